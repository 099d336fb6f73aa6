import hashlib
import math
import re

import pytest
import xxhash
from conftest import plan
from llm_tables import documents, found, no_documents, rows
from pyspark.sql import functions as F

from shelftrace.llm import spotsigs


def spots(text):
    """Spots of a text as (anchor, content words), without hashing."""
    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    out = set()
    for place, word in enumerate(words):
        if word in spotsigs.ANCHORS:
            after = words[place + 1 : place + 1 + spotsigs.REACH]
            chain = [w for w in after if w not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((word, *chain))
    return out or set(words) or ({text} if text else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def hashed(text):
    """The order of texts of one id: XXH64 with seed 42, as a signed number."""
    number = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return number - (1 << 64) if number >> 63 else number


def expected(table):
    ordered = sorted(table, key=lambda r: (-math.inf if r[0] is None else r[0], hashed(r[1])))
    out = []
    for place, (id, text) in enumerate(ordered):
        after = ordered[(place + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        out.append(
            (id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
             likeness(spots(text), spots(edited)), likeness(spots(text), spots(after)))
        )
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]


def check(df, table):
    got = sorted(found(df.select(*COLUMNS)), key=lambda r: str(r[:3]))
    want = sorted(expected(table), key=lambda r: str(r[:3]))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3:] for r in got] == [pytest.approx(r[3:]) for r in want]


def test_odd_documents(spark):
    check(spotsigs.fingerprint_documents(documents(spark)), [(r[0], r[1] or "") for r in rows()])


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check(
        spotsigs.fingerprint_documents(docs),
        [tuple(r) for r in docs.select("doc_id", "text").collect()],
    )


def test_order_spans_ranges(spark):
    ids = [i * i * 10**9 + i for i in range(300)]
    docs = spark.createDataFrame([(i, f"text of {i} in a row") for i in ids], "doc_id long, text string")
    rows = docs.select(F.col("doc_id").alias("id"), "text").repartition(7)
    got = dict(found(spotsigs.with_next(rows, ["text"]).select("id", "next_text")))
    assert got == {i: f"text of {ids[(n + 1) % 300]} in a row" for n, i in enumerate(ids)}


def test_one_and_no_document(spark):
    one = spark.createDataFrame([(5, "the old house of a river")], "doc_id long, text string")
    check(spotsigs.fingerprint_documents(one), [(5, "the old house of a river")])
    assert found(spotsigs.fingerprint_documents(no_documents(spark))) == []


def test_equal_texts_have_equal_fingerprints(spark):
    got = found(spotsigs.fingerprint_documents(documents(spark)).select("doc_id", "fingerprint"))
    by_id = dict(got)
    assert by_id[1] == by_id[2] != by_id[8]


def test_lengths_rule_pairs_out(spark):
    rows = [([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([1], list(range(1, 30))), ([], []), ([], [1])]
    pairs = spark.createDataFrame(rows, "a array<long>, b array<long>")
    near = [r[0] for r in found(pairs.select(spotsigs.jaccard(F.col("a"), F.col("b"), 0.2)))]
    assert near == [0.8, 0.0, 1.0, 0.0]
    low = [r[0] for r in found(pairs.select(spotsigs.jaccard(F.col("a"), F.col("b"), 0.01)))]
    assert low[1] == pytest.approx(1 / 29)


def test_similar_sets_lie_in_neighbouring_partitions(spark):
    lengths = spark.range(1, 300).select(F.array_repeat(F.lit(1).cast("long"), F.col("id").cast("int")).alias("s"))
    part = [r[0] for r in found(lengths.select(spotsigs.length_partition(F.col("s"), 0.8)))]
    for short in range(1, 300):
        for long in range(short, min(300, int(short / 0.8) + 1)):
            assert part[long - 1] - part[short - 1] <= 1


def test_no_python_runs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = plan(spotsigs.fingerprint_documents(docs))
    assert not re.search("Python|Arrow|Pandas", text)


def test_near_duplicates(spark):
    base = "the house by the river is old and the stones of the bridge are worn as in the valley of a mill "
    texts = [base * 2 + "the end of one tale", base * 2 + "the end of one tale of kings and queens", "unlike " * 30 + "the other story is told"]
    docs = spark.createDataFrame(
        [(10 + i, t) for i, t in enumerate(texts)] + [(20, texts[0]), (None, texts[0]), (30, None)],
        "doc_id long, text string",
    )
    pairs, members = spotsigs.near_duplicates(docs, 0.8)
    sets = [spots(t) for t in texts]
    assert likeness(sets[0], sets[1]) >= 0.8 > likeness(sets[0], sets[2])
    classes = dict((r[0], r[1]) for r in found(members) if r[0] is not None)
    assert classes == {10: 10, 20: 10, 11: 11, 12: 12, 30: 30}
    got = found(pairs)
    assert [(a, b) for a, b, _ in got] == [(10, 11)]
    assert got[0][2] == pytest.approx(likeness(sets[0], sets[1]))


def test_small_likeness_is_reported(spark):
    long = " ".join(f"the w{i} v{i}" for i in range(300))
    table = [(1, long), (2, "the w7 v7"), (3, "unlike"), (4, "the w7 v7 of u1 t1")]
    check(spotsigs.fingerprint_documents(spark.createDataFrame(table, "doc_id long, text string")), table)
    assert expected(table)[0][4] == pytest.approx(1 / 300)


@pytest.mark.parametrize("id", [None, 7])
def test_rows_of_one_id_spread_over_ranges(spark, id):
    table = [(id, f"the story number {i} of all") for i in range(400)] + [(i, f"by the road {i} on") for i in range(5, 60, 9)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    check(spotsigs.fingerprint_documents(docs), table)
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    sizes = spotsigs.in_ranges(rows)[0].groupBy("__range").count().collect()
    assert max(r["count"] for r in sizes) < 400 / 3
