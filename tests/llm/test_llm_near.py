import random

import numpy as np
import pytest
from llm_tables import documents, found, no_documents, rows

from shelftrace.llm import near_dedup
from shelftrace.llm.components import components
from shelftrace.llm.shingles import (
    FREQUENCY_BUCKETS,
    RARE_SHARE,
    Sampler,
    bucket_of,
    shingle_arrays,
    similarity,
    weighted,
)


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute_force(table, threshold=0.8):
    """Class of every row number: all pairs compared."""
    shingles = list(shingle_arrays([t for _, t in table]))
    frequency, with_words = np.zeros(FREQUENCY_BUCKETS), 0
    for s in shingles:
        frequency[np.unique(bucket_of(s))] += 1
        with_words += bool(len(s))
    common = frequency > RARE_SHARE * with_words
    idf = np.where(common, 1 + np.log10(with_words / np.maximum(frequency, 1)), 1 - np.log10(RARE_SHARE))
    sets = [weighted(s, idf) for s in shingles]
    pairs = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if (table[i][1] or "") == (table[j][1] or "") or similarity(sets[i], sets[j]) >= threshold - 1e-9
    ]
    return union_find(pairs, range(len(sets)))


def class_ids(table):
    roots = brute_force(table)
    least = {}
    for n, (id, _) in enumerate(table):
        known = [i for i in (least.get(roots[n]), id) if i is not None]
        least[roots[n]] = min(known, default=None)
    return sorted(((table[n][0], least[r]) for n, r in roots.items()), key=str)


def edited(words, share, rng):
    return [w if rng.random() > share else f"x{rng.random()}" for w in words]


def star(size, seed=1):
    """A text and its edits: all near it, few near each other; and a chain of edits."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    texts = [" ".join(base)]
    texts += [" ".join(edited(base, rng.choice([0.005, 0.01, 0.02, 0.03]), rng)) for _ in range(size)]
    link = base
    for _ in range(8):
        link = edited(link, 0.012, rng)
        texts.append(" ".join(link))
    texts += [" ".join(f"v{rng.randrange(900)}" for _ in range(150)) for _ in range(20)]
    return [(n, t) for n, t in enumerate(texts)]


@pytest.mark.parametrize("block", [16, 512])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup.remaining_links, "__defaults__", (block,))
    table = star(80)
    docs = spark.createDataFrame(table, "doc_id long, text string")
    assert sorted(found(near_dedup.near_duplicates(docs)), key=str) == class_ids(table)


@pytest.mark.parametrize("mates", [16, 200])
def test_a_centre_of_many_places(spark, monkeypatch, mates):
    monkeypatch.setattr(near_dedup, "MATES", mates)
    table = star(60, seed=3)
    docs = spark.createDataFrame(table, "doc_id long, text string")
    bands = near_dedup.band_keys(near_dedup.with_node(docs, "doc_id", "text"), np.ones(FREQUENCY_BUCKETS))
    pairs = near_dedup.centre_pairs(near_dedup.shared_buckets(bands)).collect()
    assert max(r["places"] for r in pairs) > 1
    assert len({r["b"] for r in pairs}) == len({(r["b"], r["places"]) for r in pairs})
    assert sorted(found(near_dedup.near_duplicates(docs)), key=str) == class_ids(table)


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    table = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(found(near_dedup.near_duplicates(docs)), key=str) == class_ids(table)


def test_odd_documents(spark):
    got = sorted(found(near_dedup.near_duplicates(documents(spark))), key=str)
    assert got == class_ids([(r[0], r[1]) for r in rows()])
    assert found(near_dedup.near_duplicates(no_documents(spark))) == []


def test_one_of_each_class_stays(spark):
    docs = documents(spark)
    got = near_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    kept = sorted(r[0] for r in found(got) if r[0] is not None)
    classes = class_ids([(r[0], r[1]) for r in rows()])
    assert kept == sorted({c for _, c in classes if c is not None})
    nameless = [r[1] for r in found(got) if r[0] is None]
    assert nameless == ["words without an id but with the letters"]


def test_samples_agree_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    hashes = np.unique(rng.integers(1, 1 << 63, 900).astype(np.uint64))
    weights = rng.random(len(hashes)) + 0.5
    sampler = Sampler()
    for share in (0.95, 0.8, 0.5):
        near, exact = [], []
        for _ in range(40):
            kept = rng.random(len(hashes)) < share
            other = (hashes[kept], weights[kept] * np.where(rng.random(kept.sum()) < 0.1, 0.5, 1))
            exact.append(similarity((hashes, weights), other))
            near.append((sampler.samples(hashes, weights) == sampler.samples(*other)).mean())
        assert np.mean(near) == pytest.approx(np.mean(exact), abs=0.02)


def test_shingles_are_of_five_words():
    def of(text):
        return next(shingle_arrays([text]))

    assert len(of("a b c d e f")) == 2
    assert set(of("A b, c d e!")) == set(of("a b c d e"))
    assert len(of("a b")) == 1 and of("a b")[0] != of("b a")[0]
    assert len(of("*** ")) == len(of(None)) == 0
    both = list(shingle_arrays(["a b c d e", "f g h i j"]))
    assert [len(s) for s in both] == [1, 1] and both[1][0] == of("f g h i j")[0]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(n, n + 1) for n in range(100, 140)]
    got = dict(found(components(spark.createDataFrame(links, "a long, b long"))))
    assert got == union_find(links, {n for link in links for n in link})
    assert found(components(spark.createDataFrame([], "a long, b long"))) == []


def test_of_equal_ids_and_texts_the_same_row_stays(spark):
    rows = [(1, "one text of some words here", f"source {i}", {"k": i}) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>")
    kept = [near_dedup.deduplicate(docs.repartition(n, "source")).collect() for n in (1, 3, 7)]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "n", 3)], "doc_id long, text string, kept int, node string, size int")
    assert found(near_dedup.deduplicate(docs)) == [(1, "a b", 7, "n", 3)]
