import base64
import math
from collections import Counter

import numpy as np
from llm_tables import documents, found, no_documents, rows
from pyspark.sql import functions as F

from shelftrace.llm import langid
from shelftrace.llm.common import remainder


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = langid.identify(docs, remainder("doc_id", 4) != 2).join(
        docs.where(remainder("doc_id", 4) == 2).select("doc_id", "lang"), "doc_id"
    )
    right, all_rows = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_rows > 20 and right > 0.97


def test_odd_documents(spark):
    got = found(langid.identify(documents(spark), F.lit(True)))
    assert len(got) == len(rows())
    named = {r[0]: r[1:] for r in got if r[0] is not None}
    for id in (4, 5, 6, 7):
        assert named[id] == ("und", 0.0, True)
    assert named[1][0] == "en" and named[8][0] == "de"
    assert all(0 <= r[2] <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    got = found(langid.identify(documents(spark), F.lit(False)))
    assert {r[1:] for r in got} == {("und", 0.0, True)}
    assert found(langid.identify(no_documents(spark), F.lit(True))) == []


def test_foreign_text_is_rejected(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.train(docs, F.lit(True))
    texts = spark.createDataFrame([("Καλημέρα σε όλους τους ανθρώπους",), ("天地玄黄宇宙洪荒",)], "text string")
    assert [r[3] for r in found(langid.classify(texts, model))] == [True, True]
    assert langid.classify(docs, model).where("rejected").count() == 0


def test_sample_bound_does_not_change_frequencies(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    few, all_rows = (langid.train(docs, F.lit(True), n) for n in (20, 10**6))
    assert (few["idf"] == all_rows["idf"]).all()
    assert few["languages"] == all_rows["languages"]


def test_rows_without_an_id_are_sampled_as_others(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("text", "lang")
    rows = docs.withColumn("doc_id", F.lit(None).cast("long"))
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 20)).alias("place")
    copies = rows.unionByName(rows).select("text", "lang", place)
    known = rows.where("lang is not null and text is not null")
    names, sizes = zip(*sorted(known.groupBy("lang").count().collect()))
    got = dict(langid.sampled(copies.where("lang is not null and text is not null"), 10).groupBy("lang").count().collect())
    assert all(0 < got[n] < size for n, size in zip(names, sizes) if size > 20)
    assert set(langid.train(rows, F.lit(True), 10)["languages"]) == set(got)


def plain_grams(text):
    """Hashed n-grams of one to three letters, one place of the text at a time."""
    codes = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()} "]
    grams, word = Counter(), 1 << 32
    for at, code in enumerate(codes):
        one = code * 0x9E3779B1 % word
        if code != 32:
            grams[one >> 20] += 1
        if at + 1 < len(codes):
            two = ((one ^ one >> 15) * 0x85EBCA77 + codes[at + 1]) % word
            if code != 32 or codes[at + 1] != 32:
                grams[two * 0x9E3779B1 % word >> 20] += 1
            if at + 2 < len(codes) and codes[at + 1] != 32:
                three = ((two ^ two >> 13) * 0xC2B2AE3D + codes[at + 2]) % word
                grams[three * 0x85EBCA77 % word >> 20] += 1
    return grams


def test_nearest_centroids_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    learnt = remainder("doc_id", 4) != 2
    model = langid.train(docs, learnt)
    rows = [r for r in docs.collect() if r["text"] and plain_grams(r["text"])]
    taught = {r[0] for r in docs.where(learnt & F.col("lang").isNotNull()).select("doc_id").collect()}
    frequency = Counter(g for r in rows if r["doc_id"] in taught for g in plain_grams(r["text"]))
    size = sum(r["doc_id"] in taught for r in rows)
    idf = {g: math.log((size + 1) / (frequency[g] + 1)) + 1 for g in range(langid.DIMENSIONS)}
    assert np.allclose(model["idf"], [idf[g] for g in range(langid.DIMENSIONS)], rtol=1e-5)
    got = {r[0]: r[1:] for r in found(langid.classify(docs.select("doc_id", "text"), model).drop("text"))}
    for row in rows[:60]:
        weights = {g: math.log1p(n) * idf[g] for g, n in plain_grams(row["text"]).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        near = [sum(w * float(c[g]) for g, w in weights.items()) / norm for c in model["centroids"]]
        best = max(range(len(near)), key=near.__getitem__)
        assert got[row["doc_id"]][0] == model["languages"][model["of"][best]]
        assert abs(got[row["doc_id"]][1] - near[best]) < 1e-4


def test_columns_of_the_results_are_replaced(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("text", F.lit("x").alias("score"))
    model = langid.train(spark.read.parquet(f"{small}/documents.parquet"), F.lit(True), 10)
    got = langid.classify(docs, model)
    assert got.columns == ["text", "lang_pred", "score", "rejected"] and got.count() == docs.count()


def test_clusters_of_few_vectors():
    vectors = np.eye(langid.DIMENSIONS, dtype=np.float32)[:2]
    assert langid.cluster(vectors).shape == (2, langid.DIMENSIONS)


FINNISH = (
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on "
    "annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."
)


def random_letters(chance):
    return "".join(chance.choice(list("abcdefghijklmnopqrstuvwxyz "), 400))


def test_junk_and_foreign_latin_text_are_rejected(spark, small):
    docs = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet")
    docs = docs.select("doc_id", "text", "lang")
    chance = np.random.default_rng(1)
    odd = [(-i, random_letters(chance), "en") for i in (1, 2)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    learnt = remainder("doc_id", 4) != 2
    model = langid.train(docs, learnt | (F.col("doc_id") < 0))
    junk = base64.b64encode(chance.bytes(300)).decode()
    texts = [random_letters(chance), junk, FINNISH, FINNISH[:60]]
    texts = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[3] for r in found(langid.classify(texts, model))] == [True] * 4
    held_out = langid.classify(docs.where(~learnt & (F.col("doc_id") > 0)), model)
    rejected, all_rows = held_out.agg(F.sum(F.col("rejected").cast("int")), F.count("*")).first()
    assert all_rows > 200 and rejected <= 0.02 * all_rows


def test_odd_vectors_make_no_clusters():
    chance = np.random.default_rng(2)
    vectors = chance.random((400, 64)) * 0.4 + np.repeat(np.eye(4, 64) * 3, 100, axis=0)
    vectors[::133] = np.eye(64)[10:14]
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    centres = langid.cluster(vectors)
    sizes = np.bincount((vectors @ centres.T).argmax(axis=1), minlength=len(centres))
    assert len(centres) > 1 and sizes.min() >= 8
    assert np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-5)


def test_short_texts_have_a_cut_of_their_own(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    cut = langid.train(docs, F.lit(True))["cut"]
    assert (cut[:, 0] < cut[:, -1]).all()
