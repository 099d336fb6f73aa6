"""The stages against the operators' plain results, and all queries with SQL."""

import pytest
from compare import connect, differences
from llm_tables import documents
from pyspark.sql import functions as F
from test_llm_near import class_ids

import corpus_pipeline
from shelftrace.llm.oracle import SQL
from shelftrace.llm.queries import QUERIES, WORD_BPE_FILE
from shelftrace.llm import bpe, langid, mixing, toxicity
from shelftrace.llm.common import remainder


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, small, name):
    wrong, size = differences(spark, connect(small), small, name, QUERIES[name], SQL[name])
    assert wrong is None and size > 0


@pytest.fixture(scope="module")
def stages(spark, small):
    """The rows that each stage is given and gives, as it would be run."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, small)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        made.write.mode("overwrite").parquet(path)
        made = spark.read.parquet(path)
        out.append((name, docs, made))
        docs = made
    return out


def test_stages_keep_the_columns(spark, small, stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.exceptAll(before.dropDuplicates()).dropDuplicates().subtract(before).count() == 0


def test_clean_documents_stay(stages):
    for _, before, after in stages[:2]:
        assert 0.85 * before.count() <= after.count() <= before.count()


def test_first_stages_keep_what_the_operators_do(spark, small, stages):
    """What stays is what the operators, asked by themselves, do not reject."""
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{small}/labels.parquet")
    scored = toxicity.score_documents(before, labels, remainder("doc_id", 5) != 0)
    want = sorted(r[0] for r in scored.where("predicted = 0").select("doc_id").collect())
    assert sorted(r[0] for r in after.select("doc_id").collect()) == want
    _, before, after = stages[1]
    named = langid.identify(before, remainder("doc_id", 4) != 2)
    want = sorted(r[0] for r in named.where("not rejected").select("doc_id").collect())
    assert sorted(r[0] for r in after.select("doc_id").collect()) == want


def test_columns_of_any_name(spark, small, stages):
    names = ["score", "passages", "lang_pred", "rejected", "kept", "of", "time", "below"]
    docs = stages[0][1].withColumns({n: F.lit(n) for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, small)
        assert made.columns == docs.columns
        assert made.select(*names).distinct().collect() == [tuple(names)]


def test_one_of_each_class(stages):
    _, before, after = stages[2]
    classes = class_ids([tuple(r) for r in before.select("doc_id", "text").collect()])
    assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted({c for _, c in classes})


def test_mix(stages):
    _, before, after = stages[3]
    taken = {r[0]: (r[4] // r[1] if r[1] else None) for r in mixing.mix(before).collect()}
    counts = {r[0]: r[1] for r in after.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


def test_encoded(stages):
    _, before, after = stages[4]
    tokenizer = bpe.load_tokenizer(WORD_BPE_FILE)
    want = sorted(
        (r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids)
        for r in before.select("doc_id", "text").collect()
    )
    assert sorted((r[0], list(r[1])) for r in after.select("doc_id", "ids").collect()) == want


def test_odd_documents(spark, small):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, small)
        rows = made.collect()
        if stage is not corpus_pipeline.encoded:
            assert made.columns == docs.columns
        docs = spark.createDataFrame(rows, made.schema)


def test_no_documents(spark, small):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, small).collect(), stage(spark, docs, small).schema)
        assert docs.count() == 0
