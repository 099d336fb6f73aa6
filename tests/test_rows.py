"""Validation, headers, guards, staging, ranking, totals, profiles."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan
from shelftrace import schema
from shelftrace.operators import clean, columns, profile, rank, totals, typed, validate
from shelftrace.plans import feeds, load
from shelftrace.sources import feed, remote, shared, staging
from shelftrace.sources.numbering import arrival_order, numbered

REASONS = {
    (None, None, None): "sku: Value error, SKU is required"
    " | current_price: Value error, Price is required"
    " | old_price: Value error, Price is required",
    ("  ", "1", "2"): "sku: Value error, SKU is required",
    (" A1 ", "-5", "10"): "current_price: Value error, Price must be an integer or decimal number",
    ("A1", "10", "NaN"): "old_price: Value error, Price must be an integer or decimal number",
    ("A1", "", None): "current_price: Value error, Price must be an integer or decimal number"
    " | old_price: Value error, Price is required",
    (" A1 ", "10", "12.5"): None,
}


def test_reasons(spark):
    df = spark.createDataFrame(list(REASONS), "sku string, current_price string, old_price string")
    classified = validate.classify(df)
    found = {tuple(r)[:3]: r.validation_errors for r in classified.collect()}
    assert found == REASONS
    assert [tuple(r) for r in validate.accepted(classified).collect()] == [("A1", 10.0, 12.5)]
    assert validate.rejected(classified).count() == len(REASONS) - 1


def test_required_prices_are_a_parameter(spark):
    df = spark.createDataFrame([("A1", "10", None)], "sku string, current_price string, old_price string")
    assert validate.classify(df, prices=("current_price",)).first().is_valid


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], [" Discount % ", "SKU "])
    assert columns.normalise_headers(df).columns == ["Discount", "SKU"]
    with pytest.raises(ValueError, match="collide"):
        columns.normalise_headers(spark.createDataFrame([(1, 2)], ["Discount", "Discount %"]))


def test_cleaned_headers_are_known(spark):
    df = spark.createDataFrame([("5%", "A", 1)], ["Discount", " SKU", "row_no"])
    assert columns.to_feed_columns(df).columns == ["discount", "sku", "row_no"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['sku'\]"):
        columns.project_required(spark.createDataFrame([(1,)], ["x"]), ["x", "sku"])


def test_empty_guard(spark):
    with pytest.raises(ValueError, match="empty"):
        columns.reject_empty(spark.createDataFrame([], "x int"))
    df = spark.createDataFrame([(1,)], "x int")
    assert columns.reject_empty(df) is df


def test_rules_skip_absent_columns(spark):
    df = spark.createDataFrame([(" a ", " ")], "sku string, rating string")
    assert clean.clean(df).first().asDict() == {"sku": "a", "rating": clean.NO_RATING}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "a double, b string")
    assert [tuple(r) for r in columns.nan_to_null(df).collect()] == [(None, "x"), (1.0, None)]


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        feed.read_feed(spark, str(tmp_path / "none.csv"))


def test_sheet_round_trip(spark, tmp_path):
    rows = [(" A ", 'say "hi", x', None, "u", "1.5", "NaN", "5%", "none", "N/A")]
    df = spark.createDataFrame(rows, schema.RAW_SCHEMA)
    path = str(tmp_path / "sheet")
    feed.write_raw_sheet(df, path)
    assert spark.read.csv(path, header=True).columns == list(schema.HEADERS)
    back = feed.read_feed(spark, path)
    assert back.columns == schema.FEED_COLUMNS
    assert tuple(back.first()) == (" A ", 'say "hi", x', None, "u", "1.5", None, "5%", "none", None)


def test_split_writes_both_routes_in_one_pass(spark, small, tmp_path):
    raw = feeds.raw_feed(spark, small)
    classified = validate.classify(raw)
    path = str(tmp_path / "split")
    counts = feed.write_split(classified, path)
    valid = feed.read_accepted(spark, path, classified.schema)
    invalid = feed.read_rejected(spark, path, classified.schema)
    assert (valid.count(), invalid.count()) == (counts["valid"], counts["invalid"])
    assert counts["valid"] + counts["invalid"] == raw.count()
    assert "is_valid" in plan(valid).split("PartitionFilters: ")[1].split("]")[0]


def test_split_without_rejects(spark, tmp_path):
    df = spark.createDataFrame([("A", "1", "2")], "sku string, current_price string, old_price string")
    classified = validate.classify(df)
    feed.write_split(classified, str(tmp_path / "split"))
    assert feed.read_rejected(spark, str(tmp_path / "split"), classified.schema).count() == 0


def staged(spark, rows, batch_id="b", base=0):
    fields = "row_no long, sku string, current_price double, discount string, rating string"
    df = spark.createDataFrame(rows, fields).select(
        "*",
        *[F.lit(None).cast("string").alias(c) for c in ("product_name", "image_url", "product_url")],
        F.col("current_price").alias("old_price"),
        F.lit("1,234").alias("reviews_count"),
    )
    return staging.staged_rows(df, batch_id, "feed.csv", base)


def test_staging_is_kept_by_batch(spark, tmp_path):
    path = str(tmp_path / "staging")
    first = staged(spark, [(1, "A", 1.0, "5%", "4.5"), (2, "B", 2.0, None, None)], "b1")
    assert staging.append_batch(first, path) == (2, 2)
    second = staged(spark, [(1, "A", 3.0, "5%", "4.5")], "b2", base=2)
    assert staging.append_batch(second, path) == (1, 3)
    assert staging.append_batch(second, path) == (1, 3)  # staged again, not doubled
    assert staging.read_staging(spark, path).count() == 3
    batch = staging.read_batch(spark, path, "b2")
    assert "load_batch_id" in plan(batch).split("PartitionFilters: ")[1].split("]")[0]
    row = typed.latest_typed(batch).first()
    assert (row.stage_id, row.sku, str(row.current_price), row.reviews_count) == (3, "A", "3.00", 1234)


def test_unusable_rows(spark):
    df = staged(spark, [(1, None, 1.0, "", ""), (2, "  ", 1.0, "", ""), (3, "A", None, "", ""),
                        (4, " A", 1.0, "", "")])
    assert [r.sku for r in typed.usable(df).collect()] == [" A"]


def test_price_beyond_the_dimension_stops_the_batch(spark):
    df = staged(spark, [(1, "A", float("inf"), "", "")])
    with pytest.raises(Exception, match="current_price out of range: Infinity"):
        typed.typed(df).collect()


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    last, first = rank.latest_per_key(df, "k", "n"), rank.first_per_key(df, "k", "n")
    for ranked in (last, first):
        text = plan(ranked)
        partial = text.index("WindowGroupLimit [k")
        assert "Partial" in text and "Final" in text
        assert text.index("Final") < text.index("Exchange hashpartitioning(k") < text.index("Partial")
        assert partial >= 0
    assert last.where("k = 'hot'").first().n == 19_999
    assert first.where("k = 'hot'").first().n == 1


def test_identity_falls_back(spark):
    df = spark.createDataFrame([("", None, "N"), ("S", "U", "N"), (None, "", None)], "s string, u string, n string")
    assert [r.identity for r in rank.identified(df, "s", "u", "n").collect()] == ["N", "S"]


@pytest.mark.parametrize("block,levels", [(7, 1), (3, 3), (1 << 16, 1)])
def test_running_total(spark, block, levels):
    values = {i: (i * 37) % 11 for i in range(0, 200, 3)}
    df = spark.createDataFrame(list(values.items()), "n long, v long")
    found = totals.running_total(df, "n", "v", "total", block, levels).orderBy("n").collect()
    total = 0
    for row in found:
        total += values[row.n]
        assert row.total == total
    assert len(found) == len(values)


def test_unique_by_page(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (3, "b"), (3, "c"), (3, None)], "p long, k string"
    )
    rows = totals.unique_by_page(df, "p", "k", block=2).orderBy("p").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 2, 2), (2, 1, 0, 2), (3, 2, 1, 3)]


def test_profiles(spark):
    df = spark.createDataFrame([("abc", None), ("x" * 60, None)], "a string, long_name string")
    assert {tuple(r) for r in profile.column_profile(df).collect()} == {("a", 50), ("long_name", 11)}
    fixed = profile.column_profile(df, fixed=("a",))
    assert {tuple(r) for r in fixed.collect()} == {("a", 22), ("long_name", 11)}
    rows = spark.createDataFrame([("1", "x"), ("1", None)], "rating string, reviews_count string")
    assert tuple(profile.distinct_profile(rows).first()) == (1, 1)
    assert tuple(profile.distinct_profile(rows, approximate=True).first()) == (1, 1)


def test_numbering_follows_the_order(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("v")).repartition(7)
    rows = numbered(df, ["v"], "no", base=50).collect()
    assert sorted((r.v, r.no) for r in rows) == [(i, i + 50) for i in range(1, 1001)]


def test_arrival_order_is_that_of_the_file(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("n\n" + "\n".join(str(i) for i in range(3000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = arrival_order(spark.read.option("header", True).csv(str(path)))
        assert df.rdd.getNumPartitions() > 1
        order = ["arrival_file", "arrival_block", "arrival_row"]
        found = load.number_by_arrival(df, order).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.row_no, int(r.n)) for r in found) == [(i + 1, i) for i in range(3000)]


def test_batch_ids_are_one_per_run():
    assert load.new_batch_id() != load.new_batch_id()


def test_remote_options():
    options = remote.jdbc_read_options("jdbc:x", "SELECT 1", "id", (0, 9), 3)
    assert options["dbtable"] == "(SELECT 1) AS q" and options["numPartitions"] == "3"
    assert "partitionColumn" not in remote.jdbc_read_options("jdbc:x", "SELECT 1")


def test_collated_key(spark):
    df = spark.createDataFrame([("a", 1), ("A  ", 2), ("b", 3)], "sku string, n long")
    assert sorted(r.n for r in rank.latest_per_key(columns.collate_key(df), "sku", "n").collect()) == [2, 3]
    assert rank.latest_per_key(df, "sku", "n").count() == 3


def test_cleaned_output(spark, tmp_path):
    df = spark.createDataFrame([(" a ", " 5 ")], "sku string, discount string")
    feed.write_cleaned(clean.clean(df), str(tmp_path / "cleaned"))
    assert tuple(spark.read.parquet(str(tmp_path / "cleaned")).first()) == ("a", "5%")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        feed.write_cleaned(df, str(tmp_path / "cleaned"))


def test_shared_folder(spark, monkeypatch):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared.fresh_path(spark, "x") != shared.fresh_path(spark, "x")
    assert shared.shared_folder(spark) == folder

    class Session:
        conf = {"spark.master": "yarn"}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session)
    Session.conf = {"spark.master": "local[2]"}
    assert shared.shared_folder(Session) == shared.shared_folder(Session) != folder


HEADER = ",".join(schema.HEADERS)


@pytest.mark.parametrize(
    "files",
    [
        [f"{HEADER}\nA,,,,1,2,,,\n", "Product Name,SKU" + HEADER[len("SKU,Product Name"):] + "\nx,A,,,1,2,,,\n"],
        [f"{HEADER}\nA,,,,1,2,,,,extra\n"],
        [f'{HEADER}\nA,"two\nlines",,,1,2,,,\n'],
    ],
)
def test_sheets_that_would_be_misread_stop_the_read(spark, tmp_path, files):
    for number, text in enumerate(files):
        (tmp_path / f"{number}.csv").write_text(text)
    with pytest.raises(Exception):
        feed.read_feed(spark, str(tmp_path)).select("sku").collect()


def test_line_breaks_survive_with_multiline(spark, tmp_path):
    rows = spark.createDataFrame([["a\nb", *["x"] * 8]], schema.RAW_SCHEMA)
    path = str(tmp_path / "sheet")
    feed.write_raw_sheet(rows, path)
    assert feed.read_feed(spark, path, multiline=True).first().sku == "a\nb"
    with pytest.raises(Exception):
        feed.read_feed(spark, path).collect()


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_page_runs(spark, partitions):
    """Against runs found by going through sorted numbers."""
    import random

    random.seed(int(partitions))
    rows = [("a", n) for n in range(3, 400) if n % 50] + [("a", 7), ("a", 7)]
    rows += [("b", random.randrange(60)) for _ in range(40)] + [("c", 1), ("d", 5), (None, 3), ("a", None)]
    want = []
    for crawl in "abcd":
        pages = [p for c, p in rows if c == crawl and p is not None]
        before = 0
        for page in sorted(set(pages)):
            if want and want[-1][0] == crawl and want[-1][2] == page - 1:
                want[-1][2] = page
            else:
                want.append([crawl, page, page, 0, 0, page - before - 1])
            want[-1][3] += 1
            want[-1][4] += pages.count(page) - 1
            before = page
    df = spark.createDataFrame(rows, "crawl string, n long").repartition(5)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = totals.page_runs(df, "crawl", "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(list, found)) == want


def test_sketches_merge_over_batches(spark, tmp_path):
    rows = [(b, f"v{v}", None if v % 2 else "x") for b in range(3) for v in range(100 * b, 100 * b + 150)]
    df = spark.createDataFrame(rows, "batch int, v string, w string")
    path = str(tmp_path / "sketches")
    for batch in range(3):
        profile.distinct_sketches(df.where(f"batch = {batch}"), "batch", ["v", "w"]).write.mode("append").parquet(path)
    found = profile.distinct_estimates(spark.read.parquet(path), "batch", ["v", "w"]).collect()
    assert sorted((r.batch if r.batch is not None else 9, r.distinct_v, r.distinct_w) for r in found) == [
        (0, 150, 1), (1, 150, 1), (2, 150, 1), (9, 350, 1),
    ]
    many = spark.range(100_000).select(F.lit(1).alias("b"), F.col("id").alias("v"))
    estimate = profile.distinct_estimates(profile.distinct_sketches(many, "b", ["v"]), "b", ["v"], total=False)
    assert abs(estimate.first().distinct_v - 100_000) < 3_000


def last_plan(spark):
    """The plan of the last query that ran, as it was carried out."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return spark._jsparkSession.sharedState().statusStore().executionsList().last().physicalPlanDescription()


def test_routes_and_batches_are_written_without_a_sort(spark, small, tmp_path):
    # A sort by partition holds all rows of a task, and a landed file can be one task.
    raw = feeds.raw_feed(spark, small)
    classified = validate.classify(raw)
    counts = feed.write_split(classified, str(tmp_path / "split"))
    assert "Sort" not in last_plan(spark)
    accepted = feed.read_accepted(spark, str(tmp_path / "split"), classified.schema)
    rejected = feed.read_rejected(spark, str(tmp_path / "split"), classified.schema)
    assert (accepted.count(), rejected.count()) == (counts["valid"], counts["invalid"])
    assert counts["valid"] + counts["invalid"] == raw.count() and counts["invalid"] > 0

    rows = staging.staged_rows(raw, "b1", "orders.parquet")
    staged, last = staging.append_batch(rows, str(tmp_path / "staging"))
    assert "Sort" not in last_plan(spark)
    back = staging.read_batch(spark, str(tmp_path / "staging"), "b1")
    assert back.count() == staged == raw.count()
    assert back.agg({"stage_id": "max"}).first()[0] == last
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
