"""The change history: truth table, properties, store."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan
from shelftrace import schema
from shelftrace.operators import history
from shelftrace.operators.columns import collate_key
from shelftrace.operators.typed import with_fingerprint
from shelftrace.plans import feeds, registry
from shelftrace.plans.load import load_feed, merge_batch, stage_feed
from shelftrace.sources import export
from shelftrace.sources.versions import VersionStore
from shelftrace.streaming import changes
from shelftrace.streaming.landing import start_landing

T = [datetime(2024, 1, d) for d in range(1, 10)]
DIMENSION = "sku string, row_hash string, st_date timestamp_ntz, end_date timestamp_ntz, iscurrent int, product_id long"


def merged(spark, dimension, batch, time=T[5]):
    table = spark.createDataFrame(dimension, DIMENSION)
    source = spark.createDataFrame(batch, "sku string, row_hash string")
    rows = history.merge(table, source, time).collect()
    return sorted((r.sku, r.row_hash or "", r.st_date, r.end_date or T[8], r.iscurrent) for r in rows)


def test_new_key(spark):
    assert merged(spark, [], [("A", "x")]) == [("A", "x", T[5], T[8], 1)]


def test_equal_fingerprint(spark):
    assert merged(spark, [("A", "x", T[0], None, 1, 1)], [("A", "x")]) == [("A", "x", T[0], T[8], 1)]


def test_changed_fingerprint(spark):
    assert merged(spark, [("A", "x", T[0], None, 1, 1)], [("A", "y")]) == [
        ("A", "x", T[0], T[5], 0), ("A", "y", T[5], T[8], 1),
    ]


def test_closed_rows_only(spark):
    assert merged(spark, [("A", "x", T[0], T[1], 0, 1)], [("A", "x")]) == [
        ("A", "x", T[0], T[1], 0), ("A", "x", T[5], T[8], 1),
    ]


def test_null_fingerprint_is_frozen(spark):
    assert merged(spark, [("A", None, T[0], None, 1, 1)], [("A", "y")]) == [("A", "", T[0], T[8], 1)]


def test_missing_key_stays(spark):
    assert merged(spark, [("A", "x", T[0], None, 1, 1)], [("B", "y")])[0] == ("A", "x", T[0], T[8], 1)


def test_two_current_rows(spark):
    two = [("A", "x", T[0], None, 1, 1), ("A", "y", T[1], None, 1, 2)]
    assert merged(spark, two, [("A", "y")]) == [("A", "x", T[0], T[5], 0), ("A", "y", T[1], T[8], 1)]
    assert [r[1] for r in merged(spark, two, [("A", "z")])] == ["x", "y", "z"]


def test_unmarked_row_counts_as_absent(spark):
    found = merged(spark, [("A", "x", T[0], None, None, 1)], [("A", "x")])
    assert len(found) == 2


def test_rebuild(spark):
    log = [("A", 0, "x"), ("A", 1, "x"), ("A", 2, "y"), ("A", 3, "x"), ("B", 1, "x")]
    df = spark.createDataFrame([(s, T[t], h) for s, t, h in log], "sku string, change_time timestamp_ntz, row_hash string")
    rows = sorted((r.sku, r.st_date, r.end_date, r.iscurrent) for r in history.rebuild(df).collect())
    assert rows == [
        ("A", T[0], T[2], 0), ("A", T[2], T[3], 0), ("A", T[3], None, 1), ("B", T[1], None, 1),
    ]


def test_null_and_empty_text_are_one_version(spark):
    df = spark.createDataFrame(
        [("A", T[0], None), ("A", T[1], "")], "sku string, change_time timestamp_ntz, v string"
    )
    assert history.rebuild(with_fingerprint(df, columns=["v"])).count() == 1


def test_history_properties(spark, small):
    rows = registry.scd2_history(spark, small).orderBy("sku", "st_date").collect()
    by_sku = {}
    for row in rows:
        by_sku.setdefault(row.sku, []).append(row)
    for versions in by_sku.values():
        assert [v.iscurrent for v in versions] == [0] * (len(versions) - 1) + [1]
        for older, newer in zip(versions, versions[1:]):
            assert older.end_date == newer.st_date
            assert older.row_hash != newer.row_hash


def test_column_migration(spark):
    df = spark.createDataFrame([(1,)], ["effective_from"])
    assert history.migrate_columns(df).columns == ["st_date", "end_date", "iscurrent"]
    both = spark.createDataFrame([(1, 2)], ["effective_from", "st_date"])
    assert history.migrate_columns(both).columns == ["effective_from", "st_date", "end_date", "iscurrent"]


def test_bootstrap_spares_closed_rows(spark):
    fields = "created_at timestamp_ntz, st_date timestamp_ntz, end_date timestamp_ntz, iscurrent int"
    df = spark.createDataFrame([(T[0], None, T[3], None), (T[0], T[1], T[2], 0)], fields)
    rows = [tuple(r)[1:] for r in history.bootstrap(df).orderBy("iscurrent").collect()]
    assert rows == [(T[1], T[2], 0), (T[0], None, 1)]
    every = [r.end_date for r in history.bootstrap(df, every_row=True).collect()]
    assert every == [None, None]


def source(spark, rows):
    df = spark.createDataFrame(rows, "stage_id long, sku string, product_name string")
    for f in schema.SOURCE_SCHEMA:
        if f.name not in df.columns and f.name != "row_hash":
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return with_fingerprint(df).select(*schema.SOURCE_SCHEMA.names)


def versions(store):
    return sorted(
        (r.sku, r.product_name, r.st_date, r.end_date or T[8], r.iscurrent)
        for r in store.all_versions().collect()
    )


@pytest.mark.parametrize("buckets", [1, 5])
def test_store(spark, tmp_path, buckets):
    root = str(tmp_path / "dim")
    store = VersionStore(spark, root, buckets)
    assert store.current().count() == 0
    assert store.apply(source(spark, [(1, "A", "x"), (2, "B", "x")]), "b1", T[0], 2) == 2
    assert store.apply(source(spark, [(3, "A", "y"), (4, "C", "x")]), "b2", T[1], 4) == 2
    assert store.apply(source(spark, [(5, "A", "y")]), "b3", T[2], 5) == 0
    assert store.apply(source(spark, [(1, "A", "x"), (2, "B", "x")]), "b1", T[3], 2) == 0  # replay
    reopened = VersionStore(spark, root, buckets)
    assert reopened.apply(source(spark, [(6, "A", "x")]), "b4", T[4], 6) == 1
    assert versions(reopened) == [
        ("A", "x", T[0], T[1], 0), ("A", "x", T[4], T[8], 1), ("A", "y", T[1], T[4], 0),
        ("B", "x", T[0], T[8], 1), ("C", "x", T[1], T[8], 1),
    ]
    ids = {(r.sku, r.st_date): r.product_id for r in store.all_versions().collect()}
    assert sorted(ids.values()) == [1, 2, 3, 4, 5]
    assert max(ids["A", T[0]], ids["B", T[0]]) < min(ids["A", T[1]], ids["C", T[1]]) < ids["A", T[4]]
    assert store.state()[0].last_stage_id == 6


def test_failed_merge_leaves_the_table(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    store.apply(source(spark, [(1, "A", "x")]), "b1", T[0])
    broken = source(spark, [(2, "A", "y")]).withColumn(
        "product_name", F.when(F.col("stage_id") == 2, F.raise_error(F.lit("no"))).cast("string")
    )
    with pytest.raises(Exception, match="no"):
        store.apply(broken, "b2", T[1])
    assert versions(store) == [("A", "x", T[0], T[8], 1)]
    assert store.apply(source(spark, [(2, "A", "y")]), "b2", T[1]) == 1


def test_a_small_merge_reads_one_bucket(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"), buckets=8)
    store.apply(source(spark, [(i, f"S{i}", "x") for i in range(200)]), "b1", T[0])
    first = {f.relative_to(tmp_path): f.stat().st_mtime_ns for f in (tmp_path / "dim/versions").rglob("*.parquet")}
    assert len({f.parent.name for f in first}) == 8
    store.apply(source(spark, [(300, "S7", "y")]), "b2", T[1])
    files = {f.relative_to(tmp_path): f.stat().st_mtime_ns for f in (tmp_path / "dim/versions").rglob("*.parquet")}
    assert len({f.parent.name for f in files.keys() - first.keys()}) == 1
    assert first.items() <= files.items()  # what was written stays as it is
    assert "bucket" in plan(store.current([3])).split("PartitionFilters: ")[1].split("]")[0]
    assert store.current().count() == 200 and store.all_versions().count() == 201


def test_a_load_reads_its_state_once(spark, tmp_path, monkeypatch):
    store = VersionStore(spark, str(tmp_path / "dim"))
    reads = []
    read = VersionStore.state
    monkeypatch.setattr(VersionStore, "state", lambda self, batch: reads.append(1) or read(self, batch))
    load_feed(spark, raw(spark, [(1, "A", "1", "2")]), store, T[0], "f.csv", "b1")
    load_feed(spark, raw(spark, [(1, "A", "3", "4")]), store, T[1], "f.csv", "b2")
    assert len(reads) == 2


def test_versions_of_an_unfinished_load_do_not_count(spark, tmp_path, monkeypatch):
    store = VersionStore(spark, str(tmp_path / "dim"))
    store.apply(source(spark, [(1, "A", "x")]), "b1", T[0])
    kept = store.loads().collect()
    store.apply(source(spark, [(2, "A", "y"), (3, "B", "x")]), "b2", T[1])
    spark.createDataFrame(kept, store.loads().schema).write.parquet(str(tmp_path / "kept"))
    monkeypatch.setattr(VersionStore, "loads", lambda self: spark.read.parquet(str(tmp_path / "kept")))
    assert versions(store) == [("A", "x", T[0], T[8], 1)]


def test_change_times_only_grow(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    store.apply(source(spark, [(1, "A", "x")]), "b1", T[2])
    for moment in (T[1], T[2]):
        with pytest.raises(ValueError, match="not later"):
            store.apply(source(spark, [(2, "A", "y")]), "b2", moment)
    assert versions(store) == [("A", "x", T[2], T[8], 1)]


def test_unmarked_table_is_adopted_whole(spark, small, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    table = history.migrate_columns(feeds.legacy_table(spark, small))
    store.adopt(table)
    assert store.all_versions().count() == table.count()
    highest = table.agg(F.max("product_id"), F.max("stage_id")).first()
    last, _ = store.state()
    assert (last.last_product_id, last.last_stage_id) == tuple(highest)
    other = VersionStore(spark, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="neither current"):
        other.adopt(table.withColumn("iscurrent", F.lit(2)))
    assert other.state()[0] is None


def test_point_in_time(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    store.apply(source(spark, [(1, "A", "x"), (2, "B", "x")]), "b1", T[0])
    store.apply(source(spark, [(3, "A", "y")]), "b2", T[2])

    def at(moment):
        rows = history.as_of(store.all_versions(), moment).collect()
        return sorted((r.sku, r.product_name) for r in rows)

    assert at(T[0]) == at(T[1]) == [("A", "x"), ("B", "x")]
    assert at(T[2]) == at(T[5]) == [("A", "y"), ("B", "x")]
    assert at("2020-01-01 00:00:00") == []


def test_adopted_table(spark, small, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    old = feeds.legacy_table(spark, small)
    table = history.backfill_fingerprints(history.bootstrap(history.migrate_columns(old)))
    store.adopt(table)
    assert store.all_versions().count() == old.count()
    assert store.current().count() == table.where("iscurrent = 1").count()
    last = store.state()[0].last_product_id
    assert store.apply(source(spark, [(1, "NEW", "x")]), "b", T[0]) == 1
    assert store.current().where("sku = 'NEW'").first().product_id == last + 1


def raw(spark, rows):
    df = spark.createDataFrame(rows, "row_no long, sku string, current_price string, old_price string")
    for c in schema.FEED_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def test_load_feed(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    first = load_feed(spark, raw(spark, [(1, " A ", "1", "2"), (2, "A", "3", "4"), (3, "", "1", "1")]), store, T[0], "f.csv", "b1")
    assert (first.valid, first.invalid, first.staged, first.inserted) == (2, 1, 2, 1)
    assert str(store.current().first().current_price) == "3.00"
    assert load_feed(spark, raw(spark, [(1, "A", "9", "9")]), store, T[1], "f.csv", "b1").inserted == 0
    second = load_feed(spark, raw(spark, [(1, "A", "3", "4"), (2, "B", "1", "2")]), store, T[1], "f.csv")
    assert second.inserted == 1
    assert store.current().where("sku = 'B'").first().stage_id == 4
    with pytest.raises(ValueError, match="row_no"):
        load_feed(spark, raw(spark, [(1, "A", "1", "2")]).drop("row_no"), store, T[2], "f.csv")
    with pytest.raises(ValueError, match="Batch unknown is empty"):
        merge_batch(spark, store, "unknown", T[2])
    with pytest.raises(ValueError, match="no valid rows"):
        load_feed(spark, raw(spark, [(1, None, "1", "2")]), store, T[2], "f.csv")


def test_staging_outlives_a_failed_merge(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    stage_feed(spark, raw(spark, [(1, "A", "1", "2")]), store, "b1", "f.csv")
    assert store.all_versions().count() == 0
    assert merge_batch(spark, store, "b1", T[0]) == 1
    assert merge_batch(spark, store, "b1", T[1]) == 0


def test_export(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "dim"))
    assert export.export_current(spark, store.all_versions(), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()
    store.apply(source(spark, [(1, "A", "x"), (2, "B", "x")]), "b1", T[0])
    store.apply(source(spark, [(3, "A", "y")]), "b2", T[1])
    assert export.export_current(spark, store.all_versions(), str(tmp_path / "out")) == 2
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == schema.EXPORT_COLUMNS
    assert sorted((r.sku, r.st_date, r.end_date) for r in back.collect()) == [
        ("A", "2024-01-02 00:00:00", None), ("B", "2024-01-01 00:00:00", None),
    ]


def test_landing_folder(spark, tmp_path):
    folder, store = str(tmp_path / "landing"), VersionStore(spark, str(tmp_path / "dim"))
    times = iter(T)

    def land(rows):
        feed = raw(spark, rows).select("row_no", *schema.FEED_COLUMNS)
        feed.coalesce(1).write.mode("append").parquet(folder)
        start_landing(spark, folder, store, str(tmp_path / "cp"), lambda: next(times)).awaitTermination()

    land([(1, "A", "1", "2"), (2, "B", "1", "NA")])
    land([(1, "A", "5", "6")])
    rows = [(r.sku, str(r.current_price), r.iscurrent) for r in store.all_versions().collect()]
    assert sorted(rows) == [("A", "1.00", 0), ("A", "5.00", 1)]


def test_two_landing_folders_and_a_file_without_valid_rows(spark, tmp_path):
    store, times = VersionStore(spark, str(tmp_path / "dim")), iter(T)

    def land(folder, rows):
        feed = raw(spark, rows).select("row_no", *schema.FEED_COLUMNS)
        path = str(tmp_path / folder)
        feed.coalesce(1).write.mode("append").parquet(path)
        query = start_landing(spark, path, store, f"{path}-cp", lambda: next(times))
        query.awaitTermination()
        assert query.exception() is None

    land("one", [(1, "A", "1", "2")])
    land("two", [(1, "B", "1", "2")])
    land("one", [(1, None, "1", "2"), (2, "", "x", "2")])
    land("one", [(1, "C", "1", "2")])
    assert sorted(r.sku for r in store.current().collect()) == ["A", "B", "C"]
    kept = spark.read.parquet(str(tmp_path / "dim" / "split")).where("is_valid = false")
    assert kept.count() == 2


def test_collated_merge(spark):
    table = spark.createDataFrame([("A ", "x", T[0], None, 1, 1)], DIMENSION)
    batch = spark.createDataFrame([("a", "x"), ("b", "x")], "sku string, row_hash string")
    rows = history.merge(collate_key(table), collate_key(batch), T[5]).collect()
    assert sorted(r.sku for r in rows) == ["A ", "b"]


def test_ends_follow_from_the_next_version(spark):
    rows = [("A", "x", T[0], None, 1, 1), ("A", "y", T[2], None, 1, 2), ("B", "x", T[0], T[1], 0, 3), ("B", "y", T[3], None, 1, 4)]
    found = history.with_ends(spark.createDataFrame(rows, DIMENSION)).collect()
    assert sorted((r.sku, r.row_hash, r.end_date or T[8], r.iscurrent) for r in found) == [
        ("A", "x", T[2], 0), ("A", "y", T[8], 1), ("B", "x", T[1], 0), ("B", "y", T[8], 1),
    ]


@pytest.mark.parametrize("most", [1 << 20, 3])
def test_as_of_for_many_moments(spark, most):
    """Against a comparison of every moment with every version."""
    import random

    random.seed(most)
    day = [datetime(2024, 2, d) for d in range(1, 28)]
    kept = []
    for sku in "ABCDE":
        starts = sorted(random.sample(range(25), 4))
        for i, start in enumerate(starts):
            end = None if i == 3 and sku != "E" else starts[i + 1] if i < 3 and random.random() < 0.7 else start + 1
            kept.append((sku, f"{sku}{i}", day[start], None if end is None else day[end], int(end is None), i))
    asked = [(n, random.choice("ABCDEX"), random.choice(day)) for n in range(200)]
    asked += [(200, None, day[3]), (201, "A", None), (202, None, None), (203, "A", day[5]), (203, "A", day[5])]
    table = spark.createDataFrame(kept, DIMENSION)
    moments = spark.createDataFrame(asked, "n long, sku string, moment timestamp_ntz")
    found = history.as_of_moments(table, moments, most=most).collect()
    got = sorted((r.n, r.sku or "", r.moment or T[0], r.version.row_hash if r.version else "") for r in found)
    want = []
    for n, sku, moment in asked:
        valid = [v[1] for v in kept if v[0] == sku and moment and v[2] <= moment and (v[3] is None or moment < v[3])]
        want.append((n, sku or "", moment or T[0], valid[0] if valid else ""))
    assert got == sorted(want)
    assert "CartesianProduct" not in plan(history.as_of_moments(table, moments, most=most))
    assert "NestedLoop" not in plan(history.as_of_moments(table, moments, most=most))


def test_changes_in_a_stream(spark, tmp_path):
    fields = spark.createDataFrame([], "sku string, change_time timestamp_ntz, stage_id long, row_hash string").schema
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def arrive(rows):
        spark.createDataFrame(rows, fields).repartition(3).write.mode("append").parquet(folder)
        query = changes.run_changes(spark, folder, fields, out, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
        found = spark.read.parquet(out).collect()
        return sorted((r.sku, r.change_time, r.row_hash or "", r.kind) for r in found)

    first = arrive([("A", T[0], 1, "x"), ("A", T[0], 2, "y"), ("A", T[1], 3, "y"), ("B", T[1], 4, "x"), (None, T[0], 5, "x")])
    assert first == [("A", T[0], "y", "opened"), ("B", T[1], "x", "opened")]
    second = arrive([("A", T[2], 6, "x"), ("B", T[2], 7, "x"), ("B", T[0], 8, "z"), ("C", T[0], 9, None)])
    assert second == sorted(first + [("A", T[2], "x", "opened"), ("B", T[0], "z", "late")])
    assert arrive([("A", T[3], 10, "x")]) == second


@pytest.mark.parametrize("buckets", [1, 7])
def test_products_share_a_state_in_the_stream(spark, tmp_path, monkeypatch, buckets):
    """Against a fold of every product by itself, while Python is called per bucket."""
    import random

    monkeypatch.setattr(changes, "BUCKETS", buckets, raising=False)
    random.seed(buckets)
    fields = spark.createDataFrame([], "sku string, change_time timestamp_ntz, stage_id long, row_hash string").schema
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    moments = [T[0].replace(microsecond=7), *T[1:6]]
    known, want = {}, []
    for arrival in range(3):
        rows = [
            (f"{random.choice('PQ')}{random.randrange(100)}", random.choice(moments), n, random.choice(["x", "y", None]))
            for n in range(500 * arrival, 500 * arrival + 500)
        ]
        # A row without a stage id or time comes before the others, as when a batch is ranked.
        rows += [("Z", T[arrival], None, "x"), ("Z", T[arrival], 1 << 60, "z"), (f"N{arrival}", None, 1, "x"), (f"N{arrival}", T[0], 2, "y")]
        spark.createDataFrame(rows, fields).repartition(3).write.mode("append").parquet(folder)
        query = changes.run_changes(spark, folder, fields, out, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= buckets
        last = {}
        for sku, moment, stage, fingerprint in rows:
            held = last.setdefault((sku, moment or datetime.min), (moment, stage, fingerprint))
            if (held[1] or -1) < (stage or -1):
                last[sku, moment or datetime.min] = (moment, stage, fingerprint)
        for (sku, since), (moment, stage, fingerprint) in sorted(last.items()):
            before, held = known.get(sku, (None, None))
            late = before is not None and since <= before
            if late or fingerprint != held:
                want.append((sku, moment, stage, fingerprint, "late" if late else "opened"))
            if not late:
                known[sku] = (since, fingerprint)
    found = spark.read.parquet(out).withColumn("change_time", F.col("change_time").cast("timestamp_ntz"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_landed_rows_name_their_files(spark, tmp_path):
    folder, store = str(tmp_path / "landing"), VersionStore(spark, str(tmp_path / "dim"))
    for rows in ([(1, "A", "1", "2")], [(2, "B", "1", "2"), (3, "C", "1", "2")]):
        feed = raw(spark, rows).select("row_no", *schema.FEED_COLUMNS)
        feed.coalesce(1).write.mode("append").parquet(folder)
    start_landing(spark, folder, store, str(tmp_path / "cp"), lambda: T[0]).awaitTermination()
    names = {f.name: f for f in (tmp_path / "landing").glob("*.parquet")}
    staged = spark.read.parquet(store.staging_path()).collect()
    assert len(staged) == 3 and len({r.load_batch_id for r in staged}) == 1
    for row in staged:
        held = spark.read.parquet(str(names[row.source_file]))
        assert row.sku in {r.sku for r in held.collect()}
