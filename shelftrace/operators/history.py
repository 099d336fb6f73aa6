"""Slowly Changing Dimension, type 2.

Two ways to the same table: `merge` applies one batch to the versions so far,
`rebuild` derives all versions from the whole log of batches at once.
"""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.functions.fingerprint import row_hash


def _is_current():
    return F.col("iscurrent").eqNullSafe(1)


def changed(current, source, key="sku"):
    """Current rows whose incoming row has another fingerprint.

    A null fingerprint compares as unknown: such a row stays until it is backfilled.
    """
    incoming = source.select(key, F.col("row_hash").alias("_incoming"))
    return current.join(incoming, key).where("row_hash <> _incoming").drop("_incoming")


def openable(current, source, key="sku"):
    """Incoming rows that no surviving current row stands for.

    Survivors are the current rows that `changed` leaves alone. They are found from
    keys and fingerprints with an inner join, for which a small batch can be sent to
    the dimension; an anti join against the dimension itself would shuffle it always.
    """
    incoming = source.select(key, F.col("row_hash").alias("_incoming"))
    standing = F.coalesce(F.col("row_hash") == F.col("_incoming"), F.lit(True))
    survivors = current.select(key, "row_hash").join(incoming, key).where(standing)
    return source.join(survivors.select(key), key, "left_anti")


def close_changed(current, source, change_time, key="sku"):
    """Current rows, those that changed closed at `change_time`."""
    incoming = source.select(key, F.col("row_hash").alias("_incoming"))
    closes = F.coalesce(F.col("row_hash") != F.col("_incoming"), F.lit(False))
    return (
        current.join(incoming, key, "left")
        .withColumns(
            {
                "end_date": F.when(closes, change_time).otherwise(F.col("end_date")),
                "iscurrent": F.when(closes, F.lit(0)).otherwise(F.col("iscurrent")),
            }
        )
        .drop("_incoming")
        .select(*current.columns)
    )


def open_versions(rows, change_time):
    """New rows as open versions starting at `change_time`, without product ids."""
    return rows.withColumns(
        {
            "created_at": change_time,
            "st_date": change_time,
            "end_date": F.lit(None).cast("timestamp_ntz"),
            "iscurrent": F.lit(1),
        }
    )


def merge(dimension, source, change_time, key="sku"):
    """The dimension after one batch; new versions have a null product id.

    Only current rows take part in the joins, history passes through.
    """
    change_time = as_time(change_time)
    current = dimension.where(_is_current())
    opened = open_versions(openable(current, source, key), change_time)
    return (
        dimension.where(~_is_current())
        .unionByName(close_changed(current, source, change_time, key))
        .unionByName(opened, allowMissingColumns=True)
    )


def as_time(value):
    """A change time given by the caller; plans hold no clock."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def rebuild(latest, time="change_time", key="sku", fingerprint="row_hash"):
    """All versions from the latest row per key and batch.

    A key has one row per batch here, so no group outgrows the number of batches.
    Both windows share one shuffle and one sort.
    """
    by_time = Window.partitionBy(key).orderBy(time)
    before = F.lag(fingerprint).over(by_time)
    return (
        latest.withColumn("_before", before)
        .where(F.col("_before").isNull() | (F.col("_before") != F.col(fingerprint)))
        .drop("_before")
        .withColumn("end_date", F.lead(time).over(by_time))
        .withColumnRenamed(time, "st_date")
        .withColumn("iscurrent", F.col("end_date").isNull().cast("int"))
    )


def with_ends(opened, key="sku"):
    """Versions as they were opened, with their ends: a current one ends where the next of
    its key begins. Rows that were closed before keep their end."""
    following = F.lead("st_date").over(Window.partitionBy(key).orderBy("st_date", "product_id"))
    ends = _is_current() & F.col("_next").isNotNull()
    return (
        opened.withColumn("_next", following)
        .withColumns(
            {
                "end_date": F.when(ends, F.col("_next")).otherwise(F.col("end_date")),
                "iscurrent": F.when(ends, F.lit(0)).otherwise(F.col("iscurrent")),
            }
        )
        .drop("_next")
    )


def current_versions(dimension):
    return dimension.where("iscurrent = 1")


def as_of(dimension, moment):
    """The versions that were valid at a moment: begun by then and not yet ended."""
    moment = as_time(moment)
    ended = F.col("end_date").isNotNull() & (F.col("end_date") <= moment)
    return dimension.where((F.col("st_date") <= moment) & ~ended)


# Moments of one key that a task takes; a key with more of them is dealt to several.
MOMENTS_PER_TASK = 1 << 20


def as_of_moments(dimension, moments, key="sku", moment="moment", most=MOMENTS_PER_TASK):
    """The moments with the version of their key that was valid then, as struct `version`,
    null if there was none; a version is valid from its start until before its end.

    Versions and moments of a key are sorted by time together and each moment takes the
    last version that began before: an as-of join by one shuffle and one sort, whose work
    does not grow with versions times moments. A key with more than `most` moments is
    dealt to several tasks, each with a copy of the key's versions. Of versions of a key
    that start at the same time, the one with the greatest end counts, an open one before
    others. Moments without a key or time get no version.
    """
    versions = dimension.where(F.col(key).isNotNull() & F.col("st_date").isNotNull())
    versions = versions.select(
        F.col(key).alias("_key"), F.col("st_date").alias("_time"), F.struct(*dimension.columns).alias("version")
    )
    asked = moments.select(
        F.col(key).alias("_key"), F.col(moment).cast("timestamp_ntz").alias("_time"), F.struct(*moments.columns).alias("_row")
    )
    counts = asked.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_count"))
    hot = counts.where(F.col("_count") > most).select("_key", F.ceil(F.col("_count") / most).cast("int").alias("_deals"))
    deals = F.coalesce("_deals", F.lit(1))
    # Moments without a key meet nothing; they spread over all tasks.
    dealt = F.when(F.col("_key").isNull(), F.xxhash64("_row")).otherwise(F.pmod(F.xxhash64("_row"), deals))
    asked = asked.join(hot, "_key", "left").withColumn("_deal", dealt).drop("_deals")
    versions = versions.join(hot, "_key", "left").withColumn(
        "_deal", F.explode(F.sequence(F.lit(0).cast("long"), deals.cast("long") - 1))
    ).drop("_deals")
    both = versions.unionByName(asked, allowMissingColumns=True)
    end = F.coalesce("version.end_date", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    along = Window.partitionBy("_key", "_deal").orderBy("_time", F.col("_row").isNotNull(), end)
    last = F.last("version", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    joined = both.withColumn("_last", last).where(F.col("_row").isNotNull())
    ended = F.col("_last.end_date").isNotNull() & (F.col("_last.end_date") <= F.col("_time"))
    return joined.select("_row.*", F.when(F.col("_time").isNotNull() & ~ended, F.col("_last")).alias("version"))


def bootstrap(table, every_row=False):
    """Validity columns for a table that had none.

    Rows not yet marked get an open version starting when they were created. With
    `every_row` the end date of closed rows is erased as well.
    """
    unmarked = F.lit(True) if every_row else F.col("iscurrent").isNull()
    return table.withColumns(
        {
            "st_date": F.when(
                unmarked, F.coalesce("st_date", "created_at")
            ).otherwise(F.col("st_date")),
            "end_date": F.when(~unmarked, F.col("end_date")),
            "iscurrent": F.coalesce("iscurrent", F.lit(1)),
        }
    )


def backfill_fingerprints(table, columns=schema.TRACKED, **options):
    return table.withColumn(
        "row_hash", F.coalesce("row_hash", row_hash(columns, **options))
    )


# Former column names, and the columns every dimension has.
FORMER_NAMES = {"effective_from": "st_date", "effective_to": "end_date"}
VALIDITY_COLUMNS = {
    "st_date": "timestamp_ntz",
    "end_date": "timestamp_ntz",
    "iscurrent": "int",
}


def migrate_columns(table, former=FORMER_NAMES, added=VALIDITY_COLUMNS):
    """Rename a former column unless the new one exists; add what is still missing."""
    renames = {
        old: new
        for old, new in former.items()
        if old in table.columns and new not in table.columns
    }
    table = table.withColumnsRenamed(renames)
    return table.withColumns(
        {c: F.lit(None).cast(t) for c, t in added.items() if c not in table.columns}
    )
