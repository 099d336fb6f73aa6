"""The staging table: every batch as it arrived, kept apart by batch id."""

from pyspark.sql import Column, Observation
from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.operators.columns import nan_to_null, require_columns
from shelftrace.sources.shared import open_files


def staged_rows(df, batch_id, source_file, base=0, order="row_no"):
    """The nine feed columns with batch id, source file (a text or a column) and stage id.

    `order` numbers the rows of the feed by arrival; stage ids continue after
    `base`, so later batches always rank above earlier ones.
    """
    require_columns(df, [order, *schema.FEED_COLUMNS])
    return nan_to_null(df).select(
        (F.lit(base) + F.col(order)).cast("bigint").alias("stage_id"),
        as_literal(source_file).alias("source_file"),
        *schema.FEED_COLUMNS,
        as_literal(batch_id).alias("load_batch_id"),
    )


def as_literal(value):
    return value if isinstance(value, Column) else F.lit(value)


def append_batch(staged, path, several=False):
    """Write one batch; staging the same batch id again replaces it. `several` batches at
    once are brought together by batch first, else every task writes a file of each.

    Returns the number of staged rows and their highest stage id, counted by the
    write itself.
    """
    seen = Observation()
    if several:
        staged = staged.hint("rebalance", F.col("load_batch_id"))
    watched = staged.observe(
        seen,
        F.count(F.lit(1)).alias("staged"),
        F.max("stage_id").alias("last_stage_id"),
    )
    with open_files(staged.sparkSession, 1):
        watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "load_batch_id"
        ).parquet(path)
    found = seen.get
    return found.get("staged", 0), found.get("last_stage_id")


def read_staging(spark, path):
    return spark.read.schema(schema.STAGING_SCHEMA).parquet(path)


def read_batch(spark, path, batch_id):
    """One batch; other batches are pruned as partitions."""
    return read_staging(spark, path).where(F.col("load_batch_id") == batch_id)
