"""Row numbers in a total order, without a window over all rows or a trip to the driver."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.sources.shared import stored


def in_ranges(df, order, name="_part"):
    """The rows as a stored table, cut into ranges of `order` that are numbered by `name`.

    Each range fits a task. A window within ranges, together with one row per range,
    stands for a window over all rows.
    """
    ranged = df.repartitionByRange(*order).withColumn(name, F.spark_partition_id())
    return stored(ranged, "ranges")


def ahead_of(parts, value, name, part="_part"):
    """(part, name): the sum of `value` over the ranges before each; one row per range."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(value).over(before), F.lit(0))
    return parts.select(part, total.alias(name))


def numbered(df, order, name, base=0):
    """The rows with numbers base+1, base+2, ... in the order of `order`, unique columns."""
    rows = in_ranges(df, order)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_count"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    number = F.col("_ahead") + F.col("_place") + F.lit(base)
    return (
        rows.withColumn("_place", place)
        .join(ahead_of(counts, "_count", "_ahead"), "_part")
        .withColumn(name, number)
        .drop("_part", "_place", "_ahead")
    )


def arrival_order(df):
    """Arrival order of rows read straight from files, as three sort columns.

    File name, then the block within it, then the place in that block. Use right
    after the scan; the order does not depend on how files are packed into tasks.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("arrival_file"),
        F.col("_metadata.file_block_start").alias("arrival_block"),
        F.monotonically_increasing_id().alias("arrival_row"),
    )
