"""Queries as sources, current rows as output."""

import logging

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from shelftrace import schema

log = logging.getLogger(__name__)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

CURRENT_ROWS = f"""
SELECT {', '.join(schema.EXPORT_COLUMNS)}
FROM {{dimension}}
WHERE iscurrent = 1
"""


def read_query(spark, query, **tables):
    """Result of an SQL query; `{name}` in it stands for a DataFrame given by name."""
    return spark.sql(query, **tables)


def export_rows(spark, dimension, ordered=True):
    """Current rows for export; the order by product id is a range-partitioned sort."""
    rows = read_query(spark, CURRENT_ROWS, dimension=dimension)
    return rows.orderBy("product_id") if ordered else rows


def with_rendered_times(rows, columns=("st_date", "end_date")):
    return rows.withColumns({c: F.date_format(c, TIME_FORMAT) for c in columns})


def read_export(spark, path, read_schema, order="product_id", name="place"):
    """Rows of a Parquet export with their place in it, from 1: files count in the order
    of their least `order`, rows within a file as they lie there. Only an export in order
    gives every row its rank."""
    rows = spark.read.schema(read_schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    files = rows.groupBy("_file").agg(F.min(order).alias("_least"), F.count(F.lit(1)).alias("_count"))
    # One row per file here.
    before = Window.orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)
    ahead = files.select("_file", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_ahead"))
    place = F.col("_ahead") + F.col("_row") + 1
    return rows.join(ahead, "_file").withColumn(name, place).drop("_file", "_row", "_ahead")


def export_current(spark, dimension, path, format="csv", ordered=True):
    """Write the current rows; returns how many. None at all writes nothing."""
    if dimension.where("iscurrent = 1").isEmpty():
        log.warning("No current data found.")
        return 0
    seen = Observation()
    rows = export_rows(spark, dimension, ordered)
    if format == "csv":
        rows = with_rendered_times(rows)
    rows.observe(seen, F.count(F.lit(1)).alias("exported")).write.mode(
        "errorifexists"
    ).format(format).option("header", True).save(path)
    return seen.get["exported"]
