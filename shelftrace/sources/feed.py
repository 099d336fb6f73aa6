"""Feeds in, split and raw sheets out."""

from pyspark.sql import functions as F

from shelftrace.operators import columns, validate
from shelftrace.sources.shared import open_files

# Outer white space is data here, and a quote is escaped by doubling it.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# What a file must not hold: another header than the first one's, or a row with more or
# fewer cells than the header. Both stop the read; neither moves cells to other columns.
CHECKED = {"enforceSchema": False, "mode": "FAILFAST", "columnPruning": False}


def read_feed(spark, path, format="csv", multiline=False):
    """A raw feed, everything as text, missing-cell texts as null.

    CSV takes its column order from the header line and nothing is inferred. Files of
    one path must agree in their headers; a file that does not, or a row whose cells do
    not match the header, stops the read. A missing path fails here. `multiline` allows
    line breaks inside cells, at the price of one task per file.
    """
    if format == "csv":
        options = {**CSV_OPTIONS, **CHECKED, "multiLine": multiline}
        raw = spark.read.options(**options).csv(path)
    else:
        raw = spark.read.format(format).load(path)
    texts = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
    return columns.nullify_tokens(columns.to_feed_columns(texts))


def write_raw_sheet(records, path, format="csv"):
    """Extracted records under the nine sheet headers, in fixed order. A cell with a line
    break needs `multiline` to be read again; without it the read stops."""
    sheet = columns.to_sheet_headers(records)
    options = CSV_OPTIONS if format == "csv" else {}
    sheet.write.mode("errorifexists").format(format).options(**options).save(path)


def write_split(classified, path):
    """Valid and invalid rows in one pass over the input; returns both counts.

    One job writes both routes as partitions of one folder, unsorted. Reading a route
    prunes the other.
    """
    watched, seen = validate.observe_routes(classified)
    with open_files(classified.sparkSession, 2):
        watched.write.mode("overwrite").partitionBy("is_valid").parquet(path)
    return seen.get


def read_classified(spark, path, read_schema):
    """The classified rows of a split; the schema keeps an empty route readable."""
    return spark.read.schema(read_schema).parquet(path)


def read_accepted(spark, path, read_schema):
    return validate.accepted(read_classified(spark, path, read_schema))


def read_rejected(spark, path, read_schema):
    return validate.rejected(read_classified(spark, path, read_schema))


def write_cleaned(df, path):
    df.write.mode("errorifexists").parquet(path)
