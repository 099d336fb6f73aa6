"""Row validation: every row is accepted, or rejected with readable reasons."""

from functools import reduce
from operator import and_

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelftrace.functions.numeric import parse_price
from shelftrace.functions.text import strip

# The reasons as they are reported.
KEY_REQUIRED = "Value error, SKU is required"
PRICE_REQUIRED = "Value error, Price is required"
PRICE_MALFORMED = "Value error, Price must be an integer or decimal number"

KEY = "sku"
PRICES = ("current_price", "old_price")


def key_error(column=KEY):
    blank = F.col(column).isNull() | (strip(column) == "")
    return F.when(blank, F.lit(f"{column}: {KEY_REQUIRED}"))


def price_error(column):
    return F.when(
        F.col(column).isNull(), F.lit(f"{column}: {PRICE_REQUIRED}")
    ).when(parse_price(column).isNull(), F.lit(f"{column}: {PRICE_MALFORMED}"))


def row_is_valid(key=KEY, prices=PRICES):
    """The same rules as one short test, cheap to push down to a scan."""
    tests = [F.length(strip(key)) > 0, *[parse_price(p).isNotNull() for p in prices]]
    return F.coalesce(reduce(and_, tests), F.lit(False))


def validation_errors(key=KEY, prices=PRICES):
    """All reasons of a row joined by ' | ', '' for a valid row."""
    return F.concat_ws(" | ", key_error(key), *[price_error(p) for p in prices])


def classify(df, key=KEY, prices=PRICES):
    """The rows as they came, with their route and reasons: one narrow projection."""
    valid = row_is_valid(key, prices)
    return df.withColumns({"is_valid": valid}).withColumn(
        "validation_errors",
        F.when(~F.col("is_valid"), validation_errors(key, prices)),
    )


def accepted(classified, key=KEY, prices=PRICES):
    """Valid rows, with the key stripped and the prices as doubles."""
    return (
        classified.where("is_valid")
        .drop("is_valid", "validation_errors")
        .withColumns({key: strip(key), **{p: parse_price(p) for p in prices}})
    )


def rejected(classified):
    """Invalid rows with their original values and reasons."""
    return classified.where("NOT is_valid").drop("is_valid")


def count_routes(classified):
    """Number of rows per route."""
    return classified.groupBy("is_valid").agg(F.count(F.lit(1)).alias("row_count"))


def observe_routes(classified):
    """Counts of both routes taken along by whatever job runs next."""
    seen = Observation()
    return (
        classified.observe(
            seen,
            F.count_if("is_valid").alias("valid"),
            F.count_if(~F.col("is_valid")).alias("invalid"),
        ),
        seen,
    )
