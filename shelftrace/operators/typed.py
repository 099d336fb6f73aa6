"""Staged text into the types of the dimension."""

from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.functions.fingerprint import row_hash
from shelftrace.functions.numeric import (
    lenient_count,
    lenient_percent,
    lenient_rating,
)
from shelftrace.operators.rank import latest_per_key


def usable(df):
    """Rows with a key that is not blank and with both prices. The key is not trimmed."""
    return df.where(
        F.col("sku").isNotNull()
        & (F.trim("sku") != "")
        & F.col("current_price").isNotNull()
        & F.col("old_price").isNotNull()
    )


PRICE_LIMIT = 1e16


def strict_price(column):
    """A validated price; one that does not fit the dimension stops the batch.

    Checked here because an infinite double casts to null without an error.
    """
    c = F.col(column)
    error = F.raise_error(F.concat(F.lit(f"{column} out of range: "), c.cast("string")))
    fits = c.isNull() | (F.abs(c) < PRICE_LIMIT)
    return F.when(fits, c.cast(schema.PRICE)).otherwise(error.cast(schema.PRICE))


def typed(df, *carry):
    """Lenient conversions; text that does not convert becomes null."""
    return df.select(
        *carry,
        "stage_id",
        "sku",
        "product_name",
        "image_url",
        "product_url",
        strict_price("current_price").alias("current_price"),
        strict_price("old_price").alias("old_price"),
        lenient_percent("discount").alias("discount_percent"),
        lenient_rating("rating").alias("rating"),
        lenient_count("reviews_count").alias("reviews_count"),
    )


def with_fingerprint(df, **options):
    return df.withColumn("row_hash", row_hash(**options))


def latest_typed(staged, *partition, **options):
    """Latest usable row per key, typed and fingerprinted.

    Ranking comes first: only the surviving rows are converted and hashed.
    `partition` names columns to keep apart, such as the batch.
    """
    latest = latest_per_key(usable(staged), [*partition, "sku"], "stage_id")
    return with_fingerprint(typed(latest, *partition), **options)
