"""Value cleaning of accepted rows."""

import logging

from pyspark.sql import functions as F

from shelftrace.functions.text import as_column, empty_to_null, strip

# Texts shown where a product has no rating or reviews.
NO_RATING = "no rating yet"
NO_REVIEWS = "no reviews yet"

log = logging.getLogger(__name__)


def strip_texts(df, but=()):
    """Strip every string column, except those in `but`."""
    return df.withColumns(
        {c: strip(c) for c, t in df.dtypes if t == "string" and c not in but}
    )


def clean_discount(c):
    """Blank to null; a percent sign is added where it is missing."""
    text = empty_to_null(strip(as_column(c).cast("string")))
    return F.regexp_replace(text, r"(?s)^(.*?)%?\z", "$1%")


def text_or(c, default):
    return F.coalesce(
        empty_to_null(strip(as_column(c).cast("string"))), F.lit(default)
    )


RULES = {
    "discount": clean_discount,
    "rating": lambda c: text_or(c, NO_RATING),
    "reviews_count": lambda c: text_or(c, NO_REVIEWS),
}


def clean(df, rules=RULES):
    """Strip all texts and apply each rule whose column is there; rules strip as well."""
    for column in rules:
        if column not in df.columns:
            log.warning("Column %r was not found.", column)
    return strip_texts(df, rules).withColumns(
        {c: rule(c) for c, rule in rules.items() if c in df.columns}
    )
