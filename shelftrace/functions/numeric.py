"""Reading numbers out of text, strictly and leniently."""

import unicodedata
from functools import lru_cache

from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.functions.text import as_column, strip

UNSIGNED = r"(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)"

# A finite decimal that is not negative; minus zero counts as zero.
PRICE_PATTERN = (
    rf"^((?:[+]?{UNSIGNED}|-(?:0+(?:[.]0*)?|[.]0+))(?:[eE][+-]?[0-9]+)?)\z"
)

# Plain decimals only: no exponent, no digits beyond ASCII.
LENIENT_PATTERN = rf"^([ ]*[+-]?{UNSIGNED}[ ]*)\z"

# Numbers inside a text may use the decimal digits of any script.
FIRST_NUMBER_PATTERN = r"(\p{Nd}+(?:[.]\p{Nd}+)?)"
RATING_PATTERN = r"(?i)(\p{Nd}+(?:[.]\p{Nd}+)?)\s*out of\s*5"
REVIEWS_PATTERN = r"\((\p{Nd}+)\)"

# Each reader names its input once. Tests like `when(x matches, cast(x))` would repeat
# the whole expression behind x, and filters pushed to the scan repeat it again.


@lru_cache(maxsize=1)
def _digit_tables():
    digits = [
        chr(i)
        for i in range(0x80, 0x110000)
        if unicodedata.category(chr(i)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.digit(d)) for d in digits)


def ascii_digits(c):
    """Decimal digits of every script as 0-9."""
    return F.translate(as_column(c), *_digit_tables())


def _matched(c, pattern, data_type):
    """The matched text as a number; no match gives '', which casts to null."""
    return F.regexp_extract(c, pattern, 1).try_cast(data_type)


def parse_price(c):
    """A price as double, or null if the text is no finite, non-negative decimal.

    Plain numbers are read at once; only other texts go through the rarer forms:
    other white space, underscores, other digits.
    """
    text = ascii_digits(F.replace(strip(c), F.lit("_"), F.lit("")))
    return F.coalesce(
        _matched(F.trim(c), PRICE_PATTERN, "double"), _matched(text, PRICE_PATTERN, "double")
    )


def lenient_percent(c):
    text = F.replace(as_column(c), F.lit("%"), F.lit(""))
    return _matched(text, LENIENT_PATTERN, schema.PERCENT)


def lenient_rating(c):
    return _matched(as_column(c), LENIENT_PATTERN, schema.RATING)


def lenient_count(c):
    """Thousands separators dropped, fraction truncated."""
    text = F.replace(as_column(c), F.lit(","), F.lit(""))
    return _matched(text, LENIENT_PATTERN, schema.PRICE).try_cast("int")


def _found(c, pattern, data_type):
    return ascii_digits(F.regexp_extract(c, pattern, 1)).try_cast(data_type)


def first_number(c):
    """The first number in a text; thousands separators dropped, sign ignored."""
    text = F.replace(as_column(c), F.lit(","), F.lit(""))
    return _found(text, FIRST_NUMBER_PATTERN, "double")


def rating_phrase(c):
    """N of the phrase `N out of 5`."""
    return _found(as_column(c), RATING_PATTERN, "double")


def reviews_in_parentheses(c):
    return _found(as_column(c), REVIEWS_PATTERN, "bigint")
