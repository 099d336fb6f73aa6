"""Text expressions."""

from pyspark.sql import functions as F

# The 29 white-space code points removed by stripping. Spark's own
# trim removes U+0020 only.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set for regular expressions, without and with the plain space.
RARE_SPACES = (
    r"\x{9}-\x{d}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITESPACE_CLASS = f"[ {RARE_SPACES}]"

# A run of white space, unless it is one plain space already: most gaps are.
UNEVEN_GAP = f"(?:[{RARE_SPACES}]| (?={WHITESPACE_CLASS})){WHITESPACE_CLASS}*+"

# Texts that a sheet reader takes for a missing cell.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def as_column(c):
    return F.col(c) if isinstance(c, str) else c


def strip(c):
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def empty_to_null(c):
    return F.nullif(as_column(c), F.lit(""))


def null_tokens_to_null(c):
    c = as_column(c)
    return F.when(~c.isin(NULL_TOKENS), c)


def collapse_whitespace(c):
    """Runs of white space become one space; empty text becomes null, blank text ''."""
    c = as_column(c)
    return F.when(c != "", F.btrim(F.regexp_replace(c, UNEVEN_GAP, " ")))


def first_present(*columns):
    """The first column that is neither null nor empty."""
    return F.coalesce(*[empty_to_null(c) for c in columns])
