"""The rules for use in SQL text: scalar functions of a session, and the cards of pages as
a table function.

The scalar functions are SQL expressions, so they are planned like any other; they share
their patterns with the column functions. Python runs for cards only.
"""

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.functions import arrow_udtf

import shelftrace.operators.card_parser as card_parser
from shelftrace.functions import numeric, text, urls

cloudpickle.register_pickle_by_value(card_parser)


def _digits(value):
    foreign, plain = numeric._digit_tables()
    return f"translate({value}, '{foreign}', '{plain}')"


def _matched(value, pattern, kind):
    return f"try_cast(regexp_extract({value}, r'{pattern}', 1) AS {kind})"


def _found(value, pattern, kind):
    group = f"regexp_extract({value}, r'{pattern}', 1)"
    return f"try_cast({_digits(group)} AS {kind})"


_STRIPPED = f"btrim(c, '{text.WHITESPACE}')"
_COUNT = _matched("replace(c, ',', '')", numeric.LENIENT_PATTERN, "DECIMAL(18,2)")
_PLAIN = _digits(f"replace({_STRIPPED}, '_', '')")
_PAGE = f"try_url_decode(nullif(regexp_extract(c, r'{urls.PAGE_PATTERN}', 1), ''))"
_PAGE_DIGITS = _digits(f"btrim({_PAGE}, '{text.WHITESPACE}')")

# Name: (type, expression over c).
FUNCTIONS = {
    "shelf_strip": ("STRING", _STRIPPED),
    "shelf_collapse": (
        "STRING",
        f"CASE WHEN c <> '' THEN btrim(regexp_replace(c, r'{text.UNEVEN_GAP}', ' ')) END",
    ),
    "shelf_price": (
        "DOUBLE",
        f"coalesce({_matched('trim(c)', numeric.PRICE_PATTERN, 'DOUBLE')},"
        f" {_matched(_PLAIN, numeric.PRICE_PATTERN, 'DOUBLE')})",
    ),
    "shelf_percent": ("DECIMAL(8,2)", _matched("replace(c, '%', '')", numeric.LENIENT_PATTERN, "DECIMAL(8,2)")),
    "shelf_rating": ("DECIMAL(4,2)", _matched("c", numeric.LENIENT_PATTERN, "DECIMAL(4,2)")),
    "shelf_count": (
        "INT",
        f"try_cast({_COUNT} AS INT)",
    ),
    "shelf_first_number": ("DOUBLE", _found("replace(c, ',', '')", numeric.FIRST_NUMBER_PATTERN, "DOUBLE")),
    "shelf_stars": ("DOUBLE", _found("c", numeric.RATING_PATTERN, "DOUBLE")),
    "shelf_reviews": ("BIGINT", _found("c", numeric.REVIEWS_PATTERN, "BIGINT")),
    "shelf_page_number": (
        "BIGINT",
        f"coalesce(CASE WHEN {_PAGE_DIGITS} RLIKE r'^[+-]?[0-9]+(?:_[0-9]+)*\\z'"
        f" THEN try_cast(replace({_PAGE_DIGITS}, '_', '') AS BIGINT) END, 1)",
    ),
}

CARD_TABLE = "product_cards"


@arrow_udtf(
    returnType="page_id bigint, position int, parse_error string, "
    + ", ".join(f"{name} string" for name in card_parser.RAW_FIELDS)
)
class ProductCards:
    """The raw fields of the cards of each page (page_id, html); a card that cannot be read
    has its error, a page without cards has no row, and neither has a null page. Pages come
    in Arrow batches."""

    def eval(self, pages: pa.RecordBatch):
        fields = ["parse_error", *card_parser.RAW_FIELDS]
        ids = pages.column("page_id").cast(pa.int64())
        for places, rows in card_parser.rows_by_part(pages.column("html")):
            yield pa.table(
                {
                    "page_id": ids.take(pa.array(places, pa.int64())),
                    "position": pa.array([r.get("position") for r in rows], pa.int32()),
                    **{f: pa.array([r.get(f) for r in rows], pa.string()) for f in fields},
                }
            )


def register(spark):
    """Make the functions known to the session: `SELECT shelf_price(c) ...`, and
    `SELECT * FROM product_cards(TABLE(SELECT page_id, html FROM ...))`, a parallel scan."""
    for name, (kind, expression) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING) RETURNS {kind} RETURN {expression}")
    spark.udtf.register(CARD_TABLE, ProductCards)
