"""Product cards of stored listing pages.

The only Python on the data path: an HTML parser run over Arrow batches picks raw
attributes and texts out of each card. All cleaning of them is column expressions.
"""

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelftrace.functions.numeric import (
    first_number,
    rating_phrase,
    reviews_in_parentheses,
)
from shelftrace.functions.text import collapse_whitespace, empty_to_null, first_present
from shelftrace.functions.urls import with_resolved_url
from shelftrace.operators import card_parser
from shelftrace.operators.card_parser import CARD, RAW_FIELDS, rows_by_part
from shelftrace.operators.rank import first_per_key, identified

# Executors get the parser with the task; they need no copy of this package.
cloudpickle.register_pickle_by_value(card_parser)

RAW_CARD_SCHEMA = "position int, parse_error string, " + ", ".join(
    f"{name} string" for name in RAW_FIELDS
)


def raw_cards(pages, html="html"):
    """One row per card: the other page columns, position and raw fields.

    Pages that cannot hold a card never reach Python. A card that cannot be read gives
    its position and `parse_error`, and costs no other card of its page; a page that
    cannot be parsed at all gives one row with `parse_error` and no position.
    """
    keep = [f for f in pages.schema.fields if f.name != html]
    names = [f.name for f in keep]
    marker = max(CARD[-1][1], key=len)
    candidates = pages.where(
        F.contains(F.col(html), F.lit(marker)) | F.col(html).rlike(r"class\s*=[^>]*&")
    ).select(*names, html)
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep),
                     RAW_CARD_SCHEMA])
    fields = ["position", "parse_error", *RAW_FIELDS]

    def parse(batches):
        types = [pa.int32()] + [pa.string()] * (len(fields) - 1)
        for batch in batches:
            for places, rows in rows_by_part(batch.column(html)):
                carried = batch.select(names).take(pa.array(places, pa.int64()))
                parsed = [
                    pa.array([r.get(f) for r in rows], t) for f, t in zip(fields, types)
                ]
                yield pa.RecordBatch.from_arrays([*carried.columns, *parsed], names + fields)

    return candidates.mapInArrow(parse, out)


def parsed_cards(cards):
    return cards.where(F.col("parse_error").isNull()).drop("parse_error")


def failed_pages(cards):
    return cards.where(F.col("parse_error").isNotNull() & F.col("position").isNull())


def failed_cards(cards):
    return cards.where(F.col("parse_error").isNotNull() & F.col("position").isNotNull())


def card_records(cards, base_url="url"):
    """The nine feed fields of each card; links and image addresses are resolved against
    the page, as a browser gives them. An address that waits in `data-src` stays as it is."""
    stars = F.coalesce(collapse_whitespace("stars_text"), F.lit(""))
    reviews = F.coalesce(collapse_whitespace("reviews_text"), F.lit(""))
    made = {
        "sku": first_present("data_sku", "link_id"),
        "product_name": collapse_whitespace("name_text"),
        "image_url": F.coalesce(empty_to_null("image_address"), "image_data_src"),
        "current_price": first_number("price_text"),
        "old_price": first_number("old_price_text"),
        "discount": first_number("discount_text"),
        "rating": rating_phrase(stars),
        "reviews_count": reviews_in_parentheses(reviews),
    }
    linked = with_resolved_url(cards, base_url, "link_href", "product_url")
    source = empty_to_null("image_src")
    shown = with_resolved_url(linked, base_url, source, "image_address")
    return shown.withColumns(made).drop(*RAW_FIELDS, "image_address")


def keyed(records):
    return identified(records, "sku", "product_url", "product_name")


def page_records(records, page="page_id"):
    """Unique records per page, the first card of a product wins."""
    return first_per_key(keyed(records), [page, "identity"], "position")


def catalogue(records, page="page_no", id="page_id"):
    """Unique records over all pages, the first page of a product wins; of pages with
    one number, the one with the least id."""
    return first_per_key(keyed(records), "identity", [page, id, "position"])
