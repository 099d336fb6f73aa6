"""From stored listing pages to the raw feed."""

from pyspark.sql import functions as F

from shelftrace.functions.urls import page_number
from shelftrace.operators import cards, totals


def extract_records(pages, last_page=None):
    """All card records of the pages, with their page number."""
    numbered = pages.withColumn("page_no", page_number("url"))
    if last_page is not None:
        numbered = totals.first_pages(numbered, "page_no", last_page)
    return cards.card_records(cards.parsed_cards(cards.raw_cards(numbered)))


def failed_pages(pages):
    """(page_id, url, parse_error) of the pages that gave no cards because they failed."""
    failed = cards.failed_pages(cards.raw_cards(pages.select("page_id", "url", "html")))
    return failed.select("page_id", "url", "parse_error")


def failed_cards(pages):
    """(page_id, url, position, parse_error) of the cards that could not be read; the
    other cards of their pages are records."""
    failed = cards.failed_cards(cards.raw_cards(pages.select("page_id", "url", "html")))
    return failed.select("page_id", "url", "position", "parse_error")


def extract_counts(pages):
    """Per page that can hold a card: its cards, and cards or pages that failed."""
    found = cards.raw_cards(pages.select("page_id", "html"))
    failed = F.col("parse_error").isNotNull()
    return found.groupBy("page_id").agg(
        F.count_if(~failed).alias("cards"), F.count_if(failed).alias("failures")
    )


def extract_catalogue(pages, last_page=None):
    """Unique products over all pages, the first page wins."""
    return cards.catalogue(extract_records(pages, last_page))
