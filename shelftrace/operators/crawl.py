"""Crawls over stored pages: what a crawler would see that follows the link to the next
page, worked out for all crawls at once."""

from pyspark.sql import functions as F

from shelftrace.functions.text import as_column
from shelftrace.functions.urls import page_number
from shelftrace.operators import links
from shelftrace.operators.cards import keyed
from shelftrace.operators.rank import first_per_key
from shelftrace.sources.shared import stored

# How a crawl can end.
PAGE_CAP = "page cap"
NO_LINK = "no next link"
NOT_STORED = "page not stored"
CYCLE = "cycle"


def listing_key(url):
    """What makes two addresses the same listing page: place and page number."""
    place = F.regexp_extract(as_column(url), r"^([^?#]*)", 1)
    return F.concat(place, F.lit("?page="), page_number(url).cast("string"))


def page_steps(pages, key=listing_key):
    """(page, next) of every stored page by its key; next is null without a link. Of
    several pages with one key, the one with the least id counts."""
    followed = links.next_page(pages.where(F.col("url").isNotNull()))
    steps = followed.select("page_id", key("url").alias("page"), key("next_url").alias("next"))
    return first_per_key(steps, "page", "page_id").drop("page_id")


def crawl(steps, starts, cap=None):
    """(start, position, page): the pages of every crawl in their order, from 0.

    `steps` (page, next) holds each stored page once. A crawl goes on until a page has no
    next link, the next page is not stored, it has been seen before, or `cap` pages are
    through. Pointer doubling: after k rounds each crawl is known for 2**k pages and each
    page knows the one 2**k further on, so rounds grow with the logarithm of the longest
    crawl; every round is a written table. A page that several crawls pass belongs to each.
    """
    stored_pages = steps.select("page")
    jumps = steps.select(F.col("page").alias("at"), F.col("next").alias("far"))
    jumps = stored(
        jumps.join(stored_pages.select(F.col("page").alias("far")), "far", "left_semi").select("at", "far"), "jumps"
    )
    begun = starts.select(F.col("start"), F.lit(0).cast("long").alias("position"), F.col("start").alias("page"))
    if cap is not None and cap < 1:
        begun = begun.limit(0)
    reached = stored(begun.distinct().join(stored_pages, "page", "left_semi"), "reached")
    step, size = 1, reached.count()
    while cap is None or step < cap:
        ahead = reached.join(jumps, reached["page"] == jumps["at"]).select(
            "start", (F.col("position") + step).alias("position"), F.col("far").alias("page")
        )
        if cap is not None:
            ahead = ahead.where(F.col("position") < cap)
        # A page met again was met before on a round trip; its first place stays.
        met = reached.select("start", "position", "page").unionByName(ahead)
        reached = stored(met.groupBy("start", "page").agg(F.min("position").alias("position")), "reached")
        before, size = size, reached.count()
        if size == before:
            break
        further = jumps.select(F.col("at").alias("far"), F.col("far").alias("farther"))
        jumps = stored(jumps.join(further, "far").select("at", F.col("farther").alias("far")), "jumps")
        step *= 2
    return reached.select("start", "position", "page")


def crawl_report(steps, starts, reached, cap=None):
    """(start, pages, last_page, next_page, outcome) of every crawl: how far it came, and
    why it ended. Without any page, the start itself is not stored."""
    last = reached.groupBy("start").agg(
        F.count(F.lit(1)).alias("pages"), F.max_by("page", "position").alias("last_page")
    )
    there = stored_next(steps)
    report = starts.select("start").distinct().join(last, "start", "left")
    report = report.join(there.withColumnRenamed("page", "last_page"), "last_page", "left")
    pages = F.coalesce("pages", F.lit(0))
    capped = pages >= F.lit(cap) if cap is not None else F.lit(False)
    outcome = (
        F.when(pages == 0, NOT_STORED if cap is None or cap > 0 else PAGE_CAP)
        .when(capped, PAGE_CAP)
        .when(F.col("next").isNull(), NO_LINK)
        .when(~F.col("next_is_stored"), NOT_STORED)
        .otherwise(CYCLE)
    )
    return report.select(
        "start", pages.alias("pages"), "last_page", F.col("next").alias("next_page"), outcome.alias("outcome")
    )


def stored_next(steps):
    """(page, next, next_is_stored)."""
    known = steps.select(F.col("page").alias("next"), F.lit(True).alias("known"))
    joined = steps.join(known, "next", "left")
    return joined.select("page", "next", F.coalesce("known", F.lit(False)).alias("next_is_stored"))


def crawl_catalogue(records, reached, key=listing_key):
    """Unique records of every crawl: the first page of the crawl with a product wins, and
    the first card on it."""
    places = reached.withColumnRenamed("position", "crawl_position")
    along = keyed(records).withColumn("page", key("url")).join(places, "page").drop("page")
    return first_per_key(along, ["start", "identity"], ["crawl_position", "page_id", "position"])
