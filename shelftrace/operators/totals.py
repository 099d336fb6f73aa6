"""Totals over pages."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.sources.numbering import in_ranges
from shelftrace.sources.shared import stored

BLOCK = 1 << 16


def running_total(df, order, value, name, block=BLOCK, levels=1):
    """Running sum of `value` by the unique whole number `order`; other columns go.

    A window without partitions would put all rows in one task. Here rows are
    summed per block of consecutive numbers, the block sums are totalled, and the
    total ahead of each block is added inside it. One task sees at most `block`
    rows, or one row per block; `levels` stacks blocks of blocks.

    Both uses of the rows read the same columns of the same repartitioning, so what
    lies ahead of it runs once.
    """
    if levels == 0:
        total = F.sum(value).over(Window.orderBy(order))
        return df.select(order, value, total.alias(name))
    rows = df.select(
        order, value, F.floor(F.col(order) / F.lit(block)).alias("_block")
    ).repartition("_block")
    # The first number of a block places it; asking for it keeps the columns the same.
    sums = rows.groupBy("_block").agg(F.sum(value).alias("_sum"), F.min(order).alias("_from"))
    places = sums.select(F.floor(F.col("_from") / F.lit(block)).alias("_at"), "_sum")
    ahead = running_total(places, "_at", "_sum", "_through", block, levels - 1).select(
        F.col("_at").alias("_block"), (F.col("_through") - F.col("_sum")).alias("_ahead")
    )
    inside = F.sum(value).over(Window.partitionBy("_block").orderBy(order))
    return (
        rows.withColumn("_inside", inside)
        .join(ahead, "_block")
        .select(order, value, (F.col("_inside") + F.col("_ahead")).alias(name))
    )


def unique_by_page(df, page, key, block=BLOCK):
    """Per page: unique products on it, products first seen on it, running total.

    Both counts come from groups that combine before the shuffle, by page and product
    and by product, so neither a frequent product nor a long page fills one task. The
    result per page is small beside the rows; it is stored, as the total reads it twice.
    """
    pairs = df.where(F.col(key).isNotNull()).select(page, key).distinct()
    on_page = pairs.withColumn("_new", F.lit(0))
    first_seen = pairs.groupBy(key).agg(F.min(page).alias(page)).withColumn("_new", F.lit(1))
    counts = on_page.unionByName(first_seen).groupBy(page).agg(
        F.count_if(F.col("_new") == 0).alias("unique_on_page"),
        F.count_if(F.col("_new") == 1).alias("new_products"),
    )
    per_page = stored(counts, "per-page")
    total = running_total(per_page, page, "new_products", "total_unique", block)
    return per_page.select(page, "unique_on_page").join(total, page)


def page_sequence(df, actual, expected):
    """Pages whose number differs from the expected one: a report, not an error."""
    return df.where(F.col(actual) != F.col(expected))


def page_runs(df, crawl, page, first=1):
    """(crawl, first_page, last_page, pages, repeated, missing_before): the runs of
    consecutive page numbers of every crawl, how many rows repeat a number of the run, and
    how many numbers are missing before it; the first run is expected at `first`.

    Numbers are counted by crawl and page first. The counts are cut into ranges by crawl
    and page; what a range must know of those before it, their last page and where their
    last run began, is one row per range. So a crawl of any length is spread over tasks.
    Rows without a crawl or a number take no part.
    """
    counted = df.where(F.col(crawl).isNotNull() & F.col(page).isNotNull()).groupBy(
        F.col(crawl).alias("crawl"), F.col(page).cast("long").alias("page")
    ).agg(F.count(F.lit(1)).alias("times"))
    ranges = in_ranges(counted, ["crawl", "page"])
    last = ranges.groupBy("_part").agg(F.max(F.struct("crawl", "page")).alias("last"))
    # One row per range from here to the join.
    ahead = last.select("_part", F.lag("last").over(Window.orderBy("_part")).alias("ahead"))
    along = Window.partitionBy("_part").orderBy("crawl", "page")
    prior = F.coalesce(F.lag(F.struct("crawl", "page")).over(along), F.col("ahead"))
    rows = ranges.join(ahead, "_part").withColumn("prior", prior)
    same = F.col("prior.crawl").eqNullSafe(F.col("crawl"))
    gap = F.when(same, F.col("page") - F.col("prior.page") - 1)
    rows = rows.withColumn("gap", gap).withColumn(
        "begun", F.when(F.col("gap").isNull() | (F.col("gap") > 0), F.col("page"))
    )
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.last("begun", ignorenulls=True).over(upto))
    # A run may have begun in a range before: the last beginning ahead of this range.
    begun = rows.groupBy("_part").agg(F.max_by("begun", F.when(F.col("begun").isNotNull(), F.struct("crawl", "page"))).alias("begun"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = begun.select("_part", F.last("begun", ignorenulls=True).over(earlier).alias("carried"))
    runs = rows.join(carried, "_part").groupBy("crawl", F.coalesce("run", "carried").alias("first_page"))
    return runs.agg(
        F.max("page").alias("last_page"),
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.col("times") - 1).alias("repeated"),
        F.max(F.when(F.col("begun").isNotNull(), F.coalesce("gap", F.col("begun") - F.lit(first)))).alias("missing_before"),
    )


def first_pages(df, page, last=10):
    return df.where(F.col(page).between(1, last))
