"""Every query, each a function of (spark, sf_dir) over whole tables."""

from dataclasses import astuple

from pyspark.sql import functions as F

from shelftrace.functions import numeric, sql, text, urls
from shelftrace.operators import (
    cards,
    clean,
    columns,
    crawl,
    history,
    links,
    profile,
    rank,
    totals,
    typed,
    validate,
)
from shelftrace.plans import extract, feeds, load
from shelftrace.plans.extract import extract_records
from shelftrace.sources import export, feed, staging
from shelftrace.sources.shared import fresh_path, stored
from shelftrace.sources.versions import VersionStore
from shelftrace.streaming import changes, landing

QUERIES = {}

SOURCE_FILE = "orders.parquet"

VERSION_COLUMNS = [
    "sku",
    "product_name",
    "image_url",
    "product_url",
    "current_price",
    "old_price",
    "discount_percent",
    "rating",
    "reviews_count",
    "st_date",
    "end_date",
    "iscurrent",
    "row_hash",
]


def query(function):
    """Register a query under its name."""
    QUERIES[function.__name__] = function
    return function


def _plain(df):
    """Decimals as doubles, a type that all result readers share."""
    decimals = [c for c, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


# -- stages shared by several queries -----------------------------------------


def _read(spark, sf_dir):
    """The raw feed as a sheet reader gives it: texts for a missing cell are null."""
    return columns.nullify_tokens(feeds.raw_feed(spark, sf_dir))


def _classified(spark, sf_dir):
    return validate.classify(_read(spark, sf_dir))


def _cleaned(spark, sf_dir):
    return clean.clean(validate.accepted(_classified(spark, sf_dir)))


def _staged(spark, sf_dir):
    """All yearly batches, staged in memory with the year as batch."""
    return _cleaned(spark, sf_dir).withColumnRenamed("row_no", "stage_id")


def _latest(spark, sf_dir, batch="batch_no"):
    """Latest typed row per batch and SKU, with its change time."""
    latest = typed.latest_typed(_staged(spark, sf_dir), batch)
    return latest.withColumn("change_time", feeds.batch_time(F.col(batch)))


def _versions(df):
    return _plain(df.select(*VERSION_COLUMNS))


# Batches up to this year make the dimension, all later rows one incoming batch.
LAST_MERGED = 1998
INCOMING = 2001


def _two_loads(spark, sf_dir):
    """A dimension of the earlier batches, and the later rows as one batch."""
    lumped = F.when(F.col("batch_no") <= LAST_MERGED, F.col("batch_no")).otherwise(INCOMING)
    staged = _staged(spark, sf_dir).withColumn("batch_no", lumped.cast("int"))
    # Written once by batch; each side reads its own partitions and ranks only those.
    path = fresh_path(spark, "cleaned")
    staged.write.partitionBy("batch_no").parquet(path)
    staged = spark.read.schema(staged.schema).parquet(path)
    earlier = typed.latest_typed(staged.where(F.col("batch_no") <= LAST_MERGED), "batch_no")
    earlier = earlier.withColumn("change_time", feeds.batch_time(F.col("batch_no")))
    source = typed.latest_typed(staged.where(F.col("batch_no") == INCOMING))
    dimension = history.rebuild(earlier.drop("batch_no"))
    dimension = dimension.withColumn("created_at", F.col("st_date"))
    return dimension, source


# -- reading, validation, cleaning ---------------------------------------------


@query
def csv_feed(spark, sf_dir):
    path = fresh_path(spark, "sheet")
    feed.write_raw_sheet(feeds.raw_feed(spark, sf_dir), path)
    return feed.read_feed(spark, path)


@query
def validate_feed(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        "row_no",
        "is_valid",
        "validation_errors",
        text.strip("sku").alias("sku"),
        numeric.parse_price("current_price").alias("current_price"),
        numeric.parse_price("old_price").alias("old_price"),
    )


@query
def error_summary(spark, sf_dir):
    return (
        _classified(spark, sf_dir)
        .groupBy("validation_errors")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query
def route_counts(spark, sf_dir):
    return validate.count_routes(_classified(spark, sf_dir))


@query
def quarantine_split(spark, sf_dir):
    classified = _classified(spark, sf_dir)
    path = fresh_path(spark, "split")
    feed.write_split(classified, path)
    kept = ["row_no", "sku", "current_price", "old_price", "validation_errors"]
    valid = feed.read_accepted(spark, path, classified.schema)
    valid = valid.withColumns(
        {
            "current_price": F.format_string("%.2f", "current_price"),
            "old_price": F.format_string("%.2f", "old_price"),
            "validation_errors": F.lit(None).cast("string"),
        }
    )
    invalid = feed.read_rejected(spark, path, classified.schema)
    return valid.select(*kept).unionByName(invalid.select(*kept))


@query
def clean_feed(spark, sf_dir):
    return _cleaned(spark, sf_dir)


@query
def cleaned_table(spark, sf_dir):
    """The cleaned feed as written for later use."""
    path = fresh_path(spark, "cleaned")
    feed.write_cleaned(_cleaned(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def distinct_profile(spark, sf_dir):
    return profile.distinct_profile(_cleaned(spark, sf_dir))


@query
def column_profile(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir).select(
        "sku", "product_name", "image_url", "product_url", "discount", "rating", "reviews_count"
    )
    return profile.column_profile(cleaned)


# -- staging, typing, ranking ----------------------------------------------------


@query
def stage_batch(spark, sf_dir):
    """Every year staged as a batch of its own, then the table read back."""
    path = fresh_path(spark, "staging")
    rows = staging.staged_rows(
        _cleaned(spark, sf_dir), F.col("batch_no").cast("string"), SOURCE_FILE
    )
    staging.append_batch(rows, path, several=True)
    return staging.read_staging(spark, path)


@query
def batch_counts(spark, sf_dir):
    """Rows staged per batch, counted on the staging table."""
    return stage_batch(spark, sf_dir).groupBy("load_batch_id").agg(
        F.count(F.lit(1)).alias("rows_staged"), F.max("stage_id").alias("last_stage_id")
    )


@query
def typed_feed(spark, sf_dir):
    return _plain(typed.typed(typed.usable(_staged(spark, sf_dir)), "batch_no"))


@query
def row_fingerprint(spark, sf_dir):
    rows = typed.typed(typed.usable(_staged(spark, sf_dir)))
    return typed.with_fingerprint(rows).select("stage_id", "sku", "row_hash")


@query
def latest_per_key(spark, sf_dir):
    return rank.latest_per_key(
        typed.usable(_staged(spark, sf_dir)), ["batch_no", "sku"], "stage_id"
    ).select("batch_no", "sku", "stage_id", "product_name", "current_price", "old_price")


@query
def first_per_key(spark, sf_dir):
    rows = feeds.raw_feed(spark, sf_dir).withColumn("sku", text.strip("sku"))
    keyed = rank.identified(rows, "sku", "image_url", "product_name")
    return rank.first_per_key(keyed, "identity", "row_no").select(
        "identity", "row_no", "product_name", "product_url"
    )


# -- history -----------------------------------------------------------------------


@query
def changed_rows(spark, sf_dir):
    dimension, source = _two_loads(spark, sf_dir)
    return _versions(history.changed(history.current_versions(dimension), source))


@query
def new_keys(spark, sf_dir):
    """Incoming rows that open a version: new products and changed ones."""
    dimension, source = _two_loads(spark, sf_dir)
    source = stored(source, "source")
    opened = history.openable(history.current_versions(dimension), source)
    return opened.select("sku", "stage_id", "row_hash")


@query
def scd2_merge(spark, sf_dir):
    """A merge meets both sides as stored tables and reads each more than once."""
    dimension, source = _two_loads(spark, sf_dir)
    dimension, source = stored(dimension, "dimension"), stored(source, "source")
    return _versions(history.merge(dimension, source, feeds.batch_time(F.lit(INCOMING))))


@query
def scd2_history(spark, sf_dir):
    return _versions(history.rebuild(_latest(spark, sf_dir)))


@query
def scd2_current(spark, sf_dir):
    return _versions(history.current_versions(history.rebuild(_latest(spark, sf_dir))))


AS_OF = "1998-07-01 00:00:00"


@query
def scd2_as_of(spark, sf_dir):
    """The products as they were in the middle of a year."""
    return _versions(history.as_of(history.rebuild(_latest(spark, sf_dir)), AS_OF))


@query
def merge_counts(spark, sf_dir):
    """Versions opened by each batch."""
    versions = history.rebuild(_latest(spark, sf_dir))
    return versions.groupBy("st_date").agg(F.count(F.lit(1)).alias("rows_inserted"))


@query
def scd2_events(spark, sf_dir):
    tracked = ["event_type", "level"]
    latest = rank.latest_per_key(
        feeds.event_feed(spark, sf_dir), ["sku", "batch_date"], "stage_id"
    )
    latest = typed.with_fingerprint(latest, columns=tracked).withColumn(
        "change_time", F.col("batch_date").cast("timestamp_ntz")
    )
    return history.rebuild(latest).select(
        "sku", *tracked, "st_date", "end_date", "iscurrent", "row_hash"
    )


@query
def scd2_incremental(spark, sf_dir):
    """The batches merged one after another through the version store."""
    store = VersionStore(spark, fresh_path(spark, "dimension"))
    staged = staging.staged_rows(
        _cleaned(spark, sf_dir), F.col("batch_no").cast("string"), SOURCE_FILE
    )
    path = store.staging_path()
    _, last_stage_id = staging.append_batch(staged, path, several=True)
    batches = staging.read_staging(spark, path).select("load_batch_id").distinct()
    # One number per load; each load is a job of its own.
    for year in sorted(int(row[0]) for row in batches.toLocalIterator()):
        batch = staging.read_batch(spark, path, str(year))
        store.apply(
            typed.latest_typed(batch), str(year), feeds.batch_moment(year), last_stage_id
        )
    return _versions(store.all_versions())


def _yearly_feeds(spark, sf_dir):
    """(year, raw feed of that year), oldest first; one number per load on the driver."""
    feed = feeds.raw_feed(spark, sf_dir)
    years = sorted(row[0] for row in feed.select("batch_no").distinct().toLocalIterator())
    return [(year, feed.where(F.col("batch_no") == year).drop("batch_no")) for year in years]


def _loaded(spark, sf_dir):
    """A store that was loaded feed by feed, and the result of every load."""
    store = VersionStore(spark, fresh_path(spark, "dimension"))
    results = [
        load.load_feed(
            spark, columns.nullify_tokens(feed), store, feeds.batch_moment(year), SOURCE_FILE, str(year)
        )
        for year, feed in _yearly_feeds(spark, sf_dir)
    ]
    return store, results


@query
def load_counts(spark, sf_dir):
    """What the load of each yearly feed reports."""
    _, results = _loaded(spark, sf_dir)
    schema = "batch_id string, valid long, invalid long, staged long, inserted long"
    return spark.createDataFrame([astuple(r) for r in results], schema)


@query
def product_ids(spark, sf_dir):
    """The ids of each load: as many as products, dense, after those of the load before."""
    store, _ = _loaded(spark, sf_dir)
    return store.all_versions().groupBy("st_date").agg(
        F.count(F.lit(1)).alias("products"),
        F.count_distinct("product_id").alias("distinct_ids"),
        F.min("product_id").alias("first_id"),
        F.max("product_id").alias("last_id"),
    )


@query
def landing_load(spark, sf_dir):
    """The yearly feeds put into a landing folder one by one and loaded as they come."""
    folder, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "landing-checkpoint")
    store = VersionStore(spark, fresh_path(spark, "dimension"))
    for year, feed in _yearly_feeds(spark, sf_dir):
        feed.write.mode("append").parquet(folder)
        moment = feeds.batch_moment(year)
        landing.start_landing(spark, folder, store, checkpoint, lambda m=moment: m).awaitTermination()
    return _versions(store.all_versions())


def _migrated(spark, sf_dir):
    return history.bootstrap(
        history.migrate_columns(feeds.legacy_table(spark, sf_dir))
    )


@query
def scd2_bootstrap(spark, sf_dir):
    return _migrated(spark, sf_dir).select(
        "product_id", "sku", "created_at", "st_date", "end_date", "iscurrent"
    )


@query
def hash_backfill(spark, sf_dir):
    return history.backfill_fingerprints(_migrated(spark, sf_dir)).select(
        "product_id", "sku", "row_hash"
    )


@query
def current_export(spark, sf_dir):
    table = history.backfill_fingerprints(_migrated(spark, sf_dir))
    return _plain(export.with_rendered_times(export.export_rows(spark, table)))


@query
def export_file(spark, sf_dir):
    """The export as written: every row with its place in the files."""
    path = fresh_path(spark, "export")
    table = history.backfill_fingerprints(_migrated(spark, sf_dir))
    rows = export.export_rows(spark, table)
    export.export_current(spark, table, path, format="parquet")
    return _plain(export.read_export(spark, path, rows.schema))


@query
def export_profile(spark, sf_dir):
    rows = export.export_rows(spark, _migrated(spark, sf_dir), ordered=False).select(
        "product_id", "sku", "product_name", "product_url", "reviews_count", "st_date", "end_date"
    )
    return profile.column_profile(rows, fixed=("st_date", "end_date"))


@query
def migrated_table(spark, sf_dir):
    """The legacy table without a column that every dimension has, migrated."""
    legacy = feeds.legacy_table(spark, sf_dir).drop("iscurrent")
    return _plain(history.migrate_columns(legacy)).select(
        "product_id", "sku", "current_price", "created_at", "st_date", "end_date", "iscurrent"
    )


@query
def untidy_headers(spark, sf_dir):
    """The feed under headers as sheets have them, read by its rules for headers."""
    sheet = columns.to_sheet_headers(feeds.raw_feed(spark, sf_dir))
    untidy = sheet.toDF(*[f"  {header} % " for header in sheet.columns])
    return columns.to_feed_columns(untidy)


@query
def partial_clean(spark, sf_dir):
    """Cleaning of a feed without ratings and discounts: the other rules still hold."""
    accepted = validate.accepted(_classified(spark, sf_dir))
    return clean.clean(accepted.drop("rating", "discount"))


@query
def distinct_sketches(spark, sf_dir):
    """Distinct values of each batch and of all, from sketches that were stored per batch."""
    counted = ["discount", "rating", "reviews_count"]
    rows = _cleaned(spark, sf_dir)
    sketches = stored(profile.distinct_sketches(rows, "batch_no", counted), "sketches")
    return profile.distinct_estimates(sketches, "batch_no", counted)


@query
def price_at_order(spark, sf_dir):
    """The version of the ordered product at the time of every order."""
    versions = history.rebuild(_latest(spark, sf_dir))
    versions = versions.select("sku", "st_date", "end_date", "current_price", "row_hash")
    found = history.as_of_moments(versions, feeds.order_moments(spark, sf_dir))
    return _plain(
        found.select("row_no", "sku", "moment", "version.st_date", "version.current_price", "version.row_hash")
    )


@query
def stream_changes(spark, sf_dir):
    """Versions that a stream opens by itself, the feeds arriving in two parts."""
    folder, out = fresh_path(spark, "arrivals"), fresh_path(spark, "changes")
    checkpoint = fresh_path(spark, "changes-checkpoint")
    rows = _latest(spark, sf_dir).select("sku", "change_time", "stage_id", "row_hash", "batch_no")
    rows = stored(rows, "latest")
    for part in (F.col("batch_no") <= LAST_MERGED, F.col("batch_no") > LAST_MERGED):
        rows.where(part).drop("batch_no").write.mode("append").parquet(folder)
        changes.run_changes(spark, folder, rows.drop("batch_no").schema, out, checkpoint).awaitTermination()
    found = spark.read.parquet(out)
    return found.withColumn("change_time", F.col("change_time").cast("timestamp_ntz"))


@query
def landing_files(spark, sf_dir):
    """Staged rows per batch, and how many of them name the file that holds them."""
    folder, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "landing-checkpoint")
    store = VersionStore(spark, fresh_path(spark, "dimension"))
    feeds.raw_feed(spark, sf_dir).drop("batch_no").repartition(3, "row_no").write.parquet(folder)
    landing.start_landing(
        spark, folder, store, checkpoint, lambda: feeds.batch_moment(INCOMING)
    ).awaitTermination()
    staged = staging.read_staging(spark, store.staging_path())
    held = spark.read.parquet(folder).select(
        F.col("row_no").alias("stage_id"), F.col("_metadata.file_name").alias("held_in")
    )
    named = F.col("source_file").eqNullSafe(F.col("held_in"))
    return staged.join(held, "stage_id").agg(
        F.count(F.lit(1)).alias("rows_staged"),
        F.count_if(named).alias("rows_named"),
        F.count_distinct("load_batch_id").alias("batches"),
    )


# -- pages ---------------------------------------------------------------------------


def _pages(spark, sf_dir):
    return feeds.table(spark, sf_dir, "pages")


def _listing(spark, sf_dir):
    """The listing pages as a stored table: rendered once, whatever reads them."""
    return stored(feeds.listing_pages(spark, sf_dir), "listing")


@query
def page_number(spark, sf_dir):
    return _pages(spark, sf_dir).select(
        "page_id", "url", urls.page_number("url").alias("page_no")
    )


@query
def page_sequence_check(spark, sf_dir):
    """Crawls of ten pages: pages whose URL does not carry the number expected."""
    pages = _pages(spark, sf_dir).select(
        "page_id",
        urls.page_number("url").alias("actual_page"),
        (F.col("page_id") % 10 + 1).alias("expected_page"),
    )
    return totals.page_sequence(pages, "actual_page", "expected_page")


@query
def first_pages(spark, sf_dir):
    pages = feeds.listing_pages(spark, sf_dir).select(
        "page_id", urls.page_number("url").alias("page_no")
    )
    return totals.first_pages(pages, "page_no")


@query
def page_links(spark, sf_dir):
    return links.page_links(_pages(spark, sf_dir)).select(
        "page_id", "position", "href", "link"
    )


@query
def next_page(spark, sf_dir):
    return links.next_page(_listing(spark, sf_dir))


@query
def missing_next_page(spark, sf_dir):
    followed = links.next_page(_listing(spark, sf_dir))
    return links.pages_without_next(followed).select("page_id", "url")


@query
def link_resolve(spark, sf_dir):
    references = F.array(
        F.concat(F.lit("/p"), "page_id", F.lit(".html")),
        F.concat(F.lit("q"), "page_id", F.lit(".html")),
        F.concat(F.lit("?page="), "page_id"),
        F.concat(F.lit("#a"), "page_id"),
        F.concat(F.lit("//c.example/z"), "page_id"),
        F.concat(F.lit("../u"), "page_id"),
    )
    pages = _pages(spark, sf_dir).select("page_id", "url", F.explode(references).alias("ref"))
    return urls.with_resolved_url(pages, "url", "ref", "link")


@query
def unique_by_page(spark, sf_dir):
    """A hundred feed rows to a page."""
    rows = feeds.raw_feed(spark, sf_dir).select(
        (F.floor(F.col("row_no") / 100) + 1).alias("page_no"),
        text.first_present(text.strip("sku")).alias("sku"),
    )
    return totals.unique_by_page(rows, "page_no", "sku")


@query
def page_runs(spark, sf_dir):
    """Runs of page numbers of every host, with what repeats and what is missing."""
    pages = _pages(spark, sf_dir).select(
        F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("host"),
        urls.page_number("url").alias("page_no"),
    )
    return totals.page_runs(pages, "host", "page_no").withColumnRenamed("crawl", "host")


# The crawls of the listing begin at every tenth page, and the reference stops after ten.
PAGES_PER_CRAWL = 10


def _listing_starts(pages):
    number = urls.page_number("url")
    return pages.where(number % PAGES_PER_CRAWL == 1).select(crawl.listing_key("url").alias("start"))


@query
def crawl_order(spark, sf_dir):
    """The pages of all crawls in the order of their next links."""
    pages = _listing(spark, sf_dir)
    steps = stored(crawl.page_steps(pages), "steps")
    return crawl.crawl(steps, _listing_starts(pages), PAGES_PER_CRAWL)


def _site_crawls(spark, sf_dir):
    steps = stored(feeds.site_steps(spark, sf_dir), "steps")
    number = F.substr("page", F.lit(2)).cast("long")
    return steps, steps.where(number % 50 == 0).select(F.col("page").alias("start"))


@query
def crawl_report(spark, sf_dir):
    """How far crawls without a page cap come, and what ends them."""
    steps, starts = _site_crawls(spark, sf_dir)
    return crawl.crawl_report(steps, starts, crawl.crawl(steps, starts))


@query
def crawl_report_capped(spark, sf_dir):
    """The same crawls, each of 30 pages at most."""
    steps, starts = _site_crawls(spark, sf_dir)
    return crawl.crawl_report(steps, starts, crawl.crawl(steps, starts, 30), 30)


@query
def crawl_catalogue(spark, sf_dir):
    """Unique products of every crawl, in the order of its links."""
    pages = _listing(spark, sf_dir)
    steps = stored(crawl.page_steps(pages), "steps")
    reached = crawl.crawl(steps, _listing_starts(pages), PAGES_PER_CRAWL)
    found = crawl.crawl_catalogue(extract_records(pages), reached)
    return found.select("start", "identity", "crawl_position", "page_id", "position", "product_name", "current_price")


# -- text ----------------------------------------------------------------------------


def _documents(spark, sf_dir):
    return feeds.table(spark, sf_dir, "documents").select("doc_id", "text")


@query
def text_normalise(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id",
        text.collapse_whitespace("text").alias("collapsed"),
        text.strip("text").alias("stripped"),
    )


@query
def first_number(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", numeric.first_number("text").alias("number")
    )


@query
def phrase_extract(spark, sf_dir):
    count = (F.col("l_suppkey") * F.col("l_linenumber")).cast("string")
    phrase = F.concat(
        F.lit("Rated "),
        F.col("l_quantity").cast("string"),
        F.when(F.col("l_returnflag") == "N", " of 5 (").otherwise("  Out of 5 ("),
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit("1,"), count)).otherwise(count),
        F.lit(")"),
    )
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag"
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        numeric.rating_phrase(phrase).alias("rating"),
        numeric.reviews_in_parentheses(phrase).alias("reviews"),
    )


# -- cards ---------------------------------------------------------------------------


def _records(spark, sf_dir):
    return extract_records(_listing(spark, sf_dir)).drop("url")


@query
def card_extract(spark, sf_dir):
    return _records(spark, sf_dir)


@query
def extract_counts(spark, sf_dir):
    """Cards and failures of every page."""
    return extract.extract_counts(_listing(spark, sf_dir))


@query
def page_catalogue(spark, sf_dir):
    return cards.page_records(_records(spark, sf_dir))


@query
def card_catalogue(spark, sf_dir):
    return cards.catalogue(_records(spark, sf_dir))


@query
def sql_rules(spark, sf_dir):
    """The rules called from SQL text."""
    sql.register(spark)
    return export.read_query(
        spark,
        """
        SELECT row_no, shelf_strip(sku) AS sku, shelf_price(current_price) AS current_price,
          CAST(shelf_percent(discount) AS double) AS discount, CAST(shelf_rating(rating) AS double) AS rating,
          shelf_count(reviews_count) AS reviews_count, shelf_first_number(product_url) AS number
        FROM {feed}
        """,
        feed=feeds.raw_feed(spark, sf_dir),
    )


@query
def sql_cards(spark, sf_dir):
    """Cards by the table function, counted by page in SQL."""
    sql.register(spark)
    return export.read_query(
        spark,
        """
        SELECT page_id, count(*) AS cards, count(data_sku) AS with_sku, count(link_id) AS with_link,
          max(position) AS last_position
        FROM product_cards(TABLE(SELECT page_id, html FROM {pages}))
        GROUP BY page_id
        """,
        pages=_listing(spark, sf_dir),
    )


@query
def card_quarantine(spark, sf_dir):
    """Cards of pages on which some cannot be read: those go to quarantine, others stay."""
    pages = stored(feeds.listing_pages(spark, sf_dir, poisoned=True), "listing")
    good = extract_records(pages).select(
        "page_id", "position", "sku", "product_name", F.lit(None).cast("string").alias("error")
    )
    bad = extract.failed_cards(pages).select(
        "page_id",
        "position",
        F.lit(None).cast("string").alias("sku"),
        F.lit(None).cast("string").alias("product_name"),
        F.split_part("parse_error", F.lit(":"), F.lit(1)).alias("error"),
    )
    return good.unionByName(bad)
