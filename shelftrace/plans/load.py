"""From a raw feed to new versions in the dimension."""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.operators import clean, columns, validate
from shelftrace.operators.typed import latest_typed
from shelftrace.sources import feed as feeds
from shelftrace.sources import staging
from shelftrace.sources.numbering import numbered


@dataclass(frozen=True)
class LoadResult:
    batch_id: str
    valid: int
    invalid: int
    staged: int
    inserted: int


def new_batch_id():
    """One id per run, made on the driver."""
    return str(uuid4())


def number_by_arrival(df, order, name="row_no"):
    """Row numbers in the order of `order`, for feeds that bring none."""
    return numbered(df, order, name)


class NoValidRows(ValueError):
    """Every row of a feed was quarantined."""


def stage_feed(spark, feed, store, batch_id, source_file, state=None):
    """Validate, quarantine, clean and stage one feed. Each step is durable.

    `source_file` is a text, or a column of the feed that names the file of each row."""
    columns.require_columns(feed, ["row_no", *schema.FEED_COLUMNS])
    classified = validate.classify(feed)
    split = f"{store.root}/split/batch={batch_id}"
    routes = feeds.write_split(classified, split)
    valid, invalid = routes.get("valid", 0), routes.get("invalid", 0)
    if not valid:
        raise NoValidRows(f"The feed has no valid rows ({invalid} invalid)")
    accepted = feeds.read_accepted(spark, split, classified.schema)
    last, _ = state or store.state()
    base = last.last_stage_id if last else 0
    rows = staging.staged_rows(clean.clean(accepted), batch_id, source_file, base)
    staged, last_stage_id = staging.append_batch(rows, store.staging_path())
    return valid, invalid, staged, last_stage_id


def merge_batch(spark, store, batch_id, change_time, last_stage_id=None, state=None):
    """Merge a staged batch. Staging outlives a failed merge, so this can be rerun."""
    batch = staging.read_batch(spark, store.staging_path(), batch_id)
    columns.reject_empty(batch, f"Batch {batch_id}")
    if last_stage_id is None:
        last_stage_id = batch.agg(F.max("stage_id")).first()[0]
    return store.apply(latest_typed(batch), batch_id, change_time, last_stage_id, state)


def load_feed(spark, feed, store, change_time, source_file, batch_id=None):
    """Stage and merge one feed; the table of loads is read once."""
    batch_id = batch_id or new_batch_id()
    state = store.state(batch_id)
    if state[1]:
        return LoadResult(batch_id, 0, 0, 0, 0)
    valid, invalid, staged, last_stage_id = stage_feed(
        spark, feed, store, batch_id, source_file, state
    )
    inserted = merge_batch(spark, store, batch_id, change_time, last_stage_id, state)
    return LoadResult(batch_id, valid, invalid, staged, inserted)
