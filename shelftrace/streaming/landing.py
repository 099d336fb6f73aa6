"""Feeds picked up from a landing folder as they arrive.

Each micro-batch is one load. Its batch id is made of the stream's own id, which its
checkpoint keeps, and the batch number: a micro-batch that is replayed after a failure
is recognised, and no other stream's batch is taken for it. A micro-batch without a
valid row stays in quarantine and the stream goes on.
"""

import json
import logging
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftrace import schema
from shelftrace.operators.columns import nullify_tokens
from shelftrace.plans.load import NoValidRows, load_feed

log = logging.getLogger(__name__)

LANDING_SCHEMA = T.StructType([T.StructField("row_no", T.LongType()), *schema.RAW_SCHEMA])


def _now():
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _stream_id(spark, checkpoint):
    """The id that a checkpoint gives its stream, whichever run it is."""
    kept = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(kept)["id"]


def start_landing(spark, folder, store, checkpoint, clock=_now, files_per_batch=None):
    """Load everything in the folder that was not loaded yet, then stop: as one batch, or
    `files_per_batch` files at a time. Each staged row names the file it came from."""

    def load(rows, number):
        if rows.isEmpty():
            return
        batch_id = f"landing-{_stream_id(spark, checkpoint)}-{number}"
        try:
            load_feed(
                rows.sparkSession, nullify_tokens(rows), store, clock(), F.col("source_file"), batch_id
            )
        except NoValidRows as found:
            log.warning("%s: %s", batch_id, found)

    reader = spark.readStream.schema(LANDING_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrived = reader.parquet(folder).select(
        *LANDING_SCHEMA.names, F.col("_metadata.file_name").alias("source_file")
    )
    return (
        arrived.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
