"""Change detection per product inside a stream.

The state store keeps the last change time and fingerprint of every product. A micro-batch
keeps the last row per product and change time, in the order of the stage ids, and passes
on what opens a version. State and progress lie in the stream's checkpoint, so a stream
that was stopped, or lost its executors, goes on where it was.

Products share a state by hash bucket of the key: a call of Python with its state takes
milliseconds, so there is one for a bucket and not one for every product.
"""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

OPENED = "opened"
LATE = "late"

# A fixed value, because checkpoints keep their state by it. A worker holds the products of
# one bucket at a time, and their rows of a micro-batch.
BUCKETS = 4096

# Times and stage ids travel as whole numbers. Null is less than all others, as in a sort.
LEAST = -(1 << 63)

STATE = "times map<string, bigint>, hashes map<string, string>"
CHANGES = "sku string, moment long, stage long, row_hash string, kind string"


def _follow(key, frames, state):
    """The changes of a bucket's products in a micro-batch."""
    latest = {}
    for frame in frames:
        # Only the last row of each product and change time is held, however many rows there are.
        columns = (frame[name].tolist() for name in ("sku", "moment", "stage", "row_hash"))
        for sku, moment, stage, fingerprint in zip(*columns):
            held = latest.get((sku, moment))
            if held is None or held[0] < stage:
                latest[sku, moment] = (stage, fingerprint)
    times, hashes = state.get if state.exists else ({}, {})
    out = []
    for sku, moment in sorted(latest):
        stage, fingerprint = latest[sku, moment]
        if sku in times and moment <= times[sku]:
            out.append((sku, moment, stage, fingerprint, LATE))
            continue
        times[sku] = moment
        if fingerprint != hashes.get(sku):
            out.append((sku, moment, stage, fingerprint, OPENED))
        hashes[sku] = fingerprint
    state.update((times, hashes))
    if out:
        yield pd.DataFrame(out, columns=["sku", "moment", "stage", "row_hash", "kind"])


def detect_changes(rows):
    """A stream (sku, change_time, stage_id, row_hash) as the versions that it opens: rows
    whose fingerprint differs from that of the change time before, the first of a product
    included. A row that comes after a later or equal change time of its product was seen
    is passed on as late and changes nothing. Rows without a key open nothing."""
    moment = F.unix_micros(F.col("change_time").cast("timestamp"))
    keyed = rows.where(F.col("sku").isNotNull()).select(
        F.pmod(F.xxhash64("sku"), F.lit(BUCKETS)).alias("bucket"),
        "sku",
        F.coalesce(moment, F.lit(LEAST)).alias("moment"),
        F.coalesce(F.col("stage_id").cast("long"), F.lit(LEAST)).alias("stage"),
        "row_hash",
    )
    found = keyed.groupBy("bucket").applyInPandasWithState(
        _follow, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout
    )
    return found.select(
        "sku",
        F.timestamp_micros(F.nullif("moment", F.lit(LEAST))).alias("change_time"),
        F.nullif("stage", F.lit(LEAST)).alias("stage_id"),
        "row_hash",
        "kind",
    )


def run_changes(spark, folder, schema, out, checkpoint):
    """Everything in the folder that was not read yet, then stop; changes go to `out`."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return (
        detect_changes(rows)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
