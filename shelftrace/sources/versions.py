"""The dimension as two plain tables that Spark jobs add to.

`versions` holds every version as its load opened it, by load and hash bucket of the key,
and is never written again: where a version ends follows from the version after it, on
reading. `loads` has a row for every load that is done; only its versions count. So a load
shows as a whole or not at all, and one that failed can be done again. One writer at a time.
"""

import uuid
from datetime import datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.operators import history
from shelftrace.sources.numbering import numbered
from shelftrace.sources.shared import stored


class VersionStore:
    """`buckets` is the number of hash buckets of a new store; a merge reads those that its
    batch has keys in. A store keeps the number it began with."""

    def __init__(self, spark, root, buckets=16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        for name, kind, by in (("loads", schema.LOADS, []), ("versions", schema.VERSIONS, ["load_id", "bucket"])):
            empty = spark.createDataFrame([], kind).write.mode("ignore")
            empty.partitionBy(*by).parquet(f"{self.root}/{name}")

    def staging_path(self):
        return f"{self.root}/staging"

    def _read(self, name, kind):
        return self.spark.read.schema(kind).parquet(f"{self.root}/{name}")

    def loads(self):
        return self._read("loads", schema.LOADS)

    def state(self, batch_id=None):
        """(the last load as a row or None, is the batch among the loads); one aggregate."""
        done = self.loads()
        last = F.max_by(F.struct(*done.columns), "load_no")
        applied = F.coalesce(F.max(F.col("batch_id").eqNullSafe(F.lit(batch_id))), F.lit(False))
        return tuple(done.agg(last, applied).first())

    def all_versions(self, buckets=None):
        """All versions with their ends, or those of some buckets."""
        rows = self._read("versions", schema.VERSIONS)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        opened = rows.join(self.loads().select("load_id"), "load_id", "left_semi")
        return history.with_ends(opened).select(*schema.DIMENSION_SCHEMA.names)

    def current(self, buckets=None):
        return history.current_versions(self.all_versions(buckets))

    def apply(self, source, batch_id, change_time, last_stage_id=None, state=None):
        """Merge one batch and return the number of new versions. A batch that was loaded
        before changes nothing. Change times must grow: versions end where others begin."""
        last, applied = state or self.state(batch_id)
        moment = datetime.fromisoformat(str(change_time))
        if applied:
            return 0
        if last and last.change_time and moment <= last.change_time:
            raise ValueError(f"Change time {moment} is not later than {last.change_time}")
        # Read several times, so kept as files that outlive executors.
        source = stored(source.withColumn("bucket", self._bucket(last)), "source")
        met = [row[0] for row in source.select("bucket").distinct().collect()]
        opened = history.open_versions(history.openable(self.current(met), source), history.as_time(change_time))
        opened = numbered(opened, ["sku"], "product_id", last.last_product_id if last else 0)
        return self._add(opened, last, batch_id, moment, last_stage_id or 0)

    def adopt(self, table, batch_id="adopted", change_time=None):
        """Take an existing dimension as the first load, bootstrapped where rows are not yet
        marked; both id sequences go on from the table's highest."""
        if self.state()[0]:
            raise RuntimeError("Only an empty store can adopt a table")
        rows = history.bootstrap(table).withColumn("bucket", self._bucket(None))
        moment = change_time and datetime.fromisoformat(str(change_time))
        return self._add(rows, None, batch_id, moment, 0)

    def _bucket(self, last):
        count = last.buckets if last else self.buckets
        return F.pmod(F.xxhash64("sku"), F.lit(count)).cast("int")

    def _add(self, rows, last, batch_id, moment, last_stage_id):
        """Write the versions of a load, then its row in `loads`."""
        load_id, seen = uuid.uuid4().hex, Observation()
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.DIMENSION_SCHEMA], "bucket")
        rows.hint("rebalance", F.col("bucket")).observe(
            seen,
            F.count(F.lit(1)).alias("inserted"),
            F.count_if(~F.col("iscurrent").isin(0, 1)).alias("odd"),
            F.max("product_id").alias("product"),
            F.max("stage_id").alias("stage"),
        ).write.partitionBy("bucket").parquet(f"{self.root}/versions/load_id={load_id}")
        found = seen.get
        if found.get("odd"):
            raise ValueError(f"{found['odd']} rows are neither current (1) nor closed (0)")
        number, buckets, product, stage = (0, self.buckets, 0, 0)
        if last:
            number, buckets, product, stage = last.load_no, last.buckets, last.last_product_id, last.last_stage_id
        product = max(product, found.get("product") or 0)
        stage = max(stage, last_stage_id, found.get("stage") or 0)
        row = (number + 1, load_id, batch_id, moment, buckets, found.get("inserted", 0), product, stage)
        cells = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.LOADS)]
        self.spark.range(1).select(*cells).coalesce(1).write.mode("append").parquet(f"{self.root}/loads")
        return found.get("inserted", 0)
