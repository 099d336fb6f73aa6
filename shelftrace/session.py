"""A session with the settings this library is tuned for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Arrow batches are bounded by bytes as well as rows, so wide pages fit in a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
    # HotSpot never compiles a method over 8000 bytes. A row of text rules is longer
    # than that as one generated method; such stages run faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(app_name="shelftrace", master=None, **overrides):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
