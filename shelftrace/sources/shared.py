"""The folder that all executors share."""

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache


@lru_cache(maxsize=1)
def _own_folder():
    folder = tempfile.mkdtemp(prefix="shelftrace-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark):
    """The cluster's `spark.checkpoint.dir`; only in local mode a temporary folder, which
    goes when the program ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return _own_folder()


def fresh_path(spark, label):
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df, label):
    """The rows as a table in the shared folder: computed once, read as often as needed."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def open_files(spark, count):
    """In here a task that writes `count` partitions or fewer keeps a file open for each.
    Otherwise it sorts all its rows by partition first, and holds them for that."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)
