"""One row per key.

Both keep rank 1 of a row number. Spark cuts each key to one row per map task
before the shuffle (WindowGroupLimit), so a key that holds a large share of the
rows sends at most one row per map task to the task that decides it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.functions.text import as_column, first_present


def _rank_one(df, keys, order):
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where("_rank = 1")
        .drop("_rank")
    )


def _as_list(value):
    return list(value) if isinstance(value, (list, tuple)) else [value]


def latest_per_key(df, keys, order):
    """Last wins. `order` must be unique within a key."""
    return _rank_one(
        df, _as_list(keys), [as_column(c).desc() for c in _as_list(order)]
    )


def first_per_key(df, keys, order):
    """First wins. `order` must be unique within a key."""
    return _rank_one(
        df, _as_list(keys), [as_column(c).asc() for c in _as_list(order)]
    )


def identified(df, *candidates, name="identity"):
    """Identity = first candidate present; rows without any are dropped.

    The drop comes before any shuffle, so empty keys never gather in one task.
    """
    return df.withColumn(name, first_present(*candidates)).where(
        F.col(name).isNotNull()
    )
