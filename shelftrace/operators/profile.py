"""Profiles of a table."""

from pyspark.sql import functions as F

WIDEST = 50
MARGIN = 2
TIME_WIDTH = 22


def distinct_profile(df, columns=("rating", "reviews_count"), approximate=False):
    """Number of distinct values per column, null not counted."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])


# Distinct values are told apart by 2**SKETCH_BITS registers: an error of about
# 1 / sqrt(2**SKETCH_BITS) for many, next to none for some hundred values.
SKETCH_BITS = 14


def distinct_sketches(df, by, columns):
    """(by, a sketch of each column): distinct values as sketches to be stored per batch,
    of fixed size however many rows a batch has. Null is no value."""
    sketch = [F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(c) for c in columns]
    return df.groupBy(by).agg(*sketch)


def distinct_estimates(sketches, by, columns, total=True):
    """(by, distinct_<column>...): estimates of every batch, and of all batches together
    with a null batch. Stored sketches merge on reading; no row is counted again."""

    def estimates(grouped):
        merged = [F.hll_union_agg(c) for c in columns]
        return grouped.agg(*[F.hll_sketch_estimate(m).alias(f"distinct_{c}") for m, c in zip(merged, columns)])

    kind = sketches.schema[by].dataType
    each = estimates(sketches.groupBy(by))
    if not total:
        return each
    whole = estimates(sketches.groupBy()).withColumn(by, F.lit(None).cast(kind))
    return each.unionByName(whole)


def column_profile(df, fixed=()):
    """Display width of each column: widest value or header, plus a margin, capped.

    Columns in `fixed` have the width of a rendered time. One aggregation over the
    table; the one-row result is then turned into rows.
    """
    measured = [c for c in df.columns if c not in fixed]
    widths = df.agg(
        *[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in measured]
    )

    def width(c):
        if c in fixed:
            return F.lit(TIME_WIDTH)
        widest = F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c)))
        return F.least(widest + MARGIN, F.lit(WIDEST))

    cells = [
        F.struct(F.lit(c).alias("column_name"), width(c).alias("display_width"))
        for c in df.columns
    ]
    return widths.select(F.inline(F.array(*cells)))
