"""Mixing sources to target weights with hash thresholds.

Every document has a place on a line of 2**48 hash values. A source takes each document
a whole number of times and once more those below its threshold. The threshold is found
by histograms: words summed per source and hash bucket tell which bucket the budget ends
in, and only that bucket is cut further, until it is one hash value wide. Nothing is
sorted, and a source may hold any share of all rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.llm.common import WORD_PATTERN, free_names
from shelftrace.sources.shared import stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# Hex digits of the hash, and how many of them each histogram cuts off.
HASH_DIGITS = 12
STEP_DIGITS = 3


def word_count(text="text"):
    """Words between ASCII white space; a null has none."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.regexp_count(whole, F.lit(WORD_PATTERN)).cast("long")


def hash_value(column, seed):
    """A whole number of HASH_DIGITS hex digits from the value as text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    digits = F.substring(F.md5(text), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sized, weights=WEIGHTS, most=MOST_REPEATS):
    """(source, source_size, target) from (source, size).

    Sources by code point, null last, get the weights in turn and share the sum of all
    sizes; what a target has above `most` times its source is shared again among the
    others. One row per source is ranked in one task; the driver sees sums only.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")
    ).cast("long")
    sources = stored(
        sums.withColumn("weight", weight).withColumn("most", F.col("source_size") * most),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # A source is full if its even share reaches its most. Shares only grow, so full
    # sources stay full; each turn fills at least one or is the last.
    spare, shares, full = total, None, F.lit(False)
    while True:
        open_sources = sources.where(~full)
        found = open_sources.agg(F.sum("weight")).first()[0] or 0
        shares = found
        if not shares:
            break
        filled = F.col("weight") * F.lit(spare) >= F.col("most") * F.lit(shares)
        more = open_sources.where(filled).agg(F.sum("most"), F.count(F.lit(1))).first()
        if not more[1]:
            break
        full = full | filled
        spare -= more[0]
    share = F.col("weight").cast("double") * F.lit(float(spare)) / F.lit(float(shares or 1))
    return sources.select(
        "source",
        "source_size",
        F.when(full, F.col("most").cast("double")).otherwise(share).alias("target"),
    )


def thresholds(sized, targets):
    """(of, source_size, target, repeats, below) per source `of`: each document is taken
    `repeats` times, and once more if its hash is less than `below`."""
    step = 1 << (4 * STEP_DIGITS)
    width = 1 << (4 * HASH_DIGITS)
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long")
    state = targets.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        whole.alias("repeats"),
        (target - whole * size).alias("room"),
        F.lit(0).cast("long").alias("below"),
    )
    while width > 1:
        state = stored(state, "mix-state")
        last = width
        width //= step
        # Only the bucket that the budget ends in: [below, below + last).
        inside = F.col("source").eqNullSafe(F.col("of")) & (
            (F.col("hash") >= F.col("below")) & (F.col("hash") < F.col("below") + last)
        )
        buckets = (
            sized.select("source", "hash", "size")
            .join(state.select("of", "below"), inside)
            .groupBy("of", F.floor((F.col("hash") - F.col("below")) / F.lit(width)).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        upto = F.sum("words").over(Window.partitionBy("of").orderBy("bucket"))
        summed = buckets.withColumn("upto", upto)
        summed = summed.join(
            state.select(F.col("of").alias("named"), "room"), F.col("of").eqNullSafe(F.col("named"))
        )
        fits = F.col("upto") <= F.col("room")
        if width == 1:
            # The hash value that does not fit whole is taken if that comes nearer.
            before = F.col("room") - (F.col("upto") - F.col("words"))
            fits = fits | ((before > 0) & (F.col("upto") - F.col("room") < before))
        # The first bucket that does not fit is the boundary; without one all are taken.
        cut = summed.groupBy(F.col("of").alias("cut")).agg(
            F.min(F.when(~fits, F.col("bucket"))).alias("boundary"),
            F.max(F.when(fits, F.col("upto"))).alias("used"),
        )
        state = state.join(cut, F.col("of").eqNullSafe(F.col("cut")), "left").select(
            "of",
            "source_size",
            "target",
            "repeats",
            (F.col("room") - F.coalesce("used", F.lit(0))).alias("room"),
            (F.col("below") + F.coalesce("boundary", F.lit(step)) * F.lit(width)).alias("below"),
        )
    return stored(state.drop("room"), "mix-thresholds")


def sized_documents(docs, seed, id, text, source):
    """(id, source, size, hash), written once and read for every histogram."""
    rows = docs.select(
        F.col(id).alias("id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        hash_value(id, seed).alias("hash"),
    )
    return stored(rows, "sized")


def times_taken(most):
    extra = (F.col("hash") < F.col("below")).cast("long")
    return F.least(F.col("repeats") + extra, F.lit(most))


def mix(docs, weights=WEIGHTS, most=MOST_REPEATS, seed=8, id="doc_id", text="text", source="source"):
    """(id, size, source_size, target, taken) of every document.

    `taken` is the document's size times the whole number of times it is taken, 0 to
    `most`. A null text has size 0; null sources are one source, the last. Rows with one
    id share one place and are taken alike; null ids likewise. Other columns are
    ignored. Every run on the same rows gives the same result, whatever their order.
    """
    sized = sized_documents(docs, seed, id, text, source)
    limits = thresholds(sized, source_targets(sized, weights, most))
    return sized.join(limits, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id),
        "size",
        "source_size",
        "target",
        (F.col("size") * times_taken(most)).alias("taken"),
    )


def mixed_documents(docs, weights=WEIGHTS, most=MOST_REPEATS, seed=8, id="doc_id", text="text", source="source"):
    """The rows of the mix with all their columns, each as often as it is taken."""
    sized = sized_documents(docs, seed, id, text, source)
    limits = thresholds(sized, source_targets(sized, weights, most))
    of, repeats, below, time = free_names(docs, "of", "repeats", "below", "time")
    limits = limits.select("of", "repeats", "below").toDF(of, repeats, below)
    extra = (hash_value(id, seed) < F.col(below)).cast("long")
    times = F.least(F.col(repeats) + extra, F.lit(most)).cast("int")
    rows = docs.join(limits, F.col(source).eqNullSafe(F.col(of)))
    repeated = rows.withColumn(time, F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*docs.columns)
