"""SpotSigs fingerprints, with DataFrame functions only.

A spot is a common word (anchor) with the next content words after it, other anchors
skipped. The hashes of a text's spots are its fingerprint, a set. Sets are compared by
Jaccard similarity, but only if their lengths allow the similarity asked for: lengths
are cut into partitions so wide that only neighbours can hold similar sets.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.sources.shared import stored

# Common words of English, German, French and Spanish.
ANCHORS = sorted(
    set(
        """
a an and are as at be by for from had has have he her his in is it its not of on or
she that the their they this to was were which with you
als am auf aus bei das dem den der des die ein eine einen er es ist mit nicht sich sie
und von vor wie zu zum zur
au aux avec ce dans de du elle en est et il je la le les leur ne ou par pas pour qui
que sa se son sur un une
al como con del el esta la las lo los mas no para pero por su sus una y
""".split()
    )
)
CHAIN = 2
# A chain ends with the words so far after its anchor.
REACH = 8


def text_words(text):
    """Lower-cased runs of letters, marks and digits."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def spot_hashes(words):
    """Hashes of the spots, null where there is none."""

    def spot(word, place):
        after = F.slice(words, place + 2, F.lit(REACH))
        chain = F.slice(F.filter(after, lambda w: ~w.isin(ANCHORS)), 1, CHAIN)
        whole = F.size(chain) == CHAIN
        return F.when(word.isin(ANCHORS) & whole, F.xxhash64(word, chain))

    return F.transform(words, spot)


def with_signatures(df, text, name):
    """Adds the sorted set of spot hashes of a text. A text without spots has its words
    as signatures, one without words itself, and an empty one none."""
    words, spots = f"__{name}_words", f"__{name}_spots"
    df = df.withColumn(words, text_words(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn(
        spots, F.array_distinct(F.array_compact(spot_hashes(F.col(words))))
    )
    single = F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))
    itself = F.when(
        F.col(text) != "", F.array(F.xxhash64(F.col(text), F.lit("text")))
    ).otherwise(F.array().cast("array<bigint>"))
    chosen = (
        F.when(F.size(spots) > 0, F.col(spots))
        .when(F.size(words) > 0, single)
        .otherwise(itself)
    )
    return df.withColumn(name, F.array_sort(chosen)).drop(words, spots)


def fingerprint(signatures):
    """The set as text: sixteen hex digits for each hash, in order."""
    return F.array_join(
        F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), ""
    )


def length_partition(signatures, threshold):
    """Sets of similarity `threshold` or more lie in the same partition or neighbours."""
    length = F.greatest(F.size(signatures), F.lit(1))
    return F.floor(F.log(length.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9))


def likeness(left, right):
    """Jaccard similarity of two sets, whatever it is; two empty sets are alike."""
    a, b = F.size(left), F.size(right)
    # Sets without a common element need no intersection.
    common = F.when(F.arrays_overlap(left, right), F.size(F.array_intersect(left, right)))
    common = F.coalesce(common, F.lit(0)).cast("double")
    return F.when((a == 0) & (b == 0), F.lit(1.0)).otherwise(common / (a + b - common))


def jaccard(left, right, threshold):
    """Similarity of two sets; 0 if it is under `threshold`. Sets in partitions of length
    that are no neighbours are not compared. Two empty sets are alike."""
    a, b = F.size(left), F.size(right)
    apart = F.abs(length_partition(left, threshold) - length_partition(right, threshold)) > 1
    short = F.least(a, b) < F.lit(threshold) * F.greatest(a, b)
    found = likeness(left, right)
    return F.when(((a > 0) | (b > 0)) & (apart | short), F.lit(0.0)).otherwise(
        F.when(found >= threshold, found).otherwise(F.lit(0.0))
    )


def in_ranges(docs):
    """(docs by ranges, heads): the documents with `__order` and `__hash`, by which they
    are ordered, and the number of their range; and the first row of each range with the
    range before it, that of the first being the last.

    The ids are cut into ranges of like many rows, several per shuffle partition. An id
    that fills ranges by itself, or rows without one, are cut further by the hash.
    """
    lowest = -(2**63)
    docs = docs.withColumns(
        {"__order": F.coalesce(F.col("id").cast("long"), F.lit(lowest)), "__hash": F.xxhash64("text")}
    )
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("__order", shares, 10 * ranges)).first()[0] or []
    # An id that is several cuts has as many ranges.
    pieces = {c: cuts.count(c) + (c == lowest) for c in set(cuts)}
    pieces = {c: count for c, count in pieces.items() if count > 1}
    splits = [-math.inf, *sorted({float(c) for c in cuts if c > lowest}), math.inf]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    bucketizer = Bucketizer(splits=splits, inputCol="__place", outputCol="__range")
    placed = bucketizer.transform(docs.withColumn("__place", F.col("__order").cast("double"))).drop("__place")
    # Such an id is the least of its range; the other ids there come behind its pieces.
    share = F.col("__hash").cast("double") / 2.0**64 + 0.5
    piece = F.lit(ranges)
    for hot, count in pieces.items():
        own = F.least(F.floor(share * count), F.lit(count - 1))
        piece = F.when(F.col("__order") == F.lit(hot), own).otherwise(piece)
    placed = placed.withColumn("__range", (F.col("__range") * (ranges + 1) + piece).cast("long"))
    # At most one row per range from here.
    heads = placed.groupBy("__range").agg(F.min(F.struct("__order", "__hash")).alias("__first"))
    along = Window.orderBy("__range")
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        F.col("__first.__order").alias("__head"),
        F.col("__first.__hash").alias("__head_hash"),
        F.coalesce(F.lag("__range").over(along), F.last("__range").over(everything)).alias("__before"),
    )
    return placed, heads


def with_next(docs, carried):
    """Adds `next_<c>` for each carried column: its value in the next row by `id`, rows
    of one id by a hash of their text; after the last comes the first. The first row of a
    range is also sent to the range before, where it comes last."""
    placed, heads = in_ranges(docs)
    is_head = (F.col("__order") == F.col("__head")) & (F.col("__hash") == F.col("__head_hash"))
    sent = placed.join(F.broadcast(heads), is_head, "left")
    places = F.array(
        F.struct(F.col("__range").alias("range"), F.lit(False).alias("tail")),
        F.struct(F.col("__before").alias("range"), F.lit(True).alias("tail")),
    )
    places = F.filter(places, lambda p: p["range"].isNotNull())
    sent = sent.withColumn("__to", F.explode(places))
    order = Window.partitionBy("__to.range").orderBy("__to.tail", "__order", "__hash", "text")
    following = {f"next_{c}": F.lead(c).over(order) for c in carried}
    out = sent.withColumns(following).where(~F.col("__to.tail"))
    return out.drop("__to", "__order", "__hash", "__range", "__head", "__head_hash", "__before")


def edited_text(text, following):
    """The last quarter of the code points (rounded down) replaced by as many of the
    beginning of the following text, or all of it."""
    size = F.length(text)
    cut = F.floor(size / 4).cast("int")
    return F.concat(text.substr(F.lit(1), size - cut), following.substr(F.lit(1), cut))


def fingerprint_documents(docs, id="doc_id", text="text"):
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every document.

    A null text is empty. Null ids come first in the order of documents, rows of one id
    in the order of a hash of their texts. Repeated rows come out as often as they occur;
    other columns are ignored. A table of one row follows itself. The two likenesses are
    whole Jaccard similarities, however small; only near_duplicates has a threshold.
    """
    rows = docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = with_next(with_signatures(rows, "text", "signatures"), ["text", "signatures"])
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = with_signatures(rows, "edited", "edited_signatures")
    return rows.select(
        F.col("id").alias(id),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signatures")).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )


def near_duplicates(docs, threshold=0.8, id="doc_id", text="text"):
    """(pairs, members): pairs (a, b, likeness) between documents of different sets whose
    similarity reaches the threshold, and (id, set_id) of every document.

    Documents with equal signature sets are one class, named by its least id. A set is
    looked up by its rarest signatures, as many as a set so similar cannot all lack, and
    only in its own partition of lengths and the next. Classes whose ids are all null
    are in no pair.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    signed = with_signatures(rows, "text", "signatures").drop("text")
    signed = signed.withColumn("set", F.md5(fingerprint(F.col("signatures"))))
    sets = stored(
        signed.groupBy("set").agg(F.min("id").alias("set_id"), F.first("signatures").alias("signatures")),
        "signature-sets",
    )
    members = signed.select("id", "set").join(sets.select("set", "set_id"), "set")
    members = members.select(F.col("id").alias(id), "set_id")
    named = sets.where(F.col("set_id").isNotNull() & (F.size("signatures") > 0))
    single = named.select("set_id", F.size("signatures").alias("length"), F.explode("signatures").alias("signature"))
    rarity = single.groupBy("signature").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    ordered = single.join(rarity, "signature", "left").groupBy("set_id", "length").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("sets", F.lit(1)).alias("sets"), "signature"))).alias("all")
    )
    needed = F.col("length") - F.ceil(F.col("length") * F.lit(threshold)) + 1
    prefix = ordered.select(
        "set_id",
        length_partition(F.col("all"), threshold).alias("part"),
        F.explode(F.slice("all", F.lit(1), needed.cast("int"))).alias("first"),
    ).select("set_id", "part", "first.signature")
    near = prefix.select(F.col("set_id").alias("a"), "part", "signature").join(
        prefix.select(
            F.col("set_id").alias("b"), F.explode(F.array(F.col("part"), F.col("part") - 1, F.col("part") + 1)).alias("part"), "signature"
        ),
        ["signature", "part"],
    )
    candidates = near.where("a < b").select("a", "b").distinct()

    def of(name):
        return named.select(F.col("set_id").alias(name), F.col("signatures").alias(f"{name}_set"))

    near = jaccard(F.col("a_set"), F.col("b_set"), threshold)
    pairs = candidates.join(of("a"), "a").join(of("b"), "b").select("a", "b", near.alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold), members
