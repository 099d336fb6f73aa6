"""Near-duplicate documents by weighted MinHash.

Texts are weighted sets of five-word shingles (occurrences times inverse document
frequency). Improved consistent weighted sampling gives each distinct text 64 samples,
banded by four; texts that share a band are candidates. Links are verified by the exact
weighted Jaccard similarity, in two steps. First every text meets the centres of its
buckets only: the text that shares most buckets. Then, in buckets whose texts are still
in different classes, all texts outside the largest class meet all others, dealt into
blocks, so that no link between candidates of different classes is lost and no group
has to fit one task. Classes are the connected components.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelftrace.llm.common import free_names, releasing
from shelftrace.llm.components import components
from shelftrace.llm.shingles import (
    FREQUENCY_BUCKETS,
    RARE_SHARE,
    Sampler,
    bucket_of,
    shingle_arrays,
    similarity,
    weighted,
)
from shelftrace.llm.url_filter import block_count, possible_hits
from shelftrace.sources.shared import stored

THRESHOLD = 0.8
# Texts of a bucket that one task compares with as many others.
BLOCK = 512
# Bucket mates, over all its buckets, that a centre meets in one place; it is copied to
# further places for more.
MATES = 4096
ROWS_AT_ONCE = 256
TOLERANCE = 1e-9


def _texts(batch, name="text"):
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(start, ROWS_AT_ONCE)
        yield part, part.column(name).to_pylist()


def bucket_weights(docs):
    """Inverse document frequency per hash bucket, over all documents with words:
    1 + log10(documents / frequency), and as if the frequency were a tenth of all where
    it is less. The driver gets the buckets that are more frequent: few, and at most
    FREQUENCY_BUCKETS."""

    def count(batches):
        total, rows = np.zeros(FREQUENCY_BUCKETS, np.int64), 0
        for batch in batches:
            for _, texts in _texts(batch):
                for shingles in shingle_arrays(texts):
                    if len(shingles):
                        rows += 1
                        total[np.unique(bucket_of(shingles))] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used], pa.int32()), pa.array([rows, *total[used]], pa.int64())],
            names=["bucket", "documents"],
        )

    partial = docs.select("text").mapInArrow(releasing(count), "bucket int, documents long")
    sums = stored(partial.groupBy("bucket").agg(F.sum("documents").alias("documents")), "buckets")
    every = sums.where(F.col("bucket") == -1).first()
    rows = every[1] if every else 0
    out = np.full(FREQUENCY_BUCKETS, 1 - math.log10(RARE_SHARE))
    for bucket, found in sums.where(
        (F.col("bucket") >= 0) & (F.col("documents") > RARE_SHARE * rows)
    ).collect():
        out[bucket] = 1 + math.log10(rows / found)
    return out


def band_keys(docs, idf):
    """(node, bands) for each text."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches):
        sampler = Sampler()
        for batch in batches:
            for part, texts in _texts(batch):
                bands = [sampler.bands(*weighted(s, shared.value)) for s in shingle_arrays(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(bands, pa.list_(pa.int64()))],
                    names=["node", "bands"],
                )

    return docs.select("node", "text").mapInArrow(releasing(sign), "node binary, bands array<long>")


def shared_buckets(bands):
    """(key, size, node) of all buckets with two texts or more. What is counted by key is
    written before it is joined, here and below: a join of two shuffles can be split where
    a key is hot, one with an aggregation on a side cannot."""
    rows = bands.select("node", F.posexplode("bands").alias("band", "hash"))
    rows = rows.select("node", F.xxhash64("band", "hash").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return stored(rows.join(stored(sizes, "sizes"), "key"), "shared-buckets")


def centre_pairs(shared):
    """(a, b, places): every text with the centres of its buckets, each pair once, and the
    number of places that the centre is copied to. The centre is the text with the most
    neighbours over all its buckets, and in a bucket of copies of one text that text."""
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = shared.join(degrees, "node").select("key", F.struct("degree", "node").alias("rank"))
    centres = ranked.groupBy("key").agg(F.max("rank").alias("rank"))
    centres = centres.select(
        "key",
        F.col("rank.node").alias("centre"),
        F.ceil(F.col("rank.degree") / MATES).cast("int").alias("places"),
    )
    pairs = shared.select("key", "node").join(stored(centres, "centres"), "key")
    return pairs.where("node != centre").select(
        F.least("node", "centre").alias("other"),
        F.greatest("node", "centre").alias("mate"),
        "node",
        "centre",
        "places",
    ).dropDuplicates(["other", "mate"]).select(
        F.col("node").alias("a"), F.col("centre").alias("b"), "places"
    )


def texts_of(docs, nodes):
    """(node, text) of the given nodes, once each. A Bloom filter keeps other texts out of
    the shuffle."""
    hits = possible_hits(docs.select("node", "text"), "node", nodes, block_count(nodes.count()))
    # Copies of a text are brought together in each task, before the shuffle.
    single = hits.groupBy("node").agg(F.first("text").alias("text"))
    return stored(single.join(nodes, "node", "left_semi"), "texts")


def verified(pairs, texts, idf, threshold):
    """The pairs (a, b) whose weighted Jaccard similarity reaches the threshold. A centre
    b with many mates is copied to its places, and its pairs are dealt to them."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    pairs = stored(pairs, "pairs")
    met = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    met = met.withColumn("place", F.pmod(F.xxhash64("a"), F.col("places")).cast("int"))
    centres = pairs.groupBy("b").agg(F.max("places").alias("places")).join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b"
    )
    every = F.explode(F.sequence(F.lit(0), F.col("places") - 1))
    met = met.join(centres.select("b", "b_text", every.alias("place")), ["b", "place"])

    def compare(batches):
        last, right = None, None
        for batch in batches:
            for part, lefts in _texts(batch, "a_text"):
                keep = []
                nodes, rights = part.column("b").to_pylist(), part.column("b_text")
                for place, shingles in enumerate(shingle_arrays(lefts)):
                    if nodes[place] != last:
                        last = nodes[place]
                        right = weighted(next(shingle_arrays([rights[place].as_py()])), shared.value)
                    left = weighted(shingles, shared.value)
                    keep.append(similarity(left, right) >= threshold - TOLERANCE)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return met.select("a", "b", "a_text", "b_text").mapInArrow(releasing(compare), "a binary, b binary")


def open_buckets(shared, classes):
    """(key, size, node, class, asks) of the buckets of three texts or more whose texts
    are in several classes; `asks` for texts outside the bucket's largest class. In a
    bucket of two, the only pair has been compared."""
    rows = shared.where(F.col("size") > 2).join(classes, "node", "left")
    rows = stored(rows.withColumn("class", F.coalesce("component", "node")).drop("component"), "open")
    counted = rows.groupBy("key", "class").agg(F.count(F.lit(1)).alias("rows"))
    largest = counted.groupBy("key").agg(
        F.count(F.lit(1)).alias("classes"), F.max(F.struct("rows", "class"))["class"].alias("largest")
    )
    largest = stored(largest.where(F.col("classes") > 1).drop("classes"), "largest")
    return rows.join(largest, "key").withColumn("asks", F.col("class") != F.col("largest"))


def tile_links(nodes, classes, sketches, askers, threshold):
    """Links between texts of different classes in one tile: for each asker and class the
    most similar text, if it reaches the threshold. `askers` are row numbers."""
    hashes = np.concatenate([h for h, _ in sketches])
    weights = np.concatenate([w for _, w in sketches])
    owners = np.repeat(np.arange(len(sketches)), [len(h) for h, _ in sketches])
    order = np.argsort(hashes, kind="stable")
    hashes, weights, owners = hashes[order], weights[order], owners[order]
    sums = np.array([w.sum() for _, w in sketches])
    out = []
    for asker in askers:
        own, own_weights = sketches[asker]
        low = np.searchsorted(hashes, own, "left")
        count = np.searchsorted(hashes, own, "right") - low
        ends = np.cumsum(count)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - count), count)
        common = np.bincount(
            owners[at], np.minimum(weights[at], np.repeat(own_weights, count)), len(sketches)
        )
        likeness = common / np.maximum(sums + sums[asker] - common, 1e-300)
        near = np.flatnonzero((likeness >= threshold - TOLERANCE) & (classes != classes[asker]))
        best = {}
        for row in near[np.argsort(-likeness[near], kind="stable")]:
            best.setdefault(classes[row], row)
        out.extend((nodes[asker], nodes[row]) for row in best.values())
    return out


def remaining_links(opened, texts, idf, threshold, block=BLOCK):
    """Links (a, b) between classes in open buckets. The texts of a bucket are dealt into
    blocks, and each block of askers meets each block of texts in a task of its own."""
    shared = opened.sparkSession.sparkContext.broadcast(idf)
    parts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node", "key"), parts).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = opened.withColumn("parts", parts).withColumn("own", own)
    asking = dealt.where("asks").select("key", "node", "class", F.lit(True).alias("asks"), F.col("own").alias("row"), F.explode(every).alias("column"))
    asked = dealt.select("key", "node", "class", F.lit(False).alias("asks"), F.explode(every).alias("row"), F.col("own").alias("column"))
    # Only rows of tiles that somebody asks in.
    busy = asking.select("key", "row").distinct()
    asked = asked.join(busy, ["key", "row"], "left_semi")
    rows = asking.unionByName(asked).join(texts, "node")

    def compare(key, table):
        nodes, classes = table["node"].to_pylist(), table["class"].to_pylist()
        asks = np.array(table["asks"].to_pylist(), bool)
        sketches = [weighted(s, shared.value) for s in shingle_arrays(table["text"].to_pylist())]
        named = {c: n for n, c in enumerate(sorted(set(classes)))}
        numbers = np.array([named[c] for c in classes])
        links = tile_links(nodes, numbers, sketches, np.flatnonzero(asks), threshold)
        links = [(a, b) for a, b in links if a != b]
        return pa.table(
            {
                "a": pa.array([a for a, _ in links], pa.binary()),
                "b": pa.array([b for _, b in links], pa.binary()),
            }
        )

    return rows.groupBy("key", "row", "column").applyInArrow(compare, "a binary, b binary")


def with_node(docs, id, text):
    """(id, text, node): equal texts have one node; a null text is empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id).alias("id"), whole.alias("text"), F.unhex(F.md5(whole)).alias("node")
    )


def text_classes(docs, threshold=THRESHOLD):
    """(node, class) for every distinct text of `docs` (columns node and text); a class
    is named by one of its nodes."""
    idf = bucket_weights(docs)
    signed = band_keys(docs, idf).where(F.size("bands") > 0)
    bands = stored(signed.groupBy("node").agg(F.first("bands").alias("bands")), "bands")
    shared = shared_buckets(bands)
    texts = texts_of(docs, stored(shared.select("node").distinct(), "nodes"))
    links = stored(verified(centre_pairs(shared), texts, idf, threshold), "verified")
    classes = components(links)
    opened = stored(open_buckets(shared, classes), "opened")
    more = stored(remaining_links(opened, texts, idf, threshold), "more-links")
    # The links that are left connect whole classes.
    named = opened.select("node", "class").distinct()
    between = (
        more.join(named.select(F.col("node").alias("a"), F.col("class").alias("a_class")), "a")
        .join(named.select(F.col("node").alias("b"), F.col("class").alias("b_class")), "b")
        .select(F.col("a_class").alias("a"), F.col("b_class").alias("b"))
    )
    merged = components(between).select(
        F.col("node").alias("first_class"), F.col("component").alias("merged")
    )
    every = docs.select("node").distinct().join(classes, "node", "left")
    every = every.withColumn("first_class", F.coalesce("component", "node"))
    every = every.join(merged, "first_class", "left")
    return every.select("node", F.coalesce("merged", "first_class").alias("class"))


def near_duplicates(docs, threshold=THRESHOLD, id="doc_id", text="text"):
    """(id, class_id) of every document: the least id of its class.

    Equal texts are in one class; texts without words are in a class only with their
    equals. Null texts count as empty. A class whose ids are all null has a null
    class_id. Repeated rows come out as often as they occur; other columns are ignored.
    """
    docs = with_node(docs, id, text)
    # Copies of one text are summed up before classes are.
    least = docs.groupBy("node").agg(F.min("id").alias("least"))
    least = stored(least.join(text_classes(docs, threshold), "node"), "classes")
    ids = least.groupBy("class").agg(F.min("least").alias("class_id"))
    named = least.join(ids, "class").select("node", "class_id")
    return docs.join(named, "node").select(F.col("id").alias(id), "class_id")


def deduplicate(docs, threshold=THRESHOLD, id="doc_id", text="text"):
    """One row of each class of near-duplicates, with all its columns: the one with the
    least id, rows without an id only where no other is. Of rows with that id and the same
    text, the one whose columns hash lowest, whatever the order of the rows."""
    keyed = with_node(docs, id, text)
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id"))
    least = stored(
        keyed.groupBy("node").agg(first.alias("first")).join(text_classes(keyed, threshold), "node"),
        "classes",
    )
    kept = least.groupBy("class").agg(F.min(F.struct("first", "node")).alias("kept"))

    def row_key(of_node, of_id):
        known = F.coalesce(of_id.cast("string"), F.lit("null"))
        return F.md5(F.concat_ws(":", F.hex(of_node), known))

    (name,) = free_names(docs, "kept")
    kept = kept.select(row_key(F.col("kept.node"), F.col("kept.first.id")).alias(name))
    node = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    rows = docs.withColumn(name, row_key(node, F.col(id)))
    rows = rows.join(kept, name, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = rows.groupBy(name).agg(F.min_by(whole, F.md5(F.to_json(whole))).alias("whole"))
    return one.select("whole.*")
