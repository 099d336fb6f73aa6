"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

Every document has a fingerprint of 64 bits. Distinct fingerprints are compared tile
against tile with exclusive or and bit counts, and tiles whose population counts differ
beyond the radius are skipped. Tiles are cut within blocks of fingerprints that agree in
one of radius + 1 bands of bits: of that many bands, a pair within the radius leaves one
untouched, so each such pair meets in a block. A block that outgrows a task is dealt into
tiles by population count, and each pair of tiles that may hold a link is a task's work.
"""

from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from shelftrace.llm.common import words_of
from shelftrace.llm.components import components
from shelftrace.sources.shared import stored

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
# Shingles of a document that are held at once, and documents.
SHINGLES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 2048
# Fingerprints of a block that make a task's tile, and of a tile compared at once.
BLOCK = 4096
TILE = 512
# Blocks up to this size are compared many at a time.
SMALL = 32

digest = partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_hashes(words):
    """Hashes of all shingles, repeats included, some at a time."""
    if 0 < len(words) < SHINGLE:
        yield np.array([digest(b" ".join(words))], np.uint64)
        return
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(SHINGLE))))
    left = max(0, len(words) - SHINGLE + 1)
    while left:
        count = min(left, SHINGLES_AT_ONCE)
        yield np.fromiter(map(digest, islice(shingles, count)), np.uint64, count)
        left -= count


def fingerprint(text):
    """Bits that are set in over half of the shingles' hashes; 0 without words."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(words_of(text)):
        total += len(hashes)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs):
    """(fp, ids): the documents (id, text) by fingerprint. Rows of a batch with the same
    fingerprint come as one, so no fingerprint holds many rows of what follows."""
    kind = dict(docs.dtypes)["id"]

    def scan(batches):
        for whole in batches:
            prints = np.array([fingerprint(t.as_py()) for t in whole.column("text")], np.int64)
            order = np.argsort(prints, kind="stable")
            own, first = np.unique(prints[order], return_index=True)
            bounds = np.append(first, len(prints)).astype(np.int32)
            ids = whole.column("id").take(pa.array(order))
            lists = pa.ListArray.from_arrays(pa.array(bounds), ids)
            for start in range(0, len(own), ROWS_AT_ONCE):
                part = slice(start, start + ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([pa.array(own[part]), lists[part]], names=["fp", "ids"])

    return docs.mapInArrow(scan, f"fp long, ids array<{kind}>")


def blocked(prints, radius=RADIUS, block=BLOCK):
    """(unit, fp): every fingerprint in each block that it belongs to; in a block of more
    than `block` of them, in each pair of tiles that its own tile is part of. Two levels
    of population counts that are not neighbours hold no pair within the radius."""
    width = -(-BITS // (radius + 1))
    bands = [
        F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << width) - 1).alias("bits"))
        for i in range(radius + 1)
    ]
    rows = prints.select("fp", F.inline(F.array(*bands))).withColumn(
        "level", F.floor(F.bit_count("fp") / (radius + 1)).cast("int")
    )
    keys = ["band", "bits"]
    counts = rows.groupBy(*keys, "level").agg(F.count(F.lit(1)).alias("rows"))
    tiles = F.struct("level", F.ceil(F.col("rows") / block).cast("int").alias("tiles"))
    # A block has as many entries as there are levels, at most.
    large = (
        counts.groupBy(*keys)
        .agg(F.sum("rows").alias("rows"), F.map_from_entries(F.collect_list(tiles)).alias("tiles"))
        .where(F.col("rows") > block)
        .drop("rows")
    )

    def name(level, tile, other, beside):
        return F.concat_ws(".", *(x.cast("string") for x in (level, tile, other, beside)))

    def places(level):
        count = F.coalesce(F.try_element_at("tiles", level), F.lit(0))
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    own, level = F.col("tile"), F.col("level")
    pairs = F.concat(
        F.transform(places(level), lambda t: name(level, F.least(own, t), level, F.greatest(own, t))),
        F.transform(places(level + 1), lambda t: name(level, own, level + 1, t)),
        F.transform(places(level - 1), lambda t: name(level - 1, t, level, own)),
    )
    dealt = rows.join(large, keys, "left").withColumn(
        "tile", F.pmod(F.xxhash64("fp"), F.try_element_at("tiles", level)).cast("int")
    )
    units = F.when(F.col("tiles").isNull(), F.array(F.lit(""))).otherwise(pairs)
    return dealt.select(*keys, "fp", F.explode(units).alias("pair")).select(
        F.xxhash64(*keys, "pair").alias("unit"), "fp"
    )


class Forest:
    """Trees of linked fingerprints by their places; remembers the links that joined two."""

    def __init__(self, size):
        self.roots = np.arange(size)
        self.links = []

    def find(self, place):
        while self.roots[place] != place:
            place = self.roots[place]
        return place

    def join(self, left, right):
        for a, b in zip(left.tolist(), right.tolist()):
            one, other = self.find(a), self.find(b)
            if one != other:
                self.roots[max(one, other)] = min(one, other)
                self.links.append((a, b))
        self.flatten()

    def flatten(self):
        while True:
            above = self.roots[self.roots]
            if (above == self.roots).all():
                return
            self.roots = above


def near(left, right, radius):
    return np.bitwise_count(left ^ right) <= radius


def linked_small(units, prints, forest, radius):
    """Links inside many small units at once, which lie in a row: each fingerprint with
    the next, the next but one, and so on."""
    for step in range(1, min(SMALL, len(prints))):
        low = np.flatnonzero(units[step:] == units[:-step])
        if not len(low):
            return
        low = low[near(prints[low], prints[low + step], radius)]
        low = low[forest.roots[low] != forest.roots[low + step]]
        if len(low):
            forest.join(low, low + step)


def linked_tiles(start, prints, forest, radius):
    """Links inside one unit, whose fingerprints come in the order of their population
    counts: tile against tile, but for tiles whose counts are too far apart."""
    counts = np.bitwise_count(prints).astype(np.int64)
    for low in range(0, len(prints), TILE):
        for right in range(low, len(prints), TILE):
            end = min(low + TILE, len(prints))
            if counts[right] - counts[end - 1] > radius:
                break
            close = near(prints[low:end, None], prints[None, right : right + TILE], radius)
            while True:
                # Of all links, those between two trees, one for each row at a time: a
                # group of near copies comes together in a few rounds.
                ours = forest.roots[start + low : start + end]
                theirs = forest.roots[start + right : start + right + close.shape[1]]
                close &= ours[:, None] != theirs[None, :]
                rows = np.flatnonzero(close.any(axis=1))
                if not len(rows):
                    break
                forest.join(start + low + rows, start + right + close[rows].argmax(axis=1))


def links_of(units, prints, radius):
    """(a, b) places of links that connect what is within the radius, unit by unit."""
    forest = Forest(len(prints))
    starts = np.flatnonzero(np.diff(units, prepend=units[0] - 1)) if len(units) else np.zeros(0, int)
    sizes = np.diff(starts, append=len(units))
    places = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    inner = Forest(len(places))
    linked_small(units[places], prints[places], inner, radius)
    forest.links += [(places[a], places[b]) for a, b in inner.links]
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        linked_tiles(start, prints[start : start + size], forest, radius)
    return np.array(forest.links, np.int64).reshape(-1, 2)


def near_links(prints, radius=RADIUS, block=BLOCK):
    """(a, b): links that connect the same distinct fingerprints as all pairs within the
    radius do, fewer than there are fingerprints in each unit."""

    def link(batches):
        held = None

        def found(units, prints):
            places = links_of(units, prints, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(prints[places[:, i]].astype(np.int64)) for i in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("unit", "fp")]
            rows[1] = rows[1].astype(np.uint64)
            if held is not None:
                rows = [np.concatenate(c) for c in zip(held, rows)]
            # The last unit may go on in the next batch.
            cut = np.searchsorted(rows[0] != rows[0][-1], False) if len(rows[0]) else 0
            held = [c[cut:] for c in rows]
            if cut:
                yield found(*(c[:cut] for c in rows))
        if held is not None and len(held[0]):
            yield found(*held)

    units = blocked(prints, radius, block).repartition("unit")
    units = units.sortWithinPartitions("unit", F.bit_count("fp"), "fp")
    return units.mapInArrow(link, "a long, b long")


def near_duplicates(docs, id="doc_id", text="text", radius=RADIUS):
    """(id, fingerprint, component_id) of every document.

    Documents link if their fingerprints differ in `radius` bits at most; the component id
    is the least id that links reach, the own one included. A null text is empty; texts
    without words have the fingerprint zero and link like any other. Repeated rows come
    out as often as they occur; rows without an id take part but name no component, so a
    component of such rows alone has a null id. Other columns are ignored; an empty table
    gives an empty result."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    groups = stored(fingerprints(rows), "fingerprints")
    least = groups.groupBy("fp").agg(F.min(F.array_min("ids")).alias("least"))
    linked = components(near_links(groups.select("fp").distinct(), radius))
    linked = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    # A fingerprint without links is a component of its own.
    linked = stored(linked.withColumn("component", F.coalesce("component", "fp")), "linked")
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(smallest, "component").select("fp", "component_id")
    return groups.join(named, "fp").select(
        F.explode("ids").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
