"""Ranked lexical search the other way round: the items are indexed, the documents stream.

The items' terms make an inverted index that every task gets. Documents are read once to
counts of those terms, which give the corpus statistics; the counts then stream through
the index. A task keeps a heap of the best documents for each item, of fixed size, and
only the heaps meet in a shuffle.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.llm.common import batch_of
from shelftrace.sources.shared import stored

# Postings that one index may hold, so that its size is bounded; more items make more
# indexes, and the documents stream through each. Only a single item may hold more.
POSTINGS_PER_INDEX = 1 << 20
# Scores that a task holds at once, and documents that wait before heaps are set in order.
SCORES_AT_ONCE = 1 << 19
WAITING = 1 << 15
PER_BATCH = 2048

# Of the score.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75

# Letters and digits of ASCII, A-Z in lower case, and all bytes of other characters are
# part of a term; every other byte separates terms.
FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms_of(text):
    """Terms of a text as bytes; a null has none."""
    return text.encode("utf-8", "surrogatepass").translate(FOLDED).split() if text else []


def item_terms(items, id, text):
    """(item_id, copy, term, uses) of the distinct items; different texts of one id are
    numbered as its copies."""
    rows = items.select(F.col(id).alias("item_id"), F.col(text).alias("text")).distinct()
    copy = F.row_number().over(Window.partitionBy("item_id").orderBy("text"))
    rows = rows.withColumn("copy", copy)
    kind = dict(rows.dtypes)["item_id"]

    def count(batches):
        for batch in batches:
            index, terms, uses = [], [], []
            for i, value in enumerate(batch.column("text")):
                found = {}
                for term in terms_of(value.as_py()):
                    found[term] = found.get(term, 0) + 1
                index += [i] * len(found)
                terms += found
                uses += found.values()
            for start in range(0, len(index), PER_BATCH):
                part = slice(start, start + PER_BATCH)
                own = batch.select(["item_id", "copy"]).take(pa.array(index[part], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(terms[part], pa.binary()), pa.array(uses[part], pa.int64())],
                    names=["item_id", "copy", "term", "uses"],
                )

    return rows.mapInArrow(count, f"item_id {kind}, copy int, term binary, uses long")


class Index:
    """Postings by term number: items and how often each holds the term."""

    def __init__(self, items):
        """From [(term, uses) of each item]."""
        self.items = len(items)
        places = [(term, i, uses) for i, found in enumerate(items) for term, uses in found]
        self.numbers = {t: n for n, t in enumerate(sorted({t for t, *_ in places}))}
        terms = np.array([self.numbers[t] for t, *_ in places], np.int64)
        order = np.argsort(terms, kind="stable")
        self.holders = np.array([i for _, i, _ in places], np.int64)[order]
        self.uses = np.array([u for *_, u in places], np.int64)[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(self.numbers) + 1))


def indexes(rows):
    """([(item id, copy)], Index) for so many items at a time as an index may hold. The
    rows come item by item, a partition at a time, through the driver: it holds one index."""
    keys, found, size = [], [], 0
    for item, copy, term, uses in rows.orderBy("item_id", "copy").toLocalIterator():
        if not keys or keys[-1] != (item, copy):
            if size >= POSTINGS_PER_INDEX:
                yield keys, Index(found)
                keys, found, size = [], [], 0
            keys.append((item, copy))
            found.append([])
        found[-1].append((bytes(term), uses))
        size += 1
    if keys:
        yield keys, Index(found)


def term_counts(docs, numbers):
    """(doc_id, size, terms, uses) of every document that has a term at all: its number of
    terms with repeats, and those of `numbers` (a broadcast) with their counts."""

    def count(batches):
        known = numbers.value
        schema = pa.schema(
            [("size", pa.int64()), ("terms", pa.list_(pa.int32())), ("uses", pa.list_(pa.int32()))]
        )
        for whole in batches:
            for start in range(0, whole.num_rows, PER_BATCH):
                batch = whole.slice(start, PER_BATCH)
                sizes, terms, uses = [], [], []
                for value in batch.column("text"):
                    every = terms_of(value.as_py())
                    found = {}
                    for number in map(known.get, every):
                        found[number] = found.get(number, 0) + 1
                    found.pop(None, None)
                    sizes.append(len(every))
                    terms.append(list(found))
                    uses.append(list(found.values()))
                made = batch_of(schema, [sizes, terms, uses])
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *made.columns], names=["doc_id", *schema.names]
                )
                yield rows.filter(pc.greater(rows.column("size"), 0))

    return docs.mapInArrow(count, "doc_id long, size long, terms array<int>, uses array<int>")


def holders(counts, size):
    """Documents that hold each term, summed up in the tasks first: a list of `size`."""

    def count(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            numbers = pc.list_flatten(batch.column("terms")).to_numpy(zero_copy_only=False)
            held += np.bincount(numbers, minlength=size)
        used = np.flatnonzero(held)
        for start in range(0, len(used), 1 << 16):
            part = used[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(held[part])], names=["term", "docs"])

    partial = counts.select("terms").mapInArrow(count, "term long, docs long")
    out = [0] * size
    # One row for each term of the index, whose size is bounded.
    for term, docs in partial.groupBy("term").agg(F.sum("docs")).collect():
        out[term] = docs
    return out


def weights(docs, holding):
    """floor(1000 * ln((2N + 2) / (2df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * h + 1))) for h in holding], np.int64)


class Heaps:
    """The `wanted` best documents of each item, as rows (item, score, id, no id). Rows
    wait until there are many, then all items are set in order at once."""

    def __init__(self, items, wanted):
        self.wanted = wanted
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]
        self.waiting, self.held = [], 0
        # What a document must beat: the last place of a full heap.
        self.least = np.zeros(items, np.int64)
        self.last = np.full(items, np.iinfo(np.int64).min)

    def offer(self, scores, ids, missing):
        """Scores of items (rows) by documents (columns)."""
        # A document without an id comes behind all others with its score.
        known = np.where(missing, np.iinfo(np.int64).max, ids)
        better = (scores > self.least[:, None]) | (
            (scores == self.least[:, None]) & (known[None, :] < self.last[:, None])
        )
        item, doc = np.nonzero(better)
        if len(item):
            self.waiting.append([item, scores[item, doc], ids[doc], missing[doc].astype(np.int64)])
            self.held += len(item)
            if self.held >= WAITING:
                self.settle()

    def settle(self):
        if not self.held:
            return self.rows
        rows = [np.concatenate(c) for c in zip(self.rows, *self.waiting)]
        item, score, id, missing = rows
        order = np.lexsort((id, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < self.wanted]
        self.rows = [c[kept] for c in rows]
        self.waiting, self.held = [], 0
        full = order[place == self.wanted - 1]
        self.least[rows[0][full]] = rows[1][full]
        self.last[rows[0][full]] = np.where(rows[3][full] > 0, np.iinfo(np.int64).max, rows[2][full])
        return self.rows


def scores_of(index, weight, terms, uses, sizes, doc_of, total):
    """Scores of every item (rows) for documents (columns) given by their term counts.
    `total` is (documents, terms) of the corpus."""
    docs, words = total
    # Whole numbers of any size: this product may pass 64 bits for a very large corpus.
    length = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(s) * docs // words for s in sizes], np.int64)
    worth = weight[terms] * ((SCALE * uses) // (1000 * uses + SATURATION * length[doc_of]))
    counts = index.starts[terms + 1] - index.starts[terms]
    ends = np.cumsum(counts)
    places = np.repeat(index.starts[terms] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
    out = np.zeros(index.items * len(sizes), np.int64)
    at = index.holders[places] * len(sizes) + np.repeat(doc_of, counts)
    np.add.at(out, at, np.repeat(worth, counts) * index.uses[places])
    return out.reshape(index.items, len(sizes))


def best_documents(counts, index, weight, total, wanted):
    """(item, score, doc_id): the heaps of all tasks. `index` is a broadcast."""

    def stream(batches):
        own = index.value
        heaps = Heaps(own.items, wanted)
        step = max(1, SCORES_AT_ONCE // own.items)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                lists = batch.column("terms")
                terms, uses = (
                    pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                    for c in ("terms", "uses")
                )
                held = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                doc_of = np.repeat(np.arange(batch.num_rows), held)
                ids = batch.column("doc_id")
                scores = scores_of(own, weight, terms, uses, batch.column("size").to_numpy(), doc_of, total)
                heaps.offer(
                    scores,
                    pc.fill_null(ids, 0).to_numpy(zero_copy_only=False),
                    ids.is_null().to_numpy(zero_copy_only=False),
                )
        item, score, id, missing = heaps.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(score), pa.array(id, mask=missing > 0)],
            names=["item", "score", "doc_id"],
        )

    return counts.mapInArrow(stream, "item long, score long, doc_id long")


def search(docs, items, wanted=10, id="doc_id", text="text", item_id="item_id", item_text="text"):
    """(item_id, rank, doc_id, score): the `wanted` best documents with a score above 0 of
    each item, all if there are fewer, ties by smaller id, null ids last.

    Every row of `docs` is a document, repeated rows too; null texts and texts without a
    term are none. Equal rows of `items` are one item; different texts of one id are
    ranked apart; items without a term get no rows. Ids of documents are whole numbers.
    Other columns are ignored. Without documents or items the result is empty."""
    spark = docs.sparkSession
    found = stored(item_terms(items, item_id, item_text), "item-terms")
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = dict(found.dtypes)["item_id"]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for keys, index in indexes(found):
        sent = spark.sparkContext.broadcast(index)
        counts = stored(term_counts(docs, spark.sparkContext.broadcast(index.numbers)), "term-counts")
        total = tuple(counts.agg(F.count(F.lit(1)), F.sum("size")).first())
        weight = weights(total[0], holders(counts, len(index.numbers)))
        heaps = best_documents(counts, sent, weight, total, wanted)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)
        names = spark.createDataFrame(
            [(n, item) for n, (item, _) in enumerate(keys)], f"item long, item_id {kind}"
        )
        out = out.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
