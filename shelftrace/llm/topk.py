"""Exact top-k inner products, by an impact-ordered index read score at a time.

Candidates and queries are dealt into blocks, and every pair of blocks is a task: the
candidates' block is indexed by component and quantised level. Queries read the index in
segments of falling levels, many queries at a time, and add quantised impacts up. A query
stops only once the bound on what is still unread of each row proves that all but a few
candidates are out, and scores those few exactly. The best of all blocks are ranked per
query.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelftrace.sources.shared import stored

SCALE = 256
CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 1024
LEVELS = 64
# Queries that read segments together: their sums fill some megabytes.
QUERIES_AT_ONCE = 64
# Whole numbers up to here are exact as doubles.
MOST = 2.0**53


class ImpactIndex:
    """Postings of a block: the quantised level of each component of each row, counted from
    the least and from the greatest value of the component."""

    def __init__(self, vectors):
        self.vectors = vectors
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low + 1) // LEVELS))
        self.upward = ((vectors - self.low) // self.step).astype(np.uint8)
        self.downward = ((self.high - vectors) // self.step).astype(np.uint8)
        # Sums of products of whole numbers are exact as doubles while they fit 53 bits.
        self.reach = np.maximum(np.abs(self.low), np.abs(self.high)).astype(np.float64) + self.step
        self.exact = vectors.astype(np.float64)

    def products(self, rows, query):
        if float(self.reach @ np.abs(query)) < MOST:
            return (self.exact[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ query

    def search(self, queries, wanted):
        """(rows, exact scores) for each query: rows that may be among its `wanted` best,
        all that are, ties included."""
        for start in range(0, len(queries), QUERIES_AT_ONCE):
            yield from self._search(queries[start : start + QUERIES_AT_ONCE], wanted)

    def _search(self, queries, wanted):
        """Many queries read the segments together, from the highest level down.

        A query's score is a base, its weight times step and level for each component, and
        what quantising took. After a segment the rows that lead are scored exactly: no row
        below the `wanted`-th of these scores is among the best. A row is out once its sum
        and all that is unread of it prove it to be below; a query stops once few are left.
        """
        rows = len(self.vectors)
        limit = max(8 * wanted, rows // 8)
        leading = min(rows, max(32, 4 * wanted))
        possible = [np.arange(rows)] * len(queries)
        fits = np.abs(queries).astype(np.float64) @ self.reach < MOST
        open_queries = np.flatnonzero(fits & queries.any(axis=1)) if rows > limit else np.zeros(0, int)
        units = np.abs(queries) * self.step.astype(np.float64)
        base = np.where(queries > 0, queries * self.low, queries * self.high).sum(axis=1, dtype=np.float64)
        lost = (np.abs(queries) * (self.step - 1)).sum(axis=1, dtype=np.float64)
        least = np.full(len(queries), -np.inf)
        sums, top = np.zeros((len(open_queries), rows)), LEVELS
        while len(open_queries) and top > 1:
            level = top // 2
            own = units[open_queries]
            read = np.zeros_like(sums)
            for levels, signs in ((self.upward, queries > 0), (self.downward, queries < 0)):
                weights = np.where(signs[open_queries], own, 0.0)
                seen = levels >= level
                segment = np.where(seen & (levels < top), levels, 0).astype(np.float64)
                sums += weights @ segment.T
                read += weights @ seen.T.astype(np.float64)
            # A component of a row that is not read yet has a lower level.
            rest = (level - 1) * (own.sum(axis=1)[:, None] - read) + lost[open_queries][:, None]
            bound = sums + rest + base[open_queries][:, None]
            leaders = np.argpartition(sums, rows - leading, axis=1)[:, rows - leading :]
            going = np.ones(len(open_queries), bool)
            for i, number in enumerate(open_queries):
                scores = self.products(leaders[i], queries[number])
                least[number] = max(least[number], np.partition(scores, leading - wanted)[leading - wanted])
                possible[number] = np.flatnonzero(bound[i] >= least[number])
                going[i] = len(possible[number]) > limit
            open_queries, sums, top = open_queries[going], sums[going], level
        for query, found in zip(queries, possible):
            yield found, self.products(found, query)


def best_of(ids, copies, vectors, query_ids, query_copies, queries, wanted):
    """(query id, query copy, id, score) of the best candidates of each query, not itself."""
    index = ImpactIndex(vectors)
    out = []
    # One more than wanted, for the query itself may be among them.
    found = index.search(queries, min(wanted + 1, len(ids)))
    for own, copy, (rows, scores) in zip(query_ids, query_copies, found):
        other = (ids[rows] != own) | (copies[rows] != copy)
        rows, scores = rows[other], scores[other]
        best = np.lexsort((ids[rows], -scores))[:wanted]
        out.append((np.full(len(best), own), np.full(len(best), copy), ids[rows[best]], scores[best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [[], [], [], []]


def _matrix(column, width):
    """Lists as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)
    values = values[column.offsets[0].as_py() : column.offsets[len(column)].as_py()]
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def scaled_vectors(rows, id, vector, scale=SCALE):
    """(id, copy, vector of long): each component floor(scale * x). Vectors that are null or
    hold a null or a value that is not finite are left out, null ids too; rows of one id
    and vector are one, different vectors of one id are numbered as its copies."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(values, lambda x: F.floor(x * scale).cast("long"))
    good = rows.where(F.col(id).isNotNull() & F.col(vector).isNotNull() & ~odd)
    rows = good.select(F.col(id).cast("long").alias("id"), whole.alias("vector"))
    rows = rows.dropDuplicates(["id", "vector"])
    copy = F.row_number().over(Window.partitionBy("id").orderBy("vector")).cast("long")
    return rows.select("id", copy.alias("copy"), "vector")


def top_products(vectors, queries, wanted):
    """(query_id, rank, vec_id, score) for each query of a table (id, copy, vector)
    against all other rows of another: the `wanted` highest inner products, all if there are fewer, ties
    by smaller id. A missing component counts as zero. Products are whole numbers as
    long as they fit 63 bits."""
    rows, asked = vectors.count(), queries.count()
    blocks = max(1, -(-rows // CANDIDATES_PER_BLOCK))
    groups = max(1, -(-asked // QUERIES_PER_BLOCK))

    def dealt(table, own, parts, other):
        place = F.pmod(F.xxhash64("id", "copy", F.lit(own)), F.lit(parts)).cast("int")
        return table.withColumns(
            {own: place, other[0]: F.explode(F.sequence(F.lit(0), F.lit(other[1] - 1)))}
        ).select("id", "copy", "vector", "block", "query_block")

    candidates = dealt(vectors, "block", blocks, ("query_block", groups))
    askers = dealt(queries, "query_block", groups, ("block", blocks))

    def search(key, left, right):
        found = [[], [], [], []]
        if left.num_rows and right.num_rows:
            width = max(1, *(pc.max(pc.list_value_length(t["vector"])).as_py() for t in (left, right)))
            found = best_of(
                left["id"].to_numpy(),
                left["copy"].to_numpy(),
                _matrix(left["vector"], width),
                right["id"].to_numpy(),
                right["copy"].to_numpy(),
                _matrix(right["vector"], width),
                wanted,
            )
        return pa.table(
            {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "copy", "vec_id", "score"), found)}
        )

    tiles = ["block", "query_block"]
    found = (
        candidates.groupBy(*tiles)
        .cogroup(askers.groupBy(*tiles))
        .applyInArrow(search, "query_id long, copy long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")


def search(rows, is_query, wanted=5, id="vec_id", vector="embedding", scale=SCALE):
    """The best `wanted` of all other rows for each row where `is_query` (a column over
    `id`) holds. See scaled_vectors for the rows that take part. An empty table gives an
    empty result; other columns are ignored."""
    vectors = stored(scaled_vectors(rows, id, vector, scale), "vectors")
    return top_products(vectors, vectors.where(is_query), wanted)
