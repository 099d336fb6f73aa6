import math
import random

import numpy as np
import pytest
from llm_tables import found
from pyspark.sql import functions as F

from shelftrace.llm import topk


def best(vectors, ids, wanted):
    out = []
    for query in ids:
        scores = sorted(
            (-sum(a * b for a, b in zip(vectors[query], vectors[i])), i) for i in vectors if i != query
        )
        out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:wanted], 1)]
    return out


@pytest.mark.parametrize("together", [64, 2])
def test_index_finds_the_best_of_any_block(monkeypatch, together):
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", together)
    random = np.random.default_rng(3)
    for kind in range(6):
        vectors = random.integers(-90, 90, (3000, 16))
        if kind == 1:
            vectors = np.abs(vectors)
        if kind == 2:
            vectors[500:2500] = vectors[7]
        if kind == 3:
            vectors[:, 3] = 0
        if kind == 4:
            vectors = vectors // 60
        if kind == 5:
            vectors = vectors * 10**8
        index = topk.ImpactIndex(vectors)
        queries = np.array([*vectors[:8], np.zeros(16, int)])
        for query, (rows, scores) in zip(queries, index.search(queries, 6), strict=True):
            exact = vectors @ query
            sixth = np.sort(exact)[-6]
            assert set(np.flatnonzero(exact >= sixth)) <= set(rows)
            assert (exact[rows] == scores).all()
            # Most rows are ruled out without their exact score.
            assert kind in (2, 4, 5) or not query.any() or len(rows) <= 3000 // 8


def test_blocks_ties_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    random.seed(5)
    rows = [(i, [random.choice([-0.5, 0.0, 0.25, 0.125]) for _ in range(4)]) for i in range(150)]
    rows += [(3, rows[3][1]), (200, [0.5]), (201, []), (202, [0.5, 0.5, 0.5, 0.5, 0.5])]
    odd = [(300, None), (301, [None, 0.1]), (302, [math.nan]), (303, [math.inf]), (None, [0.1])]
    table = spark.createDataFrame(
        [(i, v, 9, 9) for i, v in rows + odd], "vec_id long, embedding array<float>, rank int, block int"
    )
    got = found(topk.search(table, F.col("id") % 50 == 0))
    vectors = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    assert sorted(got) == sorted(best(vectors, [0, 50, 100, 200], 5))


def test_few_or_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    got = found(topk.search(table, F.col("id") % 50 == 0))
    assert sorted(got) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert found(topk.search(table.limit(0), F.col("id") % 50 == 0)) == []
    assert found(topk.search(table.where("vec_id = 0"), F.col("id") % 50 == 0)) == []


@pytest.mark.parametrize("wanted", [1, 300])
def test_any_number_wanted(spark, wanted):
    rows = [(i, [float(i % 7), float(-i % 5)]) for i in range(120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(topk.search(table, F.col("id") % 50 == 0, wanted))
    vectors = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    assert sorted(got) == sorted(best(vectors, [0, 50, 100], wanted))


def test_different_vectors_of_one_id_all_take_part(spark):
    rows = [(50, [1.0]), (50, [3.0]), (50, [3.0]), (7, [2.0]), (7, [5.0]), (8, [4.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(topk.search(table, F.col("id") % 50 == 0, 4))
    one, best = 256 * 256, [(7, 5), (8, 4), (50, 3), (7, 2)]
    want = [(50, rank, i, x * one) for rank, (i, x) in enumerate(best, 1)]
    best = [(7, 5), (8, 4), (7, 2), (50, 1)]
    want += [(50, rank, i, 3 * x * one) for rank, (i, x) in enumerate(best, 1)]
    assert sorted(got) == sorted(want)
