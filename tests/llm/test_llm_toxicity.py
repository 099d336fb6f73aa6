import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_tables import documents, found, no_documents, rows
from pyspark.sql import functions as F

from shelftrace.llm import toxicity
from shelftrace.llm.common import remainder


def maximal(scores):
    """Maximal scoring segments by their recursive definition."""

    def within(low, high):
        best = None
        for a in range(low, high):
            total = 0
            for b in range(a, high):
                total += scores[b]
                if total > 0 and (best is None or total > best[2]):
                    best = (a, b, total)
        if best is None:
            return []
        return within(low, best[0]) + [best] + within(best[1] + 1, high)

    return within(0, len(scores))


def test_segments_are_the_maximal_ones():
    rng = random.Random(6)
    for _ in range(300):
        scores = [rng.choice([-3.1, -1.7, -0.3, 0.9, 2.2, 4.3]) * rng.random() for _ in range(rng.randrange(14))]
        got = toxicity.maximal_segments(scores)
        want = maximal(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_held_out_labels(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet".replace("sf0.001", "sf0.01"))
    labels = spark.read.parquet(f"{small}/labels.parquet".replace("sf0.001", "sf0.01"))
    scored = toxicity.score_documents(docs, labels, remainder("doc_id", 5) != 0)
    held = scored.join(labels, "doc_id").where(remainder("doc_id", 5) == 0)
    table = {(r[0], r[1]): r[2] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert table.get((0, 1), 0) <= 1
    assert table[(1, 1)] >= 2 * table.get((1, 0), 0)


INSULTS = "vile rotten fool"


def lines(n):
    return [
        (i, f"the road number {i} runs along a river " * 6 + (INSULTS if i % 4 == 0 else "calm kind town"))
        for i in range(n)
    ]


def test_passages_are_found(spark):
    docs = spark.createDataFrame(lines(200), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, F.lit(True))
    text = "a calm text of many words " * 30
    new = [(text + "You VILE, rotten fool! " + text,), (text,), (None,), ("",)]
    got = found(toxicity.detect(spark.createDataFrame(new, "text string"), model))
    assert [r[1] >= 0.5 for r in got] == [True, False, False, False]
    first = len(text.split()) + 1
    assert [(p.first, p.last) for p in got[0][2]] == [(first, first + 2)]
    assert got[0][2][0].expected < toxicity.LEAST_EVALUE
    assert [r[2] for r in got[1:]] == [[], [], []]


def test_odd_documents_and_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (8, 0), (9, 0), (99, 1), (None, 1), (10, None)], "doc_id long, toxic int"
    )
    got = found(toxicity.score_documents(documents(spark), labels, F.lit(True)))
    assert len(got) == len(rows())
    assert all(0 <= r[1] <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = found(toxicity.score_documents(documents(spark), labels, F.lit(True)))
    assert {r[3] for r in got} == {0}
    assert found(toxicity.score_documents(no_documents(spark), labels, F.lit(True))) == []


def mixed_texts(size, seed):
    """Texts of common words; insults in those of label 1, and once in one of label 0."""
    rng = random.Random(seed)
    common = [f"w{n}" for n in range(40)]
    out = []
    for n in range(size):
        words = rng.choices(common, range(40, 0, -1), k=rng.randrange(5, 60))
        toxic = int(n % 3 == 0)
        for _ in range(rng.randrange(1, 6) if toxic else n == 1):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten", "fool"]))
        out.append((n, " ".join(words), toxic))
    return out


def plain_model(table):
    """Scores of words, K and lambda from their definitions, over a list of texts."""
    uses, held = (Counter(), Counter()), (Counter(), Counter())
    for _, text, toxic in table:
        uses[toxic].update(text.split())
        held[toxic].update(set(text.split()))
    every = set(uses[0]) | set(uses[1])

    def odds(word, counts):
        prior = {w: 0.5 + 0.01 * (counts[0][w] + counts[1][w]) for w in every}
        whole = sum(prior.values())
        n = [counts[k][word] + prior[word] for k in (0, 1)]
        all_n = [sum(counts[k].values()) + whole for k in (0, 1)]
        value = math.log(n[1] / (all_n[1] - n[1])) - math.log(n[0] / (all_n[0] - n[0]))
        return value, value / math.sqrt(1 / n[0] + 1 / n[1])

    words = {w: odds(w, uses)[0] for w in every if odds(w, held)[1] >= 3 and odds(w, uses)[0] > 0}
    totals = [sum(uses[k].values()) for k in (0, 1)]
    left = [totals[k] - sum(uses[k][w] for w in words) for k in (0, 1)]
    rest = math.log((left[1] + 0.5) / (totals[1] + 1)) - math.log((left[0] + 0.5) / (totals[0] + 1))
    shares = [(rest, left[0] / totals[0])] + [(s, (uses[0][w] + 0.01) / totals[0]) for w, s in words.items()]
    whole = sum(s for _, s in shares)
    low, high = 1e-6, 50.0
    for _ in range(200):
        middle = (low + high) / 2
        sum_at = sum(share / whole * math.exp(min(middle * s, 700)) for s, share in shares)
        low, high = (middle, high) if sum_at < 1 else (low, middle)
    return words, rest, low


def test_model_and_scores_by_brute_force(spark):
    table = mixed_texts(240, 5)
    docs = spark.createDataFrame([r[:2] for r in table], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in table], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    words, rest, rate = plain_model(table)
    assert {w.decode(): s for w, s in model["words"].items()} == pytest.approx(words)
    assert model["rest"] == pytest.approx(rest) and model["lambda"] == pytest.approx(rate, rel=1e-6)
    segments, largest = {}, []
    for n, text, toxic in table:
        scores = [words.get(w, rest) for w in text.split()]
        segments[n] = maximal(scores)
        if not toxic:
            largest.append(max((s for *_, s in segments[n]), default=0.0))
    level = max(np.quantile(largest, 0.99), 1e-9)
    size = sum(len(t.split()) for _, t, toxic in table if not toxic)
    k = (sum(x >= level for x in largest) + 0.5) / (size + 1) * math.exp(rate * level)
    assert model["k"] == pytest.approx(k)
    evidence = []
    for n, text, _ in table:
        chances = [math.log(k * len(text.split())) - rate * s for *_, s in segments[n]]
        evidence.append(sum(-c for c in chances if c < math.log(0.05)))
    # The curve is where the ridged likelihood is highest: its slope there is nothing.
    x, y = np.log1p(evidence), np.array([r[2] for r in table], float)
    at, by = model["curve"]
    p = 1 / (1 + np.exp(-(at + by * x)))
    assert (y - p).sum() - 1e-3 * at == pytest.approx(0, abs=1e-5)
    assert (x * (y - p)).sum() - 0.1 * by == pytest.approx(0, abs=1e-5)
    got = {r[0]: r[1] for r in found(toxicity.score_documents(docs, labels, F.lit(True)))}
    assert [got[r[0]] for r in table] == pytest.approx(list(p), rel=1e-6)


def test_lambda_on_simulated_texts():
    """Largest segments of chance texts fall off by the rate that is derived."""
    rng = np.random.default_rng(7)
    shares, scores = np.array([0.9, 0.06, 0.04]), np.array([-0.4, 1.0, 1.6])
    rate = toxicity._karlin_lambda(shares, scores)
    largest = []
    for _ in range(6000):
        steps = scores[rng.choice(3, 200, p=shares)]
        sums = np.concatenate([[0.0], np.cumsum(steps)])
        largest.append((sums - np.minimum.accumulate(sums)).max())
    largest = np.array(largest)
    low, high = np.quantile(largest, [0.8, 0.99])
    # Of an extreme-value law, -log(1 - share above) falls by the rate.
    above = [-math.log1p(-(largest >= x).mean()) for x in (low, high)]
    assert math.log(above[0] / above[1]) / (high - low) == pytest.approx(rate, rel=0.2)
