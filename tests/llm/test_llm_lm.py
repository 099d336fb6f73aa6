import math
from collections import Counter

import numpy as np
import pytest
from llm_tables import documents, found, no_documents, rows
from pyspark.sql import functions as F

from shelftrace.llm import lattice, lm_scoring
from shelftrace.llm.lattice import Vocabulary, expected_counts, log_likelihoods
from shelftrace.llm.queries import PIECE_FILE

PIECES = ["▁", "▁a", "a", "ab", "b", "▁ab", "bab", "é", ""]


def segmentations(text, pieces):
    if not text:
        yield []
    for number, piece in enumerate(pieces):
        if piece and text.startswith(piece):
            for rest in segmentations(text[len(piece) :], pieces):
                yield [number, *rest]


def test_marginal_is_the_sum_over_all_segmentations():
    vocabulary = Vocabulary(PIECES, [0] * 256)
    scores = np.log(np.arange(1, len(PIECES) + 1) / 50)
    words = ["a", "ab", "abab", "babab", "é", "aé", "b" * 9]
    for word, got in zip(words, log_likelihoods(words, vocabulary, scores)):
        paths = list(segmentations("▁" + word, PIECES))
        assert got == pytest.approx(math.log(sum(math.exp(sum(scores[p])) for p in paths)))


def test_expected_counts_weigh_segmentations():
    vocabulary = Vocabulary(PIECES, [0] * 256)
    scores = np.log(np.arange(1, len(PIECES) + 1) / 50)
    want = np.zeros(len(PIECES))
    for word, count in (("abab", 3), ("ab", 2)):
        paths = list(segmentations("▁" + word, PIECES))
        weights = np.array([math.exp(sum(scores[p])) for p in paths])
        for path, weight in zip(paths, weights / weights.sum()):
            for piece in path:
                want[piece] += count * weight
    got = expected_counts(["abab", "ab"], [3, 2], vocabulary, scores)
    assert got == pytest.approx(want)


def test_characters_without_piece_are_spelled_in_bytes():
    vocabulary = Vocabulary(PIECES, np.arange(256) % len(PIECES))
    scores = np.log(np.arange(1, len(PIECES) + 1) / 50)
    spelled = sum(scores[b % len(PIECES)] for b in "ü".encode())
    assert log_likelihoods(["ü"], vocabulary, scores)[0] == pytest.approx(scores[0] + spelled)


def base(texts, training):
    counts = Counter()
    for text, learn in zip(texts, training):
        if learn:
            counts.update((text or "").encode().lower().split() + [None])
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for text in texts:
        words = (text or "").encode().lower().split() + [None]
        score = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        out.append((len(words), sum(counts[w] > 0 for w in words), total, score))
    return out


@pytest.mark.parametrize("frequent", [4, 1 << 17])
def test_scores_of_odd_documents(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT_WORDS", frequent)
    docs = documents(spark)
    got = found(lm_scoring.score_documents(docs, PIECE_FILE, F.col("doc_id") % 3 != 0))
    ids, texts = [r[0] for r in rows()], [r[1] for r in rows()]
    want = base(texts, [i is not None and i % 3 != 0 for i in ids])
    key = lambda r: (-1 if r[0] is None else r[0], r[1], r[2])
    got = sorted(got, key=key)
    want = sorted([(i, *w) for i, w in zip(ids, want)], key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want])
    assert all(r[5] < 0 for r in got)


def test_no_documents(spark):
    docs = no_documents(spark)
    assert found(lm_scoring.score_documents(docs, PIECE_FILE, F.lit(True))) == []


def test_held_out_text_is_likelier_than_scrambled_text(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    held = docs.where("doc_id % 7 = 2")
    turned = held.select((-F.col("doc_id") - 1).alias("doc_id"), F.reverse("text").alias("text"))
    scored = lm_scoring.score_documents(
        docs.unionByName(turned), PIECE_FILE, (F.col("doc_id") >= 0) & (F.col("doc_id") % 7 != 2)
    )
    means = {r[0]: r[1] for r in scored.groupBy(F.col("doc_id") < 0).agg(F.sum("score") / F.sum("n_tokens")).collect()}
    assert means[False] > means[True]


@pytest.mark.parametrize("window", [1 << 16, 7])
def test_long_words_are_scored_like_others(monkeypatch, window):
    vocabulary = Vocabulary(PIECES, np.arange(256) % len(PIECES))
    scores = np.log(np.arange(1, len(PIECES) + 1) / 50)
    words = ["a", "ab" * 40, "bab" * 30, "üab" * 25, "b" * 70, "éü日" * 20]
    counts = [1, 2, 1, 3, 1, 2]
    want = log_likelihoods(words, vocabulary, scores), expected_counts(words, counts, vocabulary, scores)
    monkeypatch.setattr(lattice, "LONG_WORD", 10)
    monkeypatch.setattr(lattice, "WINDOW", window)
    assert log_likelihoods(words, vocabulary, scores) == pytest.approx(want[0])
    assert expected_counts(words, counts, vocabulary, scores) == pytest.approx(want[1])


def test_a_word_of_fifty_thousand_characters_takes_no_seconds():
    import random
    import time

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    vocabulary = Vocabulary(pieces, [0] * 256)
    scores = np.log(np.full(len(pieces), 1 / len(pieces)))
    random.seed(2)
    word = "".join(random.choices("etaoinshrdlu", k=50_000))
    start = time.process_time()
    score = log_likelihoods([word], vocabulary, scores)[0]
    assert math.isfinite(score) and time.process_time() - start < 2
