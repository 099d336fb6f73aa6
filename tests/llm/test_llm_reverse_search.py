import math
import random
import re
from collections import Counter

import pytest
from llm_tables import CLASHING, documents, found, no_documents

from shelftrace.llm import reverse_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def expected(docs, items, wanted=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, words = len(counted), sum(size for *_, size in counted)
    held = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for id, c, size in counted:
            m = 25 + 75 * size * n // words
            score = 0
            for t in terms(text):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1)))
                score += weight * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) if c[t] else 0
            if score > 0:
                scores.append((-score, id is None, id or 0, id))
        best = sorted(scores)[:wanted]
        out += [(item, rank, id, -s) for rank, (s, _, _, id) in enumerate(best, 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, wanted=10):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(found(reverse_search.search(docs, items, wanted)), key=repr)


def some(seed, count, long=12):
    random.seed(seed)
    words = ["the", "The", "of", "ünï", "x9", "a-b", "naïve", "日本", *(f"w{i}" for i in range(40))]
    return [(i, " ".join(random.choices(words, k=random.randint(0, long)))) for i in range(count)]


def test_terms_as_defined():
    for text in ["Ab_c d9É!x", "İI", "a b", "", None, "\x7f\x80z", "<|x|>"]:
        assert [t.decode() for t in reverse_search.terms_of(text)] == terms(text)


@pytest.mark.parametrize("wanted", [1, 10, 1000])
def test_best_documents(spark, monkeypatch, wanted):
    monkeypatch.setattr(reverse_search, "WAITING", 7)
    monkeypatch.setattr(reverse_search, "SCORES_AT_ONCE", 64)
    docs = some(1, 150) + [(None, "w1 w2 the"), (None, "w1 w2 the"), (7, None), (8, "..."), (3, "w1"), (3, "w1")]
    docs += [(500 + i, "w1 w2 w3") for i in range(40)]
    items = some(2, 12, 8) + [(3, None), (5, "w1 w1 w1 w2"), (None, "the w3")]
    assert got(spark, docs, items, wanted) == expected(docs, items, wanted)


def test_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(reverse_search, "POSTINGS_PER_INDEX", 10)
    docs, items = some(3, 60), some(4, 15, 8) + [(1, "w1"), (1, "w1"), (1, "w2")]
    assert got(spark, docs, items) == expected(docs, items)


def test_common_cases(spark):
    docs = documents(spark)
    items = [(1, "the house of stones", *CLASHING), (2, "w5 w6 w976", *CLASHING), (3, "中文 WÖRTERN", *CLASHING)]
    items = spark.createDataFrame(items, "item_id long, text string, doc_id long, row long, word string, score double, item string, term string, uses int")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows, [(i, t) for i, t, *_ in items.collect()])
    assert sorted(found(reverse_search.search(docs, items)), key=repr) == want
    assert found(reverse_search.search(no_documents(spark), items)) == []
    assert found(reverse_search.search(docs, items.limit(0))) == []
