import hashlib
import re

from llm_tables import documents, found, no_documents

from shelftrace.llm import fill_middle


def expected(id, text):
    """(n, form, prefix, middle, output) by slicing."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    first, second = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    prefix, middle, suffix = ("".join(t) for t in (tokens[:first], tokens[first:second], tokens[second:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, rows, schema="doc_id long, text string, n long, restored string"):
    table = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], schema)
    made = fill_middle.restore(fill_middle.transform(table))
    got = found(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"))
    want = [(i, *expected(i, t), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return {row[2] for row in got}


ODD = [
    "", None, "a", " ", "ab cd", "é", "日本語 text 😀 mixed", "<P>", "a<S>b", "a <M", "<", "<<<", "P>", "<P", "ß" * 7,
    "<S <M <P x>", "tail<", "word" * 50, "\n\n\t", "A1b2C3",
]


def test_every_cut_and_form(spark):
    rows = [(i, ODD[i % len(ODD)]) for i in range(600)] + [(None, "no id"), (3, "x y z"), (3, "x y z")]
    assert check(spark, rows) == {"plain", "psm", "spm"}


def test_windows_and_slices_meet(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "WINDOW", 7)
    monkeypatch.setattr(fill_middle, "BYTES_AT_ONCE", 40)
    check(spark, [(i, " ".join(f"wörd{j}" for j in range(i % 30))) for i in range(120)])


def test_common_cases(spark):
    docs = documents(spark)
    made = fill_middle.restore(fill_middle.transform(docs))
    got = found(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"))
    want = [(r.doc_id, *expected(r.doc_id, r.text), r.text or "") for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert found(fill_middle.restore(fill_middle.transform(no_documents(spark)))) == []
