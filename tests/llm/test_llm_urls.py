from llm_tables import found
from pyspark.sql import functions as F

from shelftrace.llm import url_filter
from shelftrace.llm.queries import URL_RULES

URLS = [
    "http://a.example.net/en/1.html",
    "http://A.Example.NET/de/1",
    "https://example.com/de/x?y#z",
    "https://notexample.com/de/x",
    "https://x.org/fr/1/",
    "https://x.org/en/1/",
    "https://x.org/en/1.html?utm=1",
    "http://x.org/en/1#top",
    "ftp://net",
    "http://net/",
    "no url",
    "",
    None,
    "http://x.org",
    "a://b://c/d",
    "http://x.org/en/2",
    "http://x.org/en/2",
]


def judge(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end].lower(), rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [
        r for r in URL_RULES
        if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])
    ]
    if fits:
        best = max(fits, key=lambda r: len(r[0] + r[1]))
        return host, path, best[0] + best[1], best[2]
    short = path.removesuffix(".html") if path.endswith(".html") else path.removesuffix("/")
    return host, path, None, "block" if host and host + short in listed else "allow"


def test_verdicts(spark):
    listed = {"x.org/en/1", "b:", "x.org", "elsewhere.org/a"}
    pages = spark.createDataFrame(
        [(i if i else None, u, "c", "v") for i, u in enumerate(URLS)],
        "page_id long, url string, canonical string, verdict string",
    )
    table = spark.createDataFrame([(u,) for u in [*listed, None, "x.org"]], "u string")
    got = found(url_filter.judge_urls(pages, table, URL_RULES))
    want = [(i if i else None, *judge(u, listed)) for i, u in enumerate(URLS)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string")
    nothing = spark.createDataFrame([], "u string")
    assert found(url_filter.judge_urls(pages, nothing, URL_RULES)) == [
        (1, "x.org", "/a", None, "allow")
    ]
    assert found(url_filter.judge_urls(pages.limit(0), nothing, URL_RULES)) == []


def test_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = url_filter.block_count(2000)
    passed = {r[0] for r in found(url_filter.possible_hits(rows, "key", keys, blocks))}
    assert passed >= {f"k{i}" for i in range(2000)}
    assert len(passed) < 2000 + 18000 * 0.02


def test_a_full_filter_changes_no_result(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    keys = rows.where("key < 'k3'")
    tight = url_filter.possible_hits(rows, "key", keys, 1).join(keys, "key", "left_semi")
    assert tight.count() == keys.count()


def test_block_number_is_bounded():
    assert url_filter.block_count(0) == 1
    assert url_filter.block_count(10**12) == url_filter.MAX_BLOCKS
