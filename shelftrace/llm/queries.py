"""The queries of the numbered operators, each over its whole table."""

from pyspark.sql import functions as F

from shelftrace.llm import (
    bpe,
    fill_middle,
    html_extract,
    langid,
    lm_scoring,
    mixing,
    near_dedup,
    reverse_search,
    simhash,
    spotsigs,
    topk,
    toxicity,
    url_filter,
)
from shelftrace.llm.common import remainder, table

QUERIES = {}

TOKENIZERS = "/opt/tokenizers"
PIECE_FILE = f"{TOKENIZERS}/piece_bpe_32k.model"
WORD_BPE_FILE = f"{TOKENIZERS}/word_bpe_49k.json"


def query(function):
    QUERIES[function.__name__] = function
    return function


def held_out(modulus, value):
    return (remainder("doc_id", modulus) == value).alias("held_out")


@query
def op1_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = lm_scoring.score_documents(docs, PIECE_FILE, remainder("doc_id", 7) != 2)
    return scored.withColumn("held_out", held_out(7, 2))


@query
def op2_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    decoded = bpe.encode_documents(docs, WORD_BPE_FILE, decode=True)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# Hosts with one of these in their name make the list of blocked URLs.
LISTED_HOSTS = ["ads-track", "casino-win", "spam-farm"]


def listed_urls(pages):
    """Canonical URLs of the pages on listed hosts."""
    host, path = url_filter.url_host(F.col("url")), url_filter.url_path(F.col("url"))
    return pages.where(host.rlike("|".join(LISTED_HOSTS))).select(
        url_filter.canonical_url(host, path).alias("canonical")
    )


@query
def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, listed_urls(pages), URL_RULES)


@query
def op8_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op4_spotsigs(spark, sf_dir):
    return spotsigs.fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op5_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, remainder("doc_id", 4) != 2)
    return found.withColumn("held_out", held_out(4, 2))


@query
def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_documents(docs, labels, remainder("doc_id", 5) != 0)
    return scored.select(
        "doc_id",
        held_out(5, 0),
        "score",
        "predicted",
        F.size("passages").alias("n_passages"),
    )


@query
def op9_html_extraction(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op6_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_reverse_search(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return reverse_search.search(docs, items)


@query
def op13_fill_middle(spark, sf_dir):
    made = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
