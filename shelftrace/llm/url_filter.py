"""URL verdicts from host rules and a list of URLs.

Listed URLs are found through a blocked Bloom filter: one block of 512 bits per key, one
bit in each of its eight words. The filter is a table of blocks whose number is bounded,
so it is broadcast; what passes it meets the list itself in a hash join, which removes
the false positives. A longer list makes the filter weaker, never the result wrong.
"""

from functools import reduce

from pyspark.sql import functions as F

from shelftrace.sources.shared import stored

WORDS = 8
BITS_PER_KEY = 16
# At most 64 bytes each: the broadcast filter stays under 8 MB.
MAX_BLOCKS = 1 << 17

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url):
    """Between the first :// and the path, A-Z in lower case; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2)


def canonical_url(host, path):
    """Host and path without a closing slash or `.html`: scheme, query and fragment,
    by which listed and met spellings of a page differ, are gone."""
    return F.concat(host, F.regexp_replace(path, r"(\.html|/)\z", ""))


def _hashed(df, column, blocks):
    """With the key's block and its bit in each word of the block."""
    spread = F.xxhash64(F.col(column), F.lit(1))
    bits = [
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned(__spread, {6 * i}) & 63 as int))")
        for i in range(WORDS)
    ]
    df = df.withColumns(
        {"__block": F.pmod(F.xxhash64(column), F.lit(blocks)), "__spread": spread}
    )
    return df.withColumns({f"__bit{i}": bit for i, bit in enumerate(bits)}).drop("__spread")


def bloom_blocks(keys, column, blocks):
    """The filter: (block, word0 ... word7) for every block that holds a key."""
    words = [F.bit_or(f"__bit{i}").alias(f"__word{i}") for i in range(WORDS)]
    grouped = _hashed(keys.select(column), column, blocks).groupBy("__block").agg(*words)
    return grouped.withColumnRenamed("__block", "__filter_block")


def possible_hits(rows, column, keys, blocks):
    """Rows whose key may be among the keys: all that are, and few others."""
    if not 0 < blocks <= MAX_BLOCKS:
        raise ValueError(f"1 to {MAX_BLOCKS} blocks")
    bloom = F.broadcast(bloom_blocks(keys, column, blocks))
    tested = _hashed(rows, column, blocks)
    bits = [F.col(f"__word{i}").bitwiseAND(F.col(f"__bit{i}")) != 0 for i in range(WORDS)]
    hit = reduce(lambda a, b: a & b, bits, F.col("__block") == F.col("__filter_block"))
    return tested.join(bloom, hit, "left_semi").select(*rows.columns)


def block_count(keys):
    wanted = -(-keys * BITS_PER_KEY // (64 * WORDS))
    return max(1, min(MAX_BLOCKS, wanted))


def listed_values(rows, column, listed):
    """The distinct values of `column` that are in the one-column table `listed`."""
    listed = stored(
        listed.toDF(column).where(F.col(column).isNotNull()).distinct(), "listed"
    )
    hits = possible_hits(rows.select(column), column, listed, block_count(listed.count()))
    return hits.distinct().join(listed, column, "left_semi")


def rule_text(rule):
    host, path, _ = rule
    return host + path


def with_rule(df, rules, host="host", path="path"):
    """Adds `rule` and `rule_verdict` of the longest rule that fits, or nulls. A rule is
    (host, path, verdict) and fits its host and all subdomains; of rules of one length
    the first by text wins. The rules are a short list."""
    order = sorted(rules, key=lambda r: (-len(rule_text(r)), rule_text(r)))
    text = verdict = F.lit(None).cast("string")
    for rule in reversed(order):
        name, start, says = rule
        fits = (
            (F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))
        ) & F.startswith(F.col(path), F.lit(start))
        text = F.when(fits, rule_text(rule)).otherwise(text)
        verdict = F.when(fits, says).otherwise(verdict)
    return df.withColumns({"rule": text, "rule_verdict": verdict})


def judge_urls(pages, listed, rules, id="page_id", url="url"):
    """(id, host, path, rule, verdict) of every row of `pages`.

    The rule's verdict stands; without a rule, a URL whose canonical form is among the
    `listed` canonical URLs is blocked, any other allowed. A null URL or one without
    :// has an empty host and path, fits no rule and is allowed. Repeated rows come out
    as often as they occur; other columns are ignored.
    """
    parts = pages.select(
        F.col(id).alias("id"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
    )
    ruled = with_rule(parts, rules)
    urls = ruled.withColumn("canonical", canonical_url(F.col("host"), F.col("path")))
    # Only the URLs that no rule decides are looked up, each once.
    open_urls = urls.where(F.col("rule").isNull() & (F.col("host") != "")).select("canonical")
    hits = listed_values(open_urls, "canonical", listed)
    hits = hits.withColumn("found", F.lit("block"))
    method = F.coalesce("found", F.lit("allow"))
    return urls.join(hits, "canonical", "left").select(
        F.col("id").alias(id),
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", method).alias("verdict"),
    )
