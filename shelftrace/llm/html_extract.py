"""Main text of pages by paths that the pages of a host agree on.

Each page rates its containers by the share of its text outside links that they hold,
and every container path gets these shares as votes of its host. The host's winner is
the deepest path that holds most of the text of its pages on average, an article or main
element before what it holds; the text is then taken from the containers at that path
and from what lies around them and belongs to the article. A page without such a
container goes by its own.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from shelftrace.llm.html_blocks import ARTICLE, article_text, blocks, main_container, shares, titled_blocks
from shelftrace.llm.url_filter import url_host
from shelftrace.sources.shared import stored

# Least average share of the text that the winning container holds.
LEAST_SHARE = 0.75
# A host with this share of all pages or more is large; there are a thousand at most.
LARGE_HOST = 0.001
STEP = " > "


def container_votes(pages):
    """(host, path, share) for each container path of each page, summed in each task."""

    def vote(batches):
        for batch in batches:
            votes = {}
            hosts = batch.column("host").to_pylist()
            for host, html in zip(hosts, batch.column("html")):
                for path, share in shares(blocks(html.as_py() or "")).items():
                    key = (host, STEP.join(path))
                    votes[key] = votes.get(key, 0.0) + share
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in votes], pa.string()),
                    pa.array([k[1] for k in votes], pa.string()),
                    pa.array(list(votes.values()), pa.float64()),
                ],
                names=["host", "path", "share"],
            )

    return pages.select("host", "html").mapInArrow(vote, "host string, path string, share double")


def winning_paths(pages, least=LEAST_SHARE):
    """(voting_host, winner, pages): the deepest path of each host with enough votes, one that
    ends with an article or main element first, of several the one with most votes, then
    the first by text. The empty path, the whole page, has
    a whole vote of every page that has text. Few paths have enough votes; only those are
    compared, one at a time."""
    votes = stored(
        container_votes(pages).groupBy("host", "path").agg(F.sum("share").alias("votes")), "votes"
    )
    whole = votes.where(F.col("path") == "")
    whole = whole.select(F.col("host").alias("voting_host"), F.col("votes").alias("pages"))
    depth = F.when(F.col("path") == "", 0).otherwise(F.size(F.split("path", STEP)))
    tag = F.substring_index(F.substring_index("path", STEP, -1), ".", 1)
    rated = F.struct(
        (~tag.isin(*sorted(ARTICLE))).alias("inner"),
        (-depth).alias("depth"),
        (-F.col("votes")).alias("votes"),
        "path",
    )
    enough = votes.join(whole, F.col("host") == F.col("voting_host")).where(
        F.col("votes") >= F.lit(least) * F.col("pages") - 1e-6
    )
    winners = enough.groupBy("voting_host").agg(
        F.min(rated)["path"].alias("winner"), F.first("pages").alias("pages")
    )
    return stored(winners, "winners")


def with_winner(pages, winners):
    """The pages with their host's winner, null for a host without text. Pages of large
    hosts stay where they are: the winners of those are few and go to all tasks."""
    every = winners.agg(F.sum("pages")).first()[0] or 0.0
    large = F.broadcast(winners.where(F.col("pages") >= LARGE_HOST * every).drop("pages"))
    same = F.col("host") == F.col("voting_host")
    others = pages.join(large, same, "left_anti").join(winners.drop("pages"), same, "left")
    return pages.join(large, same).unionByName(others)


def extract_pages(pages, least=LEAST_SHARE, id="page_id", url="url", html="html"):
    """(id, url, text, n_chars) of every page: the article's blocks, one per line.

    A null html is empty and has empty text. Pages without a URL or without a host in it
    vote together. Repeated rows vote and come out as often as they occur, null ids too;
    other columns are ignored.
    """
    pages = pages.select(
        F.col(id).alias("id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        url_host(F.col(url)).alias("host"),
    )
    chosen = with_winner(pages, winning_paths(pages, least))
    kind = dict(pages.dtypes)["id"]

    def extract(batches):
        for batch in batches:
            texts = []
            for page, winner in zip(batch.column("html"), batch.column("winner").to_pylist()):
                found = titled_blocks(page.as_py() or "")
                text = article_text(found, tuple(winner.split(STEP)) if winner else ())
                if not text and found:
                    text = article_text(found, main_container(shares(found), least))
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["id", "url", "text"],
            )

    made = chosen.select("id", "url", "html", "winner").mapInArrow(
        extract, f"id {kind}, url string, text string"
    )
    return made.select(
        F.col("id").alias(id),
        F.col("url").alias(url),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
