"""Connected components of a table of links, as rounds of joins."""

from pyspark.sql import functions as F

from shelftrace.sources.shared import stored


def components(links):
    """(node, component) for every node of `links` (a, b): the least node it is
    connected with. Each round takes the least label of the neighbours and then the
    label's own label, so the rounds grow with the logarithm of the longest path; every
    round is a written table."""
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    both = stored(both.distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("component")
        ),
        "labels",
    )
    while True:
        near = both.join(
            labels.select(F.col("node").alias("b"), F.col("component").alias("theirs")), "b"
        )
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        hooked = labels.join(near, "node").select(
            "node",
            F.col("component").alias("before"),
            F.least("component", "theirs").alias("label"),
        )
        further = labels.select(F.col("node").alias("label"), F.col("component").alias("jump"))
        jumped = stored(
            hooked.join(further, "label").select(
                "node", "before", F.least("label", "jump").alias("component")
            ),
            "labels",
        )
        changed = jumped.where(F.col("component") != F.col("before")).limit(1).count()
        labels = jumped.select("node", "component")
        if not changed:
            return labels
