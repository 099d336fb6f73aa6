"""Links of stored pages."""

from pyspark.sql import functions as F

from shelftrace.functions.markup import anchors, attribute, has_class
from shelftrace.functions.urls import with_resolved_url

# Class and label of the link to the next listing page.
NEXT_CLASS = "pg"
NEXT_LABEL = "الصفحة التالية"


def page_links(pages, url="url", html="html"):
    """Every link of every page with its position, resolved against the page."""
    tags = pages.select("page_id", url, F.posexplode(anchors(html)).alias("position", "tag"))
    found = tags.withColumn("href", attribute("tag", "href")).drop("tag")
    return with_resolved_url(found.where(F.col("href").isNotNull()), url, "href", "link")


def next_page(pages, url="url", html="html", css_class=NEXT_CLASS, label=NEXT_LABEL):
    """The link to the next listing page, as found and resolved; null where there is none."""
    wanted = F.filter(
        anchors(html),
        lambda tag: F.contains(tag, F.lit(css_class))
        & has_class(tag, css_class)
        & (attribute(tag, "aria-label") == F.lit(label)),
    )
    # Pages without the label anywhere, most of them, are not searched for anchors.
    labelled = F.when(F.contains(F.col(html), F.lit(label)), wanted)
    href = attribute(F.try_element_at(labelled, F.lit(1)), "href")
    found = pages.withColumn("next_href", href).drop(html)
    return with_resolved_url(found, url, "next_href", "next_url")


def pages_without_next(followed):
    """Pages where a crawl would have stopped: the report of missing links."""
    return followed.where(F.col("next_href").isNull())
