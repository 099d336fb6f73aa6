"""Anchors of a stored HTML page, without leaving the JVM."""

from pyspark.sql import functions as F

from shelftrace.functions.text import as_column, empty_to_null

# Named references common in link targets.
REFERENCES = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]

# Comments and scripts may hold text that looks like a link. Loops are possessive: no
# page makes them backtrack, or recurse with the length of a tag.
UNSEEN = r"(?is)<(?:!--.*?-->|(script|style)(?=[\s/>]).*?</\1\s*>)"
ANCHOR = (
    r"(?is)(<a(?=[\s/])(?:[\s/]++|[^\s/>][^\s/>=]*+"
    r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+>)"
)


def anchors(html):
    """All opening anchor tags of a page, in document order."""
    seen = F.regexp_replace(as_column(html), UNSEEN, "")
    return F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(1))


def attribute(tag, name):
    """Value of an attribute inside one tag, null if absent."""
    pattern = rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
    value = empty_to_null(F.regexp_extract(as_column(tag), pattern, 1))
    value = F.regexp_replace(value, r"(?s)^([\"'])(.*)\1\z", "$2")
    for reference, character in REFERENCES:
        value = F.replace(value, F.lit(reference), F.lit(character))
    return value


def has_class(tag, name):
    return F.array_contains(F.split(attribute(tag, "class"), r"\s+"), name)
