"""URL expressions."""

from pyspark.sql import functions as F

from shelftrace.functions.numeric import ascii_digits
from shelftrace.functions.text import as_column, empty_to_null, strip

# The first non-blank value of the query parameter `page`.
PAGE_PATTERN = r"^[^#?]*\?(?:[^#]*?&)??page=([^&#]+)"


def page_number(url):
    """Page number of a listing URL, 1 if it carries none."""
    raw = empty_to_null(F.regexp_extract(as_column(url), PAGE_PATTERN, 1))
    text = ascii_digits(strip(F.try_url_decode(raw)))
    number = F.when(
        text.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*\z"),
        F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"),
    )
    return F.coalesce(number, F.lit(1).cast("bigint"))


SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def _walked(steps):
    """A path from its steps: `..` takes back the step before, the root included."""
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(
            step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(step == ".", done)
        .otherwise(F.concat(done, F.array(step))),
    )
    closing = F.when(
        F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))
    ).otherwise(F.array().cast("array<string>"))
    path = F.array_join(F.concat(kept, closing), "/")
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))


def with_resolved_url(df, base, ref, name):
    """A link found on page `base` as an absolute URL, in column `name`.

    The steps are columns of their own, so each is computed once per row.
    """
    page, link = as_column(base), F.col("_link")
    step = df.withColumn("_ref", as_column(ref))
    ref = F.col("_ref")
    step = step.withColumns(
        {
            "_scheme": F.regexp_extract(ref, SCHEME, 1),
            "_own": F.lower(F.regexp_extract(page, SCHEME, 1)),
        }
    )
    # With the page's own scheme a link is as good as without; another one stands.
    same = F.lower("_scheme") == F.col("_own")
    rest = F.when(same, F.substr(ref, F.length("_scheme") + 2)).otherwise(ref)
    # A host that is not there, and an empty query or fragment at the end, say nothing.
    rest = F.regexp_replace(rest, r"^//(?=[/?#]|\z)", "")
    rest = F.regexp_replace(F.regexp_replace(rest, r"#\z", ""), r"\?(?=#|\z)", "")
    step = step.withColumn("_link", rest)
    step = step.withColumns(
        {
            "_path": F.regexp_extract(link, r"^([^?#]*)", 1),
            "_origin": F.concat(
                "_own", F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*(://[^/?#]*)", 1)
            ),
            "_place": F.regexp_extract(page, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1),
        }
    )
    # Steps between the first and the last that are empty count from the root only.
    folder = F.regexp_extract("_place", r"^(.*/)", 1)
    merged = F.regexp_replace(F.concat(F.lit("/"), folder, "_path"), "/{2,}", "/")
    step = step.withColumn(
        "_merged", F.when(F.col("_path").startswith("/"), F.col("_path")).otherwise(merged)
    )
    plain = F.when(
        F.col("_merged").rlike(r"/\.{1,2}(?:/|\z)"), _walked(F.split("_merged", "/"))
    ).otherwise(F.col("_merged"))
    query = F.regexp_extract(page, r"^[^?#]*(\?[^#]+)", 1)
    tail = F.substr(link, F.length("_path") + 1)
    return step.withColumn(
        name,
        F.when(ref == "", page)
        .when((F.col("_scheme") != "") & ~same, ref)
        .when(link.startswith("//"), F.concat("_own", F.lit(":"), link))
        .when(
            (link == "") | link.startswith("#"), F.concat("_origin", "_place", query, link)
        )
        .when(link.startswith("?"), F.concat("_origin", "_place", link))
        .otherwise(F.concat("_origin", plain, tail)),
    ).drop("_ref", "_scheme", "_own", "_link", "_path", "_origin", "_place", "_merged")
