"""Feeds and listing pages that Spark derives from the given tables."""

from datetime import datetime

from pyspark.sql import functions as F

from shelftrace.operators.links import NEXT_CLASS, NEXT_LABEL


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price_text(step):
    return (
        f"cast(cast((floor(o_totalprice / 250000) + 1) * {step} as decimal(18,2)) as string)"
    )


# The nine-column feed from `orders`, as text valid in Spark SQL and ANSI SQL alike:
# only the input is shared with the checks, not what is computed from it.
RAW_FEED = {
    "row_no": "o_orderkey",
    "batch_no": "cast(year(o_orderdate) as int)",
    "sku": "case when o_orderkey % 97 = 0 then null when o_orderkey % 89 = 0 then '   '"
    " when o_orderkey % 7 = 0 then '  SKU-' || cast(o_custkey as string) || ' '"
    " else 'SKU-' || cast(o_custkey as string) end",
    "product_name": "' ' || o_orderstatus || '  item ' || cast(o_custkey % 40 as string) || ' '",
    "image_url": "case when o_custkey % 31 = 0 then null"
    " else 'https://img.example.com/' || cast(o_custkey % 50 as string) || '.jpg' end",
    "product_url": "'https://shop.example.com/p/' || cast(o_custkey as string) || '.html'",
    "current_price": "case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then '-5'"
    " when o_orderkey % 107 = 0 then 'abc' when o_orderkey % 109 = 0 then '1e3'"
    f" else {_price_text(100)} end",
    "old_price": "case when o_orderkey % 53 = 0 then null when o_orderkey % 59 = 0 then 'NaN'"
    f" else {_price_text(125)} end",
    "discount": "case when o_custkey % 11 = 0 then null when o_custkey % 13 = 0 then ''"
    " when o_custkey % 3 = 0 then ' ' || cast(o_custkey % 60 as string) || '% '"
    " else cast(o_custkey % 60 as string) end",
    "rating": "case when o_custkey % 5 = 0 then null when o_custkey % 17 = 0 then '   '"
    " else cast(o_custkey % 5 as string) || '.5' end",
    "reviews_count": "case when o_custkey % 6 = 0 then null when o_custkey % 19 = 0 then '1,234'"
    " else cast(o_custkey % 300 as string) || '.0' end",
}


def raw_feed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    return orders.selectExpr(*[f"{text} AS {name}" for name, text in RAW_FEED.items()])


def batch_time(year):
    """Change time of a yearly batch."""
    return F.make_timestamp_ntz(
        year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")
    )


def batch_moment(year):
    """The same as a driver-side value."""
    return datetime(year, 1, 1)


# A dense history from `events`.
EVENT_FEED = {
    "sku": "cast(user_id as string)",
    "batch_date": "cast(ts as date)",
    "stage_id": "event_id",
    "event_type": "event_type",
    "level": "cast(floor(value / 40) as bigint)",
}


def event_feed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*[f"{text} AS {name}" for name, text in EVENT_FEED.items()])


# A dimension from before history was kept, from `customer`.
LEGACY_TABLE = {
    "product_id": "c_custkey + 1",
    "stage_id": "c_custkey",
    "sku": "'C-' || cast(c_custkey as string)",
    "product_name": "c_name",
    "image_url": "cast(null as string)",
    "product_url": "'https://shop.example.com/c/' || cast(c_nationkey as string)",
    "current_price": "cast(c_acctbal as decimal(18,2))",
    "old_price": "cast(c_acctbal + 10 as decimal(18,2))",
    "discount_percent": "cast(c_custkey % 70 as decimal(8,2))",
    "rating": "case when c_custkey % 4 = 0 then null else cast(c_custkey % 5 as decimal(4,2)) end",
    "reviews_count": "cast(c_custkey % 90 as int)",
    "created_at": "TS'2023-01-01 00:00:00'",
    "effective_from": "case when c_custkey % 3 = 0 then TS'2023-06-01 00:00:00' end",
    "effective_to": "case when c_custkey % 10 = 0 then TS'2023-09-01 00:00:00' end",
    "iscurrent": "case when c_custkey % 10 = 0 then 0 when c_custkey % 10 = 1 then 1 end",
    "row_hash": "case when c_custkey % 8 = 0 then 'legacy' end",
}


def legacy_table(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr(
        *[
            f"{text.replace('TS', 'timestamp_ntz')} AS {name}"
            for name, text in LEGACY_TABLE.items()
        ]
    )


# Product cards: five per listing page, one page per customer. `g` counts cards over
# all pages, `p` is the product on the card; products repeat on and across pages.
CARDS_PER_PAGE = 5
PAGE_URL = "'https://shop.example.com/ar/all/?page=' || cast(c_custkey + 1 as string)"


# A reference to a character with a number that no reader takes.
POISON = "&#" + "9" * 5000 + ";"


def listing_pages(spark, sf_dir, poisoned=False):
    """Listing pages rendered row by row. The table that they are rendered from may lie in
    a single part, so its keys are spread first, which costs less than to spread pages. If
    `poisoned`, the name of every 29th card cannot be read."""
    first = F.col("c_custkey") * CARDS_PER_PAGE
    numbers = F.sequence(first, first + (CARDS_PER_PAGE - 1))
    products = F.transform(
        numbers, lambda g: F.struct(g.alias("g"), (g + 7 - (g * g) % 7).alias("p"))
    )
    cards = F.transform(products, lambda card: _card(card.g, card.p, poisoned))
    page = F.col("c_custkey") + 1
    link = F.when(page % 10 == 0, "").otherwise(
        F.concat(
            F.lit(f"<a aria-label='{NEXT_LABEL}' class=\"x {NEXT_CLASS}\" href=\"?page="),
            (page + 1).cast("string"),
            F.lit('&amp;sort=a">&gt;</a>'),
        )
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var a='<article class=\"prd _fb col c-prd\">'"),
        F.lit("</script></head><body><!-- <a class=pg href=x> --><article class='prd'>"),
        F.lit("<h3 class=name>advert</h3></article><a class='pg' href='/first'>1</a>"),
        F.array_join(cards, "\n"),
        link,
        F.lit("</body></html>"),
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return customer.repartition(parts, "c_custkey").select(
        F.col("c_custkey").alias("page_id"), F.expr(PAGE_URL).alias("url"), html.alias("html")
    )


def _card(g, p, poisoned):
    text = p.cast("string")
    spoilt = (g % 29 == 7) if poisoned else F.lit(False)

    def lit(value):
        return F.lit(value)

    price = F.concat(
        lit('<div class="prc">EGP '),
        (p % 9 + 1).cast("string"),
        lit(","),
        F.lpad((p % 1000).cast("string"), 3, "0"),
        lit(".50</div>"),
    )
    rating = F.concat(
        lit('<div class="rev"><div class="_s stars m">'),
        (p % 5).cast("string"),
        lit(".5 Out  Of 5</div>("),
        F.when(p % 4 == 0, lit("1,234")).otherwise((p % 700).cast("string")),
        lit(")</div>"),
    )
    image = (
        F.when(g % 4 == 0, lit(""))
        .when(
            g % 4 == 1,
            F.concat(
                lit('<div class="img-c"><img class="img" data-src="/i/'), text, lit('.jpg"></div>')
            ),
        )
        .otherwise(
            F.concat(
                lit('<div class="img-c"><img class="img" data-src="/no" src="/i/'),
                text,
                lit('.png"></div>'),
            )
        )
    )
    return F.concat(
        lit('<article class="c-prd col _fb prd"'),
        F.when(p % 11 == 0, lit(">")).otherwise(F.concat(lit(' data-sku="P-'), text, lit('">'))),
        F.when(g % 13 == 5, lit("")).otherwise(
            F.concat(
                lit('<a class="x core" href="/item-'), text, lit('.html" data-gtm-id="G-'), text, lit('">')
            )
        ),
        image,
        F.when(spoilt, lit(f"<h3 class=name>{POISON}</h3>")).when(p % 17 == 3, lit("")).otherwise(
            F.concat(lit('<h3 class="name"> Item \n '), text, lit(" &amp; Co </h3>"))
        ),
        F.when(p % 19 == 0, lit("")).otherwise(price),
        F.when(g % 3 == 0, lit("")).otherwise(
            F.concat(
                lit('<div class="s-prc-w"><div class="old">EGP 9,'),
                F.lpad((p % 1000).cast("string"), 3, "0"),
                lit('</div><div class="bdg _dsct _sm">-'),
                (p % 90).cast("string"),
                lit("%</div></div>"),
            )
        ),
        F.when(p % 6 == 0, lit("")).otherwise(rating),
        F.when(g % 13 == 5, lit("")).otherwise(lit("</a>")),
        lit("</article>"),
    )


# Steps of a site from `customer`: mostly to the next page, some without a link, some to a
# page that is not stored, and some back, so that crawls go round.
SITE_STEPS = {
    "page": "'p' || cast(c_custkey as string)",
    "next": "case when c_custkey % 97 = 96 then null"
    " when c_custkey % 89 = 88 then 'gone' || cast(c_custkey as string)"
    " when c_custkey % 83 = 82 then 'p' || cast(c_custkey - 5 as string)"
    " else 'p' || cast(c_custkey + 1 as string) end",
}


def site_steps(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr(*[f"{text} AS {name}" for name, text in SITE_STEPS.items()])


# A price question for every order: the product, and when.
ORDER_MOMENTS = {
    "row_no": "o_orderkey",
    "sku": "case when o_orderkey % 71 = 0 then null else 'SKU-' || cast(o_custkey as string) end",
    "moment": "case when o_orderkey % 61 = 0 then null else cast(o_orderdate as timestamp_ntz) end",
}


def order_moments(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr(*[f"{text} AS {name}" for name, text in ORDER_MOMENTS.items()])
