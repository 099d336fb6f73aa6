"""Cards and links of stored pages."""

import random

from conftest import plan
from shelftrace.operators import cards, crawl, links
from shelftrace.operators.card_parser import read_cards
from shelftrace.plans import feeds
from shelftrace.plans.extract import extract_catalogue, extract_counts, extract_records, failed_cards

PAGE = """
<article class="c-prd prd  col _fb extra" data-sku="S1">
  <a class="core" href="/one.html" data-gtm-id="G1">
    <div class="img-c"><img class="img" data-src="/1.jpg"></div>
    <h3 class='name'>A &amp; <b>B</b><br>C</h3>
    <div class=prc>EGP 1,234.50</div>
    <div class="s-prc-w"><div class="old">EGP 2,000</div><div class="bdg _dsct _sm">38%</div></div>
    <div class="rev"><div class="stars _s">4.2 out of 5</div>(12)</div>
  </a></article>
<article class="prd _fb col c-prd"><a class="core" href="two.html" data-gtm-id="G2"></a>
  <div class="old">not inside its wrapper</div><img class="img" src="outside"></article>
<article class="prd _fb col c-prd"><h3 class="name">No link</h3></article>
<article class="prd _fb col c-prd" data-sku="S1"><h3 class="name">Again</h3></article>
<article class="prd _fb col c-prd"></article>
<article class="prd _fb col"><h3 class="name">Not a card</h3></article>
<!-- <article class="prd _fb col c-prd" data-sku="hidden"></article> -->
<script>"<article class='prd _fb col c-prd' data-sku='script'>"</script>
"""


def pages(spark, *htmls):
    rows = [(i, f"https://h/ar/all/?page={i + 1}", html) for i, html in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_records(spark):
    rows = extract_records(pages(spark, PAGE)).orderBy("position").collect()
    assert len(rows) == 5
    first = rows[0].asDict()
    assert {k: first[k] for k in ("sku", "product_name", "image_url", "product_url")} == {
        "sku": "S1", "product_name": "A & B C", "image_url": "/1.jpg", "product_url": "https://h/one.html",
    }
    assert (first["current_price"], first["old_price"], first["discount"]) == (1234.5, 2000.0, 38.0)
    assert (first["rating"], first["reviews_count"]) == (4.2, 12)
    second = rows[1]
    assert (second.sku, second.product_url) == ("G2", "https://h/ar/all/two.html")
    assert second.old_price is None and second.image_url is None
    assert (rows[2].sku, rows[2].product_name) == (None, "No link")


def test_image_addresses_are_resolved(spark):
    card = '<article class="prd _fb col c-prd" data-sku="{}"><div class="img-c"><img class="img" {}></div></article>'
    kinds = {"A": 'src="/a.jpg" data-src="/b.jpg"', "B": 'src="" data-src="/b.jpg"', "C": 'src="c.jpg"', "D": "alt=x"}
    page = pages(spark, "".join(card.format(*k) for k in kinds.items()))
    found = {r.sku: r.image_url for r in extract_records(page).collect()}
    assert found == {"A": "https://h/a.jpg", "B": "/b.jpg", "C": "https://h/ar/all/c.jpg", "D": None}


def test_pages_with_one_number_are_kept_apart(spark):
    card = '<article class="prd _fb col c-prd" data-sku="S"><h3 class="name">{}</h3></article>'
    rows = [(2, "https://h/x", card.format("of two")), (1, "https://h/y", card.format("of one"))]
    for order in (rows, rows[::-1]):
        listing = spark.createDataFrame(order, "page_id long, url string, html string").repartition(1)
        assert extract_catalogue(listing).first().product_name == "of one"
        records = cards.page_records(extract_records(listing)).collect()
        assert sorted((r.page_id, r.product_name) for r in records) == [(1, "of one"), (2, "of two")]


def test_failed_pages_are_a_table(spark, monkeypatch):
    from shelftrace.operators import card_parser
    from shelftrace.plans import extract

    def broken(html):
        raise ValueError("broken")

    card = '<article class="prd _fb col c-prd" data-sku="S"></article>'
    monkeypatch.setattr(card_parser, "read_cards", broken)
    found = extract.failed_pages(pages(spark, card)).collect()
    assert [(r.page_id, r.parse_error) for r in found] == [(0, "ValueError: broken")]


def test_first_card_wins_on_and_across_pages(spark):
    later = '<article class="prd _fb col c-prd" data-sku="S1"><h3 class="name">Later</h3></article>'
    both = pages(spark, PAGE, later)
    on_pages = cards.page_records(extract_records(both)).collect()
    assert sorted((r.page_id, r.identity) for r in on_pages) == [(0, "G2"), (0, "No link"), (0, "S1"), (1, "S1")]
    found = {r.identity: r.product_name for r in extract_catalogue(both).collect()}
    assert found == {"S1": "A & B C", "G2": None, "No link": "No link"}
    assert extract_catalogue(both, last_page=1).count() == 3
    assert extract_catalogue(pages(spark, later), last_page=0).count() == 0


def test_bad_page_is_reported(spark):
    import shelftrace.operators.card_parser as parser

    def broken(html):
        raise ValueError("bad page")

    kept, parser.read_cards = parser.read_cards, broken
    try:
        raw = cards.raw_cards(pages(spark, PAGE)).collect()
    finally:
        parser.read_cards = kept
    assert [r.parse_error for r in raw] == ["ValueError: bad page"]


def test_pages_without_cards_stay_on_the_jvm(spark):
    found = cards.raw_cards(pages(spark, "<p>none</p>", None, PAGE))
    assert {r.page_id for r in found.collect()} == {2}
    assert "c-prd" in plan(found)


def test_broken_markup_ends():
    rng = random.Random(1)
    pieces = ["<article class='prd _fb col c-prd'", "<div ", ">", "'", '"', "</div>", "<!--", "-->", "<script>",
              "</article>", " class=rev ", "&amp;", "<a class=core href=x>", "<", "=", "</", "text "]
    for _ in range(300):
        read_cards("".join(rng.choices(pieces, k=60)))
    read_cards("<article class='prd _fb col c-prd' " + "a='" * 100_000)
    read_cards("<div " + 'x"' * 100_000)


def test_next_page(spark):
    label = links.NEXT_LABEL
    html = [
        f"<a class='pg' href='?page=9'>9</a><a href='?page=2&amp;x=1' class='a pg' aria-label='{label}'>",
        f"<!-- <a class='pg' aria-label='{label}' href='x'> --><a class='pgx' aria-label='{label}' href='y'>",
        f"<a class='pg' aria-label='{label}'>",
        None,
    ]
    followed = links.next_page(pages(spark, *html))
    assert [r.next_url for r in followed.orderBy("page_id").collect()] == [
        "https://h/ar/all/?page=2&x=1", None, None, None,
    ]
    assert links.pages_without_next(followed).count() == 3


def test_page_links(spark):
    html = "<a href='/a?x=1&amp;y=2'>1</a><abbr title='b'><a\nname=top><A HREF=b.html title='a>b'>" + "<a x" * 5000
    found = links.page_links(pages(spark, html)).orderBy("position").collect()
    assert [r.link for r in found] == ["https://h/a?x=1&y=2", "https://h/ar/all/b.html"]


def test_listing_pages_grow_with_the_table(spark, small):
    listing = feeds.listing_pages(spark, small)
    assert listing.count() == feeds.table(spark, small, "customer").count()


def test_one_bad_card_costs_one_card(spark):
    bad = "&#" + "9" * 5000 + ";"
    card = '<article class="prd _fb col c-prd" data-sku="{}"><h3 class="name">{}</h3></article>'
    html = card.format("A", "one &amp; two") + card.format("B", bad) + card.format(bad, "x") + card.format("C", "&#999999;")
    html += f'<div class="{bad}">' + card.format("D", "last")
    found = extract_records(pages(spark, html, PAGE))
    assert {r.position: r.sku for r in found.where("page_id = 0").collect()} == {0: "A", 3: "C", 4: "D"}
    assert found.where("page_id = 1").count() == 5
    failed = failed_cards(pages(spark, html, PAGE)).collect()
    assert sorted((r.page_id, r.position, r.parse_error.split(":")[0]) for r in failed) == [
        (0, 1, "ValueError"), (0, 2, "ValueError"),
    ]
    counts = extract_counts(pages(spark, html, PAGE)).orderBy("page_id").collect()
    assert [tuple(r) for r in counts] == [(0, 3, 2), (1, 5, 0)]


def walked(steps, start, cap=None):
    """A crawl one page after another: (pages, outcome)."""
    pages, page = [], start
    while page in steps and page not in pages and (cap is None or len(pages) < cap):
        pages.append(page)
        page = steps[page]
    if cap is not None and len(pages) >= cap:
        return pages, crawl.PAGE_CAP
    if pages and page is None:
        return pages, crawl.NO_LINK
    return pages, crawl.CYCLE if page in pages else crawl.NOT_STORED


def test_crawls(spark):
    rng = random.Random(4)
    steps = {f"p{i}": f"p{i + 1}" for i in range(120)}
    steps |= {"p40": None, "p60": "gone", "p90": "p70", "self": "self", "a": "b", "b": "a", "alone": None}
    steps |= {f"t{i}": f"t{rng.randrange(60)}" for i in range(40)}
    starts = ["p0", "p0", "p39", "p40", "p50", "p61", "p91", "self", "a", "alone", "nowhere", "t3", "t9"]
    table = spark.createDataFrame(list(steps.items()), "page string, next string")
    begin = spark.createDataFrame([(s,) for s in starts], "start string")
    for cap in (None, 0, 1, 7, 16, 1000):
        reached = crawl.crawl(table, begin, cap)
        got = {}
        for r in sorted(reached.collect(), key=lambda r: (r.start, r.position)):
            got.setdefault(r.start, []).append((r.position, r.page))
        report = {r.start: r for r in crawl.crawl_report(table, begin, reached, cap).collect()}
        assert report.keys() == set(starts)
        for start in set(starts):
            pages, outcome = walked(steps, start, cap)
            assert got.get(start, []) == list(enumerate(pages))
            assert (report[start].pages, report[start].outcome) == (len(pages), outcome)
    assert crawl.crawl(table.limit(0), begin).count() == 0


def test_crawl_of_pages(spark):
    link = f"<a class='pg' href='{{}}' aria-label='{links.NEXT_LABEL}'>"
    card = '<article class="prd _fb col c-prd" data-sku="S"><h3 class="name">{}</h3></article>'
    rows = [
        (5, "https://h/l/?x=1&page=1", link.format("?page=3&amp;sort=a") + card.format("of one")),
        (6, "https://h/l/?page=1#again", link.format("?page=9")),
        (2, "https://h/l/?page=3", link.format("/l/?page=2") + card.format("of three")),
        (1, "https://h/l/?page=2", card.format("of two")),
        (7, None, card.format("nowhere")),
    ]
    listing = spark.createDataFrame(rows, "page_id long, url string, html string")
    starts = listing.where("page_id = 5").select(crawl.listing_key("url").alias("start"))
    reached = crawl.crawl(crawl.page_steps(listing), starts)
    assert [r.page for r in reached.orderBy("position").collect()] == [f"https://h/l/?page={n}" for n in (1, 3, 2)]
    found = crawl.crawl_catalogue(extract_records(listing), reached).collect()
    assert [(r.identity, r.product_name, r.crawl_position) for r in found] == [("S", "of one", 0)]


def test_cards_leave_python_by_parts_of_a_batch():
    # All cards of ten thousand pages at once would be held as dicts.
    import pyarrow as pa

    from shelftrace.operators import card_parser

    page = '<article class="prd _fb col c-prd" data-sku="A"></article>' * 3
    parts = list(card_parser.rows_by_part(pa.array([page, None, "<p>", page] * 300), size=100))
    assert [len(rows) for _, rows in parts] == [150] * 12
    places = [place for some, _ in parts for place in some]
    assert places == [i for i in range(1200) if i % 4 in (0, 3) for _ in range(3)]


def test_tags_that_are_kept_are_bounded_and_change_nothing(monkeypatch):
    from shelftrace.operators import card_parser

    monkeypatch.setattr(card_parser, "KNOWN", {})
    page = (
        '<ARTICLE class="prd _fb col c-prd" data-sku="S{0}"><a class="core" href="/{0}"><h3 class="name">n{0}'
        '</h3><div class="prc">{0}</div></a></article><article class="prd">no</article>'
    )
    found = {}
    for most in (4096, 3, 1):
        monkeypatch.setattr(card_parser, "KNOWN_TAGS", most)
        card_parser.KNOWN.clear()
        found[most] = [read_cards(page.format(i) * 2) for i in range(50)]
        assert 0 < len(card_parser.KNOWN) <= most
    assert found[4096] == found[3] == found[1]
    assert found[3][7][1]["name_text"].strip() == "n7" and len(found[3][7]) == 2


def test_listing_spreads_keys_and_not_pages(spark, small):
    stages = plan(feeds.listing_pages(spark, small)).split("Exchange hashpartitioning")
    assert len(stages) == 2 and "array_join" in stages[0] and "array_join" not in stages[1]
