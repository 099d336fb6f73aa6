from llm_tables import found

from shelftrace.llm import html_extract
from shelftrace.llm.html_blocks import blocks, deepest, shares

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style>
<script>var t="</p><article>";</script></head><body class=menu-open>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice"><p>We use cookies</p></div>
<div class="col c12"><article><header><h1>Title  &lt;1&gt;</h1></header>
<p><b>Lead &eacute;&nbsp;text<br>more<p>Second <a href="x">link</a>
 paragraph.</p><div class="ad">Buy now</div><form><p>Name</p></form>
<ul><li>one</li><li>two</ul>
<section id="comments"><p>First!</p></section></article></div>
<aside><p>Side</p></aside><footer>&copy; foot</footer></body></html>"""


def text(html):
    found = blocks(html)
    return "\n".join(t for _, t, _ in found)


def test_article_blocks():
    assert text(PAGE) == "Title <1>\nLead é text more\nSecond link paragraph.\none\ntwo"


def test_paths_are_generalised():
    paths = {p for p, _, _ in blocks(PAGE)}
    assert ("div.c#.col", "article", "header") in paths
    assert deepest(shares(blocks(PAGE)), 0.75) == ("div.c#.col", "article")


def test_broken_markup_is_read_to_its_end():
    assert text("<p>a<b>b</p></div>c<script>x") == "ab\nc"
    assert text("a < b &am; <p") == "a < b &am;"
    assert text('<div title="a>b">c</div>') == "c"
    assert text("plain\n text") == "plain text"
    assert text("") == ""


def pages(spark, rows):
    schema = "page_id long, url string, html string, host string, text string, winner string"
    return spark.createDataFrame([(*r, "h", "t", "w") for r in rows], schema)


def test_hosts_agree_on_a_path(spark):
    body = "<p>" + "words of the story " * 20 + "</p>"
    page = "<div class=s{}><p>Read these other stories</p></div><div class=main>" + body + "</div>"
    rows = [(i, f"http://h.org/{i}", page.format(i)) for i in range(4)]
    # On its own, this page would be all stray text.
    rows.append((9, "http://h.org/9", "<div class=s9>" + "<p>Read on</p>" * 40 + "</div><div class=main><p>short</p></div>"))
    got = {r[0]: r[2] for r in found(html_extract.extract_pages(pages(spark, rows)))}
    assert got[0] == ("words of the story " * 20).strip()
    assert got[9] == "short"


def test_odd_pages(spark):
    rows = [
        (1, "http://a.org/", None),
        (2, None, "<p>no address</p>"),
        (None, "http://a.org/", ""),
        (3, "http://b.org/", "<nav>only a menu</nav>"),
        (4, "http://b.org/", "<p>x</p>"),
        (4, "http://b.org/", "<p>x</p>"),
        (5, "http://c.org/", "<article><p>" + "long " * 20_000 + "</article>"),
    ]
    got = found(html_extract.extract_pages(pages(spark, rows)))
    want = ["", "no address", "", "", "x", "x", ("long " * 20_000).strip()]
    assert sorted(got, key=str) == sorted(
        [(r[0], r[1], t, len(t)) for r, t in zip(rows, want)], key=str
    )


def test_no_pages(spark):
    assert found(html_extract.extract_pages(pages(spark, []))) == []


BODY = "<p>" + "words of the story " * 40 + "</p>"
STORY = ("words of the story " * 40).strip()


def extracted(spark, *htmls):
    rows = [(i, "http://h.org/", html) for i, html in enumerate(htmls)]
    return [r[2] for r in sorted(found(html_extract.extract_pages(pages(spark, rows))))]


def test_title_and_lead_beside_the_body(spark):
    part = f"<h1>T</h1><p>lead</p><div class=body>{BODY}</div>"
    stray = "<div class=s><p>Read these other stories</p></div>"
    for tag in ("article", "main", "div"):
        assert extracted(spark, *[f"{stray}<{tag}>{part}</{tag}>"] * 3) == [f"T\nlead\n{STORY}"] * 3
    assert extracted(spark, part) == [f"T\nlead\n{STORY}"]
    head = f"{stray}<div class=page><div class=head><h1>T</h1><p>lead</p></div><div class=body>{BODY}</div></div>"
    assert extracted(spark, head) == [f"T\nlead\n{STORY}"]


def test_list_pages(spark):
    items = "".join(f"<li>item {i} of the list" for i in range(40))
    want = "T\nintro\n" + "\n".join(f"item {i} of the list" for i in range(40))
    for tag in ("article", "div"):
        page = f"<div class=s><p>Read on</p></div><{tag}><h1>T</h1><p>intro<ul>{items}</ul></{tag}>"
        assert extracted(spark, page, page) == [want] * 2


def test_links_around_the_body_are_left_out(spark):
    page = f"<div><h1>T</h1><div class=body>{BODY}</div><p><a href=x>Next story</a></p></div>"
    assert extracted(spark, page) == [f"T\n{STORY}"]


def test_wrappers_named_after_what_they_have_or_lack():
    wrappers = [
        "div class='layout no-sidebar'",
        "div class='page has-sidebar'",
        "div id='post' class='ad-free'",
        "section class='article-with-comments'",
        "div class='comments-open'",
        "div class='page sidebar'",
        "div class='sidebar-left'",
        "form id=whole",
    ]
    for start in wrappers:
        for part in ("<article>{}</article>", "<div><article>{}</article></div>", "{}"):
            if start.startswith("form") and part == "{}":
                continue
            page = f"<{start}>{part.format(BODY)}</{start.split()[0]}><div class=ad>Buy</div>"
            assert text(page) == STORY, page


def test_asides_longer_than_the_article():
    long = "<p>much to say " * 50
    for aside in ("div class=comments", "div class='comments-area'", "div class=ad", "div class=ad-slot"):
        assert text(f"<article><p>short</p></article><{aside}>{long}</div>") == "short"
    for aside in ("div class=comments", "div class=comment-list", "div class=ad"):
        assert text(f"<article><p>short</p><{aside}>{long}</div></article>") == "short"
    assert text(f"<p>short</p><div class=comments>{long}</div>") == "short"
    cards = "<div class=related><article><p>A card</p></article></div>"
    assert text(f"<article>{BODY}</article>{cards}") == STORY


def test_elements_without_an_end_tag_do_not_swallow_the_page():
    for start in (
        "<svg class=icon/>",
        "<svg class='icon' />",
        "<math/>",
        "<svg><path d=x>",
        "<datalist id=d><option value=a>A<option>B</datalist>",
        "<select><option>A</select>",
        "<button>Menu",
        "<button class='x>y'>Menu</button>",
        "<video src=x>",
        "<audio src=x>",
        "<canvas>",
        "<object data=x>",
        "<iframe src=x />",
        "<div><button>Menu</div>",
    ):
        assert text(f"{start}<article><p>first</p><p>second</p></article>") == "first\nsecond", start
        assert text(f"{start}<p>first</p>{start}<p>second") == "first\nsecond", start
    assert text("<p>a <svg/>b <svg><title>T</title><text>t</text></svg>c <math></math>d</p>") == "a b c d"
    assert text("<p>a <video><p>no video</p></video>b <option>x</option>c</p>") == "a b c"
    assert text("<p>a <svg><svg></svg><text>t</text></svg>b <script>x") == "a b"
    assert text("<p>a <button>x<button>y</button>b</p>") == "a b"


def test_sections_with_an_aside_word_in_a_longer_name_are_text():
    section = "<h2>Heading</h2><p>what the section says of it"
    for name in ("market-share", "social-history", "related-work", "menu-description", "search-results", "notice-period"):
        for attribute in ("class", "id", "role"):
            html = f"<article><p>before it<section {attribute}='{name}'>{section}</section><p>after it</article>"
            assert text(html) == "before it\nHeading\nwhat the section says of it\nafter it", html
    for aside in (
        "<div class=comments><p>First!</div>",
        "<div class='cookie-notice'><p>We use cookies</div>",
        "<div class='social-share'><p>Tell others</div>",
        "<div class='newsletter-signup'><a href=/n>Get our letters</a> <a href=/m>by mail</a></div>",
        "<ul class='related-stories'><li><a href=/1>One story</a><li><a href=/2>Another</a></ul>",
    ):
        assert text(f"<article><p>before it</p>{aside}<p>after it</article>") == "before it\nafter it", aside
    # Beside the article, a part of a name is still enough.
    assert text(f"<article><p>{STORY}</article><div class='sidebar-left'><p>words</div>") == STORY
