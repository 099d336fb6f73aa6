"""Column expressions on handmade rows."""

import random
import sys
from decimal import Decimal, InvalidOperation
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelftrace.functions import numeric, text, urls
from shelftrace.functions.fingerprint import row_hash
from shelftrace.operators import clean


def apply(spark, values, make, data_type="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {data_type}")
    return [r[0] for r in df.orderBy("i").select(make("v")).collect()]


def test_whitespace_is_pythons(spark):
    spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    assert sorted(text.WHITESPACE) == spaces
    values = [f"{s}a{s}b{s}" for s in spaces] + ["​a​", "", " ", None]
    expected = [v.strip() if v is not None else None for v in values]
    assert apply(spark, values, text.strip) == expected
    collapsed = [" ".join(v.split()) if v else None for v in values]
    assert apply(spark, values, text.collapse_whitespace) == collapsed


def test_null_tokens(spark):
    missing = ["", "<NA>", "None", "NaN", "nan", "-NaN", "-nan", "NA", "N/A", "n/a", "NULL", "null"]
    missing += ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN"]
    values = [*missing, "none", "Null", "NAN", "-", "x", " NA", None]
    expected = [None] * len(missing) + ["none", "Null", "NAN", "-", "x", " NA", None]
    assert apply(spark, values, text.null_tokens_to_null) == expected
    assert sorted(text.NULL_TOKENS) == sorted(missing)


PRICES = {
    "12": 12.0, " 12 ": 12.0, "+5": 5.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1_000": 1000.0,
    "١٢.٥": 12.5, " 12 ": 12.0, "-0": -0.0, "-0.0e5": -0.0,
    "1E+400": float("inf"), "-5": None, "1,000": None, "$5": None, "0x10": None, "12 3": None,
    "True": None, "12d": None, "NaN": None, "Infinity": None, "": None, "5\n": 5.0,
    "-1e-400": None, "e5": None, ".": None,
}


def test_prices(spark):
    assert apply(spark, list(PRICES), numeric.parse_price) == list(PRICES.values())
    assert apply(spark, [None], numeric.parse_price) == [None]


def test_prices_against_decimal(spark):
    rng = random.Random(7)
    alphabet = "0123456789+-._eE ١٢߃\U0001d7d9"
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 7))) for _ in range(8000)]

    def expected(value):
        try:
            price = Decimal(value)
        except InvalidOperation:
            return None
        return float(price) if price.is_finite() and price >= 0 else None

    assert apply(spark, values, numeric.parse_price) == [expected(v) for v in values]


def test_lenient_types(spark):
    assert apply(spark, ["15%", "12.345%", "%", None], numeric.lenient_percent) == [
        Decimal("15.00"), Decimal("12.35"), None, None,
    ]
    values = ["4.5", "no rating yet", "100", "99.999", "1e1", "٤"]
    assert apply(spark, values, numeric.lenient_rating) == [Decimal("4.50")] + [None] * 5
    values = ["1,234", "12.0", "10.99", "-10.99", "99999999999", "no reviews yet"]
    assert apply(spark, values, numeric.lenient_count) == [1234, 12, 10, -10, None, None]


def test_numbers_in_text(spark):
    values = ["EGP 1,234.50", "-15%", "1.234.5", "none", "", None, "١٢ x", "a 1,,2,.5"]
    expected = [1234.5, 15.0, 1.234, None, None, None, 12.0, 12.5]
    assert apply(spark, values, numeric.first_number) == expected
    values = ["4.2 Out Of 5", "4.2 / 5", "4 out of5", "", None]
    assert apply(spark, values, numeric.rating_phrase) == [4.2, None, 4.0, None, None]
    assert apply(spark, ["(12)", "(1,234)", None], numeric.reviews_in_parentheses) == [12, None, None]


def test_cleaning_rules(spark):
    values = ["15", " 15% ", "", "  ", None, "%", "15%%", "a\nb"]
    expected = ["15%", "15%", None, None, None, "%", "15%%", "a\nb%"]
    assert apply(spark, values, clean.clean_discount) == expected
    rating = clean.RULES["rating"]
    assert apply(spark, ["4.5", "  ", None], rating) == ["4.5", clean.NO_RATING, clean.NO_RATING]
    reviews = clean.RULES["reviews_count"]
    assert apply(spark, ["12.0", "  ", None], reviews) == ["12.0", clean.NO_REVIEWS, clean.NO_REVIEWS]


def test_page_number(spark):
    pages = {
        "?page=2&r=x": 2, "?page=": 1, "?page=%32": 2, "?page=3&page=4": 3, "?page=x": 1, "": 1,
        "?page=&page=4": 4, "?a=1&page=7#page=9": 7, "#?page=5": 1, "?xpage=5": 1, "?page=+6": 6,
        "?page=%zz": 1, "?page=1_0": 10, "?page=٣": 3,
    }
    values = [f"https://h/ar/all/{query}" for query in pages]
    assert apply(spark, values, urls.page_number) == list(pages.values())


def resolved(spark, pairs):
    rows = [(i, base, ref) for i, (base, ref) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, base string, ref string")
    linked = urls.with_resolved_url(df, "base", "ref", "link")
    assert linked.columns == ["i", "base", "ref", "link"]
    return [r.link for r in linked.orderBy("i").collect()]


def test_resolve_url(spark):
    base = "https://h/ar/all/?t=1"
    links = {
        "/p.html": "https://h/p.html", "q.html": "https://h/ar/all/q.html",
        "?page=2": "https://h/ar/all/?page=2", "#a": "https://h/ar/all/?t=1#a",
        "//c/z": "https://c/z", "../u": "https://h/ar/u", "": base, None: None,
        "http://o/x/../y": "http://o/x/../y", "mailto:a@b": "mailto:a@b",
    }
    assert resolved(spark, [(base, ref) for ref in links]) == list(links.values())


def test_resolve_url_like_the_standard_library(spark):
    rng = random.Random(3)
    bases = ["https://h", "http://h/", "https://h/a/b.html?x=1#f", "https://h/a//b/", "http://h/a/../c"]
    steps = ["", "..", ".", "a", "b.html", "...", "x y"]

    def reference():
        path = "/".join(rng.choices(steps, k=rng.randint(1, 5)))
        path = rng.choice(["", "/"]) + path.lstrip("/")
        return path + rng.choice(["", "?", "?q=1", "?q=../z"]) + rng.choice(["", "#", "#f"])

    pairs = [(rng.choice(bases), reference()) for _ in range(3000)]
    starts = ["https:", "HTTPS:", "http:", "Http:", "ftp:", "", "mailto:"]
    hosts = ["", "/", "//", "//c", "//c/", "///x", "//c/d//e", "//c/../d"]
    ends = ["", "#", "?", "?#", "#f", "?q#", "x/../y", "..//a"]
    whole = [s + h + e for s in starts for h in hosts for e in ends]
    pairs += [(base, ref) for base in [*bases, "HTTPS://h/a/b"] for ref in whole]
    wrong = [
        (p, got, urljoin(*p)) for p, got in zip(pairs, resolved(spark, pairs)) if got != urljoin(*p)
    ]
    assert wrong == []


def test_fingerprint(spark):
    rows = [("a", None), ("a", ""), ("a|", ""), ("", "a"), (None, "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    plain = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert plain[0] == plain[1] and plain[3] == plain[4] and len(set(plain)) == 3
    strict = [r[0] for r in df.select(row_hash(["x", "y"], unambiguous=True)).collect()]
    assert len(set(strict)) == 5
    wide = df.select(row_hash(["x", "y"], charset="UTF-16LE"), F.sha2(F.lit("a|").cast("binary"), 256))
    assert wide.first()[0] != wide.first()[1] == plain[0]


@pytest.mark.parametrize("pattern", [numeric.PRICE_PATTERN, numeric.LENIENT_PATTERN])
def test_patterns_reject_a_trailing_line(spark, pattern):
    df = spark.createDataFrame([("5\n",)], "v string")
    assert df.select(F.regexp_extract("v", pattern, 1)).first()[0] == ""


def test_sql_functions_agree_with_columns(spark):
    from shelftrace.functions import numeric, sql, text, urls

    sql.register(spark)
    cells = [
        None, "", " ", " A\u00a0", "a \t b\u3000c", "1,234", " 12.5 ", "1e3", "-0", "-5", "1_000", "\u0661\u0662.5", "5 %", "99.999",
        "4.5 out of 5 (12)", "3 OUT  OF 5", "(1,2)", "x -7,000.5 y", "it's", "https://h/?page=7", "https://h/?x=1&page=%D9%A3#f",
        "https://h/?page=1_0", "https://h/?page=a", "12345678901234567890", "2147483648",
    ]
    rules = {
        "shelf_strip": text.strip, "shelf_collapse": text.collapse_whitespace, "shelf_price": numeric.parse_price,
        "shelf_percent": numeric.lenient_percent, "shelf_rating": numeric.lenient_rating, "shelf_count": numeric.lenient_count,
        "shelf_first_number": numeric.first_number, "shelf_stars": numeric.rating_phrase,
        "shelf_reviews": numeric.reviews_in_parentheses, "shelf_page_number": urls.page_number,
    }
    assert rules.keys() == sql.FUNCTIONS.keys()
    table = spark.createDataFrame([(c,) for c in cells], "c string")
    table.createOrReplaceTempView("cells")
    for name, rule in rules.items():
        ours = [tuple(r) for r in table.select("c", rule("c")).collect()]
        assert [tuple(r) for r in spark.sql(f"SELECT c, {name}(c) FROM cells").collect()] == ours, name


def test_cards_as_a_table_function(spark):
    from shelftrace.functions import sql

    sql.register(spark)
    card = '<article class="prd _fb col c-prd" data-sku="{}"><h3 class="name">{}</h3></article>'
    rows = [(1, card.format("A", "x") + card.format("B", "&#" + "9" * 5000 + ";")), (2, "<p>"), (3, None), (None, card.format("C", "y"))]
    spark.createDataFrame(rows, "page_id long, html string").createOrReplaceTempView("some_pages")
    found = spark.sql("SELECT page_id, position, data_sku, name_text, parse_error IS NULL AS good FROM product_cards(TABLE(some_pages))")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, 0, "A", "x\n", True), (1, 1, None, None, False), (None, 0, "C", "y\n", True)], key=str
    )
