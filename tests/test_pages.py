"""Page extraction on hand-written HTML."""

import pytest

from tests.conftest import json_df  # noqa: F401
from vitrine.functions.text import brand_suffixes, clean_text, decode_entities
from vitrine.operators.pages import crawl_outcome, extract_product_info

from pyspark.sql import functions as F

SUFFIXES = brand_suffixes(["SHOP.de", "SHOP"])


def ld(text):
    return f'<script type="application/ld+json">{text}</script>'


# html, then name, price, description
CASES = [
    # JSON-LD as an object, as a list, after broken scripts, inside comments
    (ld('{"@type":"Product","name":" A  B | SHOP","description":"d\\n e","offers":{"price":10.50,"priceCurrency":"EUR"}}'),
     "A B", "EUR 10.5", "d e"),
    (ld('[{"@type":"X"},{"@type":"Product","name":"L","offers":[{"price":"9","priceCurrency":"USD"},{"price":"1"}]}]'),
     "L", "USD 9", "N/A"),
    (ld("{bad") + ld("") + "<!-- " + ld('{"@type":"Product","name":"hidden"}') + " -->" + ld('{"@type":"Product","name":"third"}'),
     "third", "N/A", "N/A"),
    (ld('["text",{"@type":"Product","name":"after text"}]') + ld('{"@type":"Product","name":"next script"}'),
     "next script", "N/A", "N/A"),
    ('<script type="text/plain">{"@type":"Product","name":"no"}</script><title>t</title>', "t", "N/A", "N/A"),
    ("<SCRIPT id='x' TYPE='application/ld+json' >" + '{"@type":"Product","name":"caps"}</SCRIPT>', "caps", "N/A", "N/A"),
    (ld('{"@type":["Product"],"name":"Z"}') + "<h1>h</h1>", "h", "N/A", "N/A"),
    # falsy values fall through
    (ld('{"@type":"Product","name":"","description":null,"offers":{"price":0,"priceCurrency":"EUR"}}') +
     '<meta property="og:title" content="og"><p class="price">5 EUR</p><p class="description">text</p>', "og", "5 EUR", "text"),
    (ld('{"@type":"Product","name":"n","offers":[]}') + '<b data-price="7">7</b>', "n", "7", "N/A"),
    (ld('{"@type":"Product","name":"n","offers":{"price":"0","priceCurrency":"EUR"}}'), "n", "EUR 0", "N/A"),
    (ld('{"@type":"Product","name":"n","offers":{"price":"3"}}'), "n", "3", "N/A"),
    # names
    ('<meta content="OG &quot;T&quot; | SHOP.de | SHOP" property="og:title"><h1>no</h1>', 'OG "T" | SHOP.de', "N/A", "N/A"),
    ('<meta property="og:title" content=""><h1 id=a>Head <i>it</i>&amp;&#8364;</h1>', "Head it&€", "N/A", "N/A"),
    ('<meta property="og:title" title="a content=b" content="right">', "right", "N/A", "N/A"),
    ("<h1></h1><title>t</title>", "", "N/A", "N/A"),
    ("<h1>N/A</h1><title>t</title>", "t", "N/A", "N/A"),
    ("<!-- <h1>no</h1> --><style>h1{}</style><script>'<h1>no</h1>'</script><title>\n T - SHOP </title>", "T", "N/A", "N/A"),
    # prices: only the first element of each selector counts
    ('<i class="price">none</i><i class="price">5</i><i class="sale-price">4</i>', "N/A", "4", "N/A"),
    ('<i class="big price now">1 <b>2</b></i>', "N/A", "1 2", "N/A"),
    ('<i class="price-old">1</i><i class="x product-price">2</i>', "N/A", "2", "N/A"),
    ('<div class="price"><div>1</div> 2</div> 3', "N/A", "1 2", "N/A"),
    ("<div class=price>8</div>", "N/A", "8", "N/A"),
    ('<input class="price" value="3"><u class="product-price">6</u>', "N/A", "6", "N/A"),
    ('<a title="class=\'price\'" data-x="a > b">1</a><u class="price">2</u>', "N/A", "2", "N/A"),
    # descriptions: an existing element counts even when it is empty
    ('<p class="product-details">late</p><p class="product-description"></p>', "N/A", "N/A", ""),
    ('<meta name="description" content=""><meta content="og > d" property="og:description">', "N/A", "N/A", "og > d"),
    ("<meta name='description' content='m &lt;b&gt;'>", "N/A", "N/A", "m <b>"),
    ("no tags", "N/A", "N/A", "N/A"),
    ("<<>< div", "N/A", "N/A", "N/A"),
]


def test_cases(spark):
    df = spark.createDataFrame([(str(i), c[0]) for i, c in enumerate(CASES)], "url string, html string")
    found = {int(r.current_url): (r.product_name, r.price, r.description)
             for r in extract_product_info(df, suffixes=SUFFIXES).collect()}
    wrong = {i: (CASES[i], found[i]) for i in found if found[i] != CASES[i][1:]}
    assert not wrong


def test_failed_fetch(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "x")], "url string, html string")
    info = extract_product_info(df)
    assert {(r.current_url, r.product_name, r.error) for r in info.collect()} == {
        ("a", "N/A", "Failed to fetch"), ("b", "N/A", "Failed to fetch"), ("c", "N/A", None)}
    assert {r.outcome: r.pages for r in crawl_outcome(info).collect()} == {"success": 1, "error": 2}


def test_long_pages_are_read_whole(spark):
    """Megabyte-sized tags, texts and attribute lists neither overflow the stack nor get cut."""
    many = "".join(f' a{i}="{i}"' for i in range(20_000))
    html = (f"<p{many}>" + "x " * 500_000 + '<h1 data-y="' + "y" * 500_000 + '">' + "n" * 300_000 + "</h1>"
            + "<b>" * 20_000 + "</b>" * 20_000 + '<div class="price">' + "7" * 200_000 + "</div>")
    row = extract_product_info(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert len(row.product_name) == 300_000 and len(row.price) == 200_000


@pytest.mark.parametrize("raw, clean", [
    (None, ""), ("", ""), ("  a \t\n b c ", "a b c"), ("A | SHOP.de", "A"), ("A - SHOP | SHOP.de", "A"),
    ("A | SHOP.de | SHOP", "A | SHOP.de"), (" | SHOP", "| SHOP"), ("SHOP", "SHOP"),
])
def test_clean_text(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string").select(clean_text(F.col("t"), SUFFIXES))
    assert df.first()[0] == clean


@pytest.mark.parametrize("raw, text", [
    ("&amp;lt;", "&lt;"), ("&lt;&gt;&quot;&apos;&#39;&nbsp;", "<>\"'' "), ("&#x1F48D;&#128141;", "💍💍"),
    ("&euro;&uuml;&eacute;", "€üé"), ("&unknown; & &#0; &#xD800;", "&unknown; & &#0; &#xD800;"), (None, None),
    ("&#38;lt;", "&lt;"),
])
def test_entities(spark, raw, text):
    assert spark.createDataFrame([(raw,)], "t string").select(decode_entities(F.col("t"))).first()[0] == text
