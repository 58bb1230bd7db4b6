"""The crawl loop: failed pages come back when due, successes never do."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from vitrine import app
from vitrine.functions.money import price_amount
from vitrine.operators import crawl
from vitrine.operators.currency import prices_in_usd
from vitrine.operators.pages import extract_product_info
from vitrine.sources.currency_list import currency_list

START = datetime.datetime(2024, 1, 1)


def hour(n):
    return START + datetime.timedelta(hours=n)


def results(spark, rows):
    return spark.createDataFrame([(u, hour(h), e) for u, h, e in rows], "current_url string, fetched_at timestamp, error string")


ROUNDS = [
    [("ok", 0, None), ("fails", 0, "x"), ("later", 0, "x"), ("", 0, "x"), (None, 0, "x"), ("twice", 0, "x"), ("twice", 1, "y")],
    [("fails", 2, "x"), ("later", 2, "z")],
    [("fails", 6, "x"), ("later", 6, None)],
]


@pytest.fixture(scope="module")
def parts(spark):
    return [crawl.reduce_results(results(spark, r), f"r{n}") for n, r in enumerate(ROUNDS)]


def states(parts, **settings):
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return {r.current_url: r for r in crawl.crawl_states(crawl.combine_results(whole), **settings).collect()}


def test_states_add_up_in_any_order_and_grouping(spark, parts):
    want = states(parts)
    assert states(parts[::-1]) == want == states([*parts, parts[1]])  # a round stored twice counts once
    folded = crawl.combine_results(parts[0].unionByName(parts[1]))
    assert states([folded, parts[2]]) == want
    got = {u: (r.attempts, r.succeeded_at, r.last_error, r.due_at) for u, r in want.items()}
    assert got == {"ok": (1, hour(0), None, None), "fails": (3, None, "x", hour(6 + 4)), "later": (3, hour(6), "z", None),
                   "twice": (2, None, "y", hour(1 + 2))}


def test_pause_is_bounded_and_pages_are_given_up(spark):
    tries = [crawl.reduce_results(results(spark, [("u", 100 * n, "x")]), f"r{n}") for n in range(7)]
    assert states(tries)["u"].due_at == hour(600 + 64)
    assert states(tries, longest_pause=7200)["u"].due_at == hour(602)
    assert states(tries, attempts=7)["u"].due_at is None
    assert crawl.outcome_counts(crawl.crawl_states(tries[0])).collect() == [("retry", 1, 1)]


def test_due_pages(spark, parts):
    prd = spark.createDataFrame([("1", "ok"), ("2", "fails"), ("2", "fails"), ("3", "later"), ("4", "new"), ("5", ""), ("6", "twice")],
                                "product_id string, current_url string")
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    known = crawl.crawl_states(crawl.combine_results(whole))

    def due(at):
        return [tuple(r) for r in crawl.due_pages(prd, known, F.lit(at)).collect()]

    assert due(hour(2)) == [("4", "new")]
    assert due(hour(3)) == [("4", "new"), ("6", "twice")]
    assert due(hour(10)) == [("2", "fails"), ("4", "new"), ("6", "twice")]
    assert crawl.due_pages(prd, None).count() == 5


def test_failed_page_returns_through_the_command_line(spark, lines, tmp_path):
    """Worklist, fetch, extract, merge; the failed page is fetched again and merged then."""
    root = str(tmp_path / "w")
    from vitrine.streaming.jobs import warehouse_writer

    warehouse_writer(root, ["dim_product", "dim_prd"])(lines, 0)
    app.main(["worklist", "--root", root])
    todo = [r.current_url for r in spark.read.parquet(f"{root}/crawl_worklist").collect()]
    good, bad = todo[0], todo[1]
    html = "<h1>Ring</h1>"

    def fetch(n, rows):
        path = str(tmp_path / f"pages{n}")
        spark.createDataFrame(rows, "url string, html string").write.parquet(path)
        for _ in range(2):
            app.main(["extract", "--root", root, "--pages", path])

    def merged():
        app.main(["merge", "--root", root])
        return spark.read.parquet(f"{root}/dim_product_final").where("product_name = 'N/A'").count()

    fetch(1, [(good, html), (bad, None)])
    assert merged() == 0
    known = {r.current_url: r for r in app.crawl_state(spark, app.parser().parse_args(["worklist", "--root", root])).collect()}
    assert known[bad].attempts == 1 and known[bad].due_at > known[bad].last_failed_at and known[good].due_at is None
    app.main(["worklist", "--root", root])
    left = {r.current_url for r in spark.read.parquet(f"{root}/crawl_worklist").collect()}
    assert good not in left and bad not in left  # not due yet
    fetch(2, [(good, None), (bad, html)])
    app.main(["compact", "--root", root])
    known = {r.current_url: r for r in app.crawl_state(spark, app.parser().parse_args(["worklist", "--root", root])).collect()}
    assert known[bad].attempts == 2 and known[bad].succeeded_at and known[good].attempts == 1
    merged()
    assert spark.read.parquet(f"{root}/dim_product_final").where("product_name = 'Ring'").count() >= 2


def test_structured_prices(spark):
    def ld(price, currency):
        return ('<script type="application/ld+json">{"@type":"Product","name":"n","offers":{"price":"%s","priceCurrency":"%s"}}</script>'
                % (price, currency))

    pages = spark.createDataFrame([("a", ld("1.500", "EUR")), ("b", '<i class="price">EUR 1.500</i>'), ("c", ld("0.500", "EUR")),
                                   ("d", '<i class="price">0,999 €</i>'), ("e", '<i class="price">KWD 1.500</i>'), ("f", None),
                                   ("g", '<i class="price">-12,50 €</i>'), ("h", '<i class="price">VND 1.500.000</i>'),
                                   ("i", '<i class="price">EUR 10.500</i>')], "url string, html string")
    info = extract_product_info(pages, structured=True)
    got = {r.current_url: r.amount for r in prices_in_usd(info, currency_list(spark)).collect()}
    assert {u: None if a is None else float(a) for u, a in got.items()} == {
        "a": 1.5, "b": 1500.0, "c": 0.5, "d": 0.999, "e": 1.5, "f": None, "g": -12.5, "h": 1500000.0, "i": 10500.0}
    texts = spark.createDataFrame([("EUR 0.500",), ("0,999 €",), ("100.000",), ("00.500",)], "p string")
    assert rows_of(texts.select("p", price_amount(F.col("p")).cast("double"))) == [
        ("0,999 €", 0.999), ("00.500", 0.5), ("100.000", 100000.0), ("EUR 0.500", 0.5)]
