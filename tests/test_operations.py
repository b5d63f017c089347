"""Quality checks, metrics, health, telemetry, mapping, pages and the SQL guard."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from priceloom.functions import html, mapping
from priceloom.operators import assistant, telemetry
from priceloom.operators import health as H
from priceloom.operators import quality as C

AT = datetime(2026, 9, 17, 10)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([("e1", "fake_store", 10.0, "in_stock", AT), ("e2", "fake_store", 20.0, "out_of_stock", AT), ("e3", "best_buy", 30.0, "preorder", AT)], "event_id string, source string, price double, availability string, collected_at timestamp_ntz")


def _at(s):
    return F.lit(s).cast("timestamp_ntz")


def test_checks(spark, frame):
    suite = [C.RequiredFields(("event_id", "source")), C.PriceRange(), C.AllowedValues("availability", ("in_stock", "preorder")), C.Duplicates(("source",), 0.5), C.Freshness("collected_at", _at("2026-09-17 10:30:00"))]
    got = {r.check_name: (r.passed, r.failed_records, r.message) for r in C.run_suite(frame, suite).collect()}
    assert got["required_fields"][:2] == (True, 0) and got["price_validity"][:2] == (True, 0) and got["freshness"][0]
    assert got["allowed_values"] == (False, 1, "out_of_stock") and got["duplicates"] == (True, 1, "1 keys repeat")
    bad = spark.createDataFrame([(None, "y"), ("x", None), (None, "z")], "a string, b string")
    assert C.run_suite(bad, [C.RequiredFields(("a", "b"))]).first().failed_records == 3
    assert C.run_suite(bad, [C.RequiredFields(("a", "nope"))]).first().failed_records == 3
    empty = {r.check_name: r.passed for r in C.run_suite(frame.limit(0), suite).collect()}
    assert empty == {"required_fields": True, "price_validity": True, "allowed_values": True, "duplicates": True, "freshness": False}
    late = C.run_suite(frame, [C.Freshness("collected_at", _at("2026-09-17 11:00:01"))]).first()
    assert not late.passed and late.severity == "warning"
    s = C.suite_summary(C.run_suite(frame, suite)).first()
    assert (s.total, s.passed, s.failed, s.has_errors, s.has_warnings) == (5, 4, 1, True, False)


def test_metrics(spark):
    rows = spark.createDataFrame([("a", 1, Decimal(10), "in_stock"), ("a", None, None, "in_stock"), ("b", None, Decimal(20), "out_of_stock")], "source_name string, product_id long, price decimal(12,2), availability string")
    got = {(r.metric_name, r.dimension): r.value for r in C.daily_metrics(rows).collect()}
    assert got == {("observation_count", None): 3.0, ("unique_products", None): 2.0, ("avg_price", None): 15.0, ("availability_in_stock", None): 2.0, ("availability_out_of_stock", None): 1.0, ("source_observation_count", "a"): 2.0, ("source_observation_count", "b"): 1.0}
    none = {r.metric_name: r.value for r in C.daily_metrics(rows.limit(0)).collect()}
    assert none["avg_price"] == 0.0 and none["observation_count"] == 0.0
    assert rows.limit(1).select(C.replay_key(F.lit("observation_count"), F.lit("2026-09-18"), F.lit(None))).first()[0] == "observation_count:2026-09-18:_"


def outcomes(spark, *rows):
    data = [("s", i, AT, ok, records, malformed, why) for i, (ok, records, malformed, why) in enumerate(rows)]
    return spark.createDataFrame(data, "source string, seq long, ts timestamp_ntz, success boolean, total_records long, malformed_count long, failure_reason string")


@pytest.mark.parametrize(("rows", "state"), [
    ([(True, 5, 0, None)] * 3, "healthy"), ([(True, 5, 0, None), (False, 0, 0, "x"), (False, 0, 0, "y")], "unreachable"), ([(True, 5, 0, None), (False, 0, 0, "Rate limited (HTTP 429)")], "rate_limited"),
    ([(True, 5, 0, None), (False, 0, 0, "page structure changed")], "structurally_changed"), ([(True, 0, 0, None)] * 3, "empty_result"), ([(True, 10, 6, None)], "partially_parseable"),
])
def test_health(spark, rows, state):
    assert H.assess(outcomes(spark, *rows), _at("2026-09-17 10:00:10")).first().state == state


def test_health_edges(spark):
    got = H.assess(outcomes(spark, (True, 5, 0, None)), _at("2026-09-17 11:00:00"), H.Limits(most_age_seconds=60)).first()
    assert (got.state, got.freshness_state) == ("stale", "stale")
    none = H.assess(outcomes(spark), _at("2026-09-17 11:00:00"), sources=spark.createDataFrame([("n",)], "source string")).first()
    assert (none.state, none.freshness_state) == ("healthy", "never_collected")
    streak = H.assess(outcomes(spark, (True, 5, 0, None), (True, 0, 0, None), (False, 0, 0, "t"), (True, 0, 0, None)), _at("2026-09-17 11:00:00")).first()
    assert (streak.stopped_by_failure, streak.ignoring_failures) == (1, 2)


def test_telemetry(spark):
    lag = lambda *v: telemetry.lag_growth(spark.createDataFrame([("g", float(i), x) for i, x in enumerate(v)], "g string, elapsed double, lag long"), ["g"]).first().growth
    assert lag(0, 0, 0, 0) == "stable" and lag(100, 105, 98, 102, 101, 99, 103, 100) == "stable" and lag(10, 20) == "insufficient_data"
    assert lag(10, 20, 40, 80) == "growing" and lag(80, 40, 20, 10) == "shrinking" and lag(0, 0, 5, 50) == "growing"
    one = telemetry.latency_summary(spark.createDataFrame([(42.0,)], "v double"), "v").first()
    assert (one.p50, one.p99, one.mean) == (42.0, 42.0, 42.0)
    assert telemetry.latency_summary(spark.createDataFrame([], "v double"), "v").first().p50 == 0.0
    four = telemetry.latency_summary(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double"), "v").first()
    assert four.p95 == 8.95
    c = spark.createDataFrame([("s", datetime(2026, 1, 1, 0, m), v) for m, v in ((0, 10), (1, 15), (2, 3), (3, 3))], "series string, ts timestamp_ntz, value long")
    assert telemetry.rate(c, ["series"]).first().increase == 8


def test_mapping(spark):
    df = spark.createDataFrame([({"upc": "invalid", "mpn": "AB-12"},), ({"gtin": "12345678", "upc": "012345678905"},), ({"title": "x"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(mapping.product_key("ebay", F.col("m"))).collect()] == ["ebay:AB-12", "ebay:12345678", None, None]
    got = spark.createDataFrame([("Brand New ",), ("odd",), (None,)], "c string").select(mapping.condition(F.col("c"))).collect()
    assert [r[0] for r in got] == ["new", None, None]
    s, raw = mapping.unqualified(F.lit("a:b:c"))
    assert tuple(spark.range(1).select(s, raw).first()) == ("a", "b:c")


BOOKS = """<ul class="breadcrumb"><li><a href="#">Home</a></li><li class="active">Travel</li></ul><section>
<article class="product_pod"><h3><a href="../a_1/index.html" title="A">A ...</a></h3><p class="price_color">&pound;51.77</p><p class="instock availability"><i></i> In stock</p></article>
<article class="product_pod"><h3><a href="b_2/index.html" title="B">B</a></h3><p class="price_color">free</p><p class="availability">Out of stock</p></article>
<article class="product_pod"><p class="price_color">&pound;1.00</p></article></section><li class="next"><a href="page-2.html">next</a></li>"""
CARDS = """<nav class="breadcrumb"><a href="/">Home</a> / <span>Mixed</span></nav><div class="product-grid">
<article class="product-card"><h2 class="product-name"><a href="/product/3001-good" title="Good">Good</a></h2><span class="price">$25.00</span><span class="availability">In Stock</span></article>
<article class="product-card"><h2><a href="" title="">Broken</a></h2></article><article class="product-card"><span class="price">$15.00</span></article></div>"""


def test_pages(spark):
    df = spark.createDataFrame([("http://s/c/p.html", BOOKS), ("http://e/", ""), ("http://n/", None)], "url string, html string")
    parsed = html.parse_pages(df, html.BOOKS)
    got = [tuple(r) for r in html.products_of(parsed, html.BOOKS).orderBy("ordinal").select("product_id", "name", "price", "currency", "availability", "category", "url").collect()]
    assert got == [("a_1", "A", Decimal("51.77"), "GBP", "in_stock", "Travel", "http://s/a_1/index.html"), ("b_2", "B", None, "GBP", "out_of_stock", "Travel", "http://s/c/b_2/index.html")]
    assert [r.malformed for r in parsed.filter("malformed IS NOT NULL").collect()] == ["missing link"]
    assert parsed.filter("next_url IS NOT NULL").first().next_url == "http://s/c/page-2.html"
    cards = html.parse_pages(spark.createDataFrame([("http://s/", CARDS), ("http://s/x", "<div class='new'><em>$1</em></div>")], "url string, html string"), html.CARDS)
    assert [r.product_id for r in html.products_of(cards, html.CARDS).collect()] == ["3001"]
    assert sorted(r.malformed for r in cards.filter("malformed IS NOT NULL").collect()) == ["missing link", "missing url"]
    assert [r.page_url for r in cards.filter("structural_change").collect()] == ["http://s/x"]


def test_guard(spark):
    ok = lambda q: assistant.why_not_readonly(spark, q) is None
    assert ok("SELECT 1") and ok("WITH a AS (SELECT 1) SELECT * FROM a") and ok("SELECT 'drop table x'")
    for q in ("", ";", "DROP TABLE x", "INSERT INTO t SELECT 1", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT 1; SELECT 2", "CREATE TABLE t AS SELECT 1", "SET a=b", "not sql"):
        assert not ok(q), q
    assert assistant.ask(spark, "SELECT 2 AS x").first().x == 2
    with pytest.raises(PermissionError):
        assistant.ask(spark, "DROP TABLE x")
    df = spark.createDataFrame([("pricing of x",), ("",), ("Sources and their freshness",), (None,)], "q string")
    assert [r[0].intent for r in df.select(assistant.classify(F.col("q"))).collect()] == ["price_analytics", "general", "source_health", "general"]
