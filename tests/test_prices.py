"""The price fixture of 14 observations with hand-computed results."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from priceloom import views
from priceloom.operators import prices as P

BASE = datetime(2026, 9, 1)
POINTS = {1: [(0, 100), (1, 110), (2, 120), (3, 115), (4, 125)], 2: [(0, 50), (2, 50), (4, 50)], 3: [(0, 95), (2, 105), (4, 105)], 4: [(0, None), (2, 75), (4, 80)]}
LISTINGS = [(1, 1, 1, "EXT-A-001"), (2, 1, 2, "EXT-A-002"), (3, 2, 1, "EXT-B-001"), (4, 2, 3, "EXT-B-003")]


class Fixture:
    def __init__(self, spark):
        rows = [(10 * s + i, f"e{s}-{i}", s, Decimal(p) if p is not None else None, "USD", "in_stock" if p is not None else "out_of_stock", BASE + timedelta(days=d)) for s, points in POINTS.items() for i, (d, p) in enumerate(points)]
        self.observations = spark.createDataFrame(rows, "obs_id long, event_id string, source_product_id long, price decimal(12,2), currency string, availability string, collected_at timestamp_ntz")
        self.listings = spark.createDataFrame(LISTINGS, "source_product_id long, source_id long, product_id long, external_id string")
        self.sources = spark.createDataFrame([(1, "Source A"), (2, "Source B")], "source_id long, source_name string")
        self.products = spark.createDataFrame([(1, "Product Alpha", "c"), (2, "Product Beta", "c"), (3, "Product Gamma", "d")], "product_id long, canonical_name string, category string")
        self.observed = self.observations.join(self.listings.drop("external_id"), "source_product_id")
        self.checks = spark.createDataFrame([], "check_name string, source string, passed boolean")


@pytest.fixture
def r(spark, monkeypatch):
    monkeypatch.setattr(views, "AS_OF", "2026-09-06 00:00:00")
    return Fixture(spark)


def rows(df, *cols):
    return [tuple(x) for x in df.select(*cols).collect()]


def test_latest(r):
    got = {x.source_product_id: x.price for x in P.latest_observation(r).collect()}
    assert got == {1: Decimal(125), 2: Decimal(50), 3: Decimal(105), 4: Decimal(80)}
    assert P.latest_observation(r, source_id=1).count() == 2 and P.latest_observation(r, product_id=1).count() == 2


def test_history(r):
    assert P.price_history(r, 1).count() == 5
    at = lambda d: F.lit(str(BASE + timedelta(days=d))).cast("timestamp_ntz")
    assert P.price_history(r, 1, at(2), at(4)).count() == 3


def test_changes(r):
    got = rows(P.price_changes_in_window(r, 30, 1).orderBy("collected_at"), "price_change_absolute", "price_change_percent")
    assert [a for a, _ in got] == [10, 10, -5, 10] and got[0][1] == 10.0 and got[-1][1] == 8.7
    assert rows(P.price_changes_in_window(r, 30, 2), "price_change_absolute") == [(0,), (0,)]
    inside = P.price_changes_over_history(r, F.lit(str(BASE + timedelta(days=4))).cast("timestamp_ntz"), 1)
    assert rows(inside, "prev_price") == [(115,)]  # the predecessor lies before the filter


def test_ranking(r):
    got = {x.source_product_id: (x.price_change_percent, x.price_rank) for x in P.ranked_by_increase(r, 30).collect()}
    assert got == {1: (25.0, 1), 3: (10.53, 2), 2: (0.0, 3), 4: (None, 3)}


def test_movers(r):
    assert rows(P.movers(r, 30).orderBy(F.desc("price_change_percent")), "source_product_id", "price_change_percent") == [(1, 25.0), (3, 10.53), (4, 6.67), (2, 0.0)]


def test_rolling(r):
    got = rows(P.rolling(P.daily_prices(r.observations).filter("source_product_id = 1"), 3, 2).orderBy("day"), "rolling_avg_price", "window_observation_count")
    assert got == [(105.0, 2), (110.0, 3), (115.0, 3), (120.0, 3)]


def test_source_statistics(r):
    got = {x.source_name: (x.unique_listings, x.unique_products, x.total_observations, x.missing_price_count) for x in P.source_statistics(r, 30).collect()}
    assert got == {"Source A": (2, 2, 8, 0), "Source B": (2, 2, 6, 1)}


def test_pages(r):
    assert rows(P.products_page(r, 2, 2), "product_id") == [(3,)]
    with pytest.raises(ValueError, match="page"):
        P.page(r.observations, [F.col("obs_id")], 1, 101)


def test_plans_have_no_broadcast_of_facts_and_prune_columns(r, spark, sf_dir):
    plan = P.latest_per_listing(views.Relations(spark, sf_dir).observations).select("source_product_id", "price")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "l_tax" not in plan
