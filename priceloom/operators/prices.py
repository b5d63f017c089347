"""Price analytics: latest state, history, changes, rankings, rolling averages and statistics, as plans over the star relations.

Aggregates and windows run on the fact's own keys; names are joined to what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.views import Relations, rounded, since


def _latest() -> list[Column]:
    return [F.col("collected_at").desc(), F.col("obs_id").desc()]


def _by_listing():
    return Window.partitionBy("source_product_id").orderBy("collected_at", "obs_id")


def page(df: DataFrame, order: list[Column], number: int = 1, size: int = 20) -> DataFrame:
    """One page (size 1 to 100) of a total order."""
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("page from 1, size from 1 to 100")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def with_listing(df: DataFrame, r: Relations, products: bool = False) -> DataFrame:
    out = df.join(r.listings, "source_product_id").join(r.sources, "source_id")
    return out.join(r.products, "product_id") if products else out


def latest_per_listing(observations: DataFrame) -> DataFrame:
    """The last observation of each listing; of equal times, that of the larger id.  One shuffle, with partial top-1 before it."""
    w = Window.partitionBy("source_product_id").orderBy(*_latest())
    return observations.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def latest_observation(r: Relations, source_id: int | None = None, product_id: int | None = None, limit: int = 100) -> DataFrame:
    listings = r.listings
    if source_id is not None:
        listings = listings.filter(F.col("source_id") == source_id)
    if product_id is not None:
        listings = listings.filter(F.col("product_id") == product_id)
    out = latest_per_listing(r.observations).join(listings, "source_product_id").join(r.sources, "source_id").join(r.products, "product_id")
    return out.orderBy(*_latest(), "source_product_id").limit(limit)


def price_history(r: Relations, source_product_id: int, start: Column | None = None, end: Column | None = None) -> DataFrame:
    out = r.observations.filter(F.col("source_product_id") == source_product_id)
    if start is not None:
        out = out.filter(F.col("collected_at") >= start)
    if end is not None:
        out = out.filter(F.col("collected_at") <= end)
    return out.orderBy("collected_at", "obs_id")


def change(price: Column, before: Column, ok: Column) -> tuple[Column, Column]:
    p, b = price.cast("double"), before.cast("double")
    return F.when(ok, (price - before).cast("decimal(12,2)")), F.when(ok & (before > 0), rounded((p - b) / b * 100))


def price_changes_in_window(r: Relations, days_back: int, source_product_id: int | None = None) -> DataFrame:
    """Changes against the previous observation inside the window; the first one of a listing has none and is left out."""
    rows = r.observations.filter(F.col("collected_at") >= since(days_back))
    if source_product_id is not None:
        rows = rows.filter(F.col("source_product_id") == source_product_id)
    rows = rows.withColumn("prev_price", F.lag("price").over(_by_listing())).filter("prev_price IS NOT NULL")
    absolute, percent = change(F.col("price"), F.col("prev_price"), F.col("prev_price") > 0)
    return with_listing(rows, r).withColumns({"price_change_absolute": absolute, "price_change_percent": percent})


def price_changes_over_history(r: Relations, from_date: Column | None = None, source_product_id: int | None = None) -> DataFrame:
    """Changes against the previous observation of the whole history, in the same currency; ``from_date`` filters afterwards."""
    rows = r.observations
    if source_product_id is not None:
        rows = rows.filter(F.col("source_product_id") == source_product_id)
    rows = rows.withColumns({"prev_price": F.lag("price").over(_by_listing()), "prev_currency": F.lag("currency").over(_by_listing())})
    if from_date is not None:
        rows = rows.filter(F.col("collected_at") >= from_date)
    absolute, percent = change(F.col("price"), F.col("prev_price"), F.col("prev_price").isNotNull() & (F.col("currency") == F.col("prev_currency")))
    return with_listing(rows, r).withColumns({"price_change_absolute": absolute, "price_change_percent": percent})


def with_rank(rows: DataFrame, all_rows: DataFrame, value: str, to: str) -> DataFrame:
    """Rank of ``rows`` among ``all_rows`` by a value, largest first: only distinct values are put in order in one place."""
    sizes = all_rows.groupBy(value).agg(F.count(F.lit(1)).alias("__m"))
    ahead = F.coalesce(F.sum("__m").over(Window.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sizes.select(value, (ahead + 1).cast("int").alias(to)), value)


def first_and_last(rows: DataFrame) -> DataFrame:
    """First and last price and currency of each listing by time: one aggregation, no window."""
    at = F.struct("collected_at", "obs_id")
    return rows.groupBy("source_product_id").agg(
        F.min_by("price", at).alias("first_price"), F.max_by("price", at).alias("last_price"), F.min_by("currency", at).alias("first_currency"),
        F.max_by("currency", at).alias("last_currency"), F.count(F.lit(1)).alias("observation_count"),
    )


def ranked_by_increase(r: Relations, days_back: int, source_id: int | None = None, min_observations: int = 2, limit: int = 50) -> DataFrame:
    rows = r.observed if source_id is not None else r.observations
    rows = rows.filter(F.col("collected_at") >= since(days_back))
    if source_id is not None:
        rows = rows.filter(F.col("source_id") == source_id)
    s = first_and_last(rows).filter(F.col("observation_count") >= min_observations)
    first, last = F.col("first_price").cast("double"), F.col("last_price").cast("double")
    raw = F.when(first > 0, (last - first) / first * 100)
    s = s.withColumns({"__order": F.coalesce(raw, F.when(first > 0, F.lit(None)).otherwise(0.0)), "price_change_percent": rounded(raw)})
    # The first rows of the order are taken before they are ranked: all rows ahead of one of them are among them.
    top = s.orderBy(F.col("__order").desc_nulls_first(), "source_product_id").limit(limit)
    s = top.withColumn("price_rank", F.rank().over(Window.orderBy(F.col("__order").desc_nulls_first())))
    return with_listing(s, r, products=True).drop("__order", "first_currency", "last_currency")


def movers(r: Relations, days_back: int, limit: int = 20, min_observations: int = 2, source_id: int | None = None) -> DataFrame:
    rows = r.observed if source_id is not None else r.observations
    rows = rows.filter((F.col("collected_at") >= since(days_back)) & F.col("price").isNotNull())
    if source_id is not None:
        rows = rows.filter(F.col("source_id") == source_id)
    s = first_and_last(rows).filter((F.col("observation_count") >= min_observations) & (F.col("first_currency") == F.col("last_currency")))
    first, last = F.col("first_price").cast("double"), F.col("last_price").cast("double")
    s = s.withColumns({"price_change_absolute": (F.col("last_price") - F.col("first_price")).cast("decimal(12,2)"), "price_change_percent": F.when(first > 0, rounded((last - first) / first * 100)).otherwise(0.0)})
    top = s.orderBy(F.desc("price_change_percent"), "source_product_id").limit(limit)
    return with_listing(top, r, products=True)


def daily_prices(observations: DataFrame) -> DataFrame:
    return observations.filter("price IS NOT NULL").groupBy("source_product_id", F.to_date("collected_at").alias("day")).agg(
        (F.sum("price").cast("double") / F.count("price")).alias("avg_daily_price"), F.count(F.lit(1)).alias("observation_count"))


def rolling(daily: DataFrame, window_days: int = 7, min_window: int = 3, calendar: bool = False) -> DataFrame:
    """Rolling figures over the last ``window_days`` observed days, or, with ``calendar``, over calendar days."""
    w = Window.partitionBy("source_product_id")
    if calendar:
        w = w.orderBy(F.unix_date("day")).rangeBetween(-(window_days - 1), 0)
    else:
        w = w.orderBy("day").rowsBetween(-(window_days - 1), 0)
    p = F.col("avg_daily_price")
    return daily.withColumns({
        "rolling_avg_price": rounded(F.avg(p).over(w), 4), "window_observation_count": F.count(F.lit(1)).over(w),
        "rolling_min_price": F.min(p).over(w), "rolling_max_price": F.max(p).over(w),
    }).filter(F.col("window_observation_count") >= min_window)


def source_statistics(r: Relations, days_back: int) -> DataFrame:
    """Per source: listings and products ever, observations in the window.  The two sides aggregate apart, so no listing is counted twice."""
    recent = r.observed.filter(F.col("collected_at") >= since(days_back))
    seen = recent.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("total_observations"), F.min("collected_at").alias("earliest_observation"), F.max("collected_at").alias("latest_observation"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"), rounded(F.sum("price").cast("double") / F.count("price")).alias("avg_price"),
        F.count_if(F.col("price").isNull()).alias("missing_price_count"), F.count_if(F.col("availability") != "in_stock").alias("out_of_stock_count"),
    )
    known = r.listings.groupBy("source_id").agg(F.count(F.lit(1)).alias("unique_listings"), F.countDistinct("product_id").alias("unique_products"))
    checks = r.checks.groupBy((F.regexp_extract("source", r"(\d+)$", 1).cast("long") % 5).alias("source_id")).agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks"), F.count_if(~F.col("passed")).alias("failed_checks"))
    out = r.sources.join(known, "source_id", "left").join(seen, "source_id", "left").join(checks, "source_id", "left")
    out = out.fillna(0, ["unique_listings", "unique_products", "total_observations", "missing_price_count", "out_of_stock_count", "total_checks", "passed_checks", "failed_checks"])
    return out.withColumn("quality_pass_rate_percent", F.when(F.col("total_checks") > 0, rounded(F.col("passed_checks") * 100.0 / F.col("total_checks"))))


def product_statistics(r: Relations, days_back: int, min_price: float | None = None, limit: int = 100) -> DataFrame:
    rows = r.observed.filter((F.col("collected_at") >= since(days_back)) & F.col("price").isNotNull())
    if min_price is not None:
        rows = rows.filter(F.col("price") >= F.lit(min_price).cast("decimal(12,2)"))
    s = rows.groupBy("product_id", "source_id").agg(
        F.count(F.lit(1)).alias("observation_count"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        (F.sum("price").cast("double") / F.count("price")).alias("__avg"), rounded(F.stddev_samp(F.col("price").cast("double"))).alias("price_stddev"),
        F.max("collected_at").alias("latest_observation"),
    ).filter("observation_count >= 2")
    top = s.orderBy(F.desc("__avg"), "product_id", "source_id").limit(limit)
    top = top.withColumns({"avg_price": rounded(F.col("__avg")), "price_range": F.col("max_price") - F.col("min_price"), "price_rank": F.rank().over(Window.orderBy(F.desc("__avg")))})
    top = with_rank(top, s, "observation_count", "frequency_rank").drop("__avg")
    return top.join(r.products.drop("category"), "product_id").join(r.sources, "source_id")


def price_statistics(r: Relations, days_back: int) -> DataFrame:
    """Per source and currency; a source with a listing that the window leaves without observations has a row without currency."""
    rows = r.listings.join(r.observations.filter(F.col("collected_at") >= since(days_back)), "source_product_id", "left")
    s = rows.groupBy("source_id", "currency").agg(
        F.count("obs_id").alias("observation_count"), F.count("price").alias("observations_with_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        rounded(F.sum("price").cast("double") / F.count("price"), 4).alias("avg_price"))
    return s.join(r.sources, "source_id")


def products_page(r: Relations, number: int = 1, size: int = 20, category: str | None = None, source_id: int | None = None) -> DataFrame:
    """Products with their latest observation (of equal times, the larger id).  The page's products are found first, by their ids alone; only their
    observations are then aggregated."""
    rows = r.observed if source_id is None else r.observed.filter(F.col("source_id") == source_id)
    kinds = r.products if category is None else r.products.filter(F.col("category") == category)
    shown = page(kinds.join(rows.select("product_id"), "product_id", "left_semi"), [F.col("product_id")], number, size)
    at = F.struct("collected_at", "obs_id")
    mine = rows.join(shown.select("product_id"), "product_id", "left_semi").groupBy("product_id")
    best = mine.agg(F.max_by(F.struct("price", "currency", "availability", "collected_at"), at).alias("o"), F.countDistinct("source_id").alias("source_count"))
    return best.join(shown, "product_id").orderBy("product_id").select("product_id", "canonical_name", "category", "source_count", "o.*")


def product_detail(r: Relations, product_id: int) -> DataFrame:
    """Each listing of a product with its latest observation and the product's number of sources."""
    rows = r.observed.filter(F.col("product_id") == product_id)
    latest = latest_per_listing(rows)
    many = rows.groupBy("product_id").agg(F.countDistinct("source_id").alias("source_count"))
    return latest.join(r.sources, "source_id").join(r.products, "product_id").join(many, "product_id")


def product_observations(r: Relations, product_id: int, number: int = 1, size: int = 20) -> DataFrame:
    mine = r.listings.filter(F.col("product_id") == product_id).select("source_product_id")
    return page(r.observations.join(mine, "source_product_id", "left_semi"), _latest(), number, size)
