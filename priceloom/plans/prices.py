"""Warehouse analytics and read models over prices (Q1 to Q14) and their isolated parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.operators import prices as P
from priceloom.plans.registry import query
from priceloom.views import AS_OF, DAYS_BACK, Relations, as_of, since, sql_rounded

RECENT = f"collected_at >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS_BACK} DAY"
OBS = ["obs_id", "source_product_id", "price", "currency", "availability", "collected_at"]
LIST = ", ".join(OBS)


@query("q01_latest_observation", f"""SELECT {LIST}, external_id, source_id, source_name, product_id, canonical_name, category FROM
(SELECT *, row_number() OVER (PARTITION BY source_product_id ORDER BY collected_at DESC, obs_id DESC) AS rn FROM observations)
JOIN listings USING (source_product_id) JOIN sources USING (source_id) JOIN products USING (product_id) WHERE rn = 1
ORDER BY collected_at DESC, obs_id DESC, source_product_id LIMIT 100""")
def q01(r: Relations) -> DataFrame:
    return P.latest_observation(r).select(*OBS, "external_id", "source_id", "source_name", "product_id", "canonical_name", "category")


@query("q01_latest_observation_of_source", f"""SELECT {LIST}, product_id FROM
(SELECT *, row_number() OVER (PARTITION BY source_product_id ORDER BY collected_at DESC, obs_id DESC) AS rn FROM observations)
JOIN listings USING (source_product_id) WHERE rn = 1 AND source_id = 2 ORDER BY collected_at DESC, obs_id DESC, source_product_id LIMIT 100""")
def q01_source(r: Relations) -> DataFrame:
    return P.latest_observation(r, source_id=2).select(*OBS, "product_id")


@query("q02_price_history", f"""SELECT {LIST} FROM observations WHERE source_product_id = 20000007 AND collected_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2001-06-30'""")
def q02(r: Relations) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    return P.price_history(r, 20_000_007, at("1996-01-01"), at("2001-06-30")).select(*OBS)


CHANGE = f"""CASE WHEN {{0}} THEN (price - prev_price)::DECIMAL(12,2) END AS price_change_absolute,
CASE WHEN {{0}} AND prev_price > 0 THEN {sql_rounded("((price::DOUBLE - prev_price::DOUBLE) / prev_price::DOUBLE * 100)")} END AS price_change_percent"""


@query("q03_price_change_analysis", f"""SELECT {LIST}, prev_price, external_id, source_name, {CHANGE.format("prev_price > 0")} FROM
(SELECT *, lag(price) OVER (PARTITION BY source_product_id ORDER BY collected_at, obs_id) AS prev_price FROM observations WHERE {RECENT})
JOIN listings USING (source_product_id) JOIN sources USING (source_id) WHERE prev_price IS NOT NULL""")
def q03(r: Relations) -> DataFrame:
    return P.price_changes_in_window(r, DAYS_BACK).select(*OBS, "prev_price", "external_id", "source_name", "price_change_absolute", "price_change_percent")


FIRST_LAST = """SELECT source_product_id, arg_min(ROW(price), ROW(collected_at, obs_id))[1] AS first_price, arg_max(ROW(price), ROW(collected_at, obs_id))[1] AS last_price,
arg_min(currency, ROW(collected_at, obs_id)) AS first_currency, arg_max(currency, ROW(collected_at, obs_id)) AS last_currency, count(*) AS observation_count FROM observations"""
_RAW = "CASE WHEN first_price > 0 THEN (last_price::DOUBLE - first_price::DOUBLE) / first_price::DOUBLE * 100 END"


@query("q04_ranked_by_increase", f""", fl AS ({FIRST_LAST} WHERE {RECENT} GROUP BY 1 HAVING count(*) >= 2),
p AS (SELECT *, {_RAW} AS raw, CASE WHEN first_price > 0 THEN {_RAW} ELSE 0 END AS ord FROM fl),
k AS (SELECT *, rank() OVER (ORDER BY ord DESC NULLS FIRST) AS price_rank FROM p ORDER BY price_rank, source_product_id LIMIT 50)
SELECT source_product_id, first_price, last_price, observation_count, {sql_rounded("raw")} AS price_change_percent, price_rank, external_id, source_name, canonical_name
FROM k JOIN listings USING (source_product_id) JOIN sources USING (source_id) JOIN products USING (product_id)""")
def q04(r: Relations) -> DataFrame:
    return P.ranked_by_increase(r, DAYS_BACK).select("source_product_id", "first_price", "last_price", "observation_count", "price_change_percent", "price_rank", "external_id", "source_name", "canonical_name")


@query("q05_latest_record", f"""SELECT {LIST} FROM (SELECT *, row_number() OVER (PARTITION BY source_product_id ORDER BY collected_at DESC, obs_id DESC) AS rn FROM observed) WHERE rn = 1""")
def q05(r: Relations) -> DataFrame:
    return P.latest_per_listing(r.observations).select(*OBS)


DAILY = "SELECT source_product_id, collected_at::DATE AS day, sum(price)::DOUBLE / count(price) AS avg_daily_price, count(*) AS observation_count FROM observations WHERE price IS NOT NULL GROUP BY 1, 2"


def _rolling_sql(frame: str) -> str:
    w = f"OVER (PARTITION BY source_product_id ORDER BY {frame})"
    return f""", daily AS ({DAILY}), roll AS (SELECT *, avg(avg_daily_price) {w} AS a, count(*) {w} AS window_observation_count,
min(avg_daily_price) {w} AS rolling_min_price, max(avg_daily_price) {w} AS rolling_max_price FROM daily)
SELECT source_product_id, day::VARCHAR AS day, avg_daily_price, observation_count, {sql_rounded("a", 4)} AS rolling_avg_price, window_observation_count, rolling_min_price, rolling_max_price, external_id, source_name
FROM roll JOIN listings USING (source_product_id) JOIN sources USING (source_id) WHERE window_observation_count >= 3"""


def _roll() -> list:
    return [F.col("source_product_id"), F.col("day").cast("string").alias("day"), *map(F.col, ["avg_daily_price", "observation_count", "rolling_avg_price", "window_observation_count", "rolling_min_price", "rolling_max_price", "external_id", "source_name"])]


@query("q06_rolling_average", _rolling_sql("day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"))
def q06(r: Relations) -> DataFrame:
    return P.with_listing(P.rolling(P.daily_prices(r.observations)), r).select(*_roll())


@query("q06_rolling_average_calendar", _rolling_sql("day RANGE BETWEEN INTERVAL 729 DAY PRECEDING AND CURRENT ROW"))
def q06_calendar(r: Relations) -> DataFrame:
    return P.with_listing(P.rolling(P.daily_prices(r.observations), 730, 3, calendar=True), r).select(*_roll())


@query("q07_source_statistics", f""", seen AS (SELECT source_id, count(*) AS total_observations, min(collected_at) AS earliest_observation, max(collected_at) AS latest_observation,
min(price) AS min_price, max(price) AS max_price, {sql_rounded("(sum(price)::DOUBLE / count(price))")} AS avg_price, count(*) FILTER (WHERE price IS NULL) AS missing_price_count,
count(*) FILTER (WHERE availability <> 'in_stock') AS out_of_stock_count FROM observed WHERE {RECENT} GROUP BY 1),
known AS (SELECT source_id, count(*) AS unique_listings, count(DISTINCT product_id) AS unique_products FROM listings GROUP BY 1),
qc AS (SELECT regexp_extract(source, '([0-9]+)$', 1)::BIGINT % 5 AS source_id, count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks, count(*) FILTER (WHERE NOT passed) AS failed_checks FROM checks GROUP BY 1)
SELECT source_id, source_name, coalesce(unique_listings, 0) AS unique_listings, coalesce(unique_products, 0) AS unique_products, coalesce(total_observations, 0) AS total_observations, earliest_observation, latest_observation,
min_price, max_price, avg_price, coalesce(missing_price_count, 0) AS missing_price_count, coalesce(out_of_stock_count, 0) AS out_of_stock_count, coalesce(total_checks, 0) AS total_checks, coalesce(passed_checks, 0) AS passed_checks,
coalesce(failed_checks, 0) AS failed_checks, CASE WHEN total_checks > 0 THEN {sql_rounded("(passed_checks * 100.0::DOUBLE / total_checks)")} END AS quality_pass_rate_percent
FROM sources LEFT JOIN known USING (source_id) LEFT JOIN seen USING (source_id) LEFT JOIN qc USING (source_id)""")
def q07(r: Relations) -> DataFrame:
    return P.source_statistics(r, DAYS_BACK)


@query("q08_product_statistics", f""", s AS (SELECT product_id, source_id, count(*) AS observation_count, min(price) AS min_price, max(price) AS max_price, sum(price)::DOUBLE / count(price) AS a,
stddev_samp(price::DOUBLE) AS sd, max(collected_at) AS latest_observation FROM observed WHERE {RECENT} AND price IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
k AS (SELECT *, rank() OVER (ORDER BY a DESC) AS price_rank, rank() OVER (ORDER BY observation_count DESC) AS frequency_rank FROM s ORDER BY price_rank, product_id, source_id LIMIT 100)
SELECT product_id, source_id, canonical_name, source_name, observation_count, min_price, max_price, {sql_rounded("a")} AS avg_price, {sql_rounded("sd")} AS price_stddev, latest_observation, price_rank, frequency_rank,
max_price - min_price AS price_range FROM k JOIN products USING (product_id) JOIN sources USING (source_id)""")
def q08(r: Relations) -> DataFrame:
    return P.product_statistics(r, DAYS_BACK)


@query("q09_price_changes", f"""SELECT {LIST}, prev_price, prev_currency, external_id, source_name, {CHANGE.format("prev_price IS NOT NULL AND currency = prev_currency")} FROM
(SELECT *, lag(price) OVER w AS prev_price, lag(currency) OVER w AS prev_currency FROM observations WINDOW w AS (PARTITION BY source_product_id ORDER BY collected_at, obs_id))
JOIN listings USING (source_product_id) JOIN sources USING (source_id) WHERE {RECENT}""")
def q09(r: Relations) -> DataFrame:
    return P.price_changes_over_history(r, since(DAYS_BACK)).select(*OBS, "prev_price", "prev_currency", "external_id", "source_name", "price_change_absolute", "price_change_percent")


@query("q09_price_changes_page", f"""SELECT {LIST}, prev_price, {CHANGE.format("prev_price IS NOT NULL AND currency = prev_currency")} FROM
(SELECT *, lag(price) OVER w AS prev_price, lag(currency) OVER w AS prev_currency FROM observations WINDOW w AS (PARTITION BY source_product_id ORDER BY collected_at, obs_id))
WHERE {RECENT} ORDER BY collected_at DESC, obs_id DESC, source_product_id LIMIT 20 OFFSET 40""")
def q09_page(r: Relations) -> DataFrame:
    rows = P.price_changes_over_history(r, since(DAYS_BACK))
    return P.page(rows, [F.desc("collected_at"), F.desc("obs_id"), F.col("source_product_id")], 3, 20).select(*OBS, "prev_price", "price_change_absolute", "price_change_percent")


@query("a10_price_change_total", f"SELECT count(*) AS total FROM observations WHERE {RECENT}")
def a10(r: Relations) -> DataFrame:
    return P.price_changes_over_history(r, since(DAYS_BACK)).agg(F.count(F.lit(1)).alias("total"))


@query("q10_price_movers", f""", fl AS ({FIRST_LAST} WHERE {RECENT} AND price IS NOT NULL GROUP BY 1 HAVING count(*) >= 2),
p AS (SELECT *, CASE WHEN first_price > 0 THEN {sql_rounded("((last_price::DOUBLE - first_price::DOUBLE) / first_price::DOUBLE * 100)")} ELSE 0 END AS price_change_percent FROM fl WHERE first_currency = last_currency ORDER BY price_change_percent DESC, source_product_id LIMIT 20)
SELECT source_product_id, external_id, source_name, canonical_name, first_currency AS currency, first_price, last_price, (last_price - first_price)::DECIMAL(12,2) AS price_change_absolute, price_change_percent, observation_count
FROM p JOIN listings USING (source_product_id) JOIN sources USING (source_id) JOIN products USING (product_id)""")
def q10(r: Relations) -> DataFrame:
    return P.movers(r, DAYS_BACK).select("source_product_id", "external_id", "source_name", "canonical_name", F.col("first_currency").alias("currency"), "first_price", "last_price", "price_change_absolute", "price_change_percent", "observation_count")


@query("q11_price_statistics", f"""SELECT source_id, source_name, currency, count(obs_id) AS observation_count, count(price) AS observations_with_price, min(price) AS min_price, max(price) AS max_price,
{sql_rounded("(sum(price)::DOUBLE / nullif(count(price), 0))", 4)} AS avg_price FROM listings LEFT JOIN (SELECT * FROM observations WHERE {RECENT}) USING (source_product_id) JOIN sources USING (source_id) GROUP BY ALL""")
def q11(r: Relations) -> DataFrame:
    return P.price_statistics(r, DAYS_BACK)


@query("q12_products", """, b AS (SELECT product_id, arg_max(obs_id, ROW(collected_at, obs_id)) AS k, arg_max(ROW(price, currency, availability, collected_at), ROW(collected_at, obs_id)) AS o, count(DISTINCT source_id) AS source_count FROM observed GROUP BY 1)
SELECT product_id, canonical_name, category, source_count, o[1] AS price, o[2] AS currency, o[3] AS availability, o[4] AS collected_at FROM b JOIN products USING (product_id) ORDER BY product_id LIMIT 20 OFFSET 20""")
def q12(r: Relations) -> DataFrame:
    return P.products_page(r, 2, 20)


@query("q12_products_of_source", """, b AS (SELECT product_id, arg_max(ROW(price, currency, availability, collected_at), ROW(collected_at, obs_id)) AS o FROM observed WHERE source_id = 1 GROUP BY 1)
SELECT product_id, o[1] AS price, o[4] AS collected_at FROM b ORDER BY product_id LIMIT 20""")
def q12_source(r: Relations) -> DataFrame:
    return P.products_page(r, 1, 20, source_id=1).select("product_id", "price", "collected_at")


@query("q13_product_detail", f"""SELECT {LIST}, source_id, source_name, product_id, canonical_name, category, event_id, (SELECT count(DISTINCT source_id) FROM observed WHERE product_id = 7) AS source_count FROM
(SELECT *, row_number() OVER (PARTITION BY source_product_id ORDER BY collected_at DESC, obs_id DESC) AS rn FROM observed WHERE product_id = 7) JOIN sources USING (source_id) JOIN products USING (product_id) WHERE rn = 1""")
def q13(r: Relations) -> DataFrame:
    return P.product_detail(r, 7)


@query("q14_product_observations", f"SELECT {LIST}, event_id FROM observations WHERE source_product_id IN (SELECT source_product_id FROM listings WHERE product_id = 7) ORDER BY collected_at DESC, obs_id DESC LIMIT 20")
def q14(r: Relations) -> DataFrame:
    return P.product_observations(r, 7)


# Isolated parts.


@query("j01_star", f"SELECT {LIST}, source_name, canonical_name, category FROM observations JOIN listings USING (source_product_id) JOIN sources USING (source_id) JOIN products USING (product_id)")
def j01(r: Relations) -> DataFrame:
    return P.with_listing(r.observations, r, products=True).select(*OBS, "source_name", "canonical_name", "category")


@query("j03_left_with_time_in_on", f"""SELECT source_id, source_name, count(obs_id) AS n, count(DISTINCT source_product_id) AS listings FROM sources LEFT JOIN listings USING (source_id)
LEFT JOIN (SELECT obs_id, source_product_id FROM observations WHERE collected_at >= TIMESTAMP '{AS_OF}' - INTERVAL 40 DAY) USING (source_product_id) GROUP BY ALL""")
def j03(r: Relations) -> DataFrame:
    recent = r.observations.filter(F.col("collected_at") >= since(40))
    return r.sources.join(r.listings, "source_id", "left").join(recent, "source_product_id", "left").groupBy("source_id", "source_name").agg(F.count("obs_id").alias("n"), F.countDistinct("source_product_id").alias("listings"))


@query("j10_last_seen", f"""SELECT source_id, source_name, max(collected_at) AS last_seen, count(obs_id) AS total, date_diff('second', max(collected_at), TIMESTAMP '{AS_OF}')::DOUBLE AS age_seconds
FROM sources LEFT JOIN listings USING (source_id) LEFT JOIN observations USING (source_product_id) GROUP BY ALL""")
def j10(r: Relations) -> DataFrame:
    # The newest observation by listing first, so that the joins see one row for each listing.
    newest = r.observations.groupBy("source_product_id").agg(F.max("collected_at").alias("at"), F.count(F.lit(1)).alias("n"))
    out = r.sources.join(r.listings, "source_id", "left").join(newest, "source_product_id", "left").groupBy("source_id", "source_name").agg(F.max("at").alias("last_seen"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return out.withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("last_seen"), as_of()).cast("double"))


@query("j16_listing_to_product", """, maps AS (SELECT source_product_id, product_id, obs_id FROM observed WHERE product_id % 3 <> 0),
last AS (SELECT source_product_id, arg_max(product_id, obs_id) AS mapped FROM maps GROUP BY 1)
SELECT source_product_id, mapped AS product_key FROM listings LEFT JOIN last USING (source_product_id)""")
def j16(r: Relations) -> DataFrame:
    last = r.observed.filter("product_id % 3 <> 0").groupBy("source_product_id").agg(F.max_by("product_id", "obs_id").alias("product_key"))
    return r.listings.select("source_product_id").join(last, "source_product_id", "left")


@query("v16_products_in_stock_somewhere", "SELECT product_id, canonical_name FROM products WHERE product_id IN (SELECT product_id FROM observed WHERE availability = 'in_stock')")
def v16(r: Relations) -> DataFrame:
    return r.products.join(r.observed.filter("availability = 'in_stock'").select("product_id"), "product_id", "left_semi").select("product_id", "canonical_name")


@query("j14_products_never_seen", "SELECT product_id FROM products WHERE product_id NOT IN (SELECT product_id FROM observed WHERE currency = 'USD' AND source_id = 2 AND collected_at < TIMESTAMP '1998-01-01')")
def j14(r: Relations) -> DataFrame:
    return r.products.join(r.observed.filter("currency = 'USD' AND source_id = 2 AND collected_at < '1998-01-01'").select("product_id"), "product_id", "left_anti").select("product_id")


@query("a02_filtered_aggregates", f"""SELECT source_product_id, min(price) FILTER (WHERE {RECENT}) AS min_recent, max(price) FILTER (WHERE {RECENT}) AS max_recent, count(*) FILTER (WHERE price IS NULL) AS missing, count(*) AS n FROM observations GROUP BY 1""")
def a02(r: Relations) -> DataFrame:
    new = F.col("collected_at") >= since(DAYS_BACK)
    return r.observations.groupBy("source_product_id").agg(F.min(F.when(new, F.col("price"))).alias("min_recent"), F.max(F.when(new, F.col("price"))).alias("max_recent"), F.count_if(F.col("price").isNull()).alias("missing"), F.count(F.lit(1)).alias("n"))


@query("a03_daily_mean", f"SELECT source_product_id, day::VARCHAR AS day, avg_daily_price, observation_count FROM ({DAILY})")
def a03(r: Relations) -> DataFrame:
    return P.daily_prices(r.observations).withColumn("day", F.col("day").cast("string"))


@query("a09_latest_time_and_sources", "SELECT product_id, max(collected_at) AS latest, count(DISTINCT source_id) AS source_count FROM observed GROUP BY 1")
def a09(r: Relations) -> DataFrame:
    return r.observed.groupBy("product_id").agg(F.max("collected_at").alias("latest"), F.countDistinct("source_id").alias("source_count"))


@query("w12_first_and_last", FIRST_LAST + " GROUP BY 1")
def w12(r: Relations) -> DataFrame:
    return P.first_and_last(r.observations)


@query("w06_global_rank", "SELECT source_product_id, n, rank() OVER (ORDER BY n DESC) AS place FROM (SELECT source_product_id, count(*) AS n FROM observations GROUP BY 1)")
def w06(r: Relations) -> DataFrame:
    n = r.observations.groupBy("source_product_id").agg(F.count(F.lit(1)).alias("n"))
    return P.with_rank(n, n, "n", "place").select("source_product_id", "n", "place")


@query("l04_mixed_order_page", f"SELECT obs_id, source_product_id, price FROM observations ORDER BY price DESC NULLS FIRST, obs_id, source_product_id LIMIT 50")
def l04(r: Relations) -> DataFrame:
    return r.observations.select("obs_id", "source_product_id", "price").orderBy(F.col("price").desc_nulls_first(), "obs_id", "source_product_id").limit(50)


@query("l05_newest_capped", f"SELECT {LIST} FROM observations ORDER BY collected_at DESC, obs_id DESC, source_product_id LIMIT 100000")
def l05(r: Relations) -> DataFrame:
    return r.observations.orderBy(F.desc("collected_at"), F.desc("obs_id"), "source_product_id").limit(100_000).select(*OBS)
