"""Small queries that show a part of the inventory by itself: single joins, aggregates, windows, checks and predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from priceloom.functions import mapping, text
from priceloom.operators import health as H
from priceloom.operators import prices as P
from priceloom.operators import quality as C
from priceloom.operators import telemetry as T
from priceloom.plans.operations import HEALTH, STATUS, _assessed, _runs
from priceloom.plans.prices import LIST, OBS, RECENT
from priceloom.plans.registry import query
from priceloom.views import AS_OF, DAYS_BACK, Relations, as_of, since, sql_rounded

# Joins.


@query("j02_inner_three_way", f"SELECT {LIST}, external_id, source_name FROM observations JOIN listings USING (source_product_id) JOIN sources USING (source_id)")
def j02(r: Relations) -> DataFrame:
    return P.with_listing(r.observations, r).select(*OBS, "external_id", "source_name")


@query("j04_left_chain_to_checks", """SELECT source_id, count(check_id) AS checks FROM sources LEFT JOIN (SELECT *, regexp_extract(source, '([0-9]+)$', 1)::BIGINT % 5 AS source_id FROM checks) USING (source_id) GROUP BY 1""")
def j04(r: Relations) -> DataFrame:
    by = r.checks.groupBy((F.regexp_extract("source", r"(\d+)$", 1).cast("long") % 5).alias("source_id")).agg(F.count(F.lit(1)).alias("checks"))
    return r.sources.join(by, "source_id", "left").select("source_id", F.coalesce("checks", F.lit(0)).alias("checks"))


@query("j06_late_lookup", "SELECT source_product_id, n, external_id FROM (SELECT source_product_id, count(*) AS n FROM observations GROUP BY 1 ORDER BY n DESC, source_product_id LIMIT 25) JOIN listings USING (source_product_id)")
def j06(r: Relations) -> DataFrame:
    top = r.observations.groupBy("source_product_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source_product_id").limit(25)
    return top.join(r.listings, "source_product_id").select("source_product_id", "n", "external_id")


@query("j08_groupwise_max", "SELECT source_product_id, obs_id, price FROM observations JOIN (SELECT source_product_id, max(collected_at) AS collected_at FROM observations GROUP BY 1) USING (source_product_id, collected_at)")
def j08(r: Relations) -> DataFrame:
    """All observations at the last time of a listing, ties included."""
    last = r.observations.groupBy("source_product_id").agg(F.max("collected_at").alias("collected_at"))
    return r.observations.join(last, ["source_product_id", "collected_at"]).select("source_product_id", "obs_id", "price")


@query("j12_key_resolution", "SELECT source_name, external_id, source_product_id FROM listings JOIN sources USING (source_id) WHERE source_name IN ('ASIA', 'EUROPE')")
def j12(r: Relations) -> DataFrame:
    return r.listings.join(r.sources.filter(F.col("source_name").isin("ASIA", "EUROPE")), "source_id").select("source_name", "external_id", "source_product_id")


@query("j13_conflicting_ids", "SELECT event_id, count(DISTINCT source_product_id) AS kinds FROM observations GROUP BY 1 HAVING count(DISTINCT source_product_id) > 1")
def j13(r: Relations) -> DataFrame:
    return r.observations.groupBy("event_id").agg(F.countDistinct("source_product_id").alias("kinds")).filter("kinds > 1")


@query("v17_row_values_in", "SELECT source_product_id, external_id FROM listings WHERE (source_id, external_id) IN (SELECT source_id, external_id FROM listings WHERE product_id % 2 = 1 AND source_id < 2)")
def v17(r: Relations) -> DataFrame:
    pairs = r.listings.filter("product_id % 2 = 1 AND source_id < 2").select("source_id", "external_id")
    return r.listings.join(pairs, ["source_id", "external_id"], "left_semi").select("source_product_id", "external_id")


# Filters.


@query("v11_optional_parameters", f"SELECT {LIST} FROM observed WHERE source_id = 3 AND currency = 'EUR' AND price >= 50000")
def v11(r: Relations) -> DataFrame:
    given = {"source_id": 3, "product_id": None, "currency": "EUR"}
    rows = r.observed
    for name, value in given.items():
        rows = rows if value is None else rows.filter(F.col(name) == value)
    return rows.filter("price >= 50000").select(*OBS)


@query("v12_relative_window", f"SELECT {LIST} FROM observations WHERE {RECENT}")
def v12(r: Relations) -> DataFrame:
    return r.observations.filter(F.col("collected_at") >= since(DAYS_BACK)).select(*OBS)


@query("v10_partition_days", "SELECT availability, count(*) AS n FROM observations WHERE collected_at::DATE BETWEEN DATE '1998-02-01' AND DATE '1998-03-31' GROUP BY 1")
def v10(r: Relations) -> DataFrame:
    day = F.to_date("collected_at")
    return r.observations.filter(day.between(F.lit(datetime(1998, 2, 1).date()), F.lit(datetime(1998, 3, 31).date()))).groupBy("availability").agg(F.count(F.lit(1)).alias("n"))


@query("v19_exists", "SELECT EXISTS (SELECT 1 FROM products WHERE product_id = 7) AS found")
def v19(r: Relations) -> DataFrame:
    return r.products.filter("product_id = 7").limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))


# Aggregates.


@query("a01_distinct_counts", "SELECT source_id, count(DISTINCT source_product_id) AS listings, count(DISTINCT product_id) AS products, count(*) AS n, min(price) AS lo, max(price) AS hi FROM observed GROUP BY 1")
def a01(r: Relations) -> DataFrame:
    return r.observed.groupBy("source_id").agg(F.countDistinct("source_product_id").alias("listings"), F.countDistinct("product_id").alias("products"), F.count(F.lit(1)).alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi"))


@query("a04_deviation_with_having", f"SELECT source_product_id, count(*) AS n, {sql_rounded('stddev_samp(price::DOUBLE)', 3)} AS deviation, max(collected_at) AS latest FROM observations WHERE price IS NOT NULL GROUP BY 1 HAVING count(*) >= 5")
def a04(r: Relations) -> DataFrame:
    from priceloom.views import rounded

    s = r.observations.filter("price IS NOT NULL").groupBy("source_product_id").agg(F.count(F.lit(1)).alias("n"), rounded(F.stddev_samp(F.col("price").cast("double")), 3).alias("deviation"), F.max("collected_at").alias("latest"))
    return s.filter("n >= 5")


@query("a05_by_source_and_currency", "SELECT source_id, currency, count(*) AS n, count(price) AS priced, min(price) AS lo, max(price) AS hi FROM observed GROUP BY 1, 2")
def a05(r: Relations) -> DataFrame:
    return r.observed.groupBy("source_id", "currency").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("priced"), F.min("price").alias("lo"), F.max("price").alias("hi"))


@query("a06_conditional_counts", "SELECT check_name, sum(CASE WHEN passed THEN 1 ELSE 0 END)::BIGINT AS ok, count(*) FILTER (WHERE severity = 'error') AS errors FROM checks GROUP BY 1")
def a06(r: Relations) -> DataFrame:
    return r.checks.groupBy("check_name").agg(F.sum(F.col("passed").cast("long")).alias("ok"), F.count_if(F.col("severity") == "error").alias("errors"))


@query("a08_candidates_with_having", f"SELECT source_product_id, count(*) AS n FROM observations WHERE {RECENT} AND price IS NOT NULL GROUP BY 1 HAVING count(*) >= 2")
def a08(r: Relations) -> DataFrame:
    rows = r.observations.filter((F.col("collected_at") >= since(DAYS_BACK)) & F.col("price").isNotNull())
    return rows.groupBy("source_product_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query("a11b_distinct_with_null", "SELECT source, count(DISTINCT failure_reason) + max(CASE WHEN failure_reason IS NULL THEN 1 ELSE 0 END) AS kinds FROM outcomes GROUP BY 1")
def a11b(r: Relations) -> DataFrame:
    return r.outcomes.groupBy("source").agg((F.countDistinct("failure_reason") + F.max(F.col("failure_reason").isNull().cast("int"))).alias("kinds"))


@query("a14_distinct_offenders", "SELECT source_id, string_agg(DISTINCT currency, ',' ORDER BY currency) AS offending FROM observed WHERE currency <> 'USD' GROUP BY 1")
def a14(r: Relations) -> DataFrame:
    return r.observed.filter("currency <> 'USD'").groupBy("source_id").agg(F.array_join(F.array_sort(F.collect_set("currency")), ",").alias("offending"))


@query("a15_age", f"SELECT source_id, date_diff('second', max(collected_at), TIMESTAMP '{AS_OF}') AS age FROM observed GROUP BY 1")
def a15(r: Relations) -> DataFrame:
    return r.observed.groupBy("source_id").agg(F.timestamp_diff("SECOND", F.max("collected_at"), as_of()).alias("age"))


@query("a22_topic_lag", "SELECT event_type, sum(coalesce(CASE WHEN event_id % 5 <> 0 THEN event_id % 31 END, 0))::BIGINT AS lag FROM events GROUP BY 1", prefix=False)
def a22(r: Relations) -> DataFrame:
    return r.table("events").groupBy("event_type").agg(F.sum(F.coalesce(F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 31), F.lit(0))).alias("lag"))


@query("a25_latency_summary", "SELECT event_type, count(value) AS n, min(value) AS lo, max(value) AS hi, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY 1", prefix=False)
def a25(r: Relations) -> DataFrame:
    return r.table("events").groupBy("event_type").agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


# Windows.


@query("w03_lag_in_window", f"SELECT obs_id, source_product_id, lag(price) OVER (PARTITION BY source_product_id ORDER BY collected_at, obs_id) AS before FROM observations WHERE {RECENT}")
def w03(r: Relations) -> DataFrame:
    w = Window.partitionBy("source_product_id").orderBy("collected_at", "obs_id")
    return r.observations.filter(F.col("collected_at") >= since(DAYS_BACK)).select("obs_id", "source_product_id", F.lag("price").over(w).alias("before"))


@query("w05_first_and_last_value", """SELECT obs_id, source_product_id, first_value(obs_id) OVER w AS first_obs, last_value(obs_id) OVER w AS last_obs FROM observations
WINDOW w AS (PARTITION BY source_product_id ORDER BY collected_at, obs_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def w05(r: Relations) -> DataFrame:
    w = Window.partitionBy("source_product_id").orderBy("collected_at", "obs_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return r.observations.select("obs_id", "source_product_id", F.first("obs_id").over(w).alias("first_obs"), F.last("obs_id").over(w).alias("last_obs"))


@query("w08_rolling_rows", """SELECT source_product_id, day::VARCHAR AS day, sum(n) OVER (PARTITION BY source_product_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS last_three FROM (SELECT source_product_id, collected_at::DATE AS day, count(*) AS n FROM observations GROUP BY 1, 2)""")
def w08(r: Relations) -> DataFrame:
    days = r.observations.groupBy("source_product_id", F.to_date("collected_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source_product_id").orderBy("day").rowsBetween(-2, 0)
    return days.select("source_product_id", F.col("day").cast("string").alias("day"), F.sum("n").over(w).alias("last_three"))


@query("w13_empty_streaks", HEALTH + "SELECT source, stopped_by_failure, ignoring_failures FROM st")
def w13(r: Relations) -> DataFrame:
    return H.empty_streaks(H.last_outcomes(r.outcomes))


@query("w14_last_outcomes", "SELECT source, count(*) AS kept, min(seq) AS first_seq FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq DESC) AS n FROM outcomes) WHERE n <= 100 GROUP BY 1")
def w14(r: Relations) -> DataFrame:
    return H.last_outcomes(r.outcomes).groupBy("source").agg(F.count(F.lit(1)).alias("kept"), F.min("seq").alias("first_seq"))


# Sets.


@query("u01_concat", "SELECT kind, count(*) AS n FROM (SELECT 'o' AS kind FROM orders UNION ALL SELECT 'l' FROM lineitem) GROUP BY 1", prefix=False)
def u01(r: Relations) -> DataFrame:
    both = r.table("orders").select(F.lit("o").alias("kind")).unionByName(r.table("lineitem").select(F.lit("l").alias("kind")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("u02_distinct", "SELECT DISTINCT source_id, currency FROM observed")
def u02(r: Relations) -> DataFrame:
    return r.observed.select("source_id", "currency").distinct()


@query("u04_first_of_key", "SELECT canonical_name, category, min(product_id) AS product_id FROM products GROUP BY 1, 2")
def u04(r: Relations) -> DataFrame:
    return r.products.groupBy("canonical_name", "category").agg(F.min("product_id").alias("product_id"))


# Checks, one by one.


def _recent(r: Relations) -> DataFrame:
    return r.observations.filter(F.col("collected_at") >= since(DAYS_BACK))


def _one(name: str, severity: str, failed: str, ok: str | None = None) -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, {ok or f'{failed} = 0'} AS passed, count(*) AS records_checked, {failed} AS failed_records FROM observations WHERE {RECENT}"


_COLS = ["check_name", "severity", "passed", "records_checked", "failed_records"]


@query("c01_required_fields", _one("required_fields", "error", "count(*) FILTER (WHERE price IS NULL OR currency IS NULL)"))
def c01(r: Relations) -> DataFrame:
    return C.run_suite(_recent(r), [C.RequiredFields(("price", "currency"))]).select(*_COLS)


@query("c02_price_validity", _one("price_validity", "error", "count(*) FILTER (WHERE price < 0)"))
def c02(r: Relations) -> DataFrame:
    return C.run_suite(_recent(r), [C.PriceRange()]).select(*_COLS)


@query("c03_allowed_values", _one("allowed_values", "error", "count(*) FILTER (WHERE availability NOT IN ('in_stock'))"))
def c03(r: Relations) -> DataFrame:
    return C.run_suite(_recent(r), [C.AllowedValues("availability", ("in_stock",))]).select(*_COLS)


@query("c04_duplicates", f"SELECT 'duplicates' AS check_name, 'warning' AS severity, sum(n - 1) = 0 AS passed, sum(n)::BIGINT AS records_checked, sum(n - 1)::BIGINT AS failed_records FROM (SELECT count(*) AS n FROM observations WHERE {RECENT} GROUP BY event_id)")
def c04(r: Relations) -> DataFrame:
    return C.run_suite(_recent(r), [C.Duplicates(("event_id",))]).select(*_COLS)


@query("c05_freshness", _one("freshness", "warning", "count(*)", f"date_diff('second', max(collected_at), TIMESTAMP '{AS_OF}') <= 3600"))
def c05(r: Relations) -> DataFrame:
    return C.run_suite(_recent(r), [C.Freshness("collected_at", as_of())]).select(*_COLS)


# Health.


@query("h02_freshness_state", HEALTH + "SELECT source, freshness_state FROM h")
def h02(r: Relations) -> DataFrame:
    return _assessed(r).select("source", "freshness_state")


@query("h03_all_sources", HEALTH + "SELECT s.source, coalesce(state, 'healthy') AS state FROM (SELECT unnest(range(60)) AS source) s LEFT JOIN h USING (source)")
def h03(r: Relations) -> DataFrame:
    """Sources without outcomes count as healthy, without history."""
    from priceloom.plans.operations import LIMITS, _now

    return H.assess(r.outcomes, _now(), LIMITS, sources=r.spark.range(60).withColumnRenamed("id", "source")).select("source", "state")


@query("h05_status_counts", HEALTH + f"SELECT {STATUS} AS status, count(*) AS n FROM h GROUP BY 1")
def h05(r: Relations) -> DataFrame:
    return _assessed(r).groupBy(H.source_status(F.col("state"), F.col("freshness_state")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("h06_worst_severity", "SELECT source, CASE max(CASE severity WHEN 'info' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END) WHEN 1 THEN 'info' WHEN 2 THEN 'warning' ELSE 'error' END AS worst FROM checks WHERE NOT passed GROUP BY 1")
def h06(r: Relations) -> DataFrame:
    return r.checks.filter(~F.col("passed")).groupBy("source").agg(F.max_by("severity", C.severity_rank(F.col("severity"))).alias("worst"))


@query("q24_pipeline_rollup", "SELECT CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'running' ELSE 'success' END AS status, count(*) AS runs, max(o_orderdate)::TIMESTAMP AS last_started FROM orders GROUP BY 1", prefix=False)
def q24_runs(r: Relations) -> DataFrame:
    return _runs(r).groupBy("status").agg(F.count(F.lit(1)).alias("runs"), F.max("started_at").alias("last_started"))


# Identities.


@query("p19_qualified_ids", "SELECT page_id, 'a:' || page_id || ':x' AS id, 'a' AS source, page_id || ':x' AS raw FROM pages", prefix=False)
def p19(r: Relations) -> DataFrame:
    q = mapping.qualified("a", F.concat(F.col("page_id").cast("string"), F.lit(":x")))
    s, raw = mapping.unqualified(q)
    return r.table("pages").select("page_id", q.alias("id"), s.alias("source"), raw.alias("raw"))


@query("p15_condition", "SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'like_new' WHEN 2 THEN 'for_parts' END AS condition FROM part", prefix=False)
def p15(r: Relations) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, [" Brand NEW", "Excellent", "for parts or not working", "shiny"])), (F.col("p_size") % 4 + 1).cast("int"))
    return r.table("part").select(F.col("p_partkey").alias("id"), mapping.condition(said).alias("condition"))


@query("p03_strip", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(event_type, ' ', user_id) END AS name FROM events", prefix=False)
def p03(r: Relations) -> DataFrame:
    """All kinds of white space around, none inside taken; a text of white space only becomes empty."""
    around = [F.lit(s) for s in ("\t \u00a0", "\u2003\u3000\n", "\x0b\x85\u2028 ", "")]
    pick = lambda k: F.element_at(F.array(*around), (F.pmod(F.xxhash64(F.lit(k), "event_id"), F.lit(len(around))) + 1).cast("int"))
    inner = F.when(F.col("event_id") % 3 != 0, F.concat(F.col("event_type"), F.lit(" "), F.col("user_id").cast("string"))).otherwise("")
    return r.table("events").select("event_id", text.strip(F.concat(pick(1), inner, pick(2))).alias("name"))


@query("t05_daily_last_value", "SELECT user_id, ts::DATE::VARCHAR AS day, arg_max(value, ts) AS value FROM events GROUP BY 1, 2", prefix=False)
def t05_daily(r: Relations) -> DataFrame:
    e = r.table("events").withColumn("day", F.to_date("ts").cast("string"))
    return T.latest_gauge(e, ["user_id", "day"]).select("user_id", "day", "value")
