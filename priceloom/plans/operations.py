"""Queries on quality, metrics, health and telemetry (A, C, H, Q15 to Q24, T ids)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.operators import health as H
from priceloom.operators import quality as C
from priceloom.operators import telemetry as T
from priceloom.operators.prices import page
from priceloom.plans.registry import query
from priceloom.views import AS_OF, DAYS_BACK, Relations, as_of, since, sql_rounded

NOW = "2024-01-31 00:00:00"
DAY = "2001-06-15"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("q15_quality_checks", "SELECT check_id, check_name, source, passed, severity, checked_at FROM checks WHERE check_name = 'en' AND NOT passed AND checked_at >= TIMESTAMP '2024-01-01 02:00:00' ORDER BY checked_at DESC, check_id LIMIT 20")
def q15(r: Relations) -> DataFrame:
    rows = r.checks.filter((F.col("check_name") == "en") & ~F.col("passed") & (F.col("checked_at") >= F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")))
    return page(rows, [F.desc("checked_at"), F.col("check_id")])


@query("q16_quality_summary", """SELECT check_name, count(*) AS total, count(*) FILTER (WHERE passed) AS passed_count, count(*) FILTER (WHERE NOT passed) AS failed_count, max(checked_at) AS last_checked, max(severity) AS max_severity_text,
(array['info', 'warning', 'error'])[max(CASE WHEN NOT passed THEN CASE severity WHEN 'info' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END END)] AS worst_failed_severity FROM checks GROUP BY 1""")
def q16(r: Relations) -> DataFrame:
    return C.check_summary(r.checks)


def _runs(r: Relations) -> DataFrame:
    """Pipeline runs: an order is one; status F failed, O running, P success."""
    o = F.col("o_orderstatus")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    return r.table("orders").select(
        F.col("o_orderkey").alias("run_id"), F.when(o == "F", "failed").when(o == "O", "running").otherwise("success").alias("status"), start.alias("started_at"),
        F.when(o != "O", F.timestamp_add("SECOND", F.col("o_orderkey") % 100, start)).alias("finished_at"), F.when(F.col("o_orderkey") % 7 != 0, F.floor("o_totalprice").cast("long")).alias("records"), F.when(o == "F", F.col("o_orderpriority")).alias("error_message"))


RUNS = """WITH runs AS (SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'running' ELSE 'success' END AS status, o_orderdate::TIMESTAMP AS started_at,
CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::TIMESTAMP + to_seconds(o_orderkey % 100) END AS finished_at, CASE WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice)::BIGINT END AS records, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS error_message FROM orders)
"""


@query("q17_pipeline_runs", RUNS + "SELECT run_id, status, started_at, records, CASE status WHEN 'failed' THEN 'failed' ELSE 'healthy' END AS derived FROM runs WHERE status <> 'running' ORDER BY started_at DESC, run_id LIMIT 20", prefix=False)
def q17(r: Relations) -> DataFrame:
    return page(_runs(r).filter("status <> 'running'"), [F.desc("started_at"), F.col("run_id")]).select("run_id", "status", "started_at", "records", H.run_status(F.col("status")).alias("derived"))


@query("a23_processing_rate", RUNS + f"SELECT {sql_rounded('(sum(records)::DOUBLE / sum(epoch(finished_at) - epoch(started_at))::DOUBLE)')} AS records_per_second FROM runs WHERE finished_at > started_at AND records IS NOT NULL", prefix=False)
def a23(r: Relations) -> DataFrame:
    return T.processing_rate(_runs(r))


HEALTH = f""", recent AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq DESC) AS recency FROM outcomes QUALIFY recency <= 100),
br AS (SELECT source, coalesce(min(recency) FILTER (WHERE NOT (success AND total_records = 0)), 1000) AS a, coalesce(min(recency) FILTER (WHERE success AND total_records > 0), 1000) AS b FROM recent GROUP BY 1),
st AS (SELECT source, count(*) FILTER (WHERE success AND total_records = 0 AND recency < a) AS stopped_by_failure, count(*) FILTER (WHERE success AND total_records = 0 AND recency < b) AS ignoring_failures FROM recent JOIN br USING (source) GROUP BY 1),
os AS (SELECT source, count(*) AS total_fetches, count(*) FILTER (WHERE success) AS successful_fetches, count(*) FILTER (WHERE success) / count(*) AS success_ratio, sum(total_records)::BIGINT AS total_records, sum(CASE WHEN success THEN malformed_count ELSE 0 END)::BIGINT AS total_malformed,
arg_max(failure_reason, seq) FILTER (WHERE NOT success) AS last_failure, max(ts) FILTER (WHERE success) AS last_success FROM recent GROUP BY 1),
aged AS (SELECT *, CASE WHEN total_records > 0 THEN total_malformed / total_records ELSE 0 END AS malformed_ratio, date_diff('second', last_success, TIMESTAMP '{NOW}')::DOUBLE AS age FROM os JOIN st USING (source)),
h AS (SELECT *, CASE WHEN lower(last_failure) LIKE '%rate%' AND lower(last_failure) LIKE '%limit%' THEN 'rate_limited' WHEN lower(last_failure) LIKE '%structur%' THEN 'structurally_changed' WHEN success_ratio < 0.75 THEN 'unreachable'
WHEN age > 30000 THEN 'stale' WHEN stopped_by_failure >= 3 THEN 'empty_result' WHEN total_records > 0 AND malformed_ratio > 0.1 THEN 'partially_parseable' ELSE 'healthy' END AS state,
CASE WHEN age IS NULL THEN 'never_collected' WHEN greatest(age, 0) > 30000 THEN 'stale' ELSE 'fresh' END AS freshness_state FROM aged)
"""
LIMITS = H.Limits(least_success=0.75, most_age_seconds=30_000, most_malformed=0.1)


def _age(c: str) -> str:
    return f"date_diff('second', {c}, TIMESTAMP '{NOW}')"


def _assessed(r: Relations) -> DataFrame:
    return H.assess(r.outcomes, _now(), LIMITS)


@query("h01_source_health", HEALTH + "SELECT source, total_fetches, successful_fetches, total_records, total_malformed, stopped_by_failure, ignoring_failures, state, freshness_state FROM h")
def h01(r: Relations) -> DataFrame:
    return _assessed(r).select("source", "total_fetches", "successful_fetches", "total_records", "total_malformed", "stopped_by_failure", "ignoring_failures", "state", "freshness_state")


STATUS = "CASE WHEN freshness_state = 'stale' THEN 'stale' WHEN state = 'healthy' AND freshness_state = 'fresh' THEN 'healthy' WHEN state IN ('unreachable', 'rate_limited', 'structurally_changed', 'partially_parseable', 'empty_result') THEN 'degraded' WHEN state = 'stale' THEN 'stale' ELSE 'unknown' END"


@query("q18_source_health", HEALTH + f"SELECT source, state, {STATUS} AS status FROM h ORDER BY source LIMIT 30")
def q18(r: Relations) -> DataFrame:
    return _assessed(r).select("source", "state", H.source_status(F.col("state"), F.col("freshness_state")).alias("status")).orderBy("source").limit(30)


@query("q24_overall_source_health", HEALTH + f""", s AS (SELECT {STATUS} AS s FROM h), n AS (SELECT count(*) AS total, count(*) FILTER (WHERE s = 'healthy') AS healthy, count(*) FILTER (WHERE s = 'degraded') AS degraded, count(*) FILTER (WHERE s = 'stale') AS stale FROM s)
SELECT *, CASE WHEN degraded > 0 THEN 'degraded' WHEN stale > 0 THEN 'stale' WHEN total > 0 AND healthy = total THEN 'healthy' ELSE 'unknown' END AS overall FROM n""")
def q24(r: Relations) -> DataFrame:
    return H.overall(_assessed(r))


@query("h04_alerts", HEALTH.replace(", recent", RUNS.replace("WITH runs", ", runs").rstrip() + ", recent", 1) + f"""SELECT 'run_failed' AS kind, run_id::VARCHAR AS subject, 'high' AS severity, coalesce(error_message, 'failed') AS message FROM runs WHERE status = 'failed'
UNION ALL SELECT concat('source_', s), source::VARCHAR, CASE s WHEN 'degraded' THEN 'high' ELSE 'medium' END, state FROM (SELECT *, {STATUS} AS s FROM h) WHERE s IN ('degraded', 'stale')""")
def h04(r: Relations) -> DataFrame:
    return H.alerts(_runs(r), _assessed(r))


@query("a24_outcome_stats", HEALTH + "SELECT source, total_fetches, success_ratio, malformed_ratio, last_failure FROM h")
def a24(r: Relations) -> DataFrame:
    return H.outcome_stats(H.last_outcomes(r.outcomes)).select("source", "total_fetches", "success_ratio", "malformed_ratio", "last_failure")


@query("q19_recent_failures", "SELECT check_id, check_name, severity, checked_at FROM checks WHERE NOT passed ORDER BY checked_at DESC, check_id DESC LIMIT 25")
def q19(r: Relations) -> DataFrame:
    return r.checks.filter(~F.col("passed")).orderBy(F.desc("checked_at"), F.desc("check_id")).limit(25).select("check_id", "check_name", "severity", "checked_at")


@query("q19_latest_status", "SELECT check_name, source, check_id, passed FROM (SELECT *, row_number() OVER (PARTITION BY check_name, source ORDER BY checked_at DESC, check_id DESC) AS n FROM checks) WHERE n = 1 AND check_name IN ('en', 'fr')")
def q19_latest(r: Relations) -> DataFrame:
    return C.latest_by(r.checks.filter(F.col("check_name").isin("en", "fr")), ["check_name", "source"], [F.desc("checked_at"), F.desc("check_id")]).select("check_name", "source", "check_id", "passed")


@query("q20_degraded_sources", HEALTH + f"SELECT source, state FROM h WHERE {STATUS} = 'degraded'")
def q20(r: Relations) -> DataFrame:
    return _assessed(r).filter(H.source_status(F.col("state"), F.col("freshness_state")) == "degraded").select("source", "state")


_DAY = f"collected_at >= TIMESTAMP '{DAY}' AND collected_at < TIMESTAMP '{DAY}' + INTERVAL 7 DAY"


@query("q21_daily_metrics", f""", o AS (SELECT * FROM observed JOIN sources USING (source_id) WHERE {_DAY})
SELECT metric_name, NULL::VARCHAR AS dimension, value FROM (SELECT count(*)::DOUBLE AS observation_count, count(DISTINCT product_id)::DOUBLE AS unique_products, coalesce(sum(price)::DOUBLE / count(price), 0) AS avg_price,
(count(*) FILTER (WHERE availability = 'in_stock'))::DOUBLE AS availability_in_stock, (count(*) FILTER (WHERE availability = 'out_of_stock'))::DOUBLE AS availability_out_of_stock FROM o) UNPIVOT (value FOR metric_name IN (observation_count, unique_products, avg_price, availability_in_stock, availability_out_of_stock))
UNION ALL SELECT 'source_observation_count', source_name, count(*)::DOUBLE FROM o GROUP BY 2""")
def q21(r: Relations) -> DataFrame:
    start = F.lit(DAY).cast("timestamp_ntz")
    rows = r.observed.filter((F.col("collected_at") >= start) & (F.col("collected_at") < start + F.make_dt_interval(F.lit(7)))).join(r.sources, "source_id")
    return C.daily_metrics(rows)


@query("a11_metrics_by_day", "SELECT collected_at::DATE::VARCHAR AS day, count(*) AS n, count(DISTINCT product_id) AS products, count(price) AS priced FROM observed GROUP BY 1")
def a11(r: Relations) -> DataFrame:
    return r.observed.groupBy(F.to_date("collected_at").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("product_id").alias("products"), F.count("price").alias("priced"))


SUITE = f"""SELECT 'required_fields' AS check_name, 'error' AS severity, count(*) FILTER (WHERE price IS NULL OR currency IS NULL) = 0 AS passed, count(*) AS records_checked, count(*) FILTER (WHERE price IS NULL OR currency IS NULL) AS failed_records, concat(count(*) FILTER (WHERE price IS NULL OR currency IS NULL), ' rows with nulls') AS message FROM w
UNION ALL SELECT 'price_validity', 'error', count(*) FILTER (WHERE price < 1000 OR price > 90000) = 0, count(*), count(*) FILTER (WHERE price < 1000 OR price > 90000), concat(count(*) FILTER (WHERE price < 1000), ' below, ', count(*) FILTER (WHERE price > 90000), ' above') FROM w
UNION ALL SELECT 'allowed_values', 'error', count(*) FILTER (WHERE currency NOT IN ('USD', 'EUR')) = 0, count(*), count(*) FILTER (WHERE currency NOT IN ('USD', 'EUR')), coalesce(string_agg(DISTINCT currency, ',') FILTER (WHERE currency NOT IN ('USD', 'EUR')), '') FROM w
UNION ALL SELECT 'freshness', 'warning', date_diff('second', max(collected_at), TIMESTAMP '{AS_OF}') <= 3600, count(*), CASE WHEN date_diff('second', max(collected_at), TIMESTAMP '{AS_OF}') <= 3600 THEN 0 ELSE count(*) END, concat('age ', date_diff('second', max(collected_at), TIMESTAMP '{AS_OF}')) FROM w
UNION ALL SELECT 'duplicates', 'warning', sum(n - 1) / sum(n) <= 0.01, sum(n)::BIGINT, sum(n - 1)::BIGINT, concat(count(*) FILTER (WHERE n > 1), ' keys repeat') FROM (SELECT count(*) AS n FROM w GROUP BY source_product_id)"""


def _suite(r: Relations) -> DataFrame:
    rows = r.observations.filter(F.col("collected_at") >= since(DAYS_BACK))
    return C.run_suite(rows, [C.RequiredFields(("price", "currency")), C.PriceRange(least=1000, most=90_000), C.AllowedValues("currency", ("USD", "EUR")), C.Freshness("collected_at", as_of()), C.Duplicates(("source_product_id",), 0.01)])


_W = f", w AS (SELECT * FROM observations WHERE collected_at >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS_BACK} DAY)\n"


@query("q22_quality_suite", _W + SUITE)
def q22(r: Relations) -> DataFrame:
    return _suite(r)


@query("a27_suite_summary", _W + f", s AS ({SUITE}) SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, coalesce(bool_or(NOT passed AND severity = 'error'), false) AS has_errors, coalesce(bool_or(NOT passed AND severity = 'warning'), false) AS has_warnings FROM s")
def a27(r: Relations) -> DataFrame:
    return C.suite_summary(_suite(r))


@query("a12_duplicate_counts", "SELECT count(*) AS unique_keys, sum(n - 1)::BIGINT AS extra_rows, count(*) FILTER (WHERE n > 1) AS repeated_keys FROM (SELECT count(*) AS n FROM observations GROUP BY event_id)")
def a12(r: Relations) -> DataFrame:
    n = r.observations.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("unique_keys"), F.sum(F.col("n") - 1).alias("extra_rows"), F.count_if(F.col("n") > 1).alias("repeated_keys"))


@query("a13_null_counts", "SELECT count(*) FILTER (WHERE price IS NULL) AS price, count(*) FILTER (WHERE currency IS NULL) AS currency, count(*) FILTER (WHERE price IS NULL OR currency IS NULL) AS any_null FROM observations")
def a13(r: Relations) -> DataFrame:
    return r.observations.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("price", "currency")], F.count_if(F.col("price").isNull() | F.col("currency").isNull()).alias("any_null"))


# Telemetry over events: a counter per user that counts events and resets every 20.
COUNTERS = """WITH c AS (SELECT user_id AS series, event_type AS status, ts::TIMESTAMP AS ts, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) % 20 + 1 AS value FROM events),
i AS (SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN NULL WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE value END AS increase, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM c WINDOW w AS (PARTITION BY series ORDER BY ts))
"""


def _counters(r: Relations) -> DataFrame:
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return r.table("events").select(F.col("user_id").alias("series"), F.col("event_type").alias("status"), F.col("ts").cast("timestamp_ntz").alias("ts"), ((n - 1) % 20 + 1).alias("value"))


@query("t01_counter_rate", COUNTERS + "SELECT series, window_start, sum(increase)::BIGINT AS increase, sum(increase) / 86400.0::DOUBLE AS rate FROM i GROUP BY 1, 2", prefix=False)
def t01(r: Relations) -> DataFrame:
    return T.rate(_counters(r), ["series"], "1 day")


@query("t04_rate_by_label", COUNTERS + "SELECT status, window_start, sum(increase)::BIGINT AS increase, sum(increase) / 86400.0::DOUBLE AS rate FROM i GROUP BY 1, 2", prefix=False)
def t04(r: Relations) -> DataFrame:
    return T.rate(_counters(r), ["series"], "1 day", by=["status"])


@query("st06_sliding_counts", """WITH s AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * k) AS window_start FROM events, range(2) AS t(k)) SELECT event_type, window_start, count(*) AS n FROM s GROUP BY 1, 2""", prefix=False)
def st06(r: Relations) -> DataFrame:
    e = r.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return e.groupBy("event_type", F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("event_type", F.col("w.start").alias("window_start"), "n")


@query("t02_windowed_mean", f"SELECT event_type, ts::DATE::VARCHAR AS day, {sql_rounded('(sum(round(value * 100)::BIGINT) / 100.0::DOUBLE / count(*))', 4)} AS mean FROM events GROUP BY 1, 2", prefix=False)
def t02(r: Relations) -> DataFrame:
    from priceloom.views import rounded

    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return r.table("events").groupBy("event_type", F.to_date("ts").cast("string").alias("day")).agg(rounded(T.ratio(cents / 100.0, F.count(F.lit(1))), 4).alias("mean"))


@query("t03_error_percentage", "SELECT user_id, CASE WHEN count(*) <> 0 THEN (count(*) FILTER (WHERE event_type = 'error')) / count(*) * 100 END AS percent FROM events GROUP BY 1", prefix=False)
def t03(r: Relations) -> DataFrame:
    return r.table("events").groupBy("user_id").agg(T.ratio(F.count_if(F.col("event_type") == "error"), F.count(F.lit(1)), 100.0).alias("percent"))


@query("t05_latest_gauge", "SELECT user_id, arg_max(value, ts) AS value, max(ts)::TIMESTAMP AS ts FROM events GROUP BY 1", prefix=False)
def t05(r: Relations) -> DataFrame:
    return T.latest_gauge(r.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz")), ["user_id"])




def _latency_sql(digits: int) -> str:
    # Values have two decimals, so interpolated ones have four; four digits never round a tie.
    p = ", ".join(f"{sql_rounded(f'quantile_cont(value, {q})', digits)} AS p{p}" for p, q in ((50, 0.5), (90, 0.9), (95, 0.95), (99, 0.99)))
    return f"count(value) AS count, {sql_rounded('min(value)', digits)} AS min, {sql_rounded('max(value)', digits)} AS max, {sql_rounded('avg(value)', digits)} AS mean, {p}"


@query("a16_latency_percentiles", f"SELECT {_latency_sql(4)} FROM events", prefix=False)
def a16(r: Relations) -> DataFrame:
    return T.latency_summary(r.table("events"), "value", digits=4)


@query("a18_latency_by_worker", f"SELECT user_id, {_latency_sql(4)} FROM events GROUP BY 1", prefix=False)
def a18(r: Relations) -> DataFrame:
    return T.latency_summary(r.table("events"), "value", ["user_id"], digits=4)


@query("a19_status_histogram", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL", prefix=False)
def a19(r: Relations) -> DataFrame:
    return T.status_histogram(r.table("events"), "user_id", "event_type").select("user_id", F.explode("statuses").alias("event_type", "n"))


@query("a20_lag_summary", "SELECT user_id, min(event_id % 97) AS min_lag, max(event_id % 97) AS max_lag, avg(event_id % 97) AS mean_lag, arg_max(event_id % 97, event_id) AS final_lag FROM events GROUP BY 1", prefix=False)
def a20(r: Relations) -> DataFrame:
    return T.lag_summary(r.table("events").select("user_id", F.col("event_id").alias("elapsed"), (F.col("event_id") % 97).alias("lag")), ["user_id"])


@query("a21_lag_growth", """WITH l AS (SELECT user_id, event_id AS elapsed, event_id * (user_id % 3) // 50 + user_id AS lag FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY elapsed) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM l),
s AS (SELECT user_id, max(n) AS n, avg(lag) AS m, max(lag) - min(lag) AS spread, avg(lag) FILTER (WHERE i <= greatest(1, n // 4)) AS head, avg(lag) FILTER (WHERE i > n - greatest(1, n // 4)) AS tail FROM n GROUP BY 1)
SELECT user_id, CASE WHEN n < 4 THEN 'insufficient_data' WHEN spread <= m * 0.2 THEN 'stable' WHEN head = 0 THEN CASE WHEN tail > 10 THEN 'growing' ELSE 'stable' END WHEN tail > head * 1.5 THEN 'growing' WHEN tail < head * 0.7 THEN 'shrinking' ELSE 'stable' END AS growth FROM s""", prefix=False)
def a21(r: Relations) -> DataFrame:
    lag = F.floor(F.col("event_id") * (F.col("user_id") % 3) / 50) + F.col("user_id")
    return T.lag_growth(r.table("events").select("user_id", F.col("event_id").alias("elapsed"), lag.alias("lag")), ["user_id"])


@query("st08_consumer_lag", "SELECT o_custkey, sum(CASE WHEN o_orderstatus <> 'O' THEN h - c END)::BIGINT AS lag, sum(greatest(0, h - CASE WHEN o_orderstatus <> 'O' THEN c ELSE l END))::BIGINT AS probe FROM (SELECT *, o_orderkey AS h, o_orderkey // 2 AS l, o_orderkey - 5 + o_custkey % 10 AS c FROM orders) GROUP BY 1", prefix=False)
def st08(r: Relations) -> DataFrame:
    o = r.table("orders")
    offsets = o.select("o_custkey", F.col("o_orderkey").alias("high"), F.expr("o_orderkey div 2").alias("low"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey") - 5 + F.col("o_custkey") % 10).alias("committed"))
    return T.consumer_lag(offsets).groupBy("o_custkey").agg(F.sum("lag").alias("lag"), F.sum("probe_lag").alias("probe"))


@query("j15_arrival_latency", "SELECT o_orderkey AS event_id, (epoch_us(min(l_shipdate)) - epoch_us(any_value(o_orderdate))) / 1000 AS latency_ms FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1", prefix=False)
def j15(r: Relations) -> DataFrame:
    made = r.table("orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("produced_at"))
    landed = r.table("lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_shipdate").alias("landed_at"))
    return T.arrivals(made, landed).select("event_id", "latency_ms")


@query("a17_throughput", f"""SELECT user_id, sum(event_id % 3)::BIGINT AS events, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS seconds, max(value) AS peak_rss, arg_max(value, ts) - arg_min(value, ts) AS cpu_delta,
{sql_rounded("coalesce(sum(event_id % 3) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE, 0), 0)", 9)} AS events_per_second FROM events GROUP BY 1""", prefix=False)
def a17(r: Relations) -> DataFrame:
    from priceloom.views import rounded

    samples = r.table("events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 3).alias("acknowledged"), F.col("value").alias("rss_bytes"), F.col("value").alias("cpu_seconds"))
    return T.throughput(samples, ["user_id"]).withColumn("events_per_second", rounded(F.col("events_per_second"), 9))


@query("snk09_replay_key", "SELECT concat_ws(':', check_name, check_id, '_', source, strftime(checked_at, '%Y-%m-%d')) AS replay_key, passed FROM checks")
def snk09(r: Relations) -> DataFrame:
    return r.checks.select(C.replay_key(F.col("check_name"), F.col("check_id"), F.lit(None), F.col("source"), F.to_date("checked_at")).alias("replay_key"), "passed")


@query("p27_derived_status", RUNS + "SELECT status, CASE status WHEN 'failed' THEN 'failed' ELSE 'healthy' END AS derived, count(*) AS n FROM runs GROUP BY 1", prefix=False)
def p27(r: Relations) -> DataFrame:
    return _runs(r).groupBy("status", H.run_status(F.col("status")).alias("derived")).agg(F.count(F.lit(1)).alias("n"))
