"""Queries on the state of the platform: runs, evaluations, roll-ups, result tables (Q17, Q20, Q23, Q24, H5, SNK10 to SNK12)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.operators import health as H
from priceloom.operators import quality as C
from priceloom.operators.warehouse import write_health, write_metrics
from priceloom.plans.operations import DAY, HEALTH, RUNS, STATUS, _assessed, _now, _runs
from priceloom.plans.platform import _room
from priceloom.plans.registry import query
from priceloom.sources import lake, landed
from priceloom.views import AS_OF, Relations, as_of, sql_rounded

_RESULTS = ", results AS (SELECT concat('s', source) AS source_name, CASE WHEN success THEN 'healthy' ELSE 'unreachable' END AS state, ts AS assessed_at, concat('s', source, ':', seq) AS replay_key FROM outcomes)\n"


def _results(r: Relations) -> DataFrame:
    """Evaluations as they are stored: an outcome is one."""
    name = F.concat(F.lit("s"), F.col("source").cast("string"))
    return r.outcomes.select(name.alias("source_name"), F.when(F.col("success"), "healthy").otherwise("unreachable").alias("state"), F.col("ts").alias("assessed_at"), F.concat(name, F.lit(":"), F.col("seq").cast("string")).alias("replay_key"))


@query("q17_run_by_id", RUNS + "SELECT run_id, status, started_at, finished_at, records, error_message, CASE status WHEN 'failed' THEN 'failed' ELSE 'healthy' END AS derived FROM runs WHERE run_id IN (1, 2, 3, 7)", prefix=False)
def q17_one(r: Relations) -> DataFrame:
    return _runs(r).filter(F.col("run_id").isin(1, 2, 3, 7)).withColumn("derived", H.run_status(F.col("status")))


@query("q20_recent_evaluations", _RESULTS + "SELECT 'all' AS of, * FROM (SELECT * FROM results ORDER BY assessed_at DESC, source_name LIMIT 50) UNION ALL SELECT 's7', * FROM (SELECT * FROM results WHERE source_name = 's7' ORDER BY assessed_at DESC, source_name LIMIT 50)")
def q20_recent(r: Relations) -> DataFrame:
    every, one = H.recent_evaluations(_results(r)), H.recent_evaluations(_results(r), "s7")
    return every.withColumn("of", F.lit("all")).unionByName(one.withColumn("of", F.lit("s7")))


@query("q20_latest_per_source", _RESULTS + "SELECT * FROM (SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY source_name ORDER BY assessed_at DESC, replay_key DESC) = 1)")
def q20_latest(r: Relations) -> DataFrame:
    return H.latest_per_source(_results(r))


@query("q20_latest_degraded", _RESULTS + "SELECT source_name, state FROM (SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY source_name ORDER BY assessed_at DESC, replay_key DESC) = 1) WHERE state <> 'healthy'")
def q20_degraded(r: Relations) -> DataFrame:
    return H.latest_per_source(_results(r), degraded_only=True).select("source_name", "state")


_AGES = {"ASIA": 1e9, "EUROPE": 60.0}


@query("q23_ingestion_health", f""", more AS (SELECT source_id, source_name FROM sources UNION ALL SELECT 99, 'NOWHERE'), seen AS (SELECT source_name, max(collected_at) AS last_observation_at, count(obs_id) AS total_observations FROM more LEFT JOIN listings USING (source_id) LEFT JOIN observations USING (source_product_id) GROUP BY 1)
SELECT *, greatest(date_diff('second', last_observation_at, TIMESTAMP '{AS_OF}'), 0)::DOUBLE AS freshness_age_seconds, CASE WHEN last_observation_at IS NULL THEN 'never_collected' WHEN greatest(date_diff('second', last_observation_at, TIMESTAMP '{AS_OF}'), 0) > CASE source_name WHEN 'ASIA' THEN 1e9 WHEN 'EUROPE' THEN 60 ELSE 90000000 END THEN 'stale' ELSE 'fresh' END AS freshness_state,
'healthy' AS state, CASE WHEN last_observation_at IS NULL THEN 'no observation data available' END AS reason FROM (SELECT * REPLACE (last_observation_at AS last_observation_at) FROM seen)""".replace("greatest(date_diff('second', last_observation_at, TIMESTAMP '" + AS_OF + "'), 0)::DOUBLE AS", "CASE WHEN last_observation_at IS NOT NULL THEN greatest(date_diff('second', last_observation_at, TIMESTAMP '" + AS_OF + "'), 0)::DOUBLE END AS"))
def q23(r: Relations) -> DataFrame:
    sources = r.sources.unionByName(r.spark.createDataFrame([(99, "NOWHERE")], "source_id long, source_name string"))
    return H.ingestion_health(H.last_seen(sources, r.listings, r.observations), as_of(), _AGES, 90_000_000).drop("source_id")


_LAG = "lag AS (SELECT event_type AS topic, CASE WHEN event_id % 10 <> 0 THEN event_id % 97 END AS lag FROM events)"


def _lag(r: Relations) -> DataFrame:
    return r.table("events").select(F.col("event_type").alias("topic"), F.when(F.col("event_id") % 10 != 0, F.col("event_id") % 97).alias("lag"))


def _pipeline_sql(which: str) -> str:
    """The roll-up over runs of which ``which`` holds."""
    seconds = "(epoch_us(finished_at) - epoch_us(started_at)) / 1000000.0::DOUBLE"
    ok = f"({seconds}) > 0 AND records IS NOT NULL"
    return HEALTH + f""", runs AS ({RUNS.strip().removeprefix('WITH runs AS (')[:-1]}), mine AS (SELECT * FROM runs WHERE {which}), new AS (SELECT * FROM mine ORDER BY started_at DESC, run_id DESC LIMIT 5), {_LAG},
a AS (SELECT count(*) AS recent_runs, count(*) FILTER (WHERE status = 'failed') AS failed_runs, (SELECT finished_at FROM new WHERE status <> 'failed' AND finished_at IS NOT NULL ORDER BY started_at DESC, run_id DESC LIMIT 1) AS last_write, {sql_rounded(f'((sum(records) FILTER (WHERE {ok}))::DOUBLE / (sum({seconds}) FILTER (WHERE {ok})))')} AS records_per_second FROM new),
b AS (SELECT (SELECT count(*) FROM mine) AS total_runs, (SELECT count(*) FROM h WHERE {STATUS} IN ('degraded', 'stale')) AS bad_sources, (SELECT coalesce(sum(lag), 0)::BIGINT FROM lag) AS total_lag, (SELECT count(DISTINCT topic) FROM lag) AS topics)
SELECT *, failed_runs + bad_sources AS alerts, CASE WHEN failed_runs > 0 OR bad_sources > 0 THEN 'degraded' WHEN recent_runs = 0 THEN 'unknown' ELSE 'healthy' END AS overall FROM a, b"""


@query("q24_pipeline_status", _pipeline_sql("true"))
def q24_pipeline(r: Relations) -> DataFrame:
    return H.pipeline_status(_runs(r), _assessed(r), _lag(r))


@query("q24_pipeline_status_ended", _pipeline_sql("status = 'success'"))
def q24_ended(r: Relations) -> DataFrame:
    """Of runs that ended well, so that the rate and the last write have values."""
    return H.pipeline_status(_runs(r).filter("status = 'success'"), _assessed(r), _lag(r))


_QUALITY = """SELECT (SELECT count(DISTINCT check_name) FROM q) AS checks, (SELECT count(*) FROM q WHERE NOT passed) AS total_failures, (SELECT count(DISTINCT check_name) FROM q WHERE NOT passed) AS checks_with_failures,
(SELECT (array['info', 'warning', 'error'])[max(CASE severity WHEN 'info' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END)] FROM (SELECT * FROM q ORDER BY checked_at DESC, check_id DESC LIMIT 10) WHERE NOT passed) AS worst_severity,
CASE WHEN (SELECT count(*) FROM q) = 0 THEN 'unknown' WHEN (SELECT count(*) FROM q WHERE NOT passed) > 0 THEN 'degraded' ELSE 'healthy' END AS overall"""


@query("q24_quality_status", ", q AS (SELECT * FROM checks)\n" + _QUALITY)
def q24_quality(r: Relations) -> DataFrame:
    return H.quality_status(r.checks)


@query("h05_precedence", HEALTH + f""", s AS (SELECT source % 3 AS part, {STATUS} AS s FROM h UNION ALL SELECT 0, 'healthy' WHERE false), n AS (SELECT part, count(*) AS total, count(*) FILTER (WHERE s = 'healthy') AS healthy, count(*) FILTER (WHERE s = 'degraded') AS degraded, count(*) FILTER (WHERE s = 'stale') AS stale FROM s GROUP BY 1)
SELECT 'sources ' || part AS of, CASE WHEN degraded > 0 THEN 'degraded' WHEN stale > 0 THEN 'stale' WHEN healthy = total THEN 'healthy' ELSE 'unknown' END AS overall FROM n
UNION ALL SELECT 'no sources', 'unknown' UNION ALL SELECT 'checks that passed', 'healthy' UNION ALL SELECT 'no checks', 'unknown' UNION ALL SELECT 'no runs, no sources', 'unknown'""")
def h05_precedence(r: Relations) -> DataFrame:
    assessed, none = _assessed(r), _assessed(r).limit(0)
    of = {f"sources {k}": H.overall(assessed.filter(F.col("source") % 3 == k)) for k in range(3)}
    of |= {"no sources": H.overall(none), "checks that passed": H.quality_status(r.checks.filter("passed")), "no checks": H.quality_status(r.checks.limit(0)), "no runs, no sources": H.pipeline_status(_runs(r).limit(0), none, _lag(r))}
    rows = [df.select(F.lit(name).alias("of"), "overall") for name, df in of.items()]
    for df in rows[1:]:
        rows[0] = rows[0].unionByName(df)
    return rows[0]


@query("snk10_health_results", HEALTH + "SELECT d AS logical_date, count(*) AS n, count(DISTINCT concat(source, ':', d)) AS keys, count(*) FILTER (WHERE state <> 'healthy') AS bad FROM h, (VALUES ('2024-01-30'), ('2024-01-31')) AS t(d) GROUP BY 1")
def snk10(r: Relations) -> DataFrame:
    """Evaluations of two dates, the first written twice."""
    path = _room(r, "health")
    rows = _assessed(r).select(F.col("source").cast("string").alias("source_name"), "state", "freshness_state", F.lit(None).cast("string").alias("reason"), "freshness_age_seconds", _now().alias("assessed_at"))
    for day in ("2024-01-30", "2024-01-31", "2024-01-30"):
        write_health(r.spark, path, rows, day, _now())
    return r.spark.read.parquet(path).groupBy("logical_date").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("replay_key").alias("keys"), F.count_if(F.col("state") != "healthy").alias("bad"))


@query("snk11_metric_results", f""", o AS (SELECT * FROM observed JOIN sources USING (source_id) WHERE collected_at >= TIMESTAMP '{DAY}' AND collected_at < TIMESTAMP '{DAY}' + INTERVAL 7 DAY)
SELECT concat('source_observation_count:{DAY}:', source_name) AS replay_key, count(*)::DOUBLE AS value FROM o GROUP BY 1 UNION ALL SELECT 'observation_count:{DAY}:_', count(*)::DOUBLE FROM o""")
def snk11(r: Relations) -> DataFrame:
    path, start = _room(r, "metrics"), F.lit(DAY).cast("timestamp_ntz")
    rows = r.observed.filter((F.col("collected_at") >= start) & (F.col("collected_at") < start + F.make_dt_interval(F.lit(7)))).join(r.sources, "source_id")
    for _ in range(2):
        write_metrics(r.spark, path, C.daily_metrics(rows), DAY, DAY, as_of())
    return r.spark.read.parquet(path).filter("metric_name IN ('observation_count', 'source_observation_count')").select("replay_key", "value")


@query("snk12_report", "SELECT 'configuration,environment,results,run_id,timestamp' AS fields, 'run-1' AS run_id, count(*)::BIGINT AS events FROM events", prefix=False)
def snk12(r: Relations) -> DataFrame:
    path = f"{_room(r, 'report')}/report.json"
    landed.write_report(r.spark, path, "run-1", "2026-01-01T00:00:00+00:00", {"rate": 100}, {"events": r.table("events").count()})
    back = json.loads(lake.get(r.spark, path))
    return r.spark.createDataFrame([(",".join(back), back["run_id"], back["results"]["events"])], "fields string, run_id string, events long")
