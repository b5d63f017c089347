"""Source health from fetch outcomes: statistics, empty streaks, freshness and one CASE for the state."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.operators.quality import severity_rank
from priceloom.operators.telemetry import rate_of_runs

#: Fixed values.
DEGRADED = ("unreachable", "rate_limited", "structurally_changed", "partially_parseable", "empty_result")


@dataclass(frozen=True)
class Limits:
    least_success: float = 0.5
    most_age_seconds: float | None = None
    most_empty: int = 3
    least_records: int | None = None
    most_malformed: float = 0.5


def last_outcomes(outcomes: DataFrame, keep: int = 100) -> DataFrame:
    """The last ``keep`` outcomes of each source; ``recency`` counts from 1 at the newest."""
    w = Window.partitionBy("source").orderBy(F.desc("seq"))
    return outcomes.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= keep)


def empty_streaks(recent: DataFrame) -> DataFrame:
    """Per source: ``stopped_by_failure``, empties since the last success with records or failure; ``ignoring_failures``, empties since the last success
    with records.  Two aggregations, no window: the newest breaker of each kind, then what is newer."""
    empty = F.col("success") & (F.col("total_records") == 0)
    full = F.col("success") & (F.col("total_records") > 0)
    far = F.lit(1 << 30)
    breaks = recent.groupBy("source").agg(F.coalesce(F.min(F.when(~empty, F.col("recency"))), far).alias("a"), F.coalesce(F.min(F.when(full, F.col("recency"))), far).alias("b"))
    return recent.filter(empty).join(breaks, "source", "right").groupBy("source").agg(F.count_if(F.col("recency") < F.col("a")).alias("stopped_by_failure"), F.count_if(F.col("recency") < F.col("b")).alias("ignoring_failures"))


def outcome_stats(recent: DataFrame) -> DataFrame:
    ok = F.col("success")
    n = F.count(F.lit(1))
    records, malformed = F.sum(F.when(ok, F.col("total_records")).otherwise(0)), F.sum(F.when(ok, F.col("malformed_count")).otherwise(0))
    return recent.groupBy("source").agg(
        n.alias("total_fetches"), F.count_if("success").alias("successful_fetches"), (F.count_if("success") / n).alias("success_ratio"), records.alias("total_records"), malformed.alias("total_malformed"),
        F.when(records > 0, malformed / records).otherwise(0.0).alias("malformed_ratio"), F.max_by("failure_reason", F.when(~ok, F.col("seq"))).alias("last_failure"), F.max(F.when(ok, F.col("ts"))).alias("last_success"))


def freshness(age: Column, most: float | None) -> Column:
    """never_collected, fresh or stale; ages under 0 count as 0."""
    if most is None:
        return F.when(age.isNull(), "never_collected").otherwise("fresh")
    return F.when(age.isNull(), "never_collected").when(F.greatest(age, F.lit(0.0)) > most, "stale").otherwise("fresh")


def state(limits: Limits, age: Column, empties: Column) -> Column:
    """First match wins; a failure's text matters even if the ratio is fine."""
    why = F.lower(F.coalesce("last_failure", F.lit("")))
    limited = F.contains(why, F.lit("rate")) & F.contains(why, F.lit("limit"))
    changed = F.contains(why, F.lit("structur"))
    out = F.when(F.coalesce("total_fetches", F.lit(0)) == 0, "healthy").when(limited, "rate_limited").when(changed, "structurally_changed").when(F.col("success_ratio") < limits.least_success, "unreachable")
    if limits.most_age_seconds is not None:
        out = out.when(age > limits.most_age_seconds, "stale")
    out = out.when(empties >= limits.most_empty, "empty_result")
    if limits.least_records is not None:
        out = out.when((F.col("total_records") > 0) & (F.col("total_records") < limits.least_records), "empty_result")
    return out.when((F.col("total_records") > 0) & (F.col("malformed_ratio") > limits.most_malformed), "partially_parseable").otherwise("healthy")


def assess(outcomes: DataFrame, at: Column, limits: Limits = Limits(), keep: int = 100, sources: DataFrame | None = None) -> DataFrame:
    """A row for each source (of ``sources``, if given, also for those without outcomes): statistics, state and freshness."""
    recent = last_outcomes(outcomes, keep)
    rows = outcome_stats(recent).join(empty_streaks(recent), "source")
    if sources is not None:
        rows = sources.select("source").join(rows, "source", "left")
    age = F.timestamp_diff("SECOND", F.col("last_success"), at).cast("double")
    rows = rows.withColumn("freshness_age_seconds", age)
    rows = rows.withColumn("state", state(limits, F.col("freshness_age_seconds"), F.coalesce("stopped_by_failure", F.lit(0))))
    return rows.withColumn("freshness_state", freshness(F.col("freshness_age_seconds"), limits.most_age_seconds))


def source_status(state: Column, freshness_state: Column) -> Column:
    return F.when(freshness_state == "stale", "stale").when((state == "healthy") & (freshness_state == "fresh"), "healthy").when(state.isin(*DEGRADED), "degraded").when(state == "stale", "stale").otherwise("unknown")


def run_status(status: Column) -> Column:
    return F.when(status == "failed", "failed").when(status.isin("running", "success"), "healthy").otherwise("unknown")


def overall(assessed: DataFrame) -> DataFrame:
    """Counts by status and the one for all: degraded before stale; healthy only if all sources are, else unknown, as without sources."""
    s = source_status(F.col("state"), F.col("freshness_state"))
    n = assessed.select(s.alias("s")).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("s") == k).alias(k) for k in ("healthy", "degraded", "stale")])
    one = F.when(F.col("degraded") > 0, "degraded").when(F.col("stale") > 0, "stale").when((F.col("total") > 0) & (F.col("healthy") == F.col("total")), "healthy")
    return n.withColumn("overall", F.coalesce(one, F.lit("unknown")))


def pipeline_status(runs: DataFrame, assessed: DataFrame, lag: DataFrame, recent: int = 5) -> DataFrame:
    """One row on the pipeline: the ``recent`` newest runs (run_id, status, started_at, finished_at, records), all sources, and lag samples (topic, lag).

    overall: degraded if one of these runs failed or a source is degraded or stale; unknown without runs; else healthy.  last_write: when the newest healthy one
    of these runs ended.  Four one-row frames are put side by side, so nothing but the newest runs is sorted.
    """
    newest = runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(recent).withColumn("derived", run_status(F.col("status")))
    ended = F.when((F.col("derived") == "healthy") & F.col("finished_at").isNotNull(), F.struct("started_at", "run_id", "finished_at"))
    of_runs = newest.agg(F.count(F.lit(1)).alias("recent_runs"), F.count_if(F.col("derived") == "failed").alias("failed_runs"), F.max(ended)["finished_at"].alias("last_write"), rate_of_runs().alias("records_per_second"))
    total = runs.agg(F.count(F.lit(1)).alias("total_runs"))
    bad = source_status(F.col("state"), F.col("freshness_state")).isin("degraded", "stale")
    of_sources = assessed.agg(F.count_if(bad).alias("bad_sources"))
    of_lag = lag.agg(F.coalesce(F.sum(F.coalesce("lag", F.lit(0))), F.lit(0)).alias("total_lag"), F.countDistinct("topic").alias("topics"))
    row = reduce(lambda a, b: a.join(b, "one"), [x.withColumn("one", F.lit(1)) for x in (of_runs, total, of_sources, of_lag)]).drop("one")
    named = F.when((F.col("failed_runs") > 0) | (F.col("bad_sources") > 0), "degraded").when(F.col("recent_runs") == 0, "unknown").otherwise("healthy")
    return row.withColumns({"alerts": F.col("failed_runs") + F.col("bad_sources"), "overall": named})


def quality_status(results: DataFrame, recent: int = 10) -> DataFrame:
    """One row on quality results (check_id, check_name, severity, passed, checked_at): degraded with any failure, unknown without results, else healthy;
    the number of failures and of checks with one; the worst severity among failures of the ``recent`` newest results."""
    by = results.groupBy("check_name").agg(F.count_if(~F.col("passed")).alias("failed"))
    all_of = by.agg(F.count(F.lit(1)).alias("checks"), F.coalesce(F.sum("failed"), F.lit(0)).alias("total_failures"), F.count_if(F.col("failed") > 0).alias("checks_with_failures"))
    newest = results.orderBy(F.desc("checked_at"), F.desc("check_id")).limit(recent)
    worst = newest.agg(F.max_by("severity", F.when(~F.col("passed"), severity_rank(F.col("severity")))).alias("worst_severity"))
    named = F.when(F.col("checks") == 0, "unknown").when(F.col("total_failures") > 0, "degraded").otherwise("healthy")
    return all_of.withColumn("one", F.lit(1)).join(worst.withColumn("one", F.lit(1)), "one").drop("one").withColumn("overall", named)


def last_seen(sources: DataFrame, listings: DataFrame, observations: DataFrame) -> DataFrame:
    """source_id, source_name, last_observation_at, total_observations of every source, those without observations included.  Observations are counted by
    listing first, so the joins see one row for each."""
    newest = observations.groupBy("source_product_id").agg(F.max("collected_at").alias("at"), F.count(F.lit(1)).alias("n"))
    by = listings.join(newest, "source_product_id").groupBy("source_id").agg(F.max("at").alias("last_observation_at"), F.sum("n").alias("n"))
    return sources.join(by, "source_id", "left").select("source_id", "source_name", "last_observation_at", F.coalesce("n", F.lit(0)).alias("total_observations"))


def ingestion_health(seen: DataFrame, at: Column, most_age: dict[str, float] | None = None, default_age: float | None = None) -> DataFrame:
    """State and freshness of sources by what the warehouse has of them (:func:`last_seen`): without fetch outcomes a source is healthy, and a source that
    was never collected says so; ages under 0 count as 0.  ``most_age``: seconds by source name, ``default_age`` for the others (None: never stale)."""
    age = F.greatest(F.timestamp_diff("SECOND", F.col("last_observation_at"), at), F.lit(0)).cast("double")
    most = F.lit(default_age).cast("double")
    for name, seconds in (most_age or {}).items():
        most = F.when(F.col("source_name") == name, F.lit(float(seconds))).otherwise(most)
    fresh = F.when(F.col("last_observation_at").isNull(), "never_collected").when(age > most, "stale").otherwise("fresh")
    why = F.when(F.col("last_observation_at").isNull(), "no observation data available")
    return seen.withColumns({"freshness_age_seconds": F.when(F.col("last_observation_at").isNotNull(), age), "freshness_state": fresh, "state": F.lit("healthy"), "reason": why})


def recent_evaluations(results: DataFrame, source: str | None = None, limit: int = 50) -> DataFrame:
    rows = results if source is None else results.filter(F.col("source_name") == source)
    return rows.orderBy(F.desc("assessed_at"), "source_name").limit(limit)


def latest_per_source(results: DataFrame, degraded_only: bool = False) -> DataFrame:
    """The newest evaluation of each source; with ``degraded_only``, of those that are not healthy by it."""
    newest = results.groupBy("source_name").agg(F.max_by(F.struct(*[c for c in results.columns if c != "source_name"]), F.struct("assessed_at", "replay_key")).alias("r")).select("source_name", "r.*")
    return newest.filter("state <> 'healthy'") if degraded_only else newest


def alerts(runs: DataFrame, assessed: DataFrame) -> DataFrame:
    """(kind, subject, severity, message) of failed runs, degraded and stale sources."""
    s = source_status(F.col("state"), F.col("freshness_state"))
    failed = runs.filter("status = 'failed'").select(F.lit("run_failed").alias("kind"), F.col("run_id").cast("string").alias("subject"), F.lit("high").alias("severity"), F.coalesce("error_message", F.lit("failed")).alias("message"))
    bad = assessed.withColumn("__s", s).filter("__s IN ('degraded', 'stale')").select(
        F.concat(F.lit("source_"), F.col("__s")).alias("kind"), F.col("source").cast("string").alias("subject"), F.when(F.col("__s") == "degraded", "high").otherwise("medium").alias("severity"), F.col("state").alias("message"))
    return failed.unionByName(bad)
