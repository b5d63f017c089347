"""Counter series, latencies, lag and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.views import rounded


def increases(counters: DataFrame, series: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Add ``increase``: growth since the series' previous sample; after a reset the value itself.  The first sample has none."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(ts))
    v = F.col(value)
    return counters.withColumn("increase", F.when(before.isNull(), None).when(v >= before, v - before).otherwise(v))


def rate(counters: DataFrame, series: list[str], window: str = "5 minutes", slide: str | None = None, by: list[str] | None = None, ts: str = "ts", value: str = "value") -> DataFrame:
    """Increase per second in each window, of each series or summed ``by`` fewer labels."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    rows = increases(counters, series, ts, value).withColumn("w", w)
    seconds = F.unix_micros(F.col("w.end").cast("timestamp")) / 1e6 - F.unix_micros(F.col("w.start").cast("timestamp")) / 1e6
    out = rows.groupBy("w", *(by if by is not None else series)).agg(F.sum("increase").alias("increase"))
    return out.withColumn("rate", F.col("increase") / seconds).withColumn("window_start", F.col("w.start")).drop("w")


def ratio(a: Column, b: Column, scale: float = 1.0) -> Column:
    return F.when(b != 0, a / b * scale)


def latest_gauge(samples: DataFrame, series: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    return samples.groupBy(*series).agg(F.max_by(value, ts).alias("value"), F.max(ts).alias("ts"))


def latency_summary(rows: DataFrame, column: str, by: list[str] | None = None, digits: int = 3) -> DataFrame:
    """count, min, max, mean and exact percentiles with linear interpolation, rounded to ``digits``; 0 where there is nothing."""
    c = F.col(column)
    made = [F.count(c).alias("count")] + [F.coalesce(rounded(x, digits), F.lit(0.0)).alias(n) for n, x in (("min", F.min(c)), ("max", F.max(c)), ("mean", F.avg(c)))]
    p = F.percentile(c, F.array(*[F.lit(x) for x in (0.5, 0.9, 0.95, 0.99)]))
    out = (rows.groupBy(*by) if by else rows).agg(*made, p.alias("__p"))
    return out.withColumns({n: F.coalesce(rounded(F.col("__p")[i], digits), F.lit(0.0)) for i, n in enumerate(("p50", "p90", "p95", "p99"))}).drop("__p")


def status_histogram(rows: DataFrame, endpoint: str, status: str) -> DataFrame:
    """Per endpoint a map of status to count; pairs are counted before they are gathered."""
    pairs = rows.groupBy(endpoint, status).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(endpoint).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(status, "n")))).alias("statuses"))


def lag_summary(samples: DataFrame, keys: list[str], elapsed: str = "elapsed", lag: str = "lag") -> DataFrame:
    return samples.groupBy(*keys).agg(F.min(lag).alias("min_lag"), F.max(lag).alias("max_lag"), F.avg(lag).alias("mean_lag"), F.max_by(lag, elapsed).alias("final_lag"))


def lag_growth(samples: DataFrame, keys: list[str], elapsed: str = "elapsed", lag: str = "lag") -> DataFrame:
    """insufficient_data under 4 samples; stable if the spread is at most a fifth of the mean; growing or shrinking by the last quarter's mean against
    the first's (x 1.5, x 0.7; from 0, growing over 10); else stable."""
    w = Window.partitionBy(*keys)
    rows = samples.withColumns({"i": F.row_number().over(w.orderBy(elapsed)), "n": F.count(F.lit(1)).over(w)})
    q = F.greatest(F.lit(1), F.floor(F.col("n") / 4))
    s = rows.groupBy(*keys).agg(F.max("n").alias("n"), F.avg(lag).alias("mean"), (F.max(lag) - F.min(lag)).alias("spread"), F.avg(F.when(F.col("i") <= q, F.col(lag))).alias("head"), F.avg(F.when(F.col("i") > F.col("n") - q, F.col(lag))).alias("tail"))
    kind = (
        F.when(F.col("n") < 4, "insufficient_data").when(F.col("spread") <= F.col("mean") * 0.2, "stable")
        .when(F.col("head") == 0, F.when(F.col("tail") > 10, "growing").otherwise("stable")).when(F.col("tail") > F.col("head") * 1.5, "growing").when(F.col("tail") < F.col("head") * 0.7, "shrinking").otherwise("stable")
    )
    return s.select(*keys, kind.alias("growth"))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """high - committed, without committed offset null; the probe counts from the low mark then, 0 at least."""
    high, low, done = F.col("high"), F.col("low"), F.col("committed")
    return offsets.withColumns({"lag": high - done, "probe_lag": F.greatest(F.lit(0), high - F.coalesce(done, low))})


def processing_rate(runs: DataFrame) -> DataFrame:
    """Records per second over finished runs of positive duration that tell their records, rounded to 2; null without such a run."""
    return runs.agg(rate_of_runs().alias("records_per_second"))


def rate_of_runs(records: str = "records") -> Column:
    """The aggregate behind :func:`processing_rate`; the time of a run whose records are not known does not count."""
    seconds = (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    counts = (seconds > 0) & F.col(records).isNotNull()
    return rounded(F.sum(F.when(counts, F.col(records))) / F.sum(F.when(counts, seconds)))


def throughput(samples: DataFrame, by: list[str], at: str = "ts", done: str = "acknowledged", rss: str = "rss_bytes", cpu: str = "cpu_seconds") -> DataFrame:
    """Per group: events, seconds, events per second (0 without time), peak resident memory, and CPU time spent (last sample minus first)."""
    s = (F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))) / 1e6
    out = samples.groupBy(*by).agg(F.sum(done).alias("events"), s.alias("seconds"), F.max(rss).alias("peak_rss"), (F.max_by(cpu, at) - F.min_by(cpu, at)).alias("cpu_delta"))
    return out.withColumn("events_per_second", F.coalesce(ratio(F.col("events"), F.col("seconds")), F.lit(0.0)))


def arrivals(produced: DataFrame, landed: DataFrame, key: str = "event_id") -> DataFrame:
    """Milliseconds from production to first landing of each event that landed."""
    first = landed.groupBy(key).agg(F.min("landed_at").alias("landed_at"))
    return produced.join(first, key).withColumn("latency_ms", (F.unix_micros(F.col("landed_at").cast("timestamp")) - F.unix_micros(F.col("produced_at").cast("timestamp"))) / 1000)
