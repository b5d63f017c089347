"""Quality checks, daily metrics and their roll-ups.

A check gives aggregate columns and a finisher.  A suite folds the aggregates of all checks into one pass over the data; only the duplicate check,
which needs counts per key, takes a shuffle of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = "check_name string, severity string, passed boolean, records_checked bigint, failed_records bigint, message string"
#: Severities from mild to severe.
SEVERITIES = ("info", "warning", "error")


def _result(name: str, severity: str, passed: Column, checked: Column, failed: Column, message: Column) -> Column:
    return F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), passed.alias("passed"), checked.cast("long").alias("records_checked"), failed.cast("long").alias("failed_records"), message.alias("message"))


def _rows() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class RequiredFields:
    """Rows with a null in any of the columns fail; a missing column fails every row; an empty frame passes."""

    columns: tuple[str, ...]
    name: str = "required_fields"

    def result(self, df: DataFrame) -> Column:
        gone = [c for c in self.columns if c not in df.columns]
        bad = _rows() if gone else F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns]))
        return _result(self.name, "error", bad == 0, _rows(), bad, F.lit("missing columns: " + ",".join(gone)) if gone else F.concat(bad.cast("string"), F.lit(" rows with nulls")))


@dataclass(frozen=True)
class PriceRange:
    """Nulls are ignored; prices under ``least`` or over ``most`` fail."""

    column: str = "price"
    least: float = 0
    most: float | None = None
    name: str = "price_validity"

    def result(self, df: DataFrame) -> Column:
        low = F.count_if(F.col(self.column) < self.least)
        high = F.count_if(F.col(self.column) > self.most) if self.most is not None else F.lit(0)
        return _result(self.name, "error", low + high == 0, _rows(), low + high, F.concat(low.cast("string"), F.lit(" below, "), high.cast("string"), F.lit(" above")))


@dataclass(frozen=True)
class AllowedValues:
    """Values outside the set fail, nulls do not; the message lists the distinct offenders, sorted."""

    column: str
    allowed: tuple[str, ...]
    name: str = "allowed_values"

    def result(self, df: DataFrame) -> Column:
        off = ~F.col(self.column).isin(*self.allowed)
        return _result(self.name, "error", F.count_if(off) == 0, _rows(), F.count_if(off), F.array_join(F.array_sort(F.collect_set(F.when(off, F.col(self.column)))), ","))


@dataclass(frozen=True)
class Freshness:
    """The newest timestamp may be ``most_seconds`` old; an empty frame, or one without timestamps, fails."""

    column: str
    at: Column
    most_seconds: int = 3600
    name: str = "freshness"

    def result(self, df: DataFrame) -> Column:
        newest = F.max(self.column)
        age = F.timestamp_diff("SECOND", newest, self.at)
        ok = F.coalesce(age <= self.most_seconds, F.lit(False))
        return _result(self.name, "warning", ok, _rows(), F.when(ok, 0).otherwise(_rows()), F.when(_rows() == 0, "no_records").when(newest.isNull(), "no_timestamps").otherwise(F.concat(F.lit("age "), age.cast("string"))))


@dataclass(frozen=True)
class Duplicates:
    """Fails if the share of rows beyond the first of their key is over ``most_rate``; the number is reported either way."""

    keys: tuple[str, ...]
    most_rate: float = 0.0
    name: str = "duplicates"

    def frame(self, df: DataFrame) -> DataFrame:
        per_key = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
        total, extra = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
        ok = F.when(total == 0, True).otherwise(extra / total <= self.most_rate)
        return per_key.agg(_result(self.name, "warning", ok, total, extra, F.concat(F.count_if(F.col("n") > 1).cast("string"), F.lit(" keys repeat"))).alias("r")).select("r.*")


def run_suite(df: DataFrame, checks: list) -> DataFrame:
    """A result row for each check; one aggregation for all that need no keys."""
    flat = [c for c in checks if not hasattr(c, "frame")]
    frames = [c.frame(df) for c in checks if hasattr(c, "frame")]
    if flat:
        frames.insert(0, df.agg(F.array(*[c.result(df) for c in flat]).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, frames)


def suite_summary(results: DataFrame) -> DataFrame:
    failed = F.count_if(~F.col("passed"))
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), failed.alias("failed"),
        (F.count_if(~F.col("passed") & (F.col("severity") == "error")) > 0).alias("has_errors"), (F.count_if(~F.col("passed") & (F.col("severity") == "warning")) > 0).alias("has_warnings"))


def severity_rank(c: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), c)


def check_summary(results: DataFrame) -> DataFrame:
    """Per check: totals, last time, the greatest severity as text (as the read model has it) and the worst one by rank among failures."""
    ok = F.count_if("passed")
    return results.groupBy("check_name").agg(
        F.count(F.lit(1)).alias("total"), ok.alias("passed_count"), (F.count(F.lit(1)) - ok).alias("failed_count"), F.max("checked_at").alias("last_checked"),
        F.max("severity").alias("max_severity_text"), F.max_by("severity", F.when(~F.col("passed"), severity_rank(F.col("severity")))).alias("worst_failed_severity"))


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def daily_metrics(rows: DataFrame, source: str = "source_name", product: str = "product_id") -> DataFrame:
    """Long form (metric_name, dimension, value): one pass by source, from which the totals are added up.  A null product counts as one value."""
    per_product = rows.groupBy(source, product).agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("s"), F.count("price").alias("k"), F.count_if(F.col("availability") == "in_stock").alias("i"), F.count_if(F.col("availability") == "out_of_stock").alias("o"))
    total = per_product.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("observation_count"), (F.countDistinct(product) + F.coalesce(F.max(F.col(product).isNull().cast("int")), F.lit(0))).cast("double").alias("unique_products"),
        F.coalesce(F.sum("s").cast("double") / F.nullif(F.sum("k"), F.lit(0)), F.lit(0.0)).alias("avg_price"), F.coalesce(F.sum("i"), F.lit(0)).cast("double").alias("availability_in_stock"), F.coalesce(F.sum("o"), F.lit(0)).cast("double").alias("availability_out_of_stock"))
    long = total.unpivot([], total.columns, "metric_name", "value").select("metric_name", F.lit(None).cast("string").alias("dimension"), "value")
    by = per_product.groupBy(source).agg(F.sum("n").cast("double").alias("value"))
    return long.unionByName(by.select(F.lit("source_observation_count").alias("metric_name"), F.col(source).alias("dimension"), "value"))


def replay_key(*parts: Column) -> Column:
    """Parts joined by colons, ``_`` for a missing one."""
    return F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("_")) for p in parts])
