"""Idempotent load of records into the star schema, kept as Parquet tables.

Keys are hashes of natural keys, so no sequence is needed and a product has one row.  A load first finds conflicts (an id with another payload) and
raises before anything is written; then each table gets the rows whose key it lacks.  New rows are staged before they are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.operators.quality import replay_key
from priceloom.operators.records import payload_hash
from priceloom.schemas import PRICE
from priceloom.sources.lake import _files, exists

TABLES = {
    "sources": "source_id long, name string",
    "products": "product_id long, canonical_name string, category string",
    "source_products": "source_product_id long, source_id long, product_id long, external_id string, url string",
    "observations": "event_id string, source_product_id long, name string, price decimal(12,2), currency string, availability string, collected_at timestamp, hash string",
}
PAYLOAD = ["source_product_id", "name", "price", "currency", "availability", "collected_at"]


class ConflictError(ValueError):
    """Incoming ids that are known, or come twice, with another payload."""


def surrogate(*parts: Column) -> Column:
    """A 64-bit key from natural parts; parts cannot run together and null differs from every text."""
    return F.xxhash64(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"}))


#: Fields without which a row has no place in the warehouse, in the order in which they are asked for.
NEEDED = ("source", "external_id", "availability", "collected_at", "event_id")


def map_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that can be loaded, rejected rows with ``reason``) of stored rows: the first needed field that is null or empty, or a price text that is no number.  An
    empty price is a missing one; times in text become timestamps."""
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    price = F.when(F.col("price").cast("string") != "", F.col("price").cast("string"))
    why = [F.when(empty(c), f"Missing required field '{c}'") for c in NEEDED]
    why += [F.when(price.isNotNull() & price.try_cast(PRICE).isNull(), F.concat(F.lit("Invalid price value '"), price, F.lit("'"))), F.when(F.col("collected_at").cast("string").try_cast("timestamp").isNull(), "Invalid time")]
    checked = rows.withColumn("reason", F.coalesce(*why))
    good = checked.filter("reason IS NULL").drop("reason").withColumns({"price": price.try_cast(PRICE), "collected_at": F.col("collected_at").cast("string").try_cast("timestamp")})
    return good, checked.filter("reason IS NOT NULL")


class Warehouse:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        p = f"{self.path}/{name}"
        return self.spark.read.schema(TABLES[name]).parquet(p) if exists(self.spark, p) else self.spark.createDataFrame([], TABLES[name])

    def _append(self, name: str, rows: DataFrame, key: str) -> int:
        """Rows whose key the table lacks; the number is counted on what was staged."""
        new = rows.select(*[c.split()[0] for c in TABLES[name].split(", ")]).dropDuplicates([key]).join(self.table(name).select(key), key, "left_anti")
        stage = f"{self.path}/_stage_{uuid.uuid4().hex}"
        new.write.parquet(stage)
        staged = self.spark.read.schema(TABLES[name]).parquet(stage)
        n = staged.count()
        if n:
            staged.write.mode("append").parquet(f"{self.path}/{name}")
        store, p = _files(self.spark, stage)
        store.delete(p, True)
        return n

    def keyed(self, records: DataFrame) -> DataFrame:
        r = records.withColumns({"source_id": surrogate(F.col("source")), "product_id": surrogate(F.col("name"), F.col("category")), "source_product_id": surrogate(F.col("source"), F.col("external_id"))})
        return r.withColumn("hash", payload_hash(PAYLOAD))

    def conflicts(self, keyed: DataFrame) -> DataFrame:
        """Ids with differing payloads inside the load or against the table."""
        own = keyed.groupBy("event_id").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        known = self.table("observations").select("event_id", "hash")
        return own.join(known, "event_id", "left").filter((F.col("lo") != F.col("hi")) | (F.col("hash") != F.col("lo"))).select("event_id")

    def load_checked(self, rows: DataFrame) -> dict[str, int]:
        """As :meth:`load`, for rows that may be unfit: these are appended, with the reason, to the table ``rejects``, once for a row; the others are loaded."""
        good, bad = map_rows(rows)
        return self.load(good) | {"rejects": append_results(self.spark, f"{self.path}/rejects", bad, F.md5(F.to_json(F.struct(*rows.columns))), F.col("reason"))}

    def load(self, records: DataFrame) -> dict[str, int]:
        """New rows by table.  Loading twice adds nothing; a conflict raises and nothing is written."""
        stage = f"{self.path}/_stage_{uuid.uuid4().hex}"
        self.keyed(records).write.parquet(stage)
        try:
            keyed = self.spark.read.parquet(stage)
            bad = [r[0] for r in self.conflicts(keyed).limit(20).collect()]
            if bad:
                raise ConflictError(f"other payload for {', '.join(bad)}")
            # The first mapping of a listing wins: known listings are left alone, new ones take their first product by time.
            first = keyed.groupBy("source_product_id", "source_id", "external_id").agg(F.min_by(F.struct("product_id", "url"), F.struct("collected_at", "event_id")).alias("m"))
            return {
                "sources": self._append("sources", keyed.select("source_id", F.col("source").alias("name")), "source_id"),
                "products": self._append("products", keyed.select("product_id", F.col("name").alias("canonical_name"), "category"), "product_id"),
                "source_products": self._append("source_products", first.select("source_product_id", "source_id", "external_id", "m.*"), "source_product_id"),
                "observations": self._append("observations", keyed, "event_id"),
            }
        finally:
            store, p = _files(self.spark, stage)
            store.delete(p, True)


def append_results(spark: SparkSession, path: str, rows: DataFrame, *key: Column) -> int:
    """Append result rows (checks, health, metrics) under a replay key; rows with a known key are skipped."""
    rows = rows.withColumn("replay_key", replay_key(*key)).dropDuplicates(["replay_key"])
    if exists(spark, path):
        rows = rows.join(spark.read.parquet(path).select("replay_key"), "replay_key", "left_anti")
    stage = f"{path.rstrip('/')}__stage_{uuid.uuid4().hex}"
    rows.write.parquet(stage)
    staged = spark.read.parquet(stage)
    n = staged.count()
    if n:
        staged.write.mode("append").parquet(path)
    store, p = _files(spark, stage)
    store.delete(p, True)
    return n


def write_health(spark: SparkSession, path: str, evaluations: DataFrame, logical_date: str, evaluated_at: Column) -> int:
    """Append evaluations (source_name, state, freshness_state, reason, freshness_age_seconds, assessed_at) of one logical date, once for each source."""
    rows = evaluations.select("source_name", "state", "freshness_state", "reason", "freshness_age_seconds", "assessed_at", evaluated_at.alias("evaluated_at"), F.lit(logical_date).alias("logical_date"))
    return append_results(spark, path, rows, F.col("source_name"), F.col("logical_date"))


def write_metrics(spark: SparkSession, path: str, metrics: DataFrame, metric_date: str, logical_date: str, computed_at: Column) -> int:
    """Append daily metrics (metric_name, dimension, value), once for each name, day and dimension."""
    rows = metrics.select(F.lit(metric_date).cast("date").alias("metric_date"), "metric_name", "dimension", "value", computed_at.alias("computed_at"), F.lit(logical_date).alias("logical_date"))
    return append_results(spark, path, rows, F.col("metric_name"), F.col("metric_date"), F.col("dimension"))
