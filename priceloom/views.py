"""The price-observation relations over the star-schema tables, as DataFrames and, identically, as SQL for oracles.

A listing is a part sold from a region; its id is region * 10**7 + part.  An observation is a line item: its price is missing where it was
returned and is open, its currency and availability follow from the two flags.  ``obs_id`` orders observations of a listing at one time.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.sources.rooms import new_path

_listings: dict[tuple, tuple] = {}

AS_OF = "2001-12-01 00:00:00"
DAYS_BACK = 365


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def since(days: int, at: Column | None = None) -> Column:
    return (as_of() if at is None else at) - F.make_dt_interval(F.lit(days))


def rounded(c: Column, digits: int = 2) -> Column:
    """Half away from zero in double arithmetic, the same in any IEEE engine."""
    k = float(10**digits)
    return F.signum(c) * (F.floor(F.abs(c) * k + 0.5).cast("double") / k)


def sql_rounded(c: str, digits: int = 2) -> str:
    k = float(10**digits)
    return f"(sign({c})::DOUBLE * (floor(abs({c}) * {k} + 0.5)::DOUBLE / {k}))"


class Relations:
    """Lazily built frames of one data directory.  No broadcast hints: sizes are Spark's to check."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def sources(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").cast("long").alias("source_id"), F.col("r_name").alias("source_name"))

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("canonical_name"), F.col("p_type").alias("category"))

    @cached_property
    def observed(self) -> DataFrame:
        """Observations with the keys of their listing."""
        homes = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").cast("long").alias("source_id"))
        return self.table("lineitem").join(homes, F.col("l_suppkey") == F.col("s_suppkey")).select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("obs_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
            (F.col("source_id") * 10_000_000 + F.col("l_partkey")).alias("source_product_id"),
            "source_id", F.col("l_partkey").alias("product_id"),
            F.when(~((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")), F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"),
            F.when(F.col("l_returnflag") == "A", "USD").when(F.col("l_returnflag") == "N", "EUR").otherwise("GBP").alias("currency"),
            F.when(F.col("l_linestatus") == "F", "in_stock").otherwise("out_of_stock").alias("availability"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("collected_at"),
        )

    @cached_property
    def listings(self) -> DataFrame:
        """The dimension as a table of its own: found among all observations once for a session and a state of the data, and read from then on."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.dir}/lineitem.parquet")
        facts = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(path)
        key = (self.spark.sparkContext.applicationId, self.dir, facts.getModificationTime(), facts.getLen())
        if key not in _listings:
            found = self.observed.select("source_product_id", "source_id", "product_id").distinct().withColumn("external_id", F.col("product_id").cast("string"))
            to = new_path(self.spark, "listings")
            found.write.parquet(to)
            _listings[key] = to, found.schema
        to, schema = _listings[key]
        return self.spark.read.schema(schema).parquet(to)

    @cached_property
    def observations(self) -> DataFrame:
        """The fact table: only the listing's key."""
        return self.observed.drop("source_id", "product_id")

    @cached_property
    def checks(self) -> DataFrame:
        """Quality results: a labelled document is a check of its language on its source."""
        d = self.table("documents").select("doc_id", "lang", "source")
        return self.table("labels").join(d, "doc_id").select(
            F.col("doc_id").alias("check_id"), F.col("lang").alias("check_name"), "source", (F.col("quality") == 1).alias("passed"),
            F.when(F.col("toxic") == 1, "error").when(F.col("quality") == 1, "info").otherwise("warning").alias("severity"),
            F.timestamp_add("MINUTE", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("checked_at"),
        )

    @cached_property
    def outcomes(self) -> DataFrame:
        """Fetch outcomes of sources (users modulo 50): errors fail, purchases are malformed."""
        kind = F.col("event_type")
        return self.table("events").select(
            (F.col("user_id") % 50).alias("source"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp_ntz").alias("ts"), (kind != "error").alias("success"),
            F.when(kind == "error", 0).otherwise(F.floor("value").cast("long") % 5).alias("total_records"),
            F.when((kind == "error") & (F.col("event_id") % 3 == 0), "Rate limited (HTTP 429)").when((kind == "error") & (F.col("event_id") % 3 == 1), "page structure changed").when(kind == "error", "timeout").alias("failure_reason"),
            F.when((kind == "purchase") & (F.floor("value").cast("long") % 5 > 0), 1).otherwise(0).alias("malformed_count"),
        )


PREFIX = """
WITH sources AS (SELECT r_regionkey::BIGINT AS source_id, r_name AS source_name FROM region),
products AS (SELECT p_partkey AS product_id, p_name AS canonical_name, p_type AS category FROM part),
observed AS (SELECT l_orderkey * 100 + l_linenumber AS obs_id, concat(l_orderkey, '-', l_linenumber) AS event_id,
  n_regionkey::BIGINT * 10000000 + l_partkey AS source_product_id, n_regionkey::BIGINT AS source_id, l_partkey AS product_id,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL ELSE l_extendedprice::DECIMAL(12,2) END AS price,
  CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'EUR' ELSE 'GBP' END AS currency,
  CASE l_linestatus WHEN 'F' THEN 'in_stock' ELSE 'out_of_stock' END AS availability, l_shipdate::TIMESTAMP AS collected_at
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
listings AS (SELECT DISTINCT source_product_id, source_id, product_id, product_id::VARCHAR AS external_id FROM observed),
observations AS (SELECT obs_id, event_id, source_product_id, price, currency, availability, collected_at FROM observed),
checks AS (SELECT doc_id AS check_id, lang AS check_name, source, quality = 1 AS passed,
  CASE WHEN toxic = 1 THEN 'error' WHEN quality = 1 THEN 'info' ELSE 'warning' END AS severity,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id::BIGINT) AS checked_at FROM labels JOIN documents USING (doc_id)),
outcomes AS (SELECT user_id % 50 AS source, event_id AS seq, ts::TIMESTAMP AS ts, event_type <> 'error' AS success,
  CASE WHEN event_type = 'error' THEN 0 ELSE floor(value)::BIGINT % 5 END AS total_records,
  CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'Rate limited (HTTP 429)' WHEN event_type = 'error' AND event_id % 3 = 1 THEN 'page structure changed' WHEN event_type = 'error' THEN 'timeout' END AS failure_reason,
  CASE WHEN event_type = 'purchase' AND floor(value)::BIGINT % 5 > 0 THEN 1 ELSE 0 END AS malformed_count FROM events)
"""
