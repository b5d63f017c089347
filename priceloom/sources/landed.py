"""Landed source data: JSON items with their malformed siblings, generated events, and the catalog as data."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priceloom.operators import records
from priceloom.schemas import EVENT
from priceloom.sources.lake import delete, move, put
from priceloom.sources.rooms import tagged

#: Fixed values of generated events.
CATEGORIES = ("electronics", "books", "clothing", "home", "sports", "toys", "beauty", "grocery")
CURRENCIES = ("USD", "EUR", "GBP")
STOCK = ("in_stock", "out_of_stock", "preorder", "unknown")


def read_json_items(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(items, malformed) of JSON-lines files: a line that is no object of the schema is kept as text with its file."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"), F.col("_metadata.file_path").alias("file"))
    rows = lines.select("r.*", "file")
    return rows.filter("_corrupt IS NULL").drop("_corrupt"), rows.filter("_corrupt IS NOT NULL").select("_corrupt", "file")


def items_of(documents: DataFrame, value: str, schema: T.StructType, field: str | None = None, needed: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(items, malformed) of landed answers, one JSON text in ``value`` for each: a list of items, or an object with the list in ``field``.

    An item has its place ``index`` in its answer.  Malformed are items that are no objects of the schema or lack a ``needed`` field, with their text and "item
    N: why", and answers that are no such list, with index -1.
    """
    listed = T.ArrayType(T.StringType())
    text = F.col(value)
    raw = F.from_json(text if field is None else F.get_json_object(text, f"$.{field}"), listed)
    other = [c for c in documents.columns if c != value]
    answers = documents.withColumn("__items", raw)
    none = answers.filter("__items IS NULL").select(*other, F.lit(-1).alias("index"), text.alias("raw"), F.lit("not a list of items" if field is None else f"no list '{field}'").alias("reason"))
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = answers.filter("__items IS NOT NULL").select(*other, F.posexplode("__items").alias("index", "raw"))
    rows = rows.withColumn("r", F.from_json("raw", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    lacks = [F.when(F.col(f"r.{n}").isNull(), f"no {n}") for n in needed]
    why = F.coalesce(F.when(F.col("r._corrupt").isNotNull() | F.col("r").isNull(), "not an object of the schema"), *lacks)
    rows = rows.withColumn("reason", F.when(why.isNotNull(), F.concat(F.lit("item "), F.col("index").cast("string"), F.lit(": "), why)))
    good = rows.filter("reason IS NULL").select(*other, "index", "r.*").drop("_corrupt")
    return good, none.unionByName(rows.filter("reason IS NOT NULL").select(*other, "index", "raw", "reason"))


def mock_source(spark: SparkSession, events: list[dict], malformed: list[dict] = (), source: str = "mock_source", fail: Exception | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, malformed) as given, in the raw contract; raises ``fail`` if set.  For tests of what follows a source."""
    if fail is not None:
        raise fail
    good = spark.createDataFrame([{**e, "source": source} for e in events], EVENT)
    return good, spark.createDataFrame([(json.dumps(m.get("raw_record")), m["reason"]) for m in malformed], "raw string, reason string")


def read_relation(spark: SparkSession, name: str, url: str | None = None, **options: str) -> DataFrame:
    """A relation behind one interface: a catalog table or view by name, Parquet by path, or a database table (``url``: its JDBC address; give ``partitionColumn`` and
    bounds for a parallel read, and the driver's jar to the session)."""
    if url:
        return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
    return spark.read.options(**options).parquet(name) if "/" in name else spark.table(name)


def publish(events: DataFrame, path: str) -> DataFrame:
    """Write events as messages (a key and a JSON value) to files, one folder for each publication, checking the texts that are written against the contract
    as they are written.  One that breaks it stops the whole publication before anything is visible.  Returns the messages as written; a broker sink takes the same frame.

    Messages are written beside ``path`` and moved there as a whole: tasks outlive the job that one of them failed, and make the folders anew in which they write.
    """
    spark, path = events.sparkSession, path.rstrip("/")
    messages, name = as_messages(events), uuid.uuid4().hex
    to, stage = f"{path}/publication={name}", f"{path}__stage_{name}"
    with tagged(spark, f"publication-{name}") as settle:
        try:
            records.verify(messages).write.json(stage)
        except Exception as stopped:
            settle()
            delete(spark, stage)
            bad = [r["error"] for r in records.parse(messages, strict=True)[1].select("error").limit(5).collect()]
            if bad:
                raise ValueError("; ".join(bad)) from stopped
            raise
    move(spark, stage, to)
    return spark.read.schema("key string, value string").json(to)


def publish_validated(rows: DataFrame, path: str) -> DataFrame:
    """As :func:`publish`, for normalized records: those that validation passed."""
    good, _ = records.validate(rows)
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    names = [f.name for f in EVENT["payload"].dataType.fields]
    flat = good.withColumns({"collected_at": text("collected_at"), "produced_at": text("produced_at"), "price": F.col("price").cast("string"), "schema_version": F.col("schema_version").cast("string")})
    return publish(flat.select("event_id", "event_type", "schema_version", "source", "produced_at", F.struct(*names).alias("payload")), path)


def write_report(spark: SparkSession, path: str, run_id: str, at: str, configuration: dict, results: dict) -> dict:
    """A run's report as JSON with sorted keys; the report as written."""
    report = {"run_id": run_id, "timestamp": at, "environment": {"spark": spark.version}, "configuration": configuration, "results": results}
    put(spark, path, (json.dumps(report, indent=2, sort_keys=True) + "\n").encode())
    return report


def generate_events(spark: SparkSession, n: int, seed: int = 42, source: str = "load-test", products: int = 1000, start: str = "2026-01-01 00:00:00") -> DataFrame:
    """``n`` valid raw events, each a function of its number and the seed."""
    pick = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(len(xs))) + 1).cast("int"))
    share = F.pmod(F.xxhash64(F.lit(seed), F.lit(9), "id"), F.lit(199_899)) / 100 + 1
    external = F.concat(F.lit("prod-"), F.pmod(F.xxhash64(F.lit(seed), F.lit(8), "id"), F.lit(products)).cast("string"))
    at = F.date_format(F.timestamp_add("SECOND", F.col("id"), F.lit(start).cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.struct(
        external.alias("external_id"), F.concat(F.lit("Product "), external).alias("name"), F.concat(F.lit("https://example.com/"), external).alias("url"), F.format_string("%.2f", share).alias("price"),
        pick(CURRENCIES, 1).alias("currency"), pick(STOCK, 2).alias("availability"), pick(CATEGORIES, 3).alias("category"), F.lit(None).cast("string").alias("listing_id"), F.lit(None).cast("string").alias("seller_id"), at.alias("collected_at"))
    return spark.range(n).select(
        F.concat(F.lit(f"{source}:"), F.col("id").cast("string")).alias("event_id"), F.lit("product.observation").alias("event_type"), F.lit("1").alias("schema_version"), F.lit(source).alias("source"), at.alias("produced_at"), payload.alias("payload"))


def as_messages(events: DataFrame) -> DataFrame:
    """Key (source and product, so that a listing keeps its order) and JSON value."""
    return events.select(F.concat_ws(":", "source", "payload.external_id").alias("key"), F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))


def catalog(spark: SparkSession, keys: dict[str, list[str]] | None = None, count: bool = True, only: list[str] | None = None) -> DataFrame:
    """Tables and columns of the current catalog (of the tables in ``only``, if given) with key columns (from ``keys``) and row counts."""
    rows = []
    for t in spark.catalog.listTables():
        if only is not None and t.name not in only:
            continue
        n = spark.table(t.name).count() if count else None
        rows += [(t.name, c.name, c.dataType, c.nullable, c.name in (keys or {}).get(t.name, []), n) for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean, is_key boolean, row_count long")
