"""Flatten, normalize, validate, replays and conflicts, on small literal frames."""

import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from priceloom import schemas
from priceloom.functions import text
from priceloom.operators import records
from priceloom.schemas import EVENT
from priceloom.sources import landed

DEFAULT = {
    "event_id": "evt-001", "event_type": "product.observation", "schema_version": 1, "source": "test-source", "produced_at": "2026-09-03T08:00:00Z",
    "payload": {"external_id": "prod-123", "name": "Test Product", "url": "https://example.com/product/123", "price": "99.99", "currency": "EUR", "availability": "in_stock", "category": "electronics", "collected_at": "2026-09-03T08:00:00Z"},
}


def event(**changes):
    e = json.loads(json.dumps(DEFAULT))
    for k, v in changes.items():
        (e["payload"] if k in e["payload"] else e)[k] = v
    return e


def frame(spark, *events):
    df = spark.createDataFrame([(json.dumps(e), 0, i) for i, e in enumerate(events)], "value string, partition int, offset long")
    good, dead = records.parse(df)
    return records.normalize(records.flatten(good)), dead


def test_normalize(spark):
    rows, dead = frame(spark, event(name="\t Test ", price="abc", availability=" IN_STOCK ", collected_at="2026-09-03T10:00:00+02:00"))
    assert dead.count() == 0 and [f.name for f in rows.schema] == [f.name for f in schemas.RECORD] and rows.schema["price"].dataType == schemas.PRICE
    r = rows.first()
    assert (r.name, r.price, r.availability) == ("Test", None, "in_stock")
    assert rows.select(text.iso(F.col("collected_at"))).first()[0] == "2026-09-03T08:00:00+00:00"


@pytest.mark.parametrize(("change", "errors"), [
    ({}, ""), ({"price": "-1"}, "negative_price"), ({"price": "0"}, ""), ({"price": None}, ""),
    ({"availability": "sold"}, "invalid_availability:allowed={in_stock,out_of_stock,preorder,unknown}"), ({"availability": ""}, "invalid_availability:allowed={in_stock,out_of_stock,preorder,unknown}"),
    ({"schema_version": 2}, "unsupported_schema_version:allowed={1}"), ({"currency": "eur"}, "invalid_currency_format"), ({"currency": "EURO"}, "invalid_currency_format"), ({"currency": "123"}, "invalid_currency_format"),
    ({"name": None, "price": "-2", "currency": "x"}, "null_required:name; negative_price; invalid_currency_format"), ({"collected_at": "no time"}, "null_required:collected_at"),
])
def test_violations(spark, change, errors):
    rows, _ = frame(spark, event(**change))
    assert records.with_violations(rows).first()[records.ERRORS] == errors


def test_dead_letters(spark):
    df = spark.createDataFrame([("{bad", 0, 1), ('{"event_type": "other"}', 0, 2), (None, 0, 3)], "value string, partition int, offset long")
    _, dead = records.parse(df)
    letters = records.dead_letter(dead, F.lit("raw"))
    assert {r.error for r in letters.collect()} == {"malformed_json", "unknown_event_type"}
    assert [r.letter_id for r in letters.orderBy("offset").collect()] == [r.letter_id for r in records.dead_letter(dead, F.lit("raw")).orderBy("offset").collect()]


def _status(spark, rows, seen=None):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ingest_seq int, event_id string, name string, price double")
    return [r.status for r in records.status(df, seen=seen, payload=["name", "price"]).orderBy("ingest_seq").collect()]


def test_status(spark):
    assert _status(spark, [("a", "x", 1.0)] * 3) == ["unique", "duplicate", "duplicate"]
    assert _status(spark, [("a", "x", 1.0), ("a", "x", 2.0)]) == ["conflict"] * 2
    assert _status(spark, [("a", "x", 1.0), ("a", "x", 1.0), ("a", "y", 1.0)]) == ["conflict"] * 3
    assert _status(spark, [("a", "x", None), ("a", "y", None)]) == ["conflict"] * 2  # a null price hides nothing
    assert _status(spark, [("a", None, 1.0), ("b", None, 1.0)]) == ["unique"] * 2
    known = spark.createDataFrame([("a", "x", 1.0)], "event_id string, name string, price double").select("event_id", records.payload_hash(["name", "price"]).alias("hash"))
    assert _status(spark, [("a", "x", 1.0), ("b", "x", 1.0)], known) == ["duplicate", "unique"]
    assert _status(spark, [("a", "x", 9.0)], known) == ["conflict"]
    assert _status(spark, []) == []


def test_one_row_of_a_mass_replay_is_unique(spark):
    """Rows of one id, equal or not, come from many partitions; one of the first ones in order is unique."""
    df = spark.range(3000, numPartitions=9).select((F.col("id") % 7).alias("ingest_seq"), F.lit("a").alias("event_id"), F.lit("x").alias("name"), F.lit(1.0).alias("price"))
    got = records.status(df, payload=["name", "price"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("ingest_seq").alias("lo")).collect()
    assert {r.status: r.n for r in got} == {"unique": 1, "duplicate": 2999} and all(r.lo == 0 for r in got)
    none = records.status(df.withColumn("event_id", F.lit(None).cast("string")), payload=["name", "price"])
    assert {r.status: r["count"] for r in none.groupBy("status").count().collect()} == {"unique": 1, "duplicate": 2999}


def test_every_row_has_one_route(spark):
    rows, _ = frame(spark, event(), event(), event(event_id="e2", price="-1"), event(event_id="e3"), event(event_id="e3", name="other"), event(event_id="e4", name=None))
    n = {r.route: r["count"] for r in records.route(rows, order="produced_at").groupBy("route").count().collect()}
    assert n == {"valid": 1, "duplicate": 1, "invalid": 2, "conflict": 2}


def test_schema_changes():
    from pyspark.sql import types as T

    a = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    assert schemas.compatibility(a, a) == "IDENTICAL"
    wider = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType()), T.StructField("z", T.StringType())])
    assert schemas.compatibility(a, wider) == "COMPATIBLE" and schemas.compatibility(wider, a) == "INCOMPATIBLE"
    assert schemas.compatibility(a, T.StructType(a.fields[::-1])) == "INCOMPATIBLE"
    assert schemas.compatibility(a, T.StructType([T.StructField("x", T.IntegerType(), False), a.fields[1]])) == "INCOMPATIBLE"


def test_text(spark):
    df = spark.createDataFrame([("£1,234.50",), ("free",), ("$ 0.99",), (None,), ("12",)], "t string")
    price, currency = text.price_text(F.col("t"), "GBP")
    assert [tuple(r) for r in df.select(price, currency).collect()] == [(Decimal("1234.50"), "GBP"), (None, "GBP"), (Decimal("0.99"), "USD"), (None, None), (Decimal("12.00"), "GBP")]
    seg = spark.createDataFrame([("path/../evil",), ("a b",)], "t string").select(text.path_segment(F.col("t"))).collect()
    assert [r[0] for r in seg] == ["path_._evil", "a_b"]


def test_messages_are_parsed_once(spark, tmp_path):
    """Neither half of a strict parse repeats the parser in its filter; a publication checks what it writes as it writes it, and leaves nothing if refused."""
    good, bad = ({"event_id": i, "event_type": "product.observation", "schema_version": "1", "source": "s", "produced_at": "2026-01-01T00:00:00Z", "payload": {"external_id": "x", "name": "n", "url": "u", "price": p, "currency": "EUR", "availability": "in_stock", "category": "c", "listing_id": None, "seller_id": None, "collected_at": "2026-01-01T00:00:00Z"}} for i, p in (("a", "1"), ("b", "-1")))
    lines = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),), ("{",)], "value string")
    for half in records.parse(lines, strict=True):
        assert half._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    events, dead = records.parse(lines, strict=True)
    assert [r.event_id for r in events.collect()] == ["a"] and {r.error for r in dead.collect()} == {"malformed_json", "contract: payload.price"}
    frame = lambda *e: spark.createDataFrame(list(e), EVENT)
    with pytest.raises(ValueError, match="contract: payload.price"):
        landed.publish(frame(good, bad), str(tmp_path / "refused"))
    assert not (tmp_path / "refused").exists()
    kept = landed.publish(frame(good), str(tmp_path / "kept"))
    with pytest.raises(ValueError):
        landed.publish(frame(bad), str(tmp_path / "kept"))
    assert kept.count() == 1 and len(list((tmp_path / "kept").iterdir())) == 1


def test_a_late_task_of_a_refused_publication_leaves_nothing(spark, tmp_path):
    """One task refuses its row at once; the other one comes to its first row, and makes its file, when the job has failed."""
    sums = lambda to, f: F.aggregate(F.sequence(F.lit(1), to), F.lit(0), f)
    late = sums(F.col("id").cast("int") * 6000, lambda a, x: (a + sums(F.lit(6000), lambda b, y: (b + y * x) % 7)) % 7).cast("string")  # seconds that no interrupt ends
    said = {"external_id": F.lit("x"), "name": F.when(F.col("id") == 1, F.concat(F.lit("n"), late)).otherwise("n"), "url": F.lit("u"), "price": F.when(F.col("id") == 0, "-1").otherwise("1"), "currency": F.lit("EUR"), "availability": F.lit("in_stock"), "category": F.lit("c"), "listing_id": F.lit(None).cast("string"), "seller_id": F.lit(None).cast("string"), "collected_at": F.lit("2026-01-01T00:00:00Z")}
    e = {"event_id": F.lit("a"), "event_type": F.lit("product.observation"), "schema_version": F.lit("1"), "source": F.lit("s"), "produced_at": F.lit("2026-01-01T00:00:00Z"), "payload": F.struct(*[c.alias(n) for n, c in said.items()])}
    events = spark.range(2, numPartitions=2).select(*[c.alias(n) for n, c in e.items()])
    with pytest.raises(ValueError, match="contract: payload.price"):
        landed.publish(events, str(tmp_path / "refused"))
    time.sleep(4)
    assert not list(tmp_path.iterdir())
