"""Lake, warehouse and stream: replays change nothing, conflicts raise, batch equals stream."""

import json
from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from priceloom.operators import records
from priceloom.operators.warehouse import ConflictError, Warehouse, append_results
from priceloom.sources import lake, landed
from priceloom.streaming import pipeline
from tests.test_records import event, frame


@pytest.fixture
def rows(spark):
    days = ["2026-09-12", "2026-09-12", "2026-09-13", "2026-09-12", "2026-08-31"]
    sources = ["fake-store", "fake-store", "fake-store", "bestbuy", "fake-store"]
    good, _ = frame(spark, *[event(event_id=f"evt-{i}", source=s, external_id=f"p{i}", collected_at=f"{d}T0{i}:00:00Z") for i, (d, s) in enumerate(zip(days, sources, strict=True))])
    return good


def test_lake(spark, rows, tmp_path):
    path = f"file://{tmp_path}/silver"
    assert lake.scan(spark, path).count() == 0 and lake.discover(spark, path).count() == 0
    lake.write(rows, path)
    lake.write(rows.filter("event_id = 'evt-0'"), path)
    assert lake.scan(spark, path).count() == 5
    assert [tuple(r)[:4] for r in lake.discover(spark, path).collect()] == [("bestbuy", "2026", "09", "12"), ("fake-store", "2026", "08", "31"), ("fake-store", "2026", "09", "12"), ("fake-store", "2026", "09", "13")]
    some = lake.scan(spark, path, lake.Partitions("fake-store", date(2026, 9, 1), date(2026, 9, 12)), ["event_id"])
    assert sorted(r.event_id for r in some.collect()) == ["evt-0", "evt-1"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "source_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="after"):
        lake.Partitions(start=date(2026, 2, 1), end=date(2026, 1, 1))


def test_compaction(spark, rows, tmp_path):
    path = f"file://{tmp_path}/bronze"
    one = lake.with_partitions(rows.filter("event_id = 'evt-0'"))
    for i in range(6):
        one.withColumn("event_id", F.lit(f"c{i}")).write.mode("append").partitionBy(*lake.PARTS).parquet(path)
    lake.with_partitions(rows.filter("source = 'bestbuy'")).write.mode("append").partitionBy(*lake.PARTS).parquet(path)
    before = sorted(map(str, lake.scan(spark, path).collect()))
    done = lake.compact(spark, path).collect()
    assert [(r.files_before, r.rows) for r in done] == [(6, 6)]
    assert sorted(map(str, lake.scan(spark, path).collect())) == before
    assert {r.file_count for r in lake.discover(spark, path).collect()} == {1} and lake.compact(spark, path).count() == 0


def test_no_column_is_lost(spark, rows, tmp_path):
    path = f"file://{tmp_path}/wide"
    lake.write(rows.withColumn("region", F.lit("x")), path)
    lake.write(rows.filter("event_id = 'evt-0'").withColumn("note", F.lit(1)), path)
    whole = spark.read.schema(lake.stored_schema(spark, path)).parquet(path)
    assert {(r.event_id, r.region, r.note) for r in whole.collect()} == {("evt-0", None, 1), *((f"evt-{i}", "x", None) for i in range(1, 5))}
    one = lake.with_partitions(rows.filter("event_id = 'evt-0'"))
    for i in range(6):
        one.withColumns({"event_id": F.lit(f"c{i}"), f"extra{i % 2}": F.lit(i)}).write.mode("append").partitionBy(*lake.PARTS).parquet(path)
    before = sorted(map(str, spark.read.schema(lake.stored_schema(spark, path)).parquet(path).collect()))
    assert [r.files_before for r in lake.compact(spark, path).collect()] == [7]
    after = spark.read.schema(lake.stored_schema(spark, path)).parquet(path)
    assert {"region", "note", "extra0", "extra1"} <= set(after.columns) and sorted(map(str, after.select(*lake.stored_schema(spark, path).names).collect())) == before


def test_a_hot_day_is_many_files(spark, rows, tmp_path):
    path = f"file://{tmp_path}/hot"
    many = rows.filter("event_id = 'evt-0'").join(spark.range(20_000)).withColumn("event_id", F.concat(F.lit("h"), F.col("id").cast("string"))).drop("id")
    lake.write(many, path, most_file_bytes=20_000)
    files = {r.file_count for r in lake.discover(spark, path).collect()}
    assert len(files) == 1 and min(files) > 3 and lake.scan(spark, path).count() == 20_000


def test_empty_lakes(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    assert lake.compact(spark, path).collect() == []
    (tmp_path / "none").mkdir()
    assert lake.compact(spark, path).collect() == []


def test_warehouse(spark, rows, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/wh")
    assert w.load(rows) == {"sources": 2, "products": 1, "source_products": 5, "observations": 5}
    assert w.load(rows.unionByName(rows)) == dict.fromkeys(("sources", "products", "source_products", "observations"), 0)
    other = rows.withColumn("price", F.lit(1).cast("decimal(12,2)"))
    new = rows.filter("event_id = 'evt-1'").withColumn("event_id", F.lit("evt-9"))
    with pytest.raises(ConflictError, match="evt-0"):
        w.load(other.filter("event_id = 'evt-0'").unionByName(new))
    assert w.table("observations").count() == 5
    moved = new.withColumns({"name": F.lit("Another"), "event_id": F.lit("evt-10")})
    assert w.load(moved)["products"] == 1 and w.table("source_products").count() == 5  # the first mapping stays
    assert w.load(rows.limit(0)) == dict.fromkeys(("sources", "products", "source_products", "observations"), 0)


def test_results_are_appended_once(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "check_name string, run long")
    path = f"file://{tmp_path}/results"
    assert append_results(spark, path, df, F.col("check_name"), F.col("run")) == 2
    assert append_results(spark, path, df, F.col("check_name"), F.col("run")) == 0
    assert {r.replay_key for r in spark.read.parquet(path).collect()} == {"a:1", "b:_"}


def test_landed_json(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1, "price": 2.5}\n{bad\n{"id": "no"}\n')
    items, bad = landed.read_json_items(spark, str(tmp_path), T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())]))
    assert [tuple(r)[:2] for r in items.collect()] == [(1, 2.5)] and bad.count() == 2


def _land(path, *events):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.txt").write_text("".join(e if isinstance(e, str) else json.dumps(e) + "\n" for e in events))


def test_stream_equals_batch_and_restarts_clean(spark, tmp_path):
    source, out, ck = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck"
    _land(source, event(), event(), event(event_id="e2", price="-1"), "{bad\n", event(event_id="e3"), event(event_id="e3", name="other"))
    pipeline.run(pipeline.read_messages(spark, str(source)), out, ck).awaitTermination()
    got = spark.read.parquet(f"{out}/records")
    n = {r.route: r["count"] for r in got.groupBy("route").count().collect()}
    assert n == {"valid": 1, "duplicate": 1, "invalid": 1, "conflict": 2} and spark.read.parquet(f"{out}/dead").count() == 1
    batch, dead = pipeline.process_batch(spark.read.text(str(source)).withColumns({"partition": F.lit(0), "offset": F.lit(0)}), None)
    assert {r.route: r["count"] for r in batch.groupBy("route").count().collect()} == n and dead.count() == 1
    _land(source, event(), event(event_id="evt-001", name="changed"), event(event_id="e5"))
    pipeline.run(pipeline.read_messages(spark, str(source)), out, ck).awaitTermination()
    late = spark.read.parquet(f"{out}/records").filter("batch = 1")
    assert {(r.event_id, r.route) for r in late.collect()} == {("evt-001", "conflict"), ("e5", "valid")}
    pipeline.run(pipeline.read_messages(spark, str(source)), out, ck).awaitTermination()
    assert spark.read.parquet(f"{out}/records").count() == 8


def test_order_letters_and_conflicts_of_a_stream(spark, tmp_path):
    """Equal broken lines are letters of their own; offsets follow the lines; an id with two payloads stays a conflict whichever comes again."""
    source, out, ck = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck"
    key = "s:p:2026-09-03T08:00:00+00:00"
    run = lambda: pipeline.run(pipeline.read_messages(spark, str(source)), out, ck).awaitTermination()
    _land(source, "{bad\n", event(event_id=key), "{bad\n", event(event_id=key, name="other"), event(event_id="plain"))
    run()
    assert spark.read.parquet(f"{out}/dead").select("letter_id").distinct().count() == 2
    first = spark.read.parquet(f"{out}/records").filter("batch = 0")
    assert sorted(r.offset for r in first.collect()) == [1, 3, 4] and {r.route for r in first.filter(F.col("event_id") == key).collect()} == {"conflict"}
    for name in ("Test Product", "other", "third"):
        _land(source, event(event_id=key, name=name), event(event_id="plain"))
        run()
    later = spark.read.parquet(f"{out}/records").filter("batch > 0")
    assert {(r.event_id, r.route) for r in later.collect()} == {(key, "conflict"), ("plain", "duplicate")}
    slots = {p.name for p in (tmp_path / "out" / "seen").iterdir() if p.is_dir()}
    assert "slot=2026-09" in slots and len(slots) == 2
    n = spark.read.parquet(f"{out}/metrics").filter("batch = 0").first()
    assert (n.received, n.valid, n.conflict, n.dead) == (5, 1, 2, 2)


def test_landed_files_are_read_in_pieces(spark, tmp_path):
    """A file is no single row and no single task; offsets are still the numbers of its lines, blank ones counted."""
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / f"{name}.txt").write_bytes(b"\n".join((b"" if i % 7 == 3 else f"{name}{i} é".encode() * (1 + i % 5)) + b"\r" * (i % 2) for i in range(400)))
    got = []
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        stream = pipeline.read_messages(spark, str(tmp_path / "in")).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck"))
        stream.foreachBatch(lambda b, _: got.append((b.rdd.getNumPartitions(), pipeline.placed(b).collect()))).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    [(tasks, rows)] = got
    assert tasks > 4
    assert sorted((r.partition[-5], r.offset, r.value) for r in rows) == sorted((n, i, f"{n}{i} é" * (1 + i % 5)) for n in "ab" for i in range(400) if i % 7 != 3)


def test_event_time(spark, tmp_path):
    rows = [(f"e{i % 3}", datetime(2026, 1, 1, 0, i)) for i in range(9)]
    spark.createDataFrame(rows, "event_id string, ts timestamp").write.parquet(f"file://{tmp_path}/s")
    stream = lambda: spark.readStream.schema("event_id string, ts timestamp").parquet(f"file://{tmp_path}/s")

    def drain(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert len(drain(pipeline.drop_replays(stream(), at="ts"), "once")) == 3
    assert sorted(r.n for r in drain(pipeline.windowed_counts(stream(), [], "ts"), "windows", "complete")) == [4, 5]
    assert sum(r.n for r in drain(pipeline.windowed_counts(stream(), [], "ts", slide="1 minute"), "sliding", "complete")) == 45
    assert [r.n for r in drain(pipeline.sessions(stream(), ["event_id"], "ts"), "sessions", "complete")] == [3, 3, 3]


def test_generator(spark):
    a, b = (landed.generate_events(spark, 50).collect() for _ in range(2))
    assert a == b
    events, dead = records.parse(landed.as_messages(landed.generate_events(spark, 50)))
    good, bad = records.validate(records.normalize(records.flatten(events)))
    assert (good.count(), bad.count(), dead.count()) == (50, 0, 0)


def test_catalog_has_every_table(spark, sf_dir):
    spark.range(3).createOrReplaceTempView("not_of_the_directory")
    got = entry.queries()["src17_catalog"](spark, sf_dir).collect()
    files = sorted(Path(sf_dir).glob("*.parquet"))
    want = {(f.stem, name, pq.read_metadata(f).num_rows) for f in files for name in pq.read_schema(f).names}
    assert len(files) == 14 and {(r.table, r.column, r.row_count) for r in got} == want
    assert all(any(r.is_key for r in got if r.table == f.stem) for f in files)
