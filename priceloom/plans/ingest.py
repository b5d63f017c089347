"""Queries that take data in and out: sources, sinks, contract, streams, lake upkeep (SRC, SNK, ST, D8, D9, P17, P18, P26, V ids)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priceloom import schemas
from priceloom.functions import html, mapping, text
from priceloom.operators import assistant, records
from priceloom.operators.warehouse import Warehouse, map_rows
from priceloom.plans.platform import _VALID, _room, _valid
from priceloom.plans.records import RAW, _normal, raw_records
from priceloom.plans.registry import query
from priceloom.sources import lake, landed
from priceloom.streaming import pipeline
from priceloom.views import Relations


def _yearly(r: Relations) -> DataFrame:
    """Valid records under a source per category, by year, so that partitions are of some size."""
    return _valid(r).withColumns({"source": F.col("category"), "collected_at": F.date_trunc("year", "collected_at")})


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


# Lake.


@query("src01_discover", _VALID + "SELECT DISTINCT category AS source_part, strftime(collected_at, '%Y') AS year, '01' AS month, '01' AS day FROM v WHERE category IN ('A', 'N') AND collected_at >= TIMESTAMP '1997-01-01'", prefix=False)
def src01(r: Relations) -> DataFrame:
    path = _room(r, "discover")
    lake.write(_yearly(r), path)
    found = [lake.discover(r.spark, path, lake.Partitions(s, date(1997, 1, 1))).filter("file_count > 0") for s in ("A", "N")]
    return found[0].unionByName(found[1]).select(*lake.PARTS)


@query("src03_read_actions", _VALID + """SELECT 'counted' AS what, count(*) AS n FROM v UNION ALL SELECT 'collected', count(*) FROM v WHERE category = 'R' AND strftime(collected_at, '%Y') = '1997'
UNION ALL SELECT 'no such source', 0 UNION ALL SELECT 'columns of no such lake', 15 + 4""", prefix=False)
def src03(r: Relations) -> DataFrame:
    path = _room(r, "actions")
    lake.write(_yearly(r), path)
    one = lake.scan(r.spark, path, lake.Partitions("R", date(1997, 1, 1), date(1997, 12, 31)), ["event_id"])
    none = lake.scan(r.spark, f"{path}-none")
    got = [("counted", lake.scan(r.spark, path).count()), ("collected", len(one.collect())), ("no such source", lake.scan(r.spark, path, lake.Partitions("nobody")).count() + none.count()), ("columns of no such lake", len(none.columns))]
    return r.spark.createDataFrame(got, "what string, n long")


@query("src07_parquet_list", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1", prefix=False)
def src07(r: Relations) -> DataFrame:
    """Files by a list of paths; a list without any is no error."""
    parts = [f"{_room(r, 'list')}-{k}" for k in range(2)]
    for k, path in enumerate(parts):
        r.table("customer").filter(F.col("c_custkey") % 2 == k).write.parquet(path)
    assert lake.try_read(r.spark, f"{parts[0]}-none") is None
    return lake.try_read(r.spark, *parts).groupBy("c_nationkey").agg(_n())


@query("src18_objects", "SELECT * FROM (VALUES ('list', 'a.json,b.json'), ('get', '{\"n\": 1}'), ('exists', 'true'), ('deleted', 'true'), ('again', 'false'), ('left', 'b.json')) AS t(action, outcome)", prefix=False)
def src18(r: Relations) -> DataFrame:
    spark, path = r.spark, _room(r, "objects")
    for name, content in (("b.json", b"{}"), ("a.json", b"{}"), ("a.json", b'{"n": 1}')):
        lake.put(spark, f"{path}/{name}", content)
    got = [("list", ",".join(lake.names(spark, path))), ("get", lake.get(spark, f"{path}/a.json").decode()), ("exists", str(lake.exists(spark, f"{path}/a.json")).lower())]
    got += [(what, str(lake.delete(spark, f"{path}/a.json")).lower()) for what in ("deleted", "again")] + [("left", ",".join(lake.names(spark, path)))]
    return spark.createDataFrame(got, "action string, outcome string")


@query("snk01_columns_stay", _VALID + """SELECT category AS source_part, count(*) AS n, count(*) FILTER (WHERE l_partkey % 3 <> 0) AS regions, count(*) FILTER (WHERE l_partkey % 3 = 0) AS notes FROM v GROUP BY 1""", prefix=False)
def snk01(r: Relations) -> DataFrame:
    """Two batches with a column each that the other lacks: neither loses its own."""
    path = _room(r, "columns")
    rows = _yearly(r).withColumn("third", F.col("external_id").cast("long") % 3)
    lake.write(rows.filter("third <> 0").withColumn("region", F.lit("x")), path)
    lake.write(rows.filter("third = 0").withColumn("note", F.lit(1)), path)
    back = r.spark.read.schema(lake.stored_schema(r.spark, path)).parquet(path)
    return back.groupBy("source_part").agg(_n(), F.count("region").alias("regions"), F.count("note").alias("notes"))


@query("d08_compaction", _VALID + """SELECT category AS source_part, strftime(collected_at, '%Y') AS year, 6 AS files_before, count(*) AS rows, count(*) AS kept, sum(l_partkey)::BIGINT AS extra
FROM v WHERE category = 'A' AND strftime(collected_at, '%Y') IN ('1996', '1997') GROUP BY ALL""", prefix=False)
def d08(r: Relations) -> DataFrame:
    """Two partitions of six files each, five of which have a column that the lake's schema lacks, and others of one file."""
    path, rows = _room(r, "compact"), lake.with_partitions(_yearly(r))
    few = rows.filter("source_part = 'A' AND year IN ('1996', '1997')").withColumns({"extra": F.col("external_id").cast("long"), "k": F.pmod(F.xxhash64("event_id"), F.lit(6))})
    for k in range(6):
        few.filter(F.col("k") == k).drop("k").coalesce(1).sortWithinPartitions("year").write.mode("append").partitionBy(*lake.PARTS).parquet(path)
    rows.filter("source_part = 'N'").coalesce(1).sortWithinPartitions("year").write.mode("append").partitionBy(*lake.PARTS).parquet(path)
    done = lake.compact(r.spark, path)
    after = r.spark.read.schema(lake.stored_schema(r.spark, path)).parquet(path).groupBy("source_part", "year").agg(F.count(F.lit(1)).alias("kept"), F.sum("extra").alias("extra"))
    return done.join(after, ["source_part", "year"]).select("source_part", "year", F.col("files_before").cast("int").alias("files_before"), "rows", "kept", "extra")


@query("st07_late_rows", _VALID + "SELECT strftime(collected_at, '%Y') AS year, count(*) AS n FROM v GROUP BY 1", prefix=False)
def st07(r: Relations) -> DataFrame:
    """Rows of earlier years come in a later batch, by time of production; they land in the partitions of their own times."""
    path, rows = _room(r, "late"), _yearly(r)
    lake.write(rows.filter("collected_at >= '1998-01-01'"), path)
    lake.write(rows.filter("collected_at < '1998-01-01'"), path)
    return lake.scan(r.spark, path, columns=["year"]).groupBy("year").agg(_n())


@query("src09_relations", "SELECT 'view' AS via, count(*) AS n FROM nation UNION ALL SELECT 'path', count(*) FROM region", prefix=False)
def src09(r: Relations) -> DataFrame:
    r.table("nation").createOrReplaceTempView("relation_by_name")
    by = {"view": landed.read_relation(r.spark, "relation_by_name"), "path": landed.read_relation(r.spark, f"{r.dir}/region.parquet")}
    view, path = (df.agg(_n()).select(F.lit(via).alias("via"), "n") for via, df in by.items())
    return view.unionByName(path)


# Landed answers and pages.

_ITEM = "id long, title string, price double"


def _item() -> Column:
    """A part as an item; some are no objects, some lack a title."""
    return F.when(F.col("p_partkey") % 11 == 0, F.lit('"text"')).otherwise(F.to_json(F.struct(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("title"), F.col("p_retailprice").alias("price"))))


def _answers(r: Relations, by: str) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", _item().alias("item")))), lambda x: x["item"])
    return r.table("part").groupBy(by).agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("answer"))


@query("src10_items_with_reasons", """SELECT p_brand, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1)::INTEGER AS index, CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 9 <> 0 THEN p_partkey END AS id,
CASE WHEN p_partkey % 11 = 0 THEN 'not an object of the schema' WHEN p_partkey % 9 = 0 THEN 'no title' END AS why FROM part""", prefix=False)
def src10(r: Relations) -> DataFrame:
    good, bad = landed.items_of(_answers(r, "p_brand"), "answer", T.StructType.fromDDL(_ITEM), needed=("id", "title"))
    return good.select("p_brand", "index", "id", F.lit(None).cast("string").alias("why")).unionByName(bad.select("p_brand", "index", F.lit(None).cast("long").alias("id"), F.substring_index("reason", ": ", -1).alias("why")))


@query("src11_paged_answers", """SELECT p_type, count(*) FILTER (WHERE p_type <> 'PROMO' AND p_partkey % 11 <> 0) AS items, CASE WHEN p_type = 'PROMO' THEN 1 ELSE count(*) FILTER (WHERE p_partkey % 11 = 0) END AS malformed FROM part GROUP BY 1""", prefix=False)
def src11(r: Relations) -> DataFrame:
    """Pages of an API: an object with the items in a field; a page without it is malformed as a whole."""
    pages = _answers(r, "p_type").withColumn("answer", F.when(F.col("p_type") == "PROMO", F.lit('{"error": 403}')).otherwise(F.concat(F.lit('{"total": 1, "products": '), "answer", F.lit("}"))))
    good, bad = landed.items_of(pages, "answer", T.StructType.fromDDL(_ITEM), field="products", needed=("id",))
    both = good.select("p_type", F.lit(1).alias("g")).unionByName(bad.select("p_type", F.lit(0).alias("g")))
    return both.groupBy("p_type").agg(F.count_if(F.col("g") == 1).alias("items"), F.count_if(F.col("g") == 0).alias("malformed"))


@query("src13_paging", """WITH landed AS (SELECT page_id FROM pages WHERE page_id % 11 <> 4), s AS (SELECT page_id AS p FROM landed WHERE page_id % 7 = 0), steps AS (SELECT p, k FROM s, range(5) AS t(k))
SELECT concat('http://shop/', p) AS start_url, concat('http://shop/', p + k) AS page_url, (k + 1)::INTEGER AS page_no FROM steps WHERE (SELECT count(*) FROM landed WHERE page_id BETWEEN p AND p + k) = k + 1""", prefix=False)
def src13_paging(r: Relations) -> DataFrame:
    """Runs of seven pages, each linked to the next, of which some never landed: five pages at most, and those before a missing one."""
    url = F.concat(F.lit("http://shop/"), F.col("page_id").cast("string"))
    link = F.concat(F.lit('<li class="next"><a href="'), (F.col("page_id") + 1).cast("string"), F.lit('">next</a></li>'))
    pages = r.table("pages").filter("page_id % 11 <> 4").select("page_id", url.alias("url"), F.concat(F.col("html"), F.when(F.col("page_id") % 7 != 6, link).otherwise("")).alias("html"))
    return html.follow_pages(html.parse_pages(pages, html.BOOKS), pages.filter("page_id % 7 = 0").select("url"))


@query("src13_card_layout", """SELECT page_id, concat('7', page_id) AS product_id, (page_id * 1000 + 5)::DECIMAL(12,2) AS price, 'EUR' AS currency, CASE page_id % 6 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'out_of_stock' WHEN 2 THEN 'preorder' WHEN 3 THEN 'in_stock' WHEN 4 THEN 'out_of_stock' ELSE 'unknown' END AS availability FROM pages""", prefix=False)
def src13_cards(r: Relations) -> DataFrame:
    """The card layout: thousands by dots, and availability by text, class and attribute."""
    k = F.col("page_id").cast("string")
    stock = F.element_at(F.array(*map(F.lit, ['<span class="stock-status">In Stock</span>', '<p class="availability">Currently unavailable</p>', '<span class="availability">Coming soon</span>', '<span class="in-stock"></span>', '<i data-available="false"></i>', '<span class="stock-status">call</span>'])), (F.col("page_id") % 6 + 1).cast("int"))
    card = F.concat(F.lit('<div class="product-grid"><div class="product-card"><h2><a href="/p/7'), k, F.lit('-x">Name</a></h2><span class="price">&euro;'), F.format_string("%d.005", F.col("page_id")), F.lit("</span>"), stock, F.lit("</div></div>"))
    pages = r.table("pages").select(F.concat(F.lit("http://shop/"), k).alias("url"), card.alias("html"))
    found = html.products_of(html.parse_pages(pages, html.CARDS), html.CARDS)
    return found.select(F.regexp_extract("page_url", r"(\d+)$", 1).cast("long").alias("page_id"), "product_id", "price", "currency", "availability")


@query("src15_mock_source", "SELECT * FROM (VALUES ('mock_source', 'e1', NULL), ('mock_source', 'e2', NULL), (NULL, NULL, 'no price')) AS t(source, event_id, reason)", prefix=False)
def src15(r: Relations) -> DataFrame:
    good, bad = landed.mock_source(r.spark, [{"event_id": "e1"}, {"event_id": "e2"}], [{"raw_record": {"a": 1}, "reason": "no price"}])
    return good.select("source", "event_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select(F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("event_id"), "reason"))


# Messages made of orders: some are no JSON, of another type, without payload, or with a value that breaks the contract.

_KIND = """CASE WHEN k % 31 = 0 THEN 'malformed_json' WHEN k % 37 = 0 THEN 'unknown_event_type' WHEN k % 41 = 0 THEN 'missing_payload' END"""
_ORDERS = f"WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, {_KIND.replace('k %', 'o_orderkey %')} AS dead, o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS invalid, o_orderpriority AS priority FROM orders)\n"


def _events(r: Relations, name: str = "order") -> DataFrame:
    k = F.col("o_orderkey")
    t = lambda c: c.cast("string")
    at = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.struct(
        F.concat(F.lit("c"), t(F.col("o_custkey"))).alias("external_id"), F.concat(F.lit(f"{name} "), t(k)).alias("name"), F.lit("http://x/").alias("url"), F.when(k % 11 == 0, "-1").otherwise("2.50").alias("price"), F.lit("EUR").alias("currency"),
        F.when(k % 13 == 0, "sold").otherwise("in_stock").alias("availability"), F.col("o_orderpriority").alias("category"), F.lit(None).cast("string").alias("listing_id"), F.lit(None).cast("string").alias("seller_id"), at.alias("collected_at"))
    event = F.concat(F.lit("orders:"), t(k), F.lit(":"), at)
    return r.table("orders").select("o_orderkey", event.alias("event_id"), F.lit(schemas.EVENT_TYPE).alias("event_type"), F.lit("1").alias("schema_version"), F.lit("orders").alias("source"), at.alias("produced_at"), payload.alias("payload"))


def _messages(r: Relations, name: str = "order") -> DataFrame:
    k = F.col("o_orderkey")
    good = F.to_json(F.struct("event_id", "event_type", "schema_version", "source", "produced_at", "payload"))
    odd = F.when(k % 31 == 0, '{"event_id": ').when(k % 37 == 0, '{"event_type": "other", "payload": {}}').when(k % 41 == 0, F.lit(f'{{"event_type": "{schemas.EVENT_TYPE}"}}'))
    return _events(r, name).select("o_orderkey", F.coalesce(odd, good).alias("value"))


@query("v07_contract_strict", _ORDERS + """SELECT coalesce(dead, CASE WHEN k % 11 = 0 AND k % 13 = 0 THEN 'contract: payload.price, payload.availability' WHEN k % 11 = 0 THEN 'contract: payload.price' WHEN k % 13 = 0 THEN 'contract: payload.availability' END, 'ok') AS kind, count(*) AS n FROM o GROUP BY 1""", prefix=False)
def v07_strict(r: Relations) -> DataFrame:
    good, dead = records.parse(_messages(r), strict=True)
    return good.select(F.lit("ok").alias("kind")).unionByName(dead.select(F.col("error").alias("kind"))).groupBy("kind").agg(_n())


@query("v07_contract_fields", """SELECT CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'event_id' WHEN 2 THEN 'payload.name' WHEN 3 THEN 'payload.listing_id' WHEN 4 THEN 'schema_version' WHEN 5 THEN 'produced_at,payload.collected_at' WHEN 6 THEN 'payload.price' ELSE 'payload.currency' END AS errors, count(*) AS n FROM events GROUP BY 1""", prefix=False)
def v07_fields(r: Relations) -> DataFrame:
    k = F.col("event_id") % 8
    either = lambda i, bad, good: F.when(k == i, F.lit(bad)).otherwise(F.lit(good))
    at = either(5, "2026-01-01T00:00:00", "2026-01-01T00:00:00+02:00")
    payload = F.struct(F.lit("x").alias("external_id"), either(2, "  ", "n").alias("name"), F.lit("u").alias("url"), either(6, "abc", "0").alias("price"), either(7, "EURO", "EUR").alias("currency"), F.lit("unknown").alias("availability"), F.lit("c").alias("category"), either(3, "", None).alias("listing_id"), F.lit(None).cast("string").alias("seller_id"), at.alias("collected_at"))
    e = F.struct(either(1, None, "e").alias("event_id"), F.lit(None).cast("string").alias("event_type"), either(4, "2", "1").alias("schema_version"), F.lit("s").alias("source"), at.alias("produced_at"), payload.alias("payload"))
    return r.table("events").select(F.array_join(records.contract_errors(e), ",").alias("errors")).groupBy("errors").agg(_n())


@query("snk07_dead_letters", _ORDERS + "SELECT dead AS error, count(*) AS n, count(*) AS letters FROM o WHERE dead IS NOT NULL GROUP BY 1", prefix=False)
def snk07(r: Relations) -> DataFrame:
    messages = _messages(r).select("value", F.lit("in").alias("partition"), F.col("o_orderkey").alias("offset"))
    twice = records.parse(messages.unionByName(messages))[1]  # a replay makes the same letter
    letters = records.dead_letter(twice, F.lit("raw"))
    return letters.groupBy("error").agg((F.count(F.lit(1)) / 2).cast("long").alias("n"), F.countDistinct("letter_id").alias("letters"))


@query("snk05_publish", _ORDERS + """SELECT 'refused' AS topic, 0 AS n, 0 AS keys UNION ALL SELECT 'raw', count(*), count(DISTINCT c) FROM o WHERE NOT invalid UNION ALL SELECT 'validated', count(*), count(DISTINCT c) FROM o WHERE NOT invalid""", prefix=False)
def snk05(r: Relations) -> DataFrame:
    """Raw events and validated records as messages; a publication that breaks the contract leaves nothing."""
    path, events = _room(r, "topics"), _events(r)
    try:
        landed.publish(events.drop("o_orderkey"), f"{path}/refused")
    except ValueError:
        pass
    raw = landed.publish(events.filter("o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0").drop("o_orderkey"), f"{path}/raw")
    good = landed.publish_validated(records.normalize(records.flatten(events)), f"{path}/validated")
    none = r.spark.createDataFrame([("refused", int(lake.exists(r.spark, f"{path}/refused")), 0)], "topic string, n long, keys long")
    for topic, df in (("raw", raw), ("validated", good)):
        back, dead = records.parse(df, strict=True)
        n = back.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("keys"))
        none = none.unionByName(n.select(F.lit(topic).alias("topic"), "n", "keys"))
    return none


@query("st04_message_keys", _ORDERS + "SELECT concat('orders:c', c) AS key, count(*) AS n FROM o GROUP BY 1", prefix=False)
def st04(r: Relations) -> DataFrame:
    """A listing's messages share a key, so a broker keeps their order."""
    return landed.as_messages(_events(r).drop("o_orderkey")).groupBy("key").agg(_n())


@query("st01_stream_twice", _ORDERS + """, m AS (SELECT *, k % 5 = 0 AS again, k % 7 = 0 AS changed FROM o), first AS (SELECT 1 AS run, coalesce(CASE WHEN dead IS NOT NULL THEN 'dead' WHEN invalid THEN 'invalid' END, 'valid') AS route, 1 AS n FROM m),
second AS (SELECT 2 AS run, CASE WHEN dead IS NOT NULL THEN 'dead' WHEN invalid THEN 'invalid' WHEN changed THEN 'conflict' ELSE 'duplicate' END AS route, again::INTEGER + changed::INTEGER AS n FROM m WHERE again OR changed)
SELECT run, route, sum(n)::BIGINT AS n FROM (SELECT * FROM first UNION ALL SELECT * FROM second) GROUP BY ALL""", prefix=False)
def st01(r: Relations) -> DataFrame:
    """The pipeline as a stream: a first landing, then one with replays and with other payloads under known ids; a third run finds nothing new."""
    spark, path = r.spark, _room(r, "stream")
    out = f"{path}/out"

    def run() -> int:
        pipeline.run(pipeline.read_messages(spark, f"{path}/in"), out, f"{path}/checkpoint").awaitTermination()
        return spark.read.parquet(f"{out}/records").agg(F.max("batch")).first()[0]

    _messages(r).select("value").write.mode("append").text(f"{path}/in")
    last = run()
    again = _messages(r).filter("o_orderkey % 5 = 0").unionByName(_messages(r, "changed").filter("o_orderkey % 7 = 0"))
    again.select("value").write.mode("append").text(f"{path}/in")
    assert run() > last
    run()
    routes = spark.read.parquet(f"{out}/records").select("batch", "route").unionByName(spark.read.parquet(f"{out}/dead").select("batch", F.lit("dead").alias("route")))
    return routes.groupBy(F.when(F.col("batch") <= last, 1).otherwise(2).alias("run"), "route").agg(_n())


@query("st05_replays_in_watermark", "SELECT event_type, count(*) AS n FROM events GROUP BY 1", prefix=False)
def st05(r: Relations) -> DataFrame:
    path, e = _room(r, "replays"), r.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    e.unionByName(e).write.parquet(f"{path}/in")
    stream = pipeline.drop_replays(r.spark.readStream.schema(e.schema).parquet(f"{path}/in"), at="ts")
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return r.spark.read.schema(e.schema).parquet(f"{path}/out").groupBy("event_type").agg(_n())


@query("st09_observed_routes", RAW + "SELECT count(*) AS rows, count(*) FILTER (WHERE route = 'invalid') AS invalid FROM (SELECT CASE WHEN schema_version IS NULL OR name IS NULL OR price < 0 OR availability <> 'in_stock' OR schema_version <> 1 OR currency = 'eur' THEN 'invalid' END AS route FROM n)", prefix=False)
def st09(r: Relations) -> DataFrame:
    """Counts that a frame reports while it is run for another purpose."""
    seen = Observation("routes")
    routed = records.route(_normal(r), order=["collected_at", "source"], payload=["source", "external_id", "price", "category", "collected_at"])
    pipeline.observed(routed, seen).write.format("noop").mode("overwrite").save()
    return r.spark.createDataFrame([(seen.get["rows"], seen.get["invalid"])], "rows long, invalid long")


@query("st10_incremental_load", _VALID + "SELECT 1 AS run, count(*) AS n FROM v WHERE category = 'A' UNION ALL SELECT 2, count(*) FROM v UNION ALL SELECT 3, count(*) FROM v", prefix=False)
def st10(r: Relations) -> DataFrame:
    """New files of the lake are loaded, run by run; a run without any changes nothing."""
    path, rows, got = _room(r, "increment"), _yearly(r), []
    w = Warehouse(r.spark, f"{path}/warehouse")
    for n, some in enumerate((rows.filter("category = 'A'"), rows.filter("category <> 'A'"), None), 1):
        if some is not None:
            lake.write(some, f"{path}/lake")
        pipeline.load_new(r.spark, f"{path}/lake", w, lake.layer_schema(), f"{path}/checkpoint").awaitTermination()
        got.append((n, w.table("observations").count()))
    return r.spark.createDataFrame(got, "run int, n long")


# Rows, listings, bounds, guard.


@query("v08_row_errors", RAW + """SELECT concat_ws('; ', CASE WHEN schema_version IS NOT NULL THEN 'Type mismatch for ''schema_version'': expected bigint, got string' ELSE 'Required field is null: schema_version' END, CASE WHEN name IS NULL THEN 'Required field is null: name' END, 'Missing required field: url') AS errors, count(*) AS n FROM n GROUP BY 1""", prefix=False)
def v08(r: Relations) -> DataFrame:
    rows = _normal(r).drop("url", "listing_id").withColumns({"schema_version": F.col("schema_version").cast("string"), "more": F.lit(1)})
    return rows.select(F.array_join(schemas.row_errors(rows, schemas.STORED), "; ").alias("errors")).groupBy("errors").agg(_n())


@query("v09_schema_changes", "SELECT * FROM (VALUES ('price', 'removed', true), ('stock', 'added', false), ('event_id', 'optional', false), ('schema_version', 'retyped bigint to string', true), ('schema_version', 'optional', false)) AS t(field, change, breaking)", prefix=False)
def v09(r: Relations) -> DataFrame:
    was = schemas.STORED
    now = T.StructType([*(T.StructField(f.name, T.StringType() if f.name == "schema_version" else f.dataType, f.nullable or f.name in ("event_id", "schema_version")) for f in was.fields if f.name != "price"), T.StructField("stock", T.StringType())])
    assert schemas.compatibility(was, now) == "INCOMPATIBLE"
    return r.spark.createDataFrame(schemas.schema_changes(was, now), "field string, change string, breaking boolean")


@query("v13_utc_bounds", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch(ts::DATE::TIMESTAMP)::BIGINT WHEN 1 THEN epoch(date_trunc('second', ts))::BIGINT WHEN 2 THEN epoch(date_trunc('second', ts))::BIGINT WHEN 3 THEN epoch(date_trunc('second', ts))::BIGINT - 7200 END AS seconds FROM events""", prefix=False)
def v13(r: Relations) -> DataFrame:
    e = r.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    day, second = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    k = F.col("event_id") % 5
    said = F.when(k == 0, day).when(k == 1, second).when(k == 2, F.concat(second, F.lit("Z"))).when(k == 3, F.concat(second, F.lit("+02:00"))).otherwise("soon")
    return e.select("event_id", F.unix_seconds(text.utc_bound(said)).alias("seconds"))


@query("v14_read_only_guard", "SELECT * FROM (VALUES ('SELECT 1 AS x', true), ('WITH a AS (SELECT 1 AS x) SELECT * FROM a', true), ('SELECT ''drop table t''', true), ('DROP TABLE t', false), ('WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a', false), ('SELECT 1; SELECT 2', false), ('SET a = b', false), ('', false)) AS t(asked, allowed)", prefix=False)
def v14(r: Relations) -> DataFrame:
    asked = ["SELECT 1 AS x", "WITH a AS (SELECT 1 AS x) SELECT * FROM a", "SELECT 'drop table t'", "DROP TABLE t", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT 1; SELECT 2", "SET a = b", ""]
    return r.spark.createDataFrame([(q, assistant.why_not_readonly(r.spark, q) is None) for q in asked], "asked string, allowed boolean")


@query("v18_in_list", "SELECT check_id, check_name FROM checks WHERE check_name = ANY(['en', 'de']) AND severity = ANY(['error', 'warning'])")
def v18(r: Relations) -> DataFrame:
    return r.checks.filter(F.col("check_name").isin("en", "de") & F.col("severity").isin("error", "warning")).select("check_id", "check_name")


@query("p18_listing", """SELECT concat('ebay:', p_partkey) AS listing_id, p_name AS title, CASE WHEN p_size % 6 <> 0 THEN concat('ebay:', p_brand) END AS seller_id, CASE WHEN p_size % 6 <> 0 AND p_size % 2 = 0 THEN p_size::VARCHAR END AS feedback, CASE p_size % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'like_new' WHEN 2 THEN 'for_parts' END AS condition,
CASE p_size % 3 WHEN 1 THEN 'true' WHEN 2 THEN 'false' END AS stock, p_size::VARCHAR AS category_id, CASE WHEN p_size % 9 NOT IN (0, 8) THEN p_retailprice::DECIMAL(12,2)::VARCHAR END AS price, CASE WHEN p_size % 9 = 0 THEN '-5.0' END AS refused, CASE WHEN p_size % 9 <> 8 THEN 'EUR' END AS currency, CASE WHEN p_size % 5 = 0 THEN concat('ebay:', lpad(p_partkey::VARCHAR, 12, '0')) END AS product_key FROM part""", prefix=False)
def p18(r: Relations) -> DataFrame:
    n, k = F.col("p_size"), F.col("p_partkey").cast("string")
    texts = lambda *x: F.array(*x).cast("array<string>")
    items = r.table("part").select(
        k.alias("itemId"), F.concat(F.lit(" "), F.col("p_name"), F.lit("\t")).alias("title"), F.struct(F.when(n % 9 == 0, "-5").when(n % 9 != 8, F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("value"), F.lit("eur").alias("currency")).alias("price"), F.lit("http://own").alias("itemWebUrl"),
        F.struct(F.when(n % 6 == 0, " ").otherwise(F.col("p_brand")).alias("username"), F.when(n % 2 == 0, n).alias("feedbackScore"), F.lit(None).cast("string").alias("feedbackPercentage")).alias("seller"),
        F.when(n % 3 == 1, texts(F.lit("x"))).when(n % 3 == 2, texts()).alias("shipTo"), F.when(n % 3 == 2, texts()).alias("pickup"), texts(F.lit("1"), n.cast("string")).alias("categoryIds"),
        F.element_at(F.array(*map(F.lit, ["Brand New", "excellent", "For parts or not working", "shiny"])), (n % 4 + 1).cast("int")).alias("condition"), F.create_map(F.lit("upc"), F.when(n % 5 == 0, F.lpad(k, 12, "0"))).alias("identifiers"))
    m = lambda key: F.try_element_at("metadata", F.lit(key))
    return mapping.market_listing(items).select(
        "listing_id", "title", "seller.seller_id", F.try_element_at("seller.metadata", F.lit("feedback_score")).alias("feedback"), m("condition").alias("condition"), m("availability_raw").alias("stock"), m("category_id").alias("category_id"),
        m("price").alias("price"), m("price_original").alias("refused"), m("currency").alias("currency"), "product_key")


@query("p26_rejected_rows", """SELECT coalesce(reason, 'loaded') AS reason, count(*) AS n FROM (SELECT CASE WHEN l_orderkey % 17 = 0 THEN 'Missing required field ''source''' WHEN l_orderkey % 19 = 0 THEN 'Missing required field ''availability''' WHEN l_orderkey % 11 = 0 AND l_orderkey % 7 <> 0 THEN 'Invalid price value ''abc''' WHEN l_orderkey % 23 = 0 THEN 'Invalid time' END AS reason FROM lineitem) GROUP BY 1""", prefix=False)
def p26(r: Relations) -> DataFrame:
    n = F.regexp_extract("event_id", r"^(\d+)", 1).cast("long")
    rows = raw_records(r).withColumns({"source": F.when(n % 17 == 0, "").otherwise(F.col("source")), "availability": F.when(n % 19 != 0, F.col("availability")), "price": F.when(n % 7 == 0, "").when(n % 11 == 0, "abc").otherwise("1.5"), "collected_at": F.when(n % 23 == 0, "soon").otherwise(F.col("collected_at"))})
    good, bad = map_rows(rows)
    return good.select(F.lit("loaded").alias("reason")).unionByName(bad.select("reason")).groupBy("reason").agg(_n())


@query("p26_reject_table", "SELECT 'observations' AS relation, count(*) FILTER (WHERE p_size % 7 <> 0) AS n FROM part UNION ALL SELECT 'rejects', count(*) FILTER (WHERE p_size % 7 = 0) FROM part", prefix=False)
def p26_table(r: Relations) -> DataFrame:
    """Rejected rows are kept once with their reason, however often the batch comes."""
    k = F.col("p_partkey").cast("string")
    rows = r.table("part").select(F.concat(F.lit("e"), k).alias("event_id"), F.when(F.col("p_size") % 7 != 0, "s").alias("source"), k.alias("external_id"), F.col("p_name").alias("name"), F.lit("u").alias("url"), F.lit("1.5").alias("price"), F.lit("EUR").alias("currency"), F.lit("in_stock").alias("availability"), F.col("p_type").alias("category"), F.lit("2024-01-01T00:00:00Z").alias("collected_at"))
    w = Warehouse(r.spark, _room(r, "rejects"))
    w.load_checked(rows)
    assert not any(w.load_checked(rows).values())
    return w.table("observations").agg(_n()).select(F.lit("observations").alias("relation"), "n").unionByName(r.spark.read.parquet(f"{w.path}/rejects").agg(_n()).select(F.lit("rejects").alias("relation"), "n"))


@query("d09_assigned_listings", """, t AS (SELECT source_product_id::VARCHAR AS l, concat('p', product_id % 10) AS p FROM listings WHERE product_id % 2 = 0), c AS (SELECT source_product_id::VARCHAR AS l, arg_max(concat('q', product_id % 7), obs_id) AS p FROM observed WHERE product_id % 3 = 0 GROUP BY 1)
SELECT coalesce(t.l, c.l) AS listing_id, coalesce(c.p, t.p) AS product_key FROM t FULL JOIN c ON t.l = c.l""")
def d09(r: Relations) -> DataFrame:
    table = r.listings.filter("product_id % 2 = 0").select(F.col("source_product_id").cast("string").alias("listing_id"), F.concat(F.lit("p"), (F.col("product_id") % 10).cast("string")).alias("product_key"))
    changes = r.observed.filter("product_id % 3 = 0").select(F.col("source_product_id").cast("string").alias("listing_id"), F.concat(F.lit("q"), (F.col("product_id") % 7).cast("string")).alias("product_key"), F.col("obs_id").alias("seq"))
    refused = changes.withColumns({"product_key": F.lit(""), "seq": F.col("seq") + 1})
    return mapping.assign_listings(table, changes.unionByName(refused))
