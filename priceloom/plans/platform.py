"""Queries that run lake, warehouse, pages, generator and intents end to end in a folder of their own under the shared one."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.functions import html
from priceloom.operators import assistant, records
from priceloom.operators.warehouse import Warehouse
from priceloom.plans.records import raw_records
from priceloom.plans.registry import query
from priceloom.sources import lake, landed
from priceloom.sources.rooms import new_path
from priceloom.views import Relations


def _room(r: Relations, name: str) -> str:
    return new_path(r.spark, name)


def _valid(r: Relations) -> DataFrame:
    """Valid records of which each id has one."""
    good, _ = records.validate(records.normalize(raw_records(r)))
    return good.groupBy("event_id").agg(F.min_by(F.struct(*[c for c in good.columns if c != "event_id"]), F.struct("collected_at", "source")).alias("x")).select("event_id", "x.*")


_VALID = """WITH n AS (SELECT concat(l_orderkey, '-', l_linenumber) AS event_id, concat('src', l_suppkey) AS source, l_partkey, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END::DECIMAL(12,2) AS price, l_returnflag AS category, l_shipdate::TIMESTAMP - INTERVAL 2 HOUR AS collected_at FROM lineitem
WHERE l_orderkey % 13 <> 0 AND l_orderkey % 101 <> 0 AND l_orderkey % 17 <> 0 AND NOT (l_orderkey % 19 = 0 AND l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0) AND l_orderkey % 23 <> 0 AND l_orderkey % 29 <> 0),
v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY collected_at, source) AS k FROM n) WHERE k = 1)
"""


@query("snk02_lake_write_and_scan", _VALID + "SELECT category AS source_part, strftime(collected_at, '%Y') AS year, count(*) AS n FROM v WHERE category <> 'R' AND collected_at >= TIMESTAMP '1998-01-01' AND collected_at < TIMESTAMP '2000-01-01' GROUP BY ALL", prefix=False)
def snk02(r: Relations) -> DataFrame:
    """Records under a source per category, by year (the flat tables have few records a day); a replay of a third changes nothing."""
    path = _room(r, "lake")
    rows = _valid(r).withColumns({"source": F.col("category"), "collected_at": F.date_trunc("year", "collected_at")})
    half = F.pmod(F.xxhash64("event_id"), F.lit(3))
    lake.write(rows.filter(half != 0), path)
    lake.write(rows.filter(half != 1), path)
    n = F.count(F.lit(1)).alias("n")
    found = [lake.scan(r.spark, path, lake.Partitions(source, date(1998, 1, 1), date(1999, 12, 31)), ["source_part", "year"]) for source in ("A", "N")]
    return found[0].unionByName(found[1]).groupBy("source_part", "year").agg(n)


@query("d03_warehouse_load_twice", _VALID + """SELECT 'sources' AS relation, count(DISTINCT source) AS n FROM v UNION ALL SELECT 'products', count(DISTINCT (l_partkey, category)) FROM v
UNION ALL SELECT 'source_products', count(DISTINCT (source, l_partkey)) FROM v UNION ALL SELECT 'observations', count(*) FROM v""", prefix=False)
def d03(r: Relations) -> DataFrame:
    w = Warehouse(r.spark, _room(r, "warehouse"))
    rows = _valid(r)
    w.load(rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0))
    w.load(rows)
    again = w.load(rows)
    assert not any(again.values()), again
    counts = [w.table(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("relation"), "n") for t in ("sources", "products", "source_products", "observations")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query("src16_generated_events", "SELECT 10000 AS n, 10000 AS ids, 10000 AS valid", prefix=False)
def src16(r: Relations) -> DataFrame:
    messages = landed.as_messages(landed.generate_events(r.spark, 10_000))
    events, _ = records.parse(messages)
    rows = records.with_violations(records.normalize(records.flatten(events)))
    return rows.agg(F.count(F.lit(1)).cast("int").alias("n"), F.countDistinct("event_id").cast("int").alias("ids"), F.count_if(F.col(records.ERRORS) == "").cast("int").alias("valid"))


@query("v07_contract_parse", """SELECT kind, count(*) AS n FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'unknown_event_type' WHEN 2 THEN 'missing_payload' ELSE 'ok' END AS kind FROM events) GROUP BY 1""", prefix=False)
def v07(r: Relations) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ['{"event_id": "a", ', '{"event_type": "other", "payload": {}}', '{"event_type": "product.observation"}', '{"event_type": "product.observation", "payload": {"external_id": "x"}}'])), (F.col("event_id") % 4 + 1).cast("int"))
    ok, dead = records.parse(r.table("events").select(said.alias("value")))
    return ok.select(F.lit("ok").alias("kind")).unionByName(dead.select(F.col("error").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("src13_page_cards", """SELECT page_id, 'book-' || page_id AS product_id, (page_id % 97)::DECIMAL(12,2) AS price, CASE WHEN page_id % 2 = 0 THEN 'in_stock' ELSE 'out_of_stock' END AS availability, concat('http://shop/c/book-', page_id, '/index.html') AS url FROM pages""", prefix=False)
def src13(r: Relations) -> DataFrame:
    k = F.col("page_id").cast("string")
    card = F.concat(
        F.lit('<ul class="breadcrumb"><li>Home</li><li>X</li></ul><article class="product_pod"><h3><a href="book-'), k, F.lit('/index.html" title="T">T</a></h3><p class="price_color">&pound;'), (F.col("page_id") % 97).cast("string"),
        F.lit('.00</p><p class="availability">'), F.when(F.col("page_id") % 2 == 0, "In stock").otherwise("Unavailable"), F.lit('</p></article><article class="product_pod"><p>no link</p></article>'), F.col("html"))
    pages = r.table("pages").select("page_id", F.concat(F.lit("http://shop/c/list-"), k).alias("url"), card.alias("html"))
    found = html.products_of(html.parse_pages(pages, html.BOOKS), html.BOOKS)
    return found.join(pages.select("page_id", F.col("url").alias("page_url")), "page_url").select("page_id", "product_id", "price", "availability", "url")


@query("f16_intents", """SELECT event_id % 5 AS k, CASE event_id % 5 WHEN 0 THEN 'price_analytics' WHEN 1 THEN 'pipeline_status' WHEN 2 THEN 'data_quality' WHEN 3 THEN 'source_health' ELSE 'general' END AS intent, count(*) AS n FROM events GROUP BY 1, 2""", prefix=False)
def f16(r: Relations) -> DataFrame:
    q = F.element_at(F.array(*map(F.lit, ["What is the average PRICE trend?", "pipeline health and consumer lag", "which quality check failed", "source freshness", "hello priceless"])), (F.col("event_id") % 5 + 1).cast("int"))
    return r.table("events").select((F.col("event_id") % 5).alias("k"), assistant.classify(q)["intent"].alias("intent")).groupBy("k", "intent").agg(F.count(F.lit(1)).alias("n"))


#: Keys of the driver's tables; a table of the data directory that is not named here has none.
TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
    "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


@query("src17_catalog")
def src17(r: Relations) -> DataFrame:
    """All tables of the data directory; other views of the session are not among them."""
    names = [n.removesuffix(".parquet") for n in lake.names(r.spark, r.dir) if n.endswith(".parquet")]
    for name in names:
        r.table(name).createOrReplaceTempView(name)
    return landed.catalog(r.spark, TABLE_KEYS, only=names)
