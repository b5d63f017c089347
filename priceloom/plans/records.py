"""Queries of the record pipeline (P, V, D, U ids) over observations written as events, and of the source mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.functions import mapping, text
from priceloom.operators import records
from priceloom.plans.registry import query
from priceloom.views import Relations


def raw_records(r: Relations) -> DataFrame:
    """Flat records with planted faults: some line items lack a part of the contract."""
    n = F.col("l_orderkey")
    return r.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"), F.lit("product.observation ").alias("event_type"), F.when(n % 13 == 0, "2").when(n % 101 == 0, "x").otherwise("1").alias("schema_version"),
        F.concat(F.lit(" src"), F.col("l_suppkey").cast("string")).alias("source"), F.lit("2024-01-01T00:00:00Z").alias("produced_at"), F.col("l_partkey").cast("string").alias("external_id"),
        F.when(n % 17 != 0, F.concat(F.lit("\t item "), F.col("l_partkey").cast("string"))).alias("name"), F.lit("http://x/").alias("url"),
        F.when(n % 7 == 0, F.lit(None)).when(n % 11 == 0, "abc").when(n % 19 == 0, "-1.00").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.when(n % 23 == 0, "eur").otherwise("EUR").alias("currency"), F.when(n % 29 == 0, "sold").otherwise(" In_Stock ").alias("availability"), F.col("l_returnflag").alias("category"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("collected_at"), F.lit(None).cast("string").alias("listing_id"), F.lit(None).cast("string").alias("seller_id"),
        (F.col("l_suppkey") * 1000 + F.dayofyear("l_shipdate")).alias("ingest_seq"),
    )


RAW = """WITH n AS (SELECT concat(l_orderkey, '-', l_linenumber) AS event_id, 'product.observation' AS event_type, CASE WHEN l_orderkey % 13 = 0 THEN 2 WHEN l_orderkey % 101 = 0 THEN NULL ELSE 1 END::BIGINT AS schema_version,
concat('src', l_suppkey) AS source, l_partkey::VARCHAR AS external_id, CASE WHEN l_orderkey % 17 <> 0 THEN concat('item ', l_partkey) END AS name,
CASE WHEN l_orderkey % 7 = 0 OR l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 19 = 0 THEN -1.00 ELSE l_extendedprice END::DECIMAL(12,2) AS price,
CASE WHEN l_orderkey % 23 = 0 THEN 'eur' ELSE 'EUR' END AS currency, CASE WHEN l_orderkey % 29 = 0 THEN 'sold' ELSE 'in_stock' END AS availability, l_returnflag AS category,
l_shipdate::TIMESTAMP - INTERVAL 2 HOUR AS collected_at, l_suppkey * 1000 + dayofyear(l_shipdate) AS ingest_seq FROM lineitem)
"""
ERRORS_SQL = """concat_ws('; ', CASE WHEN schema_version IS NULL THEN 'null_required:schema_version' END, CASE WHEN name IS NULL THEN 'null_required:name' END, CASE WHEN price < 0 THEN 'negative_price' END,
CASE WHEN availability NOT IN ('in_stock') THEN 'invalid_availability:allowed={in_stock,out_of_stock,preorder,unknown}' END, CASE WHEN schema_version <> 1 THEN 'unsupported_schema_version:allowed={1}' END, CASE WHEN currency = 'eur' THEN 'invalid_currency_format' END)"""


def _normal(r: Relations) -> DataFrame:
    """Normalized records; collection times as UTC wall time, which reads the same in any engine."""
    return records.normalize(raw_records(r))


@query("p01_normalize", RAW + "SELECT event_id, event_type, schema_version, source, external_id, name, price, currency, availability, category, collected_at FROM n", prefix=False)
def p01(r: Relations) -> DataFrame:
    return _normal(r).select("event_id", "event_type", "schema_version", "source", "external_id", "name", "price", "currency", "availability", "category", F.col("collected_at").cast("timestamp_ntz").alias("collected_at"))


@query("p09_event_id", "SELECT concat('s:', l_partkey, ':', strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'), '+00:00') AS event_id, count(*) AS n FROM lineitem GROUP BY 1", prefix=False)
def p09(r: Relations) -> DataFrame:
    return r.table("lineitem").select(text.event_id(F.lit("s"), F.col("l_partkey").cast("string"), F.col("l_shipdate").cast("timestamp")).alias("event_id")).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


@query("v01_violations", RAW + f"SELECT event_id, {ERRORS_SQL} AS errors FROM n", prefix=False)
def v01(r: Relations) -> DataFrame:
    return records.with_violations(_normal(r)).select("event_id", F.col(records.ERRORS).alias("errors"))


@query("v01_violation_counts", RAW + f"SELECT errors, count(*) AS n FROM (SELECT {ERRORS_SQL} AS errors FROM n) GROUP BY 1", prefix=False)
def v01_counts(r: Relations) -> DataFrame:
    return records.with_violations(_normal(r)).groupBy(F.col(records.ERRORS).alias("errors")).agg(F.count(F.lit(1)).alias("n"))


# An exact replay of a slice of orders joins the batch.
BATCH = """WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, 0 AS wave FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, 1 FROM lineitem WHERE l_orderkey % 50 = 0),
h AS (SELECT *, concat(l_orderkey, '-', l_linenumber) AS event_id, concat(l_partkey, '|', l_suppkey, '|', l_shipdate) AS payload FROM li),
s AS (SELECT *, count(DISTINCT payload) OVER (PARTITION BY event_id) AS kinds, row_number() OVER (PARTITION BY event_id ORDER BY wave, l_partkey, l_suppkey, l_shipdate) AS n FROM h)
"""


def _batch(r: Relations) -> DataFrame:
    li = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    both = li.withColumn("wave", F.lit(0)).unionByName(li.filter("l_orderkey % 50 = 0").withColumn("wave", F.lit(1)))
    return both.withColumn("event_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))


def _status(r: Relations) -> DataFrame:
    return records.status(_batch(r), order=["wave", "l_partkey", "l_suppkey", "l_shipdate"], payload=["l_partkey", "l_suppkey", "l_shipdate"])


_CASE = "CASE WHEN kinds > 1 THEN 'conflict' WHEN n > 1 THEN 'duplicate' ELSE 'unique' END"


@query("d01_dedup_status", BATCH + f"SELECT event_id, wave, l_partkey, l_suppkey, {_CASE} AS status FROM s", prefix=False)
def d01(r: Relations) -> DataFrame:
    return _status(r).select("event_id", "wave", "l_partkey", "l_suppkey", "status")


@query("u03_split_counts", BATCH + f"SELECT status, count(*) AS n FROM (SELECT {_CASE} AS status FROM s) GROUP BY 1", prefix=False)
def u03(r: Relations) -> DataFrame:
    return _status(r).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("d02_status_with_seen", """WITH seen AS (SELECT concat(l_orderkey, '-', l_linenumber) AS event_id, max(l_partkey) AS part FROM lineitem WHERE l_orderkey % 4 = 0 GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT concat(l_orderkey, '-', l_linenumber) AS event_id, l_partkey + CASE WHEN l_orderkey % 8 = 0 THEN 1 ELSE 0 END AS part, l_suppkey FROM lineitem),
w AS (SELECT *, count(DISTINCT part) OVER (PARTITION BY event_id) AS kinds, row_number() OVER (PARTITION BY event_id ORDER BY part, l_suppkey) AS n FROM b)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN kinds > 1 OR seen.part <> w.part THEN 'conflict' WHEN n > 1 OR seen.part IS NOT NULL THEN 'duplicate' ELSE 'unique' END AS status FROM w LEFT JOIN seen USING (event_id)) GROUP BY 1""", prefix=False)
def d02(r: Relations) -> DataFrame:
    li = r.table("lineitem").withColumn("event_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    seen = li.filter("l_orderkey % 4 = 0").groupBy("event_id").agg(F.max("l_partkey").alias("part"), F.count(F.lit(1)).alias("n")).filter("n = 1").select("event_id", records.payload_hash(["part"]).alias("hash"))
    batch = li.select("event_id", (F.col("l_partkey") + F.when(F.col("l_orderkey") % 8 == 0, 1).otherwise(0)).alias("part"), "l_suppkey")
    return records.status(batch, order=["part", "l_suppkey"], payload=["part"], seen=seen).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("d02_conflict_then_replay", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'conflict' WHEN o_orderkey % 3 = 1 THEN 'duplicate' ELSE 'unique' END AS status, 1 + (o_orderkey % 2) AS n FROM orders""", prefix=False)
def d02_again(r: Relations) -> DataFrame:
    """Ids that had two payloads before stay conflicts, whichever of the two comes again; ids with one payload are duplicates; new ids are unique or replays of
    themselves inside the batch (shown as unique, with their number)."""
    o, k = r.table("orders"), F.col("o_orderkey")
    part = lambda p: o.select(k.cast("string").alias("event_id"), k.alias("k"), F.lit(p).alias("part"))
    h = records.payload_hash(["part"]).alias("hash")
    seen = part(1).filter("k % 3 <> 2").select("event_id", h).unionByName(part(2).filter("k % 3 = 0").select("event_id", h))
    batch = part(1).filter("k % 6 <> 0").unionByName(part(2).filter("k % 6 = 0")).unionByName(part(1).filter("k % 2 = 1 AND k % 6 <> 0"))
    got = records.status(batch.withColumn("seq", F.lit(1)), order="seq", payload=["part"], seen=seen)
    return got.groupBy("k").agg(F.max("status").alias("status"), F.count(F.lit(1)).alias("n"))


@query("st03_route", RAW + f"""SELECT route, count(*) AS n FROM (SELECT CASE WHEN errors <> '' THEN 'invalid' WHEN kinds > 1 THEN 'conflict' WHEN k > 1 THEN 'duplicate' ELSE 'valid' END AS route FROM
(SELECT errors, count(DISTINCT payload) OVER (PARTITION BY event_id, errors <> '') AS kinds, row_number() OVER (PARTITION BY event_id, errors <> '' ORDER BY collected_at, source) AS k FROM
(SELECT event_id, source, collected_at, {ERRORS_SQL} AS errors, concat_ws('|', source, external_id, coalesce(price::VARCHAR, '_'), category, collected_at) AS payload FROM n))) GROUP BY 1""", prefix=False)
def st03(r: Relations) -> DataFrame:
    return records.route(_normal(r), store=True, order=["collected_at", "source"], payload=["source", "external_id", "price", "category", "collected_at"]).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


# Source mappings over parts and events.


@query("p11_store_api", """SELECT 'fake-store' AS source, p_partkey::VARCHAR AS external_id, p_name AS name, concat('https://s/products/', p_partkey) AS url, p_retailprice::DECIMAL(12,2) AS price, 'USD' AS currency, 'in_stock' AS availability, p_type AS category FROM part""", prefix=False)
def p11(r: Relations) -> DataFrame:
    items = r.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"), F.col("p_type").alias("category"), F.lit("2024-01-01").cast("timestamp").alias("collected_at"))
    return mapping.store_api(items, "https://s/").select("source", "external_id", "name", "url", "price", "currency", "availability", "category")


@query("p12_retailer_api", """SELECT p_partkey::VARCHAR AS external_id, CASE WHEN p_size % 3 = 0 THEN p_retailprice / 2 ELSE p_retailprice END::DECIMAL(12,2) AS price,
CASE WHEN p_size % 4 = 0 OR p_size % 5 = 0 THEN 'in_stock' WHEN p_size % 4 = 1 AND p_size % 5 <> 4 THEN 'out_of_stock' ELSE 'unknown' END AS availability, CASE WHEN p_size % 7 = 0 THEN 'unknown' ELSE p_brand END AS category FROM part""", prefix=False)
def p12(r: Relations) -> DataFrame:
    n = F.col("p_size")
    pair = lambda i, name: F.struct(F.lit(i).alias("id"), name.alias("name"))
    items = r.table("part").select(
        F.col("p_partkey").alias("sku"), F.col("p_name").alias("name"), F.when(n % 3 == 0, F.col("p_retailprice") / 2).alias("salePrice"), F.col("p_retailprice").alias("regularPrice"),
        F.when(n % 7 == 0, F.array()).otherwise(F.array(pair("1", F.col("p_type")), pair("2", F.col("p_brand")), pair("3", F.lit("")))).alias("categoryPath"), F.lit("u").alias("url"),
        F.when(n % 4 == 0, True).when(n % 4 == 1, False).alias("inStoreAvailability"), F.when(n % 5 == 0, True).when(n % 5 != 4, False).alias("onlineAvailability"), F.lit("2024-01-01").cast("timestamp").alias("collected_at"))
    return mapping.retailer_api(items).select("external_id", "price", "availability", "category")


@query("p13_marketplace", """SELECT concat('ebay:', p_partkey) AS listing_id, CASE WHEN p_size % 6 <> 0 THEN concat('ebay:', p_brand) END AS seller_id, CASE WHEN p_size % 9 <> 0 THEN p_retailprice::DECIMAL(12,2) END AS price, CASE WHEN p_size % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
CASE WHEN p_size % 3 = 0 THEN 'unknown' WHEN p_size % 3 = 1 THEN 'in_stock' ELSE 'out_of_stock' END AS availability, concat('ebay_category_', p_size) AS category, CASE WHEN p_size % 4 = 0 THEN concat('https://www.ebay.com/itm/', p_partkey) ELSE 'http://own' END AS url FROM part""", prefix=False)
def p13(r: Relations) -> DataFrame:
    n = F.col("p_size")
    text_list = lambda *x: F.array(*x).cast("array<string>")
    items = r.table("part").select(
        F.col("p_partkey").cast("string").alias("itemId"), F.col("p_name").alias("title"),
        F.struct(F.when(n % 9 == 0, "-5").otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("value"), F.when(n % 2 == 0, "eur").alias("currency")).alias("price"),
        F.when(n % 4 == 0, "  ").otherwise("http://own").alias("itemWebUrl"), F.struct(F.when(n % 6 == 0, " ").otherwise(F.col("p_brand")).alias("username")).alias("seller"),
        F.when(n % 3 == 1, text_list(F.lit("x"))).when(n % 3 == 2, text_list()).alias("shipTo"), F.when(n % 3 == 2, text_list()).alias("pickup"), text_list(F.lit("1"), n.cast("string")).alias("categoryIds"), F.lit("2024-01-01").cast("timestamp").alias("collected_at"))
    return mapping.marketplace(items).select("listing_id", "seller_id", "price", "currency", "availability", "category", "url")


@query("p20_identifiers", """SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'upc' WHEN p_size % 3 = 1 AND p_size % 2 = 0 THEN 'asin' WHEN p_size % 5 = 0 THEN 'mpn' END AS kind,
CASE WHEN p_size % 3 = 0 THEN concat('m:', lpad(p_partkey::VARCHAR, 12, '0')) WHEN p_size % 3 = 1 AND p_size % 2 = 0 THEN concat('m:', lpad(p_partkey::VARCHAR, 10, 'B')) WHEN p_size % 5 = 0 THEN concat('m:', 'PN-', p_partkey) END AS product_key FROM part""", prefix=False)
def p20(r: Relations) -> DataFrame:
    n, k = F.col("p_size"), F.col("p_partkey").cast("string")
    meta = F.create_map(F.lit("gtin"), F.lit("12"), F.lit("upc"), F.when(n % 3 == 0, F.lpad(k, 12, "0")), F.lit("asin"), F.when((n % 3 == 1) & (n % 2 == 0), F.concat(F.lit(" "), F.lpad(k, 10, "B"))), F.lit("mpn"), F.when(n % 5 == 0, F.concat(F.lit("PN-"), k)))
    rows = r.table("part").select(F.col("p_partkey").alias("id"), meta.alias("m"))
    return rows.select("id", mapping.identifier(F.col("m"))["kind"].alias("kind"), mapping.product_key("m", F.col("m")).alias("product_key"))


@query("p22_price_text", """SELECT p_partkey AS id, CASE p_size % 8 WHEN 0 THEN NULL WHEN 4 THEN p_partkey * 1000 + 0.5 WHEN 5 THEN p_partkey * 1000 + 7 WHEN 6 THEN NULL WHEN 7 THEN 1000000 + p_partkey % 1000 ELSE p_retailprice END::DECIMAL(12,2) AS price,
CASE WHEN p_size % 8 IN (1, 5) THEN 'EUR' WHEN p_size % 8 IN (2, 7) THEN 'USD' ELSE 'GBP' END AS currency FROM part""", prefix=False)
def p22(r: Relations) -> DataFrame:
    """Thousands by comma and by dot, both separators at once (no number), two symbols (the first of the table counts)."""
    n, k, p = F.col("p_size") % 8, F.col("p_partkey"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    shown = (
        F.when(n == 0, "free").when(n == 1, F.concat(F.lit(" €"), p)).when(n == 2, F.concat(F.lit("$"), p)).when(n == 4, F.concat(F.lit("£ "), F.format_number(k * 1000 + 0.5, 2))).when(n == 5, F.concat(F.lit("€"), k.cast("string"), F.lit(".007")))
        .when(n == 6, F.concat(F.lit("£"), k.cast("string"), F.lit(".000,50"))).when(n == 7, F.concat(F.lit("€$1,000,"), F.lpad((k % 1000).cast("string"), 3, "0"))).otherwise(p)
    )
    price, currency = text.price_text(shown, "GBP")
    return r.table("part").select(F.col("p_partkey").alias("id"), price.alias("price"), currency.alias("currency"))


@query("p23_url_ids", "SELECT page_id, CASE WHEN regexp_matches(s, '^[0-9]+') THEN regexp_extract(s, '^([0-9]+)', 1) ELSE s END AS product_id FROM (SELECT page_id, nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1), '') AS s FROM pages)", prefix=False)
def p23(r: Relations) -> DataFrame:
    return r.table("pages").select("page_id", text.leading_digits(text.slug_of_url(F.col("url"))).alias("product_id"))


_SAID = {
    "Currently Unavailable": "out_of_stock", "IN STOCK (3 left)": "in_stock", "Out of stock": "out_of_stock", "Pre-order now": "preorder", "available": "in_stock", "call us": "unknown", "Coming Soon": "preorder", "preorder": "preorder",
    "sold out": "out_of_stock", "Not available": "out_of_stock", "": "unknown",
}


def _nth(values, k):
    """The value of row k of a fixed list, repeating."""
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def _listed(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


@query("p25_availability_text", f"SELECT event_id, ({_listed(_SAID.values())})[event_id % {len(_SAID)} + 1] AS availability FROM events", prefix=False)
def p25(r: Relations) -> DataFrame:
    return r.table("events").select("event_id", text.availability_of(_nth(_SAID, F.col("event_id"))).alias("availability"))


_ANSWERS = [
    (429, "", "rate_limited"), (503, "", "unavailable"), (403, "", "blocked"), (404, "", "error"), (500, "captcha", "error"), (200, "fine", "ok"), (200, "low maintenance garden", "ok"), (301, "captcha", "ok"), (200, None, "ok"),
    *[(200, f"<p>{w.upper()}</p>", "blocked") for w in ("captcha", "robot check", "are you a human", "bot detection", "access denied", "verify you are human")],
    *[(200, f"<p>{w.capitalize()}</p>", "unavailable") for w in ("service unavailable", "under maintenance", "temporarily unavailable", "we'll be back", "sorry for the inconvenience")],
]


@query("v15_response_class", f"SELECT event_id, ({_listed(a[2] for a in _ANSWERS)})[event_id % {len(_ANSWERS)} + 1] AS kind FROM events", prefix=False)
def v15(r: Relations) -> DataFrame:
    k = F.col("event_id")
    return r.table("events").select("event_id", mapping.response_class(_nth([a[0] for a in _ANSWERS], k), _nth([a[1] for a in _ANSWERS], k)).alias("kind"))


@query("snk04_partition_key", """SELECT regexp_replace(regexp_replace(concat('s ', l_returnflag, '/..', l_suppkey % 5), '[^a-zA-Z0-9\\-_.]', '_', 'g'), '\\.{2,}', '.', 'g') AS segment, strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month, count(*) AS n FROM lineitem GROUP BY ALL""", prefix=False)
def snk04(r: Relations) -> DataFrame:
    seg = text.path_segment(F.concat(F.lit("s "), F.col("l_returnflag"), F.lit("/.."), (F.col("l_suppkey") % 5).cast("string")))
    return r.table("lineitem").groupBy(seg.alias("segment"), F.date_format("l_shipdate", "yyyy").alias("year"), F.date_format("l_shipdate", "MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
