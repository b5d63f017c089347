"""Source records to canonical records, identities, and classification of fetch responses: pure column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions.text import blank_to_null, event_id, strip
from priceloom.schemas import AVAILABILITY, EVENT_TYPE, PRICE


def canonical(rows: DataFrame, source: str) -> DataFrame:
    """The 13 contract columns and the two optional ones from mapped columns (external_id, name, url, price, currency, availability, category,
    collected_at and, optionally, listing_id, seller_id)."""
    has = set(rows.columns)
    opt = lambda n: F.col(n) if n in has else F.lit(None).cast("string")
    stock = F.lower(strip(F.col("availability")))
    return rows.select(
        event_id(F.lit(source), F.col("external_id"), F.col("collected_at")).alias("event_id"), F.lit(EVENT_TYPE).alias("event_type"), F.lit(1).cast("long").alias("schema_version"),
        F.lit(source).alias("source"), F.col("collected_at").alias("produced_at"), "external_id", F.col("name"), F.col("url"), F.col("price").try_cast(PRICE).alias("price"),
        F.upper(F.col("currency")).alias("currency"), F.when(stock.isin(*AVAILABILITY), stock).otherwise("unknown").alias("availability"), F.col("category"), "collected_at",
        opt("listing_id").alias("listing_id"), opt("seller_id").alias("seller_id"),
    )


def store_api(items: DataFrame, base_url: str, source: str = "fake-store") -> DataFrame:
    """Items (id, title, price, category, collected_at) of the simple store API: always in stock, in US dollars."""
    return canonical(items.select(
        F.col("id").cast("string").alias("external_id"), F.col("title").alias("name"), F.concat(F.lit(base_url.rstrip("/") + "/products/"), F.col("id").cast("string")).alias("url"),
        "price", F.lit("USD").alias("currency"), F.lit("in_stock").alias("availability"), "category", "collected_at"), source)


def any_of(*flags: Column) -> Column:
    """in_stock if a flag is true, out_of_stock if all are false, else unknown."""
    yes = reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags])
    no = reduce(lambda a, b: a & b, [F.coalesce(~f, F.lit(False)) for f in flags])
    return F.when(yes, "in_stock").when(no, "out_of_stock").otherwise("unknown")


def retailer_api(items: DataFrame, source: str = "best-buy") -> DataFrame:
    """Items (sku, name, salePrice, regularPrice, categoryPath, url, inStoreAvailability, onlineAvailability, collected_at): sale before regular price, last named category."""
    named = F.filter("categoryPath", lambda c: c["name"].isNotNull() & (c["name"] != ""))
    return canonical(items.select(
        F.col("sku").cast("string").alias("external_id"), "name", "url", F.coalesce("salePrice", "regularPrice").alias("price"), F.lit("USD").alias("currency"),
        any_of(F.col("inStoreAvailability"), F.col("onlineAvailability")).alias("availability"), F.coalesce(F.try_element_at(named, F.lit(-1))["name"], F.lit("unknown")).alias("category"), "collected_at"), source)


def qualified(source: str | Column, raw: Column) -> Column:
    """``source:raw``; null for an empty part."""
    s = F.lit(source) if isinstance(source, str) else source
    return F.when((strip(s) != "") & (strip(raw) != ""), F.concat(s, F.lit(":"), raw))


def unqualified(c: Column) -> tuple[Column, Column]:
    """(source, raw): split at the first colon only."""
    parts = F.split(c, ":", 2)
    return parts[0], F.try_element_at(parts, F.lit(2))


#: Item condition texts and what they mean.
CONDITIONS = {
    "new": "new", "brand new": "new", "like new": "like_new", "excellent": "like_new", "very good": "good",
    "good": "good", "acceptable": "acceptable", "for parts or not working": "for_parts", "used": "used",
}


def condition(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CONDITIONS.items() for x in pair])
    return F.try_element_at(table, F.lower(strip(c)))


def market_price(value: Column, currency: Column) -> tuple[Column, Column]:
    """No negative and no unparsable price; currency in capitals, US dollars if missing."""
    p = value.try_cast(PRICE)
    return F.when(p >= 0, p), F.upper(F.coalesce(blank_to_null(currency), F.lit("USD")))


def market_stock(shipping: Column, pickup: Column) -> Column:
    """From availability lists: unknown without lists, in stock if one has entries."""
    return F.when(shipping.isNull() & pickup.isNull(), "unknown").when((F.coalesce(F.size(shipping), F.lit(0)) > 0) | (F.coalesce(F.size(pickup), F.lit(0)) > 0), "in_stock").otherwise("out_of_stock")


def listing_url(url: Column, item_id: Column, base: str) -> Column:
    return F.coalesce(blank_to_null(url), F.concat(F.lit(base.rstrip("/") + "/itm/"), item_id))


def marketplace(items: DataFrame, source: str = "ebay", base: str = "https://www.ebay.com") -> DataFrame:
    """Items (itemId, title, price{value, currency}, itemWebUrl, seller{username}, shipTo, pickup, categoryIds, collected_at) with qualified listing and seller ids."""
    price, currency = market_price(F.col("price.value"), F.col("price.currency"))
    last = F.try_element_at("categoryIds", F.lit(-1))
    return canonical(items.select(
        F.col("itemId").alias("external_id"), F.col("title").alias("name"), listing_url(F.col("itemWebUrl"), F.col("itemId"), base).alias("url"), price.alias("price"), currency.alias("currency"),
        market_stock(F.col("shipTo"), F.col("pickup")).alias("availability"), F.coalesce(F.concat(F.lit(f"{source}_category_"), last), F.lit("unknown")).alias("category"), "collected_at",
        qualified(source, F.col("itemId")).alias("listing_id"), qualified(source, F.col("seller.username")).alias("seller_id")), source)


def seller(s: Column, source: str) -> Column:
    """struct(seller_id, username, metadata) of a seller (username, feedbackScore, feedbackPercentage); null without a name.  Feedback is metadata only."""
    name = blank_to_null(s["username"])
    meta = _known({"feedback_score": s["feedbackScore"].cast("string"), "feedback_percentage": s["feedbackPercentage"].cast("string")})
    return F.when(name.isNotNull(), F.struct(qualified(source, name).alias("seller_id"), name.alias("username"), meta.alias("metadata")))


def _known(values: dict[str, Column]) -> Column:
    """A map of the values that are not null."""
    return F.map_filter(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())


def market_listing(items: DataFrame, source: str = "ebay", base: str = "https://www.ebay.com") -> DataFrame:
    """A listing with its seller, product key (of an explicit identifier, if any) and a metadata map without nulls.

    Metadata: condition, availability_raw (whether in stock, where availability is told), category_id, price and currency; for a price that is refused
    (negative) price_original instead.
    """
    has = set(items.columns)
    price, currency = market_price(F.col("price.value"), F.col("price.currency"))
    stock = market_stock(F.col("shipTo"), F.col("pickup"))
    told = F.col("price.value").isNotNull()
    meta = _known({
        "condition": condition(F.col("condition")), "availability_raw": F.when(stock != "unknown", (stock == "in_stock").cast("string")), "category_id": F.try_element_at("categoryIds", F.lit(-1)),
        "price": price.cast("string"), "price_original": F.when(price.isNull() & told, F.col("price.value").try_cast("double").cast("string")), "currency": F.when(told, currency),
    })
    return items.select(
        qualified(source, F.col("itemId")).alias("listing_id"), strip(F.col("title")).alias("title"), price.alias("price"), currency.alias("currency"), condition(F.col("condition")).alias("condition"),
        listing_url(F.col("itemWebUrl"), F.col("itemId"), base).alias("url"), seller(F.col("seller"), source).alias("seller"),
        (product_key(source, F.col("identifiers")) if "identifiers" in has else F.lit(None).cast("string")).alias("product_key"), meta.alias("metadata"))


#: Identifier kinds in order of preference and the form of each.
IDENTIFIERS = {
    "gtin": r"^\d{8,14}$", "upc": r"^\d{12}$", "ean": r"^\d{13}$", "isbn": r"^(?:97[89])?\d{9}[\dX]$", "asin": r"^[A-Z0-9]{10}$", "mpn": r"^[A-Za-z0-9\-_.]{4,30}$",
}


def identifier(metadata: Column) -> Column:
    """struct(kind, value) of the first identifier of valid form in a map, or null."""
    found = []
    for kind, form in IDENTIFIERS.items():
        v = strip(F.try_element_at(metadata, F.lit(kind)))
        found.append(F.when(v.rlike(form), F.struct(F.lit(kind).alias("kind"), v.alias("value"))))
    return F.coalesce(*found)


def product_key(source: str | Column, metadata: Column) -> Column:
    """``source:value`` of an explicit identifier; null otherwise, as titles are never matched."""
    return qualified(source, identifier(metadata)["value"])


#: Phrases, in lower case, of pages that are answered with 200 but block a client or say that the service is down.
BLOCKED = ("captcha", "robot check", "are you a human", "bot detection", "access denied", "verify you are human")
UNAVAILABLE = ("service unavailable", "under maintenance", "temporarily unavailable", "we'll be back", "sorry for the inconvenience")


def response_class(status: Column, body: Column) -> Column:
    """What an HTTP answer means for a page source: the status decides, and for 200 the phrases in the page."""
    text = F.lower(F.coalesce(body, F.lit("")))
    says = lambda phrases: reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in phrases])
    return (
        F.when(status == 429, "rate_limited").when(status == 503, "unavailable").when(status == 403, "blocked")
        .when((status == 200) & says(BLOCKED), "blocked").when((status == 200) & says(UNAVAILABLE), "unavailable")
        .when(status >= 400, "error").otherwise("ok")
    )


def assign_listings(assigned: DataFrame, changes: DataFrame, order: str = "seq") -> DataFrame:
    """The table (listing_id, product_key) after ``changes`` (listing_id, product_key, ``order``): the last change of a listing wins over earlier ones and
    over the table.  A change without a listing or key is refused, so it changes nothing.  Listings of a product are the rows with its key."""
    good = changes.filter((F.coalesce("listing_id", F.lit("")) != "") & (F.coalesce("product_key", F.lit("")) != ""))
    last = good.groupBy("listing_id").agg(F.max_by("product_key", F.struct(order, "product_key")).alias("new_key"))
    both = assigned.join(last, "listing_id", "full_outer")
    return both.select("listing_id", F.coalesce("new_key", "product_key").alias("product_key"))
