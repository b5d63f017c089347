"""The record pipeline: flatten, normalize, validate with all violations, find replays and conflicts, route.

Every step is a function of frames, shared by batch and stream; only finding replays and conflicts shuffles, by event id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.functions.text import strip, to_price, to_utc
from priceloom.schemas import AVAILABILITY, CURRENCY, EVENT, EVENT_TYPE, RECORD, REQUIRED, SCHEMA_VERSIONS
from priceloom.sources.rooms import materialize

ERRORS = "_validation_errors"


#: Fields of an event that must have a character, and those that may be missing but not empty.
_FILLED = ("event_id", "source", "payload.external_id", "payload.name", "payload.url", "payload.category")
_OPTIONAL = ("payload.listing_id", "payload.seller_id")


def _broken(e: Column) -> list[Column]:
    """Where an event breaks the contract, as names of fields in order, null for each that keeps it: empty or missing texts, times that are none or have no offset, a price that is no
    number or negative, a currency, availability or version outside the fixed values.  A missing event type and version have their defaults."""
    at = lambda path: reduce(lambda c, part: c[part], path.split("."), e)
    timed = lambda path: F.coalesce(at(path).rlike(r"(Z|[+-]\d{2}:?\d{2})$") & to_utc(at(path)).isNotNull(), F.lit(False))
    price = at("payload.price")
    bad = {
        **{f: F.coalesce(strip(at(f)) == "", F.lit(True)) for f in _FILLED}, **{f: F.coalesce(strip(at(f)) == "", F.lit(False)) for f in _OPTIONAL},
        "event_type": F.coalesce(at("event_type"), F.lit(EVENT_TYPE)) != EVENT_TYPE,
        "schema_version": ~F.coalesce(F.coalesce(at("schema_version"), F.lit("1")).try_cast("long").isin(*SCHEMA_VERSIONS), F.lit(False)),
        "produced_at": ~timed("produced_at"), "payload.collected_at": ~timed("payload.collected_at"),
        "payload.price": F.coalesce(price.isNotNull() & ~(F.coalesce(price.try_cast("decimal(38,10)"), F.lit(-1)) >= 0), F.lit(False)),
        "payload.currency": ~F.coalesce(F.length(strip(at("payload.currency"))) == 3, F.lit(False)), "payload.availability": ~F.coalesce(at("payload.availability").isin(*AVAILABILITY), F.lit(False)),
    }
    return [F.when(v, k) for k, v in bad.items()]


def contract_errors(e: Column) -> Column:
    """The fields in which an event breaks the contract, as an array."""
    return F.array_compact(F.array(*_broken(e)))


def _judged(raw: DataFrame, value: str, strict: bool) -> DataFrame:
    """Rows with their ``__event`` and an ``error``, null where there is none.

    A row is parsed and checked once: ``inline`` over one struct is a step that the optimizer moves no filter below, as it would otherwise write the parser
    into the filter wherever a field is read, dozens of times a row.
    """
    text = F.col(value).cast("string")
    rows = raw.withColumn("__event", F.from_json(text, EVENT, {"mode": "PERMISSIVE"}))
    e = F.col("__event")
    why = F.when(e.isNull() | F.try_parse_json(text).isNull(), "malformed_json").when(e["event_type"].isNull() | (e["event_type"] != EVENT_TYPE), "unknown_event_type").when(e["payload"].isNull(), "missing_payload")
    if strict:
        why = why.otherwise(F.concat_ws(", ", F.lit("contract:"), *_broken(e)))
    rows = rows.select("*", F.inline(F.array(F.struct(why.alias("error")))))
    return rows.withColumn("error", F.when(F.col("error") != "contract:", F.regexp_replace("error", "^contract:, ", "contract: "))) if strict else rows


def parse(raw: DataFrame, value: str = "value", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON text to (events, dead letters).  A dead letter keeps its raw text and why it failed; with ``strict``, what breaks the contract is one too, and names
    its fields, otherwise such events go on and validation lists their violations."""
    rows = _judged(raw, value, strict)
    return rows.filter("error IS NULL").drop("error").select("*", "__event.*").drop("__event"), rows.filter("error IS NOT NULL").drop("__event")


def verify(raw: DataFrame, value: str = "value") -> DataFrame:
    """``raw`` as it is; what would be a dead letter of a strict :func:`parse` fails the job that reads it."""
    rows = _judged(raw, value, True)
    return rows.withColumn(value, F.when(F.col("error").isNull(), F.col(value)).otherwise(F.raise_error(F.col("error")))).select(*raw.columns)


def dead_letter(rows: DataFrame, topic: Column, value: str = "value") -> DataFrame:
    """Envelope with an id that depends on where the message stood, so a replay makes the same letter."""
    at = [F.coalesce(c.cast("string"), F.lit("_")) for c in (topic, F.col("partition"), F.col("offset"))]
    return rows.select(F.sha2(F.concat_ws("|", *at), 256).alias("letter_id"), topic.alias("topic"), "partition", "offset", F.base64(F.col(value).cast("binary")).alias("raw"), "error")


def flatten(events: DataFrame, *also: str) -> DataFrame:
    """Envelope and payload as flat columns, in contract order, then the columns ``also``."""
    top = {f.name for f in EVENT.fields}
    cols = [F.col(f.name) if f.name in top else F.col(f"payload.{f.name}").alias(f.name) for f in RECORD.fields]
    return events.select(*cols, *also)


def normalize(flat: DataFrame, *also: str) -> DataFrame:
    """Declared types (the columns ``also`` as they are); white space goes from names, not from ids or urls; what does not parse becomes null."""
    as_text = lambda n: F.col(n).cast("string")
    made = {
        "schema_version": as_text("schema_version").try_cast("long"), "price": to_price(as_text("price")), "produced_at": to_utc(as_text("produced_at")),
        "collected_at": to_utc(as_text("collected_at")), "availability": F.lower(strip(as_text("availability"))),
    } | {n: strip(as_text(n)) for n in ("name", "category", "currency", "source", "event_type")}
    return flat.select(*[made.get(f.name, as_text(f.name)).alias(f.name) if f.name in flat.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD.fields], *also)


def violations() -> list[Column]:
    """In the order in which they are listed."""
    allowed = lambda xs: "{" + ",".join(map(str, sorted(xs))) + "}"
    return [
        *[F.when(F.col(n).isNull(), f"null_required:{n}") for n in REQUIRED],
        F.when(F.col("price") < 0, "negative_price"),
        F.when(~F.col("availability").isin(*AVAILABILITY), "invalid_availability:allowed=" + allowed(AVAILABILITY)),
        F.when(~F.col("schema_version").isin(*SCHEMA_VERSIONS), "unsupported_schema_version:allowed=" + allowed(SCHEMA_VERSIONS)),
        F.when(~F.col("currency").rlike(CURRENCY), "invalid_currency_format"),
    ]


def with_violations(rows: DataFrame) -> DataFrame:
    """All violations of a row joined by ``; ``, empty for a valid row."""
    return rows.withColumn(ERRORS, F.concat_ws("; ", *violations()))


def validate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = with_violations(rows)
    return rows.filter(F.col(ERRORS) == "").drop(ERRORS), rows.filter(F.col(ERRORS) != "")


def _hashes(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of the columns, each with whether it is null, so that null differs from every value and columns don't run together."""
    marked = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(seed), *marked) for seed in ("a", "b")]


def _text_of(one: Column, other: Column) -> Column:
    return F.concat(F.lpad(F.hex(one), 16, "0"), F.lpad(F.hex(other), 16, "0"))


def payload_hash(columns: list[str]) -> Column:
    """128 bits as hex, in which null differs from every value and columns don't run together."""
    return _text_of(*_hashes(columns))


#: Groups into which the rows of one id are split before its first row is chosen.
SPLIT = 64


def status(rows: DataFrame, key: str = "event_id", order: str | list[str] = "ingest_seq", payload: list[str] | None = None, seen: DataFrame | None = None, among: Column | None = None) -> DataFrame:
    """Add ``hash`` and ``status``: conflict (an id with differing payloads, ``seen`` included) before duplicate (a replay) before unique, exactly one each.

    ``seen`` (key, hash) holds the ids of earlier batches, a row for each payload an id has had; an id with two of them stays a conflict.  Rows on which
    ``among`` does not hold take no part and get a null status.

    Rows are counted per id by numbers only, partly before the shuffle; only ids with several rows are joined back (a broadcast where they are few).  Of
    an id's rows the first is chosen in two steps, among the rows of each of ``SPLIT`` groups and then among the groups' firsts, so an id with very many
    rows, equal or not, is not one task.
    """
    order = [order] if isinstance(order, str) else order
    payload = payload or [c for c in rows.columns if c not in order]
    one, other = _hashes(payload)
    rows = rows.withColumns({"__h1": one, "__h2": other, "__in": F.lit(True) if among is None else among})
    ids = rows.filter("__in").groupBy(F.col(key).alias("__id")).agg(F.count(F.lit(1)).alias("__rows"), *[f(h).alias(f"{n}{h}") for h in ("__h1", "__h2") for f, n in ((F.min, "lo"), (F.max, "hi"))]).filter("__rows > 1")
    ids = ids.select("__id", ((F.col("lo__h1") != F.col("hi__h1")) | (F.col("lo__h2") != F.col("hi__h2"))).alias("__differ"))
    rows = rows.join(ids, F.col(key).eqNullSafe(F.col("__id")) & F.col("__in"), "left").drop("__id")
    alone = rows.filter("__differ IS NULL").withColumn("__again", F.lit(False))
    by = [*order, "__h1", "__h2"]
    many = rows.filter("__differ IS NOT NULL").withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(SPLIT)))
    many = many.withColumn("__n", F.row_number().over(Window.partitionBy(key, "__group").orderBy(*by)))
    firsts = Window.partitionBy(key, F.when(F.col("__n") == 1, -1).otherwise(F.col("__group"))).orderBy(*by, "__group")
    many = many.withColumn("__again", (F.col("__n") > 1) | (F.row_number().over(firsts) > 1)).drop("__group", "__n")
    rows = alone.unionByName(many).withColumn("hash", _text_of(F.col("__h1"), F.col("__h2"))).drop("__h1", "__h2")
    if seen is None:
        old = F.lit(None).cast("string")
        differs = F.lit(False)
    else:
        versions = seen.groupBy(F.col(key).alias("__key")).agg(F.min("hash").alias("__lo"), F.max("hash").alias("__hi"))
        rows = rows.join(versions, F.col(key) == F.col("__key"), "left").drop("__key")
        old, differs = F.col("__lo"), F.coalesce((F.col("__lo") != F.col("hash")) | (F.col("__hi") != F.col("hash")), F.lit(False))
    named = F.when(F.coalesce("__differ", F.lit(False)) | differs, "conflict").when(F.col("__again") | old.isNotNull(), "duplicate").otherwise("unique")
    return rows.withColumn("status", F.when(F.col("__in"), named)).drop("__differ", "__again", "__lo", "__hi", "__in")


def route(rows: DataFrame, store: bool = False, **how) -> DataFrame:
    """Normalized rows with ``route``: invalid, conflict, duplicate or valid; each row has one.  Invalid rows are no replays and no conflicts.

    Rows are read three times: to count ids, and for ids with one row and with several.  With ``store`` they are normalized and checked once, and written
    down in the shared folder until the application ends.
    """
    checked = materialize(with_violations(rows), "routed") if store else with_violations(rows)
    order = how.get("order", "ingest_seq")
    how.setdefault("payload", [c for c in rows.columns if c != order and c not in order])
    good = status(checked, among=F.col(ERRORS) == "", **how)
    named = F.when(F.col("status").isNull(), "invalid").when(F.col("status") == "unique", "valid").otherwise(F.col("status"))
    return good.withColumn("route", named).drop("status").withColumn("hash", F.when(F.col("route") != "invalid", F.col("hash"))).withColumn(ERRORS, F.when(F.col(ERRORS) != "", F.col(ERRORS)))
