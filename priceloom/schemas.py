"""Declared schemas, fixed values of the observation contract, and the compatibility check between schema versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the contract.
EVENT_TYPE = "product.observation"
SCHEMA_VERSIONS = (1,)
AVAILABILITY = ("in_stock", "out_of_stock", "preorder", "unknown")
CURRENCY = "^[A-Z]{3}$"
PRICE = T.DecimalType(12, 2)

PAYLOAD = T.StructType([
    T.StructField("external_id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("price", T.StringType()), T.StructField("currency", T.StringType()), T.StructField("availability", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("listing_id", T.StringType()), T.StructField("seller_id", T.StringType()),
    T.StructField("collected_at", T.StringType()),
])

#: A raw event as it arrives; timestamps and price stay text until they are normalized, so that nothing is lost to a failed parse.
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_type", T.StringType()), T.StructField("schema_version", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("produced_at", T.StringType()), T.StructField("payload", PAYLOAD),
])

#: A normalized record: 13 columns in fixed order, then two optional ones (a compatible addition).
RECORD = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_type", T.StringType()), T.StructField("schema_version", T.LongType()),
    T.StructField("source", T.StringType()), T.StructField("produced_at", T.TimestampType()), T.StructField("external_id", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("url", T.StringType()), T.StructField("price", PRICE),
    T.StructField("currency", T.StringType()), T.StructField("availability", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("collected_at", T.TimestampType()), T.StructField("listing_id", T.StringType()), T.StructField("seller_id", T.StringType()),
])
#: The same record as it must be stored: the contract's required fields are not null.
STORED = T.StructType([T.StructField(f.name, f.dataType, i >= 13 or f.name == "price") for i, f in enumerate(RECORD.fields)])
REQUIRED = tuple(f.name for f in RECORD.fields[:13] if f.name != "price")

_WIDENS = {("int", "bigint"), ("float", "double")}


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple[str, str, bool]]:
    """(field, change, breaking) of every difference: removed, added, retyped, required, optional, reordered."""
    was, now = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    out: list[tuple[str, str, bool]] = [(n, "removed", True) for n in was if n not in now]
    out += [(n, "added", not f.nullable) for n, f in now.items() if n not in was]
    for n in (n for n in was if n in now):
        a, b = was[n].dataType.simpleString(), now[n].dataType.simpleString()
        if a != b:
            out.append((n, f"retyped {a} to {b}", (a, b) not in _WIDENS))
        if was[n].nullable != now[n].nullable:
            out.append((n, "required" if was[n].nullable else "optional", was[n].nullable))
    kept = [n for n in was if n in now]
    if kept != [n for n in now if n in was]:
        out.append(("*", "reordered", True))
    return out


def compatibility(old: T.StructType, new: T.StructType) -> str:
    changes = schema_changes(old, new)
    if not changes:
        return "IDENTICAL"
    return "INCOMPATIBLE" if any(b for *_, b in changes) else "COMPATIBLE"


#: Types whose values can stand for a declared type: text for times, whole numbers for fractions.
_STANDS_FOR = {"timestamp": {"timestamp_ntz", "string"}, "timestamp_ntz": {"timestamp", "string"}, "bigint": {"int", "smallint", "tinyint"}, "int": {"smallint", "tinyint"}, "double": {"float", "bigint", "int"}, "float": {"int"}}


def row_errors(rows: DataFrame, schema: T.StructType) -> Column:
    """What a row has against a declared schema, as an array of texts in the schema's order: required fields that are null or missing, and values of a type that
    cannot stand for the declared one.  Columns that the schema does not have are no error."""
    have, found = {f.name: f.dataType.simpleString() for f in rows.schema}, []
    for f in schema.fields:
        want = f.dataType.simpleString()
        if f.name not in have:
            found.append(F.lit(None if f.nullable else f"Missing required field: {f.name}").cast("string"))
            continue
        if not f.nullable:
            found.append(F.when(F.col(f.name).isNull(), f"Required field is null: {f.name}"))
        if have[f.name] != want and have[f.name] not in _STANDS_FOR.get(want, ()):
            found.append(F.when(F.col(f.name).isNotNull(), f"Type mismatch for '{f.name}': expected {want}, got {have[f.name]}"))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
