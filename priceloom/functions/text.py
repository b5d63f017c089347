"""Text and number normalization as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from priceloom.schemas import PRICE


#: The code points of the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without leading and trailing Unicode white space (``trim`` alone takes spaces only); a trim of a set of characters, several times as fast as a regex."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def to_price(c: Column) -> Column:
    """A decimal price or null, never an error and never 0 for what is no number."""
    return c.try_cast(PRICE)


def to_utc(c: Column) -> Column:
    """ISO text to a timestamp; without an offset it counts as UTC (the session's zone)."""
    return c.try_cast("timestamp")


def iso(c: Column) -> Column:
    """ISO 8601 with offset; a fraction of six digits only where there is one."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
    return F.concat(whole, F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("+00:00"))


def event_id(source: Column, external_id: Column, collected_at: Column) -> Column:
    return F.concat(source, F.lit(":"), external_id, F.lit(":"), iso(collected_at))


def path_segment(c: Column) -> Column:
    """Safe for a path: other characters become ``_``, runs of dots one dot."""
    return F.regexp_replace(F.regexp_replace(c, r"[^a-zA-Z0-9\-_.]", "_"), r"\.{2,}", ".")


#: The currency of each symbol, the first found counts; a separator of thousands.
SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP"}
THOUSANDS = r"(?<=\d)[,.](?=\d{3}(?:[^\d]|$))"


def price_text(c: Column, default: str) -> tuple[Column, Column]:
    """(price, currency) of a text such as ``£1,234.50``; the default currency where there is no symbol, a null price where there is no number.

    A comma or dot before three digits that end there separates thousands: ``€1.234`` is 1234.
    """
    currency = F.lit(default)
    for sign, code in reversed(SYMBOLS.items()):
        currency = F.when(F.contains(c, F.lit(sign)), code).otherwise(currency)
    digits = strip(F.translate(c, "".join(SYMBOLS), ""))
    plain = F.regexp_replace(digits, THOUSANDS, "")
    return plain.try_cast(PRICE), F.when(c.isNotNull(), currency)


def slug_of_url(url: Column) -> Column:
    """The last path part of a URL without an index page, query or fragment."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/(index\.html?)?$", "")
    return blank_to_null(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.html?$", ""))


def leading_digits(slug: Column) -> Column:
    found = F.regexp_extract(slug, r"^(\d+)", 1)
    return F.when(found != "", found).otherwise(slug)


def availability_of(text: Column, mark: Column | None = None) -> Column:
    """Availability by what is written; where that says nothing, by ``mark`` (from classes and attributes), else unknown.

    Negative phrases are tested first, so that ``unavailable`` is not taken for ``available``.
    """
    t = F.lower(text)
    has = lambda *words: t.rlike("|".join(words))
    said = F.when(has("out of stock", "unavailable", "not available", "sold out"), "out_of_stock").when(has("pre-?order", "coming soon"), "preorder").when(has("in stock", "available"), "in_stock")
    return F.coalesce(said, *([mark] if mark is not None else []), F.lit("unknown"))


def utc_bound(c: Column) -> Column:
    """A bound of a time range, from text: without an offset it is UTC, whatever the session's zone; a day alone is its midnight; else null."""
    day = c.rlike(r"^\d{4}-\d{2}-\d{2}$")
    zoned = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(day, F.concat(c, F.lit("T00:00:00Z"))).when(zoned, c).otherwise(F.concat(c, F.lit("Z"))).try_cast("timestamp")
