"""Product listing pages to product rows with the standard library's parser, in Arrow batches.

A layout names the elements that hold a card, its link, price and stock text; everything else (prices, ids, availability, absolute urls)
is derived from the extracted texts by column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.functions.text import availability_of, blank_to_null, leading_digits, price_text, slug_of_url
from priceloom.session import ship_code

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None = None
    children: list = field(default_factory=list)

    @property
    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def walk(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children).strip()


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {})

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


@dataclass(frozen=True)
class Layout:
    """Where a retailer's pages keep things; each is a set of (tag or None, class or None).

    ``stock_in`` and ``stock_out`` are elements that tell availability by being there (as does an attribute ``data-available``); ``stock_class`` is text in
    the class of the stock element that says in stock.
    """

    containers: tuple = ()
    cards: tuple = ()
    titles: tuple = ()
    price: tuple = ()
    stock: tuple = ()
    stock_in: tuple = ()
    stock_out: tuple = ()
    stock_class: str | None = None
    crumbs: tuple = ()
    category: str = "General"
    currency: str = "USD"
    text_is_name: bool = True
    numeric_ids: bool = True


def _is(node: Node, wanted: tuple) -> bool:
    return any((tag is None or node.tag == tag) and (cls is None or cls in node.classes) for tag, cls in wanted)


def _first(node: Node, wanted: tuple) -> Node | None:
    return next((n for n in node.walk() if _is(n, wanted)), None)


#: The two known layouts.
BOOKS = Layout(
    cards=(("article", "product_pod"),), titles=(("h3", None),), price=(("p", "price_color"),), stock=((None, "availability"),), stock_class="instock", crumbs=(("ul", "breadcrumb"),), category="Books", currency="GBP", text_is_name=False, numeric_ids=False,
)
CARDS = Layout(
    containers=(("div", "product-grid"), ("div", "product-list"), ("ol", "product-list")), cards=(("article", "product-card"), ("div", "product-card"), ("li", "product-item")), titles=(("h2", None), ("h3", None)),
    price=(("span", "price"), ("p", "price"), ("span", "product-price"), ("data", "price")), stock=(("span", "availability"), ("p", "availability"), ("span", "stock-status"), (None, "stock")),
    stock_in=(("span", "in-stock"), ("span", "available")), stock_out=(("span", "out-of-stock"), ("span", "unavailable")), crumbs=(("ul", "breadcrumb"), ("nav", "breadcrumb")),
)


def _category(root: Node, layout: Layout) -> str:
    for crumb in (n for n in root.walk() if _is(n, layout.crumbs)):
        labels = [n.text() for n in crumb.walk() if n.tag in ("li", "span")]
        labels = [x for x in labels if x and x.lower() != "home"]
        if labels:
            return labels[-1]
    head = next((n for n in root.walk() if n.tag == "h1" and n.classes & {"category-title", "page-title"}), None)
    return (head.text() if head else "") or layout.category


def _mark(card: Node, stock: Node | None, layout: Layout) -> str | None:
    """Availability by classes and attributes: in stock before out of stock."""
    said = {n.attrs["data-available"] for n in card.walk() if "data-available" in n.attrs}
    if (layout.stock_class and stock and layout.stock_class in stock.attrs.get("class", "")) or _first(card, layout.stock_in) or "true" in said:
        return "in_stock"
    return "out_of_stock" if _first(card, layout.stock_out) or "false" in said else None


def _card(card: Node, layout: Layout) -> tuple:
    title = _first(card, layout.titles)
    link = next((n for n in title.walk() if n.tag == "a"), None) if title else None
    if link is None:
        return None, None, None, None, None, "missing link"
    name = (link.attrs.get("title") or (link.text() if layout.text_is_name else "")).strip()
    href = link.attrs.get("href", "").strip()
    price, stock = _first(card, layout.price), _first(card, layout.stock)
    shown = price.text() if price else next((n.attrs["data-price"] for n in card.walk() if "data-price" in n.attrs), None)
    why = "missing name" if not name else "missing url" if not href else None
    return name, href, shown, (stock.text() if stock else None), _mark(card, stock, layout), why


def extract(html: str | None, layout: Layout) -> tuple[list[tuple], bool, str | None]:
    """((name, href, price text, stock text, stock mark, reason why malformed, category) of each card, structure changed, link to the next page)."""
    if not html or not html.strip():
        return [], False, None
    root = tree(html)
    inside = _first(root, layout.containers) if layout.containers else root
    cards = [n for n in (inside or root).walk() if _is(n, layout.cards)]
    pager = next((n for n in root.walk() if n.tag == "li" and "next" in n.classes), None)
    link = next((n for n in pager.walk() if n.tag == "a"), None) if pager else None
    category = _category(root, layout)
    return [(*_card(c, layout), category) for c in cards], bool(layout.containers) and inside is None and not cards, (link.attrs.get("href", "").strip() or None) if link else None


_OUT = pa.schema([("page_url", pa.string()), ("ordinal", pa.int32()), ("name", pa.string()), ("href", pa.string()), ("url", pa.string()), ("price_text", pa.string()), ("stock_text", pa.string()), ("stock_mark", pa.string()), ("category", pa.string()), ("malformed", pa.string()), ("structural_change", pa.bool_()), ("next_url", pa.string())])
_DDL = "page_url string, ordinal int, name string, href string, url string, price_text string, stock_text string, stock_mark string, category string, malformed string, structural_change boolean, next_url string"


def parse_pages(pages: DataFrame, layout: Layout, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row for each card and one (ordinal -1) for each page; malformed cards say why.  No shuffle."""

    ship_code(pages.sparkSession)

    def run(batches):
        for b in batches:
            out = []
            for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                cards, changed, nxt = extract(html, layout)
                out.append((url, -1, None, None, None, None, None, None, None, None, changed, urljoin(url or "", nxt) if nxt else None))
                out += [(url, i, name, href, urljoin(url or "", href) if href else None, price, stock, mark, category, why, False, None) for i, (name, href, price, stock, mark, why, category) in enumerate(cards)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)

    return pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, _DDL)


def products_of(parsed: DataFrame, layout: Layout) -> DataFrame:
    """Well-formed cards with product id, price, currency and availability."""
    price, currency = price_text(F.coalesce("price_text", F.lit("")), layout.currency)
    slug = slug_of_url(F.col("href"))
    pid = leading_digits(slug) if layout.numeric_ids else slug
    named = F.substring(F.regexp_replace(F.lower("name"), " ", "-"), 1, 80)
    good = parsed.filter("ordinal >= 0 AND malformed IS NULL")
    return good.select("page_url", "ordinal", F.coalesce(blank_to_null(pid), named).alias("product_id"), "name", price.alias("price"), currency.alias("currency"), availability_of(F.coalesce("stock_text", F.lit("")), F.col("stock_mark")).alias("availability"), "category", "url")


def follow_pages(parsed: DataFrame, first: DataFrame, max_pages: int = 5) -> DataFrame:
    """(start_url, page_url, page_no) of the landed pages that paging reaches from each url of ``first`` (url), by the next links of ``parsed``.

    A page is landed if ``parsed`` has its row; paging stops at a page that is not there or has no next link, and after ``max_pages``, so the pages before a
    missing one stay.  Each step is a join of the pages reached last with the links: the number of steps is the parameter, not the data's.
    """
    links = parsed.filter("ordinal = -1").groupBy("page_url").agg(F.min("next_url").alias("next_url"))
    here = first.select(F.col("url").alias("start_url"), F.col("url").alias("page_url")).distinct().join(links, "page_url").withColumn("page_no", F.lit(1))
    reached = here
    for n in range(2, max_pages + 1):
        here = here.filter("next_url IS NOT NULL").select("start_url", F.col("next_url").alias("page_url")).join(links, "page_url").withColumn("page_no", F.lit(n))
        reached = reached.unionByName(here)
    return reached.select("start_url", "page_url", "page_no")
