"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree has regions, racks and shards, each shard with a weight; a node weighs what its shards weigh together.  A row
descends region, rack, shard; at each level every child draws ``-ln(u) / weight`` with ``u`` from a hash of the row's id and
the child's name, and the smallest draw wins.  A child's draw depends on nothing but the id, its name and its weight, so when weights
change, rows move only out of or into the subtrees whose weights changed.  A shard that opens a region of its own (:func:`grow`)
takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: region -> rack -> shard -> weight
Tree = dict[int, dict[int, dict[int, float]]]


def even_tree(shards: int, racks: int = 2, regions: int = 2) -> Tree:
    """``shards`` shards of weight 1, dealt in order over ``regions`` regions of ``racks`` racks each."""
    tree: Tree = {}
    for s in range(shards):
        rack = s * regions * racks // shards
        tree.setdefault(rack // racks, {}).setdefault(rack, {})[s] = 1.0
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard in a new region of its own."""
    rack = 1 + max(k for racks in tree.values() for k in racks)
    return {**tree, 1 + max(tree): {rack: {shard: weight}}}


def _uniform(*parts: Column) -> Column:
    """A number from 0 to 2**52 - 1 by the MD5 of the parts' texts (null: empty), joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def _draw(key: list[Column], level: str, name: int, weight: float) -> Column:
    # Shifted by a half, the number lies strictly between 0 and 1.
    u = (_uniform(*key, F.lit(level), F.lit(name)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.struct((-F.ln(u) / F.lit(float(weight))).alias("draw"), F.lit(name).alias("name"))


def _pick(key: list[Column], level: str, weights: dict[int, float]) -> Column:
    drawn = [_draw(key, level, name, w) for name, w in sorted(weights.items()) if w > 0]
    if not drawn:
        return F.lit(None).cast("int")
    return F.array_min(F.array(*drawn))["name"] if len(drawn) > 1 else drawn[0]["name"]


def _either(on: Column, cases: dict[int, Column]) -> Column:
    out = F.lit(None).cast("int")
    for name, then in cases.items():
        out = F.when(on == F.lit(name), then).otherwise(out)
    return out


def assign(df: DataFrame, tree: Tree, key: list[str], to: str) -> DataFrame:
    """Add column ``to``, the shard of each row.  Null keys hash like any other value; a shard of weight 0 gets no rows."""
    cols = [F.col(k) for k in key]
    rack_w = {r: {k: sum(s.values()) for k, s in racks.items()} for r, racks in tree.items()}
    region, rack = f"__{to}_region", f"__{to}_rack"
    df = df.withColumn(region, _pick(cols, "region", {r: sum(k.values()) for r, k in rack_w.items()}))
    df = df.withColumn(rack, _either(F.col(region), {r: _pick(cols, "rack", w) for r, w in rack_w.items()}))
    df = df.withColumn(to, _either(F.col(rack), {k: _pick(cols, "shard", s) for racks in tree.values() for k, s in racks.items()}))
    return df.drop(region, rack)


#: Rows of a cell in which a window numbers them, and copies of a row that a task writes out, about.
CELL_ROWS, COPIES = 1 << 16, 4096


def with_slots(df: DataFrame, shard: str, order: list[str], to: str = "slot", most_cells: int = 1 << 16) -> DataFrame:
    """The distinct rows of ``df`` with ``__n``, how often each occurs, and ``to``, the first of its slots: slots number each shard's rows from 0 without a gap, in
    the order of a hash of ``order`` and then ``order``.

    A shard is cut into cells, ranges of the hash, as many as its rows ask for (at most ``most_cells`` over all shards, which bounds the broadcast table of the
    cells' first numbers); rows are numbered inside their cell.  Repeated rows are counted before they are shuffled.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__h", _uniform(*map(F.col, order)))
    total = df.count()
    bits = max(0, min(-(-total // CELL_ROWS) - 1, most_cells // 64 - 1).bit_length())
    rows = rows.withColumn("__cell", F.shiftright("__h", 52 - bits))
    cells = rows.groupBy(F.col(shard).alias("__s"), F.col("__cell").alias("__c")).agg(F.sum("__n").alias("__m"))
    before = Window.partitionBy("__s").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    first = cells.select("__s", "__c", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__first"))
    inside = F.sum("__n").over(Window.partitionBy(shard, "__cell").orderBy("__h", *order).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__in", F.coalesce(inside, F.lit(0))).join(F.broadcast(first), (F.col(shard) == F.col("__s")) & (F.col("__cell") == F.col("__c")))
    return rows.withColumn(to, F.col("__first") + F.col("__in")).drop("__h", "__cell", "__s", "__c", "__first", "__in")


def expand(counted: DataFrame, slot: str = "slot") -> DataFrame:
    """Each row as often as ``__n`` says, in slots of its own; a row with very many copies is spread over tasks."""
    once = counted.filter("__n = 1").drop("__n")
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / COPIES)))
    spread = counted.filter("__n > 1").withColumn("__part", parts).repartition("__part", slot)
    end = F.least(F.col("__n"), (F.col("__part") + 1) * COPIES) - 1
    many = spread.withColumn("__k", F.explode(F.sequence(F.col("__part") * COPIES, end)))
    return once.unionByName(many.withColumn(slot, F.col(slot) + F.col("__k")).drop("__n", "__part", "__k"))


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes and 1), CRC of the text, shard, slot, and the shard under the grown tree.

    The id alone (with the tree) decides the shard.  Null text: size 1, CRC of nothing (0); a null id counts as an empty one.  Repeated ids share a shard and
    get different slots; rows that repeat id and text take neighbouring ones.  Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = assign(rows, tree, [id_col], "shard")
    rows = assign(expand(with_slots(rows, "shard", [id_col, "text_crc32", "size"])), grown, [id_col], "grown_shard")
    return rows.select(id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _shard_sql(tree: Tree, shard: str) -> str:
    """A shard by the same draws, a CASE for each level."""
    draw = lambda level, name, w: f"(-ln((('0x' || substr(md5(k || ':{level}:{name}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE) / {float(w)}::DOUBLE)"
    pick = lambda level, of: f"list_min([{', '.join(f'struct_pack(d := {draw(level, n, w)}, n := {n})' for n, w in sorted(of.items()))}]).n"
    racks = {r: {k: sum(s.values()) for k, s in ks.items()} for r, ks in tree.items()}
    region = pick("region", {r: sum(k.values()) for r, k in racks.items()})
    rack = "CASE region " + " ".join(f"WHEN {r} THEN {pick('rack', k)}" for r, k in racks.items()) + " END"
    leaf = "CASE rack " + " ".join(f"WHEN {k} THEN {pick('shard', s)}" for ks in tree.values() for k, s in ks.items()) + " END"
    return f"SELECT k, {leaf} AS {shard} FROM (SELECT k, {rack} AS rack FROM (SELECT k, {region} AS region FROM i))"


def shard_sql(shards: int = 16) -> str:
    """The query's rows in DuckDB SQL; used as an oracle.  It has no CRC, so bytes are folded with the table of the polynomial's remainders."""
    tree = even_tree(shards)
    return f"""WITH i AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS k FROM documents), a AS ({_shard_sql(tree, "shard")}), g AS ({_shard_sql(grow(tree, shards), "grown_shard")}),
t AS (SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
h AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, strlen(coalesce(text, ''))::BIGINT AS n, hex(coalesce(text, '')) AS h FROM documents),
b AS (SELECT doc_id, k, n + 1 AS size, list_transform(range(0, n), lambda i: ('0x' || substr(h, (2 * i + 1)::INTEGER, 2))::BIGINT) AS bytes FROM h),
c AS (SELECT doc_id, k, size, xor(list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, t),
o AS (SELECT *, ('0x' || substr(md5(concat_ws(':', k, text_crc32::VARCHAR, size::VARCHAR)), 1, 13))::BIGINT AS o FROM c JOIN a USING (k) JOIN g USING (k))
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard, (row_number() OVER (PARTITION BY shard ORDER BY o, doc_id, text_crc32, size) - 1)::BIGINT AS slot, grown_shard::INTEGER AS grown_shard FROM o"""


SHARD_SQL = shard_sql()
