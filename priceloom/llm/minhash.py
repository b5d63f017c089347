"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

Sketch (:func:`sketches`).  Coordinates are bins.  In round i of the first t rounds every element of a set draws a bin and a value; a
bin keeps the smallest (round, value).  A document leaves when all its t bins are full.  In t further rounds, round t + j offers every element to bin j,
so that every coordinate of a non-empty set fills.  Two sketches agree in a share of coordinates that is concentrated about the sets' Jaccard
similarity.

Links.  Documents with equal sets are one node.  Bands of coordinates make buckets.  In each bucket, four leaders (the smallest node and
the smallest after three scramblings) are paired with every member; pairs are verified on the full sets; components of the
verified pairs follow.  What is left are buckets with members of several components; :func:`_crossing` compares across these in blocks of bounded
size.  So no pair that shares a bucket and could join two components is skipped, no bucket reaches one task as a whole, and the pairs
of a group are never listed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import BASE, PrimeHash, batch, materialize, mix64, slices
from priceloom.llm.components import components
from priceloom.session import ship_code

#: Leaders of a bucket: the smallest nodes after each of these is xor-ed in, which scrambles their order and can be undone.
LEADERS = 4
SCRAMBLE = (0, 0x2545F4914F6CDD1D, -0x61C8864680B583EB, 0x5851F42D4C957F2D)
#: Nodes of a block whose sketches are compared, and of one whose sets are; set elements of such a block.
BLOCK, SET_BLOCK, SET_ITEMS = 512, 128, 1 << 20
#: Bytes of text whose words are hashed at once.
SECTION = 1 << 18
_U = np.uint64


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind each other, and where each starts and ends (null: empty)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n, off = len(column), column.offset
    ends = np.frombuffer(column.buffers()[1], np.int64)[off : off + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if n else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def _section_end(space: np.ndarray, bounds: np.ndarray, lo: int) -> int:
    """Where the section of words from ``lo`` ends: behind white space or at a text's end, SECTION bytes on if there is such a place, else at the next."""
    n = len(space)
    if lo + SECTION >= n:
        return n
    inside = np.flatnonzero(space[lo : lo + SECTION])
    if len(inside):
        return lo + int(inside[-1]) + 1
    end = int(bounds[np.searchsorted(bounds, lo, side="right")])
    for at in range(lo + SECTION, end, SECTION):
        if (later := np.flatnonzero(space[at : min(end, at + SECTION)])).size:
            return at + int(later[0]) + 1
    return end


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word of every text in order.  Words are runs of bytes other than space and tab to carriage return, with A-Z lower-cased.

    Texts are hashed in sections that end between words, so besides 9 bytes a word and 2 a byte of text, memory is bounded by SECTION and the longest word.
    """
    data, bounds = _text_bytes(column)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    hashes, docs, lo = [np.zeros(0, _U)], [np.zeros(0, np.int64)], 0
    while lo < len(data):
        hi = _section_end(space, bounds, lo)
        low = data[lo:hi]
        low = low + ((low >= 65) & (low <= 90)).astype(np.uint8) * np.uint8(32)
        word = ~space[lo:hi]
        cut = np.zeros(len(low) + 1, bool)
        cut[bounds[np.searchsorted(bounds, lo) : np.searchsorted(bounds, hi, side="right")] - lo] = True
        before, after = np.concatenate([[False], word]), np.concatenate([word, [False]])
        starts, ends = np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))
        hashes.append(PrimeHash(low)(starts, ends))
        docs.append(np.searchsorted(bounds, starts + lo, side="right") - 1)
        lo = hi
    return np.concatenate(hashes), np.concatenate(docs)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct shingles of ``width`` words of every text, sorted by document and hash; a text with fewer words has its whole
    sequence as one shingle."""
    h, doc = word_hashes(column)
    n_docs = len(column)
    words = np.bincount(doc, minlength=n_docs)
    # A shingle's hash is a polynomial in its words' hashes; short texts use the words they have.
    first = np.concatenate([[0], np.cumsum(words)])
    i = np.arange(len(h))
    keep = np.where(words[doc] >= width, i + width <= first[doc + 1], i == first[doc])
    out = np.zeros(len(h), _U)
    with np.errstate(over="ignore"):
        for k in range(width):
            there = i + k < first[doc + 1]
            out = np.where(there, out * _U(BASE) + h[np.minimum(i + k, len(h) - 1)] if len(h) else out, out)
    s, d = mix64(out[keep]), doc[keep]
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    return s[new], d[new]


def sketches(s: np.ndarray, d: np.ndarray, n_docs: int, t: int) -> np.ndarray:
    """The n_docs x t sketch of sets given as (hash, document); 0 where a document has no elements."""
    empty = np.iinfo(np.uint64).max
    out = np.full(n_docs * t, empty, _U)
    has = np.bincount(d, minlength=n_docs) > 0
    value_bits = _U(54)
    for i in range(2 * t):
        if not len(s):
            break
        h = mix64(s ^ mix64(np.array([0x51ED27 + i], _U)))
        if i < t:
            at = d * t + (h % _U(t)).astype(np.int64)
        else:
            at = d * t + (i - t)
        value = (_U(i) << value_bits) | (mix64(h + _U(1)) >> _U(10))
        np.minimum.at(out, at, value)
        full = (out.reshape(n_docs, t) != empty).all(1)
        live = ~full[d]
        s, d = s[live], d[live]
    return np.where(has[:, None], out.reshape(n_docs, t), _U(0))


def _sets(docs: DataFrame, width: int, t: int, bands: int, per_band: int, id_type: str) -> DataFrame:
    """Per document: id, n (set size), f1, f2 (fingerprint of the set), bands (a hash of each band), low (a byte of each coordinate)."""

    def run(batches):
        schema = None
        for b in slices(batches, 1 << 19, 2048):
            schema = schema or pa.schema([b.schema.field(0), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("bands", pa.list_(pa.int64())), ("low", pa.binary())])
            s, d = shingle_sets(b.column(1), width)
            n_docs = b.num_rows
            n = np.bincount(d, minlength=n_docs)
            prints = []
            for salt in (1, 2):
                sums = np.zeros(n_docs, _U)
                np.add.at(sums, d, mix64(s ^ mix64(np.array([salt], _U))))
                prints.append(mix64(sums + n.astype(_U)).astype(np.int64))
            k = sketches(s, d, n_docs, t)
            keys = np.zeros((n_docs, bands), _U)
            for r in range(per_band):
                keys = mix64(keys * _U(BASE) + k[:, r : bands * per_band : per_band])
            keys = mix64(keys + np.arange(bands, dtype=_U)).astype(np.int64)
            low = np.ascontiguousarray((mix64(k) & _U(255)).astype(np.uint8))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n_docs * bands + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
            yield batch(schema, b.column(0), n, *prints, lists, [row.tobytes() for row in low])

    return docs.mapInArrow(run, f"id {id_type}, n long, f1 long, f2 long, bands array<long>, low binary")


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches):
        schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        for b in slices(batches, 1 << 19, 2048):
            s, d = shingle_sets(b.column(1), width)
            ends = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=b.num_rows))]).astype(np.int32)
            yield batch(schema, b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(s.astype(np.int64))))

    return docs.mapInArrow(run, "node long, shingles array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Those of the pairs (a, b) whose full sets are similar enough, and the sets (node, shingles) of all their nodes.

    Each text that a pair needs is shuffled once, and each set once per pair; the merge hints keep this plan at every size.
    """
    need = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    full = materialize(_full_sets(texts.join(need.hint("merge"), "node"), width), f"{name}-sets")
    left, right = (full.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    ok = both * 100 >= (F.size("sa") + F.size("sb") - both) * percent
    return joined.filter(ok).select("a", "b"), full


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, coordinates: int = 128, bands: int = 25, per_band: int = 5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, n_shingles, component_id, kept, one row per row of ``docs``: documents of which 100 x intersection >= ``percent`` x union of the sets of ``width``-word
    shingles are linked; ``component_id`` is the smallest id reachable, ``kept`` whether it is the document's own.

    Null, empty and blank texts have no shingles and are linked with nothing.  Ids are integers; rows that repeat an id are one document
    with the first text's links kept by id.  Null ids: components of their own (null), kept.  A pair of similarity s is missed with a probability of
    about (1 - s^per_band)^bands: 4e-7 at 0.85 and 5e-5 at 0.8 with the defaults.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = materialize(_sets(rows, width, coordinates, bands, per_band, "bigint"), "near-sets")
    # Equal sets are one node, named by its smallest id; counted before rows move.
    nodes = found.filter("n > 0 AND id IS NOT NULL").groupBy("f1", "f2", "n").agg(F.min(F.struct("id", "bands", "low")).alias("first"))
    nodes = materialize(nodes.select(F.col("first.id").alias("node"), "f1", "f2", "n", "first.bands", "first.low"), "near-nodes")
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("key"))
    leads = [F.min(F.col("node").bitwiseXOR(F.lit(c))).bitwiseXOR(F.lit(c)) for c in SCRAMBLE[:LEADERS]]
    # Written down first: a join of two plain exchanges would not let Spark split the partition of a very large bucket.
    leads = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.array_distinct(F.array(*leads)).alias("leads")).filter("size > 1"), "near-leads")
    members = materialize(keys.join(leads, "key").select("key", "node", "size", "leads"), "near-buckets")
    led = members.select("node", F.explode("leads").alias("lead")).filter("node != lead").select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
    led = materialize(led, "near-led")
    good, sets = _verified(led, rows.select(F.col("id").alias("node"), "text"), width, percent, "near-led")
    links = materialize(good, "near-links")
    parts = components(links, "near")
    more = _crossing(members.filter("size > 2").select("key", "node"), parts, nodes, sets, percent, coordinates)
    if more is not None:
        more = materialize(more, "near-more")
        if not more.isEmpty():
            parts = components(links.unionByName(more), "near")
    named = nodes.join(parts, "node", "left").select("f1", "f2", "n", F.coalesce("component", "node").alias("component"))
    # Components of nodes, named by nodes that are each the smallest id of their set.
    out = found.select("id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    out = out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), own).alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)


def _dealt(named: DataFrame, block: int, weight: Column, most: int) -> DataFrame:
    """``named`` (key, node, component, n, ...) as groups (key, x, y) whose pairs are all that matter: side 0 holds a block of the bucket, side 1 a block
    of its members outside the bucket's largest component.

    A bucket of m members of which r lie outside has about m x r / ``block`` rows, never the m x m of its pairs.
    """
    counts = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.sum(weight).alias("w"))
    most_of = F.struct("c", "component")
    sides = counts.groupBy("key").agg(F.max(most_of)["component"].alias("main"), F.sum("c").alias("m"), F.sum("w").alias("wm"), F.max("c").alias("c"), F.max(F.struct("c", "component", "w"))["w"].alias("w"))
    blocks = lambda c, w: F.greatest(F.ceil(c / block), F.ceil(w / most)).cast("int")
    sides = materialize(sides.select("key", "main", blocks(F.col("m"), F.col("wm")).alias("bx"), blocks(F.col("m") - F.col("c"), F.col("wm") - F.col("w")).alias("by")).filter("by > 0"), "near-sides")
    rows = named.join(sides, "key")
    own = lambda b: F.pmod(F.xxhash64("node", "key"), F.col(b)).cast("int")
    every = lambda b: F.explode(F.sequence(F.lit(0), F.col(b) - 1))
    every_member = rows.withColumns({"x": own("bx"), "side": F.lit(0)}).withColumn("y", every("by"))
    outside = rows.filter("component != main").withColumns({"y": own("by"), "side": F.lit(1)}).withColumn("x", every("bx"))
    return every_member.unionByName(outside).drop("main", "bx", "by")


def _crossing(members: DataFrame, parts: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, t: int) -> DataFrame | None:
    """Links (a, b) between different components, verified on the full sets; None if no bucket holds members of several components.

    Members of such buckets are dealt into pairs of blocks (:func:`_dealt`).  First with their sketches only: nodes stay that have a partner of another
    component which the sketches do not rule out (the estimate's standard deviation is at most sqrt(s (1 - s) / t) at similarity s, and pairs five of
    them below the threshold are out).  What stays is dealt again with its sets, and a task gives no more rows than links that join components.
    """
    share = percent / 100
    least = math.floor(t * max(0.0, share - 5 * math.sqrt(share * (1 - share) / t)))
    named = members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = materialize(named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("key"), "near-mixed-keys")
    if mixed.isEmpty():
        return None
    named = materialize(named.join(mixed, "key").join(nodes.select("node", "n", "low"), "node"), "near-mixed")
    near = _grouped(_dealt(named, BLOCK, F.lit(0), 1), ["component", "low"], lambda held: _candidates(held, least, t), "key long, node long").distinct()
    named = materialize(named.join(near, ["key", "node"]), "near-candidates")
    if named.isEmpty():
        return None
    full = _dealt(named, SET_BLOCK, F.col("n"), SET_ITEMS).join(sets.hint("merge"), "node")
    return _grouped(full, ["component", "low", "shingles"], lambda held: _joining(held, least, percent, t), "a long, b long").distinct()


def _grouped(dealt: DataFrame, carried: list[str], compare, result: str) -> DataFrame:
    """``compare`` over the rows (side, key, node, *carried) of each group (key, x, y); a group is one task's at a time, and its size is bounded."""
    schema = pa.schema([(f.split()[0], pa.int64()) for f in result.split(", ")])

    def run(batches):
        group, held = None, []

        def close():
            found = compare(held) if held and held[0][0] == 0 and held[-1][0] == 1 else []
            return [batch(schema, *zip(*found, strict=True))] if found else []

        for b in slices(batches):
            where = list(zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
            rest = [b.column(k).to_pylist() if b.schema.names[k] != "shingles" else b.column(k) for k in range(3, b.num_columns)]
            for i, g in enumerate(where):
                if g != group:
                    yield from close()
                    group, held = g, []
                side, node, *more = (c[i] for c in rest)
                held.append((side, g[0], node, *(np.sort(m.values.to_numpy()) if isinstance(m, pa.Scalar) else m for m in more)))
        yield from close()

    groups = dealt.select("key", "x", "y", "side", "node", *carried).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "side")
    return groups.mapInArrow(run, result)


def _agreeing(held: list, least: int, t: int):
    """(index on side 0, index on side 1) of pairs of different components whose sketches agree often enough, for each member of side 1."""
    split = next(i for i, h in enumerate(held) if h[0])
    low = np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(len(held), t)
    component = np.array([h[3] for h in held])
    for j in range(split, len(held)):
        yield j, np.flatnonzero(((low[:split] == low[j]).sum(1) >= least) & (component[:split] != component[j]))


def _candidates(held: list, least: int, t: int) -> list[tuple[int, int]]:
    found = set()
    for j, near in _agreeing(held, least, t):
        if len(near):
            found |= {held[j][1:3], *(held[i][1:3] for i in near.tolist())}
    return sorted(found)


def _joining(held: list, least: int, percent: int, t: int) -> list[tuple[int, int]]:
    """Verified links, of which each joins two components that the links before it have not joined."""
    up = {h[3]: h[3] for h in held}

    def find(c: int) -> int:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    out = []
    for j, near in _agreeing(held, least, t):
        mine = held[j][5]
        for i in near.tolist():
            a, b, other = find(held[i][3]), find(held[j][3]), held[i][5]
            if a == b:
                continue
            few, many = (mine, other) if len(mine) < len(other) else (other, mine)
            at = np.searchsorted(many, few)
            both = int((many[np.minimum(at, len(many) - 1)] == few).sum())
            if 100 * both >= percent * (len(mine) + len(other) - both):
                up[max(a, b)] = min(a, b)
                out.append((min(held[i][2], held[j][2]), max(held[i][2], held[j][2])))
    return out


def _one_of_equal_rows(keyed: DataFrame, text_col: str) -> DataFrame:
    """``keyed`` with the smallest of all rows that share a ``__key`` and whose text has a word."""
    worded = keyed.filter(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
    many = materialize(worded.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__key"), "near-equal")
    if many.isEmpty():
        return keyed
    one = keyed.join(many, "__key", "left_semi").groupBy("__key").agg(F.min(F.struct(*keyed.columns)).alias("r")).select("r.*")
    return materialize(keyed.join(many, "__key", "left_anti").select(*keyed.columns).unionByName(one), "near-rows")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_row: bool = False, **how) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of the smallest id.

    A document is an id and a text: another text under the same id is judged by itself.  Rows that repeat both stay or go together, and rows
    without an id stay.  With ``one_row``, one row of each group stays: of rows that repeat both the smallest, and rows without an id take part
    as those of the largest id.
    """
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.withColumn("__key", key if one_row else F.when(F.col(id_col).isNotNull(), key))
    if one_row:
        keyed = _one_of_equal_rows(keyed, text_col)
    found = near_duplicates(keyed.select("__key", text_col), id_col="__key", text_col=text_col, **how)
    found = found.filter("n_shingles > 0 AND __key IS NOT NULL").select("__key", "component_id").distinct()
    ids = keyed.filter("__key IS NOT NULL").groupBy("__key").agg(F.min(F.col(id_col).cast("long")).alias("id"))
    groups = materialize(found.join(ids, "__key"), "near-groups")
    # One key for each component, so that no join meets a large group on one key.
    stay = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__key")).alias("first")).select("first.__key")
    gone = groups.select("__key").join(stay, "__key", "left_anti")
    return keyed.join(gone, "__key", "left_anti").select(*docs.columns)


#: The query's rows by joining shingles and following links; used as an oracle on small tables.
NEAR_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
l AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
u AS MATERIALIZED (SELECT min(doc_id) AS node, g, len(g) AS n FROM l GROUP BY g),
s AS MATERIALIZED (SELECT node, n, unnest(g) AS g FROM u),
p AS (SELECT a.node AS a, b.node AS b FROM s AS a JOIN s AS b ON a.g = b.g AND a.node < b.node GROUP BY a.node, b.node HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT node AS a, node AS b FROM u UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
k AS (SELECT a AS node, min(b) AS component FROM r GROUP BY a)
SELECT l.doc_id, len(l.g)::BIGINT AS n_shingles, CASE WHEN len(l.g) = 0 THEN l.doc_id ELSE k.component END AS component_id, CASE WHEN len(l.g) = 0 THEN true ELSE l.doc_id = k.component END AS kept
FROM l JOIN u ON l.g = u.g JOIN k ON k.node = u.node"""
