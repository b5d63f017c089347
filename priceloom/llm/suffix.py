"""Removal of repeated byte strings by longest-previous-factor arrays over sampled suffixes.

A string of ``length`` bytes that starts at two places is found without a global suffix array:

1.  Windows.  Each window of ``length`` bytes has an anchor, the place of the smallest hash among its ``GRAM``-byte grams (leftmost of
    equals).  Equal windows have equal anchors at equal offsets, so they meet under the anchor's gram hash.  A run of
    neighbouring windows with one anchor is a fragment; there is about one for every (length - GRAM) / 2 bytes.  Fragments are written once, as narrow
    rows with a 128-bit BLAKE2b digest of their bytes.
2.  Grams are counted before anything else moves; only those that occur at least twice go on.  Under a gram, fragments of equal digest are one class
    with a count and a first place; the digest stands for the bytes, so copies of whole fragments are settled without shipping them.
3.  Grams with several classes need their bytes, one fragment per class.  A task sorts the suffixes of its fragments to a depth of ``length`` bytes by
    prefix doubling and takes the common prefixes of neighbours from the doubled ranks.  :func:`longest_previous` then gives each window its longest
    previous factor: the longer of the prefixes shared with the nearest suffixes before and after it in suffix order that start at a smaller place of
    the corpus.  A window whose factor reaches ``length`` is a later copy; what the factor points at is its earlier one.
4.  A gram with very many classes is dealt into salts of about ``CLASSES`` fragments.  Each salt hands on one row per distinct window, with a
    digest; these are grouped, so windows that only meet across salts are found as well.

Rows that repeat an id and a text are one row for all this; of such rows one is the first and the others are whole later copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import RangeHash, batch, materialize, slices
from priceloom.llm.minhash import _text_bytes
from priceloom.session import ship_code

GRAM = 64
#: Fragments of one gram that a task sorts together: some 1.3 MB at a length of 200.
CLASSES = 4096
#: Bytes of fragments that are sorted together, and of text that is hashed together.
CHUNK = 1 << 18
SECTION = 1 << 19
#: In a winnowing key, low bits for the place; sections are shorter than 2**PLACE_BITS.
PLACE_BITS = 28
_U = np.uint64


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` neighbours, by running minima from both ends of blocks of ``w``."""
    n = len(x)
    if n < w:
        return x[:0]
    full = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    full[:n] = x
    rows = full.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit BLAKE2b digests of byte ranges, as two columns of int64."""
    view, new = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    return np.frombuffer(b"".join([new(view[a:z], digest_size=16).digest() for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]), "<i8").reshape(-1, 2)


def fragments(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, gram hash, digest) of every run of windows with one anchor; places count from the document's start."""
    gram = min(GRAM, length)
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros((0, 2), np.int64),)
    ranged = RangeHash(data)
    at = np.arange(n - gram + 1)
    h = ranged(at, at + gram)
    key = (h >> _U(PLACE_BITS)) << _U(PLACE_BITS) | at.astype(_U)
    anchor = (sliding_min(key, length - gram + 1) & _U((1 << PLACE_BITS) - 1)).astype(np.int64)
    start = np.arange(len(anchor))
    doc = np.searchsorted(bounds, start, side="right") - 1
    inside = start + length <= bounds[doc + 1]
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (doc[1:] != doc[:-1])
    a = np.flatnonzero(first)
    end = np.ones(len(anchor), bool)
    end[:-1] = first[1:] | ~inside[1:]
    b = np.flatnonzero(end & inside)
    return doc[a], a - bounds[doc[a]], b - a + 1, h[anchor[a]].astype(np.int64), digests(data, a, b + length)


def _ranks(high: np.ndarray, low: np.ndarray, low_bits: int) -> np.ndarray:
    """Dense ranks of the pairs (high, low).  Where both and the position fit into 64 bits, packed keys are sorted as plain numbers, which is several times
    as fast as sorting positions."""
    n = len(high)
    bits = max(1, (n - 1).bit_length())
    if int(high.max(initial=0)).bit_length() + low_bits + bits <= 64:
        packed = np.sort((high.astype(_U) << _U(low_bits) | low.astype(_U)) << _U(bits) | np.arange(n, dtype=_U))
        value, order = packed >> _U(bits), (packed & _U((1 << bits) - 1)).astype(np.int64)
        changed = value[1:] != value[:-1]
    else:
        order = np.lexsort((low, high))
        changed = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    out = np.empty(n, np.int64)
    out[order] = np.concatenate([[0], np.cumsum(changed)])
    return out


def rank_levels(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(depth, rank of each position's next ``depth`` bytes in lexicographic order) of each round of prefix doubling; equal strings have equal ranks.

    The last depth is ``length``.  Positions nearer to the end count as if zero bytes followed.
    """
    n = len(data)
    depth = min(5, length)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)]).astype(_U)
    key = np.zeros(n, _U)
    for i in range(depth):
        key = key << _U(8) | padded[i : i + n]
    levels = [(depth, _ranks(key, np.zeros(n, _U), 0))]
    while depth < length:
        step, r = min(depth, length - depth), levels[-1][1]
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = r[step:] + 1
        depth += step
        levels.append((depth, _ranks(r, ahead, n.bit_length())))
    return levels


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of each position's next ``length`` bytes in lexicographic order (equal strings, equal ranks)."""
    return rank_levels(data, length)[-1][1]


def common_prefixes(data: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, which differ within the last depth: the deepest equal ranks first, then bytes."""
    n, shared = len(data), np.zeros(len(a), np.int64)
    for depth, rank in reversed(levels[:-1]):
        i, j = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
        shared += np.where((rank[i] == rank[j]) & (np.maximum(a, b) + shared + depth <= n), depth, 0)
    for _ in range(levels[0][0]):
        i, j = a + shared, b + shared
        inside = np.maximum(i, j) < n
        shared += inside & (data[np.minimum(i, n - 1)] == data[np.minimum(j, n - 1)])
    return np.minimum(shared, levels[-1][0])


def longest_previous(place: list[int], lcp: list[int]) -> tuple[list[int], list[int]]:
    """Longest previous factors of suffixes in suffix order.

    ``place``: where each starts in the corpus; ``lcp``: its common prefix with the suffix before it in the order.  Returns, for each, the length of
    the longest prefix that also starts at a smaller place, and the index of a suffix there (-1: none).  One pass with a stack: an entry's previous
    smaller place is what lies below it, its next smaller place is what removes it; the longer common prefix of the two is the factor.
    """
    n = len(place)
    factor, source = [0] * n, [-1] * n
    stack: list[tuple[int, int]] = []  # (index, common prefix with the entry below)
    for i in range(n + 1):
        here, shared = (place[i], lcp[i]) if i < n else (-1, 0)
        while stack and place[stack[-1][0]] > here:
            j, before = stack.pop()
            if before >= shared:
                factor[j], source[j] = before, stack[-1][0] if stack and before else -1
            else:
                factor[j], source[j] = shared, i
            shared = min(before, shared)
        if i < n:
            stack.append((i, shared if stack else 0))
    return factor, source


def window_factors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(factor, source, rank) of the windows that start at ``at``, given in corpus order: the longest previous factor, at most ``length``; the window it
    points at (-1: none); the rank of the window's bytes.

    Windows of equal bytes stand side by side in suffix order, by place: the one before is the previous smaller place, with all ``length`` bytes in
    common.  The first of each run goes through :func:`longest_previous` with the firsts of the other runs.
    """
    levels = rank_levels(data, length)
    rank = levels[-1][1][at]
    order = np.argsort(rank, kind="stable")
    factor, source = np.full(len(at), length, np.int64), np.full(len(at), -1, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = rank[order][1:] != rank[order][:-1]
    source[order[1:]] = order[:-1]
    heads = order[new]
    lcp = np.zeros(len(heads), np.int64)
    lcp[1:] = common_prefixes(data, levels, at[heads[:-1]], at[heads[1:]])
    found, back = longest_previous(heads.tolist(), lcp.tolist())
    back = np.array(back, np.int64)
    factor[heads], source[heads] = found, np.where(back >= 0, heads[back], -1)
    return factor, source, rank


def _window_places(sizes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buffer position and fragment of every window of fragments that lie behind each other."""
    offset = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    frag = np.repeat(np.arange(len(windows)), windows)
    within = np.arange(len(frag)) - np.repeat(np.concatenate([[0], np.cumsum(windows)])[:-1], windows)
    return offset[frag] + within, frag


def _keys(text_col: str, id_col: str) -> dict:
    """__id and __rk, a hash of the text that tells rows of one id apart; null ids count as the smallest id, null texts as empty."""
    return {"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), "__rk": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    schema = pa.schema([("h", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("id", pa.int64()), ("rk", pa.int64()), ("p", pa.int64()), ("n", pa.int32())])

    def run(batches):
        for b in slices(batches, SECTION, 2048):
            ids, rks = b.column(0).to_numpy(), b.column(1).to_numpy()
            data, bounds = _text_bytes(b.column(2))
            for lo in range(0, max(1, len(data)), 2 * SECTION) if len(data) > 2 * SECTION else [0]:
                # A text longer than two sections is cut; sections share length - 1 bytes, so each window is in one.
                hi = min(len(data), lo + 2 * SECTION + length - 1) if len(data) > 2 * SECTION else len(data)
                inner = np.unique(np.clip(bounds, lo, hi))
                doc, p, n, h, f = fragments(data[lo:hi], inner - lo, length)
                if len(doc):
                    own = np.searchsorted(bounds, inner[doc], side="right") - 1
                    yield batch(schema, h, f[:, 0], f[:, 1], ids[own], rks[own], p + inner[doc] - bounds[own], n.astype(np.int32))

    return rows.mapInArrow(run, "h long, f1 long, f2 long, id long, rk long, p long, n int")


def _cut_fragments(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted fragments (id, rk, p, n, h, salt, salts, times)."""
    schema = pa.schema([("h", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("id", pa.int64()), ("rk", pa.int64()), ("p", pa.int64()), ("n", pa.int32()), ("times", pa.int64()), ("bytes", pa.binary())])

    def run(batches):
        for b in slices(batches, SECTION, 1024):
            out = []
            for i, rk, text, asked in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                raw = text.encode()
                for a in asked:
                    out.append((a["h"], a["salt"], a["salts"], i, rk, a["p"], a["n"], a["times"], raw[a["p"] : a["p"] + a["n"] + length - 1]))
                    if len(out) >= 4096:
                        yield batch(schema, *zip(*out, strict=True))
                        out = []
            if out:
                yield batch(schema, *zip(*out, strict=True))

    lists = wanted.groupBy("id", "rk").agg(F.collect_list(F.struct("h", "salt", "salts", "p", "n", "times")).alias("asked"))
    return rows.join(lists, ["id", "rk"]).select("id", "rk", "text", "asked").mapInArrow(run, "h long, salt int, salts int, id long, rk long, p long, n int, times long, bytes binary")


def _sorted_groups(pieces: DataFrame, length: int, first: bool) -> DataFrame:
    """Removed spans (kind 0: id, rk, s, e) of the fragments, and one row for each distinct window of a salted gram (kind 1: w1, w2, its first place, its times)."""
    schema = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("rk", pa.int64()), ("s", pa.int64()), ("e", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("times", pa.int64())])

    def solve(held):
        held.sort(key=lambda r: r[3:6])  # corpus order
        ids, rks, ps, ns, times = (np.array([r[k] for r in held], np.int64) for k in (3, 4, 5, 6, 7))
        salts = np.array([r[2] for r in held])
        data = np.frombuffer(b"".join(r[8] for r in held), np.uint8)
        at, frag = _window_places(np.array([len(r[8]) for r in held]), ns)
        factor, source, rank = window_factors(data, at, length)
        later = factor >= length
        gone = later.copy()
        if not first:
            gone[source[later]] = True  # the earlier place of a factor goes as well, as do fragments with copies
            gone |= times[frag] > 1
        p = at - at[np.concatenate([[0], np.cumsum(ns)])[:-1]][frag] + ps[frag]
        a = gone.copy()
        a[1:] &= ~gone[:-1] | (frag[1:] != frag[:-1])
        z = gone.copy()
        z[:-1] &= ~gone[1:] | (frag[1:] != frag[:-1])
        a, z = np.flatnonzero(a), np.flatnonzero(z)
        none = np.zeros(len(a), np.int64)
        if len(a):
            yield batch(schema, none.astype(np.int32), ids[frag[a]], rks[frag[a]], p[a], p[z] + length, none, none, none)
        if (salts > 1).any():
            total = np.bincount(rank, weights=times[frag])
            lead = np.flatnonzero((salts[frag] > 1) & ~later)
            w = digests(data, at[lead], at[lead] + length)
            yield batch(schema, np.ones(len(lead), np.int32), ids[frag[lead]], rks[frag[lead]], p[lead], p[lead] + length, w[:, 0], w[:, 1], total[rank[lead]].astype(np.int64))

    def run(batches):
        held, size, key = [], 0, None
        for b in slices(batches, 2 << 20):
            for r in zip(*(b.column(k).to_pylist() for k in range(9)), strict=True):
                if r[:2] != key:
                    if size >= CHUNK:
                        yield from solve(held)
                        held, size = [], 0
                    key = r[:2]
                held.append(r)
                size += len(r[8])
        if held:
            yield from solve(held)

    groups = pieces.repartition("h", "salt").sortWithinPartitions("h", "salt")
    return groups.mapInArrow(run, "kind int, id long, rk long, s long, e long, w1 long, w2 long, times long")


def repeated_spans(rows: DataFrame, length: int, first: bool) -> DataFrame:
    """(id, rk, spans): byte spans to remove from each of ``rows`` (id, rk, text; no two with equal id and rk) that has any; spans may overlap."""
    ship_code(rows.sparkSession)
    anchors = materialize(_anchors(rows, length), "lpf-anchors")
    # Counts are written down before they are joined: a join of two plain exchanges lets Spark split the partition of a very common gram.
    many = materialize(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h"), "lpf-grams")
    met = materialize(anchors.join(many, "h"), "lpf-met")
    classes = met.groupBy("h", "f1", "f2").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "rk", "p", "n")).alias("at"))
    classes = materialize(classes.select("h", "f1", "f2", "times", "at"), "lpf-classes")
    several = materialize(classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "lpf-several")
    salts = F.ceil(F.col("kinds") / CLASSES).cast("int")
    wanted = classes.join(several, "h").select("at.*", "h", F.pmod(F.xxhash64("f1", "f2"), salts).cast("int").alias("salt"), salts.alias("salts"), "times")
    solved = materialize(_sorted_groups(_cut_fragments(rows, wanted, length), length, first), "lpf-spans")
    place = F.struct("id", "rk", "p")
    copies = met.join(classes.filter("times > 1").select("h", "f1", "f2", F.struct("at.id", "at.rk", "at.p").alias("lead")), ["h", "f1", "f2"])
    if first:
        copies = copies.filter(place != F.col("lead"))
    spans = copies.select("id", "rk", F.col("p").alias("s"), (F.col("p") + F.col("n") + length - 1).alias("e"))
    spans = spans.unionByName(solved.filter("kind = 0").select("id", "rk", "s", "e"))
    met_again = solved.filter("kind = 1")
    across = materialize(met_again.groupBy("w1", "w2").agg(F.sum("times").alias("all"), F.min(F.struct("id", "rk", "s")).alias("lead")).filter("all > 1"), "lpf-across")
    again = met_again.join(across, ["w1", "w2"])
    again = again.filter(F.struct("id", "rk", "s") != F.col("lead")) if first else again
    spans = spans.unionByName(again.select("id", "rk", "s", "e"))
    return spans.groupBy("id", "rk").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def _one_of_equals(keyed: DataFrame) -> DataFrame:
    """``keyed`` with __copy: null for a row without equals, "first" for one of the rows that repeat an id and a text, "later" for the others.

    The first is that of the smallest digest of all its columns, and of rows equal in everything any one; the choice is written down, so it stays.
    """
    equal = materialize(keyed.groupBy("__id", "__rk").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__id", "__rk"), "lpf-equal")
    if equal.isEmpty():
        return keyed.withColumn("__copy", F.lit(None).cast("string"))
    names = [c for c in keyed.columns if c not in ("__id", "__rk")]
    rows = keyed.join(equal, ["__id", "__rk"], "left_semi").withColumns({"__uid": F.monotonically_increasing_id(), "__own": F.md5(F.to_json(F.struct(*names)))})
    rows = materialize(rows, "lpf-equal-rows")
    firsts = rows.groupBy("__id", "__rk").agg(F.min(F.struct("__own", "__uid"))["__uid"].alias("__uid")).select("__uid", F.lit("first").alias("__copy"))
    rows = rows.join(firsts, "__uid", "left").withColumn("__copy", F.coalesce("__copy", F.lit("later")))
    return keyed.join(equal, ["__id", "__rk"], "left_anti").withColumn("__copy", F.lit(None).cast("string")).unionByName(rows.drop("__uid", "__own"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, length: int = 200, keep: str = "first", id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` with the repeated strings of ``length`` bytes (UTF-8) cut out of ``text_col``.

    ``keep="first"``: a byte goes if a string of ``length`` bytes over it starts at an earlier place too (by id, then hash of the text, then place), so
    one copy stays.  ``keep="none"``: it goes if such a string starts at any other place.  Strings are judged on the input; matches never cross
    documents; overlaps count.  A character of which some bytes go is dropped.  Null texts stay null, shorter ones as they are; null ids count as the
    smallest id.  Rows that repeat an id and a text are as many places: one of them is the first, the others are later copies as a whole.
    Other columns, whatever their names, stay as they are.

    ``digest=True``: instead id, n_bytes, n_removed, n_spans (maximal runs), kept_sha256.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    names = docs.columns
    keyed = _one_of_equals(docs.withColumns(_keys(text_col, id_col)))
    rows = keyed.filter("__copy IS NULL OR __copy = 'first'").select(F.col("__id").alias("id"), F.col("__rk").alias("rk"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = repeated_spans(rows, length, keep == "first")
    whole = F.coalesce(F.col("__copy") == "later", F.lit(False)) if keep == "first" else F.col("__copy").isNotNull()
    joined = keyed.join(spans.withColumnsRenamed({"id": "__id", "rk": "__rk", "spans": "__spans"}), ["__id", "__rk"], "left")
    # A text that goes as a whole is one span, beyond its end.
    joined = joined.withColumn("__spans", F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("s"), F.lit(1 << 62).cast("long").alias("e")))).otherwise(F.col("__spans"))).drop("__id", "__rk", "__copy")
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(raw: bytes, spans) -> tuple[bytes, list]:
        runs = [(s, min(e, len(raw))) for s, e in merge([(x["s"], x["e"]) for x in spans])] if len(raw) >= length else []
        edges = [0, *(v for run in runs for v in run), len(raw)]
        return b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)), runs

    def digested(batches):
        schema = None
        for b in slices(batches):
            schema = schema or pa.schema([pa.field("id", b.schema.field(0).type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
            out = []
            for i, text, spans in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                raw = (text or "").encode()
                kept, runs = cut(raw, spans or ())
                out.append((i, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            yield batch(schema, *zip(*out, strict=True))

    if digest:
        return joined.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "__spans").mapInArrow(digested, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)

    def texts(batches):
        schema = None
        for b in slices(batches):
            at = b.schema.get_field_index(text_col)
            schema = schema or pa.schema(list(b.schema)[:-1])
            column = b.column(at).to_pylist()
            for k, spans in enumerate(b.column(b.num_columns - 1).to_pylist()):
                if spans and column[k]:
                    column[k] = cut(column[k].encode(), spans)[0].decode("utf-8", "ignore")
            yield batch(schema, *[column if k == at else b.column(k) for k in range(b.num_columns - 1)])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.select(*names, "__spans").mapInArrow(texts, fields)


#: The query's rows by grouping every window of 200 bytes; used as an oracle on small tables.
REPEATS_SQL = """WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, n, p, md5(array_slice(b, p + 1, p + 200)) AS h FROM (SELECT doc_id, n, b, unnest(range(0, n - 199)) AS p FROM d)),
g AS (SELECT doc_id, p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM g)),
s AS (SELECT doc_id, min(p) AS s, max(p) + 200 AS e FROM i GROUP BY doc_id, run),
k AS (SELECT doc_id, list_sort(list([s, e])) AS spans, sum(e - s)::BIGINT AS gone FROM s GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(len(spans), 0)::BIGINT AS n_spans,
sha256(CASE WHEN spans IS NULL THEN b ELSE unhex(array_to_string(list_transform(range(0, len(spans) + 1), lambda j: hex(array_slice(b, CASE WHEN j = 0 THEN 1 ELSE spans[j][2] + 1 END, CASE WHEN j = len(spans) THEN n ELSE spans[j + 1][1] END))), '')) END) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""
