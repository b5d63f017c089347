"""Operators 2 and 10 against plain Python."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from priceloom.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(out.values())
        share = {s: w[s] * left / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
        free -= over
    return out


def _docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(0, 90))), rng.choice(["a", "b", "b", "b", "b", "b", "B", "ß", None, ""])) for i in range(600)]
    rows += [(600, None, "a"), (601, " \x0b ", "b"), (None, "null id", "b"), (5, "again five", "b"), (5, "again five", "b"), (602, "w " * 4000, "zz"), (603, None, "only")]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, target int, shards int").repartition(4)


def test_mix(spark):
    rows, docs = _docs(spark)
    sized = docs.select("doc_id", "text", "source", mixing.word_count(F.col("text")).alias("size"))
    out = mixing.mix_sources(sized)
    got = out.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = water_fill(sizes)
    taken = Counter()
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        assert len(r.shards) >= -(-r.taken // r.size) if r.size else True
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.mix_sources(sized.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    emitted = mixing.emit_copies(out, ["doc_id", "text", "source"]).collect()
    words = Counter()
    for r in emitted:
        words[r.source] += len(WORD.findall(r.text))
    assert words == Counter({s: n for s, n in taken.items() if n})


def test_copies_lie_in_their_shards_in_order(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, "w " * rng.randrange(1, 90), rng.choice("abc")) for i in range(600)], "doc_id long, text string, source string").repartition(3)
    mixed = mixing.materialize(mixing.mix_sources(docs.withColumn("size", mixing.word_count(F.col("text"))), shards=4), "test-mixed")
    rows = {r.doc_id: r for r in mixed.collect()}
    ranges = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    dealt = mixing.emit_copies(mixed, docs.columns, shards=4)
    assert dealt.columns == docs.columns
    got, order = {}, {}
    for r in dealt.withColumn("at", F.spark_partition_id()).collect():
        got.setdefault(r.doc_id, []).append(r.at // ranges)
        order.setdefault(r.at, []).append(rows[r.doc_id].order_key)
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(r.shards) for i, r in rows.items() if r.taken}
    assert all(x == sorted(x) for x in order.values()) and len({s for x in got.values() for s in x}) == 4
    for s in range(4):  # ranges follow each other, so a shard is in order from its first partition to its last
        runs = [order.get(s * ranges + k, []) for k in range(ranges)]
        assert (flat := [k for run in runs for k in run]) == sorted(flat)


def test_splitting_tree_is_exact(spark):
    _, docs = _docs(spark)
    units = docs.select(F.lit(False).alias("__null"), F.coalesce("source", F.lit("")).alias("__src"), F.lit(1).alias("__copy"), F.col("doc_id").cast("string").alias("__block"))
    n = Counter(r["__shard"] for r in mixing.split_units(units, 8, 1).collect())
    assert max(n.values()) - min(n.values()) <= 1 and len(n) == 8


def test_mix_empty(spark):
    none = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix_sources(none).collect() == []


def test_shards(spark):
    rows, docs = _docs(spark)
    tree = sharding.even_tree(16)
    got = sharding.shard_documents(docs, tree, sharding.grow(tree, 16)).collect()
    assert len(got) == len(rows)
    of = {}
    slots = {}
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
        assert of.setdefault(r.doc_id, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_weights_confine_moves(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "k")
    tree = {0: {0: {0: 1.0, 1: 1.0}, 1: {2: 1.0, 3: 1.0}}, 1: {2: {4: 2.0, 5: 1.0}}}
    less = {0: {0: {0: 1.0, 1: 1.0}, 1: {2: 1.0, 3: 1.0}}, 1: {2: {4: 2.0, 5: 0.0}}}
    rows = sharding.assign(sharding.assign(ids, tree, ["k"], "a"), less, ["k"], "b").groupBy("a", "b").count().collect()
    n = Counter()
    for r in rows:
        n[r.a] += r["count"]
        # Only the region whose weight fell loses rows; inside the other region nothing moves between racks.
        assert r.a == r.b or r.a in (4, 5)
        assert r.b != 5
    assert abs(n[4] / 40_000 - 2 / 7) < 0.02 and abs(n[0] / 40_000 - 1 / 7) < 0.02


def test_shards_empty(spark):
    tree = sharding.even_tree(16)
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string"), tree, sharding.grow(tree, 16)).collect() == []


def test_shards_of_brute_force(spark, monkeypatch):
    """Each row's shard, grown shard and slot recomputed from the draws; repeated rows, null ids and many cells change nothing."""
    import hashlib
    import math

    monkeypatch.setattr(sharding, "COPIES", 3)
    monkeypatch.setattr(sharding, "CELL_ROWS", 20)
    rng = random.Random(8)
    rows = [(i, "t" * rng.randrange(9)) for i in range(300)] + [(7, "seven")] * 50 + [(7, "other")] * 2 + [(None, "n")] * 5 + [(None, None)] * 4
    tree = sharding.even_tree(16)
    grown = sharding.grow(tree, 16)
    number = lambda *parts: int(hashlib.md5(":".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16)

    def pick(i, level, weights):
        return min((-math.log((number(i, level, n) + 0.5) / 2**52) / w, n) for n, w in weights.items())[1]

    def shard(i, t):
        region = pick(i, "region", {r: sum(sum(s.values()) for s in k.values()) for r, k in t.items()})
        rack = pick(i, "rack", {k: sum(s.values()) for k, s in t[region].items()})
        return pick(i, "shard", t[region][rack])

    want, at = [], Counter()
    keyed = [(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows]
    for i, crc, n in sorted(keyed, key=lambda r: (number(*r), r[0] is not None, r[0] or 0, r[1:])):
        s = shard(i, tree)
        want.append((i, n, crc, "key", s, at[s], shard(i, grown)))
        at[s] += 1
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, slot int").repartition(3)
    got = sharding.shard_documents(docs, tree, grown)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_clashing_columns(spark):
    """Columns that have the operator's names: replaced in the table of takings, kept in the mix itself."""
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice("abc"), f"t{i}", i, 1.5, "s", "Order", 9) for i in range(200)] + [(None, None, None, "x", 0, 0.0, "y", "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target string, size long, taken double, shards string, Order_Key string, source_size int")
    mixed = mixing.mix_sources(docs.withColumn("size", mixing.word_count(F.col("text"))))
    assert mixed.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken", "shards", "order_key"]
    plain = mixing.mix_sources(docs.select("doc_id", "text", "source").withColumn("size", mixing.word_count(F.col("text"))))
    assert sorted(map(str, mixed.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    by = {r[0]: r for r in rows}
    for r in out.collect():
        own = by[r.doc_id]
        assert (r.source, r.target, r["size"], r.taken, r.shards, r.Order_Key, r.source_size) == own[2:]
        assert own[1].startswith(r.text) and r.text
    assert sum(len(WORD.findall(r.text)) for r in out.collect()) == sum(r.taken for r in plain.collect())
