"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (DataFrame functions only).

1.  Targets: sources share the total size by weight; a target stops at ``most`` times its source's size and the excess is shared
    again by weight among the others.  Solved in one pass: with sources sorted by cap / weight, those capped are a prefix.
2.  Quotas: a source gives ``floor(target / size)`` whole copies of every document and, for the rest, a run of its permuted blocks.  A
    document's place in the permutation is the MD5 of its id; the first two hex digits are its block, the next two its sub-block.
    Block totals are summed before any row moves, so only the documents of the one sub-block in which a quota ends are ordered by row.
3.  Splitting tree: each (source, copy, block) that is drawn is a unit; units are permuted by a hash.  Every node of a binary tree over the output shards
    gives the first half of its permuted units to the left, so the counts per source on the left are a multivariate-hypergeometric draw, quotas
    stay exact, and shards get disjoint blocks.  A unit's place in the permutation tells its path, so the levels are arithmetic.
    ``order_key`` shuffles inside a shard.

The unit table holds sources x 256 x (most + 1) rows at most, whatever the number of documents; it is ranked in 256 ranges of the hash.  Sources
themselves, a row each, are solved in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["__null", "__src"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(df: DataFrame, id_col: str, source_col: str) -> DataFrame:
    place = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return df.withColumns({
        "__null": F.col(source_col).isNull(), "__src": F.coalesce(F.col(source_col), F.lit("")), "__place": place,
        "__block": F.substring(place, 1, 2), "__sub": F.substring(place, 3, 2),
    })


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per source (null last): source_size, target, whole copies of each document, and the words still wanted."""
    one = Window.partitionBy()
    by_ratio = Window.partitionBy().orderBy(F.col("__cap") / F.col("__w"), *_KEY)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(Window.orderBy(*_KEY)) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sized.groupBy(*_KEY).agg(F.sum("size").alias("source_size"))
    s = s.withColumn("__w", weight).withColumns({"__cap": (F.col("source_size") * most).cast("double"), "__total": F.sum("source_size").over(one).cast("double")})
    s = s.withColumns({
        "__cap_before": F.coalesce(F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "__w_from": F.sum("__w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
    })
    s = s.withColumn("__capped", F.col("__cap") * F.col("__w_from") <= F.col("__w") * (F.col("__total") - F.col("__cap_before")))
    s = s.withColumns({
        "__left": F.col("__total") - F.coalesce(F.sum(F.when(F.col("__capped"), F.col("__cap"))).over(one), F.lit(0.0)),
        "__w_left": F.sum(F.when(~F.col("__capped"), F.col("__w"))).over(one),
    })
    s = s.withColumn("target", F.when(F.col("__capped"), F.col("__cap")).otherwise(F.col("__w") * F.col("__left") / F.col("__w_left")))
    words = F.floor(F.col("target") + 0.5).cast("long")
    copies = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("int")
    return s.select(*_KEY, "source_size", "target", copies.alias("copies"), (words - copies * F.col("source_size")).alias("__want"))


def _runs(cells: DataFrame, outer: list[str], cell: str, want: str) -> DataFrame:
    """Cells of a permutation, each with the words wanted from it: all up to where ``want`` ends, part of one, none after."""
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*outer).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cells.withColumn("__get", F.greatest(F.lit(0), F.least(F.col("__n"), F.col(want) - before)))


def split_units(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """Deal units to ``shards`` (a power of two) output shards by the splitting tree; adds ``__shard``."""
    name = ["__null", "__src", "__copy", "__block"]
    units = units.withColumn("__at", F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in name])))
    units = units.withColumn("__range", F.substring("__at", 1, 2))
    ranges = units.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    in_order = Window.partitionBy().orderBy("__range")  # 256 rows at most
    ranges = ranges.select("__range", F.sum("__n").over(in_order).alias("__upto"), "__n", F.sum("__n").over(Window.partitionBy()).alias("__size"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy("__at", *name))
    units = units.join(ranges, "__range").withColumn("__rank", F.col("__upto") - F.col("__n") + inside - 1).withColumn("__shard", F.lit(0))
    for _ in range(shards.bit_length() - 1):
        left = F.floor((F.col("__size") + 1) / 2)
        right = F.col("__rank") >= left
        units = units.withColumns({"__shard": F.col("__shard") * 2 + right.cast("int"), "__rank": F.when(right, F.col("__rank") - left).otherwise(F.col("__rank")), "__size": F.when(right, F.col("__size") - left).otherwise(left)})
    return units.drop("__at", "__range", "__upto", "__n", "__size", "__rank")


def mix_sources(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, shards: int = 16, seed: int = 17, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``sized`` (any columns, with ``size``) and, for each row: source_size, target, taken, shards (of each copy, the partial one last), order_key.

    ``taken`` is the number of words that the mix takes of the row, repeats counted: whole copies, and for the one document in which a
    source's quota ends a part of one more.  Each source's sum is its target rounded to a word.  Null and empty sources are two sources.
    Rows of size 0 take 0 words and go along with their block.  Repeated ids are taken independently.  Reruns agree.  The five columns replace
    columns of ``sized`` that have their names (in any case), except for ``size``, which it must have.
    """
    if shards & (shards - 1) or shards < 1:
        raise ValueError("shards must be a power of two")
    made = ["source_size", "target", "taken", "shards", "order_key"]
    own = [c for c in sized.columns if c.lower() not in made]
    rows = _keyed(sized.select(*own), id_col, source_col)
    sources = source_targets(rows, weights, most)
    subs = rows.groupBy(*_KEY, "__block", "__sub").agg(F.sum("size").alias("__n"))
    subs = materialize(subs.select(*_KEY, "__block", "__sub", "__n"), "mix-cells")
    blocks = subs.groupBy(*_KEY, "__block").agg(F.sum("__n").alias("__n")).join(sources, _KEY)
    blocks = _runs(blocks, _KEY, "__block", "__want").withColumn("__part", (F.col("__get") > 0) & (F.col("__get") < F.col("__n")))
    blocks = materialize(blocks.select(*_KEY, "__block", "__n", "source_size", "target", "copies", "__get", "__part"), "mix-blocks")
    drawn = blocks.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies") + F.when(F.col("__get") > 0, 1).otherwise(0)))).filter(F.col("__copy") > 0)
    drawn = drawn.filter(F.col("copies") + F.when(F.col("__get") > 0, 1).otherwise(0) > 0)
    dealt = split_units(drawn.select(*_KEY, "__copy", "__block"), shards, seed).groupBy(*_KEY, "__block").agg(F.transform(F.array_sort(F.collect_list(F.struct("__copy", "__shard"))), lambda x: x["__shard"]).alias("shards"))
    ends = _runs(subs.join(blocks.filter("__part").select(*_KEY, "__block", F.col("__get").alias("__of_block")), [*_KEY, "__block"]), [*_KEY, "__block"], "__sub", "__of_block")
    ends = ends.select(*_KEY, "__block", "__sub", F.col("__get").alias("__of_sub"), ((F.col("__get") > 0) & (F.col("__get") < F.col("__n"))).alias("__cut"))
    # Written down, so that Spark knows how small they are: rows then meet them where they lie.
    ends = materialize(ends, "mix-ends")
    plan = materialize(blocks.join(dealt, [*_KEY, "__block"], "left"), "mix-plan")
    rows = rows.join(plan.select(*_KEY, "__block", "source_size", "target", "copies", "__get", "__part", "shards"), [*_KEY, "__block"]).join(ends, [*_KEY, "__block", "__sub"], "left")
    cut = F.coalesce(F.col("__cut"), F.lit(False))
    # Only rows of a sub-block in which a quota ends are ordered one by one.
    whole = rows.filter(~cut).withColumn("__extra", F.when(F.col("__part"), F.when(F.col("__of_sub") > 0, F.col("size")).otherwise(0)).otherwise(F.when(F.col("__get") > 0, F.col("size")).otherwise(0)))
    inside = Window.partitionBy(*_KEY, "__block", "__sub").orderBy("__place", "size").rowsBetween(Window.unboundedPreceding, -1)
    ended = rows.filter(cut).withColumn("__extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("__of_sub") - F.coalesce(F.sum("size").over(inside), F.lit(0)))))
    out = whole.unionByName(ended).withColumn("taken", (F.col("copies") * F.col("size") + F.col("__extra")).cast("long"))
    out = out.withColumn("shards", F.slice(F.coalesce("shards", F.array().cast("array<int>")), 1, F.col("copies") + F.when(F.col("__extra") > 0, 1).otherwise(0)))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "__place")), 1, 15), 16, 10).cast("long")
    return out.withColumn("order_key", key).select(*own, *made)


def emit_copies(mixed: DataFrame, columns: list[str], text_col: str = "text", shards: int = 16) -> DataFrame:
    """The mix itself: ``columns`` of each taken row once per copy, the last copy cut to the words taken of it (white space between words stays).

    Copies lie where the splitting tree has dealt them: each of the ``shards`` of :func:`mix_sources` is a run of partitions of its own, each
    partition a range of ``order_key`` in its order, so that a shard is shuffled as a whole.
    """
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    part = F.concat_ws("", F.slice(F.regexp_extract_all(F.col(text_col), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), F.greatest(rest, F.lit(1))))
    rows = mixed.withColumns({"__whole": whole, "__rest": rest}).filter("taken > 0")
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__whole") + F.when(F.col("__rest") > 0, 1).otherwise(0))))
    rows = rows.withColumn(text_col, F.when(F.col("__copy") <= F.col("__whole"), F.col(text_col)).otherwise(part))
    rows = rows.withColumns({"__shard": F.get("shards", F.col("__copy") - 1), "__order": F.col("order_key")}).select(*columns, "__copy", "__shard", "__order")
    # As many ranges of a shard as give the session's number of partitions; the key is a hash, so ranges of equal width are even.
    ranges = -(-int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    at = F.floor(F.shiftright("__order", 28) * ranges / (1 << 32)).cast("int")
    dealt = rows.repartitionById(shards * ranges, F.col("__shard") * ranges + at)
    return dealt.sortWithinPartitions("__order", "__copy").select(*columns)


def mix_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The mix of ``docs``: its columns, whatever their names, of each taken row once per copy, laid in shards as :func:`emit_copies` says."""
    rest = [c for c in docs.columns if c != text_col]
    carried = docs.select(F.struct(*rest).alias("__row"), F.col(id_col).alias("__doc"), F.col(source_col).alias("__from"), F.col(text_col).alias("text"), word_count(F.col(text_col)).alias("size"))
    mixed = mix_sources(carried, shards=shards, id_col="__doc", source_col="__from", **how)
    out = emit_copies(mixed, ["__row", "text"], shards=shards)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in docs.columns])


def query_columns(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What the query shows of :func:`mix_sources`; the shards of a row's copies are one text."""
    return mixed.select(id_col, "size", "source_size", "target", "taken", F.array_join("shards", ",").alias("shards"), "order_key")


#: The same result by plain window sums; used as an oracle.
MIX_SQL = re.sub(r"\n\s*", "\n", r"""
WITH d AS (SELECT doc_id, source IS NULL AS sn, coalesce(source, '') AS sk,
       coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, 'null')) AS place FROM documents),
s0 AS (SELECT sn, sk, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
s1 AS (SELECT *, ((row_number() OVER (ORDER BY sn, sk) - 1) % 3 + 1)::DOUBLE AS w, (3 * source_size)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS total FROM s0),
s2 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, sn, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
       sum(w) OVER (ORDER BY cap / w, sn, sk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wf FROM s1),
s3 AS (SELECT *, cap * wf <= w * (total - before) AS capped FROM s2),
s4 AS (SELECT *, total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS rest, sum(CASE WHEN NOT capped THEN w END) OVER () AS wl FROM s3),
s5 AS (SELECT sn, sk, source_size, CASE WHEN capped THEN cap ELSE w * rest / wl END AS target FROM s4),
s6 AS (SELECT *, floor(target + 0.5)::BIGINT AS words, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS copies FROM s5),
r AS (SELECT d.doc_id, d.size, d.sn, d.sk, d.place, s6.source_size, s6.target, s6.copies, s6.words - s6.copies * s6.source_size AS want,
      coalesce(sum(d.size) OVER (PARTITION BY d.sn, d.sk ORDER BY d.place, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN s6 ON d.sn = s6.sn AND d.sk = s6.sk),
q AS (SELECT sn, sk, copies, want, b, n, coalesce(sum(n) OVER (PARTITION BY sn, sk ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT sn, sk, substr(place, 1, 2) AS b, sum(size) AS n FROM d GROUP BY ALL) JOIN (SELECT sn, sk, copies, words - copies * source_size AS want FROM s6) USING (sn, sk)),
u AS (SELECT sn, sk, b, unnest(range(1, (copies + CASE WHEN least(n, want - before) > 0 THEN 1 ELSE 0 END + 1)::BIGINT)) AS copy FROM q),
t0 AS (SELECT *, 0 AS shard, row_number() OVER (ORDER BY md5(concat_ws(':', '17', sn::VARCHAR, sk, copy::VARCHAR, b)), sn, sk, copy, b) - 1 AS k, count(*) OVER () AS z FROM u),
t1 AS (SELECT sn, sk, b, copy, shard * 2 + CASE WHEN k >= (z + 1) // 2 THEN 1 ELSE 0 END AS shard, CASE WHEN k >= (z + 1) // 2 THEN k - (z + 1) // 2 ELSE k END AS k, CASE WHEN k >= (z + 1) // 2 THEN z - (z + 1) // 2 ELSE (z + 1) // 2 END AS z FROM t0),
t2 AS (SELECT sn, sk, b, copy, shard * 2 + CASE WHEN k >= (z + 1) // 2 THEN 1 ELSE 0 END AS shard, CASE WHEN k >= (z + 1) // 2 THEN k - (z + 1) // 2 ELSE k END AS k, CASE WHEN k >= (z + 1) // 2 THEN z - (z + 1) // 2 ELSE (z + 1) // 2 END AS z FROM t1),
t3 AS (SELECT sn, sk, b, copy, shard * 2 + CASE WHEN k >= (z + 1) // 2 THEN 1 ELSE 0 END AS shard, CASE WHEN k >= (z + 1) // 2 THEN k - (z + 1) // 2 ELSE k END AS k, CASE WHEN k >= (z + 1) // 2 THEN z - (z + 1) // 2 ELSE (z + 1) // 2 END AS z FROM t2),
t4 AS (SELECT sn, sk, b, list(shard * 2 + CASE WHEN k >= (z + 1) // 2 THEN 1 ELSE 0 END ORDER BY copy) AS dealt FROM t3 GROUP BY ALL),
e AS (SELECT r.*, least(size, want - before) > 0 AS part, coalesce(dealt, []) AS dealt FROM r LEFT JOIN t4 ON r.sn = t4.sn AND r.sk = t4.sk AND substr(r.place, 1, 2) = t4.b)
SELECT doc_id, size, source_size, target, (copies * size + greatest(0, least(size, want - before)))::BIGINT AS taken,
       array_to_string(dealt[1:copies + CASE WHEN part THEN 1 ELSE 0 END], ',') AS shards, ('0x' || substr(md5(concat_ws(':', '17', place)), 1, 15))::BIGINT AS order_key FROM e
""").strip()
