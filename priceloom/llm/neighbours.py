"""Approximate nearest neighbours: several shifted Hilbert orderings, range-partitioned; windows of neighbouring keys are merged and reranked."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import batch, materialize, mix64, slices
from priceloom.llm.hilbert import cosines, curve_keys, fit_curves, unit
from priceloom.session import ship_code

_RESULT = "query_id long, rank int, vec_id long, score double"


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column of equal lengths as a float64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def clean_vectors(vectors: DataFrame, id_col: str, vec_col: str, zero: bool) -> DataFrame:
    """(id, vec array<double>) of the rows that take part: id not null, all components finite, and, unless ``zero``, one that is not 0."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
    v = v.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return v if zero else v.filter(F.exists("vec", lambda x: x != 0))


def common_length(rows: DataFrame) -> int:
    """The most frequent vector length, the larger of equals; 0 for an empty table."""
    top = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0


#: Rows of a block that one query may keep by their codes; beyond it (mass ties) the block's vectors themselves are ranked.
KEPT = 256
#: Bits of a hash of the id that end a key, so that rows of one place on a curve do not make one block.
TIE_BITS = 12


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, error) of unit vectors: a byte per component, and the distance between a vector and its code."""
    scale = np.abs(x).max(1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(1))


def _entries(rows: DataFrame, is_query: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """(entries: vid, ids, vec, asked; queries: query_id, vid).  Equal vectors are one entry with their k + 1 smallest ids.

    Equal vectors are found by hashes, counted before they are shuffled; only vectors of such groups are grouped themselves, all others stay where they are.
    """
    hashes = {"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")}
    many = materialize(rows.withColumns(hashes).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2"), "ann-equal")
    alone = rows.withColumns(hashes).join(many, ["h1", "h2"], "left_anti")
    equal = materialize(rows.withColumns(hashes).join(many, ["h1", "h2"], "left_semi").select("id", "vec", is_query.alias("asked")).distinct(), "ann-equals")
    few = equal.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= k + 1)
    few = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    few = few.join(equal.filter("asked").select("vec").distinct().withColumn("asked", F.lit(True)), "vec", "left")
    few = materialize(few.select(F.col("ids")[0].alias("vid"), "ids", "vec", F.coalesce("asked", F.lit(False)).alias("asked")), "ann-folded")
    entries = alone.select(F.col("id").alias("vid"), F.array("id").alias("ids"), "vec", F.coalesce(is_query, F.lit(False)).alias("asked")).unionByName(few)
    entries = materialize(entries, "ann-entries")
    folded = equal.filter("asked").join(few.select("vid", "vec"), "vec").select(F.col("id").alias("query_id"), "vid")
    single = entries.filter("asked AND size(ids) = 1").join(few.select("vid"), "vid", "left_anti").select(F.col("vid").alias("query_id"), "vid")
    return entries, single.unionByName(folded)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, curves: int = 12, dims: int = 5, bits: int = 10, window_share: float = 0.09, block: int = 4096,
    sample: int = 4096, seed: int = 11, least_blocks: int = 1, most_blocks: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest cosines found for each row on which ``is_query`` (over ``id``) holds.

    Every row is indexed; only the curves' directions and quantiles are fitted, on the ``sample`` rows of smallest id hash.  Each of the ``curves`` orderings is
    cut by quantiles of all its keys into blocks of about ``block`` rows (``least_blocks`` to ``most_blocks`` of them; a table of one block is searched as a whole), and a query sees its own block and as
    many on both sides as hold ``window_share`` of all rows together.  A row goes to its block of each curve as a code of a byte per component; a query keeps
    the rows that the codes' error bounds leave among its best, what it kept on all curves is merged, and the rest is ranked by the vectors, which are
    fetched once.  So the result is the best of the windows exactly, whatever the codes.

    Equal vectors are one entry that keeps its k + 1 smallest ids, which is all that any query can be given of them, so a vector that a third
    of all rows share makes no hot block.  Rows with a null id, null vector, null or non-finite component, only zeros, or another
    length than most take no part.  Ties go to the smaller id.  Rows with the query's own id are no candidates.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = clean_vectors(vectors, id_col, vec_col, zero=False)
    size = common_length(rows)
    if not size:
        return spark.createDataFrame([], _RESULT)
    entries, asked = _entries(rows.filter(F.size("vec") == size), is_query, k)
    fitted = np.array([r["vec"] for r in entries.select("vid", "vec").orderBy(F.xxhash64("vid"), "vid").limit(sample).collect()])
    dims = min(dims, size)
    lines = fit_curves(unit(fitted), curves, dims, seed)

    def keys_of(ids: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        tie = (mix64(ids.astype(np.uint64)) >> np.uint64(64 - TIE_BITS)).astype(np.int64)
        return [curve_keys(x, line, bits) << TIE_BITS | tie for line in lines]

    def keyed(batches):
        schema = pa.schema([("curve", pa.int32()), ("key", pa.int64())])
        for b in slices(batches):
            for c, key in enumerate(keys_of(b.column(0).to_numpy(), unit(matrix(b.column(1), size)))):
                yield batch(schema, np.full(len(key), c, np.int32), key)

    blocks = min(most_blocks, max(least_blocks, -(-entries.count() // block)))
    reach = max(0, math.ceil((window_share * blocks - 1) / 2))
    marks = {c: np.zeros(0, np.int64) for c in range(curves)}
    if blocks > 1:
        cuts = F.percentile_approx("key", F.array(*[F.lit(i / blocks) for i in range(1, blocks)]), 20 * blocks)
        # As many numbers as curves times blocks: bounded by the parameters.
        found = entries.select("vid", "vec").mapInArrow(keyed, "curve int, key long").groupBy("curve").agg(cuts.alias("cuts")).collect()
        marks |= {r["curve"]: np.array(r["cuts"], np.int64) for r in found}

    def placed(batches):
        """kind 0: each row in its block of each curve; kind 1: each query in all blocks of its windows."""
        schema = pa.schema([("curve", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("vid", pa.int64()), ("code", pa.binary()), ("scale", pa.float64()), ("error", pa.float64())])
        for b in slices(batches):
            ids, x, is_asked = b.column(0).to_numpy(), unit(matrix(b.column(1), size)), b.column(2).to_numpy(zero_copy_only=False)
            codes, scale, error = encode(x)
            packed = [row.tobytes() for row in codes]
            who = np.flatnonzero(is_asked)
            for c, key in enumerate(keys_of(ids, x)):
                at = np.searchsorted(marks[c], key, side="right").astype(np.int32)
                yield batch(schema, np.full(len(ids), c, np.int32), at, np.zeros(len(ids), np.int32), ids, packed, scale, error)
                for step in range(-reach, reach + 1):
                    there = who[(at[who] + step >= 0) & (at[who] + step < blocks)]
                    if len(there):
                        yield batch(schema, np.full(len(there), c, np.int32), at[there] + np.int32(step), np.ones(len(there), np.int32), ids[there], [packed[i] for i in there], scale[there], error[there])

    def compare(batches):
        """(qvid, vid, lo, hi) of all that may be among a query's k + 1 best of a block; vid is null where these are more than KEPT."""
        schema = pa.schema([("curve", pa.int32()), ("block", pa.int32()), ("qvid", pa.int64()), ("vid", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64())])
        open_at, held, near, ids, error = None, [], None, None, None
        for b in slices(batches, 4 << 20):
            curve, where, kind, vid = (b.column(i).to_numpy() for i in range(4))
            code = np.frombuffer(b"".join(b.column(4).to_pylist()), np.int8).reshape(-1, size)
            scale, lost = b.column(5).to_numpy(), b.column(6).to_numpy()
            cuts = np.flatnonzero(np.diff(where) | np.diff(curve) | np.diff(kind)) + 1
            for a, z in zip([0, *cuts], [*cuts, len(where)], strict=True):
                if (curve[a], where[a]) != open_at:
                    open_at, held, near = (curve[a], where[a]), [], None
                if not kind[a]:
                    held.append((code[a:z], scale[a:z], lost[a:z], vid[a:z]))
                    continue
                if not held:
                    continue
                if near is None:
                    near = (np.concatenate([h[0] for h in held]).astype(np.float32) * np.concatenate([h[1] for h in held])[:, None].astype(np.float32)).T
                    error, ids = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
                for s in range(a, z, 64):
                    q = slice(s, min(z, s + 64))
                    close = ((code[q].astype(np.float32) * scale[q, None].astype(np.float32)) @ near).astype(np.float64)
                    # What codes, and sums in single precision, can be off by.
                    off = error[None, :] + lost[q, None] * (1 + error[None, :]) + size * 1e-6
                    m = min(close.shape[1], k + 1)
                    least = np.partition(close - off, close.shape[1] - m, axis=1)[:, close.shape[1] - m]
                    may = close + off >= least[:, None]
                    mass = may.sum(1) > KEPT
                    who, got = np.nonzero(may & ~mass[:, None])
                    most = np.flatnonzero(mass)
                    if len(who) + len(most):
                        n = len(who) + len(most)
                        lo, hi = (close - off)[who, got], (close + off)[who, got]
                        yield batch(
                            schema, np.full(n, curve[a], np.int32), np.full(n, where[a], np.int32), np.concatenate([vid[q][who], vid[q][most]]),
                            pa.array(np.concatenate([ids[got], np.zeros(len(most), np.int64)]), mask=np.concatenate([np.zeros(len(who), bool), np.ones(len(most), bool)])),
                            np.concatenate([lo, np.zeros(len(most))]), np.concatenate([hi, np.zeros(len(most))]),
                        )

    fields = "curve int, block int, kind int, vid long, code binary, scale double, error double"
    coded = entries.select("vid", "vec", "asked").mapInArrow(placed, fields).repartition("curve", "block").sortWithinPartitions("curve", "block", "kind")
    kept = materialize(coded.mapInArrow(compare, "curve int, block int, qvid long, vid long, lo double, hi double"), "ann-kept")
    pairs = kept.filter("vid IS NOT NULL").select("qvid", "vid", "lo", "hi")
    mass = kept.filter("vid IS NULL").select("curve", "block", "qvid")
    if not mass.isEmpty():
        pairs = pairs.unionByName(_ranked_blocks(entries, mass, keys_of, marks, size, k))
    # The same pair has the same bounds on every curve; a query's list is bounded by its windows' blocks times KEPT.
    pairs = pairs.groupBy("qvid", "vid").agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    least = pairs.groupBy("qvid").agg(F.coalesce(F.get(F.sort_array(F.collect_list("lo"), asc=False), F.lit(k)), F.lit(-2.0)).alias("least"))
    pairs = pairs.join(least, "qvid").filter("hi >= least").select("qvid", "vid")

    def scored(batches):
        schema = pa.schema([("qvid", pa.int64()), ("vid", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
        for b in slices(batches):
            yield batch(schema, *(b.column(i) for i in range(3)), cosines(matrix(b.column(3), size), matrix(b.column(4), size)))

    both = pairs.join(entries.select("vid", "ids", "vec"), "vid").join(entries.filter("asked").select(F.col("vid").alias("qvid"), F.col("vec").alias("qvec")), "qvid")
    found = both.select("qvid", "vid", "ids", "vec", "qvec").mapInArrow(scored, "qvid long, vid long, ids array<long>, score double")
    best = Window.partitionBy("qvid").orderBy(F.desc("score"), "vid")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    answers = asked.join(found, asked["vid"] == found["qvid"]).select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ranked_blocks(entries: DataFrame, mass: DataFrame, keys_of, marks: dict, size: int, k: int) -> DataFrame:
    """(qvid, vid, lo, hi) of the k + 1 best of blocks (``mass``: curve, block, qvid) by the vectors themselves, ties to the smaller id."""

    def placed(batches):
        schema = pa.schema([("curve", pa.int32()), ("block", pa.int32()), ("vid", pa.int64()), ("vec", pa.list_(pa.float64()))])
        for b in slices(batches):
            ids = b.column(0).to_numpy()
            for c, key in enumerate(keys_of(ids, unit(matrix(b.column(1), size)))):
                yield batch(schema, np.full(len(ids), c, np.int32), np.searchsorted(marks[c], key, side="right").astype(np.int32), ids, b.column(1))

    def rank(batches):
        schema = pa.schema([("qvid", pa.int64()), ("vid", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64())])
        slack, open_at, held, vids, vecs = (size + 16) * 2.0**-50, None, [], None, None
        for b in slices(batches, 4 << 20):
            curve, where, kind, vid = (b.column(i).to_numpy() for i in range(4))
            x = matrix(b.column(4), size)
            for i in range(len(vid)):
                if (curve[i], where[i]) != open_at:
                    open_at, held, vids = (curve[i], where[i]), [], None
                if not kind[i]:
                    held.append((vid[i], x[i]))
                    continue
                if vids is None:
                    vids, vecs = np.array([h[0] for h in held]), np.array([h[1] for h in held])
                score = cosines(np.broadcast_to(x[i], vecs.shape), vecs)
                best = np.lexsort((vids, -score))[: k + 1]
                yield batch(schema, np.full(len(best), vid[i]), vids[best], score[best] - slack, score[best] + slack)

    blocks = materialize(mass.select("curve", "block").distinct(), "ann-mass")
    every = entries.select("vid", "vec").mapInArrow(placed, "curve int, block int, vid long, vec array<double>").join(blocks, ["curve", "block"])
    queries = mass.join(entries.select(F.col("vid").alias("qvid"), "vec"), "qvid").select("curve", "block", F.lit(1).alias("kind"), F.col("qvid").alias("vid"), "vec")
    both = every.select("curve", "block", F.lit(0).alias("kind"), "vid", "vec").unionByName(queries).repartition("curve", "block").sortWithinPartitions("curve", "block", "kind")
    return both.mapInArrow(rank, "qvid long, vid long, lo double, hi double")
