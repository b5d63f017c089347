"""Operators 5 and 9 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from priceloom.llm import bitslice, neighbours
from priceloom.llm.hilbert import hilbert_keys


def table(spark, n=1500, d=16):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[50:90] = x[3]  # equal vectors, queries among them
    x[7] = 2 * x[3]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5050, [None] * d, 1), (5100, [float("nan")] * d, 1), (5150, [0.0] * d, 1), (5200, [1.0], 1), (5250, [float("inf")] * d, 1), (None, x[0].tolist(), 1)]
    good = [(i, v) for i, v, _ in rows if i is not None and v and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(3), np.array([i for i, _ in good]), np.array([v for _, v in good], np.float32).astype(float)


def test_hilbert_curve_is_continuous():
    for d, b in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << b)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = hilbert_keys(cells, b)
        assert (np.sort(keys) == np.arange(len(cells))).all()
        assert (abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("block", [4096, 100])
def test_nearest(spark, block):
    df, ids, x = table(spark)
    on = np.abs(x).max(1) > 0
    ids, x = ids[on], x[on]
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 50 == 0, block=block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    queries = np.flatnonzero(ids % 50 == 0)
    assert set(got) == set(ids[queries])
    hit = 0
    n = np.sqrt((x * x).sum(1))
    for q in queries:
        s = (x * x[q]).sum(1) / (n * n[q])
        rows = sorted(got[ids[q]])
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5] and ids[q] not in {v for _, v, _ in rows}
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        for _, v, score in rows:
            assert score == s[np.flatnonzero(ids == v)[0]]
        want = [ids[j] for j in np.lexsort((ids, -s)) if j != q][:5]
        hit += len(set(want) & {v for _, v, _ in rows})
    assert hit / (5 * len(queries)) >= 0.9


def test_scaled_copies_tie_to_the_smaller_id(spark):
    """Different vectors of one direction: those scaled by powers of two tie, others differ by rounding."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2000, 16))
    ids = rng.permutation(2000)
    copies = rng.choice(2000, 400, replace=False)
    x[copies[:300]] = x[copies[0]] * 2.0 ** (np.arange(300) - 150)[:, None]
    x[copies[300:]] = x[copies[0]] * np.arange(3, 203, 2)[:, None]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, neighbours.nearest(df, F.col("id") % 20 == 0).collect()))
    n = np.sqrt((x * x).sum(1))
    want = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(1) / (n * n[q])
        want += [(ids[q], r + 1, ids[j], s[j]) for r, j in enumerate([j for j in np.lexsort((ids, -s)) if j != q][:5])]
    assert got == sorted(want)


@pytest.mark.parametrize("rows", [16_384, 200])
def test_top_k(spark, rows):
    df, ids, x = table(spark)
    z = np.floor(1024 * x).astype(np.int64)
    got = {}
    for r in bitslice.top_k(df, F.col("id") % 100 == 0, block_rows=rows).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    queries = np.flatnonzero(ids % 100 == 0)
    for q in queries:
        s = z @ z[q]
        want = [(k + 1, ids[j], s[j]) for k, j in enumerate([j for j in np.lexsort((ids, -s)) if j != q][:10])]
        assert sorted(got[ids[q]]) == want


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    none = spark.createDataFrame([], schema)
    assert neighbours.nearest(none, F.col("id") % 50 == 0).collect() == [] and bitslice.top_k(none, F.col("id") % 100 == 0).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 3.0])], schema)
    assert [tuple(r) for r in neighbours.nearest(few, F.col("id") % 50 == 0).orderBy("rank").collect()][0] == (0, 1, 1, 1.0)
    assert [tuple(r) for r in bitslice.top_k(few, F.col("id") % 100 == 0).orderBy("rank").collect()] == [(0, 1, 1, 1024 * 1024), (0, 2, 2, -1024 * 1024)]


def test_bit_slices_never_lose_a_row():
    rng = np.random.default_rng(3)
    for scale in (3, 300, 70_000):
        v = rng.integers(-scale, scale, (700, 9))
        block = bitslice.Block(v)
        for q in rng.integers(-scale, scale, (20, 9)):
            s = v @ q
            kept = block.candidates(q, 10)
            assert set(np.flatnonzero(s >= np.sort(s)[-10])) <= set(kept)


def test_scores_that_leave_64_bits_are_refused(spark):
    schema = "vec_id long, embedding array<double>"
    large = spark.createDataFrame([(0, [1e16, 1.0]), (1, [1e16, 2.0])], schema)
    with pytest.raises(ArithmeticError, match="64 bits"):
        bitslice.top_k(large, F.col("id") % 100 == 0)
    fits = spark.createDataFrame([(0, [1e5, 1.0]), (1, [1e5, 2.0]), (2, [-1e5, 0.5]), (3, None), (4, [float("nan"), 1.0])], schema)
    got = [tuple(r) for r in bitslice.top_k(fits, F.col("id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, (1024 * 10**5) ** 2 + 2 * 1024**2), (0, 2, 2, -((1024 * 10**5) ** 2) + 512 * 1024)]


def test_codes_bound_their_error():
    x = np.random.default_rng(2).normal(size=(200, 24))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    codes, scale, error = neighbours.encode(x)
    near = codes * scale[:, None]
    off = error[:, None] + error[None, :] * (1 + error[:, None])
    assert (np.abs(near @ near.T - x @ x.T) <= off + 1e-12).all() and error.max() < 0.02


@pytest.mark.parametrize("kept", [256, 3])
def test_windows_are_ranked_exactly(spark, monkeypatch, kept):
    """With one window over all rows the search is exact, whether rows are kept by codes or blocks are ranked by vectors."""
    monkeypatch.setattr(neighbours, "KEPT", kept)
    df, ids, x = table(spark, 300, 8)
    on = np.abs(x).max(1) > 0
    ids, x = ids[on], x[on]
    got = sorted(map(tuple, neighbours.nearest(df, F.col("id") % 50 == 0, curves=2, window_share=3.0, least_blocks=3).collect()))
    n, want = np.sqrt((x * x).sum(1)), []
    for q in np.flatnonzero(ids % 50 == 0):
        s = (x * x[q]).sum(1) / (n * n[q])
        want += [(ids[q], r + 1, ids[j], s[j]) for r, j in enumerate([j for j in np.lexsort((ids, -s)) if j != q][:5])]
    assert got == sorted(want)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    """The registered query, with its production parameters, against brute force: windows hold under a tenth of the rows."""
    from priceloom.llm import queries
    from tests.conftest import TESTDATA

    got = {}
    for r in queries.op5_nearest_neighbours(spark, f"{TESTDATA}/{sf}").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = spark.read.parquet(f"{TESTDATA}/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hit = asked = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = (x * x[q]).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((x[q] * x[q]).sum()))
        want = [ids[j] for j in np.lexsort((ids, -s)) if j != q][:5]
        hit, asked = hit + len(set(want) & got[ids[q]]), asked + 5
    assert hit / asked >= 0.9
