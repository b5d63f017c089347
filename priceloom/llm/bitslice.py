"""Exact top-k by inner product over a bit-sliced index.

The index holds blocks of rows.  A block stores, for each attribute, the quantised offset from the attribute's smallest value as bit slices: slice b is
a bitmap over the block's rows.  A query's weights are quantised too; the slices of every attribute are added with bitmap
arithmetic (carry-save adders), negative weights through the complement.  The k best rows of the quantised sum are selected from the most
significant slice downward; then every row whose quantised sum is within twice the error bound of the k-th is scored
exactly, so the result is exact whatever the quantisation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceloom.llm.common import batch, materialize, slices
from priceloom.llm.neighbours import clean_vectors, common_length, matrix
from priceloom.session import ship_code

#: Bits of a quantised attribute and of a quantised weight.
ATTRIBUTE_BITS, WEIGHT_BITS = 8, 7


def _shift(top: int, bits: int) -> int:
    return max(0, int(top).bit_length() - bits)


class Block:
    """The bit slices of a block of integer rows (n x d)."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.n, self.d = values.shape
        self.least = values.min(0)
        offset = values - self.least
        self.shift = _shift(offset.max(), ATTRIBUTE_BITS)
        u = (offset >> self.shift).astype(np.uint64)
        self.all = (1 << self.n) - 1
        self.slices = [[int.from_bytes(np.packbits((u[:, j] >> np.uint64(b)) & np.uint64(1) != 0, bitorder="little").tobytes(), "little") for b in range(ATTRIBUTE_BITS)] for j in range(self.d)]

    def sums(self, q: np.ndarray) -> tuple[list[int], float]:
        """Slices of the quantised score of every row, least significant first, and a bound on how far a row's exact score may lie from
        ``unit * sum`` plus a constant, in units of the sum."""
        t = _shift(np.abs(q).max(initial=0), WEIGHT_BITS)
        w = (np.abs(q) + ((1 << t) >> 1)) >> t
        columns: list[list[int]] = [[] for _ in range(ATTRIBUTE_BITS + WEIGHT_BITS + 2 + self.d.bit_length())]
        for j in np.flatnonzero(w):
            weight, own = int(w[j]), self.slices[j]
            if q[j] < 0:
                own = [self.all ^ s for s in own]
            b = 0
            while weight >> b:
                if weight >> b & 1:
                    for i, s in enumerate(own):
                        if s:
                            columns[i + b].append(s)
                b += 1
        out = []
        for p, column in enumerate(columns):
            while len(column) > 1:
                if len(column) > 2:
                    a, b, c = column.pop(), column.pop(), column.pop()
                    x = a ^ b
                    column.insert(0, x ^ c)
                    carry = a & b | x & c
                else:
                    a, b = column.pop(), column.pop()
                    column.append(a ^ b)
                    carry = a & b
                if carry:
                    if p + 1 == len(columns):
                        columns.append([])
                    columns[p + 1].append(carry)
            out.append(column[0] if column else 0)
        top = (1 << ATTRIBUTE_BITS) - 1
        lost = np.abs(np.abs(q) - (w << t)).sum() * (top / 2) * 2.0**self.shift  # weights rounded, offsets centred
        lost += np.abs(q).sum() * (2.0**self.shift - 1) / 2  # low bits of offsets dropped, centred
        return out, float(lost) / 2.0 ** (t + self.shift)

    def at_least(self, sums: list[int], floor: int) -> int:
        """Bitmap of rows whose sum is ``floor`` or more, compared from the most significant slice downward."""
        if floor <= 0:
            return self.all
        if floor >> len(sums):
            return 0
        more, same = 0, self.all
        for p in range(len(sums) - 1, -1, -1):
            if floor >> p & 1:
                same &= sums[p]
            else:
                more |= same & sums[p]
                same &= ~sums[p]
        return more | same

    def candidates(self, q: np.ndarray, k: int) -> np.ndarray:
        """Rows that can be among the k best: all within the error bound of the k-th best quantised sum."""
        if self.n <= k:
            return np.arange(self.n)
        sums, error = self.sums(q)
        kth, sure, maybe = 0, 0, self.all
        for p in range(len(sums) - 1, -1, -1):
            high = maybe & sums[p]
            if sure + high.bit_count() >= k:
                maybe, kth = high, kth | 1 << p
            else:
                sure += high.bit_count()
                maybe &= ~sums[p]
        bitmap = self.at_least(sums, kth - int(np.ceil(2 * error)) - 1)
        raw = np.frombuffer(bitmap.to_bytes((self.n + 7) // 8, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little", count=self.n))


def top_rows(block: Block, ids: np.ndarray, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    rows = block.candidates(q, k + int((ids == own).sum()))
    rows = rows[ids[rows] != own]
    score = block.values[rows] @ q
    best = np.lexsort((ids[rows], -score))[:k]
    return ids[rows][best], score[best]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, block_rows: int = 16_384, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row on which ``is_query`` (over ``id``) holds, the ``k`` rows of largest integer inner product.

    A component x counts as floor(scale * x).  Every block of the index meets every query, in blocks; each pair gives k rows at most, and
    a window by query merges them.  Ties go to the smaller id; rows with the query's own id are no candidates.  Rows with a null
    id, null vector, null or non-finite component or another length than most take no part; zero vectors do.  Components so large that a score could
    leave 64 bits raise an ArithmeticError before anything is computed.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = clean_vectors(vectors, id_col, vec_col, zero=True)
    size = common_length(rows)
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.filter(F.size("vec") == size)
    largest = rows.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0] * scale + 1
    if size * largest * largest >= 2.0**62:
        raise ArithmeticError(f"scores of components up to {largest:.3g} could leave 64 bits")

    def index(batches):
        """Blocks of up to ``block_rows`` rows of a partition."""
        part, made, ids, values, held = TaskContext.get().partitionId(), 0, [], [], 0
        schema = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("values", pa.binary())])

        def close():
            nonlocal made, ids, values, held
            i, v = np.concatenate(ids), np.concatenate(values)
            made, ids, values, held = made + 1, [], [], 0
            return batch(schema, [(part << 32) + made - 1], [i.astype("<i8").tobytes()], [v.astype("<i8").tobytes()])

        for b in slices(batches, 8 << 20, min(4096, block_rows)):
            ids.append(b.column(0).to_numpy())
            values.append(np.floor(matrix(b.column(1), size) * scale).astype(np.int64))
            held += len(ids[-1])
            if held + 4096 > block_rows:
                yield close()
        if held:
            yield close()

    def search(batches):
        """Rows arrive sorted by block, the block itself before its queries."""
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        block, ids = None, None
        for b in batches:
            for i in range(b.num_rows):
                kind, own, raw = b.column(1)[i].as_py(), np.frombuffer(b.column(2)[i].as_py(), "<i8"), b.column(3)[i].as_py()
                values = np.frombuffer(raw, "<i8").reshape(-1, size)
                if kind == 0:
                    block, ids = Block(values), own
                    continue
                found = [top_rows(block, ids, q, o, k) for q, o in zip(values, own, strict=True)]
                yield batch(schema, np.repeat(own, [len(f[0]) for f in found]), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))

    blocks = "block long, ids binary, values binary"
    # Dealt by a hash of the id, so that blocks are full and even; the number of partitions follows the number of rows.
    stored = materialize(rows.repartition(max(1, -(-rows.count() // block_rows)), "id").mapInArrow(index, blocks), "bsi-index")
    asked = rows.filter(is_query)
    packed = materialize(asked.repartition(max(1, -(-asked.count() // 64)), "id").mapInArrow(index, blocks), "bsi-queries")
    both = stored.select("block", F.lit(0).alias("kind"), "ids", "values").unionByName(_meet(packed, stored))
    both = both.repartition("block").sortWithinPartitions("block", "kind")
    found = both.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: Groups of index blocks, at most; a block of queries goes to each, and there to each of its blocks.
GROUPS = 256


def _meet(packed: DataFrame, stored: DataFrame) -> DataFrame:
    """A copy of every block of queries for each block of the index: the stated query set against all rows, in blocks.  Both sides are dealt by group, so
    neither is broadcast, whatever its estimated size."""
    groups = max(1, min(GROUPS, stored.count()))
    blocks = stored.select("block", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"))
    spread = packed.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "ids", "values")
    return spread.hint("merge").join(blocks, "group").select("block", F.lit(1).alias("kind"), "ids", "values")


#: The same scores by products of lists; used as an oracle on small tables.
TOP_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= 10"""
