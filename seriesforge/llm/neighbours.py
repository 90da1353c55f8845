"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector's offset from the mean is rotated at random and kept as one bit per dimension, packed, with two scalars: the
length of the offset and how well the bits point along it. The rotated query's products with a shard's bits, unpacked
to signs there, are one product of matrices; the scalars turn them into estimates of the inner products with a bound on
the error. Only vectors whose upper bound reaches the current k-th best score are compared exactly.

Queries and rows meet in a grid: queries in blocks of ``QUERY_BLOCK``, rows in shards of about ``SHARD_ROWS``; each
cell returns k rows per query, and the cells' results are merged. Every row is indexed; the mean is taken over all rows.

Defined results: vectors that are NULL, empty, zero, hold NULL or non-finite components, or have another dimension than
most (of equally frequent ones the smallest) take no part, nor do rows without vec_id. Identical rows count once;
different vectors of one vec_id are one item, as near as the nearest of them. Ties go to the smaller vec_id. With fewer
than k candidates all are returned; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import per_batch, prepare, stored

NEAREST = 20
ONE_QUERY_IN = 20
#: Width of the error bound in standard deviations of the estimate: one true neighbour in 700 may lie beyond.
EPSILON = 3.0
#: Rows of best estimate that set the score to reach, for each neighbour asked for.
LEAD = 10
SEED = 20
QUERY_BLOCK = 4096
SHARD_ROWS = 16384
#: Queries of a block that are looked at together, and pairs compared together.
_TILE = 128
_PAIRS = 16384
#: More than single precision may lose of an inner product, relative to the lengths.
_ROUNDING = 1e-5


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector): the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("vector")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    ).distinct()
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["n"] if sizes else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def mean_of(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and their mean; each batch is summed first."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = _matrix(batch.column(0)).sum(axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(range(len(sums)), pa.int32()), pa.array(sums), pa.array([batch.num_rows] * len(sums), pa.int64())], names=["i", "total", "n"]
        )

    sums = per_batch(rows.select("vector"), work, "i int, total double, n bigint").groupBy("i").agg(F.sum("total"), F.sum("n")).orderBy("i").collect()
    return (sums[0][2], np.array([t for _, t, _ in sums]) / sums[0][2]) if sums else (0, np.zeros(0))


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits (uint64 words) and the scalars: offset length, alignment."""
    n, d = vectors.shape
    offset = vectors - mean
    length = np.linalg.norm(offset, axis=1)
    turned = (offset / np.where(length > 0, length, 1)[:, None]) @ turn
    bits = turned > 0
    align = np.abs(turned).sum(axis=1) / np.sqrt(d)
    return _pack(bits), np.stack([length, np.where(length > 0, align, 1.0)], axis=1)


def _pack(bits: np.ndarray) -> np.ndarray:
    n, d = bits.shape
    wide = np.zeros((n, -(-d // 64) * 64), bool)
    wide[:, :d] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def build_index(rows: DataFrame, mean: np.ndarray, seed: int = SEED) -> DataFrame:
    """(vec_id, code, length, align, vector) for every row."""
    turn = rotation(len(mean), seed)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, scalars = encode(_matrix(batch.column("vector")), mean, turn)
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary()), *[pa.array(s) for s in scalars.T], batch.column("vector")],
            names=["vec_id", "code", "length", "align", "vector"],
        )

    schema = "vec_id bigint, code binary, length double, align double, vector array<double>"
    return per_batch(rows.select("vec_id", "vector"), work, schema)


def exact(a_columns: np.ndarray, b_columns: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (a, b), added up dimension by dimension."""
    total = np.zeros(len(a))
    for x, y in zip(a_columns, b_columns):
        total += x[a] * y[b]
    return total


def _signs(codes: np.ndarray, d: int) -> np.ndarray:
    """The packed bits as -1 and 1."""
    return np.unpackbits(codes.view(np.uint8), axis=1, count=d, bitorder="little").astype(np.float32) * 2 - 1


class _Queries:
    """Rotated queries."""

    def __init__(self, vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray):
        self.turned = (vectors @ turn).astype(np.float32)
        self.norm = np.linalg.norm(vectors, axis=1).astype(np.float32)
        self.with_mean, self.mean_norm = (vectors @ mean).astype(np.float32), np.linalg.norm(mean)

    def estimates(self, tile: slice, codes: np.ndarray, scalars: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner product of each query of the tile with each coded vector, and the most it can be."""
        d = self.turned.shape[1]
        length, align = (x.astype(np.float32) for x in scalars.T)
        dot = self.turned[tile] @ _signs(codes, d).T
        dot *= length / (align * np.float32(np.sqrt(d)))
        dot += self.with_mean[tile][:, None]
        spread = np.sqrt(np.maximum(1 - align**2, 0)) / align / np.float32(np.sqrt(max(d - 1, 1)))
        above = length * epsilon * spread + _ROUNDING * (length + self.mean_norm)
        return dot, dot + self.norm[tile][:, None] * above.astype(np.float32)


def _single(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (q, r) in single precision, some pairs at a time."""
    out = np.empty(len(q), np.float32)
    for a in range(0, len(q), _PAIRS):
        some = slice(a, a + _PAIRS)
        out[some] = np.einsum("ij,ij->i", queries[q[some]], rows[r[some]])
    return out


def search_cell(queries: pa.Table, rows: pa.Table, mean: np.ndarray, turn: np.ndarray, k: int, epsilon: float) -> dict[str, np.ndarray]:
    """The k nearest rows of one shard for each query of one block.

    Of ``LEAD`` times k rows of best estimate the k-th best score is one that the true k-th best can't fall short of,
    so only vectors whose upper bound reaches it are compared with the query: in single precision first, and those
    that its rounding leaves open exactly. Queries count with length 1 and rows relative to the longest up to there.
    """
    q_ids, q_vectors = queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"))
    r_ids, r_vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"))
    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), "<u8").reshape(len(r_ids), -1)
    scalars = np.stack([rows.column(c).to_numpy() for c in ("length", "align")], axis=1)
    unit = q_vectors / np.linalg.norm(q_vectors, axis=1)[:, None]
    r_norm = np.linalg.norm(r_vectors, axis=1)
    longest = r_norm.max()
    scalars[:, 0] /= longest
    coded = _Queries(unit, mean / longest, turn)
    q_single, r_single = unit.astype(np.float32), (r_vectors / longest).astype(np.float32)
    slack = (_ROUNDING * r_norm / longest).astype(np.float32)
    q_columns, r_columns = np.ascontiguousarray(q_vectors.T), np.ascontiguousarray(r_vectors.T)
    own_items = len(np.unique(r_ids)) == len(r_ids)
    leads = min(LEAD * k, len(r_ids) - 2)
    found = []
    for a in range(0, len(q_ids), _TILE):
        tile = slice(a, min(a + _TILE, len(q_ids)))
        size = tile.stop - a
        estimate, most = coded.estimates(tile, codes, scalars, epsilon)
        own = q_ids[tile][:, None] == r_ids
        estimate[own] = most[own] = -np.inf
        reach = np.full(size, -np.inf, np.float32)
        if own_items and leads >= k:
            lead = np.argpartition(estimate, len(r_ids) - leads, axis=1)[:, -leads:]
            least = _single(q_single, r_single, np.repeat(np.arange(a, tile.stop), leads), lead.ravel()).reshape(size, leads) - slack[lead]
            reach = np.partition(least, leads - k, axis=1)[:, leads - k]
        qi, ri = np.nonzero((most >= reach[:, None]) & ~own)
        near = _single(q_single, r_single, a + qi, ri) + slack[ri] >= reach[qi]
        qi, ri = qi[near], ri[near]
        found.append((a + qi, r_ids[ri], exact(q_columns, r_columns, a + qi, ri)))
    q, r, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-score, r, q))  # an item counts once, at its best
    q, r, score = q[order], r[order], score[order]
    once = np.append(True, (np.diff(q) != 0) | (np.diff(r) != 0))[: len(q)]
    q, r, score = q[once], r[once], score[once]
    order = np.lexsort((r, -score, q))
    q, r, score = q[order], r[order], score[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return {"query_id": q_ids[q[best]], "vec_id": r[best], "score": score[best]}


def nearest(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    one_query_in: int = ONE_QUERY_IN,
    k: int = NEAREST,
    epsilon: float = EPSILON,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row whose id is divisible by ``one_query_in``."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    n, mean = mean_of(rows)
    index = stored(build_index(rows, mean, seed), "codes") if n else None
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = rows.where(F.pmod("vec_id", F.lit(one_query_in)) == 0)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    shards = max(1, -(-n // SHARD_ROWS))
    # Both sides are dealt by hash of the id, so that no block or shard grows with a frequent vector.
    dealt = lambda m: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(m)).cast("int")
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.select(dealt(blocks).alias("block"), numbers(shards).alias("shard"), "vec_id", "vector")
    right = index.select(numbers(blocks).alias("block"), dealt(shards).alias("shard"), *index.columns)
    turn = rotation(len(mean), seed)

    def cell(queries, candidates):
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.table(search_cell(queries, candidates, mean, turn, k, epsilon))

    found = (
        left.groupBy("block", "shard")
        .cogroup(right.groupBy("block", "shard"))
        .applyInArrow(cell, "query_id bigint, vec_id bigint, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """A query has at most k rows from each shard; they are ranked together."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
