"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector is kept as the signs of its randomly rotated coordinates, packed, and two scalars: its
length and how well the signs point along it. With a query cut to a few bits per coordinate, inner
products are estimated from counts of common bits, and a bound on the estimate's error follows from
the correction scalars. Only vectors whose bound reaches the 20th best of those looked at already are
reranked, by the exact product.

Codes are built once, where vectors are scanned. Queries and vectors then meet in a grid of blocks, so memory is
bounded and every vector is a candidate for every query. What is shuffled grows with the number of vectors times that
of query blocks (and the other way round), so blocks are large and vectors travel packed, in their own precision.
Coarse cells would not do: where vectors have no direction in common, as in isotropic data, most cells must be probed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import blocks, materialize

K = 20
SEED = 20
QUERY_BITS = 5
#: Standard deviations of the estimate's error that the bound allows for; at 3 one pair in some hundreds lies beyond.
EPSILON = 3.0
#: Queries whose estimates are held at a time.
AT_A_TIME = 32
#: Rows of a block of vectors and of queries at most. Small tables are dealt to up to LEAST_BLOCKS of SMALL_BLOCK rows, to be searched side by side.
BLOCK_ROWS = 1 << 16
QUERY_ROWS = 1 << 14
LEAST_BLOCKS, SMALL_BLOCK = 8, 2048


@lru_cache(8)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """One-bit codes of a block of vectors: packed signs and two correction scalars each.

    ``scale`` is the vector's length over ``along``, the inner product of the unit vector and its unit code, which is
    near 0.8 for a random one.
    """

    def __init__(self, dim: int, packed: np.ndarray, scale: np.ndarray, along: np.ndarray):
        self.dim, self.packed, self.scale, self.along = dim, packed, scale, along
        self.words = packed.shape[1]
        self.ones = np.bitwise_count(packed).sum(1).astype(np.int64)

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        n, dim = vectors.shape
        rotated = vectors @ rotation(dim).T
        bits = np.zeros((n, -(-dim // 64) * 64), bool)
        bits[:, :dim] = rotated > 0
        length = np.linalg.norm(vectors, axis=1)
        along = np.abs(rotated).sum(1) / (np.sqrt(dim) * length)
        return cls(dim, np.packbits(bits, axis=1, bitorder="little").view(np.uint64), length / along, along)

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products, a row per query, and how far the truth may be from them."""
        dim, n = self.dim, len(queries)
        rotated = queries @ rotation(dim).T
        low = rotated.min(1, keepdims=True)
        width = np.maximum(np.ptp(rotated, axis=1, keepdims=True), 1e-300) / ((1 << QUERY_BITS) - 1)
        levels = np.zeros((n, self.words * 64), np.int64)
        levels[:, :dim] = np.rint((rotated - low) / width)
        common = np.zeros((n, len(self.scale)), np.int32)
        for b in range(QUERY_BITS):  # a plane of the queries' bits at a time
            plane = np.packbits(levels >> b & 1 > 0, axis=1, bitorder="little").view(np.uint64)
            for w in range(self.words):
                common += np.bitwise_count(self.packed[:, w] & plane[:, w, None]).astype(np.int32) << b
        # <code, query>, the code's signs being +-1 / sqrt(dim) and the query at its levels
        product = (2 * width * common + 2 * low * self.ones - width * levels.sum(1, keepdims=True) - low * dim) / np.sqrt(dim)
        spread = (1 - self.along**2).clip(0) / max(1, dim - 1) * (queries**2).sum(1, keepdims=True) + width**2 / 12
        return product * self.scale, EPSILON * self.scale * np.sqrt(spread)


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first coordinate to the last."""
    total = vectors[:, 0] * query[0]
    for d in range(1, vectors.shape[1]):
        total = total + vectors[:, d] * query[d]
    return total


def search_block(ids: np.ndarray, codes: Codes, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query, its k nearest of a block (ids, scores), nearest first, ties to smaller ids, without its own row.

    The 2 k best estimates are looked at exactly first; then everything whose bound reaches the k-th
    best of them. Of these, sums in the defined order are taken of what comes near the k best.
    """
    found = []
    for at in range(0, len(queries), AT_A_TIME):
        value, error = codes.estimate(queries[at : at + AT_A_TIME])
        for own_id, query, row, bound in zip(query_ids[at:], queries[at : at + AT_A_TIME], value, value + error, strict=False):
            own = ids == own_id
            row[own] = bound[own] = -np.inf
            if len(ids) > 2 * k:
                first = np.argpartition(row, len(row) - 2 * k)[len(row) - 2 * k :]
                reach = np.partition(vectors[first] @ query, k)[k]
                bound[first] = np.where(own[first], -np.inf, np.inf)
                chosen = np.flatnonzero(bound >= reach)
                rough = vectors[chosen] @ query  # in an order of its own: rounding may tell it from the exact sum
                if len(chosen) > k:
                    chosen = chosen[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9 * np.abs(rough).max()]
            else:
                chosen = np.flatnonzero(~own)
            scores = exact(vectors[chosen], query)
            order = np.lexsort((ids[chosen], -scores))[:k]
            found.append((ids[chosen][order], scores[order]))
    return found


def usable(vector: Column) -> Column:
    """Neither null, empty or zero nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def encoded(rows: DataFrame, kind: str) -> DataFrame:
    """Rows (id, v, asks) with each vector packed in its own precision, and its code and correction scalars."""
    schema = "id bigint, dim int, v binary, code binary, scale double, along double, asks boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                part = batch.take(pa.array(own))
                vectors = np.asarray(part.column(1).flatten()).reshape(len(own), dim).astype(kind) + 0.0  # no negative zeros: equal vectors are equal bytes
                codes = Codes.of(vectors.astype(float))
                packed = [pa.array([x.tobytes() for x in rows], pa.binary()) for rows in (vectors.astype(kind), codes.packed)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(own), dim, np.int32)), *packed, pa.array(codes.scale), pa.array(codes.along), part.column(2)], names=["id", "dim", "v", "code", "scale", "along", "asks"])

    return rows.mapInArrow(run, schema)


def _vectors(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(float)


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest other rows.

    Rows with a null key, or a vector that isn't `usable`, take no part; vectors of unlike length don't meet.
    Ties go to the smaller key. Repeats of a row count once; rows that share a query's key are its own, and rows
    of one key with unlike vectors are candidates each. Other columns, whatever their names, are left out; an
    empty table gives no row. Of equal vectors only the k + 1 smallest keys can be among the nearest; the
    others are put aside first, by a limit within the window that is applied before the shuffle too.
    """
    kind = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"
    array = F.col(vector) if kind == "<f4" else F.col(vector).cast("array<double>")
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), array.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    coded = materialize(encoded(rows.where(usable(F.col("v"))), kind), "vectors")
    same = Window.partitionBy("v", "dim").orderBy("id")
    base = materialize(coded.drop("asks").withColumn("copy", F.dense_rank().over(same)).where(F.col("copy") <= k + 1).drop("copy"), "vectors-apart")
    queries = coded.where("asks").select("id", "v", "dim")
    size = base.count()
    n_base, n_queries = max(blocks(size, block_rows), min(LEAST_BLOCKS, blocks(size, SMALL_BLOCK))), blocks(queries.count(), query_rows)

    def dealt(side: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        mark = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")
        return side.withColumn(own, mark).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    left = dealt(base, "b", n_base, "q", n_queries).groupBy("dim", "b", "q")
    right = dealt(queries, "q", n_queries, "b", n_base).groupBy("dim", "b", "q")

    def meet(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(own) and len(asked):
            own, asked = own.drop_duplicates(["id", "v"]), asked.drop_duplicates(["id", "v"])  # rows of one key are in one block
            ids, vectors = own["id"].to_numpy(), _vectors(own["v"], kind)
            packed = np.frombuffer(b"".join(own["code"]), np.uint64).reshape(len(own), -1)
            codes = Codes(vectors.shape[1], packed, own["scale"].to_numpy(), own["along"].to_numpy())
            query_ids = asked["id"].to_numpy()
            for q, (near, scores) in zip(query_ids, search_block(ids, codes, vectors, query_ids, _vectors(asked["v"], kind), k), strict=True):
                found.append((np.full(len(near), q), near, scores))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    met = left.cogroup(right).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of true (query_id, vec_id) pairs that were found."""
    return found.join(truth, ["query_id", "vec_id"], "left_semi").count() / max(1, truth.count())
