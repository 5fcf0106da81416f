"""Exact top-k inner-product search by tiled matrix products.

Queries are dealt out to tiles and all vectors to shards by hash. Both hold up to TILE_BYTES of numbers, so that a
vector is copied once for every TILE_BYTES of queries and a query once for every TILE_BYTES of vectors; where all
vectors fit in fewer shards than the session has cores, shards are smaller. Each pair of a tile and a shard is one matrix
product in one task, from which the best k of every query are selected. These short lists are merged
in a tree: within groups of shards, then over the groups. Products of whole numbers are exact in double precision
below 2**53, which is checked for each pair; beyond that they are made with unbounded integers.

Defined results: vectors that are null, or hold null or non-finite components, and rows without an id take no part;
rows that repeat id and vector count once, an id with several vectors counts for each of them, as a query and as a candidate; vectors are only compared with vectors of their own length; a score
beyond the range of a long becomes the nearest long; a query that is alone has no rows; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TILE_BYTES, LEAST_ROWS = 32 << 20, 2048
#: Scores that a task holds at once.
SCORES = 1 << 22
SCHEMA = "query_id long, vec_id long, score long, shard int"


def _matrix(column: pa.ChunkedArray, scale: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = (flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat).flatten()
    return np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(column), -1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products, as doubles where that is safe, else clamped to longs."""
    most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1])
    if most < 2**53:
        return q @ c.T
    as_int = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    big = as_int(q) @ as_int(c).T
    return np.array([[min(max(x, -(2**63)), 2**63 - 1) for x in row] for row in big], object)


def best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of each query's k best of this shard; ties to the smaller id."""
    out: list[tuple] = []
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    step = max(1, SCORES // max(1, len(c)))
    for at in range(0, len(q_ids), step):
        ids, score = q_ids[at : at + step], products(q[at : at + step], c)
        other = ids[:, None] != c_ids[None]
        if score.dtype == object:
            for i, d in enumerate(ids):
                js = sorted(np.flatnonzero(other[i]), key=lambda j: (-score[i, j], c_ids[j]))[:k]
                out += [(d, c_ids[j], score[i, j]) for j in js]
            continue
        score = np.where(other, score, -np.inf)
        if score.shape[1] > k:
            least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
            row, col = np.nonzero((score >= least[:, None]) & other)
        else:
            row, col = np.nonzero(other)
        value = score[row, col]
        by = np.lexsort((c_ids[col], -value, row))
        row, col, value = row[by], col[by], value[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < k
        out += zip(ids[row[keep]].tolist(), c_ids[col[keep]].tolist(), value[keep].astype(np.int64).tolist(), strict=True)
    return tuple(np.array([x[i] for x in out], np.int64) for i in range(3))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, tile: int | None = None, shard: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each query (vec_id, embedding) its k best of vectors (vec_id, embedding).

    tile and shard are rows; left out, they follow from TILE_BYTES.
    """
    fit = lambda df: df.where("vec_id is not null and embedding is not null").where(F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))).select("vec_id", "embedding").distinct()
    all_, asked = common.written(fit(vectors), "topk-vectors"), common.written(fit(queries), "topk-queries")
    n, dims = all_.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).head()
    most = max(1, TILE_BYTES // (8 * max(1, dims)))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    tiles = max(1, -(-asked.count() // (tile or most)))
    shards = max(1, -(-n // (shard or min(most, max(LEAST_ROWS, -(-n // cores))))))
    dim = F.size("embedding").alias("dim")
    number = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = asked.select("vec_id", "embedding", dim, number(tiles).alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    right = all_.select("vec_id", "embedding", dim, F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), number(shards).alias("shard"))

    def pair(key: tuple, q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            found = (np.zeros(0, np.int64),) * 3
        else:
            ids = [t.column("vec_id").to_numpy() for t in (q, c)]
            found = best(ids[0], _matrix(q.column("embedding"), scale), ids[1], _matrix(c.column("embedding"), scale), k)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2], "shard": np.full(len(found[0]), key[2].as_py(), np.int32)})

    keys = ["dim", "tile", "shard"]
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, SCHEMA)
    wide = 32
    while shards > wide:
        lists = _merge(lists.withColumn("shard", (F.col("shard") / wide).cast("int")), ["query_id", "shard"], k)
        shards = -(-shards // wide)
    return _merge(lists, ["query_id"], k).select("query_id", "rank", "vec_id", "score")


def _merge(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


OP9_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
