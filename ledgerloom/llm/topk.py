"""Exact top-k inner products in three phases with one threshold per query.

1. Every shard gives a local score list per query: its highest approximate
   scores (a product in single precision with a proven error bound), only so
   many that the lists of all shards together hold k. The k-th highest of what
   is gathered, less the error bound, is a safe cutoff: at least k scores are
   not below it.
2. The cutoffs go back to the shards with the query blocks, and each shard
   collects the entries whose score could reach the cutoff.
3. For these alone the integer score is computed exactly, and the k highest
   stay, ties to the smaller id.

Inputs: ids, vectors and components that are null, and components that are
not finite, take no part; equal vectors are candidates of their own; vectors
meet only vectors of their own length; scores that do not fit a long are held
at its ends; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, query, table
from ledgerloom.llm.vectors import against, opened, per_row, split_sets, usable

CHUNK = 512


def rough(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single-precision scores and, per query, a bound of their error."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = q.astype(np.float32) @ v.astype(np.float32).T
        largest = np.sqrt((v * v).sum(axis=1).max(initial=0.0))
        bound = np.sqrt((q * q).sum(axis=1)) * largest * (q.shape[1] + 4) * 2.0**-22
    return score, bound.astype(np.float32) * np.float32(1.001)


def exact(q: np.ndarray, v: np.ndarray) -> list[int]:
    """Integer inner products of paired rows, whatever their size."""
    if len(q) and max(np.abs(q).max(), 1) * max(np.abs(v).max(), 1) * q.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", q, v).astype(np.int64).tolist()
    low, high = -(1 << 63), (1 << 63) - 1
    return [max(low, min(high, sum(int(a) * int(b) for a, b in zip(x, y, strict=True)))) for x, y in zip(q, v, strict=True)]


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64, shard_rows: int = 8192, query_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score of every query's k highest integer inner products."""
    whole = F.transform("vector", lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    shards, queries, count = split_sets(usable(vectors).select("vec_id", whole.alias("vector")), every, shard_rows, query_rows)
    local = min(k, -(-k // count) + 4)

    def scored(row: dict):
        """Per chunk of queries: their ids and rows, and the bounds between which each score lies."""
        ids, v = opened(row)
        q_ids, q = opened(row, "q_")
        for at in range(0, len(q_ids), CHUNK):
            names = q_ids[at : at + CHUNK]
            score, bound = rough(q[at : at + CHUNK], v)
            low, high = score - bound[:, None], score + bound[:, None]
            low[~np.isfinite(low)], high[~np.isfinite(high)] = -np.inf, np.inf  # beyond single precision: left to phase 3
            own = ids[None, :] == names[:, None]
            low[own] = high[own] = -np.inf
            yield at, ids, v, names, q[at : at + CHUNK], low, high

    def lists(row: dict):
        for _, _, _, names, _, low, _ in scored(row):
            n = min(local, low.shape[1])
            best = np.partition(low, low.shape[1] - n, axis=1)[:, -n:].ravel().astype(float)
            real = np.isfinite(best)
            yield np.repeat(names, n)[real], best[real]

    pairs = against(shards, queries)
    pairs = pairs.repartition("block", "q_block")
    gathered = per_row(pairs, lists, "query_id long, low double", [pa.int64(), pa.float64()])
    best_first = Window.partitionBy("query_id").orderBy(F.desc("low"))
    cut = gathered.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= k)
    cut = cut.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("low")).alias("cutoff"))
    cut = materialize(cut, "cutoffs")

    # cutoffs travel as one packed row per query block, like the queries
    named = per_row(queries.select("block", "dim", "ids"), lambda r: [(ids := np.frombuffer(r["ids"], "<i8"), np.full(len(ids), r["block"]), np.full(len(ids), r["dim"]))],
                    "query_id long, q_block int, dim int", [pa.int64(), pa.int32(), pa.int32()])
    packed = named.join(cut, "query_id", "left").groupBy("q_block", "dim").agg(F.sort_array(F.collect_list(F.struct("query_id", F.coalesce("cutoff", F.lit(float("-inf"))).alias("cutoff")))).alias("c"))
    packed = packed.select("q_block", "dim", F.col("c.cutoff").alias("cutoffs"))

    def collect(row: dict):
        cutoffs = np.array(row["cutoffs"])
        for at, ids, v, names, q, _, high in scored(row):
            hit, of = np.nonzero((high >= cutoffs[at : at + len(names), None]) & (high > -np.inf))
            yield names[hit], ids[of], exact(q[hit], v[of])

    found = per_row(pairs.join(packed, ["q_block", "dim"]).repartition("block", "q_block"), collect, "query_id long, vec_id long, score long", [pa.int64()] * 3)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_TEXT = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op4_exact_topk", ORACLE_TEXT)
def op4_exact_topk(spark, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings", "vec_id", "embedding"))
