"""Vectors in packed blocks: the shared ground of exact and approximate search.

A block is one row with the ids and the components of some thousand vectors,
so that a task works on matrices. Candidates are dealt to shards by a hash of
their id; queries lie in blocks too, and a pair of a candidate shard and a
query block is one row of a keyed join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, materialize

BLOCK = "block int, dim int, ids binary, vectors binary"


def usable(rows: DataFrame, zero: bool = True) -> DataFrame:
    """(vec_id, vector as doubles) of rows that take part: id and vector not null, every component finite.

    ``zero`` tells whether a vector of zeros takes part.
    """
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select("vec_id", v.alias("vector")).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad)
    return kept if zero else kept.filter(F.exists("vector", lambda x: x != 0))


def blocks(rows: DataFrame, count: int) -> DataFrame:
    """Pack (vec_id, vector) into ``count`` blocks by a hash of the id; vectors of other lengths make blocks of their own."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        ids = group.column("vec_id").to_numpy().astype("<i8").tobytes()
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in group.column("vector").chunks])
        first = [group.column(c)[0].as_py() for c in ("block", "dim")]
        return pa.table({"block": pa.array([first[0]], pa.int32()), "dim": pa.array([first[1]], pa.int32()), "ids": [ids], "vectors": [flat.astype("<f8").tobytes()]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")).withColumn("dim", F.size("vector"))
    return dealt.groupBy("block", "dim").applyInArrow(pack, BLOCK)


def opened(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The ids and the matrix of one packed block."""
    ids = np.frombuffer(row[f"{prefix}ids"], "<i8")
    return ids, np.frombuffer(row[f"{prefix}vectors"], "<f8").reshape(len(ids), -1)


def against(shards: DataFrame, queries: DataFrame) -> DataFrame:
    """Every shard beside every query block of the same dimension.

    The number of query blocks is a stated query set cut into blocks; a shard
    is repeated once per block and meets it by key.
    """
    numbered = queries.select(F.col("dim").alias("q_dim"), F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    known = queries.groupBy("dim").agg(F.collect_list("block").alias("q_blocks"))
    repeated = shards.join(known, "dim").withColumn("q_block", F.explode("q_blocks")).drop("q_blocks")
    on = (repeated["dim"] == numbered["q_dim"]) & (repeated["q_block"] == numbered["q_block"])
    return repeated.join(numbered, on).drop(numbered["q_block"]).drop("q_dim")


def per_row(df: DataFrame, work, schema: str, types: list[pa.DataType]) -> DataFrame:
    """One packed row in, columns of any length out."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for columns in work({c: batch.column(c)[k].as_py() for c in batch.schema.names}):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return map_batches(df, run, schema)


def split_sets(vectors: DataFrame, every: int, shard_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """Stored candidate shards, stored query blocks, and the number of shards."""
    vectors = materialize(vectors, "vectors")
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    queries = vectors.filter(F.col("vec_id") % every == 0)
    query_blocks = max(1, -(-(n // every + 1) // query_rows))
    return materialize(blocks(vectors, shards), "shards"), materialize(blocks(queries, query_blocks), "query-blocks"), shards
