"""Helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import materialize

__all__ = ["ORACLE", "QUERIES", "bucket_count", "free_name", "map_batches", "materialize", "query", "table", "ranked_in_buckets"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder)`` under a query name, with its DuckDB text where there is one."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores in front until no column has it in any case."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name = "_" + name
    return name


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow``: one pass over Arrow batches inside each partition."""
    return df.mapInArrow(work, schema)


def bucket_count(rows: int) -> int:
    """Numbering buckets for a table of so many rows: the square root, so that buckets and rows in one grow alike."""
    return max(1, isqrt(rows))


def ranked_in_buckets(df: DataFrame, keys: list[str], order: list[str], rows: int, out: str) -> DataFrame:
    """Gapless numbers from 0 within ``keys``, also when one key holds most rows.

    Rows of a key are dealt to buckets by a hash of ``order``; each bucket is
    numbered by itself and shifted by the rows of the buckets before it. Only
    the counts per (key, bucket) meet in one window. Equal rows get different
    numbers; which of them gets which cannot be told apart.
    """
    from pyspark.sql import Window

    buckets = bucket_count(rows)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = dealt.withColumn("_within", F.row_number().over(within) - 1)
    if buckets == 1:
        return numbered.withColumn(out, F.col("_within").cast("long")).drop("_bucket", "_within")
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    joined = same_keys(numbered, starts, [*keys, "_bucket"])
    return joined.withColumn(out, (F.col("_start") + F.col("_within")).cast("long")).drop("_bucket", "_within", "_start")


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the right side's copies of the keys go."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on: Column | None = None
    for c in keys:
        one = left[c].eqNullSafe(renamed[f"_r_{c}"])
        on = one if on is None else on & one
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in keys])
