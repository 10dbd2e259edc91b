"""Pages of a stored order: a page far down reads the ranges it lies in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import global_position

POSITION, RANGE = "_position", "_range"
WIDTH = 1 << 18  # positions per range


def write_ranked(df: DataFrame, order: list[Column], path: str, width: int = WIDTH) -> None:
    """Store a table by its position in an order, one folder per range of ``width`` positions.

    The order must tell all rows apart for the positions to be the same in
    every run. The sort is paid once; a page costs one or two ranges.
    """
    numbered = global_position(df, order, out=POSITION, start=0)
    ranges = numbered.withColumn(RANGE, F.floor(F.col(POSITION) / width).cast("bigint"))
    ranges.write.mode("overwrite").partitionBy(RANGE).parquet(path)


def ranked_page(spark: SparkSession, path: str, offset: int, limit: int, width: int = WIDTH) -> DataFrame:
    """Rows ``offset`` to ``offset + limit - 1`` of a stored order; empty past the end."""
    last = offset + limit - 1
    inside = F.col(RANGE).between(offset // width, last // width) & F.col(POSITION).between(offset, last)
    return spark.read.parquet(path).where(inside).orderBy(POSITION).drop(POSITION, RANGE)
