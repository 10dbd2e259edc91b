"""Open-data exports: datasets to files, with an index that describes them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_dataset(df: DataFrame, folder: str, name: str, formats: list[str], only_if_rows: bool = False) -> list[str]:
    """Write a dataset as folders of JSON lines and/or CSV; returns what was written.

    Files stay one per task: nothing is gathered into a single writer. An
    optional dataset without rows writes nothing.
    """
    if only_if_rows and df.isEmpty():
        return []
    written = []
    for fmt in formats:
        path = f"{folder}/{name}.{fmt}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.json(path)
        written.append(path)
    return written


def export_index(datasets: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Row count and file names of every dataset."""
    rows = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(",".join(f"{name}.{f}" for f in formats)).alias("files")
        )
        for name, (df, formats) in datasets.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def export_crosswalk(crosswalk: DataFrame, path: str) -> None:
    """Crosswalk as CSV, sorted by slug, source and raw name."""
    crosswalk.orderBy("canonical_slug", "source", "raw_name").write.mode("overwrite").option("header", True).csv(path)
