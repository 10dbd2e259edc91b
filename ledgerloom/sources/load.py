"""Loads: checksums, append of what is new, replacement of a scope, ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.checks import gate
from ledgerloom.operators.ordered import global_position, ordered_dedup
from ledgerloom.session import materialize


def composite_checksum(*columns: str) -> Column:
    """SHA-256 of several values, for sources that are not one file."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def file_checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SHA-256, size and name of every file of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("filename"), F.col("length"), F.sha2("content", 256).alias("checksum"))


def new_only(incoming: DataFrame, existing: DataFrame, order: str, key: str = "checksum") -> DataFrame:
    """Incoming rows whose key is not registered yet, each key once.

    Of several incoming rows with one key the first in ``order`` is kept.
    """
    fresh = incoming.join(existing.select(key).distinct(), key, "left_anti").select(*incoming.columns)
    return ordered_dedup(fresh, [key], order)


def replace_scope(existing: DataFrame, incoming: DataFrame, scope: list[str]) -> DataFrame:
    """Existing rows outside the incoming scopes, plus the incoming rows."""
    kept = existing.join(incoming.select(*scope).distinct(), scope, "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def write_scope(df: DataFrame, path: str, scope: list[str]) -> None:
    """Overwrite only the partitions of the scopes present in the data."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*scope)
        .parquet(path)
    )


def surrogate_ids(df: DataFrame, order: list[Column], existing: DataFrame | None = None, out: str = "id") -> DataFrame:
    """Consecutive ids in the given order, after the largest existing one."""
    last = existing.agg(F.max(out).alias("m")).first()["m"] if existing is not None else None
    return global_position(df, order, out=out, start=(last or 0) + 1)


def typed(df: DataFrame, schema: T.StructType, blank_is_null: tuple[str, ...] = ()) -> DataFrame:
    """Columns in schema order and type; listed text columns turn '' into NULL."""
    def column(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if field.name in blank_is_null:
            value = F.nullif(value, F.lit(""))
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def append_typed(df: DataFrame, path: str, schema: T.StructType, partition: str = "year", blank_is_null: tuple[str, ...] = ()) -> None:
    """Append long items to a table folder partitioned by year."""
    typed(df, schema, blank_is_null).write.mode("append").partitionBy(partition).parquet(path)


def gated_load(df: DataFrame, checks: DataFrame, path: str, scope: list[str]) -> bool:
    """Write the scope only when every check passed; tells whether it did."""
    if not gate(checks):
        return False
    write_scope(df, path, scope)
    return True


def observed_load(df: DataFrame, rules: dict[str, Column], path: str, scope: list[str]) -> dict[str, object]:
    """Load a scope in one pass over the input; the target changes only when every rule holds.

    ``rules`` are aggregates that give true or false over all rows (NULL, as on
    an empty input, counts as true). They are collected while the rows are
    written to a staging folder; if all hold, the staged rows replace the scope
    in the target. Returns the rules' outcomes and ``rows``.
    """
    seen = Observation(f"load-{uuid.uuid4().hex}")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[r.alias(n) for n, r in rules.items()])
    staged = materialize(watched, "staging")
    outcome = seen.get
    if all(outcome[n] is not False for n in rules):
        write_scope(staged, path, scope)
    return outcome


def audit_rows(rows: DataFrame, keys: list[str], pos: str, page: str, cells: str) -> DataFrame:
    """Raw rows as JSON objects with their page, one per row in position order.

    One object per row rather than one text per document: the audit file of a
    huge document is written by many tasks.
    """
    return rows.select(*keys, pos, F.to_json(F.struct(F.col(page).alias("page"), F.col(cells).alias("cells"))).alias("raw_json"))


def write_normalized(rows: DataFrame, path: str, document: list[str], columns: list[str]) -> None:
    """Normalized rows as CSV with titles, one folder per document; NULL is an empty field."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    placed = rows.select(*[F.col(d).alias(f"_{d}") for d in document], *texts)
    placed.write.mode("overwrite").partitionBy(*[f"_{d}" for d in document]).csv(path, header=True, emptyValue="", escape='"')


def write_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def availability(df: DataFrame, group: str, year: str = "year") -> DataFrame:
    """Sorted years present per group."""
    return df.select(group, year).distinct().groupBy(group).agg(F.sort_array(F.collect_list(year)).alias("years"))


def missing_members(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Expected members that the table does not have."""
    return expected.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")
