"""Entity names across sources: crosswalk, directory and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import canonical_entity
from ledgerloom.operators.facts import containing, limited


def canonicalize(df: DataFrame, raw: str, registry: list[tuple[str, str, str]]) -> DataFrame:
    """Add ``canonical_slug`` and ``canonical_name`` to a table of raw names."""
    slug, name = canonical_entity(F.col(raw), registry)
    return df.withColumns({"canonical_slug": slug, "canonical_name": name})


def entity_crosswalk(entities: DataFrame, entity_metrics: DataFrame) -> DataFrame:
    """Raw to canonical names of both sources, every pair once."""
    listed = entities.select("canonical_slug", "canonical_name", F.col("name").alias("raw_name"), F.lit("entities").alias("source"))
    valued = entity_metrics.select(
        "canonical_slug", "canonical_name", F.col("entity_name").alias("raw_name"), F.col("source")
    )
    return listed.unionByName(valued).distinct()


def entity_directory(entities: DataFrame, entity_metrics: DataFrame, statements: DataFrame) -> DataFrame:
    """One row per entity over three sources with its span of years."""
    rows = (
        entities.select("canonical_slug", "canonical_name", "entity_type", "year")
        .unionByName(entity_metrics.select("canonical_slug", "canonical_name", "year"), allowMissingColumns=True)
        .where(F.col("canonical_slug").isNotNull())
        .unionByName(
            statements.select(F.col("entity_slug").alias("canonical_slug"), F.col("entity_name").alias("canonical_name"), "year"),
            allowMissingColumns=True,
        )
    )
    return rows.groupBy("canonical_slug").agg(
        F.max("canonical_name").alias("canonical_name"),
        F.max("entity_type").alias("entity_type"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.countDistinct("year").alias("n_years"),
    )


def search_entities(entities: DataFrame, entity_metrics: DataFrame, query: str) -> DataFrame:
    """Entities whose raw or canonical name contains the text, in either source."""
    rows = entities.select("canonical_slug", "canonical_name", "entity_type", F.col("name").alias("raw")).unionByName(
        entity_metrics.select("canonical_slug", "canonical_name", F.col("entity_name").alias("raw")),
        allowMissingColumns=True,
    )
    hits = rows.where(
        F.col("canonical_slug").isNotNull() & (containing(F.col("raw"), query) | containing(F.col("canonical_name"), query))
    )
    return hits.groupBy("canonical_slug", "canonical_name").agg(F.max("entity_type").alias("entity_type"))


def search_all(metrics: DataFrame, entities: DataFrame, notes: DataFrame, limit: int | None = None) -> DataFrame:
    """The three result families in one tagged table, each cut to the limit.

    Inputs are the already matched rows with columns ``label``, ``year`` and
    ``value``; the order is newest first, then by label.
    """
    families = []
    for tag, rows in (("metric", metrics), ("entity", entities), ("note", notes)):
        order = [F.col("year").desc_nulls_last(), F.col("label").asc_nulls_last(), F.col("value").asc_nulls_last()]
        families.append(limited(rows.orderBy(*order), limit).select(F.lit(tag).alias("family"), "label", "year", "value"))
    return families[0].unionByName(families[1]).unionByName(families[2])
