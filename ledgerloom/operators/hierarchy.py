"""Sums, roll-ups and paths over the level-1 to leaf hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import compose_label

LEVEL_COLUMNS = ["liv1_code", "liv1_name", "liv2_code", "liv2_name", "liv3_code", "liv3_name"]


def hierarchy_sums(leaves: DataFrame) -> DataFrame:
    """Value per level-3 node; missing levels form a node of their own."""
    return leaves.groupBy(*LEVEL_COLUMNS).agg(F.sum("value").alias("value"))


def hierarchy_rollup(leaves: DataFrame) -> DataFrame:
    """Totals of every node from the root to level 3 with their share of the root.

    ``depth`` tells a subtotal from a node whose level is missing.
    """
    sums = leaves.groupBy("liv1_code", "liv2_code", "liv3_code").agg(F.sum("value").alias("value"))
    nodes = sums.rollup("liv1_code", "liv2_code", "liv3_code").agg(
        (F.lit(3) - F.bit_count(F.grouping_id())).cast("int").alias("depth"), F.sum("value").alias("value")
    )
    root = sums.agg(F.sum("value").cast("double")).scalar()
    return nodes.withColumn("root_share", F.try_divide(F.col("value").cast("double") * 100, root))


def leaf_paths(leaves: DataFrame, missing: str = "—") -> DataFrame:
    """Positive leaves with the labels of the path down to them."""
    return leaves.where(F.col("value") > 0).select(
        compose_label(F.col("liv1_code"), F.col("liv1_name")).alias("level1"),
        F.coalesce("liv2_name", F.lit(missing)).alias("level2"),
        F.coalesce("liv3_name", F.lit(missing)).alias("level3"),
        compose_label(F.col("capitolo_code"), F.col("denominazione")).alias("leaf"),
        "value",
    )


def hierarchy_series(leaves: DataFrame) -> DataFrame:
    """Yearly value of the selected leaf or level, with one of its labels."""
    return leaves.groupBy("year").agg(F.sum("value").alias("value"), F.max("denominazione").alias("denominazione"))


def hierarchy_items(leaves: DataFrame, level: str = "capitolo") -> DataFrame:
    """Selectable leaves or level-3 nodes across all years."""
    code, name = ("liv3_code", "liv3_name") if level == "liv3" else ("capitolo_code", "denominazione")
    picked = leaves.where(F.col(code).isNotNull()) if level == "liv3" else leaves
    return picked.groupBy(F.col(code).alias("code")).agg(F.max(name).alias("name"))


def rollup_to_parent(df: DataFrame, keys: list[str], measures: list[str], total_name: str, order: str | None = None) -> DataFrame:
    """Child rows summed to their parent code, long, plus a grand total per measure.

    Parents that are zero in every measure are left out; the grand total is
    the sum of all of them and stands also where it is zero. A parent's name is
    that of its first row in ``order``; without one, the largest.
    """
    label = F.min_by("name", order) if order else F.max("name")
    sums = df.groupBy(*keys, "code").agg(label.alias("name"), *[F.sum(m).alias(m) for m in measures])
    some = None
    for m in measures:
        test = F.coalesce(F.col(m), F.lit(0)) != 0
        some = test if some is None else some | test
    long = sums.withColumn("_some", some).unpivot([*keys, "code", "name", "_some"], measures, "measure", "value")
    items = long.where("_some").select(*keys, F.lit("voce").alias("level"), "code", "name", "measure", "value")
    totals = long.groupBy(*keys, "measure").agg(F.sum("value").alias("value")).select(
        *keys,
        F.lit("totale").alias("level"),
        F.lit(None).cast("string").alias("code"),
        F.lit(total_name).alias("name"),
        "measure",
        F.col("value").cast("decimal(30,2)"),
    )
    return items.withColumn("value", F.col("value").cast("decimal(30,2)")).unionByName(totals)


def unfold_matrix_row(df: DataFrame, keys: list[str], cells: str, codes: list[str], group: int, measures: dict[int, str]):
    """Wide total row of ``group`` columns per code to long items and grand totals.

    ``measures`` names the columns kept of every group. After the code columns
    the row carries one column that is skipped and then the grand totals.
    """
    width = len(codes) * group
    code_at = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.expr(f"cell_pos div {group}") + 1).cast("int"))
    long = df.select(*keys, F.posexplode(cells).alias("cell_pos", "value"))
    items = long.where(F.col("cell_pos") < width).select(*keys, code_at.alias("code"), (F.col("cell_pos") % group).alias("slot"), "value")
    totals = long.where((F.col("cell_pos") > width) & (F.col("cell_pos") <= width + group)).select(
        *keys, F.lit(None).cast("string").alias("code"), (F.col("cell_pos") - width - 1).alias("slot"), "value"
    )
    name = None
    for slot, measure in measures.items():
        name = F.when(F.col("slot") == slot, measure) if name is None else name.when(F.col("slot") == slot, measure)
    both = items.withColumn("level", F.lit("voce")).unionByName(totals.withColumn("level", F.lit("totale")))
    named = both.withColumn("measure", name).where(F.col("measure").isNotNull())
    live = named.where(F.col("value") != 0).select(*keys, F.col("code").alias("_code"), F.col("level").alias("_level")).distinct()
    same = (named["level"] == live["_level"]) & named["code"].eqNullSafe(live["_code"])
    for k in keys:
        same = same & named[k].eqNullSafe(live[k])
    kept = named.where(F.col("level") == "totale").unionByName(
        named.where(F.col("level") == "voce").join(live, same, "left_semi")
    )
    return kept.select(*keys, "level", "code", "measure", "value")
