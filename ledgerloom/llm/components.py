"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize


def star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links (a, b) with a > b.

    Every node looks at its neighbours (the large step: all of them, the small
    step: itself and the smaller ones) and links the larger (or smaller) of
    them to the least. Least neighbours are partial aggregates joined back, so
    a node with most links is no single task.
    """
    seen = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        seen = seen.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = seen.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node that is not its component's least; links are two long columns a, b.

    Each round is written to the shared folder; the rounds follow the logarithm
    of the largest component's width.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state, mark = materialize(ordered.distinct(), "links"), None
    while True:
        state = materialize(star(materialize(star(state, True), "links"), False), "links")
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
