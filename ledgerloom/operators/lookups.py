"""Joins against label lists, totals and populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import global_position, ordered_scan

def borrow_labels(df: DataFrame, lookup: DataFrame, code: str = "code", name: str = "name") -> DataFrame:
    """Canonical label of the code where the lookup has one, else the own label.

    The lookup is made unique first; of several labels the largest counts.
    """
    unique = lookup.where(F.col(name) != "").groupBy(F.col(code).alias("_code")).agg(F.max(name).alias("_label"))
    joined = df.join(unique, df[code] == unique["_code"], "left")
    return joined.withColumn(name, F.coalesce("_label", F.col(name))).drop("_code", "_label")


def detail_against_totals(
    details: DataFrame, totals: DataFrame, keys: list[str], tolerance: float = 1.00, value: str = "value"
) -> DataFrame:
    """Every total with the sum of its details (0 when there are none)."""
    sums = details.groupBy(*keys).agg(F.sum(value).alias("detail_sum"))
    return (
        totals.select(*keys, F.col(value).alias("expected"))
        .join(sums, keys, "left")
        .withColumn("detail_sum", F.coalesce("detail_sum", F.lit(0).cast("decimal(30,2)")))
        .withColumn("delta", F.col("detail_sum") - F.col("expected"))
        .withColumn("matched", F.abs("delta") <= F.lit(tolerance).cast("decimal(20,2)"))
    )


def next_year_pairs(df: DataFrame, keys: list[str], closing: str, opening: str, year: str = "year") -> DataFrame:
    """Closing of a year beside the opening of the next; gaps do not chain."""
    ends = df.where(F.col(closing).isNotNull()).select(*keys, year, closing)
    begins = df.where(F.col(opening).isNotNull()).select(*keys, (F.col(year) - 1).cast("int").alias(year), opening)
    return ends.join(begins, [*keys, year])


def per_capita(values: DataFrame, population: DataFrame, keys: list[str], keep_raw: bool, value: str = "value") -> DataFrame:
    """Value per resident.

    Without a population the raw value stays (``keep_raw``) or the row drops.
    """
    people = population.where(F.coalesce(F.col("residenti"), F.lit(0)) != 0).select(*keys, "residenti")
    joined = values.join(people, keys, "left" if keep_raw else "inner")
    raw = F.col(value).cast("double")
    return joined.withColumn("per_capita", F.coalesce(raw / F.col("residenti"), raw))


def compare_members(values: DataFrame, member: str, code: str, base: str, others: list[str], value: str = "value") -> DataFrame:
    """The base member's codes for every member, then codes only others have.

    Codes a member lacks are zero; ``share`` is of the member's own total. The
    alignment is codes x members from grouped rows, so it grows with the code
    list and never with the facts.
    """
    wanted = [base, *others]
    sums = (
        values.where(F.col(member).isin(*wanted))
        .groupBy(member, code)
        .agg(F.sum(value).cast("decimal(30,2)").alias(value))
    )
    axis = sums.groupBy(code).agg(F.max(F.col(member) == base).alias("in_base"))
    grid = axis.select(code, "in_base", F.explode(F.array(*[F.lit(m) for m in wanted])).alias(member))
    totals = sums.groupBy(member).agg(F.sum(value).cast("double").alias("_total"))
    aligned = grid.join(sums, [member, code], "left").join(totals, member, "left")
    amount = F.coalesce(F.col(value), F.lit(0).cast("decimal(30,2)"))
    base_total = F.when(F.coalesce("_total", F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("_total"))
    return aligned.select(
        member, code, "in_base", amount.alias(value), (amount.cast("double") / base_total * 100).alias("share")
    )


def longest_prefix(df: DataFrame, text: str, glossary: DataFrame, key: str = "prefix", label: str = "description") -> DataFrame:
    """Glossary entry with the longest prefix of the text; NULL when none fits.

    An as-of merge: glossary entries and distinct texts stand in one order, and
    the last entry at or before a text is carried to it. Whatever is a prefix of
    the text is a prefix of that entry too, so each entry brings along the
    entries that begin it, and the longest that begins the text counts. Of
    several labels for one prefix the largest counts; empty texts have none.
    """
    entries = glossary.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    begun = entries.select(
        "_key", F.explode(F.sequence(F.lit(0), F.length("_key"))).alias("_n")
    ).withColumn("_begin", F.expr("substring(_key, 1, _n)"))
    beginnings = entries.select(F.col("_key").alias("_begin"), "_label")
    chains = begun.join(beginnings, "_begin").groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("_n", "_begin", "_label")), asc=False).alias("_chain")
    )
    texts = df.where(F.length(text) > 0).select(F.col(text).alias("_key")).distinct()
    both = chains.withColumn("_is_text", F.lit(0)).unionByName(texts.withColumn("_is_text", F.lit(1)), allowMissingColumns=True)
    order = global_position(both, [F.col("_key").asc(), F.col("_is_text").asc()], out="_pos")
    merged = ordered_scan(order.withColumn("_all", F.lit(0)), ["_all"], "_pos", last={"_open": F.col("_chain")})
    fits = F.filter("_open", lambda e: F.startswith(F.col("_key"), e["_begin"]))
    own = merged.where(F.col("_is_text") == 1).select(F.col("_key").alias("_text"), F.get(fits, F.lit(0))["_label"].alias(label))
    return df.join(own, df[text] == own["_text"], "left").drop("_text")


def code_descriptions(df: DataFrame, code: Column, descriptions: DataFrame, code_col: str = "code") -> DataFrame:
    """Description of a normalised code; rows without one keep NULL."""
    keyed = df.withColumn("_code", code)
    own = descriptions.select(F.col(code_col).alias("_code"), "description")
    return keyed.join(own, "_code", "left").drop("_code")


def contract_budget_bridge(contracts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Contracts with the budget chapter their decisions name.

    A contract named with several chapters takes the smallest code, so the
    bridge never multiplies contracts.
    """
    chapter = pairs.where(F.col("capitolo_code").isNotNull()).groupBy("cig").agg(F.min("capitolo_code").alias("capitolo_code"))
    return contracts.join(chapter, "cig", "left")
