"""Shares, changes, rankings and pivots over yearly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import global_position


def share_of_total(
    df: DataFrame, code: str, exclude: list[str] | None = None, net_base: bool = False, value: str = "value", year: str = "year"
) -> DataFrame:
    """Percent share of each row in its year's total.

    Excluded codes leave the result; the base is the full total, or with
    ``net_base`` the total without them. A zero total gives share 0. Totals are
    grouped and joined back, so a hot year is never one window task.
    """
    kept = df.where(~F.col(code).isin(*exclude)) if exclude else df
    totals = (kept if net_base else df).groupBy(F.col(year).alias("_year")).agg(
        F.sum(value).cast("double").alias("year_total")
    )
    shared = kept.join(totals, kept[year] == totals["_year"]).drop("_year")
    ratio = F.col(value).cast("double") / F.col("year_total") * 100
    return shared.withColumn("share", F.when(F.coalesce("year_total", F.lit(0.0)) == 0, 0.0).otherwise(ratio))


def shares_of_totals(df: DataFrame, code: str, exclude: list[str], value: str = "value", year: str = "year") -> DataFrame:
    """Both shares of ``share_of_total``, ``gross_share`` and ``net_share``, from one grouping."""
    counted = ~F.col(code).isin(*exclude)
    totals = df.groupBy(F.col(year).alias("_year")).agg(
        F.sum(value).cast("double").alias("gross_share"), F.sum(F.when(counted, F.col(value))).cast("double").alias("net_share")
    )
    shared = df.where(counted).join(totals, F.col(year) == totals["_year"]).drop("_year")
    ratio = lambda total: F.when(F.coalesce(F.col(total), F.lit(0.0)) == 0, 0.0).otherwise(F.col(value).cast("double") / F.col(total) * 100)
    return shared.withColumns({c: ratio(c) for c in ("gross_share", "net_share")})


def yoy_delta(df: DataFrame, keys: list[str], value: str = "value", year: str = "year") -> DataFrame:
    """Percent change on the previous calendar year, by the previous magnitude.

    NULL where the previous year is missing, NULL or zero.
    """
    prior = df.select(*keys, (F.col(year) + 1).cast("int").alias(year), F.col(value).alias("prior_value"))
    joined = df.join(prior, [*keys, year], "left")
    change = F.col(value).cast("double") - F.col("prior_value").cast("double")
    return joined.withColumn("delta_pct", F.try_divide(change, F.abs(F.col("prior_value").cast("double"))) * 100)


def first_last_variation(df: DataFrame, keys: list[str], value: str = "value", year: str = "year") -> DataFrame:
    """Change from the first to the last year of a series; 0 % from zero."""
    ends = df.groupBy(*keys).agg(
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.min_by(value, year).cast("double").alias("first_value"),
        F.max_by(value, year).cast("double").alias("last_value"),
    )
    delta = F.col("last_value") - F.col("first_value")
    pct = F.when(F.coalesce("first_value", F.lit(0.0)) == 0, 0.0).otherwise(delta / F.col("first_value") * 100)
    return ends.withColumns({"delta": delta, "delta_pct": pct})


def rank_by_latest(df: DataFrame, series: str, value: str = "value", year: str = "year") -> DataFrame:
    """Series ranked by their value in the last year of the table.

    Series without a value in that year follow, in order of their name.
    """
    marked = df.withColumn("_latest", df.agg(F.max(year)).scalar())
    per_series = marked.groupBy(series).agg(F.max(F.when(F.col(year) == F.col("_latest"), F.col(value))).alias("latest_value"))
    order = [F.col("latest_value").desc_nulls_last(), F.col(series).asc()]
    return global_position(per_series, order, out="rank")


def missing_years(df: DataFrame, available: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Years of the catalogue that a series does not have.

    Each key meets the catalogue's sorted list of years, one short array.
    """
    years = available.select(year).distinct().agg(F.sort_array(F.collect_list(year))).scalar()
    present = df.select(*keys, year).distinct().groupBy(*keys).agg(F.collect_list(year).alias("_have"))
    gaps = present.withColumn("_all", years)
    return gaps.select(*keys, F.explode(F.array_except("_all", "_have")).alias(year))


def latest_years(df: DataFrame, keys: list[str], n: int = 2, year: str = "year") -> DataFrame:
    """Rows of the latest ``n`` years each key has.

    Only distinct (key, year) pairs are ranked, never the facts.
    """
    pairs = df.select(*keys, year).distinct()
    newest = Window.partitionBy(*keys).orderBy(F.col(year).desc())
    kept = pairs.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n")
    return df.join(kept, [*keys, year], "left_semi")


def years_of(df: DataFrame, year: str = "year") -> list[int]:
    """The distinct years of a table, ascending: the columns a pivot by year needs."""
    return [r[year] for r in df.select(year).where(F.col(year).isNotNull()).distinct().orderBy(year).collect()]


def pivot_years(df: DataFrame, keys: list[str], years: list[int], value: str = "value", year: str = "year") -> DataFrame:
    """One column per listed year, in the order given."""
    wide = df.groupBy(*keys).pivot(year, years).agg(F.first(value, ignorenulls=True).cast("double"))
    return wide.select(*keys, *[F.col(f"`{y}`").alias(f"y{y}") for y in years])


def pivot_measures(df: DataFrame, keys: list[str], measures: list[str], value: str = "value") -> DataFrame:
    """One column per listed measure of a long table."""
    return df.groupBy(*keys).pivot("measure", measures).agg(F.first(value, ignorenulls=True))


def net_position(df: DataFrame, keys: list[str], party: str, assets: str, liabilities: str) -> DataFrame:
    """Credits, debts and their difference toward one related party."""
    own = df.where(F.col("related_party") == party)
    zero = F.lit(0).cast("decimal(30,2)")
    side = lambda c: F.coalesce(F.sum(F.when(F.col("category") == c, F.col("value"))), zero)
    return (
        own.groupBy(*keys)
        .agg(side(assets).alias("credits"), side(liabilities).alias("debts"))
        .withColumn("net", F.col("credits") - F.col("debts"))
        .where((F.col("credits") != 0) | (F.col("debts") != 0))
    )


def derived_sum(*parts: Column) -> Column:
    """Sum that is NULL when any part is."""
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total
