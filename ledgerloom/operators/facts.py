"""Filters, lookups, joins and rankings over long fact tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def where_equal(df: DataFrame, **conditions) -> DataFrame:
    """Keep rows equal to every given value; a None argument is no condition.

    Lists and sets mean membership.
    """
    tests = []
    for name, wanted in conditions.items():
        if wanted is None:
            continue
        if isinstance(wanted, (list, tuple, set, frozenset)):
            tests.append(F.col(name).isin(*wanted))
        else:
            tests.append(F.col(name) == F.lit(wanted))
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def _plain_backslash(query: str) -> str:
    """A backslash of the text stands for itself."""
    return query.replace("\\", "\\\\")


def containing(column: Column, query: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` keep their LIKE meaning."""
    return F.lower(column).like(f"%{_plain_backslash(query.lower())}%")


def any_containing(columns: list[str], query: str) -> Column:
    """The same test over several columns, any of which may match."""
    return reduce(lambda a, b: a | b, [F.col(c).ilike(f"%{_plain_backslash(query)}%") for c in columns])


def with_provenance(facts: DataFrame, documents: DataFrame, key: str = "document_id") -> DataFrame:
    """Facts with the file they come from; facts of unknown documents drop out."""
    names = documents.select(F.col("id").alias(key), F.col("filename").alias("source_document"), F.col("year").alias("doc_year"))
    return facts.join(names, key)


def authoritative(facts: DataFrame, keys: list[str], year: str = "year", doc_year: str = "doc_year", tie: str = "id") -> DataFrame:
    """One version per key: the report of the fact's own year, else the latest.

    Spark limits each group to its first row before the shuffle, so a hot key
    sends one row per task.
    """
    order = Window.partitionBy(*keys).orderBy(
        F.when(F.col(doc_year) == F.col(year), 0).otherwise(1),
        F.col(doc_year).desc(),
        F.col(tie),
    )
    return facts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def own_report_or_all(facts: DataFrame, year: str = "year", doc_year: str = "doc_year") -> DataFrame:
    """Per year, rows of that year's own report; every row where there is none."""
    own = facts.where(F.col(doc_year) == F.col(year)).select(F.col(year).alias("_own_year")).distinct()
    marked = facts.join(own, facts[year] == own["_own_year"], "left")
    return marked.where(F.col("_own_year").isNull() | (F.col(doc_year) == F.col(year))).drop("_own_year")


def page_of(df: DataFrame, order: list[Column], limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows in order from ``offset`` on, ``limit`` of them if one is given."""
    return limited(df.orderBy(*order).offset(offset), limit)


def limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column as text, tagged with the column name."""
    return df.select(F.lit(column).alias("domain"), F.col(column).cast("string").alias("member")).distinct()


def ranked_by(df: DataFrame, column: str, allowed: list[str], limit: int | None = None, tie: str = "id") -> DataFrame:
    """Top rows by a whitelisted column (else the first allowed), NULLs last, equal ones by ``tie``."""
    chosen = column if column in allowed else allowed[0]
    return limited(df.orderBy(F.col(chosen).desc_nulls_last(), F.col(tie).asc_nulls_last()), limit)


def optional_source(spark: SparkSession, path: str, schema: T.StructType, read_as: T.StructType | None = None) -> DataFrame:
    """A Parquet folder, or an empty table of the schema when it is not there.

    ``read_as`` fixes the types also of partition columns, whose values Spark
    would otherwise take for numbers where they look like some.
    """
    try:
        return (spark.read.schema(read_as) if read_as else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def optional_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalogue table, or an empty one of the schema when it is not there."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def drop_zero_items(df: DataFrame, item: list[str], value: str = "value") -> DataFrame:
    """Leave out items whose every value is NULL or zero."""
    live = df.where(F.col(value).isNotNull() & (F.col(value) != 0)).select(*item).distinct()
    return df.join(live, item, "left_semi")


def select_member(df: DataFrame, name_col: str, type_col: str, name: str, kind: str) -> DataFrame:
    """Rows of one body: name and type must both match, so namesakes stay out."""
    same = lambda c, v: F.upper(F.trim(F.col(c))) == v.strip().upper()
    return df.where(same(name_col, name) & same(type_col, kind))


def spans(df: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """First and last year and number of distinct years per key."""
    return df.groupBy(*keys).agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.countDistinct(year).alias("n_years")
    )


def names_over_years(df: DataFrame, name: str, at_least: int = 2, year: str = "year") -> DataFrame:
    """Names present in at least so many distinct years."""
    counted = df.groupBy(name).agg(F.countDistinct(year).alias("n_years"))
    return counted.where(F.col("n_years") >= at_least).select(name)


def contract_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        F.sum("importo_aggiudicazione").alias("tot_aggiudicato"),
        F.sum("importo_liquidato").alias("tot_liquidato"),
        F.countDistinct("aggiudicatario").alias("n_fornitori"),
    )


def top_suppliers(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Largest suppliers by amount; contracts without a supplier are a group."""
    totals = df.groupBy("aggiudicatario").agg(
        F.count("*").alias("n_contratti"), F.sum("importo_aggiudicazione").alias("importo")
    )
    return limited(totals.orderBy(F.col("importo").desc_nulls_last(), F.col("aggiudicatario").asc_nulls_last()), limit)


def two_years(df: DataFrame, year: Column, prior_year: Column, current: str = "current", prior: str = "prior") -> DataFrame:
    """One row per year for lines with a current and a prior value; NULLs drop."""
    pairs = F.array(
        F.struct(year.cast("int").alias("year"), F.col(current).alias("value")),
        F.struct(prior_year.cast("int").alias("year"), F.col(prior).alias("value")),
    )
    kept = [c for c in df.columns if c not in (current, prior)]
    return df.select(*kept, F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))
