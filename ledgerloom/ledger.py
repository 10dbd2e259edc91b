"""Read-only queries over the stored tables of one ledger folder.

Every method returns a DataFrame, so callers go on composing and Spark plans
the whole. Decimals leave as doubles; figures carry their source document and
page. A table that has not been loaded yet reads as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions.numbers import to_output
from ledgerloom.operators import entities as E
from ledgerloom.operators import facts, hierarchy

TABLES = {
    "documents": schemas.DOCUMENTS,
    "metrics": schemas.METRICS,
    "entities": schemas.ENTITIES,
    "entity_metrics": schemas.ENTITY_METRICS,
    "note_items": schemas.NOTE_ITEMS,
    "summary": schemas.RENDICONTO,
    "leaves": schemas.RENDICONTO_CAPITOLI,
    "debt": schemas.DEBITO,
    "members": schemas.RENDICONTO_COMUNI,
    "population": schemas.POPOLAZIONE,
    "entity_statements": schemas.ENTITY_STATEMENTS,
    "contracts": schemas.CONTRATTI,
}


def _newest(*then: str) -> list:
    return [F.col("year").desc(), *[F.col(c).asc_nulls_last() for c in then]]


def _up(*columns: str) -> list:
    return [F.col(c).asc_nulls_last() for c in columns]


class Ledger:
    """Queries over ``<root>/<table>`` Parquet folders."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    def table(self, name: str) -> DataFrame:
        """Stored table in its schema's column order."""
        schema = TABLES[name]
        stored = facts.optional_source(self.spark, f"{self.root}/{name}", schema)
        return stored.select(*schema.fieldNames())

    def has(self, name: str) -> bool:
        return not self.table(name).isEmpty()

    def _out(self, df: DataFrame, *drop: str) -> DataFrame:
        decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
        return df.withColumns({c: to_output(F.col(c)) for c in decimals}).drop(*drop)

    def _sourced(self, name: str) -> DataFrame:
        return facts.with_provenance(self.table(name), self.table("documents"))

    def _values(self, name: str, column: str, **conditions) -> DataFrame:
        return facts.where_equal(self.table(name), **conditions).select(column).distinct().orderBy(*_up(column))

    # -- documents and metrics ---------------------------------------------------
    def documents(self) -> DataFrame:
        return self.table("documents").orderBy(F.col("year").desc())

    def document(self, doc_id: int) -> DataFrame:
        return facts.where_equal(self.table("documents"), id=doc_id).limit(1)

    def years(self) -> DataFrame:
        return self._values("metrics", "year")

    def metric_categories(self) -> DataFrame:
        return self._values("metrics", "category")

    def metrics(
        self,
        year: int | None = None,
        category: str | None = None,
        code: str | None = None,
        query: str | None = None,
        limit: int | None = None,
        offset: int = 0,
    ) -> DataFrame:
        rows = facts.where_equal(self._sourced("metrics"), year=year, category=category, code=code)
        if query:
            rows = rows.where(facts.containing(F.col("metric_name"), query))
        return self._out(facts.page_of(rows, _newest("category", "id"), limit, offset), "doc_year")

    def metric_series(self, name: str, category: str | None = None) -> DataFrame:
        """One value per year and category, the year's own report preferred."""
        rows = facts.where_equal(self._sourced("metrics"), category=category).where(F.lower("metric_name") == name.lower())
        return self._out(facts.authoritative(rows, ["year", "category"]).orderBy("year"), "doc_year", "id", "document_id")

    def all_metrics(self) -> DataFrame:
        return self._out(self._sourced("metrics").orderBy(*_newest("category", "code", "metric_name")), "doc_year", "document_id")

    # -- entities ------------------------------------------------------------------
    def entities(self, year: int | None = None, slug: str | None = None) -> DataFrame:
        rows = facts.where_equal(self._sourced("entities"), year=year, canonical_slug=slug)
        return self._out(rows.orderBy(*_newest("canonical_name")), "doc_year", "document_id")

    def entity_metrics(self, slug: str | None = None, year: int | None = None) -> DataFrame:
        rows = facts.where_equal(self._sourced("entity_metrics"), canonical_slug=slug, year=year)
        return self._out(rows.orderBy(*_newest("canonical_name", "source", "metric_name")), "doc_year", "id", "document_id")

    def entity_metric_series(self, slug: str, metric: str) -> DataFrame:
        rows = facts.where_equal(self._sourced("entity_metrics"), canonical_slug=slug, metric_name=metric)
        return self._out(
            rows.select("year", "value", "unit", "canonical_name", "source", "source_page", "source_document").orderBy("year")
        )

    def entity_metrics_over_years(self, slug: str) -> DataFrame:
        rows = facts.where_equal(self.table("entity_metrics"), canonical_slug=slug)
        return facts.names_over_years(rows, "metric_name").orderBy("metric_name")

    def entities_with_metric(self, metric: str) -> DataFrame:
        rows = facts.where_equal(self.table("entity_metrics"), metric_name=metric).where(F.col("canonical_slug").isNotNull())
        keys = ["canonical_slug", "canonical_name"]
        return rows.groupBy(*keys).agg(F.countDistinct("year").alias("n_years")).orderBy(*_up("canonical_name"))

    def entity_directory(self) -> DataFrame:
        found = E.entity_directory(self.table("entities"), self.table("entity_metrics"), self.table("entity_statements"))
        return found.orderBy(*_up("canonical_name"))

    def entity_crosswalk(self) -> DataFrame:
        return E.entity_crosswalk(self.table("entities"), self.table("entity_metrics"))

    def statement_years(self, slug: str) -> DataFrame:
        years = facts.where_equal(self.table("entity_statements"), entity_slug=slug).select("year").distinct()
        return years.orderBy(F.col("year").desc())

    def entity_statements(
        self, slug: str | None = None, category: str | None = None, years: list[int] | None = None
    ) -> DataFrame:
        rows = facts.where_equal(self.table("entity_statements"), entity_slug=slug, category=category, year=years or None)
        return self._out(rows.orderBy(*_up("entity_slug", "category", "seq"), F.col("year").desc()), "id")

    # -- summary, members, population, debt -----------------------------------------
    def summary_years(self) -> DataFrame:
        return self._values("summary", "year")

    def summary_measures(self, kind: str) -> DataFrame:
        return self._values("summary", "measure", kind=kind)

    def summary(self, kind: str, measure: str, year: int | None = None, level: str = "voce") -> DataFrame:
        rows = facts.where_equal(self._sourced("summary"), kind=kind, measure=measure, level=level, year=year)
        return self._out(rows.orderBy(*_up("year", "code")), "doc_year", "id", "document_id")

    def summary_total(self, kind: str, measure: str, year: int) -> DataFrame:
        rows = facts.where_equal(self._sourced("summary"), kind=kind, measure=measure, level="totale", year=year)
        return self._out(rows.orderBy("id").select("year", "value", "source_page", "source_document").limit(1))

    def all_summary(self) -> DataFrame:
        return self._out(self._sourced("summary").orderBy(*_newest("kind", "measure", "code")), "doc_year", "id", "document_id")

    def member_spans(self) -> DataFrame:
        return facts.spans(self.table("members"), ["comune", "region"]).orderBy("comune")

    def members(
        self, comune: str | None = None, kind: str | None = None, measure: str | None = None,
        year: int | None = None, level: str | None = "voce",
    ) -> DataFrame:
        rows = facts.where_equal(self.table("members"), comune=comune, kind=kind, measure=measure, level=level, year=year)
        return self._out(rows.orderBy(*_up("year", "code")), "id")

    def all_members(self) -> DataFrame:
        order = [*_up("comune"), F.col("year").desc(), *_up("kind", "measure", "code")]
        return self._out(self.table("members").orderBy(*order), "id")

    def population(self, comune: str | None = None) -> DataFrame:
        return facts.where_equal(self.table("population"), comune=comune).orderBy("comune", "year")

    def debt_years(self) -> DataFrame:
        return self._values("debt", "year")

    def debt_measures(self) -> DataFrame:
        return self._values("debt", "measure")

    def debt(self, measure: str | None = None) -> DataFrame:
        return self._out(facts.where_equal(self.table("debt"), measure=measure).orderBy("year", "measure"), "id")

    def note_items(self) -> DataFrame:
        return self._out(self._sourced("note_items").orderBy(*_newest("source_page", "table_index")), "doc_year", "id", "document_id")

    # -- leaves ------------------------------------------------------------------------
    def leaf_years(self) -> DataFrame:
        return self._values("leaves", "year")

    def hierarchy(self, kind: str, year: int, measure: str) -> DataFrame:
        return self._out(hierarchy.hierarchy_sums(facts.where_equal(self.table("leaves"), kind=kind, year=year, measure=measure)))

    def hierarchy_level1(self, kind: str, year: int) -> DataFrame:
        rows = facts.where_equal(self.table("leaves"), kind=kind, year=year)
        return rows.select("liv1_code", "liv1_name").distinct().orderBy(*_up("liv1_code"))

    def leaves(
        self, kind: str, year: int, measure: str, liv1: str | None = None, liv2: str | None = None, limit: int | None = None
    ) -> DataFrame:
        rows = facts.where_equal(
            self.table("leaves"), kind=kind, year=year, measure=measure, liv1_code=liv1, liv2_code=liv2
        )
        return self._out(facts.limited(rows.orderBy(F.col("value").desc_nulls_last(), "id"), limit), "id", "document_id")

    def leaf_series(
        self, kind: str, measure: str, code: str | None = None,
        liv1: str | None = None, liv2: str | None = None, liv3: str | None = None,
    ) -> DataFrame:
        rows = facts.where_equal(
            self.table("leaves"), kind=kind, measure=measure, capitolo_code=code, liv1_code=liv1, liv2_code=liv2, liv3_code=liv3
        )
        return self._out(hierarchy.hierarchy_series(rows).orderBy("year"))

    def leaf_items(self, kind: str, liv1: str, liv2: str | None = None, level: str = "capitolo") -> DataFrame:
        rows = facts.where_equal(self.table("leaves"), kind=kind, liv1_code=liv1, liv2_code=liv2)
        return hierarchy.hierarchy_items(rows, level).orderBy(*_up("name"))

    def all_leaves(self) -> DataFrame:
        order = _up("year", "kind", "liv1_code", "liv2_code", "liv3_code", "capitolo_code", "measure")
        return self._out(self.table("leaves").orderBy(*order), "id", "document_id")

    # -- contracts -----------------------------------------------------------------------
    def contract_years(self) -> DataFrame:
        return self._values("contracts", "anno")

    def contracts(
        self, anno: int | None = None, search: str | None = None, order_by: str = "importo_aggiudicazione", limit: int | None = None
    ) -> DataFrame:
        rows = facts.where_equal(self.table("contracts"), anno=anno)
        if search:
            rows = rows.where(facts.any_containing(["oggetto", "aggiudicatario", "cig"], search))
        return self._out(facts.ranked_by(rows, order_by, ["importo_aggiudicazione", "importo_liquidato"], limit), "id")

    def contract_summary(self, anno: int | None = None) -> DataFrame:
        return self._out(facts.contract_summary(facts.where_equal(self.table("contracts"), anno=anno)))

    def top_suppliers(self, anno: int | None = None, limit: int | None = None) -> DataFrame:
        return self._out(facts.top_suppliers(facts.where_equal(self.table("contracts"), anno=anno), limit))

    def all_contracts(self) -> DataFrame:
        order = [F.col("anno").asc(), F.col("importo_aggiudicazione").desc_nulls_last()]
        return self._out(self.table("contracts").orderBy(*order), "id")

    # -- search ----------------------------------------------------------------------------
    def search(self, query: str, limit: int | None = None) -> dict[str, DataFrame]:
        """Metrics, entities and notes whose names contain the text."""
        metrics = self._sourced("metrics").where(facts.containing(F.col("metric_name"), query))
        notes = self._sourced("note_items").where(facts.containing(F.col("voce"), query))
        found = E.search_entities(self.table("entities"), self.table("entity_metrics"), query)
        return {
            "metrics": self._out(facts.limited(metrics.orderBy(*_newest("metric_name")), limit), "doc_year", "id", "document_id"),
            "entities": facts.limited(found.orderBy(*_up("canonical_name")), limit),
            "notes": self._out(facts.limited(notes.orderBy(*_newest("voce")), limit), "doc_year", "id", "document_id"),
        }
