"""Fact-table queries: filters, provenance, versions, hierarchy, contracts, exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import presets
from ledgerloom.functions.numbers import to_output as out
from ledgerloom.operators import entities, facts, hierarchy, pages
from ledgerloom.plans.registry import query
from ledgerloom.session import scratch_path
from ledgerloom.sources.export import export_index

METRIC = "id, year, category, code, metric_name, CAST(value AS DOUBLE) AS value, unit, source_page, source_document"
SOURCED = "(SELECT m.*, d.filename AS source_document, d.year AS doc_year FROM metric m JOIN report d ON d.id = m.document_id)"


def _sourced(t):
    return facts.with_provenance(t.metric, t.report)


def _metric_columns(df):
    return df.select(
        "id", "year", "category", "code", "metric_name", out(F.col("value")).alias("value"), "unit", "source_page", "source_document"
    )


@query("facts_with_provenance", f"SELECT {METRIC} FROM {SOURCED}", "metric report")
def facts_with_provenance(t):
    return _metric_columns(_sourced(t))


@query("authoritative_series", f"""
SELECT {METRIC} FROM (SELECT *, row_number() OVER (PARTITION BY year, category ORDER BY CASE WHEN doc_year = year THEN 0 ELSE 1 END, doc_year DESC, id) AS rk
 FROM {SOURCED} WHERE lower(metric_name) = 'f') WHERE rk = 1 ORDER BY year""", "metric report")
def authoritative_series(t):
    named = _sourced(t).where(F.lower("metric_name") == "f")
    return _metric_columns(facts.authoritative(named, ["year", "category"])).orderBy("year")


@query("filtered_facts", f"SELECT {METRIC} FROM {SOURCED} WHERE year = 1997 AND category = '1-URGENT' AND lower(metric_name) LIKE '%o%'", "metric report")
def filtered_facts(t):
    rows = facts.where_equal(_sourced(t), year=1997, category="1-URGENT", code=None)
    return _metric_columns(rows.where(facts.containing(F.col("metric_name"), "O")))


@query("filter_in", f"SELECT {METRIC} FROM {SOURCED} WHERE year IN (1996, 1998)", "metric report")
def filter_in(t):
    return _metric_columns(facts.where_equal(_sourced(t), year=[1996, 1998]))


@query("paged_facts", f"SELECT {METRIC} FROM {SOURCED} ORDER BY year DESC, category, id LIMIT 20 OFFSET 10", "metric report")
def paged_facts(t):
    order = [F.col("year").desc(), F.col("category").asc_nulls_last(), F.col("id").asc()]
    return _metric_columns(facts.page_of(_sourced(t), order, limit=20, offset=10))


@query("deep_page", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 5000")
def deep_page(t):
    """A page far down a stored order, read from the ranges it lies in."""
    path = scratch_path(t.spark, "ranked")
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    pages.write_ranked(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], path, width=4096)
    return pages.ranked_page(t.spark, path, offset=5000, limit=50, width=4096)


@query("authoritative_or_all", f"""
SELECT {METRIC} FROM {SOURCED} s WHERE doc_year = year OR NOT EXISTS (SELECT 1 FROM metric m WHERE m.document_id = m.year AND m.year = s.year)""", "metric report")
def authoritative_or_all(t):
    return _metric_columns(facts.own_report_or_all(_sourced(t)))


@query("report_year_lines", f"SELECT {METRIC} FROM {SOURCED} WHERE year = 1998 AND source_document = 'report_1998.pdf'", "metric report")
def report_year_lines(t):
    return _metric_columns(facts.where_equal(_sourced(t), year=1998, source_document="report_1998.pdf"))


@query("document_by_id", "SELECT id, filename, document_type, year, page_count FROM report WHERE id = 1999", "report")
def document_by_id(t):
    return facts.where_equal(t.report, id=1999).limit(1)


@query("export_documents", "SELECT id, filename, document_type, year, page_count FROM report ORDER BY year DESC", "report")
def export_documents(t):
    return t.report.orderBy(F.col("year").desc())


@query("distinct_domain", """
SELECT DISTINCT 'year' AS domain, CAST(year AS VARCHAR) AS member FROM metric UNION ALL SELECT DISTINCT 'category', category FROM metric
UNION ALL SELECT DISTINCT 'metric_name', metric_name FROM metric UNION ALL SELECT DISTINCT 'anno', CAST(anno AS VARCHAR) FROM contract""", "metric contract")
def distinct_domain(t):
    parts = [facts.domain(t.metric, c) for c in ("year", "category", "metric_name")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(facts.domain(t.contract, "anno"))
    return whole.orderBy("domain", "member")


@query("substring_search", "SELECT doc_id, lang, n_chars FROM documents WHERE lower(text) LIKE '%token%'")
def substring_search(t):
    return t.raw("documents").where(facts.containing(F.col("text"), "Token")).select("doc_id", "lang", "n_chars")


@query("ilike_any", """
SELECT cig, anno, oggetto, aggiudicatario FROM contract WHERE oggetto ILIKE '%gear%' OR aggiudicatario ILIKE '%gear%' OR cig ILIKE '%gear%'""", "contract")
def ilike_any(t):
    return t.contract.where(facts.any_containing(["oggetto", "aggiudicatario", "cig"], "GEAR")).select(
        "cig", "anno", "oggetto", "aggiudicatario"
    )


@query("select_member", """
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS total FROM geo WHERE upper(trim(' ' || lower(n_name) || ' ')) = 'NATION_3' AND upper(trim(c_mktsegment)) = 'BUILDING'""", "geo")
def select_member(t):
    printed = t.order_geo.withColumn("city", F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")))
    return facts.select_member(printed, "city", "c_mktsegment", "nation_3 ", "building").select(
        "o_orderkey", F.col("o_totalprice").alias("total")
    )


@query("optional_source", """
SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'unfiled', 0""")
def optional_source(t):
    schema = T.StructType([T.StructField("o_orderkey", T.LongType())])
    found = facts.optional_source(t.spark, f"{t.folder}/orders.parquet", schema)
    absent = facts.optional_source(t.spark, f"{t.folder}/unfiled.parquet", schema)
    tally = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
    return tally(found, "orders").unionByName(tally(absent, "unfiled"))


@query("drop_zero_items", """
SELECT o_custkey, year, CAST(value AS DOUBLE) AS value FROM (
 SELECT *, max(CASE WHEN x.value <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS live FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year,
   sum(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN CAST(o_totalprice AS DECIMAL(20,2)) ELSE 0 END) AS value FROM orders GROUP BY 1, 2) x) WHERE live = 1""")
def drop_zero_items(t):
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    value = F.when(urgent, F.col("o_totalprice").cast("decimal(20,2)")).otherwise(F.lit(0).cast("decimal(20,2)"))
    cells = t.orders.groupBy("o_custkey", "year").agg(F.sum(value).alias("value"))
    return facts.drop_zero_items(cells, ["o_custkey"]).select("o_custkey", "year", out(F.col("value")).alias("value"))


@query("multi_year_metrics", """
SELECT metric_name FROM entity_metric WHERE canonical_slug = 'gear_group' GROUP BY metric_name HAVING count(DISTINCT year) >= 2 ORDER BY 1""", "entity_metric")
def multi_year_metrics(t):
    return facts.names_over_years(facts.where_equal(t.entity_metric, canonical_slug="gear_group"), "metric_name").orderBy("metric_name")


@query("members_with_metric", """
SELECT canonical_slug, canonical_name, count(DISTINCT year) AS n_years FROM entity_metric WHERE metric_name = 'valore' AND canonical_slug IS NOT NULL GROUP BY 1, 2""", "entity_metric")
def members_with_metric(t):
    named = t.entity_metric.where((F.col("metric_name") == "valore") & F.col("canonical_slug").isNotNull())
    return named.groupBy("canonical_slug", "canonical_name").agg(F.countDistinct("year").alias("n_years")).orderBy("canonical_name")


@query("member_year_span", """
SELECT comune, region, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS n_years FROM member GROUP BY 1, 2""", "member")
def member_year_span(t):
    return facts.spans(t.member, ["comune", "region"]).orderBy("comune")


@query("entity_directory", """
SELECT canonical_slug, max(canonical_name) AS canonical_name, max(entity_type) AS entity_type, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS n_years
FROM (SELECT canonical_slug, canonical_name, entity_type, year FROM entity WHERE canonical_slug IS NOT NULL UNION ALL
 SELECT canonical_slug, canonical_name, NULL, year FROM entity_metric WHERE canonical_slug IS NOT NULL UNION ALL
 SELECT entity_slug, entity_name, NULL, year FROM statement) GROUP BY 1""", "entity entity_metric statement")
def entity_directory(t):
    return entities.entity_directory(t.entity, t.entity_metric, t.statement).orderBy("canonical_name")


@query("entity_crosswalk", """
SELECT DISTINCT canonical_slug, canonical_name, name AS raw_name, 'entities' AS source FROM entity
UNION SELECT DISTINCT canonical_slug, canonical_name, entity_name, source FROM entity_metric""", "entity entity_metric")
def entity_crosswalk(t):
    return entities.entity_crosswalk(t.entity, t.entity_metric).orderBy("canonical_slug", "source", "raw_name")


@query("search_entities", """
SELECT canonical_slug, canonical_name, max(entity_type) AS entity_type FROM (SELECT canonical_slug, canonical_name, entity_type, name AS raw FROM entity
 UNION ALL SELECT canonical_slug, canonical_name, NULL, entity_name FROM entity_metric)
WHERE canonical_slug IS NOT NULL AND (lower(raw) LIKE '%gear%' OR lower(canonical_name) LIKE '%gear%') GROUP BY 1, 2""", "entity entity_metric")
def search_entities(t):
    return entities.search_entities(t.entity, t.entity_metric, "gear").orderBy("canonical_name")


@query("search_all", """
(SELECT 'metric' AS family, concat_ws(' ', category, metric_name) AS label, year, CAST(value AS DOUBLE) AS value FROM metric WHERE lower(category) LIKE '%high%'
  ORDER BY year DESC NULLS LAST, label NULLS LAST, value NULLS LAST LIMIT 50)
UNION ALL (SELECT 'entity', canonical_name, CAST(max(year) AS INT) AS y, NULL FROM entity WHERE lower(name) LIKE '%high%' OR lower(canonical_name) LIKE '%high%' OR lower(name) LIKE '%old%' GROUP BY canonical_name
  ORDER BY y DESC NULLS LAST, canonical_name NULLS LAST LIMIT 50)
UNION ALL (SELECT 'note', event_type, CAST(user_id AS INT) AS u, CAST(value AS DOUBLE) AS v FROM note WHERE lower(event_type) LIKE '%sign%' ORDER BY u DESC NULLS LAST, event_type NULLS LAST, v NULLS LAST LIMIT 50)""", "metric entity note")
def search_all(t):
    found = t.metric.where(facts.containing(F.col("category"), "high")).select(
        F.concat_ws(" ", "category", "metric_name").alias("label"), "year", out(F.col("value")).alias("value")
    )
    named = t.entity.where(
        facts.containing(F.col("name"), "high")
        | facts.containing(F.col("canonical_name"), "high")
        | facts.containing(F.col("name"), "old")
    ).groupBy(F.col("canonical_name").alias("label")).agg(F.max("year").alias("year"))
    noted = t.note.where(facts.containing(F.col("event_type"), "sign")).select(
        F.col("event_type").alias("label"), F.col("user_id").cast("int").alias("year"), out(F.col("value")).alias("value")
    )
    return entities.search_all(found, named.withColumn("value", F.lit(None).cast("double")), noted, limit=50)


ENTITY = "year, name, canonical_slug, canonical_name, CAST(ownership_percentage AS DOUBLE) AS ownership_percentage, entity_type, source_page, filename AS source_document"
ENTITY_FROM = "FROM (SELECT e.*, d.filename FROM entity e JOIN report d ON d.id = e.document_id)"


def _entity_columns(t, rows):
    return facts.with_provenance(rows, t.report).select(
        "year", "name", "canonical_slug", "canonical_name", out(F.col("ownership_percentage")).alias("ownership_percentage"),
        "entity_type", "source_page", "source_document",
    )


@query("entity_rows", f"SELECT {ENTITY} {ENTITY_FROM} WHERE year = 1997 AND canonical_slug = 'bolt_works'", "entity report")
def entity_rows(t):
    return _entity_columns(t, facts.where_equal(t.entity, year=1997, canonical_slug="bolt_works")).orderBy("canonical_name")


@query("export_entities", f"SELECT {ENTITY} {ENTITY_FROM}", "entity report")
def export_entities(t):
    return _entity_columns(t, t.entity).orderBy(F.col("year").desc(), F.col("canonical_name").asc_nulls_last())


EM = """year, entity_name, canonical_slug, canonical_name, source, metric_name, CAST(value AS DOUBLE) AS value, unit, source_page, filename AS source_document
FROM (SELECT e.*, d.filename FROM entity_metric e JOIN report d ON d.id = e.document_id)"""


def _entity_metric_columns(t, rows):
    return facts.with_provenance(rows, t.report).select(
        "year", "entity_name", "canonical_slug", "canonical_name", "source", "metric_name", out(F.col("value")).alias("value"),
        "unit", "source_page", "source_document",
    )


@query("entity_metric_rows", f"SELECT {EM} WHERE canonical_slug = 'rod_srl' AND year = 1998", "entity_metric report")
def entity_metric_rows(t):
    rows = facts.where_equal(t.entity_metric, canonical_slug="rod_srl", year=1998)
    return _entity_metric_columns(t, rows).orderBy(F.col("year").desc(), "source", "metric_name")


@query("entity_metric_series", f"SELECT {EM} WHERE canonical_slug = 'ring_house' AND metric_name = 'valore'", "entity_metric report")
def entity_metric_series(t):
    rows = facts.where_equal(t.entity_metric, canonical_slug="ring_house", metric_name="valore")
    return _entity_metric_columns(t, rows).orderBy("year")


@query("export_entity_metrics", f"SELECT {EM}", "entity_metric report")
def export_entity_metrics(t):
    order = [F.col("year").desc(), F.col("canonical_name").asc_nulls_last(), F.col("source"), F.col("metric_name")]
    return _entity_metric_columns(t, t.entity_metric).orderBy(*order)


@query("export_metrics", f"SELECT {METRIC} FROM {SOURCED} ORDER BY year DESC, category, code NULLS LAST, metric_name", "metric report")
def export_metrics(t):
    order = [F.col("year").desc(), F.col("category").asc_nulls_last(), F.col("code").asc_nulls_last(), F.col("metric_name").asc_nulls_last()]
    return _metric_columns(_sourced(t).orderBy(*order))


@query("export_headlines", f"""
SELECT {METRIC} FROM (SELECT *, row_number() OVER (PARTITION BY metric_name, year, category ORDER BY CASE WHEN doc_year = year THEN 0 ELSE 1 END, doc_year DESC, id) AS rk
 FROM {SOURCED} WHERE (category, metric_name) IN (('1-URGENT', 'F'), ('2-HIGH', 'O'))) WHERE rk = 1""", "metric report")
def export_headlines(t):
    chosen = ((F.col("category") == "1-URGENT") & (F.col("metric_name") == "F")) | (
        (F.col("category") == "2-HIGH") & (F.col("metric_name") == "O")
    )
    return _metric_columns(facts.authoritative(_sourced(t).where(chosen), ["metric_name", "year", "category"]))


STATEMENT = "entity_slug, entity_name, year, category, seq, code, name, CAST(value AS DOUBLE) AS value, is_total, related_party FROM statement"


def _statement_columns(rows):
    return rows.withColumn("value", out(F.col("value")))


@query("statement_rows", f"SELECT {STATEMENT} WHERE entity_slug = 'supplier_7' AND category = 'stato_patrimoniale_attivo' AND year IN (1997, 1998)", "statement")
def statement_rows(t):
    rows = facts.where_equal(t.statement, entity_slug="supplier_7", category=presets.ASSETS, year=[1997, 1998])
    return _statement_columns(rows).orderBy("category", "seq", F.col("year").desc())


@query("export_statements", f"SELECT {STATEMENT}", "statement")
def export_statements(t):
    return _statement_columns(t.statement).orderBy("entity_slug", "category", "seq", F.col("year").desc())


SUMMARY_SQL = """(SELECT year, kind, 'voce' AS level, liv1_code AS code, liv1_name AS name, measure, sum(value) AS value FROM leaf GROUP BY ALL
 UNION ALL SELECT year, kind, 'totale', NULL, 'Totale generale', measure, sum(value) FROM leaf GROUP BY ALL)"""


def summary(t):
    """Level-1 items with printed grand totals, from the leaves."""
    items = t.leaf.groupBy("year", "kind", F.col("liv1_code").alias("code"), F.col("liv1_name").alias("name"), "measure").agg(
        F.sum("value").alias("value")
    )
    totals = t.leaf.groupBy("year", "kind", "measure").agg(F.sum("value").alias("value"))
    return items.withColumn("level", F.lit("voce")).unionByName(
        totals.withColumns(
            {"level": F.lit("totale"), "code": F.lit(None).cast("string"), "name": F.lit("Totale generale")}
        )
    ).select("year", "kind", "level", "code", "name", "measure", out(F.col("value")).alias("value"))


@query("summary_rows", f"SELECT year, kind, level, code, name, measure, CAST(value AS DOUBLE) AS value FROM {SUMMARY_SQL} WHERE kind = 'spesa' AND measure = 'impegni' AND level = 'voce'", "leaf")
def summary_rows(t):
    return facts.where_equal(summary(t), kind="spesa", measure="impegni", level="voce", year=None).orderBy("year", F.col("code").asc_nulls_last())


@query("summary_total", f"SELECT year, CAST(value AS DOUBLE) AS value FROM {SUMMARY_SQL} WHERE kind = 'entrata' AND measure = 'accertamenti' AND level = 'totale' AND year = 1998", "leaf")
def summary_total(t):
    return facts.where_equal(summary(t), kind="entrata", measure="accertamenti", level="totale", year=1998).select("year", "value").limit(1)


@query("export_summary", f"SELECT year, kind, level, code, name, measure, CAST(value AS DOUBLE) AS value FROM {SUMMARY_SQL}", "leaf")
def export_summary(t):
    return summary(t).orderBy(F.col("year").desc(), "kind", "measure", F.col("code").asc_nulls_last())


@query("member_rows", "SELECT comune, region, year, code, CAST(value AS DOUBLE) AS value FROM member WHERE comune = 'NATION_3' AND year = 1998", "member")
def member_rows(t):
    return facts.where_equal(t.member, comune="NATION_3", year=1998).withColumn("value", out(F.col("value"))).orderBy("year", "code")


@query("export_members", "SELECT comune, region, year, code, CAST(value AS DOUBLE) AS value FROM member", "member")
def export_members(t):
    return t.member.withColumn("value", out(F.col("value"))).orderBy("comune", F.col("year").desc(), F.col("code").asc_nulls_last())


@query("export_population", "SELECT comune, year, residenti FROM population", "population")
def export_population(t):
    return t.population.orderBy("comune", "year")


@query("export_notes", "SELECT user_id, event_type, period, CAST(value AS DOUBLE) AS value FROM note", "note")
def export_notes(t):
    return t.note.withColumn("value", out(F.col("value"))).orderBy("user_id", "event_type", "period")


SERIES_LONG = """(SELECT year, 'residuo_iniziale' AS measure, CAST(opening AS DOUBLE) AS value FROM series WHERE opening IS NOT NULL
 UNION ALL SELECT year, 'debito_fine_anno', CAST(closing AS DOUBLE) FROM series UNION ALL SELECT year, 'oneri_finanziari', CAST(added AS DOUBLE) FROM series)"""


def series_long(t):
    named = t.series.select(
        "year",
        out(F.col("opening")).alias("residuo_iniziale"),
        out(F.col("closing")).alias("debito_fine_anno"),
        out(F.col("added")).alias("oneri_finanziari"),
    )
    return named.unpivot(["year"], ["residuo_iniziale", "debito_fine_anno", "oneri_finanziari"], "measure", "value").where(
        F.col("value").isNotNull()
    )


@query("export_series", f"SELECT * FROM {SERIES_LONG}", "series")
def export_series(t):
    return series_long(t).orderBy("year", "measure")


LEAF = "liv1_code, liv1_name, liv2_code, liv2_name, liv3_code, liv3_name"


@query("hierarchy_sums", f"SELECT {LEAF}, CAST(sum(value) AS DOUBLE) AS value FROM leaf WHERE kind = 'spesa' AND year = 1998 AND measure = 'impegni' GROUP BY ALL", "leaf")
def hierarchy_sums(t):
    rows = facts.where_equal(t.leaf, kind="spesa", year=1998, measure="impegni")
    return hierarchy.hierarchy_sums(rows).withColumn("value", out(F.col("value")))


@query("hierarchy_level1", "SELECT DISTINCT liv1_code, liv1_name FROM leaf WHERE kind = 'spesa' AND year = 1998 ORDER BY 1", "leaf")
def hierarchy_level1(t):
    return facts.where_equal(t.leaf, kind="spesa", year=1998).select("liv1_code", "liv1_name").distinct().orderBy("liv1_code")


@query("top_leaves", """SELECT liv1_code, liv2_code, capitolo_code, denominazione, CAST(value AS DOUBLE) AS value FROM leaf
WHERE kind = 'spesa' AND year = 1998 AND measure = 'impegni' AND liv1_code = '01' ORDER BY leaf.value DESC, capitolo_code LIMIT 25""", "leaf")
def top_leaves(t):
    rows = facts.where_equal(t.leaf, kind="spesa", year=1998, measure="impegni", liv1_code="01", liv2_code=None)
    return rows.orderBy(F.col("value").desc_nulls_last(), "capitolo_code").limit(25).select(
        "liv1_code", "liv2_code", "capitolo_code", "denominazione", out(F.col("value")).alias("value")
    )


@query("hierarchy_timeseries", """SELECT year, CAST(sum(value) AS DOUBLE) AS value, max(denominazione) AS denominazione FROM leaf
WHERE kind = 'spesa' AND measure = 'impegni' AND liv1_code = '02' GROUP BY year""", "leaf")
def hierarchy_timeseries(t):
    rows = facts.where_equal(t.leaf, kind="spesa", measure="impegni", liv1_code="02")
    return hierarchy.hierarchy_series(rows).withColumn("value", out(F.col("value"))).orderBy("year")


@query("hierarchy_items", """SELECT 'capitolo' AS level, capitolo_code AS code, max(denominazione) AS name FROM leaf WHERE kind = 'spesa' AND liv1_code = '01' GROUP BY ALL
UNION ALL SELECT 'liv3', liv3_code, max(liv3_name) FROM leaf WHERE kind = 'spesa' AND liv1_code = '01' AND liv3_code IS NOT NULL GROUP BY ALL""", "leaf")
def hierarchy_items(t):
    rows = facts.where_equal(t.leaf, kind="spesa", liv1_code="01")
    levels = [hierarchy.hierarchy_items(rows, lv).select(F.lit(lv).alias("level"), "code", "name") for lv in ("capitolo", "liv3")]
    return levels[0].unionByName(levels[1]).orderBy("name")


@query("hierarchy_rollup", """
SELECT liv1_code, liv2_code, liv3_code, depth, CAST(value AS DOUBLE) AS value, CAST(value AS DOUBLE) * 100 / CAST(max(CASE WHEN depth = 0 THEN value END) OVER () AS DOUBLE) AS root_share FROM (
 SELECT liv1_code, liv2_code, liv3_code, CAST(3 - (grouping(liv1_code) + grouping(liv2_code) + grouping(liv3_code)) AS INT) AS depth, sum(value) AS value
 FROM leaf WHERE kind = 'spesa' GROUP BY ROLLUP (liv1_code, liv2_code, liv3_code))""", "leaf")
def hierarchy_rollup(t):
    return hierarchy.hierarchy_rollup(facts.where_equal(t.leaf, kind="spesa")).withColumn("value", out(F.col("value")))


@query("hierarchy_leaf_paths", """
SELECT concat_ws(' · ', liv1_code, liv1_name) AS level1, coalesce(liv2_name, '—') AS level2, coalesce(liv3_name, '—') AS level3, concat_ws(' · ', capitolo_code, denominazione) AS leaf,
 CAST(value AS DOUBLE) AS value FROM leaf WHERE kind = 'spesa' AND year = 1998 AND leaf.value > 0""", "leaf")
def hierarchy_leaf_paths(t):
    return hierarchy.leaf_paths(facts.where_equal(t.leaf, kind="spesa", year=1998)).withColumn("value", out(F.col("value")))


@query("export_leaves", f"SELECT year, kind, {LEAF}, capitolo_code, denominazione, measure, CAST(value AS DOUBLE) AS value FROM leaf", "leaf")
def export_leaves(t):
    return t.leaf.withColumn("value", out(F.col("value"))).orderBy(
        "year", "kind", "liv1_code", "liv2_code", F.col("liv3_code").asc_nulls_last(), "capitolo_code", "measure"
    )


@query("contract_summary", """
SELECT count(*) AS n, CAST(sum(importo_aggiudicazione) AS DOUBLE) AS tot_aggiudicato, CAST(sum(importo_liquidato) AS DOUBLE) AS tot_liquidato, count(DISTINCT aggiudicatario) AS n_fornitori
FROM contract WHERE anno = 1998""", "contract")
def contract_summary(t):
    totals = facts.contract_summary(facts.where_equal(t.contract, anno=1998))
    return totals.withColumns({c: out(F.col(c)) for c in ("tot_aggiudicato", "tot_liquidato")})


@query("top_suppliers", """
SELECT aggiudicatario, count(*) AS n_contratti, CAST(sum(importo_aggiudicazione) AS DOUBLE) AS importo FROM contract GROUP BY 1
ORDER BY sum(importo_aggiudicazione) DESC NULLS LAST, aggiudicatario NULLS LAST LIMIT 15""", "contract")
def top_suppliers(t):
    return facts.top_suppliers(t.contract, 15).withColumn("importo", out(F.col("importo")))


CONTRACT = """cig, anno, oggetto, struttura, aggiudicatario, n_partecipanti, CAST(importo_aggiudicazione AS DOUBLE) AS importo_aggiudicazione,
 CAST(importo_liquidato AS DOUBLE) AS importo_liquidato"""


def _contract_columns(rows):
    return rows.withColumns({c: out(F.col(c)) for c in ("importo_aggiudicazione", "importo_liquidato")})


@query("ranked_contracts", f"SELECT {CONTRACT} FROM contract WHERE anno = 1997 ORDER BY contract.importo_liquidato DESC NULLS LAST, contract.cig LIMIT 50", "contract")
def ranked_contracts(t):
    allowed = ["importo_aggiudicazione", "importo_liquidato"]
    return _contract_columns(facts.ranked_by(facts.where_equal(t.contract, anno=1997), "importo_liquidato", allowed, 50, tie="cig"))


@query("export_contracts", f"SELECT {CONTRACT} FROM contract", "contract")
def export_contracts(t):
    return _contract_columns(t.contract).orderBy("anno", F.col("importo_aggiudicazione").desc_nulls_last())


@query("export_index", """
SELECT 'documents' AS dataset, count(*) AS n_rows, 'documents.json' AS files FROM report UNION ALL SELECT 'metrics', count(*), 'metrics.json,metrics.csv' FROM metric
UNION ALL SELECT 'population', count(*), 'population.json,population.csv' FROM population UNION ALL SELECT 'leaves', count(*), 'leaves.csv' FROM leaf
UNION ALL SELECT 'contracts', count(*), 'contracts.csv' FROM contract""", "report metric population leaf contract")
def export_index_query(t):
    return export_index(
        {
            "documents": (t.report, ["json"]),
            "metrics": (t.metric, ["json", "csv"]),
            "population": (t.population, ["json", "csv"]),
            "leaves": (t.leaf, ["csv"]),
            "contracts": (t.contract, ["csv"]),
        }
    )
