"""Shares, per-capita, comparisons, changes, lookups, pivots and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions import text as X
from ledgerloom.functions.numbers import to_output as out
from ledgerloom.operators import analytics, facts, hierarchy, lookups
from ledgerloom.operators.ordered import ordered_dedup
from ledgerloom.plans.q_facts import SERIES_LONG, series_long
from ledgerloom.plans.registry import query
from ledgerloom.sources import readers

MONEY = "decimal(20,2)"


def _level1(t):
    return t.leaf.groupBy("year", "kind", F.col("liv1_code").alias("code")).agg(F.sum("value").alias("value"))


@query("share_of_total", """
SELECT year, code, CAST(value AS DOUBLE) AS value, CAST(value AS DOUBLE) / CAST(gross AS DOUBLE) * 100 AS gross_share, CAST(value AS DOUBLE) / CAST(net AS DOUBLE) * 100 AS net_share
FROM (SELECT *, sum(value) OVER (PARTITION BY year) AS gross, sum(CASE WHEN code NOT IN ('04', '00') THEN value END) OVER (PARTITION BY year) AS net
 FROM (SELECT year, liv1_code AS code, sum(value) AS value FROM leaf WHERE kind = 'spesa' GROUP BY ALL)) WHERE code NOT IN ('04', '00')""", "leaf")
def share_of_total(t):
    rows = facts.where_equal(_level1(t), kind="spesa").drop("kind")
    shares = analytics.shares_of_totals(rows, "code", exclude=["04", "00"])
    return shares.select("year", "code", out(F.col("value")).alias("value"), "gross_share", "net_share")


@query("yoy_delta", """
SELECT a.comune, a.code, a.year, CAST(a.value AS DOUBLE) AS value, CAST(b.value AS DOUBLE) AS prior_value,
 (CAST(a.value AS DOUBLE) - CAST(b.value AS DOUBLE)) / nullif(abs(CAST(b.value AS DOUBLE)), 0) * 100 AS delta_pct
FROM member a LEFT JOIN member b ON a.comune = b.comune AND a.code = b.code AND a.year = b.year + 1""", "member")
def yoy_delta(t):
    changed = analytics.yoy_delta(t.member.drop("region"), ["comune", "code"])
    return changed.withColumns({c: out(F.col(c)) for c in ("value", "prior_value")})


@query("first_last_variation", """
SELECT *, last_value - first_value AS delta, CASE WHEN first_value = 0 THEN 0 ELSE (last_value - first_value) / first_value * 100 END AS delta_pct FROM (
 SELECT comune, code, min(year) AS first_year, max(year) AS last_year, CAST(arg_min(value, year) AS DOUBLE) AS first_value, CAST(arg_max(value, year) AS DOUBLE) AS last_value
 FROM member GROUP BY comune, code)""", "member")
def first_last_variation(t):
    return analytics.first_last_variation(t.member, ["comune", "code"])


@query("rank_by_latest", """
SELECT capitolo_code, CAST(latest AS DOUBLE) AS latest_value, row_number() OVER (ORDER BY latest DESC NULLS LAST, capitolo_code) AS rank FROM (
 SELECT capitolo_code, max(CASE WHEN year = (SELECT max(year) FROM leaf) THEN value END) AS latest FROM leaf WHERE kind = 'spesa' GROUP BY 1)""", "leaf")
def rank_by_latest(t):
    # The latest year is that of the whole table, so reversals stay in it.
    rows = facts.where_equal(t.leaf, kind="spesa").groupBy("capitolo_code", "year").agg(F.sum("value").alias("value"))
    return analytics.rank_by_latest(rows, "capitolo_code").withColumn("latest_value", out(F.col("latest_value")))


@query("missing_years", """
SELECT c.capitolo_code, y.year FROM (SELECT DISTINCT capitolo_code FROM leaf) c, (SELECT DISTINCT year FROM leaf) y
EXCEPT SELECT capitolo_code, year FROM leaf""", "leaf")
def missing_years(t):
    return analytics.missing_years(t.leaf, t.report, ["capitolo_code"])


@query("latest_n_years", """
SELECT entity_slug, year, category, seq, CAST(value AS DOUBLE) AS value FROM (SELECT *, dense_rank() OVER (PARTITION BY entity_slug ORDER BY year DESC) AS r FROM statement) WHERE r <= 2""", "statement")
def latest_n_years(t):
    kept = analytics.latest_years(t.statement, ["entity_slug"], 2)
    return kept.select("entity_slug", "year", "category", "seq", out(F.col("value")).alias("value"))


@query("pivot_measure_by_year", f"""
SELECT measure, {', '.join(f"max(CASE WHEN year = {y} THEN value END) AS y{y}" for y in range(1995, 2002))} FROM {SERIES_LONG} GROUP BY measure""", "series")
def pivot_measure_by_year(t):
    rows = series_long(t)
    return analytics.pivot_years(rows, ["measure"], analytics.years_of(rows))


@query("pivot_statement", """
SELECT entity_slug, category, seq, name, CAST(cur AS DOUBLE) AS y1998, CAST(prev AS DOUBLE) AS y1997, (CAST(cur AS DOUBLE) - CAST(prev AS DOUBLE)) / nullif(abs(CAST(prev AS DOUBLE)), 0) * 100 AS delta_pct
FROM (SELECT entity_slug, category, seq, name, max(CASE WHEN year = 1998 THEN value END) AS cur, max(CASE WHEN year = 1997 THEN value END) AS prev
 FROM statement WHERE year IN (1997, 1998) GROUP BY ALL)""", "statement")
def pivot_statement(t):
    rows = facts.where_equal(t.statement, year=[1997, 1998])
    wide = analytics.pivot_years(rows, ["entity_slug", "category", "seq", "name"], [1998, 1997])
    change = F.try_divide(F.col("y1998") - F.col("y1997"), F.abs("y1997")) * 100
    return wide.withColumn("delta_pct", change)


@query("net_position", """
SELECT entity_slug, year, CAST(credits AS DOUBLE) AS credits, CAST(debts AS DOUBLE) AS debts, CAST(credits - debts AS DOUBLE) AS net FROM (
 SELECT entity_slug, year, sum(CASE WHEN category = 'stato_patrimoniale_attivo' THEN value ELSE 0 END) AS credits,
  sum(CASE WHEN category = 'stato_patrimoniale_passivo' THEN value ELSE 0 END) AS debts FROM statement WHERE related_party = 'socio' GROUP BY 1, 2) WHERE credits <> 0 OR debts <> 0""", "statement")
def net_position(t):
    rows = analytics.net_position(t.statement, ["entity_slug", "year"], "socio", presets.ASSETS, presets.LIABILITIES)
    return rows.withColumns({c: out(F.col(c)) for c in ("credits", "debts", "net")})


@query("derived_balances", """
SELECT user_id, event_type, CAST(inizio AS DOUBLE) AS receipts, CAST(variazione AS DOUBLE) AS payments, CAST(inizio - variazione AS DOUBLE) AS balance,
 CAST(inizio + nullif(variazione, 0) AS DOUBLE) AS service FROM movement""", "movement")
def derived_balances(t):
    paid = F.col("variazione")
    wide = analytics.pivot_measures(t.note.withColumnRenamed("period", "measure"), ["user_id", "event_type"], ["inizio", "variazione"])
    return wide.select(
        "user_id",
        "event_type",
        out(F.col("inizio")).alias("receipts"),
        out(paid).alias("payments"),
        out(F.col("inizio") - paid).alias("balance"),
        out(analytics.derived_sum(F.col("inizio"), F.nullif(paid, F.lit(0)))).alias("service"),
    )


@query("per_capita", """
SELECT m.comune, m.year, m.code, CAST(m.value AS DOUBLE) AS value, p.residenti, coalesce(CAST(m.value AS DOUBLE) / p.residenti, CAST(m.value AS DOUBLE)) AS per_capita
FROM member m LEFT JOIN population p ON p.comune = m.comune AND p.year = m.year""", "member population")
def per_capita(t):
    rows = lookups.per_capita(t.member, t.population, ["comune", "year"], keep_raw=True)
    return rows.select("comune", "year", "code", out(F.col("value")).alias("value"), "residenti", "per_capita")


@query("compare_per_capita", """
SELECT m.comune, m.year, m.code, CAST(m.value AS DOUBLE) / p.residenti AS per_capita FROM member m JOIN population p ON p.comune = m.comune AND p.year = m.year""", "member population")
def compare_per_capita(t):
    return lookups.per_capita(t.member, t.population, ["comune", "year"], keep_raw=False).select("comune", "year", "code", "per_capita")


@query("compare_members", """
SELECT g.comune, g.code, g.in_base, CAST(coalesce(v.value, 0) AS DOUBLE) AS value, CAST(coalesce(v.value, 0) AS DOUBLE) / coalesce(CAST(tot.total AS DOUBLE), 1) * 100 AS share
FROM (SELECT a.code, a.in_base, m.comune FROM (SELECT code, bool_or(comune = 'NATION_3') AS in_base FROM member WHERE year = 1998 AND comune IN ('NATION_3', 'NATION_8', 'NATION_12') GROUP BY code) a,
 (VALUES ('NATION_3'), ('NATION_8'), ('NATION_12')) m(comune)) g
LEFT JOIN (SELECT * FROM member WHERE year = 1998) v ON v.comune = g.comune AND v.code = g.code
LEFT JOIN (SELECT comune, sum(value) AS total FROM member WHERE year = 1998 GROUP BY 1) tot ON tot.comune = g.comune""", "member")
def compare_members(t):
    rows = facts.where_equal(t.member, year=1998)
    aligned = lookups.compare_members(rows, "comune", "code", "NATION_3", ["NATION_8", "NATION_12"])
    return aligned.withColumn("value", out(F.col("value")))


@query("borrow_labels", """
SELECT o_orderkey, CASE WHEN substr(o_orderpriority, 1, 1) IN (SELECT max(substr(o_orderpriority, 1, 1)) FROM orders WHERE o_orderpriority LIKE '%-%' AND o_orderstatus = 'F' GROUP BY o_orderpriority)
  AND substr(o_orderpriority, 1, 1) < '4' THEN lower(o_orderpriority) ELSE o_orderpriority END AS name FROM orders""")
def borrow_labels(t):
    rows = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("code"), F.col("o_orderpriority").alias("name"))
    known = t.orders.where((F.col("o_orderstatus") == "F") & (F.substring("o_orderpriority", 1, 1) < "4")).select(
        F.substring("o_orderpriority", 1, 1).alias("code"), F.lower("o_orderpriority").alias("name")
    )
    return lookups.borrow_labels(rows, known).select("o_orderkey", "name")


@query("longest_prefix_lookup", """
SELECT p_partkey, CASE WHEN p_name LIKE 'red ring%' THEN 'ring in red' WHEN p_name LIKE 'red%' THEN 'red goods' WHEN p_name LIKE 'cold r%' THEN 'cold r goods' WHEN p_name LIKE 'cold%' THEN 'cold goods' END AS description FROM part""")
def longest_prefix_lookup(t):
    glossary = t.spark.createDataFrame(
        [("red", "red goods"), ("red ring", "ring in red"), ("cold", "cold goods"), ("cold r", "cold r goods")], "prefix string, description string"
    )
    named = t.raw("part").select("p_partkey", F.lower(X.collapse_spaces(F.col("p_name"))).alias("name"))
    return lookups.longest_prefix(named, "name", glossary).select("p_partkey", "description")


@query("code_descriptions", """
SELECT n_nationkey, CASE WHEN n_regionkey < 3 THEN 'region ' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') END AS description, o_orderkey FROM geo""", "geo")
def code_descriptions(t):
    described = t.raw("region").where(F.col("r_regionkey") < 3).select(
        X.pad_code(F.col("r_regionkey").cast("string")).alias("code"),
        F.concat(F.lit("region "), F.lpad(F.col("r_regionkey").cast("string"), 2, "0")).alias("description"),
    )
    code = X.pad_code(F.col("n_regionkey").cast("string"))
    return lookups.code_descriptions(t.order_geo, code, described).select("n_nationkey", "description", "o_orderkey")


@query("contract_budget_bridge", """
SELECT c.cig, c.anno, CAST(c.importo_aggiudicazione AS DOUBLE) AS importo_aggiudicazione, p.capitolo_code FROM contract c LEFT JOIN (
 SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS cig, lpad(CAST(min(l_partkey) AS VARCHAR), 12, '0') AS capitolo_code FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_suppkey) p
ON p.cig = c.cig""", "contract")
def contract_budget_bridge(t):
    pairs = t.raw("lineitem").where(F.col("l_returnflag") == "R").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")).alias("cig"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("capitolo_code"),
    )
    return lookups.contract_budget_bridge(t.contract, pairs).select(
        "cig", "anno", out(F.col("importo_aggiudicazione")).alias("importo_aggiudicazione"), "capitolo_code"
    )


@query("ordered_dedup", "SELECT l_suppkey, l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1, 2")
def ordered_dedup_query(t):
    return ordered_dedup(t.raw("lineitem").select("l_suppkey", "l_partkey", "l_orderkey"), ["l_suppkey", "l_partkey"], "l_orderkey")


@query("rollup_with_total", """
WITH s AS (SELECT year, liv1_code AS code, max(liv1_name) AS name, sum(CASE WHEN kind = 'spesa' THEN value ELSE 0 END) AS impegni, sum(CASE WHEN kind = 'spesa' AND liv3_code IS NULL THEN value ELSE 0 END) AS residui
  FROM leaf GROUP BY year, liv1_code),
 items AS (SELECT year, code, name, 'impegni' AS measure, impegni AS value, impegni <> 0 OR residui <> 0 AS live FROM s UNION ALL SELECT year, code, name, 'residui', residui, impegni <> 0 OR residui <> 0 FROM s)
SELECT year, 'voce' AS level, code, name, measure, CAST(value AS DOUBLE) AS value FROM items WHERE live UNION ALL
SELECT year, 'totale', NULL, 'Totale generale', measure, CAST(sum(value) AS DOUBLE) FROM items GROUP BY year, measure""", "leaf")
def rollup_with_total(t):
    spent = F.when(F.col("kind") == "spesa", F.col("value")).otherwise(F.lit(0))
    rows = t.leaf.select(
        "year",
        F.col("liv1_code").alias("code"),
        F.col("liv1_name").alias("name"),
        spent.cast("decimal(30,2)").alias("impegni"),
        F.when(F.col("liv3_code").isNull(), spent).otherwise(0).cast("decimal(30,2)").alias("residui"),
    )
    return hierarchy.rollup_to_parent(rows, ["year"], ["impegni", "residui"], "Totale generale").withColumn("value", out(F.col("value")))


@query("normalize_side", """
WITH s AS (SELECT comune, CAST(CAST(code AS INT) AS VARCHAR) AS code, max(name) AS name, sum(previsioni) AS previsioni, sum(accertamenti) AS accertamenti FROM (
  SELECT n_name AS comune, '0' || substr(o_orderpriority, 1, 1) AS code, lower(substr(o_orderpriority, 3)) AS name, CAST(o_totalprice AS DECIMAL(20,2)) AS previsioni,
   CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(20,2)) ELSE 0 END AS accertamenti FROM geo) GROUP BY 1, 2),
 items AS (SELECT comune, code, name, 'previsioni' AS measure, previsioni AS value, previsioni <> 0 OR accertamenti <> 0 AS live FROM s UNION ALL SELECT comune, code, name, 'accertamenti', accertamenti, previsioni <> 0 OR accertamenti <> 0 FROM s)
SELECT comune, 'voce' AS level, code, name, measure, CAST(value AS DOUBLE) AS value FROM items WHERE live UNION ALL
SELECT comune, 'totale', NULL, 'Totale generale delle entrate', measure, CAST(sum(value) AS DOUBLE) FROM items GROUP BY comune, measure""", "geo")
def normalize_side(t):
    """Text columns of one side, as the delimited files carry them."""
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    printed = t.order_geo.select(
        F.col("n_name").alias("comune"),
        F.concat(F.lit(" 0"), F.substring("o_orderpriority", 1, 1), F.lit(" ")).alias("Codice Titolo"),
        F.lower(F.substring("o_orderpriority", 3, 20)).alias("Descrizione Titolo"),
        price.alias("Previsioni Definitive di Competenza"),
        F.when(F.col("o_orderstatus") == "F", price).otherwise("").alias("Accertamenti"),
    )
    columns = {"Previsioni Definitive di Competenza": "previsioni", "Accertamenti": "accertamenti"}
    rows = readers.normalize_side(printed, ["comune"], "Codice Titolo", "Descrizione Titolo", columns, "Totale generale delle entrate", unpad=True)
    return rows.withColumn("value", out(F.col("value")))


@query("unfold_matrix_row", """
WITH g AS (SELECT c.comune, v.code, v.slot, CAST(coalesce(m.value, 0) AS DECIMAL(20,2)) AS value FROM (SELECT DISTINCT comune FROM member WHERE year = 1998) c
  CROSS JOIN (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY')) v0(code) CROSS JOIN LATERAL (VALUES (v0.code, 0), (v0.code, 2)) v(code, slot)
  LEFT JOIN member m ON m.comune = c.comune AND m.code = v.code AND m.year = CASE v.slot WHEN 0 THEN 1998 ELSE 1997 END),
 live AS (SELECT comune, code FROM g GROUP BY 1, 2 HAVING max(abs(value)) > 0)
SELECT g.comune, 'voce' AS level, g.code, CASE g.slot WHEN 0 THEN 'impegni' ELSE 'pagamenti_totali' END AS measure, CAST(g.value AS DOUBLE) AS value FROM g JOIN live USING (comune, code)
UNION ALL SELECT comune, 'totale', NULL, CASE slot WHEN 0 THEN 'impegni' ELSE 'pagamenti_totali' END, CAST(sum(value) AS DOUBLE) FROM g GROUP BY comune, slot""", "member")
def unfold_matrix_row(t):
    codes = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    zero = F.lit(0).cast("decimal(30,2)")
    at = lambda code, year: F.coalesce(
        F.sum(F.when((F.col("code") == code) & (F.col("year") == year), F.col("value"))), zero
    ).cast("decimal(30,2)")
    total = lambda year: F.coalesce(F.sum(F.when(F.col("year") == year, F.col("value"))), zero).cast("decimal(30,2)")
    cells = [c for code in codes for c in (at(code, 1998), zero, at(code, 1997))]
    wide = t.member.groupBy("comune").agg(F.array(*cells, zero, total(1998), zero, total(1997)).alias("cells"))
    rows = hierarchy.unfold_matrix_row(wide, ["comune"], "cells", codes, 3, {0: "impegni", 2: "pagamenti_totali"})
    return rows.withColumn("value", out(F.col("value")))


@query("load_report", """
SELECT anno, count(*) AS n_contracts, CAST(sum(importo_aggiudicazione) AS DOUBLE) AS awarded, count(DISTINCT oggetto || '/' || struttura) AS n_subjects FROM contract GROUP BY anno""", "contract")
def load_report(t):
    return t.contract.groupBy("anno").agg(
        F.count("*").alias("n_contracts"),
        out(F.sum("importo_aggiudicazione")).alias("awarded"),
        F.countDistinct("oggetto", "struttura").alias("n_subjects"),
    )


@query("display_labels", """
SELECT domain, CASE domain WHEN 'residuo_iniziale' THEN 'Residuo debito a inizio anno' WHEN 'debito_fine_anno' THEN 'Debito residuo a fine anno' WHEN 'oneri_finanziari' THEN 'Oneri finanziari (interessi passivi)'
 ELSE upper(substr(replace(domain, '_', ' '), 1, 1)) || lower(substr(replace(domain, '_', ' '), 2)) END AS label
FROM (SELECT measure AS domain FROM """ + SERIES_LONG + """ UNION ALL SELECT replace(p_name, ' ', '_') FROM part)""", "series")
def display_labels(t):
    keys = series_long(t).select(F.col("measure").alias("domain")).unionByName(
        t.raw("part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("domain"))
    )
    return keys.select("domain", X.display_label(F.col("domain"), presets.MEASURE_LABELS).alias("label"))
