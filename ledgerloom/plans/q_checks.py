"""Reconciliation checks over the adapter views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions.numbers import to_output as out
from ledgerloom.operators import checks, lookups
from ledgerloom.plans.registry import query


def _verdict(name: str, failed: str, source: str, need: bool = False, extra: str = "") -> str:
    some = " AND count(*) > 0" if need else ""
    return f"""SELECT '{name}' AS "check", count(*) AS checked, count(*) FILTER ({failed}) AS failed, count(*) FILTER ({failed}) = 0{some}{extra} AS passed FROM {source}"""


IDENTITY_SQL = _verdict(
    "balance_sheet_identity",
    "assets IS NULL OR liabilities IS NULL OR assets <> liabilities",
    """(SELECT entity_slug, year, max(CASE WHEN name = 'TOTALE ATTIVO' THEN value END) AS assets, max(CASE WHEN name = 'TOTALE PASSIVO' THEN value END) AS liabilities FROM statement GROUP BY 1, 2)""",
)


def _identity(t):
    printed = t.statement.withColumn(
        "name",
        F.when(F.col("name") == "TOTALE ATTIVO", "Totale dell'attivo").when(F.col("name") == "TOTALE PASSIVO", "TOTALE DEL").otherwise(F.col("name")),
    )
    cases = checks.identity_cases(
        printed, ["entity_slug", "year"], "seq", "name", "category", [presets.ASSETS], [presets.LIABILITIES], "value"
    )
    return checks.check_identity(cases)


@query("check_balance_identity", IDENTITY_SQL, "statement")
def check_balance_identity(t):
    return _identity(t)


@query("check_identities", """
WITH p AS (SELECT entity_slug, year, max(CASE WHEN name = 'TOTALE ATTIVO' THEN value END) AS assets, max(CASE WHEN name = 'TOTALE PASSIVO' THEN value END) AS owed FROM statement GROUP BY 1, 2)
SELECT 'balance_sheet_identity_current' AS "check", count(*) AS checked, count(*) FILTER (assets IS NULL OR owed IS NULL OR assets <> owed) AS failed, count(*) FILTER (assets IS NULL OR owed IS NULL OR assets <> owed) = 0 AS passed FROM p
UNION ALL SELECT 'balance_sheet_identity_prior', count(*), count(*) FILTER (assets IS NULL OR owed IS NULL), count(*) FILTER (assets IS NULL OR owed IS NULL) = 0 FROM p
UNION ALL SELECT 'aggregate_balance_sheet_identity', count(*), count(*) FILTER (assets IS NULL OR owed IS NULL), count(*) FILTER (assets IS NULL OR owed IS NULL) = 0 FROM p WHERE year = 1997""", "statement")
def check_identities(t):
    """Consolidated sheets of two years, and aggregates that only the reports of one year print."""
    name = F.when(F.col("name") == "TOTALE ATTIVO", "Totale dell'attivo").when(F.col("name") == "TOTALE PASSIVO", "TOTALE DEL").otherwise(F.col("name"))
    family = F.when(F.col("category") == presets.ASSETS, "balance_sheet_assets").when(F.col("category") == presets.LIABILITIES, "balance_sheet_liabilities").otherwise("income_statement")
    lines = t.statement.select("entity_slug", "year", "seq", name.alias("name"), family.alias("family"), F.col("value").alias("current"), F.when(F.col("is_total"), 5).otherwise(F.col("seq")).cast("decimal(30,2)").alias("prior"))
    aggregate = lines.where(F.col("year") == 1997).select("entity_slug", "year", "seq", "name", F.concat(F.lit("aggregate_"), "family").alias("family"), F.col("prior").alias("current"), F.lit(None).cast("decimal(30,2)").alias("prior"))
    return checks.check_identities(lines.unionByName(aggregate), ["entity_slug", "year"], "seq", "name", "family", "current", "prior")


@query("statement_reconcile", """
SELECT entity_slug, year, CAST(assets AS DOUBLE) AS assets, CAST(liabilities AS DOUBLE) AS liabilities, coalesce(assets = liabilities, FALSE) AS balanced FROM (
 SELECT entity_slug, year, max(CASE WHEN name = 'TOTALE ATTIVO' THEN value END) AS assets, max(CASE WHEN name = 'TOTALE PASSIVO' THEN value END) AS liabilities FROM statement GROUP BY 1, 2)""", "statement")
def statement_reconcile(t):
    rows = checks.statement_reconcile(t.statement, ["entity_slug", "year"], "civil")
    return rows.select("entity_slug", "year", out(F.col("assets")).alias("assets"), out(F.col("liabilities")).alias("liabilities"), "balanced")


# How each scheme's lines are printed - assets, liabilities, result in the income statement and in equity.
SCHEME_LINES = {
    "civil": ("TOTALE ATTIVO", "TOTALE PASSIVO E NETTO", "21) UTILE (PERDITA) DELL'ESERCIZIO", "IX - Utile (perdita) dell'esercizio"),
    "four_column": ("Totale attività", "Totale patrimonio netto e passività", "Risultato netto del periodo", "Risultato netto del periodo"),
    "consolidated": ("Totale attività", "Totale patrimonio netto e passività", "Risultato attribuibile agli azionisti", "Risultato netto del periodo"),
    "form": ("Totale attivo", "Totale passivo", None, None),
}


def _scheme_lines(t, scheme: str):
    """Lines of each nation and year: totals and results that agree, differ or are absent, by the length and sound of names."""
    assets, liabilities, income, equity = SCHEME_LINES[scheme]
    price = F.col("o_totalprice").cast("decimal(20,2)")
    sums = t.order_geo.groupBy(F.col("n_name").alias("entity_slug"), "year", F.col("n_nationkey").alias("k")).agg(
        F.sum(price).alias("total"), F.sum(F.when(F.col("o_orderstatus") == "F", price).otherwise(0)).alias("result")
    )

    def line(seq: int, category: str, name: str | None, value):
        return F.struct(F.lit(seq).alias("seq"), F.lit(category).alias("category"), F.lit(name).alias("name"), value.cast("decimal(20,2)").alias("value"))

    def off(by: int):
        return F.when(F.col("k") % by == 0, 1).otherwise(0)

    printed = F.array(
        line(1, presets.ASSETS, "Crediti", F.col("total") / 2),
        line(2, presets.ASSETS, assets, F.col("total")),
        line(3, presets.LIABILITIES, equity, F.when(F.col("k") % 5 != 0, F.col("result") + off(4))),
        line(4, presets.LIABILITIES, liabilities, F.col("total") + off(3)),
        line(5, presets.INCOME, income, F.col("result")),
    )
    rows = sums.select("entity_slug", "year", F.inline(printed))
    return rows.where("name IS NOT NULL AND value IS NOT NULL").withColumn("related_party", F.lit(None).cast("string"))


def _results_sql(scheme: str) -> str:
    shown = SCHEME_LINES[scheme][2] is not None
    income, equity = ("r", "CASE WHEN k % 5 <> 0 THEN r + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END END") if shown else ("NULL", "NULL")
    return f"""
WITH s AS (SELECT n_name AS entity_slug, year, n_nationkey AS k, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS t, sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(20,2)) ELSE 0 END) AS r FROM geo GROUP BY ALL),
 v AS (SELECT entity_slug, year, t AS assets, t + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS liabilities, {income} AS income_result, {equity} AS equity_result FROM s)
SELECT entity_slug, year, CAST(assets AS DOUBLE) AS assets, CAST(liabilities AS DOUBLE) AS liabilities, CAST(income_result AS DOUBLE) AS income_result, CAST(equity_result AS DOUBLE) AS equity_result,
 assets = liabilities AS totals_match, coalesce(income_result = equity_result, TRUE) AS results_match, assets = liabilities AND coalesce(income_result = equity_result, TRUE) AS balanced FROM v"""


def _register_results(scheme: str) -> None:
    @query(f"statement_results_{scheme}", _results_sql(scheme), "geo")
    def results(t):
        rows = checks.statement_reconcile(_scheme_lines(t, scheme), ["entity_slug", "year"], scheme)
        amounts = [out(F.col(c)).alias(c) for c in ("assets", "liabilities", "income_result", "equity_result")]
        return rows.select("entity_slug", "year", *amounts, "totals_match", "results_match", "balanced")


for _scheme in SCHEME_LINES:
    _register_results(_scheme)


NOT_NULL_SQL = _verdict("no_malformed_metric_values", "importo_liquidato IS NULL", "contract WHERE n_partecipanti > 1")


@query("check_not_null", NOT_NULL_SQL, "contract")
def check_not_null(t):
    return checks.check_present(t.contract, F.col("n_partecipanti") > 1, "importo_liquidato")


MOVEMENTS_SQL = _verdict("movements_identity", "abs(inizio + variazione - fine) > 0.05", "movement")


@query("check_movements", MOVEMENTS_SQL, "movement")
def check_movements(t):
    return checks.check_movements(t.note, ["user_id", "event_type"])


def _items(t):
    """Level-1 items and, as printed total, the sum over the plain customers."""
    items = t.leaf.groupBy("year", "kind", "measure", F.col("liv1_code").alias("code")).agg(F.sum("value").alias("value"))
    totals = t.leaf.where(F.col("liv3_code").isNotNull()).groupBy("year", "kind", "measure").agg(F.sum("value").alias("value"))
    return items.withColumn("level", F.lit("voce")).unionByName(
        totals.withColumns({"level": F.lit("totale"), "code": F.lit(None).cast("string")})
    )


@query("check_item_totals", _verdict("item_totals", "abs(item_sum - total) > 0.05", """
(SELECT year, kind, measure, sum(value) AS item_sum, sum(CASE WHEN liv3_code IS NOT NULL THEN value END) AS total FROM leaf GROUP BY ALL) WHERE total IS NOT NULL""", need=True), "leaf")
def check_item_totals(t):
    return checks.check_item_totals(_items(t), ["year"])


CHAIN_SQL = _verdict("series_chain", "a.closing <> b.opening", "series a JOIN series b ON b.year = a.year + 1", extra=" AND (SELECT count(*) FROM series) > 1")


@query("check_chain", CHAIN_SQL, "series")
def check_chain(t):
    return checks.check_chain(t.series, [], "closing", "opening")


@query("chain_continuity", """
SELECT a.comune, a.code, a.year, CAST(a.value AS DOUBLE) AS closing, CAST(b.value AS DOUBLE) AS opening, a.value = b.value AS chained
FROM member a JOIN member b ON a.comune = b.comune AND a.code = b.code AND b.year = a.year + 1""", "member")
def chain_continuity(t):
    rows = t.member.select("comune", "code", "year", F.col("value").alias("closing"), F.col("value").alias("opening"))
    pairs = lookups.next_year_pairs(rows, ["comune", "code"], "closing", "opening")
    return pairs.select(
        "comune", "code", "year", out(F.col("closing")).alias("closing"), out(F.col("opening")).alias("opening"),
        (F.col("closing") == F.col("opening")).alias("chained"),
    )


@query("check_per_capita", _verdict("per_capita", "abs(closing / people - printed) > 0.5", """
(SELECT CAST(closing AS DOUBLE) AS closing, people, CASE WHEN year < 1998 THEN floor(CAST(closing AS DOUBLE) / people) + 0.5 ELSE 0.0 END AS printed FROM series)"""), "series")
def check_per_capita(t):
    exact = F.col("closing").cast("double") / F.col("people")
    printed = F.when(F.col("year") < 1998, F.floor(exact) + F.lit(0.5)).otherwise(F.lit(0.0)).cast("decimal(30,2)")
    return checks.check_per_capita(t.series.withColumn("printed", printed), "closing", "people", "printed")


def _level1_totals(t):
    """Level-1 totals straight from the orders, customers in debt left out."""
    kind = F.when(F.col("o_orderstatus") == "F", "entrata").otherwise("spesa")
    amount = F.col("o_totalprice").cast("decimal(20,2)")
    signed = F.when(F.col("o_orderpriority") == "1-URGENT", -amount).otherwise(amount)
    kept = F.when((F.col("r_name") == "ASIA") & (F.col("c_acctbal") < 0), F.lit(0)).otherwise(signed)
    return t.order_geo.groupBy("year", kind.alias("kind"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("liv1_code")).agg(
        F.sum(kept).alias("value")
    )


LEVEL1_SQL = """(SELECT year, CASE WHEN o_orderstatus = 'F' THEN 'entrata' ELSE 'spesa' END AS kind, lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS liv1_code,
 sum(CASE WHEN r_name = 'ASIA' AND c_acctbal < 0 THEN 0 WHEN o_orderpriority = '1-URGENT' THEN -CAST(o_totalprice AS DECIMAL(20,2)) ELSE CAST(o_totalprice AS DECIMAL(20,2)) END) AS expected FROM geo GROUP BY ALL)"""
DETAIL_SQL = f"""(SELECT e.year, e.kind, e.liv1_code, expected, coalesce(d.s, 0) AS detail_sum FROM {LEVEL1_SQL} e LEFT JOIN
 (SELECT year, kind, liv1_code, sum(value) AS s FROM leaf GROUP BY ALL) d USING (year, kind, liv1_code))"""


@query("reconcile_detail_to_total", f"""
SELECT year, kind, liv1_code, CAST(expected AS DOUBLE) AS expected, CAST(detail_sum AS DOUBLE) AS detail_sum, CAST(detail_sum - expected AS DOUBLE) AS delta, abs(detail_sum - expected) <= 1 AS matched FROM {DETAIL_SQL}""", "leaf")
def reconcile_detail_to_total(t):
    rows = lookups.detail_against_totals(t.leaf, _level1_totals(t), ["year", "kind", "liv1_code"])
    return rows.withColumns({c: out(F.col(c)) for c in ("expected", "detail_sum", "delta")})


@query("check_leaves_to_aggregate", _verdict("leaves_per_item", "abs(detail_sum - expected) > 1", DETAIL_SQL, need=True), "leaf")
def check_leaves_to_aggregate(t):
    return checks.check_leaves(t.leaf, _level1_totals(t), ["year", "kind", "liv1_code"], "leaves_per_item")


CROSS_SQL = _verdict("cross_source", "abs(a.v - b.v) > 0.01", """(SELECT comune, year, sum(value) AS v FROM member GROUP BY 1, 2) a JOIN
 (SELECT n_name AS comune, year, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS v FROM geo GROUP BY 1, 2) b USING (comune, year)""", need=True)


@query("check_cross_source", CROSS_SQL, "member")
def check_cross_source(t):
    left = t.member.groupBy("comune", "year").agg(F.sum("value").alias("value"))
    right = t.order_geo.groupBy(F.col("n_name").alias("comune"), "year").agg(F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("value"))
    return checks.check_cross_source(left, right, ["comune", "year"])


@query("check_report", f"""
SELECT *, bool_and(passed) OVER () AS report_passed FROM ({CHAIN_SQL} UNION ALL {MOVEMENTS_SQL} UNION ALL {IDENTITY_SQL} UNION ALL {NOT_NULL_SQL})""", "series movement statement contract")
def check_report(t):
    return checks.check_report(
        [
            checks.check_chain(t.series, [], "closing", "opening"),
            checks.check_movements(t.note, ["user_id", "event_type"]),
            _identity(t),
            checks.check_present(t.contract, F.col("n_partecipanti") > 1, "importo_liquidato"),
        ]
    )
