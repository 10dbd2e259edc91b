"""Reconciliation checks that gate a load.

Every check returns one row ``(check, checked, failed, passed)``. Some pass
when nothing could be checked and some fail; each says which. Tolerances are
exact decimals, so the outcome does not depend on partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.operators.lookups import detail_against_totals, next_year_pairs
from ledgerloom.operators.ordered import SLICE, ordered_scan

MONEY = "decimal(30,2)"


def _tolerance(value: str) -> Column:
    return F.lit(value).cast("decimal(20,2)")


def summarize(cases: DataFrame, name: str, failed: Column, *, need_cases: bool) -> DataFrame:
    """Fold one row per checked case into the check's result row."""
    counted = cases.agg(
        F.count("*").alias("checked"), F.coalesce(F.count_if(failed), F.lit(0)).cast("bigint").alias("failed")
    )
    ok = F.col("failed") == 0
    if need_cases:
        ok = ok & (F.col("checked") > 0)
    return counted.select(F.lit(name).alias("check"), "checked", "failed", ok.alias("passed"))


def first_total(pos: str, value: Column, where: Column) -> Column:
    """Aggregate: the first matching printed value."""
    return F.min_by(value, F.when(where, F.col(pos)))


def identity_cases(
    lines: DataFrame, keys: list[str], pos: str, name: str, family: str, assets: list[str], liabilities: list[str], value: str
) -> DataFrame:
    """Total assets and total liabilities of every statement, side by side.

    A bare "totale del" among the family's rows is the liabilities total, whose
    last word may be printed on the next line.
    """
    text = F.lower(F.trim(F.col(name)))
    inside = F.col(family).isin(*assets, *liabilities)
    left = first_total(pos, F.col(value), inside & text.startswith("totale dell'attivo"))
    right = first_total(pos, F.col(value), inside & text.startswith("totale del") & ~F.contains(text, F.lit("attivo")))
    return lines.groupBy(*keys).agg(left.alias("assets"), right.alias("liabilities"))


def check_identities(
    lines: DataFrame, keys: list[str], pos: str, name: str, family: str, current: str, prior: str
) -> DataFrame:
    """The balance identities of a report: the consolidated sheet in both years, the aggregate in one.

    One row ``(check, checked, failed, passed)`` each. The consolidated sheet
    is due in every document; the aggregate only where a document prints any of
    its rows, so its check may have nothing to compare and then passes.
    """
    text = F.lower(F.trim(F.col(name)))
    left = text.startswith("totale dell'attivo")
    right = text.startswith("totale del") & ~F.contains(text, F.lit("attivo"))
    parts = {
        "balance_sheet_identity_current": (presets.CONSOLIDATED_SHEET, current),
        "balance_sheet_identity_prior": (presets.CONSOLIDATED_SHEET, prior),
        "aggregate_balance_sheet_identity": (presets.AGGREGATE_SHEET, current),
    }
    totals = lines.groupBy(*keys).agg(
        F.max(F.col(family).isin(*presets.AGGREGATE_SHEET)).alias("_aggregate"),
        *[
            first_total(pos, F.col(value), F.col(family).isin(*families) & where).alias(f"{check}/{side}")
            for check, (families, value) in parts.items()
            for side, where in (("left", left), ("right", right))
        ],
    )
    cases = F.array(
        *[F.struct(F.lit(c).alias("check"), F.col(f"{c}/left").alias("assets"), F.col(f"{c}/right").alias("liabilities")) for c in parts]
    )
    due = lambda c: (c["check"] != "aggregate_balance_sheet_identity") | F.col("_aggregate")
    long = totals.select(F.inline(F.filter(cases, due)))
    differs = ~F.coalesce(F.col("assets") == F.col("liabilities"), F.lit(False))
    return long.groupBy("check").agg(F.count("*").alias("checked"), F.count_if(differs).alias("failed")).withColumn(
        "passed", F.col("failed") == 0
    )


def check_identity(cases: DataFrame, name: str = "balance_sheet_identity") -> DataFrame:
    """Assets equal liabilities exactly; a missing total fails."""
    same = F.coalesce(F.col("assets") == F.col("liabilities"), F.lit(False))
    return summarize(cases, name, ~same, need_cases=False)


def check_present(rows: DataFrame, required: Column, value: str, name: str = "no_malformed_metric_values") -> DataFrame:
    """Rows that must carry a value do."""
    return summarize(rows.where(required), name, F.col(value).isNull(), need_cases=False)


def subtotal_groups(
    lines: DataFrame, keys: list[str], pos: str, code: str, name: str, value: str, width: int = SLICE
) -> DataFrame:
    """Lettered children with the valued line above them that they break down.

    Rows with neither a value nor a letter are page headers and are skipped;
    an "of which" child ends the group. The parent of a group opened by an "of
    which" row is that row.
    """
    letter = F.coalesce(F.col(code).rlike(r"^[a-z]$"), F.lit(False))
    child = letter & ~F.lower(F.col(name)).startswith("di cui")
    kept = lines.where(letter | F.col(value).isNotNull()).withColumn("_child", child)
    grouped = ordered_scan(kept, keys, pos, running={"_group": (~F.col("_child")).cast("int")}, width=width)
    kids = F.col("_child")
    return (
        grouped.where(F.col("_group") > 0)
        .groupBy(*keys, "_group")
        .agg(
            F.max(F.when(~kids, F.col(value))).alias("parent"),
            F.max(F.when(~kids, F.col(name))).alias("parent_name"),
            F.count_if(kids).alias("children"),
            F.count_if(kids & F.col(value).isNull()).alias("blank_children"),
            F.sum(F.when(kids, F.col(value))).alias("children_sum"),
        )
        .where((F.col("children") > 0) & (F.col("blank_children") == 0) & F.col("parent").isNotNull())
        .withColumn("delta", F.col("parent") - F.col("children_sum"))
    )


def check_subtotals(groups: DataFrame, name: str = "statement_subtotals") -> DataFrame:
    """Parent equals the sum of its children within 0.05; passes when none."""
    return summarize(groups, name, F.abs("delta") > _tolerance("0.05"), need_cases=False)


def section_totals(
    lines: DataFrame, keys: list[str], pos: str, code: str, name: str, value: str, width: int = SLICE
) -> DataFrame:
    """Printed totals of sections A and B with the sum of their numbered lines.

    A marker row opens a section and the next "totale … gestione" row closes
    it; rows outside an open section count for nothing.
    """
    mark = F.coalesce(F.trim(F.col(code)).isin("A", "B"), F.lit(False))
    text = F.lower(F.col(name))
    closing = text.startswith("totale") & F.contains(text, F.lit("gestione")) & F.col(value).isNotNull() & ~mark
    numbered = F.coalesce(F.trim(F.col(code)).rlike(r"^\d+$"), F.lit(False)) & F.col(value).isNotNull() & ~mark
    scanned = ordered_scan(
        lines.withColumns({"_mark": mark, "_close": closing, "_line": numbered}),
        keys,
        pos,
        running={"_section": F.col("_mark").cast("int")},
        last={"_opened": F.when(F.col("_mark"), F.col(pos)), "_closed": F.when(F.col("_close"), F.col(pos))},
        before=("_closed",),
        width=width,
    )
    # A row counts while no closing row lies between it and its section's mark.
    rows = scanned.where((F.col("_section") > 0) & (F.coalesce("_closed", F.col("_opened") - 1) < F.col("_opened")))
    zero = F.lit(0).cast(MONEY)
    sums = rows.groupBy(*keys, "_section").agg(
        F.max(F.when(F.col("_close"), F.col(value))).alias("printed"),
        F.coalesce(F.sum(F.when(F.col("_line"), F.col(value))), zero).alias("line_sum"),
    )
    return sums.where(F.col("printed").isNotNull()).withColumn("delta", F.col("printed") - F.col("line_sum"))


def check_section_totals(sections: DataFrame, name: str = "income_section_totals") -> DataFrame:
    """Section total equals its lines within 0.05; passes when none."""
    return summarize(sections, name, F.abs("delta") > _tolerance("0.05"), need_cases=False)


def check_movements(items: DataFrame, keys: list[str], periods=("inizio", "variazione", "fine"), name="movements_identity") -> DataFrame:
    """Opening plus change equals closing within 0.05, where all three exist.

    Input is long (``period``, ``value``); passes when nothing is complete.
    """
    part = lambda p: F.max(F.when(F.col("period") == p, F.col("value")))
    wide = items.groupBy(*keys).agg(*[part(p).alias(f"_{i}") for i, p in enumerate(periods)])
    full = wide.where(F.col("_0").isNotNull() & F.col("_1").isNotNull() & F.col("_2").isNotNull())
    return summarize(full, name, F.abs(F.col("_0") + F.col("_1") - F.col("_2")) > _tolerance("0.05"), need_cases=False)


def check_item_totals(items: DataFrame, scope: list[str], reconciled=presets.RECONCILED_MEASURES, name="item_totals") -> DataFrame:
    """Sum of the items equals the printed total per scope, kind and measure.

    Only the listed measures are reconciled; fails when no total was found.
    """
    pairs = [(F.col("kind") == k) & F.col("measure").isin(*m) for k, m in reconciled.items()]
    chosen = items.where(reduce(lambda a, b: a | b, pairs) & F.col("value").isNotNull())
    item = F.col("level") == "voce"
    sums = chosen.groupBy(*scope, "kind", "measure").agg(
        F.coalesce(F.sum(F.when(item, F.col("value"))), F.lit(0).cast(MONEY)).alias("item_sum"),
        F.max(F.when(F.col("level") == "totale", F.col("value"))).alias("total"),
    )
    cases = sums.where(F.col("total").isNotNull())
    return summarize(cases, name, F.abs(F.col("item_sum") - F.col("total")) > _tolerance("0.05"), need_cases=True)


def check_chain(series: DataFrame, keys: list[str], closing: str, opening: str, name: str = "series_chain") -> DataFrame:
    """Closing of a year equals the opening of the next, exactly.

    Fails when the series has a single year or none.
    """
    pairs = next_year_pairs(series, keys, closing, opening)
    result = summarize(pairs, name, F.col(closing) != F.col(opening), need_cases=False)
    years = series.select("year").distinct().limit(2).agg(F.count("*")).scalar()
    return result.withColumn("passed", F.col("passed") & (years > 1))


def check_per_capita(series: DataFrame, total: str, people: str, printed: str, name: str = "per_capita") -> DataFrame:
    """Printed per-capita figure within 0.5 of total over residents."""
    full = series.where(
        F.col(total).isNotNull() & F.col(printed).isNotNull() & (F.coalesce(F.col(people), F.lit(0)) != 0)
    )
    expected = F.col(total) / F.col(people).cast("decimal(12,0)")
    return summarize(full, name, F.abs(expected - F.col(printed)) > _tolerance("0.5"), need_cases=False)


def check_leaves(leaves: DataFrame, totals: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Leaves add up to the printed aggregate within 1.00; fails when none."""
    cases = detail_against_totals(leaves, totals, keys)
    return summarize(cases, name, ~F.col("matched"), need_cases=True)


def check_cross_source(left: DataFrame, right: DataFrame, keys: list[str], name: str = "cross_source") -> DataFrame:
    """The same total from two sources agrees within 0.01."""
    joined = left.select(*keys, F.col("value").alias("_a")).join(right.select(*keys, F.col("value").alias("_b")), keys)
    return summarize(joined, name, F.abs(F.col("_a") - F.col("_b")) > _tolerance("0.01"), need_cases=True)


def scheme_line(text: Column, scheme: str, which: str) -> Column | None:
    """Whether a label (upper case, without spaces) is the scheme's line for a total or a result; None where it has none.

    The words are fixed values: how the statements of each scheme are printed.
    """
    begins = text.startswith
    has = lambda words: F.contains(text, F.lit(words))
    period_result = has("RISULTATONETTO") & has("PERIODO")
    lines = {
        "civil": {
            "assets": (text == "TOTALEATTIVO") | begins("TOTALEDELL'ATTIVO"),
            "liabilities": (text == "TOTALEPASSIVO") | begins("TOTALEPASSIVOENET") | begins("TOTALEDELPASSIVO"),
            "income_result": begins("21)UTILE") | has("UTILE(PERDITA)DELL'ESER") | has("RISULTATODELL'ESER"),
            "equity_result": has("UTILE(PERDITA)D'ESERCIZIO") | has("UTILE(PERDITA)DELL'ESERCIZIO") | has("RISULTATOECONOMICODELL'ESER"),
        },
        "four_column": {
            "assets": begins("TOTALEATTIV") & ~has("CORRENTI"),
            "liabilities": has("PATRIMONIO") & has("PASSIVIT"),
            "income_result": period_result & ~has("ATTIVITA"),
            "equity_result": period_result,
        },
        "consolidated": {
            "assets": begins("TOTALEATTIV") & ~has("CORRENTI"),
            "liabilities": has("PATRIMONIO") & has("PASSIVIT"),
            "income_result": has("ATTRIBUIBILEAGLI") & has("AZIONISTI"),
            "equity_result": period_result,
        },
        "form": {"assets": text == "TOTALEATTIVO", "liabilities": text == "TOTALEPASSIVO"},
    }
    return lines[scheme].get(which)


def statement_reconcile(items: DataFrame, keys: list[str], scheme: str = "civil", pos: str = "seq") -> DataFrame:
    """Totals and results of each entity and year, in one grouping.

    ``balanced`` needs both totals and equality; a result present on one side
    only is not compared. Lines toward related parties never count as totals.
    """
    # The form's scheme looks in every category, the others in the right one.
    anywhere = scheme == "form"
    text = F.upper(F.replace(F.col("name"), F.lit(" "), F.lit("")))

    def pick(which: str, category: str) -> Column:
        line = scheme_line(text, scheme, which)
        if line is None:
            return F.lit(None).cast("decimal(20,2)")
        hit = F.col("related_party").isNull() & line
        if not anywhere:
            hit = hit & (F.col("category") == category)
        order = F.struct(F.col("category"), F.col(pos)) if anywhere else F.col(pos)
        return F.min_by("value", F.when(hit, order))

    found = items.groupBy(*keys).agg(
        pick("assets", presets.ASSETS).alias("assets"),
        pick("liabilities", presets.LIABILITIES).alias("liabilities"),
        pick("income_result", presets.INCOME).alias("income_result"),
        pick("equity_result", presets.LIABILITIES).alias("equity_result"),
    )
    totals = F.coalesce(F.col("assets") == F.col("liabilities"), F.lit(False))
    results = F.coalesce(F.col("income_result") == F.col("equity_result"), F.lit(True))
    return found.withColumns({"totals_match": totals, "results_match": results, "balanced": totals & results})


def check_report(checks: list[DataFrame]) -> DataFrame:
    """All result rows with the verdict of the whole report on each."""
    rows = reduce(DataFrame.unionByName, checks)
    # the window sees one row per check result, and the checks run once
    return rows.withColumn("report_passed", F.bool_and("passed").over(Window.partitionBy()))


def gate(checks: DataFrame) -> bool:
    """True when every check passed (the one value a load waits for)."""
    row = checks.agg(F.bool_and("passed").alias("ok")).first()
    return bool(row["ok"]) if row["ok"] is not None else True
