"""Order-dependent queries over statement lines of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.numbers import to_output as out
from ledgerloom.operators import checks, ordered
from ledgerloom.plans.registry import query

# Heading rows of the ordered queries: the flag says which level a line sets.
HEADINGS = {"l1": "A", "l2": "N", "l3": "R"}


@query("carry_headings", """
WITH h AS (SELECT doc, pos, CASE WHEN flag = 'A' THEN name END AS h1, CASE WHEN flag = 'N' AND status = 'O' THEN name END AS h2, CASE WHEN flag = 'R' AND status = 'F' THEN name END AS h3 FROM line),
 a AS (SELECT *, count(h1) OVER (PARTITION BY doc ORDER BY pos) AS e1, last_value(h1 IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos) AS l1 FROM h),
 b AS (SELECT *, count(h2) OVER (PARTITION BY doc, e1 ORDER BY pos) AS e2, last_value(h2 IGNORE NULLS) OVER (PARTITION BY doc, e1 ORDER BY pos) AS l2 FROM a)
SELECT doc, pos, l1, l2, last_value(h3 IGNORE NULLS) OVER (PARTITION BY doc, e1, e2 ORDER BY pos) AS l3 FROM b""", "line")
def carry_headings(t):
    set_when = lambda test: F.when(test, F.col("name"))
    levels = {
        "l1": set_when(F.col("flag") == "A"),
        "l2": set_when((F.col("flag") == "N") & (F.col("status") == "O")),
        "l3": set_when((F.col("flag") == "R") & (F.col("status") == "F")),
    }
    return ordered.carry_headings(t.line, ["doc"], "pos", levels).select("doc", "pos", "l1", "l2", "l3")


@query("segment_blocks", """
SELECT doc, CAST(block AS BIGINT) AS block, CAST(min(pos) AS INT) AS page, string_agg(name, chr(10) ORDER BY pos) AS block_text
FROM (SELECT *, sum(CASE WHEN name LIKE 'old%' OR name LIKE 'new%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS block FROM line) WHERE block > 0 GROUP BY doc, block""", "line")
def segment_blocks(t):
    return ordered.segment_blocks(t.line.withColumn("page", F.col("pos")), ["doc"], "pos", "name", "page", "^(old|new)")


@query("merge_continuations", """
SELECT doc, CAST(min(pos) AS INT) AS pos, CAST(arg_min(part, pos) AS BIGINT) AS part, string_agg(name, ' ' ORDER BY pos) AS name
FROM (SELECT *, sum(CASE WHEN flag <> 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS item FROM line) WHERE item > 0 GROUP BY doc, item""", "line")
def merge_continuations(t):
    return ordered.merge_continuations(t.line, ["doc"], "pos", F.col("flag") != "R", "name", ["part"]).select("doc", "pos", "part", "name")


@query("coalesce_block_cells", """
SELECT doc, CAST(block AS BIGINT) AS block, coalesce(arg_min(CASE WHEN flag <> 'A' THEN NULL ELSE name END, CASE WHEN flag = 'A' THEN pos END), '') AS c1,
 coalesce(arg_min(name, CASE WHEN status = 'F' THEN pos END), '') AS c2, coalesce(arg_min(flag, pos), '') AS c3
FROM (SELECT *, sum(CASE WHEN flag = 'A' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS block FROM line) WHERE block > 0 GROUP BY doc, block""", "line")
def coalesce_block_cells(t):
    cells = F.array(
        F.when(F.col("flag") == "A", F.col("name")).otherwise(""), F.when(F.col("status") == "F", F.col("name")).otherwise(""), F.col("flag")
    )
    rows = t.line.select("doc", "pos", "flag", cells.alias("cells"))
    merged = ordered.coalesce_block_cells(rows, ["doc"], "pos", F.col("flag") == "A", "cells")
    return merged.select("doc", "block", *[F.col("cells")[i].alias(f"c{i + 1}") for i in range(3)])


@query("pair_rows", """
WITH e AS (SELECT *, coalesce(sum(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM line),
 n AS (SELECT *, last_value(CASE WHEN flag = 'A' THEN name END IGNORE NULLS) OVER (PARTITION BY doc, epoch ORDER BY pos) AS paired_name FROM e)
SELECT doc, pos, paired_name, CAST(amount AS DOUBLE) AS amount FROM n WHERE flag = 'R' AND paired_name IS NOT NULL""", "line")
def pair_rows(t):
    named = F.when(F.col("flag") == "A", F.col("name"))
    rows = ordered.pair_rows(t.line, ["doc"], "pos", named, F.col("flag") == "R")
    return rows.select("doc", "pos", "paired_name", out(F.col("amount")).alias("amount"))


@query("backfill_sections", """
SELECT doc, pos, CASE WHEN max(c) OVER (PARTITION BY doc) IS NULL THEN '' ELSE coalesce(first_value(c IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 'result') END AS section
FROM (SELECT *, CASE WHEN flag = 'A' AND status = 'F' THEN name END AS c FROM line)""", "line")
def backfill_sections(t):
    closing = F.when((F.col("flag") == "A") & (F.col("status") == "F"), F.col("name"))
    return ordered.backfill_sections(t.line, ["doc"], "pos", closing, "result").select("doc", "pos", "section")


@query("printed_sequence", """
SELECT doc, pos, CAST(row_number() OVER (PARTITION BY doc ORDER BY pos) - 1 AS INT) AS seq FROM line WHERE amount > 20000""", "line")
def printed_sequence(t):
    return ordered.printed_sequence(t.line, ["doc"], "pos", F.col("amount") > 20000).select("doc", "pos", "seq")


@query("subtotal_groups", """
SELECT doc, CAST(parent AS DOUBLE) AS parent, children, CAST(children_sum AS DOUBLE) AS children_sum, CAST(parent - children_sum AS DOUBLE) AS delta FROM (
 SELECT doc, grp, max(CASE WHEN NOT kid THEN amount END) AS parent, count(*) FILTER (kid) AS children, sum(CASE WHEN kid THEN amount END) AS children_sum
 FROM (SELECT *, sum(CASE WHEN kid THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY pos) AS grp FROM (SELECT *, flag <> 'A' AND NOT (flag = 'R' AND status = 'F') AS kid FROM line))
 WHERE grp > 0 GROUP BY doc, grp) WHERE children > 0""", "line")
def subtotal_groups(t):
    return _statement_groups(t).select(
        "doc", out(F.col("parent")).alias("parent"), "children", out(F.col("children_sum")).alias("children_sum"), out(F.col("delta")).alias("delta")
    )


def _statement_groups(t):
    """Flag A opens a group, N and R are lettered children, R with F an "of which"."""
    rows = t.line.select(
        "doc",
        "pos",
        F.when(F.col("flag") == "A", F.col("pos").cast("string")).otherwise(F.lower("flag")).alias("code"),
        F.when((F.col("flag") == "R") & (F.col("status") == "F"), F.concat(F.lit("Di cui "), "name")).otherwise(F.col("name")).alias("name"),
        "amount",
    )
    return checks.subtotal_groups(rows, ["doc"], "pos", "code", "name", "amount")


@query("check_subtotals", """
SELECT 'statement_subtotals' AS "check", count(*) AS checked, count(*) FILTER (abs(parent - children_sum) > 0.05) AS failed, count(*) FILTER (abs(parent - children_sum) > 0.05) = 0 AS passed FROM (
 SELECT doc, grp, max(CASE WHEN NOT kid THEN amount END) AS parent, count(*) FILTER (kid) AS children, sum(CASE WHEN kid THEN amount END) AS children_sum
 FROM (SELECT *, sum(CASE WHEN kid THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY pos) AS grp FROM (SELECT *, flag <> 'A' AND NOT (flag = 'R' AND status = 'F') AS kid FROM line))
 WHERE grp > 0 GROUP BY doc, grp) WHERE children > 0""", "line")
def check_subtotals(t):
    return checks.check_subtotals(_statement_groups(t))


SECTION_SQL = """
WITH m AS (SELECT *, flag = 'A' AS mark, flag = 'R' AND status = 'F' AS closing, flag = 'N' AS numbered FROM line),
 s AS (SELECT *, sum(CASE WHEN mark THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS sec FROM m),
 c AS (SELECT *, coalesce(sum(CASE WHEN closing THEN 1 ELSE 0 END) OVER (PARTITION BY doc, sec ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM s WHERE sec > 0),
 t AS (SELECT doc, sec, max(CASE WHEN closing THEN amount END) AS printed, coalesce(sum(CASE WHEN numbered THEN amount END), 0) AS line_sum FROM c WHERE done = 0 GROUP BY doc, sec)
"""


def _sections(t):
    """Flag A marks a section, N is a numbered line, R with F closes it."""
    code = F.when(F.col("flag") == "A", F.when(F.col("status") == "F", "A").otherwise("B")).when(F.col("flag") == "N", F.col("pos").cast("string")).otherwise("")
    closing = (F.col("flag") == "R") & (F.col("status") == "F")
    rows = t.line.select("doc", "pos", code.alias("code"), F.when(closing, "Totale componenti della gestione").otherwise(F.col("name")).alias("name"), "amount")
    return checks.section_totals(rows, ["doc"], "pos", "code", "name", "amount")


@query("section_totals", SECTION_SQL + "SELECT doc, CAST(printed AS DOUBLE) AS printed, CAST(line_sum AS DOUBLE) AS line_sum, CAST(printed - line_sum AS DOUBLE) AS delta FROM t WHERE printed IS NOT NULL", "line")
def section_totals(t):
    return _sections(t).select("doc", *[out(F.col(c)).alias(c) for c in ("printed", "line_sum", "delta")])


@query("check_section_totals", SECTION_SQL + """SELECT 'income_section_totals' AS "check", count(*) AS checked, count(*) FILTER (abs(printed - line_sum) > 0.05) AS failed,
 count(*) FILTER (abs(printed - line_sum) > 0.05) = 0 AS passed FROM t WHERE printed IS NOT NULL""", "line")
def check_section_totals(t):
    return checks.check_section_totals(_sections(t))
