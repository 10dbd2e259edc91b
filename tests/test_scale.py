"""Plans and files that keep their size when the tables grow."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions import numbers
from ledgerloom.operators import blocks, ordered, tables, words
from ledgerloom.plans import q_sources
from ledgerloom.plans.registry import QUERIES


def test_contract_files_hold_few_records(spark, tmp_path, monkeypatch):
    rows = lambda name, df: df.coalesce(1).write.parquet(f"{tmp_path}/t/{name}.parquet")
    rows("lineitem", spark.range(40).select(
        F.col("id").alias("l_orderkey"), F.lit(1).cast("bigint").alias("l_suppkey"), F.lit(1).cast("bigint").alias("l_partkey"),
        F.lit(10.0).alias("l_extendedprice"), F.lit("F").alias("l_linestatus"),
    ))
    rows("orders", spark.range(40).select(
        F.col("id").alias("o_orderkey"), F.timestamp_seconds(F.lit(9e8)).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
    ))
    rows("supplier", spark.range(1, 2).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(1.0).alias("s_acctbal")))
    rows("part", spark.range(1, 2).select(F.col("id").alias("p_partkey"), F.lit("hot bolt").alias("p_name")))
    monkeypatch.setattr(q_sources, "scratch_path", lambda *_: f"{tmp_path}/xml")
    monkeypatch.setattr(q_sources, "XML_RECORDS", 10)
    assert QUERIES["src_xml_records"](spark, f"{tmp_path}/t").count() == 40
    assert len(list(Path(f"{tmp_path}/xml").glob("part-*"))) >= 4


def test_block_cells_send_a_row_per_block(spark):
    """After the scan one exchange follows; the cells are grouped where their slice lies."""
    lines = [("d", p, cells) for p, cells in enumerate([["a", "", ""], ["", "x", ""], ["", "y", "z"], ["b", "", ""], ["", "", "w", "q"]])]
    df = spark.createDataFrame(lines, "doc string, pos int, cells array<string>")
    for width in (1, 2, ordered.SLICE):
        made = ordered.coalesce_block_cells(df, ["doc"], "pos", F.col("cells")[0] != "", "cells", width=width)
        assert {r["block"]: r["cells"] for r in made.collect()} == {1: ["a", "x", "z"], 2: ["b", "", "w", "q"]}
    plan = made._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Window [")]
    assert above.count("Exchange hashpartitioning") == 1


def test_block_cells_without_position_keep_their_size_only(spark):
    lines = [("d", 0, ["a", ""]), ("d", 1, ["", "x"]), ("d", None, ["b", "y", "z"])]
    df = spark.createDataFrame(lines, "doc string, pos int, cells array<string>")
    made = ordered.coalesce_block_cells(df, ["doc"], "pos", F.col("cells")[0] != "", "cells")
    assert [r["cells"] for r in made.collect()] == [["a", "x", ""]]


def test_summary_of_repeated_lines_reads_the_first_token(spark):
    """Of lines at one position the token printed first counts; lines pass the scan in one exchange, blocks in another."""
    lines = [("d", 1, "TITOLO 1: uno RS 1,00 A"), ("d", 2, "9,00 CP 5,00 A 7,00 TR"), ("d", 2, "9,00 CP 5,00 A 7,00 TR")]
    df = spark.createDataFrame(lines, "doc string, pos int, line string").withColumn("page", F.lit(1))
    made = blocks.parse_summary(df, ["doc"], "pos", "line", "page", presets.REVENUE_SUMMARY)
    assert {r["measure"]: int(r["value"]) for r in made.collect()} == {"previsioni": 5, "accertamenti": 9, "riscossioni_totali": 9}
    plan = made._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Window [")]
    assert above.count("Exchange hashpartitioning") == 1 and "Generate posexplode" not in above


def test_note_tables_match_each_cell_once(spark):
    """Conditions stay above the columns they read: the amount pattern, the letter count and the header text are in the plan once."""
    head, note = ["Descrizione", None, "31.12.2024"], ["12", None, "Crediti verso", "(1.000,00)", "x", "\u00a0- 5,50 "]
    data = [(1, [head, ["ab", "1,00"], note, None, ["Debiti", "7"]]), (2, [["altro"], note]), (3, None), (4, [])]
    df = spark.createDataFrame(data, "t int, rows array<array<string>>")
    made = tables.unfold_note_tables(df, 2024)
    got = sorted((r["t"], r["row_no"], r["voce"], r["period"], str(r["value"])) for r in made.collect())
    assert got == [(1, 2, "Crediti verso", "2024", "-1000.00"), (1, 2, "Crediti verso", "v2", "-5.50")]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == plan.count("regexp_replace") == plan.count("lower(") == 1


def test_words_are_packed_before_the_shuffle(spark):
    """Words become structs in compiled code below the exchange; a run keeps its ends, not a set of its baselines."""
    page = [
        ("1)", 50.0, 60.0, 10.0), ("Crediti", 70.0, 100.0, 10.5), ("12", 230.0, 400.0, 10.0), ("mesi", 255.0, 275.0, 10.0),
        ("1.234", 390.0, 432.0, 11.5), ("(5)", 395.0, 432.0, 11.5), ("77", 520.0, 560.0, 11.5), (None, 530.0, 560.0, 11.5), ("9,5", 540.0, 560.0, 11.5),
        ("a", 50.0, 60.0, 30.0), ("b", 60.0, 70.0, 33.0), ("8", 390.0, None, 36.0), ("_.1_2", 390.0, 430.0, 36.0),
    ]
    df = spark.createDataFrame([(1, *w) for w in page] + [(2, "x", 1.0, 2.0, None)], "doc int, text string, x0 double, x1 double, top double")
    made = words.assign_columns(df, ["doc"])
    got = sorted(tuple(r) for r in made.collect())
    assert got == [(1, 10.0, "1) Crediti 12 mesi 9,5", 1234, 77), (1, 30.0, "a b", None, None), (1, 36.0, "8", 12, None)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and plan.count("collect_list(_w") == 1


def test_numbers_are_read_alike_as_column_and_in_steps(spark):
    tokens = ["12", "1.234", "1.234.567", "12.34", "1.23", "0007", "9" * 18, "9" * 19, "9" * 25, "12\n", " 12 ", "(12)", "(1.234", "x12", "12.", "1.234_", "a", "", "-", "1,5", "1.234.", "١٢", None]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = numbers.with_noisy_integer(df, "t", "n").select("t", "n", numbers.parse_noisy_integer(F.col("t")).alias("m")).collect()
    assert all(r["n"] == r["m"] for r in got) and [r["n"] for r in got][:3] == [12, 1234, 1234567]


def test_tables_are_dealt_by_size_before_they_are_sorted(spark):
    data = [("p", 2, [["a"], ["b"]]), ("p", 1, [["c"], ["d"]]), ("p", 0, [["e"]]), (None, 0, []), (None, 1, [["f"]]), ("q", 5, None)]
    df = spark.createDataFrame(data, "page string, table_index int, rows array<array<string>>")
    made = tables.largest_table(df, ["page"])
    assert {r["page"]: (r["table_index"], r["rows"]) for r in made.collect()} == {"p": (1, [["c"], ["d"]]), None: (1, [["f"]]), "q": (5, None)}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RebalancePartitions")
