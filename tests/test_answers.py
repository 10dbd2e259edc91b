"""Answers that were once wrong: zero scopes, backslashes, ties, long texts, years of the data."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.operators import analytics, checks, documents, facts, hierarchy, ordered, tables
from ledgerloom.sources import readers
from conftest import rows


def test_zero_scope_keeps_its_totals(frame):
    df = frame([("a", "1", "x", Decimal("0.00")), ("a", "2", "y", Decimal("0.00")), ("b", "1", "x", Decimal("3.00"))], "city string, code string, name string, v decimal(30,2)")
    got = hierarchy.rollup_to_parent(df, ["city"], ["v"], "all")
    assert rows(got, "city", "level", "value") == [("a", "totale", Decimal("0.00")), ("b", "totale", Decimal("3.00")), ("b", "voce", Decimal("3.00"))]


def test_backslash_stands_for_itself(frame):
    df = frame([("a\\b",), ("ab",), ("A\\Bc",)], "name string")
    assert df.where(facts.containing(F.col("name"), "a\\b")).count() == 2
    assert df.where(facts.any_containing(["name"], "a\\B")).count() == 2


def test_ranks_break_ties_and_have_no_hidden_limit(frame):
    df = frame([(k, 1.0) for k in range(700)], "id int, v double")
    assert [r["id"] for r in facts.ranked_by(df, "v", ["v"], 3).collect()] == [0, 1, 2]
    assert facts.ranked_by(df, "v", ["v"]).count() == 700
    assert facts.page_of(df, [F.col("id")], offset=10).count() == 690


def test_amounts_are_read_to_the_end_of_the_text(frame):
    df = frame([("OGGETTO: lavori " + "x " * 3000 + "EURO 1.234,50",)], "text string")
    assert df.select(documents.headline_amount(F.col("text"))).first()[0] == Decimal("1234.50")


def test_years_come_from_the_data(frame):
    df = frame([(2003, "m", 1.0), (1990, "m", 2.0)], "year int, measure string, value double")
    wide = analytics.pivot_years(df, ["measure"], analytics.years_of(df))
    assert rows(wide) == [("m", 2.0, 1.0)] and wide.columns == ["measure", "y1990", "y2003"]


def test_report_verdict_in_one_pass(frame):
    one = frame([("x", True)], "check string, passed boolean")
    two = frame([("y", False)], "check string, passed boolean")
    assert rows(checks.check_report([one, two])) == [("x", True, False), ("y", False, False)]


def test_doubled_quotes(spark, tmp_path):
    (tmp_path / "f.csv").write_text('Ente;v\n"Ente ""X"" sud";1\n', encoding="latin-1")
    assert [r["Ente"] for r in readers.read_delimited(spark, str(tmp_path)).collect()] == ['Ente "X" sud']


def test_absent_source_is_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert facts.optional_source(spark, str(tmp_path / "none"), schema).count() == 0
    spark.range(3).write.parquet(str(tmp_path / "some"))
    assert facts.optional_source(spark, str(tmp_path / "some"), schema).count() == 3


def test_one_plan_whatever_the_positions(frame):
    near = [("d", k, k % 3 == 0) for k in range(50)]
    far = [("d", k * 10**9, k % 3 == 0) for k in range(50)]
    results = []
    for data in (near, far):
        df = frame(data, "doc string, pos long, mark boolean")
        plain = ordered.ordered_scan(df, ["doc"], "pos", running={"n": F.col("mark").cast("int")})
        cut = ordered.ordered_scan(df, ["doc"], "pos", running={"n": F.col("mark").cast("int")}, width=7)
        assert rows(plain) == rows(cut)
        results.append(sorted(r["n"] for r in plain.collect()))
    assert results[0] == results[1]


def test_labels():
    assert presets.MEASURE_LABELS["oneri_finanziari"] == "Oneri finanziari (interessi passivi)"


def test_blank_rows_add_no_columns_to_a_valuation(spark):
    blank = [""] * 7
    record = [(1, ["ACME SPA", *blank]), (2, ["", "12,50%", "1.000,00", "", "2.000,00", "3,00", "-", "EP 12"])]
    schema = "pos int, cells array<string>"

    def metrics(lines):
        table = spark.createDataFrame(lines, schema).selectExpr("1 AS doc", "pos", "6 AS page", "cells")
        found = tables.valuation_metrics(table, ["doc"], "pos", "page", indirect_pages=[])
        return sorted((r["metric_name"], r["value"]) for r in found.collect())

    want = metrics(record)
    assert len(want) == 4
    assert metrics([*record, (3, [" "] * 12)]) == want


def test_both_shares_from_one_grouping(spark):
    table = spark.createDataFrame([(1, "01", 30.0), (1, "02", 10.0), (1, "04", 60.0), (2, "04", 5.0), (3, "01", 0.0)], "year int, code string, value double")
    got = {(r["year"], r["code"]): (r["gross_share"], r["net_share"]) for r in analytics.shares_of_totals(table, "code", ["04", "00"]).collect()}
    assert got == {(1, "01"): (30.0, 75.0), (1, "02"): (10.0, 25.0), (3, "01"): (0.0, 0.0)}
