"""Reports and word rows that are shuffled once, as they are printed."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom import presets
from ledgerloom.operators import blocks, ordered, words
from ledgerloom.plans import q_reports  # noqa: F401  registers its queries
from ledgerloom.plans.registry import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def leaf_lines():
    """Pages that interleave, sides printed on boilerplate lines, behind a page's other lines and on no page at all."""
    text = {
        (1, 0): "TITOLO 1: prima", (1, 5): "1 2 3 000000000001 Uno A 1,00 CP 2,00 CP 3,00",
        (2, 6): "MISSIONE 2: Due", (2, 7): "01 02 03 000000000002 Due CP 4,00 I", (1, 8): "COMUNE DI TORINO", (2, 9): " 5,00 TP 6,00 dopo",
        (2, 10): "Data di stampa - SPESE (anno 2024)", (3, 11): "TITOLO 3 : Sezione", (3, 12): "MISSIONE 4: Quattro", (3, 13): "01 02 03 000000000003 Tre CP 7,00",
        (4, 14): "CODICE PREVISIONI - ENTRATE (anno 2024)", (4, 15): "CODICE PREVISIONI - SPESE (anno 2024)", (4, 16): "MISSIONE 5: Cinque", (4, 17): "01 02 03 000000000004 Quattro CP 8,00",
        (5, 18): "COMUNE DI TORINO - ENTRATE (anno 2024)", (5, 19): "TITOLO 6: Sei", (5, 20): "1 2 3 000000000005 Sei TR 1,00 TR 2,00 TR 3,00 CS 1,00",
        (6, 21): "totale titolo A 9,00", (6, 22): "1 2 3 000000000006 Sette A", (6, 23): None, (6, 24): " ", (6, 25): "10,00 fine",
    }
    return [(d, pos, page, line) for d in ("a", "b", None) for (page, pos), line in text.items()] + [("a", 30, None, "1 2 3 000000000007 x A 1,00")]


def test_leaf_lines_are_shuffled_once(frame):
    df = frame(leaf_lines(), "doc string, pos int, page int, line string")
    want = sorted(
        [("000000000001", "entrata", "Uno", m, v) for m, v in (("accertamenti", "1.00"), ("previsioni", "2.00"), ("maggiori_minori_accertamenti", "3.00"))]
        + [("000000000002", "spesa", "Due dopo", m, v) for m, v in (("previsioni", "4.00"), ("impegni", "5.00"), ("pagamenti_totali", "6.00"))]
        + [("000000000003", "spesa", "Tre", "previsioni", "7.00"), ("000000000004", "spesa", "Quattro", "previsioni", "8.00")]
        + [("000000000005", "entrata", "Sei", m, v) for m, v in (("riscossioni_totali", "1.00"), ("residui_da_riportare", "2.00"), ("previsioni_cassa", "1.00"))]
        + [("000000000006", "entrata", "Sette fine", "accertamenti", "10.00")]
    )
    for width in (4, ordered.SLICE):
        made = blocks.parse_leaves(df, ["doc"], "pos", "line", "page", width).withColumn("value", F.col("value").cast("string"))
        assert rows(made, "leaf_code", "kind", "leaf_name", "measure", "value") == sorted(want * 2)
    assert exchanges(made) == 1


def test_lines_are_read_behind_the_shuffle(frame):
    """The shuffle carries the printed line, not what the patterns find in it; of spending blocks too."""
    df = frame(leaf_lines(), "doc string, pos int, page int, line string")
    plan = blocks.parse_leaves(df, ["doc"], "pos", "line", "page")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "regexp_extract" not in below and "_src" not in below
    plan = blocks.parse_summary(df, ["doc"], "pos", "line", "page", presets.SPENDING_SUMMARY)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "regexp_extract" not in below and "RLIKE" not in below


@pytest.mark.parametrize("width", [7, ordered.SLICE])
def test_what_follows_is_not_worked_out_anew_per_row(frame, width):
    rnd = random.Random(3)
    data = [(d, p, rnd.choice([None, None, p])) for d in (1, 2) for p in range(40)]
    df = frame(data, "doc int, pos int, v int")
    for spans in (None, width < 40):
        got = ordered.ordered_scan(df, ["doc"], "pos", following={"own": F.col("v"), "later": F.col("v")}, before=("later",), width=width, spans=spans)
        first = lambda d, p: next((r[2] for r in data if r[0] == d and r[1] >= p and r[2] is not None), None)
        assert rows(got.select("doc", "pos", F.coalesce("own", F.lit(-1)), F.coalesce("later", F.lit(-1)))) == sorted(
            (d, p, -1 if first(d, p) is None else first(d, p), -1 if first(d, p + 1) is None else first(d, p + 1)) for d, p, _ in data
        )
    # The rows handed from slice to slice, few as they are, may still be read to the end.
    if spans is False:
        assert "unboundedfollowing" not in plan_of(got).lower()


def test_neighbours_are_sent_once(frame):
    data = [(d, i, f"t{d}{i}") for d in (1, 2) for i in range(23)]
    df = frame(data, "doc int, idx long, name string")
    for width in (1, 2, 5, ordered.SLICE):
        near = ordered.neighbours(df, ["doc"], "idx", ["name"], {"above": -1, "above2": -2, "below": 1}, width)
        got = {(r["doc"], r["idx"]): [x and x["name"] for x in (r["above"], r["above2"], r["below"])] for r in near.collect()}
        assert got == {(d, i): [f"t{d}{j}" if 0 <= j < 23 else None for j in (i - 1, i - 2, i + 1)] for d, i, _ in data}
    sent = near._jdf.queryExecution().optimizedPlan().toString()
    assert sent.count("Generate") == 1 and "Aggregate" not in sent


def four_column_words(pages=(1, 2, 40)):
    out = []
    for page in pages:
        for i in range(6):
            top = 100.0 + 40 * i
            out += [(1, page, f"Voce{i}", 50.0, 80.0, top), (1, page, "(15)", 81.0, 90.0, top), (1, page, "12", 91.0, 95.0, top), (1, page, f"1.{i}00", 320.0, 360.0, top)]
            out += [(1, page, "999", 380.0, 410.0, top), (1, page, f"(2.{i}00)", 440.0, 480.0, top + 1), (1, page, "sotto", 50.0, 80.0, top + 8), (1, page, None, 50.0, 80.0, top)]
    return out


def test_four_columns_are_shuffled_once_behind_their_rows(spark, frame):
    ddl = "doc int, page int, text string, x0 double, x1 double, top double"
    made = {}
    for pages in ((1, 2), (1, 2, 40)):  # one slice, several slices
        df = frame(four_column_words(pages), ddl)
        made[pages] = words.assemble_four_columns(df, ["doc"], "page", F.lit(2024), F.lit(2023))
        got = rows(made[pages].withColumn("value", F.col("value").cast("int")), "seq", "page", "name", "year", "value")
        want = [(k * 6 + i, p, f"Voce{i} 12 sotto", y, v) for k, p in enumerate(pages) for i in range(6) for y, v in ((2023, -2000 - 100 * i), (2024, 1000 + 100 * i))]
        assert got == sorted(want)
    assert exchanges(made[(1, 2)]) == 1


def test_words_beside_the_table_are_sent_without_text(spark):
    df = spark.createDataFrame([(1, 1, "Ente", 50.0, 80.0, 100.0), (1, 1, "x1.000", 320.0, 360.0, 100.0), (1, 1, "nota", 600.0, 620.0, 100.0)], "doc int, page int, text string, x0 double, x1 double, top double")
    made = words.printed_rows(df, ["doc", "page"], labels=F.col("x0") < 255, numbers=F.col("x1") < 370).first()["_words"]
    assert [(w["text"], w["n"], w["x1"]) for w in made] == [("Ente", None, 80.0), (None, 1000, 360.0), (None, None, None)]


def test_second_page_needs_no_lookup_of_its_lines(spark, tmp_path):
    """Both pages are printed from one table of lines, and no words are joined to lines."""
    def write(name, df):
        df.coalesce(1).write.parquet(f"{tmp_path}/t/{name}.parquet")

    line = [(1, 1, 1, "A", "F"), (1, 2, 1, "A", "O"), (2, 1, 1, "N", "F"), (None, 1, 1, "A", "F"), (3, None, 1, "A", "F"), (4, 1, 1, "A", None)]
    made = spark.createDataFrame(line, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string")
    write("lineitem", made.withColumns({"l_extendedprice": F.lit(1234.5), "l_quantity": F.lit(7.0)}))
    write("part", spark.createDataFrame([(1, "hot bolt")], "p_partkey long, p_name string"))
    df = QUERIES["extract_counterparty_pages"](spark, f"{tmp_path}/t")
    got = {(r["doc"], r["page"]): r["value"] for r in df.collect()}
    assert (1, 413) in got and (4, 413) not in got and (None, 412) in got and (None, 413) not in got and (2, 412) not in got
    assert "LeftSemi" not in plan_of(df) and plan_of(df).count("lineitem") == 0
