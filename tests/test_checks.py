"""Every check on data that passes, on data that fails and on no data."""

import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from conftest import rows
from ledgerloom import presets
from ledgerloom.operators import checks, lookups, pages


def verdict(df):
    row = df.first()
    return row["checked"], row["failed"], row["passed"]


LINE = "doc int, pos int, code string, name string, value decimal(20,2)"


def lines(frame, *items):
    return frame([(1, i, c, n, v if v is None else D(v)) for i, (c, n, v) in enumerate(items)], LINE)


def subtotals(frame, *items):
    return verdict(checks.check_subtotals(checks.subtotal_groups(lines(frame, *items), ["doc"], "pos", "code", "name", "value")))


def test_subtotals(frame):
    parent, a, b = ("3", "Proventi", "100"), ("a", "uno", "60"), ("b", "due", "40")
    assert subtotals(frame, parent, a, b) == (1, 0, True)
    assert subtotals(frame, parent, a, ("", "intestazione", None), b, ("4", "Altro", "5")) == (1, 0, True)
    assert subtotals(frame, parent, a) == (1, 1, False)
    assert subtotals(frame, parent, a, b, ("a", "Di cui interessi", "7")) == (1, 0, True)
    assert subtotals(frame, parent, a, ("b", "vuota", None)) == (0, 0, True)
    assert subtotals(frame, ("4", "Altro", "5")) == (0, 0, True)
    assert subtotals(frame, parent, a, ("b", "due", "40.05")) == (1, 0, True)
    assert subtotals(frame, parent, a, ("b", "due", "40.06")) == (1, 1, False)


def sections(frame, *items):
    return verdict(checks.check_section_totals(checks.section_totals(lines(frame, *items), ["doc"], "pos", "code", "name", "value")))


def test_sections(frame):
    start, one, two = ("A", "Entrate", None), ("1", "uno", "60"), ("2", "due", "40")
    total = ("", "Totale componenti positivi della gestione A)", "100")
    assert sections(frame, start, one, ("a", "di cui", "9"), two, total) == (1, 0, True)
    assert sections(frame, start, one, total) == (1, 1, False)
    assert sections(frame, ("9", "prima", "5"), start, one, two, total, ("3", "dopo", "7"), total) == (1, 0, True)
    assert sections(frame, one, two, total) == (0, 0, True)
    assert sections(frame, start, one, two, total, ("B", "Uscite", None), ("6", "x", "3"), ("", "totale della gestione", "4")) == (2, 1, False)


def identity(frame, *items):
    made = frame([(1, i, f, n, v if v is None else D(v)) for i, (f, n, v) in enumerate(items)], "doc int, pos int, family string, name string, value decimal(20,2)")
    cases = checks.identity_cases(made, ["doc"], "pos", "name", "family", ["att"], ["pas"], "value")
    return verdict(checks.check_identity(cases))


def test_identity(frame):
    assets = ("att", "Totale dell'attivo (A+B)", "10")
    assert identity(frame, assets, ("pas", "TOTALE DEL", "10")) == (1, 0, True)
    assert identity(frame, assets, ("pas", "Totale del passivo", "11")) == (1, 1, False)
    assert identity(frame, assets) == (1, 1, False)
    assert identity(frame, assets, ("altro", "Totale del passivo", "10")) == (1, 1, False)


def test_movements(frame):
    def run(*items):
        return verdict(checks.check_movements(frame([(1, v, p, D(x)) for v, p, x in items], "page int, voce string, period string, value decimal(20,2)"), ["page", "voce"]))

    assert run(("a", "inizio", "5"), ("a", "variazione", "2"), ("a", "fine", "7"), ("b", "inizio", "1")) == (1, 0, True)
    assert run(("a", "inizio", "5"), ("a", "variazione", "2"), ("a", "fine", "7.06")) == (1, 1, False)
    assert run(("b", "inizio", "1")) == (0, 0, True)


ITEM = "kind string, level string, code string, measure string, value decimal(20,2)"


def test_item_totals(frame):
    def run(total, measure="impegni"):
        data = [("spesa", "voce", "01", measure, D("60")), ("spesa", "voce", "02", measure, D("40"))]
        if total:
            data.append(("spesa", "totale", None, measure, D(total)))
        return verdict(checks.check_item_totals(frame(data, ITEM), []))

    assert run("100") == (1, 0, True)
    assert run("101") == (1, 1, False)
    assert run(None) == (0, 0, False)
    assert run("100", "previsioni") == (0, 0, False)


def test_chain_and_per_capita(frame):
    def series(*years):
        return frame([(y, D(o), D(c), p, D(pc)) for y, o, c, p, pc in years], "year int, opening decimal(20,2), closing decimal(20,2), people int, pc decimal(20,2)")

    good = series((2018, "1", "5", 2, "2.5"), (2019, "5", "7", 2, "3.9"), (2021, "9", "9", 0, "1"))
    assert verdict(checks.check_chain(good, [], "closing", "opening")) == (1, 0, True)
    assert verdict(checks.check_per_capita(good, "closing", "people", "pc")) == (2, 0, True)
    bad = series((2018, "1", "5", 2, "4"), (2019, "5.01", "7", 2, "3.5"))
    assert verdict(checks.check_chain(bad, [], "closing", "opening")) == (1, 1, False)
    assert verdict(checks.check_per_capita(bad, "closing", "people", "pc")) == (2, 1, False)
    assert verdict(checks.check_chain(series((2018, "1", "5", 2, "2")), [], "closing", "opening")) == (0, 0, False)


def test_leaves_and_cross_source(frame):
    key = "kind string, code string, value decimal(20,2)"
    leaves = frame([("spesa", "01", D("60")), ("spesa", "01", D("39.5"))], key)
    assert verdict(checks.check_leaves(leaves, frame([("spesa", "01", D("100"))], key), ["kind", "code"], "x")) == (1, 0, True)
    assert verdict(checks.check_leaves(leaves, frame([("spesa", "02", D("5"))], key), ["kind", "code"], "x")) == (1, 1, False)
    assert verdict(checks.check_leaves(leaves, frame([], key, 1), ["kind", "code"], "x")) == (0, 0, False)
    other = frame([("spesa", "01", D("60.02"))], key)
    assert verdict(checks.check_cross_source(leaves.limit(1), other, ["kind", "code"]))[0] == 1


STATEMENT = "entity string, year int, category string, seq int, name string, value decimal(20,2), related_party string"


def reconciled(frame, scheme, *items):
    made = frame([("e", 2024, c, i, n, D(v), rp) for i, (c, n, v, rp) in enumerate(items)], STATEMENT)
    row = checks.statement_reconcile(made, ["entity", "year"], scheme).first()
    return row["totals_match"], row["results_match"], row["balanced"]


def test_statement_schemes(frame):
    a, p, i = presets.ASSETS, presets.LIABILITIES, presets.INCOME
    civil = [(a, "TOTALE  ATTIVO", "9", None), (p, "T O T A L E PASSIVO E NETTO", "9", None)]
    results = [(p, "IX. Utile (perdita) dell'esercizio", "2", None), (i, "21) Utile (perdita)", "2", None)]
    assert reconciled(frame, "civil", *civil, *results) == (True, True, True)
    assert reconciled(frame, "civil", *civil, results[0], (i, "21) Utile", "3", None)) == (True, False, False)
    assert reconciled(frame, "civil", *civil, results[0]) == (True, True, True)
    assert reconciled(frame, "civil", civil[0]) == (False, True, False)
    assert reconciled(frame, "civil", civil[0], (p, "Totale passivo", "9", "socio")) == (False, True, False)
    four = [(a, "Totale attività non correnti", "5", None), (a, "TOTALE ATTIVITA'", "9", None), (p, "TOTALE PATRIMONIO NETTO E PASSIVITA'", "9", None)]
    assert reconciled(frame, "four_column", *four) == (True, True, True)
    assert reconciled(frame, "form", (i, "Totale attivo", "4", None), (a, "TOTALE PASSIVO", "4", None)) == (True, True, True)


def test_gate_and_report(frame):
    good = frame([("a", 1, 0, True), ("b", 0, 0, True)], "check string, checked long, failed long, passed boolean")
    bad = frame([("c", 1, 1, False)], "check string, checked long, failed long, passed boolean")
    assert checks.gate(good) and not checks.gate(good.unionByName(bad))
    assert {r["report_passed"] for r in checks.check_report([good, bad]).collect()} == {False}


def test_lookups(frame):
    facts = frame([("01", "x"), ("02", "y"), ("03", "z")], "code string, name string")
    known = frame([("01", "Servizi"), ("01", "Affari"), ("02", "")], "code string, name string")
    assert rows(lookups.borrow_labels(facts, known), "code", "name") == [("01", "Servizi"), ("02", "y"), ("03", "z")]
    names = frame([("ricavi delle vendite estere",), ("ricavi",), ("costi",), ("",), (None,)], "name string")
    glossary = frame([("ricavi", "base"), ("ricavi delle vendite", "vendite")], "prefix string, description string")
    got = {r["name"]: r["description"] for r in lookups.longest_prefix(names, "name", glossary).collect()}
    assert got == {"ricavi delle vendite estere": "vendite", "ricavi": "base", "costi": None, "": None, None: None}


def test_longest_prefix_among_nested_entries(frame):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abè") for _ in range(rng.randrange(n)))
    entries = {word(5): f"d{k}" for k in range(60)}
    texts = [word(9) for _ in range(400)]
    glossary = frame([*entries.items(), (None, "none")], "prefix string, description string")
    got = lookups.longest_prefix(frame([(t,) for t in texts], "name string"), "name", glossary).collect()

    def want(text):
        fitting = [p for p in entries if text and text.startswith(p)]
        return entries[max(fitting, key=len)] if fitting else None

    assert len(got) == len(texts)
    assert all(r["description"] == want(r["name"]) for r in got)
    empty = lookups.longest_prefix(frame([("a",)], "name string"), "name", glossary.where("false"))
    assert [r["description"] for r in empty.collect()] == [None]


def test_pages_of_a_stored_order(spark, frame, tmp_path):
    path = str(tmp_path / "ranked")
    table = frame([(n, -n % 7) for n in range(100)], "n int, k int")
    pages.write_ranked(table, [F.col("k").desc(), F.col("n").asc()], path, width=16)
    whole = [tuple(r) for r in table.orderBy(F.col("k").desc(), "n").collect()]
    for offset, limit in ((0, 5), (14, 40), (95, 10), (200, 3)):
        assert [tuple(r) for r in pages.ranked_page(spark, path, offset, limit, width=16).collect()] == whole[offset : offset + limit]
    assert len(pages.ranked_page(spark, path, 33, 8, width=16).inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(_range" in pages.ranked_page(spark, path, 33, 8, width=16)._jdf.queryExecution().executedPlan().toString()


def test_members_aligned_with_zero(frame):
    values = frame([("T", "01", D("10")), ("M", "01", D("5")), ("M", "02", D("15")), ("X", "09", D("1"))], "city string, code string, value decimal(20,2)")
    got = rows(lookups.compare_members(values, "city", "code", "T", ["M", "Z"]), "city", "code", "in_base", "value", "share")
    assert got == [
        ("M", "01", True, D("5"), 25.0), ("M", "02", False, D("15"), 75.0), ("T", "01", True, D("10"), 100.0),
        ("T", "02", False, D("0"), 0.0), ("Z", "01", True, D("0"), 0.0), ("Z", "02", False, D("0"), 0.0),
    ]


def test_per_capita_modes(frame):
    values = frame([("T", 2020, D("10")), ("M", 2020, D("8"))], "city string, year int, value decimal(20,2)")
    people = frame([("T", 2020, 4), ("M", 2020, 0)], "city string, year int, residenti int")
    assert rows(lookups.per_capita(values, people, ["city", "year"], True), "city", "per_capita") == [("M", 8.0), ("T", 2.5)]
    assert rows(lookups.per_capita(values, people, ["city", "year"], False), "city", "per_capita") == [("T", 2.5)]


def test_hot_key_spreads_over_slices(spark):
    """Two thirds of the lines in one document still give the plain result."""
    df = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") < 20_000, 0).otherwise(F.col("id") % 7).alias("doc"),
        F.col("id").alias("pos"),
        F.when(F.col("id") % 5 == 0, "1").otherwise("a").alias("code"),
        F.lit("voce").alias("name"),
        F.lit(1).cast("decimal(20,2)").alias("value"),
    )
    from ledgerloom.operators.ordered import ordered_scan

    mark = (F.col("code") == "1").cast("int")
    sliced = ordered_scan(df, ["doc"], "pos", running={"grp": mark}, width=1_000)
    plain = ordered_scan(df, ["doc"], "pos", running={"grp": mark})
    assert sliced.exceptAll(plain).count() == 0 and sliced.count() == 30_000
