"""Numbers, text rules and cell rows on small literals."""

from decimal import Decimal as D

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions import cells as C
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as X
from ledgerloom.operators import tables


def values(frame, texts, expr):
    """Value of the expression for every text, in order."""
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_localized_decimals(frame):
    texts = ["1.234.567,89", "(1.000,00)", "-2.983.581,00", "0,00", "", "  ", "voce", "12", "+ 7,5", "1.23,4", None, " 5,00 ", "1,00)"]
    assert values(frame, texts, N.parse_localized_decimal) == [
        D("1234567.89"), D("-1000.00"), D("-2983581.00"), D("0.00"), None, None, None, D("12.00"), D("7.50"), None, None, D("5.00"), D("1.00"),
    ]


def test_amounts_need_a_comma(frame):
    assert values(frame, ["1.234,56", "7", "voce", None, "a,b"], N.is_amount) == [True, False, False, False, False]


def test_noisy_integers(frame):
    texts = ["1.515.214.893", "(231.334)", "O____21_6_._1_72", "0", "voce", "12,5", "7__", "1.23", "(5)", "", None]
    assert values(frame, texts, N.parse_noisy_integer) == [1515214893, -231334, 216172, 0, None, None, 7, None, -5, None, None]


def test_percent_and_forms(frame):
    assert values(frame, ["60,37%", "3,163", "-", "/", ""], N.parse_percent) == [D("60.3700"), D("3.1630"), None, None, None]
    assert values(frame, ["1.234.567", "(12)", "+5", "", "x"], N.parse_form_integer) == [D("1234567.00"), D("-12.00"), D("5.00"), None, None]
    assert values(frame, ["diretta 5,5% e 4 % tramite", "nessuna"], N.sum_percentages) == [D("9.5000"), None]


def test_magnitudes(frame):
    df = frame([(2.5e9,), (3.21e6,), (12.5,), (None,)], "v double", 1)
    assert [r[0] for r in df.select(N.format_magnitude(F.col("v"))).collect()] == [
        "~2.50 miliardi EUR", "~3.2 milioni EUR", "12.50 EUR", "n/d",
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(min_value=-10**15, max_value=10**15, places=2), min_size=20, max_size=60))
def test_format_and_parse_round_trip(spark, numbers):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], "i int, v decimal(20,2)")
    back = N.parse_localized_decimal(N.format_localized(F.col("v")))
    assert df.where(~back.eqNullSafe(F.col("v"))).count() == 0


def test_line_codes(frame):
    labels = ["A) Crediti", "B.III. Immobili", "D. RATEI", "11 bis) Altri", "20 Imposte", "d-bis) x", "Crediti", "5-ter) y", "20 12"]
    assert values(frame, labels, X.line_code) == ["A)", "B.III.", "D.", "11 bis)", "20", "d-bis)", "", "5-ter)", ""]


def test_totals_names_parties(frame):
    assert values(frame, ["T O T A L E  ATTIVO", "Risultato prima", "Crediti"], X.is_total_line) == [True, True, False]
    assert values(frame, ["14) Oneri____ di cui minus", "Debiti___ .", "x meno: fondo 3"], X.clean_line_name) == ["14) Oneri", "Debiti", "x"]
    assert values(
        frame, ["sottoposte al controllo delle controllanti", "verso controllanti", "verso collegate", "altro"], X.related_party
    ) == ["gruppo_socio", "socio", "controllate", None]


def test_canonical_names(frame):
    registry = [("5t", "5T S.r.l.", r"\b5T\b"), ("mobilita", "Agenzia", r"MOBILIT")]
    names = ["5T S.r.l. (100%)", "Agenzia della Mobilità", "Rossi S.p.A. in liquidazione", "Caffè d’Oro", "S.p.A."]
    slug = values(frame, names, lambda c: X.canonical_entity(c, registry)[0])
    assert slug == ["5t", "mobilita", "rossi", "caffe_d_oro", "s_p_a"]
    assert values(frame, names, lambda c: X.canonical_entity(c, registry)[1])[2] == "Rossi S.p.A. in liquidazione"


def test_codes_headings_notes(frame):
    assert values(frame, ["01", "7", "x1", " 09 "], X.unpad_code) == ["1", "7", "x1", "9"]
    assert values(frame, ["1", "12", "123"], X.pad_code) == ["01", "12", "123"]
    assert values(frame, ["testo\n 5.12 DEBITI VERSO BANCHE\n6. ALTRO", "5.12 Debiti"], X.page_heading) == ["5.12 DEBITI VERSO BANCHE", ""]
    assert values(frame, ["ENTRATE da incassi  vincolati reintegro", "regolarizzazione cassa vincolata", "incassi vincolati"], X.technical_entry) == [
        "entrata", "spesa", None,
    ]
    assert values(frame, ["debito_fine_anno", "ALTRO_dato"], lambda c: X.display_label(c, presets.MEASURE_LABELS)) == ["Debito residuo a fine anno", "Altro dato"]


def test_value_tokens(frame):
    pattern = X.value_token_pattern()
    found = values(frame, ["ECP1.624,00 RS -2,50 9RC 1,00 CP x I 3,1"], lambda c: X.value_tokens(c, pattern))[0]
    assert [(t["label"], t["value"]) for t in found] == [("ECP", D("1624.00")), ("RS", D("-2.50"))]


def test_statement_cells(frame):
    made = frame(
        [
            (1, ["A", "II.1", "TOTALE DEL", "", "PASSIVO", "1.000,00", "", "(5,00)"]),
            (2, ["7", "", "Proventi"]),
            (3, ["7", "12"]),
            (4, ["", ""]),
            (5, ["", "31.001.183,11"]),
        ],
        "i int, cells array<string>",
    )
    got = {r["i"]: (r["code"], r["description"], r["current"], r["prior"]) for r in tables.normalize_statement_rows(made).collect()}
    assert got == {
        1: ("A", "II.1 TOTALE DEL PASSIVO", D("1000.00"), D("-5.00")),
        2: ("7", "Proventi", None, None),
        5: ("", "", D("31001183.11"), None),
    }


def test_row_label_prefers_first_of_equals(frame):
    made = frame([(["12", "alfa", "beta", "1,00", "2,00", "7"],), (["alfa"],)], "cells array<string>", 1)
    got = C.with_parts(made, "cells").select(C.row_label(F.col("_lead"), F.col("_amounts"))).collect()
    assert [r[0] for r in got] == ["alfa", ""]
