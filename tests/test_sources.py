"""Files, archives, XML, loads and the streaming append."""

import hashlib
import io
import zipfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from ledgerloom import presets, schemas
from ledgerloom.operators import analytics, checks, documents, facts, tables, words
from ledgerloom.sources import archives, export, load, readers
from ledgerloom.streaming.incremental import append_new_stream, file_stream

HEADER = " Descrizione Tipologia Soggetto;Descrizione Comune ;Codice Missione;Descrizione Missione;Impegni;Totale Pagamenti"


def test_delimited_city(spark, tmp_path):
    body = "\n".join(
        [
            HEADER,
            "COMUNI;CITTÀ;01;Servizi;10.50;4",
            "",
            "comuni ; città ;01;Servizi;1.50;n.d.",
            "PROVINCE;CITTÀ;01;Altro;99;99",
            "COMUNI;ALTROVE;01;Servizi;7;7",
            "COMUNI;CITTÀ;03;Zero;0;",
            "COMUNI",
        ]
    )
    (tmp_path / "spese.csv").write_bytes(body.encode("latin-1"))
    read = readers.city_rows(readers.read_delimited(spark, str(tmp_path)), "Città")
    got = readers.normalize_side(read, [], "Codice Missione", "Descrizione Missione", {"Impegni": "impegni", "Totale Pagamenti": "pagamenti"}, "Totale", unpad=True)
    assert {(r["level"], r["code"], r["measure"], r["value"]) for r in got.collect()} == {
        ("voce", "1", "impegni", D("12.00")), ("voce", "1", "pagamenti", D("4.00")),
        ("totale", None, "impegni", D("12.00")), ("totale", None, "pagamenti", D("4.00")),
    }


def test_each_file_is_read_by_its_own_titles(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('Ente;Impegni \n"Ente ""X"" sud";1\n'.encode("latin-1"))
    (tmp_path / "b uno.csv").write_bytes(" Impegni;Ente;Nota\n2;Città;n\n".encode("latin-1"))
    got = readers.read_delimited(spark, str(tmp_path)).select("Ente", "Impegni", "Nota")
    assert sorted(map(tuple, got.collect())) == [("Città", "2", "n"), ('Ente "X" sud', "1", None)]


def test_revenue_categories(spark):
    lines = [
        ("10 - Dieci", "Tipologia 100", "1.000,50", "1"), ("9 - Nove", " tipologia 2", "2,5", ""), ("9 - Nove", "TIPOLOGIA 3", None, "4"),
        ("8 - Zero", "Tipologia 1", "0,00", " "), ("TOTALE", "Tipologia 1", "9", "9"), ("7 - Altro", "Fondo", "9", "9"), ("6 - Corta", None, None, None),
    ]
    table = spark.createDataFrame(lines, "Titolo string, Tipologia string, A string, R string")
    got = readers.normalize_revenue(table, [], "Titolo", "Tipologia", {"A": "acc", "R": "risc"}, "Tutto").where("measure = 'acc'").orderBy("position")
    assert [(r["code"], r["name"], r["value"]) for r in got.collect()] == [("9", "Nove", D("2.50")), ("10", "Dieci", D("1000.50")), (None, "Tutto", D("1003.00"))]
    zero = readers.normalize_revenue(table.where("Titolo LIKE '8%'"), [], "Titolo", "Tipologia", {"A": "acc", "R": "risc"}, "Tutto")
    assert [(r["level"], r["value"]) for r in zero.collect()] == [("totale", D("0.00"))] * 2


def test_year_files(spark, tmp_path):
    for name in ("anac_2020.txt", "anac_2021.txt", "anac_bozza.txt", "note.txt"):
        (tmp_path / name).write_text(name)
    assert rows(readers.read_year_lines(spark, str(tmp_path), [2021])) == [("anac_2021.txt", "anac_2021.txt", 2021)]
    assert readers.read_year_lines(spark, str(tmp_path)).count() == 2


def test_archive_picks_the_shortest_matching_member(spark, tmp_path):
    for name, members in {
        "2020_Lazio.zip": {"Spese_lungo.csv": "x", "Spese.csv": 'a; b \r\n1;"2 ""due""; e\naltro"\n\n3\n4;5" x;6\n', "Spese_Province.csv": "a;b\n9;9\n", "Spese.txt": "no"},
        "2021_Lazio.zip": {"Entrate.csv": "a;b\n1;1\n"},
        "2022_Lazio.zip": {"Spese.csv": "b;c;a\n2;c;Città\n"},
        "2022_EMILIA-ROMAGNA.zip": {"Spese.CSV": "a\n7\n", "Entrate.csv": "b;a\n1;8\n"},
        "altro.zip": {"Spese.csv": "a;b\n0;0\n"},
    }.items():
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, text in members.items():
                z.writestr(member, text.encode("latin-1"))
    got = archives.read_members(spark, str(tmp_path), ["Spese"], ["a", "b"], exclude="Province")
    want = [
        ("EMILIA-ROMAGNA", 2022, "Spese.CSV", "7", "-"),
        ("Lazio", 2020, "Spese.csv", "1", '2 "due"; e\naltro'), ("Lazio", 2020, "Spese.csv", "3", "-"), ("Lazio", 2020, "Spese.csv", "4", '5" x'),
        ("Lazio", 2022, "Spese.csv", "Città", "2"),
    ]
    assert rows(got.fillna("-"), "region", "year", "member", "a", "b") == sorted(want)
    both = archives.read_members(spark, str(tmp_path), ["Spese", "Entrate"], ["a"], scopes=[("emilia-romagna", None), ("Lazio", 2021)])
    assert rows(both, "region", "year", "needle", "a") == [("EMILIA-ROMAGNA", 2022, "Entrate", "8"), ("EMILIA-ROMAGNA", 2022, "Spese", "7"), ("Lazio", 2021, "Entrate", "1")]
    assert both.rdd.getNumPartitions() == 4
    (tmp_path / "leer").mkdir()
    assert archives.read_members(spark, str(tmp_path / "leer"), ["Spese"], ["a"]).count() == 0


def test_archives_are_written_line_by_line(spark, tmp_path):
    made = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("region"), F.lit(2020).alias("year"),
        F.concat(F.lit("Spese_"), (F.col("id") % 2).cast("string"), F.lit(".csv")).alias("member"), "id", F.concat(F.lit("x;"), F.col("id").cast("string")).alias("line"),
    )
    assert archives.write_archives(made, str(tmp_path), "id") == 2
    got = archives.read_members(spark, str(tmp_path), ["Spese_0", "Spese_1"], ["x"])
    assert got.count() == 30_000 - 4  # each member's first line is its titles
    assert not list(tmp_path.glob("*.part"))


XML = """<?xml version="1.0"?><n:pubblicazione xmlns:n="urn:x"><data>
<lotto><cig>Z1</cig><n:strutturaProponente><denominazione>Area</denominazione></n:strutturaProponente><oggetto> Carta </oggetto>
<partecipanti><partecipante><ragioneSociale>A</ragioneSociale></partecipante><partecipante><ragioneSociale>B</ragioneSociale></partecipante></partecipanti>
<aggiudicatari><aggiudicatario><codiceFiscale>1</codiceFiscale><ragioneSociale>A</ragioneSociale></aggiudicatario><aggiudicatario><ragioneSociale>B</ragioneSociale></aggiudicatario></aggiudicatari>
<importoAggiudicazione>10.5</importoAggiudicazione><importoSommeLiquidate>boh</importoSommeLiquidate>
<tempiCompletamento><dataInizio>2021-01-02</dataInizio><dataUltimazione>0000-00-00</dataUltimazione></tempiCompletamento></lotto>
<lotto><cig> </cig><partecipanti></partecipanti></lotto></data></n:pubblicazione>"""


def test_contract_xml(spark, tmp_path):
    (tmp_path / "anac_2021.xml").write_text(XML)
    (tmp_path / "anac_bozza.xml").write_text(XML)
    got = readers.with_file_year(readers.read_contract_xml(spark, str(tmp_path)), "source_document", [2021])
    found = sorted((tuple(r) for r in got.drop("source_document").collect()), key=str)
    assert found == sorted(
        [
            ("Z1", "Carta", "Area", None, "A", "1", 2, D("10.50"), None, "2021-01-02", None, 2021),
            (None, None, None, None, None, None, None, None, None, None, None, 2021),
        ],
        key=str,
    )


def test_form_rows(spark):
    row = "struct<code:string,name:string,total:boolean,v_cur:string,v_prev:string>"
    data = [("fct", 2024, 2023, [("B.", "Crediti", False, "1.000", "(2)"), (None, "Vuota", None, "", None), ("", "Crediti vs COMUNE DI TORINO", False, None, "3"), ("", "Totale attivo", True, "5", "")])]
    forms = spark.createDataFrame(data, f"slug string, year int, prev_year int, rows array<{row}>")
    got = readers.form_items(forms, presets.ASSETS)
    assert [tuple(r) for r in got.orderBy("seq", F.desc("year")).select("seq", "code", "year", "value", "related_party", "is_total").collect()] == [
        (0, "B.", 2024, D("1000.00"), None, False), (0, "B.", 2023, D("-2.00"), None, False),
        (1, None, 2023, D("3.00"), "socio", False), (2, None, 2024, D("5.00"), None, True),
    ]


def test_new_only_and_replace(frame):
    incoming = frame([("b", 2), ("b", 1), ("a", 3), ("c", 4)], "checksum string, n int")
    existing = frame([("a", 0)], "checksum string, n int")
    assert rows(load.new_only(incoming, existing, "n"), "checksum", "n") == [("b", 1), ("c", 4)]
    old = frame([(2020, 1), (2020, 2), (2021, 3)], "year int, n int")
    assert rows(load.replace_scope(old, frame([(2020, 9)], "year int, n int"), ["year"])) == [(2020, 9), (2021, 3)]


def test_scope_overwrite_and_gate(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    load.write_scope(frame([(2020, 1), (2021, 2)], "year int, n int"), path, ["year"])
    passed = frame([("x", True)], "check string, passed boolean", 1)
    failed = frame([("x", False)], "check string, passed boolean", 1)
    assert not load.gated_load(frame([(2021, 7)], "year int, n int"), failed, path, ["year"])
    assert load.gated_load(frame([(2021, 8)], "year int, n int"), passed, path, ["year"])
    assert rows(spark.read.parquet(path), "year", "n") == [(2020, 1), (2021, 8)]


def test_observed_load(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rules = {"positive": F.bool_and(F.col("n") > 0), "small": F.sum("n") < 100}
    assert load.observed_load(frame([(2020, 1), (2021, 2)], "year int, n int"), rules, path, ["year"]) == {"rows": 2, "positive": True, "small": True}
    failed = load.observed_load(frame([(2021, 7), (2022, -1)], "year int, n int"), rules, path, ["year"])
    assert failed == {"rows": 2, "positive": False, "small": True}
    assert load.observed_load(frame([(2021, 99), (2021, 1)], "year int, n int"), rules, path, ["year"])["small"] is False
    load.observed_load(frame([(2021, 8)], "year int, n int"), rules, path, ["year"])
    nothing = load.observed_load(spark.createDataFrame([], "year int, n int"), rules, path, ["year"])
    assert nothing == {"rows": 0, "positive": None, "small": None}
    assert rows(spark.read.parquet(path), "year", "n") == [(2020, 1), (2021, 8)]


def test_ids_continue(frame):
    existing = frame([(7,)], "id int", 1)
    got = load.surrogate_ids(frame([("b",), ("a",), ("c",)], "k string"), [F.col("k")], existing)
    assert rows(got, "k", "id") == [("a", 8), ("b", 9), ("c", 10)]


def test_typed_append(spark, frame, tmp_path):
    path = str(tmp_path / "metrics")
    made = frame([(1, 2020, "", "12.345")], "id int, year int, code string, value string", 1)
    load.append_typed(made, path, schemas.METRICS, blank_is_null=("code",))
    load.append_typed(made.withColumn("year", F.lit(2021)), path, schemas.METRICS)
    assert rows(spark.read.parquet(path).where("year = 2020"), "id", "code", "value") == [(1, None, D("12.35"))]


def test_stream_appends_only_new_files(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("checksum", T.StringType())])

    def run(n):
        append_new_stream(file_stream(spark, str(source)), target, schema, str(tmp_path / f"ck{n}"), "path").awaitTermination()
        return spark.read.parquet(target).count()

    (source / "a.txt").write_text("uno")
    (source / "copy.txt").write_text("uno")
    assert run(1) == 1
    (source / "b.txt").write_text("due")
    assert run(1) == 2
    assert run(2) == 2  # a new query replays every file and adds nothing


def test_stream_reads_only_the_prefixes_of_its_keys(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("checksum", T.StringType())])

    def run():
        append_new_stream(file_stream(spark, str(source)), target, schema, str(tmp_path / "ck"), "path", prefix=2).awaitTermination()
        return sorted(r["checksum"][:8] for r in spark.read.parquet(target).collect())

    (source / "a.txt").write_text("abc")
    (source / "copy.txt").write_text("abc")
    assert run() == ["ba7816bf"]
    (source / "b.txt").write_text("abc")
    (source / "c.txt").write_text("xyz")
    other = hashlib.sha256(b"xyz").hexdigest()
    assert run() == sorted(["ba7816bf", other[:8]])
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"key_prefix=ba", f"key_prefix={other[:2]}"}


def test_file_checksums(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    got = load.file_checksums(spark, str(tmp_path), "*.bin").collect()
    assert [(r["filename"], r["checksum"][:8]) for r in got] == [("a.bin", "ba7816bf")]


def test_exports(spark, frame, tmp_path):
    data = frame([(1, "x")], "n int, t string", 1)
    assert len(export.export_dataset(data, str(tmp_path), "metrics", ["json", "csv"])) == 2
    assert export.export_dataset(data.limit(0), str(tmp_path), "extra", ["json"], only_if_rows=True) == []
    assert spark.read.csv(str(tmp_path / "metrics.csv"), header=True).first()["t"] == "x"
    index = export.export_index({"metrics": (data, ["json", "csv"])})
    assert rows(index) == [("metrics", 1, "metrics.json,metrics.csv")]


def test_optional_sources(spark, frame, tmp_path):
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    assert facts.optional_source(spark, str(tmp_path / "none"), schema).count() == 0
    assert facts.optional_table(spark, "no_such_table", schema).columns == ["n"]


def test_authoritative_prefers_own_report(frame):
    data = [(1, 2020, "a", 2020, 1), (2, 2020, "a", 2021, 2), (3, 2019, "a", 2020, 3), (4, 2019, "a", 2021, 4)]
    got = facts.authoritative(frame(data, "id int, year int, category string, doc_year int, value int"), ["year", "category"])
    assert rows(got, "year", "id") == [(2019, 4), (2020, 1)]
    kept = facts.own_report_or_all(frame(data, "id int, year int, category string, doc_year int, value int"))
    assert rows(kept, "id") == [(1,), (3,), (4,)]


def test_changes(frame):
    data = frame([("a", 2019, 0.0), ("a", 2020, 5.0), ("a", 2022, -10.0), ("a", 2023, -5.0)], "k string, year int, value double")
    got = {r["year"]: r["delta_pct"] for r in analytics.yoy_delta(data, ["k"]).collect()}
    assert got == {2019: None, 2020: None, 2022: None, 2023: 50.0}
    row = analytics.first_last_variation(data, ["k"]).first()
    assert (row["delta"], row["delta_pct"]) == (-5.0, 0.0)


WORD = "doc int, page int, text string, x0 double, x1 double, top double"


def boxes(frame, *items):
    return frame([(1, p, t, float(a), float(b), float(y)) for p, t, a, b, y in items], WORD)


def test_civil_statement(frame):
    made = boxes(
        frame,
        (1, "Premessa", 50, 90, 90),
        (1, "B)", 50, 60, 100), (1, "Immobilizzazioni", 65, 120, 101), (1, "1.000", 400, 432, 102), (1, "900", 530, 560, 102),
        (1, "14)", 50, 60, 120), (1, "Oneri", 65, 90, 120),
        (1, "di", 65, 70, 132), (1, "cui", 72, 80, 132), (1, "55", 420, 432, 132),
        (2, "77", 420, 432, 60), (2, "resto", 65, 80, 60),
        (2, "TOTALE", 50, 80, 100), (2, "ATTIVO", 85, 110, 100), (2, "(5)", 480, 499, 100), (2, "3", 550, 560, 100), (2, "300", 370, 390, 100),
    )
    got = words.assemble_statement(made, ["doc"], "page", F.lit(2024), F.lit(2023))
    assert [tuple(r) for r in got.orderBy("seq", F.desc("year")).select("seq", "page", "code", "name", "is_total", "year", "value").collect()] == [
        (0, 1, "B)", "B) Immobilizzazioni", False, 2024, 1000), (0, 1, "B)", "B) Immobilizzazioni", False, 2023, 900),
        (1, 1, "14)", "14) Oneri", False, 2024, 55),
        (2, 2, "", "TOTALE ATTIVO", True, 2024, -5), (2, 2, "", "TOTALE ATTIVO", True, 2023, 3),
    ]


def test_four_column_labels_are_taken_once(frame):
    value = lambda y, t: ((1, t, 320, 360, y), (1, "9", 460, 480, y))
    made = boxes(
        frame,
        (1, "Testata", 50, 90, 50),
        (1, "Ricavi", 50, 90, 100), *value(100, "10"),
        (1, "netti", 50, 90, 108),
        (1, "Costi", 50, 90, 116), *value(116, "20"),
        (1, "Sopra", 50, 90, 200), *value(208, "30"),
        (1, "(12)", 240, 250, 208),
        *value(300, "40"),
    )
    got = words.assemble_four_columns(made, ["doc"], "page", F.lit(2024), F.lit(2023), factor=1000)
    seen = [tuple(r) for r in got.where("year = 2024").orderBy("seq").select("name", "value").collect()]
    assert seen == [("Ricavi netti", D("10000.00")), ("Costi", D("20000.00")), ("Sopra", D("30000.00"))]


TEXT = "OGGETTO : ACQUISTO DI CARTA\nPER UFFICI\nil dirigente\nCIG: Z123456789 e CIG Z123456789, C.I.G. 0000000001\nIMPEGNO DI SPESA Euro 1.000,00\nEURO 2.500,00\n" + "testo " * 40 + (
    "\nprima\nseconda\nterza\nImporto Anno\n6.895,0 0 2024\n000010203040\nDescrizione capitolo e articolo CANCELLERIA\nE STAMPATI\nConto Finanziario U.1\n"
)


def test_decision_fields(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "breve"), (3, "x" * 300)], "doc int, text string")
    fields = documents.document_fields(df)
    entries = documents.chapter_entries(df, ["doc"])
    got = {r["doc"]: r for r in documents.document_warnings(fields, entries, ["doc"]).collect()}
    assert got[1]["oggetto"] == "ACQUISTO DI CARTA PER UFFICI"
    assert got[1]["cig"] == ["Z123456789", "0000000001"]
    assert got[1]["importo"] == D("2500.00") and got[1]["warnings"] == []
    assert got[2]["is_scanned"] and got[2]["warnings"] == ["no_text"]
    assert got[3]["warnings"] == ["no_chapter", "no_contract_id"]
    assert rows(entries, "doc", "capitolo_code", "capitolo_nome", "anno", "importo") == [
        (1, "000010203040", "CANCELLERIA E STAMPATI", 2024, "6.895,00")
    ]


def test_note_tables(spark):
    rows_ = [
        (1, [["Voce", "Valore di inizio esercizio", "Variazione", "Valore di fine"], ["Crediti", "1,00", "2,00", "3,00"], ["ab", "9,00"], ["Senza importi", "x"]]),
        (2, [["Descrizione", "31.12.2024"], ["Debiti", "5,00", "6,00"]]),
        (3, [["Altro", "tabella"], ["Debiti", "5,00"]]),
    ]
    made = spark.createDataFrame(rows_, "t int, rows array<array<string>>")
    got = rows(tables.unfold_note_tables(made, 2024), "t", "kind", "voce", "period", "value")
    assert got == [
        (1, "movimenti", "Crediti", "fine", D("3.00")), (1, "movimenti", "Crediti", "inizio", D("1.00")), (1, "movimenti", "Crediti", "variazione", D("2.00")),
        (2, "dettaglio", "Debiti", "2024", D("5.00")), (2, "dettaglio", "Debiti", "v2", D("6.00")),
    ]


def test_spending_matrix_takes_the_first_total_row(spark, tmp_path):
    cells = ["0,00"] * 69
    cells[0], cells[2], cells[27], cells[29], cells[4] = "300.000,00", "290.000,00", "88.000,00", "", "5,00"
    head = "Titolo;Macro;" + ";".join(f"c{i}" for i in range(73))
    total = "TOTALE MISSIONI - TOTALE GENERALE;;" + ";".join([*cells, "0,00", "388.000,00", "5,00", "290.000,00"])
    (tmp_path / "a.csv").write_bytes("\n".join([head, "1 - Spese;101;" + ";".join(["9,00"] * 73), " " + total, total.replace("300", "900")]).encode("latin-1"))
    read = readers.read_positional(spark, str(tmp_path), 75)
    got = readers.normalize_spending_matrix(read, ["source_file"], "pos", "cells", {"01": "Servizi"})
    assert {(r["level"], r["code"], r["name"], r["measure"], r["value"]) for r in got.collect()} == {
        ("voce", "01", "Servizi", "impegni", D("300000.00")), ("voce", "01", "Servizi", "pagamenti_totali", D("290000.00")),
        ("voce", "10", "Missione 10", "impegni", D("88000.00")), ("voce", "10", "Missione 10", "pagamenti_totali", D("0.00")),
        ("totale", None, "Totale generale delle spese", "impegni", D("388000.00")), ("totale", None, "Totale generale delle spese", "pagamenti_totali", D("290000.00")),
    }
    (tmp_path / "b.csv").write_text(head + "\nTOTALE GENERALE;;" + ";" * 72)
    for bad, message in (("b.csv", "no row 'TOTALE MISSIONI' in b.csv"), ("c.csv", "fewer than 75 cells")):
        (tmp_path / "c.csv").write_text("TOTALE MISSIONI;;1,00")
        wrong = readers.read_positional(spark, str(tmp_path / bad), 75)
        if bad == "c.csv":
            wrong = wrong.withColumn("cells", F.slice("cells", 1, 3))
        with pytest.raises(Exception, match=message):
            readers.normalize_spending_matrix(wrong, ["source_file"], "pos", "cells", {}).collect()


def test_city_comparison(spark, tmp_path):
    spese = "Descrizione Tipologia Soggetto;Descrizione Comune;Codice Missione;Descrizione Missione;Previsioni Definitive di Competenza;Impegni;Totale Pagamenti"
    entrate = "Totale Riscossioni;Descrizione Comune;Descrizione Tipologia Soggetto;Codice Titolo;Descrizione Titolo;Previsioni Definitive di Competenza;Accertamenti"
    both = {
        "2020 Spese Riepilogo Missioni.csv": [spese, "COMUNI;TORINO;01;Primo;10.00;4;1", "COMUNI;Torino ;01;Dopo;1.50;n.d.;", "PROVINCE;TORINO;02;Altro;9;9;9", "COMUNI;ALBA;01;X;7;7;7", "COMUNI;TORINO;03;Zero;0;;0"],
        "2020 Entrate Riepilogo Titoli.csv": [entrate, "3;TORINO;COMUNI;01;Tributi;5;2"],
        "2020 Spese Riepilogo Missioni - Voce di Riepilogo.csv": ["a;b"],
    }
    archives_ = {
        "2020_PIEMONTE.zip": both,
        "2021_PIEMONTE.zip": {k: v for k, v in both.items() if "Entrate" not in k},
        "2020_LAZIO.zip": both,
        "2020_LOMBARDIA.zip": both,
    }
    for name, members in archives_.items():
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, lines in members.items():
                z.writestr(member, "\n".join(lines).encode("latin-1"))
    names = spark.createDataFrame([("entrata", "1", "Entrate correnti"), ("spesa", "9", "?")], "kind string, code string, name string")
    cities = {"Torino": "Piemonte", "Roma": "LAZIO"}
    target = str(tmp_path / "out")
    spark.range(1).selectExpr("1 AS region", "2 AS year", "id").write.partitionBy("region", "year").parquet(target)  # an older build
    readers.load_city_comparison(spark, str(tmp_path), cities, target, names)
    got = rows(spark.read.parquet(target).fillna("-"), "comune", "region", "year", "kind", "level", "code", "name", "measure", "value")
    want = [
        ("TORINO", "PIEMONTE", 2020, kind, *rest, measure, D(value))
        for kind, measures in (
            ("spesa", {"previsioni": "11.50", "impegni": "4.00", "pagamenti_totali": "1.00"}),
            ("entrata", {"previsioni": "5.00", "accertamenti": "2.00", "riscossioni_totali": "3.00"}),
        )
        for rest in (
            (("voce", "01", "Primo"), ("totale", "-", "Totale generale delle spese"))
            if kind == "spesa"
            else (("voce", "1", "Entrate correnti"), ("totale", "-", "Totale generale delle entrate"))
        )
        for measure, value in measures.items()
    ]
    assert got == sorted(want)


def test_identities_of_two_sheets_and_years(spark):
    lines = [
        ("d", 1, "Totale dell'attivo", "balance_sheet_assets", D(5), D(4)), ("d", 2, "Totale del passivo", "balance_sheet_liabilities", D(5), D(3)),
        ("d", 3, "Totale del", "balance_sheet_liabilities", D(9), D(9)),
        ("e", 1, "totale dell'attivo", "balance_sheet_assets", D(1), D(1)), ("e", 2, "TOTALE DEL PASSIVO", "balance_sheet_liabilities", D(1), D(1)),
        ("e", 3, "Totale dell'attivo", "aggregate_balance_sheet_assets", D(2), None),
    ]
    df = spark.createDataFrame(lines, "doc string, pos int, name string, family string, cur decimal(20,2), pri decimal(20,2)")
    got = checks.check_identities(df, ["doc"], "pos", "name", "family", "cur", "pri")
    assert rows(got) == [
        ("aggregate_balance_sheet_identity", 1, 1, False), ("balance_sheet_identity_current", 2, 0, True), ("balance_sheet_identity_prior", 2, 1, False),
    ]
    assert [r["check"] for r in checks.check_identities(df.limit(0), ["doc"], "pos", "name", "family", "cur", "pri").collect()] == []


def test_empty_dataset_has_its_titles(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, b string")
    for frame_, name in ((empty, "x"), (empty.repartition(3), "y")):
        assert export.export_dataset(frame_, str(tmp_path), name, ["csv", "json"]) == [f"{tmp_path}/{name}.csv", f"{tmp_path}/{name}.json"]
        assert spark.read.csv(f"{tmp_path}/{name}.csv", header=True).columns == ["a", "b"]
        assert spark.read.schema("a int").json(f"{tmp_path}/{name}.json").count() == 0
    assert export.export_dataset(empty, str(tmp_path), "z", ["csv"], only_if_rows=True) == []
