"""Text, number and cell queries.

The printed forms are made by Spark from the driver tables; the DuckDB side
knows the figures they were made from, so a match shows that parsing gives
them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions import cells as C
from ledgerloom.functions import numbers as N
from ledgerloom.functions import text as X
from ledgerloom.functions.numbers import to_output as out
from ledgerloom.operators import tables
from ledgerloom.operators.entities import canonicalize
from ledgerloom.plans.registry import query
from ledgerloom.plans.tables import REGISTRY

EURO = lambda c: N.format_localized(F.col(c))


def by_flag(a, n, r):
    return F.when(F.col("flag") == "A", a).when(F.col("flag") == "N", n).otherwise(r)


@query("parse_localized_decimal", "SELECT doc, pos, CAST(CASE flag WHEN 'A' THEN amount ELSE -amount END AS DOUBLE) AS value FROM line", "line")
def parse_localized_decimal(t):
    printed = by_flag(EURO("amount"), F.concat(F.lit(" ("), EURO("amount"), F.lit(") ")), F.concat(F.lit("- "), EURO("amount")))
    return t.line.select("doc", "pos", out(N.parse_localized_decimal(printed)).alias("value"))


@query("is_amount", "SELECT doc, pos, flag <> 'R' AS reads_as_number, flag = 'A' AS is_amount FROM line", "line")
def is_amount(t):
    printed = by_flag(EURO("amount"), F.col("pos").cast("string"), F.col("name"))
    return t.line.select("doc", "pos", N.is_amount_text(printed).alias("reads_as_number"), N.is_amount(printed).alias("is_amount"))


@query("parse_decimal_variants", """
SELECT doc, pos, CAST(CASE flag WHEN 'R' THEN 0 ELSE amount END AS DOUBLE) AS locale_value, CAST(CASE flag WHEN 'N' THEN 0 ELSE prior END AS DOUBLE) AS dot_or_zero,
 CAST(CASE flag WHEN 'N' THEN NULL ELSE prior END AS DOUBLE) AS dot_or_null FROM line""", "line")
def parse_decimal_variants(t):
    locale = by_flag(EURO("amount"), F.concat(EURO("amount"), F.lit(" ")), F.lit("  "))
    dotted = by_flag(F.col("prior").cast("string"), F.lit("n.d."), F.concat(F.lit(" "), F.col("prior").cast("string")))
    return t.line.select(
        "doc",
        "pos",
        out(N.parse_simple_locale(locale)).alias("locale_value"),
        out(N.parse_dot_decimal(dotted)).alias("dot_or_zero"),
        out(N.parse_dot_decimal(dotted, bad_as_zero=False)).alias("dot_or_null"),
    )


@query("parse_percent", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax = 0 THEN NULL ELSE CAST(CAST(l_discount AS DECIMAL(7,4)) * 100 AS DOUBLE) END AS value FROM lineitem""")
def parse_percent(t):
    pct = F.replace((F.col("l_discount").cast("decimal(7,4)") * 100).cast("decimal(7,2)").cast("string"), F.lit("."), F.lit(","))
    printed = F.when(F.col("l_tax") == 0, "-").otherwise(F.concat(pct, F.lit("%")))
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", out(N.parse_percent(printed)).alias("value"))


@query("sum_percentages", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST((CAST(l_discount AS DECIMAL(7,4)) + CAST(l_tax AS DECIMAL(7,4))) * 100 AS DOUBLE) AS value FROM lineitem""")
def sum_percentages(t):
    pct = lambda c: F.replace((F.col(c).cast("decimal(7,4)") * 100).cast("decimal(7,2)").cast("string"), F.lit("."), F.lit(","))
    printed = F.concat(F.lit("diretta "), pct("l_discount"), F.lit("% e indiretta "), pct("l_tax"), F.lit(" % tramite Holding 7"))
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", out(N.sum_percentages(printed)).alias("value"))


@query("headline_amount", "SELECT doc, pos, CAST(greatest(amount, prior) AS DOUBLE) AS value FROM line", "line")
def headline_amount(t):
    printed = F.concat(F.lit("Impegno di spesa di EURO "), EURO("amount"), F.lit(" importo a base di gara pari a "), EURO("prior"), F.lit(" oltre IVA"))
    return t.line.select("doc", "pos", out(N.largest_amount(printed, presets.DECISION_AMOUNTS)).alias("value"))


WHOLE = "CAST(floor(amount) AS BIGINT)"


def whole(column: str):
    """Whole part printed with dots between the thousands."""
    return F.translate(F.format_number(F.floor(column), 0), ",", ".")


@query("parse_noisy_integer", f"SELECT doc, pos, CASE flag WHEN 'A' THEN {WHOLE} WHEN 'N' THEN -{WHOLE} END AS value FROM line", "line")
def parse_noisy_integer(t):
    leaders = F.concat(F.lit("O____"), F.replace(whole("amount"), F.lit("."), F.lit("_._")))
    printed = by_flag(leaders, F.concat(F.lit("("), whole("amount"), F.lit(")__")), EURO("amount"))
    return t.line.select("doc", "pos", N.parse_noisy_integer(printed).alias("value"))


@query("scale_units", f"SELECT doc, pos, CAST({WHOLE} * 1000 AS DOUBLE) AS value FROM line", "line")
def scale_units(t):
    return t.line.select("doc", "pos", out(N.scale_units(F.floor("amount").cast("decimal(20,2)"), 1000)).alias("value"))


@query("format_amounts", """
SELECT doc, pos, translate(format('{:,.2f}', CAST(amount AS DOUBLE)), ',.', '.,') AS printed, format('{:.2f}', CAST(amount AS DOUBLE)) AS plain,
 CASE WHEN big >= 1e9 THEN '~' || format('{:.2f}', big / 1e9) || ' miliardi EUR' WHEN big >= 1e6 THEN '~' || format('{:.1f}', big / 1e6) || ' milioni EUR' ELSE format('{:.2f}', big) || ' EUR' END AS magnitude
FROM (SELECT *, CAST(amount AS DOUBLE) * CASE flag WHEN 'A' THEN 1 WHEN 'N' THEN 1000 ELSE 1000000 END AS big FROM line)""", "line")
def format_amounts(t):
    amount = F.col("amount").cast("double")
    big = amount * by_flag(F.lit(1), F.lit(1000), F.lit(1000000))
    return t.line.select(
        "doc", "pos", EURO("amount").alias("printed"), N.format_plain(F.col("amount")).alias("plain"), N.format_magnitude(big).alias("magnitude")
    )


@query("normalize_codes", """
SELECT doc_id, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS n, CASE WHEN length(CAST(doc_id AS VARCHAR)) >= 3 THEN CAST(doc_id AS VARCHAR) ELSE lpad(CAST(doc_id AS VARCHAR), 3, '0') END AS padded,
 CAST(doc_id AS VARCHAR) AS bare FROM documents""")
def normalize_codes(t):
    padded = X.pad_code(F.concat(F.lit(" "), F.col("doc_id").cast("string")), 3)
    return t.raw("documents").select(
        "doc_id", F.length(X.collapse_spaces(F.col("text"))).alias("n"), padded.alias("padded"), X.unpad_code(padded).alias("bare")
    )


@query("canonical_entities", "SELECT id, raw_name, canonical_slug, canonical_name FROM canonical", "canonical")
def canonical_entities(t):
    return canonicalize(t.rawname, "raw_name", REGISTRY)


TYPED_NAME = {
    "ECONOMY": "Fondazione {}", "SMALL": "{} S.p.A.", "MEDIUM": "Consorzio {}", "PROMO": "{} srl", "STANDARD": "Agenzia {}", "LARGE": "{}",
}


@query("classify_by_keywords", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'fondazione' WHEN 'SMALL' THEN 'società' WHEN 'MEDIUM' THEN 'consorzio' WHEN 'PROMO' THEN 'società' WHEN 'STANDARD' THEN 'agenzia' ELSE 'altro' END AS entity_type FROM part""")
def classify_by_keywords(t):
    name = F.lit(None).cast("string")
    for kind, shape in TYPED_NAME.items():
        before, after = shape.split("{}")
        name = F.when(F.col("p_type") == kind, F.concat(F.lit(before), F.col("p_name"), F.lit(after))).otherwise(name)
    return t.raw("part").select("p_partkey", X.classify_entity(name).alias("entity_type"))


@query("tag_related_party", """
SELECT doc, pos, CASE WHEN flag = 'A' AND status = 'F' THEN 'gruppo_socio' WHEN flag = 'A' THEN 'socio' WHEN flag = 'N' THEN 'controllate' END AS related_party FROM line""", "line")
def tag_related_party(t):
    label = by_flag(
        F.when(F.col("status") == "F", "verso imprese sottoposte al Controllo delle controllanti").otherwise("Crediti verso CONTROLLANTI"),
        F.lit("Debiti verso imprese collegate"),
        F.col("name"),
    )
    return t.line.select("doc", "pos", X.related_party(label).alias("related_party"))


@query("extract_line_code", """
SELECT doc, pos, CASE flag WHEN 'A' THEN pos || '-bis)' WHEN 'N' THEN 'B.III.' ELSE '' END AS code FROM line""", "line")
def extract_line_code(t):
    label = by_flag(F.concat(F.col("pos").cast("string"), F.lit("-bis) "), "name"), F.concat(F.lit("B.III."), "name"), F.concat(F.lit("voce "), "name"))
    return t.line.select("doc", "pos", X.line_code(label).alias("code"))


@query("is_total_row", "SELECT doc, pos, flag <> 'R' AS is_total FROM line", "line")
def is_total_row(t):
    label = by_flag(F.lit("T O T A L E   A T T I V O"), F.concat(F.lit("Differenza tra "), "name"), F.col("name"))
    return t.line.select("doc", "pos", X.is_total_line(label).alias("is_total"))


@query("clean_line_name", "SELECT doc, pos, pos || ') ' || name AS name FROM line", "line")
def clean_line_name(t):
    base = F.concat(F.col("pos").cast("string"), F.lit(")  "), "name")
    label = by_flag(F.concat(base, F.lit("____ Valore al lordo 12")), F.concat(base, F.lit(" di cui minusvalenze")), F.concat(base, F.lit("_____.-")))
    return t.line.select("doc", "pos", X.clean_line_name(label).alias("name"))


@query("line_depth", """
SELECT doc, pos, CASE WHEN flag = 'A' AND status = 'F' THEN 0 WHEN flag = 'A' THEN 1 WHEN flag = 'N' THEN 3 ELSE 2 END AS depth, CASE WHEN flag = 'A' THEN 1 WHEN flag = 'N' THEN 2 ELSE 0 END AS report_depth FROM line""", "line")
def line_depth(t):
    code = by_flag(F.when(F.col("status") == "F", "B.").otherwise("B.II."), F.lit("c"), F.concat(F.col("pos").cast("string"), F.lit(")")))
    return t.line.select("doc", "pos", X.line_depth(code, F.lit(False)).alias("depth"), X.report_depth(code).alias("report_depth"))


@query("flag_technical_entries", """
SELECT doc, pos, CASE WHEN flag = 'A' THEN 'entrata' WHEN flag = 'N' AND status = 'F' THEN 'spesa' END AS side FROM line""", "line")
def flag_technical_entries(t):
    label = by_flag(
        F.concat(F.lit("Entrate  da incassi VINCOLATI art. 195 "), "name"),
        F.when(F.col("status") == "F", F.concat(F.lit("Regolarizzazione cassa vincolata "), "name")).otherwise(F.concat(F.lit("incassi vincolati "), "name")),
        F.col("name"),
    )
    return t.line.select("doc", "pos", X.technical_entry(label).alias("side"))


@query("page_heading", """
SELECT doc_id, CASE WHEN lang = 'en' THEN '5.' || doc_id || ' NOTE DI COMMENTO' ELSE '' END AS heading FROM documents""")
def page_heading(t):
    """Whole texts; English ones get a heading line after their text."""
    headed = F.concat("text", F.lit("\n 5."), F.col("doc_id").cast("string"), F.lit(" NOTE DI COMMENTO\n5.99 SECONDA VOCE\n"), "text")
    page = F.when(F.col("lang") == "en", headed).otherwise(F.col("text"))
    return t.raw("documents").select("doc_id", X.page_heading(page).alias("heading"))


# --- rows of cells --------------------------------------------------------------

def _first_word():
    return F.element_at(F.split("name", " "), 1)


def _second_word():
    return F.element_at(F.split("name", " "), 2)


@query("normalize_cell_rows", """
SELECT doc, pos, CASE flag WHEN 'A' THEN pos || '.II' ELSE CAST(pos AS VARCHAR) END AS code, name AS description, CASE WHEN flag <> 'R' THEN CAST(amount AS DOUBLE) END AS current,
 CASE WHEN flag = 'A' THEN CAST(prior AS DOUBLE) END AS prior FROM line""", "line")
def normalize_cell_rows(t):
    number, none = F.col("pos").cast("string"), F.lit("")
    cells = F.array(
        none, number, by_flag(F.lit("II"), none, none), _first_word(), none, _second_word(),
        by_flag(EURO("amount"), EURO("amount"), none), none, by_flag(EURO("prior"), none, none),
    )
    rows = tables.normalize_statement_rows(t.line.select("doc", "pos", cells.alias("cells")))
    return rows.select("doc", "pos", "code", "description", out(F.col("current")).alias("current"), out(F.col("prior")).alias("prior"))


@query("row_label_amounts", """
SELECT doc, pos, CASE WHEN flag = 'R' THEN '' ELSE name END AS label, CASE WHEN flag = 'R' THEN 0 ELSE 2 END AS n, CASE WHEN flag <> 'R' THEN CAST(prior AS DOUBLE) END AS last_amount FROM line""", "line")
def row_label_amounts(t):
    number = F.col("pos").cast("string")
    none = F.lit("")
    cells = F.array(number, F.lit("ab"), F.col("name"), F.lit("x"), by_flag(EURO("amount"), EURO("amount"), none), by_flag(EURO("prior"), EURO("prior"), none))
    parts = C.with_parts(t.line.select("doc", "pos", cells.alias("cells")), "cells")
    return parts.select(
        "doc",
        "pos",
        C.row_label(F.col("_lead"), F.col("_amounts")).alias("label"),
        F.size("_amounts").alias("n"),
        out(F.try_element_at("_amounts", F.lit(-1))).alias("last_amount"),
    )


@query("classify_and_unfold_tables", """
SELECT doc, pos, kind, name AS voce, period, CAST(CASE src WHEN 1 THEN amount ELSE prior END AS DOUBLE) AS value FROM line JOIN (VALUES
 ('A', 'movimenti', 'inizio', 1), ('A', 'movimenti', 'variazione', 2), ('A', 'movimenti', 'fine', 1), ('A', 'movimenti', 'v4', 2), ('N', 'confronto', '2023', 1), ('N', 'confronto', 'variazione', 2),
 ('N', 'confronto', '2024', 1), ('R', 'dettaglio', '2024', 2)) k(flag, kind, period, src) USING (flag)""", "line")
def classify_and_unfold_tables(t):
    text = lambda *cs: F.array(*[F.lit(c) for c in cs])
    head = by_flag(
        text("Voce", "Valore di inizio esercizio", "Variazione", "Valore di fine"), text("Voce", "31.12.2023", "Variazione", "31.12.2024"), text("Descrizione", "31.12.2024")
    )
    data = by_flag(
        F.array("name", EURO("amount"), EURO("prior"), EURO("amount"), EURO("prior")),
        F.array("name", EURO("amount"), EURO("prior"), EURO("amount")),
        F.array("name", EURO("prior")),
    )
    short = F.array(F.lit("ab"), EURO("amount"))
    made = t.line.select("doc", "pos", F.array(head, short, data).alias("rows"))
    rows = tables.unfold_note_tables(made, 2024)
    return rows.select("doc", "pos", "kind", "voce", "period", out(F.col("value")).alias("value"))


@query("largest_table_per_page", """
SELECT doc, arg_max(pos, length(name) * 1000 - pos) AS table_index, CAST(max(length(name)) AS INT) AS n_rows FROM line GROUP BY doc""", "line")
def largest_table_per_page(t):
    made = t.line.select("doc", F.col("pos").alias("table_index"), F.array_repeat(F.array("name"), F.length("name")).alias("rows"))
    return tables.largest_table(made, ["doc"]).select("doc", "table_index", F.size("rows").alias("n_rows"))


@query("sizable_tables", """
SELECT doc, pos, r.row_no, CASE r.row_no WHEN 0 THEN name || '/' ELSE flag || '/' || status END AS cells FROM line, (VALUES (0), (2)) r(row_no) WHERE flag = 'A'""", "line")
def sizable_tables(t):
    spaced = F.concat(F.lit(" "), F.replace("name", F.lit(" "), F.lit(" \n ")), F.lit(" "))
    rows = F.array(F.array(spaced, F.lit(None).cast("string")), F.array(F.lit(" "), F.lit("\n")), F.array("flag", "status"))
    made = t.line.select("doc", "pos", F.when(F.col("flag") == "A", rows).otherwise(F.slice(rows, 1, 2)).alias("rows"))
    kept = tables.non_blank_rows(tables.sizable_tables(made))
    return kept.select("doc", "pos", "row_no", F.array_join("cells", "/").alias("cells"))


METRICS_SQL = """SELECT doc, pos, name AS entity_name, metric_name, CAST(CASE metric_name WHEN 'perc_consolidamento' THEN pos WHEN 'quota_posseduta' THEN pos WHEN 'spesa_personale' THEN amount
 WHEN 'valore_iscrizione_partecipazione' THEN amount WHEN 'frazione_patrimonio_netto' THEN amount ELSE prior END AS DOUBLE) AS value, unit FROM line"""


def _metric_rows(df):
    return df.select("doc", "pos", "entity_name", "metric_name", out(F.col("value")).alias("value"), "unit")


def _pct():
    return F.concat(F.col("pos").cast("string"), F.lit(",00%"))


@query("wide_record_to_metrics", METRICS_SQL + """, (VALUES ('perc_consolidamento', 'PCT'), ('spesa_personale', 'EUR'), ('perdite_ripianate_comune', 'EUR')) m(metric_name, unit)""", "line")
def wide_record_to_metrics(t):
    cells = F.array(F.col("name"), _pct(), F.lit("-"), EURO("amount"), EURO("prior"))
    return _metric_rows(tables.personnel_metrics(t.line.select("doc", "pos", cells.alias("cells"))))


def _two_rows(t, first, second):
    """Two printed rows per line, at positions 2k and 2k + 1."""
    return t.line.select("doc", F.col("pos").alias("line_no"), F.posexplode(F.array(first, second)).alias("half", "cells")).select(
        "doc", (F.col("line_no") * 2 + F.col("half")).alias("pos"), "cells"
    )


@query("block_record_to_metrics", """SELECT doc, page, entity_name, metric_name, value, unit, source, note FROM (SELECT x.*, pos * 2 AS page, CASE WHEN pos = 3 THEN 'valutazione_indiretta' ELSE 'valutazione_diretta' END AS source, 'EP 12' AS note FROM (""" + METRICS_SQL + """,
 (VALUES ('quota_posseduta', 'PCT'), ('valore_iscrizione_partecipazione', 'EUR'), ('patrimonio_netto', 'EUR'), ('frazione_patrimonio_netto', 'EUR')) m(metric_name, unit)) x)""", "line")
def block_record_to_metrics(t):
    none = F.lit("")
    rows = _two_rows(
        t,
        F.array(F.col("name"), *[none] * 7),
        F.array(none, _pct(), EURO("amount"), none, EURO("prior"), EURO("amount"), F.lit("-"), F.lit("EP 12")),
    ).withColumn("page", F.col("pos"))
    found = tables.valuation_metrics(rows, ["doc"], "pos", "page", indirect_pages=[6])
    return found.select("doc", "page", "entity_name", "metric_name", out(F.col("value")).alias("value"), "unit", "source", "note")


@query("paired_record_to_metrics", "SELECT doc, pos * 2 + 1 AS pos, entity_name, metric_name, value, unit FROM (" + METRICS_SQL + """,
 (VALUES ('perc_consolidamento', 'PCT'), ('incidenza_ricavi_comune', 'PCT'), ('spesa_personale', 'EUR'), ('perdite_ripianate_comune', 'EUR')) m(metric_name, unit))""", "line")
def paired_record_to_metrics(t):
    none = F.lit("")
    share = F.replace(F.col("prior").cast("string"), F.lit("."), F.lit(","))
    rows = _two_rows(t, F.array(none, F.col("name"), none), F.array(EURO("amount"), none, _pct(), F.concat(share, F.lit("%")), EURO("prior")))
    return _metric_rows(tables.paired_metrics(rows, ["doc"], "pos", tables.PERSONNEL_PAIRED, 4))


@query("entity_registry", """
SELECT doc, CAST(pos * 2 AS INT) AS pos, 'Fondazione ' || name AS name, CASE WHEN flag = 'R' THEN 'diretta ' || pos || ',50%' ELSE 'diretta ' || pos || ',50% indiretta 10,25% tramite Gear' END AS quota_text,
 CAST(CASE WHEN flag = 'R' THEN pos + 0.5 ELSE pos + 10.75 END AS DOUBLE) AS ownership_percentage, 'fondazione' AS entity_type FROM line""", "line")
def entity_registry(t):
    none = F.lit("")
    head = F.array(F.concat(F.lit("Fondazione "), "name"), F.lit("1.000,00"), F.concat(F.lit("diretta "), F.col("pos").cast("string"), F.lit(",50%")), F.lit("/"))
    more = F.array(none, F.lit("-"), F.lit("indiretta 10,25% tramite Gear"), F.lit("non rilevante"))
    header = F.array(F.lit("Denominazione"), F.lit("Quota posseduta"), F.lit("77%"), none)
    rows = t.line.select("doc", F.col("pos").alias("line_no"), F.posexplode(F.array(head, F.when(F.col("flag") == "R", header).otherwise(more))).alias("half", "cells"))
    rows = rows.select("doc", (F.col("line_no") * 2 + F.col("half")).alias("pos"), F.col("line_no").alias("page"), "cells")
    found = tables.entity_registry(rows, ["doc"], "pos", "page")
    return found.select("doc", "pos", "name", "quota_text", out(F.col("ownership_percentage")).alias("ownership_percentage"), "entity_type")
