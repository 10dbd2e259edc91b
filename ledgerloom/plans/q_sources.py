"""Source and load queries: files are written by Spark from the tables and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.numbers import to_output as out
from ledgerloom.operators.facts import two_years
from ledgerloom.plans.q_text import whole
from ledgerloom.plans.registry import query
from ledgerloom.session import scratch_path
from ledgerloom.sources import archives, load, readers

MONEY = "decimal(20,2)"
XML_RECORDS = 50_000  # records per written file


@query("src_delimited", """
WITH s AS (SELECT 'Città ' || n_name AS comune, '0' || strpos('ABFHM', substr(c_mktsegment, 1, 1)) AS code, sum(CAST(o_totalprice AS DECIMAL(20,2))) AS previsioni, sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(20,2)) ELSE 0 END) AS impegni FROM geo GROUP BY 1, 2),
 i AS (SELECT comune, code, 'previsioni' AS measure, previsioni AS value FROM s UNION ALL SELECT comune, code, 'impegni', impegni FROM s)
SELECT comune, 'voce' AS level, code, measure, CAST(value AS DOUBLE) AS value FROM i UNION ALL SELECT comune, 'totale', NULL, measure, CAST(sum(value) AS DOUBLE) FROM i GROUP BY 1, 4""", "geo")
def src_delimited(t):
    """Latin-1 semicolon files with padded titles and bodies of another type."""
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    rows = t.order_geo.select(
        F.lit("Comuni ").alias(" Descrizione Tipologia Soggetto"),
        F.concat(F.lit("Città "), "n_name").alias(" Descrizione Comune "),
        F.concat(F.lit("0"), F.expr("instr('ABFHM', substr(c_mktsegment, 1, 1))").cast("string")).alias("Codice Missione"),
        F.col("r_name").alias("Descrizione Missione"),
        price.alias("Previsioni Definitive di Competenza"),
        F.when(F.col("o_orderstatus") == "F", price).otherwise("n.d.").alias(" Impegni"),
    )
    other = rows.withColumn(" Descrizione Tipologia Soggetto", F.lit("Province"))
    path = scratch_path(t.spark, "delimited")
    rows.unionByName(other).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    read = readers.read_delimited(t.spark, path)
    cities = read.where(F.upper(F.trim(F.col(readers.SUMMARY_TYPE))) == readers.SUMMARY_CITY_TYPE)
    measures = {"Previsioni Definitive di Competenza": "previsioni", "Impegni": "impegni"}
    items = readers.normalize_side(
        cities.withColumnRenamed(readers.SUMMARY_MEMBER, "comune"), ["comune"], "Codice Missione", "Descrizione Missione", measures, "Totale"
    )
    return items.select("comune", "level", "code", "measure", out(F.col("value")).alias("value"))


@query("src_archive", "SELECT region, year, comune, code, CAST(value AS DOUBLE) AS value FROM member", "member")
def src_archive(t):
    """Archives per region and year, as the portal publishes them, written and read as files."""
    number = F.row_number().over(Window.partitionBy("region", "year").orderBy("comune", "code"))
    rows = t.member.withColumn("line_no", number)
    title = rows.select("region", "year").distinct().select("region", "year", F.lit(0).alias("line_no"), F.lit("comune; code ;value").alias("line"))
    body = rows.select("region", "year", "line_no", F.concat_ws(";", F.concat(F.lit('"'), "comune", F.lit('"')), "code", F.col("value").cast("string")).alias("line"))
    name = lambda text: F.concat(F.lit(text), F.col("year").cast("string"), F.lit(".csv"))
    wanted = title.unionByName(body).withColumn("member", name("Riepilogo_Spese_"))
    other = title.withColumn("member", name("Riepilogo_Spese_Province_")).unionByName(
        title.withColumns({"member": name("Riepilogo_Spese_Province_"), "line_no": F.lit(1), "line": F.lit("X;Y;1")})
    )
    path = scratch_path(t.spark, "archives")
    archives.write_archives(wanted.unionByName(other), path, "line_no")
    read = archives.read_members(t.spark, path, ["Riepilogo_Spese"], ["comune", "code", "value"], exclude="Province")
    return read.select("region", "year", "comune", "code", F.col("value").cast("double").alias("value"))


@query("src_xml_records", """
SELECT cig, oggetto, struttura, aggiudicatario, nullif(n_partecipanti - 1, 0) AS n_partecipanti, CAST(importo_aggiudicazione AS DOUBLE) AS importo_aggiudicazione, CAST(importo_liquidato AS DOUBLE) AS importo_liquidato,
 CASE WHEN anno >= 1998 THEN anno || '-01-31' END AS data_inizio FROM contract""", "contract")
def src_xml_records(t):
    """Contract files as the XML writer lays them out, read by record tag."""
    col = F.col
    firm = F.struct(F.lit("ditta").alias("ragioneSociale"))
    begin = F.when(col("anno") >= 1998, F.concat(col("anno").cast("string"), F.lit("-01-31"))).otherwise(readers.NO_DATE)
    records = t.contract.select(
        "cig",
        F.struct(col("struttura").alias("denominazione")).alias("strutturaProponente"),
        F.concat(F.lit(" "), "oggetto", F.lit(" ")).alias("oggetto"),
        F.lit("17-AFFIDAMENTO DIRETTO").alias("sceltaContraente"),
        F.struct(F.array_repeat(firm, col("n_partecipanti") - 1).alias("partecipante")).alias("partecipanti"),
        F.struct(F.array(F.struct(col("aggiudicatario").alias("ragioneSociale"))).alias("aggiudicatario")).alias("aggiudicatari"),
        col("importo_aggiudicazione").cast("string").alias("importoAggiudicazione"),
        col("importo_liquidato").cast("string").alias("importoSommeLiquidate"),
        F.struct(begin.alias("dataInizio")).alias("tempiCompletamento"),
    )
    path = scratch_path(t.spark, "xml")
    # A file is read whole by one task, so files are kept small.
    writer = records.write.format("xml").option("rootTag", "pubblicazione").option("rowTag", "lotto")
    writer.option("maxRecordsPerFile", XML_RECORDS).option("compression", "gzip").save(path)
    rows = readers.read_contract_xml(t.spark, path)
    return rows.select(
        "cig", "oggetto", "struttura", "aggiudicatario", "n_partecipanti",
        out(F.col("importo_aggiudicazione")).alias("importo_aggiudicazione"), out(F.col("importo_liquidato")).alias("importo_liquidato"), "data_inizio",
    )


@query("normalize_revenue_csv", """
WITH s AS (SELECT n_name AS comune, 5 * strpos('ABFHM', substr(c_mktsegment, 1, 1)) AS number, max(c_mktsegment) AS name,
  sum(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(20,2)) END) AS a, sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(20,2)) ELSE 0 END) AS r
  FROM geo WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
 i AS (SELECT comune, number, name, 'accertamenti' AS measure, a AS value FROM s UNION ALL SELECT comune, number, name, 'riscossioni_totali', r FROM s),
 u AS (SELECT comune, 'voce' AS level, number, name, measure, value FROM i UNION ALL SELECT comune, 'totale', NULL, 'Totale generale delle entrate', measure, sum(value) FROM i GROUP BY 1, 5)
SELECT comune, level, CAST(number AS VARCHAR) AS code, name, measure, CAST(value AS DOUBLE) AS value, CAST(row_number() OVER (PARTITION BY comune, measure ORDER BY number NULLS LAST) AS INT) AS position FROM u""", "geo")
def normalize_revenue_csv(t):
    """Latin-1 files with a line per kind of revenue, two column orders, amounts with a decimal comma."""
    text = F.translate(F.format_number(F.col("o_totalprice").cast(MONEY), 2), ",.", ".,")
    number = F.expr("5 * instr('ABFHM', substr(c_mktsegment, 1, 1))").cast("string")
    lines = t.order_geo.select(
        F.concat(number, F.lit(" - "), "c_mktsegment").alias(" Titolo"),
        F.when(F.col("o_orderstatus") == "P", "Fondo pluriennale").otherwise("Tipologia 101: altro").alias("Tipologia "),
        text.alias("Accertamenti"),
        F.when(F.col("o_orderstatus") == "F", text).alias("Riscossioni"),
        F.col("n_name").alias("Comune"),
    )
    path = scratch_path(t.spark, "revenue")
    even = F.pmod(F.xxhash64("Comune", "Accertamenti"), F.lit(2)) == 0
    lines.where(even).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    lines.where(~even).select("Riscossioni", "Comune", "Accertamenti", "Tipologia ", " Titolo").write.mode("append").csv(path, sep=";", header=True, encoding="ISO-8859-1")
    rows = readers.read_delimited(t.spark, path).withColumnRenamed("Comune", "comune")
    measures = {"Accertamenti": "accertamenti", "Riscossioni": "riscossioni_totali"}
    items = readers.normalize_revenue(rows, ["comune"], "Titolo", "Tipologia", measures, "Totale generale delle entrate")
    return items.select("comune", "level", "code", "name", "measure", out(F.col("value")).alias("value"), "position")


@query("src_file_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS anno FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) IN (1996, 1997)")
def src_file_year(t):
    """Files named after their year, and drafts without one, of which two years are opened."""
    stem = F.when(F.col("o_orderstatus") == "P", "bozza").otherwise(F.col("year").cast("string"))
    lines = t.orders.select(F.concat(F.lit("anac_"), stem, F.lit(".txt")).alias("file_name"), "o_orderkey", F.col("o_orderkey").cast("string").alias("line"))
    path = scratch_path(t.spark, "year-files")
    archives.write_texts(lines, path, "o_orderkey")
    read = readers.read_year_lines(t.spark, path, [1996, 1997])
    return read.select(F.col("value").cast("long").alias("o_orderkey"), "anno")


@query("normalize_spending_csv", """
WITH c AS (SELECT DISTINCT comune FROM member),
 v AS (SELECT comune, '0' || strpos('ABFHM', substr(code, 1, 1)) AS code, CASE WHEN year = 1997 THEN 'pagamenti_totali' ELSE 'impegni' END AS measure, value FROM member WHERE year IN (1997, 1998)),
 i AS (SELECT comune, code, m.measure, coalesce((SELECT sum(value) FROM v WHERE v.comune = k.comune AND v.code = k.code AND v.measure = m.measure), 0) AS value
  FROM (SELECT DISTINCT comune, code FROM v WHERE value <> 0) k, (VALUES ('impegni'), ('pagamenti_totali')) m(measure))
SELECT comune, 'voce' AS level, code, CASE code WHEN '01' THEN 'Servizi' ELSE 'Missione ' || CAST(CAST(code AS INT) AS VARCHAR) END AS name, measure, CAST(value AS DOUBLE) AS value FROM i
UNION ALL SELECT c.comune, 'totale', NULL, 'Totale generale delle spese', m.measure, CAST(coalesce((SELECT sum(value) FROM v WHERE v.comune = c.comune AND v.measure = m.measure), 0) AS DOUBLE)
FROM c, (VALUES ('impegni'), ('pagamenti_totali')) m(measure)""", "member")
def normalize_spending_csv(t):
    """Matrix files of every city: titles, body lines, the printed total row, and a later row that begins like it."""
    euro = lambda c: F.replace(F.replace(F.replace(F.format_number(c, 2), F.lit(","), F.lit("_")), F.lit("."), F.lit(",")), F.lit("_"), F.lit("."))
    place = F.expr("instr('ABFHM', substr(code, 1, 1))")
    zero = F.lit(0).cast("decimal(30,2)")
    at = lambda n, year: F.coalesce(F.sum(F.when((place == n) & (F.col("year") == year), F.col("value"))), zero)
    whole_year = lambda year: F.coalesce(F.sum(F.when(F.col("year") == year, F.col("value"))), zero)
    cells = [c for n in range(1, 24) for c in (at(n, 1998), F.lit(7).cast("decimal(30,2)"), at(n, 1997))]
    sums = t.member.groupBy("comune").agg(F.array(*[euro(c) for c in (*cells, zero, whole_year(1998), zero, whole_year(1997))]).alias("cells"))
    label = lambda text: F.lit(f"{text};;")
    blank = ";".join([""] * 73)
    lines = F.array(
        F.lit("Titolo;Macroaggregato;" + ";".join(f"c{i}" for i in range(73))),
        F.lit(f'"1 - Spese; ""correnti""";101 - Redditi;{blank}'),
        F.concat(label(" TOTALE MISSIONI - TOTALE GENERALE DELLE SPESE"), F.array_join("cells", ";")),
        F.lit(f"TOTALE MISSIONI;;{blank}"),
    )
    files = sums.select(F.concat(F.col("comune"), F.lit(".csv")).alias("file_name"), F.posexplode(lines).alias("n", "line"))
    path = scratch_path(t.spark, "matrix")
    archives.write_texts(files, path, "n")
    rows = readers.read_positional(t.spark, path, 75)
    items = readers.normalize_spending_matrix(rows, ["source_file"], "pos", "cells", {"01": "Servizi"})
    return items.select(F.replace("source_file", F.lit(".csv"), F.lit("")).alias("comune"), "level", "code", "name", "measure", out(F.col("value")).alias("value"))


@query("city_comparison", """
WITH m AS (SELECT comune, region, year, strpos('ABFHM', substr(code, 1, 1)) AS n, code, value FROM member WHERE comune NOT IN ('NATION_3', 'NATION_4') AND NOT (region = 'AFRICA' AND year = 1996)),
 e AS (SELECT comune, region, year, n, code, value FROM m WHERE comune <> 'NATION_5' OR year <> 1997),
 both_sides AS (SELECT DISTINCT comune, year FROM e),
 i AS (SELECT comune, region, year, 'spesa' AS kind, '0' || n AS code, CASE n WHEN 1 THEN 'Servizi' ELSE code END AS name, u.measure, CASE u.measure WHEN 'previsioni' THEN value WHEN 'impegni' THEN value - 1 ELSE 0 END AS value
   FROM m SEMI JOIN both_sides USING (comune, year), (VALUES ('previsioni'), ('impegni'), ('pagamenti_totali')) u(measure)
  UNION ALL SELECT comune, region, year, 'entrata', CAST(n AS VARCHAR), code, u.measure, CASE u.measure WHEN 'previsioni' THEN value WHEN 'accertamenti' THEN 2 ELSE 0 END
   FROM e, (VALUES ('previsioni'), ('accertamenti'), ('riscossioni_totali')) u(measure))
SELECT comune, region, year, kind, 'voce' AS level, code, name, measure, CAST(value AS DOUBLE) AS value, 'EUR' AS unit, 'BDAP Rendiconto SDB ' || year || ' (RGS/MEF) — N' || lower(substr(comune, 2)) AS source FROM i
UNION ALL SELECT comune, region, year, kind, 'totale', NULL, CASE kind WHEN 'spesa' THEN 'Totale generale delle spese' ELSE 'Totale generale delle entrate' END, measure, CAST(sum(value) AS DOUBLE), 'EUR',
 'BDAP Rendiconto SDB ' || year || ' (RGS/MEF) — N' || lower(substr(comune, 2)) FROM i GROUP BY comune, region, year, kind, measure""", "member")
def city_comparison(t):
    """Archives of regions and years with both sides, a year that lacks one, bodies that share a city's name, cities not asked for."""
    col, text = F.col, lambda c: c.cast("string")
    rows = t.member.withColumn("n", F.expr("instr('ABFHM', substr(code, 1, 1))"))
    head = "Descrizione Tipologia Soggetto; Descrizione Comune ;Codice %s;Descrizione %s;Previsioni Definitive di Competenza;%s"
    line = lambda kind, *parts: F.concat_ws(";", F.lit(kind), F.lower("comune"), F.concat(F.lit("0"), text(col("n"))), *parts)
    # A code stands in two lines; its first one names it. The body of another type shares the name.
    spending = F.array(
        line("COMUNI", col("code"), text(col("value") - 1), text(col("value") - 1), F.lit("n.d.")),
        line("comuni ", F.lit("Zeta"), F.lit("1"), F.lit(""), F.lit("")),
        line("Province", F.lit("Altro"), F.lit("99"), F.lit("99"), F.lit("99")),
    )
    revenue = F.array(line("Comuni", F.concat(F.lit('"'), col("code"), F.lit('"')), text(col("value")), F.lit("2.00"), F.lit("")))
    has_revenue = ~((col("region") == "AFRICA") & (col("year") == 1996)) & ~((col("comune") == "NATION_5") & (col("year") == 1997))

    def member(found, needle, title, body):
        scopes = t.member.select("region", "year").distinct().where(~((col("region") == "AFRICA") & (col("year") == 1996)) | F.lit("Spese" in needle))
        top = scopes.select("region", "year", F.lit(0).alias("line_no"), F.lit(title).alias("line"))
        lines = found.select("region", "year", F.posexplode(body).alias("k", "line"), "comune", "n")
        numbered = lines.select("region", "year", (F.hash("comune", "n").cast("long") * 4 + 20_000_000_000 + col("k")).alias("line_no"), "line")
        return top.withColumn("line_no", F.lit(0).cast("long")).unionByName(numbered).withColumn("member", F.lit(f"2020 {needle}.csv"))

    wanted = member(rows, "Spese Riepilogo Missioni", head % ("Missione", "Missione", "Impegni;Totale Pagamenti"), spending).unionByName(
        member(rows.where(has_revenue), "Entrate Riepilogo Titoli", head % ("Titolo", "Titolo", "Accertamenti;Totale Riscossioni"), revenue)
    )
    other = member(rows.limit(0), "Spese Riepilogo Missioni - Voce di Riepilogo", "x;y", spending)
    path = scratch_path(t.spark, "city-archives")
    archives.write_archives(wanted.unionByName(other), path, "line_no")
    names = t.spark.createDataFrame([("spesa", "01", "Servizi"), ("entrata", "9", "Altro")], "kind string, code string, name string")
    cities = {r["comune"]: r["region"] for r in t.order_geo.select(col("n_name").alias("comune"), col("r_name").alias("region")).distinct().collect()}
    asked = {c: r for c, r in cities.items() if c not in ("NATION_3", "NATION_4")}
    return readers.city_comparison(t.spark, path, asked, names).withColumn("value", out(col("value")))


@query("src_unpivot_seed", """
SELECT user_id, event_type, measure, CAST(value AS DOUBLE) AS value FROM (SELECT user_id, event_type, 'inizio' AS measure, nullif(inizio, 0) AS value FROM movement
 UNION ALL SELECT user_id, event_type, 'fine', fine FROM movement) WHERE value IS NOT NULL""", "movement")
def src_unpivot_seed(t):
    wide = t.movement.withColumn("inizio", F.nullif("inizio", F.lit(0)).cast("decimal(31,2)")).withColumn("fine", F.col("fine").cast("decimal(31,2)"))
    return readers.unpivot_seed(wide, ["user_id", "event_type"], ["inizio", "fine"]).withColumn("value", out(F.col("value")))


@query("src_form_rows", """
SELECT doc, pos, s.seq, CASE s.seq WHEN 0 THEN NULL ELSE 'D.' END AS code, CASE s.seq WHEN 0 THEN name ELSE 'Debiti verso Comune di Torino' END AS name, CASE s.seq WHEN 1 THEN 'socio' END AS related_party, CAST(y.year AS INT) AS year,
 CAST(CASE WHEN y.year = 2024 AND s.seq = 0 THEN floor(amount) WHEN s.seq = 0 THEN -floor(prior) ELSE pos END AS DOUBLE) AS value
FROM line, (VALUES (0), (1)) s(seq), (VALUES (2024), (2023)) y(year) WHERE NOT (s.seq = 1 AND y.year = 2023)""", "line")
def src_form_rows(t):
    row = lambda code, name, cur, prev: F.struct(
        F.lit(code).alias("code"), name.alias("name"), F.lit(False).alias("total"), cur.alias("v_cur"), prev.alias("v_prev")
    )
    rows = F.array(
        row("", F.col("name"), whole("amount"), F.concat(F.lit("("), whole("prior"), F.lit(")"))),
        row("B", F.lit("Riga vuota"), F.lit(" "), F.lit(None).cast("string")),
        row("D.", F.lit(" Debiti verso Comune di Torino"), F.concat(F.lit("+"), F.col("pos").cast("string")), F.lit("")),
    )
    forms = t.line.select(
        F.concat_ws("-", F.col("doc").cast("string"), F.col("pos").cast("string")).alias("slug"),
        F.lit(2024).alias("year"), F.lit(2023).alias("prev_year"), rows.alias("rows"),
    )
    items = readers.form_items(forms, "conto_economico")
    key = F.split("entity_slug", "-")
    return items.select(
        key[0].cast("bigint").alias("doc"), key[1].cast("int").alias("pos"), "seq", "code", "name", "related_party", "year", out(F.col("value")).alias("value")
    )


@query("content_checksum", "SELECT doc_id, sha256(text) AS checksum, sha256(source || '|' || lang || '|' || CAST(n_chars AS VARCHAR)) AS composite FROM documents")
def content_checksum(t):
    return t.raw("documents").select("doc_id", F.sha2("text", 256).alias("checksum"), load.composite_checksum("source", "lang", "n_chars").alias("composite"))


@query("append_new_only", """
SELECT min(doc_id) AS doc_id, sha256(text) AS checksum FROM documents WHERE lang <> 'en' AND text NOT IN (SELECT text FROM documents WHERE lang = 'en') GROUP BY text""")
def append_new_only(t):
    texts = t.raw("documents").select("doc_id", "lang", F.sha2("text", 256).alias("checksum"))
    registered = texts.where(F.col("lang") == "en")
    return load.new_only(texts.select("doc_id", "checksum"), registered, "doc_id").select("doc_id", "checksum")


@query("replace_scope", """
SELECT year, kind, capitolo_code, CAST(value AS DOUBLE) AS value FROM leaf WHERE year NOT IN (SELECT year FROM leaf WHERE liv1_name = 'ASIA' AND year >= 1999)
UNION ALL SELECT year, kind, capitolo_code, CAST(value * 2 AS DOUBLE) FROM leaf WHERE liv1_name = 'ASIA' AND year >= 1999""", "leaf")
def replace_scope(t):
    leaves = t.leaf.select("year", "kind", "capitolo_code", F.col("value").cast("decimal(31,2)").alias("value"), "liv1_name")
    incoming = leaves.where((F.col("liv1_name") == "ASIA") & (F.col("year") >= 1999)).withColumn("value", (F.col("value") * 2).cast("decimal(31,2)"))
    return load.replace_scope(leaves.drop("liv1_name"), incoming.drop("liv1_name"), ["year"]).withColumn("value", out(F.col("value")))


@query("observed_load", """
SELECT year, kind, capitolo_code, CAST(CASE WHEN year >= 1997 THEN value * 2 ELSE value END AS DOUBLE) AS value FROM leaf""", "leaf")
def observed_load(t):
    """Three loads of one pass each: all years, later years anew, and one that fails its rules and changes nothing."""
    path = scratch_path(t.spark, "observed")
    leaves = t.leaf.select("year", "kind", "capitolo_code", F.col("value").cast("decimal(31,2)").alias("value"))
    rules = {"valued": F.bool_and(F.col("value").isNotNull()), "positive": F.sum("value") > 0}
    double = leaves.where("year >= 1997").withColumn("value", (F.col("value") * 2).cast("decimal(31,2)"))
    wrong = leaves.withColumn("value", (-F.col("value")).cast("decimal(31,2)"))
    for rows in (leaves, double, wrong):
        load.observed_load(rows, rules, path, ["year"])
    stored = t.spark.read.schema(leaves.schema).parquet(path)
    return stored.select("year", "kind", "capitolo_code", out(F.col("value")).alias("value"))


@query("surrogate_ids", """
SELECT cig, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY anno, cig) AS id FROM contract""", "contract")
def surrogate_ids(t):
    existing = t.orders.select(F.col("o_orderkey").alias("id"))
    return load.surrogate_ids(t.contract.select("cig", "anno"), [F.col("anno"), F.col("cig")], existing).select("cig", "id")


@query("unfold_current_prior", """
SELECT o_orderkey, CAST(y AS INT) AS year, value FROM (SELECT o_orderkey, year(o_orderdate) AS y, o_totalprice AS value FROM orders UNION ALL SELECT o_orderkey, year(o_orderdate) - 1, o_totalprice - 1000 FROM orders WHERE o_orderstatus <> 'O')""")
def unfold_current_prior(t):
    rows = t.orders.select(
        "o_orderkey", F.col("year").alias("report_year"), F.col("o_totalprice").alias("current"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice") - 1000).alias("prior"),
    )
    return two_years(rows, F.col("report_year"), F.col("report_year") - 1).drop("report_year")


@query("typed_append", """
SELECT year, kind, count(*) AS n, count(*) FILTER (liv3_code IS NULL) AS n_blank, CAST(sum(value) AS DOUBLE) AS value FROM leaf GROUP BY 1, 2""", "leaf")
def typed_append(t):
    """Leaves appended by year in two loads, blanks stored as NULL, read back."""
    path = scratch_path(t.spark, "leaves")
    leaves = t.leaf.withColumn("liv3_code", F.coalesce("liv3_code", F.lit("")))
    for side in ("spesa", "entrata"):
        load.append_typed(leaves.where(F.col("kind") == side), path, schemas.RENDICONTO_CAPITOLI, blank_is_null=("liv3_code", "liv3_name"))
    stored = t.spark.read.parquet(path)
    return stored.groupBy("year", "kind").agg(
        F.count("*").alias("n"), F.count_if(F.col("liv3_code").isNull()).alias("n_blank"), out(F.sum("value")).alias("value")
    )


@query("raw_audit_json", """
SELECT doc, pos, '{"page":' || pos || ',"cells":["' || name || '","' || flag || '"]}' AS raw_json FROM line""", "line")
def raw_audit_json(t):
    rows = t.line.select("doc", "pos", F.col("pos").alias("page"), F.array("name", "flag").alias("cells"))
    return load.audit_rows(rows, ["doc"], "pos", "page", "cells")


@query("normalized_audit_csv", """
SELECT doc, pos, name, CASE WHEN flag = 'A' THEN CAST(amount AS VARCHAR) ELSE '' END AS amount, flag || ', "' || name || '"' AS note FROM line""", "line")
def normalized_audit_csv(t):
    """Normalized rows as CSV, one folder per group of documents; what is NULL stands as an empty field."""
    rows = t.line.select(
        (F.col("doc") % 4).alias("part"), "doc", "pos", "name", F.when(F.col("flag") == "A", F.col("amount")).alias("amount"),
        F.concat(F.col("flag"), F.lit(', "'), F.col("name"), F.lit('"')).alias("note"),
    )
    path = scratch_path(t.spark, "normalized")
    load.write_normalized(rows, path, ["part"], ["doc", "pos", "name", "amount", "note"])
    read = t.spark.read.csv(path, header=True, escape='"')
    amount = F.coalesce("amount", F.lit("")).alias("amount")
    return read.select(F.col("doc").cast("long").alias("doc"), F.col("pos").cast("int").alias("pos"), "name", amount, "note")


@query("availability_by_group", "SELECT region, string_agg(DISTINCT CAST(year AS VARCHAR), ',' ORDER BY CAST(year AS VARCHAR)) AS years FROM member GROUP BY region", "member")
def availability_by_group(t):
    return load.availability(t.member, "region").select("region", F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"))


@query("missing_members", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def missing_members(t):
    present = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return load.missing_members(t.raw("customer"), present, "c_custkey")
