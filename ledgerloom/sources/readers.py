"""Sources: delimited files, XML records, year files, forms and seed tables."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions.numbers import parse_dot_decimal, parse_form_integer, parse_simple_locale
from ledgerloom.functions.text import by_number, first_rule, unpad_code
from ledgerloom.operators.facts import select_member
from ledgerloom.operators.hierarchy import rollup_to_parent, unfold_matrix_row
from ledgerloom.operators.lookups import borrow_labels
from ledgerloom.session import materialize
from ledgerloom.sources.archives import cells_of, read_members


def read_delimited(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", multi_line: bool = False) -> DataFrame:
    """Semicolon files as text columns with trimmed names; each file's own titles tell its columns.

    Blank lines are skipped by the reader and rows shorter than the header are
    filled with NULL, so the filters of the caller drop them. Fields that run
    over line ends need ``multi_line``, and a file is then read by one task.
    """
    parts = []
    for paths in header_groups(spark, path):
        raw = spark.read.csv(paths, sep=";", header=True, encoding=encoding, quote='"', escape='"', mode="PERMISSIVE", multiLine=multi_line)
        parts.append(raw.toDF(*[c.strip() for c in raw.columns]))
    if not parts:
        return spark.createDataFrame([], "struct<>")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a folder by their title line, which names the columns of each file.

    A file's titles are the first line of its first block. What reaches the
    driver are file names, which Spark's own listing holds there as well.
    """
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at"), "_metadata.file_path", "_metadata.file_block_start")
    first = lines.where((F.col("file_block_start") == 0) & (F.trim("value") != "")).groupBy("file_path").agg(F.min_by("value", "at").alias("titles"))
    titles = F.transform(cells_of(F.col("titles")), lambda c: F.trim(c))
    groups = first.groupBy(titles.alias("titles")).agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    return [[unquote(f) for f in row["files"]] for row in groups.orderBy("titles").collect()]


CATEGORY = r"^(\d+)\s*-\s*(.+)$"
CATEGORY_ROW = "TIPOLOGIA"


def normalize_revenue(rows: DataFrame, keys: list[str], category: str, kind: str, measures: dict[str, str], total_name: str) -> DataFrame:
    """Lines per kind of revenue to items per category, in numeric order of the codes, and grand totals.

    A line counts if its category reads ``N - name`` and its kind begins with
    the fixed word; amounts have a decimal comma, and blank ones are zero.
    """
    text = F.trim(F.col(f"`{category}`"))
    used = rows.where(text.rlike(CATEGORY) & F.startswith(F.upper(F.trim(F.col(f"`{kind}`"))), F.lit(CATEGORY_ROW)))
    typed = used.select(
        *keys,
        F.regexp_extract(text, CATEGORY, 1).alias("code"),
        F.trim(F.regexp_extract(text, CATEGORY, 2)).alias("name"),
        *[F.coalesce(parse_simple_locale(F.col(f"`{c}`")), F.lit(0)).cast("decimal(30,2)").alias(m) for c, m in measures.items()],
    )
    items = rollup_to_parent(typed, keys, list(measures.values()), total_name)
    # the window sees one row per category of a key and measure
    return items.withColumn("position", F.row_number().over(Window.partitionBy(*keys, "measure").orderBy(*by_number("code"))))


def normalize_side(
    rows: DataFrame,
    keys: list[str],
    code_col: str,
    name_col: str,
    measures: dict[str, str],
    total_name: str,
    unpad: bool = False,
    order: str | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """One side of a delimited summary to long items and grand totals.

    Amounts use a decimal point; what does not read as one counts as zero. An
    item is named by ``names`` (code, name) where they know its code, else by
    its first line in ``order``.
    """
    bare = F.trim(F.col(f"`{code_col}`"))
    typed = rows.select(
        *keys,
        *([F.col(order).alias("_order")] if order else []),
        (unpad_code(bare) if unpad else bare).alias("code"),
        F.trim(F.col(f"`{name_col}`")).alias("name"),
        *[parse_dot_decimal(F.col(f"`{c}`")).cast("decimal(30,2)").alias(m) for c, m in measures.items()],
    )
    items = rollup_to_parent(typed, keys, list(measures.values()), total_name, "_order" if order else None)
    return borrow_labels(items, names).select(*items.columns) if names is not None else items


MATRIX_TOTAL = "TOTALE MISSIONI"


def read_positional(spark: SparkSession, path: str, width: int, encoding: str = "ISO-8859-1") -> DataFrame:
    """Semicolon files without regard to titles: ``source_file``, ``pos`` in reading order, and ``width`` cells."""
    names = [f"_c{i}" for i in range(width)]
    raw = spark.read.csv(path, schema=", ".join(f"{n} string" for n in names), sep=";", encoding=encoding, quote='"', escape='"')
    return raw.select(F.col("_metadata.file_name").alias("source_file"), F.monotonically_increasing_id().alias("pos"), F.array(*names).alias("cells"))


def normalize_spending_matrix(
    rows: DataFrame, keys: list[str], pos: str, cells: str, names: dict[str, str], codes: list[str] = presets.PROGRAMME_COLUMNS
) -> DataFrame:
    """A matrix of programmes by kind of spending to items per programme and grand totals.

    The first row that begins with the fixed words holds the printed column
    totals: after two label columns three columns per code (committed, reserved,
    paid), one that is skipped, and the three grand totals. A key without such
    a row, or with one too short, raises an error when the plan runs. Amounts
    have a decimal comma; codes zero in both measures are left out.
    """
    width = 2 + 3 * len(codes) + 4
    printed = F.startswith(F.trim(F.coalesce(F.element_at(cells, 1), F.lit(""))), F.lit(MATRIX_TOTAL))
    chosen = rows.groupBy(*keys).agg(F.min_by(cells, F.when(printed, F.col(pos))).alias("_row"))
    amounts = F.transform(F.slice("_row", 3, width - 2), lambda c: F.coalesce(parse_simple_locale(F.coalesce(c, F.lit(""))), F.lit(0)).cast("decimal(30,2)"))
    absent = F.raise_error(F.concat_ws(" ", F.lit(f"no row '{MATRIX_TOTAL}' in"), *[F.col(k).cast("string") for k in keys])).cast("array<decimal(30,2)>")
    short = F.raise_error(F.lit(f"row '{MATRIX_TOTAL}' has fewer than {width} cells")).cast("array<decimal(30,2)>")
    checked = F.when(F.col("_row").isNull(), absent).when(F.size("_row") < width, short).otherwise(amounts)
    # The marker keeps the check in the plan whatever columns a caller asks for.
    wide = chosen.select(*keys, checked.alias("_cells")).where(F.size("_cells") > 0)
    long = unfold_matrix_row(wide, keys, "_cells", codes, 3, {0: "impegni", 2: "pagamenti_totali"})
    own = F.concat(F.lit("Missione "), F.col("code").cast("int").cast("string"))
    label = F.coalesce(*[F.when(F.col("code") == c, F.lit(n)) for c, n in names.items()], own, F.lit("Totale generale delle spese"))
    return long.withColumn("name", label).select(*keys, "level", "code", "name", "measure", "value")


# Column titles of the open-data summaries and their measures.
SUMMARY_SPENDING = {
    "Previsioni Definitive di Competenza": "previsioni",
    "Impegni": "impegni",
    "Totale Pagamenti": "pagamenti_totali",
}
SUMMARY_REVENUE = {
    "Previsioni Definitive di Competenza": "previsioni",
    "Accertamenti": "accertamenti",
    "Totale Riscossioni": "riscossioni_totali",
}
SUMMARY_MEMBER, SUMMARY_TYPE, SUMMARY_CITY_TYPE = "Descrizione Comune", "Descrizione Tipologia Soggetto", "COMUNI"


SUMMARY_SIDES = {
    "spesa": ("Spese Riepilogo Missioni", "Codice Missione", "Descrizione Missione", SUMMARY_SPENDING, False, "Totale generale delle spese"),
    "entrata": ("Entrate Riepilogo Titoli", "Codice Titolo", "Descrizione Titolo", SUMMARY_REVENUE, True, "Totale generale delle entrate"),
}
SUMMARY_EXCLUDED = "Voce di Riepilogo"


def city_rows(rows: DataFrame, city: str) -> DataFrame:
    """Rows of one city; other bodies that share its name stay out."""
    return select_member(rows, f"`{SUMMARY_MEMBER}`", f"`{SUMMARY_TYPE}`", city, SUMMARY_CITY_TYPE)


def city_comparison(spark: SparkSession, path: str, cities: dict[str, str], names: DataFrame | None = None) -> DataFrame:
    """Summary items of many cities from the archives of their regions, all in one job.

    ``cities`` maps a city to its region, whose archives of any year are read.
    A city counts in a year only with rows on both sides; other bodies that
    share its name stay out. ``names`` (kind, code, name) gives the labels of
    codes it knows. Columns: comune, region, year, kind, level, code, name,
    measure, value, unit, source.
    """
    columns = sorted({SUMMARY_MEMBER, SUMMARY_TYPE} | {c for side in SUMMARY_SIDES.values() for c in (side[1], side[2], *side[3])})
    scopes = [(region, None) for region in sorted(set(cities.values()))]
    rows = read_members(spark, path, [s[0] for s in SUMMARY_SIDES.values()], columns, exclude=SUMMARY_EXCLUDED, scopes=scopes)
    place = F.create_map(*[F.lit(v) for city, region in cities.items() for v in (city.strip().upper(), region.strip().upper())])
    upper = lambda c: F.upper(F.trim(F.col(f"`{c}`")))
    ours = rows.withColumns({"comune": upper(SUMMARY_MEMBER), "region": F.upper("region")}).where(
        (upper(SUMMARY_TYPE) == SUMMARY_CITY_TYPE) & (F.try_element_at(place, F.col("comune")) == F.col("region"))
    )
    # Written once: both sides and their totals read it.
    ours = materialize(ours, "city-rows")
    keys = ["comune", "region", "year"]
    sides = []
    for kind, (needle, code, name, measures, unpad, total) in SUMMARY_SIDES.items():
        labels = names.where(F.col("kind") == kind).select("code", "name") if names is not None else None
        side = normalize_side(ours.where(F.col("needle") == needle), keys, code, name, measures, total, unpad, "line_no", labels)
        sides.append(side.withColumn("kind", F.lit(kind)))
    items = sides[0].unionByName(sides[1])
    # A total stands for every side that has rows, so two kinds of totals mean both sides.
    both = items.where(F.col("level") == "totale").groupBy(*keys).agg(F.countDistinct("kind").alias("_kinds")).where("_kinds = 2")
    source = F.concat(F.lit("BDAP Rendiconto SDB "), F.col("year").cast("string"), F.lit(" (RGS/MEF) — "), F.initcap("comune"))
    return items.join(both.drop("_kinds"), keys, "left_semi").select(
        *keys, "kind", "level", "code", "name", "measure", "value", F.lit("EUR").alias("unit"), source.alias("source")
    )


def load_city_comparison(spark: SparkSession, path: str, cities: dict[str, str], target: str, names: DataFrame | None = None) -> None:
    """Rebuild the comparison table under ``target``; it then holds exactly what the archives hold."""
    rows = city_comparison(spark, path, cities, names)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("region", "year").parquet(target)


CONTRACT_RECORD = (
    "cig string, strutturaProponente struct<denominazione:string>, oggetto string, sceltaContraente string, "
    "partecipanti struct<partecipante:array<struct<codiceFiscale:string,ragioneSociale:string>>>, "
    "aggiudicatari struct<aggiudicatario:array<struct<codiceFiscale:string,ragioneSociale:string>>>, "
    "importoAggiudicazione string, importoSommeLiquidate string, "
    "tempiCompletamento struct<dataInizio:string,dataUltimazione:string>"
)
NO_DATE = "0000-00-00"


def read_contract_xml(spark: SparkSession, path: str) -> DataFrame:
    """Contract records of XML files, with the file name as ``source_document``."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", "lotto")
        .option("ignoreNamespace", True)
        .schema(CONTRACT_RECORD)
        .load(path)
        .withColumn("source_document", F.col("_metadata.file_name"))
    )
    return contract_columns(raw)


def contract_columns(records: DataFrame) -> DataFrame:
    """Nested contract records to flat rows; blanks and date sentinels are NULL."""
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    date = lambda c: F.nullif(text(c), F.lit(NO_DATE))
    first = "aggiudicatari.aggiudicatario"
    awardee = lambda f: F.nullif(F.trim(F.try_element_at(F.col(f"{first}.{f}"), F.lit(1))), F.lit(""))
    count = F.size("partecipanti.partecipante")
    return records.select(
        text("cig").alias("cig"),
        text("oggetto").alias("oggetto"),
        text("strutturaProponente.denominazione").alias("struttura"),
        text("sceltaContraente").alias("scelta_contraente"),
        awardee("ragioneSociale").alias("aggiudicatario"),
        awardee("codiceFiscale").alias("aggiudicatario_cf"),
        F.when(count > 0, count).alias("n_partecipanti"),
        parse_dot_decimal(F.col("importoAggiudicazione"), bad_as_zero=False).alias("importo_aggiudicazione"),
        parse_dot_decimal(F.col("importoSommeLiquidate"), bad_as_zero=False).alias("importo_liquidato"),
        date("tempiCompletamento.dataInizio").alias("data_inizio"),
        date("tempiCompletamento.dataUltimazione").alias("data_ultimazione"),
        "source_document",
    )


def with_file_year(df: DataFrame, name: str, years: list[int] | None = None) -> DataFrame:
    """Year from names such as ``anac_2021.xml``; other names drop out."""
    year = F.regexp_extract(F.col(name), r"_([^_./]+)\.[^./]+$", 1).try_cast("int")
    dated = df.withColumn("anno", year).where(F.col("anno").isNotNull())
    return dated.where(F.col("anno").isin(*years)) if years else dated


def read_year_lines(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """Lines of the files named ``..._YYYY.ext``, of the given years only, as ``value``, ``file_name`` and ``anno``.

    The year is a condition on the file's metadata, so other files are not opened.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    return with_file_year(lines, "file_name", years)


def unpivot_seed(wide: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Curated wide table to one row per measure; missing cells drop."""
    return wide.unpivot(keys, measures, "measure", "value").where(F.col("value").isNotNull())


def form_items(forms: DataFrame, category: str, rows: str = "rows") -> DataFrame:
    """Filled-in form lines to statement items of the current and prior year.

    ``rows`` is ``array<struct<code,name,total,v_cur,v_prev>>`` in printed
    order. Lines blank in both years are skipped and take no number; a line
    that names the owner is marked as related party.
    """
    parsed = F.transform(
        F.col(rows),
        lambda r: F.struct(
            F.trim(r["name"]).alias("name"),
            F.trim(F.coalesce(r["code"], F.lit(""))).alias("code"),
            F.coalesce(r["total"], F.lit(False)).alias("is_total"),
            parse_form_integer(r["v_cur"]).alias("cur"),
            parse_form_integer(r["v_prev"]).alias("prev"),
        ),
    )
    entered = F.filter(parsed, lambda r: r["cur"].isNotNull() | r["prev"].isNotNull())
    lines = forms.select("slug", "year", "prev_year", F.posexplode(entered).alias("seq", "_r"))
    values = F.array(
        F.struct(F.col("year").alias("year"), F.col("_r.cur").alias("value")),
        F.struct(F.col("prev_year").alias("year"), F.col("_r.prev").alias("value")),
    )
    return lines.select(
        F.col("slug").alias("entity_slug"),
        F.lit(category).alias("category"),
        "seq",
        F.nullif(F.col("_r.code"), F.lit("")).alias("code"),
        F.col("_r.name").alias("name"),
        F.col("_r.is_total").alias("is_total"),
        first_rule(F.lower(F.col("_r.name")), presets.FORM_OWNER_RULES).alias("related_party"),
        F.inline(F.filter(values, lambda v: v["value"].isNotNull())),
    )
