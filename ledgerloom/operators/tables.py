"""Extracted page tables: rows of cells to long facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cells as C
from ledgerloom.functions.numbers import is_amount, is_amount_text, parse_localized_decimal, parse_percent, sum_percentages
from ledgerloom.functions.text import classify_entity
from ledgerloom.operators.ordered import coalesce_block_cells, merge_continuations, pair_rows


def normalize_statement_rows(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Statement cells to ``code, description, current, prior``; noise drops."""
    parsed = C.with_parts(rows, cells).select(
        *[c for c in rows.columns if c != cells],
        C.row_code(F.col("_lead")).alias("code"),
        C.row_description(F.col("_lead")).alias("description"),
        F.try_element_at("_amounts", F.lit(1)).alias("current"),
        F.try_element_at("_amounts", F.lit(2)).alias("prior"),
    )
    return parsed.where((F.col("description") != "") | F.col("current").isNotNull())


def largest_table(tables: DataFrame, keys: list[str], index: str = "table_index", rows: str = "rows") -> DataFrame:
    """The table with most rows on each page; of equals the first.

    The grouping sorts whole tables, so they are dealt anew before it, in
    partitions that Spark sizes by the tables and not by what they are made from.
    """
    dealt = tables.hint("rebalance", *[F.col(c) for c in (*keys, index)])
    size = F.struct(F.size(rows).alias("n"), (-F.col(index)).alias("i"))
    rest = [c for c in tables.columns if c not in keys]
    return dealt.groupBy(*keys).agg(F.max_by(F.struct(*rest), size).alias("_t")).select(*keys, "_t.*")


def sizable_tables(tables: DataFrame, min_rows: int = 3, rows: str = "rows") -> DataFrame:
    """Tables with enough rows, their cells cleaned."""
    return tables.where(F.size(rows) >= min_rows).withColumn(rows, F.transform(rows, C.clean_cells))


def non_blank_rows(tables: DataFrame, rows: str = "rows") -> DataFrame:
    """One row per table row that has at least one filled cell."""
    flat = tables.select(*[c for c in tables.columns if c != rows], F.posexplode(F.transform(rows, C.clean_cells)).alias("row_no", "cells"))
    return flat.where(F.exists("cells", lambda c: c != ""))


def note_kind(head: Column, year: int) -> Column:
    """Kind of a notes table from its header text: movements, comparison or detail.

    The markers are fixed values of the printed layout; the comparison looks
    for the closing date of the year before.
    """
    has = lambda t: F.contains(head, F.lit(t))
    return (
        F.when(has("valore di inizio"), "movimenti")
        .when(has(f"31.12.{year - 1}"), "confronto")
        .when(has("descrizione") & has("31.12"), "dettaglio")
    )


def unfold_note_tables(tables: DataFrame, year: int, rows: str = "rows") -> DataFrame:
    """Recognised notes tables to one row per line and period.

    Amounts beyond the known periods are called v2, v3 and so on; lines whose
    label has fewer than three letters are dropped.
    """
    periods = {
        "movimenti": ["inizio", "variazione", "fine"],
        "confronto": [str(year - 1), "variazione", str(year)],
        "dettaglio": [str(year)],
    }
    known = F.create_map(*[x for k, v in periods.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))])
    rest = [c for c in tables.columns if c != rows]
    # Conditions stand inside the generators: a filter above a column would be pushed below it and work it out again.
    headed = tables.withColumn("_head", C.header_text(F.col(rows)))
    kind = F.filter(F.array(note_kind(F.col("_head"), year)), lambda k: k.isNotNull())
    kinds = headed.select(*rest, rows, F.explode(kind).alias("kind"))
    each = F.posexplode(F.when(F.col("kind") != "", F.col(rows))).alias("row_no", "_cells")
    lines = C.with_parts(kinds.select(*rest, "kind", each), "_cells").withColumn("_best", C.wordiest(F.col("_lead"), F.col("_amounts")))
    usable = F.when(F.col("_best.n") >= 3, F.col("_amounts"))
    flat = lines.select(*rest, "kind", "row_no", F.col("_best.cell").alias("voce"), F.posexplode(usable).alias("_i", "value"))
    period = F.coalesce(F.try_element_at(known[F.col("kind")], F.col("_i") + 1), F.concat(F.lit("v"), (F.col("_i") + 1).cast("string")))
    return flat.withColumn("period", period).drop("_i")


# --- fixed values: registry header words, quota words and voting-share marks ---
REGISTRY_HEADERS = ["denominazione", "quota posseduta", "% voti", "capitale"]
QUOTA_WORDS = ["diretta", "indiretta", "tramite", "%"]
VOTING_MARKS = ["non rilevante", "/", "-", ""]


def _mentions(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | F.contains(F.lower(text), F.lit(word))
    return out


def entity_registry(rows: DataFrame, keys: list[str], pos: str, page: str, cells: str = "cells") -> DataFrame:
    """Registry rows to entities with their summed ownership quota.

    A row with a name opens an entity; rows without one continue its quota.
    Header rows and voting-share columns are left out.
    """
    cell = lambda i: C.cell(F.col(cells), i)
    quota_like = lambda c: ~F.lower(c).isin(*VOTING_MARKS) & _mentions(c, QUOTA_WORDS)
    own = F.concat_ws(" ", F.when(cell(2) != "", cell(2)), F.when(quota_like(cell(3)), cell(3)))
    spill = F.array_join(F.filter(F.col(cells), lambda c: (c != "") & quota_like(c)), " ")
    opens = cell(0) != ""
    body = rows.where(~_mentions(F.array_join(cells, " "), REGISTRY_HEADERS)).select(
        *keys, pos, page, cell(0).alias("name"), F.when(opens, own).otherwise(spill).alias("quota_text")
    )
    merged = merge_continuations(body, keys, pos, F.col("name") != "", "quota_text", ["name", page])
    return merged.withColumns(
        {
            "quota_text": F.trim(F.regexp_replace("quota_text", r"\s+", " ")),
            "ownership_percentage": sum_percentages(F.col("quota_text")).cast("decimal(20,4)"),
            "entity_type": classify_entity(F.col("name")),
        }
    )


# --- fixed values: metric, parser and cell position of each per-entity table ---
PERSONNEL_INLINE = [
    ("perc_consolidamento", "PCT", 1),
    ("incidenza_ricavi_comune", "PCT", 2),
    ("spesa_personale", "EUR", 3),
    ("perdite_ripianate_comune", "EUR", 4),
]
PERSONNEL_PAIRED = [
    ("perc_consolidamento", "PCT", 1),
    ("incidenza_ricavi_comune", "PCT", 2),
    ("spesa_personale", "EUR", 0),
    ("perdite_ripianate_comune", "EUR", 3),
]
VALUATION_NAMES = [
    ("quota_posseduta", "PCT"),
    ("valore_iscrizione_partecipazione", "EUR"),
    ("patrimonio_netto", "EUR"),
    ("frazione_patrimonio_netto", "EUR"),
    ("differenza_elisione", "EUR"),
]
VALUATION_WIDE, VALUATION_NARROW, VALUATION_PAIRED = [1, 3, 5, 7, 9], [1, 2, 4, 5, 6], [0, 1, 2, 3, 4]
VALUATION_WIDE_CELLS = 12
VALUATION_ENTRY = r"\bE[PI]\s*\d+\b"


def cells_to_metrics(rows: DataFrame, specs: list[tuple[str, str, int]], cells: str = "cells") -> DataFrame:
    """One row per metric whose cell reads as a percentage or an amount."""
    return _inline_metrics(rows, _metrics(specs, cells), cells)


def _metrics(specs: list[tuple[str, str, int]], cells: str) -> Column:
    def metric(name: str, unit: str, index: int) -> Column:
        text = C.cell(F.col(cells), index)
        value = parse_percent(text) if unit == "PCT" else parse_localized_decimal(text, 20, 4)
        return F.struct(F.lit(name).alias("metric_name"), value.cast("decimal(20,4)").alias("value"), F.lit(unit).alias("unit"))

    return F.array(*[metric(*s) for s in specs])


def _inline_metrics(rows: DataFrame, metrics: Column, cells: str) -> DataFrame:
    found = F.filter(metrics, lambda m: m["value"].isNotNull())
    return rows.select(*[c for c in rows.columns if c != cells], F.inline(found))


def personnel_metrics(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Inline personnel table: name and four figures per row."""
    name = C.cell(F.col(cells), 0)
    header = _mentions(F.array_join(cells, " "), ["organismo", "percentuale"])
    body = rows.where((name != "") & ~header & (F.size(cells) >= 5)).withColumn("entity_name", name)
    return cells_to_metrics(body, PERSONNEL_INLINE, cells)


def is_entity_row(cells: Column) -> Column:
    """Text in the first cell and no amount after it: the row names an entity."""
    head = C.cell(cells, 0)
    tail = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    return (head != "") & ~_mentions(head, ["organismo", "valutazione", "quota"]) & ~F.exists(tail, is_amount)


def valuation_metrics(
    rows: DataFrame, keys: list[str], pos: str, page: str, indirect_pages: list[int], cells: str = "cells"
) -> DataFrame:
    """Valuation table: an entity's name row and value rows folded into one.

    The column positions depend on how many columns the folded row has; rows
    blank in every cell belong to no entity and add no columns.
    """
    filled = rows.where(F.exists(cells, lambda c: F.trim(c) != ""))
    blocks = coalesce_block_cells(filled, keys, pos, is_entity_row(F.col(cells)), cells, carried=(page,))
    named = blocks.withColumns(
        {
            "entity_name": C.cell(F.col(cells), 0),
            "note": F.nullif(F.regexp_extract(F.array_join(cells, " "), VALUATION_ENTRY, 0), F.lit("")),
            "source": F.when(F.col(page).isin(*indirect_pages), "valutazione_indiretta").otherwise("valutazione_diretta"),
        }
    )
    spec = lambda at: _metrics([(n, u, i) for (n, u), i in zip(VALUATION_NAMES, at)], cells)
    wide = F.size(cells) >= VALUATION_WIDE_CELLS
    found = F.when(wide, spec(VALUATION_WIDE)).otherwise(spec(VALUATION_NARROW))
    return _inline_metrics(named, found, cells)


def paired_metrics(
    rows: DataFrame, keys: list[str], pos: str, specs: list[tuple[str, str, int]], min_cells: int, cells: str = "cells"
) -> DataFrame:
    """Name rows followed by value rows; values are read by their order."""
    packed = rows.withColumn(cells, C.filled(F.transform(cells, lambda c: F.trim(c)))).where(F.size(cells) > 0)
    numeric = F.size(F.filter(cells, lambda c: is_amount_text(c) | parse_percent(c).isNotNull()))
    name = F.when((F.size(cells) == 1) & C.cell(F.col(cells), 0).rlike("[A-Za-z]"), C.cell(F.col(cells), 0))
    marked = packed.withColumns({"_name_here": name, "_numeric": numeric})
    values = F.col("_name_here").isNull() & (F.col("_numeric") >= 3)
    paired = pair_rows(marked, keys, pos, F.col("_name_here"), values, out="entity_name").drop("_name_here", "_numeric")
    return cells_to_metrics(paired.where(F.size(cells) >= min_cells), specs, cells)


def valuation_paired_specs() -> list[tuple[str, str, int]]:
    return [(n, u, i) for (n, u), i in zip(VALUATION_NAMES, VALUATION_PAIRED)]
