"""Printed statements from word boxes ``(document, page, text, x0, x1, top)``.

Words become visual rows, rows become label and amounts, rows become lines of
a statement. Pages are independent until the lines are put in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions.numbers import scale_units, with_noisy_integer
from ledgerloom.functions.text import clean_line_name, is_total_line, line_code, related_party
from ledgerloom.operators.facts import two_years
from ledgerloom.operators.ordered import SLICE, block_ids, join_lines, neighbours, positions, row_index
from ledgerloom.session import materialize


def _row_starts(tops: Column, tolerance: float) -> Column:
    """First baselines of the rows of a page, from its sorted distinct baselines.

    A baseline joins the open row when it is within the tolerance of the row's
    first baseline; otherwise it opens the next row.
    """

    def step(starts: Column, top: Column) -> Column:
        near = F.abs(top - F.try_element_at(starts, F.lit(-1))) <= tolerance
        return F.when(near, starts).otherwise(F.concat(starts, F.array(top)))

    return F.aggregate(tops, F.array().cast("array<double>"), step)


def visual_rows(words: DataFrame, keys: list[str], tolerance: float = 3.5) -> DataFrame:
    """The visual rows of every page: ``row_top`` and ``_words``, the row's words from left to right.

    Sorted by baseline, a gap wider than the tolerance always ends a row, so a
    page falls into runs of near baselines, and the rule of ``_row_starts`` is
    folded over one run at a time. The words are shuffled once, by page; what
    is gathered is a run, which is rarely more than one printed line.
    """
    above = F.lag("top").over(Window.partitionBy(*keys).orderBy("top"))
    far = F.coalesce((F.col("top") - above > tolerance).cast("int"), F.lit(0))
    order = Window.partitionBy(*keys).orderBy("top").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = ["x0", "top", *[c for c in words.columns if c not in (*keys, "x0", "top")]]
    # Packed before the shuffle, where it is compiled; the grouping below would build the struct field by field.
    packed = words.select(*keys, "top", F.struct(*own).alias("_w"))
    marked = packed.withColumn("_far", far).withColumn("_run", F.sum("_far").over(order))
    runs = marked.groupBy(*keys, "_run").agg(
        F.sort_array(F.collect_list("_w")).alias("_all"), F.min("top").alias("_first"), F.max("top").alias("_last")
    )
    one = F.col("_last") - F.col("_first") <= tolerance
    tops = F.sort_array(F.array_distinct(F.filter(F.transform("_all", lambda w: w["top"]), lambda t: t.isNotNull())))
    starts = F.when(one, F.array("_first")).otherwise(_row_starts(tops, tolerance))
    rows = runs.withColumn("_starts", starts).select(
        *keys, "_all", F.size("_starts").alias("_n"), F.posexplode("_starts").alias("_i", "row_top"), F.try_element_at("_starts", F.col("_i") + 2).alias("_next")
    )
    inside = F.filter("_all", lambda w: (w["top"] >= F.col("row_top")) & (F.col("_next").isNull() | (w["top"] < F.col("_next"))))
    return rows.select(*keys, "row_top", F.when(F.col("_n") == 1, F.col("_all")).otherwise(inside).alias("_words"))


def cluster_rows(words: DataFrame, keys: list[str], tolerance: float = 3.5) -> DataFrame:
    """Words with ``row_top``, the baseline that names their visual row."""
    return visual_rows(words, keys, tolerance).select(*keys, "row_top", F.inline("_words")).select(*words.columns, "row_top")


def printed_rows(
    words: DataFrame,
    keys: list[str],
    tolerance: float = 3.5,
    marks: dict[str, Column] | None = None,
    labels: Column | None = None,
    numbers: Column | None = None,
) -> DataFrame:
    """Visual rows with their words from left to right, numbers already read.

    ``marks`` are further fields of a word, worked out before the words are gathered.
    ``labels`` and ``numbers`` say, if given, whose text and whose number the layout reads; other
    words are sent with what places them on the page alone.
    """
    read = words.select(*keys, "x0", "top", "x1", "text")
    if numbers is None:
        read = with_noisy_integer(read, "text", "n")
    else:
        read = with_noisy_integer(read.withColumn("_number", F.when(numbers, F.col("text"))), "_number", "n").drop("_number")
    if labels is not None:
        told = {"x1": F.when(F.col("n").isNotNull() | labels, F.col("x1")), "text": F.when(labels, F.col("text"))}
        read = read.withColumns(told)
    return visual_rows(read.withColumns(marks or {}), keys, tolerance)


def _texts(words: Column) -> Column:
    return F.trim(F.array_join(F.transform(words, lambda w: w["text"]), " "))


def _right_most(words: Column) -> Column:
    """Number with the largest right edge; of equals the first printed."""
    return F.array_max(F.transform(words, lambda w: F.struct(w["x1"].alias("a"), (-w["x0"]).alias("b"), w["n"].alias("n"))))["n"]


# what a word is in the civil-code layout
MONTHS, LABEL, CURRENT, PRIOR = range(4)


def assign_columns(words: DataFrame, keys: list[str], layout: dict = presets.CIVIL_LAYOUT) -> DataFrame:
    """Words to visual rows as ``label, current, prior`` in the civil-code layout.

    Far-right numbers are the prior year and the right-most remaining one the
    current year; "12 mesi" is a heading, not a number. The current year keeps
    the first of two equally placed numbers and the prior year the last.
    """
    number = F.when(F.col("x1") >= layout["prior_x1_min"], PRIOR).when(F.col("x1") >= layout["current_x1_min"], CURRENT)
    months = F.when(F.lower("text") == "mesi", MONTHS)
    marks = {"kind": F.coalesce(F.when(F.col("n").isNotNull(), number), months, F.lit(LABEL)).cast("tinyint")}
    rows = printed_rows(words, keys, layout["row_tolerance"], marks)
    heading = lambda i: F.coalesce(F.try_element_at(F.col("_words"), i + 2)["kind"] == MONTHS, F.lit(False))
    of = lambda kind: F.filter("_words", lambda w, i: (w["kind"] == kind) & ~heading(i))
    return rows.select(
        *keys,
        "row_top",
        _texts(F.filter("_words", lambda w, i: (w["kind"] < CURRENT) | heading(i))).alias("label"),
        _right_most(of(CURRENT)).alias("current"),
        F.try_element_at(of(PRIOR), F.lit(-1))["n"].alias("prior"),
    )


def _line_position(df: DataFrame, keys: list[str], page: str) -> DataFrame:
    """Position that follows page and baseline (to a thousandth of a point)."""
    return df.withColumn(
        "_pos", F.col(page).cast("bigint") * 100_000_000 + F.round(F.col("row_top") * 1000).cast("bigint")
    )


def assemble_statement(
    words: DataFrame, keys: list[str], page: str, year: Column, prior_year: Column, layout: dict = presets.CIVIL_LAYOUT
) -> DataFrame:
    """Civil-code statement lines, one row per line and year.

    A row that opens with a code or is a total starts a line; other rows extend
    its label and lend it their amounts when it has none yet.
    """
    rows = assign_columns(words, [*keys, page], layout)
    # Written once: the scan below reads it twice.
    rows = materialize(_line_position(rows.where(F.col("label") != ""), keys, page), "rows")
    starts = (line_code(F.col("label")) != "") | is_total_line(F.col("label"))
    marked = rows.withColumn("_starts", starts)
    numbered = block_ids(marked, keys, "_pos", F.col("_starts"), out="_line")
    has_amount = F.col("current").isNotNull() | F.col("prior").isNotNull()
    lines = (
        numbered.where(F.col("_line") > 0)
        .groupBy(*keys, "_line")
        .agg(
            F.min_by(page, "_pos").alias("page"),
            F.min("_pos").alias("_pos"),
            F.min_by(is_total_line(F.col("label")), "_pos").alias("_printed_total"),
            join_lines("_pos", "label").alias("_label"),
            F.min_by(F.struct("current", "prior"), F.when(has_amount, F.col("_pos"))).alias("_v"),
        )
        .withColumns({"name": clean_line_name(F.col("_label")), "current": F.col("_v.current"), "prior": F.col("_v.prior")})
        .where(F.col("name") != "")
    )
    sequenced = printed_lines(lines, keys)
    named = sequenced.select(
        *keys,
        "page",
        "seq",
        line_code(F.col("name")).alias("code"),
        "name",
        (F.col("_printed_total") | is_total_line(F.col("name"))).alias("is_total"),
        related_party(F.col("name")).alias("related_party"),
        "current",
        "prior",
    )
    return two_years(named, year, prior_year)


# A row begins more than the tolerance below the one before it, so a slice of
# so many thousandths of a point holds about as many rows as one of ordered.SLICE lines.
ROW_SLICE = SLICE * 3500


def printed_lines(lines: DataFrame, keys: list[str], width: int = SLICE, spans: bool | None = None) -> DataFrame:
    """Number the lines that carry at least one amount, in printed order.

    Lines whose groups are known to lie in one slice each are read once and need not be written.
    """
    emitted = F.col("current").isNotNull() | F.col("prior").isNotNull()
    kept = lines.where(emitted)
    kept = kept if spans is False else materialize(kept, "lines")
    return row_index(kept, keys, "_pos", "seq", width, spans).withColumn("seq", F.col("seq").cast("int"))


def four_column_rows(words: DataFrame, keys: list[str], layout: dict = presets.FOUR_COLUMN_LAYOUT) -> DataFrame:
    """Words to visual rows of the layout current | party | prior | party."""
    worded = F.col("x0") < layout["label_x0_max"]
    counted = (F.col("x1") <= layout["current_x1_max"]) | F.col("x1").between(layout["prior_x1_min"], layout["prior_x1_max"])
    # Notes are told before the words are gathered; they keep their place only.
    note = F.coalesce(F.col("text").rlike(presets.FOUR_COLUMN_NOTE), F.lit(True))
    rows = printed_rows(words, keys, layout["row_tolerance"], labels=worded & ~note, numbers=counted & ~note).where(F.col("row_top") >= layout["skip_top"])
    is_current = lambda w: w["x1"] <= layout["current_x1_max"]
    is_prior = lambda w: w["x1"].between(layout["prior_x1_min"], layout["prior_x1_max"])
    numbers = lambda test: F.filter("_words", lambda w: w["n"].isNotNull() & test(w))
    return rows.select(
        *keys,
        "row_top",
        _texts(F.filter("_words", lambda w: w["x0"] < layout["label_x0_max"])).alias("label"),
        _right_most(numbers(is_current)).alias("current"),
        _right_most(numbers(is_prior)).alias("prior"),
    )


def assemble_four_columns(
    words: DataFrame,
    keys: list[str],
    page: str,
    year: Column,
    prior_year: Column,
    factor: int = 1,
    layout: dict = presets.FOUR_COLUMN_LAYOUT,
) -> DataFrame:
    """Four-column statement lines with split labels merged.

    A label-only row within the gap below a value row completes its label; one
    above does too, unless the value row before it has already taken it.
    """
    rows = materialize(_line_position(four_column_rows(words, [*keys, page], layout), keys, page), "rows")
    rows = rows.withColumn("_valued", F.col("current").isNotNull() | F.col("prior").isNotNull())
    # Groups within one slice are shuffled once for all that follows.
    spans, missing = positions(rows, "_pos", ROW_SLICE)
    spans = None if missing else spans
    indexed = row_index(rows, keys, "_pos", width=ROW_SLICE, spans=spans, keep_slice=spans is False)
    around = neighbours(indexed, keys, "idx", ["label", "row_top", "_valued"], {"above": -1, "above2": -2, "below": 1})
    near = lambda a, b: F.abs(a - b) <= layout["label_gap"]
    label_only = lambda r: ~F.col(f"{r}._valued") & (F.col(f"{r}.label") != "")
    taken = F.coalesce(F.col("above2._valued") & near(F.col("above2.row_top"), F.col("above.row_top")), F.lit(False))
    upper = F.when(label_only("above") & near(F.col("row_top"), F.col("above.row_top")) & ~taken, F.col("above.label"))
    lower = F.when(label_only("below") & near(F.col("below.row_top"), F.col("row_top")), F.col("below.label"))
    own = F.when(F.col("label") != "", F.col("label"))
    lines = around.where("_valued").withColumn("name", F.trim(F.concat_ws(" ", upper, own, lower))).where(F.col("name") != "")
    sequenced = printed_lines(lines.drop("idx", "above", "above2", "below", "label", "row_top"), keys, ROW_SLICE, spans)
    first_word = F.lower(F.element_at(F.split("name", r"\s+"), 1))
    shouting = (F.col("name") == F.upper("name")) & (F.length("name") > 1)
    named = sequenced.select(
        *keys,
        F.col(page).alias("page"),
        "seq",
        "name",
        (first_word.isin(*presets.FOUR_COLUMN_TOTAL_WORDS) | shouting).alias("is_total"),
        "current",
        "prior",
    )
    return two_years(named, year, prior_year).withColumn("value", scale_units(F.col("value"), factor))


def counterparty_rows(
    words: DataFrame,
    keys: list[str],
    page: str,
    entity: str,
    columns: list[tuple[str, str]],
    bounds: list[float] = presets.COUNTERPARTY_BOUNDS,
    label_x0_max: float = presets.FOUR_COLUMN_LAYOUT["label_x0_max"],
    factor: int = 1000,
    layout: dict = presets.FOUR_COLUMN_LAYOUT,
) -> DataFrame:
    """Non-zero amounts of one counterparty's row, named by their column.

    A number belongs to the first column whose right bound is not exceeded;
    beyond the last bound it belongs to the last column.
    """
    worded = F.col("x0") < label_x0_max
    rows = printed_rows(words, [*keys, page], layout["row_tolerance"], labels=worded, numbers=F.col("x0") >= label_x0_max).where(
        F.col("row_top") >= layout["skip_top"]
    )
    label = _texts(F.filter("_words", lambda w: w["x0"] < label_x0_max))
    wanted = rows.where(F.lower(label).startswith(entity.lower()))
    cells = wanted.select(*keys, page, "row_top", F.inline(F.filter("_words", lambda w: w["x0"] >= label_x0_max)))
    column = F.lit(len(bounds) + 1)
    for i in range(len(bounds), 0, -1):
        column = F.when(F.col("x1") <= bounds[i - 1], i).otherwise(column)
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("category")) for n, c in columns])
    return (
        cells.where(F.col("n") != 0)
        .withColumn("_col", F.try_element_at(names, column))
        .where(F.col("_col").isNotNull())
        .select(
            *keys,
            F.col(page).alias("page"),
            F.col("row_top"),
            "x0",
            F.col("_col.category").alias("category"),
            F.col("_col.name").alias("name"),
            scale_units(F.col("n"), factor).alias("value"),
            F.lit(entity).alias("related_party"),
        )
    )


def counterparty_items(
    words: DataFrame, keys: list[str], page: str, entity: str, sides: dict[int, list[tuple[str, str]]], **layout
) -> DataFrame:
    """One counterparty's amounts over the pages of a table, numbered in printed order.

    ``sides`` gives the columns printed on each page, in the order in which the
    pages count; ``layout`` goes to ``counterparty_rows``.
    """
    parts = [
        counterparty_rows(words.where(F.col(page) == number), keys, page, entity, columns, **layout).withColumn("_side", F.lit(i))
        for i, (number, columns) in enumerate(sides.items())
    ]
    # the window sees the cells of one counterparty: as many as the table has columns
    order = Window.partitionBy(*keys).orderBy("_side", "row_top", "x0")
    items = reduce(DataFrame.unionByName, parts).withColumn("seq", F.row_number().over(order) - 1)
    return items.select(*keys, "page", "seq", "category", "name", "value", "related_party")
