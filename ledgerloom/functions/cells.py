"""Rows of table cells (``array<string>``) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import amount_value, is_amount

# Fixed value: a section letter, a roman numeral or a dotted line number.
CODE_CELL = r"^(?:[A-Za-z]|[IVXLCDM]+|\d+(?:\.\d+)*)$"


def filled(cells: Column) -> Column:
    return F.filter(cells, lambda c: c.isNotNull() & (c != ""))


def clean_cells(cells: Column) -> Column:
    """Inner line breaks and runs of spaces collapsed, NULL cells to empty."""
    return F.transform(cells, lambda c: F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit("")))


def amount_marks(cells: Column) -> Column:
    """For every cell a struct with its amount, NULL where it is none: the pattern is matched once per cell."""
    return F.transform(cells, lambda c: F.when(is_amount(c), F.struct(amount_value(c).alias("value"))))


def amounts(marks: Column) -> Column:
    """Every amount in the row, in printed order, from the marks of its cells."""
    return F.transform(F.filter(marks, lambda m: m.isNotNull()), lambda m: m["value"])


def leading_cells(cells: Column, marks: Column) -> Column:
    """Filled cells before the first amount."""
    first = F.coalesce(F.array_position(F.transform(marks, lambda m: m.isNotNull()), F.lit(True)).cast("int"), F.lit(0))
    # No amount leaves position 0, and then the whole row leads.
    return filled(F.slice(cells, F.lit(1), F.when(first > 0, first - 1).otherwise(F.size(cells))))


def with_parts(df: DataFrame, cells: str, lead: str = "_lead", found: str = "_amounts") -> DataFrame:
    """Add the leading cells and the amounts of a row, each worked out once."""
    marked = df.withColumn("_marks", amount_marks(F.col(cells)))
    return marked.withColumns({lead: leading_cells(F.col(cells), F.col("_marks")), found: amounts(F.col("_marks"))}).drop("_marks")


def is_code(cell_text: Column) -> Column:
    return cell_text.rlike(CODE_CELL)


def row_code(lead: Column) -> Column:
    """Hierarchy path of a statement row from its leading cells."""
    return F.array_join(F.filter(lead, is_code), ".")


def row_description(lead: Column) -> Column:
    """Label of a statement row, also when it is split over cells."""
    return F.array_join(F.filter(lead, lambda c: ~is_code(c)), " ")


def letters(cell: Column) -> Column:
    """Number of Latin letters in a cell."""
    return F.length(F.regexp_replace(cell, "[^A-Za-zÀ-ÿ]", ""))


def wordiest(lead: Column, found: Column) -> Column:
    """The wordiest leading cell as a struct of its letters ``n`` and ``cell``; of equals the first; NULL without amounts."""
    ranked = F.transform(lead, lambda c, i: F.struct(letters(c).alias("n"), (-i).alias("o"), c.alias("cell")))
    return F.when(F.size(found) > 0, F.array_max(ranked))


def row_label(lead: Column, found: Column) -> Column:
    """The wordiest leading cell; of equals the first; empty without amounts."""
    return F.coalesce(wordiest(lead, found)["cell"], F.lit(""))


def header_text(rows: Column, n: int = 3) -> Column:
    """Lower-case text of the first rows of a table (``array<array<string>>``)."""
    return F.lower(F.array_join(F.transform(F.slice(rows, 1, n), lambda r: F.array_join(r, " ", "")), " "))


def cell(cells: Column, index: int) -> Column:
    """Cell at a zero-based position, empty when the row is shorter."""
    return F.coalesce(F.try_element_at(cells, F.lit(index + 1)), F.lit(""))
