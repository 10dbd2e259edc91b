"""Numbers printed the Italian way: parsing, testing and formatting.

Everything is a JVM-side column expression. Dirty input gives NULL, never an
error, and a blank stays NULL unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the shape of an amount such as 1.234.567,89, -12,00 or (1.000,00).
AMOUNT = r"^\s*(\()?\s*([-+])?\s*(\d{1,3}(?:\.\d{3})*|\d+)(?:,(\d+))?\s*\)?\s*$"


# The same where non-breaking spaces count as spaces.
_SPACED_AMOUNT = AMOUNT.replace(r"\s", r"[\s\u00a0\u2007\u202f]")


def is_amount_text(text: Column) -> Column:
    """True where the text reads as an amount (NULL counts as no)."""
    return F.coalesce(text.rlike(_SPACED_AMOUNT), F.lit(False))


def is_amount(text: Column) -> Column:
    """Stricter test for table cells: an amount must carry a decimal comma."""
    return F.coalesce(F.contains(text, F.lit(",")), F.lit(False)) & is_amount_text(text)


def parse_localized_decimal(text: Column, precision: int = 20, scale: int = 2) -> Column:
    """Amount text to decimal; NULL when it does not read as one."""
    return F.when(text.rlike(_SPACED_AMOUNT), amount_value(text, precision, scale))


def amount_value(text: Column, precision: int = 20, scale: int = 2) -> Column:
    """Decimal of a text that is known to read as an amount.

    Such a text holds only digits, separators, a sign or parentheses and
    spaces, so the rest is character translation.
    """
    digits = F.translate(text, ",.()+- \t\n\r\f\u000b\u00a0\u2007\u202f", ".")
    negative = F.contains(text, F.lit("(")) | F.contains(text, F.lit("-"))
    return F.when(negative, F.concat(F.lit("-"), digits)).otherwise(digits).try_cast(f"decimal({precision},{scale})")


def parse_simple_locale(text: Column, empty_as_zero: bool = True) -> Column:
    """Dots dropped, comma as decimal point; blank gives 0 or NULL."""
    trimmed = F.trim(text)
    plain = F.replace(F.replace(trimmed, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    value = plain.try_cast("decimal(20,2)")
    if not empty_as_zero:
        return value
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(0).cast("decimal(20,2)")).otherwise(value)


def parse_dot_decimal(text: Column, bad_as_zero: bool = True) -> Column:
    """Plain ``1234.56``; anything else gives 0 or NULL."""
    value = F.trim(text).try_cast("decimal(20,2)")
    return F.coalesce(value, F.lit(0).cast("decimal(20,2)")) if bad_as_zero else value


def parse_percent(text: Column) -> Column:
    """``60,37%`` or ``3,163`` to decimal(20,4); dashes and slashes are NULL."""
    bare = F.trim(F.regexp_replace(F.trim(text), r"%+$", ""))
    return F.replace(bare, F.lit(","), F.lit(".")).try_cast("decimal(20,4)")


def _noisy_tail(text: Column) -> Column:
    """Token without its trailing underscores, then dashes, then dots."""
    return F.regexp_replace(F.trim(text), r"\.*-*_*$", "")


def _noisy_blob(tail: Column) -> Column:
    return F.regexp_extract(tail, r"(\(?\d[\d._]*\d\)?$|\(?\d\)?$)", 1)


def _noisy_value(tail: Column, blob: Column, digits: Column) -> Column:
    number = F.replace(digits, F.lit("."), F.lit("")).try_cast("bigint")
    usable = ~F.contains(tail, F.lit(",")) & digits.rlike(r"^(?:\d{1,3}(?:\.\d{3})*|\d+)$")
    return F.when(usable, F.when(blob.startswith("("), -number).otherwise(number))


def parse_noisy_integer(text: Column) -> Column:
    """Whole number fused with dotted leaders, as in ``O____21_6_._1_72``.

    Parentheses mean negative; a comma means the token is no whole number.
    """
    tail = _noisy_tail(text)
    blob = _noisy_blob(tail)
    return F.when(text.rlike(r"\d"), _noisy_value(tail, blob, F.translate(blob, "()_", "")))


def with_noisy_integer(df: DataFrame, text: str, out: str) -> DataFrame:
    """The same as a column, for large tables: each step is worked out once, and a plain number is read as it is."""
    plain = df.withColumn("_plain", F.coalesce(F.col(text).rlike(r"^(?:\d{1,18}|\d{1,3}(?:\.\d{3}){1,5})\z"), F.lit(False)))
    tail = plain.withColumn("_tail", F.when(~F.col("_plain") & F.col(text).rlike(r"\d"), _noisy_tail(F.col(text))))
    blob = tail.withColumn("_blob", _noisy_blob(F.col("_tail")))
    digits = blob.withColumn("_digits", F.translate("_blob", "()_", ""))
    value = F.when(F.col("_plain"), F.replace(F.col(text), F.lit("."), F.lit("")).try_cast("bigint")).otherwise(_noisy_value(F.col("_tail"), F.col("_blob"), F.col("_digits")))
    return digits.withColumn(out, value).drop("_plain", "_tail", "_blob", "_digits")


def parse_form_integer(text: Column) -> Column:
    """Form cell ``1.234.567``, ``(12)`` or ``+5`` to decimal; blank is NULL."""
    bare = F.regexp_replace(F.trim(text), r"[. ]", "")
    digits = F.regexp_replace(bare, r"[()+]", "").try_cast("decimal(20,2)")
    return F.when(bare.startswith("(") & bare.endswith(")"), -digits).otherwise(digits)


def sum_percentages(text: Column) -> Column:
    """Sum of every percentage stated in a sentence; NULL when there is none."""
    found = F.regexp_extract_all(text, F.lit(r"(\d{1,3}(?:[.,]\d+)?)\s*%"), F.lit(1))
    values = F.transform(
        found, lambda p: F.replace(p, F.lit(","), F.lit(".")).try_cast("decimal(20,4)")
    )
    total = F.aggregate(
        values,
        F.lit(0).cast("decimal(20,4)"),
        lambda acc, v: (acc + F.coalesce(v, F.lit(0))).cast("decimal(20,4)"),
    )
    return F.when(F.size(found) > 0, total)


def largest_amount(text: Column, patterns: list[str]) -> Column:
    """Largest amount caught by any of the patterns (each with one group)."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns])
    return F.array_max(F.transform(found, lambda t: parse_simple_locale(t, empty_as_zero=False)))


def format_localized(value: Column, decimals: int = 2) -> Column:
    """Number to ``1.234.567,89``; NULL prints as ``-``."""
    text = F.translate(F.format_number(value, decimals), ",.", ".,")
    return F.coalesce(text, F.lit("-"))


def format_plain(value: Column) -> Column:
    """Number to ``1234567.89``; NULL prints as an empty text."""
    return F.coalesce(F.replace(F.format_number(value, 2), F.lit(","), F.lit("")), F.lit(""))


def format_magnitude(value: Column, unit: str = "EUR") -> Column:
    """Billions and millions in words, smaller figures in full."""
    grouped = lambda v, d: F.replace(F.format_number(v, d), F.lit(","), F.lit(""))
    size = F.abs(value)
    return (
        F.when(value.isNull(), "n/d")
        .when(size >= 1e9, F.concat(F.lit("~"), grouped(value / F.lit(1e9), 2), F.lit(f" miliardi {unit}")))
        .when(size >= 1e6, F.concat(F.lit("~"), grouped(value / F.lit(1e6), 1), F.lit(f" milioni {unit}")))
        .otherwise(F.concat(grouped(value, 2), F.lit(f" {unit}")))
    )


def scale_units(value: Column, factor: int = 1000) -> Column:
    """Amounts reported in thousands (or another factor) to single units."""
    return (value * F.lit(factor)).cast("decimal(20,2)")


def to_output(value: Column) -> Column:
    """Decimals leave the engine as doubles."""
    return value.cast("double")
