"""Text rules of statements, entities and reports as column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce
from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import presets


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _accent_pairs() -> tuple[str, str]:
    """Latin letters whose compatibility form is one base letter plus marks."""
    accented, base = [], []
    for point in (0x00AA, 0x00BA, *range(0x00C0, 0x0250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)):
        letter = chr(point)
        bare = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(bare) == 1 and bare != letter:
            accented.append(letter)
            base.append(bare)
    return "".join(accented), "".join(base)


_ACCENTED, _BASE = _accent_pairs()


def fold_accents(text: Column) -> Column:
    """Accented Latin letters to their base letter, loose marks removed."""
    return F.regexp_replace(F.translate(text, _ACCENTED, _BASE), "[\u0300-\u036f]", "")


def slugify(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def clean_entity_name(raw: Column) -> Column:
    """Upper case without parentheticals, accents or typographic punctuation."""
    bare = F.regexp_replace(raw, r"\([^)]*\)", " ")
    folded = F.translate(fold_accents(bare), "’–—", "'--")
    return collapse_spaces(F.upper(folded))


# Fixed value: legal-form suffixes that end the distinctive part of a name.
LEGAL_SUFFIX = r"\bS\.?P\.?A\.?\b|\bS\.?R\.?L\.?\b|\bS\.?C\.?AR"


def canonical_entity(raw: Column, registry: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(slug, display name)`` of a raw name; the first registry pattern wins.

    Names no pattern knows get a slug of their own, so nothing is lost.
    """
    cleaned = clean_entity_name(raw)
    core = F.trim(F.element_at(F.split(cleaned, LEGAL_SUFFIX, 2), 1))
    own_slug = F.when(slugify(core) != "", slugify(core)).otherwise(slugify(cleaned))
    if not registry:
        return own_slug, F.trim(raw)
    slug = name = None
    for key, display, pattern in registry:
        hit = cleaned.rlike(pattern)
        slug = F.when(hit, key) if slug is None else slug.when(hit, key)
        name = F.when(hit, display) if name is None else name.when(hit, display)
    return slug.otherwise(own_slug), name.otherwise(F.trim(raw))


def first_rule(text: Column, rules: list[tuple[str, list[str]]], default: str | None = None) -> Column:
    """Label of the first rule one of whose needles the text contains."""
    out = None
    for label, needles in rules:
        hit = reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(default)) if default is not None else out


def classify_entity(name: Column, rules=presets.ENTITY_TYPE_RULES) -> Column:
    padded = F.concat(F.lit(" "), F.upper(name), F.lit(" "))
    return first_rule(padded, rules, presets.OTHER_ENTITY_TYPE)


def related_party(name: Column, rules=presets.RELATED_PARTY_RULES) -> Column:
    return first_rule(F.lower(name), rules)


def line_code(label: Column, pattern: str = presets.STATEMENT_CODE) -> Column:
    """Leading structural code of a statement label, empty when there is none."""
    return F.regexp_extract(label, pattern, 0)


def compact_upper(text: Column) -> Column:
    return F.upper(F.replace(text, F.lit(" "), F.lit("")))


def is_total_line(label: Column, prefixes: list[str] = presets.STATEMENT_TOTAL_PREFIXES) -> Column:
    """Totals and results, also when printed with spaced letters."""
    squeezed = compact_upper(label)
    return reduce(lambda a, b: a | b, [squeezed.startswith(p) for p in prefixes])


def clean_line_name(label: Column, memo: str = presets.STATEMENT_MEMO) -> Column:
    """Label up to the first memo phrase, without dotted leaders."""
    cut = F.regexp_replace(label, f"(?s){memo}.*$", "")
    spaced = F.regexp_replace(cut, "_{2,}", " ")
    return F.regexp_replace(F.regexp_replace(spaced, r"\s+", " "), r"^[ ._-]+|[ ._-]+$", "")


def line_depth(code: Column, is_total: Column) -> Column:
    """Indentation depth of a civil-code statement line."""
    bare = F.trim(F.coalesce(code, F.lit("")))
    return (
        F.when(is_total | (bare == ""), 0)
        .when(bare.rlike(r"^[A-E][.\)]$"), 0)
        .when(bare.rlike(r"^[A-E]\.[IVX]"), 1)
        .when(bare.rlike(r"^[a-z]"), 3)
        .otherwise(2)
    )


def report_depth(code: Column) -> Column:
    """Depth in a consolidated report: letters below dotted below plain codes."""
    bare = F.trim(F.coalesce(code, F.lit("")))
    return F.when(bare.rlike(r"^[a-z]$"), 2).when(F.contains(bare, F.lit(".")), 1).otherwise(0)


def pad_code(code: Column, width: int = 2) -> Column:
    bare = F.trim(code)
    return F.when(F.length(bare) >= width, bare).otherwise(F.lpad(bare, width, "0"))


def by_number(code: str) -> list[Column]:
    """Sort keys that put string codes in numeric order; codes that are no number, then NULL, come last."""
    return [F.col(code).isNull(), F.col(code).try_cast("long").asc_nulls_last(), F.col(code)]


def unpad_code(code: Column) -> Column:
    """``01`` to ``1``; codes that are no whole number stay as they are."""
    bare = F.trim(code)
    return F.when(bare.rlike(r"^\d+$"), F.coalesce(bare.try_cast("bigint").cast("string"), bare)).otherwise(bare)


def display_label(key: Column, labels: dict[str, str]) -> Column:
    """Known label, else the key as words with the first letter capitalised."""
    words = F.lower(F.replace(key, F.lit("_"), F.lit(" ")))
    fallback = F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))
    out = None
    for name, text in labels.items():
        out = F.when(key == name, text) if out is None else out.when(key == name, text)
    return fallback if out is None else out.otherwise(fallback)


def compose_label(code: Column, name: Column) -> Column:
    """``code · name``; the parts that are NULL are left out."""
    return F.concat_ws(" · ", code, name)


def technical_entry(name: Column) -> Column:
    """Side of a technical accounting entry named in the label, NULL for real ones.

    The phrases are fixed values of the accounting rule on restricted receipts.
    """
    words = F.lower(collapse_spaces(name))
    has = lambda phrase: F.contains(words, F.lit(phrase))
    restricted = has("incassi vincolati") & (
        has("art. 195") | has("art.195") | has("reintegro") | has("utilizzo incassi") | has("destinazione incassi")
    )
    flagged = restricted | has("regolarizzazione cassa vincolata")
    return F.when(flagged, F.when(words.startswith("entrate"), "entrata").otherwise("spesa"))


# Fixed value: a numbered heading in capitals, such as "5.12 DEBITI".
PAGE_HEADING = r"^\s*\d+(?:\.\d+)*\.?\s+[A-ZÀ-Ü][A-ZÀ-Ü ']{3,}"


def page_heading(text: Column) -> Column:
    """First line that is a numbered heading, trimmed; empty when none is."""
    lines = F.split(text, r"\r\n|\r|\n")
    hits = F.filter(lines, lambda line: line.rlike(PAGE_HEADING))
    return F.coalesce(F.trim(F.try_element_at(hits, F.lit(1))), F.lit(""))


def _labels(labels: list[str], no_digit_before: bool) -> str:
    """Pattern of one label; longer ones are tried first, and only where a label's first letter stands."""
    guard = "A-Za-z0-9" if no_digit_before else "A-Za-z"
    first = "".join(sorted({label[0] for label in labels}))
    return rf"(?=[{first}])(?<![{guard}])({'|'.join(sorted(labels, key=len, reverse=True))})"


def value_token_pattern(labels: list[str] = presets.VALUE_LABELS, no_digit_before: bool = True) -> str:
    """Pattern of ``LABEL value`` tokens."""
    return _labels(labels, no_digit_before) + rf"\s*({TOKEN_VALUE})"


# Fixed value: a printed amount that may follow a label.
TOKEN_VALUE = r"-?[\d.]+,\d{2}"


def open_label(text: Column, labels: list[str] = presets.VALUE_LABELS, no_digit_before: bool = True) -> Column:
    """The label that ends a text without its value, empty when none does."""
    end = F.right(F.rtrim(text), F.lit(1))
    found = F.regexp_extract(text, _labels(labels, no_digit_before) + r"\s*$", 1)
    return F.when(end.between("A", "Z") | (end < " "), found).otherwise("")  # most texts end otherwise, and no pattern runs


def leading_value(text: Column) -> Column:
    """The printed amount at the front of a text, empty when there is none."""
    front = F.left(F.ltrim(text), F.lit(1))
    found = F.regexp_extract(text, rf"^\s*({TOKEN_VALUE})", 1)
    return F.when(front.between("-", "9") | (front < " "), found).otherwise("")


def value_of(amount: Column) -> Column:
    """A printed amount as a decimal."""
    return F.translate(amount, ",.", ".").try_cast("decimal(20,2)")


_SPACES = " \t\n\r\f\u000b"


def value_tokens(text: Column, pattern: str) -> Column:
    """``array<struct<label, value>>`` of the tokens in printed order.

    The pattern runs once over the text; a token is letters, then a number, so
    its two parts are told apart by character translation.
    """
    found = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda t: F.struct(
            F.translate(t, f"0123456789.,-{_SPACES}", "").alias("label"),
            value_of(F.translate(t, f"{ascii_letters}{_SPACES}", "")).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<label:string,value:decimal(20,2)>>")
    return F.when(F.contains(text, F.lit(",")), found).otherwise(none)  # every amount has a comma


def printed_tokens(text: Column, pattern: str) -> Column:
    """The same tokens as they are printed, joined by ``|``, which none of them holds."""
    found = F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "|")
    return F.when(F.contains(text, F.lit(",")), found).otherwise("")


def token_labels(tokens: Column) -> Column:
    """Labels of joined tokens; what is left out between two bars counts as one without a label."""
    return F.split(F.translate(tokens, f"0123456789.,-{_SPACES}", ""), r"\|")


def token_values(tokens: Column) -> Column:
    """Amounts of joined tokens as they are printed, at the places of their labels."""
    return F.split(F.translate(tokens, f"{ascii_letters}{_SPACES}", ""), r"\|")


def without_tokens(text: Column, pattern: str) -> Column:
    """What is left of the text once every value token is taken out."""
    return collapse_spaces(F.regexp_replace(text, pattern, " "))
