"""Secret scans with recursive decoding.

A text is the first layer. Every layer is scanned for secrets and for encoded
runs (URL, Unicode and HTML escapes, base64, also base64 broken into lines of
one length; compressed bytes inside base64, with all their members or frames);
each decoded run is a new layer on the worklist until nothing is left. A layer
whose content was seen before at the same place is not taken up again, so
cycles end. A layer keeps for each character the span of the text it came
from; a secret found in it is reported at the span that covers its characters.

Only decoded bytes that are UTF-8 text without control characters make a
layer. One compressed run may unfold to ``limit`` bytes; a run that would go
beyond counts in ``unopened``, so a bomb is reported and does not end the job;
masking stars out such a run as a whole, as nobody knows what it holds.

Inputs: a null text is empty; an empty text has no spans; repeated rows and
null ids are rows of their own; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, query, table

KINDS = ("assign", "access", "hex")
# The secret patterns and the words without which none of the first kind can match.
ASSIGN = re.compile(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so the length can stand in the pattern
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}")
ENTITY = re.compile(r"&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:amp|lt|gt|quot|apos);")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]+={0,2})+")
LINE = re.compile(r"[^\r\n]+")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def find(text: str) -> list[tuple[str, int, int]]:
    """The secrets of one layer: (kind, start, end)."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


class Unopened(Exception):
    """A run that unfolds beyond the limit."""


def inflate(data: bytes, limit: int) -> bytes | None:
    """What gzip, zlib or zstd bytes hold; None for other bytes."""
    try:
        if data[:2] == b"\x1f\x8b" or (len(data) > 1 and data[0] == 0x78 and (data[0] << 8 | data[1]) % 31 == 0):
            whole = b""
            while True:  # a stream may hold several members; what follows the last one is padding
                machine = zlib.decompressobj(47)
                try:
                    part = machine.decompress(data, max(1, limit - len(whole)))
                except zlib.error:
                    return whole or None
                if machine.unconsumed_tail or len(whole) + len(part) > limit:
                    raise Unopened
                if not machine.eof:
                    return whole or None
                whole += part
                data = machine.unused_data
                if data[:2] != b"\x1f\x8b":
                    return whole
        if data[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            out = b""
            with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as reader:
                while len(out) <= limit and (part := reader.read(limit + 1 - len(out))):
                    out += part
            if len(out) > limit:
                raise Unopened
            return out
    except (zlib.error, ValueError, OSError):
        return None
    except Exception as e:  # zstandard has an error type of its own
        if type(e).__name__ == "ZstdError":
            return None
        raise
    return None


def readable(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return None if CONTROL.search(text) else text


def unbase64(run: str, limit: int) -> str | None:
    """The text in a base64 run (either alphabet, padding optional), through compressed layers."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None
    seen = set()
    while (inner := inflate(data, limit)) is not None and inner not in seen:
        seen.add(data)
        data = inner
    return readable(data)


def wrapped(text: str) -> Iterator[tuple[int, list[int]]]:
    """Starts and possible ends of base64 broken into lines: lines of one length, without and with a shorter one behind them."""
    for m in WRAPPED.finditer(text):
        lines = [line.span() for line in LINE.finditer(text, *m.span())]
        k = 0
        while k < len(lines):
            width, j = lines[k][1] - lines[k][0], k + 1
            while j < len(lines) and lines[j][1] - lines[j][0] == width:
                j += 1
            if width >= 16:
                ends = [lines[j - 1][1]] if j > k + 1 else []
                if j < len(lines) and lines[j][1] - lines[j][0] < width:
                    ends.append(lines[j][1])
                if ends:
                    yield lines[k][0], ends
            k = j


def escape(run: str) -> str:
    """The character of one Unicode escape."""
    code = int(run[2:].strip("{}"), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else run


def replaced(text: str, pattern: re.Pattern, decode) -> tuple[str, np.ndarray, np.ndarray] | None:
    """The text with its runs decoded, and the span of every new character; None if nothing changes."""
    out, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(text):
        new = decode(m[0])
        if new is None or new == m[0]:
            continue
        a, b = m.span()
        out += [text[at:a], new]
        starts += [np.arange(at, a), np.full(len(new), a)]
        ends += [np.arange(at, a) + 1, np.full(len(new), b)]
        at = b
    if not out:
        return None
    out.append(text[at:])
    starts.append(np.arange(at, len(text)))
    ends.append(np.arange(at, len(text)) + 1)
    return "".join(out), np.concatenate(starts), np.concatenate(ends)


def unwrapped(text: str, limit: int) -> Iterator[tuple[str | None, np.ndarray, np.ndarray]]:
    """The layers directly inside a layer, with no text for a run that stays unopened."""
    if "%" in text and (layer := replaced(text, URL, lambda r: readable(bytes.fromhex(r.replace("%", ""))))):
        yield layer
    if "\\" in text:
        # surrogate pairs join once all escapes of a run are read
        if layer := replaced(text, UNICODE, escape):
            yield layer
        pairs = re.compile(r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}")
        if pairs.search(text) and (layer := replaced(text, pairs, lambda r: chr(0x10000 + (int(r[2:6], 16) - 0xD800 << 10) + int(r[8:], 16) - 0xDC00))):
            yield layer
    if "&" in text and (layer := replaced(text, ENTITY, html.unescape)):
        yield layer
    runs = [(m.start(), [m.end()]) for m in BASE64.finditer(text)]
    if "\n" in text:
        runs += wrapped(text)
    for a, ends in runs:
        best, span = None, 0
        try:
            for b in ends:
                span = b
                inner = unbase64(text[a:b].replace("\r", "").replace("\n", ""), limit)
                if inner and (best is None or inner != best[0]):  # a longer run counts if it holds more
                    best = inner, b
        except Unopened:
            yield None, np.array([a]), np.array([span])
            continue
        if best:
            yield best[0], np.full(len(best[0]), a), np.full(len(best[0]), best[1])


def scan(text: str | None, limit: int = 1 << 24) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Spans of the text itself, spans of all layers, and how many runs stayed unopened."""
    base, spans, closed = layers(text, limit)
    return base, spans, len(closed)


def layers(text: str | None, limit: int = 1 << 24) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], list[tuple[int, int]]]:
    """Spans of the text itself, spans of all layers, and the spans of runs that stayed unopened."""
    text = text or ""
    base = find(text)
    spans, closed = set(base), set()
    work: list[tuple[str, np.ndarray | None, np.ndarray | None]] = [(text, None, None)]
    seen = {(text, 0, len(text))}
    while work:
        layer, starts, ends = work.pop()
        for item in unwrapped(layer, limit):
            inner, a, b = item
            if starts is not None:
                a, b = starts[a], ends[b - 1]
            if inner is None:
                closed.add((int(a[0]), int(b[-1])))
                continue
            if not inner or (key := (inner, int(a[0]), int(b[-1]))) in seen:
                continue
            seen.add(key)
            spans.update((kind, int(a[s]), int(b[e - 1])) for kind, s, e in find(inner))
            work.append((inner, a, b))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(spans, key=order), sorted(closed)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_documents(docs: DataFrame, limit: int = 1 << 24) -> DataFrame:
    """Per document: doc_id, base_spans, spans (kind:start:end in code points, end exclusive), unopened."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [scan(t.as_py(), limit) for t in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array([joined(g[0]) for g in got], pa.string()), pa.array([joined(g[1]) for g in got], pa.string()), pa.array([g[2] for g in got], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base_spans", "spans", "unopened"])

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, base_spans string, spans string, unopened long")


def starred(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the characters of all spans, which may overlap, replaced by ``*``."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            a = max(a, at)
            out += [text[at:a], "*" * (b - a)]
            at = b
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, limit: int = 1 << 24) -> DataFrame:
    """The documents with the characters of every found span and unopened run replaced by ``*``; the other columns stay."""
    columns = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                _, spans, closed = layers(text, limit)
                texts.append(starred(text, [(a, b) for _, a, b in spans] + closed) if spans or closed else text)
            arrays = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(work, docs.schema)


@query("op10_secret_scan")
def op10_secret_scan(spark, folder: str) -> DataFrame:
    found = scan_documents(table(spark, folder, "documents", "doc_id", "text"))

    def count(kind: str):
        return F.regexp_count("base_spans", F.lit(kind + ":")).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans", "unopened")
