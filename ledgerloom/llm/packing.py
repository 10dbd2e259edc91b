"""Packing by cutting-stock column generation.

A document's ids are cut into pieces of the sequence length and one rest; a
piece's class is its length rounded up to the grid. The class counts are the
demand of a cutting-stock program: patterns (how many pieces of each class
lie in one sequence) are the columns, a revised simplex over the classes
gives dual prices, and an unbounded knapsack by dynamic programming finds the
pattern of the greatest price until none is worth more than one sequence.
Pattern counts are rounded down, and what is left (fewer pieces than a few
sequences for each class) is packed first-fit decreasing. Pieces get a rank
within their class; pattern by pattern the ranks are dealt to sequences.

The program sees the class counts alone: at most ``length / grid`` numbers
reach the driver, whatever the table. Ranks are numbered in buckets, so a
class with most pieces is many tasks.

Inputs: a null text is empty and gives one piece with the end id; null and
repeated ids are kept as rows of their own (repeated rows with equal texts
are alike, so either numbering of them is the same); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, materialize, query, ranked_in_buckets, table
from ledgerloom.llm.tokens import PieceEncoder, ids_crc32, vocabulary_path

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_documents(docs: DataFrame, vocabulary: str, length: int = 4096, end_id: int = 2) -> DataFrame:
    """The pieces of every document: full sequences, then the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(vocabulary)
        end = np.array([end_id], encoder.dtype)
        for batch in batches:
            rows = []
            for doc, got in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), strict=True):
                ids = np.concatenate([got, end])
                rows += [(doc, k, len(ids[k : k + length]), ids_crc32(ids[k : k + length]), len(ids)) for k in range(0, len(ids), length)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECES.split(", ")])

    return map_batches(docs.select("doc_id", "text"), cut, PIECES)


def best_pattern(prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of classes 1..m within ``room`` of the greatest total price."""
    m = len(prices)
    best, took = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for w in range(1, room + 1):
        values = best[w - np.arange(1, min(m, w) + 1)] + prices[: min(m, w)]
        k = int(values.argmax())
        best[w], took[w] = (values[k], k + 1) if values[k] > best[w - 1] + 1e-12 else (best[w - 1], 0)
    pattern, w = np.zeros(m, np.int64), room
    while w > 0:
        if took[w]:
            pattern[took[w] - 1] += 1
        w -= took[w] or 1
    return float(best[room]), pattern


def solve_patterns(demand: np.ndarray, room: int, gap: float = 1e-3, rounds: int = 5000) -> list[tuple[np.ndarray, float]]:
    """The linear program over patterns for counts of classes 1..len(demand).

    Revised simplex with columns from ``best_pattern``; it ends when the best
    column is worth at most ``1 + gap`` sequences, so the result is within
    that factor of the optimum.
    """
    used = np.flatnonzero(demand)
    m = len(used)
    if not m:
        return []
    columns = np.zeros((m, m))
    columns[np.arange(m), np.arange(m)] = room // (used + 1)
    inverse = np.diag(1.0 / np.diag(columns))
    cost = np.ones(m)
    x = inverse @ demand[used]
    for _ in range(rounds):
        duals = cost @ inverse
        if (low := duals.min()) < -1e-9:  # covering a class more than once
            entering, value = np.zeros(m), 0.0
            entering[duals.argmin()] = -1.0
        else:
            prices = np.zeros(len(demand))
            prices[used] = np.maximum(duals, 0)
            worth, pattern = best_pattern(prices, room)
            if worth <= 1 + gap:
                break
            entering, value = pattern[used].astype(float), 1.0
        step = inverse @ entering
        ratios = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        x = np.maximum(x - ratios[out] * step, 0)
        x[out] = ratios[out]
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        columns[:, out], cost[out] = entering, value
    result = []
    for k in range(m):
        if cost[k] and x[k] > 1e-9:
            pattern = np.zeros(len(demand), np.int64)
            pattern[used] = np.rint(columns[:, k]).astype(np.int64)
            result.append((pattern, float(x[k])))
    return result


def whole_patterns(demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole counts that hold every piece of ``demand`` exactly once."""
    left = demand.astype(np.int64).copy()
    whole: list[tuple[np.ndarray, int]] = []
    for pattern, x in sorted(solve_patterns(demand.astype(float), room), key=lambda p: -p[1]):
        fits = [left[c] // pattern[c] for c in np.flatnonzero(pattern)]
        if n := int(min([int(x + 1e-6), *fits])):
            whole.append((pattern, n))
            left -= pattern * n
    while left.any():  # first fit decreasing, as many times as the pattern repeats
        pattern, free = np.zeros(len(left), np.int64), room
        for c in np.flatnonzero(left)[::-1]:
            pattern[c] = min(left[c], free // (c + 1))
            free -= pattern[c] * (c + 1)
        n = int(min(left[c] // pattern[c] for c in np.flatnonzero(pattern)))
        whole.append((pattern, n))
        left -= pattern * n
    return whole


def pack_pieces(pieces: DataFrame, length: int = 4096, grid: int = 16) -> DataFrame:
    """Add sequence_id and offset to stored pieces (columns as ``cut_documents`` gives them)."""
    spark = pieces.sparkSession
    classed = pieces.withColumn("class", F.ceil(F.col("length") / grid).cast("int"))
    counts = {r["class"]: r["count"] for r in classed.groupBy("class").count().collect()}  # at most length / grid rows
    room = length // grid
    demand = np.array([counts.get(c, 0) for c in range(1, room + 1)], np.int64)
    taken, first, deals = np.zeros(room, np.int64), 0, []
    for pattern, n in whole_patterns(demand, room):
        for c in np.flatnonzero(pattern):
            deals.append((int(c) + 1, int(taken[c]), int(taken[c] + n * pattern[c]), first, int(pattern[c])))
        taken += n * pattern
        first += n
    dealt = spark.createDataFrame(deals, "_class int, lo long, hi long, first long, each long")
    ranked = ranked_in_buckets(classed, ["class"], ["doc_id", "start", "ids_crc32"], sum(counts.values()), "rank")
    inside = (F.col("class") == F.col("_class")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    # the deals are bounded by the classes and patterns, not by the pieces
    placed = ranked.join(F.broadcast(dealt), inside)
    placed = placed.withColumn("sequence_id", F.col("first") + F.expr("(rank - lo) div each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select(*[c for c in pieces.columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str, length: int = 4096, end_id: int = 2) -> DataFrame:
    """Cut, count and pack whole documents; one row per piece."""
    return pack_pieces(materialize(cut_documents(docs, vocabulary, length, end_id), "pieces"), length)


@query("op7_packing")
def op7_packing(spark, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents", "doc_id", "text"), vocabulary_path("word_bpe_49k.json"))
