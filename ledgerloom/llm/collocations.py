"""Phrase collocations through weighted acyclic automata.

Every place of a text gives one n-gram: its word and the next words of the
piece, four at most. A shard (a bounded number of words) sorts its n-grams and
builds an automaton from them one by one: states that no later n-gram can
reach are looked up in a register and shared, and the weight of a state is the
number of n-grams that end there. An automaton is cut at prefix bounds that
all shards have in common; the parts of one prefix range meet in one task,
where equal paths are united and their weights summed. The count of a phrase
is then the weight of all paths that begin with it. Prefixes that a bound cuts
through are handed on by both ranges and summed afterwards.

Phrases that occur often enough are automata again, one per prefix range, with
their counts as weights. The parts of all candidates are sorted and composed
with the automaton of their range; hot ranges are dealt to several tasks.

Bounds come from a bounded sample of places and steer only the load. A range
holds about ``RANGE_WORDS`` places; beyond ``MOST_RANGES`` ranges it grows.

Inputs: a null text is empty, a null language is ``und``. Rows count as often
as they stand in the table, whatever their other columns hold. An empty table
and texts without words give no rows. Texts of any length are read whole.
"""

from __future__ import annotations

import gc
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, materialize, query, table

LONGEST = 4
SHARD_WORDS = 2_000_000
RANGE_WORDS = 1_000_000
MOST_RANGES = 1 << 18
SAMPLE_DOCS, SAMPLE_PLACES = 4096, 256  # documents drawn for bounds, places drawn from each
PHRASES_PER_RANGE = 200_000
SALTS = 8
# Bytes in lower case; those that end a piece become line feeds.
FOLD = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def pieces_of(text: str | None) -> list[list[bytes]]:
    """The words of each piece of a whole text, as UTF-8; pieces without words are left out."""
    return [words for piece in text.encode().translate(FOLD).split(b"\n") if (words := piece.split())] if text else []


def narrow(values: np.ndarray) -> tuple[str, bytes]:
    """Unsigned numbers in the smallest type that holds them."""
    kind = np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<")
    return kind.str, values.astype(kind).tobytes()


class CountAutomaton:
    """A weighted acyclic automaton over word numbers (from 1).

    ``sizes`` holds the numbers per state and ``flat`` all states one after
    another: the weight of paths ending there, then label and target of each
    arc. A target stands before the states that point at it; the last state is
    the root. ``words`` are in ascending order of their bytes.
    """

    BLOB = "words binary, size_kind string, sizes binary, flat_kind string, flat binary"

    def __init__(self, words: list[bytes], sizes: np.ndarray, flat: np.ndarray):
        self.words, self.sizes, self.flat = words, sizes, flat
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def from_sorted(cls, words: list[bytes], paths: np.ndarray, weights: np.ndarray) -> CountAutomaton:
        """From distinct paths (rows, ended by zeros) in ascending order and their weights, one path at a time."""
        collecting = gc.isenabled()
        gc.disable()  # the register holds no cycles, and it is large
        try:
            return cls(words, *cls._registered(paths, weights))
        finally:
            if collecting:
                gc.enable()

    @staticmethod
    def _registered(paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``sizes`` and ``flat`` of the registered states."""
        width = paths.shape[1]
        shared = np.argmax(paths[1:] != paths[:-1], axis=1).tolist()
        lengths = np.count_nonzero(paths, axis=1).tolist()
        register: dict[tuple[int, ...], int] = {}
        known = register.setdefault
        arcs: list[list[int]] = [[0] for _ in range(width)]  # of the state after each word of the path at work
        last, held = (), 0
        for path, length, weight, common in zip(paths.tolist(), lengths, weights.tolist(), [0, *shared], strict=True):
            while held > common:  # no later path comes through these states
                done = tuple(arcs[held])
                arcs[held] = [0]
                held -= 1
                arcs[held] += (last[held], known(done, len(register)))
            if length == width:  # nothing follows a longest path, so its end is known at once
                held = width - 1
                arcs[held] += (path[held], known((weight,), len(register)))
            else:
                arcs[length][0] = weight
                held = length
            last = path
        while held:
            done = tuple(arcs[held])
            held -= 1
            arcs[held] += (last[held], known(done, len(register)))
        states = [*register, tuple(arcs[0])]
        sizes = np.fromiter(map(len, states), np.int64, len(states))
        return sizes, np.fromiter(chain.from_iterable(states), np.int64, int(sizes.sum()))

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All paths (rows ended by zeros) and their weights, level by level."""
        states, rows = np.array([len(self.sizes) - 1]), np.zeros((1, LONGEST), np.int64)
        found = []
        for depth in range(LONGEST + 1):
            weights = self.flat[self.starts[states]]
            ends = weights > 0
            found.append((rows[ends], weights[ends]))
            arcs = (self.sizes[states] - 1) // 2
            if not arcs.sum():
                break
            at = np.repeat(np.arange(len(states)), arcs)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(arcs) - arcs, arcs)
            place = self.starts[states][at] + 1 + 2 * nth
            rows = rows[at]
            rows[:, depth] = self.flat[place]
            states = self.flat[place + 1]
        return np.concatenate([r for r, _ in found]), np.concatenate([w for _, w in found])

    def compose(self, parts: list[bytes]) -> Iterator[int]:
        """The weight of each of the sorted parts (words joined by a space; 0: not held), walking shared prefixes once."""
        number = {w: k for k, w in enumerate(self.words, 1)}
        root, opened = len(self.sizes) - 1, {}

        def arcs(state: int) -> dict[int, int]:
            if state not in opened:
                at = int(self.starts[state])
                own = self.flat[at + 1 : at + int(self.sizes[state])]
                opened[state] = dict(zip(own[::2].tolist(), own[1::2].tolist(), strict=True))
            return opened[state]

        last: list[bytes] = []
        walked: list[int | None] = [root]
        for part in parts:
            words = part.split(b" ")
            same = 0
            while same < min(len(last), len(words)) and last[same] == words[same]:
                same += 1
            del walked[same + 1 :]
            for word in words[same:]:
                state = walked[-1]
                walked.append(None if state is None else arcs(state).get(number.get(word, 0)))
            last = words
            yield 0 if walked[-1] is None else int(self.flat[self.starts[walked[-1]]])

    def blob(self) -> list:
        """The values of the columns ``BLOB``."""
        return [b" ".join(self.words), *narrow(self.sizes), *narrow(self.flat)]

    @classmethod
    def opened(cls, words: bytes, size_kind: str, sizes: bytes, flat_kind: str, flat: bytes) -> CountAutomaton:
        return cls(words.split(b" ") if words else [], np.frombuffer(sizes, size_kind).astype(np.int64), np.frombuffer(flat, flat_kind).astype(np.int64))


BLOB_NAMES = [c.split()[0] for c in CountAutomaton.BLOB.split(", ")]
BLOB_TYPES = [pa.binary(), pa.string(), pa.binary(), pa.string(), pa.binary()]


def sorted_grams(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (rows, ended by zeros) in ascending order and how often each starts, of word numbers with zeros between pieces."""
    padded = np.concatenate([ids, np.zeros(LONGEST, ids.dtype)])
    rows = np.zeros((len(ids), LONGEST), np.int64)
    rows[:, 0] = ids
    for k in range(1, LONGEST):
        rows[:, k] = np.where(rows[:, k - 1] == 0, 0, padded[k : k + len(ids)])
    return united(rows[ids > 0], None)


def united(rows: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows in ascending order, equal ones once with the sum of their weights (null: one each)."""
    high, low = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3]
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(order) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(order))) if weights is None else np.add.reduceat(weights[order], first) if len(first) else first
    return rows[order[first]], sums


def ranked(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words in the order in which they sort before a space, and the number (from 1) of each given word."""
    order = sorted(range(len(words)), key=lambda k: words[k] + b" ")
    numbers = np.empty(len(words), np.int64)
    numbers[order] = np.arange(1, len(words) + 1)
    return [words[k] for k in order], numbers


def local_automaton(words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> CountAutomaton:
    """The automaton of sorted rows that names only the words in use."""
    used = np.unique(rows)
    used = used[used > 0]
    numbers = np.zeros(len(words) + 1, np.int64)
    numbers[used] = np.arange(1, len(used) + 1)
    return CountAutomaton.from_sorted([words[k - 1] for k in used], numbers[rows], weights)


def path_of(words: list[bytes], row: np.ndarray) -> bytes:
    """A row as bytes that sort as rows do."""
    return b"".join([words[k - 1] + b" " for k in row.tolist() if k])


def language() -> Column:
    return F.coalesce("lang", F.lit("und"))


def prefix_bounds(docs: DataFrame, ranges: int, rows: int) -> dict[str, list[bytes]]:
    """Ascending bounds per language that cut the places into about ``ranges`` parts of like size; from a bounded sample."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                pieces = pieces_of(text)
                total = sum(map(len, pieces))
                step = max(32, -(-total // SAMPLE_PLACES))
                found, at, due = [], 0, step // 2
                for piece in pieces:
                    while due < at + len(piece):
                        found.append(b"".join([w + b" " for w in piece[due - at : due - at + LONGEST]]))
                        due += step
                    at += len(piece)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary())], names=["lang", "path"])

    if ranges < 2:
        return {}
    drawn = docs.sample(min(1.0, SAMPLE_DOCS / max(rows, 1)), seed=13)
    sample = sorted((r["lang"], bytes(r["path"])) for r in map_batches(drawn, places, "lang string, path binary").toLocalIterator())
    bounds: dict[str, list[bytes]] = defaultdict(list)
    for k in range(1, ranges):
        if sample:
            lang, path = sample[k * len(sample) // ranges]
            if not bounds[lang] or bounds[lang][-1] != path:
                bounds[lang].append(path)
    return dict(bounds)


def shard_automata(docs: DataFrame, bounds, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, range, blob columns): the automata of all shards, cut at the bounds (a broadcast dictionary)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[dict, list[int]]] = {}
        words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (vocabulary, ids) in held.items():
                names, numbers = ranked(list(vocabulary))
                rows, weights = sorted_grams(np.append(numbers, 0)[np.array(ids, np.int64)])
                ids.clear()
                cuts = [0]
                for bound in bounds.value.get(lang, ()):
                    cuts.append(bisect_left(range(len(rows)), bound, lo=cuts[-1], key=lambda k: path_of(names, rows[k])))  # noqa: B023
                cuts.append(len(rows))
                for at, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if b > a:
                        values = [lang, at, *local_automaton(names, rows[a:b], weights[a:b]).blob()]
                        kinds = [pa.string(), pa.int32(), *BLOB_TYPES]
                        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["lang", "range", *BLOB_NAMES])
            held.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                for lang, text in zip(some.column("lang").to_pylist(), some.column("text").to_pylist(), strict=True):
                    if lang not in held:
                        held[lang] = (defaultdict(count().__next__), [])
                    vocabulary, ids = held[lang]
                    before = len(ids)
                    for piece in pieces_of(text):
                        ids.extend(map(vocabulary.__getitem__, piece))
                        ids.append(-1)
                    words += len(ids) - before
                    if words >= shard_words:
                        yield from flush()
                        words = 0
        yield from flush()

    return map_batches(docs, build, f"lang string, range int, {CountAutomaton.BLOB}")


def phrase_counts(docs: DataFrame, at_least: int, shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS) -> tuple[DataFrame, dict[str, list[bytes]]]:
    """(lang, phrase, words, a) of all phrases of 1 to 4 words that occur ``at_least`` times, stored, and the bounds in use.

    The row of 0 words holds the number of word occurrences of the language.
    """
    docs = docs.select(language().alias("lang"), "text")
    rows, characters = docs.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    ranges = min(MOST_RANGES, -(-int(characters or 0) // (6 * range_words)))
    bounds = prefix_bounds(docs, ranges, rows)
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def unite(key: tuple, group: pa.Table) -> pa.Table:
        automata = [CountAutomaton.opened(*(group.column(c)[k].as_py() for c in BLOB_NAMES)) for k in range(group.num_rows)]
        names, numbers = ranked(list({w for a in automata for w in a.words}))
        number = dict(zip(names, range(1, len(names) + 1), strict=True))
        parts = []
        for one in automata:
            paths, weights = one.paths()
            parts.append((np.array([0, *map(number.__getitem__, one.words)], np.int64)[paths], weights))
        paths, weights = united(np.concatenate([p for p, _ in parts]), np.concatenate([w for _, w in parts]))
        out: list[tuple[str, int, int]] = [("", 0, int(weights.sum()))]
        for length in range(1, LONGEST + 1):
            head = paths[:, :length]
            new = np.concatenate([[True], (head[1:] != head[:-1]).any(axis=1)])
            first = np.flatnonzero(new)
            sums = np.add.reduceat(weights, first)
            full = head[first, -1] > 0
            keep = sums >= at_least
            keep[[0, -1]] = True  # the neighbouring ranges may hold more of these
            for at in np.flatnonzero(keep & full).tolist():
                out.append((path_of(names, head[first[at]])[:-1].decode(), length, int(sums[at])))
        columns = [pa.array([key[0].as_py()] * len(out), pa.string()), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int64()), strict=True))]
        return pa.Table.from_arrays(columns, names=["lang", "phrase", "words", "a"])

    automata = shard_automata(docs, shared, shard_words)
    counted = automata.groupBy("lang", "range").applyInArrow(unite, "lang string, phrase string, words int, a long")
    summed = counted.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter((F.col("a") >= at_least) | (F.col("words") == 0))
    return materialize(summed, "phrases"), bounds


def part_counts(parts: DataFrame, phrases: DataFrame, bounds: dict[str, list[bytes]]) -> DataFrame:
    """``parts`` (lang, part, other columns) with ``f``, the count of the part among ``phrases``, by composing automata of prefix ranges."""
    held = phrases.filter("words > 0")
    ranges = max(1, -(-held.count() // PHRASES_PER_RANGE))
    every = max(1, -(-(sum(map(len, bounds.values())) + 1) // ranges))
    shared = parts.sparkSession.sparkContext.broadcast({lang: some[every - 1 :: every] for lang, some in bounds.items()})
    others = [f for f in parts.schema.fields if f.name not in ("lang", "part")]

    def ranged(df: DataFrame, column: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column("lang").to_pylist(), batch.column(column).to_pylist(), strict=True)
                at = [bisect_right(shared.value.get(lang, ()), part.encode() + b" ") for lang, part in pairs]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "range"])

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        return map_batches(df, run, f"{fields}, range int")

    def build(key: tuple, group: pa.Table) -> pa.Table:
        paths = [p.encode().split(b" ") for p in group.column("phrase").to_pylist()]
        names, _ = ranked(list({w for p in paths for w in p}))
        number = dict(zip(names, range(1, len(names) + 1), strict=True))
        rows = np.zeros((len(paths), LONGEST), np.int64)
        for at, path in enumerate(paths):
            rows[at, : len(path)] = [number[w] for w in path]
        rows, weights = united(rows, group.column("a").to_numpy())
        values = zip([key[0].as_py(), key[1].as_py(), *CountAutomaton.from_sorted(names, rows, weights).blob()], [pa.string(), pa.int32(), *BLOB_TYPES], strict=True)
        return pa.Table.from_arrays([pa.array([v], k) for v, k in values], names=["lang", "range", *BLOB_NAMES])

    automata = ranged(held.select("lang", "phrase", "a"), "phrase").groupBy("lang", "range").applyInArrow(build, f"lang string, range int, {CountAutomaton.BLOB}")
    automata = automata.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("kind", F.lit(0))
    names = [f.name for f in others]
    asked = ranged(parts.select("lang", "part", *names), "part")
    asked = asked.withColumn("salt", F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int")).withColumn("kind", F.lit(1))
    places = ["lang", "range", "salt"]
    rows = automata.unionByName(asked, allowMissingColumns=True).repartition(*places).sortWithinPartitions(*places, "kind", "part")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            opens = np.flatnonzero(kinds == 0).tolist()
            for a, b in zip([0, *opens], [*opens, len(kinds)], strict=True):
                if a < b and kinds[a] == 0:
                    automaton = CountAutomaton.opened(*(batch.column(c)[a].as_py() for c in BLOB_NAMES))
                    a += 1
                some = batch.slice(a, b - a)
                counts = list(automaton.compose([p.encode() for p in some.column("part").to_pylist()])) if some.num_rows else []
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("lang", "part", *names)), pa.array(counts, pa.int64())], names=["lang", "part", *names, "f"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    return map_batches(rows, answer, f"lang string, part string, {fields}, f long")


def collocations(docs: DataFrame, at_least: int = 30, most: int = 2000, cover: int = 80, **sizes: int) -> DataFrame:
    """Each language's ``most`` phrases of highest score: lang, rank, phrase, a, l, r, n, score.

    A phrase goes when a longer one around it occurs at least ``cover`` times
    in a hundred of its own occurrences.
    """
    phrases, bounds = phrase_counts(docs, at_least, **sizes)
    candidates = phrases.filter("words > 1").withColumn("ws", F.split("phrase", " "))
    cut = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice("ws", F.lit(1), k), " ").alias("first"), F.array_join(F.slice("ws", k + 1, F.col("words") - k), " ").alias("rest")),
    )
    cuts = candidates.select("lang", "phrase", "a", F.explode(cut).alias("c"))
    sides = F.explode(F.array(F.struct(F.lit(True).alias("left"), F.col("c.first").alias("part")), F.struct(F.lit(False).alias("left"), F.col("c.rest").alias("part"))))
    parts = cuts.select("lang", "phrase", "a", F.col("c.k").alias("k"), sides.alias("s")).select("lang", "s.part", "phrase", "a", "k", "s.left")
    counted = part_counts(parts, phrases, bounds)
    sides_of = counted.groupBy("lang", "phrase", "a").agg(
        *[F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f"))).alias(f"{'l' if left else 'r'}{k}") for k in range(1, LONGEST) for left in (True, False)]
    )

    def scored(k: int) -> Column:
        score = F.expr(f"cast(a as decimal(19,0)) * 2000000 div (cast(l{k} as decimal(19,0)) + cast(r{k} as decimal(19,0)))")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    worst = sides_of.select("lang", "phrase", "a", F.array_min(F.filter(F.array(*map(scored, range(1, LONGEST))), lambda s: s.isNotNull())).alias("cut"))

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice("ws", at, size), " ")),
        )
    )
    around = candidates.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    hundred = F.col("longer").cast("decimal(19,0)") * 100
    kept = worst.join(around, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (hundred < F.col("a").cast("decimal(19,0)") * cover))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", rank).filter(F.col("rank") <= most)
    totals = phrases.filter("words = 0").select("lang", F.col("a").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, g.n AS words, unnest(list_transform(range(1, len(w) - g.n + 2), lambda i: array_to_string(w[i:i + g.n - 1], ' '))) AS phrase
  FROM ws, (SELECT unnest([1, 2, 3, 4]) AS n) g),
f AS (SELECT lang, words, phrase, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, words, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND a >= 30),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS part1, array_to_string(w[k + 1:], ' ') AS part2
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, f1.a AS l, f2.a AS r, ((2000000::HUGEINT * c.a) // (f1.a + f2.a))::BIGINT AS score
  FROM cuts c JOIN f f1 ON f1.lang = c.lang AND f1.phrase = c.part1 JOIN f f2 ON f2.lang = c.lang AND f2.phrase = c.part2),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a AS longer, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, words - size + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS size FROM cand WHERE words > 2))),
around AS (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (SELECT w.* FROM worst w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""


@query("op13_collocations", SQL)
def op13_collocations(spark, folder: str) -> DataFrame:
    """The 2000 strongest phrases of every language of ``documents``."""
    return collocations(table(spark, folder, "documents", "lang", "text"))
