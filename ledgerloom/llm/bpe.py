"""BPE encoding and decoding through an index of pair occurrences.

The distinct words of a block of texts of one partition lie end to end as
linked symbols. An index maps the rank of every adjacent pair that may merge
to all places where it stands. Ranks are taken in ascending order from a heap:
all places of a rank merge from left to right, and each merge puts the two
pairs it makes into the lists of their ranks. A place whose symbols have
changed meanwhile is passed over. A rank below the one at work (a token that
two merges make) is taken at once and the rest of the list afterwards, so the
order is that of merging each word alone, lowest rank first, leftmost first.

A word's ids are remembered in a bounded memory, so a repeated word is merged
once per worker. Normalizing and cutting words out of a piece of text are left
to the vocabulary's own normalizer and pre-tokenizer; strings of added tokens
are cut out of the raw text first and carry their own ids.

Inputs: null and empty texts have no ids and decode to an empty text. Null ids
in an array are passed over. Repeated rows and other columns stay as they are.
An empty table gives no rows. Texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, query, table
from ledgerloom.llm.tokens import PIECE, SOLID, lower_latin, vocabulary_path

BLOCK_CHARACTERS = 4_000_000  # texts whose new words share one index


class PairIndex:
    """Merges many words at once; ``merge(words)`` takes lists of symbol ids and returns lists of ids."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        """``merges`` are (left, right, made) in the order of their ranks."""
        self.merges = merges
        self.ranks = {left << 32 | right: rank for rank, (left, right, _) in enumerate(merges)}

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        symbols: list[int] = []
        starts = []
        for word in words:
            starts.append(len(symbols))
            symbols += word
            symbols.append(-1)  # ends a word; it is in no pair
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        merges, rank_of, places = self.merges, self.ranks.get, defaultdict(list)
        for at, (left, right) in enumerate(pairwise(symbols)):
            if right >= 0 and (rank := rank_of(left << 32 | right)) is not None:
                places[rank].append(at)
        heap = list(places)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            todo = sorted(places.pop(rank))
            left, right, made = merges[rank]
            for k, at in enumerate(todo):
                then = after[at]
                if symbols[at] != left or symbols[then] != right:
                    continue
                symbols[at], symbols[then] = made, -2  # a merged-away place is in no pair
                after[at] = end = after[then]
                before[end] = at
                lower = False
                found = symbols[end]
                if found >= 0 and (new := rank_of(made << 32 | found)) is not None:
                    if new not in places:
                        heapq.heappush(heap, new)
                    places[new].append(at)
                    lower = new < rank
                first = before[at]
                found = symbols[first] if first >= 0 else -1
                if found >= 0 and (new := rank_of(found << 32 | made)) is not None:
                    if new not in places:
                        heapq.heappush(heap, new)
                    places[new].append(first)
                    lower |= new < rank
                if lower:
                    if rank not in places:
                        heapq.heappush(heap, rank)
                    places[rank] += todo[k + 1 :]
                    break
        out = []
        for at in starts:
            ids = []
            while symbols[at] != -1:
                ids.append(symbols[at])
                at = after[at]
            out.append(ids)
        return out


class BpeCoder:
    """One vocabulary file, opened once per Python worker; ``keep`` bounds the pieces it remembers."""

    open: dict[str, BpeCoder] = {}

    @classmethod
    def of(cls, path: str) -> BpeCoder:
        if path not in cls.open:
            cls.open[path] = cls(path)
        return cls.open[path]

    def __init__(self, path: str, keep: int = 800_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, plain = spec["model"], Tokenizer.from_file(path)
        self.normalize = plain.normalizer.normalize_str if plain.normalizer else str
        self.cut = plain.pre_tokenizer.pre_tokenize_str
        self.solid = not plain.encode(" ", add_special_tokens=False).ids  # white space has no ids
        self.pieces = (SOLID if self.solid else PIECE).findall
        self.fold = lower_latin if self.normalize("A\xc9") == "a\xe9" else str
        self.decoder = plain.decoder
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = self.vocab
        self.index = PairIndex([(ids[a], ids[b], ids[a + b]) for a, b in merges])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        names = {i: t for t, i in (*self.vocab.items(), *self.added.items())}
        self.names = pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())
        self.keep, self.known = keep, {}

    def symbols(self, word: str) -> list[int]:
        """The ids of a word's characters; the last one carries the suffix of word ends."""
        parts = [*word[:-1], word[-1] + self.suffix]
        return [self.vocab[p] for p in parts if p in self.vocab]

    def words(self, pieces: list[str]) -> list[list[str]]:
        """The words of each piece; pieces without white space are normalized and cut many in one call."""
        if not self.solid:
            return [[w for w, _ in self.cut(self.normalize(p)) if w] for p in pieces]
        joined = self.normalize(" ".join(pieces))
        lengths = [len(p) + 1 for p in joined.split(" ")]
        if len(lengths) != len(pieces):  # a normalizer made or took a space: one by one
            return [[w for w, _ in self.cut(self.normalize(p)) if w] for p in pieces]
        ends = list(accumulate(lengths))
        out: list[list[str]] = [[] for _ in pieces]
        for word, (start, _) in self.cut(joined):
            out[bisect_right(ends, start)].append(word)
        return out

    def learn(self, pieces: list[str]) -> None:
        """Merge the words of pieces not met before, all through one index."""
        cut = [ws for k in range(0, len(pieces), 1024) for ws in self.words(pieces[k : k + 1024])]
        words = list({w for ws in cut for w in ws})
        merged = self.index.merge([self.symbols(w) for w in words])
        ids = {w: array("i", m).tobytes() for w, m in zip(words, merged, strict=True)}
        for piece, ws in zip(pieces, cut, strict=True):
            self.known[piece] = b"".join([ids[w] for w in ws])

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and (not block or size < BLOCK_CHARACTERS):
                text = texts[at] or ""
                block.append(self.marks(text) if self.marks else [text])  # every second part is an added token
                size += len(text)
                at += 1
            if len(self.known) > self.keep:
                for piece in list(islice(reversed(self.known), self.keep // 2)):  # frequent pieces are met early
                    del self.known[piece]
            known = self.known
            pieces = [[self.pieces(self.fold(part)) for part in parts[::2]] for parts in block]
            fresh = {p for parts in pieces for part in parts for p in part if p not in known}
            if fresh:
                self.learn(list(fresh))
            for parts, cut in zip(block, pieces, strict=True):
                out = []
                for k, part in enumerate(cut):
                    out += map(known.__getitem__, part)
                    if 2 * k + 1 < len(parts):
                        out.append(array("i", [self.added[parts[2 * k + 1]]]).tobytes())
                yield b"".join(out)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The tokens of each list of ids, special ones included, joined by the vocabulary's decoder; by spaces where it has none."""
        ids = lists.flatten()
        known = pc.fill_null(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(self.names))), False)
        names = self.names.take(pc.if_else(known, ids, None))
        if names.null_count or lists.null_count:  # rows are counted anew without what names no token
            held = np.concatenate([[0], np.cumsum(names.is_valid().to_numpy(zero_copy_only=False))])
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            offsets, names = held[np.concatenate([[0], ends])], names.drop_null()
        else:
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names)
        return pa.array([self.decoder.decode(t) for t in tokens.to_pylist()], pa.string()) if self.decoder else pc.binary_join(tokens, " ")


def _with(df: DataFrame, column: str, kind: pa.DataType, ddl: str, source: str, work) -> DataFrame:
    """``df`` with a column made from ``source`` in Arrow batches of some hundred rows."""
    if column in df.columns:
        raise ValueError(f"the table has a column {column!r}; give another name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                made = work(some.column(source))
                yield pa.RecordBatch.from_arrays([*some.columns, made], names=[*some.schema.names, column])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return map_batches(df, run, f"{fields}, `{column}` {ddl}")


def encode_documents(docs: DataFrame, vocabulary: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the ids of each text as ``array<int>``."""

    def work(texts: pa.Array) -> pa.Array:
        blobs = list(BpeCoder.of(vocabulary).encode(texts.to_pylist()))
        offsets = [0]
        for b in blobs:
            offsets.append(offsets[-1] + len(b) // 4)
        values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(blobs))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return _with(docs, ids, pa.list_(pa.int32()), "array<int>", text, work)


def decode_documents(rows: DataFrame, vocabulary: str, decoded: str = "decoded", ids: str = "ids") -> DataFrame:
    """All columns of ``rows`` and the text that the ids stand for; a null array stands for an empty text."""

    def work(lists: pa.Array) -> pa.Array:
        return BpeCoder.of(vocabulary).decode(lists)

    return _with(rows, decoded, pa.string(), "string", ids, work)


@query("op11_bpe")
def op11_bpe(spark, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    path = vocabulary_path("word_bpe_49k.json")
    coded = decode_documents(encode_documents(table(spark, folder, "documents", "doc_id", "text"), path), path)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
