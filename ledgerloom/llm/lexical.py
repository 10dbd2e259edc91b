"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents become index shards of a bounded number of words: per term the
documents that hold it and how often. An item asks a shard through one impact
list per term, highest impact first. Sorted access goes down all lists in
rounds; every new document gets its whole score by direct access to all lists,
which also marks its position in each. The best position of a list ends its
unbroken run of seen positions; whatever is unseen lies behind it in every
list, so the impacts there bound all unseen scores. A shard stops when that
bound is strictly below the k-th score that the shard, or an earlier shard of
the task, has reached. Ties at the k-th score are therefore all seen.

Items travel to the shards as rows and stream past the one that is open; each
shard hands on at most k rows an item. Document frequencies come from the
shards' dictionaries, joined to the terms asked for.

Inputs: a null text has no terms; a document without terms counts nowhere and
is in no result. Null ids of documents are allowed and come last among ties;
rows that share an id are documents of their own. Rows of items that share an
id (null too) are one item with the terms of all. Items without a known term
have no rows. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, materialize, query, table

SHARD_WORDS = 2_000_000
SHARD_DOCS = 60_000  # so that a document's place in its shard fits 16 bits
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of a term stand for themselves, A-Z in lower case; all others part terms.
TERM_BYTES = bytes(b if 0x30 <= b <= 0x39 or b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SHARD = "part int, seq int, n_docs long, n_words long, doc_ids array<long>, lengths binary, terms binary, ends binary, docs binary, counts binary"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, as UTF-8."""
    return text.encode().translate(TERM_BYTES).split() if text else []


def index_documents(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index shards of ``docs`` (doc_id, text); a shard ends after ``shard_words`` words (a document is never cut)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids, lengths, distinct, terms, counts = [], [], [], [], []
        vocabulary = defaultdict(count().__next__)

        def flush() -> pa.RecordBatch:
            nonlocal vocabulary, seq
            term = np.concatenate(terms)
            order = np.argsort(term, kind="stable")
            in_doc = np.repeat(np.arange(len(ids), dtype="<u2"), distinct)[order]
            often = np.concatenate(counts)[order].astype("<u4")
            row = [
                part, seq, sum(n > 0 for n in lengths), sum(lengths), list(ids), np.array(lengths, "<i8").tobytes(), b" ".join(vocabulary),
                np.cumsum(np.bincount(term, minlength=len(vocabulary))).astype("<i8").tobytes(), in_doc.tobytes(), often.tobytes(),
            ]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
            out = pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in SHARD.split(", ")])
            vocabulary, seq = defaultdict(count().__next__), seq + 1
            for held in (ids, lengths, distinct, terms, counts):
                held.clear()
            return out

        words = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                for doc, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                    found = terms_of(text)
                    tally = Counter(found)
                    ids.append(doc)
                    lengths.append(len(found))
                    distinct.append(len(tally))
                    terms.append(np.fromiter(map(vocabulary.__getitem__, tally), np.int64, len(tally)))
                    counts.append(np.fromiter(tally.values(), np.int64, len(tally)))
                    words += len(found)
                    if words >= shard_words or len(ids) >= SHARD_DOCS:
                        yield flush()
                        words = 0
        if ids:
            yield flush()

    return materialize(map_batches(docs.select("doc_id", "text"), build, SHARD), "lexical-index")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): each item's distinct terms."""
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(F.array_distinct(found)).alias("term")).distinct()


def document_frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df) for the asked terms that occur: the shards' dictionary rows joined to them and summed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                blob, ends = (batch.column(c)[k].as_py() for c in ("terms", "ends"))
                names = blob.decode().split(" ") if blob else []
                df = np.diff(np.frombuffer(ends, "<i8"), prepend=0)
                for start in range(0, len(names), 50_000):
                    part = slice(start, start + 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(names[part], pa.string()), pa.array(df[part])], names=["term", "df"])

    held = map_batches(index.select("terms", "ends"), rows, "term string, df long")
    return held.join(terms.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))


class ImpactList:
    """One term in one shard: documents by number for direct access, and by falling impact for sorted access."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray):
        self.docs, self.impacts = docs, impacts
        order = np.argsort(-impacts, kind="stable")
        self.sorted_docs, self.sorted_impacts = docs[order], impacts[order]
        self.places = np.empty(len(docs), np.int64)
        self.places[order] = np.arange(len(docs))

    def __len__(self) -> int:
        return len(self.docs)


class Shard:
    """An opened index shard; impact lists are made when first asked for."""

    def __init__(self, row: dict, n: int, total: int):
        self.doc_ids = row["doc_ids"]
        lengths = np.frombuffer(row["lengths"], "<i8")
        wide = lengths if 50 * n * int(lengths.max(initial=0)) < 1 << 62 else lengths.astype(object)
        self.m = (50 + 50 * wide * n // max(total, 1)).astype(np.int64)
        self.number = {t: k for k, t in enumerate(row["terms"].split(b" "))} if row["terms"] else {}
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.docs, self.counts = np.frombuffer(row["docs"], "<u2"), np.frombuffer(row["counts"], "<u4")
        self.lists: dict[int, ImpactList] = {}

    def impact_list(self, term: bytes) -> ImpactList | None:
        k = self.number.get(term)
        if k is None:
            return None
        if k not in self.lists:
            part = slice(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))
            docs, tf = self.docs[part].astype(np.int64), self.counts[part].astype(np.int64)
            self.lists[k] = ImpactList(docs, 1_000_000_000 * tf // (1000 * tf + 20 * self.m[docs]))
        return self.lists[k]

    def best(self, terms: list[bytes], weights: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers and scores of the shard's ``k`` best documents of at least ``floor``, and the k-th score (``floor``, if fewer)."""
        lists = [(w, one) for t, w in zip(terms, weights, strict=True) if w > 0 and (one := self.impact_list(t)) is not None]
        scores = np.zeros(len(self.doc_ids), np.int64)
        seen = np.zeros(len(self.doc_ids), bool)
        marks = [np.zeros(len(one), bool) for _, one in lists]
        best = [0] * len(lists)  # the first position of each list that is not seen
        depth, step, top = 0, 2 * k, np.zeros(0, np.int64)
        while True:
            met = [one.sorted_docs[depth : depth + step] for _, one in lists if depth < len(one)]
            if not met:
                break
            fresh = np.zeros(len(seen), bool)
            for docs in met:
                fresh[docs] = True
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            bound = 0
            for at, ((w, one), mark) in enumerate(zip(lists, marks, strict=True)):
                where = np.searchsorted(one.docs, fresh)
                where[where == len(one)] = 0
                held = one.docs[where] == fresh
                where = where[held]
                scores[fresh[held]] += w * one.impacts[where]
                mark[one.places[where]] = True
                if best[at] < len(one):
                    gap = int(np.argmin(mark[best[at] :]))
                    best[at] = len(one) if mark[best[at] + gap] else best[at] + gap
                    if best[at] < len(one):
                        bound += w * int(one.sorted_impacts[best[at]])
            top = np.concatenate([top, scores[fresh]])
            if len(top) > k:
                top = np.partition(top, len(top) - k)[-k:]
            if len(top) == k:
                floor = max(floor, int(top.min()))
            if bound < floor:
                break
            depth, step = depth + step, step + step // 2
        found = np.flatnonzero(scores >= max(floor, 1))
        return found, scores[found], floor


def search(index: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of highest score above 0."""
    schema = "item_id long, doc_id long, score long"
    totals = index.agg(F.count(F.lit(1)), F.sum("n_docs"), F.sum("n_words")).first()
    shards, n, total = (int(v or 0) for v in totals)
    asked = materialize(item_terms(items), "item-terms")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = asked.join(document_frequencies(index, asked).withColumn("w", weight), "term")
    packed = weighed.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("asked"))
    packed = packed.select("item_id", F.col("asked.term").alias("item_terms"), F.col("asked.w").alias("weights"))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = index.groupBy("part").agg(F.count(F.lit(1)).alias("held")).select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    numbered = index.join(firsts, "part").withColumn("shard", F.col("first") + F.col("seq"))
    held = ["doc_ids", "lengths", "terms", "ends", "docs", "counts"]
    places = max(1, min(shards, max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards // 32)))
    every = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1).cast("long"))))
    rows = numbered.select("shard", F.lit(0).alias("kind"), *held).unionByName(every.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    rows = rows.repartitionById(places, F.pmod("shard", F.lit(places)).cast("int")).sortWithinPartitions("shard", "kind")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, floors = None, {}
        for batch in batches:
            out: list[list] = [[], [], []]
            kinds = batch.column("kind").to_numpy()
            for at, kind in enumerate(kinds):
                if kind == 0:
                    shard = Shard({c: batch.column(c)[at].as_py() for c in held}, n, total)
                    continue
                item, terms, weights = (batch.column(c)[at].as_py() for c in ("item_id", "item_terms", "weights"))
                found, scores, floors[item] = shard.best([t.encode() for t in terms], weights, k, floors.get(item, 0))
                ids = [shard.doc_ids[d] for d in found]
                order = sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j] is None, ids[j] or 0))[:k]
                out[0] += [item] * len(order)
                out[1] += [ids[j] for j in order]
                out[2] += [int(scores[j]) for j in order]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["item_id", "doc_id", "score"])

    local = map_batches(rows, ask, schema)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
tot AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
w AS (SELECT item_id, term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM q JOIN df USING (term), tot),
s AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))))::BIGINT AS score
  FROM w JOIN tf USING (term) JOIN len USING (r), tot GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query("op12_lexical_search", SQL)
def op12_lexical_search(spark, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    index = index_documents(table(spark, folder, "documents", "doc_id", "text"))
    return search(index, table(spark, folder, "benchmark", "item_id", "text"))
