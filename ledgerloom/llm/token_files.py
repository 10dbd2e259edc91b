"""Token-id files with Elias-Fano document boundaries.

Documents in ascending ``doc_id`` order become segments of a bounded number of
ids. A segment is one row of a Parquet table: the concatenated ids as a blob
in the narrowest unsigned type, and the document ends as an Elias-Fano
sequence. With ``n`` ends up to ``u``, each end keeps ``l = floor(log2(u / n))``
low bits in a packed array; the high parts are a unary bit vector in which
end ``i`` is the set bit at ``(end >> l) + i``. ``select(i)``, the position of
the i-th set bit, starts from a sample every ``SAMPLE`` set bits, so an
offset costs about ``2 + log2(u / n)`` bits a document and no 64-bit table.

Inputs: null texts are empty (one id, the end id). Null ids come last.
Repeated ids keep one row each. Other columns are ignored. An empty table
gives no segment and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, query, table
from ledgerloom.llm.tokens import PieceEncoder, ids_crc32, vocabulary_path
from ledgerloom.session import scratch_path

SAMPLE = 64
SEGMENT = (
    "part int, seq int, first_id long, n_docs long, n_ids long, id_bytes int, doc_ids array<long>, ids binary, "
    "low_bits int, low binary, high binary, high_samples binary"
)


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits each, one after another, lowest bit first."""
    if not width or not len(values):
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(blob: bytes, width: int, at: np.ndarray) -> np.ndarray:
    """The values at the given places of what ``pack_bits`` made."""
    if not width:
        return np.zeros(len(at), np.uint64)
    data = np.frombuffer(blob, np.uint8)
    bit = at.astype(np.int64)[:, None] * width + np.arange(width)
    ones = (data[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
    return (ones.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class EliasFano:
    """A non-decreasing sequence of integers in about 2 + log2(u / n) bits each."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low = n, low_bits, low
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def encode(cls, ends: np.ndarray) -> EliasFano:
        ends = np.asarray(ends, np.uint64)
        n = len(ends)
        if not n:
            return cls(0, 0, b"", b"", b"")
        width = max(0, int(int(ends[-1]) // n).bit_length() - 1)
        places = (ends >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places.astype(np.int64)] = 1
        low = pack_bits(ends & np.uint64((1 << width) - 1), width)
        return cls(n, width, low, np.packbits(bits, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The position of set bit ``i``, from the sample before it."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def get(self, i: int) -> int:
        """Value ``i`` alone."""
        return (self.select(i) - i) << self.low_bits | int(unpack_bits(self.low, self.low_bits, np.array([i]))[0])

    def all(self) -> np.ndarray:
        """Every value: all set bits at once."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n].astype(np.uint64)
        high = (places - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.low_bits)
        return (high | unpack_bits(self.low, self.low_bits, np.arange(self.n))).astype(np.int64)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, segment_ids: int = 2_000_000, parts: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write segments in ascending id order to ``path``.

    ``segment_ids`` bounds a segment (a document is never cut, so one longer
    document makes a segment of its own).
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = PieceEncoder.of(vocabulary)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list[int | None] = []
        ends: list[int] = []
        end = np.array([end_id], encoder.dtype).tobytes()

        def flush() -> pa.RecordBatch:
            e = EliasFano.encode(np.array(ends))
            row = (part, seq, names[0], len(names), ends[-1], encoder.dtype.itemsize, list(names), b"".join(ids), e.low_bits, e.low, e.high.tobytes(), e.samples.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types, strict=True)], names=[c.split()[0] for c in SEGMENT.split(", ")]
            )

        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                for doc, got in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text").to_pylist()), strict=True):
                    if names and ends[-1] + len(got) + 1 > segment_ids:
                        yield flush()
                        seq += 1
                        ids.clear(), names.clear(), ends.clear()
                    ids += [got.tobytes(), end]
                    names.append(doc)
                    ends.append((ends[-1] if ends else 0) + len(got) + 1)
        if names:
            yield flush()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranged = docs.select("doc_id", "text")
    ranged = ranged.repartitionByRange(parts, *order) if parts else ranged.repartitionByRange(*order)
    map_batches(ranged.sortWithinPartitions(*order), segments, SEGMENT).write.option("compression", "zstd").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """The segments of ``path`` with ``start``, the ids of all segments before each.

    Partitions hold ascending id ranges, so totals per partition and then
    totals within a partition give the starts; no window sees all segments.
    """
    files = spark.read.parquet(path)
    sizes = files.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_in", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part")
    starts = starts.select("part", "seq", (F.col("part_start") + F.col("_in")).alias("start"))
    return files.join(starts, ["part", "seq"])


def document_ids(segments: DataFrame) -> DataFrame:
    """Per document of read segments: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                ids = np.frombuffer(row["ids"].as_py(), f"<u{row['id_bytes'].as_py()}")
                code = EliasFano(*(row[c].as_py() for c in ("n_docs", "low_bits", "low", "high", "high_samples")))
                ends = code.all()
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                crcs = [ids_crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                arrays = [row["doc_ids"].values, pa.array(begins + row["start"].as_py()), pa.array(ends - begins), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(segments, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op5_token_files")
def op5_token_files(spark, folder: str) -> DataFrame:
    """Encode, write, read back: one row per document of ``documents``."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents", "doc_id", "text"), path, vocabulary_path("byte_bpe_50k.json"))
    return document_ids(read_token_files(spark, path))
