"""SimHash near-duplicates by pigeonring filtering.

Fingerprints of 64 bits lie as a ring of four segments of 16 bits. If two
fingerprints differ in at most 3 bits, some start exists from which chains of
1, 2 and 3 consecutive segments differ in at most 0, 1 and 2 bits (their
share of the budget, rounded down). A chain's budget makes it an index: the
first segment agrees, one half of the second agrees, one third of the next
agrees. So each fingerprint is filed under 4 * 2 * 3 masks of about 29 bits;
candidates share a file, pass the chain's cumulative budgets, and then the
full Hamming check.

Equal fingerprints are one node. A file emits a star over each of its linked
sets, never its pairs. A file above ``crowded`` fingerprints is cut again: its
free bits make four parts, one of which agrees within the budget, twice at
most, after which at most 19 bits are free.

``similar_components`` serves near copies of a similarity of 0.8 over
five-word shingles. Their 64-bit fingerprints over shingles lie about 10 bits
apart, beyond any index, but over words, weighed by ``1 + log2(count)``, they
lie 4 bits apart. So a document carries ``FAMILIES`` fingerprints over words,
each of which goes through the pigeonring filter, and one of 256 bits over
its distinct shingles: 0.8 means about 39 differing bits, and sets within
``WIDE_REACH`` bits are candidates. Linked sets of candidates are then checked
against their whole shingle sets: only a Jaccard similarity of 0.8 and more
links. A node is a distinct shingle set, so its shingles travel once for each
candidate set it is in; candidate components up to ``GATHERED`` nodes are one
such set, larger ones keep the sets of their files.

Inputs: null, empty and wordless texts have fingerprint zero and are linked
like any other; fewer words than a shingle make one shingle; repeated rows
are rows of their own; ids may be null (a component's name is the smallest
id that is not); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, materialize, query, table
from ledgerloom.llm.components import components

SEGMENTS, WIDTH, REACH = 4, 16, 3
FAMILIES, WIDE_REACH = 4, 60
GATHERED = 256
WIDE = ("w0", "w1", "w2", "w3")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, A-Z lower-cased, XXH64 per shingle."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def digests(parts: list[bytes]) -> np.ndarray:
    """256 bits for each part."""
    import xxhash

    raw = b"".join(xxhash.xxh3_128_digest(p, 42) + xxhash.xxh3_128_digest(p, 43) for p in parts)
    return np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 32), axis=1)


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    import xxhash

    words = (text or "").encode().lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(words[k : k + shingle]), 42) for k in range(n)), np.uint64, n))


def wide_fingerprint(text: str | None, shingle: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of 64 bits over weighed words (``FAMILIES``), and one of 256 bits over distinct shingles, as signed longs."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(FAMILIES, np.int64), np.zeros(len(WIDE), np.int64)
    counts = Counter(words)
    distinct, weight = list(counts), 1 + np.log2(np.fromiter(counts.values(), float, len(counts)))
    heavy = np.zeros(256)
    for at in range(0, len(distinct), 1 << 13):
        heavy += weight[at : at + (1 << 13)] @ digests(distinct[at : at + (1 << 13)])
    parts = list({b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))})
    ones, n = np.zeros(256, np.int64), len(parts)
    for at in range(0, n, 1 << 13):
        ones += digests(parts[at : at + (1 << 13)]).sum(axis=0, dtype=np.int64)
    light, full = (np.packbits(b).view(">i8").astype(np.int64) for b in (2 * heavy > weight.sum(), 2 * ones > n))
    return light[:FAMILIES], full


def wide_fingerprints(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, text_hash, node, f0.., w0..w3): ``node`` names equal sets of shingles."""
    import xxhash

    names = ["node", *[f"f{k}" for k in range(FAMILIES)], *WIDE]

    def one(text: str | None) -> np.ndarray:
        node = signed(xxhash.xxh3_64_intdigest(shingle_set(text, shingle).tobytes(), 42))
        return np.concatenate([[node], *wide_fingerprint(text, shingle)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([one(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, len(names))
            arrays = [batch.column("doc_id"), batch.column("text_hash"), *[pa.array(c, pa.int64()) for c in fps.T]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", *names])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return map_batches(rows, work, ", ".join(f"{c} long" for c in ("doc_id", "text_hash", *names)))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [signed(fingerprint(t.as_py(), shingle)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, fp long")


def bits(start: int, width: int) -> int:
    """A mask of the ring's bits from ``start`` on, counted from the top."""
    return sum(1 << (63 - (start + k) % 64) for k in range(width))


def chain_masks() -> list[tuple[int, int]]:
    """(start segment, mask) of every file of the index."""
    masks = []
    for s in range(SEGMENTS):
        at = s * WIDTH
        for half in (0, 8):
            for third, size in ((0, 5), (5, 5), (10, 6)):
                masks.append((s, bits(at, WIDTH) | bits(at + WIDTH + half, 8) | bits(at + 2 * WIDTH + third, size)))
    return masks


def parted(mask: int) -> list[int]:
    """The mask with each of four parts of its free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[k::4]) for k in range(4)]


def mask_tree() -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Top masks (id, start, mask) and child masks (parent id, id, mask), two levels deep."""
    top = [(k, s, m) for k, (s, m) in enumerate(chain_masks())]
    children, level, free_id = [], [(k, m) for k, _, m in top], len(top)
    for _ in range(2):
        below = []
        for parent, mask in level:
            for m in parted(mask):
                children.append((parent, free_id, m))
                below.append((free_id, m))
                free_id += 1
        level = below
    return top, children


def mixed(x: np.ndarray) -> np.ndarray:
    """Longs scattered over all 64 bits; the sum over a set names the set."""
    x = x.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def file_links(rows: Iterator[pa.RecordBatch], starts: np.ndarray, reach: int, wide_reach: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Links (a, b) of files that arrive sorted by (start mask, value): a star over each linked set of a file.

    Rows are (mask, val, fp) and link fingerprints; where they go on with a
    node and its fingerprint over shingles, they link nodes, that fingerprint
    is checked as well, and a third array names the linked set; the set's
    seed then is linked to itself, too.
    """

    def near(x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        """Chain budgets from the file's start, then the whole distance."""
        x = x.view(np.uint64)
        turn = np.uint64(WIDTH) * np.asarray(start, np.uint64)
        ring = np.where(turn > 0, (x << turn) | (x >> ((np.uint64(64) - turn) & np.uint64(63))), x)
        two = np.bitwise_count(ring >> np.uint64(32)) <= 2 * reach // SEGMENTS
        three = np.bitwise_count(ring >> np.uint64(16)) <= 3 * reach // SEGMENTS
        return two & three & (np.bitwise_count(x) <= reach)

    def alike(wide: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray | bool:
        """The check over shingles between rows at ``a`` and ``b``."""
        return not wide or sum(np.bitwise_count((w[a] ^ w[b]).view(np.uint64)).astype(np.int16) for w in wide) <= wide_reach

    def one(fp: np.ndarray, name: np.ndarray, wide: list[np.ndarray], start: int) -> Iterator[tuple[np.ndarray, ...]]:
        left = np.unique(name, return_index=True)[1]
        while len(left) > 1:
            seed, left = left[0], left[1:]
            edge, linked = np.array([seed]), [np.array([seed])]
            while len(edge) and len(left):
                front = edge[:64, None]
                hit = (near(fp[front] ^ fp[left], start) & alike(wide, front, left)).any(axis=0)
                edge = np.concatenate([edge[64:], left[hit]])
                if hit.any():
                    linked.append(left[hit])
                left = left[~hit]
            if len(linked) > 1:
                some = name[np.concatenate(linked if wide else linked[1:])]
                stars = some, np.full(len(some), name[seed])
                yield (*stars, np.full(len(some), mixed(some).sum().view(np.int64))) if wide else stars

    def files(mask: np.ndarray, val: np.ndarray, fp: np.ndarray, *rest: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        name, wide = (rest[0], list(rest[1:])) if rest else (fp, [])
        cut = np.flatnonzero((mask[1:] != mask[:-1]) | (val[1:] != val[:-1])) + 1
        begin = np.concatenate([[0], cut])
        size = np.diff(np.concatenate([begin, [len(fp)]]))
        pair = begin[size == 2]
        ok = near(fp[pair] ^ fp[pair + 1], starts[mask[pair]]) & (name[pair] != name[pair + 1]) & alike(wide, pair, pair + 1)
        a, b = name[pair][ok], name[pair + 1][ok]
        if wide:
            key = (mixed(a) + mixed(b)).view(np.int64)
            yield np.concatenate([a, b]), np.concatenate([a, a]), np.concatenate([key, key])
        else:
            yield a, b
        for b, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            yield from one(fp[b : b + n], name[b : b + n], [w[b : b + n] for w in wide], int(starts[mask[b]]))

    held: list[np.ndarray] | None = None
    for batch in rows:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        last = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]))
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield from files(*[c[:whole] for c in columns])
        held = [c[whole:] for c in columns]
    if held is not None and len(held[0]):
        yield from files(*held)


def near_links(nodes: DataFrame, crowded: int = 2000, reach: int = REACH, wide_reach: int = WIDE_REACH) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) whose closure holds every pair within ``reach`` bits.

    Nodes that also carry ``node`` and ``w0`` to ``w3`` are linked by ``node``
    if their fingerprints over shingles lie within ``wide_reach`` bits too; a
    third column ``linked`` names the set that a link is of.
    """
    spark = nodes.sparkSession
    names = ["fp", "node"] if "node" in nodes.columns else ["fp"]
    top, children = mask_tree()
    starts = np.zeros(max(c[1] for c in children) + 1, np.int64)
    for k, s, _ in top:
        starts[k] = s
    for parent, k, _ in children:
        starts[k] = starts[parent]
    below = spark.createDataFrame([(p, k, signed(m)) for p, k, m in children], "mask int, child int, bits long")

    def crowding(rows: DataFrame) -> DataFrame:
        counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("mask", "val")))
        return materialize(counted.filter("n > 1"), "simhash-files")

    filed = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("val")) for k, _, m in top])
    level = crowding(nodes.select(*names, F.explode(filed).alias("f")).select("f.mask", "f.val", *names))
    levels = []
    for _ in range(2):
        levels.append(level.filter(F.col("n") <= crowded))
        dense = level.filter(F.col("n") > crowded)
        if not dense.limit(1).count():
            dense = None
            break
        finer = dense.join(F.broadcast(below), "mask")  # a fixed list of masks
        level = crowding(finer.select(F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("bits")).alias("val"), *names))
    else:
        levels.append(level)
    rows = levels[0]
    for more in levels[1:]:
        rows = rows.unionByName(more)

    out = ["a", "b", "linked"] if len(names) > 1 else ["a", "b"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in file_links(batches, starts, reach, wide_reach):
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=out)

    rows = rows.select("mask", "val", *names)
    if len(names) > 1:
        rows = rows.join(nodes.select("node", *WIDE), "node").select("mask", "val", *names, *WIDE)
    sorted_files = rows.repartition("mask", "val").sortWithinPartitions("mask", "val", "fp")
    return map_batches(sorted_files, link, ", ".join(f"{c} long" for c in out))


def set_links(nodes: list[int], sets: list[np.ndarray], tenths: int = 8) -> list[tuple[int, int]]:
    """Links whose closure holds every pair of sets with a Jaccard similarity of ``tenths`` tenths and more, and no other."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    has, left, links = np.zeros(len(known) + 1, np.int32), order[sizes[order] > 0], []
    while len(left) > 1:
        edge, left = [left[0]], left[1:]
        while edge and len(left):
            at = edge.pop()
            mine = flat[begin[at] : begin[at + 1]]
            has[mine] = 1
            fit = np.flatnonzero((10 * sizes[left] >= tenths * sizes[at]) & (10 * sizes[at] >= tenths * sizes[left]))
            shared = np.array([has[flat[begin[k] : begin[k + 1]]].sum() for k in left[fit]], np.int64)
            has[mine] = 0
            hit = fit[10 * shared >= tenths * (sizes[left[fit]] + sizes[at] - shared)]
            links += [(nodes[k], nodes[at]) for k in left[hit]]
            edge += left[hit].tolist()
            left = np.delete(left, hit)
    return links


def exact_links(docs: DataFrame, named: DataFrame, found: DataFrame, shingle: int, gathered: int = GATHERED) -> DataFrame:
    """Links (a, b) between nodes of the candidate sets ``found`` whose whole shingle sets are similar."""
    roots = components(found.filter("a <> b").select("a", "b").distinct())
    roots = materialize(roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct(), "wide-candidates")
    small = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= gathered).select("root")
    one_set = roots.join(small, "root").select("node", F.col("root").alias("linked"))
    sets = found.select(F.col("a").alias("node"), "linked").join(one_set.select("node"), "node", "left_anti").distinct().unionByName(one_set)
    # a node's text: of its rows, those of the smallest hash, once
    texts = named.join(roots.select("node"), "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    texts = materialize(texts, "wide-texts")
    whole = docs.select("text", F.xxhash64("text").alias("text_hash")).join(texts.select("text_hash"), "text_hash", "left_semi")
    whole = whole.groupBy("text_hash").agg(F.min("text").alias("text")).join(texts, "text_hash").select("node", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), shingle).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.list_(pa.int64()))], names=["node", "shingles"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, held = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1 and (links := set_links(nodes, held)):
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for k, node, shingles in zip(batch.column("linked").to_pylist(), batch.column("node").to_pylist(), batch.column("shingles"), strict=True):
                if k != key:
                    yield from done()
                    key, nodes, held = k, [], []
                nodes.append(node)
                held.append(shingles.values.to_numpy())
        yield from done()

    full = materialize(map_batches(whole, read, "node long, shingles array<long>"), "wide-sets")
    dealt = sets.join(full, "node").select("linked", "node", "shingles").repartition("linked").sortWithinPartitions("linked", "node")
    return map_batches(dealt, check, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 3, crowded: int = 2000) -> DataFrame:
    """(doc_id, fp, component_id): components of documents whose fingerprints chain within 3 bits."""
    named = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-nodes")
    roots = materialize(components(near_links(nodes.select("fp"), crowded)), "fp-roots")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = materialize(rooted.join(names, "root").select("fp", "component_id"), "fp-components")
    return named.join(known, "fp").select("doc_id", "fp", "component_id")


def similar_components(docs: DataFrame, shingle: int = 5, crowded: int = 2000, wide_reach: int = WIDE_REACH) -> DataFrame:
    """(doc_id, text_hash, root, component_id): components of documents of a similarity of 0.8 and more.

    ``root`` tells components apart also where they share their smallest id. Two different sets of shingles share a node's name by chance
    once in 2**64 pairs.
    """
    named = materialize(wide_fingerprints(docs, shingle), "wide-fingerprints")
    seen = named.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct(*[c for c in named.columns if c[0] in "fw"])).alias("fps"))
    nodes = materialize(seen.select("node", "least", "fps.*"), "wide-nodes")
    links = None
    for k in range(FAMILIES):
        found = near_links(nodes.select("node", F.col(f"f{k}").alias("fp"), *WIDE), crowded, REACH, wide_reach)
        links = found if links is None else links.unionByName(found)
    links = materialize(links.distinct(), "wide-links")
    roots = materialize(components(exact_links(docs, named, links, shingle)), "wide-roots")
    rooted = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = materialize(rooted.join(names, "root").select("node", "root", "component_id"), "wide-components")
    return named.select("doc_id", "text_hash", "node").join(known, "node").select("doc_id", "text_hash", "root", "component_id")


def near_dedup(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """One document of each component of near copies: the one of the smallest id.

    Of texts that share the smallest id the one of the smallest hash stays, of
    repeated rows one. Rows with a null id are kept: nothing names them as
    copies.
    """
    key = ["doc_id", "_text_hash"]
    found = materialize(similar_components(docs.select("doc_id", "text"), shingle).withColumnRenamed("text_hash", "_text_hash"), "wide-found")
    found = found.filter("doc_id IS NOT NULL")
    kept = found.filter("doc_id = component_id").groupBy("root").agg(F.min("_text_hash").alias("kept"))
    copy = (F.col("doc_id") != F.col("component_id")) | (F.col("_text_hash") != F.col("kept"))
    gone = found.join(kept, "root").groupBy(*key).agg(F.bool_or(copy).alias("copy"), F.count(F.lit(1)).alias("rows"))
    marked = materialize(gone.filter("copy OR rows > 1"), "wide-copies")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("_text_hash"), F.struct(*docs.columns).alias("row"))  # no name clashes
    single = hashed.join(marked, key, "left_anti").select("row.*")
    again = hashed.join(marked.filter("NOT copy").select(*key), key, "left_semi")
    again = again.groupBy(*key).agg(F.min("row").alias("row"))
    return single.unionByName(again.select("row.*"))


@query("op8_simhash")
def op8_simhash(spark, folder: str) -> DataFrame:
    found = simhash_components(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
