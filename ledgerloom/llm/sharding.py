"""Sharding by vector bin packing.

Groups of equal texts are the items; an item has three sizes (bytes, tokens,
rows), each as a share of the total. An item goes to the shard whose residual
capacity has the highest dot product with it, the smaller shard on ties. The
law is ``bytes``: shard sizes come out near equal.

Items above one ``coarse``-th of a shard are placed one by one over the whole
table, largest first; there are at most ``3 * shards * coarse`` of them, which
bounds what the driver sees. A group larger than ``whole`` of a shard cannot
keep the sizes near equal, so its rows are dealt to pieces of ``1 / coarse``
shard each. The rest are dealt to chunks by their hash, and each chunk fills
its share of what the large items left, again largest first. Chunks are
independent tasks, so no task and no driver sees all groups.

Inputs: a null text has no bytes and no tokens and is a group of its own,
apart from the empty text; repeated rows are members of their group; ids may
be null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, query, ranked_in_buckets, table

WORD = r"[^\x20\x09-\x0D]+"
OVERHEAD = 16


def place(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shards of items (rows of shares) taken in the given order; ``residual`` is used up.

    A shard that an item would fill past its bytes is passed over while
    another still has room.
    """
    out = np.empty(len(items), np.int32)
    for i, item in enumerate(items):
        fits = residual[:, 0] >= item[0]
        score = residual @ item
        if fits.any():
            score = np.where(fits, score, -np.inf)
            out[i] = score.argmax()
        else:
            out[i] = residual[:, 0].argmax()
        residual[out[i]] -= item
    return out


def shard_groups(rows: DataFrame, shards: int, coarse: int = 50, whole: float = 0.5, chunk_groups: int = 2000) -> DataFrame:
    """Add ``shard`` to rows that have group_key, size, tokens and row_key.

    ``row_key`` tells the rows of a split group apart.
    """
    spark = rows.sparkSession
    groups = materialize(
        rows.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "shard-groups"
    )
    total = groups.agg(F.sum("bytes"), F.sum("tokens"), F.sum("n"), F.count(F.lit(1))).first()
    sums = np.maximum(np.array([total[k] or 0 for k in range(3)], float), 1.0)
    share = F.greatest(*(F.col(c) / F.lit(float(s)) for c, s in zip(("bytes", "tokens", "n"), sums, strict=True)))
    groups = groups.withColumn("share", share)
    unit = 1.0 / (shards * coarse)

    large = groups.filter(F.col("share") > unit)
    pieces = F.when(F.col("share") > whole / shards, F.least(F.ceil(F.col("share") / unit), F.col("n"))).otherwise(1).cast("int")
    large = large.withColumn("pieces", pieces)
    picked = large.select("group_key", "bytes", "tokens", "n", "share", "pieces").orderBy(F.desc("share"), "group_key").toPandas()

    residual = np.full((shards, 3), 1.0 / shards)
    split = picked.loc[picked.index.repeat(picked["pieces"])].reset_index(drop=True)
    split["piece"] = split.groupby("group_key").cumcount() if len(split) else 0
    vectors = split[["bytes", "tokens", "n"]].to_numpy(float) / sums / split[["pieces"]].to_numpy(float)
    order = np.argsort(-vectors.max(axis=1), kind="stable") if len(split) else np.arange(0)
    split = split.iloc[order].assign(shard=place(vectors[order], residual))
    placed_large = spark.createDataFrame(
        [(int(k), int(n), int(p), int(s)) for k, n, p, s in split[["group_key", "pieces", "piece", "shard"]].itertuples(index=False)],
        "group_key long, pieces int, piece int, shard int",
    )

    chunks = max(1, -(-(total[3] or 0) // chunk_groups))
    room = np.maximum(residual, 0.0)
    room = room / np.maximum(room.sum(axis=0), 1e-12)

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["share", "group_key"], ascending=[False, True])
        vectors = part[["bytes", "tokens", "n"]].to_numpy(float) / sums
        free = room * vectors.sum(axis=0)
        return pd.DataFrame({"group_key": part["group_key"].to_numpy(), "pieces": np.int32(1), "piece": np.int32(0), "shard": place(vectors, free)})

    small = groups.filter(F.col("share") <= unit).withColumn("chunk", F.pmod(F.xxhash64("group_key"), F.lit(chunks)))
    placed_small = small.groupBy("chunk").applyInPandas(fill, "group_key long, pieces int, piece int, shard int")
    placed = materialize(placed_small.unionByName(placed_large), "shard-places")

    pieces_of = placed_large.groupBy("group_key").agg(F.max("pieces").alias("pieces")).filter("pieces > 1")
    small_side = F.broadcast(pieces_of)  # at most 3 * shards / whole split groups
    split_rows = ranked_in_buckets(rows.join(small_side, "group_key"), ["group_key"], ["row_key"], total[2] or 0, "_place")
    split_rows = split_rows.withColumn("piece", (F.col("_place") % F.col("pieces")).cast("int")).select(*rows.columns, "piece")
    salted = rows.join(small_side, "group_key", "left_anti").withColumn("piece", F.lit(0)).unionByName(split_rows)
    return salted.join(placed.drop("pieces"), ["group_key", "piece"]).drop("piece")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.xxhash64("text", F.col("text").isNull(), F.octet_length(text), F.crc32(text)).alias("group_key"),
    )
    rows = materialize(rows.withColumn("row_key", F.xxhash64("doc_id", "group_key")), "shard-rows")
    placed = shard_groups(rows, shards)
    slotted = ranked_in_buckets(placed, ["shard"], ["doc_id", "group_key"], rows.count(), "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_sharding")
def op3_sharding(spark, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents", "doc_id", "text"))
