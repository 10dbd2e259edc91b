"""Approximate nearest neighbours: a navigable small-world graph per shard.

Vectors are dealt to shards of a bounded size by a hash of their id. A task
builds one shard's hierarchical graph over its distinct directions and stores
it as a row of flat neighbour arrays; a lost task builds one shard again.
Queries visit every shard in blocks, and the shard results are merged by rank.
Scores are cosines in double precision on the original vectors.

Equal vectors of a shard are one node that keeps its smallest ``k + 1`` ids,
which are all that ties to the smaller id can ask for.

Inputs: null ids, and vectors that are null, zero or hold null or non-finite
components, take no part; vectors meet only vectors of their own length;
repeated rows of an id are one vector each; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, query, table
from ledgerloom.llm.vectors import against, opened, per_row, split_sets, usable

INDEX = "block int, dim int, ids binary, vectors binary, nodes binary, top int, sizes binary, links binary"


class SmallWorld:
    """A hierarchical graph over unit rows; level l keeps its nodes' neighbours in one flat array."""

    def __init__(self, unit: np.ndarray, links: int = 16, width: int = 64):
        self.unit, self.links, self.width = unit, links, width
        n = len(unit)
        self.mark, self.turn = np.zeros(n, np.int64), 0
        levels = np.minimum((-np.log(1.0 - np.random.default_rng(7).random(n)) / np.log(links)).astype(int), 12)
        self.top = int(levels.max()) if n else 0
        self.near = [np.full((n, links * (2 if level == 0 else 1)), -1, np.int32) for level in range(self.top + 1)]
        self.used = [np.zeros(n, np.int32) for _ in range(self.top + 1)]
        self.entry = -1
        self.levels = levels

    def search(self, q: np.ndarray, starts: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` closest found, as (similarity, node) in no order."""
        self.turn += 1
        mark, turn, near, used, unit = self.mark, self.turn, self.near[level], self.used[level], self.unit
        sims = unit[starts] @ q
        mark[starts] = turn
        todo = [(-s, v) for s, v in zip(sims.tolist(), starts, strict=True)]
        kept = [(-s, v) for s, v in todo]
        heapify(todo)
        heapify(kept)
        while len(kept) > width:
            heappop(kept)
        while todo:
            far, node = heappop(todo)
            if -far < kept[0][0] and len(kept) >= width:
                break
            ring = near[node, : used[node]]
            ring = ring[mark[ring] != turn]
            if not len(ring):
                continue
            mark[ring] = turn
            got = unit[ring] @ q
            if len(kept) >= width:
                better = got > kept[0][0]
                ring, got = ring[better], got[better]
            for s, v in zip(got.tolist(), ring.tolist(), strict=True):
                if len(kept) < width:
                    heappush(kept, (s, v))
                elif s > kept[0][0]:
                    heapreplace(kept, (s, v))
                else:
                    continue
                heappush(todo, (-s, v))
        return kept

    def choose(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Spread-out neighbours: one that is closer to a chosen one than to the node waits."""
        found = sorted(found, key=lambda f: (-f[0], f[1]))
        nodes = [v for _, v in found]
        rows = self.unit[nodes]
        between = rows @ rows.T
        chosen: list[int] = []
        worst = np.full(len(nodes), -2.0, np.float32)
        for k, (s, _) in enumerate(found):
            if worst[k] < s:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(worst, between[k], out=worst)
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [k for k in range(len(nodes)) if k not in taken][: most - len(chosen)]
        return [nodes[k] for k in chosen]

    def tie(self, node: int, others: list[int], level: int) -> None:
        """Link both ways; a full neighbour chooses anew."""
        near, used = self.near[level], self.used[level]
        near[node, : len(others)] = others
        used[node] = len(others)
        most = near.shape[1]
        for other in others:
            if used[other] < most:
                near[other, used[other]] = node
                used[other] += 1
                continue
            ring = np.append(near[other], node)
            kept = self.choose(list(zip((self.unit[ring] @ self.unit[other]).tolist(), ring.tolist(), strict=True)), most)
            near[other, : len(kept)] = kept
            used[other] = len(kept)

    def build(self) -> SmallWorld:
        for node in range(len(self.unit)):
            level = int(self.levels[node])
            if self.entry < 0:
                self.entry = node
                continue
            q, start = self.unit[node], [self.entry]
            height = int(self.levels[self.entry])
            for above in range(height, level, -1):
                start = [max(self.search(q, start, 1, above))[1]]
            for at in range(min(level, height), -1, -1):
                found = self.search(q, start, self.width, at)
                self.tie(node, self.choose(found, self.links), at)
                start = [v for _, v in found]
            if level > height:
                self.entry = node
        return self

    def nearest(self, q: np.ndarray, count: int, width: int) -> list[int]:
        start = [self.entry]
        for above in range(int(self.levels[self.entry]), 0, -1):
            start = [max(self.search(q, start, 1, above))[1]]
        return [v for _, v in sorted(self.search(q, start, max(width, count), 0), key=lambda f: (-f[0], f[1]))[:count]]


def unit_rows(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of one vector and rows, in double precision."""
    a, b = q / np.abs(q).max(), v / np.abs(v).max(axis=1, keepdims=True)
    return np.minimum(1.0, np.maximum(-1.0, (b @ a) / (np.sqrt(a @ a) * np.sqrt((b * b).sum(axis=1)))))


def index_shards(shards: DataFrame, links: int, width: int) -> DataFrame:
    """One row of flat arrays per shard: distinct vectors, their rows in the shard, entry and level sizes, neighbours."""

    def build(row: dict):
        ids, v = opened(row)
        _, first, nodes = np.unique(v, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(first)  # nodes in order of first appearance
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        world = SmallWorld(unit_rows(v[first[order]]).astype(np.float32), links, width).build()
        sizes = np.concatenate([[world.entry, links, len(order)], world.levels]).astype("<i4")
        flat = np.concatenate([near.ravel() for near in world.near]).astype("<i4")
        yield [row["block"]], [row["dim"]], [row["ids"]], [row["vectors"]], [place[nodes.ravel()].astype("<i4").tobytes()], [world.top], [sizes.tobytes()], [flat.tobytes()]

    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    return per_row(shards.repartition("block", "dim"), build, INDEX, types)


def reopened(row: dict, v: np.ndarray) -> tuple[SmallWorld, list[np.ndarray]]:
    """The graph of a stored row, and the vectors behind each node."""
    entry, links, n = np.frombuffer(row["sizes"], "<i4")[:3].tolist()
    nodes = np.frombuffer(row["nodes"], "<i4")
    order = np.argsort(nodes, kind="stable")  # rows are in id order, so members are too
    members = np.split(order, np.cumsum(np.bincount(nodes, minlength=n))[:-1])
    world = SmallWorld.__new__(SmallWorld)
    world.unit = unit_rows(v[[m[0] for m in members]]).astype(np.float32)
    world.links, world.entry, world.top = links, entry, row["top"]
    world.levels = np.frombuffer(row["sizes"], "<i4")[3:]
    world.mark, world.turn = np.zeros(n, np.int64), 0
    flat, at = np.frombuffer(row["links"], "<i4"), 0
    world.near = []
    for level in range(row["top"] + 1):
        wide = links * (2 if level == 0 else 1)
        world.near.append(flat[at : at + n * wide].reshape(n, wide))
        at += n * wide
    world.used = [(near >= 0).sum(axis=1).astype(np.int32) for near in world.near]
    return world, members


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, links: int = 16, build_width: int = 64, search_width: int = 96, shard_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score of every query's k nearest by cosine."""
    shards, queries, _ = split_sets(usable(vectors, zero=False), every, shard_rows, 1024)
    index = materialize(index_shards(shards, links, build_width), "hnsw-index")

    def search(row: dict):
        ids, v = opened(row)
        q_ids, q = opened(row, "q_")
        world, members = reopened(row, v)
        for name, vector, unit in zip(q_ids.tolist(), q, unit_rows(q).astype(np.float32), strict=True):
            nodes = world.nearest(unit, k + 1, search_width)
            rows = np.concatenate([members[node][: k + 1] for node in nodes])
            rows = rows[ids[rows] != name]
            score = cosine(vector, v[rows])
            best = np.lexsort((ids[rows], -score))[:k]
            yield np.full(len(best), name), ids[rows[best]], score[best]

    found = per_row(against(index, queries).repartition("block", "q_block"), search, "query_id long, vec_id long, score double", [pa.int64(), pa.int64(), pa.float64()])
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op9_hnsw")
def op9_hnsw(spark, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings", "vec_id", "embedding"))
