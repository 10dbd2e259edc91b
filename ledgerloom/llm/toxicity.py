"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own hashed embedding beside the mean of its hashed
character n-grams (3 to 5, with marks at the word's ends), so unseen forms of
a known stem are read by their characters. Two gated recurrent passes, one in
each direction, run over a window of words; attention weighs their states into
one, from which comes the window's logit. Windows overlap and cover the whole
text; a document's logit is that of its highest window, brought to a
probability by a logistic curve fitted on documents kept out of training.

Training is on the driver, over a bounded sample of labelled rows: at most
``per_class`` rows of each class (picked by a hash of the id, which is no
input) with texts up to ``longest`` characters. A class that is capped is
rarer in the sample than in the table, so the learnable labels of each class
are counted over the whole table and the curve's offset is moved by the
difference in log odds: a score is a chance in the table, whatever its size.
As a label holds for the document and not for each window, an epoch learns from each document's
currently highest window, after two epochs of random ones. Scoring is one
pass over Arrow batches with the fixed-size model; nothing is shuffled.

Inputs: null, empty and wordless texts get the logit of an empty window;
letters and digits in runs over 24 are read as several words; null and
repeated ids are rows of their own; null labels teach nothing; without any
label the score is 0; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_batches, query, table

WORD = re.compile(r"[^\W_]{1,24}")
WORDS, CHARS, WIDE, STATE = 1 << 15, 1 << 16, 8, 8
WINDOW, STEP = 64, 52
GATES = 3 * STATE


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


class Words:
    """Distinct words of some texts with their hashed features."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def read(self, text: str | None) -> np.ndarray:
        known = self.known
        found = WORD.findall(text.lower()) if text else []
        return np.fromiter([known.setdefault(w, len(known)) for w in found], np.int32, len(found))

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per word length: places, word buckets, and n-gram buckets as rows."""
        by_length: dict[int, tuple[list[int], list[str]]] = {}
        for w, k in self.known.items():
            places, words = by_length.setdefault(len(w), ([], []))
            places.append(k)
            words.append(w)
        for n, (places, words) in by_length.items():
            for at in range(0, len(words), 8192):
                part = np.array(words[at : at + 8192], f"<U{n}").view(np.uint32).reshape(-1, n)
                marks = np.full((len(part), 1), 1, np.uint32)
                c = np.hstack([marks, part, marks + 1])
                hashed = c[:, 0].copy()
                for k in range(1, n + 2):
                    hashed = hashed * np.uint32(0x01000193) ^ c[:, k]
                hashed ^= hashed >> np.uint32(15)
                grams = []
                for size in range(3, min(5, n + 2) + 1):
                    h = c[:, : n + 3 - size] + np.uint32(size)
                    for k in range(1, size):
                        h = h * np.uint32(0x9E3779B1) + c[:, k : n + 3 - size + k]
                    h ^= h >> np.uint32(15)
                    h *= np.uint32(0x85EBCA77)
                    grams.append((h >> np.uint32(13)) & np.uint32(CHARS - 1))
                yield np.array(places[at : at + 8192]), hashed & np.uint32(WORDS - 1), np.hstack(grams)


def windows_of(n: int) -> np.ndarray:
    """Starts of the overlapping windows over ``n`` words; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.minimum(np.arange(0, n - WINDOW + STEP, STEP), n - WINDOW)


def windowed(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word places (padded), lengths and document of every window."""
    starts = [windows_of(len(d)) for d in docs]
    doc = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
    flat = np.concatenate([*docs, np.zeros(WINDOW, np.int32)])
    offset = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    begin = np.concatenate(starts) + offset[doc] if len(docs) else np.zeros(0, np.int64)
    sizes = np.minimum(np.array([len(d) for d in docs], np.int64), WINDOW)[doc] if len(docs) else np.zeros(0, np.int64)
    return flat[begin[:, None] + np.arange(WINDOW)], sizes, doc


class Network:
    """Weights of the network and its passes."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = lambda *shape, s=0.1: rng.normal(0, s, shape).astype(np.float32)
        self.word, self.char = f(WORDS, WIDE), f(CHARS, WIDE, s=0.2)
        self.w = {"in": f(2 * WIDE, 2 * GATES, s=0.3), "bias": np.zeros(2 * GATES, np.float32), "fore": f(STATE, GATES, s=0.3), "back": f(STATE, GATES, s=0.3),
                  "look": f(2 * STATE, s=0.3), "out": f(2 * STATE, s=0.3), "rest": np.zeros(1, np.float32)}
        self.curve = (1.0, 0.0)
        self.taught = False

    def inputs(self, words: Words) -> np.ndarray:
        """Input vectors of all distinct words."""
        x = np.zeros((len(words.known) + 1, 2 * WIDE), np.float32)
        for places, bucket, grams in words.features():
            x[places, :WIDE] = self.word[bucket]
            total = self.char[grams[:, 0]]
            for k in range(1, grams.shape[1]):
                total += self.char[grams[:, k]]
            x[places, WIDE:] = total / np.float32(np.sqrt(grams.shape[1]))
        return x

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What the words give to the gates of both passes."""
        return x @ self.w["in"] + self.w["bias"]

    @staticmethod
    def mirrored(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of position t in the backward pass."""
        return np.maximum(sizes[:, None] - 1 - np.arange(ids.shape[1]), 0)

    def run(self, gates: np.ndarray, ids: np.ndarray, sizes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows; ``keep`` collects what the backward pass needs."""
        n, steps = len(ids), int(sizes.max(initial=0))
        padded = bool((sizes < steps).any())
        one, half_one = np.float32(1), np.float32(0.5)
        mask = np.arange(steps) < sizes[:, None]
        alive = np.ascontiguousarray(mask.T)
        mirror = self.mirrored(ids[:, :steps], sizes)
        look, out = np.zeros((2, steps, n), np.float32), np.zeros((2, steps, n), np.float32)
        tables = np.ascontiguousarray(gates[:, :GATES]), np.ascontiguousarray(gates[:, GATES:])
        orders = [np.ascontiguousarray(o.T) for o in (ids[:, :steps], np.take_along_axis(ids[:, :steps], mirror, axis=1))]
        for d, (name, order) in enumerate(zip(("fore", "back"), orders, strict=True)):
            u, half = np.ascontiguousarray(self.w[name].T), slice(d * STATE, (d + 1) * STATE)
            ends = np.stack([self.w["look"][half], self.w["out"][half]])
            h = np.zeros((STATE, n), np.float32)  # states lie in rows, windows in columns
            trace = []
            for t in range(steps):
                p, hu = tables[d][order[t]].T, u @ h
                zr = hu[: 2 * STATE] + p[: 2 * STATE]
                zr *= half_one
                np.tanh(zr, out=zr)
                zr += one
                zr *= half_one
                z, r = zr[:STATE], zr[STATE:]
                c = r * hu[2 * STATE :]
                c += p[2 * STATE :]
                np.tanh(c, out=c)
                new = h - c
                new *= z
                new += c
                if padded:
                    new = np.where(alive[t], new, h)
                if keep is not None:
                    trace.append((h, z, r, c, hu[2 * STATE :], new))
                h = new
                look[d, t], out[d, t] = ends @ h
            if keep is not None:
                keep.append(trace)
        look, out = look.transpose(0, 2, 1), out.transpose(0, 2, 1)
        back = lambda a: np.take_along_axis(a, mirror, axis=1)
        score = np.where(mask, look[0] + back(look[1]), -np.inf)
        top = np.where(sizes > 0, score.max(axis=1, initial=-np.inf), 0)
        weight = np.exp(score - top[:, None])
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-30)
        value = out[0] + back(out[1])
        if keep is not None:
            keep += [weight, value, mask, mirror, orders]
        return (weight * value).sum(axis=1) + self.w["rest"][0]

    def learn(self, words_x: np.ndarray, ids: np.ndarray, sizes: np.ndarray, error) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Gradients of the weights and of the word inputs; ``error`` maps logits to d loss / d logit."""
        keep: list = []
        logit = self.run(self.gates(words_x), ids, sizes, keep)
        weight, value, mask, mirror, orders = keep[2:]
        d = error(logit).astype(np.float32)
        steps = weight.shape[1]
        d_value = d[:, None] * weight
        d_weight = d[:, None] * value
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["rest"][0] = d.sum()
        d_gates = np.zeros((len(words_x), 2 * GATES), np.float32)
        for k, name in enumerate(("fore", "back")):
            u, half = self.w[name], slice(k * STATE, (k + 1) * STATE)
            dv, ds = d_value * mask, d_score * mask
            if k:  # position of step t, seen from the backward pass
                dv, ds = np.take_along_axis(dv, mirror, axis=1) * mask, np.take_along_axis(ds, mirror, axis=1) * mask
            dv, ds, alive = np.ascontiguousarray(dv.T), np.ascontiguousarray(ds.T), np.ascontiguousarray(mask.T)
            w_out, w_look = self.w["out"][half, None], self.w["look"][half, None]
            dh = np.zeros((STATE, len(ids)), np.float32)
            flows = np.empty((steps, GATES, len(ids)), np.float32)
            for t in range(steps - 1, -1, -1):
                h, z, r, c, hc, new = keep[k][t]
                grads["out"][half] += new @ dv[t]
                grads["look"][half] += new @ ds[t]
                dh = dh + dv[t] * w_out + ds[t] * w_look
                live = dh * alive[t]
                dc = live * (1 - z) * (1 - c * c)
                dz = live * (h - c) * z * (1 - z)
                dr = dc * hc * r * (1 - r)
                flows[t, :STATE], flows[t, STATE : 2 * STATE], flows[t, 2 * STATE :] = dz, dr, dc
                through = flows[t].copy()
                through[2 * STATE :] *= r
                grads[name] += h @ through.T
                dh = (dh - live) + live * z + u @ through
            np.add.at(d_gates[:, k * GATES : (k + 1) * GATES], orders[k].ravel(), flows.transpose(0, 2, 1).reshape(-1, GATES))
        grads["bias"] = d_gates.sum(axis=0)
        grads["in"] = words_x.T @ d_gates
        return grads, d_gates @ self.w["in"].T, logit

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of whole texts."""
        if not self.taught:
            return np.zeros(len(texts))
        words = Words()
        docs = [words.read(t) for t in texts]
        return self.probability(self.highest(self.inputs(words), docs)[0])

    def highest(self, x: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per document: its highest window's logit, places and length; and all window logits."""
        ids, sizes, doc = windowed(docs)
        gates = self.gates(x)
        alike, logit = np.argsort(sizes, kind="stable"), np.zeros(len(ids))  # so that most chunks need no padding
        for k in range(0, len(ids), 1024):
            some = alike[k : k + 1024]
            logit[some] = self.run(gates, ids[some], sizes[some])
        order = np.lexsort((-logit, doc))
        first = order[np.searchsorted(doc[order], np.arange(len(docs)))]
        return logit[first], ids[first], sizes[first], logit

    def probability(self, logit: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * logit.astype(float) + b, -500, 500)))


def train(texts: list[str], labels: list[int], visits: int = 28_000, batch: int = 64, rate: float = 0.01, shift: float = 0.0) -> Network:
    """Fit the network to documents and their 0/1 labels; the same rows give the same network.

    A small sample is gone through more often: about ``visits`` documents in
    all, 7 to 40 times. ``shift`` is what the table's log odds have over those
    of the sample.
    """
    net = Network()
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return net
    net.taught = True
    epochs = max(7, min(40, visits // len(y)))
    rng = np.random.default_rng(3)
    words = Words()
    docs = [words.read(t) for t in texts]
    features = list(words.features())
    n_words = len(words.known)
    bucket = np.zeros(n_words, np.int64)
    grams: list[np.ndarray] = [np.zeros(0, np.int64)] * n_words
    for places, b, g in features:
        bucket[places] = b
        for k, row in zip(places.tolist(), g.astype(np.int64), strict=True):
            grams[k] = row
    gram_sizes = np.array([len(g) for g in grams])
    gram_from = np.concatenate([[0], np.cumsum(gram_sizes)])
    gram_flat = np.concatenate(grams)

    kept = rng.random(len(y)) < 0.2  # for the curve
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    seen_word, seen_char = np.full(WORDS, 1e-4, np.float32), np.full(CHARS, 1e-4, np.float32)
    step = 0
    for epoch in range(epochs):
        if epoch < 2:
            begin = [int(rng.integers(len(windows_of(len(d))))) for d in docs]
            parts = [d[s : s + WINDOW] for d, s in ((d, windows_of(len(d))[k]) for d, k in zip(docs, begin, strict=True))]
            ids = np.zeros((len(docs), WINDOW), np.int32)
            for k, p in enumerate(parts):
                ids[k, : len(p)] = p
            sizes = np.array([len(p) for p in parts])
        else:
            _, ids, sizes, _ = net.highest(net.inputs(words), docs)
        rows = np.flatnonzero(~kept)
        rng.shuffle(rows)
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(rows), batch):
            some = rows[at : at + batch]
            used, local = np.unique(ids[some], return_inverse=True)
            local = local.reshape(len(some), WINDOW)
            flat = np.concatenate([gram_flat[gram_from[w] : gram_from[w + 1]] for w in used])
            of = np.repeat(np.arange(len(used)), gram_sizes[used])
            scale = (1 / np.sqrt(gram_sizes[used])).astype(np.float32)[:, None]
            x = np.zeros((len(used), 2 * WIDE), np.float32)
            x[:, :WIDE] = net.word[bucket[used]]
            x[:, WIDE:] = np.add.reduceat(net.char[flat], np.searchsorted(of, np.arange(len(used)))) * scale
            truth = y[some]
            grads, dx, _ = net.learn(x, local, sizes[some], lambda z: (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) / len(truth))  # noqa: B023
            step += 1
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.w[k] -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            for weights, seen, rows_of, g in ((net.word, seen_word, bucket[used], dx[:, :WIDE]), (net.char, seen_char, flat, (dx[:, WIDE:] * scale)[of])):
                touched, inverse = np.unique(rows_of, return_inverse=True)
                total = np.zeros((len(touched), WIDE), np.float32)
                np.add.at(total, inverse, g)
                seen[touched] += (total * total).mean(axis=1)
                weights[touched] -= np.float32(pace * 10) * total / np.sqrt(seen[touched])[:, None] * np.float32(0.5)

    logit = net.highest(net.inputs(words), docs)[0][kept] if kept.any() else np.zeros(0)
    slope, offset = fitted_curve(logit, y[kept])
    net.curve = slope, offset + shift
    return net


def fitted_curve(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by damped Newton steps with a weak prior at (1, 0)."""
    beta, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    if not len(y):
        return 1.0, 0.0
    x = np.stack([logit.astype(float), np.ones(len(y))], axis=1)

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((np.logaddexp(0, z) - y * z).sum() + ((b - prior) ** 2).sum() / 2)

    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (p - y) + (beta - prior)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(beta - size * move) > loss(beta):
            size /= 2  # a full step may overshoot
        beta = beta - size * move
    return float(max(beta[0], 0.05)), float(beta[1])


def learnable(labels: DataFrame) -> DataFrame:
    """The distinct labels that may be learned from."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).select("doc_id", "toxic").distinct()


def sample_shift(labels: DataFrame, per_class: int = 2000) -> float:
    """Log odds of the learnable labels of the whole table, less those of a sample of ``per_class`` of each class.

    Rows are drawn before their texts are looked up, so texts that are too
    long or missing thin out a class alike in table and sample.
    """
    counts = {int(r["toxic"]): r["count"] for r in learnable(labels).groupBy("toxic").count().collect()}
    over = {k: max(1.0, counts.get(k, 0) / per_class) for k in (0, 1)}
    return float(np.log(over[1] / over[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = 2000, longest: int = 20_000) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``per_class`` learnable rows of each class."""
    usable = learnable(labels)
    picked = None
    for value in (0, 1):
        one = usable.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    short = docs.select("doc_id", "text").filter(F.length("text") <= longest)
    rows = short.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text").collect()  # at most 2 * per_class ids
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


NAMES = ("held_out", "score", "predicted")


def toxicity_scores(docs: DataFrame, model: Network, threshold: float = 0.3, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """The documents with three columns called ``names``; columns of the documents with these names go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c not in names]
    docs = docs.select(*columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores = net.scores(part.column(columns.index("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*columns, names[1]])

    scored = docs.mapInArrow(score, docs.limit(0).withColumn(names[1], F.lit(0.0)).schema)
    return scored.withColumn(names[0], held_out()).withColumn(names[2], (F.col(names[1]) >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """Learn from the labelled documents and score all of them."""
    return toxicity_scores(docs, train(*labelled_sample(docs, labels), shift=sample_shift(labels)), threshold, names)


@query("op1_toxicity")
def op1_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return toxicity(docs, table(spark, folder, "labels", "doc_id", "toxic")).select("doc_id", "held_out", "score", "predicted")
