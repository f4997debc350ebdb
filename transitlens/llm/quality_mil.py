"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of its text. Every
passage has surface features (shares of byte classes, word shapes, repeats)
and hashed word counts; a learned layer encodes it, gated attention
(tanh and sigmoid branches) weighs the encoded passages, and a logistic
function scores their weighted sum. The weights are learned in numpy from
document labels alone, on at most ``TRAIN_DOCS`` labelled documents of at most
``TRAIN_BYTES`` bytes each, chosen by a hash of their id; scoring runs over
all documents, a few MB at a time, with the weights broadcast (about 25 kB).

Defined cases: a null or empty text is a bag of one passage without words;
several labels of a document count as their mean, null labels not at all; of a
repeated id the fit takes the smallest text;
with no usable label all scores are 0.5; repeated rows are scored each; an
empty table gives an empty result; a document's label, lang, source and id
are never features; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.llm.scratch import ship_package
from transitlens.llm.word_arrays import pieces, utf8, words

PASSAGE = 48             # words
HASHED = 48              # buckets of hashed words
HIDDEN, GATE = 24, 12
TRAIN_DOCS = 8_000
TRAIN_BYTES = 60_000
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.01, 1e-4
BATCH_BYTES = 4 << 20


def _class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.float32)
    t[np.frombuffer(chars, np.uint8)] = 1
    return t


_CLASSES = [_class(b"0123456789"), _class(bytes(range(0x41, 0x5B))), _class(b"#*$%&|<>"), _class(b".,;:!?"),
            _class(b"\n"), _class(bytes(range(0x80, 0x100))), _class(b"()[]{}=_/\\@+~^-\"'`")]
FEATURES = len(_CLASSES) + 8 + HASHED


@dataclass
class Bags:
    """x: one row of features per passage; bag b has rows first[b] to first[b + 1] - 1."""

    x: np.ndarray
    first: np.ndarray


def passages(texts: list[bytes]) -> Bags:
    """The features of every passage of every text."""
    w = words(texts, lower=False)
    n_words = np.diff(w.first)
    per_doc = np.maximum(-(-n_words // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    doc = np.repeat(np.arange(len(texts)), per_doc)
    nth = np.arange(first[-1]) - first[doc]
    a = w.first[doc] + nth * PASSAGE
    b = np.minimum(a + PASSAGE, w.first[doc + 1])
    n = (b - a).astype(np.float32)
    x = np.zeros((len(a), FEATURES), np.float32)
    if not len(w.start):
        return Bags(x, first)
    full = b > a
    lo, hi = w.start[np.minimum(a, len(w.start) - 1)], w.end[np.maximum(b - 1, 0)]
    size = np.maximum(np.where(full, hi - lo, 1), 1).astype(np.float32)
    for k, table in enumerate(_CLASSES):
        run = np.concatenate([[0], np.cumsum(table[w.buf], dtype=np.float64)])
        x[:, k] = np.where(full, (run[hi] - run[lo]) / size, 0)
    k = len(_CLASSES)
    of = np.repeat(np.arange(len(a)), b - a)
    length = np.minimum(w.end - w.start, 1000).astype(np.float32)
    h = w.hashes()
    sums = lambda v: np.bincount(of, v, len(a)).astype(np.float32)
    m = np.maximum(n, 1)
    same = np.zeros(len(h), np.float32)
    same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((h, of))
    fresh = np.ones(len(h), np.float32)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
    mean = sums(length) / m
    stats = (np.log1p(n), n / PASSAGE, mean, np.sqrt(np.maximum(sums(length * length) / m - mean * mean, 0)),
             sums(length == 1) / m, sums(length > 20) / m, sums(same) / m, np.bincount(of[order], fresh, len(a)) / m)
    for i, s in enumerate(stats):
        x[:, k + i] = s
    bucket = (h >> np.uint64(40)) % np.uint64(HASHED)
    counts = np.bincount(of * HASHED + bucket.astype(np.int64), minlength=len(a) * HASHED).reshape(-1, HASHED)
    x[:, k + len(stats):] = counts / m[:, None]
    return Bags(x, first)


class Model:
    """Passage encoder, gated attention and the logistic function on top."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        z = lambda *s: np.zeros(s, np.float32)
        self.mean, self.scale = z(FEATURES), np.ones(FEATURES, np.float32)
        self.p = {"We": g(FEATURES, HIDDEN), "be": z(HIDDEN), "V": g(HIDDEN, GATE), "U": g(HIDDEN, GATE),
                  "w": g(GATE, 1), "c": g(HIDDEN, 1), "d": z(1)}
        self.fitted = False

    def _forward(self, bags: Bags):
        p, at = self.p, bags.first[:-1]
        bag = np.repeat(np.arange(len(at)), np.diff(bags.first))
        x = np.clip((bags.x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["We"] + p["be"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = ((t * s) @ p["w"])[:, 0]
        e = np.exp(e - np.maximum.reduceat(e, at)[bag])
        a = e / np.add.reduceat(e, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at)
        y = 1 / (1 + np.exp(-np.clip((z @ p["c"])[:, 0] + p["d"], -30, 30)))
        return x, h, t, s, a, z, y, bag

    def score(self, bags: Bags) -> np.ndarray:
        if not self.fitted:
            return np.full(len(bags.first) - 1, 0.5)
        return np.clip(self._forward(bags)[6].astype(np.float64), 0.0, 1.0)

    def weights(self, bags: Bags) -> np.ndarray:
        """The attention weight of every passage."""
        return self._forward(bags)[4]

    def _gradients(self, bags: Bags, target: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x, h, t, s, a, z, y, bag = self._forward(bags)
        dy = ((y - target) / len(target)).astype(np.float32)
        dz = dy[:, None] * p["c"][:, 0]
        da = (h * dz[bag]).sum(1)
        de = a * (da - np.add.reduceat(a * da, bags.first[:-1])[bag])
        du = de[:, None] * p["w"][:, 0]
        dt, ds = du * s * (1 - t * t), du * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"We": x.T @ dh, "be": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de[:, None],
                "c": z.T @ dy[:, None], "d": np.array([dy.sum()], np.float32)}

    def fit(self, bags: Bags, target: np.ndarray, seed: int = 6) -> Model:
        """Adam on the log loss of the documents."""
        self.mean = bags.x.mean(0)
        self.scale = bags.x.std(0) + np.float32(1e-3)
        r, step, sizes = np.random.default_rng(seed), 0, np.diff(bags.first)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(EPOCHS):
            order = r.permutation(len(target))
            for i in range(0, len(order), BATCH):
                some = order[i:i + BATCH]
                rows = np.concatenate([np.arange(bags.first[b], bags.first[b + 1]) for b in some])
                part = Bags(bags.x[rows], np.concatenate([[0], np.cumsum(sizes[some])]))
                step += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for k, g in self._gradients(part, target[some]).items():
                    g = g + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    q[k] = 0.99 * q[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(q[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        self.fitted = True
        return self


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0) -> Model:
    """Learn from the labelled documents outside the held-out fold."""
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.avg(label).alias("target")) \
        .filter(fold(F.col("doc_id"), folds) != held_out) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    # at most TRAIN_DOCS ids and numbers: small enough to broadcast by construction
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .filter(F.octet_length("text") <= TRAIN_BYTES).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "target").agg(F.min("text").alias("text"))     # of a repeated id one row, so the bound holds

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bags = passages(utf8(b.column("text")))
            raw = [bags.x[i:j].tobytes() for i, j in zip(bags.first, bags.first[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.string()), b.column("target"),
                                              pa.array(raw, pa.binary())], names=["doc_id", "target", "x"])

    ship_package(docs.sparkSession)
    got = sorted(rows.mapInArrow(features, "doc_id string, target double, x binary").collect())
    if not got:
        return Model()
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in got]
    bags = Bags(np.concatenate(x), np.concatenate([[0], np.cumsum([len(v) for v in x])]))
    return Model().fit(bags, np.array([r["target"] for r in got], np.float32))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every document."""
    ship_package(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column("text"))
            for i, j in pieces([len(t) for t in texts], BATCH_BYTES):
                s = known.value.score(passages(texts[i:j]))
                yield pa.RecordBatch.from_arrays([b.column("key").slice(i, j - i), pa.array(s, pa.float64())],
                                                 names=["key", "score"])

    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, score double") \
        .select(F.col("key").alias(key), "score")
