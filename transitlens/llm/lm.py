"""Language-model scores of texts by a log-bilinear model.

Tokens are lower-cased words and an end per text. One exchange between blocks
of text and ranges of word hashes gives every token's count in the training
texts; the counts of all texts take part, so what is gathered grows with the
corpus. The ``HEAD`` most frequent tokens are outputs of the model by
themselves, all other words through their class (the last two bytes before
closing punctuation, hashed to ``CLASSES``): log P(word) = log P(class |
context) + log of its share in the class, with one more for every known word
and one for all unknown ones.

The context of a token is the ``CONTEXT`` tokens before it. Their embeddings,
each weighted by a vector of its place, add up to a prediction; its products
with all output embeddings, plus biases, are the scores of the outputs. They
are trained by noise-contrastive estimation against the unigram noise: first
on a sample of about ``INIT_TOKENS`` tokens in the driver, then by every task
on all training texts of its blocks, the results being averaged by tokens.
An output's score is a sum over the places of the context, so for scoring
matrix products give, once for each place, the exponentials of all outputs
after every embedding; their products over a context's places, added up,
normalise each token's log probability exactly.

Words are named by 64-bit hashes; for a corpus of 10^9 distinct words, the
chance that any two share a name is about 3 %.

Defined cases: null and empty texts have one token, the end; with no training
text N and V are 0 and all words unknown; a null id counts as an empty text
for the fold; repeated rows count and are scored each; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm import text_blocks as B
from transitlens.llm.scratch import Scratch, ranges_for, ship_package
from transitlens.llm.word_arrays import SPACED, mix64, words

BLOCK = 4 << 20
HEAD, CLASSES = 255, 128        # the end is one of HEAD
OUTPUTS = HEAD + CLASSES
CONTEXT, WIDTH = 4, 20
INIT_TOKENS, INIT_EPOCHS = 300_000, 3
BATCH, NOISE = 256, 48
RATE = 0.08
ROWS = 512                      # contexts scored at once
LEAST = 1e-30                   # sums below are made anew from the scores: float32 products may have vanished
END = np.uint64(0x5851F42D4C957F2D)
_START = OUTPUTS                # stands before the first token


def in_fold(ids: np.ndarray, valid: np.ndarray, folds: int, held_out: int) -> np.ndarray:
    """Whether the crc32 of each id as text, modulo ``folds``, is the held-out one."""
    return np.array([zlib.crc32(str(i).encode() if v else b"") % folds == held_out for i, v in
                     zip(ids.tolist(), valid.tolist())], bool)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and classes of all tokens, and the place of each text's first one; every text closes with an end."""
    w = words(texts, SPACED)
    n = np.diff(w.first)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    name = np.full(first[-1], END, np.uint64)
    kind = np.zeros(first[-1], np.uint8)
    at = np.arange(len(w.start)) + np.repeat(np.arange(len(texts)), n)
    name[at] = w.hashes()
    kind[at] = classes(w)
    return name, kind, first


def classes(w) -> np.ndarray:
    """The class of each word: its last two bytes before one or two closing characters that are no letters or digits."""
    closing = np.ones(256, bool)
    closing[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
    end = w.end
    for _ in range(2):
        end = end - (closing[w.buf[end - 1]] & (end - 1 > w.start))
    last = w.buf[end - 1].astype(np.uint64)
    before = np.where(end - 2 >= w.start, w.buf[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    return (mix64(last * np.uint64(256) + before) % np.uint64(CLASSES)).astype(np.uint8)


# ---- counts -----------------------------------------------------------------

def _ask_counts(folds: int, held_out: int, buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _ in B.read_blocks(batches):
            b = B.TextBlock(row)
            name, kind, first = tokens(b.texts())
            learn = np.repeat(~in_fold(b.ids, b.valid, folds, held_out), np.diff(first))
            order = np.argsort(name, kind="stable")
            new = np.ones(len(name), bool)
            new[1:] = name[order][1:] != name[order][:-1]
            at = np.flatnonzero(new)
            count = np.add.reduceat(learn[order].astype(np.int64), at)
            unique, kinds = name[order][at], kind[order][at]
            yield from B.ask_batch(
                (k, b.number, 1, B.pack_sorted(unique[s]), B.pack(count[s].astype(np.uint64)), kinds[s].tobytes())
                for k, s in B.cut(B.bucket_of(unique, buckets), buckets))
    return ask


def _answer_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Total counts for all askers; and, as kind 2, what the corpus needs of this range."""
    for kind, rows in B.asked_rows(batches).items():
        each = [B.unpack_sorted(r[3]) for r in rows]
        name, count = np.concatenate(each), np.concatenate([B.unpack(r[4]) for r in rows])
        classes_ = np.concatenate([np.frombuffer(r[5], np.uint8) for r in rows])
        order = np.argsort(name, kind="stable")
        new = np.ones(len(name), bool)
        new[1:] = name[order][1:] != name[order][:-1]
        at = np.flatnonzero(new)
        total = np.add.reduceat(count[order], at)
        back = np.empty(len(name), np.uint64)
        back[order] = total[np.cumsum(new) - 1]
        cut = np.cumsum([0, *map(len, each)])
        yield B.answer_batch(kind, rows, [B.pack(back[x:y]) for x, y in zip(cut, cut[1:])])
        unique, kinds = name[order][at], classes_[order][at]
        known = total > 0
        mass = np.bincount(kinds[known], total[known].astype(np.float64), CLASSES).astype(np.int64)
        distinct = np.bincount(kinds[known], minlength=CLASSES)
        top = np.lexsort((unique, -total.astype(np.int64)))[:HEAD]
        top = top[total[top] > 0]
        packed = np.concatenate([mass, distinct, unique[top].view(np.int64), total[top].astype(np.int64),
                                 kinds[top].astype(np.int64)]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([rows[0][0]], pa.int32()),
                                          pa.array([2], pa.int32()), pa.array([packed], pa.binary())],
                                         names=["block", "bucket", "kind", "code"])


def _merge_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and the largest counts of many ranges in the form of one."""
    mass, names, counts, kinds = np.zeros(2 * CLASSES, np.int64), [], [], []
    for b in batches:
        for raw in b.column("code").to_pylist():
            x = np.frombuffer(raw, "<i8")
            mass = mass + x[:2 * CLASSES]
            top = x[2 * CLASSES:].reshape(3, -1)
            for held, part in zip((names, counts, kinds), top):
                held.append(part)
    if names:
        n, c, k = map(np.concatenate, (names, counts, kinds))
        best = np.lexsort((n.view(np.uint64), -c))[:HEAD]
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([mass, n[best], c[best], k[best]]).tobytes()])], names=["code"])


@dataclass
class Vocabulary:
    """Counts that every task needs: about 8 kB."""

    names: np.ndarray           # of the head, sorted
    output: np.ndarray          # and the output of each
    counts: np.ndarray          # of the outputs
    distinct: np.ndarray        # known words of each class outside the head
    total: int = 0              # N
    known: int = 0              # V

    def outputs(self, name: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The output of every token."""
        out = HEAD + kind.astype(np.int64)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
            out = np.where(self.names[at] == name, self.output[at], out)
        return out


def vocabulary(answers: DataFrame, parts: int) -> Vocabulary:
    rows = answers.filter("kind = 2").select("code").repartition(max(1, int(parts ** 0.5))).mapInArrow(_merge_stats, "code binary")
    merged = list(_merge_stats([pa.RecordBatch.from_arrays([pa.array([bytes(r[0]) for r in rows.collect()], pa.binary())],
                                                           names=["code"])]))
    empty = np.zeros(0, np.int64)
    if not merged:
        return Vocabulary(empty.view(np.uint64), empty, np.zeros(OUTPUTS, np.int64), np.zeros(CLASSES, np.int64))
    x = np.frombuffer(merged[0].column("code")[0].as_py(), "<i8")
    mass, distinct = x[:CLASSES].copy(), x[CLASSES:2 * CLASSES].copy()
    name, count, kind = x[2 * CLASSES:].reshape(3, -1)
    name = name.view(np.uint64)
    total, known = int(mass.sum()), int(distinct.sum())
    np.subtract.at(mass, kind, count)
    np.subtract.at(distinct, kind, 1)
    counts = np.zeros(OUTPUTS, np.int64)
    counts[:len(count)], counts[HEAD:] = count, mass
    order = np.argsort(name)
    return Vocabulary(name[order], order, counts, distinct, total, known)


# ---- the model --------------------------------------------------------------

@dataclass
class Model:
    """Embeddings of context tokens (the last row is the start) and of outputs, place weights and biases."""

    vocabulary: Vocabulary
    p: dict[str, np.ndarray] = field(default_factory=dict)
    seen: dict[str, np.ndarray] = field(default_factory=dict)     # Adagrad's sums of squares

    @staticmethod
    def new(v: Vocabulary, seed: int = 3) -> Model:
        r = np.random.default_rng(seed)
        noise = lambda *s: (0.1 * r.standard_normal(s)).astype(np.float32)
        share = (v.counts + 0.5) / (v.counts.sum() + 0.5 * OUTPUTS)
        m = Model(v, {"in": noise(OUTPUTS + 1, WIDTH), "out": noise(OUTPUTS, WIDTH), "place": np.ones((CONTEXT, WIDTH), np.float32),
                      "bias": np.log(share).astype(np.float32)})
        m.seen = {k: np.full_like(x, 0.1) for k, x in m.p.items()}
        return m

    def predictions(self, context: np.ndarray) -> np.ndarray:
        """Predicted vectors of contexts (columns: the token before, the one before that, ...)."""
        p = self.p["in"]
        out = p[context[:, 0]] * self.p["place"][0]
        for j in range(1, CONTEXT):
            out += p[context[:, j]] * self.p["place"][j]
        return out

    def log_probabilities(self, target: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Natural logs of the normalised probabilities of the target outputs."""
        score = [(self.p["in"] * place) @ self.p["out"].T for place in self.p["place"]]
        score[0] += self.p["bias"]
        score = [x - x.max(1, keepdims=True) for x in score]      # falls out of the quotient
        factor = [np.exp(x) for x in score]
        out = np.empty(len(target), np.float64)
        product, one = (np.empty((ROWS, OUTPUTS), np.float32) for _ in range(2))
        for i in range(0, len(target), ROWS):
            t, c = target[i:i + ROWS], context[i:i + ROWS]
            n = len(t)
            after = [f.take(c[:, j], 0, out=x[:n], mode="clip") for j, (f, x) in enumerate(zip(factor, (product, one)))]
            for j in range(2, CONTEXT):
                after[0] *= after[1]
                factor[j].take(c[:, j], 0, out=one[:n], mode="clip")
            own = sum(x[c[:, j], t].astype(np.float64) for j, x in enumerate(score))
            total = np.einsum("co,co->c", *after).astype(np.float64)
            few = np.flatnonzero(total < LEAST)
            logs = np.log(np.maximum(total, LEAST))
            if len(few):
                s = sum(x[c[few, j]].astype(np.float64) for j, x in enumerate(score))
                most = s.max(1)
                logs[few] = most + np.log(np.exp(s - most[:, None]).sum(1))
            out[i:i + ROWS] = own - logs
        return out

    def train(self, target: np.ndarray, context: np.ndarray, epochs: int, seed: int, rate: float = RATE) -> None:
        """Noise-contrastive estimation, NOISE noise outputs shared by a batch; Adagrad."""
        v = self.vocabulary
        share = (v.counts + 0.5) / (v.counts.sum() + 0.5 * OUTPUTS)
        r, log_noise, p = np.random.default_rng(seed), np.log(NOISE * share).astype(np.float32), self.p
        draw = np.cumsum(share)
        target, context = target.astype(np.int16), context.astype(np.int16)     # sorted by radix
        for _ in range(epochs):
            order = r.permutation(len(target))
            for i in range(0, len(order) - len(order) % BATCH or len(order), BATCH):
                k = order[i:i + BATCH]
                t, c = target[k], context[k]
                noise = np.minimum(np.searchsorted(draw, r.random(NOISE)), OUTPUTS - 1)
                side = np.concatenate([t, noise.astype(np.int16)])
                n = len(t)
                near = p["in"].take(c, 0)
                q = np.einsum("bcw,cw->bw", near, p["place"])
                out, bias = p["out"].take(side, 0), (p["bias"] - log_noise).take(side)
                own = np.einsum("bw,bw->b", q, out[:n]) + bias[:n]
                other = q @ out[n:].T + bias[n:]
                g = 1 / (1 + np.exp(np.clip(own, -30, 30)))              # towards the target
                h = -1 / (1 + np.exp(np.clip(-other, -30, 30)))          # away from the noise
                dq = g[:, None] * out[:n] + h @ out[n:]
                up = np.empty((len(side), WIDTH + 1), np.float32)        # of output embeddings and biases
                np.multiply(g[:, None], q, out=up[:n, :WIDTH])
                np.matmul(h.T, q, out=up[n:, :WIDTH])
                up[:n, WIDTH], up[n:, WIDTH] = g, h.sum(0)
                place = np.einsum("bw,bcw->cw", dq, near)
                rows, grad = _summed(side, lambda by: up.take(by, 0))
                inner, dnear = _summed(c.ravel(), lambda by: dq.take(by // CONTEXT, 0) * p["place"].take(by % CONTEXT, 0))
                self._step("out", rows, grad[:, :WIDTH], rate)
                self._step("bias", rows, grad[:, WIDTH], rate)
                self._step("in", inner, dnear, rate)
                self._step("place", slice(None), place, rate)

    def _step(self, name: str, rows, grad: np.ndarray, rate: float) -> None:
        seen = self.seen[name][rows] + grad * grad
        self.seen[name][rows] = seen
        self.p[name][rows] += rate * grad / np.sqrt(seen)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float64)

    def with_flat(self, x: np.ndarray) -> Model:
        out, at = {}, 0
        for k in sorted(self.p):
            out[k] = x[at:at + self.p[k].size].reshape(self.p[k].shape).astype(np.float32)
            at += self.p[k].size
        return Model(self.vocabulary, out, self.seen)


def _summed(rows: np.ndarray, grad) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of equal rows added up; ``grad`` gives those of the rows at some places."""
    order = np.argsort(rows, kind="stable")
    s = rows[order]
    at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[at], np.add.reduceat(grad(order), at)


def contexts(out: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The CONTEXT outputs before each token, the start standing before the texts."""
    nth = np.arange(len(out)) - np.repeat(first[:-1], np.diff(first))
    c = np.empty((len(out), CONTEXT), np.int32)
    for j in range(CONTEXT):
        c[:, j] = np.where(nth > j, np.concatenate([np.full(j + 1, _START), out])[:len(out)], _START)
    return c


def _learning(v, folds: int, held_out: int, pick=None):
    """Outputs and text borders of the training texts of each block, or of the picked ones among them."""
    def each(batches: Iterator[pa.RecordBatch]):
        for row, _ in B.read_blocks(batches):
            b = B.TextBlock(row)
            learn = ~in_fold(b.ids, b.valid, folds, held_out)
            chosen = np.flatnonzero(learn & pick(mix64(b.ids.view(np.uint64))) if pick else learn)
            if len(chosen):
                texts = b.texts()
                name, kind, first = tokens([texts[i] for i in chosen])
                yield v.value.outputs(name, kind), first
    return each


def _sampling(v, folds: int, held_out: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.uint64(min(int(INIT_TOKENS / max(v.value.total, 1) * 2**64), 2**64 - 1))
        for out, first in _learning(v, folds, held_out, lambda h: h <= limit)(batches):
            yield pa.RecordBatch.from_arrays([pa.array([out.astype("<i2").tobytes()]), pa.array([first.astype("<i8").tobytes()])],
                                             names=["out", "first"])
    return sample


def _refining(model, folds: int, held_out: int):
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, n = model.value.with_flat(model.value.flat()), 0
        m.seen = {k: x.copy() for k, x in m.seen.items()}
        v = type("", (), {"value": m.vocabulary})
        for out, first in _learning(v, folds, held_out)(batches):
            m.train(out, contexts(out, first), 1, len(out), RATE / 2)
            n += len(out)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([(n * m.flat()).tobytes()]), pa.array([n], pa.int64())], names=["sum", "n"])
    return refine


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = 0.0, 0
    for b in batches:
        for raw, k in zip(b.column("sum").to_pylist(), b.column("n").to_pylist()):
            total, n = total + np.frombuffer(raw), n + k
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([n], pa.int64())], names=["sum", "n"])


def fit(blocks: DataFrame, v: Vocabulary, folds: int, held_out: int, parts: int) -> Model:
    """A model of the training texts of written blocks."""
    sc = blocks.sparkSession.sparkContext
    model, rows = Model.new(v), B.with_answers(blocks, [], parts)
    sample = rows.mapInArrow(_sampling(sc.broadcast(v), folds, held_out), "out binary, first binary").collect()
    got = sorted((bytes(r[0]), bytes(r[1])) for r in sample)
    if got:
        pairs = [(np.frombuffer(a, "<i2").astype(np.int64), np.frombuffer(f, "<i8")) for a, f in got]
        model.train(np.concatenate([o for o, _ in pairs]), np.concatenate([contexts(o, f) for o, f in pairs]), INIT_EPOCHS, 1)
    refined = rows.mapInArrow(_refining(sc.broadcast(model), folds, held_out), "sum binary, n long")
    # averaged in two steps, so that the driver gets the square root of the tasks' number of models
    sums = refined.repartition(max(1, int(parts ** 0.5))).mapInArrow(_added, "sum binary, n long").collect()
    if sums:
        model = model.with_flat(sum(np.frombuffer(bytes(r[0])) for r in sums) / sum(r[1] for r in sums))
    return model


# ---- scores -----------------------------------------------------------------

def _scoring(model, folds: int, held_out: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        v = m.vocabulary
        for row, answers in B.read_blocks(batches):
            b = B.TextBlock(row)
            name, kind, first = tokens(b.texts())
            unique, of = np.unique(name, return_inverse=True)
            count = np.concatenate([B.unpack(x) for x in answers[1]])[of].astype(np.float64)
            out = v.outputs(name, kind)
            lp = m.log_probabilities(out, contexts(out, first))
            tail = out >= HEAD
            k = out[tail] - HEAD
            lp[tail] += np.log((count[tail] + 1) / (v.counts[HEAD:][k] + v.distinct[k] + 1))
            base = np.log10((count + 1) / (v.total + v.known + 1))
            known = (count > 0).astype(np.int64)
            ids = pa.array(b.ids, pa.int64(), mask=b.valid == 0)
            held = in_fold(b.ids, b.valid, folds, held_out)
            add = lambda x: np.add.reduceat(x, first[:-1])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(held), pa.array(np.diff(first), pa.int64()), pa.array(add(known), pa.int64()),
                 pa.array(np.full(len(held), v.total), pa.int64()), pa.array(add(base)), pa.array(add(lp) / np.log(10))],
                names=["doc", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return score


def score_texts(docs: DataFrame, folds: int = 7, held_out: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "lm")
    blocks = scratch.write(B.pack_blocks(docs, key, text, BLOCK), "blocks")
    parts = ranges_for(spark, blocks.agg(F.sum("n_bytes")).first()[0])
    counts = B.exchange(B.with_answers(blocks, [], parts), _ask_counts(folds, held_out, parts), _answer_counts, parts)
    counts = scratch.write(counts, "counts")
    model = fit(blocks, vocabulary(counts, parts), folds, held_out, parts)
    rows = B.with_answers(blocks, [counts.filter("kind = 1")], parts)
    out = rows.mapInArrow(_scoring(spark.sparkContext.broadcast(model), folds, held_out),
                          "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                          "base_score double, score double")
    return out.withColumnRenamed("doc", key)
