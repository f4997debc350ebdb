"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Ranks of positions are built by doubling: the rank
of the 8 bytes at a position is their value; the rank of 16, 24, 32 and 50
bytes is the name of a pair of ranks at offsets 8, 8, 16 and 18. Inside a
document the pairs are named where they stand; across documents, Spark deals
(rank, position) pairs by ranges of the rank, every range is sorted, ranks
that occur in one document only are dropped, and the others go on to the next
length:

1. Positions. Of each window of ``LENGTH`` bytes, the position with the least
   24-byte rank in it stands for it: about one position in 14. Equal windows
   have equal positions, so nothing is lost, and a position stands for a run
   of neighbouring windows.
2. Length 24: sorted (rank, block) pairs; positions with a unique rank end.
3. The whole run: sorted (rank, rank of the run, document). A run that a
   smaller document has too is settled; so is a rank all of whose documents
   have the same run, and the first document of every rank.
4. Length 50: the runs that are left are sorted window by window. Ranks that
   more than ``HOT`` documents share skip step 3 and are sorted by window at
   once, each window at most once per block, so that a passage of a third of
   all documents is spread over all tasks.

Documents are packed into blocks of about ``BLOCK`` bytes, and a block sends a
rank at most once to a range and gets one small code back for it; what comes
back meets the block again by its number. The ranks of the last round are 128
bits wide, those of the run 64 on top of the 64 of the position; those of step
2 are cut to what the corpus needs (see ``rank_bits``), since a false partner
there is only looked at again.

Defined cases: null and empty texts have 0 bytes and the digest of nothing;
texts shorter than ``LENGTH`` lose nothing; a repeat inside one document, or
in rows with the same id, is kept; a null id counts as larger than all others;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.scratch import Scratch, ranges_for, ship_package
from transitlens.llm.text_blocks import (  # noqa: F401
    NULL_ID, TextBlock, answer_batch, ask_batch, asked_rows, bucket_of, cut, exchange, pack, pack_blocks, pack_sorted,
    read_blocks, unpack, unpack_sorted, with_answers)
from transitlens.llm.word_arrays import mix64

LENGTH = 50
SEED = 24                # bytes of the rank that chooses positions
SPAN = LENGTH - SEED + 1
BLOCK = 2 << 20          # bytes of text in a block; a longer text is a block of its own
STEP = 1 << 17           # window starts handled by one numpy operation
HOT = 2_000              # documents that share a rank before it is dealt by window
SPARE_BITS = 16          # a false partner in step 2 has a chance of 2 ^ -SPARE_BITS

_POS = np.uint64((1 << 18) - 1)     # STEP + LENGTH positions fit


def _name(a: np.ndarray, b: np.ndarray, c1: int = 0x9E3779B97F4A7C15, c2: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Names of pairs of ranks: one-to-one in either of them."""
    x = a ^ (a >> np.uint64(32))
    x *= np.uint64(c1)
    x += b
    x ^= x >> np.uint64(31)
    x *= np.uint64(c2)
    x ^= x >> np.uint64(29)
    return x


def _rank8(buf: np.ndarray, n: int) -> np.ndarray:
    """The values of the 8 bytes at positions 0 to n - 1 of a buffer with 8 bytes more than n, rounded up to 8."""
    m = -(-n // 8)
    out = np.empty(m * 8, np.uint64)
    for k in range(8):
        out[k::8] = buf[k:k + m * 8].view("<u8")
    return out[:n]


class Runs:
    """Positions of a block with the runs of windows they stand for.

    ``seed``: the 24-byte rank at the position; windows start at ``first`` to
    ``last``; ``run``: the rank of all they cover; ``doc``: the number of the
    document in the block.
    """

    def __init__(self, data: bytes, sizes: np.ndarray):
        self.buf = np.frombuffer(data + bytes(LENGTH + 16), np.uint8)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        parts = [self._piece(*p) for p in _steps(begins.tolist(), ends.tolist())]
        cols = list(zip(*parts)) if parts else [[np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64, np.uint64)]
        self.seed, self.first, self.last, self.run = map(np.concatenate, cols)
        self.doc = np.searchsorted(ends, self.first, side="right")

    def _piece(self, a: int, b: int, bounds: list[int]):
        """Window starts a to b - 1; documents inside end at ``bounds``."""
        n = b - a + LENGTH
        buf = self.buf[a:a + n + 16]
        r8 = _rank8(buf, n)
        r16 = _name(r8[:-8], r8[8:])
        r24 = _name(r16[:-8], r16[8:])
        m = (r24 & ~_POS) | np.arange(len(r24), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        m = np.minimum(m[:len(m) - (SPAN - width)], m[SPAN - width:])[:b - a]
        good = np.ones(b - a, bool)
        for e in bounds:
            good[max(e - LENGTH + 1 - a, 0):e - a] = False
        start = np.flatnonzero(good)
        at = (m[start] & _POS).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        stop = np.append(new[1:], len(at)) - 1 if len(at) else new
        first, last, at = start[new], start[stop], at[new]
        long_ = lambda p: _name(_name(r16[p], r16[p + 16]), _name(r16[p + 32], r16[p + 34]))
        shape = ((last - first) * 64 + at - first).astype(np.uint64)
        # chosen ranks are small ones: scrambled, they fill all ranges alike
        return mix64(r24[at]), first + a, last + a, _name(_name(long_(first), long_(last)), shape)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All window starts of some runs, and the run (its number in ``which``) of each."""
        n = (self.last - self.first + 1)[which]
        of = np.repeat(np.arange(len(which)), n)
        return self.first[which][of] + np.arange(len(of)) - (np.cumsum(n) - n)[of], of


def _steps(begins: list[int], ends: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """Ranges of window starts of about STEP, with the ends of the documents in them; long documents are cut."""
    a, bounds = None, []
    for x, y in zip(begins, ends):
        if a is not None and y - a > STEP:
            yield a, bounds[-1], bounds
            a, bounds = None, []
        if y - x > STEP:
            for z in range(x, y, STEP):
                yield z, min(z + STEP, y), [y]
        else:
            a = x if a is None else a
            bounds.append(y)
    if a is not None:
        yield a, bounds[-1], bounds


def window_ranks(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit ranks of the LENGTH bytes at ascending places of a buffer with 16 bytes to spare."""
    x, y = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    for i in range(0, len(at), STEP):
        some = at[i:i + STEP]
        lo = int(some.min())
        n = int(some.max()) + LENGTH - lo
        r8 = _rank8(buf[lo:], n)
        p = some - lo
        x[i:i + STEP] = y[i:i + STEP] = r8[p]
        for k in (8, 16, 24, 32, 40, 42):
            w = r8[p + k]
            x[i:i + STEP] = _name(x[i:i + STEP], w)
            y[i:i + STEP] = _name(y[i:i + STEP], w, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
    return x, y


def rank_bits(corpus_bytes: int) -> int:
    """Bits of the ranks of step 2: SPARE_BITS more than it takes to number the positions."""
    return min(60, max(40, int(corpus_bytes // 8 + 1).bit_length() + SPARE_BITS))


def _ids(docs: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned numbers in the same order."""
    return docs.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def pack_ids(docs: np.ndarray) -> bytes:
    u = _ids(docs)
    low = u.min() if len(u) else np.uint64(0)
    return int(low).to_bytes(8, "little") + pack(u - low)


def unpack_ids(raw: bytes) -> np.ndarray:
    return unpack(raw[8:]) + np.uint64(int.from_bytes(raw[:8], "little"))


# ---- blocks -----------------------------------------------------------------

class Block(TextBlock):
    """One block with what came back for it so far, and what it asks in each round."""

    def __init__(self, row: dict, bits: int):
        super().__init__(row)
        self.runs = Runs(self.data, self.sizes)
        self.bits = bits
        self.doc = self.ids[self.runs.doc]
        # ranks of step 2 in order, one per rank, and the rank of each run among them
        short = (self.runs.seed >> np.uint64(64 - bits)) << np.uint64(64 - bits)
        self.order = np.lexsort((self.doc, short))
        s, d = short[self.order], self.doc[self.order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        self.ranks = s[new]
        self.rank_of = np.empty(len(s), np.int64)
        self.rank_of[self.order] = np.cumsum(new) - 1
        changes = new.copy()
        changes[1:] |= d[1:] != d[:-1]
        self.docs_of = np.bincount((np.cumsum(new) - 1)[changes], minlength=len(self.ranks))

    def ask_ranks(self, buckets: int) -> Iterator[tuple]:
        for k, s in cut(bucket_of(self.ranks, buckets), buckets):
            yield (k, self.number, 1, pack_sorted(self.ranks[s] >> np.uint64(64 - self.bits)),
                   np.minimum(self.docs_of[s], 255).astype(np.uint8).tobytes(), b"")

    def take_ranks(self, code: np.ndarray) -> None:
        """Codes of step 2: 0 in one document only, 1 shared, 2 shared by very many."""
        mine = code[self.rank_of] if len(code) else np.zeros(0, np.uint8)
        shared = np.flatnonzero(mine == 1)
        r = self.runs
        self.shared = shared[np.lexsort((self.doc[shared], r.run[shared], r.seed[shared]))]
        seed, run = r.seed[self.shared], r.run[self.shared]
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (run[1:] != run[:-1])
        self.own = self.shared[new]                         # the smallest document's run of each kind
        self.own_of = np.cumsum(new) - 1
        hot = np.flatnonzero(mine == 2)
        self.hot_at, of = r.windows(hot)
        self.hot_doc = self.doc[hot][of]
        if len(hot):
            x, y = window_ranks(r.buf, self.hot_at)
            self.hot_order = np.lexsort((self.hot_doc, y, x))
            x, y = x[self.hot_order], y[self.hot_order]
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            self.hot_own, self.hot_of, self.hot_rank = self.hot_order[new], np.cumsum(new) - 1, (x[new], y[new])

    def ask_runs(self, buckets: int) -> Iterator[tuple]:
        r = self.runs
        for k, s in cut(bucket_of(r.seed[self.own], buckets), buckets):
            own = self.own[s]
            yield k, self.number, 2, pack_sorted(r.seed[own]), pack(r.run[own]), pack_ids(self.doc[own])

    def take_runs(self, code: np.ndarray) -> None:
        """Codes of step 3: 0 nothing to remove, 1 all removed, 2 to be seen window by window."""
        self.run_code = code
        self.left = self.own[code == 2] if len(code) else np.zeros(0, np.int64)

    def ask_windows(self, buckets: int) -> Iterator[tuple]:
        r, z = self.runs, zstandard.ZstdCompressor(3)
        for k, s in cut(bucket_of(r.seed[self.left], buckets), buckets):
            own = self.left[s]
            n = (r.last - r.first + 1)[own]
            raw = b"".join(self.data[a:b + LENGTH] for a, b in zip(r.first[own].tolist(), r.last[own].tolist()))
            yield k, self.number, 3, z.compress(raw), n.astype(np.uint8).tobytes(), pack_ids(self.doc[own])
        if len(self.hot_at):
            x, y = self.hot_rank
            for k, s in cut(bucket_of(x, buckets), buckets):
                yield (k, self.number, 4, pack_sorted(x[s]), np.ascontiguousarray(y[s], "<u8").tobytes(),
                       pack_ids(self.hot_doc[self.hot_own[s]]))

    def removed(self, window_code: np.ndarray, hot_code: np.ndarray) -> np.ndarray:
        """Whether each byte goes. Codes of step 4, a window each: whether a smaller document has it."""
        r = self.runs
        diff = np.zeros(len(self.data) + 1, np.int32)

        def cover(first: np.ndarray, last: np.ndarray) -> None:
            np.add.at(diff, first, 1)
            np.add.at(diff, last + LENGTH, -1)

        if len(self.shared):
            later = self.doc[self.shared] > self.doc[self.own][self.own_of]    # the block itself has a smaller one
            whole = self.shared[later | (self.run_code[self.own_of] == 1)]
            cover(r.first[whole], r.last[whole])
            if len(self.left):
                # a run of the smallest document may stand there more than once in that document
                kind = np.full(len(self.own), -1)
                kind[self.run_code == 2] = np.arange(len(self.left))
                n = (r.last - r.first + 1)[self.left]
                begin = np.cumsum(n) - n
                part = np.flatnonzero(~later & (self.run_code[self.own_of] == 2))
                at, of = r.windows(self.shared[part])
                k = kind[self.own_of[part]][of]
                gone = window_code[begin[k] + at - r.first[self.shared[part]][of]] == 1
                cover(at[gone], at[gone])
        if len(self.hot_at):
            d = self.hot_doc[self.hot_order]
            gone = (d > self.hot_doc[self.hot_own][self.hot_of]) | (hot_code[self.hot_of] == 1)
            at = self.hot_at[self.hot_order][gone]
            cover(at, at)
        return np.cumsum(diff[:-1]) > 0


# ---- rounds -----------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[Block, dict[int, np.ndarray]]]:
    for row, codes in read_blocks(batches):
        yield Block(row, bits), {k: np.frombuffer(b"".join(v), np.uint8) for k, v in codes.items()}


_NONE = np.zeros(0, np.uint8)


def _asking(step: int, bits: int, buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, codes in _blocks(batches, bits):
            rows = block.ask_ranks(buckets)
            if step > 1:
                block.take_ranks(codes.get(1, _NONE))
                rows = block.ask_runs(buckets)
            if step > 2:
                block.take_runs(codes.get(2, _NONE))
                rows = block.ask_windows(buckets)
            yield from ask_batch(rows)
    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All that blocks ask of one range of ranks -> a code for each rank that each block named."""
    for kind, rows in asked_rows(batches).items():
        codes, sizes = _CODES[kind](rows)
        at = np.concatenate([[0], np.cumsum(sizes)])
        yield answer_batch(kind, rows, [codes[x:y].tobytes() for x, y in zip(at, at[1:])])


def _firsts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _rank_codes(rows: list[tuple]):
    each = [unpack_sorted(r[3]) for r in rows]
    rank = np.concatenate(each)
    docs = np.concatenate([np.frombuffer(r[4], np.uint8) for r in rows]).astype(np.int64)
    order = np.argsort(rank, kind="stable")
    new = _firsts(rank[order])
    total = np.add.reduceat(docs[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    code = np.empty(len(rank), np.uint8)
    code[order] = (total > 1).astype(np.uint8) + (total > HOT)
    return code, [len(x) for x in each]


def _run_codes(rows: list[tuple]):
    each = [unpack_sorted(r[3]) for r in rows]
    seed, run = np.concatenate(each), np.concatenate([unpack(r[4]) for r in rows])
    doc = np.concatenate([unpack_ids(r[5]) for r in rows])
    order = np.lexsort((doc, run, seed))
    seed, run, d = seed[order], run[order], doc[order]
    of_run = np.cumsum(_firsts(seed, run)) - 1
    first = d[np.flatnonzero(_firsts(seed, run))][of_run]           # smallest document with this run
    new = _firsts(seed)
    low = np.minimum.reduceat(d, np.flatnonzero(new))               # and with this rank
    of = np.cumsum(new) - 1
    open_ = np.zeros(len(low), bool)
    open_[of[first > low[of]]] = True
    code = np.empty(len(seed), np.uint8)
    code[order] = np.where(d > first, 1, np.where(open_[of], 2, 0))
    return code, [len(x) for x in each]


def _window_codes(rows: list[tuple]):
    z = zstandard.ZstdDecompressor()
    n = [np.frombuffer(r[4], np.uint8).astype(np.int64) for r in rows]
    buf = np.frombuffer(b"".join(z.decompress(r[3]) for r in rows) + bytes(LENGTH + 16), np.uint8)
    each = np.concatenate(n)
    size = each + LENGTH - 1
    at = np.repeat(np.cumsum(size) - size, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    doc = np.repeat(np.concatenate([unpack_ids(r[5]) for r in rows]), each)
    return _smaller(*window_ranks(buf, at), doc), [int(x.sum()) for x in n]


def _hot_codes(rows: list[tuple]):
    each = [unpack_sorted(r[3]) for r in rows]
    second = np.concatenate([np.frombuffer(r[4], "<u8") for r in rows])
    return _smaller(np.concatenate(each), second, np.concatenate([unpack_ids(r[5]) for r in rows])), [len(x) for x in each]


def _smaller(x: np.ndarray, y: np.ndarray, doc: np.ndarray) -> np.ndarray:
    order = np.lexsort((doc, y, x))
    new = _firsts(x[order], y[order])
    d = doc[order]
    code = np.empty(len(x), np.uint8)
    code[order] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return code


_CODES = {1: _rank_codes, 2: _run_codes, 3: _window_codes, 4: _hot_codes}


def _finishing(bits: int, with_text: bool):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, codes in _blocks(batches, bits):
            block.take_ranks(codes.get(1, _NONE))
            block.take_runs(codes.get(2, _NONE))
            gone = block.removed(codes.get(3, _NONE), codes.get(4, _NONE))
            buf, rows, a = np.frombuffer(block.data, np.uint8), [], 0
            for doc, ok, n in zip(block.ids.tolist(), block.valid.tolist(), block.sizes.tolist()):
                g = gone[a:a + n]
                removed = int(g.sum())
                spans = int((g[1:] & ~g[:-1]).sum()) + int(g[:1].sum()) if removed else 0
                kept = buf[a:a + n][~g].tobytes() if removed else block.data[a:a + n]
                rows.append((doc if ok else None, n, removed, spans, hashlib.sha256(kept).hexdigest(),
                             kept if with_text else None))
                a += n
            c = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int64()) for x in c[:4]], pa.array(c[4], pa.string()), pa.array(c[5], pa.binary())],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return finish


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 and, where asked for, the kept bytes of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "repeats")
    blocks = scratch.write(pack_blocks(docs, key, text, BLOCK), "blocks")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    bits, buckets = rank_bits(total), ranges_for(spark, total)
    answers: list[DataFrame] = []
    for step in (1, 2, 3):
        asking = with_answers(blocks, answers, buckets)
        answers.append(scratch.write(exchange(asking, _asking(step, bits, buckets), _answer, buckets), f"answers-{step}"))
    out = with_answers(blocks, answers, buckets).mapInArrow(_finishing(bits, with_text), "doc long, n_bytes long, n_removed long, n_spans long, "
                                                             "kept_sha256 string, kept binary")
    return out.select(F.col("doc").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      *(["kept"] if with_text else []))
