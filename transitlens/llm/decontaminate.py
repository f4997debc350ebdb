"""Benchmark decontamination by Wu-Manber search over words.

A benchmark item gives a pattern for every run of ``WINDOW`` consecutive words
(all its words where it has fewer). Patterns are searched by length, the
blocks of the search being two consecutive words (one where the pattern is a
single word). A shift table over hashed blocks tells how far the search may
jump from a position where no pattern can end; where the shift is 0, the
patterns whose last block has that hash are looked up in buckets, and a word
by word comparison of the bytes confirms them. The search runs over many
stretches of text in step, one numpy operation for a jump of all.

Patterns are broadcast in slices of at most ``SLICE_BYTES`` of item text, one
narrow pass over the documents per slice; nothing is shuffled.

Defined cases: null and empty texts have no words, no hits and no items, and
a null or empty item has no pattern; an item id that occurs in several rows
is one item with the patterns of all; a null item id stands as "null"; an
empty benchmark or an empty table of documents gives no hits or no rows;
columns of the documents pass through, but those named like a result (n_words,
hits, item_ids, in any letter case), which the result replaces;
``drop_contaminated`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.scratch import ship_package
from transitlens.llm.word_arrays import ALNUM, mix64, pieces, utf8, words

WINDOW = 10
SLICE_BYTES = 16 << 20   # item text in one broadcast
TABLE_BITS = 18          # entries of a shift table, as a power of two, at least
STRETCH = 256            # ends that one lane of the search looks at
BATCH_BYTES = 4 << 20    # text searched at a time


def _block(h: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the blocks whose last words are at ``end``."""
    return mix64(h[end - 1] + np.uint64(0x632BE59BD9B4E019) * h[end]) if size == 2 else h[end]


class Patterns:
    """Shift table, suffix buckets and words of all patterns of one length."""

    def __init__(self, length: int, grams: dict[tuple[bytes, ...], set[int]]):
        self.length, self.size = length, min(2, length)
        self.grams, self.items = list(grams), list(grams.values())
        w = words([b" ".join(g) for g in self.grams], ALNUM, lower=False)
        self.hashes = w.hashes().reshape(-1, length)
        bits = max(TABLE_BITS, int(len(self.grams) * length).bit_length() + 2)
        self.mask = np.uint64((1 << bits) - 1)
        # no block seen: jump by the pattern's length less the block's, plus one
        self.shift = np.full(1 << bits, length - self.size + 1, np.int32)
        flat, rows = self.hashes.ravel(), np.arange(len(self.grams)) * length
        for at in range(self.size - 1, length):
            np.minimum.at(self.shift, (_block(flat, rows + at, self.size) & self.mask).astype(np.int64), length - 1 - at)
        last = _block(flat, rows + length - 1, self.size)
        self.order = np.argsort(last, kind="stable")
        self.last = last[self.order]

    def ends(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Positions where the shift is 0, in texts whose words are h[first[t]:first[t + 1]]."""
        lo, hi = first[:-1] + self.length - 1, first[1:]
        lanes = np.maximum(-(-(hi - lo) // STRETCH), 0)
        text = np.repeat(np.arange(len(lo)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = lo[text] + nth * STRETCH
        stop = np.minimum(pos + STRETCH, hi[text])
        found = []
        while len(pos):
            step = self.shift[(_block(h, pos, self.size) & self.mask).astype(np.int64)]
            hit = step == 0
            found.append(pos[hit])
            pos = pos + np.maximum(step, 1)
            on = pos < stop
            pos, stop = pos[on], stop[on]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def matches(self, w, h: np.ndarray) -> list[tuple[int, int]]:
        """(place of the first word, pattern) of every occurrence."""
        end = self.ends(h, w.first)
        if not len(end):
            return []
        block = _block(h, end, self.size)
        a, b = np.searchsorted(self.last, block, "left"), np.searchsorted(self.last, block, "right")
        n = b - a
        at = np.repeat(end, n) - self.length + 1
        which = self.order[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        same = np.ones(len(at), bool)
        for k in range(self.length):     # hashes sort out all but true occurrences before bytes are compared
            live = np.flatnonzero(same)
            same[live] = h[at[live] + k] == self.hashes[which[live], k]
        return [(i, p) for i, p in zip(at[same].tolist(), which[same].tolist())
                if all(w.word(i + k) == self.grams[p][k] for k in range(self.length))]


def compile_patterns(texts: list[bytes], window: int = WINDOW) -> list[Patterns]:
    """The patterns of items, item i being texts[i], by length."""
    by: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
    w = words(texts, ALNUM)
    for i in range(len(texts)):
        own = [w.word(k) for k in range(w.first[i], w.first[i + 1])]
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            by.setdefault(n, {}).setdefault(tuple(own[k:k + n]), set()).add(i)
    return [Patterns(n, grams) for n, grams in sorted(by.items())]


def search(texts: list[bytes], patterns: list[Patterns]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[int]]]:
    """Of each text: its number of words, the merged stretches of hit words, the items that occur."""
    w = words(texts, ALNUM)
    h, first = w.hashes(), w.first
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    for p in patterns:
        found = p.matches(w, h)
        of = np.searchsorted(first, [i for i, _ in found], side="right") - 1 if found else []
        for (i, which), t in zip(found, of):
            spans[t].append((i - int(first[t]), i - int(first[t]) + p.length))
            items[t] |= p.items[which]
    return np.diff(first), [merged(s) for s in spans], items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


RESULTS = ("n_words", "hits", "item_ids")


def _slices(items: DataFrame) -> Iterator[tuple[list[str], list[bytes]]]:
    """The benchmark in slices that are small enough to broadcast, one after the other."""
    ids, texts, held = [], [], 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"),
                        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("t"))
    for r in rows.toLocalIterator():
        if held and held + len(r["t"]) > SLICE_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(r["id"])
        texts.append(bytes(r["t"]))
        held += len(r["t"])
    yield ids, texts


def find_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, hits (stretches of hit words) and item_ids (of the items that occur, sorted) for any columns of these names."""
    ship_package(docs.sparkSession)
    names, sc = docs.columns, docs.sparkSession.sparkContext
    at = names.index(text)
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    result = [T.StructField("n_words", T.LongType()),
              T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
              T.StructField("items", T.ArrayType(T.StringType()))]
    d = docs.toDF(*[f.name for f in fields]) \
        .withColumns({"n_words": F.lit(None).cast("long"), "hits": F.lit(None).cast("array<array<bigint>>"),
                      "items": F.lit(None).cast("array<string>")})
    for ids, texts in _slices(items):
        known = sc.broadcast((ids, compile_patterns(texts, window)))

        def scan(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            ids, patterns = known.value
            for batch in batches:
                col = utf8(batch.column(at))
                for a, b in pieces([len(x) for x in col], BATCH_BYTES):
                    part = batch.slice(a, b - a)
                    n, spans, found = search(col[a:b], patterns)
                    old = part.column("hits").to_pylist(), part.column("items").to_pylist()
                    spans = [merged(s + [tuple(x) for x in o or []]) for s, o in zip(spans, old[0])]
                    found = [sorted({ids[i] for i in s} | set(o or [])) for s, o in zip(found, old[1])]
                    kinds = [part.schema.field(k).type for k in ("hits", "items")]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:len(fields)], pa.array(n, pa.int64()),
                         pa.array([[list(x) for x in s] for s in spans], kinds[0]), pa.array(found, kinds[1])],
                        names=part.schema.names)

        d = d.mapInArrow(scan, T.StructType(fields + result))
    hits = F.transform("hits", lambda s: F.struct(s[0].alias("start"), s[1].alias("end")))
    return d.select(*[F.col(f.name).alias(n) for f, n in zip(fields, names) if n.lower() not in RESULTS],
                    "n_words", hits.alias("hits"), F.col("items").alias("item_ids"))


def hit_digest(found: DataFrame) -> list:
    """n_words, n_hit, n_items, items_sha256 and contaminated from the columns of :func:`find_benchmark`."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return [F.col("n_words"), n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated")]


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text).alias("__t"))
    return find_benchmark(inner, items, "__t").filter(F.size("hits") == 0).select("__row.*")
