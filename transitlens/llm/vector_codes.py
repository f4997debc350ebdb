"""Product codes of vectors, with pruned exact assignment (LAESA).

Components become integers, vectors are cut into PARTS equal parts, and every
part position has a codebook of ENTRIES entries, refined in rounds: each part
goes to its nearest entry, each entry becomes the mean of its parts, rounded
down. All distances and means are exact integers.

The search for the nearest entry follows LAESA. A part's distances to a few
fixed pivots are computed once, before the first round, and stored beside the
vectors. In a round only the distances between entries and pivots are new: the
greatest difference between a part's and an entry's distance to a pivot is a
lower bound of their distance. Entries are tried in the order of these bounds
and a part is done when the next bound exceeds its best distance. Bounds are
floating point and lowered by more than their error; what isn't pruned is
decided by integer distances, ties by the lower index.

Spark reads the stored vectors once a round; a task sends its sums for each
entry, split into 32-bit limbs so that they add up exactly at any size, and
the driver gets PARTS x ENTRIES sums, a number that depends on the width of
the vectors alone.

Defined cases: rows whose vector is null or holds a null, infinite or
not-a-number component go; a null id stays, as the greatest; vectors of
different lengths, or of a length that PARTS doesn't divide, are filled with
zeros to the least multiple that holds the longest; an empty vector is all
zeros; with fewer than ENTRIES vectors the codebooks have as many entries;
rows with equal ids stay apart, those first in the order of their vectors
start the codebooks; components too large for 64-bit squares are worked on as
unbounded integers, without pivots; errors beyond a
long are null, and so is their label's; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.scratch import Scratch, ship_package

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4               # pivots of a part position
SLACK = 1e-12            # by this share of the two distances their difference is lowered
LABELS = 400_000         # labels that are broadcast at most; more are joined by a shuffle
SALTS = 32               # parts of a label in that join


def whole_number(x: float) -> int:
    """floor(SCALE * x), exactly."""
    return math.floor(x * SCALE) if abs(x) < 2.0 ** 60 else int(x) * SCALE


def as_integers(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as integers (rows, PARTS, width / PARTS): 64-bit ones, or Python's where squares would be too large."""
    sizes = np.array(column.value_lengths(), np.int64)
    flat = np.array(column.flatten(), np.float64)
    if (sizes != width).any():
        rows = np.repeat(np.arange(len(sizes)), sizes)
        filled = np.zeros((len(sizes), width))
        filled[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        flat = filled
    flat = flat.reshape(len(sizes), width)
    if small(float(np.abs(flat).max(initial=0)) * SCALE, width):
        out = np.floor(flat * SCALE).astype(np.int64)
    else:
        out = np.array([whole_number(x) for x in flat.ravel().tolist()], object)
    return out.reshape(len(sizes), PARTS, width // PARTS)


def small(largest: float, width: int) -> bool:
    """Whether squared distances between parts of such components are far from leaving 64 bits."""
    return largest < 2.0 ** 29 / math.sqrt(max(width // PARTS, 1))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    d = a - b
    return (d * d).sum(axis=-1) if d.shape[-1] else np.zeros(d.shape[:-1], np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances as floating point; not a number where integers are unbounded."""
    s = squares(a, b)
    return np.full(s.shape, np.nan) if s.dtype == object else np.sqrt(s.astype(np.float64))


def choose_pivots(start: np.ndarray) -> np.ndarray:
    """PIVOTS entries of each codebook (entries, PARTS, d) that lie far from each other, as (pivots, PARTS, d)."""
    out = []
    for p in range(PARTS):
        e, taken = start[:, p], [0]
        while len(taken) < min(PIVOTS, len(e)):
            near = np.min([squares(e, e[i]) for i in taken], axis=0)
            taken.append(int(np.argmax(near)))
        out.append(e[taken])
    return np.stack(out, axis=1)


def nearest(parts: np.ndarray, near: np.ndarray, entries: np.ndarray, entry_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of parts (n, d): the nearest entry's index, the squared distance to it, and how many distances were computed.

    ``near`` (n, pivots) and ``entry_near`` (entries, pivots) are the distances to the pivots.
    """
    a, b = near[:, None, :], entry_near[None, :, :]
    bound = np.nan_to_num(np.abs(a - b) - SLACK * (a + b)).max(axis=2, initial=0.0) ** 2 * (1 - SLACK)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    index = order[:, 0].copy()
    best = squares(parts, entries[index])
    alive, tried = np.arange(len(parts)), len(parts)
    for step in range(1, len(entries)):
        alive = alive[bound[alive, step] <= best[alive].astype(np.float64)]
        if not len(alive):
            break
        e = order[alive, step]
        d = squares(parts[alive], entries[e])
        tried += len(alive)
        better = (d < best[alive]) | (d == best[alive]) & (e < index[alive])
        best[alive[better]], index[alive[better]] = d[better], e[better]
    return index, best, tried


@dataclass
class Codebooks:
    """entries (ENTRIES, PARTS, d) and the fixed pivots (pivots, PARTS, d), as integers."""

    entries: np.ndarray
    pivots: np.ndarray
    width: int

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place."""
        return hashlib.sha256(",".join(str(x) for x in self.entries.swapaxes(0, 1).ravel().tolist()).encode()).hexdigest()

    def assign(self, ints: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Codes (n, PARTS), squared distances summed over the parts, and how many distances were computed."""
        codes, errors, tried = np.empty(ints.shape[:2], np.uint8), 0, 0
        entries = self.entries if ints.dtype == self.entries.dtype else self.entries.astype(object)
        ints = ints if ints.dtype == entries.dtype else ints.astype(object)
        for p in range(PARTS):
            at = distances(entries[:, None, p], self.pivots[None, :, p])
            codes[:, p], best, n = nearest(ints[:, p], near[:, p], entries[:, p], at)
            errors, tried = errors + best, tried + n
        return codes, errors, tried


def _start(rows: list[list[float]], width: int) -> np.ndarray:
    return as_integers(pa.array(rows, pa.list_(pa.float64())), width)


def _near(column: pa.Array, parts: int) -> np.ndarray:
    flat = np.array(column.flatten(), np.float64)
    return flat.reshape(len(column), PARTS, parts)


def _with_pivots(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The vectors with the distances between their parts and the pivots."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ints = as_integers(b.column("v"), books.width)
            near = distances(ints[:, :, None], books.pivots.swapaxes(0, 1)[None])
            offsets = pa.array(np.arange(len(ints) + 1) * near.shape[1] * near.shape[2], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(offsets, pa.array(near.ravel(), pa.float64()))],
                                             names=[*b.schema.names, "near"])

    return vectors.mapInArrow(measured, T.StructType([*vectors.schema, T.StructField("near", T.ArrayType(T.DoubleType()))]))


def _limbs(x: int) -> Iterator[tuple[int, int]]:
    """An integer as (place, 32-bit limb), the last one with the sign."""
    k = 0
    while not -(1 << 31) <= x < 1 << 31:
        yield k, x & 0xFFFFFFFF
        x, k = x >> 32, k + 1
    yield k, x


def _refined(stored: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks of the next round."""
    d, k = books.width // PARTS, len(books.entries)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last component is the number of parts
        sums = np.zeros((k, PARTS, d + 1), object)
        for b in batches:
            ints = as_integers(b.column("v"), books.width)
            codes, _, _ = books.assign(ints, _near(b.column("near"), len(books.pivots)))
            for p in range(PARTS):
                for e in np.unique(codes[:, p]).tolist():
                    of = ints[codes[:, p] == e, p]
                    sums[e, p, :d] += of.sum(axis=0)
                    sums[e, p, d] += len(of)
        rows = [(e, p, c, place, limb) for e in range(k) for p in range(PARTS) for c in range(d + 1)
                if sums[e, p, d] for place, limb in _limbs(int(sums[e, p, c]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int32()] * 4 + [pa.int64()])],
                                         names=["entry", "part", "comp", "place", "limb"])

    places = ["entry", "part", "comp", "place"]
    sums = stored.mapInArrow(summed, "entry int, part int, comp int, place int, limb long").groupBy(*places).agg(F.sum("limb").alias("limb"))
    total = np.zeros((k, PARTS, d + 1), object)
    for e, p, c, place, limb in sums.collect():
        total[e, p, c] += limb << 32 * place
    entries = books.entries.astype(object)
    for e in range(k):
        for p in range(PARTS):
            if total[e, p, d]:
                entries[e, p] = [x // total[e, p, d] for x in total[e, p, :d]]
    if books.entries.dtype != object:
        entries = entries.astype(np.int64)
    return Codebooks(entries, books.pivots, books.width)


def kept_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector and all of its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))


def encode_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """key, label, code (PARTS bytes) and error of every kept row, and the codebooks (None without any row)."""
    spark = rows.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "vectors")
    kept = kept_vectors(rows, vector).select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v"))
    names = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = f"key {names['key']}, label {names['label']}, code binary, error long"
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], schema).withColumnsRenamed({"key": key, "label": label}), None
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    first = kept.orderBy(F.col("key").asc_nulls_last(), "v", "label").limit(ENTRIES).collect()
    entries = _start([r["v"] for r in first], width)
    books = Codebooks(entries, choose_pivots(entries), width)
    stored = scratch.write(_with_pivots(kept, books), "vectors")
    for _ in range(ROUNDS):
        books = _refined(stored, books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, errors, _ = books.assign(as_integers(b.column("v"), books.width), _near(b.column("near"), len(books.pivots)))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("label"), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([int(x) if x < 1 << 63 else None for x in errors.tolist()], pa.int64())], names=["key", "label", "code", "error"])

    codes = scratch.write(stored.mapInArrow(coded, schema), "codes")
    scratch.drop("vectors")
    return codes.withColumnsRenamed({"key": key, "label": label}), books


def with_label_error(codes: DataFrame, label: str = "label", into: str = "label_error") -> DataFrame:
    """The rows with the error summed over all rows of their label; null labels are one."""
    own = F.struct(F.col(label).alias("l"))
    sums = codes.groupBy(own.alias("_own")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.every(F.col("error").isNotNull()).alias("_whole"))
    sums = sums.select("_own", F.when(F.col("_whole"), F.col("_sum").try_cast("long")).alias(into))
    out = codes.withColumn("_own", own)
    if sums.count() <= LABELS:
        return out.join(F.broadcast(sums), "_own").drop("_own")
    salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return out.withColumn("_salt", (F.rand(7) * SALTS).cast("int")).join(salted, ["_own", "_salt"]).drop("_own", "_salt")
