"""Product codes against a plain version, and what the pivots prune."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from rows_util import SMALL, ordered

from transitlens.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, near string, code string, error string, v string"


def plain(rows, parts=8, entries=16, rounds=6):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n) for i, v, n in rows]
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(parts, -(-max((len(r[1]) for r in kept), default=0) // parts) * parts)
    d = width // parts
    whole = [[math.floor(4096 * x) if abs(x) < 2 ** 40 else int(x) * 4096 for x in [*r[1], *[0.0] * (width - len(r[1]))]] for r in kept]
    cut = [[w[p * d:(p + 1) * d] for p in range(parts)] for w in whole]
    book = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(book[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for e in range(len(book[p])):
                own = [c[p] for c, a in zip(cut, at) if a[p][1] == e]
                if own:
                    book[p][e] = [sum(col) // len(own) for col in zip(*own)]
    at = assign()
    errors = [sum(x for x, _ in a) for a in at]
    by_label = {}
    for r, x in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + x
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{i:02x}" for _, i in a), x, by_label[r[2]]) for r, a, x in zip(kept, at, errors)], digest


def coded(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)
    codes, books = vector_codes.encode_vectors(df)
    out = vector_codes.with_label_error(codes).collect()
    return ordered([(r["vec_id"], r["code"].hex(), r["error"], r["label_error"]) for r in out]), books


@pytest.fixture(scope="module")
def vectors():
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()]
    width = len(rows[0][1])
    rng = np.random.default_rng(3)
    some = rng.normal(size=(40, width)).astype(np.float32).tolist()
    odd = [(5000, None, 1), (5001, [None] * width, 1), (5002, [float("nan")] * width, 2), (5003, [1.0] * (width - 1) + [float("inf")], 2)]
    # a third of all rows are copies; ids repeat and are missing
    return rows + odd + [(6000 + i, v, None) for i, v in enumerate(some)] + [(7000, some[0], 3)] * 60 + [(None, some[1], 3), (0, some[2], None)]


def test_codes(spark, vectors):
    want, digest = plain(vectors)
    got, books = coded(spark, vectors)
    assert got == ordered(want)
    assert books.digest() == digest


def test_partitions_do_not_matter(spark, vectors):
    assert coded(spark, vectors, 1)[0] == coded(spark, vectors, 7)[0]


@pytest.mark.parametrize("rows", [
    [(i, [float(i % 3)] * 16, 0) for i in range(5)],                       # fewer vectors than entries, equal ones
    [(1, [], None), (2, [0.5], 1), (3, [0.25] * 11, 1)],                    # lengths that differ and don't divide
    [(i, [(-1.0) ** i * 1e30 * (i + 1)] * 4 + [0.1 * i] * 4, 1) for i in range(20)]])    # beyond 64-bit squares
def test_odd_vectors(spark, rows):
    want, digest = plain(rows)
    got, books = coded(spark, rows)
    fit = all(e < 1 << 63 for _, _, e, _ in want)
    assert got == ordered([(i, c, e if e < 1 << 63 else None, s if fit else None) for i, c, e, s in want])
    assert books.digest() == digest


def test_none(spark):
    codes, books = vector_codes.encode_vectors(spark.createDataFrame([(1, None, 1, "", "", "", "")], SCHEMA))
    assert codes.collect() == [] and books is None
    assert vector_codes.with_label_error(codes).columns == ["vec_id", "label", "code", "error", "label_error"]


def test_many_labels(spark, vectors, monkeypatch):
    """More labels than may be broadcast are joined over salted parts, with the same sums."""
    want = coded(spark, vectors)[0]
    monkeypatch.setattr(vector_codes, "LABELS", 0)
    assert coded(spark, vectors)[0] == want


def test_pivots_prune():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(16, 64)) * 4
    data = (centres[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 64)) * 0.1).ravel()
    ints = vector_codes.as_integers(pa.ListArray.from_arrays(np.arange(3001) * 64, pa.array(data)), 64)
    start = vector_codes.as_integers(pa.array(centres.tolist()), 64)
    books = vector_codes.Codebooks(start, vector_codes.choose_pivots(start), 64)
    near = vector_codes.distances(ints[:, :, None], books.pivots.swapaxes(0, 1)[None])
    codes, errors, tried = books.assign(ints, near)
    every = ((ints[:, None] - start[None]) ** 2).sum(axis=3)
    assert (codes == every.argmin(axis=1)).all() and (errors == every.min(axis=1).sum(axis=1)).all()
    assert tried < 0.3 * every.size
