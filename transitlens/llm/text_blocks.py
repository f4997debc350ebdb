"""Texts packed into numbered blocks, and an exchange of questions and answers between blocks and ranges of ranks.

For work that needs a small answer for very many items of a text: a block
names each distinct item once (sorted, so packed into few bytes), Spark deals
the names by ranges of their rank, a task answers for all blocks that ask in
its range, and the answers meet the block again by its number. Only packed
arrays are shuffled, a hot item counts once per block, and the size of a task
is that of its range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.word_arrays import utf8

NULL_ID = 2**63 - 1
BLOCKS = "block long, ids binary, sizes binary, valid binary, data binary, n_bytes long"
ASK = "bucket int, block long, kind int, a binary, b binary, c binary"
ANSWER = "block long, bucket int, kind int, code binary"
_COLUMNS = ("block", "ids", "sizes", "valid", "data", "n_bytes")


def pack_blocks(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Blocks of about ``size`` bytes of text; a longer text is a block of its own."""
    def pack_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        ids, texts, held = [], [], 0
        z = zstandard.ZstdCompressor(3)

        def flush() -> pa.RecordBatch:
            known = [NULL_ID if i is None else i for i in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array([base + n], pa.int64()), pa.array([np.array(known, "<i8").tobytes()]),
                 pa.array([np.array([len(t) for t in texts], "<i8").tobytes()]),
                 pa.array([bytes(i is not None for i in ids)]), pa.array([z.compress(b"".join(texts))]),
                 pa.array([held], pa.int64())], names=list(_COLUMNS))

        for b in batches:
            for i, t in zip(b.column("doc").to_pylist(), utf8(b.column("text"))):
                if ids and held + len(t) > size:
                    yield flush()
                    ids, texts, held, n = [], [], 0, n + 1
                ids.append(i)
                texts.append(t)
                held += len(t)
        if ids:
            yield flush()

    d = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return d.mapInArrow(pack_, BLOCKS)


class TextBlock:
    """ids (null as NULL_ID), valid (whether the id is known), sizes in bytes, and the joined texts."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.valid = np.frombuffer(row["valid"], np.uint8)
        self.data = zstandard.ZstdDecompressor().decompress(row["data"], max(row["n_bytes"], 1))

    def texts(self) -> list[bytes]:
        ends = np.cumsum(self.sizes)
        return [self.data[a:b] for a, b in zip((ends - self.sizes).tolist(), ends.tolist())]


def with_answers(blocks: DataFrame, answers: list[DataFrame], parts: int) -> DataFrame:
    """Each block followed by what came back for it, in the order of kind and range."""
    own = blocks.select("block", F.lit(0).alias("kind"), F.lit(-1).alias("bucket"),
                        F.lit(None).cast("binary").alias("code"), *_COLUMNS[1:])
    if not answers:
        return own
    nothing = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in _COLUMNS[1:]]
    for a in answers:
        own = own.union(a.select("block", "kind", "bucket", "code", *nothing))
    return own.repartition(parts, "block").sortWithinPartitions("block", "kind", "bucket")


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict[int, list[bytes]]]]:
    """Rows of :func:`with_answers` -> the row of each block and its answers by kind."""
    row, codes = None, {}
    for b in batches:
        kinds = b.column("kind").to_pylist()
        for i, kind in enumerate(kinds):
            if kind == 0:
                if row is not None:
                    yield row, codes
                row, codes = {c: b.column(c)[i].as_py() for c in _COLUMNS}, {}
            else:
                codes.setdefault(kind, []).append(b.column("code")[i].as_py())
    if row is not None:
        yield row, codes


def ask_batch(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Questions of one block as a batch, none if it has none."""
    c = list(zip(*rows))
    if c:
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(c, (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3))],
            names=["bucket", "block", "kind", "a", "b", "c"])


def asked_rows(batches: Iterator[pa.RecordBatch]) -> dict[int, list[tuple]]:
    """All questions (bucket, block, kind, a, b, c) of a task, by kind."""
    asked: dict[int, list[tuple]] = {}
    for b in batches:
        for r in zip(*[b.column(c).to_pylist() for c in ("bucket", "block", "kind", "a", "b", "c")]):
            asked.setdefault(r[2], []).append(r)
    return asked


def answer_batch(kind: int, rows: list[tuple], codes: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
         pa.array([kind] * len(rows), pa.int32()), pa.array(codes, pa.binary())],
        names=["block", "bucket", "kind", "code"])


def exchange(asking: DataFrame, ask: Callable, answer: Callable, buckets: int) -> DataFrame:
    """Blocks ask, ranges answer."""
    return asking.mapInArrow(ask, ASK).repartitionById(buckets, "bucket").mapInArrow(answer, ANSWER)


# ---- packing ----------------------------------------------------------------

def pack(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers in as few whole bytes each as the largest needs."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0])
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :raw[0]] = x
    return out.view("<u8").ravel().astype(np.uint64)


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.concatenate([x[:1], np.diff(x)])) if len(x) else pack(x)


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def bucket_of(rank: np.ndarray, buckets: int) -> np.ndarray:
    """The range of a 64-bit rank."""
    return ((rank >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def cut(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The ranges that sorted ranks fall into, and where."""
    at = np.searchsorted(bucket, np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(at)).tolist():
        yield k, slice(int(at[k]), int(at[k + 1]))
