"""Token ids in binary shards of patched frame-of-reference blocks.

Shard file (little-endian)::

    b"TPF1" | u32 block size
    block*  : u32 minimum | u8 width | u8 exception width | u16 exceptions | u32 values
              | (value - minimum) mod 2^width, packed | u16 position of each exception
              | (value - minimum) >> width of each exception, packed
    index   : u64 file offset of each block
    docs    : i64 doc id | u64 ids up to its end, each as a column, then u8 valid id
    footer  : u64 index offset | u64 blocks | u64 docs | u64 ids | b"TPF1"

The width of a block is what ``PERCENTILE`` per cent of its values need; the
others keep their high bits in the exception list. Blocks run over document
borders. A document is found by its end in the docs table, a range of ids by
the block index, without reading the rest.

Documents are dealt by ranges of their id and sorted, so shards in order of
their first id hold all documents in ascending order. Null ids sort first.

Defined cases: null and empty texts give the end id alone; ties among equal
doc ids keep the order of their texts; an empty table gives no shard and an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitlens.llm.scratch import Scratch, parallelism, ship_package
from transitlens.llm.shared_files import new_file, open_fs
from transitlens.llm.word_arrays import pieces
from transitlens.llm.worker_cache import held

MAGIC = b"TPF1"
BLOCK = 8_192            # ids in a block; at most 65,536
PERCENTILE = 90
READ_BYTES = 4 << 20     # a reader asks for runs of blocks of about this size
CACHE = 600_000          # entries of a worker's cache of encoded pre-tokens
RECENT = 2               # batches whose pre-tokens stay when the cache is full
TEXTS = 1_024            # texts in a batch, of
TEXT_BYTES = 4 << 20     # bytes at most, a text at least
LONGEST = 64             # longer pre-tokens aren't cached

_HEAD = struct.Struct("<IBBHI")
_FOOT = struct.Struct("<QQQQ4s")
_TOKENIZERS: dict[str, object] = {}
_SPACED: dict[str, np.ndarray] = {}
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


# ---- blocks -----------------------------------------------------------------

def _pack(v: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of numbers below 2^32, one after the other."""
    if not width or not len(v):
        return b""
    bits = np.unpackbits(v.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


_PLACES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    if not width or not n:
        return np.zeros(n, np.uint64)
    if width not in _PLACES:
        at = np.arange(1 << 16, dtype=np.int64) * width
        _PLACES[width] = at >> 3, (at & 7).astype(np.uint64)
    byte, shift = _PLACES[width]
    # the 8 bytes from each byte on, as numbers; a value of up to 32 bits lies in those from its first byte on
    numbers = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))
    return (numbers[byte[:n]] >> shift[:n]) & ((np.uint64(1) << np.uint64(width)) - np.uint64(1))


def encode_block(ids: np.ndarray) -> bytes:
    """One block of 1 to 65,536 ids below 2^32."""
    low = int(ids.min())
    v = ids.astype(np.uint64) - np.uint64(low)
    at = max(0, -(-len(v) * PERCENTILE // 100) - 1)
    width = int(np.partition(v, at)[at]).bit_length()
    high = v >> np.uint64(width)
    where = np.flatnonzero(high)
    xwidth = int(high.max()).bit_length()
    # 65,536 exceptions can't occur: at least PERCENTILE per cent of the values fit
    return _HEAD.pack(low, width, xwidth, len(where), len(v)) \
        + _pack(v & ((np.uint64(1) << np.uint64(width)) - np.uint64(1)), width) \
        + where.astype("<u2").tobytes() + _pack(high[where], xwidth)


def decode_block(raw: bytes) -> np.ndarray:
    low, width, xwidth, n_x, n = _HEAD.unpack_from(raw)
    at = _HEAD.size
    v = _unpack(raw[at:(at := at + -(-n * width // 8))], n, width)
    if n_x:
        where = np.frombuffer(raw, "<u2", n_x, at)
        at += 2 * n_x
        v[where] |= _unpack(raw[at:at + -(-n_x * xwidth // 8)], n_x, xwidth) << np.uint64(width)
    return (v + np.uint64(low)).astype(np.uint32)


# ---- shards -----------------------------------------------------------------

class ShardWriter:
    """Writes documents' ids to one shard; holds a block of ids and 17 bytes a document."""

    def __init__(self, uri: str):
        f, p = open_fs(uri)
        self.out, self.at, self.total = f.open_output_stream(p), 8, 0
        self.out.write(MAGIC + struct.pack("<I", BLOCK))
        self.parts, self.held, self.index, self.ids, self.ends = [], 0, [], [], []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """``raw``: the document's ids as little-endian unsigned 32-bit integers."""
        self.parts.append(raw)
        self.held += len(raw) // 4
        self.total += len(raw) // 4
        self.ids.append(doc_id)
        self.ends.append(self.total)
        if self.held >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.parts), "<u4")
        full = len(ids) if last else len(ids) // BLOCK * BLOCK
        for i in range(0, full, BLOCK):
            raw = encode_block(ids[i:i + BLOCK])
            self.index.append(self.at)
            self.out.write(raw)
            self.at += len(raw)
        rest = ids[full:]
        self.parts, self.held = [rest.tobytes()] if len(rest) else [], len(rest)

    def close(self) -> tuple[int, int]:
        """(documents, ids)"""
        if self.held:
            self._flush(True)
        self.out.write(np.array(self.index, "<u8").tobytes())
        self.out.write(np.array([x or 0 for x in self.ids], "<i8").tobytes())
        self.out.write(np.array(self.ends, "<u8").tobytes())
        self.out.write(np.array([x is not None for x in self.ids], np.uint8).tobytes())
        self.out.write(_FOOT.pack(self.at, len(self.index), len(self.ids), self.total, MAGIC))
        self.out.close()
        return len(self.ids), self.total


class ShardReader:
    """Reads documents of one shard by ranges of blocks."""

    def __init__(self, uri: str):
        f, p = open_fs(uri)
        self.file = f.open_input_file(p)
        size = self.file.size()
        index, blocks, docs, self.total, magic = _FOOT.unpack(self.file.read_at(_FOOT.size, size - _FOOT.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        raw = self.file.read_at(blocks * 8 + docs * 17, index)
        self.offsets = np.append(np.frombuffer(raw, "<u8", blocks), np.uint64(index)).astype(np.int64)
        ids = np.frombuffer(raw, "<i8", docs, blocks * 8)
        valid = np.frombuffer(raw, np.uint8, docs, blocks * 8 + docs * 16)
        self.ids = [int(i) if v else None for i, v in zip(ids, valid)]
        self.ends = np.frombuffer(raw, "<u8", docs, blocks * 8 + docs * 8).astype(np.int64)
        self.block = struct.unpack("<I", self.file.read_at(4, 4))[0]

    def blocks(self, first: int, last: int) -> Iterator[np.ndarray]:
        """The ids of blocks first to last - 1, in reads of about READ_BYTES."""
        while first < last:
            to = first + 1
            while to < last and self.offsets[to + 1] - self.offsets[first] <= READ_BYTES:
                to += 1
            base = self.offsets[first]
            raw = self.file.read_at(int(self.offsets[to] - base), int(base))
            for k in range(first, to):
                yield decode_block(raw[self.offsets[k] - base:self.offsets[k + 1] - base])
            first = to

    def read(self, start: int, end: int) -> np.ndarray:
        """The ids from place ``start`` up to ``end`` of the shard."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a = start // self.block
        got = np.concatenate(list(self.blocks(a, -(-end // self.block))))
        return got[start - a * self.block:end - a * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, place of its first id, ids) of all documents in order."""
        more, held, start = self.blocks(0, len(self.offsets) - 1), np.zeros(0, np.uint32), 0
        for doc, end in zip(self.ids, self.ends.tolist()):
            parts, have = [held], len(held)
            while have < end - start:
                parts.append(next(more))
                have += len(parts[-1])
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc, start, held[:end - start]
            held, start = held[end - start:], end

    def close(self) -> None:
        self.file.close()


# ---- encoding ---------------------------------------------------------------

def tokenizer(path: str):
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def spaces_cut(path: str) -> bool:
    """Whether pre-tokens of this tokenizer start at a lone space between other characters.

    So it is with byte-level models that split by their own pattern and neither normalise nor add a space.
    """
    import json

    spec = json.loads(tokenizer(path).to_str())
    pre = spec.get("pre_tokenizer") or {}
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", False) and not pre.get("add_prefix_space") \
        and spec.get("normalizer") is None and not any(
            a["lstrip"] or a["rstrip"] or a["single_word"] or " " in a["content"] for a in spec["added_tokens"])


def _ids(path: str, texts: list[str]) -> list[bytes]:
    t = tokenizer(path)
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def _starts(path: str) -> np.ndarray:
    """Of every id, whether its token starts with a space."""
    if path not in _SPACED:
        t = tokenizer(path)
        spaced = np.zeros(t.get_vocab_size(), bool)
        for token, i in t.get_vocab().items():
            spaced[i] = token.startswith("\u0120")
        _SPACED[path] = spaced
    return _SPACED[path]


def _newline(path: str) -> int:
    """The id of a newline alone; -1 if it has more than one."""
    ids = np.frombuffer(_ids(path, ["\n"])[0], "<u4")
    return int(ids[0]) if len(ids) == 1 else -1


def _encode_units(path: str, plain: set[str], other: set[str]) -> dict[str, bytes]:
    """The ids of each unit: after a space, or as it is where it starts with a newline.

    ``plain`` units have no white space but that newline. They are encoded many
    to a call, and cut at the tokens that start with the space or the newline.
    """
    out: dict[str, bytes] = {}
    rest = list(other)
    lines = [u for u in plain if u[0] == "\n"]
    words = list(plain.difference(lines))
    spaced, newline = _starts(path), _newline(path)
    for some, joint in ((words, " "), (lines, "")):
        chunks = [some[i:i + 512] for i in range(0, len(some), 512)]
        for chunk, raw in zip(chunks, _ids(path, [joint + joint.join(c) for c in chunks])):
            ids = np.frombuffer(raw, "<u4")
            cut = (np.flatnonzero(spaced[ids] if joint else ids == newline) * 4).tolist()
            if len(cut) == len(chunk):
                out.update(zip(chunk, map(raw.__getitem__, map(slice, cut, [*cut[1:], len(raw)]))))
            else:
                rest += chunk
    out.update(zip(rest, _ids(path, [u if u[:1] == "\n" else " " + u for u in rest])))
    return out


def _units(text: str) -> tuple[list[str], bool]:
    """The text cut at its lone spaces and newlines: the first unit, then units as :func:`_encode_units` takes them.

    And whether all but the first are plain.
    """
    if text.replace("\n", "").isprintable():
        text_ = text.replace("\n", " \n")
        if "  " not in text_ and "\n " not in text_ and text_[:1] != " " and text_[-1:] not in (" ", "\n"):
            return text_.split(" "), True
    return _BETWEEN.split(text), False      # no unit after the first starts with white space


def encode_texts(path: str, texts: list[str], cut: bool) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers, as the tokenizer gives them for the whole text.

    With ``cut``, a text falls into pre-tokens at its lone spaces and newlines;
    their ids come from a cache that a Python worker keeps between tasks, and
    distinct missing ones are encoded a batch at a time. A full cache keeps
    what the last RECENT batches used.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if not cut:
        return _ids(path, texts)
    seen, recent = held(f"ids:{path}", lambda: ({}, deque(maxlen=RECENT)))
    units, plain = zip(*map(_units, texts)) if texts else ((), ())
    heads = _ids(path, [u[0] for u in units])
    for u in units:
        del u[0]
    got = [list(map(seen.get, u)) for u in units]
    gaps = [[i for i, r in enumerate(g) if r is None] if None in g else [] for g in got]
    missing: tuple[set[str], set[str]] = (set(), set())
    for u, gap, p in zip(units, gaps, plain):
        missing[0 if p else 1].update(map(u.__getitem__, gap))
    found = _encode_units(path, missing[0], missing[1] - missing[0])
    for u, g, gap in zip(units, got, gaps):
        for i in gap:
            g[i] = found[u[i]]
    recent.append(units)
    if len(seen) + len(found) > CACHE:
        kept = {u: seen[u] for batch in recent for some in batch for u in some if u in seen}
        seen.clear()
        seen.update(kept)
    for u in [u for u in found if len(u) > LONGEST]:
        del found[u]
    seen.update(found)
    return [h + b"".join(g) for h, g in zip(heads, got)]


# ---- the operator -----------------------------------------------------------

def write_shards(docs: DataFrame, path: str, folder: str, scratch: Scratch, end_id: int = 0,
                 key: str = "doc_id", text: str = "text", shards: int | None = None) -> DataFrame:
    """Write the shards to ``folder``; one row per shard: file, first_id, n_docs, n_tokens and start (ids before it)."""
    ship_package(docs.sparkSession)
    cut, end = spaces_cut(path), struct.pack("<I", end_id)
    d = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = shards or parallelism(d.sparkSession)
    d = d.repartitionByRange(n, "key").sortWithinPartitions("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first = None, None
        for b in batches:
            keys, sizes = b.column("key").to_pylist(), pc.binary_length(b.column("text")).to_pylist()
            for i, j in pieces(sizes, TEXT_BYTES, TEXTS):
                some = encode_texts(path, b.column("text").slice(i, j - i).to_pylist(), cut)
                for k, raw in zip(keys[i:j], some):
                    if out is None:
                        uri, first = new_file(folder, ".tpf"), k
                        out = ShardWriter(uri)
                    out.add(k, raw + end)
        if out is not None:
            n_docs, n_tokens = out.close()
            yield pa.RecordBatch.from_pylist(
                [{"file": uri, "first_id": first, "n_docs": n_docs, "n_tokens": n_tokens}],
                schema=pa.schema([("file", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()),
                                  ("n_tokens", pa.int64())]))

    rows = scratch.write(d.mapInArrow(write, "file string, first_id long, n_docs long, n_tokens long"), "shards")
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc id, start, n_tokens and ids_crc32 of every document in the shards' files."""
    schema = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist()):
                r, rows = ShardReader(uri), []
                for doc, at, ids in r.documents():
                    rows.append((doc, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                        rows = []
                r.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    ship_package(shards.sparkSession)
    d = shards.select("file", "start").repartition(parallelism(shards.sparkSession), "file")
    return d.mapInArrow(read, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def store_tokens(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Encode all documents, write the shards under the checkpoint folder and read them back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, path, scratch.path("files"), scratch, end_id))
