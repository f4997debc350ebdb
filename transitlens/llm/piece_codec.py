"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A model of the merge type builds a text's pieces by always merging the
neighbours whose joined piece has the best score, the leftmost first. A
sequence of pieces is that encoding exactly if every two neighbours, merged
anew from their characters, give themselves. So the encoder walks forward with
the longest piece at its position (found for all positions at once by an
Aho-Corasick automaton of the reversed pieces), checks each piece against its
neighbour, tries shorter pieces where they don't go together, and steps back
where none does. A prefix has one encoding, so a position that has failed once
has failed for good: a bitfield remembers it, and the work is linear. Many
units take their steps together, as numpy arrays.

Characters that no piece holds become byte pieces. No piece goes on across a
space that follows another character, nor across a newline (checked on the
vocabulary; else a text is one unit), so texts fall into units whose ids a
worker keeps between batches. Texts are whole, whatever their length.

Defined cases: null and empty texts have the end id alone, and decode to an
empty text; a null list of ids decodes to an empty text; repeated rows are
encoded each; an empty table gives an empty result. ``encode`` reads and
returns only the key and the text's ids; ``decode`` passes all columns through
and replaces one that has the name of its result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.aho_corasick import LongestMatch
from transitlens.llm.scratch import ship_package
from transitlens.llm.word_arrays import pieces as slices
from transitlens.llm.worker_cache import held

SPACE = "▁"              # stands for a space in pieces
KEPT_UNITS = 400_000     # units of which a worker keeps the ids; beyond, it starts anew
KEPT_IDS = 4_000_000     # ids that it keeps
PAIR_SLOTS = 1 << 21     # neighbours of which it keeps whether they go together
PAIR_MULTIPLIER = 0x9E3779B97F4B
PIECE_CHARS = 2 << 20    # characters of texts worked on at a time


class Pieces:
    """The vocabulary of a model's file, its merges and what a worker has seen."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        if any(m.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        self.end = m.eos_id()
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in ids if m.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("models without byte pieces are not supported")
        special = [m.is_control(i) or m.is_unknown(i) or m.is_byte(i) for i in ids]
        normal = [i for i in ids if not special[i]]
        self.text = {i: m.id_to_piece(i) for i in normal}
        self.score = {self.text[i]: m.get_score(i) for i in normal}
        own = {t: i for i, t in self.text.items()}
        chars = {c for t in own for c in t}
        # characters of pieces that are no pieces themselves start as symbols and end as bytes
        for n, c in enumerate(sorted(chars - own.keys())):
            own[c] = len(ids) + n
            self.text[len(ids) + n] = c
        self.lone = {i: self._byte_ids(t) for i, t in self.text.items() if i >= len(ids)}
        self.span = len(ids) + len(self.lone)     # numbers of pieces lie below
        self.size = np.zeros(self.span, np.int64)
        self.shorter = np.full(self.span, -1)     # the longest piece that starts a piece and isn't all of it
        for t, i in own.items():
            self.size[i] = len(t)
            self.shorter[i] = next((own[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in own), -1)
        self.longest_at = LongestMatch(own)
        self.pair = np.full(PAIR_SLOTS, -1)       # neighbours seen, each at the slot of its hash
        self.pair_fits = np.zeros(PAIR_SLOTS, bool)
        self.gap = next(c for c in map(chr, range(1, 0x110000)) if c not in chars)
        self.by_units = not any(SPACE in t.lstrip(SPACE) or "\n" in t for t in own)
        self.surface = [b" \xe2\x81\x87 " if m.is_unknown(i) else b"" if m.is_control(i) else
                        bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(SPACE, " ").encode()
                        for i in ids]
        self.surfaces = pa.array(self.surface, pa.large_binary())
        self.is_byte = np.array([m.is_byte(i) for i in ids])
        self.opens = np.array([not special[i] and m.id_to_piece(i)[:1] == SPACE for i in ids])
        self.forget()

    def forget(self) -> None:
        """Drop the kept units. Unit 0 is the end id."""
        self.unit: dict[str | int, int] = {0: 0}
        self.flat, self.start, self.count = array("i", [self.end]), array("q", [0]), array("i", [1])

    def _byte_ids(self, text: str) -> list[int]:
        return [self.bytes[b] for b in text.encode("utf-8", "replace")]

    # encoding

    def remerge(self, text: str) -> list[str]:
        """The pieces of a short text by merging the best neighbours, the leftmost of equal ones."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def together(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether neighbours merge to themselves; of first pieces (``last`` -1), whether they do."""
        key = (last + 1) * self.span + token
        slot = (key * PAIR_MULTIPLIER & 0xFFFFFFFFFFFF) % PAIR_SLOTS
        out, new = self.pair_fits[slot], self.pair[slot] != key
        if new.any():
            some, first, which = np.unique(key[new], return_index=True, return_inverse=True)
            fits = np.zeros(len(some), bool)
            for k, pair in enumerate(some.tolist()):
                a, b = pair // self.span - 1, pair % self.span
                want = [self.text[b]] if a < 0 else [self.text[a], self.text[b]]
                fits[k] = self.remerge("".join(want)) == want
            out[new] = fits[which]
            at = slot[new][first]
            self.pair[at], self.pair_fits[at] = some, fits
        return out

    def walk(self, start: np.ndarray, size: np.ndarray, longest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of many stretches of a text, all of whose characters pieces hold: their places and numbers.

        All stretches take a step at a time. A stretch has a place, a piece to
        try there and a bitfield of the places that failed; the piece that ends
        at a place is noted, which is all that a step back needs.
        """
        ending = np.full(len(longest) + 1, -1)
        words = int(size.max(initial=0) // 64) + 1
        failed = np.zeros((len(start), words), np.uint64)
        active, pos, token = np.arange(len(start)), np.zeros(len(start), np.int64), longest[start]
        while len(active):
            there = start[active] + pos
            tried = token >= 0
            stuck = active[~tried], pos[~tried]
            np.bitwise_or.at(failed, (stuck[0], stuck[1] >> 6), np.uint64(1) << (stuck[1] & 63).astype(np.uint64))
            last = np.where(pos > 0, ending[there], -1)
            end = pos + np.where(tried, self.size[token], 0)
            fits = tried & (failed[active, end >> 6] >> (end & 63).astype(np.uint64) & np.uint64(1) == 0)
            fits[fits] = self.together(last[fits], token[fits])
            ending[start[active][fits] + end[fits]] = token[fits]
            back = np.where(tried, token, last)                       # what a shorter piece takes the place of
            pos = np.where(fits, end, np.where(tried, pos, pos - self.size[back]))
            go = ~fits | (end < size[active])
            token = np.where(fits, longest[np.minimum(start[active] + pos, len(longest) - 1)], self.shorter[back])
            active, pos, token = active[go], pos[go], token[go]
        places, tokens, left, at = [], [], start, start + size
        while len(at):
            t = ending[at]
            at = at - self.size[t]
            places.append(at)
            tokens.append(t)
            left, at = left[at > left], at[at > left]
        return np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate([np.zeros(0, np.int64), *tokens])

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that start with nothing before them, one after the other, and how many each has."""
        text = self.gap.join(units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        stops = np.cumsum(sizes + 1) - 1
        longest = self.longest_at(text)
        outside = np.zeros(len(text) + 1, bool)
        outside[stops] = True
        held_ = np.concatenate([[False], (longest >= 0) & ~outside[:-1], [False]])
        edges = np.flatnonzero(np.diff(held_.astype(np.int8)))
        start, size = edges[::2], edges[1::2] - edges[::2]
        places, tokens = [], []
        for some in (size <= 63, size > 63):       # few stretches are long: their bitfields have more words
            p, t = self.walk(start[some], size[some], longest)
            places.append(p)
            tokens.append(t)
        at = np.concatenate(places)
        token = np.full(len(text), -1)
        token[at] = np.concatenate(tokens)
        # pieces count one, characters that no piece holds as many as their bytes
        count = (token >= 0).astype(np.int64)
        odd = {p: self._byte_ids(text[p]) for p in np.flatnonzero(~held_[1:-1] & ~outside[:-1]).tolist()}
        odd |= {p: self.lone[token[p]] for p in np.flatnonzero(token >= self.span - len(self.lone)).tolist()} if self.lone else {}
        for p, ids in odd.items():
            count[p] = len(ids)
        before = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(before[-1], np.int64)
        plain = np.flatnonzero(token >= 0)
        out[before[plain]] = token[plain]
        for p, ids in odd.items():
            out[before[p]:before[p] + len(ids)] = ids
        ends = before[stops]
        return out, np.diff(ends, prepend=0)

    def units_of(self, text: str) -> list[str]:
        """Keys of a text's units: a key that starts with a newline or a space mark is the unit, to others belongs a mark."""
        if not self.by_units:
            return [SPACE + text.replace(" ", SPACE)]
        if text[0] != " " and "  " not in text and SPACE not in text:
            return text.replace("\n", " \n").split(" ")
        return re.findall(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*", SPACE + text.replace(" ", SPACE))

    def encode(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts, one text after the other, and where each text ends."""
        keys: list[str | int] = []
        stops = np.empty(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                keys += self.units_of(t)
            if end:
                keys.append(0)
            stops[i] = len(keys)
        if len(self.unit) > KEPT_UNITS or len(self.flat) > KEPT_IDS:
            self.forget()
        new = list(set(keys).difference(self.unit))
        if new:
            found, counts = self.encode_units([k if k[:1] in ("\n", SPACE) and k else SPACE + k for k in new])
            self.unit.update(zip(new, range(len(self.start), len(self.start) + len(new))))
            self.start.frombytes((len(self.flat) + np.cumsum(counts) - counts).astype(np.int64).tobytes())
            self.count.frombytes(counts.astype(np.int32).tobytes())
            self.flat.frombytes(found.astype(np.int32).tobytes())
        which = np.fromiter(map(self.unit.__getitem__, keys), np.int64, len(keys))
        start, count = np.array(self.start, np.int64)[which], np.array(self.count, np.int64)[which]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = np.array(self.flat, np.int32)[np.repeat(start - before[:-1], count) + np.arange(before[-1])]
        return ids, before[stops]

    # decoding

    def decode_slowly(self, ids: list[int]) -> str:
        """One list of ids piece by piece: runs of byte pieces are read together, broken ones as replacement characters."""
        out, i, stripped = "", 0, False
        while i < len(ids):
            if not self.is_byte[ids[i]]:
                s = self.surface[ids[i]].decode()
                if self.opens[ids[i]] and not out and not stripped:
                    s, stripped = s[1:], True
                out, i = out + s, i + 1
                continue
            j = i
            while j < len(ids) and self.is_byte[ids[j]]:
                j += 1
            run, at = b"".join(self.surface[k] for k in ids[i:j]), 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out += run[at:at + n].decode()
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out, n = out + "�", 1
                at += n
            i = j
        return out

    def decode(self, ids: np.ndarray, stops: np.ndarray) -> list[str]:
        """The texts of lists of ids."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.surface):
            raise ValueError("an id is outside the vocabulary")
        taken = self.surfaces.take(pa.array(ids))
        place = np.frombuffer(taken.buffers()[1], np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        data, sizes = taken.buffers()[2] or b"", np.diff(place)
        out, a = [], 0
        for stop in stops.tolist():
            first = a
            while first < stop and not sizes[first]:
                first += 1
            try:
                text = str(data[place[a]:place[stop]], "utf-8")
                out.append(text[1:] if first < stop and self.opens[ids[first]] else text)
            except UnicodeDecodeError:
                out.append(self.decode_slowly(ids[a:stop].tolist()))
            a = stop
        return out


def _pieces(path: str) -> Pieces:
    return held(f"pieces:{path}", lambda: Pieces(path))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """key and ids (array of int) of every row; ``end`` adds the model's end id. ``path`` is the model's file on every machine."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _pieces(path)
            texts = b.column("text").to_pylist()
            for i, j in slices([len(t) for t in texts], PIECE_CHARS):
                ids, stops = p.encode(texts[i:j], end)
                offsets = pa.array(np.concatenate([[0], stops]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=["key", "ids"])

    kind = d.schema["key"].dataType.simpleString()
    return d.mapInArrow(encoded, f"key {kind}, ids array<int>").select(F.col("key").alias(key), "ids")


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in column ``into``."""
    ship_package(encoded.sparkSession)
    d = encoded.drop(into)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, lists = _pieces(path), b.column(ids)
            counts = np.array(lists.value_lengths().fill_null(0), np.int64)
            flat = np.array(lists.flatten(), np.int64)
            texts = p.decode(flat, np.cumsum(counts))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, into])

    return d.mapInArrow(decoded, T.StructType([*d.schema, T.StructField(into, T.StringType())]))
