"""Exact Jaccard join of documents' word shingles, and its components.

1. One row per document: the size of its set of ``SHINGLE``-word shingles
   (64-bit hashes), a 128-bit digest of the set and a parity bitmap of it,
   about one bit per shingle. Equal sets are one class, stood for by its
   smallest document. Shingles that are frequent inside a task's documents
   are summed over all tasks; the most frequent go last in the order of
   shingles, which may be any order as long as it is the same for all.
2. Two sets of a similarity of t or more share a shingle among the first
   n - ceil(t n) + 1 of each. Those prefixes are dealt by shingle, as arrays;
   shingles of a single class end there. Neighbours by size under a shingle
   are the first candidates: a chain, not all pairs.
3. Candidates pass if the bitmaps allow: each differing bit is a differing
   shingle, which bounds the overlap from above. What is left is decided by
   the intersection of the sorted arrays, and links give components.
4. Only shingles that still join different components go on. Their members
   are cut into tiles by size band (large members of a band visit the next)
   and, if a tile is large, by blocks of it; in a tile, pairs of different
   components are held against size, place and bitmap bounds, and those left
   are decided exactly. A first pass takes some partners of each member and
   joins most components; the second takes all pairs of what is still apart.
   So no link between components is lost, and pairs inside a component are
   not listed.

Nothing is capped: every pair that could link two components is decided.

Defined cases: documents without words have an empty set, 0 shingles, and are
linked with nothing; fewer words than a shingle are one shingle, their whole
sequence; rows that share a doc_id are one node with the links of all (while
pairs are sought, each different set of such an id is a node of its own, with
an unused number, of which there must be enough above or below all ids); a row
with a null doc_id has no links and a null component; repeated rows are
copies; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.components import components
from transitlens.llm.scratch import Scratch, parallelism, ranges_for, ship_package
from transitlens.llm.word_arrays import SPACED, mix64, pieces, shingle_hashes, utf8, words

SHINGLE = 5
THRESHOLD = 80           # per cent
PIECE_BYTES = 4 << 20    # text handled at a time
FREQUENT_PCT = 1         # a shingle in this share of a piece's documents, and in FREQUENT_MIN, is reported
FREQUENT_MIN = 8
MOST_FREQUENT = 65_536   # shingles put last; 8 bytes each are broadcast
BITS = (64, 4_096)       # least and most bits of a bitmap
BAND = 4                 # ratio of a size band
NARROW = 256             # bits of the bitmap that goes into tiles
STEPS = (1, 2, 4, 8, 16) # partners of a member in the chain, counted along it
PARTNERS_FIRST = 24      # partners of a member in the first pass over the tiles
TILE = 2_048             # members of a block of a tile
PAIRS = 1 << 20          # pairs looked at in one numpy operation
BROADCAST_ROWS = 400_000 # rows up to which a written table of ids (and, of 64 bytes at most, bitmaps) is broadcast
PARTNERS = 64            # texts held against one text by one task, about


# ---- sets -------------------------------------------------------------------

def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = words(texts, SPACED)
    h = w.hashes()
    all_ = shingle_hashes(h, size)
    out = []
    for a, b in zip(w.first.tolist(), w.first[1:].tolist()):
        if b - a >= size:
            s = np.sort(all_[a:b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(mix64(shingle_hashes(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed(a, b, threshold: int = THRESHOLD):
    """The overlap that sets of a and b elements need: ceil(t (a + b) / (100 + t))."""
    return -(-threshold * (a + b) // (100 + threshold))


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + 1 if n else 0


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the elements by their low bits."""
    bits = min(max(BITS[0], 1 << (len(s) - 1).bit_length()), BITS[1])
    at = (s & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """A lower bound of the number of elements that are in one set of a pair only; the longer bitmap is folded."""
    out = np.zeros(len(x), np.int64)
    size = np.minimum(np.fromiter(map(len, x), np.int64, len(x)), np.fromiter(map(len, y), np.int64, len(y)))
    for k in np.unique(size):
        rows = np.flatnonzero(size == k)
        both = [_folded([side[i] for i in rows], int(k)) for side in (x, y)]
        out[rows] = np.bitwise_count(both[0] ^ both[1]).sum(1)
    return out


def _folded(maps: list[bytes], size: int) -> np.ndarray:
    out = np.empty((len(maps), size // 8), np.uint64)
    length = np.fromiter(map(len, maps), np.int64, len(maps))
    for k in np.unique(length):
        rows = np.flatnonzero(length == k)
        m = np.frombuffer(b"".join(maps[i] for i in rows), np.uint64).reshape(len(rows), k // size, size // 8)
        out[rows] = np.bitwise_xor.reduce(m, axis=1)
    return out


def may_link(na, nb, x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Whether the bitmaps allow a link: overlap <= (a + b - differing) / 2."""
    return (na + nb - differing(x, y)) // 2 >= needed(na, nb)


# ---- 1. sizes ---------------------------------------------------------------

_SIZES = "doc long, n long, d1 long, d2 long, bits binary, frequent binary"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text"))
        for a, b in pieces([len(t) for t in texts], PIECE_BYTES):
            sets = shingle_sets(texts[a:b])
            n = [len(s) for s in sets]
            d1 = [int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            d2 = [int(mix64(s ^ np.uint64(0x9E6C63D0876A9A47)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            s, count = np.unique(np.concatenate(sets), return_counts=True)
            often = count >= max(FREQUENT_MIN, FREQUENT_PCT * (b - a) / 100)
            frequent = s[often].tobytes() + count[often].astype(np.uint64).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(a, b - a), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
                 pa.array(d2, pa.int64()), pa.array([bitmap(x) for x in sets], pa.binary()),
                 pa.array([frequent] + [None] * (b - a - 1), pa.binary())],
                names=["doc", "n", "d1", "d2", "bits", "frequent"])


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for raw in b.column("frequent").to_pylist():
            x = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:len(x) // 2]), pa.array(x[len(x) // 2:])], names=["shingle", "n"])


def frequent_shingles(sizes: DataFrame) -> np.ndarray:
    """The shingles to put last, sorted; at most MOST_FREQUENT."""
    rows = sizes.filter("frequent is not null").select("frequent").mapInArrow(_reported, "shingle long, n long") \
        .groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT) \
        .select("shingle").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


# ---- ids of several sets ----------------------------------------------------

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the size and digest of their sets."""
    for batch in batches:
        own = pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text")], names=["doc", "text"])
        at = 0
        for s in _sizes(iter([own])):
            part = own.slice(at, s.num_rows)
            at += s.num_rows
            yield pa.RecordBatch.from_arrays([*[s.column(c) for c in ("doc", "n", "d1", "d2")], part.column("text")],
                                             names=["doc", "n", "d1", "d2", "text"])


def numbered_sets(live: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int] | None:
    """A number (node) for each different set of the ids that have several, and the first and last number; None if no id has."""
    digest = ("n", "d1", "d2")
    ends = live.groupBy("doc").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in digest for f in (F.min, F.max)])
    torn = scratch.write(ends.filter(" or ".join(f"min_{c} < max_{c}" for c in digest)).select("doc"), "torn")
    if torn.isEmpty():
        return None
    sets = live.join(_small(torn), "doc").select("doc", *digest).distinct().withColumn("part", F.spark_partition_id()) \
        .withColumn("at", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33))
    sets = scratch.write(sets, "torn-sets")
    start, total = [], 0
    for part, n in sets.groupBy("part").count().collect():
        start.append((part, total))
        total += n
    low, high = live.agg(F.min("doc"), F.max("doc")).first()
    if high + total < 2**63:
        base = high + 1
    elif low - total >= -2**63:
        base = low - total
    else:
        raise ValueError(f"{total} unused numbers are needed above or below all ids")
    starts = live.sparkSession.createDataFrame(start, "part int, start long")
    node = (F.lit(base).cast("long") + F.col("start") + F.col("at")).alias("node")
    return scratch.write(sets.join(F.broadcast(starts), "part").select("doc", *digest, node), "nodes"), base, base + total - 1


# ---- 2. prefixes by shingle -------------------------------------------------

_BLOB = "bucket int, shingle binary, owner binary, place binary, docs binary"
_DOC = np.dtype([("doc", "<i8"), ("n", "<i8"), ("d1", "<i8"), ("d2", "<i8")])
_SHARED = pa.schema([("shingle", pa.int64()), ("doc", pa.int64()), ("n", pa.int64()), ("place", pa.int64()),
                     ("next", pa.list_(pa.int64()))])


def prefixes(sets: list[np.ndarray], last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, set, place) of the prefixes of all sets, the shingles of ``last`` being last in order."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    late = np.zeros(len(flat), bool)
    if len(last) and len(flat):
        late = last[np.minimum(np.searchsorted(last, flat), len(last) - 1)] == flat
    parts, lengths, at = [], [], 0
    for s in sets:
        p, x = prefix_length(len(s)), late[at:at + len(s)]
        at += len(s)
        parts.append((np.concatenate([s[~x], s[x]]) if x.any() else s)[:p])
        lengths.append(p)
    owner = np.repeat(np.arange(len(sets)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.concatenate(parts) if parts else flat, owner, place


def _deal(last, buckets: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch.column("text")), batch.column("doc").to_numpy()
            for a, b in pieces([len(t) for t in texts], PIECE_BYTES):
                sets = shingle_sets(texts[a:b])
                shingle, owner, place = prefixes(sets, last.value)
                docs = np.zeros(b - a, _DOC)
                docs["doc"], docs["n"] = ids[a:b], [len(s) for s in sets]
                for k, seed in (("d1", 0), ("d2", 0x9E6C63D0876A9A47)):
                    docs[k] = [mix64(s ^ np.uint64(seed)).sum(dtype=np.uint64).astype(np.int64) for s in sets]
                bucket = (shingle % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows = []
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    own = order[cut[k]:cut[k + 1]]
                    who, index = np.unique(owner[own], return_inverse=True)
                    rows.append((k, shingle[own].tobytes(), index.astype("<u4").tobytes(),
                                 place[own].astype("<u4").tobytes(), docs[who].tobytes()))
                if rows:
                    c = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int32()), *[pa.array(x, pa.binary()) for x in c[1:]]],
                        names=["bucket", "shingle", "owner", "place", "docs"])
    return deal


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: the members of shingles of more than one class, each with its neighbour."""
    shingle, at, place, docs, n = [], [], [], [], 0
    for b in batches:
        for s, o, p, d in zip(*[b.column(c).to_pylist() for c in ("shingle", "owner", "place", "docs")]):
            shingle.append(np.frombuffer(s, np.uint64))
            at.append(np.frombuffer(o, "<u4").astype(np.int64) + n)
            place.append(np.frombuffer(p, "<u4"))
            docs.append(np.frombuffer(d, _DOC))
            n += len(docs[-1])
    if not shingle:
        return
    shingle, at, place, docs = map(np.concatenate, (shingle, at, place, docs))
    order = np.argsort(shingle, kind="stable")
    shingle, at, place = shingle[order], at[order], place[order]
    twin = np.zeros(len(shingle), bool)
    twin[1:] = shingle[1:] == shingle[:-1]
    twin[:-1] |= twin[1:]
    shingle, at, place = shingle[twin], at[twin], place[twin].astype(np.int64)
    d = docs[at]
    order = np.lexsort((d["doc"], d["d2"], d["d1"], d["n"], shingle))
    shingle, place, d = shingle[order], place[order], d[order]
    first = np.ones(len(shingle), bool)     # one member for each class
    first[1:] = (shingle[1:] != shingle[:-1]) | (d["d1"][1:] != d["d1"][:-1]) | (d["d2"][1:] != d["d2"][:-1]) \
        | (d["n"][1:] != d["n"][:-1])
    shingle, place, d = shingle[first], place[first], d[first]
    same = shingle[1:] == shingle[:-1]
    member = np.zeros(len(shingle), bool)
    member[1:] |= same
    member[:-1] |= same
    near = np.zeros((len(STEPS), len(shingle)), np.int64)
    good = np.zeros(near.shape, bool)
    for row, step in enumerate(STEPS):
        if step < len(shingle):
            good[row, :-step] = (shingle[step:] == shingle[:-step]) \
                & possible(d["n"][:-step], d["n"][step:], place[:-step], place[step:])
            near[row, :-step] = d["doc"][step:]
    for i in range(0, len(shingle), 100_000):
        k = np.flatnonzero(member[i:i + 100_000]) + i
        listed = good[:, k].T
        ends = np.concatenate([[0], np.cumsum(listed.sum(1))]).astype(np.int32)
        partners = pa.ListArray.from_arrays(pa.array(ends), pa.array(near[:, k].T[listed]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(shingle[k].view(np.int64)), pa.array(d["doc"][k]), pa.array(d["n"][k]), pa.array(place[k]), partners],
            schema=_SHARED)


def possible(na, nb, pa_, pb):
    """Size and place bounds of pairs whose first common shingle stands at these places."""
    return (100 * np.minimum(na, nb) >= THRESHOLD * np.maximum(na, nb)) \
        & (np.minimum(na - pa_, nb - pb) >= needed(na, nb))


# ---- 3. candidates and links ------------------------------------------------

def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = [b.column(c).to_numpy() for c in ("na", "nb")]
        ok = may_link(*n, b.column("xa").to_pylist(), b.column("xb").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])


def _narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps folded to NARROW bits at most."""
    for b in batches:
        maps = b.column("bits").to_pylist()
        out = [x if len(x) * 8 <= NARROW else _folded([x], NARROW // 8)[0].tobytes() for x in maps]
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("n"), pa.array(out, pa.binary())], names=["doc", "n", "bits"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, salt, b), a's own text, whose b is null, first."""
    a, sets = None, []
    for batch in batches:
        texts = utf8(batch.column("text"))
        of = list(zip(*[batch.column(c).to_pylist() for c in ("a", "salt", "b")]))
        for i, j in pieces([len(t) for t in texts], PIECE_BYTES):
            rows = []
            for (x, salt, y), s in zip(of[i:j], shingle_sets(texts[i:j])):
                if (x, salt) != a:
                    a, sets = (x, salt), []
                if y is None:
                    sets.append(s)
                elif any(_overlap(s, t) >= needed(len(s), len(t)) for t in sets):
                    rows.append((x, y))
            if rows:
                u, v = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _overlap(s: np.ndarray, t: np.ndarray) -> int:
    """Common elements of two sorted arrays."""
    if len(s) > len(t):
        s, t = t, s
    if not len(s):
        return -1
    return int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())


def _small(written: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its rows are counted and few; else Spark joins it by a shuffle."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def decided(docs: DataFrame, pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) of documents that are linked, as u and v. ``pairs`` is a written table."""
    ids = scratch.write(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), f"{name}-ids")
    texts = docs.join(_small(ids), F.col("doc") == F.col("id")).select("id", "text")
    texts = scratch.write(texts, f"{name}-texts")
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    dealt = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    partners = dealt.join(texts.withColumnRenamed("id", "b"), "b").select("a", "salt", "b", "text")
    own = dealt.select("a", "salt").distinct().join(texts.withColumnRenamed("id", "a"), "a") \
        .select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    rows = partners.union(own).repartition(parallelism(docs.sparkSession), "a", "salt") \
        .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    links = scratch.write(rows.mapInArrow(_decide, "u long, v long").distinct(), f"{name}-links")
    scratch.drop(f"{name}-texts")
    return links


# ---- 4. tiles ---------------------------------------------------------------

def _tiles(most: int):
    """Rows sorted by tile -> candidate pairs of different components, of each member with the next ``most``."""
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            t = pa.Table.from_batches([*[x for h in held for x in h.to_batches()], batch])
            key = _tile_of(t)
            # the last tile may go on in the next batch
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from _pairs(t.slice(0, cut), most)
            held = [t.slice(cut)]
        for t in held:
            yield from _pairs(t, most)
    return tiles


def _tile_of(t: pa.Table) -> np.ndarray:
    cols = [t.column(c).to_numpy() for c in ("shingle", "band", "i", "j")]
    new = np.zeros(len(t), bool)
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _pairs(t: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    if not len(t):
        return
    c = {k: t.column(k).to_numpy() for k in ("doc", "component", "n", "place", "visits", "part", "i", "j")}
    maps = t.column("bits").to_pylist()
    key = _tile_of(t)
    end = np.searchsorted(key, key, side="right")
    count = np.minimum(end - np.arange(len(key)) - 1, most)    # partners that follow in the tile
    run = np.concatenate([[0], np.cumsum(count)])
    for x in range(0, int(run[-1]), PAIRS):        # pairs x to x + PAIRS - 1 of all tiles, in order
        at = np.arange(x, min(x + PAIRS, int(run[-1])))
        p = np.searchsorted(run, at, side="right") - 1
        q = p + 1 + at - run[p]
        ok = (c["component"][p] != c["component"][q]) & ~(c["visits"][p] & c["visits"][q])
        ok &= (c["i"][p] == c["j"][p]) | (c["part"][p] != c["part"][q])
        ok &= possible(c["n"][p], c["n"][q], c["place"][p], c["place"][q])
        p, q = p[ok], q[ok]
        a, b = np.minimum(c["doc"][p], c["doc"][q]), np.maximum(c["doc"][p], c["doc"][q])
        order = np.lexsort((b, a))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        k = order[fresh]
        if len(k):
            ok = may_link(c["n"][p[k]], c["n"][q[k]], [maps[i] for i in p[k]], [maps[i] for i in q[k]])
            yield pa.RecordBatch.from_arrays([pa.array(a[k][ok]), pa.array(b[k][ok])], names=["a", "b"])


def tiled(members: DataFrame) -> DataFrame:
    """Members (shingle, doc, component, n, place, bits) of undecided shingles -> a row per member and tile.

    A member also visits the next band if a set that may link with it can be that large.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(float(BAND))) + 1e-9).cast("int")
    reach = F.floor(F.log(F.col("n") * 100.0 / THRESHOLD) / F.log(F.lit(float(BAND))) + 1e-6).cast("int")
    m = members.withColumn("own", band).withColumn("band", F.explode(F.sequence(band, F.greatest(band, reach)))) \
        .withColumn("visits", F.col("band") != F.col("own")).drop("own")
    large = m.groupBy("shingle", "band").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > TILE)
    m = m.join(large, ["shingle", "band"], "left") \
        .withColumn("parts", F.coalesce(F.ceil(F.col("size") / TILE), F.lit(1)).cast("int")) \
        .withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return m.select("shingle", "band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                    "doc", "component", "n", "place", "visits", "part", "bits")


# ---- the operator -----------------------------------------------------------

def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id (the smallest key reachable by links) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "jaccard")
    all_docs = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = all_docs.filter("doc is not null")

    sizes = scratch.write(all_docs.mapInArrow(_sizes, _SIZES), "sizes")
    buckets = ranges_for(spark, 8 * (sizes.agg(F.sum("n")).first()[0] or 0))
    last = spark.sparkContext.broadcast(frequent_shingles(sizes))
    live = sizes.filter("n > 0 and doc is not null").select("doc", "n", "d1", "d2", "bits")
    numbered, own = numbered_sets(live, scratch), None
    if numbered:
        nodes, low, high = numbered
        key_, ids = ["doc", "n", "d1", "d2"], _small(scratch.write(nodes.select("doc").distinct(), "torn-ids"))
        torn = known.join(ids, "doc").select("doc", "text").mapInArrow(_digests, "doc long, n long, d1 long, d2 long, text string")
        torn = scratch.write(torn.join(_small(nodes), key_).select(F.col("node").alias("doc"), "text"), "torn-texts")
        known = known.join(ids, "doc", "left_anti").union(torn)
        live = live.join(_small(nodes), key_, "left").withColumn("doc", F.coalesce("node", "doc")).drop("node")
        own = nodes.select(F.col("node").alias("u"), F.col("doc").alias("v"))
    blobs = known.mapInArrow(_deal(last, buckets), _BLOB).repartitionById(buckets, "bucket")
    shared = scratch.write(blobs.select("shingle", "owner", "place", "docs")
                           .mapInArrow(_share, "shingle long, doc long, n long, place long, next array<long>"), "shared")

    groups = live.groupBy("n", "d1", "d2").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("size"))
    copies = live.join(groups.filter("size > 1"), ["n", "d1", "d2"]).filter("doc != rep").select("doc", "rep").distinct()
    copies = scratch.write(copies, "copies")
    # the row that stands for a class, of which there may be more than one if rows repeat
    reps = live.join(_small(copies), "doc", "left_anti").groupBy("doc", "n").agg(F.first("bits").alias("bits"))
    reps = scratch.write(reps, "reps")

    def standing(d: DataFrame, column: str) -> DataFrame:
        c = _small(copies).select(F.col("doc").alias("__doc"), "rep")
        return d.join(c, F.col(column) == F.col("__doc"), "left") \
            .withColumn(column, F.coalesce("rep", column)).drop("rep", "__doc")

    def bounded(pairs: DataFrame) -> DataFrame:
        side = lambda s: reps.select(F.col("doc").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"x{s}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_bounded, "a long, b long").distinct()

    chain = shared.select(F.col("doc").alias("a"), F.explode("next").alias("b")).distinct()
    chain = standing(standing(chain, "a"), "b").filter("a != b") \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    chain = scratch.write(bounded(chain), "chain")
    same = copies.select(F.col("doc").alias("u"), F.col("rep").alias("v"))
    links = decided(known, chain, scratch, "first")
    links = links.union(own) if own else links
    found = scratch.write(components(links, scratch, "c1"), "first-components")

    narrow = scratch.write(reps.mapInArrow(_narrowed, "doc long, n long, bits binary"), "narrow")
    tried, links = chain, links.union(same)
    for name, most in (("near", PARTNERS_FIRST), ("all", 1 << 40)):
        # the shingles' own files hold all members of a shingle, so nothing is shuffled before the undecided are known
        member = standing(shared.select("shingle", "doc", "n", "place"), "doc") \
            .join(_small(found).withColumnRenamed("node", "doc"), "doc", "left") \
            .withColumn("component", F.coalesce("component", "doc"))
        open_ = member.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
            .filter("lo < hi").select("shingle")
        member = member.join(open_, "shingle").join(narrow, ["doc", "n"])
        tiles = tiled(member).repartition(buckets, "shingle", "band", "i", "j") \
            .sortWithinPartitions("shingle", "band", "i", "j", F.xxhash64("doc"))
        pairs = tiles.mapInArrow(_tiles(most), "a long, b long").distinct()
        pairs = scratch.write(bounded(pairs.join(tried, ["a", "b"], "left_anti")), f"{name}-pairs")
        links = links.union(decided(known, pairs, scratch, name))
        tried = tried.union(pairs)
        found = scratch.write(components(links, scratch, f"{name}-c"), f"{name}-components")

    if numbered:    # components by their smallest id, without the numbers of sets
        real = found.filter((F.col("node") < low) | (F.col("node") > high))
        least = real.groupBy("component").agg(F.min("node").alias("least"))
        found = real.join(least, "component").select("node", F.col("least").alias("component"))
    out = sizes.select("doc", "n").join(found, F.col("doc") == F.col("node"), "left")
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "doc").alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that have the smallest key of their component, once each, with their own columns.

    Of rows that share that key, the one of the smallest text stays. Rows with a null key stay.
    """
    found = near_duplicates(docs, key, text)
    gone = found.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("__gone")).distinct()
    kept = docs.join(gone, F.col(key) == F.col("__gone"), "left_anti")
    twice = kept.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__twice")).agg(F.count(F.lit(1)).alias("__n")) \
        .filter("__n > 1").select("__twice")
    rows = kept.join(twice, F.col(key) == F.col("__twice"), "left")
    once = rows.filter("__twice is null").select(*[F.col(f"`{c}`") for c in docs.columns])
    row = F.struct(F.col(text).alias("__t"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    again = rows.filter("__twice is not null").groupBy("__twice").agg(F.min(row).alias("__m")).select("__m.__row.*")
    return once.unionByName(again)
