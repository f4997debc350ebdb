"""Exact token counts by a map-side two-tier lookup: no pre-token of the texts is shuffled, only the sample's tallies are.

A piece model of this kind never merges across a space or a newline, so a text
falls into pre-tokens whose token counts add up. The lengths of frequent
pre-tokens (counted by Spark in a random sample of about ``SAMPLE_ROWS`` rows
from all over the table, at most ``FREQUENT`` of them) are broadcast; a pre-token that isn't among them goes through a cache that a
Python worker keeps between tasks and that starts anew at ``CACHE`` entries, and
only what misses both is encoded, a batch of distinct ones at a time. Texts
with runs of spaces, and all texts of a model for which the rule doesn't hold
(tested on its vocabulary), are encoded whole.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted each; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.scratch import ship_package
from transitlens.llm.worker_cache import held

FREQUENT = 32_768        # entries of the broadcast table, each of at most LONGEST characters
LONGEST = 64             # longer pre-tokens are neither broadcast nor cached
CACHE = 1_000_000        # entries of a worker's cache
SAMPLE_ROWS = 10_000     # rows that the frequent pre-tokens are looked for in; counts don't depend on them
SAMPLE_CHARS = 50_000    # longest text taken into that sample
TALLY = 200_000          # distinct pre-tokens that a task of the sample holds at most
BLOCK = "▁"

_MODELS: dict[str, object] = {}


def model(path: str):
    """The model of a file, loaded once per process."""
    if path not in _MODELS:
        import sentencepiece

        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def splits_at_spaces(path: str) -> bool:
    """Whether no piece holds a space after another character, nor a newline, and spaces are kept as they are."""
    m = model(path)
    pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
    inside = any(BLOCK in p.lstrip(BLOCK) or "\n" in p for p in pieces)
    probes = {"a": [BLOCK + "a"], "a\n": [BLOCK + "a", "<0x0A>"], "\na": [BLOCK, "<0x0A>", "a"]}
    return not inside and all(m.encode(t, out_type=str) == want for t, want in probes.items()) \
        and "".join(m.encode(" a  a ", out_type=str)) == BLOCK * 2 + "a" + BLOCK * 2 + "a" + BLOCK


def pre_tokens(text: str) -> list[str] | None:
    """The pre-tokens of a text, or None where it must be encoded whole.

    Each stands for itself after one space, or after nothing where it starts with a newline.
    """
    text = text.replace("\n", " \n")
    if "  " in text or text[:1] == " " and text[1:2] != "\n" or text[-1:] == " " or BLOCK in text:
        return None
    return text[1:].split(" ") if text[:1] == " " else text.split(" ")


def _length(m, tokens: list[str]) -> list[int]:
    return [len(x) - (t[:1] == "\n") for t, x in zip(tokens, m.encode(tokens, num_threads=1))]


def count_batch(path: str, texts: list[str], frequent: dict[str, int], split: bool) -> list[int]:
    """Token counts of texts."""
    m, seen = model(path), held(f"lengths:{path}", dict)
    if len(seen) > CACHE:
        seen.clear()
    out, pending, whole = [0] * len(texts), [], []
    missing: set[str] = set()
    for i, t in enumerate(texts):
        if not t:
            continue
        # a text that starts with a newline has a lone space before it, which no pre-token stands for
        units = pre_tokens(t) if split and t[0] != "\n" else None
        if units is None:
            whole.append(i)
            continue
        rest = []
        for u in units:
            n = frequent.get(u)
            if n is None:
                n = seen.get(u)
                if n is None:
                    rest.append(u)
                    continue
            out[i] += n
        if rest:
            pending.append((i, rest))
            missing.update(rest)
    if missing:
        order = list(missing)
        found = dict(zip(order, _length(m, order)))
        for i, rest in pending:
            out[i] += sum(map(found.__getitem__, rest))
        seen.update((u, n) for u, n in found.items() if len(u) <= LONGEST)
    for i, x in zip(whole, m.encode([texts[i] for i in whole], num_threads=1) if whole else []):
        out[i] = len(x)
    return out


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pre-tokens of the texts with how often they occur, summed up per task."""
    counts: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["u", "n"])

    for b in batches:
        for t in b.column("text").to_pylist():
            # a text that starts with a newline is encoded whole
            if t[0] != "\n":
                counts.update(u for u in pre_tokens(t) or [] if u and len(u) <= LONGEST)
            if len(counts) > TALLY:
                yield flushed()
                counts.clear()
    if counts:
        yield flushed()


def frequent_lengths(texts: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens in a sample of the rows, spread over all of them."""
    n = texts.count()
    if not n:
        return {}
    sample = texts.sample(fraction=min(1.0, SAMPLE_ROWS / n), seed=11).filter((F.col("text") != "") & (F.length("text") <= SAMPLE_CHARS))
    counts = sample.select("text").mapInArrow(_tallied, "u string, n long").groupBy("u").agg(F.sum("n").alias("n"))
    top = [r["u"] for r in counts.filter("n > 1").orderBy(F.desc("n"), "u").limit(FREQUENT).collect()]
    return dict(zip(top, _length(model(path), top))) if top else {}


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every row; ``path`` is the model's file on every machine."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = splits_at_spaces(path)
    table = d.sparkSession.sparkContext.broadcast(frequent_lengths(d, path) if split else {})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for b in batches:
            texts = b.column("text")
            n = count_batch(path, texts.to_pylist(), table.value, split)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n, pa.int64())],
                names=["key", "n_bytes", "n_tokens"])

    kind = d.schema["key"].dataType.simpleString()
    out = d.mapInArrow(counted, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
