import os
import random
import sys

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rows_util import SMALL  # noqa: E402

SCHEMA = "doc_id long, text string, source string, n_words string, bits string, taken string, score string, block string"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source): real texts, and every odd case."""
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    out = [(r["doc_id"], r["text"], r["source"]) for r in t if len(r["text"]) < 8_000][:120]
    rng = random.Random(4)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(160))
    words = base.split(" ")
    for k in range(12):     # near copies of different closeness
        w = list(words)
        for _ in range(k):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append((1000 + k, " ".join(w), "near"))
    passage = "A passage that many of these documents share, and that is well over fifty bytes long, Ünïcödé too."
    out += [(1100 + k, f"{rng.random()} {passage} {rng.random()}", "pass") for k in range(6)]
    out += [(2000, None, "a"), (2001, "", "a"), (2002, " \n\t ", None), (2003, "two words", None), (2004, "TWO Words", ""),
            (2005, "é", "b"), (None, base, "b"), (None, None, None), (2006, base, "b"), (2006, base, "b"), (2006, "other text", "b"),
            (2007, "x" * 3_000, "b"), (2008, " ".join(f"long{k % 977}" for k in range(9_000)), "long"),
            (2009, "same line\n" * 40, "c"), (2010, "  two  spaces \n\n and lines\n", "c"), (2011, "<|endoftext|> a \x00 b\r\nc", "c")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names clash with the operators' own, over several partitions."""
    return spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
