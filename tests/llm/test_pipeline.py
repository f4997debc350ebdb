"""The pipeline's stages on a small table, each held against brute force."""

import brute
import corpus_pipeline
import pyarrow.parquet as pq
import pytest
from rows_util import SMALL, got, ordered

import __spark_entry__
from transitlens.llm import mixing, quality_rules
from transitlens.llm.scratch import Scratch


@pytest.fixture(scope="module")
def stages(spark):
    docs, scratch, out = spark.read.parquet(f"{SMALL}/documents.parquet"), Scratch(spark, "test"), []
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.write(stage(spark, docs, SMALL), name)
        out.append((docs, after))
        docs = after
    return out


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    assert len(stages) == 5
    assert all(after.columns == before.columns for before, after in stages[:-1])


def test_quality_stage(stages):
    before, after = stages[0]
    kept = quality_rules.judge(before.select("doc_id", "text")).filter("kept")
    assert got(after, "doc_id") == got(kept, "doc_id")
    failed = {r[0] for r in brute.quality(_pairs(before)) if r[6]}
    assert not failed & {i for i, _ in _pairs(after)}


def test_near_copies_stage(stages):
    before, after = stages[1]
    assert ordered(_pairs(after)) == ordered([p for p, c in zip(_pairs(before), brute.components(_pairs(before))) if p[0] == c[2]])


def test_decontamination_stage(stages):
    before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    clean = [p for p, c in zip(_pairs(before), brute.contamination(_pairs(before), items)) if not c[5]]
    assert ordered(_pairs(after)) == ordered(clean)


def test_mixing_stage(stages):
    before, after = stages[3]
    want = mixing.mix(mixing.sized(before)).groupBy("source").sum("taken").withColumnRenamed("sum(taken)", "n").filter("n > 0")
    mine = mixing.sized(after).groupBy("source").sum("size").withColumnRenamed("sum(size)", "n")
    assert got(mine, "source", "n") == got(want, "source", "n")


def test_token_stage(stages):
    from tokenizers import Tokenizer
    import public_tokenizers

    before, after = stages[4]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert got(after, "doc_id", "n_tokens") == ordered([(i, len(t.encode(x, add_special_tokens=False).ids) + 1) for i, x in _pairs(before)])


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
