"""The ten operators against brute force, odd cases included."""

import base64
import hashlib
import math
import random
import zlib
from types import SimpleNamespace

import brute
import numpy as np
import public_tokenizers
import pytest
from rows_util import got, ordered
from pyspark.sql import functions as F

from transitlens.llm import (
    decontaminate, lm, mixing, ngram_join, quality_mil, quality_rules, suffix_dedup, token_counts, token_store, warc)
from transitlens.llm.scratch import Scratch

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def pairs(rows):
    return [r[:2] for r in rows]


# ---- 1 ----------------------------------------------------------------------

def test_repeats(docs, rows):
    out = suffix_dedup.remove_repeats(docs)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == ordered(brute.repeats(pairs(rows)))


def test_repeats_of_hot_ranks(docs, rows, monkeypatch):
    """The way of ranks that very many documents share gives the same result."""
    real = suffix_dedup._rank_codes
    blocks = []

    def spread(rows_):
        code, sizes = real(rows_)
        return np.where(code == 1, 2, code).astype(np.uint8), sizes

    b = [(suffix_dedup.Block(r, 44)) for r in _blocks(pairs(rows), 3)]
    blocks += b
    answers = {}
    for kind, codes in ((1, spread), (2, suffix_dedup._run_codes)):
        _round(b, kind, codes, answers)
    _round(b, 3, None, answers)
    out = [r for x in b for r in _finished(x, answers)]
    assert ordered(out) == ordered(brute.repeats(pairs(rows)))


def _blocks(rows, n):
    import zstandard

    for k in range(n):
        own = rows[k::n]
        raw = [brute.utf8(t) for _, t in own]
        ids = [suffix_dedup.NULL_ID if i is None else i for i, _ in own]
        yield {"block": k, "ids": np.array(ids, "<i8").tobytes(), "sizes": np.array([len(x) for x in raw], "<i8").tobytes(),
               "valid": bytes(i is not None for i, _ in own), "data": zstandard.compress(b"".join(raw)), "n_bytes": sum(map(len, raw))}


def _round(blocks, step, codes, answers, buckets=4):
    asks = []
    for x in blocks:
        if step == 1:
            asks += x.ask_ranks(buckets)
        elif step == 2:
            x.take_ranks(answers.get((x.number, 1), np.zeros(0, np.uint8)))
            asks += x.ask_runs(buckets)
        else:
            x.take_runs(answers.get((x.number, 2), np.zeros(0, np.uint8)))
            asks += x.ask_windows(buckets)
    for bucket in range(buckets):
        for kind in sorted({a[2] for a in asks}):
            mine = [a for a in asks if a[0] == bucket and a[2] == kind]
            if mine:
                code, sizes = (codes or suffix_dedup._CODES[kind])(mine)
                for a, part in zip(mine, np.split(code, np.cumsum(sizes)[:-1])):
                    answers[a[1], kind] = np.concatenate([answers.get((a[1], kind), np.zeros(0, np.uint8)), part])


def _finished(block, answers):
    none = np.zeros(0, np.uint8)
    gone = block.removed(answers.get((block.number, 3), none), answers.get((block.number, 4), none))
    a = 0
    for i, ok, n in zip(block.ids.tolist(), block.valid.tolist(), block.sizes.tolist()):
        g = gone[a:a + n]
        spans = int((g & ~np.concatenate([[False], g[:-1]])).sum()) if n else 0
        kept = np.frombuffer(block.data, np.uint8)[a:a + n][~g].tobytes()
        yield i if ok else None, n, int(g.sum()), spans, hashlib.sha256(kept).hexdigest()
        a += n


def test_repeats_in_small_steps(rows, monkeypatch):
    """Long texts cut into many steps keep every window."""
    monkeypatch.setattr(suffix_dedup, "STEP", 300)
    b = [suffix_dedup.Block(r, 44) for r in _blocks(pairs(rows), 2)]
    answers = {}
    for step, codes in ((1, suffix_dedup._rank_codes), (2, suffix_dedup._run_codes), (3, None)):
        _round(b, step, codes, answers)
    assert ordered([r for x in b for r in _finished(x, answers)]) == ordered(brute.repeats(pairs(rows)))


# ---- 2 ----------------------------------------------------------------------

def test_mix(docs, rows):
    sizes = mixing.sized(docs)
    out = mixing.mix(sizes).collect()
    assert len(out) == len(rows)
    total, per = sum(r["size"] for r in out), {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        own = per.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        own[0] += r["size"]
        own[1] += r["taken"]
    assert all(size == source_size for size, _, _, source_size in per.values())
    assert math.isclose(sum(t for _, _, t, _ in per.values()), min(1.5, 2) * total)
    assert all(t <= 2 * size + 1e-9 and abs(taken - t) <= 3 * mixing.BLOCK_WORDS for size, taken, t, _ in per.values())
    order = sorted((s for s in per if s is not None)) + [None]
    free = [per[s][2] / w for s, w in zip(order, [5, 2, 1] * 99) if per[s][2] < 2 * per[s][0] - 1e-6]
    assert max(free) - min(free) < 1e-6            # sources below their cap share by weight
    again = mixing.mix(mixing.sized(docs.repartition(7))).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted(map(tuple, again), key=key)


def test_apportionment_is_highest_quotients(spark):
    votes = [(0, 0, 53_000.0), (0, 1, 24_000.0), (0, 2, 23_000.0), (0, 3, 1.0), (0, 4, 0.0)]
    parts = spark.createDataFrame(votes, "g int, i int, votes double")
    for seats in (0, 1, 7, 100, 2_500):
        won = {r["i"]: r["won"] for r in mixing.apportion(parts, ["g"], "votes", F.lit(seats), "i", "won").collect()}
        bids = sorted(((-v / (2 * j - 1), i) for _, i, v in votes if v for j in range(1, seats + 2)))[:seats]
        assert won == {i: sum(b == i for _, b in bids) for _, i, _ in votes}


@pytest.mark.parametrize("bands", [3, 1_000])
def test_apportionment_in_bands(spark, bands):
    rng = random.Random(bands)
    groups = {0: [rng.randrange(1, 10**6) for _ in range(150)], 1: [500] * 90, 2: [0] * 5,        # many votes, all equal, none
              3: [rng.choice([1, 10, 10, 1_000]) for _ in range(80)], None: [7]}
    parts = spark.createDataFrame([(g, i, v) for g, votes in groups.items() for i, v in enumerate(votes)], "g int, i int, votes long")
    for seats in (0, 1_234):
        out = mixing.apportion(parts.repartition(3), ["g"], "votes", F.lit(seats), "i", "won", bands).collect()
        for g, votes in groups.items():
            bids = sorted((-v / (2 * j - 1), i) for i, v in enumerate(votes) if v for j in range(1, seats + 2))[:seats]
            want = [0] * len(votes)
            for _, i in bids:
                want[i] += 1
            assert [r["won"] for r in sorted((r for r in out if r["g"] == g), key=lambda r: r["i"])] == want


def test_mixed_documents(docs):
    plan = mixing.mix(mixing.sized(docs)).groupBy("source").agg(F.sum("taken").alias("n"))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = mixing.sized(out).groupBy("source").agg(F.sum("size").alias("n"))
    assert got(taken.filter("n > 0"), "source", "n") == got(plan.filter("n > 0"), "source", "n")


# ---- 3 ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def scores(docs):
    return lm.score_texts(docs).toPandas()


def test_lm_counts(scores, rows):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    none = lambda x: None if x != x else int(x)
    mine = ordered([(none(r[0]), *r[1:5], round(r[5], 6)) for r in scores[[*names, "base_score"]].itertuples(index=False)])
    want = ordered([(*r[:5], round(r[5], 6)) for r in brute.lm_base(pairs(rows))])
    assert [r[:5] for r in mine] == [r[:5] for r in want]
    assert all(abs(a[5] - b[5]) < 1e-5 for a, b in zip(mine, want))


def test_lm_scores(scores):
    assert (scores.score < 0).all() and np.isfinite(scores.score).all()
    held = scores[scores.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_lm_probabilities_sum_to_one():
    v = lm.Vocabulary(np.arange(5, dtype=np.uint64), np.arange(5), np.r_[np.arange(50, 45, -1), np.zeros(lm.OUTPUTS - 5, np.int64)],
                      np.zeros(lm.CLASSES, np.int64), 240, 5)
    m = lm.Model.new(v)
    context = np.array([[1, 2, 3, lm.OUTPUTS]] * lm.OUTPUTS)
    m.train(np.arange(300) % 5, np.tile(context[:1], (300, 1)), 2, 1)
    assert abs(np.exp(m.log_probabilities(np.arange(lm.OUTPUTS), context)).sum() - 1) < 1e-5


def _any_model(scale):
    m = lm.Model.new(lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.ones(lm.OUTPUTS, np.int64), np.ones(lm.CLASSES, np.int64), 1, 1))
    r = np.random.default_rng(5)
    m.p = {k: (scale * r.standard_normal(x.shape)).astype(np.float32) for k, x in m.p.items()}
    return m, r.integers(0, lm.OUTPUTS, 2_000), r.integers(0, lm.OUTPUTS + 1, (2_000, lm.CONTEXT))


@pytest.mark.parametrize("scale", [0.3, 4.0])     # large weights: float32 products vanish
def test_lm_log_probabilities_equal_the_softmax_of_all_scores(scale):
    m, target, context = _any_model(scale)
    p = {k: x.astype(np.float64) for k, x in m.p.items()}
    s = (p["in"][context] * p["place"]).sum(1) @ p["out"].T + p["bias"]
    s -= s.max(1, keepdims=True)
    want = s[np.arange(len(s)), target] - np.log(np.exp(s).sum(1))
    assert np.allclose(m.log_probabilities(target, context), want, rtol=1e-4, atol=1e-4)


def test_lm_scoring_takes_exponentials_once_a_place_not_once_a_token(monkeypatch):
    m, target, context = _any_model(0.3)
    seen, real = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: (seen.append(np.size(x)), real(x, *a, **k))[1])
    m.log_probabilities(np.tile(target, 10), np.tile(context, (10, 1)))
    assert sum(seen) <= lm.CONTEXT * (lm.OUTPUTS + 1) * lm.OUTPUTS


def test_lm_learns_from_every_training_text(docs, rows):
    """Each task passes over all texts outside the fold, repeated ids and null ones included."""
    blocks = lm.B.pack_blocks(docs, "doc_id", "text", 20_000)
    batches = lm.B.with_answers(blocks, [], 2).toArrow().to_batches()
    v = lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.ones(lm.OUTPUTS, np.int64), np.ones(lm.CLASSES, np.int64), 1, 1)
    out = list(lm._refining(SimpleNamespace(value=lm.Model.new(v)), 7, 2)(iter(batches)))
    assert sum(b.column("n")[0].as_py() for b in out) == brute.lm_base(pairs(rows))[0][4]


# ---- 4 ----------------------------------------------------------------------

@pytest.fixture(scope="session")
def items(spark, rows):
    text = rows[3][1].split(" ")
    return [(7, " ".join(text[5:30])), (10, " ".join(text[8:19]).upper()), (7, "two WORDS"), (None, "é"), (1, None), (2, ""), (3, "nowhere at all")]


def test_contamination(spark, docs, rows, items):
    out = decontaminate.find_benchmark(docs.withColumns({"HITS": F.lit("x"), "item_ids": F.lit(1)}), spark.createDataFrame(items, "item_id long, text string"))
    mine = got(out, "doc_id", *decontaminate.hit_digest(out))
    assert mine == ordered(brute.contamination(pairs(rows), items))


def test_contamination_in_slices(spark, docs, rows, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 20)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find_benchmark(docs, bench)
    assert got(out, "doc_id", *decontaminate.hit_digest(out)) == ordered(brute.contamination(pairs(rows), items))
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[5] for r in brute.contamination(pairs(rows), items))


# ---- 5 ----------------------------------------------------------------------

def test_warc(spark):
    pages = [(5, "http://a/", "one"), (3, "http://b/ \r\nc", "two"), (9, None, "one"), (1, "http://d/", None), (2, "http://e/", ""),
             (None, "http://f/", "one"), (7, "ü", "ü" * 9_000), (8, "http://g", "one")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, file string").repartition(3)
    scratch = Scratch(spark, "warc")
    index = warc.write_archives(df, scratch.path("archives"), scratch)
    out = {r["page_id"]: r for r in warc.read_records(index).collect()}
    first = {"one": 5, "two": 3, "": 1, "ü" * 9_000: 7}
    for page, url, html in pages:
        raw, r = (html or "").encode(), out[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert r["refers_to"] == (None if first[html or ""] == page else first[html or ""])
        assert r["record_type"] == ("response" if r["refers_to"] is None else "revisit")
        assert (bytes(r["payload"]) if r["payload"] is not None else None) == (raw if r["refers_to"] is None else None)
    assert out[9]["url"] is None and out[3]["url"] == "http://b/%20%0D%0Ac"
    some = warc.read_records(index.filter("page_id in (7, 8)"), payloads=False)
    assert got(some, "page_id", "record_type") == [(7, "response"), (8, "revisit")]
    longer = warc.with_referred(df, min_bytes=4)
    assert longer.filter("refers_to is not null").count() == 0
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_warc_reads_near_records_at_once():
    class File:
        reads = []

        def read_at(self, n, at):
            self.reads.append((at, n))
            return bytes(x % 251 for x in range(at, at + n))

    ranges = [(0, 10), (10, 5), (15 + warc.GAP_BYTES, 7), (10**7, 3)]
    parts = list(warc.fetch(File(), ranges))
    assert [len(p) for p in parts] == [10, 5, 7, 3] and parts[3][0] == 10**7 % 251
    assert len(File.reads) == 2


# ---- 6 ----------------------------------------------------------------------

def test_token_store(docs, rows):
    from tokenizers import Tokenizer

    t, want, start = Tokenizer.from_file(BPE), [], 0
    for i, text in sorted(pairs(rows), key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got(token_store.store_tokens(docs, BPE), "doc_id", "start", "n_tokens", "ids_crc32") == ordered(want)


@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 2**32])
def test_blocks_round_trip(high):
    r = np.random.default_rng(high)
    for n in (1, 7, 8_192):
        ids = r.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        ids[r.integers(0, n, n // 50)] = high - 1
        assert (token_store.decode_block(token_store.encode_block(ids)) == ids).all()


def test_shard_reads_ranges(tmp_path):
    w = token_store.ShardWriter(str(tmp_path / "a.tpf"))
    docs = [(k, np.arange(k * 977, k * 977 + (k * 131) % 3_000, dtype="<u4")) for k in range(40)]
    for k, ids in docs:
        w.add(k or None, ids.tobytes())
    w.close()
    r, start = token_store.ShardReader(str(tmp_path / "a.tpf")), 0
    assert r.ids[:3] == [None, 1, 2]
    for _, ids in docs:
        assert (r.read(start, start + len(ids)) == ids).all()
        start += len(ids)


# ---- 7 ----------------------------------------------------------------------

def test_quality_statistics(docs, rows):
    out = quality_rules.judge(docs.select("doc_id", "text"))
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") \
        == ordered(brute.quality(pairs(rows)))
    assert out.filter("kept and base_failed").count() == 0


def test_rule_order_doesnt_change_verdicts(docs):
    d = docs.select("doc_id", "text")
    one = quality_rules.judge(d)
    two = quality_rules.judge(d, rules=quality_rules.text_rules()[::-1])
    assert got(one, "doc_id", "kept") == got(two, "doc_id", "kept")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id", "text") == got(quality_rules.judge(docs.select("doc_id", "text")).filter("kept"), "doc_id", "text")


def test_each_text_rule_agrees_with_the_statistics(docs):
    words = F.inline(F.array(F.struct(quality_rules.words_of(F.col("text")).alias("__words"))))
    d = quality_rules.with_stats(docs.select("doc_id", "text").select("doc_id", "text", words))
    few, repeated = (r.reject for r in quality_rules.all_rules("text", F.col("__words"))[:2])
    few_, repeated_ = (r.reject for r in quality_rules.base_rules())
    assert d.filter((few != few_) | (repeated != repeated_) | repeated.isNull()).count() == 0
    assert d.filter(repeated).count() > 0


def test_rules_by_rejections_per_cost(spark):
    d = spark.range(1000)
    r = lambda name, share, cost: quality_rules.Rule(name, F.col("id") < share * 1000, F.lit(cost))
    rules = [r("dear", 0.9, 100.0), r("cheap", 0.1, 1.0), r("best", 0.5, 2.0)]
    assert [x.name for x in quality_rules.order_rules(d, rules, fraction=1.0)] == ["best", "cheap", "dear"]
    assert quality_rules.order_rules(d.limit(0), rules) == rules


# ---- 8 ----------------------------------------------------------------------

def test_near_duplicates(docs, rows):
    out = ngram_join.near_duplicates(docs)
    assert got(out, "doc_id", "n_shingles", "component_id") == ordered(brute.components(pairs(rows)))


def test_near_duplicates_in_small_tiles(spark, monkeypatch):
    """A family whose links are weak, in blocks of tiles and with few partners at first."""
    import random

    rng = random.Random(9)
    words, out = [f"w{k}" for k in range(60)], []
    for k in range(70):
        w = list(words)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            w[rng.randrange(60)] = f"y{rng.randrange(10**6)}"
        out.append((k, " ".join(w)))
    monkeypatch.setattr(ngram_join, "TILE", 8)
    monkeypatch.setattr(ngram_join, "STEPS", (1,))
    monkeypatch.setattr(ngram_join, "PARTNERS_FIRST", 1)
    df = spark.createDataFrame(out, "doc_id long, text string")
    assert got(ngram_join.near_duplicates(df), "doc_id", "n_shingles", "component_id") == ordered(brute.components(out))


@pytest.mark.parametrize("shift", [0, 2**63 - 1 - 30])
def test_near_duplicates_of_ids_with_several_texts(spark, shift):
    """Each text of an id keeps its own links, also if another one is a copy or has as many shingles."""
    import random

    rng = random.Random(5)
    text = lambda: [f"v{rng.randrange(10**6)}" for _ in range(70)]
    near = lambda w: [*w[:-1], "changed"]
    a, b, c, d, e, f = (text() for _ in range(6))
    out = [(3, a), (5, a), (5, b), (7, near(b)), (9, c), (9, d), (11, near(d)), (12, near(c)), (12, c), (20, e), (21, near(e)),
           (30, f), (30, f), (30, []), (2, near(f)), (2, near(d))]
    out = [(i + shift, " ".join(w)) for i, w in out] + [(None, " ".join(b))]
    df = spark.createDataFrame(out, "doc_id long, text string")
    assert got(ngram_join.near_duplicates(df), "doc_id", "n_shingles", "component_id") == ordered(brute.components(out))


def test_one_of_each(docs, rows):
    out = ngram_join.one_of_each(docs)
    found = brute.components(pairs(rows))
    ids = {i for i, _, c in found if i is not None and i == c}
    assert out.columns == docs.columns
    assert [r[0] for r in got(out, "doc_id")] == [None] * sum(i is None for i, _ in pairs(rows)) + sorted(ids)


def test_bitmap_bound():
    r = np.random.default_rng(2)
    for n in (1, 40, 700):
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 5:], r.integers(0, 2**63, n // 4, dtype=np.uint64)]))
        if len(b):
            assert ngram_join.differing([ngram_join.bitmap(a)], [ngram_join.bitmap(b)])[0] <= len(np.setxor1d(a, b))


# ---- 9 ----------------------------------------------------------------------

def test_token_counts(docs, rows):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len(brute.utf8(t)), len(m.encode(t or "")), len(m.encode(t or "")) > 4096) for i, t in pairs(rows)]
    assert got(token_counts.count_tokens(docs, PIECES), "doc_id", "n_bytes", "n_tokens", "over_limit") == ordered(want)


# ---- 10 ---------------------------------------------------------------------

def test_quality_scores(spark):
    small = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    out = quality_mil.score(docs, quality_mil.train(docs, labels))
    held = out.filter(quality_mil.fold(F.col("doc_id"), 5) == 0).join(labels.groupBy("doc_id").agg(F.max("quality").alias("q")), "doc_id")
    r = held.toPandas()
    assert r.score.between(0, 1).all() and ((r.score >= 0.3) == (r.q == 1)).mean() > 0.9


def test_quality_odd_rows(spark, docs, rows):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality_mil.train(docs, none)
    assert [s for _, s in got(quality_mil.score(docs, model), "doc_id", "score")] == [0.5] * len(rows)
    labels = spark.createDataFrame([(r[0], k % 2) for k, r in enumerate(rows[:40])], "doc_id long, quality int")
    scored = quality_mil.score(docs, quality_mil.train(docs, labels))
    assert scored.count() == len(rows) and scored.filter("score >= 0 and score <= 1").count() == len(rows)


def test_attention_gradients():
    r = np.random.default_rng(0)
    bags = quality_mil.passages([b"one two three. " * 30, b"", b"four | five # 6 " * 9])
    m = quality_mil.Model()
    target = np.array([1, 0, 1], np.float32)
    m.p = {k: v.astype(np.float64) + 0.1 * r.standard_normal(v.shape) for k, v in m.p.items()}
    loss = lambda: -np.mean(target * np.log(m._forward(bags)[6]) + (1 - target) * np.log(1 - m._forward(bags)[6]))
    g = m._gradients(bags, target)
    for k in m.p:
        i = tuple(r.integers(0, n) for n in m.p[k].shape)
        m.p[k][i] += 1e-4
        up = loss()
        m.p[k][i] -= 2e-4
        assert abs((up - loss()) / 2e-4 - g[k][i]) < 1e-3
        m.p[k][i] += 1e-4
    a = m.weights(bags)
    assert np.allclose(np.add.reduceat(a, bags.first[:-1]), 1, atol=1e-5)


# ---- empty tables -----------------------------------------------------------

def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (suffix_dedup.remove_repeats(empty), mixing.mix(mixing.sized(empty)), mixing.mixed_documents(empty),
                lm.score_texts(empty), decontaminate.find_benchmark(empty, bench), token_store.store_tokens(empty, BPE),
                quality_rules.judge(empty.select("doc_id", "text")), ngram_join.near_duplicates(empty),
                token_counts.count_tokens(empty, PIECES), quality_mil.score(empty, quality_mil.train(empty, labels))):
        assert out.count() == 0


# ---- helpers ----------------------------------------------------------------

def test_idle_caches_are_dropped(monkeypatch):
    import time

    from transitlens.llm import worker_cache

    monkeypatch.setattr(worker_cache, "IDLE_S", 0.2)
    first = worker_cache.held("x", dict)
    assert worker_cache.held("x", dict) is first
    time.sleep(1.0)
    assert worker_cache.held("x", dict) is not first


def test_words_of_long_texts_in_pieces(monkeypatch):
    """Hashes don't depend on where a text lies or on how it is cut."""
    from transitlens.llm import word_arrays as wa

    texts = [b"one two", b"", b" x" * 500, "Über größe ÜBER".encode(), b"y" * 2_000 + b" one"]
    whole = wa.words(texts)
    h = whole.hashes()
    monkeypatch.setattr(wa, "PIECE", 64)
    assert (wa.words(texts).hashes() == h).all()
    alone = np.concatenate([wa.words([t]).hashes() for t in texts])
    assert (alone == h).all()
    assert [whole.word(i) for i in (0, 1)] == [b"one", b"two"] and h[0] == h[-1]


def test_fit_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    """The bound on the labelled documents is one on rows: a hot id brings one text."""
    rows = [(i, f"text of document {i} " * 9) for i in range(1, 9)] + [(3, f"other {k}") for k in range(200)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int")
    seen = []
    real = quality_mil.Model.fit
    monkeypatch.setattr(quality_mil.Model, "fit", lambda self, bags, target: (seen.append(len(target)), real(self, bags, target))[1])
    quality_mil.train(docs.repartition(4), labels)
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 9))]


def test_score_of_a_bag_by_hand():
    """The forward pass, passage by passage, in plain Python."""
    texts = [b"one two three. " * 40, b"", b"four | five # 6 " * 9]
    bags, m = quality_mil.passages(texts), quality_mil.Model()
    m.fitted = True
    p = {k: v.astype(float) for k, v in m.p.items()}
    for b, got_ in enumerate(m.score(bags)):
        states, logits = [], []
        for x in bags.x[bags.first[b]:bags.first[b + 1]]:
            h = [math.tanh(sum(float(np.clip(x[i], -6, 6)) * p["We"][i, j] for i in range(len(x))) + p["be"][j]) for j in range(len(p["be"]))]
            gate = [math.tanh(sum(h[i] * p["V"][i, g] for i in range(len(h)))) / (1 + math.exp(-sum(h[i] * p["U"][i, g] for i in range(len(h)))))
                    for g in range(p["V"].shape[1])]
            states.append(h)
            logits.append(sum(gate[g] * p["w"][g, 0] for g in range(len(gate))))
        top = [math.exp(v) for v in logits]
        z = [sum(w * h[j] for w, h in zip(top, states)) / sum(top) for j in range(len(states[0]))]
        want = 1 / (1 + math.exp(-(sum(z[j] * p["c"][j, 0] for j in range(len(z))) + p["d"][0])))
        assert abs(got_ - want) < 1e-4
