"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a boolean column over a document. A sample of about ``SAMPLE_ROWS``
documents is stored; each rule's cost is the time that Spark takes for it over
the sample, and one aggregation gives the share of documents that it rejects.
In descending order of rejections per cost the rules become one CASE
expression, which stops at the first that rejects. The order
changes what a document costs and which rule is named as its first, never
whether it is kept: the verdict is the conjunction of all rules.

``keep_good`` puts all rules into the cascade, the repeated windows too, and
shares nothing but the words between them. ``judge`` reports every statistic
of every document, so its base rules are comparisons of columns that are there
anyway and stand first; its rules over the text are ordered as above.

Defined cases: a null or empty text has no words and fails ``few_words``;
an empty table gives an empty result (the rules keep the given order);
repeated rows are judged row by row; columns of other names pass through
``judge`` untouched, and a clash with a column it adds is an error raised
when the plan is built.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.llm.scratch import Scratch

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"

MIN_WORDS = 50
MAX_REPEAT_PCT = 50          # words inside repeated 3-word windows, per cent of the words
MAX_SYMBOL_PCT = 20          # symbol characters per 100 words
MAX_DUP_LINE_PCT = 50        # lines equal to an earlier line, per cent of the lines with a word
MIN_MEAN_CHARS = 2           # mean word length, code points
MAX_MEAN_CHARS = 15
MIN_LETTER_WORD_PCT = 60     # words that hold a letter, per cent of the words
SAMPLE_ROWS = 2_000          # documents, about, on which costs and rejections are measured
SAMPLE_PARTS = 16            # partitions that the sample is stored in


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for a document to be dropped; ``cost`` per document, if known, stands for the measured one."""

    name: str
    reject: Column
    cost: Column | None = None


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, the value evaluated once however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda s: F.rlike(s, F.lit(WORD)))


def _windows(words: Column) -> Column:
    """64-bit hashes of the 3-word windows of one text (compared only inside that text)."""
    inner = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(inner, lambda w, i: F.xxhash64(w, words[i + 1], words[i + 2]))


def _sorted_windows(win: Column) -> Column:
    """The windows' hashes with their positions, sorted; null where no two are equal."""
    return F.when(F.size(F.array_distinct(win)) < F.size(win),
                  F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def _repeated_at(s: Column) -> Column:
    """Positions of the windows that occur twice or more, ascending."""
    same = lambda e, i, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
    return F.sort_array(F.transform(
        F.filter(s, lambda e, i: same(e, i, i - 1) | same(e, i, i + 1)), lambda e: e["i"]))


def _covered(at: Column) -> Column:
    """Words in the windows at these positions: the gaps between them, three words at most."""
    return F.coalesce(F.aggregate(
        F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(3)), F.lit(3))),
        F.lit(0), lambda a, x: a + x), F.lit(0))


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (all long).

    n_repeat_words: the windows' hashes are sorted with their positions, equal
    neighbours are repeated windows, and the positions they cover are added up
    as the gaps between repeated windows, three words at most.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("__words", words_of(F.col(text)))
    d = d.withColumn("__win", _windows(F.col("__words")))
    d = d.withColumn("__sorted", _sorted_windows(F.col("__win")))
    d = d.withColumn("__at", _repeated_at(F.col("__sorted")))
    d = d.withColumn("__lines", _lines(F.col(text)))
    stats = {
        "n_words": F.size("__words"), "word_chars": F.length(F.regexp_replace(t, SPACE, "")),
        "n_symbols": F.length(F.regexp_replace(t, NOT_SYMBOLS, "")), "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _covered(F.col("__at")),
    }
    # generated columns: a filter on them is not pushed below, where it would compute the arrays again for every mention
    return d.select(*[F.col(f"`{c}`") for c in docs.columns],
                    F.inline(F.array(F.struct(*[v.cast("long").alias(k) for k, v in stats.items()]))))


def _base_rules(n_words: Column, n_repeat_words: Column) -> list[Rule]:
    return [
        Rule("few_words", n_words < MIN_WORDS),
        Rule("repeated_windows", 100 * n_repeat_words > MAX_REPEAT_PCT * n_words),
    ]


def base_rules() -> list[Rule]:
    """Rules over the columns of :func:`with_stats`."""
    return _base_rules(F.col("n_words"), F.col("n_repeat_words"))


def text_rules(text: str = "text", words: Column | None = None) -> list[Rule]:
    """Rules that read the text themselves, and its words where a column holds them."""
    c = F.col(text)
    t, words = F.coalesce(c, F.lit("")), words_of(c) if words is None else words
    bare = F.length(F.regexp_replace(t, SPACE, ""))
    n = F.size(words)
    return [
        Rule("symbols", 100 * F.length(F.regexp_replace(t, NOT_SYMBOLS, "")) > MAX_SYMBOL_PCT * n),
        Rule("duplicate_lines", _let(_lines(c), lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x))) > MAX_DUP_LINE_PCT * F.size(x))),
        Rule("word_length", _let(bare, lambda x: (x < MIN_MEAN_CHARS * n) | (x > MAX_MEAN_CHARS * n))),
        Rule("letter_words", 100 * F.size(F.filter(words, lambda w: F.rlike(w, F.lit(LETTER))))
             < MIN_LETTER_WORD_PCT * n),
    ]


def all_rules(text: str, words: Column) -> list[Rule]:
    """Base rules and text rules over the text and its words alone, without :func:`with_stats`."""
    repeated = _let(_windows(words), lambda win: _let(_sorted_windows(win), lambda s: _let(_repeated_at(s), _covered)))
    return _base_rules(F.size(words), repeated) + text_rules(text, words)


def order_rules(docs: DataFrame, rules: list[Rule], fraction: float | None = None, seed: int = 7) -> list[Rule]:
    """``rules`` by rejections per cost on a sample, highest first, ties in the given order; without ``fraction``, of about SAMPLE_ROWS."""
    if len(rules) < 2:
        return list(rules)
    if fraction is None:
        fraction = min(1.0, SAMPLE_ROWS / max(docs.count(), 1))
    scratch = Scratch(docs.sparkSession, "rules")
    sample = scratch.write(docs.sample(False, fraction, seed).repartition(SAMPLE_PARTS), "sample")
    flags = [F.coalesce(r.reject, F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    rejected = sample.agg(*[F.count_if(f).alias(f"r{i}") for i, f in enumerate(flags)]).first()
    costs = [_seconds(sample, f) if r.cost is None else sample.agg(F.avg(r.cost)).first()[0] or 0.0 for r, f in zip(rules, flags)]
    scratch.drop("sample")
    gain = [n / max(cost, 1e-9) for n, cost in zip(rejected, costs)]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain[i], i))]


def _seconds(sample: DataFrame, flag: Column) -> float:
    """What evaluating a rule over the sample takes: the faster of two runs, as the first one compiles."""
    took = []
    for _ in range(2):
        start = time.perf_counter()
        sample.agg(F.count_if(flag)).collect()
        took.append(time.perf_counter() - start)
    return min(took)


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule in order that rejects, else null; later rules aren't evaluated."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(r.reject, F.lit(r.name)).otherwise(out)
    return out


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``rejected_by`` and ``kept``.

    The base rules, comparisons of the statistics, come first; the text rules
    follow in cascade order for the documents that are left.
    """
    rules = text_rules(text) if rules is None else rules
    first = cascade(base_rules())
    rest = cascade(order_rules(docs, rules))
    base_failed = F.lit(False)
    for r in base_rules():
        base_failed = base_failed | r.reject
    return with_stats(docs, text).withColumn("base_failed", base_failed) \
        .withColumn("rejected_by", F.when(F.col("base_failed"), first).otherwise(rest)) \
        .withColumn("kept", F.col("rejected_by").isNull())


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    words = F.inline(F.array(F.struct(words_of(F.col("__t")).alias("__words"))))    # cut once for all rules
    rules = order_rules(docs.select(F.col(text).alias("__t")).select("__t", words), all_rules("__t", F.col("__words")))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text).alias("__t"))
    return inner.select("__row", "__t", words).filter(cascade(rules).isNull()).select("__row.*")
