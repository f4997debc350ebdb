"""Mixing sources to target weights by Sainte-Laguë, in DataFrame functions only.

1. Sizes are summed per source (partial aggregation). Sources in code-point
   order, null last, weigh 5, 2, 1, repeating; ``share`` of all words is dealt
   out by weight, no source above ``max_epochs`` times its own words, the
   excess going to the others by weight (the level of the water is found from
   the sources sorted by capacity per weight).
2. The targets become ``block_words``-word blocks. Sainte-Laguë gives each
   source its blocks by the highest quotients target / (2 j - 1), and then
   each shard of a source, by its words, its integer quota. A source is cut
   into shards of about ``shard_words`` words by a seeded hash of the
   document, so a source with a third of all rows is spread over many.
3. In a shard, documents stand in seeded order and are cut into blocks. A
   quota of q over n blocks takes every block q div n times and q mod n
   blocks once more, from a seeded place on, round the end. A document's
   taken words are its overlap with the taken blocks, repeats counted.

Quotients aren't ranked in one window: they are counted in bands between the
quantiles of their group's quotients, and only the band in which the last seat
falls is ranked, so a source of very many shards is no single task.

Only (document, source, size) rows are shuffled, never texts, except to the
documents' own rows where the caller asks for them back. Everything follows
from the data and the seed, so reruns agree.

Defined cases: null text has size 0 and takes 0; a null source is a source of
its own; repeated rows are rows of their own in one shard (ties in the order
are broken by all of id and size); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlens.llm.quality_rules import WORD, words_of
from transitlens.llm.scratch import Scratch

WEIGHTS = (5, 2, 1)
SHARE_PCT = 150
MAX_EPOCHS = 2
BLOCK_WORDS = 32
SHARD_WORDS = 40_000
BANDS = 1_000            # quantiles that the quotients of a group are cut at


def _digest(key: str, what: str, seed: int) -> Column:
    """A seeded number below 2^32 for a row, equal in every engine that has md5."""
    h = F.md5(F.concat_ws(":", F.lit(f"{seed}-{what}"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, share_pct: int = SHARE_PCT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size -> also rank and target; one row per source, so the windows are over sources."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) \
        .withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * share_pct / 100.0
    left = F.greatest(total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = ranked.withColumn("__left", left).withColumn("__wl", weight_left) \
        .withColumn("__full", F.col("cap") * F.col("__wl") <= F.col("weight") * F.col("__left"))
    # the first source that is not full sets the level; those after it are not full either and give less
    level = F.max(F.when(~F.col("__full"), F.col("__left") / F.col("__wl"))).over(everything)
    return leveled.withColumn("__level", level).withColumn(
        "target", F.when(F.col("__level").isNull(), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.col("weight") * F.col("__level")))) \
        .select("source", "source_size", "rank", "target")


def _same(keys: list[str], left: str, right: str) -> Column:
    """Rows agree in all keys, nulls being equal."""
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def highest(bids: DataFrame, group: list[str], bid: str, order: str, seats: str, bands: int = BANDS) -> DataFrame:
    """The ``seats`` highest bids of each group; equal ones in the order of the whole numbers in ``order``.

    Bids are counted in bands between quantiles of the group, a bid that equals
    a quantile apart from those between, so that equal bids, however many, are
    in a band of their own; that one is cut further by ``order``. Bands above
    the one with the last seat win whole, and rows are ranked in that one alone.
    At most bands * (bands + 2) counts of a group meet in a window.
    """
    cuts = bids.groupBy(*group).agg(
        F.sort_array(F.array_distinct(F.percentile_approx(bid, [i / bands for i in range(bands + 1)], 10 * bands)), False).alias("__cuts"),
        F.min(order).alias("__first"), (F.max(order) - F.min(order) + 1).alias("__orders"))
    b = bids.alias("b").join(cuts.alias("c"), _same(group, "b", "c")).select("b.*", "c.__cuts", "c.__first", "c.__orders")
    above = F.size(F.filter("__cuts", lambda c: c > F.col(bid)))
    equal = F.coalesce(F.get(F.col("__cuts"), above) == F.col(bid), F.lit(False))
    b = b.withColumn("__above", above).withColumn("__band", 2 * F.col("__above") + F.when(equal, 1).otherwise(0)) \
        .withColumn("__part", F.when(equal, F.floor((F.col(order) - F.col("__first")) * bands / F.col("__orders"))).otherwise(0).cast("long")) \
        .drop("__cuts", "__first", "__orders", "__above")
    spot = ["__band", "__part"]
    counts = b.groupBy(*group, *spot).agg(F.count(F.lit(1)).alias("__in"), F.max(seats).alias("__seats"))
    counts = counts.withColumn("__before", F.sum("__in").over(Window.partitionBy(*group).orderBy(*spot)) - F.col("__in")) \
        .filter("__before < __seats")
    b = b.alias("b").join(counts.alias("k"), _same([*group, *spot], "b", "k")).select("b.*", "k.__before", "k.__in")
    whole = F.col("__before") + F.col("__in") <= F.col(seats)
    place = F.row_number().over(Window.partitionBy(*group, *spot).orderBy(F.col(bid).desc(), order))
    last = b.filter(~whole).withColumn("__place", place).filter(F.col("__before") + F.col("__place") <= F.col(seats))
    return b.filter(whole).select(*bids.columns).unionByName(last.select(*bids.columns))


def apportion(parts: DataFrame, group: list[str], votes: str, seats: Column, order: str, out: str, bands: int = BANDS) -> DataFrame:
    """``parts`` with ``out``: the seats of each part in its group by Sainte-Laguë.

    A divisor lies between V / (K + n/2) and V / (K - n/2) for n parts, K seats
    and V votes, so each part surely gets the seats at the first and can't
    exceed those at the second; only the quotients between, about 2 n, compete
    (:func:`highest`). Ties go to the part that is first in ``order``, a whole
    number that names the part in its group. ``seats`` is one number a group.
    Parts and quotients are stored, as they are read several times over.
    """
    k, scratch = F.col("__k"), Scratch(parts.sparkSession, "seats")
    parts = scratch.write(parts, "parts")
    per = parts.withColumn("__k", seats.cast("long")).groupBy(*group).agg(
        F.max("__k").alias("__k"), F.count(F.lit(1)).alias("__n"), F.sum(votes).cast("double").alias("__v"))
    share = F.col(votes) / F.col("__v")
    est = parts.alias("p").join(per.alias("g"), _same(group, "p", "g")).select("p.*", "g.__k", "g.__n", "g.__v") \
        .withColumn("__lo", F.when((F.col("__v") > 0) & (k > 0), F.greatest(
            F.floor(share * (k - F.col("__n") / 2)) - 1, F.lit(0))).otherwise(F.lit(0)).cast("long")) \
        .withColumn("__hi", F.when((F.col("__v") > 0) & (k > 0) & (F.col(votes) > 0),
                                   F.ceil(share * (k + F.col("__n") / 2)) + 2).otherwise(F.col("__lo")).cast("long"))
    sure = est.groupBy(*group).agg((F.max("__k") - F.sum("__lo")).alias("__rest"))
    bids = est.filter("__hi > __lo").select(
        *group, order, F.col(votes).alias("__votes"),
        F.explode(F.sequence(F.col("__lo") + 1, F.col("__hi"))).alias("__j"))
    bids = bids.alias("b").join(sure.alias("s"), _same(group, "b", "s")).select(
        *[f"b.{c}" for c in [*group, order]], "s.__rest", (F.col("b.__votes") / (2 * F.col("b.__j") - 1)).alias("__bid"))
    bids = scratch.write(bids, "bids")
    won = highest(bids, group, "__bid", order, "__rest", bands).groupBy(*group, order).agg(F.count(F.lit(1)).alias("__won"))
    joined = est.alias("e").join(won.alias("w"), _same([*group, order], "e", "w"), "left")
    out = scratch.write(joined.select(*[F.col(f"e.{c}") for c in parts.columns],
                                      (F.col("e.__lo") + F.coalesce(F.col("w.__won"), F.lit(0))).alias(out)), "won")
    for table in ("parts", "bids"):
        scratch.drop(table)
    return out


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size of every document."""
    return docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))


def mix(sizes: DataFrame, seed: int = 1, extra: tuple[str, ...] = (), block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        share_pct: int = SHARE_PCT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size -> doc_id, source, size, source_size, target, taken, and the taking itself.

    ``base`` is how often the whole document is taken; ``cut1``/``len1`` and
    ``cut2``/``len2`` are the word intervals taken once more (the second only
    where the taken blocks go round the end of the shard). Columns named in
    ``extra`` pass through and break ties in the order of a shard.
    """
    per_source = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), share_pct, max_epochs)
    seats = F.round(F.sum("target").over(Window.partitionBy()) / block_words)
    per_source = apportion(per_source.withColumn("__all", F.lit(0)), ["__all"], "target", seats, "rank", "blocks")
    per_source = per_source.select(
        "source", "source_size", "rank", "target", "blocks",
        F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long").alias("shards"))
    d = sizes.alias("d").join(per_source.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))) \
        .select("d.doc_id", "d.source", "d.size", *[f"d.{c}" for c in extra], "s.rank", "s.source_size", "s.target", "s.blocks", "s.shards") \
        .withColumn("shard", _digest("doc_id", "shard", seed) % F.col("shards")) \
        .withColumn("place", _digest("doc_id", "place", seed))
    shards = d.groupBy("rank", "shard").agg(F.sum("size").alias("words"), F.max("blocks").alias("blocks"))
    shards = apportion(shards, ["rank"], "words", F.col("blocks"), "shard", "quota") \
        .withColumn("n", F.ceil(F.col("words") / block_words).cast("long")) \
        .withColumn("q", F.least(F.col("quota"), max_epochs * F.col("n"))) \
        .withColumn("key", F.concat_ws("-", "rank", "shard")) \
        .withColumn("from", F.when(F.col("n") > 0, _digest("key", "from", seed) % F.col("n")).otherwise(0)) \
        .select("rank", "shard", F.col("words").alias("w"),
                F.when(F.col("n") > 0, F.floor(F.col("q") / F.col("n"))).otherwise(0).cast("long").alias("base"),
                (F.col("from") * block_words).alias("x"),
                F.when(F.col("n") > 0, (F.col("from") + F.col("q") % F.col("n")) * block_words).otherwise(0).alias("y"),
                (F.col("n") * block_words).alias("ring"))
    laid = d.withColumn("a", F.coalesce(F.sum("size").over(
        Window.partitionBy("rank", "shard").orderBy("place", "doc_id", "size", *extra)
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    laid = laid.alias("l").join(shards.alias("q"), ["rank", "shard"])
    end = F.col("a") + F.col("size")
    cut1 = F.greatest(F.col("x"), F.col("a"))
    len1 = F.greatest(F.least(F.col("y"), F.col("ring"), end) - cut1, F.lit(0))
    # what goes round the end starts the shard again
    len2 = F.greatest(F.least(F.col("y") - F.col("ring"), end) - F.col("a"), F.lit(0))
    out = laid.select("doc_id", "source", "size", *extra, "source_size", "target", "base",
                      (cut1 - F.col("a")).alias("cut1"), len1.alias("len1"),
                      F.lit(0).cast("long").alias("cut2"), len2.alias("len2"))
    return out.withColumn("taken", F.col("base") * F.col("size") + F.col("len1") + F.col("len2"))


def mixed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mix itself: each document as often as it is taken whole, then its once more taken part.

    A part is the stretch of the text from the first to the last taken word,
    spaces inside kept; n_chars, where there is one, follows the text.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col("doc_id").alias("__id"),
        F.xxhash64("source", "text").alias("__row"), F.size(words_of(F.col("text"))).cast("long").alias("__size"))
    sizes = keyed.select(F.col("__id").alias("doc_id"), F.col("__doc.source").alias("source"),
                         F.col("__size").alias("size"), "__row")
    m = mix(sizes, seed, ("__row",)).select(F.col("doc_id").alias("__own"), F.col("__row").alias("__same"),
                                            "base", "cut1", "len1", "cut2", "len2", "taken")
    # rows of equal id, source and text are told apart by number
    m = m.withColumn("__nth", F.row_number().over(Window.partitionBy("__own", "__same").orderBy("base", "cut1", "len1", "len2"))) \
        .filter("taken > 0")
    d = keyed.withColumn("__n", F.row_number().over(Window.partitionBy("__id", "__row").orderBy("__size")))
    j = d.join(m, F.col("__id").eqNullSafe(F.col("__own")) & (F.col("__row") == F.col("__same"))
               & (F.col("__n") == F.col("__nth")))
    part = lambda c, n: F.struct(c.alias("cut"), n.alias("len"))
    takes = F.filter(F.concat(F.array_repeat(part(F.lit(0).cast("long"), F.col("__size")), F.col("base").cast("int")),
                              F.array(part(F.col("cut1"), F.col("len1")), part(F.col("cut2"), F.col("len2")))),
                     lambda t: t["len"] > 0)
    j = j.select("__doc", "__size", F.explode(takes).alias("__take"))
    # words with the space after them; the space before the first word is no piece
    pieces = F.filter(F.split(F.col("__doc.text"), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1),
                      lambda s: F.rlike(s, F.lit(WORD)))
    text = F.when(F.col("__take.len") == F.col("__size"), F.col("__doc.text")).otherwise(
        F.array_join(F.slice(pieces, (F.col("__take.cut") + 1).cast("int"), F.col("__take.len").cast("int")), ""))
    out = j.select(F.col("__doc").withField("text", text).alias("__doc")).select("__doc.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
