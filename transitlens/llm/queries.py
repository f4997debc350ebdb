"""The subpackage's queries: thin ones over whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.llm import (decontaminate, lm, merkle, mixing, ngram_join, piece_codec, quality_mil, quality_rules, suffix_dedup, token_counts,
                             token_store, vector_codes, warc)
from transitlens.llm.oracle import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings removed from every document."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(mixing.sized(docs)).select("doc_id", "size", "source_size", "target", "taken")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document's text."""
    return lm.score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *decontaminate.hit_digest(found))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back by byte ranges."""
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to shards and read back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_store.store_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality statistics and the cascade's verdict for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingles and the component of its links."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op10_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_mil.train(docs, _table(spark, sf_dir, "labels"))
    return quality_mil.score(docs, model).select(
        "doc_id", (quality_mil.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings, with their errors."""
    codes, books = vector_codes.encode_vectors(_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and what its tampered or own row folds to."""
    docs = _table(spark, sf_dir, "documents")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # a null doc_id has no remainder and is not tampered with
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", upper, lower)).otherwise(F.col("text"))
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": tampered})
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = piece_codec.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return piece_codec.decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_mixing, op3_lm_scoring, op4_decontamination, op5_warc, op6_token_store, op7_quality_rules, op8_ngram_join,
    op9_token_counts, op10_quality_mil, op11_vector_codes, op12_merkle, op13_piece_codec)}
