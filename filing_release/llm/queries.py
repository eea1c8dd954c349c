"""The registered corpus queries: one per operator, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, centroids, html_text, imatch, jaccard, language, lines, merkle, mixing, packing,
               quality, substring, toxicity)
from .common import read_table
from .oracles import ORACLES


def vocabulary() -> str:
    return os.environ.get("BPE_VOCABULARY") or public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    return os.environ.get("BYTE_BPE_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_deleted", "emptied",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = quality.stage_measures(read_table(spark, sf_dir, "documents"))
    return quality.score(measures).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(read_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), vocabulary())
    return bpe.digests(encoded, vocabulary())


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read_table(spark, sf_dir, "documents"), budget="corpus").select(
        "doc_id", "source", "n_tokens", "epoch", "block", "visit")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(read_table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), byte_vocabulary()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(read_table(spark, sf_dir, "documents")))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings")).drop("n_checked")


_ALL: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_ngram_jaccard_join, op2_html_extraction, op3_line_dedup, op4_quality_rules,
    op5_document_fingerprints, op6_bpe, op7_substring_dedup, op8_source_mixing, op9_toxicity,
    op10_language_id, op11_packing, op12_merkle_manifest, op13_centroid_clustering]
QUERIES = {f.__name__: (f, ORACLES.get(f.__name__)) for f in _ALL}
