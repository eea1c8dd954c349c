"""The corpus pipeline: documents in, token ids out.

Stages run in order; each one's result is written as Parquet on shared storage
and reread as the next one's ``docs``:

1. quality rules: documents that the rules reject go;
2. line dedup: blocks of lines that an earlier document has go from the later
   one, and a document left without words goes;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. mixing: documents are repeated to the target source weights (none is left out);
5. BPE: every document's token ids.

Rows without a ``doc_id`` leave in the first stage.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filing_release.llm import bpe, jaccard, lines, mixing, quality
from filing_release.llm.common import if_small, read_table, stage
from filing_release.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.score(quality.stage_measures(docs))
    out = stage(scored.where("not kept").select("doc_id").distinct(), "rejected")
    return docs.where("doc_id is not null").join(if_small(out), "doc_id", "left_anti").select(
        *COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup(docs.select(*COLUMNS)).where("not emptied").select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.length("kept_text").cast("long").alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs.select(*COLUMNS))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs.select(*COLUMNS))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, vocabulary()).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), "ids")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup),
          ("n-gram Jaccard join", near_copies), ("mixing sources", source_mixing),
          ("BPE encoding", bpe_encoding)]

#: Expectation-maximisation, alignment and BPE are beyond SQL; tests/llm holds
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
