"""A training-data pipeline over ``documents``: five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
Between stages the documents are written as Parquet and read again, so a lost executor
costs at most one stage. All stages but the last return the columns of ``documents``.
Empty input gives empty output at every stage; null texts count as empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from gaugeworks.llm.common import table
from gaugeworks.session import written


#: Names of a stage's own columns, which no document table has.
LINES, DROPPED = "__stage_n_lines", "__stage_n_dropped"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking, learnt from the labels of this input, does not reject."""
    labels = table(spark, sf_dir, "labels")
    ranking = quality.learn(docs, labels.filter(~quality.held_out(labels["doc_id"])))
    return quality.good_documents(docs, ranking)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines of any length go. A document of which nothing but white space is left, having
    had some, goes too: all it said stands in documents that stay."""
    out = line_dedup.line_dedup(docs, lines_col=LINES, dropped_col=DROPPED)
    emptied = (F.col(DROPPED) > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    kept = out.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(DROPPED) > 0, F.char_length("text").cast("long"))
        kept = kept.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return kept.select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id: five-word
    shingles, Jaccard similarity of 0.8 or more. Documents without words link with none."""
    classes = jaccard_join.jaccard_classes(docs, words=5, num=80)
    stays = classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = stays.select(F.col("doc_id").alias("stays_id")).distinct()
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays["stays_id"]), "left_semi")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_stage),
    ("decontaminate", benchmark_stage),
    ("bpe", token_stage),
]

#: Learnt scores, single-link classes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
