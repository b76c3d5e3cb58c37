"""The document pipeline: each stage reads what its predecessor wrote.

All stages but the last return the columns of ``documents``; where a stage
changes texts, ``n_chars`` follows. Rows with a null id pass through the stages
that compare documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.llm import bpe, decontaminate, jaccard, line_dedup, quality
from tapeweave.llm.common import saved, table

TOKENIZER = "byte_bpe_50k.json"
# Near duplicates: five words, a similarity of 0.8 or more.
WORDS, NUM, DEN = 5, 80, 100


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores below its threshold go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).where("predicted = 1").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller document holds too go; every document stays."""
    out = line_dedup.dedup_lines(docs)
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c
                        for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies stays; rows that repeat one id stay or go together."""
    found = jaccard.cluster(docs, words=WORDS, num=NUM, den=DEN)
    copies = saved(found.where("doc <> component_id").select(F.col("doc").alias("doc_id")).distinct(), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), out="__spans")
    return marked.where(F.size("__spans") == 0).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it (a null text counts as an empty one)."""
    path = public_tokenizers.path(TOKENIZER)
    out = bpe.encode(docs, path, out="ids", decoded="decoded")
    return out.select(*[c for c in docs.columns if c not in ("ids", "decoded")], "ids",
                      F.size("ids").cast("long").alias("n_tokens"),
                      (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", dedup_documents),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", tokenize),
]
# SQL can express neither the classifier nor the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
