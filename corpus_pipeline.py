"""Training-corpus pipeline: the stages in order, each over all that its predecessor kept.

Every stage but the last returns the columns of its documents. Stages that judge a document by its own text pass its
row through and drop or keep it, so only line dedup and near dedup shuffle texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import decontaminate, language, lines, packing, simhash
from pricelens.llm.common import materialize
from pricelens.llm.queries import tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the language the model gives them, which their pieces have in the end; those whose language it does not know go.

    It learns from the documents' own languages."""
    return language.identify(docs, language.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that an earlier document has are cut out; the text's length follows."""
    out = lines.dedup_lines(docs)
    cols = [F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*cols)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash-linked documents the one with the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or one within the edit threshold, go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), similarity=0.8)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces placed in sequences of at most 4096 tokens, each with its language."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), size=4096, keep=("lang",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # language, embeddings and tokens are not SQL; tests/llm compares run() with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
