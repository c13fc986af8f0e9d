"""A training-data pipeline over ``documents``: drop toxic documents, cut lines that earlier
documents hold, keep one of each group of near copies, mix the sources, pack into bins.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; ``run`` writes each stage's
result to the shared folder and reads it back as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqualedger.llm import lines, mixing, packing, simhash, toxicity
from aqualedger.llm.util import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, learnt on these documents and ``labels``, accept."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with only the lines that no earlier document holds; n_chars follows."""
    cut = lines.line_dedup(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash group (4 words, 4 bits)."""
    return simhash.near_dedup(docs, shingle_words=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mixture, each source's target weight the root of its documents."""
    return mixing.mixed(docs, weights=0.5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' places in bins of 4096 words; a packing group is a stretch of the order in
    which ``docs`` lie in their files, the mixture's, and ``place`` is the number in it."""
    return packing.best_fit(docs, in_order=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None  # language models are not expressible in SQL; tests hold the stages against brute force
