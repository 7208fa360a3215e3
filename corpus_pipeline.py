"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) over all that the stage before it kept. The
first four return the columns of `documents`; the last returns the packed pieces. Every stage is
written as Parquet to the shared folder and read again before the next one starts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.contamination import Decontamination
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.near_text import NearTexts
from tidemark.llm.packing import digest, pack
from tidemark.llm.toxicity import Toxicity
from tidemark.session import staged

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# Workers live on from stage to stage, and by default keep the pages of arrays they have freed. With
# these settings of the C library an array of more than 128 kB is given back when it is freed.
LEAN = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "131072",
    "MALLOC_TRIM_THRESHOLD_": "131072",
}


def _lean(spark: SparkSession) -> None:
    """Start this session's Python workers with `LEAN`, unless the cluster sets these itself."""
    for name, value in LEAN.items():
        spark.sparkContext.environment.setdefault(name, value)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3; the labels of `labels` are for ids of `documents`."""
    _lean(spark)
    return Toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).kept(0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines found in ten documents or more; n_chars follows the text."""
    _lean(spark)
    size = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return drop_repeated_lines(docs, least_docs=10).withColumn("n_chars", size)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate texts: the one with the smallest id."""
    _lean(spark)
    return NearTexts(docs).kept()


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    _lean(spark)
    return Decontamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).kept()


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 ids."""
    _lean(spark)
    return digest(pack(docs, VOCABULARY))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Scores, minima over links and BM25 order are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
