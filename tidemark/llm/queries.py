"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, contamination, licenses, merkle, oracles, packing, phrases, pii, toxicity
from tidemark.llm.contamination import Decontamination
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.near_text import NearTexts
from tidemark.llm.near_vectors import NearVectors
from tidemark.llm.sharding import ShardTree, shard_rows
from tidemark.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": oracles.NEAR_TEXTS,
    "op3_line_dedup": oracles.LINES,
    "op5_embedding_neighbours": oracles.VECTORS,
    "op8_decontamination": oracles.CONTAMINATION,
    "op10_chat_formatting": oracles.CHATS,
    "op11_license_scan": oracles.LICENSES,
    "op12_phrases": oracles.PHRASES,
    "op13_merkle_manifest": oracles.MANIFEST,
}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), ShardTree.of(16))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents"), least_docs=10, digest=True)


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination.digest(Decontamination(docs, benchmark).report())


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearTexts(table(spark, sf_dir, "documents")).report()


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY, limit=512)


@query
def op6_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), VOCABULARY))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.judged(toxicity.Toxicity(docs, labels).report(), threshold=0.3)


@query
def op5_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearVectors(table(spark, sf_dir, "embeddings"), least=0.95).report()


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(table(spark, sf_dir, "documents")))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    rows = table(spark, sf_dir, "conversations").select(*columns).unionByName(chat.probe(spark))
    return chat.digest(chat.format_chats(rows.withColumn("parts", chat.text_part(F.col("text")))))


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.LicenseScan(table(spark, sf_dir, "documents")).scanned())


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.Phrases(table(spark, sf_dir, "documents"), least=30).best()


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.Manifest(docs, merkle.FIELDS, claims=merkle.tampered()).report()
