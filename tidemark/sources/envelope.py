"""One fetched document to many raw tables, without interpreting what is inside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_collections(
    documents: DataFrame, body: str, collections: Mapping[str, T.StructType]
) -> DataFrame:
    """How many documents lack each listed collection; a warning, not a failure."""
    schema = T.StructType([T.StructField(n, T.ArrayType(s)) for n, s in collections.items()])
    parsed = documents.select(F.from_json(body, schema, {"mode": "FAILFAST"}).alias("d"))
    counts = parsed.agg(*[F.count_if(F.col(f"d.{n}").isNull()).alias(n) for n in collections])
    return counts.unpivot([], list(collections), "collection", "documents_without").filter(
        F.col("documents_without") > 0
    )


def split_collection(
    documents: DataFrame, body: str, collection: str, item: T.StructType, keep: list[str]
) -> DataFrame:
    """The records of one collection, one row each; a document without it yields no rows.

    Only this collection is parsed, and each document expands on its own, without a shuffle.
    """
    schema = T.StructType([T.StructField(collection, T.ArrayType(item))])
    parsed = F.from_json(body, schema, {"mode": "FAILFAST"})[collection]
    return documents.select(*keep, F.explode(parsed).alias("item")).select(*keep, "item.*")


def split_envelope(
    documents: DataFrame, body: str, collections: Mapping[str, T.StructType], keep: list[str]
) -> dict[str, DataFrame]:
    """Every listed collection as its own table; losing one does not cost the others."""
    return {n: split_collection(documents, body, n, s, keep) for n, s in collections.items()}


def envelope_meta(
    documents: DataFrame, body: str, schema: T.StructType, keep: list[str]
) -> DataFrame:
    """What is left of a document besides its collections: one row per document."""
    parsed = F.from_json(body, schema, {"mode": "FAILFAST"}).alias("meta")
    return documents.select(*keep, parsed).select(*keep, "meta.*")


def stamp_parent(
    documents: DataFrame, elements: str, parent: str
) -> DataFrame:
    """The elements of each response, each carrying the id its request was made for.

    `elements` is an array of structs; a null or absent array yields no rows.
    """
    return documents.select(F.explode(elements).alias("element"), parent).select(
        "element.*", parent
    )
