"""Connected components of a links table, by repeated small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (columns a, b); a component is its least node.

    Each round turns the links around the nodes' least neighbours: first every node hands all
    its larger neighbours to its least one, then all its smaller ones. Rounds end when nothing
    changes; their number grows with the logarithm of the longest path. Every round's links are
    written to the shared folder, so no plan grows and a lost executor costs one scan. A node's
    neighbours are never gathered: both steps are a minimum per node and a join.
    """
    now = staged(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = staged(large.filter("a <> b").distinct(), "links")
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(low, "a")
            .filter("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(low.select("a", F.col("least").alias("b")))
            .distinct()
        )
        new = staged(small, "links")
        count = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
        if now.agg(count).first() == new.agg(count).first():
            break
        now = new
    tops = new.select(F.col("b").alias("node")).distinct()
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component"))
    )
