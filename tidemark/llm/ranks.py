"""Rows numbered inside their parts, where one part may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged


def numbered(df: DataFrame, part: str, order: list[Column], label: str) -> DataFrame:
    """Adds `rank` (from 0, inside the part) and `size` (rows of the part).

    Rows are dealt by ranges of part and order, so a part spreads over as many tasks as it needs.
    The rows of a task are numbered as they lie; a task's share of a part is counted, and the
    counts before it shift its numbers. Null is a part of its own, before all others.
    """
    keys = [F.col(part).asc_nulls_first(), *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("_share", F.shiftright("_at", 33))
    shares = rows.groupBy(part, "_share").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(part)
    before = whole.orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        F.col(part).alias("_part"),
        F.col("_share").alias("_of"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    same = F.col(part).eqNullSafe(F.col("_part")) & (F.col("_share") == F.col("_of"))
    return rows.join(shares, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "size")
