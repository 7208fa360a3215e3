"""As-of joins: for each row the newest row of another table at or before its moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(
    left: DataFrame,
    right: DataFrame,
    at: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    width: int = 1 << 32,
    right_at: str | None = None,
) -> DataFrame:
    """The rows of `left` with `values` of the newest row of `right` whose moment is not later.

    Moments are longs (`at`, in `right` called `right_at` if named otherwise). Rows meet where all
    `by` columns are equal; null keys meet nothing and null moments find nothing. Of right rows at
    one moment the greatest values count, compared from left to right. `right_at` of the row found
    comes back as `as_of`; where there is none, it and the values are null. No row of `left` is
    lost or doubled.

    Both sides are merged in one sort, split by buckets of `width` moments, so a key with most of
    the rows spreads over as many tasks as it has buckets. What is newest at the end of a bucket is
    carried into the ones after it by a second pass over one row per bucket.
    """
    right_at = right_at or at
    found = F.struct(F.col(right_at).cast("long").alias("as_of"), *[F.col(v) for v in values])
    kind = right.select(found.alias("r")).schema["r"].dataType
    keys = [f"_by{i}" for i in range(len(by))]
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    mine = left.select(
        *named, F.col(at).cast("long").alias("_at"), F.struct(*left.columns).alias("_left"), F.lit(None).cast(kind).alias("_r")
    )
    theirs = right.filter(F.col(right_at).isNotNull())
    for c in by:
        theirs = theirs.filter(F.col(c).isNotNull())
    theirs = theirs.select(
        *named, F.col(right_at).cast("long").alias("_at"), F.lit(None).cast(mine.schema["_left"].dataType).alias("_left"), found.alias("_r")
    )
    at_ = F.col("_at")
    merged = mine.unionByName(theirs).withColumn("_bucket", F.expr(f"(_at - pmod(_at, {width}L)) div {width}L"))
    # Right rows of a moment come before left ones: at or before.
    running = Window.partitionBy(*keys, "_bucket").orderBy(at_, F.col("_left").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = merged.withColumn("_seen", F.when(at_.isNotNull(), F.max("_r").over(running))).filter(F.col("_left").isNotNull())
    ends = merged.groupBy(*keys, "_bucket").agg(F.max("_r").alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(k).alias(f"_c{k}") for k in keys],
        F.col("_bucket").alias("_c_bucket"),
        F.max("_end").over(earlier).alias("_carried"),
    ).filter(F.col("_c_bucket").isNotNull())
    same = F.col("_bucket") == F.col("_c_bucket")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_c{k}"))
    newest = F.coalesce("_seen", "_carried")
    return inside.join(carried, same, "left").select(
        "_left.*", newest["as_of"].alias("as_of"), *[newest[v].alias(v) for v in values]
    )
