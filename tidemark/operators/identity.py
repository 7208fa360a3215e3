"""Two identity domains joined through one map: accounts, and the ids events arrive under."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio


def identity_map(users: DataFrame, identifies: DataFrame) -> DataFrame:
    """(user_id, distinct_id) pairs: what identify calls say, and every user as its own id.

    Kept as pairs rather than one set per user, so a user with very many ids stays many rows.
    """
    itself = users.select("user_id", F.col("user_id").cast("string").alias("distinct_id"))
    said = identifies.select("user_id", F.col("distinct_id").cast("string").alias("distinct_id"))
    return said.unionByName(itself).filter(F.col("distinct_id").isNotNull()).distinct()


def resolution_rate(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """The share of events that resolve through the map; never by comparing ids inline.

    An event counts once however often and under however many ids it was delivered; it is
    resolved if any of its ids is known.
    """
    arrivals = events.select("event_id", "distinct_id").distinct()
    known = mapping.select("distinct_id").distinct().withColumn("is_resolved", F.lit(True))
    per_event = (
        arrivals.join(known, "distinct_id", "left")
        .groupBy("event_id")
        .agg(F.coalesce(F.bool_or("is_resolved"), F.lit(False)).alias("is_resolved"))
    )
    return (
        per_event.agg(
            F.count(F.lit(1)).alias("active_events"),
            F.count_if("is_resolved").alias("resolved_events"),
        )
        .withColumn("resolved_share", ratio(F.col("resolved_events"), F.col("active_events")))
    )


def manager_360(
    users: DataFrame, business: DataFrame, events: DataFrame, mapping: DataFrame
) -> DataFrame:
    """One row per user: business totals and behaviour totals, each reduced before it is joined.

    `business` is already one row per user. An event that arrived under several ids of one user
    counts once for that user: events are reduced to (user, event) before they are counted.
    """
    named = events.select("event_id", "distinct_id").distinct().join(mapping, "distinct_id")
    counted = (
        named.select("user_id", "event_id").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    )
    ids = (
        named.select("user_id", "distinct_id").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("active_ids"))
    )
    behaviour = counted.join(ids, "user_id")
    counts = [c for c in business.columns if c != "user_id"] + ["events", "active_ids"]
    return users.join(business, "user_id", "left").join(behaviour, "user_id", "left").na.fill(
        0, subset=counts
    )
