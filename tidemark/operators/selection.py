"""Choosing periods: those whose numbers can still move, and those named by range specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: gameweeks in a season, the upper end of a valid range spec.
LAST_GAMEWEEK = 38


def flag(name: str) -> Column:
    """A flag that may be missing or null counts as not set."""
    return F.coalesce(F.col(name), F.lit(False))


def unsettled(periods: DataFrame, key: str = "id") -> DataFrame:
    """Period ids still worth re-reading, once each; no rows is a valid answer.

    The running one; the one before it even when already checked, because the check may have
    come after the last read; and any that finished without having been checked.
    """
    open_ended = flag("finished") & ~flag("data_checked")
    return (
        periods.filter(F.col(key).isNotNull())
        .filter(flag("is_current") | flag("is_previous") | open_ended)
        .select(key)
        .distinct()
    )


def _parts(specs: DataFrame, key: str, spec: str) -> DataFrame:
    ends = F.split("part", "-", 2)
    return (
        specs.select(key, F.explode(F.split(spec, ",")).alias("part"))
        .withColumn("part", F.trim("part"))
        .filter(F.col("part") != "")
        .withColumn("is_range", F.contains(F.col("part"), F.lit("-")))
        .withColumn("lo", F.trim(ends[0]).try_cast("int"))
        .withColumn("hi", F.when(F.col("is_range"), F.trim(F.get(ends, F.lit(1))).try_cast("int")).otherwise(F.col("lo")))
    )


def range_spec_errors(
    specs: DataFrame, key: str, spec: str, last: int = LAST_GAMEWEEK
) -> DataFrame:
    """The parts that make a spec unusable, with the reason."""
    lo, hi = F.col("lo"), F.col("hi")
    reason = (
        F.when(lo.isNull() | hi.isNull(), "not numeric")
        .when(lo > hi, "inverted")
        .when((lo < 1) | (hi > last), "outside")
    )
    return (
        _parts(specs, key, spec)
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select(key, "part", "reason")
    )


def expand_range_specs(
    specs: DataFrame, key: str, spec: str, period: str, last: int = LAST_GAMEWEEK
) -> DataFrame:
    """Each spec such as "1,3,5-7" as its distinct periods. A spec with any bad part gives none;
    `range_spec_errors` says why. Every list is at most `last` long."""
    parts = _parts(specs, key, spec).withColumn(
        "good",
        F.coalesce(
            (F.col("lo") <= F.col("hi")) & (F.col("lo") >= 1) & (F.col("hi") <= last), F.lit(False)
        ),
    )
    each = F.when(F.col("good"), F.sequence("lo", "hi")).otherwise(F.array().cast("array<int>"))
    return (
        parts.groupBy(key)
        .agg(
            F.bool_and("good").alias("all_good"),
            F.array_distinct(F.flatten(F.collect_set(each))).alias("periods"),
        )
        .filter("all_good")
        .select(key, F.explode("periods").alias(period))
    )
