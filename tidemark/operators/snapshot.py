"""Which rows of an append-only table count: one committed load, or history over all of them.

A table at a point in time is every row of its newest committed load. That is not the newest
row per key: an entity that vanished from the source must vanish here as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import differs, epoch_text_to_timestamp
from tidemark.session import staged

# Fixed value: the ledger status of a load whose every file was written.
COMMITTED = 0
LOAD_ID = "_dlt_load_id"


def conform_ledger(ledger: DataFrame) -> DataFrame:
    """The whole load history; load ids are epoch seconds as text, so they give the start."""
    return ledger.select(
        "load_id",
        "schema_name",
        "status",
        (F.col("status") == COMMITTED).alias("is_committed"),
        F.col("inserted_at").alias("loaded_at"),
        "schema_version_hash",
        epoch_text_to_timestamp(F.col("load_id")).alias("load_started_at"),
    )


def newest_load(ledger: DataFrame) -> DataFrame:
    """One row: the newest committed load id, by number rather than by text, without a sort."""
    return ledger.filter(F.col("status") == COMMITTED).agg(
        F.max_by("load_id", F.col("load_id").cast("double")).alias("load_id")
    )


def latest_committed_load(ledger: DataFrame) -> str | None:
    """The newest committed load id as one driver value, so a whole build reads one snapshot."""
    return newest_load(ledger).first()["load_id"]


def snapshot_rows(
    table: DataFrame, load_id: str, load_column: str = LOAD_ID, dates: Sequence[str] | None = None
) -> DataFrame:
    """Every row of one load; the load id alone decides.

    `dates` are those the load's ledger row lists: where the table has `load_date`, no other
    date is read.
    """
    rows = table
    if dates is not None and "load_date" in table.columns:
        rows = rows.filter(F.col("load_date").isin(*[F.to_date(F.lit(d)) for d in dates]))
    return rows.filter(F.col(load_column) == load_id)


def committed_rows(
    table: DataFrame, ledger: DataFrame, load_column: str = LOAD_ID
) -> DataFrame:
    """Rows of all committed loads. The ledger has one row per run and joins as the small side."""
    committed = ledger.filter(F.col("status") == COMMITTED).select(F.col("load_id").alias(load_column))
    return table.join(committed, load_column, "left_semi")


# Rows of one key that tie for the newest place are compared in so many tasks first.
TIE_SALTS = 64


def latest_per_key(
    observations: DataFrame, keys: list[str], order: Column | Sequence[Column], columns: list[str]
) -> DataFrame:
    """The newest observation of each key, whole rows read only for the newest place.

    `order` is one column or several, the most significant first; the first should have a fixed
    width (a number, date or timestamp). The first pass reads keys and this column alone and keeps
    the greatest one per key, a hash aggregate that combines map-side. The second pass reads
    `columns` and keeps the rows at that place by a semi join, which AQE turns into a broadcast
    where the keys are few. Only these rows, about one per key, are compared by what is left of
    the order, in two levels, so a key whose rows all tie spreads over `TIE_SALTS` tasks. Nulls in
    the order come before all values and a null key is a key; rows that tie in all of the order
    are decided by the hash of their `columns` (no maps), so the result does not depend on how they
    are read; repeated rows count once.
    """
    first, *rest = [order] if isinstance(order, Column) else order
    # A key column may be asked for again as a value, so places in the row stand for names.
    cells = [F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]
    names = [f"k{i}" for i in range(len(keys))]
    narrow = observations.select(*cells, first.alias("o"))
    newest = narrow.groupBy(*names).agg(F.max("o").alias("best")).toDF(*[f"_{n}" for n in names], "best")
    rows = observations.select(
        *cells,
        first.alias("o"),
        *[c.alias(f"r{i}") for i, c in enumerate(rest)],
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)],
    )
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    tied = rows.join(newest, same & F.col("o").eqNullSafe(F.col("best")), "left_semi").distinct()
    values = [f"c{i}" for i in range(len(columns))]
    tied = tied.withColumn("address", F.xxhash64(*values) if values else F.lit(0).cast("long"))
    falling = [*[F.col(f"r{i}").desc_nulls_last() for i in range(len(rest))], F.col("address").desc()]
    salted = tied.withColumn("salt", F.pmod(F.hash(*[f"r{i}" for i in range(len(rest))], "address"), F.lit(TIE_SALTS)))
    for within in ([*names, "salt"], names):
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*falling))
        salted = salted.withColumn("place", place).filter("place = 1")
    return salted.select(*names, *values).toDF(*keys, *columns)


def value_changes(
    history: DataFrame, key: str, order: str, value: str, buckets: Sequence[str] = ()
) -> DataFrame:
    """Rows where a key's value differs from its previous one, the first row included, and how long
    each value held: `valid_from` is the row's own place, `valid_to` that of the next change (null
    for the value that still holds).

    `history` holds one row per key and load. `buckets` are columns that do not decrease along
    `order` (month and day of a load, say): one task compares one bucket of one key, and the last
    value of the buckets before, or the next change of those after, comes in as one row per bucket.
    So a key with most of the history spreads over as many tasks as it has buckets.
    """
    parts = [key, *buckets]
    inside = Window.partitionBy(*parts).orderBy(F.col(order).asc_nulls_last())
    along = Window.partitionBy(key).orderBy(*[F.col(b).asc_nulls_last() for b in buckets]) if buckets else None
    seen = F.struct(F.col(value).alias("value"))

    def carried(ends: DataFrame, name: str) -> tuple[DataFrame, Column]:
        """One row per bucket, its part columns renamed, and the null-safe condition to join it."""
        renamed = ends.select(*[F.col(c).alias(f"_{c}") for c in parts], name)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in parts])
        return renamed, same

    rows = history.select(key, *buckets, order, value).withColumn("_previous", F.lag(seen).over(inside))
    if buckets:
        last = F.max_by(seen, F.struct(F.col(order).isNull(), F.col(order)))
        ends = history.groupBy(*parts).agg(last.alias("_last"))
        ends, same = carried(ends.withColumn("_carried", F.lag("_last").over(along)), "_carried")
        rows = rows.join(ends, same, "left").withColumn("_previous", F.coalesce("_previous", "_carried"))
    rows = rows.select(
        *parts, order, F.col("_previous.value").alias("previous_value"), value, F.col("_previous").isNull().alias("is_first")
    )
    changes = rows.filter(F.col("is_first") | differs(F.col(value), F.col("previous_value")))
    until = F.lead(order).over(inside)
    if buckets:
        changes = staged(changes, "changes")
        starts, same = carried(
            changes.groupBy(*parts).agg(F.min(order).alias("_start")).withColumn("_next", F.lead("_start").over(along)), "_next"
        )
        changes = changes.withColumn("_until", until).join(starts, same, "left")
        until = F.coalesce("_until", "_next")
    return changes.select(
        key, order, "previous_value", value, "is_first", F.col(order).alias("valid_from"), until.alias("valid_to")
    )
