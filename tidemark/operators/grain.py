"""Give a table the grain of the question: one row per participant, one row per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.session import staged


def unpivot_sides(
    matches: DataFrame,
    shared: Sequence[str],
    mirrored: dict[str, tuple[str, str]],
    side_flag: str = "is_home",
) -> DataFrame:
    """Two rows per two-sided row, from one scan.

    `mirrored` maps an output column to its (home view, away view) source columns, so each
    mapping is written once and the second side is the first one swapped.
    """

    def side(which: int, flag: bool) -> Column:
        views = [F.col(pair[which]).alias(name) for name, pair in mirrored.items()]
        return F.struct(F.lit(flag).alias(side_flag), *views)

    both = F.explode(F.array(side(0, True), side(1, False))).alias("side")
    return matches.select(*shared, both).select(*shared, "side.*")


def own_and_opponent(**pairs: tuple[str, str, str, str]) -> dict[str, tuple[str, str]]:
    """Mirrored columns from (own name, opponent name, home column, away column) entries."""
    mirrored = {}
    for own, other, home, away in pairs.values():
        mirrored[own] = (home, away)
        mirrored[other] = (away, home)
    return mirrored


def _positions(calendar: DataFrame, period: str) -> tuple[DataFrame, int]:
    """The calendar with each period's position in it, and how many there are.

    A calendar has one row per period, so numbering it is one small window. It is written and read
    back: its size is then known, and Spark's own check decides whether a join sends it to every
    task or shuffles.
    """
    place = (F.row_number().over(Window.orderBy(period)) - 1).alias("_place")
    numbered = staged(calendar.filter(F.col(period).isNotNull()).select("*", place), "calendar")
    return numbered, numbered.count()


def dense_grid(entities: DataFrame, calendar: DataFrame, period: str) -> DataFrame:
    """Every entity in every period of the calendar, without a cross join.

    Each entity row unfolds into the calendar's positions and meets the calendar on them, so
    periods may lie as far apart as they like. The size of the result is entities x periods by
    definition.
    """
    numbered, rows = _positions(calendar, period)
    spread = entities.withColumn("_place", F.explode(_upto(rows)))
    return spread.join(numbered, "_place").select(period, *entities.columns, *[c for c in calendar.columns if c != period])


def _upto(rows: int) -> Column:
    if rows == 0:
        return F.array().cast("array<int>")
    return F.sequence(F.lit(0), F.lit(rows - 1))


def dense_cells(
    entities: DataFrame,
    cells: DataFrame,
    calendar: DataFrame,
    entity: str,
    period: str,
    counts: Sequence[str],
) -> DataFrame:
    """The dense grid with facts laid on it; a missing count is zero, other measures are NULL.

    `cells` are facts already reduced to one row per entity and period; two of them in one place
    stop the query. They move as one array per entity, in which a cell's place is its period's
    position in the calendar, and the grid unfolds after that shuffle. So no grid row is looked up
    or shuffled, and a window over an entity's periods needs no exchange.
    """
    numbered, rows = _positions(calendar, period)
    measures = [c for c in cells.columns if c not in (entity, period)]
    placed = cells.join(numbered.select(period, "_place"), period).withColumn("_cell", F.struct(*measures))
    none = f"CAST(NULL AS {placed.schema['_cell'].dataType.simpleString()})"
    entries = placed.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("_place", "_cell"))).alias("_entries"))
    until = f"coalesce(get(_entries, i + 1)._place, {rows})"
    gap = f"if({until} > e._place, {until} - e._place - 1, raise_error('two cells of one entity and period'))"
    laid = (
        f"concat(array_repeat({none}, coalesce(get(_entries, 0)._place, {rows})),"
        f" flatten(transform(coalesce(_entries, array()), (e, i) -> concat(array(e._cell), array_repeat({none}, {gap})))))"
    )
    wide = entities.join(entries, entity, "left").select(*entities.columns, F.posexplode(F.expr(laid)).alias("_place", "_cell"))
    grid = wide.select(*entities.columns, "_place", "_cell.*").na.fill(0, subset=list(counts))
    rest = [c for c in calendar.columns if c != period]
    return grid.join(numbered, "_place").select(period, *entities.columns, *measures, *rest)


def day_calendar(events: DataFrame, time: str, day: str = "day") -> DataFrame:
    """All days from the first to the last event, including days without one."""
    date = F.col(time).cast("date")
    return events.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias(day)
    )


def rolling_outlook(
    grid: DataFrame,
    entity: str,
    period: str,
    sums: dict[str, str],
    horizon: int,
    averages: dict[str, tuple[str, str]] | None = None,
    cast: str = "int",
) -> DataFrame:
    """Totals over each period and the next `horizon - 1`, on a dense grid.

    `sums` maps output names to columns; `averages` maps output names to (total, count) columns
    and divides the windowed sums, since an average of averages would weigh a period with one
    fact like a period with two. A window holds one entity's periods, so it is as long as the
    calendar whatever the number of facts.
    """
    ahead = (
        Window.partitionBy(entity)
        .orderBy(F.col(period).asc_nulls_last())
        .rowsBetween(Window.currentRow, horizon - 1)
    )
    prefix = f"next_{horizon}"
    covered = F.count(F.lit(1)).over(ahead)
    out = {f"{prefix}_{name}": F.sum(column).over(ahead).cast(cast) for name, column in sums.items()}
    for name, (total, count) in (averages or {}).items():
        out[f"{prefix}_{name}"] = ratio(F.sum(total).over(ahead), F.sum(count).over(ahead))
    out[f"{prefix}_gameweeks_covered"] = covered.cast(cast)
    out[f"{prefix}_is_partial"] = covered < horizon
    return grid.withColumns(out)


def text_in_order(label: str, *order: str, separator: str = ", ") -> Column:
    """An aggregate: the labels of a group as one text, by the order columns, unknown ones last."""
    keys = [k for c in order for k in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    in_order = F.array_sort(F.collect_list(F.struct(*keys, F.col(label).alias("label"))))
    text = F.array_join(F.transform(in_order, lambda e: e["label"]), separator)
    return F.nullif(text, F.lit(""))


def ordered_labels(
    facts: DataFrame,
    keys: Sequence[str],
    label: str,
    order: str,
    tie_break: str,
    name: str,
    separator: str = ", ",
) -> DataFrame:
    """The labels of all facts of each key as one text, in order; NULL labels are left out.

    Every fact has its entry, repeats included, so the text of a key is as long as its facts.
    """
    text = text_in_order(label, order, tie_break, separator=separator)
    return facts.filter(F.col(label).isNotNull()).groupBy(*keys).agg(text.alias(name))
