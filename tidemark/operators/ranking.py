"""Ranks, medians and fills that hold when one group has a third of all rows.

A window over a whole group sorts that group in one task. Here a group is first reduced to one
row per distinct value (a map-side count), the values are cut into buckets of bounded weight,
and a running total of the counts (bucket offset + position inside the bucket) gives every rank.

The first cuts are quantiles of the whole column, as literals. Each of these parts is cut again
at quantiles of its own, which are a small table joined by the part's number: the more rows
there are, the more cuts, so a bucket has about `WEIGHT` distinct values at every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.session import staged

BUCKETS = 256
# Distinct values one window task sorts, about.
WEIGHT = 500_000
# Split points need not be exact: a sketch this many times finer than a bucket stays small.
SKETCH_DETAIL = 4


class Cuts(list):
    """Quantiles of a column, and how many rows it has."""

    def __init__(self, points: Sequence[float], rows: int) -> None:
        super().__init__(points)
        self.rows = rows

    def finer(self, weight: int) -> int:
        """Into how many buckets each part between two cuts is cut again."""
        return max(1, -(-self.rows // ((len(self) + 1) * weight)))


def split_points(df: DataFrame, values: Sequence[str], buckets: int = BUCKETS) -> dict[str, Cuts]:
    """Up to `buckets - 1` quantiles of each numeric column, all from one pass.

    These few numbers become literals, so a recomputed task cuts the values the same way.
    """
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    sketches = [
        F.expr(f"percentile_approx(CAST(`{v}` AS DOUBLE), array({shares}), {SKETCH_DETAIL * buckets}) AS q{i}")
        for i, v in enumerate(values)
    ]
    row = df.agg(*sketches, F.expr("count(1) AS rows")).first()
    return {v: Cuts(sorted(set(row[f"q{i}"] or [])), row["rows"]) for i, v in enumerate(values)}


def _with_bucket(df: DataFrame, value: str, points: list, descending: bool) -> DataFrame:
    """Add the bucket number in rank order; NULLs form the last bucket.

    The cuts are searched in two levels, about two square roots of their number of comparisons.
    """
    step = max(1, math.isqrt(len(points)))
    blocks = [points[i : i + step] for i in range(0, len(points), step)] + [[]]

    def array(cuts: Sequence[float]) -> str:
        return f"CAST(array({', '.join(f'{float(p)!r}D' for p in cuts)}) AS array<double>)"

    number = f"CAST(`{value}` AS DOUBLE)"
    block = f"size(filter({array([b[-1] for b in blocks[:-1]])}, p -> p <= {number})) AS block"
    inside = f"array({', '.join(array(b) for b in blocks)})[block]"
    below = f"block * {step} + size(filter({inside}, p -> p <= {number}))"
    last = step * (len(blocks) - 1)
    place = f"{last} - ({below})" if descending else below
    return (
        df.selectExpr("*", block)
        .selectExpr("*", f"if(`{value}` IS NULL, {last + 1}, {place}) AS bucket")
        .drop("block")
    )


def _cut_again(df: DataFrame, value: str, finer: int, descending: bool) -> DataFrame:
    """Split every bucket at `finer - 1` quantiles of its own values, in rank order."""
    shares = ", ".join(f"{i / finer!r}D" for i in range(1, finer))
    number = f"CAST(`{value}` AS DOUBLE)"
    cuts = df.groupBy(F.col("bucket").alias("part")).agg(
        F.expr(f"percentile_approx({number}, array({shares}), {SKETCH_DETAIL * finer}) AS cuts")
    )
    # The cuts' own quantiles say which few of them have to be looked at.
    step = max(1, math.isqrt(finer))
    heads = cuts.selectExpr(
        "part",
        f"transform(sequence(0, greatest(coalesce(size(cuts), 0) - 1, 0) DIV {step}), i -> slice(coalesce(cuts, array()), i * {step} + 1, {step})) AS groups",
    ).selectExpr("part", "groups", "transform(groups, g -> try_element_at(g, -1)) AS heads")
    group = f"least(size(filter(heads, p -> p <= {number})), size(groups) - 1)"
    inside = f"size(filter(groups[{group}], p -> p <= {number}))"
    below = f"coalesce({group} * {step} + {inside}, 0)"
    place = f"{finer} - {below}" if descending else below
    return (
        df.join(heads, F.col("bucket") == F.col("part"), "left")
        .selectExpr(*[f"`{c}`" for c in df.columns if c != "bucket"], f"CAST(bucket AS BIGINT) * {finer + 1} + {place} AS bucket")
    )


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _same_row(columns: Sequence[str]) -> str:
    """Null-safe equality of columns with their underscored copies."""
    return " AND ".join(f"`{c}` <=> `_{c}`" for c in columns)


def value_positions(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    descending: bool = False,
    points: Cuts | None = None,
    weight: int = WEIGHT,
) -> DataFrame:
    """One row per (keys, value): `ties` rows have it and `before` rows precede it, of
    `group_rows` rows in the group, `value_rows` of which have a value.

    Works for no keys at all, which is the global case. No window covers more than one bucket of
    distinct values, or one row per bucket.
    """
    keys = list(keys)
    if points is None:
        points = split_points(df, [value])[value]
    counted = _with_bucket(
        df.groupBy(*keys, value).agg(F.expr("count(1) AS ties")), value, points, descending
    )
    finer = points.finer(weight)
    if finer > 1:
        counted = _cut_again(counted, value, finer, descending)

    group = _names(keys) or "0"
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = (
        counted.groupBy(*keys, "bucket")
        .agg(
            F.expr("sum(ties) AS in_bucket"),
            F.expr(f"sum(if(`{value}` IS NULL, 0, ties)) AS known"),
        )
        .selectExpr(
            *[f"`{k}` AS `_{k}`" for k in keys],
            "bucket AS _bucket",
            f"coalesce(sum(in_bucket) OVER (PARTITION BY {group} ORDER BY bucket {earlier}), 0)"
            " AS offset",
            f"sum(in_bucket) OVER (PARTITION BY {group}) AS group_rows",
            f"sum(known) OVER (PARTITION BY {group}) AS value_rows",
        )
    )

    direction = "DESC NULLS LAST" if descending else "ASC NULLS LAST"
    inside = (
        f"sum(ties) OVER (PARTITION BY {_names([*keys, 'bucket'])}"
        f" ORDER BY `{value}` {direction} {earlier})"
    )
    return (
        counted.selectExpr("*", f"coalesce({inside}, 0) AS inside")
        .join(offsets, F.expr(_same_row([*keys, "bucket"])))
        .selectExpr(
            *[f"`{c}`" for c in [*keys, value]],
            "ties",
            "offset + inside AS before",
            "group_rows",
            "value_rows",
        )
    )


# Rank-like outputs over value positions, as SQL text.
RANK = "before + 1"
# (rank - 1) / (rows - 1); zero in a group of one row, as SQL defines it.
PERCENT_RANK = "coalesce(try_divide(CAST(before AS DOUBLE), CAST(group_rows - 1 AS DOUBLE)), 0D)"


def reverse_rank(value: str) -> str:
    """The rank in the opposite order, NULLs still last, from the same positions."""
    return f"if(`{value}` IS NULL, before, value_rows - before - ties) + 1"


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    outputs: dict[str, str],
    descending: bool = False,
    points: Cuts | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add rank-like columns (name to SQL text) computed from the (keys, value) table.

    `source` is the frame to take the positions from when `df` is the same rows further along;
    several rankings in a row then all start from the one source.

    The way back is a null-safe equality join with that table, one row per pair: small tables
    are sent to every task by Spark's own size check, larger ones meet in a shuffle whose hot
    pairs the skew-join rule splits.
    """
    pair = [*keys, value]
    positions = value_positions(df if source is None else source, keys, value, descending, points)
    ranks = positions.selectExpr(
        *[f"`{c}` AS `_{c}`" for c in pair], *[f"{e} AS `{n}`" for n, e in outputs.items()]
    )
    return df.join(ranks, F.expr(_same_row(pair)), "left").drop(*[f"_{c}" for c in pair])


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    descending: bool = True,
    points: Cuts | None = None,
) -> DataFrame:
    """rank(): ties share a rank and leave a gap after it; NULLs come last and tie."""
    return with_positions(df, keys, value, {name: RANK}, descending, points)


def with_percent_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    descending: bool = False,
    points: Cuts | None = None,
) -> DataFrame:
    return with_positions(df, keys, value, {name: PERCENT_RANK}, descending, points)


# Ranks in a sketch are right to one part in so many; brackets are a few parts wide.
SKETCH_PARTS = 10_000
BRACKET_PARTS = 4
# Distinct values of one group that are looked through one by one at the end.
FEW = 1 << 16
CELLS = 256


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, outputs: dict[str, float], few: int = FEW, parts: int = SKETCH_PARTS
) -> DataFrame:
    """Exact quantiles of each group by selection, interpolated between neighbours; NULLs are
    ignored, and so are groups without a value.

    `outputs` maps names to shares. No group is sorted: a sketch brackets the two neighbours of
    each share, one hash aggregate counts the rows below each bracket and the distinct values in
    it, and where these are still many, the bracket is cut into cells, the cells are weighed and
    the one with the wanted rank becomes the bracket. At most `few` values of a group meet.
    """
    keys, known = list(keys), df.filter(f"`{value}` IS NOT NULL")
    shares = list(outputs.values())
    number = f"CAST(`{value}` AS DOUBLE)"
    slack = BRACKET_PARTS / parts
    ends = ", ".join(f"{max(0.0, q - slack)!r}D, {min(1.0, q + slack)!r}D" for q in shares)
    sketch = known.groupBy(*keys).agg(
        F.expr(f"percentile_approx({number}, array({ends}), {parts})").alias("_ends"), F.count(F.lit(1)).alias("_rows")
    )
    sketch = staged(sketch.select(*[F.col(k).alias(f"_{k}") for k in keys], "_ends", "_rows"), "quantile-sketch")
    most = sketch.agg(F.max("_rows")).first()[0] or 0

    # One row per group and share; a value counts where it is at or below the bracket's end. In a
    # small group a bracket is less than a few rows wide, so there it is the whole group.
    small = 2 * parts
    ends = ", ".join(f"'{n}', if(_rows <= {small}, NULL, _ends[2 * i + {j}])" for j, n in enumerate(("lo", "hi")))
    bracket = f"explode(transform(sequence(0, {len(shares) - 1}), i -> named_struct('q', i, {ends})))"
    brackets = sketch.selectExpr("*", f"{bracket} AS _b").drop("_ends")
    same = F.expr(_same_row(keys)) if keys else F.lit(True)
    inside = F.when(F.expr(f"_b.lo IS NULL OR {number} >= _b.lo"), F.col(value))
    counted = (
        known.join(brackets, same & F.expr(f"_b.hi IS NULL OR {number} <= _b.hi"))
        .groupBy(*keys, F.col("_b.q").alias("_q"), "_rows", inside.alias("_value"))
        .agg(F.count(F.lit(1)).alias("_ties"))
    )
    groups = [*keys, "_q", "_rows"]
    if max(min(most, small), 2 * BRACKET_PARTS * most // parts) > few:
        counted = _narrowed(staged(counted, "quantile-cells"), groups, shares, few)
    return _selected(counted, groups, keys, outputs)


def _place(shares: Sequence[float]) -> str:
    """The exact place of each share among `_rows` values, from 0; places may lie between two."""
    cases = " ".join(f"WHEN {i} THEN {q!r}D" for i, q in enumerate(shares))
    return f"((CASE _q {cases} END) * (_rows - 1))"


def _narrowed(counted: DataFrame, groups: list[str], shares: Sequence[float], few: int) -> DataFrame:
    """Brackets cut down to at most `few` distinct values each."""
    while True:
        sizes = counted.groupBy(*groups).agg(F.count("_value").alias("_values"))
        if (sizes.agg(F.max("_values")).first()[0] or 0) <= few:
            return counted
        number = "CAST(_value AS DOUBLE)"
        steps = ", ".join(f"{i / CELLS!r}D" for i in range(1, CELLS))
        cuts = counted.filter("_value IS NOT NULL").groupBy(*[F.col(c).alias(f"_{c}") for c in groups]).agg(
            F.expr(f"array_distinct(percentile_approx({number}, array({steps}), {4 * CELLS}))").alias("_cuts")
        )
        celled = counted.join(cuts, F.expr(_same_row(groups))).withColumn(
            "_cell", F.expr(f"if(_value IS NULL, -1, size(filter(_cuts, p -> p <= {number})))")
        ).select(*counted.columns, "_cell")
        weights = celled.groupBy(*groups, "_cell").agg(F.sum("_ties").alias("_weight"))
        # The cells of a group are few: their running weights say which hold the two neighbours.
        listed = weights.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct("_cell", "_weight"))).alias("_cells"))
        low, high = f"CAST(floor({_place(shares)}) AS BIGINT)", f"CAST(ceil({_place(shares)}) AS BIGINT)"
        running = "aggregate(slice(_cells, 1, i + 1), 0L, (s, c) -> s + c._weight)"
        holds = f"element_at(filter(transform(_cells, (c, i) -> if({running} > {{at}}, c._cell, NULL)), c -> c IS NOT NULL), 1)"
        kept = listed.select(
            *[F.col(c).alias(f"_{c}") for c in groups],
            F.expr(holds.format(at=low)).alias("_from"),
            F.expr(holds.format(at=high)).alias("_to"),
        )
        within = F.when(F.col("_cell") >= F.col("_from"), F.col("_value"))
        counted = staged(
            celled.join(kept, F.expr(_same_row(groups)))
            .filter("_cell <= _to")
            .groupBy(*groups, within.alias("_value"))
            .agg(F.sum("_ties").alias("_ties")),
            "quantile-cells",
        )


def _selected(counted: DataFrame, groups: list[str], keys: list[str], outputs: dict[str, float]) -> DataFrame:
    """The values at the wanted places; NULL stands for all rows below the bracket."""
    place = _place(list(outputs.values()))
    listed = counted.groupBy(*groups).agg(
        F.expr("coalesce(sum(if(_value IS NULL, _ties, 0)), 0) AS _below"),
        F.expr("array_sort(collect_list(if(_value IS NULL, NULL, struct(_value, _ties)))) AS _values"),
    )
    found = (
        "aggregate(_values, named_struct('seen', _below, 'found', CAST(NULL AS {kind})),"
        " (s, v) -> named_struct('seen', s.seen + v._ties, 'found',"
        " coalesce(s.found, if(s.seen + v._ties > {at}, v._value, NULL))), s -> s.found)"
    )
    kind = counted.schema["_value"].dataType.simpleString()
    sides = [found.format(kind=kind, at=f"CAST({f}({place}) AS BIGINT)") for f in ("floor", "ceil")]
    sound = f"_below <= CAST(floor({place}) AS BIGINT)"
    both = listed.selectExpr(
        *[f"`{g}`" for g in groups], *[f"if({sound}, {x}, raise_error('bracket')) AS _{n}" for x, n in zip(sides, ("low", "high"))]
    )
    # Halfway is a plain mean of the two, as a median is defined.
    share = f"({place} - floor({place}))"
    number = f"if({share} = 0.5D, (_low + _high) / 2.0D, CAST(_low AS DOUBLE) + (CAST(_high AS DOUBLE) - CAST(_low AS DOUBLE)) * {share})"
    each = both.withColumn("_at", F.expr(number))
    return each.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_q") == i, F.col("_at"))).alias(n) for i, n in enumerate(outputs)]
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The exact median of each group, by selection; NULLs are ignored."""
    return exact_quantiles(df, keys, value, {name: 0.5})


def extreme_fill(
    candidates: DataFrame,
    group: str,
    price: str,
    tie_break: str,
    slots: str,
    name: str,
    dearest: bool = False,
    most_slots: int | None = None,
) -> DataFrame:
    """What the `slots` cheapest (or dearest) candidates of each group cost together.

    `slots` is a column, and a per-row limit cannot be pushed down. The largest slot count is a
    literal limit that can: every task keeps at most that many rows per group before the
    shuffle, so the size of a group does not matter.
    """
    if most_slots is None:
        most_slots = candidates.agg(F.max(slots)).first()[0] or 0
    direction = "DESC NULLS LAST" if dearest else "ASC NULLS LAST"
    place = (
        f"row_number() OVER (PARTITION BY `{group}` ORDER BY `{price}` {direction},"
        f" `{tie_break}`) AS place"
    )
    return (
        candidates.selectExpr(f"`{group}`", f"`{price}`", f"`{slots}`", place)
        .filter(f"place <= {int(most_slots)} AND place <= `{slots}`")
        .groupBy(group)
        .agg(F.expr(f"sum(`{price}`) AS `{name}`"))
    )


def with_share_of_total(df: DataFrame, value: str, total: str, share: str) -> DataFrame:
    """Every row with the sum over the whole relation and its own share of it."""
    whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(total, whole).withColumn(share, ratio(F.col(value), F.col(total)))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
) -> DataFrame:
    """A cumulative sum per key, of which any may have a very long history.

    Every key is split by the `buckets`, columns that do not decrease along `order` (month and
    day of a timestamp, for instance; more of them split a crowded day again). One task sums one
    bucket of one key; the buckets before it come in as a single number, from a window over one
    row per bucket. There is one way for all keys, whatever their size.
    """
    keys, part = list(keys), [*keys, *buckets]
    whole = Window.partitionBy(*part)
    so_far = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = df.withColumn("inside", F.sum(value).over(so_far))
    earlier = Window.partitionBy(*keys).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*part)
        .agg(F.sum(value).alias("in_part"))
        .select(*[F.col(c).alias(f"_{c}") for c in part], F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        summed.join(offsets, F.expr(_same_row(part)))
        .withColumn(name, F.col("offset") + F.col("inside"))
        .select(*df.columns, name)
    )
