"""Data-quality checks. Each returns the rows that break a rule; no rows means it holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import apart, differs

# Fixed value: the largest share of the budget the cheapest legal squad may take.
FLOOR_SHARE = 0.85


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. NULLs are not values."""
    return unique_combination(df.filter(f"`{column}` IS NOT NULL"), [column])


def unique_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`unique` for several columns of a table from one scan and one shuffle."""
    values = ", ".join(f"struct('{c}' AS column_name, CAST(`{c}` AS STRING) AS value)" for c in columns)
    each = df.selectExpr(f"inline(array({values}))").filter("value IS NOT NULL")
    return unique_combination(each, ["column_name", "value"])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*columns).agg(F.expr("count(1) AS duplicate_count"))
    return counted.filter("duplicate_count > 1")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts of all the columns from one pass over the table, one row per bad column."""
    counted = ", ".join(
        f"struct('{c}' AS column_name, count_if(`{c}` IS NULL) AS null_count)" for c in columns
    )
    return df.agg(F.expr(f"inline(array({counted}))")).filter("null_count > 0")


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values without a parent, and how many rows carry them. NULL keys refer to nothing.

    Rows are counted per key first, so the join meets each key once however often it occurs.
    """
    used = (
        df.filter(f"`{column}` IS NOT NULL").groupBy(column).agg(F.expr("count(1) AS row_count"))
    )
    known = parent.selectExpr(f"`{parent_column}` AS `{column}`")
    return used.join(known, column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside a vocabulary, and how many rows carry them. NULL is left to `not_null`."""
    counted = df.groupBy(column).agg(F.expr("count(1) AS row_count"))
    return counted.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def accepted_columns(df: DataFrame, accepted: Mapping[str, Iterable]) -> DataFrame:
    """`accepted_values` for several columns of a table from one scan."""
    cells = [
        f"struct('{c}' AS column_name, CAST(`{c}` AS STRING) AS value,"
        f" array({', '.join(repr(str(v)) for v in values)}) AS vocabulary)"
        for c, values in accepted.items()
    ]
    outside = df.selectExpr(f"inline(array({', '.join(cells)}))").filter(
        "value IS NOT NULL AND NOT array_contains(vocabulary, value)"
    )
    return outside.groupBy("column_name", "value").agg(F.expr("count(1) AS row_count"))


def column_types(frames: Mapping[str, DataFrame], expected: Mapping[str, str]) -> DataFrame:
    """Columns, named `model.column`, whose type has drifted, and how many values that concerns.

    Types come from the schemas when the check is planned; a column that is gone fails there.
    Only drifted columns are read, each table once.
    """
    drifted: dict[str, list[tuple[str, str, str]]] = {}
    for reference, wanted in expected.items():
        model, column = reference.split(".")
        actual = frames[model].schema[column].dataType.simpleString()
        if actual != wanted:
            drifted.setdefault(model, []).append((column, actual, wanted))
    if not drifted:
        spark = next(iter(frames.values())).sparkSession
        return spark.createDataFrame(
            [], "column_ref string, actual_type string, expected_type string, value_count bigint"
        )
    parts = []
    for model, columns in drifted.items():
        rows = [
            F.struct(
                F.lit(f"{model}.{column}").alias("column_ref"),
                F.lit(actual).alias("actual_type"),
                F.lit(wanted).alias("expected_type"),
                F.count(column).alias("value_count"),
            )
            for column, actual, wanted in columns
        ]
        found = frames[model].agg(F.array(*rows).alias("found"))
        parts.append(found.select(F.explode("found").alias("f")).select("f.*"))
    return reduce(DataFrame.unionByName, parts)


def one_snapshot(models: Mapping[str, DataFrame], loads: DataFrame) -> DataFrame:
    """Models not read from exactly one load, from an uncommitted one, or not all from the same.

    A load id counts as uncommitted under SQL's NOT IN: an unknown id on either side decides
    nothing. Per model only distinct ids travel.
    """
    parts = [
        df.select(F.lit(name).alias("model_name"), "load_id") for name, df in models.items()
    ]
    per_model = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("model_name")
        .agg(F.countDistinct("load_id").alias("distinct_loads"), F.min("load_id").alias("load_id"))
    )
    committed = loads.filter("is_committed").select("load_id").distinct()
    unknown_committed = committed.agg(F.count_if(F.col("load_id").isNull())).scalar()
    loads_read = per_model.agg(F.countDistinct("load_id")).scalar()
    known = committed.select(F.col("load_id").alias("known_load"))
    uncommitted = (
        F.col("known_load").isNull() & F.col("load_id").isNotNull() & (unknown_committed == 0)
    )
    return (
        per_model.join(known, F.col("load_id") == F.col("known_load"), "left")
        .filter((F.col("distinct_loads") != 1) | uncommitted | (loads_read != 1))
        .select("model_name", "distinct_loads", "load_id")
    )


def rules_agree(positions: DataFrame, settings: DataFrame) -> DataFrame:
    """The per-position squad rules against the squad and lineup sizes stated elsewhere."""
    sums = positions.agg(
        F.struct(
            F.sum("squad_required").alias("required"),
            F.sum("lineup_min").alias("least"),
            F.sum("lineup_max").alias("most"),
        )
    ).scalar()
    both = settings.select("squad_size", "lineup_size").withColumn("p", sums)
    size_differs = F.col("p.required") != F.col("squad_size")
    unreachable = (F.col("lineup_size") < F.col("p.least")) | (
        F.col("lineup_size") > F.col("p.most")
    )

    def broken(rule: Column, name: str, stated: str, expected: str) -> Column:
        row = F.struct(
            F.lit(name).alias("invariant"),
            F.col(f"p.{stated}").alias("from_positions"),
            F.col(expected).cast("long").alias("from_settings"),
        )
        return F.when(rule, row)

    rows = F.array_compact(
        F.array(
            broken(size_differs, "squad size", "required", "squad_size"),
            broken(unreachable, "lineup size is reachable", "least", "lineup_size"),
        )
    )
    return both.select(F.explode(rows).alias("r")).select("r.*")


def sides_balance(sides: DataFrame) -> DataFrame:
    """Fixtures whose two rows do not mirror each other. Scores not yet known agree."""
    home, away = F.col("is_home"), ~F.col("is_home")

    def on(side: Column, column: str, name: str) -> Column:
        return F.max(F.when(side, F.col(column))).alias(name)

    paired = sides.groupBy("fixture_id").agg(
        F.count(F.lit(1)).alias("side_count"),
        F.count_if(home).alias("home_count"),
        F.count_if(away).alias("away_count"),
        on(home, "team_id", "home_team"),
        on(away, "team_id", "away_team"),
        on(home, "opponent_team_id", "home_opponent"),
        on(away, "opponent_team_id", "away_opponent"),
        on(home, "difficulty", "home_difficulty"),
        on(away, "difficulty", "away_difficulty"),
        on(home, "opponent_difficulty", "home_opponent_difficulty"),
        on(away, "opponent_difficulty", "away_opponent_difficulty"),
        on(home, "goals_for", "home_goals_for"),
        on(away, "goals_against", "away_goals_against"),
    )
    c = F.col
    return paired.filter(
        (c("side_count") != 2)
        | (c("home_count") != 1)
        | (c("away_count") != 1)
        | (c("home_opponent") != c("away_team"))
        | (c("away_opponent") != c("home_team"))
        | differs(c("home_difficulty"), c("away_opponent_difficulty"))
        | differs(c("away_difficulty"), c("home_opponent_difficulty"))
        | differs(c("home_goals_for"), c("away_goals_against"))
    )


def grid_complete(
    grid: DataFrame, entities: DataFrame, calendar: DataFrame, entity: str, period: str
) -> DataFrame:
    """Gaps and duplicates of a dense grid: first its overall shape, then each entity's coverage.

    Distinct pairs are counted as structs, since a NULL in a pair must still count. Both checks
    start from one row per pair.
    """
    pairs = grid.groupBy(entity, period).agg(F.count(F.lit(1)).alias("copies"))
    shape = pairs.agg(
        F.sum("copies").alias("row_count"),
        F.count(F.lit(1)).alias("pair_count"),
        F.countDistinct(entity).alias("team_count"),
        F.countDistinct(period).alias("gameweek_count"),
    )
    n_entities = entities.agg(F.count(F.lit(1))).scalar()
    n_periods = calendar.agg(F.count(F.lit(1))).scalar()
    c = F.col
    bad_shape = shape.withColumns({"e": n_entities, "p": n_periods}).filter(
        (c("row_count") != c("pair_count"))
        | (c("row_count") != c("e") * c("p"))
        | (c("team_count") != c("e"))
        | (c("gameweek_count") != c("p"))
    )
    covered = (
        pairs.groupBy(entity)
        .agg(F.sum("copies").alias("gameweeks"))
        .withColumn("p", n_periods)
        .filter(c("gameweeks") != c("p"))
    )
    return bad_shape.select(
        F.lit("grid_shape").alias("failure"),
        "row_count",
        "pair_count",
        "team_count",
        "gameweek_count",
    ).unionByName(
        covered.select(
            F.lit("team_coverage").alias("failure"),
            c("gameweeks").alias("row_count"),
            c("gameweeks").alias("pair_count"),
            c(entity).cast("long").alias("team_count"),
            F.lit(None).cast("long").alias("gameweek_count"),
        )
    )


def budget_holds(scarcity: DataFrame, floor_share: float = FLOOR_SHARE) -> DataFrame:
    """The cheapest legal squad fits the budget with room to choose, and the mart adds up."""
    c = F.col
    squad = scarcity.agg(
        F.max("minimum_squad_gbp_m").alias("minimum_squad_gbp_m"),
        F.max("budget_gbp_m").alias("budget_gbp_m"),
        F.max("budget_headroom_gbp_m").alias("headroom_gbp_m"),
        F.sum("cheapest_fill_gbp_m").alias("summed_fill_gbp_m"),
        F.sum("squad_required").alias("squad_slots"),
        F.max("squad_size").alias("squad_size"),
    )
    return squad.filter(
        (c("minimum_squad_gbp_m") > c("budget_gbp_m"))
        | (c("minimum_squad_gbp_m") > c("budget_gbp_m") * floor_share)
        | apart(c("minimum_squad_gbp_m"), c("summed_fill_gbp_m"))
        | apart(c("headroom_gbp_m"), c("budget_gbp_m") - c("minimum_squad_gbp_m"))
        | (c("squad_slots") != c("squad_size"))
    ).drop("summed_fill_gbp_m")


def prior_flag_holds(valued: DataFrame, evidence: Column) -> DataFrame:
    """The provenance flag is the same on every row and equals what the data shows."""
    c = F.col
    return (
        valued.agg(
            F.min("points_are_prior_season").alias("labelled"),
            F.countDistinct("points_are_prior_season").alias("distinct_flags"),
            F.count(F.lit(1)).alias("player_count"),
        )
        .withColumn("evidenced", evidence)
        .filter(differs(c("labelled"), c("evidenced")) | (c("distinct_flags") != 1))
        .select("labelled", "evidenced", "distinct_flags", "player_count")
    )
