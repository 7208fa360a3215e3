"""The marts, as plans over typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import facet_mean, joined_text, ratio, scaled
from tidemark.operators.grain import (
    dense_cells,
    own_and_opponent,
    rolling_outlook,
    text_in_order,
    unpivot_sides,
)
from tidemark.operators.ranking import (
    PERCENT_RANK,
    exact_median,
    extreme_fill,
    reverse_rank,
    with_positions,
    with_share_of_total,
)

# The outlook horizon in gameweeks, points for a result, and the two lines that
# make a player a differential.
HORIZON = 5
LEAGUE_POINTS = {"W": 3, "D": 1, "L": 0}
DIFFERENTIAL_OWNERSHIP = 5.0
DIFFERENTIAL_PERCENTILE = 0.75

FACETS = ("overall", "attack", "defence")


def dim_team(teams: DataFrame, players: DataFrame) -> DataFrame:
    """Clubs with averaged strength facets and their squad's depth and price range."""
    supply = players.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("player_count"),
        F.count_if("is_available").alias("available_player_count"),
        F.min("now_cost_gbp_m").alias("cheapest_player_gbp_m"),
        F.max("now_cost_gbp_m").alias("dearest_player_gbp_m"),
    )
    facets = [
        facet_mean(F.col(f"strength_{f}_home"), F.col(f"strength_{f}_away")).alias(f"strength_{f}")
        for f in FACETS
    ]
    split = [f"strength_{f}_{side}" for f in FACETS for side in ("home", "away")]
    rated = teams.select(
        "team_id",
        "team_code",
        "team_name",
        "team_short_name",
        *facets,
        (F.col("strength_overall_home") - F.col("strength_overall_away")).alias(
            "home_away_strength_delta"
        ),
        *split,
        "league_position",
        "matches_played",
        "wins",
        "draws",
        "losses",
        "league_points",
        "is_unavailable",
    )
    return rated.join(supply, "team_id", "left")


# The columns of the player dimension that come from the typed table unchanged.
_IDENTITY = ("player_id", "player_code", "display_name", "full_name", "first_name", "second_name", "birth_date")
_AVAILABILITY = ("status", "is_available", "chance_of_playing_next_round", "news", "news_added")
_SCORING = ("total_points", "event_points", "points_per_game", "form", "expected_points_next", "minutes", "starts", "bonus", "bps")
_CONTRIBUTIONS = ("goals_scored", "assists", "clean_sheets", "goals_conceded", "saves", "yellow_cards", "red_cards", "defensive_contribution")
_EXPECTED = ("expected_goals", "expected_assists", "expected_goal_involvements", "expected_goals_conceded", "expected_goal_involvements_per_90", "influence", "creativity", "threat", "ict_index")
_SET_PIECES = ("penalties_order", "direct_freekicks_order", "corners_and_indirect_freekicks_order")


def dim_player(players: DataFrame, teams: DataFrame, positions: DataFrame) -> DataFrame:
    """Players with their club and position resolved, and one flag for "can be bought"."""
    club = teams.select(
        "team_id",
        "team_name",
        "team_short_name",
        *[F.col(f"strength_{f}").alias(f"team_strength_{f}") for f in FACETS],
    )
    role = positions.select(
        "position_id",
        "position_name",
        "position_short_name",
        F.col("squad_required").alias("position_squad_required"),
        F.col("lineup_min").alias("position_lineup_min"),
        F.col("lineup_max").alias("position_lineup_max"),
    )
    c = F.col
    pickable = c("is_selectable") & c("is_transactable") & ~c("is_removed")
    return (
        players.join(club, "team_id")
        .join(role, "position_id")
        .select(
            *_IDENTITY,
            *club.columns,
            *role.columns,
            "now_cost_tenths",
            "now_cost_gbp_m",
            scaled(c("cost_change_start")).alias("price_change_season_gbp_m"),
            scaled(c("cost_change_event")).alias("price_change_gameweek_gbp_m"),
            *_AVAILABILITY,
            pickable.alias("is_pickable"),
            "is_removed",
            "is_selectable",
            "is_transactable",
            *_SCORING,
            *_CONTRIBUTIONS,
            *_EXPECTED,
            "selected_by_percent",
            "transfers_in_event",
            "transfers_out_event",
            (c("transfers_in_event") - c("transfers_out_event")).alias("net_transfers_event"),
            *_SET_PIECES,
            (c("penalties_order") == 1).alias("is_first_choice_penalties"),
            "load_id",
        )
    )


SIDES = own_and_opponent(
    team=("team_id", "opponent_team_id", "home_team_id", "away_team_id"),
    difficulty=("difficulty", "opponent_difficulty", "home_team_difficulty", "away_team_difficulty"),
    goals=("goals_for", "goals_against", "home_score", "away_score"),
)


def result_letter() -> Column:
    """W, D or L once finished; a level score still in progress has no result."""
    scored, conceded = F.col("goals_for"), F.col("goals_against")
    return (
        F.when(~F.col("is_finished"), F.lit(None).cast("string"))
        .when(scored > conceded, "W")
        .when(scored == conceded, "D")
        .otherwise("L")
    )


def league_points_of(result: Column) -> Column:
    points = F.create_map(*[F.lit(x) for pair in LEAGUE_POINTS.items() for x in pair])
    return F.try_element_at(points, result)


def fct_team_fixture(fixtures: DataFrame) -> DataFrame:
    """One row per team and fixture, every number from that team's point of view."""
    shared = [
        "fixture_id",
        "fixture_code",
        "gameweek_id",
        "kickoff_time",
        "is_provisional_start",
        "is_started",
        "is_finished",
        "minutes_played",
    ]
    c = F.col
    return (
        unpivot_sides(fixtures, shared, SIDES)
        .withColumn("result", result_letter())
        .select(
            "fixture_id",
            "fixture_code",
            "gameweek_id",
            "team_id",
            "opponent_team_id",
            "is_home",
            F.when(c("is_home"), "H").otherwise("A").alias("venue"),
            "kickoff_time",
            "is_provisional_start",
            "difficulty",
            "opponent_difficulty",
            (c("opponent_difficulty") - c("difficulty")).alias("difficulty_edge"),
            "goals_for",
            "goals_against",
            (c("goals_for") - c("goals_against")).alias("goal_difference"),
            "result",
            league_points_of(c("result")).alias("league_points_won"),
            "is_started",
            "is_finished",
            "minutes_played",
        )
    )


def mart_team_fixture_run(
    teams: DataFrame, gameweeks: DataFrame, team_fixtures: DataFrame, horizon: int = HORIZON
) -> DataFrame:
    """Every team in every gameweek, with what it plays there and over the next `horizon`.

    The fixtures are reduced to one row per team and gameweek on their own and then laid on the
    dense grid; the rolling window counts gameweeks, blanks included.
    """
    calendar = gameweeks.select(
        "gameweek_id",
        "gameweek_name",
        "deadline_time",
        F.col("is_finished").alias("gameweek_is_finished"),
        F.col("is_settled").alias("gameweek_is_settled"),
        F.col("is_current").alias("gameweek_is_current"),
        F.col("is_next").alias("gameweek_is_next"),
    )
    clubs = teams.select("team_id", "team_name", "team_short_name")
    cell = ["team_id", "gameweek_id"]
    scheduled = team_fixtures.filter(F.col("gameweek_id").isNotNull())
    opponent = teams.select(
        F.col("team_id").alias("opponent_team_id"), F.col("team_short_name").alias("opponent_name")
    )
    label = joined_text(F.col("opponent_name"), " (", F.col("venue"), ")")
    # One shuffle of the facts, to one row per cell; the text has every fixture of the cell. So
    # collecting it before the shuffle would reduce nothing, and sort and spill all fixtures of a task.
    per_cell = (
        scheduled.join(opponent, "opponent_team_id", "left")
        .withColumn("label", label)
        .repartition(*cell)
        .groupBy(*cell)
        .agg(
            F.count("fixture_id").alias("fixture_count"),
            F.count_if("is_home").alias("home_fixture_count"),
            ratio(F.sum("difficulty"), F.count("difficulty")).alias("avg_difficulty"),
            F.sum("difficulty").alias("total_difficulty"),
            F.min("difficulty").alias("easiest_difficulty"),
            F.max("difficulty").alias("hardest_difficulty"),
            text_in_order("label", "kickoff_time", "fixture_id").alias("opponents"),
        )
    )
    counts = ["fixture_count", "home_fixture_count"]
    folded = dense_cells(clubs, per_cell, calendar, *cell, counts).withColumns(
        {"is_blank": F.col("fixture_count") == 0, "is_double": F.col("fixture_count") > 1}
    )
    outlook = rolling_outlook(
        folded,
        "team_id",
        "gameweek_id",
        {
            "fixture_count": "fixture_count",
            "total_difficulty": "total_difficulty",
            "home_count": "home_fixture_count",
        },
        horizon,
        averages={"avg_difficulty": ("total_difficulty", "fixture_count")},
    )
    ahead = f"next_{horizon}"
    return outlook.select(
        *clubs.columns,
        *calendar.columns,
        "fixture_count",
        "is_blank",
        "is_double",
        "home_fixture_count",
        "avg_difficulty",
        "total_difficulty",
        "easiest_difficulty",
        "hardest_difficulty",
        "opponents",
        *[
            f"{ahead}_{name}"
            for name in (
                "fixture_count",
                "total_difficulty",
                "avg_difficulty",
                "home_count",
                "gameweeks_covered",
                "is_partial",
            )
        ],
    )


def planning_gameweek(gameweeks: DataFrame) -> DataFrame:
    """One row: the earliest gameweek that is not finished."""
    return gameweeks.filter(~F.col("is_finished")).agg(F.min("gameweek_id").alias("gameweek_id"))


def points_are_prior_season(gameweeks: DataFrame, players: DataFrame) -> Column:
    """Minutes while no gameweek has finished can only be last season's. One scalar per build."""
    finished = gameweeks.agg(F.count_if("is_finished")).scalar()
    most_minutes = players.agg(F.max("minutes")).scalar()
    return (finished == 0) & (most_minutes > 0)


# The ranks within a position, all descending, and the value each one orders by.
_POSITION_RANKS = {
    "points_per_million": "value_rank_in_position",
    "form_per_million": "form_value_rank_in_position",
    "now_cost_gbp_m": "price_rank_in_position",
    "selected_by_percent": "ownership_rank_in_position",
}


def mart_player_value(
    players: DataFrame, gameweeks: DataFrame, fixture_run: DataFrame, horizon: int = HORIZON
) -> DataFrame:
    """What a player returns for the price, against everyone else in the same position."""
    c = F.col
    ahead = f"next_{horizon}"
    outlook_columns = [f"{ahead}_{n}" for n in ("fixture_count", "avg_difficulty", "home_count", "is_partial")]
    outlook = fixture_run.filter(
        c("gameweek_id") == planning_gameweek(gameweeks).scalar()
    ).select(
        "team_id",
        c("gameweek_id").alias("planning_gameweek_id"),
        *outlook_columns,
        c("opponents").alias("next_opponents"),
        c("is_blank").alias("is_blank_next_gameweek"),
        c("is_double").alias("is_double_next_gameweek"),
    )
    cost = c("now_cost_gbp_m")
    ratios = {
        "points_per_million": ratio(c("total_points"), cost),
        "form_per_million": ratio(c("form"), cost),
        "expected_points_next_per_million": ratio(c("expected_points_next"), cost),
        "points_per_90": ratio(c("total_points") * F.lit(90.0), c("minutes")),
    }
    priced = players.withColumns(ratios)
    return (
        priced.join(value_ranks(priced), "player_id")
        .join(outlook, "team_id", "left")
        .withColumn("points_are_prior_season", points_are_prior_season(gameweeks, players))
        .withColumn(
            "is_differential",
            (c("selected_by_percent") < DIFFERENTIAL_OWNERSHIP)
            & (c("value_percentile_in_position") >= DIFFERENTIAL_PERCENTILE)
            & c("is_pickable"),
        )
        .select(
            "player_id",
            "player_code",
            "display_name",
            "team_id",
            "team_short_name",
            "team_name",
            "position_id",
            "position_short_name",
            "position_name",
            "now_cost_gbp_m",
            "price_change_season_gbp_m",
            "price_change_gameweek_gbp_m",
            "status",
            "is_available",
            "is_pickable",
            "chance_of_playing_next_round",
            "points_are_prior_season",
            "total_points",
            "points_per_game",
            "form",
            "expected_points_next",
            "minutes",
            "starts",
            "selected_by_percent",
            "net_transfers_event",
            "is_first_choice_penalties",
            *ratios,
            "expected_goal_involvements_per_90",
            "expected_goals",
            "expected_assists",
            "expected_goal_involvements",
            "ict_index",
            "bonus",
            "bps",
            "defensive_contribution",
            *[n for n in outlook.columns if n != "team_id"],
            "value_rank_overall",
            *_POSITION_RANKS.values(),
            "value_percentile_in_position",
            "is_differential",
        )
    )


def value_ranks(priced: DataFrame) -> DataFrame:
    """Every rank of every player, from one pass over (player, ranking, group, value) rows.

    The overall ranking is one more group. All rankings share their cuts, counts and windows, and
    one pivot brings a player's ranks together; wide rows travel once, in the caller's join.
    """
    main = "points_per_million"
    group = F.col("position_id")
    cells = [(name, group, value) for value, name in _POSITION_RANKS.items()]
    cells.append(("value_rank_overall", F.lit(None).cast(priced.schema["position_id"].dataType), main))
    each = F.array(
        *[
            F.struct(F.lit(n).alias("ranking"), g.alias("group_id"), F.col(v).cast("double").alias("value"))
            for n, g, v in cells
        ]
    )
    long = priced.select("player_id", F.explode(each).alias("c")).select("player_id", "c.*")
    outputs = {"place": reverse_rank("value"), "share": PERCENT_RANK}
    placed = with_positions(long, ["ranking", "group_id"], "value", outputs)

    def of(name: str, output: str) -> Column:
        return F.max(F.when(F.col("ranking") == name, F.col(output)))

    return placed.groupBy("player_id").agg(
        *[of(n, "place").alias(n) for n, _, _ in cells],
        of(_POSITION_RANKS[main], "share").alias("value_percentile_in_position"),
    )


def mart_position_scarcity(
    players: DataFrame, positions: DataFrame, settings: DataFrame
) -> DataFrame:
    """One row per position: supply, prices, the cost of filling its slots, the whole-squad floor.

    Money is added up in exact tenths and divided once.
    """
    c = F.col
    pickable = players.filter("is_pickable")
    # One row per position and club first, so that clubs are counted on the way.
    by_club = pickable.groupBy("position_id", "team_id").agg(
        F.count("player_id").alias("players"),
        F.count_if("is_available").alias("available"),
        F.min("now_cost_gbp_m").alias("cheapest"),
        F.max("now_cost_gbp_m").alias("dearest"),
        F.max("total_points").alias("best"),
        F.sum("total_points").alias("points"),
        F.count("total_points").alias("scorers"),
        F.max("form").alias("form"),
    )
    supply = by_club.groupBy("position_id").agg(
        F.sum("players").alias("player_count"),
        F.sum("available").alias("available_player_count"),
        F.count("team_id").alias("club_count"),
        F.min("cheapest").alias("cheapest_gbp_m"),
        F.max("dearest").alias("dearest_gbp_m"),
        F.max("best").alias("best_total_points"),
        ratio(F.sum("points"), F.sum("scorers")).alias("avg_total_points"),
        F.max("form").alias("best_form"),
    )
    median = exact_median(pickable, ["position_id"], "now_cost_gbp_m", "median_gbp_m")
    most_slots = positions.agg(F.max("squad_required")).first()[0] or 0
    fills = [
        extreme_fill(
            pickable,
            "position_id",
            "now_cost_tenths",
            "player_id",
            "position_squad_required",
            f"{name}_fill_tenths",
            dearest=name == "dearest",
            most_slots=most_slots,
        )
        for name in ("cheapest", "dearest")
    ]
    wide = positions.select(
        "position_id",
        "position_name",
        "position_short_name",
        "squad_required",
        "lineup_min",
        "lineup_max",
    )
    for part in (supply, median):
        wide = wide.join(part, "position_id", "left")
    wide = wide.na.fill(0, subset=["player_count", "available_player_count", "club_count"])
    for fill in fills:
        wide = wide.join(fill, "position_id")

    rules = settings.agg(
        F.first(F.struct("budget_tenths", "budget_gbp_m", "squad_size", "max_players_per_club"))
    ).scalar()
    whole = with_share_of_total(
        wide.withColumn("rules", rules), "cheapest_fill_tenths", "minimum_squad_tenths", "share_of_minimum_squad"
    )
    return whole.select(
        "position_id",
        "position_name",
        "position_short_name",
        "squad_required",
        "lineup_min",
        "lineup_max",
        (c("lineup_max") - c("lineup_min")).alias("lineup_flexibility"),
        "player_count",
        "available_player_count",
        "club_count",
        ratio(c("player_count"), c("squad_required")).alias("players_per_squad_slot"),
        "cheapest_gbp_m",
        "median_gbp_m",
        "dearest_gbp_m",
        (c("dearest_gbp_m") - c("cheapest_gbp_m")).alias("price_spread_gbp_m"),
        scaled(c("cheapest_fill_tenths")).alias("cheapest_fill_gbp_m"),
        scaled(c("dearest_fill_tenths")).alias("dearest_fill_gbp_m"),
        scaled(c("dearest_fill_tenths") - c("cheapest_fill_tenths")).alias("fill_cost_range_gbp_m"),
        "best_total_points",
        "avg_total_points",
        "best_form",
        "rules.budget_gbp_m",
        "rules.squad_size",
        "rules.max_players_per_club",
        scaled(c("minimum_squad_tenths")).alias("minimum_squad_gbp_m"),
        scaled(c("rules.budget_tenths") - c("minimum_squad_tenths")).alias("budget_headroom_gbp_m"),
        "share_of_minimum_squad",
    )
