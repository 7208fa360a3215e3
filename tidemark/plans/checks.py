"""The data checks of every model: which rule holds for which column, and how to run them all."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.operators.runs import CRITICAL, WARNING
from tidemark.plans.gold import points_are_prior_season


@dataclass(frozen=True)
class Rules:
    """What must hold for a model: columns that are unique, present, refer to a parent, come
    from a fixed vocabulary, or are unique together."""

    unique: tuple[str, ...] = ()
    present: tuple[str, ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    accepted: dict[str, tuple] = field(default_factory=dict)
    grain: tuple[str, ...] = ()


# ---- Fixed values: the vocabularies and the rules of each model. ----

PLAYER_STATUS = ("a", "d", "i", "s", "u")
POSITION_NAMES = ("GKP", "DEF", "MID", "FWD")
RATINGS = (1, 2, 3, 4, 5)
VENUES = ("H", "A")
RESULTS = ("W", "D", "L")

_TEAM = {"team_id": ("dim_team", "team_id")}
_SILVER_TEAM = ("stg_fpl__teams", "team_id")
_GAMEWEEK = {"gameweek_id": ("stg_fpl__gameweeks", "gameweek_id")}
_POSITION = {"position_id": ("stg_fpl__positions", "position_id")}

RULES: dict[str, Rules] = {
    "stg_fpl__loads": Rules(("load_id",), ("load_id", "is_committed", "loaded_at")),
    "stg_fpl__teams": Rules(
        ("team_id", "team_code", "team_name", "team_short_name"),
        ("team_id", "team_code", "team_name", "team_short_name", "load_id"),
    ),
    "stg_fpl__positions": Rules(
        ("position_id", "position_name", "position_short_name"),
        ("position_id", "position_name", "position_short_name", "squad_required"),
    ),
    "stg_fpl__gameweeks": Rules(
        ("gameweek_id", "gameweek_name"),
        ("gameweek_id", "gameweek_name", "deadline_time", "is_settled"),
    ),
    "stg_fpl__fixtures": Rules(
        ("fixture_id", "fixture_code"),
        ("fixture_id", "fixture_code", "home_team_id", "away_team_id"),
        {**_GAMEWEEK, "home_team_id": _SILVER_TEAM, "away_team_id": _SILVER_TEAM},
    ),
    "stg_fpl__players": Rules(
        ("player_id", "player_code"),
        (
            "player_id",
            "player_code",
            "team_id",
            "position_id",
            "status",
            "now_cost_tenths",
            "now_cost_gbp_m",
            "display_name",
            "load_id",
        ),
        {"team_id": _SILVER_TEAM, **_POSITION},
        {"status": PLAYER_STATUS},
    ),
    "stg_fpl__chips": Rules(("chip_id",), ("chip_id", "chip_name")),
    "stg_fpl__phases": Rules(("phase_id", "phase_name"), ("phase_id", "phase_name")),
    "stg_fpl__stat_types": Rules(("stat_key", "stat_label"), ("stat_key", "stat_label")),
    "stg_fpl__game_settings": Rules((), ("squad_size", "lineup_size", "budget_tenths")),
    "dim_team": Rules(
        ("team_id", "team_code", "team_name", "team_short_name"),
        (
            "team_id",
            "team_code",
            "team_name",
            "team_short_name",
            "strength_overall",
            "home_away_strength_delta",
            "player_count",
        ),
    ),
    "dim_player": Rules(
        ("player_id", "player_code"),
        (
            "player_id",
            "player_code",
            "display_name",
            "team_id",
            "team_short_name",
            "position_id",
            "position_short_name",
            "now_cost_gbp_m",
            "is_pickable",
            "position_squad_required",
        ),
        {**_TEAM, **_POSITION},
        {"position_short_name": POSITION_NAMES},
    ),
    "fct_team_fixture": Rules(
        (),
        (
            "fixture_id",
            "team_id",
            "opponent_team_id",
            "is_home",
            "venue",
            "difficulty",
            "opponent_difficulty",
        ),
        {
            "fixture_id": ("stg_fpl__fixtures", "fixture_id"),
            **_TEAM,
            "opponent_team_id": ("dim_team", "team_id"),
            **_GAMEWEEK,
        },
        {
            "venue": VENUES,
            "difficulty": RATINGS,
            "opponent_difficulty": RATINGS,
            "result": RESULTS,
        },
        ("fixture_id", "team_id"),
    ),
    "mart_team_fixture_run": Rules(
        (),
        (
            "team_id",
            "gameweek_id",
            "fixture_count",
            "is_blank",
            "is_double",
            "next_5_fixture_count",
            "next_5_gameweeks_covered",
            "next_5_is_partial",
        ),
        {**_TEAM, **_GAMEWEEK},
        {"next_5_gameweeks_covered": RATINGS},
        ("team_id", "gameweek_id"),
    ),
    "mart_player_value": Rules(
        ("player_id",),
        (
            "player_id",
            "display_name",
            "team_id",
            "position_id",
            "now_cost_gbp_m",
            "points_per_million",
            "value_rank_in_position",
            "points_are_prior_season",
            "planning_gameweek_id",
            "is_differential",
        ),
        {
            **_TEAM,
            **_POSITION,
            "planning_gameweek_id": ("stg_fpl__gameweeks", "gameweek_id"),
        },
    ),
    "mart_position_scarcity": Rules(
        ("position_id", "position_short_name"),
        (
            "position_id",
            "position_short_name",
            "squad_required",
            "player_count",
            "cheapest_fill_gbp_m",
            "minimum_squad_gbp_m",
            "budget_headroom_gbp_m",
        ),
        {},
        {"position_short_name": POSITION_NAMES},
    ),
}

# The checks that span models.
INVARIANTS = (
    "one_snapshot",
    "optional_types",
    "rules_agree",
    "sides_balance",
    "grid_complete",
    "budget_holds",
    "prior_flag_holds",
)

# Columns that may be missing from every raw file and must still be there, with these types.
OPTIONAL_TYPES = {
    "stg_fpl__fixtures.home_score": "bigint",
    "stg_fpl__fixtures.away_score": "bigint",
    "stg_fpl__players.expected_points_this": "double",
    "stg_fpl__players.chance_of_playing_this_round": "bigint",
}


def model_checks(model: str, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The rule checks of one model as violation frames, by check name."""
    df, rules = frames[model], RULES[model]
    found = {}
    if rules.unique:
        found[f"{model}.unique"] = checks.unique_columns(df, rules.unique)
    if rules.present:
        found[f"{model}.not_null"] = checks.not_null(df, rules.present)
    for column, (parent, key) in rules.parents.items():
        found[f"{model}.{column}.parent"] = checks.relationships(df, column, frames[parent], key)
    if rules.accepted:
        found[f"{model}.accepted"] = checks.accepted_columns(df, rules.accepted)
    if rules.grain:
        found[f"{model}.grain"] = checks.unique_combination(df, rules.grain)
    return found


def invariant_checks(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The checks that span models."""
    silver = {
        n: df for n, df in frames.items() if n.startswith("stg_fpl__") and n != "stg_fpl__loads"
    }
    gameweeks = frames["stg_fpl__gameweeks"]
    return {
        "one_snapshot": checks.one_snapshot(silver, frames["stg_fpl__loads"]),
        "optional_types": checks.column_types(frames, OPTIONAL_TYPES),
        "rules_agree": checks.rules_agree(
            frames["stg_fpl__positions"], frames["stg_fpl__game_settings"]
        ),
        "sides_balance": checks.sides_balance(frames["fct_team_fixture"]),
        "grid_complete": checks.grid_complete(
            frames["mart_team_fixture_run"], frames["dim_team"], gameweeks, "team_id", "gameweek_id"
        ),
        "budget_holds": checks.budget_holds(frames["mart_position_scarcity"]),
        "prior_flag_holds": checks.prior_flag_holds(
            frames["mart_player_value"], points_are_prior_season(gameweeks, frames["dim_player"])
        ),
    }


def silver_checks(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The rule checks of the typed tables, which marts are built from."""
    found = {}
    for model in RULES:
        if model.startswith("stg_fpl__"):
            found.update(model_checks(model, frames))
    return found


def all_checks(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    found = {}
    for model in RULES:
        found.update(model_checks(model, frames))
    found.update(invariant_checks(frames))
    return found


def check_names() -> set[str]:
    """The names of all checks, without any table."""
    names = set(INVARIANTS)
    for model, rules in RULES.items():
        kinds = {"unique": rules.unique, "not_null": rules.present, "accepted": rules.accepted, "grain": rules.grain}
        names.update(f"{model}.{kind}" for kind, columns in kinds.items() if columns)
        names.update(f"{model}.{column}.parent" for column in rules.parents)
    return names


def _counted(found: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.expr("count(1) AS violations")).selectExpr(f"'{name}' AS check_name", "violations")
        for name, df in found.items()
    ]
    return reduce(DataFrame.union, parts)


def violations(found: Mapping[str, DataFrame]) -> DataFrame:
    """One row per failed check with its number of violating rows, from a single query."""
    return _counted(found).filter("violations > 0")


def graded(found: Mapping[str, DataFrame], warn: Iterable[str] = ()) -> DataFrame:
    """One row per check, passed or not: check_name, grade, violations, passed.

    A check is critical unless `warn` names it. A name in `warn` that is no check is refused: a
    misspelt one would leave its check critical unseen.
    """
    mild = set(warn)
    if unknown := mild - set(found):
        raise ValueError(f"no such checks: {', '.join(sorted(unknown))}")
    grade = F.when(F.col("check_name").isin(*sorted(mild)), WARNING).otherwise(CRITICAL)
    return _counted(found).select("check_name", grade.alias("grade"), "violations", F.expr("violations = 0 AS passed"))
