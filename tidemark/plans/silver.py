"""The typed tables: one field list per raw table, read by the generic `conform`."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.operators.conform import Derived, Field, conform, fields


@dataclass(frozen=True)
class Model:
    """A typed table: the raw table it reads, its fields in output order, what it derives, and
    whether a build may go on without files of the raw table."""

    raw: str
    spec: list[Field]
    derived: list[Derived] = field(default_factory=list)
    optional: bool = False

    def build(self, raw: DataFrame, load_id: str) -> DataFrame:
        return conform(raw, self.spec, load_id, self.derived)


# ---- Fixed values: source and output column names of the typed tables. ----

TEAMS = (
    fields("long", ("id", "team_id"), ("code", "team_code"))
    + fields("text", ("name", "team_name"), ("short_name", "team_short_name"))
    + fields(
        "long",
        ("position", "league_position"),
        ("played", "matches_played"),
        ("win", "wins"),
        ("draw", "draws"),
        ("loss", "losses"),
        ("points", "league_points"),
        "strength_overall_home",
        "strength_overall_away",
        "strength_attack_home",
        "strength_attack_away",
        "strength_defence_home",
        "strength_defence_away",
    )
    + fields("flag", ("unavailable", "is_unavailable"))
    + fields("long", "pulse_id")
)

POSITIONS = (
    fields("long", ("id", "position_id"))
    + fields(
        "text",
        ("singular_name", "position_name"),
        ("singular_name_short", "position_short_name"),
        ("plural_name", "position_name_plural"),
    )
    + fields(
        "long",
        ("squad_select", "squad_required"),
        ("squad_min_play", "lineup_min"),
        ("squad_max_play", "lineup_max"),
        ("element_count", "player_count"),
    )
)

GAMEWEEKS = (
    fields("long", ("id", "gameweek_id"))
    + fields("text", ("name", "gameweek_name"))
    + fields("time", "deadline_time")
    + fields("long", "deadline_time_epoch")
    + fields(
        "flag",
        ("finished", "is_finished"),
        ("data_checked", "is_data_checked"),
        "is_previous",
        "is_current",
        "is_next",
        "can_enter",
        "can_manage",
        ("released", "is_released"),
    )
    + fields("long", "average_entry_score", "ranked_count", "transfers_made")
    + fields("json", ("chip_plays", "chip_plays_json"))
)

FIXTURES = (
    fields("long", ("id", "fixture_id"), ("code", "fixture_code"), ("event", "gameweek_id"))
    + fields("time", "kickoff_time")
    + fields("flag", ("provisional_start_time", "is_provisional_start"))
    + fields(
        "long",
        ("team_h", "home_team_id"),
        ("team_a", "away_team_id"),
        ("team_h_score", "home_score"),
        ("team_a_score", "away_score"),
        ("team_h_difficulty", "home_team_difficulty"),
        ("team_a_difficulty", "away_team_difficulty"),
    )
    + fields(
        "flag",
        ("started", "is_started"),
        ("finished", "is_finished"),
        ("finished_provisional", "is_finished_provisional"),
    )
    + fields("long", ("minutes", "minutes_played"))
    + fields("json", ("stats", "stats_json"))
    + fields("long", "pulse_id")
)

PLAYERS = (
    fields("long", ("id", "player_id"), ("code", "player_code"))
    + fields("text", "first_name", "second_name", ("web_name", "display_name"), "known_name", "opta_code")
    + fields("date", "birth_date")
    + fields("long", ("region", "region_id"), ("team", "team_id"), "team_code")
    + fields("date", "team_join_date")
    + fields(
        "long",
        ("element_type", "position_id"),
        ("now_cost", "now_cost_tenths"),
        "cost_change_start",
        "cost_change_event",
        "cost_change_start_fall",
        "cost_change_event_fall",
    )
    + fields("number_text", "price_change_percent", "selected_by_percent")
    + fields("long", "transfers_in", "transfers_out", "transfers_in_event", "transfers_out_event")
    + fields("text", "status")
    + fields("long", "chance_of_playing_next_round", "chance_of_playing_this_round")
    + fields("text", "news")
    + fields("time", "news_added")
    + fields(
        "flag",
        ("removed", "is_removed"),
        ("can_select", "is_selectable"),
        ("can_transact", "is_transactable"),
        ("special", "is_special"),
    )
    + fields("long", "total_points", "event_points")
    + fields(
        "number_text",
        "form",
        "points_per_game",
        ("ep_next", "expected_points_next"),
        ("ep_this", "expected_points_this"),
        "value_form",
        "value_season",
    )
    + fields("long", "dreamteam_count")
    + fields("flag", ("in_dreamteam", "is_in_dreamteam"))
    + fields(
        "long",
        "minutes",
        "starts",
        "goals_scored",
        "assists",
        "clean_sheets",
        "goals_conceded",
        "own_goals",
        "penalties_saved",
        "penalties_missed",
        "yellow_cards",
        "red_cards",
        "saves",
        "bonus",
        "bps",
        "tackles",
        "recoveries",
        "clearances_blocks_interceptions",
        "defensive_contribution",
    )
    + fields(
        "number_text",
        "influence",
        "creativity",
        "threat",
        "ict_index",
        "expected_goals",
        "expected_assists",
        "expected_goal_involvements",
        "expected_goals_conceded",
    )
    + fields(
        "double",
        "expected_goals_per_90",
        "expected_assists_per_90",
        "expected_goal_involvements_per_90",
        "expected_goals_conceded_per_90",
        "goals_conceded_per_90",
        "saves_per_90",
        "starts_per_90",
        "clean_sheets_per_90",
        "defensive_contribution_per_90",
    )
    + fields(
        "long",
        *[
            f"{measure}_{scope}"
            for measure in (
                "influence",
                "creativity",
                "threat",
                "ict_index",
                "now_cost",
                "form",
                "points_per_game",
                "selected",
            )
            for scope in ("rank", "rank_type")
        ],
    )
    + fields("long", "corners_and_indirect_freekicks_order")
    + fields("text", "corners_and_indirect_freekicks_text")
    + fields("long", "direct_freekicks_order")
    + fields("text", "direct_freekicks_text")
    + fields("long", "penalties_order")
    + fields("text", "penalties_text")
)

CHIPS = (
    fields("long", ("id", "chip_id"))
    + fields("text", ("name", "chip_name"), "chip_type")
    + fields(
        "long",
        ("number", "chip_number"),
        ("start_event", "first_gameweek_id"),
        ("stop_event", "last_gameweek_id"),
    )
    + fields("json", ("overrides", "overrides_json"))
)

PHASES = (
    fields("long", ("id", "phase_id"))
    + fields("text", ("name", "phase_name"))
    + fields("long", ("start_event", "first_gameweek_id"), ("stop_event", "last_gameweek_id"))
)

STAT_TYPES = fields("text", ("name", "stat_key"), ("label", "stat_label"))


def _settings(kind: str, **renamed: str) -> list[Field]:
    return [Field(f"game_settings.{source}", name, kind) for source, name in renamed.items()]


GAME_SETTINGS = (
    fields("long", "total_players")
    + _settings(
        "long",
        squad_squadsize="squad_size",
        squad_squadplay="lineup_size",
        squad_team_limit="max_players_per_club",
        squad_total_spend="budget_tenths",
        transfers_cap="transfers_cap",
        max_extra_free_transfers="max_extra_free_transfers",
    )
    + _settings("double", transfers_sell_on_fee="sell_on_fee")
    + _settings("flag", element_sell_at_purchase_price="sells_at_purchase_price")
    + _settings(
        "long",
        league_points_h2h_win="h2h_points_win",
        league_points_h2h_draw="h2h_points_draw",
        league_points_h2h_lose="h2h_points_loss",
        league_join_private_max="max_private_leagues",
        league_join_public_max="max_public_leagues",
        stats_form_days="form_window_days",
        ui_currency_multiplier="currency_multiplier",
    )
    + _settings("text", timezone="game_timezone")
    + fields("json", ("game_config.scoring", "scoring_config_json"), ("game_settings", "game_settings_json"))
)

AVAILABLE_STATUS = "a"

MODELS: dict[str, Model] = {
    "stg_fpl__teams": Model("teams", TEAMS),
    "stg_fpl__positions": Model("element_types", POSITIONS),
    # Points are final only once checked; finished alone means the matches are over.
    "stg_fpl__gameweeks": Model(
        "events", GAMEWEEKS, [Derived("is_settled", "is_data_checked", "is_finished AND is_data_checked")]
    ),
    "stg_fpl__fixtures": Model("fixtures", FIXTURES),
    "stg_fpl__players": Model(
        "elements",
        PLAYERS,
        [
            Derived("full_name", "second_name", "first_name || ' ' || second_name"),
            Derived("now_cost_gbp_m", "now_cost_tenths", "now_cost_tenths / 10.0D"),
            Derived("is_available", "status", f"status = '{AVAILABLE_STATUS}'"),
        ],
    ),
    "stg_fpl__chips": Model("chips", CHIPS),
    "stg_fpl__phases": Model(
        "phases",
        PHASES,
        [Derived("gameweek_count", "last_gameweek_id", "last_gameweek_id - first_gameweek_id + 1")],
    ),
    "stg_fpl__stat_types": Model("element_stats", STAT_TYPES),
    "stg_fpl__game_settings": Model(
        "game_meta", GAME_SETTINGS, [Derived("budget_gbp_m", "budget_tenths", "budget_tenths / 10.0D")]
    ),
}

# The raw JSON type each kind is read as.
_RAW_TYPES = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "text": T.StringType(),
    "flag": T.BooleanType(),
    "date": T.StringType(),
    "time": T.StringType(),
    "number_text": T.StringType(),
    "json": T.VariantType(),
}


def raw_schema(model: Model) -> T.StructType:
    """The declared read schema of a model's raw table, from its field list.

    A nested value is read as VARIANT: it keeps nulls and nesting whole without naming a shape.
    """
    types: dict[str, T.DataType] = {}
    for f in model.spec:
        parent, _, path = f.source.partition(".")
        types[parent] = T.VariantType() if path else types.get(parent, _RAW_TYPES[f.kind])
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def build_silver(raw: Mapping[str, DataFrame], load_id: str) -> dict[str, DataFrame]:
    """All typed tables of one load. The load id is resolved once and shared by every model."""
    return {name: model.build(raw[model.raw], load_id) for name, model in MODELS.items()}
