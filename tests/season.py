"""A small season in the raw shapes, made for the tests: 4 positions, 6 clubs, 10 gameweeks."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tidemark.plans.silver import MODELS, raw_schema
from tidemark.sources import bronze

CLUBS = 6
GAMEWEEKS = 10
OLD, NEW, DEAD = "999999999.5", "1786000000.25", "1786090000.75"
DATES = {OLD: "2001-09-09", NEW: "2026-08-06", DEAD: "2026-08-07"}
POSITIONS = [("GKP", 2, 1, 1), ("DEF", 5, 3, 5), ("MID", 5, 2, 5), ("FWD", 3, 1, 3)]


def teams(extra: int = 0) -> list[dict]:
    return [
        {
            "id": i,
            "code": 100 + i,
            "name": f"Club {i}",
            "short_name": f"C{i:02}",
            "position": i,
            "played": 0,
            "win": 0,
            "draw": 0,
            "loss": 0,
            "points": 0,
            "strength_overall_home": 2 + i % 3,
            "strength_overall_away": 3 + i % 3,
            "strength_attack_home": 0,
            "strength_attack_away": 0,
            "strength_defence_home": 0,
            "strength_defence_away": 0,
            "unavailable": False,
            "pulse_id": i,
        }
        for i in range(1, CLUBS + 1 + extra)
    ]


def element_types() -> list[dict]:
    return [
        {
            "id": i,
            "singular_name": f"Position {name}",
            "singular_name_short": name,
            "plural_name": f"{name}s",
            "squad_select": select,
            "squad_min_play": least,
            "squad_max_play": most,
            "element_count": 12,
        }
        for i, (name, select, least, most) in enumerate(POSITIONS, 1)
    ]


def gameweeks(finished: int = 0) -> list[dict]:
    return [
        {
            "id": i,
            "name": f"Gameweek {i}",
            "deadline_time": f"2026-08-{i + 10}T17:30:00Z",
            "deadline_time_epoch": 1786000000 + i,
            "finished": i <= finished,
            "data_checked": i < finished,
            "is_previous": i == finished,
            "is_current": False,
            "is_next": i == finished + 1,
            "can_enter": True,
            "can_manage": True,
            "released": True,
            "ranked_count": 0,
            "transfers_made": 0,
            "chip_plays": [{"chip_name": "wildcard", "num_played": None}],
        }
        for i in range(1, GAMEWEEKS + 1)
    ]


def fixtures() -> list[dict]:
    """Each club plays once a gameweek, but for a blank in 3, a double in 4 and one unscheduled."""
    out, number = [], 0
    for gw in range(1, GAMEWEEKS + 1):
        for pair in range(CLUBS // 2):
            home, away = (pair + gw) % CLUBS + 1, (CLUBS - 1 - pair + gw) % CLUBS + 1
            number += 1
            event = 4 if (gw, pair) == (3, 0) else None if (gw, pair) == (9, 1) else gw
            out.append(
                {
                    "id": number,
                    "code": 5000 + number,
                    "event": event,
                    "kickoff_time": f"2026-09-{gw + 1:02}T{12 + pair}:00:00Z",
                    "provisional_start_time": False,
                    "team_h": home,
                    "team_a": away,
                    "team_h_difficulty": 1 + (home + gw) % 5,
                    "team_a_difficulty": 1 + (away + 2 * gw) % 5,
                    "started": False,
                    "finished": False,
                    "finished_provisional": False,
                    "minutes": 0,
                    "stats": [],
                    "pulse_id": number,
                }
            )
    return out


def elements(per_position: int = 12) -> list[dict]:
    out = []
    for position in range(1, 5):
        for n in range(per_position):
            number = (position - 1) * per_position + n + 1
            out.append(
                {
                    "id": number,
                    "code": 9000 + number,
                    "first_name": "First",
                    "second_name": f"Second{number}",
                    "web_name": f"P{number}",
                    "team": number % CLUBS + 1,
                    "team_code": 100 + number % CLUBS + 1,
                    "element_type": position,
                    "birth_date": "1999-05-01",
                    "now_cost": 40 + n * 3,
                    "cost_change_start": n - 3,
                    "cost_change_event": 0,
                    "transfers_in_event": 10,
                    "transfers_out_event": n,
                    "status": "a" if n % 4 else "i",
                    "can_select": n != 1,
                    "can_transact": True,
                    "removed": n == 2,
                    "special": False,
                    "total_points": (n * 7) % 5,
                    "event_points": 0,
                    "form": "0.0",
                    "points_per_game": "",
                    "ep_next": "2.5",
                    "selected_by_percent": f"{n}.5",
                    "minutes": 90 * n,
                    "starts": n,
                    "expected_goals": " 1.25 ",
                    "penalties_order": 1 if n == 5 else None,
                }
            )
    return out


def game_meta() -> list[dict]:
    return [
        {
            "total_players": 0,
            "game_settings": {
                "squad_squadsize": 15,
                "squad_squadplay": 11,
                "squad_team_limit": 3,
                "squad_total_spend": 1000,
                "transfers_sell_on_fee": 0.5,
                "element_sell_at_purchase_price": False,
                "timezone": "UTC",
                "not_modelled": None,
            },
            "game_config": {"scoring": {"goals_scored": {"GKP": 10, "DEF": 6}}},
        }
    ]


def season(**changes: list[dict]) -> dict[str, list[dict]]:
    """Raw tables by name; pass a list to replace one."""
    tables = {
        "teams": teams(),
        "element_types": element_types(),
        "events": gameweeks(),
        "fixtures": fixtures(),
        "elements": elements(),
        "chips": [{"id": 1, "name": "wildcard", "number": 1, "start_event": 2, "stop_event": 19}],
        "phases": [{"id": 1, "name": "Overall", "start_event": 1, "stop_event": 10}],
        "element_stats": [{"name": "minutes", "label": "Minutes played"}],
        "game_meta": game_meta(),
    }
    tables.update(changes)
    return tables


def land(spark: SparkSession, root: str, load_id: str, tables: dict[str, list[dict]], commit: bool = True) -> None:
    """Append one load the way a fetch job does, and commit it last."""
    by_raw = {m.raw: m for m in MODELS.values()}
    landed = []
    for name, records in tables.items():
        lines = spark.createDataFrame([(json.dumps(r),) for r in records], "line string")
        schema = raw_schema(by_raw[name])
        parsed = lines.select(_parse(schema).alias("r")).select("r.*")
        landed.append(bronze.append_load(parsed, root, name, load_id, DATES[load_id]))
    if commit:
        bronze.commit_load(spark, root, load_id, "fpl", f"{DATES[load_id]}T06:05:00Z", landed=landed)


def _parse(schema):
    from pyspark.sql import functions as F

    return F.from_json("line", schema, {"mode": "FAILFAST"})
