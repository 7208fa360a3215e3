"""The whole build over hand-made raw loads, its checks, and how it fails."""

import re

import pytest
from pyspark.sql import functions as F

from tests import season
from tests.conftest import plan_of, rows
from tidemark.operators import runs
from tidemark.plans import checks, gold, silver
from tidemark.plans.build import MARTS, BrokenChecks, NoCommittedLoad, build, build_checked, run_checks
from tidemark.plans.silver import MODELS
from tidemark.sources.bronze import MissingSource
from tidemark.sources.layers import ContractError, Lake


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Three loads: an old one with a club that has since vanished, the newest committed one,
    and a newer one that died before its commit."""
    base = tmp_path_factory.mktemp("lake")
    raw = f"{base}/bronze"
    season.land(spark, raw, season.OLD, season.season(teams=season.teams(extra=1)))
    season.land(spark, raw, season.NEW, season.season())
    season.land(spark, raw, season.DEAD, {"teams": season.teams()[:1]}, commit=False)
    return build_checked(spark, raw, Lake(str(base)))


def test_counts_and_snapshot(built):
    assert len(built) == 16
    assert built["stg_fpl__teams"].count() == season.CLUBS
    assert built["stg_fpl__loads"].count() == 2
    ids = {r[0] for r in built["stg_fpl__players"].select("load_id").distinct().collect()}
    assert ids == {season.NEW}


def test_typing(built):
    player = built["stg_fpl__players"].filter("player_id = 6").first()
    assert player["full_name"] == "First Second6"
    assert (player["now_cost_tenths"], player["now_cost_gbp_m"]) == (55, 5.5)
    assert player["points_per_game"] is None and player["expected_goals"] == 1.25
    assert player["expected_points_this"] is None
    assert str(player["birth_date"]) == "1999-05-01"
    assert len(built["stg_fpl__players"].columns) == len(MODELS["stg_fpl__players"].spec) + 4
    week = built["stg_fpl__gameweeks"].filter("gameweek_id = 1").first()
    assert week["chip_plays_json"] == '[{"chip_name":"wildcard","num_played":null}]'
    settings = built["stg_fpl__game_settings"].first()
    assert settings["budget_gbp_m"] == 100.0 and settings["sell_on_fee"] == 0.5
    assert '"not_modelled":null' in settings["game_settings_json"]
    assert settings["scoring_config_json"] == '{"goals_scored":{"DEF":6,"GKP":10}}'


def test_blank_and_double(built):
    run = built["mart_team_fixture_run"]
    assert run.count() == season.CLUBS * season.GAMEWEEKS
    fixture = [f for f in season.fixtures() if f["id"] == 7][0]
    home = run.filter(F.col("team_id") == fixture["team_h"])
    blank = home.filter("gameweek_id = 3").first()
    assert blank["is_blank"] and blank["fixture_count"] == 0
    assert blank["avg_difficulty"] is None and blank["opponents"] is None
    double = home.filter("gameweek_id = 4").first()
    assert double["is_double"] and double["opponents"].count(", ") == 1
    first = f"C{fixture['team_a']:02} (H), "
    assert double["opponents"].startswith(first)
    last = home.filter("gameweek_id = 8").first()
    assert last["next_5_gameweeks_covered"] == 3 and last["next_5_is_partial"]


def test_results_wait_for_the_whistle(spark, built):
    fixtures = built["stg_fpl__fixtures"].limit(3)
    level = fixtures.withColumns(
        {"home_score": F.lit(0).cast("long"), "away_score": F.lit(0).cast("long")}
    )
    playing = gold.fct_team_fixture(level)
    assert rows(playing.select("result").distinct()) == [(None,)]
    over = gold.fct_team_fixture(level.withColumn("is_finished", F.lit(True)))
    assert rows(over.select("result", "league_points_won").distinct()) == [("D", 1)]
    won = gold.fct_team_fixture(
        level.withColumns({"is_finished": F.lit(True), "home_score": F.lit(2).cast("long")})
    )
    assert rows(won.select("is_home", "result", "league_points_won").distinct()) == [
        (False, "L", 0),
        (True, "W", 3),
    ]


def test_player_value(built):
    value = built["mart_player_value"]
    assert value.count() == 48
    assert rows(value.select("points_are_prior_season", "planning_gameweek_id").distinct()) == [
        (True, 1)
    ]
    zero = value.filter("minutes = 0")
    assert rows(zero.select("points_per_90").distinct()) == [(None,)]
    ranks = value.filter("position_id = 1").orderBy("value_rank_in_position").collect()
    for r in ranks:
        ahead = sum(1 for o in ranks if o["points_per_million"] > r["points_per_million"])
        behind = sum(1 for o in ranks if o["points_per_million"] < r["points_per_million"])
        assert r["value_rank_in_position"] == ahead + 1
        assert r["value_percentile_in_position"] == behind / (len(ranks) - 1)


def test_scarcity(built):
    scarcity = {r["position_short_name"]: r for r in built["mart_position_scarcity"].collect()}
    # Prices 40, 43, 46 ...; the second and third cheapest cannot be picked.
    assert scarcity["GKP"]["cheapest_fill_gbp_m"] == 8.9
    assert scarcity["GKP"]["player_count"] == 10
    assert scarcity["FWD"]["dearest_fill_gbp_m"] == 21.0
    floor = sum(r["cheapest_fill_gbp_m"] for r in scarcity.values())
    assert abs(scarcity["MID"]["minimum_squad_gbp_m"] - floor) < 1e-9
    assert abs(sum(r["share_of_minimum_squad"] for r in scarcity.values()) - 1) < 1e-9


def test_the_number_of_checks():
    generic = sum(
        len(r.unique) + len(r.present) + len(r.parents) + len(r.accepted) + bool(r.grain)
        for r in checks.RULES.values()
    )
    assert generic == 141


def test_every_model_check_can_fail(spark, built):
    """Break each model in the four ways its rules guard, and expect every rule to report."""

    def fill(df, columns, text):
        changes = {c: F.lit(text).cast(df.schema[c].dataType) for c in columns}
        return df.withColumns(changes)

    for model, rules in checks.RULES.items():
        df = built[model]
        cases = [
            (df.unionByName(df), f"{model}.unique", len(rules.unique)),
            (df.unionByName(df), f"{model}.grain", bool(rules.grain)),
            (fill(df, rules.present, None), f"{model}.not_null", len(rules.present)),
            (fill(df, rules.accepted, "99"), f"{model}.accepted", len(rules.accepted)),
        ]
        orphans = fill(df, rules.parents, "-1")
        cases += [(orphans, f"{model}.{c}.parent", 1) for c in rules.parents]
        for frame, name, expected in cases:
            if expected:
                broken = checks.model_checks(model, {**built, model: frame})[name]
                if "column_name" in broken.columns:
                    broken = broken.select("column_name").distinct()
                    assert broken.count() == expected, name
                else:
                    assert broken.limit(1).count() == 1, name


def test_checks_have_names_without_tables(built):
    assert set(checks.all_checks(built)) == checks.check_names()


def test_warnings_are_recorded_and_stop_nothing(spark, tmp_path):
    """One broken rule: as a warning it is published and written down, as a critical one it stops."""
    raw, lake = f"{tmp_path}/bronze", Lake(str(tmp_path))
    players = season.elements()
    players[1]["status"] = "x"
    season.land(spark, raw, season.NEW, season.season(elements=players))
    with pytest.raises(ValueError, match="stg_fpl__players.acepted"):
        build_checked(spark, raw, lake, warn=["stg_fpl__players.acepted"])
    built = build_checked(spark, raw, lake, warn=["stg_fpl__players.accepted"])
    assert lake.current(spark) != lake and built["mart_player_value"].count() > 0
    first = runs.read_check_results(spark, lake.root)
    assert {r["check_name"] for r in first.collect()} == checks.check_names()
    assert first.count() == len(checks.check_names())
    bad = rows(first.filter("NOT passed").select("check_name", "grade", "violations"))
    assert bad == [("stg_fpl__players.accepted", "warn", 1)]
    [day] = runs.correctness_daily(first).collect()
    assert day["holds"] and day["critical_share"] == 1.0 and (day["warnings"], day["warnings_failed"]) == (1, 1)
    with pytest.raises(BrokenChecks, match="stg_fpl__players.accepted"):
        build_checked(spark, raw, lake)
    # The stopped build left its results too; it got no further than the typed tables.
    both = runs.read_check_results(spark, lake.root)
    assert both.select("build").distinct().count() == 2
    [day] = runs.correctness_daily(both).collect()
    assert not day["holds"] and day["critical_passed"] == day["critical"] - 1
    assert day["critical"] == len(checks.check_names()) - 1 + both.count() - first.count()


def test_failed_checks_stop_the_build(spark, tmp_path):
    raw = f"{tmp_path}/bronze"
    players = season.elements()
    players[0]["team"] = 77
    players[1]["status"] = "x"
    season.land(spark, raw, season.NEW, season.season(elements=players))
    with pytest.raises(BrokenChecks) as error:
        build_checked(spark, raw, Lake(str(tmp_path)))
    assert "stg_fpl__players.team_id.parent (1)" in str(error.value)
    assert "stg_fpl__players.accepted (1)" in str(error.value)


def _published(spark, lake):
    """What a reader sees: the build, and the load that each typed table of it holds."""
    now = lake.current(spark)
    loads = {n: {r[0] for r in now.read(spark, "silver", n).select("load_id").distinct().collect()} for n in silver.MODELS}
    sizes = {n: now.read(spark, "gold", n).count() for n in MARTS}
    return now, loads, sizes


def test_a_lost_table_stops_the_build(spark, tmp_path):
    """Without files of a raw table nothing is published, and what was published stays."""
    raw, lake = f"{tmp_path}/bronze", Lake(str(tmp_path))
    season.land(spark, raw, season.NEW, season.season())
    build_checked(spark, raw, lake)
    before = _published(spark, lake)
    less = f"{tmp_path}/less"
    season.land(spark, less, season.NEW, {k: v for k, v in season.season().items() if k != "fixtures"})
    with pytest.raises(MissingSource, match="fixtures"):
        build_checked(spark, less, lake)
    assert _published(spark, lake) == before


def test_broken_data_is_not_published(spark, tmp_path):
    raw, lake = f"{tmp_path}/bronze", Lake(str(tmp_path))
    season.land(spark, raw, season.NEW, season.season())
    build_checked(spark, raw, lake)
    before = _published(spark, lake)
    players = season.elements()
    players[0]["team"] = 77
    broken = f"{tmp_path}/broken"
    season.land(spark, broken, season.NEW, season.season(elements=players))
    with pytest.raises(BrokenChecks, match="stg_fpl__players.team_id.parent"):
        build_checked(spark, broken, lake)
    assert _published(spark, lake) == before


def test_published_columns_are_a_contract(spark, tmp_path):
    raw, lake = f"{tmp_path}/bronze", Lake(str(tmp_path))
    season.land(spark, raw, season.NEW, season.season())
    spark.createDataFrame([(1, "x")], "team_id long, renamed string").write.parquet(lake.path("gold", "dim_team"))
    with pytest.raises(ContractError, match="gold.dim_team"):
        build(spark, raw, lake)


def test_nothing_committed(spark, tmp_path):
    raw = f"{tmp_path}/bronze"
    season.land(spark, raw, season.NEW, {"teams": season.teams()}, commit=False)
    with pytest.raises(NoCommittedLoad):
        build(spark, raw, Lake(str(tmp_path)))


def test_text_in_a_number_stops_the_build(spark, tmp_path):
    raw = f"{tmp_path}/bronze"
    players = season.elements()
    players[3]["form"] = "abc"
    season.land(spark, raw, season.NEW, season.season(elements=players))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        build(spark, raw, Lake(str(tmp_path)))


def test_building_twice_gives_the_same(spark, tmp_path):
    raw = f"{tmp_path}/bronze"
    season.land(spark, raw, season.NEW, season.season())
    lake = Lake(str(tmp_path))
    first = rows(build(spark, raw, lake)["mart_position_scarcity"])
    again = build(spark, raw, lake)
    assert rows(again["mart_position_scarcity"]) == first
    assert run_checks(again).count() == 0


class _Killed(RuntimeError):
    pass


def test_readers_see_one_whole_build_wherever_it_dies(spark, tmp_path, monkeypatch):
    """A second build is killed among its typed tables, among its marts, before and after the pointer."""
    raw, lake = f"{tmp_path}/bronze", Lake(str(tmp_path))
    season.land(spark, raw, season.OLD, season.season())
    build(spark, raw, lake)
    before = _published(spark, lake)
    season.land(spark, raw, season.NEW, season.season(elements=season.elements()[:-1]))
    write, publish = Lake.write, Lake.publish
    for model in ("stg_fpl__teams", "mart_player_value"):

        def dying(self, df, layer, name, contract=None, last=model):
            if name == last:
                raise _Killed(name)
            write(self, df, layer, name, contract)

        monkeypatch.setattr(Lake, "write", dying)
        with pytest.raises(_Killed):
            build(spark, raw, lake)
        assert _published(spark, lake) == before
    monkeypatch.setattr(Lake, "write", write)

    def never(self, *_):
        raise _Killed("publish")

    monkeypatch.setattr(Lake, "publish", never)
    with pytest.raises(_Killed):
        build(spark, raw, lake)
    assert _published(spark, lake) == before

    def late(self, *given):
        publish(self, *given)
        raise _Killed("after")

    monkeypatch.setattr(Lake, "publish", late)
    with pytest.raises(_Killed):
        build(spark, raw, lake)
    now, loads, sizes = _published(spark, lake)
    assert now != before[0] and set().union(*loads.values()) == {season.NEW}
    # Whoever resolved the older build before still reads it, whole.
    assert {r[0] for r in before[0].read(spark, "silver", "stg_fpl__teams").select("load_id").collect()} == {season.OLD}
    assert lake.retire(spark, keep=1) == [before[0].root.rsplit("/", 1)[1]]
    assert _published(spark, lake) == (now, loads, sizes)


def test_only_builds_of_a_lake_are_published(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(ValueError, match="not a build"):
        lake.publish(spark, Lake(f"{tmp_path}/elsewhere"))
    with pytest.raises(ValueError):
        lake.retire(spark, keep=0)
    one, two = lake.aside(), lake.aside()
    assert lake.current(spark) == lake
    lake.publish(spark, one)
    lake.publish(spark, two)
    assert lake.current(spark) == two
    lake.publish(spark, one)
    assert lake.current(spark) == one and len(lake.pointers(spark)) == 3
    assert lake.retire(spark, keep=2) == []
    assert lake.current(spark) == one


def test_a_text_that_many_players_share_is_stored_once(spark, built, tmp_path):
    """Fixtures of a club x its players: the text is joined when the mart is read, and only then."""
    value, run = built["mart_player_value"], built["mart_team_fixture_run"]
    assert not any(
        "next_opponents" in spark.read.parquet(f.rsplit("/", 1)[0]).columns
        for f in value.select("player_id").inputFiles()
    )
    soon = {r["team_id"]: r["opponents"] for r in run.filter("gameweek_id = 1").collect()}
    told = value.select("team_id", "next_opponents").collect()
    assert len(told) == 48 and any(r["next_opponents"] for r in told)
    assert all(r["next_opponents"] == soon[r["team_id"]] for r in told)
    names = value.columns
    assert names.index("next_opponents") == names.index("is_blank_next_gameweek") - 1
    assert "Join" not in plan_of(value.select("player_id", "is_differential"))
    # A build of before, which stored the text, is read as it is, and its columns are the same contract.
    raw, lake = f"{tmp_path}/bronze", Lake(str(tmp_path))
    season.land(spark, raw, season.NEW, season.season())
    old = lake.aside()
    value.withColumn("next_opponents", F.lit("old")).write.parquet(old.path("gold", "mart_player_value"))
    lake.publish(spark, old)
    assert rows(lake.read(spark, "gold", "mart_player_value").select("next_opponents").distinct()) == [("old",)]
    build(spark, raw, lake)
    assert rows(lake.read(spark, "gold", "mart_player_value").drop("load_id")) == rows(value.drop("load_id"))
    assert lake.published_schema(spark, "gold", "mart_player_value").fieldNames() == names


def test_texts_of_fixtures_are_collected_after_the_shuffle(built):
    """Collecting them before it as well reduces nothing: the text has every fixture."""
    sides, teams = built["fct_team_fixture"], built["dim_team"]
    run = gold.mart_team_fixture_run(teams, built["stg_fpl__gameweeks"], sides)
    plan = re.sub(r"#\d+L?", "", plan_of(run))
    assert re.search(r"Exchange hashpartitioning\(team_id, gameweek_id, \d+\), REPARTITION_BY_COL", plan)
    assert not re.search(r"Exchange hashpartitioning\(team_id, gameweek_id, \d+\), ENSURE", plan)
    names = {r["team_id"]: r["team_short_name"] for r in teams.collect()}
    cells = {}
    for r in sides.filter("gameweek_id IS NOT NULL").collect():
        label = f"{names[r['opponent_team_id']]} ({r['venue']})"
        order = (r["kickoff_time"] is None, str(r["kickoff_time"]), r["fixture_id"])
        cells.setdefault((r["team_id"], r["gameweek_id"]), []).append((order, label))
    found = {(r["team_id"], r["gameweek_id"]): r for r in run.collect()}
    assert cells and set(cells) <= set(found)
    for cell, row in found.items():
        mine = sorted(cells.get(cell, []))
        assert row["fixture_count"] == len(mine)
        assert row["opponents"] == (", ".join(label for _, label in mine) or None)
