"""Grain, selections, checks, runs, identity and the game's rules on small hand-made frames."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tidemark.operators.asof import as_of
from tidemark.operators import checks, game, grain, identity, runs, selection, snapshot

# ---- Grain. ----


def test_dense_cells_and_outlook(spark):
    teams = spark.createDataFrame([(1,), (2,)], "team long")
    weeks = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "gw long, name string")
    cells = spark.createDataFrame([(1, 1, 1, 3), (1, 4, 2, 8)], "team long, gw long, n long, d long")
    grid = grain.dense_cells(teams, cells, weeks, "team", "gw", ["n"])
    assert rows(grid.select("team", "gw", "n", "d", "name")) == [
        (1, 1, 1, 3, "a"), (1, 2, 0, None, "b"), (1, 4, 2, 8, "d"),
        (2, 1, 0, None, "a"), (2, 2, 0, None, "b"), (2, 4, 0, None, "d"),
    ]
    out = grain.rolling_outlook(grid, "team", "gw", {"n": "n"}, 2, {"avg": ("d", "n")})
    assert rows(out.filter("team = 1").select("gw", "next_2_n", "next_2_avg", "next_2_is_partial")) == [
        (1, 1, 3.0, False), (2, 2, 4.0, False), (4, 2, 4.0, True),
    ]
    assert rows(grain.dense_grid(teams, weeks, "gw").select("team", "gw")) == rows(grid.select("team", "gw"))


def test_the_grid_is_not_shuffled(spark):
    teams = spark.range(50).withColumnRenamed("id", "team")
    weeks = spark.range(1, 39).withColumnRenamed("id", "gw")
    cells = teams.join(weeks.limit(3)).withColumn("n", F.lit(1).cast("long"))
    grid = grain.dense_cells(teams, cells, weeks, "team", "gw", ["n"])
    plan = plan_of(grain.rolling_outlook(grid, "team", "gw", {"n": "n"}, 5))
    above = plan[: plan.index("Generate posexplode")]
    assert "Window" in above and "Exchange hashpartitioning" not in above


def test_periods_may_lie_far_apart(spark):
    """Two periods a thousand million apart are two rows per entity, not what lies between."""
    teams = spark.createDataFrame([(1,), (2,), (3,)], "team long")
    weeks = spark.createDataFrame([(1, "a"), (10**9, "z"), (None, "?")], "gw long, name string")
    cells = spark.createDataFrame([(1, 10**9, 4, 2.5), (2, 1, 1, None), (2, 10**9, 2, 0.5), (3, 77, 9, 9.0)], "team long, gw long, n long, x double")
    assert rows(grain.dense_grid(teams, weeks, "gw")) == sorted((g, t, n) for g, n in ((1, "a"), (10**9, "z")) for t in (1, 2, 3))
    grid = grain.dense_cells(teams, cells, weeks, "team", "gw", ["n"])
    assert rows(grid.select("team", "gw", "n", "x", "name")) == sorted([
        (1, 1, 0, None, "a"), (1, 10**9, 4, 2.5, "z"), (2, 1, 1, None, "a"), (2, 10**9, 2, 0.5, "z"),
        (3, 1, 0, None, "a"), (3, 10**9, 0, None, "z"),
    ], key=repr)
    twice = cells.unionByName(cells)
    with pytest.raises(Exception, match="two cells"):
        grain.dense_cells(teams, twice, weeks, "team", "gw", ["n"]).collect()


def test_an_empty_calendar_gives_an_empty_grid(spark):
    teams = spark.createDataFrame([(1,)], "team long")
    none = spark.createDataFrame([], "gw long")
    assert grain.dense_grid(teams, none, "gw").count() == 0


def test_every_label_in_order(spark):
    data = [(1, "b", 2, 1), (1, "a", 2, 2), (1, "z", 1, 3), (1, "z", 9, 4), (1, "u", None, 5), (2, None, 1, 6)]
    df = spark.createDataFrame(data, "k long, label string, t long, id long")
    assert rows(grain.ordered_labels(df, ["k"], "label", "t", "id", "text")) == [(1, "z, b, a, z, u")]


# ---- Selections. ----


def gameweek(**flags):
    row = {"id": None, "is_current": None, "is_previous": None, "finished": None, "data_checked": None}
    return tuple({**row, **flags}.values())


@pytest.mark.parametrize(
    "events,expected",
    [
        ([gameweek(id=1), gameweek(id=2, is_current=False, finished=False)], []),
        ([gameweek(id=3, is_previous=True, finished=True, data_checked=True)], [3]),
        ([gameweek(id=4, is_current=True), gameweek(id=5)], [4]),
        ([gameweek(id=2, finished=True), gameweek(id=3, finished=True, data_checked=True)], [2]),
        ([gameweek(is_current=True)], []),
        ([gameweek(id=7, is_current=True), gameweek(id=7, finished=True)], [7]),
        ([], []),
    ],
)
def test_unsettled(spark, events, expected):
    schema = "id long, is_current boolean, is_previous boolean, finished boolean, data_checked boolean"
    df = spark.createDataFrame(events, schema)
    assert [r[0] for r in rows(selection.unsettled(df))] == expected


@pytest.mark.parametrize(
    "spec,expected,reason",
    [
        ("5", [5], None),
        ("1-4", [1, 2, 3, 4], None),
        ("7,1,3-5,4", [1, 3, 4, 5, 7], None),
        (" 1 , 3 - 5 ", [1, 3, 4, 5], None),
        ("1,,2", [1, 2], None),
        ("9-2", [], "inverted"),
        ("0", [], "outside"),
        ("39", [], "outside"),
        ("0-5", [], "outside"),
        ("35-40", [], "outside"),
        ("gw5", [], "not numeric"),
        ("3-", [], "not numeric"),
    ],
)
def test_range_specs(spark, spec, expected, reason):
    df = spark.createDataFrame([(1, spec)], "k long, spec string")
    got = selection.expand_range_specs(df, "k", "spec", "gw")
    assert sorted(r["gw"] for r in got.collect()) == expected
    errors = selection.range_spec_errors(df, "k", "spec").collect()
    assert [e["reason"] for e in errors] == ([reason] if reason else [])


# ---- Checks that span models; the per-column ones are broken one by one in the build tests. ----


def test_one_snapshot(spark):
    loads = spark.createDataFrame([("1", True), ("2", False)], "load_id string, is_committed boolean")

    def model(*ids):
        return spark.createDataFrame([(i,) for i in ids], "load_id string")

    assert checks.one_snapshot({"a": model("1"), "b": model("1")}, loads).count() == 0
    assert rows(checks.one_snapshot({"a": model("2"), "b": model("2")}, loads).select("model_name")) == [("a",), ("b",)]
    assert checks.one_snapshot({"a": model("1"), "b": model("1", "2")}, loads).count() == 1
    unknown = loads.unionByName(spark.createDataFrame([(None, True)], loads.schema))
    assert checks.one_snapshot({"a": model("2")}, unknown).count() == 0


def test_types_rules_flag_budget(spark):
    wrong = spark.createDataFrame([(1,)], "home_score int")
    assert rows(checks.column_types({"m": wrong}, {"m.home_score": "bigint"})) == [("m.home_score", "int", "bigint", 1)]
    assert checks.column_types({"m": wrong}, {"m.home_score": "int"}).count() == 0
    with pytest.raises(KeyError):
        checks.column_types({"m": wrong}, {"m.away_score": "bigint"})

    positions = spark.createDataFrame([(2, 1, 1), (13, 6, 13)], "squad_required long, lineup_min long, lineup_max long")
    settings = "squad_size long, lineup_size long"
    assert checks.rules_agree(positions, spark.createDataFrame([(15, 11)], settings)).count() == 0
    broken = checks.rules_agree(positions, spark.createDataFrame([(14, 99)], settings))
    assert rows(broken) == [("lineup size is reachable", 7, 99), ("squad size", 15, 14)]

    flagged = spark.createDataFrame([(True,), (True,)], "points_are_prior_season boolean")
    assert checks.prior_flag_holds(flagged, F.lit(True)).count() == 0
    assert rows(checks.prior_flag_holds(flagged, F.lit(False))) == [(True, False, 1, 2)]

    schema = "minimum_squad_gbp_m double, budget_gbp_m double, budget_headroom_gbp_m double, cheapest_fill_gbp_m double, squad_required long, squad_size long"
    good = (60.0, 100.0, 40.0, 60.0, 15, 15)
    assert checks.budget_holds(spark.createDataFrame([good], schema)).count() == 0
    for i, value in ((0, 86.0), (2, 41.0), (3, 59.0), (4, 14)):
        bad = list(good)
        bad[i] = value
        assert checks.budget_holds(spark.createDataFrame([tuple(bad)], schema)).count() == 1


def test_grid_and_sides(spark):
    users, days = spark.range(2).toDF("u"), spark.range(3).toDF("d")
    grid = users.join(days)
    assert checks.grid_complete(grid, users, days, "u", "d").count() == 0
    gap = grid.filter("NOT (u = 1 AND d = 2)")
    assert [r[0] for r in rows(checks.grid_complete(gap, users, days, "u", "d"))] == ["grid_shape", "team_coverage"]
    moved = gap.unionByName(gap.filter("u = 1 AND d = 0"))
    assert checks.grid_complete(moved, users, days, "u", "d").count() == 1

    schema = "fixture_id long, team_id long, opponent_team_id long, is_home boolean, difficulty long, opponent_difficulty long, goals_for long, goals_against long"
    home, away = (1, 10, 20, True, 2, 4, None, None), (1, 20, 10, False, 4, 2, None, None)
    assert checks.sides_balance(spark.createDataFrame([home, away], schema)).count() == 0
    for wrong in ((1, 20, 10, False, 2, 2, None, None), (1, 20, 99, False, 4, 2, None, None), (1, 20, 10, False, 4, 2, None, 1)):
        assert checks.sides_balance(spark.createDataFrame([home, wrong], schema)).count() == 1
    assert checks.sides_balance(spark.createDataFrame([home], schema)).count() == 1


# ---- History. ----


def test_changes_and_latest(spark):
    data = [("p", 1.0, 5), ("p", 2.0, 5), ("p", 3.0, 6), ("p", 4.0, None), ("p", 5.0, None), ("q", 2.0, 9)]
    df = spark.createDataFrame(data, "k string, t double, v long")
    got = rows(snapshot.value_changes(df, "k", "t", "v").select("k", "t", "previous_value", "v"))
    assert got == [("p", 1.0, None, 5), ("p", 3.0, 5, 6), ("p", 4.0, 6, None), ("q", 2.0, None, 9)]
    latest = snapshot.latest_per_key(df, ["k"], F.col("t"), ["t", "v"])
    assert rows(latest) == [("p", 5.0, None), ("q", 2.0, 9)]


def test_latest_reads_whole_rows_only_at_the_newest_place(spark, tmp_path):
    # One key with a third of the rows, all of them tied; a null key; null places; repeated rows.
    data = [("hot", 7, i % 50, f"v{i % 40}") for i in range(400)]
    data += [(f"k{i % 90}", i % 11, i % 3, f"w{i}") for i in range(700)]
    data += [(None, 1, 1, "a"), (None, 2, 1, "b"), ("none", None, 4, "c"), ("none", None, None, "d"), ("part", None, 9, "e"), ("part", 0, 0, "f")]
    spark.createDataFrame(data * 2, "k string, t int, u int, v string").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    got = {r["k"]: (r["t"], r["u"], r["v"]) for r in snapshot.latest_per_key(df, ["k"], [F.col("t"), F.col("u")], ["t", "u", "v"]).collect()}

    def place(row):
        return tuple((x is not None, x or 0) for x in row[1:3])

    best = {}
    for row in data:
        best[row[0]] = max(best.get(row[0], place(row)), place(row))
    assert len(got) == len(best)
    for key, place_of_best in best.items():
        assert (key, *got[key]) in data and place((key, *got[key])) == place_of_best
    # The same rows in another order and other partitions give the same winners of ties.
    again = snapshot.latest_per_key(df.repartition(7, "v"), ["k"], [F.col("t"), F.col("u")], ["t", "u", "v"])
    assert {r["k"]: (r["t"], r["u"], r["v"]) for r in again.collect()} == got
    assert snapshot.latest_per_key(df.limit(0), ["k"], F.col("t"), ["v"]).count() == 0
    # A key may be a value as well, and all that is asked for may be the key.
    assert snapshot.latest_per_key(df, ["k"], F.col("t"), ["k"]).count() == len(best)
    text = plan_of(snapshot.latest_per_key(df, ["k"], [F.col("t"), F.col("u")], ["v"]))
    assert "HashAggregate" in text and "SortAggregate" not in text and "LeftSemi" in text
    assert "ReadSchema: struct<k:string,t:int>" in text


# ---- Run ledger. ----


def test_only_critical_checks_make_the_share(spark):
    at = datetime.datetime(2024, 1, 1, 12)
    data = [
        ("a", "critical", 0, True, at), ("b", "critical", 2, False, at), ("c", "warn", 1, False, at),
        ("d", None, 0, True, at), ("e", "critical", None, None, at),
        ("a", "warn", 0, True, at + datetime.timedelta(days=1)), ("a", "critical", 0, True, at + datetime.timedelta(days=5)),
    ]
    df = spark.createDataFrame(data, "check_name string, grade string, violations long, passed boolean, recorded_at timestamp")
    got = runs.correctness_daily(df, days=2).orderBy("day").collect()
    assert [(r["critical"], r["critical_passed"], r["warnings"], r["warnings_failed"], r["holds"]) for r in got] == [
        (4, 2, 1, 1, False), (0, 0, 1, 0, None), (1, 1, 0, 0, True),
    ]
    assert [r["critical_share"] for r in got] == [0.5, None, 1.0]
    assert [r["critical_share_30d"] for r in got] == [0.5, 0.5, 1.0]
    assert runs.correctness_daily(df.limit(0)).count() == 0


def test_run_key(spark):
    df = spark.createDataFrame([(42, 1, "load: raw & typed?")], "r long, a long, j string")
    assert df.select(runs.run_key(F.col("r"), F.col("a"), F.col("j"))).first()[0] == "42.1.load-raw-typed-"


def test_metrics_never_cost_the_record(spark):
    finishes = spark.createDataFrame(
        [("a", "success"), ("b", "cancelled"), ("c", "failure"), ("d", "success")],
        "run_key string, job_status string",
    )
    metrics = spark.createDataFrame(
        [("a", '{"rows_processed": 0, "peak_mem_mb": 5, "detail": {"tables": "9", "job_status": "x"}}'), ("b", "{not json"), ("c", '{"rows_procesed": 1}')],
        "run_key string, body string",
    )
    got = {r["run_key"]: r for r in runs.merge_metrics(finishes, metrics).collect()}
    assert got["a"]["rows_processed"] == 0 and got["a"]["note"] is None
    assert got["a"]["detail"] == {"tables": "9", "job_status": "success"}
    assert (got["b"]["status"], got["b"]["detail"]["job_status"]) == ("failed", "cancelled")
    assert got["b"]["note"] == "metrics file unreadable"
    assert got["c"]["note"] == "ignored unknown metrics key(s): rows_procesed"
    assert got["d"]["note"] == "metrics file not found" and got["d"]["rows_processed"] is None


RUN = "run_key string, attempt long, event string, recorded_at timestamp, status string, rows_processed long, peak_mem_mb long"


def _at(day, time):
    return datetime.datetime.fromisoformat(f"2026-01-{day:02d}T{time}:00")


def test_a_died_run_stays(spark):
    records = spark.createDataFrame(
        [
            ("a", 1, "start", _at(1, "07:00"), "running", None, None),
            ("a", 1, "finish", _at(1, "07:02"), "success", 0, 9),
            ("b", 2, "start", _at(1, "07:03"), "running", None, None),
            ("c", 1, "finish", _at(1, "07:04"), "failed", None, None),
        ],
        RUN,
    )
    got = runs.pair_runs(records).select("run_key", "attempt", "duration_seconds", "rows_processed", "status")
    assert rows(got) == [("a", 1, 120, 0, "success"), ("b", 2, None, None, "died")]


def test_finishes_of_one_moment_have_one_winner(spark):
    late = [("a", 1, "finish", _at(1, "07:02"), s, n, None) for s, n in (("failed", 5), ("success", 3), ("success", 4))]
    start = ("a", 1, "start", _at(1, "07:00"), "running", None, None)
    for order in (late, late[::-1]):
        got = runs.pair_runs(spark.createDataFrame([start, *order], RUN)).first()
        assert (got["status"], got["rows_processed"]) == ("success", 4)


def test_a_day_without_a_run_is_missed(spark):
    """Fresh on the 1st; nothing on the 2nd; on the 3rd the run ends after the deadline."""
    records = []
    for day, end in ((1, "07:59"), (3, "08:01"), (4, "08:00")):
        records.append((f"r{day}", 1, "start", _at(day, "07:00"), "running", None, None))
        records.append((f"r{day}", 1, "finish", _at(day, end), "success", 50, 1500))
    paired = runs.pair_runs(spark.createDataFrame(records, RUN))
    got = [
        (r["day"].day, r["runs"], r["is_fresh"], round(r["fresh_days_30d"], 4), r["memory_alert"])
        for r in runs.daily_indicators(paired, expected_rows=50).orderBy("day").collect()
    ]
    assert got == [(1, 1, True, 1.0, True), (2, 0, False, 0.5, None), (3, 1, False, 0.3333, True), (4, 1, True, 0.5, True)]
    later = runs.daily_indicators(paired, expected_rows=50, deadline="09:01", zone="Europe/Berlin").orderBy("day")
    assert [r["is_fresh"] for r in later.collect()] == [True, False, True, True]


def test_a_run_across_midnight_makes_the_second_day_fresh(spark):
    """Started on the 1st at 23:50, finished on the 2nd at 00:30; nothing after that."""
    records = [
        ("a", 1, "start", _at(1, "23:50"), "running", None, None),
        ("a", 1, "finish", _at(2, "00:30"), "success", 50, 100),
        ("b", 1, "start", _at(3, "09:00"), "running", None, None),
    ]
    paired = runs.pair_runs(spark.createDataFrame(records, RUN))
    got = [(r["day"].day, r["runs"], r["is_fresh"], r["data_age_seconds"], r["fresh_days_30d"])
           for r in runs.daily_indicators(paired, expected_rows=50).orderBy("day").collect()]
    assert got == [(1, 1, False, None, 0.0), (2, 0, True, 27_000, 0.5), (3, 1, False, 113_400, 1 / 3)]


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_days_are_those_of_the_given_zone(spark, session):
    """23:30 UTC is half past one of the next day in Athens, whatever the session's zone."""
    utc = datetime.timezone.utc
    started, finished = (datetime.datetime(2024, 1, 1, 23, m, tzinfo=utc) for m in (10, 30))
    schema = "run_key string, attempt int, started_at timestamp, finished_at timestamp, rows_processed long, peak_mem_mb int, status string, duration_seconds long"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        paired = spark.createDataFrame([("a", 1, started, finished, 50, 1, "success", 1200)], schema)
        athens = runs.daily_indicators(paired, expected_rows=50, zone="Europe/Athens").collect()
        assert [(str(r["day"]), r["is_fresh"], r["data_age_seconds"]) for r in athens] == [("2024-01-02", True, 23_400)]
        york = runs.daily_indicators(paired, expected_rows=50, zone="America/New_York", deadline="18:30").collect()
        assert [(str(r["day"]), r["is_fresh"], r["data_age_seconds"]) for r in york] == [("2024-01-01", True, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_as_of_by_brute_force(spark, width):
    """Ties in time, equal moments on both sides, null keys and moments, one key with most rows."""
    rng = random.Random(width)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    moment = lambda: rng.choice([None, *range(-40, 60)])
    left = [(i, key(), moment()) for i in range(300)]
    right = [(key(), moment(), rng.choice([None, 1, 2, 3]), rng.choice("xyz")) for _ in range(150)]
    got = as_of(
        spark.createDataFrame(left, "id int, k string, at long").repartition(4),
        spark.createDataFrame(right, "k string, t long, v int, w string").repartition(3),
        "at", ["v", "w"], by=["k"], width=width, right_at="t",
    )
    want = []
    for i, k, at in left:
        seen = [(t, -1 if v is None else v, w) for r, t, v, w in right if None not in (k, at, r, t) and r == k and t <= at]
        t, v, w = max(seen, default=(None, None, None))
        want.append((i, k, at, t, None if v == -1 else v, w))
    assert rows(got) == sorted(want, key=repr)
    assert got.columns == ["id", "k", "at", "as_of", "v", "w"]
    nothing = spark.createDataFrame([], "k string, t long, v int, w string")
    alone = as_of(spark.createDataFrame(left, "id int, k string, at long"), nothing, "at", ["v"], by=["k"], right_at="t")
    assert alone.filter("as_of IS NULL").count() == 300


@pytest.mark.parametrize("buckets", [[], ["b"], ["b", "c"]])
def test_value_spans_by_brute_force(spark, buckets):
    """Changes and how long values held, over buckets of any size, with unknown values."""
    rng = random.Random(len(buckets))
    history = [(k, t, t // 10, t // 3, rng.choice([None, 1, 1, 2])) for k in ("hot", "a", None) for t in range(60) if k == "hot" or rng.random() < 0.2]
    df = spark.createDataFrame(history, "k string, t long, b long, c long, v int").repartition(4)
    want = []
    for key in ("hot", "a", None):
        mine, last, changes = [h for h in history if h[0] == key], (), []
        for _, t, _, _, v in mine:
            if last != (v,):
                changes.append((key, t, last[0] if last else None, v, not last))
            last = (v,)
        starts = [c[1] for c in changes]
        want += [(*c, c[1], e) for c, e in zip(changes, [*starts[1:], None])]
    got = snapshot.value_changes(df, "k", "t", "v", buckets)
    assert rows(got.select("k", "t", "previous_value", "v", "is_first", "valid_from", "valid_to")) == sorted(want, key=repr)


@pytest.mark.parametrize("span", [2, 3, 64])
def test_transfers_over_long_calendars(spark, span):
    """Maps composed over several tiers give what playing week by week gives."""
    rng = random.Random(span)
    weeks, want = [], []
    for manager, first, count in (("a", 0, 100), ("b", 30, 5), ("c", 95, 1)):
        free = 1
        for week in range(first, first + count):
            made = rng.choice([0, 0, 1, 2, 5])
            weeks.append((manager, week, made))
            want.append((manager, week, made, free, -4 * max(0, made - free)))
            free = min(free - min(free, made) + 1, 3)
    df = spark.createDataFrame(weeks, "m string, gw int, transfers int").repartition(4)
    got = game.transfer_hits(df, "m", "gw", banked_most=3, span=span)
    assert rows(got.select("m", "gw", "transfers", "free_transfers", "hit_points")) == sorted(want, key=repr)
    nothing = game.transfer_hits(df.limit(0), "m", "gw", span=span)
    assert nothing.count() == 0


def test_phases_are_differences_of_running_totals(spark):
    """Phases that overlap, lie apart or hold nothing; weeks far apart, unknown points."""
    rng = random.Random(4)
    points = [(m, w, rng.choice([None, 1, 2, 9])) for m in "abc" for w in (1, 2, 3, 70, 71, 200) for _ in range(rng.randint(0, 2))]
    points.append(("d", 500, None))
    phases = [(1, 1, 200), (2, 2, 70), (3, 4, 60), (4, 71, 71), (5, 500, 600)]
    got = game.league_table(
        spark.createDataFrame(points, "m string, gw int, points long"),
        spark.createDataFrame(phases, "phase_id int, first_gameweek_id int, last_gameweek_id int"),
        "m", "gw",
    )
    want = []
    for phase, first, last in phases:
        totals = {}
        for m in "abcd":
            mine = [p for x, w, p in points if x == m and first <= w <= last]
            if mine:
                known = [p for p in mine if p is not None]
                totals[m] = sum(known) if known else None
        for m, total in totals.items():
            better = sum(1 for t in totals.values() if t is not None and (total is None or t > total))
            want.append((phase, m, total, better + 1))
    assert rows(got.select("phase_id", "m", "points", "league_rank")) == sorted(want, key=repr)


def test_start_and_finish_are_separate_files(spark, tmp_path):
    records = spark.createDataFrame([("k", "start"), ("k", "finish")], "run_key string, event string")
    records = records.withColumn("load_date", F.lit("2026-01-01").cast("date"))
    for event in ("start", "finish"):
        runs.append_run_records(records.filter(F.col("event") == event).coalesce(1), str(tmp_path))
    files = list((tmp_path / "ops_runs" / "load_date=2026-01-01").glob("*.json"))
    assert len(files) == 2
    assert all(f.read_text().endswith("}\n") and len(f.read_text().splitlines()) == 1 for f in files)


# ---- Identity. ----


def test_identity(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    said = spark.createDataFrame([(1, "anon-x"), (1, "anon-x"), (1, "anon-y"), (1, None)], "user_id long, distinct_id string")
    mapping = identity.identity_map(users, said)
    assert rows(mapping) == [(1, "1"), (1, "anon-x"), (1, "anon-y"), (2, "2")]
    events = spark.createDataFrame(
        [(1, "anon-x"), (1, "anon-x"), (2, "1"), (3, "stranger"), (4, "2")], "event_id long, distinct_id string"
    )
    # Event 1 also arrives under the account's own id: still four events.
    events = events.unionByName(spark.createDataFrame([(1, "1")], "event_id long, distinct_id string"))
    assert rows(identity.resolution_rate(events, mapping)) == [(4, 3, 0.75)]
    business = spark.createDataFrame([(1, 7)], "user_id long, orders long")
    assert rows(identity.manager_360(users, business, events, mapping)) == [(1, 7, 2, 2), (2, 0, 1, 1)]


# ---- The game. ----


def test_sell_price(spark):
    df = spark.createDataFrame([(50, 53), (50, 51), (50, 47), (50, 50)], "b long, c long")
    got = [r[0] for r in df.select(game.sell_price(F.col("b"), F.col("c"))).collect()]
    assert got == [51, 50, 47, 50]


def test_transfer_hits(spark):
    weekly = spark.createDataFrame([("m", w, n) for w, n in enumerate([0, 0, 0, 4, 1, 3], 1)], "m string, gw int, transfers long")
    got = rows(game.transfer_hits(weekly, "m", "gw").select("gw", "free_transfers", "hit_points"))
    assert got == [(1, 1, 0), (2, 2, 0), (3, 2, 0), (4, 2, -8), (5, 1, 0), (6, 1, -8)]


def test_squad_validity(spark):
    positions = spark.createDataFrame(list({"GK": 1, "DEF": 2}.items()), "position_id string, squad_required long")
    schema = "squad long, position_id string, team_id long, price_tenths long"
    good = [(1, "GK", 1, 40), (1, "DEF", 2, 40), (1, "DEF", 3, 40)]
    cases = {
        1: good,
        2: [(2, "GK", 1, 40), (2, "DEF", 1, 40), (2, "DEF", 1, 41)],
        3: [(3, "DEF", 1, 40), (3, "DEF", 2, 40), (3, "DEF", 3, 40)],
        4: [(4, "DEF", 2, 40), (4, "DEF", 3, 40)],
    }
    picks = spark.createDataFrame([p for c in cases.values() for p in c], schema)
    got = game.squad_validity(picks, positions, "squad", squad_size=3, budget_tenths=120, per_club=2)
    flags = rows(got.select("squad", "size_ok", "budget_ok", "quota_ok", "club_ok", "is_valid"))
    assert flags == [
        (1, True, True, True, True, True),
        (2, True, False, True, False, False),
        (3, True, True, False, True, False),
        (4, False, True, False, True, False),
    ]


def test_squad_validity_deals_picks_by_their_number(spark, monkeypatch):
    """A task's share of the picks is fixed; a squad of most picks is spread over its cells."""
    monkeypatch.setattr(game, "PICKS_OF_A_TASK", 100)
    positions = spark.createDataFrame([("GK", 1), ("DEF", 2)], "position_id string, squad_required long")
    small = spark.range(2000).selectExpr("id % 500 AS squad", "id", "id DIV 500 AS k")
    hot = spark.range(2000).selectExpr("-1L AS squad", "id", "id % 7 AS k")
    picks = small.union(hot).selectExpr(
        "squad", "IF(k = 0, 'GK', 'DEF') AS position_id", "k % 3 AS team_id", "1 + id % 5 AS price_tenths"
    )
    got = game.squad_validity(picks, positions, "squad", squad_size=4, budget_tenths=12, per_club=2)
    dealt = re.findall(r"Exchange hashpartitioning\(([^()]*), (\d+)\), REPARTITION_BY_NUM", plan_of(got))
    assert [n for _, n in dealt] == ["40", "40"]
    assert sorted(re.sub(r"#\d+L?", "", keys) for keys, _ in dealt) == ["squad", "squad, position_id, team_id"]
    assert plan_of(got).count("Exchange hashpartitioning(squad") == 2 and "SortMergeJoin" not in plan_of(got)
    found = {r["squad"]: r for r in got.collect()}
    held = {}
    for r in picks.collect():
        held.setdefault(r["squad"], []).append(r)
    assert len(found) == 501 and set(found) == set(held)
    for squad, mine in held.items():
        clubs = [p["team_id"] for p in mine]
        assert found[squad]["picks"] == len(mine)
        assert found[squad]["cost_tenths"] == sum(p["price_tenths"] for p in mine)
        assert found[squad]["most_from_one_club"] == max(clubs.count(t) for t in clubs)
    told = game.squad_validity(picks, positions, "squad", squad_size=4, budget_tenths=12, per_club=2, pick_count=5000)
    assert ", 50), REPARTITION_BY_NUM" in plan_of(told) and rows(told) == rows(got)


def test_limits_come_from_the_settings(spark):
    names = "squad_size long, budget_tenths long, max_players_per_club long, max_extra_free_transfers long"
    told = game.limits(spark.createDataFrame([(11, 900, None, 4)], names))
    assert told["squad_validity"] == {"squad_size": 11, "budget_tenths": 900, "per_club": 3}
    assert told["transfer_hits"] == {"banked_most": 5} and told["manager_scores"] == {"squad_size": 11}
    assert game.limits(spark.createDataFrame([], names))["bank_balance"] == {"budget_tenths": 1000}
    weekly = spark.createDataFrame([("m", gw, 0) for gw in range(1, 200)], "m string, gw long, transfers long")
    free = game.transfer_hits(weekly, "m", "gw", **told["transfer_hits"]).orderBy("gw")
    assert [r["free_transfers"] for r in free.collect()] == [min(gw, 5) for gw in range(1, 200)]


def test_a_squad_of_another_size_stops_the_query(spark):
    picks = spark.createDataFrame(
        [("m", 1, "GK", 90, 1, True, False)],
        "m string, slot int, role string, minutes long, points long, is_captain boolean, is_vice boolean",
    )
    with pytest.raises(Exception, match="a squad has 1 picks, not 15"):
        game.manager_scores(picks, ["m"]).collect()


def brute_score(squad):
    """One manager's score by walking the rules."""
    starters = [p for p in squad if p["slot"] <= 11]
    bench = [p for p in squad if p["slot"] > 11 and p["minutes"] > 0]
    fielded = [p for p in starters if p["minutes"] > 0]
    formation = [p["role"] for p in starters]
    for out in [p for p in starters if p["minutes"] == 0]:
        for b in bench:
            after = formation.copy()
            after.remove(out["role"])
            after.append(b["role"])
            if all(lo <= after.count(r) <= hi for r, (lo, hi) in game.FORMATION.items()):
                formation, bench = after, [x for x in bench if x is not b]
                fielded.append(b)
                break
    captain = [p for p in starters if p["is_captain"] and p["minutes"] > 0]
    vice = [p for p in starters if p["is_vice"] and p["minutes"] > 0]
    return sum(p["points"] for p in fielded) + sum(p["points"] for p in (captain or vice))


def test_manager_scores_against_the_rules(spark):
    rng = random.Random(11)
    shapes = ["GK DEF DEF DEF DEF MID MID MID FWD FWD FWD", "GK DEF DEF DEF MID MID MID MID MID FWD FWD", "GK DEF DEF DEF DEF DEF MID MID MID MID FWD"]
    picks, want = [], []
    for manager in range(150):
        roles = rng.choice(shapes).split() + ["GK"] + rng.choices(["DEF", "MID", "FWD"], k=3)
        leaders = rng.sample(range(1, 12), 2)
        squad = [
            {"manager": manager, "slot": i, "role": role, "minutes": rng.choice([0, 0, 30, 90]),
             "points": rng.randrange(-2, 12), "is_captain": i == leaders[0], "is_vice": i == leaders[1]}
            for i, role in enumerate(roles, 1)
        ]
        picks += squad
        want.append((manager, brute_score(squad)))
    schema = "manager long, slot int, role string, minutes int, points int, is_captain boolean, is_vice boolean"
    df = spark.createDataFrame([tuple(p.values()) for p in picks], schema).repartition(5)
    assert rows(game.manager_scores(df, ["manager"]).select("manager", "score")) == sorted(want, key=repr)


def test_net_scores_and_league(spark):
    scores = spark.createDataFrame([("m", 1, 50), ("n", 1, 40)], "manager string, gw int, score long")
    hits = spark.createDataFrame([("m", 1, -8)], "manager string, gw int, hit_points long")
    assert rows(game.net_scores(scores, hits, ["manager", "gw"]).select("manager", "net_score")) == [("m", 42), ("n", 40)]

    points = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", 1, 5), ("b", 2, 9), ("c", 2, 2)], "m string, gw int, points long")
    phases = spark.createDataFrame([(1, 1, 2), (2, 1, 1)], "phase_id int, first_gameweek_id int, last_gameweek_id int")
    got = rows(game.league_table(points, phases, "m", "gw").select("phase_id", "m", "points", "league_rank"))
    assert got == [(1, "a", 6, 2), (1, "b", 14, 1), (1, "c", 2, 3), (2, "a", 5, 1), (2, "b", 5, 1)]


def test_points_of_a_match(spark):
    schema = "role string, minutes int, goals_scored int, clean_sheets int, saves int, goals_conceded int, published_points long"
    stats = spark.createDataFrame(
        [("GK", 90, 0, 0, 7, 3, 3), ("MID", 59, 1, 1, 9, 4, 7), ("FWD", 60, 2, 1, None, 0, 10), ("DEF", 0, 0, 0, 0, 0, None)], schema
    )
    computed = game.with_points(stats).select("role", "computed_points")
    assert rows(computed) == [("DEF", 0), ("FWD", 10), ("GK", 3), ("MID", 7)]
    assert rows(game.points_differences(stats).select("role", "computed_points")) == [("DEF", 0)]
