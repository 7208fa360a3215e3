"""Ranks, medians, fills and running totals against brute force, skew and ties included."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tidemark.operators import ranking


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all rows share one group, and a third of those one value; some have none."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else f"g{i % 40}"
        value = 0.0 if i % 9 == 0 else None if i % 31 == 0 else round(rng.uniform(-5, 5), 2)
        data.append((i, group if i % 50 else None, value))
    return data, spark.createDataFrame(data, "id long, grp string, v double").repartition(6)


def brute_rank(data, by_group, descending):
    out = []
    for i, g, v in data:
        peers = [x for _, h, x in data if not by_group or h == g]
        if v is None:
            before = sum(x is not None for x in peers)
        elif descending:
            before = sum(x is not None and x > v for x in peers)
        else:
            before = sum(x is not None and x < v for x in peers)
        out.append((i, before + 1, before / (len(peers) - 1) if len(peers) > 1 else 0.0))
    return out


@pytest.mark.parametrize("descending", [True, False])
def test_rank_and_percent_rank_in_group(scores, descending):
    data, df = scores
    want = brute_rank(data, True, descending)
    got = ranking.with_rank(df, ["grp"], "v", "r", descending)
    assert rows(got.select("id", "r")) == sorted([(i, r) for i, r, _ in want], key=repr)
    got = ranking.with_percent_rank(df, ["grp"], "v", "p", descending)
    assert rows(got.select("id", "p")) == sorted([(i, p) for i, _, p in want], key=repr)


def test_global_rank(scores):
    data, df = scores
    got = ranking.with_rank(df, [], "v", "r")
    want = [(i, r) for i, r, _ in brute_rank(data, False, True)]
    assert rows(got.select("id", "r")) == sorted(want, key=repr)


def test_reverse_rank_from_ascending_positions(scores):
    data, df = scores
    outputs = {"r": ranking.reverse_rank("v")}
    got = ranking.with_positions(df, ["grp"], "v", outputs)
    want = [(i, r) for i, r, _ in brute_rank(data, True, True)]
    assert rows(got.select("id", "r")) == sorted(want, key=repr)


def test_rank_of_constant_empty_and_null_values(spark):
    same = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "id long, v double")
    assert rows(ranking.with_rank(same, [], "v", "r").select("r")) == [(1,), (1,), (1,)]
    none = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert rows(ranking.with_rank(none, [], "v", "r").select("r")) == [(1,), (1,)]
    assert ranking.with_rank(none.limit(0), [], "v", "r").count() == 0
    one = spark.createDataFrame([(1, 2.0)], "id long, v double")
    assert ranking.with_percent_rank(one, [], "v", "p").first()["p"] == 0.0


def test_no_window_covers_the_whole_relation(scores):
    """The global ranking sorts by bucket; only the few bucket totals share one partition."""
    _, df = scores
    points = ranking.split_points(df, ["v"], 16)["v"]
    plan = plan_of(ranking.value_positions(df, [], "v", True, points))
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1 and "HashAggregate(keys=[bucket" in lines[single[0] + 1]
    windows = [line for line in lines if "Window [sum(ties" in line]
    assert windows and all("windowspecdefinition(bucket" in line for line in windows)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("weight", [1, 7, 40])
def test_buckets_grow_with_the_rows(scores, monkeypatch, descending, weight):
    """With few first cuts and a small target weight the parts are cut again; ranks stay exact."""
    data, df = scores
    points = ranking.split_points(df, ["v"], 5)["v"]
    assert points.finer(weight) == -(-3000 // (5 * weight))
    counted = ranking._with_bucket(df.groupBy("v").agg(F.expr("count(1) AS ties")), "v", points, descending)
    cut = ranking._cut_again(counted, "v", points.finer(weight), descending)
    heaviest = cut.filter("v is not null").groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert heaviest <= 2 * weight + 2
    for keys in ([], ["grp"]):
        got = ranking.value_positions(df, keys, "v", descending, points, weight)
        known = {(r["grp"] if keys else 0, r["v"]): r["before"] + 1 for r in got.collect()}
        for i, rank, _ in brute_rank(data, bool(keys), descending):
            assert known[data[i][1] if keys else 0, data[i][2]] == rank


def test_median(scores):
    data, df = scores
    groups = {}
    for _, g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    got = {g: m for g, m in rows(ranking.exact_median(df, ["grp"], "v", "m"))}
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g] == pytest.approx(statistics.median(values), abs=1e-12)


@pytest.mark.parametrize("dearest", [False, True])
def test_fill_takes_each_groups_own_number(spark, dearest):
    rng = random.Random(3)
    data = [(i, "ab"[i % 2], rng.randrange(1, 20), 2 if i % 2 else 4) for i in range(60)]
    df = spark.createDataFrame(data, "id long, grp string, price long, slots int").repartition(5)
    got = ranking.extreme_fill(df, "grp", "price", "id", "slots", "cost", dearest)
    want = []
    for g, k in (("a", 4), ("b", 2)):
        prices = sorted((p for _, h, p, _ in data if h == g), reverse=dearest)
        want.append((g, sum(prices[:k])))
    assert rows(got) == want


def test_fill_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 5, 2)], "id long, grp string, price long, slots int")
    plan = plan_of(ranking.extreme_fill(df, "grp", "price", "id", "slots", "cost"))
    above = plan[: plan.index("Exchange hashpartitioning")]
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v long")
    assert rows(ranking.with_share_of_total(df, "v", "t", "s")) == [("a", 1, 4, 0.25), ("b", 3, 4, 0.75)]


@pytest.mark.parametrize("buckets", [["day"], ["day", "half"]])
def test_running_total_over_buckets(spark, buckets):
    """Two thirds of the rows share a key; a crowded day can be split again."""
    rng = random.Random(5)
    data = [
        ("hot" if i % 3 else f"k{i % 20}", rng.randrange(30), i // 450, i, rng.randrange(-9, 9))
        for i in range(900)
    ]
    df = spark.createDataFrame(data, "k string, day int, half int, id long, v long").repartition(4)
    got = ranking.running_total(df, ["k"], buckets, ["day", "id"], "v", "t")
    want, sums = [], {}
    for k, day, half, i, v in sorted(data, key=lambda r: (r[0], r[1], r[3])):
        sums[k] = sums.get(k, 0) + v
        want.append((k, day, half, i, v, sums[k]))
    assert rows(got) == sorted(want, key=repr)
    windows = [line for line in plan_of(got).splitlines() if "Window [sum(v" in line]
    assert windows and all("windowspecdefinition(k#" in line and "day" in line.split("id#")[0] for line in windows)


def test_quantiles_by_brute_force(spark):
    """One group with most rows, ties, one value alone, unknown values; brackets cut again and again."""
    rng = random.Random(11)
    data = [("hot", rng.gauss(0, 1e3)) for _ in range(3000)] + [("hot", 7.0)] * 500
    data += [("ties", rng.choice([1.0, 1.0, 2.0, 5e300])) for _ in range(99)]
    data += [("one", 4.5), ("two", 1.0), ("two", 2.0), ("none", None), (None, 3.0), (None, None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    shares = {"lowest": 0.0, "tenth": 0.1, "median": 0.5, "most": 0.995, "highest": 1.0}
    want = {}
    for g in {g for g, v in data if v is not None}:
        values = sorted(v for h, v in data if h == g and v is not None)
        for name, q in shares.items():
            at = q * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + (at > int(at)), len(values) - 1)]
            part = at - int(at)
            want[g, name] = (low + high) / 2 if part == 0.5 else low + (high - low) * part
    for more in ({}, {"few": 20, "parts": 50}):
        got = ranking.exact_quantiles(df, ["g"], "v", shares, **more).collect()
        assert {(r["g"], n): r[n] for r in got for n in shares} == pytest.approx(want, rel=1e-12)
    whole = ranking.exact_quantiles(df.filter("g = 'hot'"), [], "v", {"median": 0.5}).collect()
    assert [r["median"] for r in whole] == [want["hot", "median"]]


def test_a_median_needs_no_sort_of_the_values(spark):
    """Three passes that combine on the map side, and no window."""
    df = spark.range(100_000).selectExpr("id % 3 AS g", "CAST(id * 7919 % 100003 AS DOUBLE) AS v")
    plan = plan_of(ranking.exact_median(df, ["g"], "v", "m"))
    assert "Window" not in plan and "SinglePartition" not in plan
    assert plan.count("Scan parquet") <= 2 and plan.count("partial_count(1)") == 1
    got = {r["g"]: r["m"] for r in ranking.exact_median(df, ["g"], "v", "m").collect()}
    values = {g: sorted(float(i * 7919 % 100003) for i in range(100_000) if i % 3 == g) for g in range(3)}
    assert got == {g: (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 for g, v in values.items()}
