"""Rules of the squad game as table operators: squads, money, transfers, scores, leagues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of
from tidemark.operators.ranking import running_total, with_rank
from tidemark.session import staged

# ---- Fixed values of the game. ----
STARTING_BUDGET_TENTHS = 1000
SQUAD_SIZE = 15
QUOTAS = {"GK": 2, "DEF": 5, "MID": 5, "FWD": 3}
PER_CLUB = 3
LINEUP_SIZE = 11
FORMATION = {"GK": (1, 1), "DEF": (3, 5), "MID": (2, 5), "FWD": (1, 3)}
FREE_PER_GAMEWEEK = 1
FREE_BANKED_MOST = 2
HIT_POINTS = 4
CAPTAIN_FACTOR = 2

# Points per action in the order GK, DEF, MID, FWD.
ROLES = ("GK", "DEF", "MID", "FWD")
ACTION_POINTS = {
    "goals_scored": (6, 6, 5, 4),
    "assists": (3, 3, 3, 3),
    "clean_sheets": (4, 4, 1, 0),
    "penalties_saved": (5, 0, 0, 0),
    "penalties_missed": (-2, -2, -2, -2),
    "yellow_cards": (-1, -1, -1, -1),
    "red_cards": (-3, -3, -3, -3),
    "own_goals": (-2, -2, -2, -2),
    "bonus": (1, 1, 1, 1),
}
# Points per full group of events: three saves, two goals conceded.
GROUPED_POINTS = {"saves": (3, (1, 0, 0, 0)), "goals_conceded": (2, (-1, -1, 0, 0))}
FULL_MATCH_MINUTES = 60

# Picks that one task of `squad_validity` counts.
PICKS_OF_A_TASK = 1 << 19


def limits(settings: DataFrame) -> dict[str, dict[str, int]]:
    """The game's limits from its one settings row, as arguments of the operators they bound.

    A limit the row does not state keeps its fixed value.
    """
    row = settings.select("squad_size", "budget_tenths", "max_players_per_club", "max_extra_free_transfers").first()
    known = row.asDict() if row is not None else {}

    def of(name: str, usual: int) -> int:
        value = known.get(name)
        return usual if value is None else int(value)

    size, budget = of("squad_size", SQUAD_SIZE), of("budget_tenths", STARTING_BUDGET_TENTHS)
    extra = of("max_extra_free_transfers", FREE_BANKED_MOST - FREE_PER_GAMEWEEK)
    return {
        "squad_validity": {
            "squad_size": size,
            "budget_tenths": budget,
            "per_club": of("max_players_per_club", PER_CLUB),
        },
        "bank_balance": {"budget_tenths": budget},
        "transfer_hits": {"banked_most": FREE_PER_GAMEWEEK + extra},
        "manager_scores": {"squad_size": size},
    }


def squad_validity(
    picks: DataFrame,
    positions: DataFrame,
    squad: str,
    squad_size: int = SQUAD_SIZE,
    budget_tenths: int = STARTING_BUDGET_TENTHS,
    per_club: int = PER_CLUB,
    pick_count: int | None = None,
) -> DataFrame:
    """Each squad against the four rules at once: budget, size, quota per position, club limit.

    `picks` has the squad key, `position_id`, `team_id`, `price_tenths`; `positions` states
    `squad_required`. Picks are counted per (squad, position, club) once, and the rules are folds
    of that.

    Squads are small, so counting before a shuffle would hold nearly every pick of a task and
    reduce nothing. Picks go to the cells they count for, and cells to their squads, in as many
    tasks as the picks ask for: what a task holds does not grow with the table. A squad that has
    a large share of all picks is spread over its cells, and arrives as these. The quotas, one row
    per position, are sent to every task: a join on positions would gather all squads in a few.
    `pick_count` is the number of picks, or a bound, where one is known; else they are counted.
    """
    known = picks.count() if pick_count is None else pick_count
    tasks = max(-(-known // PICKS_OF_A_TASK), picks.sparkSession.sparkContext.defaultParallelism)
    cell = [squad, "position_id", "team_id"]
    cells = (
        picks.repartition(tasks, *cell)
        .groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("price_tenths").alias("cost"))
        .repartition(tasks, squad)
    )
    # Each cell counts for its club and for its position: one aggregate over both.
    sides = F.explode(
        F.array(
            F.struct(F.lit(True).alias("is_club"), F.col("team_id").cast("string").alias("part")),
            F.struct(F.lit(False).alias("is_club"), F.col("position_id").cast("string").alias("part")),
        )
    ).alias("side")
    counted = (
        cells.select(squad, "n", "cost", sides)
        .groupBy(squad, "side.is_club", "side.part")
        .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"))
    )
    rules = positions.select(
        F.lit(False).alias("is_club"), F.col("position_id").cast("string").alias("part"), "squad_required"
    )
    of_position = ~F.col("is_club")
    # A position without a pick is not there: all quotas hold when the met ones add up.
    met = of_position & (F.col("n") == F.col("squad_required"))
    totals = (
        counted.join(F.broadcast(rules), ["is_club", "part"], "left")
        .groupBy(squad)
        .agg(
            F.sum(F.when(of_position, F.col("n"))).alias("picks"),
            F.sum(F.when(of_position, F.col("cost"))).alias("cost_tenths"),
            F.sum(F.when(met, F.col("n")).otherwise(0)).alias("picks_in_met_quotas"),
            F.max(F.when(F.col("is_club"), F.col("n"))).alias("most_from_one_club"),
        )
    )
    quota_total = positions.agg(F.sum("squad_required")).scalar()
    c = F.col
    return (
        totals.withColumn("quota_total", quota_total)
        .withColumns(
            {
                "size_ok": c("picks") == squad_size,
                "budget_ok": c("cost_tenths") <= budget_tenths,
                "quota_ok": (c("picks_in_met_quotas") == c("quota_total"))
                & (c("picks") == c("quota_total")),
                "club_ok": c("most_from_one_club") <= per_club,
            }
        )
        .withColumn("is_valid", c("size_ok") & c("budget_ok") & c("quota_ok") & c("club_ok"))
        .select(
            squad,
            "picks",
            "cost_tenths",
            "most_from_one_club",
            "size_ok",
            "budget_ok",
            "quota_ok",
            "club_ok",
            "is_valid",
        )
    )


def sell_price(bought_tenths: Column, current_tenths: Column) -> Column:
    """Half of a rise, rounded down to a tenth; a fall in full. Exact integer tenths."""
    rise = current_tenths - bought_tenths
    kept = F.floor(rise / F.lit(2)).cast("long")
    return F.when(rise > 0, bought_tenths + kept).otherwise(current_tenths)


def bank_balance(
    transfers: DataFrame,
    manager: str,
    buckets: list[str],
    order: list[str],
    budget_tenths: int = STARTING_BUDGET_TENTHS,
) -> DataFrame:
    """Each transfer with the bank after it and whether the bank stays at or above zero.

    `transfers` has `amount_tenths`, sales positive and purchases negative; `buckets` are coarse
    times that split a manager with very many transfers.
    """
    spent = running_total(transfers, [manager], buckets, order, "amount_tenths", "flow_tenths")
    bank = F.lit(budget_tenths) + F.col("flow_tenths")
    return spent.withColumn("bank_tenths", bank).withColumn("is_valid", bank >= 0).drop("flow_tenths")


# Weeks (and spans of weeks) whose maps one task composes.
SPAN = 64
# Beyond any number of transfers: the limits of a map that has none.
_NO_LIMIT = 1 << 50


def _clamp(x: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(x, low), high)


def _then(first: Column, second: Column) -> Column:
    """Two maps x -> clamp(x + shift, low, high) as one, the first played first."""
    return F.struct(
        (first["shift"] + second["shift"]).alias("shift"),
        _clamp(first["low"] + second["shift"], second["low"], second["high"]).alias("low"),
        _clamp(first["high"] + second["shift"], second["low"], second["high"]).alias("high"),
    )


def _map(shift: Column, low: Column, high: Column) -> Column:
    return F.struct(*[c.cast("long").alias(n) for c, n in ((shift, "shift"), (low, "low"), (high, "high"))])


def _maps_before(maps: Column) -> Column:
    """For each map of an array the composition of those before it, and that of all at the end."""
    none = _map(F.lit(0), F.lit(-_NO_LIMIT), F.lit(_NO_LIMIT))
    return F.aggregate(maps, F.array(none), lambda done, m: F.concat(done, F.array(_then(F.element_at(done, -1), m))))


def transfer_hits(
    per_gameweek: DataFrame,
    manager: str,
    gameweek: str,
    banked_most: int = FREE_BANKED_MOST,
    span: int = SPAN,
) -> DataFrame:
    """Free transfers and point hits of every gameweek, in sequence.

    `per_gameweek` holds one row per manager and gameweek (a whole number) with `transfers`,
    gameweeks without one included (lay them on a dense grid first). What is carried over depends
    on every gameweek before: a gameweek maps carried transfers x to clamp(x + 1 - transfers, 1,
    most), and two such maps are one again, of three numbers. The maps of each manager's `span`
    gameweeks are composed, then those of `span` spans, until one span holds the calendar; on the
    way back every span learns what it begins with. So a task holds `span` rows of a manager, and
    however long the calendar is, a manager's gameweeks spread over many tasks.
    """
    low, high = per_gameweek.agg(F.min(gameweek), F.max(gameweek)).first()
    low, high = (0, 0) if low is None else (int(low), int(high))
    spans = per_gameweek.groupBy(manager, F.expr(f"({gameweek} - {low}L) div {span}L").alias("at")).agg(
        F.array_sort(F.collect_list(F.struct(gameweek, "transfers"))).alias("weeks")
    )
    week_map = lambda w: _map(F.lit(FREE_PER_GAMEWEEK) - w["transfers"], F.lit(FREE_PER_GAMEWEEK), F.lit(banked_most))
    begins = F.lit(FREE_PER_GAMEWEEK).cast("long")
    last = (high - low) // span
    if last == 0:
        spans = spans.withColumn("begins", begins)
    else:
        spans = staged(spans.withColumn("map", F.element_at(_maps_before(F.transform("weeks", week_map)), -1)), "spans")
        tiers = [spans.select(manager, "at", "map")]
        while last > 0:
            above = tiers[-1].groupBy(manager, F.expr(f"at div {span}L").alias("at")).agg(
                F.array_sort(F.collect_list(F.struct("at", "map"))).alias("inside")
            )
            above = above.withColumn("before", _maps_before(F.transform("inside", lambda x: x["map"])))
            above = above.withColumn("map", F.element_at("before", -1))
            tiers.append(staged(above, "spans-above"))
            last //= span
        told = tiers[-1].select(manager, "at", begins.alias("begins"))
        for tier in tiers[:0:-1]:
            below = F.arrays_zip(F.col("inside").alias("child"), F.slice("before", 1, F.size("inside")).alias("map"))
            each = tier.join(told, [manager, "at"]).select(manager, "begins", F.explode(below).alias("x"))
            told = each.select(
                manager,
                F.col("x.child.at").alias("at"),
                _clamp(F.col("begins") + F.col("x.map.shift"), F.col("x.map.low"), F.col("x.map.high")).alias("begins"),
            )
        spans = spans.join(told, [manager, "at"])
    started = F.transform(
        _maps_before(F.transform("weeks", week_map)), lambda m: _clamp(F.col("begins") + m["shift"], m["low"], m["high"])
    )
    each = F.explode(F.arrays_zip(F.col("weeks").alias("week"), F.slice(started, 1, F.size("weeks")).alias("free"))).alias("w")
    extra = F.greatest(F.col("transfers") - F.col("free_transfers"), F.lit(0))
    return (
        spans.select(manager, each)
        .select(
            manager,
            F.col(f"w.week.{gameweek}").alias(gameweek),
            F.col("w.week.transfers").alias("transfers"),
            F.col("w.free").alias("free_transfers"),
        )
        .withColumn("hit_points", extra * F.lit(-HIT_POINTS))
    )


def _formation_ok(counts: Column, formation: dict[str, tuple[int, int]]) -> Column:
    fits = [counts[role].between(lo, hi) for role, (lo, hi) in formation.items()]
    return reduce(lambda a, b: a & b, fits)


def _swap(counts: Column, out_role: Column, in_role: Column) -> Column:
    """The formation after one player leaves and one comes in."""

    def moved(role: str) -> Column:
        left = F.when(out_role == role, 1).otherwise(0)
        came = F.when(in_role == role, 1).otherwise(0)
        return (counts[role] - left + came).cast("int").alias(role)

    return F.struct(*[moved(role) for role in FORMATION])


def manager_scores(
    picks: DataFrame,
    keys: list[str],
    lineup_size: int = LINEUP_SIZE,
    formation: dict[str, tuple[int, int]] = FORMATION,
    squad_size: int = SQUAD_SIZE,
) -> DataFrame:
    """The gameweek score before transfer hits, after automatic substitutions.

    A squad of any other size than `squad_size` stops the query.

    `picks` holds `slot` (1 is the first starter, the bench follows in its order), `role`,
    `minutes`, `points`, `is_captain`, `is_vice`. Starters without minutes leave in slot order;
    each is replaced by the first bench player who played and keeps the formation legal. The
    captain counts twice, the vice-captain instead when the captain did not play.

    A squad is a fixed number of picks, so its array is small; everything runs as array
    expressions on the executors' JVM, with one shuffle by squad.
    """
    pick = F.struct("slot", "role", "minutes", "points", "is_captain", "is_vice")
    squads = picks.groupBy(*keys).agg(F.array_sort(F.collect_list(pick)).alias("squad"))
    told = F.concat(F.lit("a squad has "), F.size("squad").cast("string"), F.lit(f" picks, not {squad_size}"))
    squads = squads.withColumn("squad", F.when(F.size("squad") == squad_size, F.col("squad")).otherwise(F.raise_error(told)))

    def is_starter(p: Column) -> Column:
        return p["slot"] <= lineup_size

    def played(p: Column) -> Column:
        return p["minutes"] > 0

    starters = F.filter("squad", is_starter)
    bench = F.filter("squad", lambda p: ~is_starter(p) & played(p))
    absent = F.filter("starters", lambda p: ~played(p))

    def count(role: str) -> Column:
        return F.size(F.filter("starters", lambda p: p["role"] == role)).cast("int").alias(role)

    state = F.struct(
        F.struct(*[count(role) for role in FORMATION]).alias("counts"),
        F.col("bench").alias("bench"),
        F.filter("starters", played).alias("fielded"),
        F.lit(0).alias("subs"),
    )

    def replace(now: Column, out: Column) -> Column:
        able = F.filter(
            now["bench"],
            lambda b: _formation_ok(_swap(now["counts"], out["role"], b["role"]), formation),
        )
        comes = F.get(able, F.lit(0))
        swapped = F.struct(
            _swap(now["counts"], out["role"], comes["role"]).alias("counts"),
            F.filter(now["bench"], lambda b: b["slot"] != comes["slot"]).alias("bench"),
            F.concat(now["fielded"], F.array(comes)).alias("fielded"),
            (now["subs"] + 1).alias("subs"),
        )
        return F.when(F.size(able) > 0, swapped).otherwise(now)

    final = F.aggregate("absent", state, replace)

    def total(players: Column) -> Column:
        return F.aggregate(
            players, F.lit(0).cast("long"), lambda s, p: s + p["points"].cast("long")
        )

    def armband(flag: str) -> Column:
        return F.filter("squad", lambda p: p[flag] & played(p) & is_starter(p))

    leader = F.when(F.size("captain") > 0, F.col("captain")).otherwise(F.col("vice"))
    return (
        squads.withColumns({"starters": starters, "bench": bench})
        .withColumns(
            {"absent": absent, "captain": armband("is_captain"), "vice": armband("is_vice")}
        )
        .withColumn("final", final)
        .select(
            *keys,
            total(F.col("final.fielded")).alias("lineup_points"),
            (total(leader) * (CAPTAIN_FACTOR - 1)).alias("captain_points"),
            F.col("final.subs").cast("long").alias("substitutions"),
            F.size("absent").cast("long").alias("absent_starters"),
        )
        .withColumn("score", F.col("lineup_points") + F.col("captain_points"))
    )


def net_scores(scores: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Scores with the gameweek's transfer hits (negative points) taken off."""
    return (
        scores.join(hits.select(*keys, "hit_points"), keys, "left")
        .na.fill(0, subset=["hit_points"])
        .withColumn("net_score", F.col("score") + F.col("hit_points"))
    )


def league_table(scores: DataFrame, phases: DataFrame, manager: str, gameweek: str) -> DataFrame:
    """Managers ranked by the points of each phase, the season-long one included.

    Scores are summed per manager and gameweek, and those along the calendar. A phase's points are
    the difference of two running totals, at its last gameweek and before its first one, each found
    by an as-of join: a gameweek is read once, however many phases hold it. A manager without a
    gameweek in a phase is not in its table; points that are all unknown stay unknown.
    """
    weekly = scores.groupBy(manager, F.col(gameweek).cast("long").alias("week")).agg(
        F.sum("points").alias("points"), F.count("points").alias("known")
    )
    weekly = weekly.na.fill(0, subset=["points"]).withColumns({"weeks": F.lit(1), "span": F.expr(f"week div {SPAN}L")})
    sums = ["points", "known", "weeks"]
    weekly = staged(weekly, "league-weeks")
    inside = Window.partitionBy(manager, "span").orderBy("week")
    ends = weekly.groupBy(manager, "span").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(manager).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(manager, "span", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums])
    totals = weekly.withColumns({f"in_{c}": F.sum(c).over(inside) for c in sums}).join(ends, [manager, "span"])
    totals = totals.select(manager, "week", *[(F.col(f"in_{c}") + F.col(f"before_{c}")).alias(c) for c in sums])

    first, last = F.col("first_gameweek_id").cast("long"), F.col("last_gameweek_id").cast("long")
    edges = F.array(
        F.struct((first - 1).alias("at"), F.lit(-1).alias("sign")), F.struct(last.alias("at"), F.lit(1).alias("sign"))
    )
    marks = phases.select("phase_id", F.explode(edges).alias("e")).select(F.struct("phase_id", "e.*").alias("mark"))
    # Phases are a handful of settings: their marks go to every manager's row as one array.
    marks = marks.agg(F.collect_list("mark")).scalar()
    asked = weekly.select(manager).distinct().select(manager, F.explode(marks).alias("_mark")).select(manager, "_mark.*")
    found = as_of(asked, totals, "at", sums, by=[manager], right_at="week")
    points, known, weeks = (F.sum(F.col("sign") * F.coalesce(c, F.lit(0))).alias(c) for c in sums)
    table = found.groupBy("phase_id", manager).agg(points, known, weeks).filter("weeks > 0")
    table = table.select("phase_id", manager, F.when(F.col("known") > 0, F.col("points")).alias("points"))
    return with_rank(staged(table, "league"), ["phase_id"], "points", "league_rank")


def scoring_table(spark: SparkSession) -> DataFrame:
    """What every action is worth, one row per role."""
    worth = {**ACTION_POINTS, **{name: points for name, (_, points) in GROUPED_POINTS.items()}}
    rows = [(role, *(int(points[i]) for points in worth.values())) for i, role in enumerate(ROLES)]
    names = ", ".join(f"worth_{name} int" for name in worth)
    return spark.createDataFrame(rows, f"role string, {names}")


def with_points(stats: DataFrame, name: str = "computed_points") -> DataFrame:
    """A player's points in one gameweek from the raw match statistics; absent ones count zero.

    The four-row scoring table goes to every task; rows are scored where they are.
    """
    have = [n for n in [*ACTION_POINTS, *GROUPED_POINTS] if n in stats.columns]
    terms = ["CASE WHEN minutes >= {0} THEN 2 WHEN minutes > 0 THEN 1 ELSE 0 END".format(FULL_MATCH_MINUTES)]
    for n in have:
        amount = f"{n} DIV {GROUPED_POINTS[n][0]}" if n in GROUPED_POINTS else n
        terms.append(f"coalesce({amount}, 0) * worth_{n}")
    worth = scoring_table(stats.sparkSession).select("role", *[f"worth_{n}" for n in have])
    return (
        stats.join(F.broadcast(worth), "role", "left")
        .withColumn(name, F.expr(f"CAST({' + '.join(terms)} AS BIGINT)"))
        .drop(*[f"worth_{n}" for n in have])
    )


def points_differences(stats: DataFrame, published: str = "published_points") -> DataFrame:
    """Rows whose recomputed points are not the published ones; a row-wise pass, no shuffle."""
    return with_points(stats).filter(~F.col("computed_points").eqNullSafe(F.col(published)))
