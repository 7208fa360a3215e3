"""Queries on the game's rules: orders stand for squads, lines for picks and transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import game
from tidemark.operators.grain import dense_cells
from tidemark.operators.ranking import running_total
from tidemark.session import staged
from workload.inputs import MONTH, table
from workload.registry import query

# ---- Squads: an order is a squad, a line is a pick, its supplier's nation is the club. ----

QUOTA_SQL = "SELECT p_type AS position_id, LENGTH(p_type) - 4 AS squad_required FROM part GROUP BY 1"


@query(
    "squad_validity",
    f"""
    WITH quotas AS ({QUOTA_SQL}),
    picks AS (
      SELECT l_orderkey AS squad_id, p_type AS position_id, s_nationkey AS team_id,
             CAST(ROUND(p_retailprice * 10) AS BIGINT) AS price_tenths
      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
    totals AS (SELECT squad_id, COUNT(*) AS picks, CAST(SUM(price_tenths) AS BIGINT) AS cost_tenths FROM picks GROUP BY 1),
    clubs AS (SELECT squad_id, MAX(n) AS most_from_one_club FROM (
                SELECT squad_id, team_id, COUNT(*) AS n FROM picks GROUP BY 1, 2) GROUP BY 1),
    counts AS (SELECT squad_id, position_id, COUNT(*) AS n FROM picks GROUP BY 1, 2),
    quota AS (
      SELECT t.squad_id, COUNT(*) FILTER (WHERE COALESCE(c.n, 0) <> q.squad_required) = 0 AS quota_ok
      FROM totals t CROSS JOIN quotas q
      LEFT JOIN counts c ON c.squad_id = t.squad_id AND c.position_id = q.position_id GROUP BY 1)
    SELECT t.squad_id, picks, cost_tenths, most_from_one_club, picks = 4 AS size_ok,
           cost_tenths <= 38000 AS budget_ok, quota_ok, most_from_one_club <= 1 AS club_ok,
           picks = 4 AND cost_tenths <= 38000 AND quota_ok AND most_from_one_club <= 1 AS is_valid
    FROM totals t JOIN clubs c ON c.squad_id = t.squad_id JOIN quota q ON q.squad_id = t.squad_id""",
)
def squad_validity(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_type").alias("position_id"),
        F.round(F.col("p_retailprice") * 10).cast("bigint").alias("price_tenths"),
    )
    clubs = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("team_id")
    )
    picks = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("squad_id"), "l_partkey", "l_suppkey")
        .join(parts, "l_partkey")
        .join(clubs, "l_suppkey")
    )
    quotas = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_type").alias("position_id"))
        .agg(F.first(F.length("p_type") - 4).alias("squad_required"))
    )
    # Lines are counted from the files' footers; the joins keep at most one pick of each.
    lines = table(spark, sf_dir, "lineitem").count()
    return game.squad_validity(
        picks, quotas, "squad_id", squad_size=4, budget_tenths=38000, per_club=1, pick_count=lines
    )


# ---- Transfers: a returned line is a sale, any other a purchase, by customer and month. ----

SHIP_MONTH = MONTH.replace("o_orderdate", "l_shipdate")
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BOUGHT = "CAST(ROUND(l_extendedprice / 100) AS BIGINT)"
CURRENT = f"{BOUGHT} + CAST(ROUND(l_discount * 100) AS BIGINT) - 5"


@query(
    "transfer_economy",
    f"""
    WITH transfers AS (
      SELECT o_custkey AS manager_id, {SHIP_MONTH} AS gameweek_id, l_shipdate, l_orderkey, l_linenumber,
             l_partkey, l_suppkey,
             CASE WHEN l_returnflag <> 'R' THEN -bought
                  WHEN current > bought THEN bought + CAST(floor((current - bought) / 2) AS BIGINT)
                  ELSE current END AS amount_tenths
      FROM (SELECT *, {BOUGHT} AS bought, {CURRENT} AS current FROM lineitem JOIN orders ON o_orderkey = l_orderkey)),
    banked AS (
      SELECT *, 1000 + CAST(SUM(amount_tenths) OVER (
               PARTITION BY manager_id ORDER BY {", ".join(LINE_ORDER)}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS bank_tenths
      FROM transfers)
    SELECT manager_id, gameweek_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, amount_tenths, bank_tenths,
           bank_tenths >= 0 AS is_valid FROM banked""",
)
def transfer_economy(spark, sf_dir):
    managers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("manager_id")
    )
    bought, current = F.expr(BOUGHT), F.expr(CURRENT)
    amount = F.when(F.col("l_returnflag") == "R", game.sell_price(bought, current)).otherwise(-bought)
    transfers = (
        table(spark, sf_dir, "lineitem")
        .select(
            *LINE_ORDER, F.expr(SHIP_MONTH).alias("gameweek_id"), amount.alias("amount_tenths")
        )
        .join(managers, "l_orderkey")
    )
    return game.bank_balance(transfers, "manager_id", ["gameweek_id"], LINE_ORDER).drop("l_shipdate")


@query(
    "transfer_hits",
    f"""
    WITH RECURSIVE months AS (SELECT DISTINCT {MONTH} AS gw FROM orders),
    bounds AS (SELECT MIN(gw) AS lo, MAX(gw) AS hi FROM months),
    made AS (SELECT o_custkey AS manager_id, {MONTH} AS gw, COUNT(*) AS n FROM orders GROUP BY 1, 2),
    weekly AS (
      SELECT m.manager_id, g.gw, COALESCE(d.n, 0) AS transfers
      FROM (SELECT DISTINCT o_custkey AS manager_id FROM orders) m CROSS JOIN months g
      LEFT JOIN made d ON d.manager_id = m.manager_id AND d.gw = g.gw),
    played AS (
      SELECT manager_id, gw, transfers, CAST(1 AS BIGINT) AS free
      FROM weekly WHERE gw = (SELECT lo FROM bounds)
      UNION ALL
      SELECT w.manager_id, w.gw, w.transfers,
             LEAST(p.free - LEAST(p.free, p.transfers) + 1, 2)
      FROM played p JOIN weekly w ON w.manager_id = p.manager_id AND w.gw = p.gw + 1)
    SELECT manager_id, gw AS gameweek_id, transfers, free AS free_transfers,
           -4 * (transfers - LEAST(free, transfers)) AS hit_points FROM played""",
)
def transfer_hits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("manager_id"), F.expr(MONTH).alias("gameweek_id")
    )
    made = orders.groupBy("manager_id", "gameweek_id").agg(F.count(F.lit(1)).alias("transfers"))
    calendar = orders.select("gameweek_id").distinct()
    managers = orders.select("manager_id").distinct()
    weekly = dense_cells(managers, made, calendar, "manager_id", "gameweek_id", ["transfers"])
    return game.transfer_hits(weekly, "manager_id", "gameweek_id")


# ---- Lineups: every fifteen lines of a customer are the squad of a gameweek. The last squad is
# filled up with picks that did not play. Returned lines count as the gameweek's transfers. ----

# Roles by slot, the bench (GK, then three outfield) last; one formation per market segment.
FORMATIONS = {
    "AUTOMOBILE": "GK DEF DEF DEF DEF MID MID MID MID FWD FWD GK DEF MID FWD",
    "BUILDING": "GK DEF DEF DEF MID MID MID MID FWD FWD FWD GK DEF DEF MID",
    "FURNITURE": "GK DEF DEF DEF MID MID MID MID MID FWD FWD GK FWD DEF DEF",
    "HOUSEHOLD": "GK DEF DEF DEF DEF DEF MID MID MID FWD FWD GK MID FWD MID",
    "MACHINERY": "GK DEF DEF DEF DEF DEF MID MID MID MID FWD GK MID FWD FWD",
}
OTHER_FORMATION = "GK DEF DEF DEF DEF MID MID MID FWD FWD FWD GK DEF MID MID"
ROLES_OF = "CASE c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in FORMATIONS.items()
) + f" ELSE '{OTHER_FORMATION}' END"
MINUTES = "CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END"
POINTS = "CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_linenumber END"
# Orders whose lines one task numbers.
LINES_SPAN = 1 << 16
PICK_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

PICKS_SQL = f"""
    lines AS (
      SELECT c_custkey AS manager_id, {ROLES_OF} AS roles, {MINUTES} AS minutes, CAST({POINTS} AS BIGINT) AS points,
             CAST(l_returnflag = 'R' AS BIGINT) AS moved,
             ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY {PICK_ORDER}) - 1 AS place
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey),
    missing AS (
      SELECT manager_id, roles, 0 AS minutes, CAST(0 AS BIGINT) AS points, CAST(0 AS BIGINT) AS moved,
             unnest(range(n, (n + 14) // 15 * 15)) AS place
      FROM (SELECT manager_id, roles, COUNT(*) AS n FROM lines GROUP BY 1, 2)),
    picks AS (
      SELECT manager_id, place // 15 + 1 AS gw, place % 15 + 1 AS slot,
             split_part(roles, ' ', CAST(place % 15 + 1 AS INTEGER)) AS role, minutes, points, moved
      FROM (SELECT * FROM lines UNION ALL SELECT * FROM missing))"""


def _eligible(out_role: str, in_role: str) -> str:
    """SQL: the formation after a swap keeps every role within its bounds."""
    tests = []
    for role, (lo, hi) in game.FORMATION.items():
        after = f"{role}_n - CAST({out_role} = '{role}' AS INTEGER) + CAST({in_role} = '{role}' AS INTEGER)"
        tests.append(f"{after} BETWEEN {lo} AND {hi}")
    return " AND ".join(tests)


_COUNTS = ", ".join(
    f"CAST(COUNT(*) FILTER (WHERE slot <= 11 AND role = '{r}') AS INTEGER) AS {r}_n" for r in game.FORMATION
)
_COUNT_NAMES = ", ".join(f"{r}_n" for r in game.FORMATION)
_AFTER = ", ".join(
    f"CASE WHEN b.slot IS NULL THEN {r}_n ELSE {r}_n - CAST(a.role = '{r}' AS INTEGER)"
    f" + CAST(b.role = '{r}' AS INTEGER) END AS {r}_n"
    for r in game.FORMATION
)


@query(
    "manager_score",
    f"""
    WITH RECURSIVE {PICKS_SQL},
    absent AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY manager_id, gw ORDER BY slot) AS turn
               FROM picks WHERE slot <= 11 AND minutes = 0),
    bench AS (SELECT * FROM picks WHERE slot > 11 AND minutes > 0),
    formation AS (SELECT manager_id, gw, {_COUNTS} FROM picks GROUP BY 1, 2),
    state AS (
      SELECT manager_id, gw, CAST(0 AS BIGINT) AS turn, {_COUNT_NAMES}, CAST([] AS BIGINT[]) AS used,
             CAST(0 AS BIGINT) AS gained
      FROM formation
      UNION ALL
      SELECT manager_id, gw, turn, {_COUNT_NAMES}, used, gained FROM (
        SELECT s.manager_id, s.gw, a.turn, {_AFTER},
               CASE WHEN b.slot IS NULL THEN s.used ELSE list_append(s.used, b.slot) END AS used,
               s.gained + COALESCE(b.points, 0) AS gained,
               ROW_NUMBER() OVER (PARTITION BY s.manager_id, s.gw ORDER BY b.slot NULLS LAST) AS choice
        FROM state s JOIN absent a ON a.manager_id = s.manager_id AND a.gw = s.gw AND a.turn = s.turn + 1
        LEFT JOIN bench b ON b.manager_id = s.manager_id AND b.gw = s.gw AND NOT list_contains(s.used, b.slot)
         AND {_eligible("a.role", "b.role")})
      WHERE choice = 1),
    final AS (SELECT manager_id, gw, arg_max(used, turn) AS used, arg_max(gained, turn) AS gained FROM state GROUP BY 1, 2),
    fielded AS (SELECT manager_id, gw, CAST(COALESCE(SUM(points) FILTER (WHERE minutes > 0), 0) AS BIGINT) AS points,
                       COUNT(*) FILTER (WHERE minutes = 0) AS absent_starters,
                       CAST(COALESCE(SUM(points) FILTER (WHERE slot = 2 AND minutes > 0), 0) AS BIGINT) AS captain,
                       COUNT(*) FILTER (WHERE slot = 2 AND minutes > 0) AS captain_played,
                       CAST(COALESCE(SUM(points) FILTER (WHERE slot = 3 AND minutes > 0), 0) AS BIGINT) AS vice
                FROM picks WHERE slot <= 11 GROUP BY 1, 2),
    moves AS (SELECT manager_id, gw, CAST(SUM(moved) AS BIGINT) AS n FROM picks GROUP BY 1, 2),
    free AS (
      SELECT manager_id, gw, n, CAST(1 AS BIGINT) AS free FROM moves WHERE gw = 1
      UNION ALL
      SELECT m.manager_id, m.gw, m.n, LEAST(GREATEST(f.free - f.n, 0) + 1, 2)
      FROM free f JOIN moves m ON m.manager_id = f.manager_id AND m.gw = f.gw + 1)
    SELECT f.manager_id, f.gw AS gameweek_id, points + gained AS lineup_points,
           CASE WHEN captain_played > 0 THEN captain ELSE vice END AS captain_points,
           CAST(len(used) AS BIGINT) AS substitutions, absent_starters,
           points + gained + CASE WHEN captain_played > 0 THEN captain ELSE vice END AS score,
           -4 * GREATEST(h.n - h.free, 0) AS hit_points,
           points + gained + CASE WHEN captain_played > 0 THEN captain ELSE vice END - 4 * GREATEST(h.n - h.free, 0) AS net_score
    FROM fielded f JOIN final USING (manager_id, gw) JOIN free h USING (manager_id, gw)""",
)
def manager_score(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("manager_id"), F.expr(ROLES_OF).alias("roles")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("manager_id")
    )
    size = game.SQUAD_SIZE
    lines = (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            f"{MINUTES} AS minutes", f"{POINTS} AS points", "if(l_returnflag = 'R', 1L, 0L) AS moved",
        )
        .join(orders, "l_orderkey")
        .withColumns({"span": F.expr(f"l_orderkey DIV {LINES_SPAN}"), "one": F.lit(1)})
    )
    # Numbered in two levels: inside spans of orders, and by one row per span before.
    lines = running_total(staged(lines, "lines"), ["manager_id"], ["span"], PICK_ORDER.split(", "), "one", "place")
    lines = lines.selectExpr("manager_id", "minutes", "points", "moved", "place - 1 AS place")
    gaps = f"filter(sequence(n, n + {size}), p -> p < (n + {size - 1}) DIV {size} * {size})"
    missing = (
        orders.join(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey")
        .groupBy("manager_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("manager_id", "0L AS minutes", "0 AS points", "0L AS moved", f"explode({gaps}) AS place")
    )
    picks = (
        lines.unionByName(missing)
        .join(customers, "manager_id")
        .selectExpr(
            "manager_id",
            f"CAST(place DIV {size} + 1 AS BIGINT) AS gameweek_id",
            f"CAST(place % {size} + 1 AS INT) AS slot",
            "roles",
            "minutes",
            "points",
            "moved",
        )
        .selectExpr("*", "split_part(roles, ' ', slot) AS role", "slot = 2 AS is_captain", "slot = 3 AS is_vice")
    )
    weeks = ["manager_id", "gameweek_id"]
    moves = picks.groupBy(*weeks).agg(F.sum("moved").alias("transfers"))
    hits = game.transfer_hits(moves, *weeks, banked_most=2)
    return game.net_scores(game.manager_scores(picks, weeks), hits, weeks)


SCORES_SQL = f"SELECT o_custkey AS manager_id, {MONTH} AS gameweek_id, CAST(floor(o_totalprice / 1000) AS BIGINT) AS points FROM orders"


@query(
    "league_table",
    f"""
    WITH scores AS ({SCORES_SQL}),
    phases AS (
      SELECT CAST((gameweek_id - 1) // 12 + 1 AS BIGINT) AS phase_id, MIN(gameweek_id) AS lo, MAX(gameweek_id) AS hi
      FROM scores GROUP BY 1
      UNION ALL SELECT 0, MIN(gameweek_id), MAX(gameweek_id) FROM scores),
    totals AS (
      SELECT phase_id, manager_id, CAST(SUM(points) AS BIGINT) AS points
      FROM scores JOIN phases ON gameweek_id BETWEEN lo AND hi GROUP BY 1, 2)
    SELECT *, RANK() OVER (PARTITION BY phase_id ORDER BY points DESC NULLS LAST) AS league_rank FROM totals""",
)
def league_table(spark, sf_dir):
    scores = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("manager_id"),
        F.expr(MONTH).alias("gameweek_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("points"),
    )
    first, last = F.min("gameweek_id"), F.max("gameweek_id")
    span = [first.alias("first_gameweek_id"), last.alias("last_gameweek_id")]
    seasons = scores.groupBy(F.expr("(gameweek_id - 1) DIV 12 + 1").alias("phase_id")).agg(*span)
    overall = scores.agg(F.lit(0).cast("bigint").alias("phase_id"), *span)
    return game.league_table(scores, seasons.unionByName(overall), "manager_id", "gameweek_id")


# ---- Points recomputed from statistics, against a published number. ----

ROLE = "CASE l_returnflag WHEN 'A' THEN 'GK' WHEN 'N' THEN 'DEF' ELSE CASE l_linestatus WHEN 'F' THEN 'MID' ELSE 'FWD' END END"
STATS = {
    "minutes": "CAST(l_quantity AS BIGINT) * 2 - 2",
    "goals_scored": "l_linenumber % 3",
    "assists": "l_linenumber % 2",
    "clean_sheets": "CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END",
    "saves": "CAST(ROUND(l_discount * 100) AS BIGINT)",
    "goals_conceded": "CAST(ROUND(l_tax * 100) AS BIGINT)",
    "yellow_cards": "CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END",
    "bonus": "CASE WHEN l_discount > 0.09 THEN 3 ELSE 0 END",
    "published_points": "CAST(ROUND(l_discount * 100) AS BIGINT)",
}
_STATS_LIST = ", ".join(f"{e} AS {n}" for n, e in STATS.items())


@query(
    "points_reconcile",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, role, published_points, computed_points FROM (
      SELECT *, CAST(
        CASE WHEN minutes >= 60 THEN 2 WHEN minutes > 0 THEN 1 ELSE 0 END
        + goals_scored * CASE role WHEN 'GK' THEN 6 WHEN 'DEF' THEN 6 WHEN 'MID' THEN 5 ELSE 4 END
        + assists * 3
        + clean_sheets * CASE role WHEN 'GK' THEN 4 WHEN 'DEF' THEN 4 WHEN 'MID' THEN 1 ELSE 0 END
        + CASE WHEN role = 'GK' THEN saves // 3 ELSE 0 END
        - CASE WHEN role IN ('GK', 'DEF') THEN goals_conceded // 2 ELSE 0 END
        - yellow_cards + bonus AS BIGINT) AS computed_points
      FROM (SELECT *, {ROLE} AS role, {_STATS_LIST} FROM lineitem))
    WHERE computed_points IS DISTINCT FROM published_points""",
)
def points_reconcile(spark, sf_dir):
    stats = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        f"{ROLE} AS role",
        *[f"{e} AS {n}" for n, e in STATS.items()],
    )
    return game.points_differences(stats).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "role", "published_points", "computed_points"
    )
