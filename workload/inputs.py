"""The given tables in the raw shapes the library reads, as DataFrames and as SQL text.

Both sides share the column expressions of a raw table where the dialects agree; a pair states
the Spark and the SQL spelling where they do not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.conform import Field
from tidemark.operators.snapshot import LOAD_ID, latest_committed_load
from tidemark.plans.silver import MODELS


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its file listing and schema are looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- Loads: one per day of events; every third day of a month never committed. ----

def day_load_id() -> Column:
    days = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))
    return F.concat((days.cast("bigint") * 86400).cast("string"), F.lit(".5"))


DAY_LOAD_SQL = "CONCAT(CAST(date_diff('day', DATE '1970-01-01', day) * 86400 AS VARCHAR), '.5')"


def loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return events.withColumn(LOAD_ID, day_load_id())


LOADED_EVENTS_SQL = f"""
  SELECT *, {DAY_LOAD_SQL} AS load_id
  FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)"""


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return daily.select(
        day_load_id().alias("load_id"),
        F.lit("events").alias("schema_name"),
        F.when(F.dayofmonth("day") % 3 == 0, 1).otherwise(0).alias("status"),
        F.concat(F.col("day").cast("string"), F.lit("T23:59:59Z")).alias("inserted_at"),
        F.col("n").cast("string").alias("schema_version_hash"),
    )


LEDGER_SQL = f"""
  SELECT {DAY_LOAD_SQL} AS load_id, 'events' AS schema_name,
         CASE WHEN EXTRACT(day FROM day) % 3 = 0 THEN 1 ELSE 0 END AS status,
         CONCAT(CAST(day AS VARCHAR), 'T23:59:59Z') AS inserted_at,
         CAST(n AS VARCHAR) AS schema_version_hash
  FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1)"""

LATEST_LOAD_SQL = """
  SELECT load_id FROM ledger WHERE status = 0 ORDER BY CAST(load_id AS DOUBLE) DESC LIMIT 1"""


def latest_load(spark: SparkSession, sf_dir: str) -> str:
    return latest_committed_load(raw_ledger(spark, sf_dir))


# ---- Raw tables of the typed models. ----

MONTH = "CAST((EXTRACT(YEAR FROM o_orderdate) - 1995) * 12 + EXTRACT(MONTH FROM o_orderdate) AS BIGINT)"
DAY2 = "LPAD(CAST(p_size % 28 + 1 AS STRING), 2, '0')"


def _sold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty"))
    )
    return table(spark, sf_dir, "part").join(sold, "p_partkey", "left").na.fill(0, ["lines", "qty"])


SOLD_PARTS_SQL = """
  SELECT p.*, COALESCE(s.lines, 0) AS lines, COALESCE(s.qty, 0) AS qty
  FROM part p LEFT JOIN (
    SELECT l_partkey, COUNT(*) AS lines, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1
  ) s ON s.l_partkey = p.p_partkey"""


def _part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"))


PART_TYPES_SQL = "SELECT p_type, COUNT(*) AS parts FROM part GROUP BY p_type"


def _order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.expr(MONTH).alias("gw"),
            F.year("o_orderdate").alias("y"),
            F.month("o_orderdate").alias("m"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(status == "F").alias("f"),
            F.count_if(status == "O").alias("o"),
            F.count_if(status == "P").alias("p"),
        )
    )


ORDER_MONTHS_SQL = f"""
  SELECT {MONTH} AS gw, EXTRACT(YEAR FROM o_orderdate) AS y, EXTRACT(MONTH FROM o_orderdate) AS m,
         COUNT(*) AS n, CAST(COUNT_IF(o_orderstatus = 'F') AS BIGINT) AS f,
         CAST(COUNT_IF(o_orderstatus = 'O') AS BIGINT) AS o,
         CAST(COUNT_IF(o_orderstatus = 'P') AS BIGINT) AS p
  FROM orders GROUP BY 1, 2, 3"""


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An order has few lines, far apart in the files: counting them before the shuffle would hold
    # nearly every line of a task and reduce nothing. They go to their order's task first.
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    flags = (
        lines.repartition("o_orderkey")
        .groupBy("o_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("l_returnflag") == "A").alias("a"),
            F.count_if(F.col("l_returnflag") == "R").alias("r"),
        )
    )
    home = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").drop("o_totalprice")
    return orders.join(home, "o_custkey").join(flags, "o_orderkey", "left")


MATCHES_SQL = """
  SELECT o.*, c.c_nationkey, l.n, l.a, l.r
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN (
    SELECT l_orderkey, COUNT(*) AS n, CAST(COUNT_IF(l_returnflag = 'A') AS BIGINT) AS a,
           CAST(COUNT_IF(l_returnflag = 'R') AS BIGINT) AS r
    FROM lineitem GROUP BY 1
  ) l ON l.l_orderkey = o.o_orderkey"""


def _clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.count(F.lit(1)).alias("suppliers"))
    )
    return table(spark, sf_dir, "nation").join(suppliers, "n_nationkey", "left").na.fill(0, ["suppliers"])


CLUBS_SQL = """
  SELECT n.*, COALESCE(s.suppliers, 0) AS suppliers FROM nation n LEFT JOIN (
    SELECT s_nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY 1
  ) s ON s.s_nationkey = n.n_nationkey"""


def _price_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").agg(
        F.count(F.lit(1)).alias("parts"), F.max("p_retailprice").alias("top")
    )


PRICE_LIST_SQL = "SELECT COUNT(*) AS parts, MAX(p_retailprice) AS top FROM part"


def _event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type").distinct()


def _plain(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: table(spark, sf_dir, name)


@dataclass(frozen=True)
class Raw:
    """A raw table: its base relation, and expressions by raw column name."""

    base: Callable[[SparkSession, str], DataFrame]
    base_sql: str
    columns: dict[str, str | tuple[str, str]]
    # Expression for a field of a kind that `columns` does not name; {i} is its place.
    rules: dict[str, str] | None = None


_PLAYER_RULES = {
    "long": "CAST(p_size + {i} AS BIGINT)",
    "double": "CAST(p_size / 4.0 AS DOUBLE) + {i}",
    "text": "p_name",
    "flag": "p_size > {i} % 50",
    "date": f"CONCAT('1999-01-', {DAY2})",
    "time": f"CONCAT('1999-01-', {DAY2}, 'T10:30:00Z')",
    "number_text": "CAST(CAST((p_size + {i}) / 4.0 AS DOUBLE) AS STRING)",
}

_SETTINGS = {
    "squad_squadsize": "18",
    "squad_squadplay": "11",
    "squad_team_limit": "3",
    "squad_total_spend": "CAST(ROUND(top * 10) AS BIGINT) * 20",
    "transfers_cap": "20",
    "max_extra_free_transfers": "2",
    "transfers_sell_on_fee": "CAST(0.5 AS DOUBLE)",
    "element_sell_at_purchase_price": "false",
    "league_points_h2h_win": "3",
    "league_points_h2h_draw": "1",
    "league_points_h2h_lose": "0",
    "league_join_private_max": "30",
    "league_join_public_max": "5",
    "stats_form_days": "30",
    "ui_currency_multiplier": "10",
    "timezone": "'UTC'",
}


def _struct(entries: dict[str, str]) -> tuple[str, str]:
    spark = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in entries.items()) + ")"
    duck = "{" + ", ".join(f"'{k}': {v}" for k, v in entries.items()) + "}"
    return spark, duck


RAW: dict[str, Raw] = {
    "stg_fpl__teams": Raw(
        _clubs,
        CLUBS_SQL,
        {
            "id": "n_nationkey",
            "code": "n_nationkey + 100",
            "name": "n_name",
            "short_name": "CONCAT('N', CAST(n_nationkey AS STRING))",
            "position": "n_nationkey + 1",
            "played": "suppliers",
            "win": "n_regionkey",
            "draw": "n_nationkey % 3",
            "loss": "n_nationkey % 4",
            "points": "3 * n_regionkey + n_nationkey % 3",
            "strength_overall_home": "n_regionkey + 1",
            "strength_overall_away": "n_nationkey % 4 + 1",
            "strength_attack_home": "n_nationkey % 3 + 1",
            "strength_attack_away": "n_nationkey % 2 + 1",
            "strength_defence_home": "n_nationkey % 5",
            "strength_defence_away": "n_nationkey % 6",
            "unavailable": "suppliers = 0",
            "pulse_id": "n_nationkey + 7",
        },
    ),
    "stg_fpl__positions": Raw(
        _part_types,
        PART_TYPES_SQL,
        {
            "id": "ASCII(SUBSTR(p_type, 2, 1))",
            "singular_name": "p_type",
            "singular_name_short": "SUBSTR(p_type, 1, 3)",
            "plural_name": "CONCAT(p_type, 'S')",
            "squad_select": "LENGTH(p_type) - 3",
            "squad_min_play": "LENGTH(p_type) - 5",
            "squad_max_play": "LENGTH(p_type) - 3",
            "element_count": "parts",
        },
    ),
    "stg_fpl__gameweeks": Raw(
        _order_months,
        ORDER_MONTHS_SQL,
        {
            "id": "gw",
            "name": "CONCAT('Gameweek ', CAST(gw AS STRING))",
            "deadline_time": "CONCAT(CAST(y AS STRING), '-', LPAD(CAST(m AS STRING), 2, '0'), '-01T11:00:00Z')",
            "deadline_time_epoch": "gw * 1000",
            "finished": "f >= o",
            "data_checked": "p <= f",
            "is_previous": "p > f AND p > o",
            "is_current": "o > f AND o > p",
            "is_next": "o = p",
            "can_enter": "o > 0",
            "can_manage": "p > 0",
            "released": "n > 0",
            "average_entry_score": "n",
            "ranked_count": "f",
            "transfers_made": "o + p",
            "chip_plays": (
                "array(named_struct('chip_name', 'P', 'num_played', p))",
                "[{'chip_name': 'P', 'num_played': p}]",
            ),
        },
    ),
    "stg_fpl__fixtures": Raw(
        _matches,
        MATCHES_SQL,
        {
            "id": "o_orderkey",
            "code": "o_orderkey + 500000",
            "event": f"CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE {MONTH} END",
            "kickoff_time": "CONCAT(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T15:00:00Z')",
            "provisional_start_time": "o_orderpriority = '1-URGENT'",
            "team_h": "c_nationkey",
            "team_a": "(c_nationkey + 1 + EXTRACT(DAY FROM o_orderdate) % 24) % 25",
            "team_h_score": "CASE WHEN o_orderstatus <> 'O' THEN a END",
            "team_a_score": "CASE WHEN o_orderstatus <> 'O' THEN r END",
            "team_h_difficulty": "CAST(SUBSTR(o_orderpriority, 1, 1) AS BIGINT)",
            "team_a_difficulty": "1 + o_custkey % 5",
            "started": "o_orderstatus <> 'O'",
            "finished": "o_orderstatus = 'F'",
            "finished_provisional": "o_orderstatus = 'F'",
            "minutes": "CASE WHEN o_orderstatus = 'F' THEN 90 WHEN o_orderstatus = 'P' THEN 45 ELSE 0 END",
            "stats": _struct({"lines": "n", "note": "CAST(NULL AS STRING)"}),
            "pulse_id": "o_custkey",
        },
    ),
    "stg_fpl__players": Raw(
        _sold_parts,
        SOLD_PARTS_SQL,
        {
            "id": "p_partkey",
            "code": "p_partkey + 1000000",
            "first_name": "SPLIT_PART(p_name, ' ', 1)",
            "second_name": "SPLIT_PART(p_name, ' ', 2)",
            "web_name": "p_name",
            "opta_code": "CASE WHEN p_size > 25 THEN p_brand END",
            "team": "CAST(SUBSTR(p_brand, 7) AS INT) - 1",
            "element_type": "ASCII(SUBSTR(p_type, 2, 1))",
            "now_cost": "CAST(ROUND(p_retailprice * 10) AS BIGINT)",
            "cost_change_start": "p_size - 25",
            "cost_change_event": "p_size % 3 - 1",
            "status": "CASE WHEN p_size <= 35 THEN 'a' WHEN p_size <= 40 THEN 'd' WHEN p_size <= 45 THEN 'i' WHEN p_size <= 48 THEN 's' ELSE 'u' END",
            "can_select": "p_size <= 48",
            "can_transact": "p_size > 1",
            "removed": "p_size = 47",
            "total_points": "lines",
            "minutes": "CAST(qty AS BIGINT)",
            "form": "CASE WHEN p_size = 7 THEN ' ' ELSE CAST(CAST(p_size / 10.0 AS DOUBLE) AS STRING) END",
            "selected_by_percent": "CAST(CAST(lines % 100 / 10.0 AS DOUBLE) AS STRING)",
            "ep_this": "CASE WHEN p_size = 9 THEN '' ELSE CAST(CAST(p_size / 4.0 AS DOUBLE) AS STRING) END",
            "penalties_order": "p_size % 5 + 1",
        },
        _PLAYER_RULES,
    ),
    "stg_fpl__chips": Raw(
        _plain("customer"),
        "SELECT * FROM customer",
        {
            "id": "c_custkey",
            "name": "c_mktsegment",
            "chip_type": "'team'",
            "number": "c_nationkey",
            "start_event": "c_nationkey + 1",
            "stop_event": "c_nationkey + 10",
            "overrides": _struct({"bonus": "CAST(NULL AS STRING)", "nation": "c_nationkey"}),
        },
    ),
    "stg_fpl__phases": Raw(
        _plain("supplier"),
        "SELECT * FROM supplier",
        {
            "id": "s_suppkey",
            "name": "s_name",
            "start_event": "s_nationkey + 1",
            "stop_event": "s_nationkey + 2 + s_suppkey % 7",
        },
    ),
    "stg_fpl__stat_types": Raw(
        _event_types,
        "SELECT DISTINCT event_type FROM events",
        {"name": "event_type", "label": "UPPER(event_type)"},
    ),
    "stg_fpl__game_settings": Raw(
        _price_list,
        PRICE_LIST_SQL,
        {
            "total_players": "parts",
            "game_settings": _struct(_SETTINGS),
            "game_config": (
                "named_struct('scoring', named_struct('parts', parts))",
                "{'scoring': {'parts': parts}}",
            ),
        },
    ),
}


def _raw_expressions(model: str) -> dict[str, tuple[str, str]]:
    raw = RAW[model]
    found = {}
    for i, f in enumerate(MODELS[model].spec):
        name = f.source.partition(".")[0]
        if name in found:
            continue
        expr = raw.columns.get(name) or raw.rules[f.kind].format(i=i)
        found[name] = expr if isinstance(expr, tuple) else (expr, expr)
    return found


def raw_frame(spark: SparkSession, sf_dir: str, model: str, *loads: str) -> DataFrame:
    """The raw table, appended whole once per load."""
    columns = [f"{e} AS `{n}`" for n, (e, _) in _raw_expressions(model).items()]
    rows = RAW[model].base(spark, sf_dir).selectExpr(*columns)
    if len(loads) == 1:
        return rows.withColumn(LOAD_ID, F.lit(loads[0]))
    return rows.withColumn(LOAD_ID, F.explode(F.array(*[F.lit(x) for x in loads])))


def typed(spark: SparkSession, sf_dir: str, *models: str) -> list[DataFrame]:
    """Typed tables of the newest committed load, as the marts read them."""
    load_id = latest_load(spark, sf_dir)
    names = [f"stg_fpl__{m}" for m in models]
    return [MODELS[n].build(raw_frame(spark, sf_dir, n, load_id), load_id) for n in names]


_SQL_CASTS = {
    "long": "CAST({c} AS BIGINT)",
    "double": "CAST({c} AS DOUBLE)",
    "text": "{c}",
    "flag": "{c}",
    "date": "CAST({c} AS DATE)",
    "time": "CAST({c} AS TIMESTAMP)",
    "number_text": "CAST(NULLIF(TRIM({c}), '') AS DOUBLE)",
    "json": "CAST(to_json({c}) AS VARCHAR)",
}

_SQL_DERIVED = {
    "stg_fpl__gameweeks": ["is_finished AND is_data_checked AS is_settled"],
    "stg_fpl__players": [
        "first_name || ' ' || second_name AS full_name",
        "now_cost_tenths / 10.0 AS now_cost_gbp_m",
        "status = 'a' AS is_available",
    ],
    "stg_fpl__phases": ["last_gameweek_id - first_gameweek_id + 1 AS gameweek_count"],
    "stg_fpl__game_settings": ["budget_tenths / 10.0 AS budget_gbp_m"],
}


def _sql_field(f: Field) -> str:
    parent, _, path = f.source.partition(".")
    column = f'"{parent}".{path}' if path else f'"{parent}"'
    return f"{_SQL_CASTS[f.kind].format(c=column)} AS {f.name}"


def typed_sql(model: str) -> str:
    """The typed table in SQL; it needs a `ledger` relation in scope."""
    raw = ", ".join(f'{e} AS "{n}"' for n, (_, e) in _raw_expressions(model).items())
    casts = ", ".join(_sql_field(f) for f in MODELS[model].spec)
    derived = "".join(f", {d}" for d in _SQL_DERIVED.get(model, []))
    return f"""
  SELECT *{derived}, ({LATEST_LOAD_SQL}) AS load_id
  FROM (SELECT {casts} FROM (SELECT {raw} FROM ({RAW[model].base_sql}) AS base))"""


def with_typed(*models: str) -> str:
    """WITH clause naming the ledger and the typed tables by their short names."""
    parts = [f"ledger AS ({LEDGER_SQL})"]
    parts += [f"{m} AS ({typed_sql('stg_fpl__' + m)})" for m in models]
    return "WITH " + ",\n".join(parts)


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps as epoch seconds, so that results compare by value."""
    changes = {}
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind == "date":
            changes[f.name] = F.col(f.name).cast("string")
        elif kind == "timestamp":
            changes[f.name] = F.unix_timestamp(f.name)
        elif kind == "timestamp_ntz":
            changes[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumns(changes) if changes else df
