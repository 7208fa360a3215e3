"""Queries on the raw layer: loads, the ledger, envelopes, typing, snapshots, selections."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import (
    document_field,
    document_null,
    joined_text,
    nested_text,
    optional_column,
    ratio,
    scaled,
    strict_number,
)
from tidemark.operators.checks import FLOOR_SHARE
from tidemark.operators.selection import expand_range_specs, range_spec_errors, unsettled
from tidemark.operators.snapshot import (
    LOAD_ID,
    committed_rows,
    conform_ledger,
    latest_per_key,
    newest_load,
    snapshot_rows,
    value_changes,
)
from tidemark.plans.gold import planning_gameweek, points_are_prior_season
from tidemark.plans import build as lake_plan
from tidemark.plans.checks import check_names, graded, model_checks, violations
from tidemark.plans.silver import MODELS
from tidemark.session import scratch_path, staged
from tidemark.sources import bronze
from tidemark.sources.envelope import envelope_meta, split_envelope, stamp_parent
from tidemark.sources.layers import Lake
from workload import marts
from workload.inputs import (
    LATEST_LOAD_SQL,
    LEDGER_SQL,
    LOADED_EVENTS_SQL,
    MONTH,
    ORDER_MONTHS_SQL,
    latest_load,
    loaded_events,
    portable,
    raw_frame,
    raw_ledger,
    table,
    typed,
    with_typed,
)
from workload.registry import ORACLES, query

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField("seen_never", T.LongType()),
    ]
)


def _land_events(spark, sf_dir, label):
    """All events, appended to a fresh raw table, one load per day."""
    root = scratch_path(spark, label)
    rows = loaded_events(spark, sf_dir).withColumnRenamed("day", "load_date")
    rows = rows.withColumn("value", F.when(F.col("event_type") != "view", F.col("value")))
    bronze.append_rows(rows.drop("ts"), root, "events")
    return root


@query(
    "bronze_scan",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS load_date, event_type, COUNT(*) AS row_count,
           COUNT(CASE WHEN event_type <> 'view' THEN value END) AS values_present,
           CAST(0 AS BIGINT) AS absent_present, CAST(SUM(user_id) AS BIGINT) AS user_sum
    FROM events GROUP BY 1, 2""",
)
def bronze_scan(spark, sf_dir):
    root = _land_events(spark, sf_dir, "scan")
    rows = bronze.read_table(spark, root, "events", EVENTS_SCHEMA)
    return portable(
        rows.groupBy("load_date", "event_type").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("value").alias("values_present"),
            F.count("seen_never").alias("absent_present"),
            F.sum("user_id").alias("user_sum"),
        )
    )


@query(
    "load_ledger",
    f"""
    WITH ledger AS ({LEDGER_SQL})
    SELECT load_id, schema_name, CAST(status AS INTEGER) AS status, status = 0 AS is_committed,
           inserted_at AS loaded_at, schema_version_hash,
           CAST(floor(CAST(load_id AS DOUBLE)) AS BIGINT) AS load_started_at
    FROM ledger""",
)
def load_ledger(spark, sf_dir):
    root = scratch_path(spark, "ledger")
    bronze.append_ledger(raw_ledger(spark, sf_dir), root)
    return portable(conform_ledger(bronze.read_ledger(spark, root)))


@query(
    "optional_source_empty",
    """
    SELECT event_type, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS optional_rows
    FROM events GROUP BY 1""",
)
def optional_source_empty(spark, sf_dir):
    nothing = bronze.read_table(spark, scratch_path(spark, "none"), "events", EVENTS_SCHEMA, optional=True)
    optional = nothing.groupBy("event_type").agg(F.count(F.lit(1)).alias("optional_rows"))
    counted = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counted.join(optional, "event_type", "left").na.fill(0, ["optional_rows"])


@query(
    "layer_roundtrip",
    with_typed("fixtures")
    + """
    SELECT gameweek_id, COUNT(*) AS fixtures, CAST(SUM(home_team_difficulty) AS BIGINT) AS difficulty,
           CAST(SUM(home_score) AS BIGINT) AS home_goals
    FROM fixtures GROUP BY 1""",
)
def layer_roundtrip(spark, sf_dir):
    lake = Lake(scratch_path(spark, "layers"))
    (fixtures,) = typed(spark, sf_dir, "fixtures")
    lake.write(fixtures, "silver", "stg_fpl__fixtures", fixtures.schema)
    back = lake.read(spark, "silver", "stg_fpl__fixtures")
    return back.groupBy("gameweek_id").agg(
        F.count(F.lit(1)).alias("fixtures"),
        F.sum("home_team_difficulty").alias("difficulty"),
        F.sum("home_score").alias("home_goals"),
    )


ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


@query(
    "bronze_append_roundtrip",
    """
    SELECT '1706486400.5' AS load_id, o_orderstatus, COUNT(*) AS row_count,
           COUNT(DISTINCT o_orderkey) AS row_ids,
           CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY 2""",
)
def bronze_append_roundtrip(spark, sf_dir):
    """Two loads of a whole table, only the first committed; the read sees one snapshot."""
    root = scratch_path(spark, "append")
    orders = table(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.fieldNames())
    # The first load goes out in three parts, under dates that are days apart.
    days = {"F": "2024-01-29", "O": "2024-02-02", "P": "2024-02-09"}
    for status, day in days.items():
        part = orders.filter(F.col("o_orderstatus") == status)
        bronze.append_load(part, root, "orders", "1706486400.5", day)
    bronze.commit_load(spark, root, "1706486400.5", "orders", "2024-02-09T00:05:00Z", list(days.values()))
    bronze.append_load(orders, root, "orders", "1706572800.5", "2024-01-30")
    ledger = bronze.read_ledger(spark, root)
    load_id = newest_load(ledger).first()["load_id"]
    rows = bronze.read_table(spark, root, "orders", ORDERS_SCHEMA, load_id, bronze.dates_of(ledger, load_id))
    return rows.groupBy(F.col(LOAD_ID).alias("load_id"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(bronze.ROW_ID).alias("row_ids"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


@query(
    "uncommitted_load_invisible",
    f"""
    WITH ledger AS ({LEDGER_SQL}), loaded AS ({LOADED_EVENTS_SQL})
    SELECT load_id, event_type, COUNT(*) AS row_count FROM loaded
    WHERE load_id = ({LATEST_LOAD_SQL}) GROUP BY 1, 2""",
)
def uncommitted_load_invisible(spark, sf_dir):
    """Runs that died left files but no ledger row; the newest such load must not be read."""
    root = _land_events(spark, sf_dir, "dead")
    bronze.append_ledger(raw_ledger(spark, sf_dir).filter("status = 0"), root)
    ledger = bronze.read_ledger(spark, root)
    load_id = newest_load(ledger).first()["load_id"]
    rows = bronze.read_table(spark, root, "events", EVENTS_SCHEMA, load_id, bronze.dates_of(ledger, load_id))
    return rows.groupBy(F.col(LOAD_ID).alias("load_id"), "event_type").agg(
        F.count(F.lit(1)).alias("row_count")
    )


ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
META = T.StructType(
    [
        T.StructField("total_players", T.LongType()),
        T.StructField("game_settings", T.StructType([T.StructField("squad_squadsize", T.LongType())])),
    ]
)


def _payloads(spark, sf_dir):
    """One JSON document per order; `phases` is missing from those of status P."""
    elements = "array(named_struct('id', o_orderkey, 'name', o_orderpriority), named_struct('id', o_custkey, 'name', o_orderstatus))"
    phases = "CASE WHEN o_orderstatus <> 'P' THEN array(named_struct('id', o_custkey, 'name', 'phase')) END"
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(
            f"to_json(named_struct('elements', {elements}, 'phases', {phases},"
            " 'total_players', o_custkey,"
            " 'game_settings', named_struct('squad_squadsize', o_orderkey)))"
        ).alias("body"),
    )


@query(
    "envelope_split",
    """
    SELECT collection, COUNT(*) AS row_count, CAST(SUM(id) AS BIGINT) AS id_sum,
           COUNT(DISTINCT name) AS names
    FROM (
      SELECT 'elements' AS collection, o_orderkey AS id, o_orderpriority AS name FROM orders
      UNION ALL SELECT 'elements', o_custkey, o_orderstatus FROM orders
      UNION ALL SELECT 'phases', o_custkey, 'phase' FROM orders WHERE o_orderstatus <> 'P')
    GROUP BY 1""",
)
def envelope_split(spark, sf_dir):
    collections = {"elements": ITEM, "phases": ITEM, "chips": ITEM}
    tables = split_envelope(_payloads(spark, sf_dir), "body", collections, ["o_orderkey"])
    parts = [df.withColumn("collection", F.lit(name)) for name, df in tables.items()]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("collection").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("id").alias("id_sum"),
        F.countDistinct("name").alias("names"),
    )


@query(
    "envelope_meta",
    """
    SELECT o_orderkey, o_custkey AS total_players, o_orderkey AS squad_size FROM orders""",
)
def envelope_meta_rows(spark, sf_dir):
    return envelope_meta(_payloads(spark, sf_dir), "body", META, ["o_orderkey"]).select(
        "o_orderkey", "total_players", F.col("game_settings.squad_squadsize").alias("squad_size")
    )


@query(
    "stamp_event_id",
    """
    SELECT event_id, slot, CAST(p_size * slot AS BIGINT) AS points
    FROM (SELECT p_partkey AS event_id, p_size, UNNEST(range(1, LENGTH(p_type) + 1)) AS slot
          FROM part WHERE p_size <> 13)""",
)
def stamp_event_id(spark, sf_dir):
    element = "transform(sequence(1, length(p_type)), x -> named_struct('slot', CAST(x AS BIGINT), 'points', CAST(p_size * x AS BIGINT)))"
    responses = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("event_id"),
        F.expr(f"CASE WHEN p_size <> 13 THEN {element} END").alias("elements"),
    )
    return stamp_parent(responses, "elements", "event_id")


@query(
    "load_row_counts",
    f"""
    WITH counted AS (
      SELECT load_id, 'events' AS table_name, COUNT(*) AS row_count FROM ({LOADED_EVENTS_SQL}) GROUP BY 1
      UNION ALL
      SELECT CAST(o_custkey AS VARCHAR), 'orders', COUNT(*) FROM orders GROUP BY 1)
    SELECT load_id, table_name, row_count FROM counted
    UNION ALL
    SELECT load_id, '(total)', CAST(SUM(row_count) AS BIGINT) FROM counted GROUP BY 1""",
)
def load_row_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(LOAD_ID, F.col("o_custkey").cast("string"))
    events = loaded_events(spark, sf_dir)
    counted = bronze.row_counts({"events": events, "orders": orders, "_dlt_loads": events})
    return counted.na.fill("(total)", ["table_name"])


# Statuses of orders, each landed as a load of its own on one date.
STATUS_LOADS = {"F": "1706486400.5", "O": "1706490000.5", "P": "1706493600.5"}
STATUS_DAY = "2024-01-29"
_STATUS_LOAD = "CASE {} " + " ".join(f"WHEN '{s}' THEN '{i}'" for s, i in STATUS_LOADS.items()) + " END"


LANDED_AT_ONCE = 4


def _land_by_status(spark, sf_dir, label):
    """Orders and lines of each status as one committed load, and a dead one beside them."""
    root = scratch_path(spark, label)
    orders = table(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.fieldNames())
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    for status, load_id in STATUS_LOADS.items():
        landed = [
            bronze.append_load(orders.filter(F.col("o_orderstatus") == status), root, "orders", load_id, STATUS_DAY),
            bronze.append_load(lines.filter(F.col("l_linestatus") == status), root, "lines", load_id, STATUS_DAY),
        ]
        bronze.commit_load(spark, root, load_id, "orders", f"{STATUS_DAY}T12:00:00Z", landed=landed)
    bronze.append_load(orders, root, "orders", "1706497200.5", STATUS_DAY)
    return root


@query(
    "load_row_counts_written",
    f"""
    WITH counted AS (
      SELECT {_STATUS_LOAD.format("o_orderstatus")} AS load_id, 'orders' AS table_name, COUNT(*) AS row_count FROM orders GROUP BY 1
      UNION ALL
      SELECT load_id, 'lines', COUNT(l_orderkey)
      FROM (SELECT DISTINCT {_STATUS_LOAD.format("o_orderstatus")} AS load_id, o_orderstatus FROM orders)
      LEFT JOIN lineitem ON l_linestatus = o_orderstatus GROUP BY 1)
    SELECT load_id, table_name, row_count FROM counted
    UNION ALL
    SELECT load_id, '(total)', CAST(SUM(row_count) AS BIGINT) FROM counted GROUP BY 1""",
)
def load_row_counts_written(spark, sf_dir):
    """Rows per load and table, read off the ledger: the writes have counted them."""
    ledger = bronze.read_ledger(spark, _land_by_status(spark, sf_dir, "counted"))
    return bronze.ledger_row_counts(ledger).na.fill("(total)", ["table_name"])


@query(
    "load_files_scan",
    f"""
    SELECT {_STATUS_LOAD.format("o_orderstatus")} AS load_id, o_orderstatus, COUNT(*) AS row_count,
           COUNT(DISTINCT o_orderkey) AS row_ids, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY 1, 2""",
)
def load_files_scan(spark, sf_dir):
    """Loads of one date, each read from the files that its commit lists."""
    root = _land_by_status(spark, sf_dir, "files")
    ledger = bronze.read_ledger(spark, root)
    parts = [
        bronze.read_table(
            spark, root, "orders", ORDERS_SCHEMA, i, bronze.dates_of(ledger, i), files=bronze.files_of(spark, root, i)
        )
        for i in STATUS_LOADS.values()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(F.col(LOAD_ID).alias("load_id"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(bronze.ROW_ID).alias("row_ids"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


# ---- Typing and scalar rules. ----

BLANKED = "CASE WHEN c_nationkey = 3 THEN '' WHEN c_nationkey = 4 THEN '  ' ELSE CONCAT(' ', CAST(c_custkey AS STRING), ' ') END"


@query(
    "optional_column",
    f"""
    SELECT c_nationkey, COUNT(*) AS row_count, COUNT(ep_next) AS present_values,
           SUM(ep_next) AS present_sum, CAST(0 AS BIGINT) AS absent_values
    FROM (SELECT c_nationkey, CAST(NULLIF(TRIM({BLANKED}), '') AS DOUBLE) AS ep_next FROM customer)
    GROUP BY 1""",
)
def optional_column_rows(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select("c_nationkey", F.expr(BLANKED).alias("Ep_Next"))
    typed_rows = raw.select(
        "c_nationkey",
        optional_column(raw, "ep_next", "double"),
        optional_column(raw, "ep_this", "double", "expected_points_this"),
    )
    return typed_rows.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("ep_next").alias("present_values"),
        F.sum("ep_next").alias("present_sum"),
        F.count("expected_points_this").alias("absent_values"),
    )


PRICE_TEXT = "CASE WHEN p_size = 5 THEN '' WHEN p_size = 6 THEN '  ' ELSE CONCAT(CAST(p_retailprice AS STRING), ' ') END"


@query(
    "strict_numeric_cast",
    f"SELECT p_partkey, CAST(NULLIF(TRIM({PRICE_TEXT}), '') AS DOUBLE) AS price FROM part",
)
def strict_numeric_cast(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select("p_partkey", F.expr(PRICE_TEXT).alias("price"))
    return raw.select("p_partkey", strict_number(F.col("price")).alias("price"))


@query(
    "nested_to_json",
    """
    SELECT event_id, CAST(to_json({'user': user_id, 'note': CAST(NULL AS VARCHAR), 'tags': [event_type]}) AS VARCHAR) AS document
    FROM events""",
)
def nested_to_json(spark, sf_dir):
    nested = F.struct(
        F.col("user_id").alias("user"),
        F.lit(None).cast("string").alias("note"),
        F.array("event_type").alias("tags"),
    )
    return table(spark, sf_dir, "events").select("event_id", nested_text(nested).alias("document"))


@query(
    "variant_null_vs_missing",
    """
    SELECT event_type,
           COUNT(CASE WHEN event_type NOT IN ('error', 'view') THEN 1 END) AS with_value,
           COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS with_null,
           COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS without_key,
           CAST(SUM(CASE WHEN event_type NOT IN ('error', 'view') THEN user_id END) AS BIGINT) AS value_sum
    FROM events GROUP BY 1""",
)
def variant_null_vs_missing(spark, sf_dir):
    body = F.expr(
        "CASE event_type WHEN 'error' THEN '{\"a\": null}' WHEN 'view' THEN '{}'"
        " ELSE concat('{\"a\": ', user_id, '}') END"
    )
    documents = table(spark, sf_dir, "events").select("event_type", F.parse_json(body).alias("doc"))
    is_null = document_null(F.col("doc"), "$.a")
    return documents.groupBy("event_type").agg(
        F.count_if(~is_null).alias("with_value"),
        F.count_if(is_null).alias("with_null"),
        F.count_if(is_null.isNull()).alias("without_key"),
        F.sum(document_field(F.col("doc"), "$.a", "bigint")).alias("value_sum"),
    )


@query(
    "scaled_price",
    """
    SELECT p_partkey, CAST(ROUND(p_retailprice * 10) AS BIGINT) AS now_cost_tenths,
           CAST(ROUND(p_retailprice * 10) AS BIGINT) / 10.0 AS now_cost_gbp_m FROM part""",
)
def scaled_price(spark, sf_dir):
    tenths = F.round(F.col("p_retailprice") * 10).cast("bigint")
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", tenths.alias("now_cost_tenths"))
        .withColumn("now_cost_gbp_m", scaled(F.col("now_cost_tenths")))
    )


@query(
    "full_name_concat",
    """
    SELECT c_custkey, c_name || ' ' || CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS full_name
    FROM customer""",
)
def full_name_concat(spark, sf_dir):
    second = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    full = joined_text(F.col("c_name"), " ", second)
    return table(spark, sf_dir, "customer").select("c_custkey", full.alias("full_name"))


@query(
    "safe_ratio",
    """
    SELECT l_orderkey, CAST(SUM(l_quantity) AS DOUBLE)
           / NULLIF(CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS DOUBLE), 0) AS quantity_per_tax
    FROM lineitem GROUP BY 1""",
)
def safe_ratio(spark, sf_dir):
    totals = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("tax"),
    )
    return totals.select(
        "l_orderkey", ratio(F.col("quantity"), F.col("tax")).alias("quantity_per_tax")
    )


FLAGS = {
    "finished": "CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END",
    "checked": "CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_totalprice > 200000 END",
    "removed": "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey % 2 = 0 END",
}


@query(
    "derived_flags",
    f"""
    SELECT o_orderkey, o_orderstatus = 'F' AS is_available, finished AND checked AS is_settled,
           finished AND checked AND NOT removed AS is_pickable,
           CAST(SUBSTR(o_orderpriority, 1, 1) AS INTEGER) = 1 AS is_first_choice
    FROM (SELECT *, {", ".join(f"{e} AS {n}" for n, e in FLAGS.items())} FROM orders)""",
)
def derived_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumns({n: F.expr(e) for n, e in FLAGS.items()})
    finished, checked, removed = F.col("finished"), F.col("checked"), F.col("removed")
    return rows.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").alias("is_available"),
        (finished & checked).alias("is_settled"),
        (finished & checked & ~removed).alias("is_pickable"),
        (F.substring("o_orderpriority", 1, 1).cast("int") == 1).alias("is_first_choice"),
    )


# ---- Snapshots and selections. ----


@query("latest_committed_load", f"WITH ledger AS ({LEDGER_SQL}) {LATEST_LOAD_SQL}")
def latest_committed(spark, sf_dir):
    return newest_load(raw_ledger(spark, sf_dir))


@query(
    "snapshot_rows",
    f"""
    WITH ledger AS ({LEDGER_SQL}), loaded AS ({LOADED_EVENTS_SQL})
    SELECT load_id, event_id, user_id, event_type, value FROM loaded
    WHERE load_id = ({LATEST_LOAD_SQL})""",
)
def snapshot(spark, sf_dir):
    rows = loaded_events(spark, sf_dir).withColumnRenamed("day", "load_date")
    return snapshot_rows(rows, latest_load(spark, sf_dir)).select(
        F.col(LOAD_ID).alias("load_id"), "event_id", "user_id", "event_type", "value"
    )


@query(
    "select_unsettled",
    f"""
    SELECT DISTINCT gw AS id FROM ({ORDER_MONTHS_SQL})
    WHERE (o > f AND o > p) OR (p > f AND p > o) OR (f >= o AND NOT p <= f)""",
)
def select_unsettled(spark, sf_dir):
    load_id = latest_load(spark, sf_dir)
    return unsettled(raw_frame(spark, sf_dir, "stg_fpl__gameweeks", load_id))


SPEC = "CONCAT(CAST(c_nationkey + 1 AS STRING), ' - ', CAST(c_nationkey + c_custkey % 17 AS STRING), ', ,', CAST(c_custkey % 40 AS STRING), CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 7 THEN ',gw5' ELSE '' END)"
SPEC_PARTS_SQL = f"""
    SELECT c_custkey, part, TRY_CAST(TRIM(split_part(part, '-', 1)) AS INTEGER) AS lo,
           TRY_CAST(TRIM(CASE WHEN contains(part, '-') THEN split_part(part, '-', 2) ELSE part END) AS INTEGER) AS hi
    FROM (SELECT c_custkey, TRIM(UNNEST(string_split({SPEC}, ','))) AS part FROM customer)
    WHERE part <> ''"""


def _specs(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr(SPEC).alias("spec"))


@query(
    "backfill_ranges",
    f"""
    WITH parts AS ({SPEC_PARTS_SQL}),
    bad AS (SELECT DISTINCT c_custkey FROM parts
            WHERE lo IS NULL OR hi IS NULL OR lo > hi OR lo < 1 OR hi > 38)
    SELECT DISTINCT c_custkey, CAST(gameweek AS INTEGER) AS gameweek FROM (
      SELECT c_custkey, UNNEST(range(lo, hi + 1)) AS gameweek FROM parts
      WHERE c_custkey NOT IN (SELECT c_custkey FROM bad))""",
)
def backfill_ranges(spark, sf_dir):
    return expand_range_specs(_specs(spark, sf_dir), "c_custkey", "spec", "gameweek")


@query(
    "backfill_range_errors",
    f"""
    SELECT * FROM (
      SELECT c_custkey, part, CASE WHEN lo IS NULL OR hi IS NULL THEN 'not numeric'
             WHEN lo > hi THEN 'inverted' WHEN lo < 1 OR hi > 38 THEN 'outside' END AS reason
      FROM ({SPEC_PARTS_SQL})) WHERE reason IS NOT NULL""",
)
def backfill_range_errors(spark, sf_dir):
    return range_spec_errors(_specs(spark, sf_dir), "c_custkey", "spec")


@query(
    "planning_period",
    with_typed("gameweeks") + "SELECT MIN(gameweek_id) AS gameweek_id FROM gameweeks WHERE NOT is_finished",
)
def planning_period(spark, sf_dir):
    return planning_gameweek(typed(spark, sf_dir, "gameweeks")[0])


@query(
    "prior_period_flag",
    with_typed("gameweeks", "players")
    + """
    SELECT COUNT(*) AS player_count,
           (SELECT COUNT(*) FROM gameweeks WHERE is_finished) = 0
           AND (SELECT MAX(minutes) FROM players) > 0 AS points_are_prior_season
    FROM players""",
)
def prior_period_flag(spark, sf_dir):
    gameweeks, players = typed(spark, sf_dir, "gameweeks", "players")
    flag = points_are_prior_season(gameweeks, players)
    return players.agg(F.count(F.lit(1)).alias("player_count")).withColumn(
        "points_are_prior_season", flag
    )


# ---- Typed tables. Every row is in two loads, of which one is committed. ----


def _register_typed(key, short, dates=(), times=()):
    model = f"stg_fpl__{short}"

    def run(spark, sf_dir):
        load_id = latest_load(spark, sf_dir)
        raw = raw_frame(spark, sf_dir, model, load_id, f"9{load_id}")
        return portable(MODELS[model].build(raw, load_id))

    changed = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    changed += [f"CAST(epoch({c}) AS BIGINT) AS {c}" for c in times]
    replaced = f" REPLACE ({', '.join(changed)})" if changed else ""
    query(key, f"{with_typed(short)} SELECT *{replaced} FROM {short}")(run)


_register_typed("stg_teams", "teams")
_register_typed("stg_positions", "positions")
_register_typed("stg_gameweeks", "gameweeks", times=("deadline_time",))
_register_typed("stg_fixtures", "fixtures", times=("kickoff_time",))
_register_typed(
    "stg_players", "players", dates=("birth_date", "team_join_date"), times=("news_added",)
)
_register_typed("stg_chips", "chips")
_register_typed("phase_span", "phases")
_register_typed("stg_stat_types", "stat_types")
_register_typed("game_settings", "game_settings")


# ---- History over committed loads. ----


@query(
    "latest_per_key",
    """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
)
def newest_observation(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "events"),
        ["user_id", "event_type"],
        [F.col("ts"), F.col("event_id")],
        ["event_id", "value"],
    )


@query(
    "price_changes",
    f"""
    WITH ledger AS ({LEDGER_SQL}), loaded AS ({LOADED_EVENTS_SQL}),
    history AS (
      SELECT user_id, load_id, CAST(floor(MAX(value) / 50) AS BIGINT) AS price FROM loaded
      WHERE load_id IN (SELECT load_id FROM ledger WHERE status = 0) GROUP BY 1, 2),
    lagged AS (
      SELECT *, LAG(price) OVER w AS previous_value, ROW_NUMBER() OVER w = 1 AS is_first
      FROM history WINDOW w AS (PARTITION BY user_id ORDER BY CAST(load_id AS DOUBLE))),
    changed AS (
      SELECT user_id, CAST(load_id AS DOUBLE) AS load_time, previous_value, price, is_first FROM lagged
      WHERE is_first OR price IS DISTINCT FROM previous_value)
    SELECT *, load_time AS valid_from,
           (SELECT MIN(load_time) FROM changed later WHERE later.user_id = c.user_id AND later.load_time > c.load_time) AS valid_to
    FROM changed c""",
)
def price_changes(spark, sf_dir):
    committed = committed_rows(loaded_events(spark, sf_dir), raw_ledger(spark, sf_dir))
    history = committed.groupBy("user_id", F.col(LOAD_ID).cast("double").alias("load_time")).agg(
        F.floor(F.max("value") / 50).cast("bigint").alias("price")
    )
    history = history.withColumn("week", F.floor(F.col("load_time") / 604_800))
    return value_changes(history, "user_id", "load_time", "price", ["week"])


# ---- The whole build, from raw files to checked marts. ----

_BUILT = ["teams", "positions", "gameweeks", "fixtures", "players", "chips", "phases", "stat_types", "game_settings"]
_MODEL_COUNTS = {
    "stg_fpl__loads": "SELECT COUNT(*) FROM ledger WHERE status = 0",
    **{f"stg_fpl__{m}": f"SELECT COUNT(*) FROM {m}" for m in _BUILT},
    "dim_team": "SELECT COUNT(*) FROM teams",
    "dim_player": "SELECT COUNT(*) FROM players JOIN teams USING (team_id) JOIN positions USING (position_id)",
    "fct_team_fixture": "SELECT 2 * COUNT(*) FROM fixtures",
    "mart_team_fixture_run": "SELECT (SELECT COUNT(*) FROM teams) * (SELECT COUNT(*) FROM gameweeks)",
    "mart_player_value": "SELECT COUNT(*) FROM players JOIN teams USING (team_id) JOIN positions USING (position_id)",
    "mart_position_scarcity": "SELECT COUNT(*) FROM positions",
}


def _digest_sql() -> str:
    """Per column of some built models: values present and distinct values."""
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model_name, '{column}' AS column_name, COUNT({column}) AS present,"
        f" COUNT(DISTINCT {column}) AS distinct_values, {total} AS total FROM {source}"
        for model, source, column, total in _DIGESTED
    )


def _whole(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS BIGINT)) AS BIGINT)"


# (model, its SQL table, a column, its sum as a whole number).
_DIGESTED = [
    ("stg_fpl__teams", "teams", "team_short_name", "NULL"),
    ("stg_fpl__players", "players", "now_cost_tenths", _whole("now_cost_tenths")),
    ("stg_fpl__players", "players", "total_points", _whole("total_points")),
    ("stg_fpl__players", "players", "status", "NULL"),
    ("stg_fpl__fixtures", "fixtures", "home_score", _whole("home_score")),
    ("stg_fpl__fixtures", "fixtures", "gameweek_id", _whole("gameweek_id")),
    ("stg_fpl__gameweeks", "gameweeks", "gameweek_name", "NULL"),
    ("dim_team", "dim_team", "player_count", _whole("player_count")),
    ("dim_team", "dim_team", "home_away_strength_delta", _whole("home_away_strength_delta")),
    ("dim_player", "dim_player", "now_cost_tenths", _whole("now_cost_tenths")),
    ("dim_player", "dim_player", "position_short_name", "NULL"),
    ("fct_team_fixture", "fct", "difficulty", _whole("difficulty")),
    ("fct_team_fixture", "fct", "opponent_team_id", _whole("opponent_team_id")),
    ("mart_team_fixture_run", "fixture_run", "fixture_count", _whole("fixture_count")),
    ("mart_team_fixture_run", "fixture_run", "opponents", "NULL"),
    ("mart_team_fixture_run", "fixture_run", "next_5_total_difficulty", _whole("next_5_total_difficulty")),
]


@query(
    "lake_build_values",
    with_typed(*_BUILT) + f", {marts.DIM_TEAM_SQL}, {marts.DIM_PLAYER_SQL}, {marts.FCT_SQL}, {marts.RUN_SQL} " + _digest_sql(),
)
def lake_build_values(spark, sf_dir):
    """The values of built models, as they are read back from the published datasets."""
    parts = []
    for model, _, column, total in _DIGESTED:
        value = F.col(column)
        parts.append(
            _published(spark, sf_dir, "silver" if model.startswith("stg_") else "gold", model).agg(
                F.count(value).alias("present"),
                F.countDistinct(value).alias("distinct_values"),
                (F.sum(value.cast("bigint")) if total != "NULL" else F.lit(None)).cast("bigint").alias("total"),
            ).selectExpr(f"'{model}' AS model_name", f"'{column}' AS column_name", "*")
        )
    return reduce(DataFrame.union, parts)


# Parts' types stand for positions, so their names are not in the game's vocabulary: every one of
# them breaks the rule on the players and on the scarcity of a position. Of the other checks only
# the budget can fail, where few parts make the cheapest squad dear.
_FOREIGN = "position_short_name NOT IN ('GKP', 'DEF', 'MID', 'FWD')"


@query(
    "lake_checks_all",
    marts.SCARCITY_WITH
    + f"""
    SELECT 'dim_player.accepted' AS check_name, COUNT(DISTINCT position_short_name) AS violations
    FROM dim_player WHERE {_FOREIGN}
    UNION ALL SELECT 'mart_position_scarcity.accepted', COUNT(DISTINCT position_short_name) FROM positions WHERE {_FOREIGN}
    UNION ALL SELECT 'budget_holds', CAST(1 AS BIGINT) FROM scarcity
      HAVING MAX(minimum_squad_gbp_m) > {FLOOR_SHARE} * MAX(budget_gbp_m) OR SUM(squad_required) <> MAX(squad_size)
    UNION ALL SELECT 'models checked', CAST(16 AS BIGINT)
    UNION ALL SELECT 'invariants checked', CAST(7 AS BIGINT)""",
)
def lake_checks_all(spark, sf_dir):
    """All checks of a whole build: which fail, over how many models and invariants."""
    found = lake_plan.checks.all_checks(_build(spark, sf_dir))
    models = len({name.split(".")[0] for name in found if "." in name})
    spanning = sum("." not in name for name in found)
    seen = spark.range(1).selectExpr(
        f"stack(2, 'models checked', {models}L, 'invariants checked', {spanning}L) AS (check_name, violations)"
    )
    return violations(found).unionByName(seen)


@query(
    "lake_build",
    with_typed(*_BUILT)
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model_name, CAST(({sql}) AS BIGINT) AS row_count"
        for name, sql in _MODEL_COUNTS.items()
    ),
)
def lake_build(spark, sf_dir):
    """All raw tables landed as one committed load, then every model built and written."""
    parts = [
        df.agg(F.expr("count(1) AS row_count")).selectExpr(f"'{name}' AS model_name", "row_count")
        for name, df in _build(spark, sf_dir).items()
    ]
    return reduce(DataFrame.union, parts)


def _build(spark, sf_dir):
    root = scratch_path(spark, "build")
    raw_root = f"{root}/bronze"
    ledger = raw_ledger(spark, sf_dir).filter("status = 0")
    load_id = newest_load(ledger).first()["load_id"]
    day = str(datetime.fromtimestamp(float(load_id), tz=timezone.utc).date())

    def land(name):
        rows = raw_frame(spark, sf_dir, name, load_id).drop(LOAD_ID)
        return bronze.append_load(rows, raw_root, MODELS[name].raw, load_id, day)

    # The tables do not depend on each other: they are landed side by side.
    with ThreadPoolExecutor(LANDED_AT_ONCE) as pool:
        landed = list(pool.map(land, MODELS))
    bronze.list_files(spark, raw_root, load_id, landed)
    bronze.append_ledger(ledger.withColumn("load_dates", F.array(F.lit(day))), raw_root)
    built = lake_plan.build(spark, raw_root, Lake(root))
    _LAKES[spark.sparkContext.applicationId, sf_dir] = root
    return built


# Lakes that a query of this session has built, by application and tables.
_LAKES: dict[tuple[str, str], str] = {}


def _published(spark, sf_dir, layer, model):
    """A model as readers find it in the lake of this session, which is built if none is."""
    if (spark.sparkContext.applicationId, sf_dir) not in _LAKES:
        _build(spark, sf_dir)
    return Lake(_LAKES[spark.sparkContext.applicationId, sf_dir]).read(spark, layer, model)


# Every value of every model, as it is read back from the published build, against the SQL of the
# query that computes the model. The build's ledger holds committed loads only.
_READ_BACK = {
    **{
        f"built_{key}": ("silver", f"stg_fpl__{short}", key)
        for key, short in (
            ("stg_teams", "teams"),
            ("stg_positions", "positions"),
            ("stg_gameweeks", "gameweeks"),
            ("stg_fixtures", "fixtures"),
            ("stg_players", "players"),
            ("stg_chips", "chips"),
            ("phase_span", "phases"),
            ("stg_stat_types", "stat_types"),
            ("game_settings", "game_settings"),
        )
    },
    "built_dim_team": ("gold", "dim_team", "dim_team"),
    "built_dim_player": ("gold", "dim_player", "dim_player"),
    "built_team_fixture": ("gold", "fct_team_fixture", "team_fixture_result"),
    "built_fixture_run": ("gold", "mart_team_fixture_run", "fixture_run"),
    "built_player_value": ("gold", "mart_player_value", "player_value"),
    "built_position_scarcity": ("gold", "mart_position_scarcity", "position_scarcity"),
}


# The order of an object's keys is no part of its value; the lake keeps them sorted.
_SORTED_KEYS = """
    SELECT * REPLACE (CONCAT('{', array_to_string(list_transform(list_sort(json_keys(game_settings_json)),
                      lambda k: CONCAT('"', k, '":', json_extract(game_settings_json, CONCAT('$.', k)))), ','), '}')
                      AS game_settings_json)"""


def _register_read_back(key, layer, model, computed):
    def run(spark, sf_dir):
        return portable(_published(spark, sf_dir, layer, model))

    sql = ORACLES[computed]
    query(key, f"{_SORTED_KEYS} FROM ({sql})" if computed == "game_settings" else sql)(run)


for _key, _place in _READ_BACK.items():
    _register_read_back(_key, *_place)


# The rules that these tables break by what their columns stand for may only warn.
_MILD = ("dim_player.accepted", "mart_position_scarcity.accepted", "budget_holds")


@query(
    "checks_graded",
    marts.SCARCITY_WITH
    + f""",
    failed AS (
      SELECT 'dim_player.accepted' AS check_name, COUNT(DISTINCT position_short_name) AS violations
      FROM dim_player WHERE {_FOREIGN}
      UNION ALL SELECT 'mart_position_scarcity.accepted', COUNT(DISTINCT position_short_name) FROM positions WHERE {_FOREIGN}
      UNION ALL SELECT 'budget_holds', CAST(COUNT(*) AS BIGINT) FROM (
        SELECT 1 FROM scarcity HAVING MAX(minimum_squad_gbp_m) > {FLOOR_SHARE} * MAX(budget_gbp_m)
                                   OR SUM(squad_required) <> MAX(squad_size))),
    named AS (SELECT UNNEST({sorted(check_names())!r}) AS check_name)
    SELECT check_name, CASE WHEN check_name IN {_MILD!r} THEN 'warn' ELSE 'critical' END AS grade,
           COALESCE(violations, 0) AS violations, COALESCE(violations, 0) = 0 AS passed
    FROM named LEFT JOIN failed USING (check_name)""",
)
def checks_graded(spark, sf_dir):
    """Every check of a published build with its grade, passed or not."""
    models = {"silver": ["stg_fpl__loads", *MODELS], "gold": lake_plan.MARTS}
    built = {n: _published(spark, sf_dir, layer, n) for layer, names in models.items() for n in names}
    return graded(lake_plan.checks.all_checks(built), _MILD)


@query(
    "lake_checks",
    with_typed("players", "gameweeks", "stat_types", "positions", "teams")
    + """
    SELECT * FROM (
      SELECT 'stg_fpl__gameweeks.unique' AS check_name,
             (SELECT COUNT(*) FROM (SELECT gameweek_id FROM gameweeks GROUP BY 1 HAVING COUNT(*) > 1)) AS violations
      UNION ALL SELECT 'stg_fpl__players.position_id.parent',
             (SELECT COUNT(DISTINCT position_id) FROM players WHERE position_id NOT IN (SELECT position_id FROM positions))
      UNION ALL SELECT 'stg_fpl__players.accepted',
             (SELECT COUNT(DISTINCT status) FROM players WHERE status NOT IN ('a', 'd', 'i', 's', 'u'))
      UNION ALL SELECT 'stg_fpl__players.not_null',
             (SELECT CAST(COUNT(opta_code) < COUNT(*) AS BIGINT) FROM players)
      UNION ALL SELECT 'stg_fpl__players.team_id.parent',
             (SELECT COUNT(DISTINCT team_id) FROM players WHERE team_id NOT IN (SELECT team_id FROM teams WHERE team_id > 3)))
    WHERE violations > 0""",
)
def lake_checks(spark, sf_dir):
    """The rules of the players and gameweeks, with some clubs and codes taken away."""
    players, gameweeks, positions, teams = typed(
        spark, sf_dir, "players", "gameweeks", "positions", "teams"
    )
    frames = {
        "stg_fpl__players": staged(players.withColumn("display_name", F.col("opta_code")), "players"),
        "stg_fpl__gameweeks": gameweeks,
        "stg_fpl__positions": positions,
        "stg_fpl__teams": teams.filter("team_id > 3"),
    }
    found = {}
    for model in ("stg_fpl__players", "stg_fpl__gameweeks"):
        found.update(model_checks(model, frames))
    return violations(found)
