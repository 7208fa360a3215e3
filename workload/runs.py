"""Queries on the run ledger, the service indicators and the identity map."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import identity, runs
from tidemark.session import scratch_path
from workload.inputs import portable, table
from workload.registry import query

K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


JOB = "CONCAT('load: ', event_type, ' & publish?')"


@query(
    "run_key",
    f"""
    SELECT run_key, COUNT(*) AS records FROM (
      SELECT CONCAT(CAST(user_id AS VARCHAR), '.', CAST({K} % 3 + 1 AS VARCHAR), '.',
                    regexp_replace({JOB}, '[^A-Za-z0-9_]+', '-', 'g')) AS run_key FROM events)
    GROUP BY 1""",
)
def run_key(spark, sf_dir):
    key = runs.run_key(F.col("user_id"), _k() % 3 + 1, F.expr(JOB))
    return (
        table(spark, sf_dir, "events")
        .groupBy(key.alias("run_key"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


JOB_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'skipped' ELSE 'cancelled' END END"


@query(
    "run_status_map",
    f"""
    SELECT o_orderkey, job_status, CASE WHEN job_status = 'success' THEN 'success' ELSE 'failed' END AS status
    FROM (SELECT o_orderkey, {JOB_STATUS} AS job_status FROM orders)""",
)
def run_status_map(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", F.expr(JOB_STATUS).alias("job_status"))
        .withColumn("status", runs.run_status(F.col("job_status")))
    )


@query(
    "run_metrics_merge",
    f"""
    SELECT run_key, status, job_status AS detail_job_status,
           CASE WHEN kind = 'good' THEN CAST(o_custkey AS VARCHAR) END AS detail_tables,
           CASE WHEN kind = 'good' THEN CAST(o_custkey AS BIGINT) END AS rows_processed,
           CASE WHEN kind = 'good' THEN 212 END AS peak_mem_mb,
           CASE kind WHEN 'none' THEN 'metrics file not found' WHEN 'bad' THEN 'metrics file unreadable'
                WHEN 'typo' THEN 'ignored unknown metrics key(s): rows_procesed' END AS note
    FROM (SELECT o_orderkey AS run_key, o_custkey, {JOB_STATUS} AS job_status,
                 CASE WHEN {JOB_STATUS} = 'success' THEN 'success' ELSE 'failed' END AS status,
                 CASE WHEN o_orderstatus = 'O' THEN 'none' WHEN o_orderpriority = '5-LOW' THEN 'bad'
                      WHEN o_orderpriority = '1-URGENT' THEN 'typo' ELSE 'good' END AS kind FROM orders)""",
)
def run_metrics_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    finishes = orders.select(
        F.col("o_orderkey").alias("run_key"), F.expr(JOB_STATUS).alias("job_status")
    )
    body = """CASE WHEN o_orderpriority = '5-LOW' THEN '{not json'
      WHEN o_orderpriority = '1-URGENT' THEN '{"rows_procesed": 10}'
      ELSE concat('{"rows_processed": ', o_custkey, ', "peak_mem_mb": 212, "detail": {"tables": "', o_custkey, '"}}') END"""
    metrics = orders.filter("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("run_key"), F.expr(body).alias("body")
    )
    return runs.merge_metrics(finishes, metrics).select(
        "run_key",
        "status",
        F.try_element_at("detail", F.lit("job_status")).alias("detail_job_status"),
        F.try_element_at("detail", F.lit("tables")).alias("detail_tables"),
        "rows_processed",
        "peak_mem_mb",
        "note",
    )


RECORD = T.StructType(
    [
        T.StructField("run_key", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("peak_mem_mb", T.LongType()),
    ]
)


# Every event is a record of the run user.k: these types start it, the others finish it. Days lie
# two apart, so that every other day has no run.
STARTS = "event_type IN ('signup', 'view', 'error')"
FIRST_DAY = "2024-01-01"


def _records(spark, sf_dir):
    key = F.concat_ws(".", "user_id", _k())
    is_start = F.expr(STARTS)
    done = ~is_start & (F.col("value") > 20)
    apart = F.make_dt_interval(days=F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date")))
    return (
        table(spark, sf_dir, "events")
        .withColumn("recorded_at", F.col("ts") + apart)
        .select(
            key.alias("run_key"),
            (_k() % 3 + 1).alias("attempt"),
            F.when(is_start, "start").otherwise("finish").alias("event"),
            F.when(is_start, "running").when(done, "success").otherwise("failed").alias("status"),
            F.when(done, _k()).alias("rows_processed"),
            F.when(~is_start, F.floor(F.col("value") * 20).cast("bigint")).alias("peak_mem_mb"),
            "recorded_at",
            F.col("recorded_at").cast("date").alias("load_date"),
        )
    )


RECORDS_SQL = f"""
    moved AS (
      SELECT *, ts + to_days(CAST(date_diff('day', DATE '{FIRST_DAY}', CAST(ts AS DATE)) AS INTEGER)) AS recorded_at
      FROM events),
    records AS (
      SELECT CONCAT(CAST(user_id AS VARCHAR), '.', CAST({K} AS VARCHAR)) AS run_key, {K} % 3 + 1 AS attempt,
             CASE WHEN {STARTS} THEN 'start' ELSE 'finish' END AS event,
             CASE WHEN {STARTS} THEN 'running' WHEN value > 20 THEN 'success' ELSE 'failed' END AS status,
             CASE WHEN NOT {STARTS} AND value > 20 THEN {K} END AS rows_processed,
             CASE WHEN NOT {STARTS} THEN CAST(floor(value * 20) AS BIGINT) END AS peak_mem_mb,
             recorded_at, CAST(recorded_at AS DATE) AS load_date
      FROM moved)"""


@query(
    "run_ledger_append",
    f"""WITH {RECORDS_SQL}
    SELECT CAST(load_date AS VARCHAR) AS load_date, event, status, COUNT(*) AS records,
           COUNT(rows_processed) AS reporting, CAST(SUM(rows_processed) AS BIGINT) AS rows_processed
    FROM records GROUP BY 1, 2, 3""",
)
def run_ledger_append(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    records = _records(spark, sf_dir).drop("recorded_at")
    for event in ("start", "finish"):
        runs.append_run_records(records.filter(F.col("event") == event), root)
    back = runs.read_run_records(spark, root, RECORD)
    return portable(
        back.groupBy("load_date", "event", "status").agg(
            F.count(F.lit(1)).alias("records"),
            F.count("rows_processed").alias("reporting"),
            F.sum("rows_processed").alias("rows_processed"),
        )
    )


PAIRED_SQL = f"""{RECORDS_SQL},
    starts AS (SELECT run_key, MIN(recorded_at) AS started_at FROM records WHERE event = 'start' GROUP BY 1),
    attempts AS (SELECT run_key, MAX(attempt) AS attempt FROM records GROUP BY 1),
    finishes AS (
      SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (
                 PARTITION BY run_key
                 ORDER BY recorded_at DESC, status = 'success' DESC, rows_processed DESC NULLS LAST,
                          peak_mem_mb DESC NULLS LAST) AS place
        FROM records WHERE event = 'finish')
      WHERE place = 1),
    paired AS (
      SELECT s.run_key, a.attempt, s.started_at, f.recorded_at AS finished_at, f.rows_processed, f.peak_mem_mb,
             COALESCE(f.status, 'died') AS status, CAST(s.started_at AS DATE) AS day,
             CAST(floor((epoch_us(f.recorded_at) - epoch_us(s.started_at)) / 1000000.0) AS BIGINT) AS duration_seconds
      FROM starts s JOIN attempts a ON a.run_key = s.run_key LEFT JOIN finishes f ON f.run_key = s.run_key)"""


@query(
    "pipeline_runs",
    f"""WITH {PAIRED_SQL}
    SELECT * REPLACE (strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
                      strftime(finished_at, '%Y-%m-%d %H:%M:%S.%f') AS finished_at, CAST(day AS VARCHAR) AS day)
    FROM paired""",
)
def pipeline_runs(spark, sf_dir):
    return portable(runs.pair_runs(_records(spark, sf_dir)))


_RATE = "CAST(SUM(CAST(is_fresh AS INTEGER)) OVER w AS DOUBLE) / CAST(COUNT(*) OVER w AS DOUBLE)"


@query(
    "sli_daily",
    f"""WITH {PAIRED_SQL},
    days AS (
      SELECT CAST(unnest(generate_series(MIN(day), MAX(GREATEST(day, COALESCE(CAST(finished_at AS DATE), day))),
                                         INTERVAL 1 DAY)) AS DATE) AS day FROM paired),
    newest AS (
      SELECT day, (SELECT MAX(finished_at) FROM paired p
                   WHERE p.status = 'success' AND p.finished_at <= days.day + INTERVAL 8 HOUR) AS at FROM days),
    daily AS (
      SELECT d.day, COUNT(p.run_key) AS runs, COUNT(p.run_key) FILTER (WHERE attempt = 1) AS scheduled,
             COUNT(p.run_key) FILTER (WHERE attempt = 1 AND status = 'success') AS first_attempt_ok,
             COALESCE(any_value(n.at) >= d.day, FALSE) AS is_fresh,
             CAST((epoch_us(d.day + INTERVAL 8 HOUR) - epoch_us(any_value(n.at))) // 1000000 AS BIGINT) AS data_age_seconds,
             CAST(SUM(rows_processed) AS BIGINT) AS rows_reported, COUNT(rows_processed) AS runs_reporting,
             MAX(duration_seconds) AS longest_seconds, MAX(peak_mem_mb) AS peak_mem_mb
      FROM days d JOIN newest n USING (day) LEFT JOIN paired p ON p.day = d.day GROUP BY d.day)
    SELECT * REPLACE (CAST(day AS VARCHAR) AS day),
           CAST(SUM(first_attempt_ok) OVER w AS DOUBLE)
             / NULLIF(CAST(SUM(scheduled) OVER w AS DOUBLE), 0) AS success_rate_30d,
           {_RATE} AS fresh_days_30d,
           CAST(rows_reported AS DOUBLE) / NULLIF(runs_reporting * CAST(50 AS DOUBLE), 0) AS completeness,
           CAST(longest_seconds AS DOUBLE) / CAST(900 AS DOUBLE) AS duration_share_of_cap,
           CAST(peak_mem_mb AS DOUBLE) / CAST(2048 AS DOUBLE) AS memory_share_of_limit,
           (1 - {_RATE}) / CAST(0.25 AS DOUBLE) AS budget_spent,
           CAST(longest_seconds AS DOUBLE) / CAST(900 AS DOUBLE) > CAST(0.7 AS DOUBLE) AS duration_alert,
           CAST(peak_mem_mb AS DOUBLE) / CAST(2048 AS DOUBLE) > CAST(0.7 AS DOUBLE) AS memory_alert
    FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def sli_daily(spark, sf_dir):
    paired = runs.pair_runs(_records(spark, sf_dir))
    return portable(runs.daily_indicators(paired, expected_rows=50, budget=0.25))


# Events stand for results of checks: their type is the check, errors and views may only warn.
_MILD_SQL = "event_type IN ('error', 'view')"


@query(
    "sli_correctness",
    f"""WITH daily AS (
      SELECT CAST(ts AS DATE) AS day, COUNT(*) FILTER (WHERE NOT {_MILD_SQL}) AS critical,
             COUNT(*) FILTER (WHERE NOT {_MILD_SQL} AND event_id % 23 <> 0) AS critical_passed,
             COUNT(*) FILTER (WHERE {_MILD_SQL}) AS warnings,
             COUNT(*) FILTER (WHERE {_MILD_SQL} AND event_id % 23 = 0) AS warnings_failed,
             CAST(SUM(CASE WHEN event_id % 23 = 0 THEN 1 + event_id % 4 ELSE 0 END) AS BIGINT) AS violations
      FROM events GROUP BY 1),
    shares AS (
      SELECT d.*, (SELECT CAST(SUM(critical_passed) AS DOUBLE) / NULLIF(CAST(SUM(critical) AS DOUBLE), 0)
                   FROM (SELECT * FROM daily e WHERE e.day <= d.day ORDER BY e.day DESC LIMIT 30)) AS critical_share_30d
      FROM daily d)
    SELECT * REPLACE (CAST(day AS VARCHAR) AS day),
           CAST(critical_passed AS DOUBLE) / NULLIF(CAST(critical AS DOUBLE), 0) AS critical_share,
           CASE WHEN critical > 0 THEN critical = critical_passed END AS holds
    FROM shares""",
)
def sli_correctness(spark, sf_dir):
    """The share of critical checks that passed, by day; every 23rd result is a failed one."""
    failed = F.col("event_id") % 23 == 0
    results = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("check_name"),
        F.when(F.expr(_MILD_SQL), runs.WARNING).otherwise(runs.CRITICAL).alias("grade"),
        F.when(failed, 1 + F.col("event_id") % 4).otherwise(0).cast("bigint").alias("violations"),
        (~failed).alias("passed"),
        F.col("ts").alias("recorded_at"),
    )
    return portable(runs.correctness_daily(results))


# ---- Identity: customers have accounts; events carry the account or an anonymous id. ----

DISTINCT_ID = "CASE WHEN event_type IN ('purchase', 'error') THEN CAST(user_id AS {text}) ELSE CONCAT('anon-', CAST(user_id AS {text}), '-', CAST({k} AS {text})) END"
IDENTITY_SQL = f"""
    tagged AS (
      SELECT *, {DISTINCT_ID.format(text="VARCHAR", k=K)} AS distinct_id FROM events
      UNION ALL SELECT *, CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'view'),
    mapping AS (
      SELECT DISTINCT user_id, distinct_id FROM tagged WHERE event_type = 'signup'
      UNION SELECT c_custkey, CAST(c_custkey AS VARCHAR) FROM customer)"""


def _identity(spark, sf_dir):
    k = "get_json_object(props, '$.k')"
    events = table(spark, sf_dir, "events")
    tagged = events.withColumn("distinct_id", F.expr(DISTINCT_ID.format(text="STRING", k=k)))
    # As after a merge of two profiles: a view also arrives under the account's own id.
    again = events.filter("event_type = 'view'").withColumn("distinct_id", F.col("user_id").cast("string"))
    tagged = tagged.unionByName(again)
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    identifies = tagged.filter("event_type = 'signup'").select("user_id", "distinct_id")
    return users, tagged, identity.identity_map(users, identifies)


@query("identity_map", f"WITH {IDENTITY_SQL} SELECT user_id, distinct_id FROM mapping")
def identity_map(spark, sf_dir):
    return _identity(spark, sf_dir)[2]


@query(
    "identity_resolution_rate",
    f"""WITH {IDENTITY_SQL}
    SELECT COUNT(DISTINCT event_id) AS active_events, COUNT(DISTINCT event_id) FILTER (WHERE known) AS resolved_events,
           CAST(COUNT(DISTINCT event_id) FILTER (WHERE known) AS DOUBLE) / CAST(COUNT(DISTINCT event_id) AS DOUBLE) AS resolved_share
    FROM (SELECT event_id, distinct_id IN (SELECT distinct_id FROM mapping) AS known FROM tagged)""",
)
def identity_resolution_rate(spark, sf_dir):
    """Every event arrives twice, and views under two ids; each counts once."""
    _, events, mapping = _identity(spark, sf_dir)
    return identity.resolution_rate(events.unionByName(events), mapping)


@query(
    "manager_360",
    f"""WITH {IDENTITY_SQL},
    business AS (SELECT o_custkey, COUNT(*) AS orders, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS spent_cents
                 FROM orders GROUP BY 1),
    behaviour AS (SELECT m.user_id, COUNT(DISTINCT event_id) AS events, COUNT(DISTINCT m.distinct_id) AS active_ids
                  FROM tagged t JOIN mapping m ON m.distinct_id = t.distinct_id GROUP BY 1)
    SELECT c_custkey AS user_id, c_mktsegment, COALESCE(orders, 0) AS orders, COALESCE(spent_cents, 0) AS spent_cents,
           COALESCE(events, 0) AS events, COALESCE(active_ids, 0) AS active_ids
    FROM customer LEFT JOIN business ON o_custkey = c_custkey LEFT JOIN behaviour b ON b.user_id = c_custkey""",
)
def manager_360(spark, sf_dir):
    _, events, mapping = _identity(spark, sf_dir)
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment"
    )
    business = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("spent_cents"),
    )
    return identity.manager_360(users, business, events, mapping)
