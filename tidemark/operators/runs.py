"""The run ledger: two records per pipeline run, paired by key, and the indicators on top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import ratio
from tidemark.operators.asof import as_of

# What a metrics file may hold, and the step-duration cap in seconds.
METRIC_KEYS = ("rows_processed", "peak_mem_mb", "detail")
DURATION_CAP_SECONDS = 15 * 60
DURATION_ALERT_SHARE = 0.70
# Fresh by this local time on all but this share of days; memory and its alert.
FRESH_BY = "08:00"
FRESH_BUDGET = 0.01
MEMORY_LIMIT_MB = 2048
MEMORY_ALERT_SHARE = 0.70
# Grades of checks: a failed critical one stops a build, a failed warning is only recorded.
CRITICAL, WARNING = "critical", "warn"

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("rows_processed", T.LongType()),
        T.StructField("peak_mem_mb", T.IntegerType()),
        T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)


def run_key(run_id: Column, attempt: Column, job: Column) -> Column:
    """run.attempt.job; every run of characters an object key should not hold becomes one dash."""
    safe_job = F.regexp_replace(job, "[^A-Za-z0-9_]+", "-")
    return F.concat_ws(".", run_id.cast("string"), attempt.cast("string"), safe_job)


def run_status(job_status: Column) -> Column:
    """Only success counts as success. The original stays recoverable in the detail."""
    return F.when(job_status == "success", F.lit("success")).otherwise(F.lit("failed"))


def merge_metrics(finishes: DataFrame, metrics: DataFrame, key: str = "run_key") -> DataFrame:
    """Finish records with the metrics of their run. The record survives whatever the metrics are.

    `metrics` has one JSON text per run key. A missing or unreadable one leaves NULLs; keys the
    ledger does not know are reported beside it, never dropped unseen.
    """
    parsed = F.from_json("body", METRICS_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    keys = F.json_object_keys("body")
    known = F.array(*[F.lit(k) for k in METRIC_KEYS])
    read = metrics.select(key, "body", parsed.alias("m"), keys.alias("keys")).select(
        key,
        "m.rows_processed",
        "m.peak_mem_mb",
        F.col("m.detail").alias("job_detail"),
        F.array_join(F.array_sort(F.array_except("keys", known)), ",").alias("unknown_keys"),
        F.lit(True).alias("has_file"),
        F.col("m._corrupt_record").isNotNull().alias("is_corrupt"),
    )
    note = (
        F.when(F.col("has_file").isNull(), "metrics file not found")
        .when(F.col("is_corrupt"), "metrics file unreadable")
        .when(F.col("unknown_keys") != "", F.concat(F.lit("ignored unknown metrics key(s): "), "unknown_keys"))
    )
    status_entry = F.create_map(F.lit("job_status"), F.col("job_status"))
    own = F.coalesce(F.col("job_detail"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(own, lambda k, _: k != F.lit("job_status"))
    return (
        finishes.join(read, key, "left")
        .withColumns(
            {
                "status": run_status(F.col("job_status")),
                "detail": F.map_concat(kept, status_entry),
                "note": note,
            }
        )
        .drop("job_detail", "unknown_keys", "has_file", "is_corrupt")
    )


def pair_runs(records: DataFrame, key: str = "run_key") -> DataFrame:
    """One row per started run. A start without a finish is a run that died, and stays.

    `records` have the key, event, attempt, status, rows_processed, peak_mem_mb and recorded_at.
    Both records of a run are folded by one conditional aggregate over all dates, so a run that
    crosses midnight pairs as any other and no self-join is needed. The result has all that
    `daily_indicators` reads; `day` is the day of the start in the session's time zone.
    """
    start, finish = F.col("event") == "start", F.col("event") == "finish"
    finished = F.when(finish, F.col("recorded_at"))
    # A repeated start is an earlier attempt to write the same record; the first one counts, and
    # the last finish. Of finishes recorded at one moment a success counts, then the most rows,
    # then the most memory, whatever the order in which they are read.
    order = F.struct(
        F.col("recorded_at").alias("at"),
        (F.col("status") == "success").alias("succeeded"),
        F.col("rows_processed").alias("rows_processed"),
        F.col("peak_mem_mb").alias("peak_mem_mb"),
    )
    paired = (
        records.groupBy(key)
        .agg(
            F.min(F.when(start, F.col("recorded_at"))).alias("started_at"),
            F.max("attempt").alias("attempt"),
            F.max(F.when(finish, order)).alias("last"),
        )
        .select(
            key,
            "attempt",
            "started_at",
            F.col("last.at").alias("finished_at"),
            F.col("last.succeeded").alias("succeeded"),
            F.col("last.rows_processed").alias("rows_processed"),
            F.col("last.peak_mem_mb").alias("peak_mem_mb"),
        )
    )
    status = (
        F.when(F.col("finished_at").isNull(), "died")
        .when(F.col("succeeded"), "success")
        .otherwise("failed")
    )
    finished, started = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("finished_at", "started_at"))
    seconds = finished - started
    return (
        paired.filter(F.col("started_at").isNotNull())
        .withColumns(
            {
                "status": status,
                "day": F.col("started_at").cast("date"),
                "duration_seconds": F.floor(seconds / 1_000_000).cast("bigint"),
            }
        )
        .drop("succeeded")
    )


_DAY = 86_400_000_000
# Finishes and deadlines of about ten years are one bucket of the as-of join.
FRESH_BUCKET = 3650 * _DAY


def _local_day(at: Column, zone: str) -> Column:
    """The date of a moment in a zone."""
    clock = F.unix_micros(F.from_utc_timestamp(at, zone))
    return F.date_from_unix_date(((clock - F.pmod(clock, F.lit(_DAY))) / _DAY).cast("int"))


def _instant(day: str, micros: int, zone: str) -> Column:
    """The moment, in microseconds, when the clocks of a zone show a time of a day."""
    clock = F.unix_date(day).cast("long") * _DAY + micros
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(clock), zone))


def daily_indicators(
    runs: DataFrame,
    expected_rows: float,
    cap_seconds: int = DURATION_CAP_SECONDS,
    days: int = 30,
    deadline: str = FRESH_BY,
    zone: str = "UTC",
    budget: float = FRESH_BUDGET,
    memory_mb: float = MEMORY_LIMIT_MB,
) -> DataFrame:
    """Service indicators per calendar day: fresh or not, first-attempt success, completeness,
    duration and memory.

    `runs` is what `pair_runs` returns. Days are those of `zone`, whatever the session's zone is. At
    the `deadline` of each day the newest success finished by then is looked up: a day is fresh if
    that finish lies on the day itself, however long before the run began, and `data_age_seconds`
    is how old the newest data is (null before the first success). Runs count on the day of their
    start. Every day from the first start to the last start or finish is a row: a day without any
    run is not fresh, which is the failure the indicator is for. `budget_spent` is the share of
    missed days in the window over the share that may be missed. A run that reported no rows and a
    run that reported zero rows are different: only reported ones count for completeness. The
    windows cover one row per day.
    """
    first = F.col("attempt") == 1
    ok = F.col("status") == "success"
    started, finished = (F.col(c).cast("timestamp") for c in ("started_at", "finished_at"))
    daily = runs.groupBy(_local_day(started, zone).alias("day")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(first).alias("scheduled"),
        F.count_if(first & ok).alias("first_attempt_ok"),
        F.sum("rows_processed").alias("rows_reported"),
        F.count("rows_processed").alias("runs_reporting"),
        F.max("duration_seconds").alias("longest_seconds"),
        F.max("peak_mem_mb").alias("peak_mem_mb"),
    )
    span = runs.agg(
        F.min(_local_day(started, zone)).alias("lo"),
        F.max(F.greatest(_local_day(started, zone), _local_day(finished, zone))).alias("hi"),
    )
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    hours, minutes = (int(x) for x in deadline.split(":"))
    due = calendar.withColumns(
        {"opens": _instant("day", 0, zone), "due": _instant("day", (60 * hours + minutes) * 60_000_000, zone)}
    )
    done = runs.filter(ok & F.col("finished_at").isNotNull()).select(F.unix_micros(finished).alias("finished"))
    newest = as_of(due, done, "due", [], right_at="finished", width=FRESH_BUCKET)
    calendar = newest.select(
        "day",
        F.coalesce(F.col("as_of") >= F.col("opens"), F.lit(False)).alias("is_fresh"),
        F.expr("(due - as_of) div 1000000").alias("data_age_seconds"),
    )
    counts = ["runs", "scheduled", "first_attempt_ok", "runs_reporting"]
    dense = calendar.join(daily, "day", "left").na.fill(0, subset=counts)
    # Rows are days: the window is as long as the history in days.
    last_days = Window.orderBy("day").rowsBetween(-(days - 1), 0)
    fresh = ratio(F.sum(F.col("is_fresh").cast("int")).over(last_days), F.count(F.lit(1)).over(last_days))
    return (
        dense.withColumns(
            {
                "success_rate_30d": ratio(
                    F.sum("first_attempt_ok").over(last_days), F.sum("scheduled").over(last_days)
                ),
                "fresh_days_30d": fresh,
                "completeness": ratio(
                    F.col("rows_reported"), F.col("runs_reporting") * F.lit(float(expected_rows))
                ),
                "duration_share_of_cap": ratio(F.col("longest_seconds"), F.lit(cap_seconds)),
                "memory_share_of_limit": ratio(F.col("peak_mem_mb"), F.lit(float(memory_mb))),
            }
        )
        .withColumns(
            {
                "budget_spent": (1 - F.col("fresh_days_30d")) / F.lit(float(budget)),
                "duration_alert": F.col("duration_share_of_cap") > DURATION_ALERT_SHARE,
                "memory_alert": F.col("memory_share_of_limit") > MEMORY_ALERT_SHARE,
            }
        )
    )


def correctness_daily(results: DataFrame, days: int = 30) -> DataFrame:
    """The share of critical checks that passed, per day and over the last `days` days with results.

    `results` have check_name, grade, violations, passed and recorded_at; days are those of the
    session's zone. All critical checks must pass: `holds` says so for the day. Warnings are
    counted beside them and have no part in the share. A result without a grade is critical, and
    one that does not say that it passed has failed: what is unknown does not pass. A day with
    warnings only has no share and neither holds nor fails. Two numbers a day reach the window.
    """
    critical = F.coalesce(F.col("grade") != WARNING, F.lit(True))
    passed = F.coalesce("passed", F.lit(False))
    daily = results.groupBy(F.col("recorded_at").cast("date").alias("day")).agg(
        F.count_if(critical).alias("critical"),
        F.count_if(critical & passed).alias("critical_passed"),
        F.count_if(~critical).alias("warnings"),
        F.count_if(~critical & ~passed).alias("warnings_failed"),
        F.sum("violations").alias("violations"),
    )
    last_days = Window.orderBy("day").rowsBetween(-(days - 1), 0)
    return daily.withColumns(
        {
            "critical_share": ratio(F.col("critical_passed"), F.col("critical")),
            "critical_share_30d": ratio(F.sum("critical_passed").over(last_days), F.sum("critical").over(last_days)),
            "holds": F.when(F.col("critical") > 0, F.col("critical_passed") == F.col("critical")),
        }
    )


RECORDS, CHECK_RESULTS = "ops_runs", "ops_checks"
CHECK_RESULT = T.StructType(
    [
        T.StructField("build", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("grade", T.StringType()),
        T.StructField("violations", T.LongType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)


def append_check_results(results: DataFrame, root: str) -> None:
    """Append what the checks of a build found, one JSON line each, below the day of the record."""
    dated = results.withColumn("load_date", F.col("recorded_at").cast("date"))
    dated.coalesce(1).write.mode("append").partitionBy("load_date").json(f"{root}/{CHECK_RESULTS}")


def read_check_results(spark: SparkSession, root: str) -> DataFrame:
    dated = T.StructType(CHECK_RESULT.fields + [T.StructField("load_date", T.DateType())])
    return spark.read.schema(dated).option("mode", "FAILFAST").json(f"{root}/{CHECK_RESULTS}")


def append_run_records(records: DataFrame, root: str) -> None:
    """Append run records, one JSON line each and uncompressed, below their load date.

    Call it once for starts and once for finishes: the two never share a file, so a finish can
    not overwrite a start.
    """
    records.write.mode("append").partitionBy("load_date").json(f"{root}/{RECORDS}")


def read_run_records(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    dated = T.StructType(schema.fields + [T.StructField("load_date", T.DateType())])
    return spark.read.schema(dated).option("mode", "FAILFAST").json(f"{root}/{RECORDS}")
