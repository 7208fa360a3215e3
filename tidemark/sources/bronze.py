"""The raw layer: append-only gzip JSON lines per table and load, and the ledger of loads.

Layout under a root: `<table>/load_date=YYYY-MM-DD/*.json.gz`, and `_dlt_loads/*.json` for the
ledger. A load is visible once its ledger row exists, and that row is written last. Files are named
by their load; before the ledger row, `_dlt_files/<load>/` is written, the list of the files that
the load wrote, so that a reader opens these and no others.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import nested_text
from tidemark.operators.snapshot import COMMITTED, LOAD_ID

ROW_ID = "_dlt_id"
LEDGER = "_dlt_loads"
FILES = "_dlt_files"
BOOKKEEPING = "_dlt"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("inserted_at", T.StringType()),
        T.StructField("schema_version_hash", T.StringType()),
        # The partition dates the load wrote; NULL where a writer did not tell.
        T.StructField("load_dates", T.ArrayType(T.StringType())),
        # Rows written per table, counted while writing; NULL where a writer did not tell.
        T.StructField(
            "row_counts",
            T.ArrayType(
                T.StructType([T.StructField("table_name", T.StringType()), T.StructField("row_count", T.LongType())])
            ),
        ),
    ]
)
# Ledger fields that other writers do not have.
OWN_FIELDS = ("load_dates", "row_counts")

FILES_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("path", T.StringType())])


@dataclass(frozen=True)
class Landed:
    """What one `append_load` has written."""

    table: str
    load_date: str
    rows: int
    prefix: str



class MissingSource(RuntimeError):
    """A raw table that has to be there has no files."""

# gzip text cannot be split, so one file is one read task: keep files to about this many rows.
ROWS_PER_FILE = 1_000_000


def _read_json(
    spark: SparkSession,
    schema: T.StructType,
    path: str | list[str],
    base: str | None = None,
    optional: bool = False,
) -> DataFrame:
    """JSON lines under a declared schema; with `optional`, an empty frame where there are none."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if not optional:
            raise MissingSource(str(path)) from error
        return spark.createDataFrame([], schema)


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    load_id: str | None = None,
    dates: Sequence[str] | None = None,
    optional: bool = False,
    files: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """A raw table under its declared schema.

    A declared schema needs no inference pass, gives typed NULLs for fields that some or all
    files lack, and with FAILFAST a value of the wrong JSON type stops the read. With a load id
    only that load's rows come back. `dates` are the partition dates the load wrote, as its
    ledger row says (`dates_of`): only these are listed and read, however long the history is;
    without them every date is. `files` are those the load's commit lists (`files_of`): with them
    nothing else is opened, however many other loads there are of the same date. A table without
    files, or without files of those dates or of that load, raises unless it is `optional`; then it
    is an empty frame.
    """
    known = set(schema.fieldNames())
    lineage = [T.StructField(LOAD_ID, T.StringType()), T.StructField(ROW_ID, T.StringType())]
    full = T.StructType(
        schema.fields
        + [f for f in lineage if f.name not in known]
        + [T.StructField("load_date", T.DateType())]
    )
    path = f"{root}/{table}"
    if load_id is None:
        return _read_json(spark, full, path, optional=optional)
    if files is not None:
        mine = [f"{root}/{f}" for f in files.get(table, ())]
        if not mine and not optional:
            raise MissingSource(f"{path} has no files of load {load_id}")
        if not mine:
            return spark.createDataFrame([], full)
        rows = _read_json(spark, full, mine, base=path)
    elif dates is None:
        rows = _read_json(spark, full, path, optional=optional)
    else:
        days = ",".join(sorted(set(dates)))
        rows = _read_json(spark, full, f"{path}/load_date={{{days}}}", base=path, optional=optional)
    return rows.filter(F.col(LOAD_ID) == load_id)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger; before the first load there is none, and it is empty."""
    return _read_json(spark, LEDGER_SCHEMA, f"{root}/{LEDGER}", optional=True)


def dates_of(ledger: DataFrame, load_id: str) -> list[str] | None:
    """The partition dates a load wrote, or None if a row of its does not tell."""
    rows = ledger.filter(F.col("load_id") == load_id).select("load_dates").collect()
    if not rows or any(not r["load_dates"] for r in rows):
        return None
    return sorted({d for r in rows for d in r["load_dates"]})


def _name(load_id: str) -> str:
    """A load's id as part of a file name; different ids never give the same."""
    return re.sub(r"[^A-Za-z0-9.]", lambda c: f"_{ord(c.group()):x}_", load_id)


def files_of(spark: SparkSession, root: str, load_id: str) -> dict[str, list[str]] | None:
    """The files of a committed load by table, below the root; None if its commit lists none."""
    listed = _read_json(spark, FILES_SCHEMA, f"{root}/{FILES}/{_name(load_id)}", optional=True).collect()
    files: dict[str, list[str]] = {}
    for row in listed:
        files.setdefault(row["table_name"], [])
        if row["path"] is not None:
            files[row["table_name"]].append(row["path"])
    return files or None


def append_rows(df: DataFrame, root: str, table: str, prefix: str = "part") -> None:
    """Append rows that already carry their lineage and `load_date`.

    Columns that are NULL are left out. Nulls inside nested values are data of the source and stay:
    the writer's own rule would drop them too, so nested values go through VARIANT, which holds at
    most 16 MiB per value and orders the keys of objects.
    """
    kept = {
        f.name: F.parse_json(nested_text(F.col(f"`{f.name}`")))
        for f in df.schema
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
    }
    (
        df.withColumns(kept)
        .write.mode("append")
        .option("mapreduce.output.basename", prefix)
        .partitionBy("load_date")
        .option("compression", "gzip")
        .option("ignoreNullFields", "true")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .json(f"{root}/{table}")
    )


def append_load(df: DataFrame, root: str, table: str, load_id: str, load_date: str) -> Landed:
    """Append one full re-snapshot of a table, stamped with its load.

    Row ids come from the row's content, so a task that runs twice writes the same ids. Rows are
    counted by the write itself, each task that succeeded once. Files are named by the load and by
    this very call: what an earlier attempt of the same load left is not part of it.
    """
    counted, prefix = Observation(), f"{_name(load_id)}-{uuid.uuid4().hex[:12]}"
    content = F.sha2(F.concat_ws("|", F.lit(load_id), F.to_json(F.struct(*df.columns))), 256)
    append_rows(
        df.withColumns(
            {
                ROW_ID: F.substring(content, 1, 16),
                LOAD_ID: F.lit(load_id),
                "load_date": F.to_date(F.lit(load_date)),
            }
        ).observe(counted, F.count(F.lit(1)).alias("rows")),
        root,
        table,
        prefix,
    )
    return Landed(table, load_date, int(counted.get["rows"]), prefix)


def append_ledger(rows: DataFrame, root: str) -> None:
    """Append ledger rows; the fields that only this writer has may be missing."""
    names = LEDGER_SCHEMA.fieldNames()
    for name in OWN_FIELDS:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(LEDGER_SCHEMA[name].dataType))
    rows.select(*names).coalesce(1).write.mode("append").json(f"{root}/{LEDGER}")


def list_files(spark: SparkSession, root: str, load_id: str, landed: Sequence[Landed]) -> None:
    """Write the list of a load's files: those of the given writes, and no others of their dates."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    listed = []
    for part in landed:
        folder = path(f"{root}/{part.table}/load_date={part.load_date}/{part.prefix}-*")
        found = folder.getFileSystem(hadoop).globStatus(folder)
        names = [s.getPath().getName() for s in found] if found is not None else []
        if part.rows and not names:
            raise MissingSource(f"{folder.toString()} has no files")
        rows = [f"{part.table}/load_date={part.load_date}/{n}" for n in names]
        listed += [(part.table, r) for r in rows] or [(part.table, None)]
    rows = spark.createDataFrame(listed, FILES_SCHEMA).coalesce(1)
    rows.write.mode("overwrite").json(f"{root}/{FILES}/{_name(load_id)}")


def commit_load(
    spark: SparkSession,
    root: str,
    load_id: str,
    schema_name: str,
    inserted_at: str,
    dates: Sequence[str] = (),
    landed: Sequence[Landed] = (),
) -> None:
    """Make a load visible. Call it after every table of the load has been written, with what the
    writes returned; their files and row counts go on record and a reader opens exactly these.

    A load that something else has written is committed with all the dates it was written under.
    """
    dates = sorted({*dates, *(part.load_date for part in landed)})
    if not dates:
        raise ValueError(f"load {load_id} is committed without its dates")
    counts: dict[str, int] = {}
    for part in landed:
        counts[part.table] = counts.get(part.table, 0) + part.rows
    if landed:
        list_files(spark, root, load_id, landed)
    row = [(load_id, schema_name, COMMITTED, inserted_at, None, dates, sorted(counts.items()) or None)]
    append_ledger(spark.createDataFrame(row, LEDGER_SCHEMA), root)


def ledger_row_counts(ledger: DataFrame, load_id: str | None = None) -> DataFrame:
    """Rows per table of a load (or per load) as counted while writing; no raw table is read.

    Bookkeeping tables are left out; the total is the row whose table is NULL. A load whose writer
    did not count has no rows here.
    """
    rows = ledger if load_id is None else ledger.filter(F.col("load_id") == load_id)
    each = rows.select("load_id", F.inline("row_counts")).filter(~F.col("table_name").startswith(BOOKKEEPING))
    return (
        each.rollup("load_id", "table_name").agg(F.sum("row_count").alias("row_count")).filter(F.col("load_id").isNotNull())
    )


def row_counts(tables: Mapping[str, DataFrame], load_id: str | None = None) -> DataFrame:
    """Rows per table of a load (or per load), bookkeeping tables left out, and their total.

    The total is the row whose table is NULL. Each table is counted on its own scan.
    """
    parts = None
    for name, df in tables.items():
        if name.startswith(BOOKKEEPING):
            continue
        rows = df if load_id is None else df.filter(F.col(LOAD_ID) == load_id)
        counted = rows.groupBy(F.col(LOAD_ID).alias("load_id")).agg(
            F.count(F.lit(1)).alias("row_count")
        )
        part = counted.withColumn("table_name", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    return (
        parts.groupBy("load_id", "table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .rollup("load_id", "table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .filter(F.col("load_id").isNotNull())
    )
