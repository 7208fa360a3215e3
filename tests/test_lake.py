"""Raw loads, the ledger, snapshots, typing and envelopes."""

import functools
import json
import os
import random
import re
import subprocess
import sys

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.functions import columns as fn
from tidemark.operators import snapshot
from tidemark.operators.conform import conform, fields
from tidemark.session import scratch_path
from tidemark.sources import bronze, envelope, jdbc
from tidemark.sources.layers import ContractError, Lake, check_contract

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])


def land(spark, root, load_id, date, ids, commit=True, dates=None):
    df = spark.createDataFrame([(i, None if i % 2 else f"n{i}") for i in ids], SCHEMA)
    bronze.append_load(df, root, "things", load_id, date)
    if commit:
        bronze.commit_load(spark, root, load_id, "test", f"{date}T01:00:00Z", dates or [date])


def test_snapshot_is_the_newest_committed_load(spark, tmp_path):
    """A vanished entity is gone, a dead run is not read, and ids order by number."""
    root = str(tmp_path)
    land(spark, root, "999999999.5", "2001-09-09", [1, 2, 3])
    land(spark, root, "1000000000.5", "2001-09-09", [2, 4])
    land(spark, root, "1000090000.5", "2001-09-10", [9], commit=False)
    ledger = bronze.read_ledger(spark, root)
    load_id = snapshot.latest_committed_load(ledger)
    assert load_id == "1000000000.5"
    table = bronze.read_table(spark, root, "things", SCHEMA, load_id)
    assert rows(table.select("id", "note")) == [(2, "n2"), (4, "n4")]
    assert rows(snapshot.snapshot_rows(bronze.read_table(spark, root, "things", SCHEMA), load_id).select("id")) == [(2,), (4,)]
    assert snapshot.committed_rows(bronze.read_table(spark, root, "things", SCHEMA), ledger).count() == 5


def test_a_load_of_many_dates_is_found_whole(spark, tmp_path):
    """A load written under dates days apart; with the ledger's dates, and without any."""
    root = str(tmp_path)
    days = ["2001-09-09", "2001-09-10", "2001-09-13", "2001-09-20"]
    for i, day in enumerate(days):
        land(spark, root, "1000079999.5", day, [i], commit=day == days[-1], dates=days)
    dates = bronze.dates_of(bronze.read_ledger(spark, root), "1000079999.5")
    assert dates == days
    for known in (dates, None):
        table = bronze.read_table(spark, root, "things", SCHEMA, "1000079999.5", known)
        assert rows(table.select("id")) == [(0,), (1,), (2,), (3,)]
    with pytest.raises(ValueError, match="without its dates"):
        bronze.commit_load(spark, root, "1000079999.5", "test", "2001-09-20T01:00:00Z", [])


def test_only_the_loads_dates_are_read(spark, tmp_path):
    root = str(tmp_path)
    for day in range(1, 9):
        land(spark, root, f"{999_993_600 + day * 86_400}.5", f"2001-09-{day + 8:02}", [day])
    load_id = f"{999_993_600 + 4 * 86_400}.5"
    dates = bronze.dates_of(bronze.read_ledger(spark, root), load_id)
    one = bronze.read_table(spark, root, "things", SCHEMA, load_id, dates)
    assert {f.rsplit("/", 2)[1] for f in one.inputFiles()} == {"load_date=2001-09-12"}
    every = snapshot.snapshot_rows(bronze.read_table(spark, root, "things", SCHEMA), load_id, dates=dates)
    assert "(load_date#" in every._jdf.queryExecution().optimizedPlan().toString()
    assert rows(every.select("id")) == [(4,)]


def test_a_loads_own_files_are_read(spark, tmp_path):
    """Fifty loads of one date and dead ones beside them: a reader opens one fiftieth, whatever
    other loads are committed."""
    root, day = str(tmp_path), "2001-09-09"
    for i in range(50):
        load_id = f"{1_000_000_000 + i}.5"
        df = spark.createDataFrame([(i * 100 + j, "x" * 50) for j in range(20)], SCHEMA).coalesce(1)
        if i == 7:
            # An attempt that died under the same id, and one of a load that never committed.
            bronze.append_load(df, root, "things", load_id, day)
            bronze.append_load(df, root, "things", f"{load_id}-1", day)
        landed = [bronze.append_load(df, root, "things", load_id, day)]
        if i in (7, 8):
            landed.append(bronze.append_load(df.limit(0), root, "nothing", load_id, day))
            bronze.commit_load(spark, root, load_id, "test", f"{day}T01:00:00Z", landed=landed)
    load_id = "1000000007.5"
    files = bronze.files_of(spark, root, load_id)
    one = bronze.read_table(spark, root, "things", SCHEMA, load_id, [day], files=files)
    everything = bronze.read_table(spark, root, "things", SCHEMA, load_id, [day])
    assert len(one.inputFiles()) == 1 and len(everything.inputFiles()) == 52
    assert rows(one.select("id")) == [(700 + j,) for j in range(20)]
    assert everything.count() == 40 and one.select("load_date").distinct().count() == 1
    size = {f: os.path.getsize(f.removeprefix("file://")) for f in everything.inputFiles()}
    assert sum(size[f] for f in one.inputFiles()) * 45 < sum(size.values())
    with pytest.raises(bronze.MissingSource):
        bronze.read_table(spark, root, "nothing", SCHEMA, load_id, files=files)
    assert bronze.read_table(spark, root, "nothing", SCHEMA, load_id, optional=True, files=files).count() == 0
    assert bronze.files_of(spark, root, "1000000001.5") is None


def test_loads_have_names_of_their_own():
    names = ["1.5", "1.5-1", "1_5", "1-5", "1_2d_5", "a/b", "a*b"]
    found = [bronze._name(n) for n in names]
    assert len(set(found)) == len(names) and all(re.fullmatch("[A-Za-z0-9._]+", f) for f in found)


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    root, load_id, day = str(tmp_path), "1000000000.5", "2001-09-09"
    df = spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS note").repartition(7)
    landed = [
        bronze.append_load(df, root, "a", load_id, day),
        bronze.append_load(df.limit(0), root, "b", load_id, day),
        bronze.append_load(df.filter("id < 30"), root, "a", load_id, "2001-09-10"),
        bronze.append_load(df, root, "_dlt_own", load_id, day),
    ]
    assert [x.rows for x in landed] == [1000, 0, 30, 1000]
    bronze.commit_load(spark, root, load_id, "test", f"{day}T01:00:00Z", landed=landed)
    bronze.commit_load(spark, root, "1000000001.5", "test", f"{day}T02:00:00Z", [day])
    counts = bronze.ledger_row_counts(bronze.read_ledger(spark, root))
    assert rows(counts) == sorted([(load_id, "a", 1030), (load_id, "b", 0), (load_id, None, 1030)], key=repr)
    assert rows(bronze.ledger_row_counts(bronze.read_ledger(spark, root), "1000000001.5")) == []
    read = {f.rsplit("/", 2)[1] for f in counts.inputFiles()}
    assert read == {bronze.LEDGER}


RETRIED = """
import sys
from pyspark.sql import SparkSession, functions as F, types as T
from pyspark import TaskContext
sys.path.insert(0, {repo!r})
from tidemark.sources import bronze

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate())

def fragile(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after its rows went out")

df = spark.range(0, 100, 1, 4).mapInArrow(fragile, "id long")
print("ROWS", bronze.append_load(df, {root!r}, "t", "1.5", "2001-09-09").rows, spark.read.json({root!r} + "/t").count())
"""


def test_a_retried_task_counts_once(tmp_path):
    """A task that fails after it has passed on all its rows is run again; its rows count once."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = RETRIED.format(repo=repo, root=str(tmp_path / "raw"))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240)
    assert "ROWS 100 100" in done.stdout, done.stderr[-2000:]


def test_null_fields_are_left_out_of_the_file(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, "1000000000.5", "2001-09-09", [1])
    line = spark.read.text(f"{root}/things").first()["value"]
    assert '"note"' not in line and '"_dlt_load_id":"1000000000.5"' in line
    assert list((tmp_path / "things" / "load_date=2001-09-09").glob("*.json.gz"))


def test_wrong_json_type_stops_the_read(spark, tmp_path):
    land(spark, str(tmp_path), "1000000000.5", "2001-09-09", [2])
    wrong = T.StructType([T.StructField("note", T.LongType())])
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        bronze.read_table(spark, str(tmp_path), "things", wrong).collect()


def test_only_an_optional_source_may_be_missing(spark, tmp_path):
    empty = bronze.read_table(spark, str(tmp_path), "nothing", SCHEMA, optional=True)
    assert empty.count() == 0 and "load_date" in empty.columns
    one = bronze.read_table(spark, str(tmp_path), "nothing", SCHEMA, "1000000000.5", optional=True)
    assert one.count() == 0
    with pytest.raises(bronze.MissingSource, match="nothing"):
        bronze.read_table(spark, str(tmp_path), "nothing", SCHEMA)
    with pytest.raises(bronze.MissingSource, match="nothing"):
        bronze.read_table(spark, str(tmp_path), "nothing", SCHEMA, "1000000000.5", ["2001-09-09"])
    assert snapshot.latest_committed_load(bronze.read_ledger(spark, str(tmp_path))) is None


def test_row_counts_leave_out_bookkeeping(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, "1000000000.5", "2001-09-09", [1, 2, 3])
    things = bronze.read_table(spark, root, "things", SCHEMA)
    counted = bronze.row_counts({"a": things, "b": things.limit(1), "_dlt_x": things}, "1000000000.5")
    got = {r["table_name"]: r["row_count"] for r in counted.collect()}
    assert got == {"a": 3, "b": 1, None: 4}


def test_contract_is_checked_before_a_write(spark, tmp_path):
    lake = Lake(str(tmp_path))
    df = spark.createDataFrame([(1, "x")], SCHEMA)
    lake.write(df, "silver", "things", SCHEMA)
    lake.write(df, "silver", "things", SCHEMA)
    assert rows(lake.read(spark, "silver", "things")) == [(1, "x")]
    with pytest.raises(ContractError, match="silver.things"):
        lake.write(df.drop("note"), "silver", "things", SCHEMA)
    with pytest.raises(ContractError):
        check_contract(df.withColumn("id", F.col("id").cast("int")), SCHEMA, "things")


def test_scratch_is_the_clusters_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# ---- Typing. ----


def test_strict_numbers(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("",), ("  ",), (None,)], "x string")
    got = df.select(fn.strict_number(F.col("x")).alias("y"))
    assert [r.y for r in got.collect()] == [1.5, 2.0, None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("abc",)], "x string").select(fn.strict_number(F.col("x"))).collect()


def test_optional_columns(spark):
    df = spark.createDataFrame([("7", "")], "Here string, blank string")
    got = df.select(
        fn.optional_column(df, "here", "bigint"),
        fn.optional_column(df, "blank", "double"),
        fn.optional_column(df, "gone", "double", "named"),
    )
    assert got.dtypes == [("here", "bigint"), ("blank", "double"), ("named", "double")]
    assert got.first() == (7, None, None)


def test_conform_keeps_its_schema_when_columns_come_and_go(spark):
    spec = fields("long", "id") + fields("number_text", ("ep", "expected")) + fields("json", "doc")
    raw = spark.createDataFrame([(1, "L")], "id long, _dlt_load_id string")
    bare = conform(raw, spec, "L")
    full = conform(
        raw.withColumns({"ep": F.lit(" 2.5 "), "doc": F.parse_json(F.lit('{"a": null}'))}), spec, "L"
    )
    assert bare.dtypes == full.dtypes
    assert rows(bare) == [(1, None, None, "L")]
    assert rows(full) == [(1, 2.5, '{"a":null}', "L")]
    assert conform(raw, spec, "other").count() == 0


def test_ratio_and_differs(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 2), (None, None)], "a long, b long")
    got = df.select(fn.ratio(F.col("a"), F.col("b")), fn.differs(F.col("a"), F.col("b")))
    assert [tuple(r) for r in got.collect()] == [(0.5, True), (None, True), (None, True), (None, False)]


def test_json_null_and_missing_key_differ(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": null}',), ("{}",)], "j string")
    got = df.select(fn.document_null(F.parse_json("j"), "$.a").alias("n"))
    assert [r.n for r in got.collect()] == [False, True, None]


# ---- Envelopes. ----


def test_a_missing_collection_costs_only_itself(spark):
    item = T.StructType([T.StructField("id", T.LongType())])
    docs = spark.createDataFrame([(1, '{"a": [{"id": 5}, {"id": 6}], "n": 3}')], "doc long, body string")
    wanted = {"a": item, "b": item}
    tables = envelope.split_envelope(docs, "body", wanted, ["doc"])
    assert rows(tables["a"]) == [(1, 5), (1, 6)] and tables["b"].count() == 0
    assert rows(envelope.missing_collections(docs, "body", wanted)) == [("b", 1)]
    meta = envelope.envelope_meta(docs, "body", T.StructType([T.StructField("n", T.LongType())]), ["doc"])
    assert rows(meta) == [(1, 3)]


def test_elements_carry_their_request(spark):
    docs = spark.createDataFrame(
        [(1, [(5,)]), (2, None), (3, [])], "event_id long, elements array<struct<id: long>>"
    )
    assert rows(envelope.stamp_parent(docs, "elements", "event_id")) == [(5, 1)]


# ---- JDBC, against a reader that answers from memory: no database is started. ----


class Reader:
    def __init__(self, tables, log):
        self.tables, self.log = tables, log

    def jdbc(self, url, table, **options):
        self.log.append((table, options))
        if table.endswith(" asked"):
            # A question to the database: answered by Spark over the table it names.
            text = table.removeprefix("(").removesuffix(") asked")
            source = text.split(" from ")[1].split(" ")[0]
            self.tables[source].createOrReplaceTempView("asked_table")
            return self.tables[source].sparkSession.sql(text.replace(source, "asked_table"))
        if "predicates" in options:
            parts = [self.tables[table].filter(p) for p in options["predicates"]]
            return functools.reduce(DataFrame.unionByName, parts)
        return self.tables[table]


class Session:
    def __init__(self, tables):
        self.log = []
        self.read = Reader(tables, self.log)


def test_tables_are_discovered_and_named_by_schema(spark):
    catalog = spark.createDataFrame(
        [("app", "raw"), ("ops", "raw"), ("public", "other")], "table_schema string, table_name string"
    )
    one = spark.createDataFrame([(1,)], "id long")
    session = Session({jdbc.CATALOG: catalog, "app.raw": one, "ops.raw": one})
    found = jdbc.jdbc_snapshot(session, "url", {"user": "u"}, splits={"app.raw": ("id", 1, 9, 4)})
    assert sorted(found) == ["app_raw", "ops_raw"]
    options = dict(session.log)["app.raw"]
    assert (options["column"], options["numPartitions"]) == ("id", 4)
    assert "column" not in dict(session.log)["ops.raw"]


def test_large_tables_are_split_where_their_data_lies(spark):
    """Every row once, in tasks of about the stated size, however crooked the column is."""
    rng = random.Random(2)
    crooked = [(None, "n")] * 5 + [(int(rng.paretovariate(0.7) * 100) - 300, "x") for _ in range(4000)] + [(10**12, "far")]
    table = spark.createDataFrame(crooked, "id long, note string").select("note", "id")
    session = Session({"app.t": table})
    got = jdbc.read_snapshot(session, "url", {}, "app", "t", rows_per_task=400)
    assert rows(got) == rows(table)
    [conditions] = [o["predicates"] for t, o in session.log if "predicates" in o]
    sizes = [table.filter(c).count() for c in conditions]
    assert sum(sizes) == len(crooked) and len(conditions) >= 3
    even = spark.range(10_000).select("id")
    session = Session({"app.t": even})
    assert jdbc.read_snapshot(session, "url", {}, "app", "t", rows_per_task=1000).count() == 10_000
    [conditions] = [o["predicates"] for t, o in session.log if "predicates" in o]
    assert max(even.filter(c).count() for c in conditions) <= 1000
    small = Session({"app.t": even})
    assert jdbc.read_snapshot(small, "url", {}, "app", "t").count() == 10_000
    assert not any("predicates" in o for _, o in small.log)
    with pytest.raises(jdbc.UnsplittableTable):
        jdbc.read_snapshot(Session({"app.t": table.select("note")}), "url", {}, "app", "t", rows_per_task=400)


def test_no_tables_is_success(spark):
    empty = spark.createDataFrame([], "table_schema string, table_name string")
    assert jdbc.jdbc_snapshot(Session({jdbc.CATALOG: empty}), "url", {}) == {}
    assert "BASE TABLE" in jdbc.CATALOG


def test_path_not_found_is_the_only_error_taken_for_absence(spark, tmp_path):
    with pytest.raises(AnalysisException):
        spark.read.schema(SCHEMA).json(f"{tmp_path}/none")


def test_nulls_inside_nested_values_are_landed(spark, tmp_path):
    """Only columns that are null as a whole are left out of a file; what lies inside them stays."""
    schema = "id long, gone string, doc struct<b:string,a:long>, many array<struct<n:long,s:string>>, free map<string,string>"
    data = [(1, None, (None, 2), [(None, "x"), (3, None)], {"k": None}), (2, None, None, [], {})]
    bronze.append_load(spark.createDataFrame(data, schema), str(tmp_path), "t", "1.0", "2024-01-01")
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/t").collect()]
    first, second = sorted(lines, key=lambda x: x["id"])
    assert first["doc"] == {"a": 2, "b": None} and first["free"] == {"k": None} and "gone" not in first
    assert first["many"] == [{"n": None, "s": "x"}, {"n": 3, "s": None}]
    assert "doc" not in second and second["many"] == [] and second["free"] == {}
    back = bronze.read_table(spark, str(tmp_path), "t", T._parse_datatype_string(schema), "1.0")
    assert rows(back.select("id", "gone", "doc", "many", "free")) == rows(spark.createDataFrame(data, schema))
