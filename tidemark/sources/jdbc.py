"""A relational system of record, snapshotted whole into raw tables over Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The schemas that are ingested by default, and the catalog query that finds
# their base tables. Views are derived data and stay out.
DEFAULT_SCHEMAS = ("app", "ops")
CATALOG = (
    "(select table_schema, table_name from information_schema.tables"
    " where table_type = 'BASE TABLE') catalog"
)


def raw_table_name(schema: str, table: str) -> str:
    """Schema-qualified with one underscore: two schemas may hold a table of the same name."""
    return f"{schema}_{table}"


def discover_tables(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    schemas: Iterable[str] = DEFAULT_SCHEMAS,
    catalog: str = CATALOG,
) -> list[tuple[str, str]]:
    """All base tables of the schemas, as (schema, table). None at all is a valid answer."""
    found = spark.read.jdbc(url, catalog, properties=dict(properties))
    wanted = found.filter(F.col("table_schema").isin(*schemas)).orderBy("table_schema", "table_name")
    return [(row["table_schema"], row["table_name"]) for row in wanted.collect()]


# A table of more rows is read in parallel, a task for about so many.
ROWS_PER_TASK = 1_000_000
# Cells of the histogram for each task: runs of cells make the tasks even.
CELLS_PER_TASK = 16


class UnsplittableTable(ValueError):
    """A large table without a whole-number column that could split it."""


def _split_column(schema: T.StructType) -> str | None:
    """The first column of whole numbers."""
    for field in schema:
        kind = field.dataType
        if isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0:
            return field.name
    return None


def _predicates(column: str, low: int, width: int, cells: list[tuple[int | None, int]], rows: int) -> list[str]:
    """Conditions that share out a column's values, each for about so many rows; null is one of its own.

    `cells` are (cell, rows) of a histogram whose cells are `width` wide from `low` on. The first
    and last conditions are open, so rows that came after the histogram arrive as well.
    """
    edges, held = [], 0
    for cell, count in sorted((c, n) for c, n in cells if c is not None):
        if held and held + count > rows:
            edges.append(low + cell * width)
            held = 0
        held += count
    if not edges:
        conditions = [f"{column} is not null"]
    else:
        conditions = [f"{column} < {edges[0]}"]
        conditions += [f"{column} >= {a} and {column} < {b}" for a, b in zip(edges, edges[1:])]
        conditions.append(f"{column} >= {edges[-1]}")
    return [*conditions, f"{column} is null"]


def split_by_data(
    spark: SparkSession, url: str, properties: Mapping[str, str], source: str, column: str | None, rows_per_task: int
) -> list[str] | None:
    """The conditions under which a table is read in parallel; None if it is small enough for one task.

    The database counts rows and finds the column's ends, then counts the rows of equal cells
    between them; both come back as a few rows. A value that most rows share stays in one task.
    """

    def ask(text: str) -> list:
        return spark.read.jdbc(url, f"({text}) asked", properties=dict(properties)).collect()

    ends = "" if column is None else f", min({column}) as lo, max({column}) as hi"
    [row] = ask(f"select count(*) as n{ends} from {source}")
    if row["n"] <= rows_per_task:
        return None
    if column is None:
        raise UnsplittableTable(f"{source} has {row['n']} rows and no column of whole numbers")
    if row["lo"] is None:
        return None
    low, high = int(row["lo"]), int(row["hi"])
    tasks = -(-row["n"] // rows_per_task)
    width = max(1, -(-(high - low + 1) // (tasks * CELLS_PER_TASK)))
    cell = f"floor(({column} - {low}) / {width}.0)"
    found = ask(f"select {cell} as cell, count(*) as n from {source} group by {cell}")
    cells = [(None if r["cell"] is None else int(r["cell"]), r["n"]) for r in found]
    return _predicates(column, low, width, cells, rows_per_task)


def read_snapshot(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    schema: str,
    table: str,
    split: tuple[str, int, int, int] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One table, whole. A table of more than `rows_per_task` rows is read in parallel along its
    first column of whole numbers, cut where the data says; without such a column it is refused.

    `split` is (column, lowest, highest, partitions) and cuts evenly without asking; rows outside
    the bounds still arrive, in the first and last partition.
    """
    source = f"{schema}.{table}"
    if split is not None:
        column, lowest, highest, partitions = split
        return spark.read.jdbc(
            url,
            source,
            column=column,
            lowerBound=lowest,
            upperBound=highest,
            numPartitions=partitions,
            properties=dict(properties),
        )
    whole = spark.read.jdbc(url, source, properties=dict(properties))
    conditions = split_by_data(spark, url, properties, source, _split_column(whole.schema), rows_per_task)
    if conditions is None:
        return whole
    return spark.read.jdbc(url, source, predicates=conditions, properties=dict(properties))


def jdbc_snapshot(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    schemas: Iterable[str] = DEFAULT_SCHEMAS,
    splits: Mapping[str, tuple[str, int, int, int]] | None = None,
    catalog: str = CATALOG,
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[str, DataFrame]:
    """Every discovered table under its raw name, ready for `append_load`. A JSON column arrives
    as one text column and stays one. Large tables are split by their data unless `splits` says how."""
    return {
        raw_table_name(schema, table): read_snapshot(
            spark, url, properties, schema, table, (splits or {}).get(f"{schema}.{table}"), rows_per_task
        )
        for schema, table in discover_tables(spark, url, properties, schemas, catalog)
    }
