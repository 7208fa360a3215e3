"""The typed layers: one Parquet dataset per model, all models of a build in a folder of their own.

A build writes its models into `_builds/<id>` and nothing is ever moved. What readers see is named
by a pointer: an empty file in `_published` whose name ends in the build's id. Creating it is one
step on any store, it is the last step of a build, and the greatest name counts. So a reader finds
one whole build or the one before it, whenever the writer dies.

A long text that many rows of a model share is stored once, in the model it comes from (`SHARED`),
and joined when the model is read: with fixtures and players both growing, a copy per player would
grow with their product.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUILDS, POINTERS = "_builds", "_published"


@dataclass(frozen=True)
class Shared:
    """A column that a model does not store: the value `source` of the row of another model of the
    same layer and build that `keys` name (own column to its column). Readers find it in front of
    the column `before`."""

    column: str
    model: str
    source: str
    keys: tuple[tuple[str, str], ...]
    before: str


# By layer and model.
SHARED = {
    ("gold", "mart_player_value"): Shared(
        "next_opponents",
        "mart_team_fixture_run",
        "opponents",
        (("team_id", "team_id"), ("planning_gameweek_id", "gameweek_id")),
        "is_blank_next_gameweek",
    ),
}


class ContractError(ValueError):
    """A frame does not have the columns and types its model promises."""


def check_contract(df: DataFrame, contract: T.StructType, model: str) -> None:
    """Compare names, order and types before a write; nullability is left to the data checks."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in contract]
    if found != wanted:
        missing = sorted(set(wanted) - set(found))
        extra = sorted(set(found) - set(wanted))
        raise ContractError(f"{model}: missing {missing}, unexpected {extra}")


@dataclass(frozen=True)
class Lake:
    """Where the layers are; `root` is a local folder or any URI Spark can write."""

    root: str

    def path(self, layer: str, model: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{model}"

    def write(
        self, df: DataFrame, layer: str, model: str, contract: T.StructType | None = None
    ) -> None:
        """Replace a model's dataset in this very folder. Running the same build again gives the
        same files' content.

        A build reads raw tables and writes typed ones, so no dataset is read while replaced.
        A column that the model shares (`SHARED`) is part of the contract but not written; the
        model it is stored in belongs to the same build.
        """
        if contract is not None:
            check_contract(df, contract, f"{layer}.{model}")
        if shared := SHARED.get((layer, model)):
            df = df.drop(shared.column)
        df.write.mode("overwrite").parquet(self.path(layer, model))

    def read(self, spark: SparkSession, layer: str, model: str) -> DataFrame:
        """A model as it is published now. For several models of one build, ask `current` once and
        read from what it gives."""
        return self.current(spark)._whole(spark, layer, model)

    def _whole(self, spark: SparkSession, layer: str, model: str) -> DataFrame:
        """A model of this very lake with the column it shares, which older builds have stored.

        Of the other model only the rows that are referred to are read together, one per key. A
        reader who does not want the column pays nothing: Spark leaves the join out.
        """
        stored = spark.read.parquet(self.path(layer, model))
        shared = SHARED.get((layer, model))
        if shared is None or shared.column in stored.columns:
            return stored
        other = spark.read.parquet(self.path(layer, shared.model))
        own, theirs = [k for k, _ in shared.keys], [F.col(k).alias(f"_{o}") for o, k in shared.keys]
        wanted = stored.select(*[F.col(k).alias(f"_{k}") for k in own]).distinct()
        values = (
            other.select(*theirs, F.col(shared.source).alias(shared.column))
            .join(wanted, [f"_{k}" for k in own], "left_semi")
            .groupBy(*[f"_{k}" for k in own])
            .agg(F.max(shared.column).alias(shared.column))
        )
        same = [F.col(k) == F.col(f"_{k}") for k in own]
        names = [n for c in stored.columns for n in ([shared.column, c] if c == shared.before else [c])]
        return stored.join(values, same, "left").select(*names)

    def aside(self) -> Lake:
        """The lake of a build to be, inside this one."""
        return self._build(uuid.uuid4().hex)

    def _build(self, name: str) -> Lake:
        return Lake(f"{self.root.rstrip('/')}/{BUILDS}/{name}")

    def _files(self, spark: SparkSession, *parts: str):
        """A path below the root and the file system it is on."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root.rstrip("/"), *parts]))
        return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def pointers(self, spark: SparkSession) -> list[str]:
        """Names of all publications, oldest first."""
        folder, files = self._files(spark, POINTERS)
        if not files.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(folder))

    def current(self, spark: SparkSession) -> Lake:
        """The lake of the build that is published; this lake itself if none is."""
        names = self.pointers(spark)
        return self._build(names[-1].split("-", 1)[1]) if names else self

    def published_schema(self, spark: SparkSession, layer: str, model: str) -> T.StructType | None:
        """The columns readers rely on, or None before the first build."""
        now = self.current(spark)
        path, files = now._files(spark, layer, model)
        if not files.exists(path):
            return None
        try:
            return now._whole(spark, layer, model).schema
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def publish(self, spark: SparkSession, built: Lake) -> None:
        """Let readers see a build: all of its models at once.

        Two builds published at the same moment leave one of them on top, whole.
        """
        name = built.root.rsplit("/", 1)[1]
        if built != self._build(name):
            raise ValueError(f"{built.root} is not a build of {self.root}")
        names = self.pointers(spark)
        number = int(names[-1].split("-", 1)[0]) + 1 if names else 1
        pointer, files = self._files(spark, POINTERS, f"{number:012d}-{name}")
        files.create(pointer, False).close()

    def retire(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Remove all published builds but the newest ones; returns the names of those removed.

        A reader that resolved an older build before may still be at work: keep enough of them.
        The pointer goes last, so a removal that died is taken up again by the next one.
        """
        if keep < 1:
            raise ValueError("the published build is kept")
        old = [name.split("-", 1)[1] for name in self.pointers(spark)]
        last = set(old[-keep:])
        gone = []
        for pointer in self.pointers(spark)[:-keep]:
            name = pointer.split("-", 1)[1]
            if name not in last:
                folder, files = self._files(spark, BUILDS, name)
                files.delete(folder, True)
                gone.append(name)
            mark, files = self._files(spark, POINTERS, pointer)
            files.delete(mark, False)
        return gone
