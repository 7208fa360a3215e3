"""Array expressions that Spark has no function for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


def sums_before(values: Column) -> Column:
    """For each number of an array of longs, the sum of those before it.

    Folding copies what it has gathered at every step, so the array is folded in chunks: the
    work grows with n * CHUNK + (n / CHUNK)^2 and not with n^2.
    """
    none = F.array().cast("array<bigint>")
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
        lambda i: F.slice(values, i * CHUNK + 1, F.lit(CHUNK)),
    )

    def inner(total: Column, chunk: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(total.alias("total"), none.alias("out")),
            lambda acc, x: F.struct(
                (acc["total"] + x).alias("total"), F.concat(acc["out"], F.array(acc["total"])).alias("out")
            ),
        )

    folded = F.aggregate(
        chunks,
        F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<array<bigint>>").alias("out")),
        lambda acc, chunk: F.transform(
            F.array(inner(acc["total"], chunk)),
            lambda done: F.struct(
                done["total"].alias("total"), F.concat(acc["out"], F.array(done["out"])).alias("out")
            ),
        )[0],
        lambda acc: F.flatten(acc["out"]),
    )
    return F.when(F.size(values) > 0, folded).otherwise(none)
