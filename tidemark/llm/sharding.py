"""Placement of rows on shards by a hierarchical weighted hash tree (native columns only).

A tree has regions, regions have racks, racks have shards, and only shards have weights of
their own; a rack or a region weighs what its shards weigh. A row descends the tree: at every
level each child draws an exponential variate, -ln(u) / weight, where u is a hash of the row's
key and the child's name, and the smallest draw wins. A child's draw depends on nothing but the
key, its own name and its own weight. So when weights change inside one subtree, rows move only
between that subtree and its siblings, and inside it; draws elsewhere stay as they were.

`grown` opens a new region for the new shard. At the top level the new region only takes rows
(no other draw changes) and it holds one shard, hence the law `key`: the key and the tree alone
decide, and one more shard takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class ShardTree:
    shards: tuple[Shard, ...]

    def __post_init__(self) -> None:
        if not self.shards or any(s.weight <= 0 for s in self.shards):
            raise ValueError("a tree needs shards, each with a positive weight")
        if len({s.number for s in self.shards}) < len(self.shards):
            raise ValueError("shard numbers must differ")

    @staticmethod
    def of(count: int, per_rack: int = 4, racks: int = 2) -> ShardTree:
        """`count` shards of equal weight, so many to a rack and so many racks to a region."""
        return ShardTree(
            tuple(
                Shard(f"region-{i // (per_rack * racks)}", f"rack-{i // per_rack}", i)
                for i in range(count)
            )
        )

    def grown(self, weight: float = 1.0) -> ShardTree:
        number = 1 + max(s.number for s in self.shards)
        new = Shard(f"region-of-{number}", f"rack-of-{number}", number, weight)
        return ShardTree((*self.shards, new))


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    return -F.log((bits + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(float(weight))


def _descend(key: Column, children: dict[str, list[Shard]], below) -> Column:
    """What `below` makes of the shards of the winning child."""
    if len(children) == 1:
        [(name, shards)] = children.items()
        return below(name, shards)
    names = list(children)
    draws = [
        F.struct(_draw(key, n, sum(s.weight for s in children[n])).alias("draw"), F.lit(i).alias("child"))
        for i, n in enumerate(names)
    ]
    winner = F.least(*draws)["child"]
    choice = F.when(winner == 0, below(names[0], children[names[0]]))
    for i, n in enumerate(names[1:], 1):
        choice = choice.when(winner == i, below(n, children[n]))
    return choice


def _grouped(shards, part) -> dict[str, list[Shard]]:
    groups: dict[str, list[Shard]] = {}
    for s in shards:
        groups.setdefault(part(s), []).append(s)
    return groups


def shard_of(key: Column, tree: ShardTree) -> Column:
    """The shard number of a key; a null key is a key like any other."""

    def leaf(_, shards):
        return F.lit(shards[0].number)

    def rack(name, shards):
        return _descend(key, _grouped(shards, lambda s: f"{name}/shard-{s.number}"), leaf)

    def region(name, shards):
        return _descend(key, _grouped(shards, lambda s: f"{name}/{s.rack}"), rack)

    return _descend(key, _grouped(tree.shards, lambda s: s.region), region)


def shard_rows(df: DataFrame, tree: ShardTree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, size, checksum and place of every row; the other columns are not looked at.

    Returns the key column, `size` (UTF-8 bytes plus 1), `text_crc32`, `law`, `shard`, `slot`
    (0, 1, 2 ... inside the shard) and `grown_shard` (the shard after one more joined). A null
    text counts as empty: size 1, checksum 0. Rows with a null key share one shard. Repeated
    rows each get a slot. An empty table gives an empty result.

    Slots are numbered in two levels: inside (shard, input partition), then with the counts of
    the partitions before. No window is wider than one input partition, whatever key is hot. The
    narrow columns are written to the shared folder once, so both levels see the same partitions.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow = staged(
        df.select(
            F.col(f"`{key}`").alias("key"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body).alias("text_crc32"),
            shard_of(F.col(f"`{key}`"), tree).alias("shard"),
            shard_of(F.col(f"`{key}`"), tree.grown()).alias("grown_shard"),
            F.spark_partition_id().alias("part"),
        ),
        "sharding",
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        narrow.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "part").orderBy("key", "text_crc32", "size")
    return (
        narrow.withColumn("place", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "part"])
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("place")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
