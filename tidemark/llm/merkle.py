"""A Merkle manifest of a table: an append log of tree nodes in postorder, and proofs read from it.

Each part of the table (a language, say) is one tree over its rows in the order of their ids; the
parts' roots, in the order of the parts, are the leaves of the last tree. While a level has more
than one node, every two consecutive nodes become their hash, and so does a last one alone.

Nodes are logged when they complete, which is postorder. Rows are dealt to aligned blocks of
2^`bits` leaves. The builder of a block appends a leaf, then every node that the leaf completes,
and needs nothing from other blocks. Tops of blocks are the leaves of the next tier, built alike,
until one block holds a whole tree. So a log is a list of segments, and the place of any node is
known without reading one: the node over leaves [s, e) at height h of a tree completes after the
2(e-1) - popcount(e-1) nodes that were complete before leaf e-1 came, after that leaf and the h-1
nodes below it. Siblings are fetched from these places, from the last tier down; a tier hands each
block below it the part of the proof that all its leaves share.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import numbered
from tidemark.llm.text import map_arrow, ship
from tidemark.session import staged

BLOCK_BITS = 10
_DIGEST = 32
_ALONE, _LEFT, _RIGHT = 0, 1, 2


def field(column: Column) -> Column:
    """A value as it enters a leaf: `-` for null, else its UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def parent(left: bytes, right: bytes | None = None) -> bytes:
    """The hash over the hex text of one or two digests."""
    return sha256((left.hex() + (right.hex() if right is not None else "")).encode()).digest()


def height(leaves: int) -> int:
    return (leaves - 1).bit_length()


def place(level: int, index: int, leaves: int) -> int:
    """Where the log of a tree of so many leaves has node `index` of a level."""
    last = min(leaves, (index + 1) << level) - 1
    return 2 * last - last.bit_count() + level


def append_all(leaves: list[bytes], levels: int) -> list[bytes]:
    """The nodes of a tree in the order they complete, up to the given level."""
    log: list[bytes] = []
    open_: list[tuple[int, bytes]] = []

    def add(level: int, digest: bytes) -> None:
        log.append(digest)
        open_.append((level, digest))

    for leaf in leaves:
        add(0, leaf)
        while len(open_) > 1 and open_[-1][0] == open_[-2][0]:
            (level, right), (_, left) = open_.pop(), open_.pop()
            add(level + 1, parent(left, right))
    while len(open_) > 1 or open_[0][0] < levels:
        level, digest = open_.pop()
        if open_ and open_[-1][0] == level:
            add(level + 1, parent(open_.pop()[1], digest))
        else:
            add(level + 1, parent(digest))
    return log


def steps(log: bytes, leaves: int, levels: int, index: int) -> bytes:
    """The siblings of a leaf, upwards: for each level a side and a digest (zeros if alone)."""
    out = []
    for level in range(levels):
        other = (index >> level) ^ 1
        if other << level >= leaves:
            out.append(bytes([_ALONE]) + bytes(_DIGEST))
            continue
        at = place(level, other, leaves) * _DIGEST
        out.append(bytes([_LEFT if other & 1 == 0 else _RIGHT]) + log[at : at + _DIGEST])
    return b"".join(out)


def siblings(path: bytes) -> list[bytes]:
    """The digests of a path, without the levels where the node is alone."""
    size = _DIGEST + 1
    return [path[i + 1 : i + size] for i in range(0, len(path), size) if path[i] != _ALONE]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for i in range(0, len(path), _DIGEST + 1):
        side, other = path[i], path[i + 1 : i + 1 + _DIGEST]
        leaf = parent(leaf) if side == _ALONE else parent(other, leaf) if side == _LEFT else parent(leaf, other)
    return leaf


def _builder(bits: int):
    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("rank")
        size = block["size"][0].as_py()
        log = append_all(block["digest"].to_pylist(), min(bits, height(size)))
        row = [
            block["part"].slice(0, 1).combine_chunks(),
            pa.array([block["rank"][0].as_py() >> bits], pa.int64()),
            pa.array([size], pa.int64()),
            pa.array([block["key"].to_pylist()], pa.list_(block.schema.field("key").type)),
            pa.array([block["claim"].to_pylist()], pa.list_(pa.binary())),
            pa.array([b"".join(log)], pa.binary()),
            pa.array([log[-1]], pa.binary()),
        ]
        names = ["part", "block", "size", "keys", "claims", "log", "top"]
        arrays = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in row]
        return pa.Table.from_arrays(arrays, names=names)

    return build


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


class _Forest:
    """The trees of all parts: one table of log segments for each tier."""

    def __init__(self, leaves: DataFrame, bits: int) -> None:
        self.bits, self.tiers = bits, []
        ship(leaves.sparkSession)
        order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("salt")]
        rows = numbered(leaves, "part", order, "merkle-order")
        while True:
            schema = (
                f"part {_kind(rows, 'part')}, block long, size long, keys array<{_kind(rows, 'key')}>, "
                "claims array<binary>, log binary, top binary"
            )
            grouped = rows.groupBy("part", F.shiftright("rank", bits).alias("block"))
            tier = staged(grouped.applyInArrow(_builder(bits), schema), "merkle-log")
            self.tiers.append(tier)
            if not (tier.agg(F.max("block")).first()[0] or 0):
                break
            rows = tier.select(
                "part",
                F.lit(None).cast("long").alias("key"),
                F.col("top").alias("digest"),
                F.lit(None).cast("binary").alias("claim"),
                F.col("block").alias("rank"),
                F.shiftright(F.col("size") + ((1 << bits) - 1), bits).alias("size"),
            )

    def tops(self) -> DataFrame:
        """The root of each part's tree."""
        return self.tiers[-1].select("part", F.col("top").alias("subroot"))

    def paths(self, above: DataFrame) -> DataFrame:
        """Adds to each segment of the first tier what lies above it: the path of its top to the
        root, and the roots. `above` has part, path, subroot and root for the trees' roots."""
        above = above.withColumn("child", F.lit(0).cast("long"))
        for t in range(len(self.tiers) - 1, -1, -1):
            up = above.select(F.col("part").alias("u_part"), "child", "path", "subroot", "root")
            same = F.col("part").eqNullSafe(F.col("u_part")) & (F.col("block") == F.col("child"))
            segments = self.tiers[t].join(up, same).drop("u_part", "child")
            if t == 0:
                return segments
            schema = f"part {_kind(segments, 'part')}, child long, path binary, subroot binary, root binary"
            above = map_arrow(segments.drop("keys", "claims", "top"), _hand_down(self.bits), schema)
        raise AssertionError("a forest has one tier at least")


def _leaves_of(block: int, size: int, bits: int) -> int:
    return min(1 << bits, size - (block << bits))


def _hand_down(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                n, levels = _leaves_of(row["block"], row["size"], bits), min(bits, height(row["size"]))
                paths = [steps(row["log"], n, levels, c) + row["path"] for c in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([i] * n)),
                        pa.array([(row["block"] << bits) + c for c in range(n)], pa.int64()),
                        pa.array(paths, pa.binary()),
                        pa.array([row["subroot"]] * n, pa.binary()),
                        pa.array([row["root"]] * n, pa.binary()),
                    ],
                    names=["part", "child", "path", "subroot", "root"],
                )

    return run


def _prove(bits: int, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, levels = _leaves_of(row["block"], row["size"], bits), min(bits, height(row["size"]))
                log, keys = row["log"], batch.schema.field("keys").type.value_type
                leaf, proof, folded, given = [], [], [], []
                for i in range(n):
                    at = place(0, i, n) * _DIGEST
                    leaf.append(log[at : at + _DIGEST])
                    path = steps(log, n, levels, i) + row["path"]
                    given.append([x.hex() for x in siblings(path)])
                    proof.append(sha256("".join(given[-1]).encode()).hexdigest())
                    claim = row["claims"][i]
                    folded.append(fold(leaf[-1] if claim is None else claim, path))
                columns = {
                    "key": pa.array(row["keys"], keys),
                    "leaf": pa.array([x.hex() for x in leaf]),
                    "subroot": pa.array([row["subroot"].hex()] * n),
                    "root": pa.array([row["root"].hex()] * n),
                    "proof_sha256": pa.array(proof),
                    "folded_root": pa.array([x.hex() for x in folded]),
                    "verified": pa.array([x == row["root"] for x in folded]),
                }
                if full:
                    columns["position"] = pa.array([(row["block"] << bits) + i for i in range(n)], pa.int64())
                    columns["siblings"] = pa.array(given, pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


class Manifest:
    """The Merkle manifest of a table.

    A leaf is the hash of `fields` of a row. `claims` may give other values for some columns, as
    someone else says the row is; a claim that changes nothing is the row itself. Nulls are values
    of their own in fields, ids and parts (the null part comes first, strings in UTF-8 order); an
    empty text is not a null one. Rows of one part and id are ordered by their leaf, so repeated
    rows are neighbours that cannot be told apart. An empty table has no trees and no rows. Other
    columns, whatever their names, are not read.
    """

    def __init__(
        self,
        docs: DataFrame,
        fields: tuple[str, ...],
        id_col: str = "doc_id",
        part_col: str = "lang",
        claims: dict[str, Column] | None = None,
        bits: int = BLOCK_BITS,
    ) -> None:
        self.id_col, self.part_col, self.bits = id_col, part_col, bits
        claims = claims or {}
        own = {c: F.col(f"`{c}`") for c in fields}
        leaf = F.sha2(F.concat(*[field(own[c]) for c in fields]), 256)
        other = F.lit(False)
        for c, value in claims.items():
            other = other | ~value.eqNullSafe(own[c])
        said = F.sha2(F.concat(*[field(claims.get(c, own[c])) for c in fields]), 256)
        leaves = staged(
            docs.select(
                F.col(f"`{part_col}`").alias("part"),
                F.col(f"`{id_col}`").alias("key"),
                F.unhex(leaf).alias("digest"),
                F.when(other, F.unhex(said)).alias("claim"),
                F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("salt"),
            ),
            "merkle-leaves",
        )
        self.trees = _Forest(leaves, bits)
        tops = self.trees.tops()
        roots = tops.select(
            F.lit(0).alias("part"),
            F.col("part").alias("key"),
            F.col("subroot").alias("digest"),
            F.lit(None).cast("binary").alias("claim"),
            F.lit(0).cast("long").alias("salt"),
        )
        self.crown = _Forest(roots, bits)

    def root(self) -> DataFrame:
        """One row with the root of all, none for an empty table."""
        return self.crown.tops().select(F.lower(F.hex("subroot")).alias("root"))

    def _proved(self, full: bool) -> DataFrame:
        kind = _kind(self.crown.tiers[0].select(F.explode("keys").alias("k")), "k")
        none = F.lit(b"").cast("binary")
        ends = self.crown.tops().select("part", none.alias("path"), "subroot", F.col("subroot").alias("root"))
        above = map_arrow(
            self.crown.paths(ends), _subroot_paths(self.bits), f"part {kind}, path binary, subroot binary, root binary"
        )
        segments = self.trees.paths(staged(above, "merkle-roots"))
        key = _kind(self.trees.tiers[0].select(F.explode("keys").alias("k")), "k")
        schema = f"key {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        if full:
            schema += ", position long, siblings array<string>"
        proved = map_arrow(segments.drop("part", "top"), _prove(self.bits, full), schema)
        return proved.select(F.col("key").alias(self.id_col), *[c for c in proved.columns if c != "key"])

    def proofs(self) -> DataFrame:
        """For each row its leaf, its position in its part, the siblings up to the root, and whether
        the claimed row leads to the root."""
        return self._proved(True)

    def report(self) -> DataFrame:
        """The proofs with their siblings as one hash."""
        return self._proved(False)


def _subroot_paths(bits: int):
    """Segments of the crown as parts with the path of their subroot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, levels, log = _leaves_of(row["block"], row["size"], bits), min(bits, height(row["size"])), row["log"]
                at = [place(0, i, n) * _DIGEST for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["keys"], batch.schema.field("keys").type.value_type),
                        pa.array([steps(log, n, levels, i) + row["path"] for i in range(n)], pa.binary()),
                        pa.array([log[a : a + _DIGEST] for a in at], pa.binary()),
                        pa.array([row["root"]] * n, pa.binary()),
                    ],
                    names=["part", "path", "subroot", "root"],
                )

    return run


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered(id_col: str = "doc_id", count_col: str = "n_chars") -> dict[str, Column]:
    """One more character claimed for the rows whose id's checksum 7 divides."""
    hit = F.crc32(F.col(f"`{id_col}`").cast("string")) % 7 == 0
    count = F.col(f"`{count_col}`")
    return {count_col: F.when(hit, count + 1).otherwise(count)}
