"""Near-duplicate vectors: a subspace pigeonhole join.

Unit vectors with a cosine of at least c are at a squared distance of at most 2 - 2c. A fixed
rotation spreads what distinguishes them over all coordinates; the rotated vectors are split
into blocks of some eight coordinates. If two vectors are that close, then in at least one block
their squared distance is within the block's share of it, in proportion to its coordinates.

Each block is joined by range on its own: a grid over its first coordinates, twice the block's
radius wide, has every vector in its own cell; the vector also looks into the neighbouring cells
that its ball reaches. Vectors of a cell travel in chunks of bounded size, so a crowded cell is
many pairs of chunks, not one task. More rows make a grid over more coordinates. The union of
the blocks' candidates is verified by the cosine of the whole vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.text import map_arrow
from tidemark.session import staged

BLOCK = 8
CHUNK = 2048
SLACK = 1e-5
MOST_GRID = 6

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(size: int) -> np.ndarray:
    """A fixed random rotation."""
    if size not in _ROTATIONS:
        draw = np.random.default_rng(size).standard_normal((size, size))
        _ROTATIONS[size] = np.linalg.qr(draw)[0]
    return _ROTATIONS[size]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(pa.compute.list_flatten(column).cast(pa.float64())).reshape(len(column), size)


def units(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _blocks(size: int) -> list[np.ndarray]:
    return np.array_split(np.arange(size), max(1, round(size / BLOCK)))


def _cells(size: int, distance: float, grid: int):
    """Blobs of (block, cell, side): side 0 has the cell's own vectors, side 1 those that look in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = np.asarray(batch.column("node"))
            turned = units(_matrix(batch.column("vector"), size)) @ rotation(size)
            out: list[tuple] = []
            for number, axes in enumerate(_blocks(size)):
                part = turned[:, axes]
                radius = np.sqrt(distance * len(axes) / size) + SLACK
                width, used = 2 * radius, min(grid, len(axes))
                low = np.floor((part[:, :used] - radius) / width).astype(np.int64)
                high = np.floor((part[:, :used] + radius) / width).astype(np.int64)
                home = np.floor(part[:, :used] / width).astype(np.int64)
                for choice in product((0, 1), repeat=used):
                    cell = np.where(np.array(choice, bool), high, low)
                    doubled = ((low == high) & np.array(choice, bool)).any(axis=1)
                    # How far the cell is, along the axes where it is not the vector's own.
                    gap = np.where(cell > home, cell * width - part[:, :used], 0.0)
                    gap = np.where(cell < home, part[:, :used] - home * width, gap)
                    reach = ~doubled & ((gap * gap).sum(axis=1) <= radius * radius)
                    _blobs(out, number, 1, cell, nodes, part, reach)
                _blobs(out, number, 0, home, nodes, part, np.ones(len(part), bool))
            block, cell, side, count, ids, body = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block, pa.int64()),
                    pa.array(cell, pa.int64()),
                    pa.array(side, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(body, pa.binary()),
                ],
                names=["block", "cell", "side", "n", "ids", "body"],
            )

    return run


def _blobs(out: list, number: int, side: int, cell: np.ndarray, nodes, part, some: np.ndarray) -> None:
    at = np.flatnonzero(some)
    if not len(at):
        return
    name = np.zeros(len(at), np.int64)
    for axis in range(cell.shape[1]):
        name = (name << 10) | (cell[at, axis] + 512)
    order = np.argsort(name, kind="stable")
    at, name = at[order], name[order]
    first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
    for a, b in zip(first, np.append(first[1:], len(at))):
        rows = at[a:b]
        out.append((number, int(name[a]), side, len(rows), nodes[rows].tobytes(), part[rows].astype(np.float32).tobytes()))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the blobs of a cell's side into chunks; rows come sorted by block, cell and side."""
    key, ids, bodies, held = None, [], [], 0

    def merged():
        return pa.RecordBatch.from_arrays(
            [*[pa.array([k], pa.int64()) for k in key], pa.array([b"".join(ids)], pa.binary()), pa.array([b"".join(bodies)], pa.binary())],
            names=["block", "cell", "side", "ids", "body"],
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("block", "cell", "side", "n", "ids", "body")]
        for block, cell, side, n, some, body in zip(*columns):
            if key is not None and (key != (block, cell, side) or held + n > CHUNK):
                yield merged()
                ids, bodies, held = [], [], 0
            key = (block, cell, side)
            ids.append(some)
            bodies.append(body)
            held += n
    if held:
        yield merged()


def _compare(size: int, distance: float):
    """Candidate pairs of two chunks of one cell."""
    shares = [distance * len(a) / size for a in _blocks(size)]
    widths = [len(a) for a in _blocks(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("ids", "other_ids"))
                x, y = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), np.float32).reshape(-1, widths[block])
                    for c in ("body", "other_body")
                )
                square = (y * y).sum(axis=1)
                for s in range(0, len(a), 256):
                    z = x[s : s + 256]
                    far = (z * z).sum(axis=1)[:, None] + square[None, :] - 2 * (z @ y.T)
                    p, q = np.nonzero(far <= shares[block] + SLACK)
                    p += s
                    keep = a[p] < b[q]
                    left.append(a[p[keep]])
                    right.append(b[q[keep]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"]
            )

    return run


def _verify(size: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (units(_matrix(batch.column(c), size)) for c in ("left", "right"))
            keep = (x * y).sum(axis=1) >= least if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


class NearVectors:
    """Links and classes of vectors with a cosine of at least `least`.

    A vector that is null, empty, zero or has a null or non-finite component is linked with
    nothing; vectors of different lengths are never linked. Equal vectors are one node with
    their number of rows. Repeated rows are vectors of their own. Other columns are not read. An
    empty table gives empty results.
    """

    def __init__(self, table: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> None:
        if not 0 < least <= 1:
            raise ValueError("the least cosine is in (0, 1]")
        self.id_col, self.least = id_col, least
        vector = F.col(f"`{vector_col}`").cast("array<double>")
        finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        sound = F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))
        # Adding zero makes one of the two zeros.
        plain = F.transform(vector, lambda x: x + F.lit(0.0))
        self.rows = table.select(F.col(f"`{id_col}`").alias("id"), F.when(sound, plain).alias("vector"))
        self.nodes = staged(
            self.rows.filter(F.col("vector").isNotNull())
            .groupBy("vector")
            .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
            .withColumn("node", F.monotonically_increasing_id()),
            "vectors",
        )
        sizes = self.nodes.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
        self.links = None
        for r in sizes:
            found = self._links(r["size"], r["n"])
            self.links = found if self.links is None else self.links.unionByName(found)

    def _links(self, size: int, count: int) -> DataFrame:
        distance = 2 - 2 * self.least
        grid = int(np.clip(np.ceil(np.log2(max(count, 1) / 4096)), 2, MOST_GRID))
        nodes = self.nodes.filter(F.size("vector") == size)
        schema = "block long, cell long, side long, n long, ids binary, body binary"
        blobs = map_arrow(nodes.select("node", "vector"), _cells(size, distance, grid), schema)
        chunks = staged(
            map_arrow(
                blobs.repartition("block", "cell", "side").sortWithinPartitions("block", "cell", "side"),
                _chunks,
                "block long, cell long, side long, ids binary, body binary",
            ),
            "vector-chunks",
        )
        own = chunks.filter("side = 0").drop("side")
        looking = chunks.filter("side = 1").select(
            "block", "cell", F.col("ids").alias("other_ids"), F.col("body").alias("other_body")
        )
        met = own.join(looking, ["block", "cell"])
        pairs = map_arrow(met, _compare(size, distance), "a long, b long").distinct()
        ends = [nodes.select(F.col("node").alias(c), F.col("vector").alias(v)) for c, v in (("a", "left"), ("b", "right"))]
        whole = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "left", "right")
        return staged(map_arrow(whole, _verify(size, self.least), "a long, b long"), "vector-links")

    def report(self) -> DataFrame:
        """id, n_links (other rows linked directly), component_id (the least id reachable, itself
        included) and kept (the row has that id), one row per row of the table."""
        links = self.links
        if links is None:
            nodes = self.nodes.select("node", "vector", F.col("first").alias("least"), (F.col("copies") - 1).alias("n"))
        else:
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            weights = self.nodes.select(F.col("node").alias("b"), "copies")
            degree = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
            found = staged(components(links), "vector-classes")
            named = self.nodes.join(found, "node", "left").join(degree, "node", "left")
            named = named.withColumn("component", F.coalesce("component", "node"))
            least = named.groupBy("component").agg(F.min("first").alias("least"))
            nodes = named.join(least, "component").select(
                "node", "vector", "least", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n")
            )
        return (
            self.rows.join(nodes, "vector", "left")
            .select(
                F.col("id").alias(self.id_col),
                F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("least", "id").cast("long").alias("component_id"),
            )
            .withColumn("kept", F.coalesce(F.col(self.id_col) == F.col("component_id"), F.lit(False)))
        )
