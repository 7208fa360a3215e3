"""Removal of lines that many documents share, by two Bloom filters and an exact second look.

Pass 1 reads every line of every document and fills two Bloom filters, one of line hashes seen
in a document, one of hashes seen in at least two. Tasks send their filters in pieces, and the
pieces of equal place are merged: what is in `once` of two tasks is in `twice` of the result.
Pass 2 asks the `twice` filter: only suspected repeats are shuffled, as (128-bit key, documents,
first occurrence), summed before they move. That gives the exact keys to drop. Pass 3 cuts the
lines out of the texts.

A filter never misses a repeat, so the result is exact at every size; a filter that is too full
only lets more lines through to the exact look. Its size follows the number of input bytes up to
`MOST_BITS` (a broadcast of 32 MB at the very most).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import byte_values, map_arrow, signed, slices, span_hashes
from tidemark.session import staged

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
PIECE_BYTES = 1 << 16
# Up to so many confirmed keys travel to every task (16 bytes each); more are joined.
BROADCAST_KEYS = 1 << 21

_NAMES = ("line-a", "line-b")
_TABLES = [byte_values(n) for n in _NAMES]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def line_keys(data: np.ndarray, offsets: np.ndarray):
    """(row, place, hash a, hash b) of the lines of whole rows that have a key of one code point or more.

    The key is the line without [\\x20\\x09-\\x0D] at its ends, A-Z in lower case.
    """
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    # Line starts: each row's start and what follows a break; ends accordingly.
    rows = np.arange(len(offsets) - 1)
    of_break = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([rows, of_break])
    order = np.lexsort((starts, row))
    starts, row = starts[order], row[order]
    counts = np.bincount(row, minlength=len(rows)) if len(rows) else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = offsets[1:-1]
    if len(ends):
        ends[-1] = n
    place = np.arange(len(starts)) - first[row]
    # Trim: the first and the last byte of a line that are not blank.
    solid = np.flatnonzero(~_BLANK[data])
    low = np.searchsorted(solid, starts)
    high = np.searchsorted(solid, ends) - 1
    keyed = high >= low
    begin, end = solid[low[keyed]], solid[high[keyed]] + 1
    a, b = (span_hashes(data, begin, end, t) for t in _TABLES)
    return row[keyed], place[keyed], a, b, counts


def _distinct_in_rows(row, place, a, b):
    """The first of each key's lines in each row."""
    order = np.lexsort((place, b, a, row))
    row, place, a, b = row[order], place[order], a[order], b[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return row[new], place[new], a[new], b[new]


def _places(a: np.ndarray, b: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three bits per key."""
    step = b | np.uint64(1)
    return [((a + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(3)]


def _holds(packed: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(a), bool)
    for at in _places(a, b, bits):
        found &= (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


class _Filters:
    """Two Bloom filters as bytes; `add` takes the distinct keys of one document after another."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    @staticmethod
    def _set(packed: np.ndarray, places: list[np.ndarray]) -> None:
        for at in places:
            np.bitwise_or.at(packed, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        again |= _holds(self.once, a, b, self.bits)
        self._set(self.twice, _places(a[again], b[again], self.bits))
        self._set(self.once, _places(a, b, self.bits))


def _fill(bits: int, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _Filters(bits)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(text)):
                row, place, a, b, _ = line_keys(data, offsets)
                _, _, a, b = _distinct_in_rows(row, place, a, b)
                filters.add(a, b)
        codec = pa.Codec("zstd")
        step = min(PIECE_BYTES, bits // 8)
        for i in range(0, bits // 8, step):
            once, twice = filters.once[i : i + step], filters.twice[i : i + step]
            if once.any():
                packed = codec.compress(once.tobytes() + twice.tobytes(), asbytes=True)
                yield pa.record_batch({"piece": pa.array([i // step]), "body": pa.array([packed], pa.binary())})

    return run


def _merge(step: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        once, twice = np.zeros(step, np.uint8), np.zeros(step, np.uint8)
        for batch in batches:
            for body in batch.column("body"):
                both = np.frombuffer(codec.decompress(body.as_py(), 2 * step, asbytes=True), np.uint8)
                twice |= both[step:] | (once & both[:step])
                once |= both[:step]
        packed = codec.compress(twice.tobytes(), asbytes=True)
        yield pa.record_batch({"piece": pa.array([key[0].as_py()]), "body": pa.array([packed], pa.binary())})

    return run


def filter_of_repeats(texts: DataFrame, bits: int) -> np.ndarray:
    """The `twice` filter over all documents of a one-column frame, as bytes."""
    step = min(PIECE_BYTES, bits // 8)
    pieces = map_arrow(texts, _fill(bits, 0), "piece long, body binary")
    merged = pieces.groupBy("piece").applyInArrow(_merge(step), "piece long, body binary")
    packed, codec = np.zeros(bits // 8, np.uint8), pa.Codec("zstd")
    for piece, body in merged.toLocalIterator():
        got = codec.decompress(bytes(body), step, asbytes=True)
        packed[piece * step : (piece + 1) * step] = np.frombuffer(got, np.uint8)
    return packed


def _suspects(bits: int, filters):
    """Per key and batch: in how many documents, and where first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = filters.value
        for batch in batches:
            ids = batch.column(0)
            found = []
            for low, _, data, offsets in slices(batch.column(1)):
                row, place, a, b, _ = line_keys(data, offsets)
                held = _holds(packed, a, b, bits)
                row, place, a, b = _distinct_in_rows(row[held], place[held], a[held], b[held])
                found.append((row + low, place, a, b))
            if not found:
                continue
            row, place, a, b = (np.concatenate(x) for x in zip(*found))
            if not len(row):
                continue
            number = _numbers(ids)[row]
            order = np.lexsort((place, number, b, a))
            a, b, number, place = a[order], b[order], number[order], place[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(new)
            yield pa.record_batch(
                {
                    "a": signed(a[at]),
                    "b": signed(b[at]),
                    "docs": pa.array(np.diff(np.append(at, len(a)))),
                    "first_doc": pa.array(number[at]),
                    "first_line": pa.array(place[at]),
                }
            )

    return run


def _cut(lines: list[bytes], drop: list[int]) -> list[bytes]:
    gone = set(drop)
    return [x for i, x in enumerate(lines) if i not in gone]


class _KeyTable:
    """Sorted keys that every task has."""

    def __init__(self, keys) -> None:
        self.a, self.b, self.doc, self.line = keys

    def hits(self, x: np.ndarray, y: np.ndarray, number: np.ndarray | None, place: np.ndarray) -> np.ndarray:
        """Which occurrences go. `number` holds their documents if the first occurrence stays."""
        hit = np.zeros(len(x), bool)
        at = np.searchsorted(self.a, x)
        # Keys with equal first halves are next to each other; the second half decides.
        todo = np.arange(len(x))
        while len(todo):
            todo = todo[at[todo] < len(self.a)]
            todo = todo[self.a[at[todo]] == x[todo]]
            same = self.b[at[todo]] == y[todo]
            hit[todo[same]] = True
            todo = todo[~same]
            at[todo] += 1
        if number is not None:
            found = np.flatnonzero(hit)
            k = at[found]
            hit[found] = ~((self.doc[k] == number[found]) & (self.line[k] == place[found]))
        return hit


def _numbers(ids: pa.Array) -> np.ndarray:
    """Document ids as longs, null last."""
    return np.asarray(ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).max))


def _strip(names: list[str], id_col: str, text_col: str, keys, keep_first: bool, digest: bool):
    """Cut the lines out of whole rows. `keys`: a broadcast key table, or None if the last column
    lists each row's lines to cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _KeyTable(keys.value) if keys is not None else None
        for batch in batches:
            column, ids = batch.column(names.index(text_col)), batch.column(names.index(id_col))
            texts, totals, drops = [], [], []
            for low, high, data, offsets in slices(column):
                row, place, a, b, counts = line_keys(data, offsets)
                if table is not None:
                    number = _numbers(ids.slice(low, high - low))[row] if keep_first else None
                    hit = table.hits(a, b, number, place)
                    row, place = row[hit], place[hit]
                else:
                    lists = batch.column(len(names)).slice(low, high - low)
                    row = np.asarray(pa.compute.list_parent_indices(lists)).astype(np.int64)
                    place = np.asarray(pa.compute.list_flatten(lists))
                edge = np.searchsorted(row, np.arange(high - low + 1))
                raw = data.tobytes()
                for i in range(high - low):
                    body = raw[offsets[i] : offsets[i + 1]]
                    if edge[i] < edge[i + 1]:
                        body = b"\n".join(_cut(body.split(b"\n"), place[edge[i] : edge[i + 1]].tolist()))
                    texts.append(body)
                totals.append(counts)
                drops.append(np.diff(edge))
            total = np.concatenate([np.zeros(0, np.int64), *totals]).astype(np.int64)
            dropped = np.concatenate([np.zeros(0, np.int64), *drops]).astype(np.int64)
            if digest:
                out = {
                    "doc_id": ids,
                    "n_lines": pa.array(total),
                    "n_dropped": pa.array(dropped),
                    "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                }
            else:
                out = {n: batch.column(i) for i, n in enumerate(names)}
                new = pa.array(texts, pa.binary()).cast(pa.string())
                out[text_col] = pa.compute.if_else(pa.array(dropped == 0), column.cast(pa.string()), new)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def _occurrences(bits: int, filters):
    """Every line that may be a repeat, with its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in slices(batch.column(1)):
                row, place, a, b, _ = line_keys(data, offsets)
                held = _holds(filters.value, a, b, bits)
                at = pa.array(row[held] + low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(place[held]), signed(a[held]), signed(b[held])],
                    names=["id", "body", "place", "a", "b"],
                )

    return run


def filter_bits(docs: DataFrame) -> int:
    """A power of two from the planner's estimate of the input's bytes."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    bits = LEAST_BITS
    while bits < min(size // 8, MOST_BITS):
        bits *= 2
    return bits


def drop_repeated_lines(
    docs: DataFrame,
    least_docs: int = 10,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Documents without the lines whose key is found in `least_docs` documents or more.

    Lines are what stands between \\n. A key is the line without [\\x20\\x09-\\x0D] at both ends and
    with A-Z in lower case; lines without a key always stay. A key counts once per row, so two
    rows of one id count twice. With `keep_first` the key's first line in the document with the
    smallest id stays (rows that repeat this id keep it too; a null id comes last).

    Returns all columns, the texts without those lines; a text that loses nothing is unchanged, a
    null text stays null and counts as one empty line. With `digest`: id, n_lines, n_dropped and
    kept_sha256 instead. Equal rows are treated alike; an empty table gives an empty result.
    Columns other than the two named are carried, whatever they are called.
    """
    spark = docs.sparkSession
    bits = filter_bits(docs)
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    filters = spark.sparkContext.broadcast(filter_of_repeats(narrow.select("text"), bits))
    counted = map_arrow(
        narrow, _suspects(bits, filters), "a long, b long, docs long, first_doc long, first_line long"
    )
    keys = staged(
        counted.groupBy("a", "b")
        .agg(F.sum("docs").alias("docs"), F.min(F.struct("first_doc", "first_line")).alias("first"))
        .filter(F.col("docs") >= least_docs)
        .select("a", "b", "first.first_doc", "first.first_line"),
        "line-keys",
    )
    if digest:
        docs = narrow.select(F.col("id").alias(id_col), F.col("text").alias(text_col))
    names = docs.columns
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" if digest else docs.schema
    if keys.count() <= broadcast_keys:
        found = keys.toArrow().sort_by("a")
        columns = [found.column(i).to_numpy() for i in range(4)]
        order = np.argsort(columns[0].view(np.uint64), kind="stable")
        a, b, doc, line = (c[order] for c in columns)
        table = spark.sparkContext.broadcast((a.view(np.uint64), b.view(np.uint64), doc, line))
        return map_arrow(docs, _strip(names, id_col, text_col, table, keep_first, digest), schema)
    # Too many keys to send everywhere: join the suspected lines with them. What a row loses
    # depends on its id and its text alone, so those two carry the answer back to the row.
    body = F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)
    lines = map_arrow(
        narrow.withColumn("body", F.sha2(F.coalesce("text", F.lit("")), 256)),
        _occurrences(bits, filters),
        "id long, body string, place long, a long, b long",
    )
    lost = lines.join(keys, ["a", "b"])
    if keep_first:
        last = F.lit(np.iinfo(np.int64).max)
        lost = lost.filter(
            (F.coalesce("id", last) != F.col("first_doc")) | (F.col("place") != F.col("first_line"))
        )
    lost = lost.groupBy("id", "body").agg(F.array_sort(F.collect_set("place")).alias("lost"))
    mine = docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)], body.alias("body"))
    key = F.col(f"c{names.index(id_col)}")
    wide = mine.join(lost, key.eqNullSafe(lost["id"]) & (mine["body"] == lost["body"]), "left").select(
        *[f"c{i}" for i in range(len(names))], F.coalesce("lost", F.array().cast("array<long>")).alias("lost")
    )
    return map_arrow(wide, _strip(names, id_col, text_col, None, keep_first, digest), schema)
