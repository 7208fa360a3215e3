"""Words, hashes and row slices of Arrow text columns, worked out on whole buffers.

The operators hand Arrow batches to these helpers inside Spark tasks. A batch is cut into
slices of about half a megabyte (one row at least, never part of a row), so the arrays stay small
however many rows a batch holds; a longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 19

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_ODD_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, also when only the driver's path was extended."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


_HELD: dict[tuple, object] = {}


def held(owner: str, key: tuple, make):
    """What a Python worker keeps from task to task for an operator: one thing at a time."""
    if (owner, *key) not in _HELD:
        _HELD.clear()
        _HELD[(owner, *key)] = make()
    return _HELD[(owner, *key)]


def _enter(owner: str) -> None:
    """A worker that goes on with another operator lets go of what the last one kept."""
    if any(k[0] != owner for k in _HELD):
        _HELD.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc keeps freed arrays otherwise, as long as the worker lives
        trim(0)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    owner = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _enter(owner)
        yield from function(batches)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def random_words(label: str, count: int) -> np.ndarray:
    """Fixed 64-bit constants drawn from a label."""
    raw = b"".join(hashlib.sha256(f"{label}:{i}".encode()).digest() for i in range((count + 3) // 4))
    return np.frombuffer(raw, _U)[:count].copy()


def byte_values(label: str, lower: bool = True) -> np.ndarray:
    """One random value per byte; with `lower`, A-Z share those of a-z."""
    table = random_words(label, 256)
    if lower:
        table[65:91] = table[97:123]
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up = np.full(size, _ODD)
        down = np.full(size, _ODD_INVERSE)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) through the values of `table`."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(table[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U) * _ODD)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column back to back, and each row's offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about `most` bytes."""
    data, offsets = utf8(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Starts, ends and rows of the longest runs of bytes marked in `inside`, row by row."""
    n = len(data)
    flag = inside[data]
    before = np.zeros(n, bool)
    before[1:] = flag[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = flag[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(flag & ~before)
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def windows(words: np.ndarray, rows: np.ndarray, size: int, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside one row, and the index of each run's first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[size - 1 :] == rows[:n])
    factors = random_words(label, size) | _U(1)
    total = np.zeros(n, _U)
    for j in range(size):
        total += words[j : j + n] * factors[j]
    return mix(total[at]), at


def sort_in_rows(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """The order that sorts by row, then by value."""
    order = np.argsort(values)
    small = rows.astype(np.uint16) if count < 1 << 16 else rows
    return order[np.argsort(small[order], kind="stable")]


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
