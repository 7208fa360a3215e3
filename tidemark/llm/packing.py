"""Packing of documents into training sequences, each filled with lexical neighbours.

Texts become token ids, written once to the shared folder. The rows are then dealt by range of a
lexical key (the least-hashed of the rarer ids of a document, twice), so that documents with
common rare ids come near each other; a row number as the last part of the key splits a hot key.
Every task reads its rows in that order and forms shards of bounded size.

A shard builds an inverted index of its documents and packs: a document of several windows fills
whole windows by itself; what is left of it is an item. An item not yet used is a seed. BM25
scores over the seed's terms (ids) order the unused items, which fill the window one after the
other; the last one is cut where the window ends, and its rest is the next seed. What does not
fill a window at the end of a shard goes on to the task's next shard. At the end of a task the
rest is cut into sequences of power-of-two lengths, so nothing is padded.

How rare an id is and how long documents are is counted over all documents, so a term weighs the
same in every shard; the weight is positive however common the id. A seed's candidates are the
items of its own shard only: README gives how many of the nearest documents these are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pretoken import byte_letters, pieces
from tidemark.llm.text import byte_values, held, map_arrow, mix, signed, slices, span_hashes
from tidemark.session import staged

WINDOW = 2048
# A shard is closed at so many ids or documents; a task gets about so many ids.
SHARD_IDS, SHARD_DOCS = 1 << 20, 1024
TASK_IDS = 1 << 22
# An id in more than one in so many items of a shard is a row of weights over all of them.
DENSE_PART = 4
# Ids under this are bytes and the first merges: too common to bring documents together.
COMMON_IDS = 2048
_TABLE = byte_values("token-piece", lower=False)
# Pieces remembered by a task's process: at most so many, with so many ids in all.
_SLOT_BITS = 19
_SLOTS = 1 << _SLOT_BITS
_POOL = 1 << 22


def _vocabulary(raw: bytes) -> tuple[dict[bytes, int], np.ndarray, list[tuple[str, int]]]:
    """Byte strings by the order of their merges, their ids, and the added tokens."""
    spec = json.loads(raw)
    letters = byte_letters()

    def as_bytes(word: str) -> bytes:
        return bytes(letters[c] for c in word)

    order = {bytes([b]): b for b in range(256)}
    for merge in spec["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        order.setdefault(as_bytes(left + right), len(order))
    added = [(t["content"], t["id"]) for t in spec.get("added_tokens", [])]
    names = {w for w, _ in added}
    ids = np.zeros(len(order), np.int32)
    for word, number in spec["model"]["vocab"].items():
        if word not in names:
            ids[order[as_bytes(word)]] = number
    return order, ids, added


class Encoder:
    """Ids of whole rows; equal pieces are merged once while the table remembers them."""

    def __init__(self, vocabulary: bytes, end_id: int) -> None:
        order, self.ids, added = _vocabulary(vocabulary)
        if len(added) > 1:
            raise ValueError("more than one special string")
        # The pieces are cut already: all of a piece is one match here, only merges are left.
        self.merge = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=order, special_tokens={})
        self.special, special_id = (added[0][0].encode(), added[0][1]) if added else (None, 0)
        self.lead = np.array([end_id, special_id], np.int32)
        self.highest = max(int(self.ids.max()), end_id, special_id)
        self._clear()

    def _clear(self) -> None:
        self.names = np.zeros(_SLOTS, np.uint64)
        self.spans = np.zeros(_SLOTS, np.int64)  # where in the pool, times 2^16, plus the length
        self.pool = np.zeros(_POOL, np.int32)
        self.pool[:2] = self.lead
        self.used = 2

    def _append(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = self.ids[np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum()))]
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(len(flat), np.int32)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        return at, size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of whole rows, an end id after each row, and the rows' edges."""
        if self.used > _POOL - len(data):
            self._clear()
        start, end, row, marked = pieces(data, offsets, self.special)
        names = span_hashes(data, start, end, _TABLE)
        slot = (names >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        missing = np.flatnonzero(self.names[slot] != names)
        span = self.spans[slot]
        at, size = span >> 16, span & 0xFFFF
        if len(missing):
            new, first, which = np.unique(names[missing], return_index=True, return_inverse=True)
            raw, first = data.tobytes(), missing[first]
            merge = self.merge.encode_ordinary
            got = [merge(raw[a:b].decode()) for a, b in zip(start[first].tolist(), end[first].tolist())]
            new_at, new_size = self._append(got)
            at[missing], size[missing] = new_at[which.reshape(-1)], new_size[which.reshape(-1)]
            place = (new >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
            fits = (self.names[place] == 0) & (new_size < 1 << 16)
            place = place[fits]
            self.names[place], self.spans[place] = new[fits], (new_at[fits] << 16) | new_size[fits]
        if marked.any():
            at[marked], size[marked] = 1, 1
        edge = np.searchsorted(row, np.arange(1, len(offsets)))
        at, size = np.insert(at, edge, 0), np.insert(size, edge, 1)
        stop = np.cumsum(size)
        source = np.repeat((at - (stop - size)).astype(np.int32), size)
        source += np.arange(len(source), dtype=np.int32)
        edges = np.concatenate([[0], stop[edge + np.arange(len(edge))]])
        return self.pool[source], edges


def _encoder(key: str, vocabulary, end_id: int) -> Encoder:
    return held(__name__, (key, end_id), lambda: Encoder(vocabulary.value, end_id))


def _encode(key: str, vocabulary, end_id: int, wide: bool):
    kind = np.uint32 if wide else np.uint16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, vocabulary, end_id)
        orders = []
        for salt in (1, 2):
            order = mix(np.arange(encoder.highest + 1, dtype=np.uint64) + np.uint64(salt << 32)) >> np.uint64(2)
            order[:COMMON_IDS] |= np.uint64(1 << 62)
            orders.append(order.view(np.int64))
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1)):
                ids, edges = encoder.encode(data, offsets)
                raw = ids.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                bodies = [raw[a * width : b * width] for a, b in zip(edges, edges[1:])]
                # Hashed again: long documents have small minima and would all stand in front.
                keys = [signed(mix(np.minimum.reduceat(o[ids], edges[:-1]).view(np.uint64))) for o in orders]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(bodies, pa.binary()),
                        pa.array(np.diff(edges)),
                        *keys,
                    ],
                    names=["id", "ids", "n", "k1", "k2"],
                )

    return run


def _document_counts(size: int, wide: bool):
    """In how many documents each id is; under -1 the number of documents, under -2 that of ids."""
    kind = np.dtype(np.uint32 if wide else np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, rows, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(0).cast(pa.large_binary())):
                n = high - low
                pairs = data.view(kind).astype(np.int64) * n
                pairs += np.repeat(np.arange(n), np.diff(offsets) // kind.itemsize)
                pairs.sort()
                new = np.r_[True, pairs[1:] != pairs[:-1]]
                docs += np.bincount(pairs[new] // n, minlength=size)
                rows, total = rows + n, total + len(pairs)
        at = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [-1, -2])), pa.array(np.append(docs[at], [rows, total]))], names=["id", "docs"]
        )

    return run


def _rarity(counts: dict[int, int], size: int) -> tuple[np.ndarray, float]:
    """Each id's weight, positive for all, and the mean length of a document."""
    n = counts.get(-1, 0)
    df = np.zeros(size)
    for i, docs in counts.items():
        if i >= 0:
            df[i] = docs
    return np.log(1 + (n - df + 0.5) / (df + 0.5)), counts.get(-2, 0) / max(1, n)


class _Index:
    """An inverted index with BM25 weights (k1 1.2, b 0.75) over the items of a shard.

    `rarity` holds the weights of ids and the mean length over all documents. Without it both are
    those of the items, and ids in half of them count nothing.
    """

    def __init__(self, texts: list[np.ndarray], rarity: tuple[np.ndarray, float] | None = None) -> None:
        n = len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        owner = np.repeat(np.arange(n), sizes)
        pairs = np.concatenate(texts).astype(np.int64) * n + owner
        pairs.sort()
        new = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        count = np.diff(np.append(new, len(pairs)))
        term, doc = pairs[new] // n, pairs[new] % n
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.append(first, len(term)))
        if rarity is None:
            idf, mean = np.log((n - df + 0.5) / (df + 0.5)), sizes.mean()
        else:
            idf, mean = rarity[0][term[first]], rarity[1]
        norm = 1.2 * (0.25 + 0.75 * sizes / max(1.0, mean))
        weight = np.repeat(idf, df) * count * 2.2 / (count + norm[doc])
        # A term in one item alone brings nobody nearer. Frequent ones are rows over all items.
        kept = (idf > 0) & (df > 1)
        wide = kept & (df * DENSE_PART > n)
        here = np.repeat(wide, df)
        row = np.repeat(np.cumsum(wide) - 1, df)[here]
        self.rows = np.zeros((int(wide.sum()), n), np.float32)
        self.rows[row, doc[here]] = weight[here]
        by_doc = np.argsort(doc[here], kind="stable")
        self.wide = np.split(row[by_doc], np.searchsorted(doc[here][by_doc], np.arange(1, n)))
        kept &= ~wide
        useful = np.repeat(kept, df)
        self.n, self.doc, self.weight = n, doc[useful], weight[useful]
        df = df[kept]
        self.begin = np.cumsum(df) - df
        self.df = df
        by_doc = np.argsort(self.doc, kind="stable")
        terms = np.repeat(np.arange(len(df)), df)[by_doc]
        self.terms = np.split(terms, np.searchsorted(self.doc[by_doc], np.arange(1, n)))

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[seed]
        df, begin = self.df[terms], self.begin[terms]
        stop = np.cumsum(df)
        at = np.repeat(begin - (stop - df), df) + np.arange(stop[-1] if len(stop) else 0)
        return np.bincount(self.doc[at], self.weight[at], self.n) + self.rows[self.wide[seed]].sum(axis=0)


class _Packer:
    """Fills sequences; `out` collects (row, start, length, sequence, offset)."""

    def __init__(self, window: int, base: int, rarity: tuple[np.ndarray, float] | None = None) -> None:
        self.window, self.sequence, self.out, self.rarity = window, base, [], rarity

    def _put(self, items, name: int, take: int, offset: int) -> None:
        row, start = items[name][:2]
        self.out.append((row, start, take, self.sequence, offset))
        items[name][1] += take
        items[name][2] -= take

    def pack(self, items: list[list], texts: list[np.ndarray]) -> list[list]:
        """Items are [row, start, left]; returns those that did not fill a window."""
        for i, item in enumerate(items):
            while item[2] >= self.window:
                self._put(items, i, self.window, 0)
                self.sequence += 1
        open_ = np.array([item[2] > 0 for item in items])
        left = int(sum(item[2] for item in items))
        if left < self.window:
            return [x for x in items if x[2]]
        index = _Index(texts, self.rarity)
        seed, cursor = -1, 0
        while left >= self.window:
            if seed < 0 or not open_[seed]:
                while not open_[cursor]:
                    cursor += 1
                seed = cursor
            scores = index.scores(seed)
            scores[~open_] = -1.0
            filled, name, cut = 0, seed, -1
            while filled < self.window:
                take = min(items[name][2], self.window - filled)
                self._put(items, name, take, filled)
                filled += take
                if items[name][2]:
                    cut = name
                else:
                    open_[name] = False
                scores[name] = -1.0
                name = int(np.argmax(scores)) if filled < self.window else name
            self.sequence += 1
            left -= self.window
            seed = cut
        return [x for x in items if x[2]]

    def finish(self, items: list[list]) -> None:
        """The rest, as sequences of power-of-two lengths."""
        total = sum(x[2] for x in items)
        names = iter(range(len(items)))
        name = next(names, None)
        while total:
            size = 1 << (total.bit_length() - 1)
            filled = 0
            while filled < size:
                while not items[name][2]:
                    name = next(names)
                take = min(items[name][2], size - filled)
                self._put(items, name, take, filled)
                filled += take
            self.sequence += 1
            total -= size


def _pack(window: int, wide: bool, rarity):
    kind = np.uint32 if wide else np.uint16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window, TaskContext.get().partitionId() << 40, rarity.value)
        ids: list = []  # the shard's document ids
        texts: list[np.ndarray] = []
        items: list[list] = []
        held = 0

        def written() -> pa.RecordBatch:
            rows = [r for r, *_ in packer.out]
            numbers = [np.array(c, np.int64) for c in zip(*(x[1:] for x in packer.out))] or [np.zeros(0, np.int64)] * 4
            start, length, sequence, offset = numbers
            bodies = [texts[r][s : s + n].astype("<u4").tobytes() for r, s, n in zip(rows, start, length)]
            whole = np.array([len(texts[r]) for r in rows], np.int64)
            packer.out = []
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[r] for r in rows], pa.int64()),
                    pa.array(start),
                    pa.array(length),
                    pa.array(bodies, pa.binary()),
                    pa.array(whole),
                    pa.array(sequence),
                    pa.array(offset),
                ],
                names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = np.frombuffer(body.as_buffer(), kind)
                items.append([len(ids), 0, len(text)])
                ids.append(name)
                texts.append(text)
                held += len(text)
                if held >= SHARD_IDS or len(ids) >= SHARD_DOCS:
                    rest = packer.pack(items, texts)
                    yield written()
                    # What is left becomes the first items of the next shard.
                    rows = [x[0] for x in rest]
                    items = [[i, start, left] for i, (_, start, left) in enumerate(rest)]
                    ids, texts = [ids[r] for r in rows], [np.array(texts[r]) for r in rows]
                    held = sum(x[2] for x in items)
        if items:
            packer.finish(packer.pack(items, texts))
            yield written()

    return run


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int = 1,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most `window` ids.

    Returns id, start (the document's ids before the piece), length, ids (little-endian unsigned
    32-bit), doc_tokens (with the end id), sequence_id and offset (the place in the sequence,
    without gaps). Every id of every document lies in exactly one piece. A sequence is full or
    has a power of two of ids. `window` must be a power of two.

    A null or empty text is the end id alone. Repeated rows are packed once each; the id is a
    long and may be null or repeated. Other columns are not read. An empty table packs nothing.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    with open(vocabulary_path, "rb") as file:
        raw = file.read()
    _, ids, added = _vocabulary(raw)
    highest = max(int(ids.max()), end_id, *(i for _, i in added))
    wide = highest >= 1 << 16
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(raw)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    encoded = staged(
        map_arrow(narrow, _encode(hashlib.sha256(raw).hexdigest(), vocabulary, end_id, wide), "id long, ids binary, n long, k1 long, k2 long"),
        "packing-ids",
    )
    counted = map_arrow(encoded.select("ids"), _document_counts(highest + 1, wide), "id long, docs long")
    counts = {r["id"]: r["docs"] for r in counted.groupBy("id").agg(F.sum("docs").alias("docs")).collect()}
    rarity = context.broadcast(_rarity(counts, highest + 1))
    tasks = max(1, -(-counts.get(-2, 0) // TASK_IDS))
    key = ["k1", "k2", "k3"]
    dealt = (
        encoded.select("id", "ids", "k1", "k2", F.monotonically_increasing_id().alias("k3"))
        .repartitionByRange(tasks, *key)
        .sortWithinPartitions(*key)
        .select("id", "ids")
    )
    packed = map_arrow(
        dealt,
        _pack(window, wide, rarity),
        "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
    return packed.withColumnRenamed("id", id_col)


def digest(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.select(
        id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
