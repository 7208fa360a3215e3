"""Near-duplicate texts: Jaccard join of word shingles through token-combination prefixes.

The tokens of a document are its distinct shingles. All documents order tokens alike: rare ones
first, then the frequent ones by level of frequency, each by hash. Whatever is linked to a document of n tokens
at 0.8 lacks at most m = n // 5 of them. A prefix is extended until it covers m + 1:

* a rare token covers 1 and is indexed alone;
* frequent tokens are dealt to blocks by hash, and the k tokens of a block in the prefix cover
  k - 1: at least two of them are shared unless k - 1 are missing. All pairs inside a block are
  indexed, never a single frequent token. Blocks hold some four prefix tokens, so the pairs stay
  in proportion to the document's size. How many blocks there are depends on a size class;
  a document that can have a larger partner in the next class is indexed for both.

Linked documents share a signature: of two linked documents take the one whose prefix ends
first; the tokens it shares with the other one lie in both prefixes, and at most m are missing.

The level of a token comes from a count sketch of all shingles: fixed by the corpus, the same
for all documents. It only decides the order; results do not depend on it.

Equal token sets are one node. Candidate pairs come from the signatures' groups in two steps:
every member with the group's most central node, which has the least share of rare tokens, and,
after these are verified and the components known, the pairs of one group that are still in
different components. A group of thousands of
copies costs thousands of pairs, not millions, and no link between components is lost. Verifying
reads the texts again and joins only the sets of candidate nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.text import (
    byte_values,
    map_arrow,
    mix,
    random_words,
    signed,
    slices,
    sort_in_rows,
    span_hashes,
    windows,
    word_spans,
)
from tidemark.session import staged

SIZE = 5
# The sketch has about one counter per 8 shingles, between these powers of two.
LEAST_POWER, MOST_POWER = 16, 24
# Documents under 2^SMALL tokens are indexed by single tokens only.
SMALL = 4
POSTINGS_PER_PART = 1 << 20
# Postings a task gathers before it sends them on.
POSTINGS_AT_ONCE = 1 << 18

_U = np.uint64
_TABLE = byte_values("near-word")
_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of whole rows, sorted in each row, and each row's first (and the end)."""
    count = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets, _INSIDE)
    words = span_hashes(data, starts, ends, _TABLE)
    hashes, at = windows(words, rows, SIZE, "near-shingle")
    owner = rows[at]
    first = np.searchsorted(rows, np.arange(count + 1))
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < SIZE))
    if len(short):
        whole = n[short].astype(_U)
        for j, f in enumerate(random_words("near-short", SIZE) | _U(1)):
            inner = n[short] > j
            whole[inner] += words[first[short[inner]] + j] * f
        hashes = np.concatenate([hashes, mix(whole)])
        owner = np.concatenate([owner, short])
    order = sort_in_rows(owner, hashes, count)
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(count + 1))


def set_nodes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 63-bit name for each row's set; equal sets have equal names."""
    total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(hashes ^ _U(0x5851F42D4C957F2D)), dtype=_U)])
    folded = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * (hashes | _U(1)), dtype=_U)])
    a, b = (x[first[1:]] - x[first[:-1]] for x in (total, folded))
    return mix(a ^ mix(b + np.diff(first).astype(_U))) >> _U(1)


def parity_maps(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """One bit per token and row at least: the parity of how many tokens fall on each bit.

    Two sets whose maps differ in d bits differ in d tokens at least. A map twice as long folds
    to the shorter one by xor of its halves.
    """
    n = np.diff(first)
    bits = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(bits)])
    place = (hashes & np.repeat(bits - 1, n).astype(_U)).astype(np.int64) + np.repeat(base[:-1], n)
    packed = np.packbits((np.bincount(place, minlength=base[-1]) & 1).astype(bool))
    raw = packed.tobytes()
    return [raw[a // 8 : b // 8] for a, b in zip(base, base[1:])]


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, maps = [np.zeros(0, _U)], [np.zeros(0, np.int64)], []
        for _, _, data, offsets in slices(batch.column(1)):
            hashes, first = shingle_sets(data, offsets)
            nodes.append(set_nodes(hashes, first))
            sizes.append(np.diff(first))
            maps += parity_maps(hashes, first)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), signed(np.concatenate(nodes)), pa.array(np.concatenate(sizes)), pa.array(maps, pa.binary())],
            names=["id", "node", "n", "map"],
        )


def _promising(percent: int):
    """Pairs that the parity maps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("na")) + np.asarray(batch.column("nb"))
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint8)
                y = np.frombuffer(right[i].as_buffer(), np.uint8)
                while len(x) > len(y):
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                while len(y) > len(x):
                    y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                shared = (int(sizes[i]) - int(np.bitwise_count(x ^ y).sum())) // 2
                keep[i] = 100 * shared >= percent * (int(sizes[i]) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


PIECE = 1 << 16


def _sketch(power: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << power, np.int32)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                hashes, _ = shingle_sets(data, offsets)
                np.add.at(counts, (hashes >> _U(64 - power)).astype(np.int64), 1)
        codec = pa.Codec("zstd")
        for i in range(0, 1 << power, PIECE):
            small = np.minimum(counts[i : i + PIECE], 255).astype(np.uint8)
            if small.any():
                body = codec.compress(small.tobytes(), asbytes=True)
                yield pa.record_batch({"piece": pa.array([i // PIECE]), "body": pa.array([body], pa.binary())})

    return run


def _add_sketches(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec, total = pa.Codec("zstd"), np.zeros(PIECE, np.int64)
    for batch in batches:
        for body in batch.column("body"):
            total += np.frombuffer(codec.decompress(body.as_py(), PIECE, asbytes=True), np.uint8)
    yield pa.record_batch(
        {"piece": pa.array([key[0].as_py()]), "total": pa.array([total.sum()]), "body": pa.array([total.tobytes()], pa.binary())}
    )


def _levels(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for body in batch.column("body"):
                counts = np.frombuffer(body.as_buffer(), np.int64)
                level = sum((counts > least * 4**i).astype(np.uint8) for i in range(3)).reshape(-1, 4)
                bodies.append((level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6).tobytes())
            yield pa.record_batch({"piece": batch.column("piece"), "body": pa.array(bodies, pa.binary())})

    return run


def token_levels(texts: DataFrame, tokens: int) -> tuple[int, np.ndarray]:
    """The sketch's power and a level for each counter, two bits each.

    Level 0 is what chance makes of tokens that are in a few documents; each further level has
    four times the count. A task sends at most 255 for a counter.
    """
    power = LEAST_POWER
    while power < MOST_POWER and 8 << power < tokens:
        power += 1
    pieces = map_arrow(texts, _sketch(power), "piece long, body binary")
    summed = staged(
        pieces.groupBy("piece").applyInArrow(_add_sketches, "piece long, total long, body binary"), "shingle-counts"
    )
    mean = (summed.agg(F.sum("total")).first()[0] or 0) / (1 << power)
    least = mean + 4 * mean**0.5 + 3
    levels = np.zeros((1 << power) // 4, np.uint8)
    for r in map_arrow(summed.select("piece", "body"), _levels(least), "piece long, body binary").toLocalIterator():
        levels[r["piece"] * PIECE // 4 : (r["piece"] + 1) * PIECE // 4] = np.frombuffer(bytes(r["body"]), np.uint8)
    return power, levels


def _pairs_in_blocks(tokens: np.ndarray, blocks: int, need: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the pairs inside blocks, over the shortest prefix that covers `need`.

    Also how many of the tokens can be shared at most if no pair that ends earlier is: those from
    the pair's later token on, and one in each block before it.
    """
    block = (mix(tokens) & _U(blocks - 1)).astype(np.int64)
    # A token covers 1 unless it is the first of its block.
    order = np.argsort(block, kind="stable")
    first = np.ones(len(block), bool)
    first[1:] = block[order][1:] != block[order][:-1]
    covers = np.ones(len(block), np.int64)
    covers[order[first]] = 0
    reach = len(tokens) - np.cumsum(covers) + covers
    length = int(np.searchsorted(np.cumsum(covers), need)) + 1
    tokens, block = tokens[:length], block[:length]
    order = np.argsort(block, kind="stable")
    tokens, block, reach = tokens[order], block[order], reach[:length][order]
    marks, left, step = [np.zeros(0, _U)], [np.zeros(0, np.int64)], 1
    while True:
        # Tokens `step` apart in the same block.
        same = block[step:] == block[:-step] if step < len(block) else np.zeros(0, bool)
        if not same.any():
            return np.concatenate(marks), np.concatenate(left)
        marks.append(mix(mix(tokens[:-step][same] + salt) + tokens[step:][same]))
        left.append(reach[step:][same])
        step += 1


def signatures(tokens: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of one document's sorted tokens; tokens above level 0 are frequent.

    Also, for each signature, how many tokens two documents can share at most if it is the first
    signature that they share.
    """
    n = len(tokens)
    need = n // SIZE_MISSING + 1
    rare = tokens[level == 0]
    if len(rare) >= need:
        return rare[:need], n - np.arange(need)
    order = np.argsort(level, kind="stable")[len(rare) :]
    common = tokens[order]
    marks, left, need = [rare], [n - np.arange(len(rare))], need - len(rare)
    size = n.bit_length() - 1
    classes = [size, size + 1] if 10 * n >= 8 << (size + 1) else [size]
    for c in classes:
        if c < SMALL:
            got, reach = common[:need], len(common) - np.arange(len(common[:need]))
        else:
            got, reach = _pairs_in_blocks(common, (1 << c) // 8, need, mix(np.full(1, c, _U)))
        marks.append(got)
        left.append(reach)
    return np.concatenate(marks), np.concatenate(left)


# At 0.8 a partner lacks at most one token in five.
SIZE_MISSING = 5


def _index(power: int, packed, parts: int):
    """Postings (signature, node, size, rank, reach), packed by part: 26 bytes each."""

    def packed_by_part(got: list[tuple]) -> pa.RecordBatch:
        mark, node, size, rank, left = (np.concatenate(x) for x in zip(*got))
        part = (mix(mark) % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        ends = np.append(at[1:], len(part))
        kinds = {"mark": (mark, _U), "node": (node, _U), "n": (size, np.int32), "rank": (rank, np.int16), "reach": (left, np.int32)}
        columns = {"part": pa.array(part[at])}
        for name, (values, kind) in kinds.items():
            raw = values[order].astype(kind).tobytes()
            width = np.dtype(kind).itemsize
            columns[name] = pa.array([raw[a * width : b * width] for a, b in zip(at, ends)], pa.binary())
        return pa.record_batch(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = packed.value
        for batch in batches:
            got, held, seen = [], 0, set()
            for _, _, data, offsets in slices(batch.column(0)):
                hashes, first = shingle_sets(data, offsets)
                names, n = set_nodes(hashes, first), np.diff(first)
                counter = (hashes >> _U(64 - power)).astype(np.int64)
                level = (levels[counter >> 2] >> (2 * (counter & 3)).astype(np.uint8)) & 3
                # The share of rare tokens: the less a text has of its own, the more central it is.
                rare = np.concatenate([[0], np.cumsum(level == 0)])[first]
                rank = 1000 * np.diff(rare) // np.maximum(n, 1)
                for i in np.flatnonzero(n):
                    name = int(names[i])
                    if name in seen:
                        continue
                    seen.add(name)
                    marks, left = signatures(hashes[first[i] : first[i + 1]], level[first[i] : first[i + 1]])
                    got.append((marks, *(np.full(len(marks), x) for x in (names[i], n[i], rank[i])), left))
                    held += len(marks)
                if held >= POSTINGS_AT_ONCE:
                    yield packed_by_part(got)
                    got, held = [], 0
            if got:
                yield packed_by_part(got)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of signatures that at least two nodes have; all of a signature are in one partition."""
    names = {"mark": _U, "node": _U, "n": np.int32, "rank": np.int16, "reach": np.int32}
    parts = [[b.column(c) for c in names] for b in batches]
    columns = [
        np.concatenate([np.zeros(0, kind), *[np.frombuffer(x.as_buffer(), kind) for p in parts for x in p[i]]])
        for i, kind in enumerate(names.values())
    ]

    def some(keep: np.ndarray) -> None:
        columns[:] = [c[keep] for c in columns]

    def twins() -> np.ndarray:
        mark = columns[0]
        twin = np.zeros(len(mark), bool)
        twin[1:] = mark[1:] == mark[:-1]
        twin[:-1] |= twin[1:]
        return twin

    some(np.argsort(columns[0]))
    some(twins())
    some(np.lexsort((columns[1], columns[0])))
    new = np.ones(len(columns[0]), bool)
    new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    some(new)
    some(twins())
    for i in range(0, len(columns[0]), 1 << 16):
        mark, node, n, rank, reach = (c[i : i + (1 << 16)] for c in columns)
        yield pa.record_batch(
            {
                "mark": signed(mark),
                "node": signed(node),
                "n": pa.array(n.astype(np.int64)),
                "rank": pa.array(rank.astype(np.int64)),
                "reach": pa.array(reach.astype(np.int64)),
            }
        )


def _sets_of(wanted, power: int):
    """(node, sorted shingles) of rows whose node may be wanted; each node once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            nodes, bodies, seen = [], [], set()
            for _, _, data, offsets in slices(batch.column(0)):
                hashes, first = shingle_sets(data, offsets)
                names = set_nodes(hashes, first)
                place = (mix(names) >> _U(64 - power)).astype(np.int64)
                held = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                for i in np.flatnonzero(held):
                    if int(names[i]) not in seen:
                        seen.add(int(names[i]))
                        nodes.append(names[i])
                        bodies.append(hashes[first[i] : first[i + 1]].tobytes())
            yield pa.record_batch({"node": signed(np.array(nodes, _U)), "body": pa.array(bodies, pa.binary())})

    return run


def _mark_nodes(power: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << power, bool)
        for batch in batches:
            names = np.asarray(batch.column(0)).view(_U)
            bits[(mix(names) >> _U(64 - power)).astype(np.int64)] = True
        codec = pa.Codec("zstd")
        packed = np.packbits(bits, bitorder="little")
        step = min(len(packed), PIECE)
        for i in range(0, len(packed), step):
            if packed[i : i + step].any():
                body = codec.compress(packed[i : i + step].tobytes(), asbytes=True)
                yield pa.record_batch({"piece": pa.array([i // step]), "body": pa.array([body], pa.binary())})

    return run


def _or_pieces(step: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, total = pa.Codec("zstd"), np.zeros(step, np.uint8)
        for batch in batches:
            for body in batch.column("body"):
                total |= np.frombuffer(codec.decompress(body.as_py(), step, asbytes=True), np.uint8)
        yield pa.record_batch({"piece": pa.array([key[0].as_py()]), "body": pa.array([total.tobytes()], pa.binary())})

    return run


def _node_filter(nodes: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """One bit per hashed node (16 bits a node, 2^16 to 2^27 in all): a filter that misses no node."""
    power = 16
    while power < 27 and 1 << power < 16 * count:
        power += 1
    step = min((1 << power) // 8, PIECE)
    pieces = map_arrow(nodes, _mark_nodes(power), "piece long, body binary")
    merged = pieces.groupBy("piece").applyInArrow(_or_pieces(step), "piece long, body binary")
    bits = np.zeros((1 << power) // 8, np.uint8)
    for r in merged.toLocalIterator():
        bits[r["piece"] * step : (r["piece"] + 1) * step] = np.frombuffer(bytes(r["body"]), np.uint8)
    return power, bits


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column("left"), batch.column("right")
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), _U)
                y = np.frombuffer(right[i].as_buffer(), _U)
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (len(both) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


class NearTexts:
    """Links and classes of the near-duplicate texts of a table.

    Words are runs of anything but [\\x20\\x09-\\x0D], A-Z in lower case; a set holds the distinct
    runs of five words, or all words of a shorter text as one. Two rows are linked if 100 times
    the shared shingles reach `percent` times the joint ones. A null or empty text has an empty
    set and is linked with nothing. Rows of equal sets are linked. Only id and text are read, so
    other columns may be called anything. An empty table gives empty results.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> None:
        if percent < 80:
            raise ValueError("the prefixes are made for at least 80 percent")
        self.percent = percent
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        self.texts = narrow.select("text")
        kind = narrow.schema["id"].dataType.simpleString()
        rows = staged(map_arrow(narrow, _summary, f"id {kind}, node long, n long, map binary"), "near-rows")
        self.rows = rows.drop("map")
        self.nodes = rows.select("node", "n", "map").dropDuplicates(["node"])
        self.links = self._find()
        self.classes = staged(components(self.links), "near-classes") if self.links is not None else None

    def _sets(self, nodes: DataFrame, count: int) -> DataFrame:
        """The sets of some nodes, and of a few others that their filter lets through."""
        power, bits = _node_filter(nodes, count)
        wanted = self.texts.sparkSession.sparkContext.broadcast(bits)
        return map_arrow(self.texts, _sets_of(wanted, power), "node long, body binary")

    def _verified(self, pairs: DataFrame) -> DataFrame | None:
        """The linked ones of a written table of candidate pairs (a, b).

        First the parity maps, a few bits per token, rule out what cannot be linked. Then the
        whole sets of b travel to their pairs, and on to the sets of a, which are few.
        """
        maps = [
            self.nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("map").alias(side))
            for c, side in (("a", "left"), ("b", "right"))
        ]
        hopeful = pairs.join(maps[0], "a").join(maps[1], "b").select("a", "b", "na", "nb", "left", "right")
        pairs = staged(map_arrow(hopeful, _promising(self.percent), "a long, b long"), "near-hopeful")
        ends = [staged(pairs.select(F.col(c).alias("node")).distinct(), "near-nodes") for c in ("a", "b")]
        counts = [e.count() for e in ends]
        if not counts[0]:
            return None
        left, right = (self._sets(e, n) for e, n in zip(ends, counts))
        # Rows of one set may have sent it several times; what is linked twice is linked.
        joined = (
            pairs.join(right.select(F.col("node").alias("b"), F.col("body").alias("right")), "b")
            .join(left.select(F.col("node").alias("a"), F.col("body").alias("left")).dropDuplicates(["a"]), "a")
            .select("a", "b", "left", "right")
        )
        return staged(map_arrow(joined, _verify(self.percent), "a long, b long"), "near-links")

    def _find(self) -> DataFrame | None:
        spark = self.texts.sparkSession
        tokens = self.rows.agg(F.sum("n")).first()[0] or 0
        if not tokens:
            return None
        power, packed = token_levels(self.texts, tokens)
        parts = max(8, -(-tokens // (3 * POSTINGS_PER_PART)))
        packed = spark.sparkContext.broadcast(packed)
        postings = map_arrow(self.texts, _index(power, packed, parts), "part long, mark binary, node binary, n binary, rank binary, reach binary")
        shared = staged(
            map_arrow(postings.repartition(int(parts), "part"), _shared, "mark long, node long, n long, rank long, reach long"), "near-postings"
        )
        most = F.least("na", "nb", "ra", "rb")
        fits = most * 100 >= (F.col("na") + F.col("nb") - most) * self.percent
        least = shared.groupBy("mark").agg(F.min(F.struct("rank", "node", "n", "reach")).alias("first"))
        star = (
            shared.join(least, "mark")
            .select(
                F.col("first.node").alias("a"),
                F.col("first.n").alias("na"),
                F.col("first.reach").alias("ra"),
                F.col("node").alias("b"),
                F.col("n").alias("nb"),
                F.col("reach").alias("rb"),
            )
            .filter((F.col("a") != F.col("b")) & fits)
            .select("a", "b")
            .distinct()
        )
        tried = staged(star, "near-pairs")
        links = self._verified(tried)
        # What is left: pairs of one signature whose nodes are in different components so far.
        known = components(links) if links is not None else None
        named = shared
        if known is not None:
            known = staged(known, "near-known")
            named = shared.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
        else:
            named = shared.withColumn("component", F.col("node"))
        mixed = named.groupBy("mark").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        mixed = mixed.filter("low <> high").select("mark")
        open_ = staged(named.join(mixed, "mark", "left_semi"), "near-open")
        rest = self._rest(open_, tried, fits)
        more = self._verified(rest)
        if links is None or more is None:
            return links if more is None else more
        return links.unionByName(more)

    def _rest(self, open_: DataFrame, tried: DataFrame, fits) -> DataFrame:
        x, y = (
            open_.select(
                "mark",
                F.col("node").alias(e),
                F.col("n").alias(f"n{e}"),
                F.col("reach").alias(f"r{e}"),
                F.col("component").alias(f"c{e}"),
            )
            for e in ("a", "b")
        )
        pairs = x.join(y, "mark").filter(F.col("a") < F.col("b")).filter(F.col("ca") != F.col("cb")).filter(fits)
        pairs = pairs.select("a", "b").distinct()
        return staged(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")

    def _named(self) -> DataFrame:
        """Rows with the class of their set; an empty set is a class of its own per row (null)."""
        if self.classes is None:
            group = F.when(F.col("n") > 0, F.col("node"))
            return self.rows.withColumn("group", group)
        found = self.rows.join(self.classes, "node", "left")
        return found.withColumn("group", F.when(F.col("n") > 0, F.coalesce("component", "node"))).drop("component")

    def report(self) -> DataFrame:
        """id, n_shingles and component_id: the smallest id reachable by links, itself included."""
        named = self._named()
        least = named.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min("id").alias("first"))
        return named.join(least, "group", "left").select(
            F.col("id").alias(self.id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("first", "id").alias("component_id"),
        )

    def kept(self) -> DataFrame:
        """The rows of the table, all their columns, that stand for their class.

        A class keeps its row with the smallest id; of rows with equal ids the first set by name,
        and of equal rows one. Rows with an empty set are classes of their own and stay. A null
        id comes last.
        """
        names = self.docs.columns
        named = self._named().filter(F.col("group").isNotNull())
        last = F.struct(F.col("id").isNull().alias("none"), "id", "node")
        stays = named.groupBy("group").agg(F.min(last).alias("first")).select("first.id", "first.node")
        # One row of each kept (id, set); which row it is depends on its content alone.
        keep = staged(stays, "near-kept")
        power, bits = _node_filter(keep.select("node"), keep.count())
        wanted = self.docs.sparkSession.sparkContext.broadcast(bits)
        mine = self.docs.select(
            *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)],
            F.lit(0).cast("long").alias("node"),
            F.lit(0).cast("long").alias("n"),
        )
        texts = names.index(self.text_col)
        tagged = map_arrow(mine, _tag(texts, wanted, power), mine.schema)
        key = F.col(f"c{names.index(self.id_col)}")
        same = key.eqNullSafe(keep["id"]) & (tagged["node"] == keep["node"])
        found = tagged.filter("n > 0").join(keep, same, "left_semi").dropDuplicates([key_name(names, self.id_col), "node"])
        whole = found.unionByName(tagged.filter("n = 0"))
        return whole.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def key_name(names: list[str], id_col: str) -> str:
    return f"c{names.index(id_col)}"


def _tag(texts: int, wanted, power: int):
    """Give rows their node and size; leave out rows whose node cannot be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            nodes, sizes = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in slices(batch.column(texts)):
                hashes, first = shingle_sets(data, offsets)
                nodes.append(set_nodes(hashes, first))
                sizes.append(np.diff(first))
            node, n = np.concatenate(nodes), np.concatenate(sizes)
            place = (mix(node) >> _U(64 - power)).astype(np.int64)
            held = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            columns = [*batch.columns[:-2], signed(node), pa.array(n)]
            tagged = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            yield tagged.filter(pa.array(held | (n == 0)))

    return run
