"""Phrases whose words keep together, by weighted acyclic automata over sorted n-grams.

A task cuts its texts into words and sorts the n-grams of a shard. The sorted n-grams are built
into a count transducer: a tree of arcs labelled with words whose states carry how often the
n-gram that leads to them occurs. A shard's transducer is cut at ranges of two-word prefixes, and
what tasks sent for one range is united: states reached by the same words become one, their
weights are added (`union`). No pair or count ever meets as a row of its own before that.

A phrase of `least` occurrences has only words, and only pairs of neighbouring words, that occur
as often. So there are three passes: words; pairs of frequent words; three and four words in which
every pair is frequent. What is frequent is asked from a Bloom filter of at most `MOST_BITS` bits;
a filter that is too full lets more n-grams through to the exact counts, results stay the same.

The frequent n-grams of all lengths are one relation from phrase to weight. Each way to cut a
candidate maps it to two parts; composing both relations, a join on the part, gives their weights.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import numbered
from tidemark.llm.text import map_arrow, mix, ship, slices, word_spans
from tidemark.session import staged

LONGEST = 4
TOP = 2000
SHARD_BYTES = 1 << 22
# A task sends its transducer when it has about so many states.
MOST_STATES = 1 << 20
# Occurrences of words for each range of prefixes, and the fewest ranges.
RANGE_WORDS = 1 << 18
LEAST_RANGES = 64
RANGES_OF_A_TASK = 8
# Words drawn in proportion to their weight, whose order gives the limits of the ranges.
LIMITS = 4096
_SPACE = pa.scalar(" ", pa.large_string())
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_INSIDE = ~_BREAK
_INSIDE[[9, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


class Words:
    """The words of whole rows: codes into sorted `symbols`, the language of each, and whether a
    word and the next one stand in one piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array) -> None:
        starts, ends, rows = word_spans(data, offsets, _INSIDE)
        encoded = langs.dictionary_encode()
        order = pc.sort_indices(encoded.dictionary).to_numpy()
        self.langs = encoded.dictionary.take(pa.array(order)).cast(pa.large_string())
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.lang = place[encoded.indices.to_numpy()][rows] if len(rows) else rows
        pieces = np.cumsum(_BREAK[data])[starts] if len(starts) else starts
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = (rows[1:] == rows[:-1]) & (pieces[1:] == pieces[:-1])
        # All words back to back, as one text column.
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts] += 1
        edge[ends] -= 1
        packed = _LOWER[data[np.cumsum(edge[:-1], dtype=np.int8) > 0]]
        size = np.concatenate([[0], np.cumsum(ends - starts)])
        column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(size), pa.py_buffer(packed))
        encoded = column.dictionary_encode()
        order = pc.sort_indices(encoded.dictionary).to_numpy()
        self.symbols = encoded.dictionary.take(pa.array(order))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.codes = place[encoded.indices.to_numpy()] if len(starts) else starts


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], _U)


def _pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _U(0x9E3779B97F4A7C15) + right)


class _Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, packed: np.ndarray) -> None:
        self.packed, self.bits = packed, len(packed) * 8

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
        step = mix(hashes ^ _U(0x5851F42D4C957F2D)) | _U(1)
        return [((hashes + _U(i) * step) & _U(bits - 1)).astype(np.int64) for i in range(4)]

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes, self.bits):
            found &= (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def _phrase_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """Hashes of (lang, words) of rows whose phrases all have one word, or all two."""
    lang = mix(_word_hashes(batch.column(0)))
    parts = [p.split(" ") for p in batch.column(1).to_pylist()]
    words = [mix(_word_hashes(pa.array([p[i] for p in parts], pa.string())) ^ lang) for i in range(len(parts[0]))]
    return words[0] if len(words) == 1 else _pair_hashes(*words)


def _filter_of(phrases: DataFrame) -> _Filter:
    """A filter that holds the phrases (all of one length); at most MOST_BITS / 64 rows are collected."""
    bits = LEAST_BITS
    while bits < min(16 * phrases.count(), MOST_BITS):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.concatenate(_Filter.places(_phrase_hashes(batch), bits))
                unit, which = np.unique(at >> 6, return_inverse=True)
                mask = np.zeros(len(unit), _U)
                np.bitwise_or.at(mask, which, _U(1) << (at & 63).astype(_U))
                yield pa.record_batch({"at": pa.array(unit), "mask": pa.array(mask.view(np.int64))})

    rows = map_arrow(phrases.select("lang", "phrase"), run, "at long, mask long")
    table = rows.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    packed = np.zeros(bits // 64, np.int64)
    packed[table["at"].to_numpy()] = table["mask"].to_numpy()
    return _Filter(packed.view(np.uint8))


class Limits:
    """Prefix ranges of about equal weight, from words drawn in proportion to their weight."""

    def __init__(self, drawn: list[tuple[str, float]], ranges: int) -> None:
        drawn = sorted((w.encode(), n) for w, n in drawn)
        self.words = [w for w, _ in drawn]
        total = sum(n for _, n in drawn) or 1.0
        self.low = np.concatenate([[0.0], np.cumsum([n for _, n in drawn])]) / total
        self.ranges = ranges

    def of(self, symbols: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each symbol begins in [0, 1], and how much a drawn word takes."""
        names = [s.encode() for s in symbols.to_pylist()]
        at = np.array([bisect_left(self.words, s) for s in names], np.int64)
        own = np.array([i < len(self.words) and self.words[i] == s for i, s in zip(at, names)], bool)
        wide = np.diff(np.append(self.low, self.low[-1]))
        return self.low[at], np.where(own, wide[at], 0.0)

    def range_of(self, symbols: pa.Array, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The range of each pair of symbols; it never falls as pairs ascend."""
        low, wide = self.of(symbols)
        at = low[first] + wide[first] * low[second]
        return np.minimum((at * self.ranges).astype(np.int64), self.ranges - 1)


class Transducer:
    """A tree of arcs labelled with words, level by level in sorted order.

    `levels[d]` holds the states reached by d + 1 words: the state before the arc (an index into
    the level before; into `langs` for the first), the symbol on the arc, the weight of the state.
    """

    def __init__(self, langs: pa.Array, symbols: pa.Array, levels: list[tuple]) -> None:
        self.langs, self.symbols, self.levels = langs, symbols, levels

    def __len__(self) -> int:
        return sum(len(level[0]) for level in self.levels)

    @classmethod
    def of(cls, words: Words, link: np.ndarray, shortest: int, longest: int) -> Transducer:
        """The n-grams of `shortest` to `longest` words in which all neighbours are linked."""
        count = max(1, len(words.symbols))
        at = np.arange(len(link))
        held = [at]  # held[k]: first words of runs of k + 1 linked words
        for k in range(1, longest):
            before = held[-1]
            held.append(before[link[before + k - 1]])
        levels, state = [], np.zeros(len(link), np.int64)
        state[:] = words.lang
        for k in range(longest):
            some = held[max(k, shortest - 1)]
            arc, which = np.unique(state[some] * count + words.codes[some + k], return_inverse=True)
            weight = np.bincount(which, minlength=len(arc)) if k + 1 >= shortest else np.zeros(len(arc), np.int64)
            levels.append((arc // count, arc % count, weight))
            state = np.zeros(len(link), np.int64)
            state[some] = which
        return cls(words.langs, words.symbols, levels)

    @classmethod
    def union(cls, many: list[Transducer]) -> Transducer:
        """One transducer for all: states reached by the same words become one, weights add up."""
        if len(many) == 1:
            return many[0]

        def merged(columns: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
            encoded = pa.chunked_array(columns, pa.large_string()).combine_chunks().dictionary_encode()
            order = pc.sort_indices(encoded.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            codes = place[encoded.indices.to_numpy()]
            return encoded.dictionary.take(pa.array(order)), np.split(codes, np.cumsum([len(c) for c in columns])[:-1])

        langs, state = merged([t.langs for t in many])
        symbols, symbol = merged([t.symbols for t in many])
        levels = []
        for d in range(len(many[0].levels)):
            parts = [t.levels[d] for t in many]
            keys = np.concatenate([s[p[0]] * len(symbols) + c[p[1]] for s, c, p in zip(state, symbol, parts)])
            arc, which = np.unique(keys, return_inverse=True)
            weight = np.zeros(len(arc), np.int64)
            np.add.at(weight, which, np.concatenate([p[2] for p in parts]))
            levels.append((arc // len(symbols), arc % len(symbols), weight) if len(symbols) else (arc, arc, weight))
            state = np.split(which, np.cumsum([len(p[0]) for p in parts])[:-1])
        return cls(langs, symbols, levels)

    def cut(self, limits: Limits) -> Iterator[tuple[int, Transducer]]:
        """The transducer in pieces, one per range of two-word prefixes."""
        first, second = self.levels[0], self.levels[1]
        if not len(second[0]):
            return
        ranges = limits.range_of(self.symbols, first[1][second[0]], second[1])
        order = np.argsort(ranges, kind="stable")
        ranges = ranges[order]
        # The first words of each range, again with every range that they reach into.
        parent = second[0][order]
        fresh = np.r_[True, (ranges[1:] != ranges[:-1]) | (parent[1:] != parent[:-1])]
        heads, head_range = parent[fresh], ranges[fresh]
        parts = [(head_range, first[0][heads], first[1][heads], first[2][heads])]
        parts.append((ranges, np.cumsum(fresh) - 1, second[1][order], second[2][order]))
        for d in range(2, len(self.levels)):
            new = np.empty(len(order), np.int64)
            new[order] = np.arange(len(order))
            parent = new[self.levels[d][0]]
            order = np.argsort(parent, kind="stable")
            parent = parent[order]
            parts.append((parts[-1][0][parent], parent, self.levels[d][1][order], self.levels[d][2][order]))
        for r in np.unique(head_range):
            levels, base = [], 0
            for ranges, parent, symbol, weight in parts:
                a, b = np.searchsorted(ranges, r), np.searchsorted(ranges, r, side="right")
                levels.append((parent[a:b] - base, symbol[a:b], weight[a:b]))
                base = a
            used, codes = np.unique(np.concatenate([level[1] for level in levels]), return_inverse=True)
            ends = np.cumsum([len(level[1]) for level in levels])[:-1]
            levels = [(level[0], c, level[2]) for level, c in zip(levels, np.split(codes, ends))]
            yield int(r), Transducer(self.langs, self.symbols.take(pa.array(used)), levels)

    def written(self) -> bytes:
        """Sizes, names and levels as 32-bit numbers (parents as steps), compressed."""
        raw = [n.encode() for column in (self.langs, self.symbols) for n in column.to_pylist()]
        numbers = [[len(self.langs), len(self.symbols), len(self.levels)], [len(x[0]) for x in self.levels], [len(n) for n in raw]]
        for parent, symbol, weight in self.levels:
            numbers += [np.diff(parent, prepend=0), symbol, weight]
        body = np.concatenate([np.asarray(n, np.int32) for n in numbers]).tobytes()
        data = len(body).to_bytes(8, "little") + body + b"".join(raw)
        return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)

    @classmethod
    def read(cls, raw: bytes) -> Transducer:
        data = pa.Codec("zstd").decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True)
        end = 8 + int.from_bytes(data[:8], "little")
        numbers = np.frombuffer(data[8:end], np.int32).astype(np.int64)
        n_langs, n_symbols, n_levels = (int(n) for n in numbers[:3])
        sizes, at = numbers[3 : 3 + n_levels], 3 + n_levels
        ends = np.concatenate([[0], np.cumsum(numbers[at : at + n_langs + n_symbols])])
        at += n_langs + n_symbols
        names = pa.LargeStringArray.from_buffers(n_langs + n_symbols, pa.py_buffer(ends), pa.py_buffer(data[end:]))
        levels = []
        for n in sizes:
            parent, symbol, weight = numbers[at : at + 3 * n].reshape(3, n)
            levels.append((np.cumsum(parent), symbol, weight))
            at += 3 * int(n)
        return cls(names.slice(0, n_langs), names.slice(n_langs), levels)

    def phrases(self, least: int) -> Iterator[pa.RecordBatch]:
        """lang, phrase and weight of the states of at least that weight."""
        lang, text = None, None
        for parent, symbol, weight in self.levels:
            said = self.symbols.take(pa.array(symbol))
            lang = self.langs.take(pa.array(parent)) if lang is None else lang.take(pa.array(parent))
            text = said if text is None else pc.binary_join_element_wise(text.take(pa.array(parent)), said, _SPACE)
            often = pa.array(weight >= least)
            yield pa.record_batch(
                {
                    "lang": lang.filter(often).cast("string"),
                    "phrase": text.filter(often).cast("string"),
                    "n": pa.array(weight[weight >= least], pa.int64()),
                }
            )


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[Words]:
    for low, high, data, offsets in slices(batch.column(1), most):
        yield Words(data, offsets, batch.column(0).slice(low, high - low))


def _count_words(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _slices(batch, most):
                count = max(1, len(words.symbols))
                arc, n = np.unique(words.lang * count + words.codes, return_counts=True)
                lang, word = words.langs.take(pa.array(arc // count)), words.symbols.take(pa.array(arc % count))
                columns = {"lang": lang.cast("string"), "phrase": word.cast("string"), "n": pa.array(n, pa.int64())}
                yield pa.record_batch(columns)

    return run


def _shard(limits, words_filter, pairs_filter, shortest: int, longest: int, most: int, states: int):
    """Transducers of the n-grams whose words (and, if given, pairs) pass the filters, by range."""

    def linked(words: Words) -> np.ndarray:
        lang = mix(_word_hashes(words.langs))
        plain = _word_hashes(words.symbols)
        count = max(1, len(words.symbols))
        arc, which = np.unique(words.lang * count + words.codes, return_inverse=True)
        hashes = mix(plain[arc % count] ^ lang[arc // count]) if len(arc) else np.zeros(0, _U)
        frequent = words_filter.value.holds(hashes)[which]
        link = words.joined.copy()
        link[:-1] &= frequent[:-1] & frequent[1:]
        if pairs_filter is not None:
            at = np.flatnonzero(link)
            pairs = _pair_hashes(hashes[which[at]], hashes[which[at + 1]])
            link[at] = pairs_filter.value.holds(pairs)
        return link

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[Transducer] = []

        def send() -> Iterator[pa.RecordBatch]:
            if kept:
                whole = Transducer.union(kept)
                kept.clear()
                bounds = limits.value
                for r, piece in whole.cut(bounds):
                    yield pa.record_batch({"range": pa.array([r], pa.int64()), "body": pa.array([piece.written()], pa.binary())})

        for batch in batches:
            for words in _slices(batch, most):
                kept.append(Transducer.of(words, linked(words), shortest, longest))
                if sum(map(len, kept)) >= states:
                    yield from send()
        yield from send()

    return run


def _unite(least: int, states: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[Transducer] = []
        for batch in batches:
            for raw in batch.column(1).to_pylist():
                kept.append(Transducer.read(raw))
                if len(kept) > 1 and sum(map(len, kept)) >= max(states, 2 * len(kept[0])):
                    kept = [Transducer.union(kept)]
        yield from Transducer.union(kept).phrases(least)

    return run


class Phrases:
    """Frequent n-grams of the words of each language, and the phrases that keep together.

    Texts are cut at [.,;:!?\\x0A-\\x0D] into pieces and those at [\\x20\\x09] into words, A-Z in
    lower case. A null text has no words, a null language is `und`; a language without a frequent
    phrase gives no rows, nor does an empty table. Repeated rows count as often as they stand
    there. Columns other than the text and the language are not read.
    """

    def __init__(
        self,
        docs: DataFrame,
        least: int = 30,
        text_col: str = "text",
        lang_col: str = "lang",
        shard_bytes: int = SHARD_BYTES,
        states: int = MOST_STATES,
    ) -> None:
        spark = docs.sparkSession
        ship(spark)
        lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
        self.rows = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").alias("text"))
        self.least, self.shard_bytes, self.states = least, shard_bytes, states
        counted = map_arrow(self.rows, _count_words(shard_bytes), "lang string, phrase string, n long")
        self.words = staged(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrase-words")
        self.totals = self.words.groupBy("lang").agg(F.sum("n").alias("total"))
        words = self.words.filter(F.col("n") >= least)
        context = spark.sparkContext
        total = self.words.agg(F.sum("n")).first()[0] or 0
        self.ranges = max(LEAST_RANGES, total // RANGE_WORDS)
        limits = context.broadcast(self._limits(words, total))
        frequent = context.broadcast(_filter_of(words))
        pairs = self._counted(limits, frequent, None, 2, 2)
        longer = self._counted(limits, frequent, context.broadcast(_filter_of(pairs)), 3, LONGEST)
        self.frequent = words.unionByName(pairs).unionByName(longer).withColumn("words", F.split("phrase", " "))

    def _limits(self, words: DataFrame, total: int) -> Limits:
        """Draws words with a chance in proportion to their weight, LIMITS of them on average."""
        share = F.col("n") * LIMITS / F.lit(float(max(1, total)))
        chance = F.pmod(F.xxhash64("lang", "phrase"), F.lit(1 << 32)) / F.lit(float(1 << 32))
        drawn = words.filter(chance < share).groupBy("phrase").agg(F.sum(F.greatest(F.col("n").cast("double"), F.lit(total / LIMITS))).alias("n"))
        return Limits([(r["phrase"], float(r["n"])) for r in drawn.collect()], self.ranges)

    def _counted(self, limits, words, pairs, shortest: int, longest: int) -> DataFrame:
        shard = _shard(limits, words, pairs, shortest, longest, self.shard_bytes, self.states)
        shards = map_arrow(self.rows, shard, "range long, body binary")
        unite = _unite(self.least, self.states)
        # Tasks grow in number with the corpus, not in size.
        dealt = shards.repartition(self.ranges // RANGES_OF_A_TASK, "range")
        united = dealt.groupBy("range").applyInArrow(unite, "lang string, phrase string, n long")
        return staged(united, f"phrase-{shortest}")

    def scored(self) -> DataFrame:
        """Candidates with the weights of their worst cut; those inside a longer one are left out."""
        weight = self.frequent.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("n").alias("w"))
        size = F.size("words")
        candidates = self.frequent.filter(size > 1)

        def said(start: Column, length: Column) -> Column:
            return F.array_join(F.slice("words", start, length), " ")

        cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        cuts = cuts.select(
            "lang", "phrase", "n", "k", said(F.lit(1), F.col("k")).alias("left"), said(F.col("k") + 1, size).alias("right")
        )
        for side, name in (("left", "l"), ("right", "r")):
            on = (F.col("lang") == F.col("p_lang")) & (F.col(side) == F.col("part"))
            cuts = cuts.join(weight, on).drop("p_lang", "part").withColumnRenamed("w", name)
        exact = F.expr("cast((cast(2000000 as decimal(20, 0)) * cast(n as decimal(18, 0))) div (l + r) as long)")
        worst = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
        best = cuts.groupBy("lang", "phrase", "n").agg(worst)

        inside = F.flatten(
            F.transform(
                F.sequence(F.lit(2), size - 1),
                lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: said(i, k)),
            )
        )
        held = candidates.filter(size > 2).select("lang", F.explode(inside).alias("phrase"), "n")
        held = held.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
        wide = "decimal(22, 0)"
        whole = F.coalesce(F.col("longer"), F.lit(0)).cast(wide) * 100 < F.col("n").cast(wide) * 80
        kept = best.join(held, ["lang", "phrase"], "left").filter(whole)
        return kept.select(
            "lang", "phrase", F.col("n").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
        )

    def best(self, top: int = TOP) -> DataFrame:
        """The first phrases of each language by score, weight and text, with the language's words."""
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
        ranked = numbered(staged(self.scored(), "phrase-scores"), "lang", order, "phrase-order").filter(F.col("rank") < top)
        return ranked.join(self.totals.withColumnRenamed("total", "n"), "lang").select(
            "lang", (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score"
        )
