"""Benchmark passages inside documents, by a prefix-filtered containment join.

Every benchmark item is cut into windows of `window` consecutive words (a shorter item is one
window). A window is contained in a document only if all its shingles are, so one of them is a
sufficient prefix: the one that the corpus holds least often. One pass over the corpus counts
the benchmark's shingles; the second joins document shingles with the windows' prefix shingles.
A match proposes a start; it must lie inside the document with room for the whole window
(position and length bounds), and then all words of the window are compared.

The benchmark goes to the tasks in parts of at most `PART_WORDS` words, so what is broadcast is
bounded (some 45 bytes a word); a larger benchmark takes more passes, and the parts' hits are united
per document. Parts are dealt by a running sum of words, whatever the items' ids are, and an item
longer than an eighth of a part is cut into pieces that overlap by a window less one word, so that
every window of it lies in one piece.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import byte_values, map_arrow, random_words, slices, span_hashes, windows, word_spans
from tidemark.session import staged

WINDOW = 13
SHINGLE = 4
PART_WORDS = 1 << 19

_TABLE = byte_values("benchmark-word")
_INSIDE = np.zeros(256, bool)
_INSIDE[ord("0") : ord("9") + 1] = True
_INSIDE[ord("A") : ord("Z") + 1] = True
_INSIDE[ord("a") : ord("z") + 1] = True
_INSIDE[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of whole rows, their rows, and each row's first word (and the end)."""
    starts, ends, rows = word_spans(data, offsets, _INSIDE)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    return span_hashes(data, starts, ends, _TABLE), rows, first


class _Lookup:
    """Places of 64-bit values in a sorted list."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(values >> np.uint64(44)).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into x of what was found, and into the list."""
        at = np.flatnonzero(self.maybe[(x >> np.uint64(44)).astype(np.int64)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        same = self.values[place] == x[at]
        return at[same], place[same]


def _shingles(words, rows, size):
    return windows(words, rows, size, f"shingle-{size}")


class _Part:
    """The distinct windows of some benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, shingle: int) -> None:
        texts = [np.frombuffer(w, np.uint64) for _, w in items]
        names = sorted({i for i, _ in items})
        number = {n: i for i, n in enumerate(names)}
        self.names = names
        self.words = np.concatenate([np.zeros(0, np.uint64), *texts])
        base = np.cumsum([0, *map(len, texts)])
        starts, sizes, owner = [], [], []
        for i, (name, _) in enumerate(items):
            n = len(texts[i])
            if n:
                count = max(1, n - window + 1)
                starts.append(base[i] + np.arange(count))
                sizes.append(np.full(count, min(n, window)))
                owner.append(np.full(count, number[name]))
        start, size, own = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, sizes, owner))
        # One window per content, with the items that have it.
        key = np.zeros(len(start), np.uint64)
        for j, f in enumerate(random_words("window", window) | np.uint64(1)):
            here = np.flatnonzero(size > j)
            key[here] += self.words[start[here] + j] * f
        key = key * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        self.start, self.size = start[first].astype(np.int32), size[first].astype(np.int32)
        pairs = np.unique(np.stack([which.reshape(-1), own], 1), axis=0) if len(start) else np.zeros((0, 2), np.int64)
        self.owner = pairs[:, 1].astype(np.int32)
        self.owner_at = np.searchsorted(pairs[:, 0], np.arange(len(self.start) + 1)).astype(np.int32)
        # The shingles of each window: hash and offset.
        self.by_size = {}
        for q in sorted(set(np.minimum(self.size, shingle).tolist())):
            at = np.flatnonzero(np.minimum(self.size, shingle) == q)
            hashes, spots = _shingles(self.words, np.zeros(len(self.words), np.int64), q)
            place = np.full(len(self.words) + 1, -1)
            place[spots] = np.arange(len(spots))
            window_of, offset = [], []
            for k in range(int(self.size[at].max()) - q + 1):
                some = at[self.size[at] >= q + k]
                window_of.append(some)
                offset.append(np.full(len(some), k))
            window_of, offset = np.concatenate(window_of), np.concatenate(offset)
            value = hashes[place[self.start[window_of] + offset]]
            self.by_size[q] = (np.unique(value), window_of, offset, value)

    def prefixes(self, counts: dict[int, np.ndarray]) -> dict[int, tuple]:
        """By shingle size: prefix shingles and the windows of each, rarest shingle first.

        Windows with a shingle that no document has are left out.
        """
        out = {}
        for q, (values, window_of, offset, value) in self.by_size.items():
            seen = counts[q][np.searchsorted(values, value)]
            order = np.lexsort((offset, value, seen, window_of))
            w = window_of[order]
            best = order[np.r_[True, w[1:] != w[:-1]]] if len(order) else order
            best = best[seen[best] > 0]
            best = best[np.argsort(value[best], kind="stable")]
            keys, at = np.unique(value[best], return_index=True)
            at = np.append(at, len(best)).astype(np.int32)
            out[q] = (keys, at, window_of[best].astype(np.int32), offset[best].astype(np.int32))
        return out


def _item_words(most: int, window: int):
    """Items as words, in pieces of at most `most` words; each window of an item is in one piece."""
    step = most - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in slices(batch.column(1)):
                words, _, first = words_of(data, offsets)
                owner, pieces = [], []
                for i, (a, b) in enumerate(zip(first, first[1:])):
                    starts = range(a, max(b - window + 1, a + 1), step) if b - a > most else (a,)
                    pieces += [words[x : min(x + most, b)] for x in starts]
                    owner += [low + i] * len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner, pa.int64())),
                        pa.array([len(x) for x in pieces], pa.int64()),
                        pa.array([x.tobytes() for x in pieces], pa.binary()),
                    ],
                    names=["item", "n", "words"],
                )

    return run


def _dealt(items: DataFrame, part_words: int, most: int) -> Iterator[DataFrame]:
    """The pieces in parts of at most `part_words` words; none is longer than `most` words.

    Pieces are spread over buckets by their content and laid into cells along a running sum inside
    each bucket; the driver sees the cells' sizes, a handful for each part, and fills parts with
    them. Repeated pieces of an item count once.
    """
    total = items.agg(F.sum("n")).first()[0] or 0
    if total <= part_words:
        yield items
        return
    spread = F.pmod(F.xxhash64("item", "words"), F.lit(max(1, total // part_words)))
    along = Window.partitionBy("bucket").orderBy("item", "words").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(along), F.lit(0))
    cells = staged(
        items.distinct()
        .withColumn("bucket", spread)
        .withColumn("cell", F.col("bucket") * (1 << 31) + F.floor(before / most).cast("long"))
        .select("item", "n", "words", "cell"),
        "benchmark-cells",
    )
    parts: list[list[int]] = []
    room = 0
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect():
        if not parts or r["n"] > room:
            parts.append([])
            room = part_words
        parts[-1].append(r["cell"])
        room -= r["n"]
    for mine in parts:
        yield cells.filter(F.col("cell").isin(*mine))


def _count(shingles):
    """How often each of a part's shingles occurs in the corpus, summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {q: _Lookup(values) for q, values in shingles.value.items()}
        totals = {q: np.zeros(len(x.values), np.int64) for q, x in lookups.items()}
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                words, rows, _ = words_of(data, offsets)
                for q, lookup in lookups.items():
                    _, place = lookup.find(_shingles(words, rows, q)[0])
                    totals[q] += np.bincount(place, minlength=len(totals[q]))
        for q, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), q)), pa.array(at), pa.array(total[at])], names=["q", "at", "n"]
            )

    return run


def _occurrences(part: _Part, prefixes, lookups, words, rows, first):
    """(row, first word, window) of every occurrence of a window in whole rows."""
    found = []
    for q, (_, at, window_of, offset) in prefixes.items():
        hashes, spots = _shingles(words, rows, q)
        hit, place = lookups[q].find(hashes)
        if not len(hit):
            continue
        count = at[place + 1] - at[place]
        which = np.repeat(at[place], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        spot = np.repeat(spots[hit], count)
        window, start = window_of[which], spot - offset[which]
        row = rows[spot]
        fits = (start >= first[row]) & (start + part.size[window] <= first[row + 1])
        window, start, row = window[fits], start[fits], row[fits]
        for j in range(int(part.size.max())):
            if not len(window):
                break
            inner = part.size[window] > j
            same = np.ones(len(window), bool)
            same[inner] = words[start[inner] + j] == part.words[part.start[window[inner]] + j]
            window, start, row = window[same], start[same], row[same]
        found.append((row, start, window))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


_REPORT = "n_words long, n_hit long, items array<string>"


def _judge(part, plan, mode: str, index: int, carried: int, share: int):
    """Per row: all of its words, the words hit and the items found (`report`, `marks`), or the
    rows that are not contaminated (`keep`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, prefixes = part.value, plan.value
        lookups = {q: _Lookup(p[0]) for q, p in prefixes.items() if len(p[0])}
        used = {q: p for q, p in prefixes.items() if len(p[0])}
        for batch in batches:
            n_words, n_hit, items, places = [], [], [], []
            for low, high, data, offsets in slices(batch.column(index)):
                words, rows, first = words_of(data, offsets)
                row, start, window = _occurrences(own, used, lookups, words, rows, first)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + own.size[window], -1)
                hit = np.cumsum(edge[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(hit)])
                n_words.append(np.diff(first))
                n_hit.append(total[first[1:]] - total[first[:-1]])
                named: dict[int, set[str]] = {}
                pairs = np.unique(np.stack([row, window], 1), axis=0) if len(row) else ()
                for r, w in pairs:
                    got = own.owner[own.owner_at[w] : own.owner_at[w + 1]]
                    named.setdefault(int(r), set()).update(own.names[i] for i in got)
                items += [sorted(named.get(i, ())) for i in range(high - low)]
                if mode == "marks":
                    places += [np.flatnonzero(hit[a:b]).tolist() for a, b in zip(first, first[1:])]
            hits = np.concatenate([np.zeros(0, np.int64), *n_hit])
            totals = np.concatenate([np.zeros(0, np.int64), *n_words])
            if mode == "keep":
                dirty = (hits > 0) & (share * hits >= totals)
                yield batch.filter(pa.array(~dirty))
                continue
            out = [batch.column(i) for i in range(carried)]
            names = batch.schema.names[:carried]
            if mode == "report":
                out += [pa.array(totals), pa.array(hits), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(out, names=[*names, "n_words", "n_hit", "items"])
            else:
                out += [pa.array(places, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
                marks = pa.RecordBatch.from_arrays(out, names=[*names, "places", "items"])
                yield marks.filter(pa.array(hits > 0))

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [np.zeros(0, np.int64)]
        for _, _, data, offsets in slices(batch.column(1)):
            counts.append(np.diff(words_of(data, offsets)[2]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(np.concatenate(counts))], names=["id", "body", "n_words"]
        )


class Decontamination:
    """The benchmark's windows, ready to be looked for in documents.

    Words are runs of [0-9A-Za-z] and non-ASCII bytes, A-Z in lower case. A row is contaminated
    if at least one word in `share` lies in an occurrence of a window, and at least one does.
    A null or empty text has no words and is never contaminated; an item without words has no
    window; items of one id (all null ids are the id 'null') count as one item. Repeated rows
    are judged alike. An empty benchmark contaminates nothing. Other columns are only carried.
    """

    def __init__(
        self,
        docs: DataFrame,
        benchmark: DataFrame,
        window: int = WINDOW,
        shingle: int = SHINGLE,
        share: int = 20,
        id_col: str = "doc_id",
        text_col: str = "text",
        item_col: str = "item_id",
        item_text_col: str = "text",
        part_words: int = PART_WORDS,
    ) -> None:
        self.docs, self.id_col, self.text_col, self.share = docs, id_col, text_col, share
        context = docs.sparkSession.sparkContext
        name = F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null"))
        # A cell of pieces has less than twice the words of the longest one: four of them fit.
        most = max(part_words // 8, window)
        items = staged(
            map_arrow(
                benchmark.select(name.alias("item"), F.col(f"`{item_text_col}`").alias("text")),
                _item_words(most, window),
                "item string, n long, words binary",
            ),
            "benchmark-items",
        )
        self.narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        self.parts = []
        for mine in _dealt(items, part_words, most):
            part = _Part([(r["item"], bytes(r["words"])) for r in mine.collect()], window, shingle)
            counts = {q: np.zeros(len(v[0]), np.int64) for q, v in part.by_size.items()}
            if counts:
                shingles = context.broadcast({q: v[0] for q, v in part.by_size.items()})
                seen = map_arrow(self.narrow.select("text"), _count(shingles), "q long, at long, n long")
                for r in seen.groupBy("q", "at").agg(F.sum("n").alias("n")).collect():
                    counts[r["q"]][r["at"]] = r["n"]
                shingles.unpersist()
            plan = part.prefixes(counts)
            del part.by_size
            self.parts.append((context.broadcast(part), context.broadcast(plan)))

    def _marked(self) -> DataFrame:
        """More parts than one: hits of all parts, united per document (its id and text)."""
        keyed = self.narrow.withColumn("body", F.sha2(F.coalesce("text", F.lit("")), 256)).select("id", "body", "text")
        marks = None
        for part, plan in self.parts:
            schema = "id " + self.narrow.schema["id"].dataType.simpleString() + ", body string"
            one = map_arrow(
                keyed, _judge(part, plan, "marks", 2, 2, self.share), f"{schema}, places array<long>, items array<string>"
            )
            marks = one if marks is None else marks.unionByName(one)
        united = marks.groupBy("id", "body").agg(
            F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        return united.select(
            F.col("id").alias("mark_id"), F.col("body").alias("mark_body"), F.size("places").cast("long").alias("n_hit"), "items"
        )

    def report(self) -> DataFrame:
        """id, n_words, n_hit, items (sorted as strings) and contaminated of every row."""
        kind = self.narrow.schema["id"].dataType.simpleString()
        if len(self.parts) == 1:
            [(part, plan)] = self.parts
            found = map_arrow(self.narrow, _judge(part, plan, "report", 1, 1, self.share), f"id {kind}, {_REPORT}")
        else:
            counted = map_arrow(
                self.narrow.withColumn("body", F.sha2(F.coalesce("text", F.lit("")), 256)),
                _word_counts,
                f"id {kind}, body string, n_words long",
            )
            marks = self._marked()
            found = counted.join(
                marks, counted["id"].eqNullSafe(marks["mark_id"]) & (counted["body"] == marks["mark_body"]), "left"
            ).select(
                "id",
                "n_words",
                F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            )
        dirty = (F.col("n_hit") > 0) & (F.col("n_hit") * self.share >= F.col("n_words"))
        return found.withColumn("contaminated", dirty).withColumnRenamed("id", self.id_col)

    def kept(self) -> DataFrame:
        """The rows that are not contaminated, with all their columns."""
        names = self.docs.columns
        if len(self.parts) == 1:
            [(part, plan)] = self.parts
            keep = _judge(part, plan, "keep", names.index(self.text_col), 0, self.share)
            return map_arrow(self.docs, keep, self.docs.schema)
        marks = self._marked()
        counted = map_arrow(
            self.narrow.withColumn("body", F.sha2(F.coalesce("text", F.lit("")), 256)),
            _word_counts,
            f"id {self.narrow.schema['id'].dataType.simpleString()}, body string, n_words long",
        ).dropDuplicates(["id", "body"])
        dirty = (
            marks.join(counted, marks["mark_id"].eqNullSafe(counted["id"]) & (marks["mark_body"] == counted["body"]))
            .filter(F.col("n_hit") * self.share >= F.col("n_words"))
            .select("mark_id", "mark_body")
        )
        mine = self.docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
        key, body = F.col(f"c{names.index(self.id_col)}"), F.col(f"c{names.index(self.text_col)}")
        body = F.sha2(F.coalesce(body, F.lit("")), 256)
        left = mine.join(dirty, key.eqNullSafe(F.col("mark_id")) & (body == F.col("mark_body")), "left_anti")
        return left.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def digest(report: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The report with the items as a count and a hash of their comma-joined ids."""
    return report.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )
