"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max index.

Terms are the words of a text and the runs of four and five bytes inside words, A-Z in lower
case; runs catch inflected and compound forms. A bounded sample of labelled rows (`examples` of
each class, those with the least hash of their id) serves as examples. Terms that tell the
classes apart in it are kept: beyond chance and by much (`LEAST_LIFT` times as frequent in one
class). How large a likelihood ratio is beyond chance follows from the examples: the least one at
which `CHANCE_SHARE` of the terms that reach it would do so by chance (Benjamini and Hochberg).
Document frequencies of kept terms come from all documents.

Examples of equal vectors are one entry with their counts. Entries stand in blocks, and each
term has its largest weight in every block. For a text, the terms' block maxima bound what any
entry of a block can reach; blocks are scored in falling order of this bound until the k-th best
entry found is above all that is left, so the k nearest are exact. They vote with their cosine
as weight, each class scaled to its share among all labels. Votes are turned into probabilities
by a monotone fit over the examples, each judged without itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import byte_values, map_arrow, signed, slices, span_hashes, word_spans
from tidemark.session import staged

EXAMPLES = 4096
NEIGHBOURS = 16
BLOCK = 64
# Blocks scored before the bound decides on the others.
FIRST_BLOCKS = 8
# At most about this share of the kept terms may differ between the classes by chance alone.
CHANCE_SHARE = 0.05
# Likelihood ratios are counted in steps of this part of one.
RATIO_STEPS = 16
# And a kept term is so many times as frequent among the examples of one class as in the other's.
LEAST_LIFT = 4.0
# Weight of the vote of texts without any kept term, against one neighbour of cosine 1.
PRIOR_WEIGHT = 0.25

_U = np.uint64
_WORD = byte_values("toxicity-word")
_ODD = _U(0x9E3779B97F4A7C15)
_INSIDE = np.zeros(256, bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _INSIDE[ord(_low) : ord(_high) + 1] = True
_INSIDE[128:] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += _U(32)


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def term_codes(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, rows) of all terms of whole rows, one kind of term after the other."""
    starts, ends, rows = word_spans(data, offsets, _INSIDE)
    yield span_hashes(data, starts, ends, _WORD), rows
    n = len(data)
    if n < 4:
        return
    inside = _INSIDE[data]
    low = _LOWER[data]
    two = low[:-1] | (low[1:] << _U(8))
    four = two[:-2] | (two[2:] << _U(16))
    whole = inside[:-3] & inside[1:-2] & inside[2:-1] & inside[3:]
    edge = offsets[1:-1]
    for back in (1, 2, 3):
        at = edge - back
        whole[at[(at >= 0) & (at < len(whole))]] = False
    at = np.flatnonzero(whole)
    yield (four[at] | _U(4 << 56)) * _ODD, np.searchsorted(offsets, at, side="right") - 1
    if n < 5:
        return
    # Five bytes: two runs of four that are both inside.
    at = np.flatnonzero(whole[:-1] & whole[1:])
    yield (four[at] | (low[at + 4] << _U(32)) | _U(5 << 56)) * _ODD, np.searchsorted(offsets, at, side="right") - 1


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many examples of each class a term is, per batch."""
    for batch in batches:
        toxic = np.asarray(batch.column(1)).astype(np.int64)
        for low, _, data, offsets in slices(batch.column(0)):
            got = list(term_codes(data, offsets))
            code, row = (np.concatenate(x) for x in zip(*got))
            order = np.lexsort((row, code))
            code, row = code[order], row[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
            code, label = code[new], toxic[row[new] + low]
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
            total = np.diff(np.append(first, len(code)))
            ones = np.add.reduceat(label, first) if len(first) else total
            yield pa.RecordBatch.from_arrays(
                [signed(code[first]), pa.array(total - ones), pa.array(ones)], names=["code", "clean", "toxic"]
            )


class _Terms:
    """The kept terms, to be found in texts."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = np.sort(codes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.codes >> _U(44)).astype(np.int64)] = True

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, count), sorted by row and term.

        Rows with a kept term also have the term of all words together, the last one, counted
        once per word: a few kept terms mean less in a longer text.
        """
        rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        words = None
        if len(self.codes):
            for code, row in term_codes(data, offsets):
                if words is None:
                    words = np.bincount(row, minlength=len(offsets) - 1)
                at = np.flatnonzero(self.maybe[(code >> _U(44)).astype(np.int64)])
                place = np.minimum(np.searchsorted(self.codes, code[at]), len(self.codes) - 1)
                same = self.codes[place] == code[at]
                rows.append(row[at[same]])
                terms.append(place[same])
        width = len(self.codes) + 1
        key, count = np.unique(np.concatenate(rows) * width + np.concatenate(terms), return_counts=True)
        row, term = key // width, key % width
        found = np.unique(row)
        if not len(found):
            return row, term, count
        last = np.searchsorted(row, found, side="right")
        return (
            np.insert(row, last, found),
            np.insert(term, last, width - 1),
            np.insert(count, last, words[found]),
        )


def _document_frequencies(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = terms.value
        total, rows = np.zeros(len(own.codes) + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in slices(batch.column(0)):
                _, term, _ = own.vectors(data, offsets)
                total += np.bincount(term, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], names=["term", "docs"]
        )

    return run


def _example_vectors(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = terms.value
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(0)):
                row, term, count = own.vectors(data, offsets)
                edge = np.searchsorted(row, np.arange(high - low + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array([term[a:b].tolist() for a, b in zip(edge, edge[1:])], pa.list_(pa.int64())),
                        pa.array([count[a:b].tolist() for a, b in zip(edge, edge[1:])], pa.list_(pa.int64())),
                    ],
                    names=["toxic", "id", "terms", "counts"],
                )

    return run


def _rising(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best non-decreasing step fit of y over x: its knots and values."""
    order = np.argsort(x, kind="stable")
    x, y, w = x[order], y[order], w[order]
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, w):
        blocks.append([a, a, b * c, c])
        while len(blocks) > 1 and (
            blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3] or blocks[-2][1] == blocks[-1][0]
        ):
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots = np.array([e for b in blocks for e in (b[0], b[1])])
    # One clean and one toxic example of prior keep the ends off 0 and 1.
    values = np.array([v for b in blocks for v in [(b[2] + 0.1) / (b[3] + 0.2 + 0.8)] * 2])
    return knots, np.maximum.accumulate(values) if len(values) else values


@dataclass
class Entries:
    """The index: unit vectors by term and block, their votes, and the calibration."""

    terms: _Terms
    idf: np.ndarray
    vectors: list[tuple[np.ndarray, np.ndarray]]  # per entry: terms and weights
    weight: np.ndarray  # scaled examples of an entry
    toxic: np.ndarray  # the toxic ones among them
    ids: list  # one example's id per entry
    empty: float  # the toxic share of examples without kept terms
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def build(self) -> None:
        """Blocks of entries that share their heaviest kept term, and the terms' maxima per block."""
        n, width = len(self.vectors), len(self.idf)
        lead = [(int(t[np.argmax(w[:-1])]), float(w[-1])) for t, w in self.vectors]
        self.order = np.array(sorted(range(n), key=lead.__getitem__), np.int64)
        self.blocks = -(-n // BLOCK)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        term = np.concatenate([np.zeros(0, np.int64), *[t for t, _ in self.vectors]])
        weight = np.concatenate([np.zeros(0), *[w for _, w in self.vectors]])
        entry = np.repeat(place, [len(t) for t, _ in self.vectors])
        order = np.lexsort((entry, term))
        term, self.entry, self.posting = term[order], entry[order], weight[order]
        # Where the postings of each term begin in each block, one after the other.
        key = term * max(self.blocks, 1) + self.entry // BLOCK
        self.begin = np.searchsorted(key, np.arange(width * max(self.blocks, 1) + 1))
        self.most = np.zeros((width, max(self.blocks, 1)))
        np.maximum.at(self.most, (term, self.entry // BLOCK), self.posting)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1):
        """Entries and cosines of the k nearest and all that tie with the last; exact."""
        if not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.most[terms]
        queue = np.argsort(-bound, kind="stable")
        names, cosines, least = [], [], 0.0
        # The most promising blocks first; then, at once, all that can still hold one of the k.
        for part in (queue[:FIRST_BLOCKS], queue[FIRST_BLOCKS:]):
            some = np.sort(part[bound[part] >= max(least - 1e-9, 1e-300)])
            if not len(some):
                break
            spans = (terms[:, None] * self.blocks + some[None, :]).reshape(-1)
            first, size = self.begin[spans], self.begin[spans + 1] - self.begin[spans]
            stop = np.cumsum(size)
            at = np.repeat(first - (stop - size), size) + np.arange(stop[-1])
            times = np.repeat(np.repeat(weights, len(some)), size)
            entry = self.entry[at]
            dots = np.bincount(np.searchsorted(some, entry // BLOCK) * BLOCK + entry % BLOCK, self.posting[at] * times)
            found = np.flatnonzero(dots > 0)
            name = self.order[some[found // BLOCK] * BLOCK + found % BLOCK]
            keep = name != without
            names.append(name[keep])
            cosines.append(dots[found[keep]])
            so_far = np.concatenate(cosines)
            if len(so_far) >= k:
                least = np.partition(so_far, len(so_far) - k)[len(so_far) - k]
        if not names:
            return np.zeros(0, np.int64), np.zeros(0)
        name, cosine = np.concatenate(names), np.concatenate(cosines)
        keep = cosine >= least - 1e-9
        name, cosine = name[keep], cosine[keep]
        order = np.lexsort((name, -np.round(cosine, 9)))
        return name[order], cosine[order]

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / max(float(np.sqrt((w * w).sum())), 1e-300)

    def vote(self, name: np.ndarray, cosine: np.ndarray) -> float:
        w = cosine * self.weight[name]
        most = max(float(self.weight[name].max()) if len(name) else 0.0, 1e-300)
        toxic = float((cosine * self.toxic[name]).sum()) / most
        return (toxic + PRIOR_WEIGHT * self.empty) / (float(w.sum()) / most + PRIOR_WEIGHT)

    def calibrated(self, vote: float) -> float:
        if self.knots is None or not len(self.knots):
            return vote
        return float(np.interp(vote, self.knots, self.values))


def _score(index, k: int, mode: str, text: int, carried: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Entries = index.value
        base = own.calibrated(own.empty)
        for batch in batches:
            scores, evidence = np.full(batch.num_rows, base), [[] for _ in range(batch.num_rows)]
            for low, high, data, offsets in slices(batch.column(text)):
                row, term, count = own.terms.vectors(data, offsets)
                edge = np.searchsorted(row, np.arange(high - low + 1))
                for i in np.flatnonzero(np.diff(edge)):
                    terms = term[edge[i] : edge[i + 1]]
                    name, cosine = own.nearest(terms, own.unit(terms, count[edge[i] : edge[i + 1]]), k)
                    scores[low + i] = own.calibrated(own.vote(name, cosine))
                    if mode == "report":
                        evidence[low + i] = [
                            {"id": own.ids[e], "cosine": float(c), "toxic": float(own.toxic[e] / own.weight[e])}
                            for e, c in zip(name[:k], cosine[:k])
                        ]
            if mode == "keep":
                yield batch.filter(pa.array(scores < threshold))
            else:
                kind = pa.list_(pa.struct([("id", pa.string()), ("cosine", pa.float64()), ("toxic", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in range(carried)], pa.array(scores), pa.array(evidence, kind)],
                    names=[*batch.schema.names[:carried], "score", "evidence"],
                )

    return run


class Toxicity:
    """A scorer fitted on `labels` (id, 0/1) of `docs`.

    Only the text makes a score; labels are learnt from rows that are not held out. Null labels
    and labels of unknown ids are ignored; of rows that repeat an example's id the least text is
    taken. A
    null or empty text, and any text without a kept term, has the share of toxic rows among
    examples without one. Equal texts have equal scores. Without labels every score is 0.
    """

    def __init__(
        self,
        docs: DataFrame,
        labels: DataFrame,
        examples: int = EXAMPLES,
        neighbours: int = NEIGHBOURS,
        id_col: str = "doc_id",
        text_col: str = "text",
        label_col: str = "toxic",
    ) -> None:
        self.id_col, self.text_col, self.k = id_col, text_col, neighbours
        context = docs.sparkSession.sparkContext
        narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        known = (
            labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
            .filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
            .groupBy("id")
            .agg(F.max("toxic").alias("toxic"))
        )
        totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        picked = [
            known.filter(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(examples) for c in (0, 1)
        ]
        chosen = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * examples rows of two numbers
        # One text for each example, whatever the order of rows; it is read twice, so it is written.
        sample = staged(
            narrow.join(chosen, "id")
            .groupBy("id", "toxic")
            .agg(F.min("text").alias("text"))
            .select("text", "toxic", F.col("id").cast("string").alias("id")),
            "toxicity-examples",
        )
        kinds = map_arrow(sample.select("text", "toxic"), _class_counts, "code long, clean long, toxic long")
        sizes = {c: min(examples, totals.get(c, 0)) for c in (0, 1)}
        tables = staged(
            kinds.groupBy("code").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-terms"
        )
        ratio =_likelihood_ratio(F.col("toxic"), F.col("clean"), sizes[1], sizes[0])
        rates = [(F.col(c) + 0.5) / (sizes[i] + 1.0) for i, c in enumerate(("clean", "toxic"))]
        lift = F.greatest(rates[1] / rates[0], rates[0] / rates[1])
        steps = tables.groupBy(F.floor(ratio * RATIO_STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
        least = _least_ratio({r["step"]: r["n"] for r in steps})
        codes = tables.filter((ratio >= least) & (lift >= LEAST_LIFT)).select("code").toArrow().column(0).to_numpy()
        terms = context.broadcast(_Terms(np.ascontiguousarray(codes).view(_U)))
        seen = map_arrow(narrow.select("text"), _document_frequencies(terms), "term long, docs long")
        frequency, rows = np.zeros(len(codes)), 0
        for r in seen.groupBy("term").agg(F.sum("docs").alias("docs")).collect():
            if r["term"] < 0:
                rows = r["docs"]
            elif r["term"] < len(codes):
                frequency[r["term"]] = r["docs"]
        # The term of all words is in every text: its weight is that of the commonest term.
        idf = np.append(np.log((1 + rows) / (1 + frequency)) + 1, 1.0)
        vectors = map_arrow(
            sample.select("text", "toxic", "id"),
            _example_vectors(terms),
            "toxic int, id string, terms array<long>, counts array<long>",
        ).collect()
        scale = {c: totals.get(c, 0) / max(1, sum(r["toxic"] == c for r in vectors)) for c in (0, 1)}
        self.index = context.broadcast(_entries(terms.value, idf, vectors, scale, neighbours))
        self.docs, self.narrow = docs, narrow

    def report(self) -> DataFrame:
        """id, score and evidence (the nearest examples with their cosines) of every row."""
        kind = self.narrow.schema["id"].dataType.simpleString()
        schema = f"id {kind}, score double, evidence array<struct<id:string,cosine:double,toxic:double>>"
        found = map_arrow(self.narrow, _score(self.index, self.k, "report", 1, 1, 0.0), schema)
        return found.withColumnRenamed("id", self.id_col)

    def kept(self, threshold: float = 0.3) -> DataFrame:
        """The rows scored below the threshold, with all their columns."""
        text = self.docs.columns.index(self.text_col)
        return map_arrow(self.docs, _score(self.index, self.k, "keep", text, 0, threshold), self.docs.schema)


def _likelihood_ratio(toxic: Column, clean: Column, n1: int, n0: int) -> Column:
    """Twice the log likelihood ratio of two rates against one."""
    n1, n0 = max(n1, 1), max(n0, 1)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    rate = (toxic + clean) / F.lit(float(n1 + n0))
    return 2 * (
        part(toxic, rate * n1)
        + part(F.lit(n1) - toxic, (1 - rate) * n1)
        + part(clean, rate * n0)
        + part(F.lit(n0) - clean, (1 - rate) * n0)
    )


def _least_ratio(steps: dict[int, int]) -> float:
    """The least likelihood ratio at which few enough of the terms that reach it do so by chance."""
    total, reached, least = sum(steps.values()), 0, math.inf
    for step in sorted(steps, reverse=True):
        reached += steps[step]
        ratio = max(step, 0) / RATIO_STEPS
        # Twice the log ratio of a term without any difference is chi-squared with one degree.
        if math.erfc(math.sqrt(ratio / 2)) * total <= CHANCE_SHARE * reached:
            least = ratio
    return least


def _entries(terms: _Terms, idf: np.ndarray, rows: list, scale: dict[int, float], k: int) -> Entries:
    groups: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        groups.setdefault((tuple(r["terms"]), tuple(r["counts"])), []).append(r)
    none = groups.pop(((), ()), [])

    def weights(members: list) -> tuple[float, float]:
        toxic = sum(r["toxic"] for r in members)
        return scale[1] * toxic + scale[0] * (len(members) - toxic), scale[1] * toxic

    total, toxic = weights(none)
    empty = toxic / total if total else weights(rows)[1] / max(weights(rows)[0], 1e-300)
    index = Entries(terms, idf, [], np.zeros(0), np.zeros(0), [], empty)
    keys = list(groups)
    for t, c in keys:
        at = np.array(t, np.int64)
        index.vectors.append((at, index.unit(at, np.array(c, float))))
    index.weight = np.array([weights(groups[x])[0] for x in keys])
    index.toxic = np.array([weights(groups[x])[1] for x in keys])
    index.ids = [groups[x][0]["id"] for x in keys]
    index.build()
    # The votes of the examples, each without itself.
    votes, labels, counts = [empty], [empty], [max(total, 1.0)]
    for i, x in enumerate(keys):
        own_weight, own_toxic = index.weight[i], index.toxic[i]
        at, w = index.vectors[i]
        for label in {r["toxic"] for r in groups[x]}:
            index.weight[i] = max(own_weight - scale[label], 0.0)
            index.toxic[i] = max(own_toxic - scale[label] * label, 0.0)
            name, cosine = index.nearest(at, w, k, without=i if index.weight[i] <= 1e-9 else -1)
            votes.append(index.vote(name, cosine))
            labels.append(label)
            counts.append(scale[label] * sum(r["toxic"] == label for r in groups[x]))
        index.weight[i], index.toxic[i] = own_weight, own_toxic
    if rows:
        index.knots, index.values = _rising(np.array(votes), np.array(labels, float), np.array(counts))
    return index


def judged(report: DataFrame, threshold: float = 0.3, id_col: str = "doc_id") -> DataFrame:
    return report.select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
