"""Token counts and packing against the tokenizers library; vectors and toxicity by brute force."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, toxicity
from tidemark.llm.near_vectors import NearVectors
from tidemark.llm.pretoken import pieces
from tidemark.llm.text import slices
from tidemark.llm.token_counts import CountMachine, PieceTable, slice_counts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'t", "'re", "'r", "'ve", "'v", "'ll", "'l", "'", "''", "'m", "'d", "'D", " ", "  ", "\n", "\t", "　", "a", "e", "l", "s", "é", "中", "1", "²", "!", "<|endoftext|>", "<|endoftext|", " the", "Ж", "\U0001F600", "​", "\x1f", "\x85", "_"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(count, seed=4):
    draw = random.Random(seed)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(count)]
    texts += ["".join(draw.choices("abcdeghilnorstu", k=draw.randint(1, 60))) for _ in range(count // 2)]
    return texts + ["'" * 500, " " * 500, "ab" * 4000, "<|endoftext|>" * 50]


def encoded(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_the_machines_count_like_the_library(library):
    with open(PATH, "rb") as file:
        machine = CountMachine(file.read())
    texts, known = odd_texts(20_000), PieceTable()
    counts = [c for _, _, d, o in slices(pa.array(texts)) for c in slice_counts(machine, known, d, o).tolist()]
    assert counts == [len(x) for x in encoded(library, texts)]


def test_pieces_are_those_of_the_whole_text_however_it_is_chunked(library):
    text = "".join(odd_texts(3000))
    [(_, _, data, offsets)] = slices(pa.array([text]))
    start, end, _, marked = pieces(data, offsets, b"<|endoftext|>")
    assert start[0] == 0 and end[-1] == len(data) and (start[1:] == end[:-1]).all() and marked.any()
    raw = data.tobytes()
    one_by_one = [i for a, b in zip(start, end) for i in library.encode(raw[a:b].decode(), add_special_tokens=False).ids]
    assert one_by_one == library.encode(text, add_special_tokens=False).ids


def test_token_counts(awkward, nothing, library):
    docs, rows = awkward
    out = token_counts(docs, PATH)
    texts = [r["text"] for r in rows]
    want = [(r["doc_id"], len((t or "").encode()), len(x), len(x) > 512) for r, t, x in zip(rows, texts, encoded(library, texts))]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts(nothing, PATH).count() == 0


# ---- Packing. ----


def check_packed(out, wanted, window):
    """Each id in exactly one piece, sequences full or of a power of two, offsets without gaps."""
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], ids))
    for held in by_sequence.values():
        place = 0
        for offset, length in sorted(held):
            assert offset == place
            place += length
        assert place == window or place & (place - 1) == 0 and place < window
    whole = collections.Counter((d, tuple(x)) for d, x in wanted)
    for (doc, size), cuts in by_doc.items():
        same = [x for (d, x), n in whole.items() if d == doc and len(x) == size for _ in range(n)]
        assert sum(len(x) for _, x in cuts) == size * len(same)
        if len(same) == 1:
            assert tuple(i for _, x in sorted(cuts, key=lambda c: c[0]) for i in x.tolist()) == same[0]
    assert sum(len(x) for v in by_doc.values() for _, x in v) == sum(len(x) for _, x in wanted)


@pytest.mark.parametrize("window", [2048, 64])
def test_packing(awkward, nothing, library, window):
    docs, rows = awkward
    wanted = [(r["doc_id"], [*x, 1]) for r, x in zip(rows, encoded(library, [r["text"] for r in rows]))]
    out = packing.pack(docs, PATH, window=window).collect()
    check_packed(out, wanted, window)
    crc = {(r["doc_id"], r["start"], r["length"], r["doc_tokens"]): r["ids_crc32"] for r in packing.digest(packing.pack(docs, PATH, window=window)).collect()}
    for r in out:
        assert crc[r["doc_id"], r["start"], r["length"], r["doc_tokens"]] == zlib.crc32(bytes(r["ids"]))
    assert packing.pack(nothing, PATH).count() == 0


def test_windows_are_filled_by_lexical_neighbours():
    """Two topics in one shard: the seed's window takes the texts that share its rare ids."""
    draw = np.random.default_rng(3)
    topics = [np.arange(5000, 5040), np.arange(9000, 9040)]
    texts = [draw.choice(np.concatenate([np.arange(300, 320), topics[i % 2]]), 64).astype(np.uint16) for i in range(40)]
    packer = packing._Packer(256, 0)
    rest = packer.pack([[i, 0, len(t)] for i, t in enumerate(texts)], texts)
    rows = collections.defaultdict(set)
    for row, _, _, sequence, _ in packer.out:
        rows[sequence].add(row % 2)
    assert len(rows) == 10 and not rest
    assert sum(len(v) == 1 for v in rows.values()) >= 9


def test_bm25_scores_are_the_formula():
    texts = [np.array(t) for t in ([1, 2, 2, 3], [2, 3, 4], [5, 5, 1], [6, 7], [8, 9, 10, 2], [11, 12])]
    index = packing._Index(texts)
    n, mean = len(texts), sum(map(len, texts)) / len(texts)
    for seed in range(n):
        want = np.zeros(n)
        for term in set(texts[seed].tolist()):
            df = sum(term in t for t in texts)
            idf = max(0.0, np.log((n - df + 0.5) / (df + 0.5)))
            for d, t in enumerate(texts):
                tf = int((t == term).sum())
                if tf and df > 1:
                    want[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
        assert np.allclose(index.scores(seed), want)


def test_weights_are_those_of_all_documents():
    """The ids of a shard full of copies still count, as rare as they are among all documents."""
    texts = [np.array([5, 6, 7, 7])] * 8 + [np.array([8, 9]), np.array([8, 10, 11])]
    counts = {-1: 100, -2: 500, 5: 8, 6: 60, 7: 8, 8: 40, 9: 1, 10: 2, 11: 100}
    rarity = packing._rarity(counts, 12)
    assert rarity[1] == 5 and (rarity[0][5:] > 0).all()
    index = packing._Index(texts, rarity)
    for seed in range(len(texts)):
        want = np.zeros(len(texts))
        for term in set(texts[seed].tolist()):
            idf = np.log(1 + (100 - counts[term] + 0.5) / (counts[term] + 0.5))
            for d, t in enumerate(texts):
                tf = int((t == term).sum())
                if tf and sum(term in x for x in texts) > 1:
                    want[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / 5))
        assert np.allclose(index.scores(seed), want, rtol=1e-5) and want.max() > 0


def test_documents_are_counted_over_all_rows():
    texts = [[3, 3, 4], [4], [1, 4, 5], [1]]
    bodies = pa.array([np.array(t, np.uint16).tobytes() for t in texts], pa.binary())
    batches = [pa.RecordBatch.from_arrays([bodies[:3]], names=["ids"]), pa.RecordBatch.from_arrays([bodies[3:]], names=["ids"])]
    [out] = packing._document_counts(8, False)(iter(batches))
    assert dict(zip(*(c.to_pylist() for c in out.columns))) == {1: 2, 3: 1, 4: 3, 5: 1, -1: 4, -2: 8}


# ---- Vectors. ----


def brute_vectors(rows, least):
    good = [r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    top, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[i] += 1
                    links[j] += 1
                    top[find(i)] = find(j)
    classes = collections.defaultdict(list)
    for i, r in enumerate(rows):
        classes[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        first = min((x for x in classes[find(i)] if x is not None), default=None)
        out.append((r[0], links[i], first, r[0] is not None and r[0] == first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [64, 24, 5, 1])
def test_vectors(spark, size):
    draw = np.random.default_rng(size)
    base = draw.standard_normal((40, size))
    near = [base[i % 40] + draw.standard_normal(size) * draw.choice([0.05, 0.2, 0.3]) for i in range(200)]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *near])]
    rows += [(900, rows[3][1]), (901, [2 * x for x in rows[3][1]]), (902, [-x for x in rows[3][1]]), (3, rows[3][1]), (None, rows[3][1])]
    rows += [(910, None), (911, []), (912, [0.0] * size), (913, [float("nan")] * size), (914, [None] * size), (915, [1.0] * (size + 1)), (916, [float("inf")] * size)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash")).withColumn("label", F.lit(1))
    assert sorted(map(tuple, NearVectors(df.repartition(3)).report().collect()), key=repr) == brute_vectors(rows, 0.95)
    assert NearVectors(df.limit(0)).report().count() == 0


# ---- Toxicity. ----


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(800)]
    bad = ["idiotic", "trashy", "scummy"]
    rows, labels = [], []
    for i in range(900):
        text = [draw.choice(words) for _ in range(draw.randint(5, 60))]
        toxic = i % 6 == 0
        for _ in range(draw.randint(2, 4) if toxic else 0):
            text.insert(draw.randint(0, len(text)), draw.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: t for i, _, t in labels}


def test_held_out_rows_are_judged_right(labelled):
    docs, labels, truth = labelled
    out = toxicity.judged(toxicity.Toxicity(docs, labels).report()).collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    unseen = [r for r in out if r["held_out"]]
    assert len(unseen) > 150
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in unseen) >= 0.98 * len(unseen)


def test_held_out_labels_are_not_learnt(labelled, spark):
    docs, labels, _ = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(map(tuple, toxicity.Toxicity(docs, x).report().select("doc_id", "score").collect())) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_the_nearest_are_exact(labelled):
    docs, labels, _ = labelled
    index = toxicity.Toxicity(docs, labels).index.value
    for terms, weights in index.vectors:
        dense = np.zeros(len(index.idf))
        dense[terms] = weights
        cosines = np.array([dense[t] @ w for t, w in index.vectors])
        name, cosine = index.nearest(terms, weights, 5)
        kth = np.sort(cosines)[-min(5, len(cosines))]
        assert set(np.flatnonzero(cosines >= kth + 1e-9)) <= set(name.tolist())
        assert np.allclose(cosine, cosines[name]) and (cosine >= kth - 2e-9).all()


def test_toxicity_of_awkward_rows(awkward, nothing, labelled, spark):
    docs, rows = awkward
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(9)] + [(4, 1, 1), (None, 0, 1), (7, 0, None), (777, 0, 1)], "doc_id long, quality int, toxic int")
    job = toxicity.Toxicity(docs, labels)
    out = job.report().collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert job.kept(2.0).count() == len(rows) and job.kept(2.0).columns == docs.columns and job.kept(0.0).count() == 0
    assert toxicity.Toxicity(nothing, labels).report().count() == 0
    unlabelled = toxicity.judged(toxicity.Toxicity(docs, labels.limit(0)).report()).collect()
    assert {(r["score"], r["predicted"]) for r in unlabelled} == {(0.0, 0)}


def test_examples_of_repeated_ids_do_not_depend_on_the_order(spark):
    """Every id has a toxic-looking and a clean-looking text; whatever comes first, scores are equal."""
    bad, good = "grumble snarl wretch", "meadow linen harbour"
    data = [(i, f"{bad} n{i}" if (i + turn) % 2 else f"{good} m{i}") for turn in (0, 1) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    scores = []
    for mixed in (data, data[::-1]):
        df = spark.createDataFrame(mixed, "doc_id long, text string").repartition(3 + len(scores))
        out = toxicity.Toxicity(df, labels).report().select("doc_id", "score", F.to_json("evidence"))
        scores.append(sorted(map(tuple, out.collect())))
    assert scores[0] == scores[1] and len(scores[0]) == 400


def test_held_out_recall_in_every_language(spark):
    """Given labels: markers of a language with few examples, each seen a few times, count too."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    out = toxicity.judged(toxicity.Toxicity(docs, labels).report())
    known = out.filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = [(r["lang"], r["toxic"], r["predicted"]) for r in known.collect() if r["toxic"] is not None]
    for lang in ("de", "en", "es", "fr"):
        found = [p for x, t, p in rows if x == lang and t]
        assert len(found) > 10 and sum(found) >= 0.85 * len(found), lang
    flagged = [t for _, t, p in rows if p]
    assert sum(flagged) >= 0.95 * len(flagged)


def test_the_least_ratio_follows_from_the_terms():
    assert toxicity._least_ratio({}) == toxicity._least_ratio({0: 1000}) == np.inf
    few = toxicity._least_ratio({0: 100_000, 20 * 16: 1})
    many = toxicity._least_ratio({0: 100_000, 20 * 16: 40})
    assert (few, many) == (np.inf, 20.0)
