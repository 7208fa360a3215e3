"""Sharding, lines, n-gram join and decontamination against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PROSE
from tidemark.llm.components import components
from tidemark.llm.contamination import Decontamination, digest
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.near_text import NearTexts, signatures
from tidemark.llm.sharding import Shard, ShardTree, shard_of, shard_rows

LOWER = {i: i + 32 for i in range(65, 91)}


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- Sharding. ----


def test_shards_number_every_row(awkward):
    docs, rows = awkward
    out = shard_rows(docs, ShardTree.of(16)).collect()
    assert len(out) == len(rows)
    want = sorted((r["doc_id"] is None, r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows if True)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = collections.defaultdict(set)
    for r in out:
        by_id[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_id.values())


def test_no_rows_no_shards(nothing):
    assert shard_rows(nothing, ShardTree.of(16)).count() == 0


def test_weights_draw_their_share_and_confine_movement(spark):
    tree = ShardTree((Shard("a", "x", 0, 1.0), Shard("a", "y", 1, 3.0), Shard("b", "z", 2, 4.0)))
    keys = spark.range(40_000)
    heavier = ShardTree((Shard("a", "x", 0, 1.0), Shard("a", "y", 1, 3.0), Shard("b", "z", 2, 8.0)))
    moved = keys.select(shard_of(F.col("id"), tree).alias("old"), shard_of(F.col("id"), heavier).alias("new"))
    counts = {r["old"]: r["count"] for r in moved.groupBy("old").count().collect()}
    assert [round(counts[i] / 40_000, 1) for i in range(3)] == [0.1, 0.4, 0.5]
    # Only region b gained weight: rows move into it, and inside region a nothing moves.
    assert {(r["old"], r["new"]) for r in moved.filter("old <> new").distinct().collect()} == {(0, 2), (1, 2)}
    grown = keys.select(shard_of(F.col("id"), tree).alias("old"), shard_of(F.col("id"), tree.grown()).alias("new"))
    assert {r["new"] for r in grown.filter("old <> new").distinct().collect()} == {3}


def test_the_sharding_plan_is_native(awkward):
    plan = shard_rows(awkward[0], ShardTree.of(16))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- Lines. ----


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute_lines(rows, least):
    seen = collections.Counter()
    for _, t in rows:
        seen.update({line_key(x) for x in (t or "").split("\n")})
    bad = {k for k, n in seen.items() if n >= least and k}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if line_key(x) not in bad]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast_keys", [1 << 21, 0])
def test_lines(spark, awkward, broadcast_keys):
    random.seed(1)
    stock = ["Same line", " same LINE\t", "", "  ", "other", "café", "x" * 5000, "\x0b", " "]
    rows = [(i, "\n".join(random.choices([*stock, f"own {i}"], k=random.randint(0, 8)))) for i in range(60)]
    rows += [(r["doc_id"], r["text"]) for r in awkward[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = drop_repeated_lines(df, 10, digest=True, broadcast_keys=broadcast_keys)
    assert got(out) == brute_lines(rows, 10)


def test_lines_keep_all_columns_and_the_first(spark, awkward, nothing):
    docs, rows = awkward
    assert drop_repeated_lines(docs).columns == docs.columns
    assert drop_repeated_lines(nothing).count() == 0
    df = spark.createDataFrame([(i, f"top\nline {i}\ntop") for i in range(12)], "doc_id long, text string")
    for most in (1 << 21, 0):
        kept = dict(got(drop_repeated_lines(df, keep_first=True, broadcast_keys=most)))
        assert kept[0] == "top\nline 0" and all(kept[i] == f"line {i}" for i in range(1, 12))


# ---- N-gram Jaccard join. ----


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = [x for x in re.split("[ \t-\r]+", (t or "").translate(LOWER)) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                top[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append(d)
    known = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, len(sets[i]), known[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def near_family(seed, copies, size, rate):
    """Copies of one text with words changed at `rate`: many pairs close to the threshold."""
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(size)]
    return [" ".join(f"x{draw.randint(0, 10**6)}" if draw.random() < rate else w for w in base) for _ in range(copies)]


def test_near_texts(spark, awkward):
    texts = [r["text"] for r in awkward[1]]
    for seed, (copies, size, rate) in enumerate([(60, 120, 0.02), (60, 40, 0.03), (40, 12, 0.05), (25, 700, 0.02), (80, 60, 0.015)]):
        texts += near_family(seed, copies, size, rate)
    shared = near_family(99, 1, 80, 0)[0]
    texts += [f"{shared} {t}" for t in near_family(98, 50, 30, 1.0)] + ["one two", "ONE  two", "one", "one two three four five"]
    rows = list(enumerate(texts)) + [(None, "one two"), (3, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(NearTexts(df).report()) == brute_near(rows)


def test_near_texts_keep_one_row_of_each_class(spark, awkward, nothing):
    docs, rows = awkward
    near = NearTexts(docs)
    kept = near.kept()
    assert kept.columns == docs.columns
    brute = brute_near([(r["doc_id"], r["text"]) for r in rows])
    empty = sum(n == 0 for _, n, _ in brute)
    classes = {c for _, n, c in brute if n}
    assert kept.count() == empty + len(classes)
    prose = [r for r in kept.collect() if r["text"] and r["text"].lower().startswith(PROSE.lower()[:20])]
    assert [r["doc_id"] for r in prose] == [4]
    assert NearTexts(nothing).report().count() == 0 and NearTexts(nothing).kept().count() == 0


def test_linked_sets_share_a_signature():
    """The prefix argument itself, over random sets near the threshold and random token levels."""
    import numpy as np

    draw = np.random.default_rng(5)
    for _ in range(3000):
        n = int(draw.integers(1, 90))
        pool = np.unique(draw.integers(1, 1 << 63, 2 * n + 4).astype(np.uint64))
        level_of = dict(zip(pool.tolist(), draw.choice(4, len(pool), p=[0.3, 0.4, 0.2, 0.1]).tolist()))
        x = np.sort(draw.choice(pool, min(n, len(pool)), replace=False))
        y = x[draw.random(len(x)) > 0.12]
        fresh = np.setdiff1d(pool, x)
        y = np.sort(np.concatenate([y, fresh[: int(draw.integers(0, 1 + len(x) // 10))]]))
        both = len(np.intersect1d(x, y))
        if not both or 100 * both < 80 * (len(x) + len(y) - both):
            continue
        marks = [dict(zip(*(c.tolist() for c in signatures(s, np.array([level_of[t] for t in s.tolist()]))))) for s in (x, y)]
        common = marks[0].keys() & marks[1].keys()
        assert common
        # At one of them at least, the bound lets the pair through.
        assert max(min(marks[0][m], marks[1][m]) for m in common) >= both


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500)], "a long, b long")
    found = dict(got(components(links)))
    assert all(found[i] == 0 for i in range(201)) and {found[i] for i in (500, 501, 502)} == {500}


# ---- Decontamination. ----


def brute_hits(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(lambda: collections.defaultdict(set))
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        if w:
            n = min(13, len(w))
            for k in range(len(w) - n + 1):
                windows[n][tuple(w[k : k + n])].add("null" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, found = word.findall((t or "").translate(LOWER)), set(), set()
        for n, known in windows.items():
            for k in range(len(w) - n + 1):
                if own := known.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_words", [1 << 21, 40])
def test_contamination(spark, awkward, part_words):
    docs, rows = awkward
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    items = [(1, PROSE), (2, "lazy dog"), (3, None), (4, ""), (None, "brown-fox"), (1, passage), (7, passage.upper()), (8, "a a a a a a a a a a a a a a")]
    extra = [(100, f"x {passage} y"), (101, passage.replace("seven", "7")), (102, "a " * 40), (103, passage + " " + "filler " * 400)]
    plain = [(r["doc_id"], r["text"]) for r in rows] + extra
    df = spark.createDataFrame(plain, "doc_id long, text string").withColumn("id", F.lit("clash")).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit("clash"))
    job = Decontamination(df, bench, part_words=part_words)
    want = brute_hits(plain, items)
    assert got(digest(job.report())) == want
    assert sorted((r["doc_id"] for r in job.kept().collect()), key=repr) == sorted((w[0] for w in want if not w[5]), key=repr)
    assert job.kept().columns == df.columns


def test_contamination_by_a_benchmark_of_many_parts(spark):
    """One id has a third of the words, one item is longer than a part, and items repeat."""
    rng = random.Random(5)

    def text(n):
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(n))

    long_one = text(900)
    items = [(1, text(30)) for _ in range(30)] + [(2, long_one)] + [(3, text(12))] * 40 + [(10 + i, text(25)) for i in range(20)]
    words = long_one.split()
    # Passages around every place where the long item may have been cut, and whole items.
    docs = [(i, "x " + " ".join(words[i : i + 40]) + " y") for i in range(0, 880, 7)]
    docs += [(1000 + i, f"{t} {text(60)}") for i, (_, t) in enumerate(items[::3])] + [(5000, text(300)), (5001, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    job = Decontamination(df, bench, part_words=600)
    assert len(job.parts) > 2
    assert all(len(part.value.words) <= 600 for part, _ in job.parts)
    assert got(digest(job.report())) == brute_hits(docs, items)
    # What is sent holds nothing but words, windows and prefixes.
    assert all(not hasattr(part.value, "by_size") for part, _ in job.parts)


def test_contamination_of_and_by_nothing(awkward, nothing, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    job = Decontamination(awkward[0], none)
    assert job.report().filter("contaminated or n_hit > 0").count() == 0
    assert job.kept().count() == len(awkward[1])
    bench = spark.createDataFrame([(1, PROSE)], "item_id long, text string")
    assert Decontamination(nothing, bench).report().count() == 0
