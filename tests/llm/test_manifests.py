"""Licence blocks, phrases and Merkle proofs against brute force."""

import collections
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, merkle, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def key(row):
    return repr(row)


# Licences


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_blocks(text, templates, said):
    """Per template the starts of blocks that hold the share; per phrase its places."""
    w, best, places = words(text), {}, []
    for i, t in enumerate(templates):
        tw = words(t.text)
        size, wanted = min(len(tw), len(w)), set(tw)
        for start in range(len(w) - size + 1 if size else 0):
            share = len(wanted & set(w[start : start + size])) / len(wanted)
            if share >= t.share - 1e-12:
                best.setdefault(t.label, {})[i, start] = share
    for label, phrase in said:
        p = words(phrase)
        places += [(label, i) for i in range(len(w)) if w[i : i + len(p)] == p]
    return w, best, places


def brute_licenses(rows, templates, said):
    out = []
    for r in rows:
        w, best, places = brute_blocks(r["text"], templates, said)
        labels = {x for x, _ in places}
        shares = [s for found in best.values() for s in found.values()] + [1.0] * bool(places)
        starts = [i for _, i in places]
        out.append(
            (
                r["doc_id"],
                len(w),
                len(places),
                min(starts, default=None),
                max(starts, default=None),
                ",".join(sorted(labels)),
                ",".join(sorted(labels | set(best))),
                max(shares, default=0.0),
            )
        )
    return sorted(out, key=key)


def scanned(docs, *given):
    return sorted((tuple(r) for r in licenses.digest(licenses.LicenseScan(docs, *given).scanned()).collect()), key=key)


def test_licenses_in_awkward_rows(spark, awkward, nothing):
    docs, rows = awkward
    assert scanned(docs) == brute_licenses(rows, licenses.TEMPLATES, licenses.PHRASES)
    assert scanned(nothing) == []


def test_every_block_is_found(spark):
    rng = random.Random(3)
    vocabulary = ["the", "a", "of", "cc", "by", "nc", "free", "work", "law", "under", "rights", "all", "Reserved"]
    templates = (
        licenses.Template("half", "the work of the law is free", 0.5),
        licenses.Template("most", "all rights of the free work under law", 0.8),
        licenses.Template("whole", "cc by nc", 1.0),
        licenses.Template("one", "reserved", 0.1),
    )
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 40]))) for _ in range(400)]
    texts += ["all rights reserved. ALL RIGHTS RESERVED", "cc by cc by, cc\nby", "all rights", None, ""]
    texts += ["all rights reserved " * 2000, texts[0], texts[0]]
    rows = [{"doc_id": i, "text": t} for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    assert scanned(docs, templates) == brute_licenses(rows, templates, licenses.PHRASES)
    found = collections.defaultdict(set)
    for r in licenses.LicenseScan(docs, templates).blocks().filter("not phrase").collect():
        found[r["doc_id"], r["label"]] |= set(range(r["first_word"], r["end_word"]))
    want = collections.defaultdict(set)
    for r in rows:
        w, best, _ = brute_blocks(r["text"], templates, ())
        for label, starts in best.items():
            for i, start in starts:
                want[r["doc_id"], label] |= set(range(start, start + min(len(words(templates[i].text)), len(w))))
    assert found == want


def test_a_planted_licence_with_changed_words_is_found(spark):
    mit = next(t for t in licenses.TEMPLATES if t.label == "mit" and t.share < 1)
    said = mit.text.split()
    said[5], said[20] = "somebody", "else"
    text = "Some prose before. " + " ".join(said) + " and prose after"
    docs = spark.createDataFrame([(1, text), (2, "Some prose about software and a notice")], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.digest(licenses.LicenseScan(docs).scanned()).collect()}
    assert got == {1: "mit", 2: ""}


def test_templates_must_have_words(spark, nothing):
    with pytest.raises(ValueError):
        licenses.LicenseScan(nothing, (licenses.Template("x", " ", 1.0),))


# Phrases


def brute_phrases(rows, least, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    scores = collections.defaultdict(list)
    for (lang, *w), a in candidates.items():
        cuts = []
        for k in range(1, len(w)):
            left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        longer = (
            b
            for (other, *v), b in candidates.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
        )
        if not any(100 * b >= 80 * a for b in longer):
            scores[lang].append((-score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang, found in scores.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=key)


def mined(docs, least, top=2000, **more):
    return sorted((tuple(r) for r in phrases.Phrases(docs, least=least, **more).best(top).collect()), key=key)


def corpus(rng, count):
    vocabulary = [f"w{i}" for i in range(30)] + ["Ünder", "a\x00b", " x", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["new york city hall", "New\tYork", "of the the the", "x, y; z"]
    rows = []
    for _ in range(count):
        parts = [
            rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 6)))
            for _ in range(rng.randint(0, 12))
        ]
        text = "".join(p + rng.choice([" ", ". ", "\n", "  \t", ",", "!"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return rows


@pytest.mark.parametrize("small", [{}, {"shard_bytes": 300, "states": 200}])
def test_phrases_by_brute_force(spark, small):
    """Also with shards so small that slices are sent one by one and united a few at a time."""
    rows = [*corpus(random.Random(len(small)), 500), ("en", None), (None, ""), ("fr", "one two"), ("hot", "again and " * 3000)]
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "lang string, text string, n long, phrase long").repartition(5)
    assert mined(docs, 5, **small) == brute_phrases(rows, 5)
    assert mined(docs, 5, 3, **small) == brute_phrases(rows, 5, 3)


def test_phrases_of_awkward_rows(spark, awkward, nothing):
    docs, rows = awkward
    assert mined(docs, 3) == brute_phrases([(r["lang"], r["text"]) for r in rows], 3)
    assert mined(nothing, 3) == []


def test_transducers_add_up():
    """Cutting, writing, reading and uniting a transducer gives it back, whatever the shards."""
    import pyarrow as pa

    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcde", k=30)) for _ in range(20)]

    def of(some):
        raw = "".join(some).encode()
        ends = np.concatenate([[0], np.cumsum([len(t) for t in some])])
        w = phrases.Words(np.frombuffer(raw, np.uint8), ends, pa.array(["en"] * len(some)))
        return phrases.Transducer.of(w, w.joined, 2, 4)

    def content(t):
        return sorted(tuple(r.values()) for b in t.phrases(1) for r in b.to_pylist())

    whole = of(texts)
    united = phrases.Transducer.union([of([t]) for t in texts])
    limits = phrases.Limits([("b", 3.0), ("c", 9.0), ("d", 1.0)], 40)
    pieces = [p for _, p in whole.cut(limits)]
    assert len(pieces) > 5
    again = phrases.Transducer.union([phrases.Transducer.read(p.written()) for p in pieces])
    counts = collections.Counter(" ".join(x[i : i + k]) for t in texts for x in [t.split()] for k in (2, 3, 4) for i in range(31 - k))
    assert content(whole) == sorted(("en", p, n) for p, n in counts.items())
    assert content(united) == content(whole) == content(again)


# Merkle manifest


def H(text):
    return sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        other = i ^ 1
        out.append((other < i, nodes[other] if other < len(nodes) else None))
        i //= 2
    return out


def brute_manifest(rows):
    def leaf(r):
        return H("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in merkle.FIELDS))

    parts = collections.defaultdict(list)
    for r in rows:
        parts[r["lang"]].append(r)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in order:
        mine = sorted(parts[p], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[p] = mine, levels([leaf(r) for r in mine])
    crown, out = levels([trees[p][1][-1][0] for p in order]) if order else [], []
    for k, p in enumerate(order):
        mine, tree = trees[p]
        for i, r in enumerate(mine):
            way, claim = path(tree, i) + path(crown, k), dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                claim["n_chars"] += 1
            x, root = leaf(claim), crown[-1][0]
            for left, other in way:
                x = H(x) if other is None else H(other + x) if left else H(x + other)
            proof = H("".join(s for _, s in way if s))
            out.append((r["doc_id"], leaf(r), tree[-1][0], root, proof, x, x == root))
    return sorted(out, key=key)


def manifest(docs, bits):
    made = merkle.Manifest(docs, merkle.FIELDS, claims=merkle.tampered(), bits=bits)
    return sorted((tuple(r) for r in made.report().collect()), key=key)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_by_brute_force(spark, bits):
    """Parts of many sizes over several tiers of blocks."""
    sizes = {None: 9, "": 1, "de": 33, "en": 64, "es": 2, "fr": 65, "zz": 5}
    rows = [
        {"doc_id": 1000 * i + j, "source": None if j % 5 else "s", "lang": lang, "n_chars": None if j % 11 == 3 else j, "text": f"ä{j}"}
        for i, (lang, n) in enumerate(sizes.items())
        for j in range(n)
    ]
    docs = spark.createDataFrame(
        [(*(r[c] for c in merkle.FIELDS), 0, 0) for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, part long, rank long",
    ).repartition(6)
    got = manifest(docs, bits)
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_awkward_rows(spark, awkward, nothing):
    docs, rows = awkward
    assert manifest(docs, 2) == brute_manifest(rows)
    assert manifest(nothing, 2) == []


def test_proofs_lead_to_the_root(spark, awkward):
    docs, _ = awkward
    made = merkle.Manifest(docs, merkle.FIELDS, bits=2)
    [root] = [r["root"] for r in made.root().collect()]
    rows = made.proofs().collect()
    assert all(r["verified"] and r["root"] == root for r in rows)
    assert all(H("".join(r["siblings"])) == r["proof_sha256"] for r in rows)
    assert sorted(r["position"] for r in rows if r["subroot"] == rows[0]["subroot"])[0] == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100])
def test_places_in_the_log(n):
    """The closed form names where the appended nodes are."""
    leaves = [bytes([i]) * 32 for i in range(n)]
    log = merkle.append_all(leaves, merkle.height(n))
    nodes = leaves
    for level in range(merkle.height(n) + 1):
        for i, node in enumerate(nodes):
            assert log[merkle.place(level, i, n)] == node
        nodes = [merkle.parent(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    assert len(log) == merkle.place(merkle.height(n), 0, n) + 1
