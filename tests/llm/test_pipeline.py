"""The registered queries over whole small tables, and the pipeline stage by stage."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from tests.llm.test_texts import brute_hits, brute_lines, brute_near
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.toxicity import Toxicity
from tidemark.session import staged
from tools.compare import difference, open_duckdb

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator():
    names = [f"op{i}_" for i in range(1, 14)]
    assert [sum(q.startswith(n) for q in entry_module.queries()) for n in names] == [1] * 13
    assert "pipeline" in entry_module.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_queries_return_every_row(spark, key):
    out = QUERIES[key](spark, SF_DIR).toArrow()
    table = {"op5": "embeddings", "op10": "conversations"}.get(key.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    if key.startswith("op10"):
        assert out.num_rows == rows.select("conv_id").distinct().count() + 1
    elif key.startswith("op6"):
        assert len(set(out.column("doc_id").to_pylist())) == rows.count()
    elif key.startswith("op12"):  # the first phrases of each language, not rows of documents
        ranks = collections.defaultdict(list)
        for lang, rank in zip(out.column("lang").to_pylist(), out.column("rank").to_pylist()):
            ranks[lang].append(rank)
        assert ranks and all(sorted(r) == list(range(1, len(r) + 1)) and len(r) <= 2000 for r in ranks.values())
    else:
        assert out.num_rows == rows.count()
    assert len(set(out.column_names)) == len(out.column_names)


def test_stages_do_what_brute_force_does(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    before = docs
    after = {}
    for name, stage in stages.items():
        after[name] = staged(stage(spark, before, SF_DIR), f"test-{name}")
        before = after[name]
    rows = {n: [(r["doc_id"], r["text"]) for r in df.collect()] for n, df in after.items() if n != "packing"}
    assert all(after[n].columns == COLUMNS for n in rows)

    scores = Toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).report()
    clean = {r["doc_id"] for r in scores.filter(F.col("score") < 0.3).collect()}
    assert {d for d, _ in rows["toxicity"]} == clean

    kept = [(d, len((t or "").split("\n"))) for d, t in rows["line_dedup"]]
    want = [(d, max(1, n - gone)) for d, n, gone, _ in brute_lines(rows["toxicity"], 10)]
    assert sorted(kept) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in after["line_dedup"].collect())

    classes = brute_near(rows["line_dedup"])
    firsts = {c for _, n, c in classes if n} | {d for d, n, _ in classes if not n}
    assert sorted(d for d, _ in rows["ngram_jaccard"]) == sorted(firsts)

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    clean = sorted(d for d, *_, dirty in brute_hits(rows["ngram_jaccard"], items) if not dirty)
    assert sorted(d for d, _ in rows["decontamination"]) == clean

    lengths = collections.Counter()
    for r in after["packing"].collect():
        lengths[r["sequence_id"]] += r["length"]
    assert {r["doc_id"] for r in after["packing"].select("doc_id").collect()} == {d for d, _ in rows["decontamination"]}
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())
    assert np.mean([n == 2048 for n in lengths.values()]) > 0.8


def test_stages_survive_awkward_rows(spark, awkward):
    """Null ids and texts, repeats and clashing columns go through every stage; so does nothing."""
    docs, rows = awkward
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = staged(stage(spark, now, SF_DIR), f"awkward-{name}")
            if name != "packing":
                assert now.columns == docs.columns
        assert (now.count() > 0) == (start is docs)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_queries_against_their_sql(spark, key):
    con = open_duckdb(SF_DIR)
    got, want = QUERIES[key](spark, SF_DIR).toArrow(), con.execute(ORACLES[key]).to_arrow_table()
    assert difference(got, want) is None
