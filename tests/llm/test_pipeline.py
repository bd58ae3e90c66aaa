from pathlib import Path

import duckdb
import pytest
from test_bpe import PATH, PATTERN
from test_decontaminate import brute as brute_hits
from test_line_dedup import brute as brute_lines
from test_near_dedup import shingles

import corpus_pipeline
from squadweave.llm import bpe
from squadweave.llm.common import forget_written, shared_folder, written
from squadweave.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = written(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SF_DIR)))
    return found


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_stages_are_the_dealt_ones(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert all(d.columns == COLUMNS for d in steps[:-1])
    assert all(r.n_chars == len(r.text) for d in steps[2:-1] for r in d.collect())


def test_quality_stage(spark, steps):
    kept = {r.doc_id for r in QUERIES["op6_quality_rules"](spark, SF_DIR).collect() if r.kept}
    before = texts(steps[0])
    assert texts(steps[1]) == {k: before[k] for k in kept} and len(kept) < len(before)


def test_line_stage_agrees_with_brute_force(steps):
    cut = brute_lines(sorted(texts(steps[1]).items()), 50)
    assert texts(steps[2]) == {k: text for k, (text, n) in cut.items() if not n or text.strip(" \t\n\x0b\f\r")}


def test_near_stage_agrees_with_brute_force(steps):
    before = texts(steps[2])
    sets = {k: shingles(t) for k, t in before.items()}
    group = {k: k for k in sets}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if b < a else 0
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    assert texts(steps[3]) == {k: before[k] for k in sets if root(k) == k}


def test_near_stage_leaves_one_row_of_repeated_and_null_ids(spark):
    def some(name, n=60):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [(1, some("a")), (5, some("b"))] + [(7, some("c"))] * 50
    rows += [(5, some("a") + " more"), (None, some("b") + " more"), (None, some("d")), (None, some("d")), (None, some("e"))]
    rows += [(9, some("d") + " more"), (8, some("f")), (8, some("f") + " more"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    kept = corpus_pipeline.near(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, (r.text or "-")[0]) for r in kept.collect()), key=repr)
    assert found == sorted([(1, "a"), (5, "b"), (7, "c"), (9, "d"), (None, "e"), (8, "f"), (None, "-")], key=repr)


def test_benchmark_stage_agrees_with_brute_force(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    for doc_id, text in before.items():
        words, hit, _ = brute_hits(text, items, 10)
        assert (doc_id in after) == (hit <= 0.5 * words)
        if doc_id in after:
            assert brute_hits(after[doc_id], items, 10)[1] == 0
            assert (after[doc_id] == text) == (hit == 0)


def test_token_stage_and_run(spark, steps):
    expected = sorted(map(tuple, bpe.round_trip(steps[4], PATH, PATTERN).collect()))
    assert sorted(map(tuple, steps[5].collect())) == expected
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == expected


def test_stages_on_odd_and_empty_documents(spark, odd_docs):
    docs = odd_docs.select(COLUMNS)
    for limit in (docs, docs.limit(0)):
        here = limit
        for name, stage in corpus_pipeline.STAGES:
            here = written(stage(spark, here, SF_DIR))
            assert here.columns == COLUMNS or name == "byte_bpe"
            assert here.count() <= limit.count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_agree_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = duck.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(map(repr, found.fetchall()))


def test_written_tables_lie_in_the_shared_folder(spark):
    path = written(spark.range(3)).inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir") in path


def test_forgetting(spark):
    assert written(spark.range(3)).count() == 3
    folder = Path(shared_folder(spark).removeprefix("file:"))
    assert folder.exists()
    forget_written(spark)
    assert not folder.exists()
