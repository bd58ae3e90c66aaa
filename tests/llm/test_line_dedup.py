import random
import re
from collections import defaultdict

import pytest

from squadweave.llm import line_dedup as D

BLANKS = " \t\n\x0b\f\r"


def brute(rows, min_words):
    """Cut the lines of every shortest run of min_words words, from either end, that has an earlier occurrence."""
    runs, first = [], {}
    for doc_id, text in rows:
        lines = [(k, x.strip(BLANKS)) for k, x in enumerate((text or "").split("\n"))]
        lines = [(k, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for k, x in lines if x]
        spans = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(x[2] for x in lines[a : b + 1]) >= min_words:
                    if sum(x[2] for x in lines[a:b]) < min_words or sum(x[2] for x in lines[a + 1 : b + 1]) < min_words:
                        spans.add((a, b))
                    break
        for b in range(len(lines)):
            for a in range(b, -1, -1):
                if sum(x[2] for x in lines[a : b + 1]) >= min_words:
                    spans.add((a, b))
                    break
        for a, b in spans:
            key = tuple(x[1] for x in lines[a : b + 1])
            runs.append((doc_id, lines[a][0], lines[b][0], key))
            first[key] = min(first.get(key, (doc_id, lines[a][0])), (doc_id, lines[a][0]))
    cut = defaultdict(set)
    for doc_id, a, b, key in runs:
        if first[key] != (doc_id, a):
            cut[doc_id].update(range(a, b + 1))
    return {
        doc_id: ("\n".join(x for k, x in enumerate(text.split("\n")) if k not in cut[doc_id]) if cut[doc_id] else text, len(cut[doc_id]))
        for doc_id, text in rows
    }


@pytest.mark.parametrize("min_words", [4, 7, 12])
def test_agrees_with_brute_force(spark, min_words):
    pick = random.Random(min_words)
    lines = ["a b c", "d e f g", "h i", " h i", "", "j k l m n", "o"]
    rows = [(k, "\n".join(pick.choice(lines) for _ in range(pick.randint(0, 14)))) for k in range(200)]
    found = D.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), min_words=min_words)
    assert {r.doc_id: (r.text, r.lines_cut) for r in found.collect()} == brute(rows, min_words)


def test_a_repeated_run_goes_whole_and_its_first_occurrence_stays(spark):
    run = [f"line {k} has " + " ".join(f"w{k}{j}" for j in range(6)) for k in range(8)]
    rows = [(3, ["own three", *run, "tail three"]), (1, [*run]), (2, ["head two", *run[1:], "tail two"]), (4, run[:3])]
    docs = spark.createDataFrame([(k, "\n".join(x)) for k, x in rows], "doc_id long, text string")
    found = {r.doc_id: r.text for r in D.deduplicated(docs).collect()}
    assert found == {1: "\n".join(run), 2: "head two\ntail two", 3: "own three\ntail three", 4: "\n".join(run[:3])}


def test_one_long_line_is_a_run(spark):
    line = " ".join(f"w{k}" for k in range(51))
    docs = spark.createDataFrame([(1, f"a\n{line}"), (2, f"{line} \nb"), (3, line.replace("w5 ", "x "))], "doc_id long, text string")
    assert {r.doc_id: r.text for r in D.deduplicated(docs).collect()} == {1: f"a\n{line}", 2: "b", 3: line.replace("w5 ", "x ")}


def test_odd_documents(odd_docs, no_docs):
    found = D.deduplicated(odd_docs)
    assert found.columns == [c for c in odd_docs.columns if c != "lines_cut"] + ["lines_cut"]
    before, after = ([r for r in d.collect()] for d in (odd_docs, found))
    assert len(before) == len(after)
    untouched = sorted(repr((r.doc_id, r.text)) for r in before if r.doc_id != 5)
    assert sorted(repr((r.doc_id, r.text)) for r in after if r.doc_id != 5) == untouched
    (long,) = [r for r in after if r.doc_id == 5]
    assert 0 < len(long.text.split("\n")) < 10 and long.lines_cut > 3900
    assert D.deduplicated(no_docs).collect() == []


def test_a_null_id_comes_first(spark):
    line = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, line), (None, line), (None, line)], "doc_id long, text string")
    assert sorted(repr((r.doc_id, r.lines_cut)) for r in D.deduplicated(docs).collect()) == ["(1, 1)", "(None, 0)", "(None, 0)"]


def test_plan_is_native(odd_docs):
    plan = D.deduplicated(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
