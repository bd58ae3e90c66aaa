import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from squadweave.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeated = set()
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            repeated.update(range(k, k + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


@pytest.fixture(scope="module")
def cascade(spark, odd_docs):
    return Q.measure(odd_docs)


def counts(rows):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]


def test_counts_agree_with_brute_force(spark, cascade):
    pick = random.Random(5)
    texts = [None, "", " \n\t", "a", "a b c d e f g h", "a " * 40, "x y z " * 30 + "\n" + "x y z\n" * 5, "# * | é ü <b>"]
    texts += [" ".join(pick.choice("ab") for _ in range(pick.randint(0, 60))) for _ in range(300)]
    texts += ["\n".join(pick.choice(["a b", " a b", "", "é ü ß", "|"]) for _ in range(12)) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in Q.statistics(docs, cascade).collect():
        found = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert found == brute(texts[row.doc_id])
        failed = found[0] < 20 or 100 * found[4] > 30 * found[0]
        assert row.base_failed == failed and not (failed and row.kept)


def test_the_order_of_rules_never_changes_the_verdict(spark, odd_docs, cascade):
    turned = Q.Cascade(cascade.measured)
    turned.order = cascade.order[::-1]
    both = [sorted(r.rejected_by is None for r in Q.judged(odd_docs, c).collect()) for c in (cascade, turned)]
    assert both[0] == both[1]


def test_rules_are_tried_by_rejections_per_cost():
    cascade = Q.Cascade({"dear": (10.0, 0.5), "cheap": (1.0, 0.1), "idle": (0.1, 0.0)})
    assert cascade.order == ["cheap", "dear", "idle"]


def test_later_rules_are_not_evaluated(spark):
    """The second rule would fail the query on the row that the first rejects."""
    docs = spark.createDataFrame([("a b c",)], "text string")
    chain = F.when(F.col("text") == "a b c", "first").when(F.raise_error(F.lit("evaluated")).isNotNull(), "second")
    assert docs.select(chain).first()[0] == "first"


def test_clean_prose_passes_and_junk_does_not(spark, cascade):
    prose = "It was a quiet evening and the rain had stopped at last; people came out to look at the river again, talking softly. "
    cases = {
        1: prose,
        2: prose.replace(" ", "*** "),
        3: prose.upper().replace(" ", "!! "),
        4: "word " * 60,
        5: "too short",
        6: "a a a a a b b b b b c c c c c d d d d d e e e e e",
    }
    docs = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    assert [r.doc_id for r in Q.passing(docs, cascade).collect()] == [1]


def test_odd_documents(odd_docs, no_docs, cascade):
    rows = counts(Q.statistics(odd_docs, cascade).collect())
    assert sorted(map(repr, rows)) == sorted(repr((r.doc_id, *brute(r.text))) for r in odd_docs.collect())
    judged = Q.judged(odd_docs, cascade)
    assert sorted(judged.columns) == sorted(odd_docs.columns) and judged.count() == odd_docs.count()
    assert Q.passing(odd_docs, cascade).columns == odd_docs.columns
    assert Q.statistics(no_docs).collect() == [] and Q.passing(no_docs).collect() == []


def test_plan_is_native(odd_docs, cascade):
    plan = Q.statistics(odd_docs, cascade)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
