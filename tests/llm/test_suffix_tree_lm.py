import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from squadweave.llm import suffix_tree_lm as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return (text or "").translate(LOWER).encode().split() + [b""]


def brute_base(rows):
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for doc_id, text in rows:
        words = tokens(text)
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        found.append((doc_id, len(words), sum(counts[w] > 0 for w in words), round(score, 6)))
    return total, sorted(found, key=repr)


def scored(docs, **shares):
    tree, counts = L.train(docs.filter(L.in_training(F.col("doc_id"))).select("text"), **shares)
    return tree, L.score(docs, tree, counts)


@pytest.mark.parametrize("word_share", [L.WORD_SHARE, 0.01, 2.0])
def test_base_score_agrees_whatever_is_broadcast(spark, word_share):
    pick = random.Random(6)
    rows = [(k, " ".join(pick.choice(["A", "b", "ç", "d\te", "rare%d" % k]) for _ in range(pick.randint(0, 30)))) for k in range(120)]
    tree, found = scored(spark.createDataFrame(rows, "doc_id long, text string"), word_share=word_share)
    total, expected = brute_base(rows)
    assert tree.total == total
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found.collect()), key=repr)
    assert got == expected


def test_the_tree_is_a_distribution(spark):
    """Under every kind of context the probabilities of all known words and one unknown sum to 1."""
    pick = random.Random(7)
    rows = [(" ".join(pick.choice(["a b c", "a b d", "c", "e f", "b"]) for _ in range(20)),) for _ in range(60)]
    tree, _ = L.train(spark.createDataFrame(rows, "text string"), deep_share=0.001)
    words = list(tree.words)
    assert tree.retained1.any() and len(tree.context2)
    unknown = math.log10(0.1 / (tree.total + 0.1 * (tree.distinct + 1)))
    for context in ([], [b"a"], [b"a", b"b"], [b"zz", b"b"], [b"b", b"zz"]):
        total = 0.0
        for word in [*words, b"unseen"]:
            ids, starts = tree.numbers([[*context, word]])
            best = tree.logs(ids, starts)[1][-1]
            total += 10 ** (best + (unknown if ids[-1] < 0 else 0.0))
        assert total == pytest.approx(1.0, abs=1e-9)


def test_contexts_help_on_held_out_documents(spark):
    pick = random.Random(8)
    rows = []
    for k in range(400):
        words = [pick.choice("abcdefgh")]
        while len(words) < 60:
            words.append(chr((ord(words[-1]) - 97 + 1) % 8 + 97) if pick.random() < 0.8 else pick.choice("abcdefgh"))
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, found = scored(docs)
    held = found.filter(~L.in_training(F.col("doc_id"))).agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 0.6 * held[0]


def test_contexts_that_tell_nothing_are_not_retained(spark):
    pick = np.random.RandomState(9)
    rows = [(" ".join(pick.choice(list("abcd"), 500)),) for _ in range(60)]
    tree, _ = L.train(spark.createDataFrame(rows, "text string"))
    assert not tree.retained1.any() and not len(tree.context2)


def test_counts_do_not_depend_on_how_tasks_gather(spark, monkeypatch):
    rows = [("a b a c a b",), ("b a c",), (None,)] * 20
    texts = spark.createDataFrame(rows, "text string")
    whole = L.train(texts)[0]
    monkeypatch.setattr(L, "GATHERED_WORDS", 1)
    monkeypatch.setattr(L, "GATHERED_RUNS", 1)
    small = L.train(texts.repartition(7))[0]
    assert whole.words == small.words and np.allclose(whole.single, small.single)
    assert np.array_equal(whole.codes1, small.codes1) and np.allclose(whole.logs1, small.logs1)


def test_scores_do_not_depend_on_what_is_broadcast(spark):
    pick = random.Random(10)
    rows = []
    for k in range(150):
        words = ["a", "b"]
        while len(words) < 40:
            words.append(f"{words[-2]}{words[-1]}"[-1] if pick.random() < 0.6 else pick.choice("abcdefgh"))
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = None
    for shares in ({}, {"context_share": 0.01, "deep_share": 0.05}, {"word_share": 2.0, "context_share": 2.0, "deep_share": 2.0}):
        found = {r.doc_id: round(r.score, 6) for r in scored(docs, **shares)[1].collect()}
        expected = expected or found
        assert found == expected


def test_rare_contexts_are_retained_in_a_large_corpus(spark):
    """Pairs and triples of a few occurrences count, however small their share of all tokens is."""
    common = " ".join("the of and to in".split() * 2000)
    rows = [(1 + k, common) for k in range(40)] + [(100 + k, "zeta kappa omega") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shares = {"context_share": 1e-3, "deep_share": 1e-2}
    tree, found = scored(docs, **shares)
    assert not len(tree.codes1) or tree.total * 1e-3 > 8
    rare = [r for r in found.collect() if r.doc_id >= 100]
    # The second and third word and the end follow their contexts always.
    assert all(r.score > r.base_score + 3 * 3 for r in rare)


def test_odd_documents(odd_docs, no_docs):
    total, expected = brute_base([(r.doc_id, r.text) for r in odd_docs.collect()])
    tree, found = scored(odd_docs)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found.collect()), key=repr)
    assert tree.total == total and got == expected
    tree, found = scored(no_docs)
    assert tree.total == 0 and found.collect() == []
    tree, counts = L.train(no_docs.select("text"))
    assert {r.base_score for r in L.score(odd_docs, tree, counts).collect()} == {0.0}


def brute_scores(rows, depth):
    """Scores by a tree held in dicts of word tuples, without a head, filters, codes or joins."""
    learned = [tokens(text) for doc_id, text in rows if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10]
    counts = [Counter(tuple(words[k : k + size]) for words in learned for k in range(len(words) - size + 1)) for size in range(1, depth + 2)]
    total, distinct = sum(counts[0].values()), len(counts[0])
    unseen = 0.1 / (total + 0.1 * (distinct + 1))
    prob = [{run: (n + 0.1) / (total + 0.1 * (distinct + 1)) for run, n in counts[0].items()}]
    listed = [counts[0]]
    spare, diverging = [{}], [set()]
    for size in range(2, depth + 2):
        runs = {run: n for run, n in counts[size - 1].items() if n >= 4 and listed[-1].get(run[:-1], 0) >= 4 and run[1:] in listed[-1]}
        heirs = {}
        for run in runs:
            heirs.setdefault(run[:-1], []).append(run)
        spare.append({})
        diverging.append(set())
        for context, own in heirs.items():
            n = listed[-1][context]
            shares = [runs[run] / n for run in own]
            below = [prob[-1][run[1:]] for run in own]
            rest = max(1 - sum(shares), 0.0)
            gain = sum(s * math.log(s / q) for s, q in zip(shares, below))
            if rest > 1e-12:
                gain += rest * math.log(rest / max(1 - sum(below), 1e-12))
            spare[-1][context] = max(1 - sum((runs[run] - 0.5) / n for run in own), 1e-12)
            if gain >= 0.02:
                diverging[-1].add(context)
        prob.append({run: (n - 0.5) / listed[-1][run[:-1]] + spare[-1][run[:-1]] * prob[-1][run[1:]] for run, n in runs.items()})
        listed.append(runs)
    for size in range(depth, 1, -1):
        diverging[size - 1] |= {context[1:] for context in diverging[size]}

    def chance(context, word):
        size = len(context)
        if not size:
            return prob[0].get((word,), unseen)
        if context not in diverging[size]:
            return chance(context[1:], word)
        return prob[size].get((*context, word)) or spare[size][context] * chance(context[1:], word)

    return {
        doc_id: sum(math.log10(chance(tuple(words[max(0, k - depth) : k]), words[k])) for k in range(len(words)))
        for doc_id, words in ((doc_id, tokens(text)) for doc_id, text in rows)
    }


@pytest.mark.parametrize("depth, share", [(1, 1e-6), (2, 1e-6), (2, 0.005), (3, 2.0)])
def test_scores_agree_with_brute_force(spark, depth, share):
    pick = random.Random(11)
    rows = []
    for k in range(150):
        words = ["the", "of"]
        while len(words) < 50:
            follow = f"w{zlib.crc32(' '.join(words[-pick.randint(1, 3):]).encode()) % 40}"
            words.append(follow if pick.random() < 0.7 else f"w{int(pick.expovariate(0.05))}")
        rows.append((k, " ".join(words)))
    rows += [(500, None), (501, ""), (502, "unseen the of nothing"), (None, "the of the of")]
    _, found = scored(
        spark.createDataFrame(rows, "doc_id long, text string"), depth=depth, context_share=share, deep_share=share, filter_bits=1 << 10
    )
    expected = brute_scores(rows, depth)
    got = {r.doc_id: r.score for r in found.collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], abs=1e-6) for k in expected)


def test_runs_of_words_without_a_number_are_counted(spark):
    texts = spark.createDataFrame([("a b c d",)] * 5 + [("a b x",)] * 3 + [(None,)], "text string")
    words = spark.createDataFrame([("a", 8), ("b", 8), ("c", 5), ("d", 5), ("x", 3)], "word string, n bigint")
    every = np.full(16, -1, np.int64).view(np.uint64)
    hashes = {r.hash: r.word for r in L.with_hashes(words).collect()}
    numbered = np.array(list(hashes), np.int64).view(np.uint64)
    for known in (numbered, numbered[:2], numbered[:0]):
        found = L.run_counts(texts, 2, known, every, 4, 3).collect()
        got = {(hashes.get(r.x0), hashes.get(r.x1)): r.n for r in found}
        assert got == {("a", "b"): 8, ("b", "c"): 5, ("c", "d"): 5, ("d", None): 5}


def test_hashes_are_found_among_any_known_ones():
    pick = np.random.RandomState(12)
    every = pick.randint(0, 2**63, 3000, np.int64).view(np.uint64) << np.uint64(1)
    # Many known hashes with the same first bits, and the least and the greatest of all.
    every = np.unique(np.concatenate([every, np.arange(50, dtype=np.uint64), ~np.arange(3, dtype=np.uint64)]))
    for known in (every[::2], every[1::2], every[:1], every[-1:], every[:0]):
        at, hit = L.Finder(known).find(every)
        assert np.array_equal(hit, np.isin(every, known)) and np.array_equal(known[at[hit]], every[hit])


@pytest.mark.parametrize("depth", [2, 3])
def test_what_the_head_does_not_hold_travels_packed(spark, monkeypatch, depth):
    """No row of its own for a place or a rare word, and the same scores however buckets, shares of them and blocks are cut."""
    pick = random.Random(13)
    rows = []
    for k in range(80):
        words = ["the", "of"]
        while len(words) < 40:
            follow = f"w{zlib.crc32(' '.join(words[-pick.randint(1, 3):]).encode()) % 30}"
            words.append(follow if pick.random() < 0.7 else f"é{int(pick.expovariate(0.05))}")
        rows.append((k, " ".join(words)))
    rows += [(500, None), (501, ""), (502, "unseen the of nothing"), (502, "unseen the of nothing"), (None, "the of the of")]
    docs = spark.createDataFrame(rows, "part long, text string")
    expected = brute_scores(rows, depth)
    base = {doc_id: score for doc_id, _, _, score in brute_base(rows)[1]}
    monkeypatch.setattr(L, "LOOKUP_WORDS", 1000, raising=False)
    monkeypatch.setattr(L, "LOOKUP_PLACES", 100, raising=False)
    monkeypatch.setattr(L, "GATHERED_PLACES", 300, raising=False)
    shares = {"depth": depth, "context_share": 2.0, "deep_share": 2.0, "filter_bits": 1 << 12}
    for word_share in (0.01, 2.0):
        tree, tables = L.train(docs.filter(L.in_training(F.col("part"))).select("text"), word_share=word_share, **shares)
        found = L.score(docs, tree, tables, id_col="part")
        # Nothing is unpacked from a column into rows, and no rows are joined but those of documents.
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Generate \w+\(\w+#", plan) and len(re.findall(r"\bJoin ", plan)) == 1
        got = found.collect()
        assert sorted(repr(r.part) for r in got) == sorted(repr(k) for k, _ in rows)
        assert all(r.score == pytest.approx(expected[r.part], abs=1e-6) for r in got)
        assert all(r.base_score == pytest.approx(base[r.part], abs=1e-5) for r in got)


def test_looking_places_up_takes_memory_for_a_few_at_once():
    """Whatever the places of a bucket, a task takes a bounded number apart, and holds sums of documents."""
    pick = np.random.RandomState(14)
    packed = getattr(L, "narrow", L.planes)
    rows, size, docs = 64, 1 << 15, 500
    codes = np.sort(pick.randint(0, 1 << 62, (rows, size)), axis=1)
    row = pick.randint(0, docs, (rows, size))
    sent = [
        {"part": 7, "places": size, "size": 0, "keys": packed(np.diff(c, prepend=np.int64(0))), "rows": packed(r)} for c, r in zip(codes, row)
    ]
    kinds = pa.schema([("part", pa.int64()), ("places", pa.int64()), ("size", pa.int32()), ("keys", pa.binary()), ("rows", pa.binary())])
    sent = pa.Table.from_pylist(sent, kinds)
    known = np.concatenate([codes[:, ::3].ravel(), ~codes[:, 1::3].ravel()])
    deltas = pa.table({"code": known[:1000], "delta": np.arange(1000.0)})
    tracemalloc.start()
    found = L.look_up_runs(sent, deltas, np.zeros(1, np.uint64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * rows * size
    expected = np.bincount(row[:, ::3].ravel()[:1000], np.arange(1000.0), docs)
    got = {r["_row"]: r["_lift"] for r in L.sums_of_part(found).to_pylist()}
    assert got == pytest.approx({7 + k: x for k, x in enumerate(expected) if k in set(row[:, ::3].ravel()[:1000])})


def test_rows_that_leave_a_task_are_bounded(spark, monkeypatch):
    """A place of a small document takes less than two whole numbers, and a bucket of any size several rows."""
    pick = random.Random(15)
    docs = spark.createDataFrame(
        [(k, " ".join(f"w{pick.randint(0, 30)}" for _ in range(50))) for k in range(60)], "doc_id long, text string"
    )
    tables = []
    write = L.written
    monkeypatch.setattr(L, "written", lambda df: tables.append(write(df)) or tables[-1])
    monkeypatch.setattr(L, "ROW_PLACES", 100, raising=False)
    found = scored(docs, word_share=0.02, context_share=2.0, deep_share=2.0, divergence=-1.0)[1]
    rows = tables[-1].filter("size is not null").collect()
    assert {r["size"] for r in rows} >= {L.WORDS, 2}
    assert max(r.places for r in rows) <= 100 < sum(r.places for r in rows)
    runs = [r for r in rows if r["size"] != L.WORDS]
    assert sum(len(r["keys"]) + len(r["rows"]) for r in runs) < 14 * sum(r.places for r in runs)
    assert found.count() == 60


@pytest.mark.parametrize("numbers", [[], [0], [255, 1], [256, 0, 3], [-1, 5], [2**63 - 1, -(2**63)]])
def test_numbers_are_packed_and_unpacked(numbers):
    numbers = np.array(numbers, np.int64)
    data = L.narrow(numbers)
    assert np.array_equal(L.from_narrow(data), numbers)
    if len(numbers) and numbers.min() >= 0 and numbers.max() < 256:
        assert len(data) == 1 + len(numbers)


def test_counts_of_runs_leave_a_task_in_bounded_batches(monkeypatch):
    """However many runs a task has gathered, an Arrow batch of them has about ``BATCH_PLACES`` counts and one row of a bucket more."""
    found = {}

    class Texts:
        class sparkSession:
            class sparkContext:
                broadcast = staticmethod(lambda value: type("Held", (), {"value": value}))

        def mapInArrow(self, run, _):
            found["run"] = run
            return self

        def groupBy(self, _):
            return self

        def applyInArrow(self, *_):
            return self

    monkeypatch.setattr(L, "BATCH_PLACES", 100, raising=False)
    every = np.full(16, -1, np.int64).view(np.uint64)
    L.run_counts(Texts(), 2, np.zeros(0, np.uint64), every, 4, 10)
    text = " ".join(f"w{k % 700}" for k in range(3000))
    batches = list(found["run"](iter([pa.RecordBatch.from_pydict({"text": [text]})])))
    counts = [sum(len(x) // 8 for x in batch["counts"].to_pylist()) for batch in batches]
    assert sum(counts) == 701 and max(counts) < 300
