import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from squadweave.llm import near_dedup as N

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return sorted((doc_id, len(sets[k]), least[root(k)], doc_id == least[root(k)]) for k, (doc_id, _) in enumerate(rows))


def edited(pick, words, share):
    return [pick.choice("uvwxyz") * 3 if pick.random() < share else w for w in words]


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_all_pairs(spark, seed):
    """Groups of exact copies, of near copies at every distance, chains, short texts and a shared passage."""
    pick = random.Random(seed)

    def prose(n):
        return [f"w{pick.randint(0, 3000)}" for _ in range(n)]

    rows, passage = [], prose(40)
    for _ in range(12):
        base = prose(pick.choice([3, 6, 12, 60, 200]))
        rows += [base] * pick.randint(1, 3)
        rows += [edited(pick, base, pick.choice([0.01, 0.03, 0.05, 0.1])) for _ in range(10)]
        for _ in range(5):
            base = edited(pick, base, 0.03)
            rows.append(base)
    rows += [prose(60) + passage + prose(60) for _ in range(15)] + [[], ["One"], ["one"], ["a", "b", "c", "d"], ["A", "b", "c", "D"]]
    pick.shuffle(rows)
    rows = [(k, pick.choice([" ", "\n", "\t "]).join(words)) for k, words in enumerate(rows)]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """Blocks smaller than the group, and copies that only link to each other through a third."""
    monkeypatch.setattr(N, "BLOCK", 16)
    pick = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(edited(pick, base, pick.choice([0.0, 0.01, 0.04, 0.08])))) for k in range(150)]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_pigeonhole_finds_every_pair_under_the_threshold():
    """Signatures that differ in at most 31 of 64 positions share a key, whichever positions differ."""
    pick = np.random.RandomState(3)
    for _ in range(500):
        a = pick.randint(0, 1 << 16, N.POSITIONS).astype(np.uint16)
        b = a.copy()
        at = pick.choice(N.JOINED, N.MAX_JOINED, replace=False)
        b[at] ^= 1
        differ = (a != b)[: N.JOINED].reshape(-1, N.CHUNK)
        assert (differ.sum(1) <= 1).any()
        chunk, out = divmod(int(N.first_key(a[None], b)[0]), N.CHUNK)
        left = [k for k in range(N.CHUNK) if k != out]
        assert (a[: N.JOINED].reshape(-1, N.CHUNK)[chunk, left] == b[: N.JOINED].reshape(-1, N.CHUNK)[chunk, left]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 150)] + [(200, 201), (200, 201)]
    found = {r.node: r.label for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 150)} | {200: 200, 201: 200}
    assert found == expected


def test_odd_documents(spark, odd_docs, no_docs):
    rows = N.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert found[(1, 4)] == (1, True) and found[(2, 0)] == (2, True) and found[(3, 0)] == (3, True)
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert N.near_duplicates(no_docs).collect() == []
    same = [(None, "a b c d e f"), (7, "A b c d e f"), (7, "q r s t u v")]
    found = N.near_duplicates(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(None, 7), (7, 7)}


def test_rows_without_an_id_are_linked(spark):
    """Near copies with and without ids, in chains: a row without an id has the smallest id it reaches."""
    pick = random.Random(12)
    base = [f"w{k}" for k in range(100)]
    chain = [base]
    for _ in range(5):
        chain.append(edited(pick, chain[-1], 0.02))
    rows = [(k if k % 2 else None, " ".join(words)) for k, words in enumerate(chain, 3)]
    alone = [f"v{k}" for k in range(80)]
    rows += [(None, " ".join(alone)), (None, " ".join(edited(pick, alone, 0.02))), (9, "other words here"), (None, None)]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = {r[0]: r[2] for r in brute([(k, text) for k, (_, text) in enumerate(rows)])}
    groups = {}
    for k, (doc_id, _) in enumerate(rows):
        groups.setdefault(expected[k], []).append(doc_id)
    smallest = {k: min((x for x in ids if x is not None), default=None) for k, ids in groups.items()}
    want = sorted(repr((doc_id, smallest[expected[k]])) for k, (doc_id, _) in enumerate(rows))
    assert sorted(repr((r.doc_id, r.component_id)) for r in found) == want
    assert any(doc_id is None and smallest[expected[k]] is not None for k, (doc_id, _) in enumerate(rows))


def test_texts_repeated_under_one_id_are_compared_once(spark):
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base), " ".join([*base[:50], "other", *base[51:]]), "short"]
    rows = [(k, text) for k, text in enumerate(texts) for _ in range(300)] + [(0, "another text"), (1, texts[0] + " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    (classes,) = [N.sets(docs, "doc_id", "text").filter("node is not null").groupBy("node").agg(F.min("id").alias("doc"))]
    found = N.texts_of(docs.withColumnRenamed("doc_id", "doc"), classes)
    assert sorted(r.text for r in found.collect()) == sorted([*texts, "another text"])
    assert {(r.doc_id, r.component_id) for r in N.near_duplicates(docs).collect()} == {(0, 0), (1, 0), (2, 2)}
