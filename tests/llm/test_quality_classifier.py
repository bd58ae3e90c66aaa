import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from squadweave.llm import quality_classifier as C


def made_up(n, seed=1):
    """Documents whose bad words give them away, and whose source mostly does."""
    pick, docs, labels = random.Random(seed), [], []
    for k in range(n):
        bad = pick.random() < 0.3
        words = [pick.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(pick.randint(0, 300)) for _ in range(40)]
        if bad:
            words[pick.randrange(40)] = pick.choice(["nasty", "vile"])
        source = pick.choice(["s1", "s2"]) if bad == (pick.random() < 0.9) else pick.choice(["s3", "s4"])
        docs.append((k, " ".join(words), "en", source, 200))
        labels.append((k, 1 - bad, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made_up(3000)
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, "doc_id long, quality long, toxic long"),
    )


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = C.train(docs, labels.filter("doc_id % 2 = 0"))
    truth = {r.doc_id: r for r in labels.collect() if r.doc_id % 2}
    found = [r for r in C.score(docs, model).collect() if r.doc_id in truth]
    toxic = np.array([truth[r.doc_id].toxic for r in found])
    score = np.array([r.toxic for r in found])
    assert C.ranking(score, toxic) > 0.98 and ((score > 0.5) == toxic).mean() > 0.95
    assert all(0 <= r.quality <= 1 for r in found)
    # Calibrated: what is scored p is toxic in about a share p of cases.
    assert abs(score.mean() - toxic.mean()) < 0.04


def test_training_is_repeatable(tables):
    docs, labels = tables
    one, two = C.train(docs, labels), C.train(docs.repartition(5), labels.repartition(3))
    assert all(np.allclose(a, b) for t in one.targets for a, b in zip(one.targets[t], two.targets[t]))


def test_views_exchange_confident_labels():
    found = np.array([-9.0, -4.0, -0.1, 0.1, 5.0, 8.0])
    rows, verdicts = C.hand_over(found, 0.5, 0.9)
    assert rows.tolist() == [0, 1, 5, 4] and verdicts.tolist() == [0, 0, 1, 1]


def test_the_pool_helps_the_weaker_view():
    """Metadata with three labelled rows learns the source from what the content view is sure of."""
    docs, labels = made_up(2000, seed=5)
    texts = C.content_rows(pa.array([d[1] for d in docs]))
    metadata = C.metadata_rows([pa.array([d[3] for d in docs])], len(docs))
    y = np.array([t for _, _, t in labels], float)
    few = np.flatnonzero(y > 0)[:200].tolist() + np.flatnonzero(y == 0)[:200].tolist()
    few, pool, held = np.array(few), np.arange(1000, 1500), np.arange(1500, 2000)
    trained = (texts.take(few), metadata.take(few[[0, 300, 301]]))
    parts = [tuple(v.take(rows) for v in (texts, metadata)) for rows in (pool, held)]
    # The same labels for both views, as co_train wants them: repeat the three metadata rows.
    trained = (trained[0], metadata.take(np.where(y[few] > 0, few[0], few[300])))
    weights = C.co_train(y[few], trained, *parts, y[held])
    alone = C.fit(trained[1], y[few], C.BUCKETS)
    before, after = (C.ranking(C.logits(parts[1][1], w), y[held]) for w in (alone, weights[1]))
    assert after >= before and after > 0.8


def test_sparse_rows():
    rows = C.Rows(np.array([0, 2, 1]), np.array([1.0, 2.0, 3.0]), np.array([0, 2, 2, 3]))
    weights = np.array([1.0, 10.0, 100.0])
    assert rows.dot(weights).tolist() == [201.0, 0.0, 30.0]
    assert rows.back(np.array([1.0, 5.0, 2.0]), 3).tolist() == [1.0, 6.0, 2.0]
    assert rows.take(np.array([2, 0])).dot(weights).tolist() == [30.0, 201.0]
    assert rows.plus(rows).dot(weights).tolist() == [201.0, 0.0, 30.0] * 2


def test_odd_documents(odd_docs, no_docs, tables):
    labels = tables[1]
    odd_labels = odd_docs.sparkSession.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 0)], labels.schema)
    for known in (odd_labels, labels, labels.limit(0)):
        model = C.train(odd_docs, known)
        rows = C.score(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.quality <= 1 and 0 <= r.toxic <= 1 for r in rows)
        assert C.score(no_docs, model).collect() == []
    assert C.train(no_docs, labels).targets.keys() == {"quality", "toxic"}
    model = C.train(*tables)
    assert C.score(odd_docs, model).count() == odd_docs.count()
    assert C.score(odd_docs.withColumn("source", F.lit(None).cast("string")), model).count() == odd_docs.count()


def test_a_repeated_id_is_sampled_once(spark, monkeypatch):
    sizes, real = [], C.metadata_rows
    monkeypatch.setattr(C, "metadata_rows", lambda parts, n: (sizes.append(n), real(parts, n))[1])
    ids = [*range(40), *range(1000, 1041), *[0] * 1500, *[1000] * 1500]
    rows = [(k, f"some text {n} of number {k}", "s", "en", 20) for n, k in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(k, k % 2, k % 3 % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    C.train(docs, labels)
    assert sorted(sizes) == [40, 41]


def brute_features(text):
    """Hashed words and word beginnings of a text with the logarithm of their counts, one by one."""
    found = Counter()
    for word in re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()):
        for size in (*C.STEMS, 0):
            if len(word) > size:
                raw = np.frombuffer(word[: size or None], np.uint8)
                span = C.word_hashes(raw, np.array([0]), np.array([len(raw)]))
                found[int(C.mix(span + np.uint64(size))[0] % np.uint64(C.BUCKETS))] += 1
    return {k: np.log2(1 + n) for k, n in found.items()}


def test_combined_scores_agree_with_brute_force(tables):
    docs, labels = tables
    model = C.train(docs, labels.filter("doc_id % 3 = 0"))
    some = docs.filter("doc_id < 30")
    found = {r.doc_id: r for r in C.score(some, model).collect()}
    for row in some.collect():
        features = brute_features(row.text)
        form = C.BUCKETS + np.arange(C.SHAPES) * 11
        raw = np.frombuffer(row.text.encode(), np.uint8)
        form = form + np.minimum(10, C.shapes(raw, np.array([0, len(raw)]))[0] * 10).astype(int)
        values = C.metadata_rows([pa.array([row[c]]) for c in ("source", "lang", "n_chars")], 1).index
        for target, (content_w, metadata_w, content_c, metadata_c, both) in model.targets.items():
            content = sum(content_w[k] * v for k, v in features.items()) + content_w[-1]
            metadata = sum(metadata_w[k] for k in (*values, *form)) + metadata_w[-1]
            views = content * content_c[0] + content_c[1], metadata * metadata_c[0] + metadata_c[1]
            p = 1 / (1 + np.exp(-(views[0] * both[0] + views[1] * both[1] + both[2])))
            assert found[row.doc_id][target] == pytest.approx(p, abs=1e-5)


def test_long_texts_teach(spark):
    """Only texts of 100 KB or more are labelled, and what they teach holds for short ones."""
    pick = random.Random(3)
    rows, known = [], []
    for k in range(60):
        words = [f"w{pick.randint(0, 50)}x" for _ in range(30_000 if k < 40 else 20)] + ["vile" if k % 2 else "kind"] * 20
        rows.append((k, " ".join(words), "s", "en", 1))
        known.append((k, 1 - k % 2, k % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame(known[:40], "doc_id long, quality long, toxic long")
    found = {r.doc_id: r.toxic for r in C.score(docs, C.train(docs, labels)).collect()}
    assert all((found[k] > 0.5) == bool(k % 2) for k in range(40, 60))
