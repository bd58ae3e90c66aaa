import random
import zlib

import pytest
from pyspark.sql import functions as F

from squadweave.llm import language_id as L

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")


def test_held_out_accuracy(documents):
    training = L.in_training(F.col("doc_id"))
    found = L.identify(documents, L.learn(documents.filter(training)))
    truth = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in found.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum(r.lang == truth[r.doc_id] for r in held)
    sure = [r for r in held if not r.rejected]
    assert right >= 0.97 * len(held) and len(sure) >= 0.9 * len(held)
    assert sum(r.lang == truth[r.doc_id] for r in sure) >= 0.98 * len(sure)
    assert all(0 <= r.score <= 1 for r in held)


def test_nothing_but_the_text_decides(documents):
    learned = L.learn(documents.filter(L.in_training(F.col("doc_id"))))
    some = documents.limit(50)
    other = some.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("x"))
    assert sorted(L.identify(some, learned).collect()) == sorted(L.identify(other, learned).collect())


def test_learning_is_bounded_and_repeatable(documents):
    learned = L.learn(documents, sample_documents=20, dictionary_bytes=4096)
    assert learned == L.learn(documents.repartition(5), sample_documents=20, dictionary_bytes=4096)
    assert list(learned)[0] == "en" and max(map(len, learned.values())) <= 4096


def test_no_language_is_lost(spark):
    """Languages of long texts only, or of few texts in very many rows, and texts under one long header are learned."""
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst"}
    pick = random.Random(13)

    known = {lang: ["".join(pick.choice(of) for _ in range(6)) for _ in range(20)] for lang, of in letters.items()}

    def words(lang, n):
        return " ".join(pick.choice(known[lang]) for _ in range(n))

    banner = "uvwxyz " * 100
    rows = [("aa", words("aa", 20_000)) for _ in range(3)]
    rows += [("bb", f"{k} {words('bb', 20)}") for k in range(40)]
    rows += [("cc", text) for text in [words("cc", 60)] * 5000]
    rows += [("dd", banner + words("dd", 400)) for _ in range(400)]
    learned = L.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert set(learned) == set(letters)
    for lang, of in letters.items():
        assert sum(learned[lang].count(x.encode()) for x in of) > 0.5 * len(learned[lang])
    tests = spark.createDataFrame([(lang, words(lang, 10)) for lang in letters], "doc_id string, text string")
    assert {r.doc_id: r.lang for r in L.identify(tests, learned).collect()} == {lang: lang for lang in letters}


def test_few_samples_leave_every_language_a_text(spark):
    rows = [(f"l{k % 30}", f"some words {'abcdefghij'[n % 10]} {'klmnopqrst'[n // 10 % 10]} {'uvwxyz'[n % 6]}") for k in range(30) for n in range(100)]
    learned = L.learn(spark.createDataFrame(rows, "lang string, text string"), sample_documents=1)
    assert len(learned) == 30 and all(learned.values())


def test_narrow_margins_are_rejected(spark):
    learned = {"aa": b"the same words here " * 20, "bb": b"the same words here " * 20}
    rows = L.identify(spark.createDataFrame([(1, "the same words here")], "doc_id long, text string"), learned).collect()
    assert [(r.lang, r.score, r.rejected) for r in rows] == [("aa", 0.0, True)]


def test_odd_documents(odd_docs, no_docs):
    learned = L.learn(odd_docs)
    rows = L.identify(odd_docs, learned).collect()
    assert len(rows) == odd_docs.count() and set(learned) == {"en", "fr"}
    und = {repr(r.doc_id) for r in rows if r.lang == "und"}
    assert und == {"2", "3", "4", "None"} and all(r.rejected and r.score == 0 for r in rows if r.lang == "und")
    assert L.learn(no_docs) == {} and L.identify(no_docs, learned).collect() == []
    assert {r.lang for r in L.identify(odd_docs, {}).collect()} == {"und"}


def test_tasks_cut_texts_to_their_share(spark, monkeypatch):
    """What is sent of many long texts is no more than the dictionary, and many languages share one bound."""
    sizes, real = [], L.dictionary
    monkeypatch.setattr(L, "dictionary", lambda pieces, most: (sizes.append(sum(map(len, pieces))), real(pieces, most))[1])
    rows = [(f"l{k % 3}", " ".join(f"{chr(97 + n % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for n in range(5000))) for k in range(150)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    L.learn(docs, dictionary_bytes=8192)
    assert len(sizes) == 3 and max(sizes) <= 8192
    learned = L.learn(docs, all_bytes=6000)
    assert set(learned) == {"l0", "l1", "l2"} and all(0 < len(x) <= 2000 for x in learned.values())
