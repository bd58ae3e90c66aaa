import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from squadweave.llm import collocations as M

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, cover=50, top=2000):
    """Every phrase of every piece counted, every cut tried."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        total = sum(n for phrase, n in f.items() if len(phrase) == 1)
        frequent = {phrase: a for phrase, a in f.items() if len(phrase) > 1 and a >= least}
        covered = set()
        for phrase, n in frequent.items():
            for size in range(2, len(phrase)):
                for k in range(len(phrase) - size + 1):
                    if 100 * n >= cover * f[phrase[k : k + size]]:
                        covered.add(phrase[k : k + size])
        ranked = []
        for phrase, a in frequent.items():
            if phrase not in covered:
                cuts = [(1000000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, total, -score))
    return sorted(found)


def invented(seed, documents=300):
    """Few very frequent words, many rare ones, phrases that repeat whole."""
    pick = random.Random(seed)
    phrases = ["new York city", "of the", "in the end of the", "aa aa aa aa", "é 中 😀"]
    rows = []
    for _ in range(documents):
        text = ""
        for _ in range(pick.randint(0, 30)):
            word = f"w{int(pick.paretovariate(0.6)) % 500}" if pick.random() < 0.7 else pick.choice(phrases)
            text += word + pick.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \r"])
        rows.append((text, pick.choice(["en", "en", "en", "de", None, "und"])))
    return rows


def mined(spark, rows, **parameters):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(map(tuple, M.mine(df, **parameters).collect()))


@pytest.mark.parametrize(
    "parameters",
    [
        {},
        {"head": 7},
        {"head": 0, "block": 50, "bucket_words": 100},
        {"head": 40, "filter_bits": 1024, "block": 200, "bucket_words": 500},
    ],
)
def test_agrees_with_brute_force(spark, parameters):
    rows = invented(1)
    expected = brute(rows)
    assert len(expected) > 50
    assert mined(spark, rows, **parameters) == expected


def test_longer_phrases_and_other_limits(spark):
    rows = invented(2)
    expected = brute(rows, longest=4, least=6, cover=70, top=9)
    assert {row[1] for row in expected} == set(range(1, 10))
    assert mined(spark, rows, longest=4, least=6, cover_percent=70, top=9, head=30) == expected


def test_words_that_share_a_hash(spark):
    """So short hashes meet: the hash is drawn anew until no frequent word shares its own."""
    rows = invented(3, 120)
    assert mined(spark, rows, hash_bits=15) == brute(rows)


def test_dense_tiles_count_like_sorted_ones(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE", 4)
    monkeypatch.setattr(M, "GRID", 3)
    n = np.arange(60)[::-1]
    language = np.repeat([0, 1, 2], 20)
    level = M.Level(n, n[:, None], language, n, np.zeros(0, np.uint64))
    draw = np.random.RandomState(5)
    ids = np.sort(level.ids)
    a, b = draw.choice(ids, 4000), draw.choice(ids, 4000)
    same = level.language[a // 4] == level.language[b // 4]
    a, b = a[same], b[same]
    keys, counts = M.tiled_counts(level, level, a, b)
    expected, n = np.unique(a * level.size + b, return_counts=True)
    order = np.argsort(keys)
    assert keys[order].tolist() == expected.tolist() and counts[order].tolist() == n.tolist()


def test_filter_holds_what_it_was_given(spark):
    rows = spark.range(-3000, -1000).selectExpr("id AS w0", "id * 7 AS w1")
    held = M.filter_of(rows, ["w0", "w1"], 1 << 14)
    level = M.Level(np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), held)
    first = np.arange(-3000, -1000)
    assert level.perhaps(M.code_of([first, first * 7])).all()
    assert level.perhaps(M.code_of([first * 7, first])).mean() < 0.3


def test_planes():
    numbers = np.array([0, 1, -1, 1 << 40, -(1 << 62)])
    assert M.from_planes(M.planes(numbers)).tolist() == numbers.tolist()


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    found = sorted(map(tuple, M.mine(odd_docs, least=2).collect()))
    assert found == brute(rows, least=2)
    assert M.mine(no_docs).collect() == []


def test_exact_beyond_64_bits(spark):
    """A million times the square of a count of 10 ** 13 passes 64 bits by far."""
    big = 10**13
    words = spark.createDataFrame([(1, "en", "x", big), (2, "en", "y", big + 1)], "w0 long, lang string, word string, n long")
    pairs = spark.createDataFrame([(1, 2, big - 3)], "w0 long, w1 long, n long")
    (row,) = M._scored([words, pairs], 2, 50).collect()
    assert row.score == 1000000 * (big - 3) ** 2 // (big * (big + 1))
