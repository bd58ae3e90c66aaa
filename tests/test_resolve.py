import random

import pytest
from pyspark.sql import functions as F

from squadweave.functions import similarity
from squadweave.operators import resolve


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for at, y in enumerate(b, 1):
            diagonal, row[at] = row[at], diagonal + 1 if x == y else max(row[at], row[at - 1])
    return row[-1]


def plain_ratio(a, b):
    total = len(a) + len(b)
    return (1 - (total - 2 * plain_lcs(a, b)) / total) * 100 if total else 100.0


def plain_partial(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0 if b else 100.0
    windows = [b[at : at + len(a)] for at in range(len(b))] + [b[:end] for end in range(1, len(a))]
    best = max(plain_ratio(a, w) for w in windows)
    if len(a) == len(b):
        best = max(best, max(plain_ratio(b, w) for w in [a[at:] for at in range(len(a))] + [a[:end] for end in range(1, len(b))]))
    return best


PLAIN = {"ratio": plain_ratio, "partial": plain_partial}


def plain_best(names, canon, scorer, cutoff):
    mapping = {}
    for name in names:
        scored = [(PLAIN[scorer](name, c), -at, c) for at, c in enumerate(canon)]
        good = [s for s in scored if s[0] >= cutoff]
        mapping[name] = (max(good)[2], max(good)[0]) if good else (name, None)
    return mapping


def words(rng, count, alphabet, longest):
    found = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))) for _ in range(count)}
    return sorted(found, key=lambda w: rng.random())


# Scores worked out by hand.
@pytest.mark.parametrize(
    "a, b, score",
    [
        ("abcd", "abcd", 100.0), ("abcd", "abxd", 75.0), ("abc", "xyz", 0.0), ("ab", "abcd", 2 * 2 / 6 * 100),
        ("kitten", "sitting", 8 / 13 * 100), ("", "", 100.0), ("", "a", 0.0),
    ],
)
def test_ratio_by_hand(a, b, score):
    assert similarity.indel_ratio(a, b) == pytest.approx(score)
    assert similarity.indel_ratio(b, a) == pytest.approx(score)


@pytest.mark.parametrize(
    "a, b, score",
    [("abc", "xxabcxx", 100.0), ("abcd", "xabxdx", 75.0), ("bc", "abcd", 100.0), ("abcd", "cdxy", 2 * 2 / 6 * 100)],
)
def test_partial_ratio_by_hand(a, b, score):
    (found,) = similarity.matches([a], [b], "partial", 1.0)[2]
    assert found == pytest.approx(score)


@pytest.mark.parametrize("seed", range(6))
def test_scores_equal_plain_loops(seed):
    rng = random.Random(seed)
    left, right = words(rng, 9, "abcé字 ", (6, 20, 90)[seed % 3]), words(rng, 9, "abcé字 ", 40)
    for scorer in PLAIN:
        expected = {(a, b): PLAIN[scorer](a, b) for a in left for b in right}
        i, j, s = similarity.matches(left, right, scorer, 60.0)
        assert {(left[x], right[y]): z for x, y, z in zip(i, j, s)} == {k: v for k, v in expected.items() if v >= 60.0}


def names_frame(spark, values):
    return spark.createDataFrame([(at, v) for at, v in enumerate(values)], "seq long, name string")


def mapping_of(df):
    return {r.name: (r.canon, r.score) for r in df.collect()}


@pytest.mark.parametrize("hot_share", [0.001, 0.2])
@pytest.mark.parametrize("seed", range(3))
def test_contained_pairs_equal_a_nested_loop(spark, seed, hot_share):
    rng = random.Random(seed)
    shorts, longs = words(rng, 60, "ab", 7), words(rng, 80, "abc", 30) + ["ab" * 20, "c"]
    got = resolve.contained_pairs(
        names_frame(spark, shorts).select("name"), names_frame(spark, sorted(set(longs))).select("name"), hot_share
    ).collect()
    assert len(got) == len(set(got))
    assert {(r.short, r.long) for r in got} == {(s, l) for s in shorts for l in set(longs) if s in l}


def test_a_long_text_has_few_keys_and_all_of_what_it_holds(spark):
    """Of 3 * w - 2 and more characters about two of w + 1 substrings are keys, and a part's keys are among the whole's."""
    rng = random.Random(8)
    longs = ["".join(rng.choice("abcdefghijklmnop") for _ in range(400)) for _ in range(20)]
    rows = [(level, long, long[at : at + level + 9]) for long in longs for level in resolve.LEVELS for at in (0, 57, 201)]
    frame = spark.createDataFrame(rows, "level int, long string, short string")
    for level in resolve.LEVELS:
        found = frame.filter(F.col("level") == level).select(
            resolve._minimizers(F.col("long"), level).alias("long"), resolve._minimizers(F.col("short"), level).alias("short")
        ).collect()
        window = level // 3 + 1
        assert all(set(row["short"]) <= set(row["long"]) for row in found)
        if level >= 6:
            assert sum(len(row["long"]) for row in found) < len(found) * 400 * 2 / (window + 1) * 1.1


def test_one_substring_in_a_third_of_all_names(spark):
    rng = random.Random(5)
    longs = sorted({f"{'St. ' if at % 3 == 0 else ''}{''.join(rng.choice('xyz') for _ in range(9))}" for at in range(3000)})
    shorts = ["St. ", "St", "xyz", "zzzzz"]
    got = resolve.contained_pairs(names_frame(spark, shorts).select("name"), names_frame(spark, longs).select("name"), 0.01)
    assert {(r.short, r.long) for r in got.collect()} == {(s, l) for s in shorts for l in longs if s in l}


@pytest.mark.parametrize("seed", range(3))
def test_canonical_names_equal_a_nested_loop(spark, seed, monkeypatch):
    monkeypatch.setattr(resolve, "CELL", 16)
    rng = random.Random(seed)
    canon = words(rng, 50, "abcdef", 9)
    names = sorted(set(words(rng, 60, "abcdefg", 12)) | set(canon[:5]))
    for scorer, cutoff in (("partial", 70.0), ("ratio", 60.0)):
        got = resolve.canonicalize(names_frame(spark, names + [None]), "name", names_frame(spark, canon), "name", "seq", scorer, cutoff)
        assert mapping_of(got) == plain_best(names, canon, scorer, cutoff)


def test_names_that_are_their_own_canon(spark):
    names = ["Arlington Catholic", "Catholic", "Oak", "Oak Park", "Holy Catholic"]
    frame = names_frame(spark, names)
    got = mapping_of(resolve.canonicalize(frame, "name", frame, "name", "seq"))
    # Not transitive: the earliest name that contains or lies within each.
    assert {k: v[0] for k, v in got.items()} == {
        "Arlington Catholic": "Arlington Catholic", "Catholic": "Arlington Catholic", "Oak": "Oak", "Oak Park": "Oak",
        "Holy Catholic": "Catholic",
    }


def test_whole_strings_that_are_their_own_canon(spark):
    frame = names_frame(spark, ["b a", "a b", "zz"])
    got = resolve.canonicalize(frame, "name", frame, "name", "seq", scorer="ratio", cutoff=60.0)
    assert mapping_of(got) == {"b a": ("b a", 100.0), "a b": ("a b", 100.0), "zz": ("zz", 100.0)}


def test_names_with_one_common_beginning_meet_on_rare_substrings(spark):
    frame = spark.range(3000).select(F.col("id").alias("seq"), F.format_string("Customer#%09d", "id").alias("name"))
    names = frame.select("name")
    pairs = resolve.contained_pairs(names, names)
    assert pairs.count() == 3000 and pairs.filter("short <> long").count() == 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scoring_is_case_sensitive_and_keeps_the_unmatched(spark):
    got = mapping_of(resolve.canonicalize(names_frame(spark, ["OAK", "zzz"]), "name", names_frame(spark, ["oak"]), "name", "seq"))
    assert got == {"OAK": ("OAK", None), "zzz": ("zzz", None)}


def test_text_order_as_seq(spark):
    canon = spark.createDataFrame([("ab",), ("aab",)], "name string")
    got = resolve.canonicalize(names_frame(spark, ["xaabx", "aabxx", "ax"]), "name", canon, "name", "name", cutoff=60.0)
    assert {k: v[0] for k, v in mapping_of(got).items()} == {"xaabx": "aab", "aabxx": "aab", "ax": "aab"}


def test_token_sort_match(spark):
    canon = names_frame(spark, ["St. John's Prep", "Prep St Johns", "Oak Hill", "N/A"])
    names = names_frame(spark, ["Prep, St Johns", "Hill Oka", "Nowhere", " n/a ", "!!", None])
    got = mapping_of(resolve.token_sort_match(names, "name", canon, "name", "seq"))
    assert got["Prep, St Johns"] == ("St. John's Prep", 100.0)
    assert got["Hill Oka"] == ("Oak Hill", pytest.approx(plain_ratio("hill oka", "hill oak")))
    assert {k: got[k] for k in ("Nowhere", " n/a ", "!!")} == {"Nowhere": ("Nowhere", None), " n/a ": (" n/a ", None), "!!": ("!!", None)}


def test_pair_score_row_by_row(spark):
    rows = [("abcd", "abxd"), ("", ""), (None, "a"), ("oak", "oak hill"), ("x" * 70, "x" * 35)]
    df = spark.createDataFrame(rows, "a string, b string")
    for scorer, plain in PLAIN.items():
        got = [r.s for r in df.select(resolve.pair_score(F.col("a"), F.col("b"), scorer).alias("s")).collect()]
        assert got == [None if a is None else plain(a, b) for a, b in rows]


def test_lookup_in_a_dimension(spark):
    df = spark.createDataFrame([("SEC",), ("?",), (None,)], "c string")
    dimension = spark.createDataFrame([("SEC", "South")], "code string, name string")
    kept = resolve.lookup(df, "c", dimension, "code", "name")
    assert {r.c for r in kept.collect()} == {"South", "?", None}
    dropped = resolve.lookup(df, "c", dimension, "code", "name", miss="null")
    assert sorted((r.c for r in dropped.collect()), key=str) == [None, None, "South"]


@pytest.mark.parametrize("cutoff", [0.0, 50.0, 80.0, 100.0])
def test_fuzzy_pairs_equal_a_nested_loop(spark, cutoff, monkeypatch):
    monkeypatch.setattr(resolve, "CELL", 8)
    rng = random.Random(2)
    # Lengths from 0 to 24, as only bands of like length meet.
    left, right = (["", *words(rng, 30, "ab", 24), *words(rng, 9, "abcd", 3)] for _ in range(2))
    left, right = list(dict.fromkeys(left)), list(dict.fromkeys([*right, *left[:9]]))
    got = resolve.fuzzy_pairs(
        names_frame(spark, left).select("name"), names_frame(spark, right).select(F.col("name").alias("canon"), "seq"), "ratio", cutoff
    )
    rows = got.collect()
    assert {(r.name, r.canon): r.score for r in rows} == {
        (a, b): plain_ratio(a, b) for a in left for b in right if plain_ratio(a, b) >= cutoff
    }
    assert len(rows) == len({(r.name, r.canon) for r in rows})


def test_mapping_tables(spark):
    mapping = spark.createDataFrame([("a", "A"), ("b", "b")], "name string, canon string")
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, hs string")
    assert {tuple(r) for r in resolve.apply_mapping(df, "hs", mapping).collect()} == {(1, "A"), (2, "z"), (3, None)}
    assert [tuple(r) for r in resolve.mapping_diff(mapping).collect()] == [("a", "A")]
    assert resolve.dedup_metrics(mapping).first().asDict() == {"original": 2, "canonical": 2, "removed": 0}


def test_dedup_keeps_the_first_row_with_its_nulls(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 3, "y")], "name string, seq int, v string")
    assert {tuple(r) for r in resolve.dedup_keep_first(df, ["name"], ["seq"]).collect()} == {("a", 1, None), ("b", 3, "y")}


def test_collapse(spark):
    df = spark.createDataFrame(
        [("n", "c", 1, "Recruiting Coordinator"), ("n", "c", 1, "Head Coach"), ("n", "c", 1, "Head Coach"), (None, "c", 1, "x")],
        "name string, college string, season int, title string",
    )
    got = resolve.collapse(df, ["name", "college", "season"], "title").collect()
    assert [tuple(r) for r in got] == [("n", "c", 1, "Head Coach | Recruiting Coordinator")]


def test_functions_reach_workers_without_the_package(tmp_path):
    """What a task runs must load where only the installed libraries are."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from squadweave.functions import markup

    layout = markup.Layout("l", markup.Select("p"), (markup.Card("k", markup.Select("p"), (markup.Field((markup.Select("b"),)),)),))
    task = lambda: (
        [x.tolist() for x in similarity.matches(["oak"], ["oak hill"], "partial", 70.0)],
        markup.cards_of(markup.parse("<p>x<b>y</b></p>"), layout),
    )
    (tmp_path / "task").write_bytes(cloudpickle.dumps(task))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import pickle; print(pickle.load(open('task', 'rb'))())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert done.stdout.strip() == str(task()), done.stderr[-500:]


@pytest.mark.parametrize("seed", range(4))
def test_no_bound_loses_a_match_however_pairs_are_dealt(seed, monkeypatch):
    """Texts from empty to longer than a machine word, from few characters to more than have bits, in small grids."""
    for name, value in (("GRID", 64), ("ACROSS", 16), ("CHANCES", 50), ("KINDS", 64), ("TIMES", 3)):
        monkeypatch.setattr(similarity, name, value)
    rng = random.Random(seed)
    alphabet = ["ab", "abcdefgh ", "aé字𝄞 xyz", "".join(map(chr, range(97, 300)))][seed]
    base = ["", *words(rng, 25, alphabet, 30), *words(rng, 3, alphabet, 90)]
    other = ["", "a", *words(rng, 25, alphabet, 30)]
    other += [w[: rng.randint(0, 9)] + rng.choice(alphabet) + w[rng.randint(0, 12) :] for w in base]
    other = list(dict.fromkeys(other))
    for scorer in PLAIN:
        scores = {(a, b): PLAIN[scorer](a, b) for a in base for b in other}
        for cutoff in (0.0, 45.0, 70.0, 85.0, 100.0):
            i, j, s = similarity.matches(base, other, scorer, cutoff)
            expected = {pair: pytest.approx(score) for pair, score in scores.items() if score >= cutoff}
            assert len(i) == len(expected) and {(base[x], other[y]): z for x, y, z in zip(i, j, s)} == expected
            i, j, s = similarity.matches(base, other, scorer, cutoff, best=True)
            best = {}
            for x, z in zip(i, s):
                best[base[x]] = max(best.get(base[x], 0.0), z)
            tops = {a: max(scores[a, b] for b in other) for a in base}
            assert best == {a: pytest.approx(top) for a, top in tops.items() if top >= cutoff}


def test_names_are_copied_to_few_cells(spark):
    rows = spark.range(20_000).select(F.format_string("name %d", "id").alias("name"), F.lit(0).alias("band"))
    others = rows.withColumnRenamed("name", "canon")
    assert resolve._in_cells(rows, "name", others, "canon", (0,)).count() <= 20_000 * resolve.SPREAD


def test_the_best_of_a_name_over_all_batches_is_the_earliest(monkeypatch):
    import numpy as np
    import pyarrow as pa

    found = [(np.array([0, 1, 0]), np.array([2, 0, 1]), np.array([90.0, 80.0, 90.0])), (np.array([0, 1]), np.array([0, 1]), np.array([90.0, 81.0]))]
    ((left, right, scores),) = resolve._best_of(found, 3, pa.chunked_array([[7, 5, 6]]))
    assert (left.tolist(), right.tolist(), scores.tolist()) == ([0, 1], [1, 1], [90.0, 81.0])
