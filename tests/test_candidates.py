import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_resolve import PLAIN, names_frame, plain_lcs, words

from squadweave.operators import candidates, resolve

EVERYTHING = 1e9


@pytest.fixture(autouse=True)
def no_pairs_are_few(monkeypatch):
    monkeypatch.setattr(resolve, "FEW_PAIRS", 0)


def sides(spark, names, canon):
    return names_frame(spark, names).select("name"), names_frame(spark, canon).select(F.col("name").alias("canon"), "seq")


def found_pairs(df):
    rows = df.collect()
    assert len(rows) == len({(r["name"], r["canon"]) for r in rows})
    return {(r["name"], r["canon"]): r["score"] for r in rows}


def expected_pairs(names, canon, scorer, cutoff):
    scores = {(n, c): PLAIN[scorer](n, c) for n in names for c in canon}
    return {pair: pytest.approx(score) for pair, score in scores.items() if score >= cutoff}


def mistyped(rng, word, alphabet, edits):
    letters = list(word)
    for _ in range(rng.randint(0, edits)):
        at = rng.randint(0, len(letters))
        if rng.random() < 0.5 and at < len(letters):
            del letters[at]
        else:
            letters.insert(at, rng.choice(alphabet))
    return "".join(letters)


def invented(seed, alphabet="abcdé字 ", longest=24):
    """Random names, and random names with up to six characters put in or left out, some cut out of longer ones."""
    rng = random.Random(seed)
    canon = words(rng, 60, alphabet, longest)
    names = {mistyped(rng, rng.choice(canon), alphabet, 6) for _ in range(60)}
    names |= {mistyped(rng, w[rng.randint(0, 4) : rng.randint(5, 20)], alphabet, 2) for w in canon}
    names |= {rng.choice(canon) + rng.choice(canon) for _ in range(8)} | {"", "a", "ab", "aaaaaaaaaaaa", "abababababab"}
    return sorted(names), sorted(set(canon) | {"", "aaaaaaaaaaaaaa", "ababababab"})


@pytest.mark.parametrize("share", [EVERYTHING, candidates.SHARE, 0.0])
@pytest.mark.parametrize("cutoff", [75.0, 80.0, 90.0])
@pytest.mark.parametrize("scorer", ["ratio", "partial"])
def test_pairs_equal_all_pairs(spark, scorer, cutoff, share):
    """By keys alone, by keys and cells, and by cells alone."""
    names, canon = invented(int(cutoff), longest=30 if scorer == "partial" else 24)
    expected = expected_pairs(names, canon, scorer, cutoff)
    assert len(expected) > 15
    assert found_pairs(resolve.fuzzy_pairs(*sides(spark, names, canon), scorer, cutoff, share=share)) == expected


def test_no_name_is_given_up_where_keys_may_meet_everything(spark):
    names, canon = invented(1)
    pairs, up = candidates.whole_candidates(*sides(spark, names, canon), 80.0, EVERYTHING)
    assert up.count() == 0
    assert pairs.count() < len(names) * len(canon) / 2


def test_needles_too_short_or_repeating_are_given_up(spark):
    names, canon = sides(spark, ["a", "aaaaaaaaaaaaaaaaaaaa", "an unusual long name"], ["an unusual long name, longer"])
    pairs, up = candidates.partial_candidates(names, canon, 90.0, share=EVERYTHING)
    assert {r["name"] for r in up.collect()} == {"a", "aaaaaaaaaaaaaaaaaaaa"}
    assert {r["name"] for r in pairs.collect()} == {"an unusual long name"}


def test_bounds_hold_on_random_strings(spark):
    """No pair shares more characters than the masks allow, nor fewer substrings than a match must."""
    rng = random.Random(4)
    left = words(rng, 40, "abcdefgh ", 30)
    pairs = [(k, a, mistyped(rng, a, "abcdefgh ", 8)) for k, a in enumerate(left)]
    first, second = (
        candidates.numbered(spark.createDataFrame([(p[side], p[0]) for p in pairs], "t string, k long"), name).drop(f"{name}_id")
        for side, name in ((1, "a"), (2, "b"))
    )
    both = first.withColumnRenamed("t", "x").join(second, "k")
    ones, twos = (candidates._in_common("a", "b", parts).alias(parts) for parts in ("ones", "twos"))
    for row in both.select("x", "t", ones, twos).collect():
        assert plain_lcs(row["x"], row["t"]) <= row["ones"]
        pairs_of = lambda text: Counter(text[k : k + 2] for k in range(len(text) - 1))
        assert (pairs_of(row["x"]) & pairs_of(row["t"])).total() <= row["twos"]


@pytest.mark.parametrize("scorer", ["ratio", "partial"])
def test_one_beginning_shared_by_all_names(spark, scorer):
    """Names that their keys do not tell apart are scored in cells, others by keys; none is lost."""
    same = [f"Customer of the house {k:03d}" for k in range(40)]
    rare = [f"{a}{b}{c} wholly other" for a in "xyz" for b in "qjk" for c in "vwu"]
    names, canon = same + rare, [n + "s" for n in same + rare]
    got = found_pairs(resolve.fuzzy_pairs(*sides(spark, names, canon), scorer, 90.0))
    assert got == expected_pairs(names, canon, scorer, 90.0)


def test_best_names_by_keys_equal_a_nested_loop(spark, monkeypatch):
    from test_resolve import mapping_of, plain_best

    names, canon = invented(9)
    for scorer in ("ratio", "partial"):
        for share in (EVERYTHING, candidates.SHARE):
            monkeypatch.setattr(resolve.fuzzy_pairs, "__defaults__", (False, share))
            got = resolve.canonicalize(names_frame(spark, names), "name", names_frame(spark, canon), "name", "seq", scorer, 82.0)
            expected = plain_best(names, canon, scorer, 82.0)
            assert {n: c for n, (c, _) in mapping_of(got).items()} == {n: c for n, (c, _) in expected.items()}


@pytest.mark.parametrize("find", [candidates.whole_candidates, candidates.partial_candidates])
def test_the_index_is_never_broadcast(spark, find):
    """Its files are small, as they repeat each text, but its rows would fill the driver."""
    names = [f"{a}{b} of the house number {a}{k}" for k, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "klmnopqr")]
    pairs, _ = find(*sides(spark, names, names), 80.0, share=EVERYTHING)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [key#" in plan and "BroadcastHashJoin [key#" not in plan


def test_whole_candidates_lie_within_the_edits_that_a_match_may_have(spark):
    """Texts with the same characters and neighbours in another order are no candidates."""
    names, canon = ["abcdefgh ijklmnop qrstuvwx"], ["qrstuvwx ijklmnop abcdefgh", "abcdefgh ijklmnop qrstuvwy"]
    pairs, up = candidates.whole_candidates(*sides(spark, names, canon), 80.0, EVERYTHING)
    assert up.count() == 0
    assert [r["canon"] for r in pairs.collect()] == [canon[1]]


def rows_written(monkeypatch):
    """Rows of every table that the candidates write."""
    rows, write = [], candidates.cut_lineage

    def counted(df):
        rows.append((written := write(df)).count())
        return written

    monkeypatch.setattr(candidates, "cut_lineage", counted)
    return rows


@pytest.mark.parametrize("find, cutoff", [(candidates.whole_candidates, 80.0), (candidates.partial_candidates, 85.0)])
def test_keys_that_tell_little_are_never_made(spark, monkeypatch, find, cutoff):
    """Segments and substrings of two or three characters would be many times the names, and meet most of them."""
    names, rows = sorted(set(words(random.Random(3), 400, "abcdefghijklmnop ", 20))), rows_written(monkeypatch)
    pairs, up = find(*sides(spark, names, names), cutoff)
    assert sum(rows) <= len(names)
    assert pairs.isEmpty() and {r["name"] for r in up.collect()} == set(names)


@pytest.mark.parametrize("shared", [0, 30, 70, 100])
def test_names_on_both_sides_meet_once_and_are_found_both_ways(spark, monkeypatch, shared):
    monkeypatch.setattr(resolve, "CELL", 16)
    rng = random.Random(shared)
    base = words(rng, 60, "abc字", 14)
    both = sorted(set(base) | {mistyped(rng, rng.choice(base), "abc字", 2) for _ in range(60)} | {""}, key=lambda w: rng.random())[:100]
    names, canon = both[:shared] + both[shared : (100 + shared) // 2], both[:shared] + both[(100 + shared) // 2 :]
    for scorer, cutoff in (("ratio", 70.0), ("partial", 72.0)):
        expected = expected_pairs(names, canon, scorer, cutoff)
        assert found_pairs(resolve.fuzzy_pairs(*sides(spark, names, canon), scorer, cutoff)) == expected


def test_of_a_name_and_a_cell_only_the_best_pair_is_dealt_out(spark, monkeypatch):
    """Names with many like them bring no row for each, which would be shuffled to lose duplicates and fetch texts."""
    monkeypatch.setattr(resolve, "LEAST_CELL", 125)
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(14)) for _ in range(40)]
    names, canon = [w[:3] + "x" + w[3:] for w in base], [w + end for w in base for end in (" a", " b", " c", " d", " e")]
    frames = sides(spark, names, canon)
    assert resolve.fuzzy_pairs(*frames, "partial", 85.0).count() == len(expected_pairs(names, canon, "partial", 85.0)) >= 200
    assert resolve.fuzzy_pairs(*frames, "partial", 85.0, best=True).count() <= 2 * len(names)
