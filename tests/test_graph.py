import random

import pytest
from pyspark.sql import functions as F

from squadweave.operators import graph, paths, quality
from squadweave.operators.paths import Hop


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return {tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()}


def test_last_write_keeps_nulls_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "t", 200, 2025, 1), ("a", "t", None, 2024, 2), (None, "t", 1, 2024, 3), ("b", None, 1, 2024, 4)],
        "name string, town string, weight int, season int, seq int",
    )
    keys = ["name", "town"]
    assert rows(graph.merge_nodes(df, keys, ["weight"], ["seq"])) == {("a", "t", None)}
    assert rows(graph.merge_nodes(df, keys, ["weight"], ["season", "seq"])) == {("a", "t", 200)}
    assert rows(graph.merge_nodes(df, ["name"])) == {("a",), ("b",)}
    assert graph.null_key_rows(df, keys).count() == 2


@pytest.mark.parametrize("seed", range(2))
def test_merge_does_not_depend_on_row_order_or_partitions(spark, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(20), rng.choice(["x", None, "y"]), at) for at in range(500)]
    expected = {}
    for key, value, _ in data:
        expected[key] = value
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k int, v string, seq int").repartition(1 + 6 * seed)
    assert dict(rows(graph.merge_nodes(df, ["k"], ["v"], ["seq"]))) == expected


def test_merging_a_batch_again_changes_nothing(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", None, 1), ("c", 3, 2), ("c", 4, 3)], "k string, v int, seq int")
    once = graph.merge_idempotent(stored, batch, ["k"], ["v"], ["seq"])
    assert rows(once) == {("a", 1), ("b", None), ("c", 4)}
    assert rows(graph.merge_idempotent(once, batch, ["k"], ["v"], ["seq"])) == rows(once)


@pytest.fixture(scope="module")
def roster(spark):
    data = [
        # name, hometown, team, high school, season, positions, seq
        ("Al", "X", "T1", "H1", 2024, ["Catcher", "Pitcher"], 3),
        ("Al", "X", "T2", "H1", 2025, ["Catcher"], 1),
        ("Bo", "Y", "T?", "H1", 2025, ["Catcher"], 2),
        ("Cy", "Z", "T1", "H?", 2025, ["Catcher"], 4),
        ("Di", "W", None, None, 2025, [None, ""], 5),
        ("Al", "X", "T1", "H1", 2024, [], 9),
    ]
    return spark.createDataFrame(
        data, "name string, hometown string, team string, high_school string, season int, positions array<string>, seq int"
    )


PLAYER = {"name": "name", "hometown": "hometown"}
TEAM, SCHOOL = {"team": "name"}, {"high_school": "name"}


@pytest.fixture(scope="module")
def nodes(spark, roster):
    named = lambda *values: spark.createDataFrame([(v,) for v in values], "name string")
    return {
        "Player": graph.merge_nodes(roster, ["name", "hometown"]), "Team": named("T1", "T2"), "HighSchool": named("H1"),
        "Position": named("Catcher"),
    }


def test_player_edges(roster, nodes):
    plays = graph.edge_plays_for(roster, nodes["Player"], nodes["Team"], PLAYER, TEAM, "season", ["positions"], ["seq"])
    assert rows(plays) == {
        ("Al", "X", "T1", 2024, ()), ("Al", "X", "T2", 2025, ("Catcher",)), ("Cy", "Z", "T1", 2025, ("Catcher",)),
    }
    strict = graph.edge_attended(roster, nodes["Player"], nodes["HighSchool"], PLAYER, SCHOOL, nodes["Team"], TEAM)
    assert rows(strict) == {("Al", "X", "H1")}
    clean = graph.edge_attended(roster, nodes["Player"], nodes["HighSchool"], PLAYER, SCHOOL)
    assert rows(clean) == {("Al", "X", "H1"), ("Bo", "Y", "H1")}
    also = [(nodes["Team"], TEAM), (nodes["HighSchool"], SCHOOL)]
    position = {"position": "name"}
    strict = graph.edge_has_position(roster, nodes["Player"], nodes["Position"], PLAYER, "positions", position, also)
    assert rows(strict) == {("Al", "X", "Catcher")}
    clean = graph.edge_has_position(roster, nodes["Player"], nodes["Position"], PLAYER, "positions", position)
    assert rows(clean) == {("Al", "X", "Catcher"), ("Bo", "Y", "Catcher"), ("Cy", "Z", "Catcher")}


def test_coach_edge_keeps_one_season(spark):
    df = spark.createDataFrame([("c", "T1", 2024, "a"), ("c", "T1", 2025, "b"), ("c", "T2", 2024, "x")], "name string, team string, season int, role string")
    nodes = df.select("name").distinct()
    teams = df.select(F.col("team").alias("name")).distinct()
    got = graph.edge_coaches(df, nodes, teams, {"name": "name"}, TEAM, ["season", "role"], ["season"])
    assert rows(got) == {("c", "T1", 2025, "b"), ("c", "T2", 2024, "x")}


def plain_transfers(stays, period=1):
    last = {}
    for p, a, s in stays:
        for q, b, u in stays:
            if p == q and a != b and s + period == u:
                last[p, b] = max(last.get((p, b), (0, "")), (u, a))
    return {(p, b, a, u) for (p, b), (u, a) in last.items()}


@pytest.mark.parametrize("period", [1, 2])
def test_transfers_equal_a_nested_loop(spark, period):
    rng = random.Random(period)
    # One player holds a third of all rows.
    stays = {(rng.choice([0, 0, 1, 2, 3, 4]), f"T{rng.randrange(6)}", 2000 + rng.randrange(8)) for _ in range(150)}
    df = spark.createDataFrame(sorted(stays), "player int, team string, season int")
    got = graph.transfers(df, ["player"], "team", "season", period)
    assert rows(got.select("player", "to_team", "from_team", "season")) == plain_transfers(stays, period)


def test_transfer_cases(spark):
    stays = [("a", "A", 2024), ("a", "B", 2025), ("b", "A", 2023), ("b", "B", 2025), ("c", "A", 2024), ("c", "A", 2025)]
    df = spark.createDataFrame(stays, "player string, team string, season int")
    edges = graph.transfers(df, ["player"], "team", "season")
    assert rows(edges) == {("a", "B", "A", 2025)}
    assert rows(paths.transfer_counts(edges)) == {("A", "B", 1)}


def test_transfers_form_no_pairs(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("p"), (F.col("id") % 5).cast("string").alias("t"), (F.col("id") % 3).alias("s"))
    plan = plan_of(graph.transfers(df, ["p"], "t", "s"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keys_and_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, v int")
    assert rows(quality.duplicate_keys(df, ["k"])) == {("a", 2)}
    assert rows(quality.assert_unique(df, ["k"])) == {("a", 2, "duplicate"), (None, 1, "null key")}
    quality.require_unique(df.filter("k = 'b'"), ["k"], "kept")
    with pytest.raises(ValueError, match="Team"):
        quality.require_unique(df, ["k"], "Team")
    nodes = spark.createDataFrame([("b",)], "name string")
    assert rows(quality.unmatched_report(df, nodes, {"k": "name"})) == {("a", 2), (None, 1)}
    assert rows(quality.matched_share(df, nodes, {"k": "name"})) == {(4, 1)}


def plain_shared(links):
    found = {}
    for a, v in links:
        for b, w in links:
            if a < b and v == w:
                found[a, b] = found.get((a, b), 0) + 1
    return {(a, b, n) for (a, b), n in found.items()}


@pytest.mark.parametrize("light", [0, 3, 64])
@pytest.mark.parametrize("text", [True, False])
def test_shared_neighbors_equal_a_nested_loop(spark, light, text, monkeypatch):
    monkeypatch.setattr(paths, "TILE", 4)
    monkeypatch.setattr(paths, "STRIP", 3)
    rng = random.Random(light)
    label = (lambda n: f"t{n}") if text else (lambda n: n)
    # One school holds a third of all links.
    links = {(label(rng.randrange(15)), rng.choice([0, 0, 0, *range(1, 10)])) for _ in range(90)}
    df = spark.createDataFrame(sorted(links) * 2, f"team {'string' if text else 'long'}, school long")
    got = paths.shared_neighbors(df, "team", "school", light)
    assert rows(got) == plain_shared(links)


def test_optional_path(spark):
    conf = spark.createDataFrame([("C1",), ("C2",)], "conf string")
    member = spark.createDataFrame([("C1", "T1"), ("C1", "T2")], "conf string, team string")
    plays = spark.createDataFrame([("T1", "b"), ("T1", "a"), ("T1", None)], "team string, name string")
    has = spark.createDataFrame([("a", "P"), ("a", "Q")], "name string, position string")
    hops = lambda optional: [Hop(member, {"conf": "conf"}, optional), Hop(plays, {"team": "team"}, optional)]
    first = [F.asc_nulls_last("name"), F.asc_nulls_last("team"), F.asc_nulls_last("conf")]
    got = paths.path_top_k(conf, hops(True), first, 2, [Hop(has, {"name": "name"}, True)])
    assert rows(got) == {("C1", "T1", "a", "P"), ("C1", "T1", "a", "Q"), ("C1", "T1", "b", None)}
    assert rows(paths.path(conf, hops(True))) == {
        ("C1", "T1", "a"), ("C1", "T1", "b"), ("C1", "T1", None), ("C1", "T2", None), ("C2", None, None),
    }
    assert len(rows(paths.path(conf, hops(False)))) == 3
    assert rows(paths.count_by_path(conf, hops(False), F.lit(True), "conf", ["name"])) == {("C1", 2)}
    assert rows(paths.top_producers(plays, "team", ["name"], 1)) == {("T1", 2)}
