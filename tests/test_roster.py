"""The whole build, from pages to answers, on a small made-up league."""

import pytest
from pyspark.sql import functions as F

from squadweave.plans import roster
from squadweave.sources import seeds, tables
from test_extract import classic, item, modern, modern_coach, place


def player(name, school, town, position="INF", weight="185 lbs"):
    items = [item(position), item("Jr."), item("6'2\""), item(weight), item("<span data-html-wrapper=''>L/R</span>")]
    return modern(name, items, place("high-school", school) + place("hometown", town))


PAGES = {
    ("Rice University", 2025): player("Al", "Oak High", "tampa, Fla.", "LHP/OF", "200")
    + player("Bo", "Elm", "Miami", "P") + modern_coach("Kay", "Head Coach"),
    ("University of Memphis", 2024): player("Al", "Oak High School", "Tampa, FL", "LHP", "190")
    + modern_coach("Kay", "Assistant Coach") + modern_coach("Kay", "Pitching Coach"),
    ("Troy University", 2025): "<ul>"
    + classic(**{"name": "Cy", "height": "5'9\"", "highschool": "Elm", "hometown": "Austin, Texas", "position-long-short": "C/XX"})
    + classic(name="Bad", highschool="Elm") + "</ul>",
    ("Fresno State University", 2025): player("Di", "N/A", "N/A", "OF"),
    ("Air Force Academy", 2024): modern("Ed", [item("OF"), item("Fr."), item("tall")]),
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("league"))
    urls = {(r.college, r.season): r.url for r in seeds.page_list(spark).collect()}
    rows = [(urls[key], f"<html>{html}</html>") for key, html in PAGES.items()]
    tables.write_table(spark.createDataFrame(rows, "url string, html string"), f"{root}/pages")
    roster.extract_rosters(spark, f"{root}/pages", f"{root}/raw")
    roster.clean_all(roster.read_raw(spark, f"{root}/raw"), f"{root}/clean")
    return root, roster.load_all(spark, f"{root}/clean", f"{root}/graph")


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_raw_tables(spark, built):
    root, _ = built
    raw = roster.read_raw(spark, f"{root}/raw")
    assert values(raw["players"], "name", "season") == [("Al", 2024), ("Al", 2025), ("Bo", 2025), ("Cy", 2025), ("Di", 2025)]
    assert [r.name for r in raw["highschools"].orderBy("name").collect()] == ["Elm", "Oak High", "Oak High School"]
    rejected = spark.read.parquet(f"{root}/raw/rejected")
    assert values(rejected, "college", "error") == [
        ("Air Force Academy", "page holds a card with an unreadable height"), ("Troy University", "unreadable height"),
    ]


def test_clean_tables(spark, built):
    root, _ = built
    players = spark.read.parquet(f"{root}/clean/players")
    assert values(players.filter("season = 2025"), "name", "high_school", "hometown", "class_year", "batting", "throwing", "position1", "position2") == [
        ("Al", "Oak High", "Tampa, FL", "Junior", "Left", "Right", "Left-Handed Pitcher", "Outfielder"),
        ("Bo", "Elm", "Miami", "Junior", "Left", "Right", "Pitcher", None),
        ("Cy", "Elm", "Austin, TX", None, None, None, "Catcher", None),
        ("Di", None, "Unknown", "Junior", "Left", "Right", "Outfielder", None),
    ]
    coaches = spark.read.parquet(f"{root}/clean/coaches")
    assert values(coaches, "name", "season", "title", "team") == [
        ("Kay", 2024, "Assistant Coach | Pitching Coach", "Memphis Tigers"), ("Kay", 2025, "Head Coach", "Rice Owls"),
    ]
    assert [r.name for r in spark.read.parquet(f"{root}/clean/highschools").orderBy("name").collect()] == ["Elm", "Oak High"]


def test_graph(built):
    _, g = built
    counts = {label: df.count() for label, df in g.nodes.items()}
    assert counts == {"Conference": 6, "HighSchool": 2, "Team": 20, "Player": 4, "Position": 11, "Coach": 1, "College": 20}
    # The load reads the newer season first, so the older one writes last.
    assert values(g.nodes["Player"].filter("name = 'Al'"), "hometown", "height", "weight") == [("Tampa, FL", 74, 190)]
    assert values(g.edges["PLAYS_FOR"], "name", "team", "season") == [
        ("Al", "Memphis Tigers", 2024), ("Al", "Rice Owls", 2025), ("Bo", "Rice Owls", 2025), ("Cy", "Troy Trojans", 2025),
        ("Di", "Fresno State Bulldogs", 2025),
    ]
    assert values(g.edges["ATTENDED"], "name", "high_school") == [("Al", "Oak High"), ("Bo", "Elm"), ("Cy", "Elm")]
    # Pitcher is no position node, and a player without a school gets no position.
    assert values(g.edges["HAS_POSITION"], "name", "position") == [("Al", "Left-Handed Pitcher"), ("Al", "Outfielder"), ("Cy", "Catcher")]
    assert (g.edges["MEMBER_OF"].count(), g.edges["REPRESENTS"].count()) == (18, 18)
    assert values(g.edges["COACHES"], "name", "team", "role", "season") == [
        ("Kay", "Memphis Tigers", ["Assistant Coach", "Pitching Coach"], 2024), ("Kay", "Rice Owls", ["Head Coach"], 2025),
    ]
    assert values(g.edges["TRANSFERRED_TO"], "name", "to_team", "from_team", "season") == [("Al", "Rice Owls", "Memphis Tigers", 2025)]


def test_clean_mode_and_season_recency(spark, built, tmp_path):
    root, _ = built
    g = roster.load_all(spark, f"{root}/clean", str(tmp_path), strict=False, recency="season")
    assert g.edges["REPRESENTS"].count() == 20
    assert ("Di", "Outfielder") in values(g.edges["HAS_POSITION"], "name", "position")
    assert values(g.nodes["Player"].filter("name = 'Al'"), "weight") == [(200,)]


def test_loading_again_changes_nothing(spark, built, tmp_path):
    root, g = built
    expected = {kind: values(df, *df.columns) for kind, df in {**g.nodes, **g.edges}.items()}
    for _ in range(2):
        again = roster.load_all(spark, f"{root}/clean", str(tmp_path))
        assert {kind: values(df, *df.columns) for kind, df in {**again.nodes, **again.edges}.items()} == expected


def test_every_position_stays_in_the_clean_table(spark, built):
    root, g = built
    players = spark.read.parquet(f"{root}/raw/players").withColumn("position", F.lit("C/OF/INF/LHP/C"))
    mapping = spark.createDataFrame([], "name string, canon string")
    clean = roster.clean_players(players, mapping)
    assert {c for c in clean.columns if c.startswith("position") and c[-1].isdigit()} == {f"position{k}" for k in range(1, 6)}
    expected = ["Catcher", "Outfielder", "Infielder", "Left-Handed Pitcher", "Catcher"]
    assert [r.positions for r in roster.player_rows(clean).limit(1).collect()] == [expected]
    tables_of = {"players": clean, "coaches": spark.read.parquet(f"{root}/clean/coaches")}
    counts = [
        roster.build_edges(tables_of, g.nodes, strict)["HAS_POSITION"].select("position").distinct().count()
        for strict in (True, False)
    ]
    assert counts == [3, 4]


def test_what_is_not_in_the_graph_is_reported(spark, built, tmp_path):
    root, _ = built
    players = spark.read.parquet(f"{root}/clean/players")
    nameless = players.filter("name = 'Bo'").withColumn("name", F.lit(None).cast("string"))
    tables.write_table(players.unionByName(nameless), f"{tmp_path}/clean/players")
    for name in ("coaches", "highschools"):
        tables.write_table(spark.read.parquet(f"{root}/clean/{name}"), f"{tmp_path}/clean/{name}")
    roster.load_all(spark, f"{tmp_path}/clean", f"{tmp_path}/graph")
    report = lambda kind, name: roster.read_report(spark, f"{tmp_path}/graph", kind, name)
    assert values(report("rejected", "Player"), "name", "hometown") == [(None, "Miami")]
    assert values(report("unmatched", "MEMBER_OF"), "member_of", "n") == [("Mountain West", 2)]
    assert values(report("unmatched", "ATTENDED"), "high_school", "n") == [(None, 1)]
    assert ("Pitcher", 2) in values(report("unmatched", "HAS_POSITION"), "position", "n")
    metrics = spark.read.parquet(f"{root}/clean/dedup_metrics")
    assert values(metrics, "original", "canonical", "removed") == [(3, 2, 1)]


def test_a_failing_load_leaves_the_old_graph(spark, built, tmp_path, monkeypatch):
    root, g = built
    roster.load_all(spark, f"{root}/clean", str(tmp_path))
    monkeypatch.setattr(roster, "build_transfers", lambda plays_for: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        roster.load_all(spark, f"{root}/clean", str(tmp_path), strict=False)
    kept = roster.read_graph(spark, str(tmp_path))
    assert {k: df.count() for k, df in kept.edges.items()} == {k: df.count() for k, df in g.edges.items()}


def test_a_seed_table_with_a_key_twice_stops_the_load(spark, built, tmp_path, monkeypatch):
    root, _ = built
    teams = seeds.teams
    monkeypatch.setattr(roster.seeds, "teams", lambda spark: teams(spark).union(teams(spark).limit(1)))
    with pytest.raises(ValueError, match="Team"):
        roster.load_all(spark, f"{root}/clean", str(tmp_path))


def test_refresh_of_the_players(spark, built, tmp_path):
    root, g = built
    batch = spark.read.parquet(f"{root}/clean/players").filter("name = 'Al' and season = 2025")
    roster.refresh_players(g, batch, str(tmp_path / "Player"))
    fresh = spark.read.parquet(str(tmp_path / "Player"))
    assert fresh.count() == 4
    assert values(fresh.filter("name = 'Al'"), "weight") == [(200,)]


def test_refresh_merges_nodes_and_edges(spark, built, tmp_path):
    root, full = built
    clean = {name: spark.read.parquet(f"{root}/clean/{name}") for name in ("players", "coaches", "highschools")}
    older = {**clean, "players": clean["players"].filter("season = 2025"), "coaches": clean["coaches"].filter("season = 2024")}
    for name, df in older.items():
        tables.write_table(df, f"{tmp_path}/clean/{name}")
    roster.load_all(spark, f"{tmp_path}/clean", f"{tmp_path}/graph")
    newer = {**clean, "players": clean["players"].filter("season = 2024"), "coaches": clean["coaches"].filter("season = 2025")}
    everything = lambda g: {kind: values(df, *sorted(df.columns)) for kind, df in {**g.nodes, **g.edges}.items()}
    once = everything(roster.refresh(spark, f"{tmp_path}/graph", newer))
    # The full load writes the older season last, and so does this order of batches.
    assert once == everything(full)
    assert everything(roster.refresh(spark, f"{tmp_path}/graph", newer)) == once


def test_questions(built):
    _, g = built
    assert values(roster.top_high_schools(g, 1), "high_school", "n") == [("Elm", 2)]
    assert values(roster.transfers_between_teams(g), "from_team", "to_team", "n") == [("Memphis Tigers", "Rice Owls", 1)]
    assert values(roster.left_handed_pitchers(g), "conference", "n") == [("American Conference", 1)]
    assert values(roster.teams_sharing_high_schools(g), "team_a", "team_b", "shared") == [
        ("Memphis Tigers", "Rice Owls", 1), ("Rice Owls", "Troy Trojans", 1),
    ]
    assert values(roster.head_coaches_by_conference(g), "conference", "n") == [("American Conference", 1)]
    first = roster.conference_players(g, "NCAA", 3)
    assert values(first, "name", "team", "position") == [
        ("Al", "Memphis Tigers", "Left-Handed Pitcher"), ("Al", "Memphis Tigers", "Outfielder"),
        ("Al", "Rice Owls", "Left-Handed Pitcher"), ("Al", "Rice Owls", "Outfielder"), ("Bo", "Rice Owls", None),
    ]
    assert values(roster.conference_players(g, "MW"), "conference", "team", "name") == [("Mountain West Conference", None, None)]


def test_raw_tables_from_csv(spark, tmp_path):
    (tmp_path / "players.csv").write_text(
        "College,Name,Jersey,Position,Class Year,Height,Weight,B/T,High School,Hometown,Season\n"
        "Rice University,Al,7,P,Fr.,74.0,N/A,R-R,Oak,\"tampa, Fla.\",2025\nRice University,Al,8,P,Fr.,,180,R-R,Oak,\"Tampa, FL\",2024\n"
    )
    (tmp_path / "coaches.csv").write_text("College,Name,Title,Season\nRice University,Kay,Head Coach,2025\n")
    (tmp_path / "highschools.csv").write_text("name\nOak\n")
    roster.clean_all(roster.read_raw_csv(spark, str(tmp_path)), str(tmp_path / "clean"))
    g = roster.load_all(spark, str(tmp_path / "clean"), str(tmp_path / "graph"))
    # The last row of the file wins, nulls included.
    assert values(g.nodes["Player"], "name", "height", "weight") == [("Al", None, 180)]
    assert values(g.edges["PLAYS_FOR"], "season", "jersey") == [(2024, 8), (2025, 7)]


def test_broken_csv_lines_become_tables(spark, tmp_path):
    raw, rejected = tmp_path / "raw", str(tmp_path / "rejected")
    raw.mkdir()
    for name, schema in roster.RAW_TABLES.items():
        fields = len(schema.fields)
        lines = [",".join(field.name for field in schema.fields), ",".join(["x"] * fields), ",".join(["y"] * (fields + 2)), ",".join(["z"] * fields)]
        (raw / f"{name}.csv").write_text("\n".join(lines) + "\n")
    found = roster.read_raw_csv(spark, str(raw), rejected)
    for name, schema in roster.RAW_TABLES.items():
        assert [row[0] for row in found[name].orderBy("seq").collect()] == ["x", "z"]
        (line,) = spark.read.parquet(f"{rejected}/{name}").collect()
        assert line["line"].strip() == ",".join(["y"] * (len(schema.fields) + 2))
        assert roster.read_raw_csv(spark, str(raw))[name].count() == 3
