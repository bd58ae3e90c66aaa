"""Known results of the roster build.

The tables are not part of this repository. ``ROSTER_GOLDEN_DIR`` names a
folder with ``raw`` and ``processed`` CSV files of coaches and high schools;
without it only the seed graph is checked.
"""

import ast
import csv
import os

import pytest
from pyspark.sql import functions as F

from squadweave.operators import graph
from squadweave.plans import roster
from squadweave.sources import seeds

GOLDEN = os.environ.get("ROSTER_GOLDEN_DIR")
needs_golden = pytest.mark.skipif(not GOLDEN, reason="ROSTER_GOLDEN_DIR is not set")

# A high school whose name lost a slash on the way to the list, so that no player names it.
UNNAMED = "Belen Jesuit (Santa Fe CC  Florida Atlantic)"


def stored(name):
    with open(f"{GOLDEN}/{name}.csv", encoding="utf-8-sig", newline="") as lines:
        return list(csv.DictReader(lines))


@pytest.fixture(scope="module")
def coaches(spark):
    from squadweave import schemas
    from squadweave.sources import tables

    raw = roster.plain_names(tables.read_table(spark, f"{GOLDEN}/raw/coaches.csv", schemas.RAW_COACHES, order="seq"))
    return roster.clean_coaches(raw).cache()


@pytest.fixture(scope="module")
def schools(spark):
    from squadweave import schemas
    from squadweave.sources import tables

    return tables.read_table(spark, f"{GOLDEN}/raw/highschools.csv", schemas.NAMES)


@needs_golden
def test_clean_coaches_equal_the_stored_table(coaches):
    got = [
        (r.name, r.college, r.season, r.title, r.team, r.role_list)
        for r in coaches.orderBy("name", "college", "season").collect()
    ]
    expected = [
        (r["Name"], r["College"], int(r["Season"]), r["Title"], r["Team"], ast.literal_eval(r["Role List"]))
        for r in stored("processed/coaches")
    ]
    assert len(expected) == 186
    assert got == expected


@needs_golden
def test_high_schools_equal_the_stored_list_in_order(schools):
    named = schools.filter(F.col("name") != UNNAMED).withColumnRenamed("name", "high_school")
    mapping = roster.resolve_high_schools(named, schools)
    got = [r.name for r in roster.clean_high_schools(schools, mapping).orderBy("seq").collect()]
    expected = [r["name"] for r in stored("processed/highschools")]
    assert len(expected) == 823
    assert got == expected


@needs_golden
def test_seed_tables_equal_the_stored_ones(spark):
    from squadweave import schemas
    from squadweave.sources import tables

    for name, schema, seed in (
        ("teams", schemas.TEAMS, seeds.teams(spark)),
        ("conferences", schemas.CONFERENCES, seeds.conferences(spark)),
        ("positions", schemas.NAMES, seeds.positions(spark)),
        ("colleges", schemas.NAMES, seeds.colleges(spark)),
    ):
        rows = tables.read_table(spark, f"{GOLDEN}/processed/{name}.csv", schema)
        assert [tuple(r) for r in rows.collect()] == [tuple(r) for r in seed.collect()]


@needs_golden
def test_coach_graph_counts(coaches, spark):
    nodes = graph.merge_nodes(coaches, ["name"])
    teams = seeds.teams(spark)
    edges = graph.edge_coaches(
        coaches, nodes, teams, {"name": "name"}, {"team": "team"}, ["role_list", "season"], ["college", "season"]
    )
    assert nodes.count() == 110
    assert edges.count() == 111
    assert edges.groupBy("name").count().filter("count > 1").count() == 1


def test_seed_graph_counts(spark):
    nodes = roster.build_nodes({"players": _no_players(spark), "coaches": _names(spark), "highschools": _names(spark)})
    assert {k: nodes[k].count() for k in ("Conference", "Team", "College", "Position")} == {
        "Conference": 6, "Team": 20, "College": 20, "Position": 11,
    }
    team, member = {"team": "name"}, {"member_of": "abbreviation"}
    rows = seeds.teams(spark)
    members = graph.edge_member_of(rows, nodes["Team"], nodes["Conference"], team, member, "name")
    assert members.count() == 18
    assert members.filter("team in ('Fresno State Bulldogs', 'Air Force Falcons')").count() == 0
    college = {"college": "name"}
    assert graph.edge_represents(rows, nodes["Team"], nodes["College"], team, college).count() == 20
    strict = graph.edge_represents(rows, nodes["Team"], nodes["College"], team, college, nodes["Conference"], member)
    assert strict.count() == 18


def test_page_list(spark):
    pages = seeds.page_list(spark)
    assert pages.count() == 40
    assert pages.select("url").distinct().count() == 40
    urls = {(r.college, r.season): r.url for r in pages.collect()}
    assert urls["University of Florida", 2025].endswith("/roster")
    assert urls["Troy University", 2024].endswith("/roster/2024?path=baseball")


def _names(spark):
    return spark.createDataFrame([], "name string")


def _no_players(spark):
    return spark.createDataFrame(
        [],
        "name string, hometown string, team string, high_school string, class_year string, height string, weight string,"
        "jersey string, season int, batting string, throwing string, position_list array<string>,"
        "seq long",
    )
