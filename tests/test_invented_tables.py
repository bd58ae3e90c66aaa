"""The build's rules on invented tables, case by case; these run without any outside file."""

import pytest
from pyspark.sql import functions as F

from squadweave.plans import roster

RAW = (
    "college string, name string, jersey string, position string, class_year string, height string, weight string, bt string,"
    " high_school string, hometown string, season int, seq long"
)
CLEAN = {
    "college": "Rice University", "name": "Al", "jersey": "7", "position": "C", "class_year": "Fr.", "height": "74",
    "weight": "190", "bt": "R/R", "high_school": "Oak", "hometown": "Miami", "season": 2025, "seq": 1,
}


def raw(spark, rows):
    return spark.createDataFrame([tuple({**CLEAN, **row}.values()) for row in rows], RAW)


def cleaned(spark, column, texts):
    """Clean rows of players that differ in one raw column, in the order given."""
    rows = raw(spark, [{column: text, "name": f"P{at}", "seq": at} for at, text in enumerate(texts)])
    mapping = spark.createDataFrame([], "name string, canon string")
    return roster.clean_players(rows, mapping).orderBy("seq").collect()


def test_positions(spark):
    cases = {
        "INF/RHP": ["Infielder", "Right-Handed Pitcher"],
        "INF/IF": ["Infielder", "Infielder"],
        "C, OF": ["Catcher", "Outfielder"],
        "XX": [],
        None: [],
        "P": ["Pitcher"],
        "CF": ["Center Field"],
    }
    rows = cleaned(spark, "position", cases)
    assert [r.position_list for r in rows] == list(cases.values())
    assert [(r.position1, r.position2) for r in rows] == [tuple((v + [None, None])[:2]) for v in cases.values()]


def test_class_years(spark):
    cases = {"R-So.": "Redshirt Sophomore", " Fr. ": "Freshman", "Mystery": "Mystery", None: None, "N/A": None}
    assert [r.class_year for r in cleaned(spark, "class_year", cases)] == list(cases.values())


def test_sides(spark):
    cases = {
        "R-R": ("Right", "Right"), "l/r": ("Left", "Right"), "B/R": ("Switch", "Right"), "S": ("Switch", None),
        "Year": (None, None), "Right/Right": (None, None), "/R": ("Right", None), None: (None, None),
    }
    assert [(r.batting, r.throwing) for r in cleaned(spark, "bt", cases)] == list(cases.values())


def test_hometowns(spark):
    cases = {
        "tampa, Fla.": "Tampa, FL", "o'fallon, mo.": "O'Fallon, MO", "Toronto, Ontario, Canada": "Toronto, Canada",
        "Miami": "Miami", None: "Unknown",
    }
    assert [r.hometown for r in cleaned(spark, "hometown", cases)] == list(cases.values())


def test_numbers(spark):
    rows = raw(spark, [{"jersey": text, "name": f"P{at}", "seq": at} for at, text in enumerate(["N/A", "12.0", "12"])])
    clean = roster.clean_players(rows, spark.createDataFrame([], "name string, canon string"))
    assert [r.jersey for r in roster.player_rows(clean).orderBy("order").collect()] == [None, 12, 12]


@pytest.mark.parametrize("recency, weight", [("file", None), ("season", 200)])
def test_the_last_write_wins(spark, recency, weight):
    rows = raw(spark, [{"weight": "200", "season": 2025, "seq": 1}, {"weight": None, "season": 2024, "seq": 2}])
    clean = roster.clean_players(rows, spark.createDataFrame([], "name string, canon string"))
    nodes = roster.graph.merge_nodes(roster.player_rows(clean, recency), ["name", "hometown"], ["weight"], ["order"])
    assert [r.weight for r in nodes.collect()] == [weight]


def test_transfers(spark):
    rows = [("a", 2024, "A"), ("a", 2025, "B"), ("b", 2023, "A"), ("b", 2025, "B"), ("c", 2024, "A"), ("c", 2025, "A")]
    plays = spark.createDataFrame([(n, "x", t, s) for n, s, t in rows], "name string, hometown string, team string, season int")
    found = roster.build_transfers(plays).select("name", "from_team", "to_team", "season").collect()
    assert [tuple(r) for r in found] == [("a", "A", "B", 2025)]


def test_coach_titles(spark):
    titles = {
        "Kay": ["Recruiting Coordinator", "Head Coach", "Head Coach"],
        "Lee": ["Volunteer Coach (Pitching)"],
        "Max": ["Athletic Performance Coach"],
        "Ned": ["Head Coach/Pitching Coach"],
        "Ora": ["Associate Head Coach"],
        "Pat": ["Undergraduate Assistant Coach"],
        "Quy": ["Associate Strength & Conditioning Coach"],
        "Ros": ["Special Assistant to the Head Coach"],
        "Sam": ["Head Baseball Coach"],
    }
    rows = [("Rice University", name, title, 2025) for name, of in titles.items() for title in of]
    rows += [("Rice University", None, "Head Coach", 2025)]
    found = roster.clean_coaches(spark.createDataFrame(rows, "college string, name string, title string, season int"))
    by_name = {r.name: (r.title, r.role_list) for r in found.collect()}
    assert by_name["Kay"][0] == "Head Coach | Recruiting Coordinator" and by_name["Kay"][1][0] == "Head Coach"
    assert {name: roles for name, (_, roles) in by_name.items() if name != "Kay"} == {
        "Lee": ["Volunteer Coach"], "Max": ["Assistant Coach"], "Ned": ["Head Coach", "Pitching Coach"],
        "Ora": ["Head Coach"], "Pat": ["Assistant Coach"], "Quy": ["Assistant Coach"], "Ros": ["Head Coach"],
        "Sam": ["Assistant Coach"],
    }
    assert {r.team for r in found.select(F.col("team")).distinct().collect()} == {"Rice Owls"}


def test_high_schools_keep_their_order_and_over_merge(spark):
    """Matching is case-sensitive and not transitive; the earliest canonical name wins."""
    names = ["Arlington Catholic", "Boston Latin", "Catholic", "Latin School", "Zion Catholic"]
    schools = spark.createDataFrame([(n,) for n in names], "name string")
    mapping = roster.resolve_high_schools(schools.withColumnRenamed("name", "high_school"), schools)
    found = {r.name: r.canon for r in mapping.collect()}
    assert found["Catholic"] == "Arlington Catholic" and found["Zion Catholic"] == "Catholic"
    kept = [r.name for r in roster.clean_high_schools(schools, mapping).orderBy("seq").collect()]
    assert kept == sorted(set(found.values()), key=lambda canon: min(n for n in names if found[n] == canon))
