"""Seed dimensions of the roster graph. Fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from squadweave.session import literal_table

# college, conference it is listed under, team.
TEAMS = (
    ("University of Florida", "SEC", "Florida Gators"),
    ("University of Missouri", "SEC", "Missouri Tigers"),
    ("University of Oklahoma", "SEC", "Oklahoma Sooners"),
    ("University of Alabama", "SEC", "Alabama Crimson Tide"),
    ("Texas A&M University", "SEC", "Texas A&M Aggies"),
    ("University of Washington", "B1G", "Washington Huskies"),
    ("University of Oregon", "B1G", "Oregon Ducks"),
    ("University of Indiana", "B1G", "Indiana Hoosiers"),
    ("University of Minnesota", "B1G", "Minnesota Golden Gophers"),
    ("University of Southern Mississippi", "SBC", "Southern Miss Golden Eagles"),
    ("Troy University", "SBC", "Troy Trojans"),
    ("University of Louisiana at Lafayette", "SBC", "Louisiana Ragin' Cajuns"),
    ("Rice University", "NCAA", "Rice Owls"),
    ("University of Memphis", "NCAA", "Memphis Tigers"),
    ("University of North Carolina at Charlotte", "NCAA", "Charlotte 49ers"),
    ("Oregon State University", "NCAA", "Oregon State Beavers"),
    ("Texas Tech University", "Big 12", "Texas Tech Red Raiders"),
    ("Oklahoma State University", "Big 12", "Oklahoma State Cowboys"),
    ("Fresno State University", "Mountain West", "Fresno State Bulldogs"),
    ("Air Force Academy", "Mountain West", "Air Force Falcons"),
)

# name, region, abbreviation, founded year, number of teams, headquarters.
CONFERENCES = (
    ("Southeastern Conference", "Southeast", "SEC", "1932", "16", "Birmingham, Alabama"),
    ("Big Ten Conference", "Midwest", "B1G", "1896", "18", "Rosemont, Illinois"),
    ("Sun Belt Conference", "Southeast", "SBC", "1976", "14", "New Orleans, Louisiana"),
    ("American Conference", "Various", "NCAA", "1979", "22", "Irving, Texas"),
    ("Big 12 Conference", "Various", "Big 12", "1994", "16", "Irving, Texas"),
    ("Mountain West Conference", "Western", "MW", "1998", "12", "Colorado Springs, Colorado"),
)

POSITION_NAMES = (
    "Outfielder", "Infielder", "Catcher", "Right-Handed Pitcher", "Left-Handed Pitcher", "Utility",
    "First Base", "Second Base", "Third Base", "Shortstop", "Designated Hitter",
)

# College -> host of its athletics site, in the order in which pages are read.
ROSTER_HOSTS = (
    ("University of Florida", "floridagators.com"),
    ("University of Missouri", "mutigers.com"),
    ("University of Oklahoma", "soonersports.com"),
    ("University of Alabama", "rolltide.com"),
    ("University of Washington", "gohuskies.com"),
    ("University of Oregon", "goducks.com"),
    ("University of Indiana", "iuhoosiers.com"),
    ("University of Minnesota", "gophersports.com"),
    ("Texas A&M University", "12thman.com"),
    ("University of Southern Mississippi", "southernmiss.com"),
    ("Troy University", "troytrojans.com"),
    ("University of Louisiana at Lafayette", "ragincajuns.com"),
    ("Rice University", "riceowls.com"),
    ("University of Memphis", "gotigersgo.com"),
    ("University of North Carolina at Charlotte", "charlotte49ers.com"),
    ("Oregon State University", "osubeavers.com"),
    ("Texas Tech University", "texastech.com"),
    ("Oklahoma State University", "okstate.com"),
    ("Fresno State University", "gobulldogs.com"),
    ("Air Force Academy", "goairforcefalcons.com"),
)

# Newest season first: the order of the batches decides which write is the last.
SEASONS = (2025, 2024)


def roster_url(college: str, host: str, season: int) -> str:
    url = f"https://{host}/sports/baseball/roster"
    if (college, season) != ("University of Florida", 2025):
        url += f"/{season}"
    return url + ("?path=baseball" if college == "Troy University" else "")


def _table(spark: SparkSession, names: tuple[str, ...], rows) -> DataFrame:
    return literal_table(spark, {name: list(values) for name, values in zip(names, zip(*rows))})


def teams(spark: SparkSession) -> DataFrame:
    return _table(spark, ("college", "member_of", "team"), TEAMS)


def conferences(spark: SparkSession) -> DataFrame:
    names = ("name", "region", "abbreviation", "founded_year", "number_of_teams", "headquarters")
    return _table(spark, names, CONFERENCES)


def positions(spark: SparkSession) -> DataFrame:
    return literal_table(spark, {"name": list(POSITION_NAMES)})


def colleges(spark: SparkSession) -> DataFrame:
    return literal_table(spark, {"name": [college for college, _ in ROSTER_HOSTS]})


def page_list(spark: SparkSession) -> DataFrame:
    """``(college, url, season, batch_no, page_no)`` of every listed page."""
    rows = [
        (college, roster_url(college, host, season), season, batch_no, page_no)
        for batch_no, season in enumerate(SEASONS)
        for page_no, (college, host) in enumerate(ROSTER_HOSTS)
    ]
    return _table(spark, ("college", "url", "season", "batch_no", "page_no"), rows)


def team_of_college() -> dict[str, str]:
    return {college: team for college, _, team in TEAMS}
