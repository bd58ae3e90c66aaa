import time

import pytest
from pyspark.sql import functions as F

from squadweave.functions.markup import parse
from squadweave.operators import extract

SR = "<span class='sr-only'>read out</span>"


def item(content):
    return f"<span class='s-person-details__bio-stats-item'>{SR} {content} </span>"


def modern(name, items, extra="", jersey="<div data-test-id='s-stamp__root'><span class='s-stamp__text'>" + SR + "7</span></div>"):
    head = f"<h3> {name} </h3>" if name else ""
    return (
        f"<div class='wide s-person-card__content'>{head}{jersey}"
        f"<div class='s-person-details__bio-stats'>{''.join(items)}</div>{extra}</div>"
    )


def place(kind, content):
    return f"<span data-test-id='s-person-card-list__content-location-person-{kind}'>{SR}{content}</span>"


def modern_coach(name, title):
    return (
        f"<div class='s-person-card__content'><h3>{name}</h3>"
        f"<div class='s-person-details__position'><div> {title} </div></div></div>"
    )


FULL = [item("INF"), item("Jr."), item("6'2\""), item("185 lbs"), item("B/T <span data-html-wrapper>R/R</span>")]


def classic(**fields):
    name = fields.pop("name", None)
    spans = "".join(f"<span class='sidearm-roster-player-{k}'>{v}</span>" for k, v in fields.items())
    return f"<li class='sidearm-roster-player'>{f'<h3>{name}</h3>' if name else ''}{spans}</li>"


PAGES = {
    "modern": modern("Ann&amp;Bo <b>Doe</b>", FULL, place("high-school", "Oak / High") + place("hometown", "tampa, Fla."))
    + modern("Short Items", FULL[:2], jersey="")
    + modern(None, FULL)
    + modern_coach("C One", "Head COACH")
    + modern_coach("C Two", "Trainer"),
    "modern-bad": modern("Good One", FULL) + modern("Tall One", FULL[:2] + [item("tall")]) + modern_coach("C Three", "Coach"),
    "classic": classic(name="John <b>Doe</b>", height="5'11\"", weight="190 lbs", highschool="Elm")
    + classic(name="No Height", weight="200")
    + classic(height="6'0\"")
    + "<li class='sidearm-roster-coach'><p>K Coach</p><div class='sidearm-roster-coach-title'>Pitching Coach</div></li>"
    + "<li class='sidearm-roster-coach'><div class='sidearm-roster-coach-title'>Head Coach</div></li>",
    "both": classic(name="Hidden", height="6'0\"") + modern("Seen", FULL),
    "unknown": "<div class='other'><h3>Nobody</h3></div>",
    "comment": "<!-- s-person-card__content --><p>sidearm-roster-player</p>",
}


@pytest.fixture(scope="module")
def cards(spark):
    pages = spark.createDataFrame([(k, f"<html><body>{v}</body></html>") for k, v in PAGES.items()], "page string, html string")
    return extract.roster_cards(pages).cache()


def rows(df, page):
    return [r.asDict() for r in df.filter(F.col("page") == page).orderBy("card_no").collect()]


def test_layouts(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "page string, html string")
    found = {r.page: r.layout for r in extract.detect_layout(pages).collect()}
    assert found == {
        "modern": "modern", "modern-bad": "modern", "classic": "classic", "both": "modern", "unknown": "unknown", "comment": "unknown",
    }


def test_layout_marker_written_with_a_character_reference(spark):
    pages = spark.createDataFrame([("<div class='s-person&#45;card__content'></div>",)], "html string")
    assert extract.detect_layout(pages).first().layout == "modern"


def test_modern_players(cards):
    first, second = rows(extract.roster_players(cards), "modern")
    assert {k: first[k] for k in extract.PLAYER_FIELDS} == {
        "name": "Ann&Bo Doe", "jersey": "7", "position": "INF", "class_year": "Jr.", "height": "74", "weight": "185",
        "bt": "R/R", "high_school": "Oak / High", "hometown": "tampa, Fla.",
    }
    assert {k: second[k] for k in extract.PLAYER_FIELDS} == {
        "name": "Short Items", "jersey": "N/A", "position": "INF", "class_year": "Jr.", "height": "N/A", "weight": "N/A",
        "bt": "N/A", "high_school": "N/A", "hometown": "N/A",
    }


def test_modern_coaches(cards):
    assert [(r["name"], r["title"]) for r in rows(extract.roster_coaches(cards), "modern")] == [("C One", "Head COACH")]


def test_one_bad_card_rejects_a_modern_page(cards):
    assert rows(extract.roster_players(cards), "modern-bad") == []
    assert rows(extract.roster_coaches(cards), "modern-bad") == []
    assert len(rows(extract.rejected_cards(cards), "modern-bad")) == 3


def test_classic_cards(cards):
    players = rows(extract.roster_players(cards), "classic")
    assert [(p["name"], p["height"], p["weight"], p["high_school"], p["jersey"]) for p in players] == [
        ("JohnDoe", "71", "190", "Elm", "N/A"), ("N/A", "72", "N/A", "N/A", "N/A"),
    ]
    assert [(r["name"], r["title"]) for r in rows(extract.roster_coaches(cards), "classic")] == [
        ("K Coach", "Pitching Coach"), ("N/A", "Head Coach"),
    ]
    assert [r["fields"][0] for r in rows(extract.rejected_cards(cards), "classic")] == ["No Height"]


def test_other_pages_give_no_rows(cards):
    assert [p["name"] for p in rows(extract.roster_players(cards), "both")] == ["Seen"]
    assert cards.filter("page in ('unknown', 'comment')").count() == 0


def test_unclosed_and_void_elements():
    from squadweave.functions.markup import Field, Select, parse

    page = parse("<div><p>a<br><img src=x>b<p>c<script>var t='</p>'</script></div><h3/>d</i>")
    assert Field((Select("div"),)).text_in(page) == "abc"
    assert Field((Select("p"),), nth=1).text_in(page) == "c"
    assert Field((Select("p"),), nth=2).text_in(page) is None
    assert Field((Select("h3"),)).text_in(page) == ""


def test_only_the_first_hidden_element_is_left_out():
    from squadweave.functions.markup import Field, Select, parse

    page = parse("<p><i>x</i>a<i>y</i></p>")
    assert Field((Select("p"),), without=Select("i")).text_in(page) == "ay"


def test_quarantine_by_record_and_by_page(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", True), (2, "c", False)], "page int, name string, bad boolean")
    kept, out = extract.quarantine(df, F.col("bad"))
    assert {r.name for r in kept.collect()} == {"a", "c"} and {r.name for r in out.collect()} == {"b"}
    kept, out = extract.quarantine(df, F.col("bad"), "page", ["page"])
    assert {r.name for r in kept.collect()} == {"c"} and {r.name for r in out.collect()} == {"a", "b"}


def test_extraction_needs_no_shuffle(cards, spark):
    pages = spark.createDataFrame(list(PAGES.items()), "page string, html string")
    plan = extract.roster_players(extract.roster_cards(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1


def test_a_page_that_cannot_be_parsed_costs_one_row(spark):
    pages = spark.createDataFrame(
        [(1, f"<html><![foo[x]]>{modern_coach('Kay', 'Head Coach')}</html>"), (2, f"<html>{modern_coach('Lee', 'Head Coach')}</html>")],
        "page_no int, html string",
    )
    found = extract.roster_cards(pages).collect()
    assert [(r.page_no, r.kind) for r in found if r.error is None] == [(2, "coach")]
    (bad,) = [r for r in found if r.error is not None]
    assert (bad.page_no, bad.kind) == (1, None) and "cannot be parsed" in bad.error
    cards = extract.roster_cards(pages)
    assert extract.rejected_cards(cards).count() == 1 and extract.roster_coaches(cards).count() == 1
    assert {r.page_no: r.layout for r in extract.detect_layout(pages).collect()} == {1: "unknown", 2: "modern"}


def test_stray_end_tags_take_linear_time():
    start = time.perf_counter()
    parse("<p>" * 20_000 + "</b>" * 20_000)
    assert time.perf_counter() - start < 3


def test_customers_of_one_file_are_parsed_by_many_tasks(spark, tmp_path):
    from squadweave import session
    from squadweave.plans import queries

    session.tune(spark)
    rows = spark.range(30000).selectExpr("id AS c_custkey", "md5(string(id)) AS c_name", "'BUILDING' AS c_mktsegment")
    rows.coalesce(1).write.parquet(str(tmp_path / "customer"))
    pages = queries._card_pages(lambda name: spark.read.parquet(str(tmp_path / name)))
    tasks = pages.groupBy(F.spark_partition_id().alias("task")).agg(F.count("html").alias("n"), F.max(F.length("html"))).collect()
    assert sum(row["n"] for row in tasks) == 30000 and len(tasks) > 1
