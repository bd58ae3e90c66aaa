import pytest
from pyspark.sql import functions as F

from squadweave.functions import codes, roles, text
from squadweave.functions.fixed_values import CLASS_YEARS


def each(spark, values, column):
    """``column`` of every value, in order. Values are strings or null."""
    rows = spark.createDataFrame([(at, v) for at, v in enumerate(values)], "at int, v string")
    return [r[0] for r in rows.select("at", column.alias("out")).orderBy("at").select("out").collect()]


def v():
    return F.col("v")


def test_position_codes(spark):
    values = ["INF/RHP", "INF/IF", "C, OF", "XX", None, "P", "CF", " UTIL |1B", "//", "Catcher/Infield"]
    assert each(spark, values, codes.split_codes(v())) == [
        ["Infielder", "Right-Handed Pitcher"], ["Infielder", "Infielder"], ["Catcher", "Outfielder"], [], [],
        ["Pitcher"], ["Center Field"], ["Utility", "First Base"], [], ["Catcher", "Infielder"],
    ]


def test_position_codes_that_keep_unknown_parts(spark):
    found = each(spark, ["OF/XX/ C", "", None], codes.split_codes(v(), unmapped="null", trim=False))
    assert found == [["Outfielder", None, None], [], []]


def test_class_years(spark):
    values = ["R-So.", " Fr. ", "Mystery", " Odd ", None]
    assert each(spark, values, codes.map_codes(v(), CLASS_YEARS)) == ["Redshirt Sophomore", "Freshman", "Mystery", " Odd ", None]
    assert each(spark, values, codes.map_codes(v(), CLASS_YEARS, miss="null", trim=False)) == ["Redshirt Sophomore", None, None, None, None]


def test_batting_and_throwing(spark):
    values = ["R-R", "l/r", "B/R", "S", "Year", "Right/Right", "/R", None, "N/A", " r/l ", "R / L"]
    batting, throwing = codes.split_pair(v())
    assert list(zip(each(spark, values, batting), each(spark, values, throwing))) == [
        ("Right", "Right"), ("Left", "Right"), ("Switch", "Right"), ("Switch", None), (None, None), (None, None),
        ("Right", None), (None, None), (None, None), ("Right", "Left"), (None, None),
    ]
    assert each(spark, ["Fr. Year", None, "R/R"], text.null_or_invalid_to_na(v(), "Year")) == ["N/A", "N/A", "R/R"]


def test_hometowns(spark):
    cases = {
        "tampa, Fla.": "Tampa, FL", "o'fallon, mo.": "O'Fallon, MO", "Toronto, Ontario, Canada": "Toronto, Canada",
        "Miami": "Miami", None: "Unknown", "washington, district of columbia": "Washington, district of columbia",
        "Hilo, Hawai'i": "Hilo, HI", "hilo, hawai'i": "Hilo, hawai'i", "Tampa, FL": "Tampa, FL", " san  jose ": "San  Jose",
        "Austin,texas": "Austin, TX", "Austin,": "Austin, ", "": "",
    }
    assert each(spark, list(cases), text.standardize_place(v())) == list(cases.values())


@pytest.mark.parametrize("value", ["o'fallon", "winston-salem", "d.c.", "3rd", "MIAMI", "são paulo", "st. john's", "", "x1y"])
def test_title_case_is_python_title_case(spark, value):
    assert each(spark, [value], text.title_case(v())) == [value.title()]


def test_normalized_names(spark):
    values = ["  St. John's  (Prep) ", "Oñate_High", " n/a ", None, "!!", "A  B"]
    assert each(spark, values, text.normalize_name(v())) == ["st johns prep", "oñate_high", None, None, "", "a b"]


def test_numbers(spark):
    assert each(spark, ["N/A", "12.0", "12", "x", None, "1e400", " 7 "], text.safe_int(v())) == [None, 12, 12, None, None, None, 7]


def test_heights(spark):
    values = ["6'2\"", "5'11", " 6 ' 0 \"", "6'10 1/2\"", "6-2", "tall", "N/A", None, "6'", "6'2\"'x"]
    assert each(spark, values, text.height_inches(v())) == [74, 71, 72, None, None, None, None, None, None, 74]


def test_small_texts(spark):
    assert each(spark, ["185 lbs", "N/A", "", None], text.first_token(v())) == ["185", "N/A", "", None]
    assert each(spark, [" a/b/ ", None], text.strip_char(v(), "/")) == ["ab", None]
    assert each(spark, ["b a  c", " z "], text.sort_tokens(v())) == ["a b c", "z"]
    assert each(spark, ["N/A", "", "nan", "x", None], text.na_to_null(v())) == [None, None, None, "x", None]
    assert each(spark, ["\t a b　\n"], text.strip(v())) == ["a b"]


def test_lists(spark):
    rows = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "a array<string>")
    assert codes.longest(rows, "a") == 2
    wide = rows.select(*codes.widen(F.col("a"), 3))
    assert wide.columns == ["position1", "position2", "position3"]
    assert [tuple(r) for r in wide.collect()] == [("a", "b", None), (None, None, None), (None, None, None)]
    back = wide.select(codes.compact(*map(F.col, wide.columns)).alias("a")).collect()
    assert [r.a for r in back] == [["a", "b"], [], []]
    assert each(spark, ["x"], codes.compact(v(), F.lit(""), F.lit(None))) == [["x"]]
    items = F.split(v(), "-")
    named = codes.positional_fields(items, ["p", "q"], "N/A")
    assert [each(spark, ["1-2", "1", None], col) for col in named] == [["1", "1", "N/A"], ["2", "N/A", "N/A"]]


ROLE_CASES = {
    "Head Coach": ["Head Coach"],
    "Associate Head Coach": ["Head Coach"],
    "Undergraduate Assistant Coach": ["Assistant Coach"],
    "Student Assistant Coach": ["Assistant Coach"],
    "Student Coach": ["Student Assistant Coach"],
    "Associate Strength & Conditioning Coach": ["Assistant Coach"],
    "Associate Strength and Conditioning Coach (Baseball)": ["Strength & Conditioning Coach"],
    "Special Assistant to the Head Coach": ["Head Coach"],
    "Head Baseball Coach": ["Assistant Coach"],
    "Hitting Coach & Recruiting Coordinator": ["Hitting Coach", "Recruiting Coordinator"],
    "Assistant Coach - Recruiting Coordinator": ["Assistant Coach", "Recruiting Coordinator"],
    "Volunteer Coach (Pitching)": ["Volunteer Coach"],
    "Athletic Performance Coach": ["Assistant Coach"],
    "Head Coach/Pitching Coach": ["Head Coach", "Pitching Coach"],
    "Head Coach | Recruiting Coordinator": ["Head Coach", "Recruiting Coordinator"],
    "Pitching Coach / Head Coach": ["Pitching Coach", "Head Coach"],
    "PITCHING  COACH": ["Pitching Coach"],
    "": ["Assistant Coach"],
    None: None,
}


def test_roles_of_titles(spark):
    assert each(spark, list(ROLE_CASES), roles.extract_roles(v())) == list(ROLE_CASES.values())


def test_roles_by_longest_match(spark):
    values = ["Associate Head Coach", "Student Assistant Coach", "Head Coach / Assistant Coach"]
    assert each(spark, values, roles.extract_roles(v(), longest_match=True)) == [
        ["Associate Head Coach"], ["Student Assistant Coach"], ["Head Coach"],
    ]


CLEAN_CASES = [
    (["Associate Head Coach", "Assistant Coach", "Student Assistant Coach"], ["Associate Head Coach", "Student Assistant Coach"]),
    (["Head Coach", "Associate Head Coach", "Assistant Coach", "Student Assistant Coach"], ["Head Coach", "Student Assistant Coach"]),
    (["Assistant Coach", "Student Assistant Coach"], ["Assistant Coach"]),
    (["Pitching", "Hitting"], ["Pitching Coach", "Hitting Coach"]),
    (["Pitching", "Pitching Coach"], ["Pitching Coach"]),
    (["Outfield", "Outfield Coach"], ["Outfield Coach", "Outfield Coach"]),
    (["Infield", "Infield Coach"], ["Infield", "Infield Coach"]),
    (["Infield"], ["Infield Coach"]),
    (["Strength", "Conditioning"], ["Strength & Conditioning Coach"]),
    (["Conditioning"], ["Conditioning"]),
    (["Strength & Conditioning Coach", "Strength", "Conditioning"], ["Strength & Conditioning Coach"]),
    (["Recruiting", "Recruiting Coordinator"], ["Recruiting Coordinator"]),
    ([], []),
]


def test_clean_roles(spark):
    rows = spark.createDataFrame([(at, given) for at, (given, _) in enumerate(CLEAN_CASES)], "at int, r array<string>")
    got = [r.out for r in rows.select("at", roles.clean_roles(F.col("r")).alias("out")).orderBy("at").collect()]
    assert got == [expected for _, expected in CLEAN_CASES]
