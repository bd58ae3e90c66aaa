"""Fixed values of the roster domain: codes, names, keywords and markup markers.

They are facts about the data, stated as they are. Results depend on the exact
spelling of every entry, and on the order of ``ROLE_KEYWORDS``.
"""

# Texts that stand for a missing value in a delimited file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# What extraction writes for a field that a page does not give.
MISSING = "N/A"

# Roster position code -> position.
POSITIONS = {
    "OF": "Outfielder",
    "INF": "Infielder",
    "IF": "Infielder",
    "Inf.": "Infielder",
    "C": "Catcher",
    "RHP": "Right-Handed Pitcher",
    "LHP": "Left-Handed Pitcher",
    "P": "Pitcher",
    "UTIL": "Utility",
    "UTL": "Utility",
    "UT": "Utility",
    "1B": "First Base",
    "2B": "Second Base",
    "3B": "Third Base",
    "SS": "Shortstop",
    "CF": "Center Field",
    "DH": "Designated Hitter",
    "Infield": "Infielder",
    "Outfield": "Outfielder",
    "Catcher": "Catcher",
}

# Class year code -> class year.
CLASS_YEARS = {
    "Jr.": "Junior",
    "Sr.": "Senior",
    "Sr.+": "Senior",
    "So.": "Sophomore",
    "R-Fr.": "Redshirt Freshman",
    "Fr.": "Freshman",
    "R-Jr.": "Redshirt Junior",
    "R-So.": "Redshirt Sophomore",
    "Gr.": "Graduate",
    "Gr.+": "Graduate",
    "R-Sr.": "Redshirt Senior",
    "5th": "Fifth Year",
}

# Side letter -> side.
SIDES = {"L": "Left", "R": "Right", "S": "Switch", "B": "Switch"}

# Keyword in a staff title -> role, in the order in which roles are listed.
ROLE_KEYWORDS = (
    ("head coach", "Head Coach"),
    ("associate head coach", "Associate Head Coach"),
    ("assistant coach", "Assistant Coach"),
    ("pitching coach", "Pitching Coach"),
    ("hitting coach", "Hitting Coach"),
    ("recruiting coordinator", "Recruiting Coordinator"),
    ("strength and conditioning coach", "Strength & Conditioning Coach"),
    ("strength coach", "Strength & Conditioning Coach"),
    ("volunteer coach", "Volunteer Coach"),
    ("student assistant coach", "Student Assistant Coach"),
    ("student coach", "Student Assistant Coach"),
    ("undergraduate assistant coach", "Student Assistant Coach"),
    ("special assistant", "Assistant Coach"),
)
DEFAULT_ROLE = "Assistant Coach"

# Region spelling -> region code.
REGIONS = {
    "Alabama": "AL", "Ala.": "AL", "Ala": "AL",
    "Alaska": "AK", "Alas.": "AK",
    "Arizona": "AZ", "Ariz.": "AZ", "Ariz": "AZ",
    "Arkansas": "AR", "Ark.": "AR",
    "California": "CA", "Calif.": "CA", "Calif": "CA", "Cal.": "CA", "Calilf.": "CA",
    "Colorado": "CO", "Colo.": "CO",
    "Connecticut": "CT", "Conn.": "CT",
    "Delaware": "DE", "Del.": "DE",
    "Florida": "FL", "Fla.": "FL", "Fla": "FL",
    "Georgia": "GA", "Ga.": "GA",
    "Hawaii": "HI", "Hawai'i": "HI",
    "Idaho": "ID",
    "Illinois": "IL", "Ill.": "IL",
    "Indiana": "IN", "Ind.": "IN",
    "Iowa": "IA",
    "Kansas": "KS", "Kan.": "KS",
    "Kentucky": "KY", "Ky.": "KY",
    "Louisiana": "LA", "La.": "LA",
    "Maine": "ME",
    "Maryland": "MD", "Md.": "MD",
    "Massachusetts": "MA", "Mass.": "MA",
    "Michigan": "MI", "Mich.": "MI",
    "Minnesota": "MN", "Minn.": "MN",
    "Mississippi": "MS", "Miss.": "MS",
    "Missouri": "MO", "Mo.": "MO",
    "Montana": "MT", "Mont.": "MT",
    "Nebraska": "NE", "Neb.": "NE",
    "Nevada": "NV", "Nev.": "NV",
    "New Hampshire": "NH", "N.H.": "NH",
    "New Jersey": "NJ", "N.J.": "NJ",
    "New Mexico": "NM", "N.M.": "NM",
    "New York": "NY", "N.Y.": "NY",
    "North Carolina": "NC", "N.C.": "NC",
    "North Dakota": "ND", "N.D.": "ND",
    "Ohio": "OH",
    "Oklahoma": "OK", "Okla.": "OK",
    "Oregon": "OR", "Ore.": "OR",
    "Pennsylvania": "PA", "Pa.": "PA", "Penn.": "PA",
    "Rhode Island": "RI", "R.I.": "RI",
    "South Carolina": "SC", "S.C.": "SC",
    "South Dakota": "SD", "S.D.": "SD",
    "Tennessee": "TN", "Tenn.": "TN",
    "Texas": "TX", "Tex.": "TX",
    "Utah": "UT",
    "Vermont": "VT", "Vt.": "VT",
    "Virginia": "VA", "Va.": "VA",
    "Washington": "WA", "Wash.": "WA",
    "West Virginia": "WV", "W.Va.": "WV",
    "Wisconsin": "WI", "Wis.": "WI", "Wisc.": "WI",
    "Wyoming": "WY", "Wyo.": "WY",
    "District of Columbia": "DC", "D.C.": "DC",
    "Puerto Rico": "PR", "P.R.": "PR",
    "Ontario": "ON",
    "British Columbia": "BC", "B.C.": "BC",
    "Alberta": "AB",
    "Quebec": "QC",
}
