"""Every operator as a query on the driver tables, each with the SQL it must agree with.

Customers stand in for players, nations and order priorities for teams,
regions for conferences, parts for schools and order years for seasons.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadweave.functions import codes, roles, text
from squadweave.functions.fixed_values import NA_TOKENS
from squadweave.functions.markup import Card, Field, Layout, Select
from squadweave.operators import extract, graph, paths, quality, resolve
from squadweave.operators.paths import Hop
from squadweave.session import literal_table, tune
from squadweave.sources import tables

Tables = Callable[[str], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _run(build: Callable[[Tables], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = partial(_run, build)
        if sql is not None:
            ORACLE[build.__name__] = sql.strip()
        return build

    return register


def literal(df: DataFrame, name: str, values: list) -> DataFrame:
    return literal_table(df.sparkSession, {name: values})


# ---- Scans, batches, dimensions ----


@query("SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders")
def scan_na_tokens(t: Tables) -> DataFrame:
    rows = t("orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return tables.null_tokens(rows, (*NA_TOKENS, "5-LOW"))


@query("""
SELECT DISTINCT trim(replace(v, '/', '')) AS name
FROM (SELECT CASE WHEN p_size = 1 THEN 'N/A' ELSE ' ' || p_name || '/ ' || p_partkey END AS v FROM part)
WHERE v <> 'N/A'
""")
def derive_dimension(t: Tables) -> DataFrame:
    named = t("part").select(
        F.when(F.col("p_size") == 1, "N/A")
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit("/ "), F.col("p_partkey").cast("string")))
        .alias("v")
    )
    return tables.derive_dimension(named, "v")


@query("SELECT DISTINCT o_custkey FROM orders")
def distinct_values(t: Tables) -> DataFrame:
    return tables.distinct_values(t("orders"), "o_custkey")


@query("""
SELECT CAST(CASE WHEN year(o_orderdate) >= 1998 THEN 0 ELSE 1 END AS INTEGER) AS batch_no,
       o_orderkey, o_custkey
FROM orders
""")
def union_seasons(t: Tables) -> DataFrame:
    orders = t("orders")
    newer, older = (orders.filter(F.year("o_orderdate") >= 1998), orders.filter(F.year("o_orderdate") < 1998))
    columns = ["o_orderkey", "o_custkey"]
    return tables.union_batches([newer.select(columns), older.select(columns)])


# ---- Extraction ----

def _pages(t: Tables) -> DataFrame:
    return t("pages").select("page_id", "html")


_PAGE = Select("html")
_PAGE_LAYOUT = Layout(
    "page",
    _PAGE,
    (
        Card("page", _PAGE, (Field((Select("title"),)), Field((Select("article"), Select("h1"))))),
        Card("link", Select("a"), ()),
    ),
)


@query("""
SELECT page_id,
       trim(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&')) AS title,
       trim(replace(regexp_extract(html, '<article><h1>([^<]*)</h1>', 1), '&amp;', '&')) AS heading,
       CAST(len(regexp_extract_all(html, '<a ')) AS INTEGER) AS links
FROM pages
""")
def extract_page_fields(t: Tables) -> DataFrame:
    parsed = extract.parse_pages(_pages(t), (_PAGE_LAYOUT,))
    of_kind = lambda kind: F.filter("cards", lambda card: card["kind"] == kind)
    fields = F.get(of_kind("page"), F.lit(0))["fields"]
    return parsed.select(
        "page_id",
        *codes.positional_fields(fields, ["title", "heading"], ""),
        F.size(of_kind("link")).alias("links"),
    )


@query("""
SELECT page_id, CASE WHEN contains(html, '<b>') THEN 'bold' WHEN contains(html, '<article>') THEN 'plain' ELSE 'unknown' END AS layout
FROM pages
""")
def detect_layout(t: Tables) -> DataFrame:
    layouts = (Layout("bold", Select("b")), Layout("plain", Select("article")))
    return extract.detect_layout(_pages(t), layouts)


def _card_pages(t: Tables) -> DataFrame:
    """One roster page per customer, of either design, with a player and a coach; some pages cannot be parsed."""
    # A row becomes a whole page, so few and small files make much work, which only spread rows share among tasks.
    customer = t("customer").select("c_custkey", "c_name", "c_mktsegment").hint("repartition")
    key = F.col("c_custkey")
    height = F.when(key % 10 == 3, "tall").otherwise(
        F.concat((key % 3 + 5).cast("string"), F.lit("'"), (key % 12).cast("string"), F.lit('"'))
    )
    title = F.when(key % 3 == 0, "Head Coach").when(key % 3 == 1, "Trainer").otherwise("Pitching COACH")
    read_out = "<span class='sr-only'>said</span>"
    item = lambda content: F.concat(
        F.lit(f"<span class='s-person-details__bio-stats-item'>{read_out}"), content, F.lit("</span>")
    )
    modern = F.concat(
        F.lit("<html><body><div class='box s-person-card__content'><h3> "), "c_name",
        F.lit("</h3><div class='s-person-details__bio-stats'>"),
        item(F.col("c_mktsegment")), item(F.lit("Jr.")), item(height), item(F.lit("185 lbs")),
        F.lit("</div></div><div class='s-person-card__content'><h3>Coach "), "c_name",
        F.lit("</h3><div class='s-person-details__position'><div>"), title,
        F.lit("</div></div></div></body></html>"),
    )
    part = lambda name, content: F.concat(F.lit(f"<span class='sidearm-roster-player-{name}'>"), content, F.lit("</span>"))
    classic = F.concat(
        F.lit("<ul><li class='sidearm-roster-player'><h3>"), "c_name", F.lit("</h3>"),
        part("position-long-short", F.col("c_mktsegment")), part("height", height), part("weight", F.lit("185 lbs")),
        F.lit("</li></ul><ul><li class='sidearm-roster-coach'><p>Coach "), "c_name",
        F.lit("</p><div class='sidearm-roster-coach-title'>"), title, F.lit("</div></li></ul>"),
    )
    html = F.when(key % 2 == 0, modern).otherwise(classic)
    # A marked section that no parser knows makes a page unreadable.
    return customer.select("c_custkey", F.when(key % 17 == 5, F.concat(F.lit("<![foo[x]]>"), html)).otherwise(html).alias("html"))


@query("""
WITH c AS (SELECT *, c_custkey % 10 = 3 AS tall, c_custkey % 2 = 0 AS modern FROM customer WHERE c_custkey % 17 <> 5)
SELECT c_custkey, 'player' AS kind, c_name AS name, c_mktsegment AS detail,
       CAST((c_custkey % 3 + 5) * 12 + c_custkey % 12 AS VARCHAR) AS height
FROM c WHERE NOT tall
UNION ALL
SELECT c_custkey, 'coach', 'Coach ' || c_name, CASE c_custkey % 3 WHEN 0 THEN 'Head Coach' ELSE 'Pitching COACH' END, NULL
FROM c WHERE NOT (tall AND modern) AND c_custkey % 3 <> 1
""")
def extract_roster_cards(t: Tables) -> DataFrame:
    cards = extract.roster_cards(_card_pages(t))
    # Both kinds come from one pass over the pages.
    player = F.col("kind") == "player"
    field = lambda at: F.get("fields", F.lit(at))
    kept = cards.filter(F.col("error").isNull() & (player | F.contains(F.lower(field(1)), F.lit("coach"))))
    height = extract.height_inches(field(extract.PLAYER_FIELDS.index("height"))).cast("string")
    return kept.select(
        "c_custkey", "kind", field(0).alias("name"),
        F.when(player, field(extract.PLAYER_FIELDS.index("position"))).otherwise(field(1)).alias("detail"),
        F.when(player, height).alias("height"),
    )


@query("""
SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'player' ELSE 'coach' END AS kind FROM conversations
""")
def route_records(t: Tables) -> DataFrame:
    rows = t("conversations").select("conv_id", "turn", "role")
    return extract.route_records(rows, F.col("role") == "assistant").drop("role")


@query("""
SELECT conv_id, turn, role FROM conversations
WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system')
""")
def quarantine_policy(t: Tables) -> DataFrame:
    rows = t("conversations").select("conv_id", "turn", "role")
    kept, _ = extract.quarantine(rows, F.col("role") == "system", "page", ["conv_id"])
    return kept


@query("""
SELECT p_partkey, split_part(p_name, ' ', 1) AS color, split_part(p_name, ' ', 2) AS noun, 'N/A' AS finish FROM part
""")
def positional_fields(t: Tables) -> DataFrame:
    items = F.split("p_name", " ")
    return t("part").select("p_partkey", *codes.positional_fields(items, ["color", "noun", "finish"], "N/A"))


@query("SELECT p_partkey, split_part(p_name, ' ', 1) AS token FROM part")
def first_token(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", text.first_token(F.col("p_name")).alias("token"))


@query("""
SELECT p_partkey, CAST(CASE WHEN p_size % 7 <> 0 THEN p_size * 12 + p_partkey % 12 END AS INTEGER) AS height FROM part
""")
def parse_height(t: Tables) -> DataFrame:
    written = F.concat(F.col("p_size").cast("string"), F.lit("'"), (F.col("p_partkey") % 12).cast("string"), F.lit('"'))
    shown = F.when(F.col("p_size") % 7 == 0, "tall").otherwise(written)
    return t("part").select("p_partkey", text.height_inches(shown).alias("height"))


@query("SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%econom%'")
def filter_contains(t: Tables) -> DataFrame:
    return extract.filter_contains(t("part").select("p_partkey", "p_type"), "p_type", "Econom")


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_name <> 'N/A' AND c_acctbal IS NOT NULL
""")
def filter_predicates(t: Tables) -> DataFrame:
    kept = extract.keep(
        t("customer"), F.col("c_mktsegment") == "BUILDING", F.col("c_name") != "N/A", F.col("c_acctbal").isNotNull()
    )
    return kept.select("c_custkey", "c_name")


# ---- Scalars ----

_SEGMENTS = {"BUILDING": "Construction", "FURNITURE": "Home", "MACHINERY": "Industry"}


@query("""
SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'FURNITURE' THEN 'Home'
            WHEN 'MACHINERY' THEN 'Industry' ELSE ' ' || c_mktsegment END AS segment
FROM customer
""")
def map_codes_keep(t: Tables) -> DataFrame:
    untrimmed = F.concat(F.lit(" "), "c_mktsegment")
    return t("customer").select("c_custkey", codes.map_codes(untrimmed, _SEGMENTS).alias("segment"))


@query("""
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' END AS flag
FROM lineitem
""")
def map_codes_null(t: Tables) -> DataFrame:
    flag = codes.map_codes(F.col("l_returnflag"), {"R": "Returned", "A": "Accepted"}, miss="null")
    return t("lineitem").select("l_orderkey", "l_linenumber", flag.alias("flag"))


_ORDER_CODES = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "F": "Filled", "P": "Pending", "U": "Urgent"}
_ORDER_CODE_LIST = "concat(o_orderstatus, ' / ', o_orderpriority, ',', substr(o_orderpriority, 3, 1))"
_ORDER_CODE_CASE = """
CASE x WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
       WHEN 'F' THEN 'Filled' WHEN 'P' THEN 'Pending' WHEN 'U' THEN 'Urgent' END"""


@query(f"""
SELECT o_orderkey,
       coalesce(array_to_string(list_filter(list_transform(
         [o_orderstatus, o_orderpriority, substr(o_orderpriority, 3, 1)], lambda x: {_ORDER_CODE_CASE}),
         lambda v: v IS NOT NULL), '+'), '') AS codes
FROM orders
""")
def split_codes(t: Tables) -> DataFrame:
    found = codes.split_codes(F.expr(_ORDER_CODE_LIST), _ORDER_CODES)
    return t("orders").select("o_orderkey", F.array_join(found, "+").alias("codes"))


@query("""
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'R' THEN 'Right' WHEN 'A' THEN NULL WHEN 'N' THEN NULL END AS batting,
       CASE l_linestatus WHEN 'F' THEN 'Left' END AS throwing
FROM lineitem
""")
def split_pair(t: Tables) -> DataFrame:
    pair = F.concat(F.lit("/"), F.lower("l_returnflag"), F.lit("-"), "l_linestatus")
    batting, throwing = codes.split_pair(pair, {"R": "Right", "F": "Left"})
    return t("lineitem").select("l_orderkey", "l_linenumber", batting.alias("batting"), throwing.alias("throwing"))


@query("""
WITH w AS (SELECT o_orderkey, string_split(regexp_replace(o_orderpriority, '^[0-9]-', ''), ' ') AS words FROM orders)
SELECT o_orderkey, words[1] AS word1, words[2] AS word2 FROM w
""")
def widen_array(t: Tables) -> DataFrame:
    words = F.split(F.regexp_replace("o_orderpriority", "^[0-9]-", ""), " ")
    listed = t("orders").select("o_orderkey", words.alias("words"))
    return listed.select("o_orderkey", *codes.widen(F.col("words"), codes.longest(listed, "words"), "word"))


@query("""
SELECT l_orderkey, l_linenumber,
       concat_ws('+', nullif(l_returnflag, 'N'), nullif(l_linestatus, 'O')) AS codes
FROM lineitem
""")
def compact_array(t: Tables) -> DataFrame:
    flag = F.nullif("l_returnflag", F.lit("N"))
    status = F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("l_linestatus"))
    kept = codes.compact(flag, status)
    return t("lineitem").select("l_orderkey", "l_linenumber", F.array_join(kept, "+").alias("codes"))


@query("""
SELECT c_custkey,
       CASE WHEN c_custkey % 11 = 0 THEN 'Unknown' ELSE
         upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) ||
         CASE c_nationkey % 6 WHEN 0 THEN ', FL' WHEN 1 THEN ', TX' WHEN 2 THEN ', Canada'
              WHEN 3 THEN ', MO' WHEN 4 THEN ', nowhere' ELSE '' END END AS hometown
FROM customer
""")
def standardize_place(t: Tables) -> DataFrame:
    region = (
        F.when(F.col("c_nationkey") % 6 == 0, ",Fla. ").when(F.col("c_nationkey") % 6 == 1, ", texas")
        .when(F.col("c_nationkey") % 6 == 2, ", Ontario, Canada").when(F.col("c_nationkey") % 6 == 3, ", mo.")
        .when(F.col("c_nationkey") % 6 == 4, ", nowhere").otherwise("")
    )
    place = F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit(" "), F.lower("c_mktsegment"), region))
    return t("customer").select("c_custkey", text.standardize_place(place).alias("hometown"))


@query("""
WITH s AS (SELECT p_partkey, p_name || ' o''' || p_type || '-' || p_size || 'rd' AS v FROM part)
SELECT p_partkey, list_reduce(list_transform(range(1, CAST(len(v) AS BIGINT) + 1), lambda i:
         CASE WHEN i > 1 AND regexp_matches(v[i - 1], '[A-Za-z]') THEN lower(v[i]) ELSE upper(v[i]) END),
         lambda a, b: a || b) AS title
FROM s
""")
def title_case(t: Tables) -> DataFrame:
    written = F.concat("p_name", F.lit(" o'"), "p_type", F.lit("-"), F.col("p_size").cast("string"), F.lit("rd"))
    return t("part").select("p_partkey", text.title_case(written).alias("title"))


# A title is a phrase for the part's type, a separator and a phrase for its size.
_TITLE = """
concat(
  CASE p_type WHEN 'ECONOMY' THEN 'Head Coach' WHEN 'SMALL' THEN 'Associate Head Coach' WHEN 'LARGE' THEN 'Assistant Coach'
    WHEN 'PROMO' THEN 'Student Assistant Coach' WHEN 'MEDIUM' THEN 'Athletic Performance' ELSE 'Strength  and Conditioning Coach' END,
  CASE p_partkey % 4 WHEN 0 THEN '/' WHEN 1 THEN ' & ' WHEN 2 THEN ' - ' ELSE ', ' END,
  CASE p_size % 5 WHEN 0 THEN 'Pitching Coach (Volunteer Coach)' WHEN 1 THEN 'Recruiting Coordinator' WHEN 2 THEN 'STUDENT COACH'
    WHEN 3 THEN 'Strength & Conditioning Coach' ELSE 'Special Assistant' END)
"""
_KEYWORD_VALUES = """
(0, 'head coach', 'Head Coach'), (1, 'associate head coach', 'Associate Head Coach'),
(2, 'assistant coach', 'Assistant Coach'), (3, 'pitching coach', 'Pitching Coach'), (4, 'hitting coach', 'Hitting Coach'),
(5, 'recruiting coordinator', 'Recruiting Coordinator'),
(6, 'strength and conditioning coach', 'Strength & Conditioning Coach'),
(7, 'strength coach', 'Strength & Conditioning Coach'), (8, 'volunteer coach', 'Volunteer Coach'),
(9, 'student assistant coach', 'Student Assistant Coach'), (10, 'student coach', 'Student Assistant Coach'),
(11, 'undergraduate assistant coach', 'Student Assistant Coach'), (12, 'special assistant', 'Assistant Coach')
"""


@query(f"""
WITH kw(kn, k, role) AS (VALUES {_KEYWORD_VALUES}),
named AS (SELECT p_partkey, {_TITLE} AS title FROM part),
shape AS (SELECT DISTINCT title FROM named),
parts AS (
  SELECT title, unnest(ps) AS p, generate_subscripts(ps, 1) AS rn
  FROM (SELECT title, string_split(regexp_replace(regexp_replace(replace(lower(title), '&', '/'), '[(),]', ' ', 'g'),
                                                  '\\s+', ' ', 'g'), '/') AS ps FROM shape)),
hits AS (SELECT title, role, min(parts.rn * 100 + kn) AS pos FROM parts JOIN kw ON contains(p, k) GROUP BY ALL),
flags AS (SELECT title, bool_or(role = 'Head Coach') AS head, bool_or(role = 'Associate Head Coach') AS assoc,
                 bool_or(role = 'Assistant Coach') AS asst FROM hits GROUP BY title),
kept AS (
  SELECT h.title, string_agg(role, '+' ORDER BY pos) AS roles FROM hits h JOIN flags f USING (title)
  WHERE NOT (role = 'Associate Head Coach' AND head)
    AND NOT (role = 'Assistant Coach' AND (head OR assoc))
    AND NOT (role = 'Student Assistant Coach' AND asst AND NOT head AND NOT assoc)
  GROUP BY h.title)
SELECT p_partkey, coalesce(roles, 'Assistant Coach') AS roles FROM named LEFT JOIN kept USING (title)
""")
def extract_roles(t: Tables) -> DataFrame:
    found = roles.extract_roles(F.expr(_TITLE))
    return t("part").select("p_partkey", F.array_join(found, "+").alias("roles"))


@query("""
WITH r AS (
  SELECT p_partkey, p_type = 'SMALL' AS head, p_size % 2 = 0 AS assoc, p_partkey % 3 = 0 AS asst,
         p_size % 5 = 0 AS pitching, p_partkey % 2 = 0 AS strength FROM part)
SELECT p_partkey, concat_ws('+',
  CASE WHEN NOT head AND assoc THEN 'Associate Head Coach' END,
  CASE WHEN NOT head AND NOT assoc AND asst THEN 'Assistant Coach' END,
  CASE WHEN head OR assoc OR NOT asst THEN 'Student Assistant Coach' END,
  CASE WHEN head THEN 'Head Coach' END,
  CASE WHEN pitching THEN 'Pitching Coach' END,
  CASE WHEN strength THEN 'Strength & Conditioning Coach' END) AS roles
FROM r
""")
def clean_roles(t: Tables) -> DataFrame:
    there = lambda test, role: F.when(test, role)
    named = F.array_compact(
        F.array(
            there(F.col("p_size") % 2 == 0, "Associate Head Coach"),
            there(F.col("p_partkey") % 3 == 0, "Assistant Coach"),
            F.lit("Student Assistant Coach"),
            there(F.col("p_type") == "SMALL", "Head Coach"),
            there(F.col("p_size") % 5 == 0, "Pitching"),
            there(F.col("p_partkey") % 2 == 0, "Strength"),
            there(F.col("p_partkey") % 2 == 0, "Conditioning"),
            F.lit("Recruiting"),
        )
    )
    return t("part").select("p_partkey", F.array_join(roles.clean_roles(named), "+").alias("roles"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL ELSE lower(p_name) || ' ' || replace(lower(p_brand), '#', '') || ' jos' || chr(233) END AS name
FROM part
""")
def normalize_name(t: Tables) -> DataFrame:
    shown = F.when(F.col("p_size") % 9 == 0, " n/a ").otherwise(
        F.concat(F.lit(" "), F.upper("p_name"), F.lit(" -\t"), "p_brand", F.lit(". (JosÉ)"))
    )
    return t("part").select("p_partkey", text.normalize_name(shown).alias("name"))


@query("""
SELECT p_partkey, CAST(CASE WHEN p_partkey % 4 < 2 THEN p_size END AS INTEGER) AS size FROM part
""")
def safe_int(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 4
    shown = F.when(kind == 0, size).when(kind == 1, F.concat(size, F.lit(".0"))).when(kind == 2, F.concat(size, F.lit(" lbs"))).otherwise("N/A")
    return t("part").select("p_partkey", text.safe_int(shown).alias("size"))


# ---- Entity resolution ----

# "red ring 1" lies within "red ring 12": a true over-merge of short names.
_PART_NAME = "concat(p_name, ' ', p_partkey)"
_PART_MATCH = f"""
WITH p AS (SELECT {_PART_NAME} AS name, p_partkey AS seq FROM part),
m AS (SELECT a.name, arg_min(b.name, b.seq) AS canon FROM p a JOIN p b ON contains(a.name, b.name) OR contains(b.name, a.name) GROUP BY a.name)
"""


def _part_names(t: Tables) -> DataFrame:
    return t("part").select(F.expr(_PART_NAME).alias("name"), F.col("p_partkey").alias("seq"))


def _part_mapping(t: Tables) -> DataFrame:
    names = _part_names(t)
    return resolve.canonicalize(names, "name", names, "name", "seq")


@query(f"{_PART_MATCH} SELECT name, canon, CAST(100 AS DOUBLE) AS score FROM m")
def canonicalize_names(t: Tables) -> DataFrame:
    return _part_mapping(t)


@query(f"{_PART_MATCH} SELECT l_orderkey, l_linenumber, canon AS school FROM lineitem JOIN part ON l_partkey = p_partkey JOIN m ON m.name = {_PART_NAME}")
def apply_mapping(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(
        t("part").select("p_partkey", F.expr(_PART_NAME).alias("school")), F.col("l_partkey") == F.col("p_partkey")
    )
    return resolve.apply_mapping(rows, "school", _part_mapping(t)).select("l_orderkey", "l_linenumber", "school")


@query(f"{_PART_MATCH} SELECT name, canon FROM m WHERE name <> canon")
def mapping_diff(t: Tables) -> DataFrame:
    return resolve.mapping_diff(_part_mapping(t)).select("name", "canon")


@query("""
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority
FROM orders GROUP BY o_custkey
""")
def dedup_keep_first(t: Tables) -> DataFrame:
    rows = t("orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return resolve.dedup_keep_first(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""
SELECT count(DISTINCT p_name || ' ' || p_partkey) AS original, count(DISTINCT p_name || ' ' || p_brand) AS canonical,
       count(DISTINCT p_name || ' ' || p_partkey) - count(DISTINCT p_name || ' ' || p_brand) AS removed
FROM part
""")
def dedup_metrics(t: Tables) -> DataFrame:
    mapping = t("part").select(F.expr(_PART_NAME).alias("name"), F.concat_ws(" ", "p_name", "p_brand").alias("canon"))
    return resolve.dedup_metrics(mapping)


@query("""
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_keys(t: Tables) -> DataFrame:
    rows = t("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return quality.duplicate_keys(rows, ["o_custkey", "day"])


# Longest common subsequence row by row: the next row is the running maximum of
# what the row above and its diagonal allow.
_LCS = """
lcs AS (
  SELECT a, b, 0 AS i, list_transform(range(0, CAST(len(b) AS BIGINT) + 1), lambda j: CAST(0 AS BIGINT)) AS r FROM pairs
  UNION ALL
  SELECT a, b, i + 1, list_transform(range(1, CAST(len(b) AS BIGINT) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k:
      CASE WHEN k = 1 THEN 0 ELSE greatest(r[k], r[k - 1] + CASE WHEN a[i + 1] = b[k - 1] THEN 1 ELSE 0 END) END)))
  FROM lcs WHERE i < len(a)),
scored AS (SELECT a, b, round((1 - (len(a) + len(b) - 2 * r[len(b) + 1]) / (len(a) + len(b))) * 100, 6) AS score FROM lcs WHERE i = len(a))
"""


@query(f"""
WITH RECURSIVE names AS (SELECT DISTINCT p_name AS name FROM part),
pairs AS (SELECT x.name AS a, y.name AS b FROM names x, names y),
{_LCS}
SELECT a AS name, b AS canon, score FROM scored WHERE score >= 80
""")
def fuzzy_ratio_pairs(t: Tables) -> DataFrame:
    names = t("part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("seq"))
    found = resolve.fuzzy_pairs(names.select("name"), names.select(F.col("name").alias("canon"), "seq"), "ratio", 80.0)
    return found.select("name", "canon", F.round("score", 6).alias("score"))


@query(f"""
WITH RECURSIVE canon AS (
  SELECT p_name AS canon, min(p_partkey) AS seq, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS key FROM part GROUP BY p_name),
names AS (SELECT DISTINCT upper(split_part(p_name, ' ', 2)) || ', x' || split_part(p_name, ' ', 1) AS name FROM part),
keyed AS (SELECT name, array_to_string(list_sort(string_split(replace(lower(name), ',', ''), ' ')), ' ') AS key FROM names),
pairs AS (SELECT DISTINCT keyed.key AS a, canon.key AS b FROM keyed, canon),
{_LCS},
hits AS (SELECT name, canon, score, row_number() OVER (PARTITION BY name ORDER BY score DESC, seq) AS rn
         FROM keyed JOIN scored ON keyed.key = a JOIN canon ON canon.key = b WHERE score >= 80)
SELECT name, coalesce(canon, name) AS canon, score FROM names LEFT JOIN (SELECT name, canon, score FROM hits WHERE rn = 1) USING (name)
""")
def token_sort_match(t: Tables) -> DataFrame:
    part = t("part")
    names = part.select(
        F.concat(
            F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))), F.lit(", x"), F.split_part("p_name", F.lit(" "), F.lit(1))
        ).alias("name")
    )
    canon = part.select("p_name", "p_partkey")
    return resolve.token_sort_match(names, "name", canon, "p_name", "p_partkey").withColumn("score", F.round("score", 6))


# Windows of a text: its substrings of the needle's length, and its shorter beginnings and endings.
@query(f"""
WITH RECURSIVE canon AS (SELECT p_name AS canon, min(p_partkey) AS seq FROM part GROUP BY p_name),
names AS (SELECT DISTINCT translate(p_name, 'gl', 'qk') AS name FROM canon, part WHERE canon = p_name),
sides AS (
  SELECT name, canon, seq, name AS needle, canon AS text FROM names, canon WHERE len(name) <= len(canon)
  UNION ALL
  SELECT name, canon, seq, canon, name FROM names, canon WHERE len(canon) <= len(name)),
windows AS (
  SELECT name, canon, seq, needle AS a, text[s:s + len(needle) - 1] AS b FROM sides, unnest(range(1, len(text) + 1)) AS t(s)
  UNION
  SELECT name, canon, seq, needle, text[1:e] FROM sides, unnest(range(1, len(needle))) AS t(e)),
pairs AS (SELECT DISTINCT a, b FROM windows),
{_LCS},
hits AS (
  SELECT name, canon, max(score) AS score, row_number() OVER (PARTITION BY name ORDER BY max(score) DESC, seq) AS rn
  FROM windows JOIN scored USING (a, b) WHERE score >= 70 GROUP BY name, canon, seq)
SELECT name, coalesce(canon, name) AS canon, score FROM names LEFT JOIN (FROM hits WHERE rn = 1) USING (name)
""")
def canonicalize_fuzzy(t: Tables) -> DataFrame:
    """Part names with two letters mistyped, against the names as they are."""
    part = t("part").select("p_name", "p_partkey")
    typed = part.select(F.translate("p_name", "gl", "qk").alias("typed"))
    found = resolve.canonicalize(typed, "typed", part, "p_name", "p_partkey", cutoff=70.0)
    return found.select("name", "canon", F.round("score", 6).alias("score"))


# Names whose number grows with the tables: the first words of documents.
_BLANK, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _opening(words: int) -> tuple[str, list[int]]:
    """A pattern for the first words of a text, and the groups that hold them."""
    return f"^{_BLANK}*({_WORD}+)" + f"{_BLANK}+({_WORD}+)" * (words - 1), list(range(1, words + 1))


def _openings(t: Tables, words: int) -> DataFrame:
    pattern, groups = _opening(words)
    name = F.concat_ws(" ", *[F.regexp_extract("text", pattern, group) for group in groups])
    return t("documents").filter(F.rlike("text", F.lit(pattern))).groupBy(name.alias("name")).agg(F.min("doc_id").alias("seq"))


def _openings_sql(words: int) -> str:
    pattern, groups = _opening(words)
    name = " || ' ' || ".join(f"regexp_extract(text, '{pattern}', {group})" for group in groups)
    return f"SELECT {name} AS name, min(doc_id) AS seq FROM documents WHERE regexp_matches(text, '{pattern}') GROUP BY ALL"


# How many characters two names have in common in any order, for pairs that have some.
_COMMON = """
chars AS (SELECT side, name, c, row_number() OVER (PARTITION BY side, name, c) AS nth FROM sided, unnest(string_split(name, '')) AS t(c)),
met AS (SELECT x.name AS a, y.name AS b, count(*) AS n FROM chars AS x JOIN chars AS y USING (c, nth) WHERE x.side = 1 AND y.side = 2 GROUP BY ALL)
"""


@query(f"""
WITH RECURSIVE names AS ({_openings_sql(3)}),
sided AS (SELECT 1 AS side, name FROM names UNION ALL SELECT 2, name FROM names),
{_COMMON},
pairs AS (SELECT a, b FROM met WHERE 200 * n >= 80 * (len(a) + len(b))),
{_LCS}
SELECT a AS name, b AS canon, score FROM scored WHERE score >= 80
""")
def similar_openings(t: Tables) -> DataFrame:
    """Whole-string scores, through the segment index where its keys tell names apart."""
    names = _openings(t, 3)
    found = resolve.fuzzy_pairs(names.select("name"), names.select(F.col("name").alias("canon"), "seq"), "ratio", 80.0)
    return found.select("name", "canon", F.round("score", 6).alias("score"))


@query(f"""
WITH RECURSIVE canon AS ({_openings_sql(3)}),
names AS (SELECT DISTINCT name[1:3] || 'x' || name[4:] AS name FROM ({_openings_sql(2)})),
sided AS (SELECT 1 AS side, name FROM names UNION ALL SELECT 2, name FROM canon),
{_COMMON},
near AS (SELECT a AS name, b AS canon FROM met WHERE (200 - 85) * n >= 85 * least(len(a), len(b))),
sides AS (
  SELECT name, canon, name AS needle, canon AS text FROM near WHERE len(name) <= len(canon)
  UNION ALL
  SELECT name, canon, canon, name FROM near WHERE len(canon) <= len(name)),
windows AS (
  SELECT name, canon, needle AS a, text[s:s + len(needle) - 1] AS b FROM sides, unnest(range(1, len(text) + 1)) AS t(s)
  UNION
  SELECT name, canon, needle, text[1:e] FROM sides, unnest(range(1, len(needle))) AS t(e)),
pairs AS (SELECT DISTINCT a, b FROM windows),
{_LCS},
best AS (SELECT name, canon, max(score) AS score FROM windows JOIN scored USING (a, b) WHERE score >= 85 GROUP BY name, canon),
hits AS (
  SELECT best.name, canon, score, row_number() OVER (PARTITION BY best.name ORDER BY score DESC, seq) AS rn
  FROM best JOIN canon ON canon.name = best.canon)
SELECT name, coalesce(canon, name) AS canon, score FROM names LEFT JOIN (FROM hits WHERE rn = 1) USING (name)
""")
def canonicalize_openings(t: Tables) -> DataFrame:
    """Two words with a letter put in against three words, partially, through the inverted index where its keys tell names apart."""
    typed = _openings(t, 2).select(F.concat(F.substring("name", 1, 3), F.lit("x"), F.expr("substring(name, 4)")).alias("typed"))
    found = resolve.canonicalize(typed, "typed", _openings(t, 3), "name", "seq", cutoff=85.0)
    return found.select("name", "canon", F.round("score", 6).alias("score"))


@query(f"""
WITH shorts AS ({_openings_sql(2)}), longs AS ({_openings_sql(3)})
SELECT shorts.name AS short, longs.name AS long FROM shorts, longs WHERE contains(longs.name, shorts.name)
""")
def contained_openings(t: Tables) -> DataFrame:
    return resolve.contained_pairs(_openings(t, 2).select("name"), _openings(t, 3).select("name"))


@query("""
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS o_orderpriority FROM orders GROUP BY o_custkey
""")
def collapse_titles(t: Tables) -> DataFrame:
    return resolve.collapse(t("orders"), ["o_custkey"], "o_orderpriority")


# ---- Graph ----

_EVENT_PROPS = ["event_type", "value"]
_EVENT_SEQ = ["ts", "event_id"]


def _event_rows(t: Tables) -> DataFrame:
    """Events with every error's type as null, which a merge must keep."""
    return t("events").select("user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "value", *_EVENT_SEQ)


_LAST_EVENT = """
SELECT user_id, nullif(event_type, 'error') AS event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""


@query(_LAST_EVENT)
def merge_nodes(t: Tables) -> DataFrame:
    return graph.merge_nodes(_event_rows(t), ["user_id"], _EVENT_PROPS, _EVENT_SEQ)


@query(_LAST_EVENT)
def merge_idempotent(t: Tables) -> DataFrame:
    rows = _event_rows(t)
    later = F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")
    stored = graph.merge_nodes(rows.filter(~later), ["user_id"], _EVENT_PROPS, _EVENT_SEQ)
    once = graph.merge_idempotent(stored, rows.filter(later), ["user_id"], _EVENT_PROPS, _EVENT_SEQ)
    return graph.merge_idempotent(once, rows.filter(later), ["user_id"], _EVENT_PROPS, _EVENT_SEQ)


@query("""
SELECT nullif(o_custkey, 7) AS o_custkey, o_orderdate, count(*) AS n,
       CASE WHEN nullif(o_custkey, 7) IS NULL THEN 'null key' ELSE 'duplicate' END AS problem
FROM orders GROUP BY ALL HAVING count(*) > 1 OR nullif(o_custkey, 7) IS NULL
""")
def assert_unique(t: Tables) -> DataFrame:
    rows = t("orders").select(F.nullif("o_custkey", F.lit(7)).alias("o_custkey"), "o_orderdate")
    return quality.assert_unique(rows, ["o_custkey", "o_orderdate"])


def _order_rows(t: Tables) -> DataFrame:
    return t("orders").select(
        "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("season"), "o_totalprice", "o_orderstatus",
        "o_orderdate", "o_orderkey",
    )


_ORDER_SEQ = ["o_orderdate", "o_orderkey"]
_LAST_ORDER = """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS season,
       row_number() OVER (PARTITION BY o_custkey, o_orderpriority, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
FROM orders
"""


@query(f"SELECT o_custkey, o_orderpriority, season, o_totalprice FROM ({_LAST_ORDER}) WHERE rn = 1")
def merge_edges(t: Tables) -> DataFrame:
    return graph.merge_edges(_order_rows(t), ["o_custkey"], ["o_orderpriority"], ["season"], ["o_totalprice"], _ORDER_SEQ)


def _players(t: Tables) -> DataFrame:
    return t("customer").filter("c_acctbal >= 0").select("c_custkey")


def _teams(t: Tables) -> DataFrame:
    return t("orders").select(F.col("o_orderpriority").alias("name")).filter("name <> '3-MEDIUM'").distinct()


_PLAYER = {"o_custkey": "c_custkey"}
_TEAM = {"o_orderpriority": "name"}
_MATCHED_PLAYER = "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"
_MATCHED_TEAM = "o_orderpriority <> '3-MEDIUM'"


@query(f"""
SELECT o_custkey, o_orderpriority, season, o_totalprice, o_orderstatus
FROM ({_LAST_ORDER}) WHERE rn = 1 AND {_MATCHED_PLAYER} AND {_MATCHED_TEAM}
""")
def edge_plays_for(t: Tables) -> DataFrame:
    return graph.edge_plays_for(
        _order_rows(t), _players(t), _teams(t), _PLAYER, _TEAM, "season", ["o_totalprice", "o_orderstatus"], _ORDER_SEQ
    )


@query(f"""
SELECT DISTINCT o_custkey, l_partkey
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
WHERE p_type <> 'PROMO' AND {_MATCHED_PLAYER} AND {_MATCHED_TEAM}
""")
def edge_attended(t: Tables) -> DataFrame:
    rows = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    schools = t("part").filter("p_type <> 'PROMO'").select("p_partkey")
    return graph.edge_attended(rows, _players(t), schools, _PLAYER, {"l_partkey": "p_partkey"}, _teams(t), _TEAM)


@query(f"""
WITH c AS (
  SELECT o_custkey, unnest(list_transform([o_orderstatus, o_orderpriority, substr(o_orderpriority, 3, 1)], lambda x: {_ORDER_CODE_CASE})) AS position
  FROM orders WHERE {_MATCHED_PLAYER} AND {_MATCHED_TEAM})
SELECT DISTINCT o_custkey, position FROM c WHERE position IN ('Urgent', 'Filled', 'Medium')
""")
def edge_has_position(t: Tables) -> DataFrame:
    rows = t("orders").withColumn("positions", codes.split_codes(F.expr(_ORDER_CODE_LIST), _ORDER_CODES))
    known = literal(rows, "name", ["Urgent", "Filled", "Medium"])
    return graph.edge_has_position(
        rows, _players(t), known, _PLAYER, "positions", {"position": "name"}, [(_teams(t), _TEAM)]
    )


# A customer's nation is the group it names; nation 7 is written with a wrong number.
_MEMBER = "CASE WHEN c_nationkey = 7 THEN 99 ELSE c_nationkey END"


def _member_rows(t: Tables) -> DataFrame:
    return t("customer").select("c_name", F.expr(_MEMBER).alias("member_of"), "c_mktsegment")


def _member_teams(t: Tables) -> DataFrame:
    return t("customer").filter("c_acctbal >= 0").select("c_name")


@query(f"SELECT c_name, n_name AS group_key FROM customer JOIN nation ON {_MEMBER} = n_nationkey WHERE c_acctbal >= 0")
def edge_member_of(t: Tables) -> DataFrame:
    return graph.edge_member_of(
        _member_rows(t), _member_teams(t), t("nation"), {"c_name": "c_name"}, {"member_of": "n_nationkey"}, "n_name"
    )


@query(f"""
SELECT c_name, c_mktsegment FROM customer
WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' AND {_MEMBER} IN (SELECT n_nationkey FROM nation)
""")
def edge_represents(t: Tables) -> DataFrame:
    colleges = t("customer").select(F.col("c_mktsegment").alias("name")).filter("name <> 'FURNITURE'").distinct()
    return graph.edge_represents(
        _member_rows(t), _member_teams(t), colleges, {"c_name": "c_name"}, {"c_mktsegment": "name"},
        t("nation"), {"member_of": "n_nationkey"},
    )


_COACH_SEQ = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]


@query("""
SELECT l_suppkey, l_partkey, season, role
FROM (SELECT l_suppkey, l_partkey, CAST(year(l_shipdate) AS INTEGER) AS season, l_returnflag AS role,
             row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
      FROM lineitem)
WHERE rn = 1 AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')
""")
def edge_coaches(t: Tables) -> DataFrame:
    rows = t("lineitem").withColumn("season", F.year("l_shipdate")).withColumnRenamed("l_returnflag", "role")
    coaches = t("supplier").filter("s_acctbal >= 0")
    teams = t("part").filter("p_type <> 'PROMO'")
    return graph.edge_coaches(
        rows, coaches, teams, {"l_suppkey": "s_suppkey"}, {"l_partkey": "p_partkey"}, ["season", "role"], _COACH_SEQ
    )


@query("""
SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') GROUP BY l_partkey
""")
def unmatched_report(t: Tables) -> DataFrame:
    nodes = t("part").filter("p_type <> 'PROMO'")
    return quality.unmatched_report(t("lineitem"), nodes, {"l_partkey": "p_partkey"})


_TRANSFERS = """
e AS (SELECT DISTINCT o_custkey, o_orderpriority AS team, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders),
moves AS (
  SELECT o_custkey, b.team AS to_team, a.team AS from_team, b.season,
         row_number() OVER (PARTITION BY o_custkey, b.team ORDER BY b.season DESC, a.team DESC) AS rn
  FROM e a JOIN e b USING (o_custkey) WHERE a.season + 1 = b.season AND a.team <> b.team)
"""


def _transfer_edges(t: Tables) -> DataFrame:
    stays = t("orders").select(
        "o_custkey", F.col("o_orderpriority").alias("team"), F.year("o_orderdate").alias("season")
    )
    return graph.transfers(stays, ["o_custkey"], "team", "season")


@query(f"WITH {_TRANSFERS} SELECT o_custkey, to_team, from_team, season FROM moves WHERE rn = 1")
def transfers(t: Tables) -> DataFrame:
    return _transfer_edges(t)


# ---- Questions ----


@query(f"WITH {_TRANSFERS} SELECT from_team, to_team, count(*) AS n FROM moves WHERE rn = 1 GROUP BY ALL")
def transfer_counts(t: Tables) -> DataFrame:
    return paths.transfer_counts(_transfer_edges(t))


@query("""
SELECT l_partkey, count(DISTINCT o_custkey) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 15
""")
def top_producers(t: Tables) -> DataFrame:
    edges = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return paths.top_producers(edges, "l_partkey", ["o_custkey"], 15)


@query("""
SELECT r_name, count(DISTINCT c_custkey) AS n
FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
WHERE c_mktsegment = 'MACHINERY' AND o_orderpriority = '1-URGENT' GROUP BY r_name
""")
def count_by_path(t: Tables) -> DataFrame:
    hops = [
        Hop(t("nation").select("n_nationkey", "n_regionkey"), {"r_regionkey": "n_regionkey"}),
        Hop(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), {"n_nationkey": "c_nationkey"}),
        Hop(t("orders").select("o_custkey", "o_orderpriority"), {"c_custkey": "o_custkey"}),
    ]
    machinery = (F.col("c_mktsegment") == "MACHINERY") & (F.col("o_orderpriority") == "1-URGENT")
    return paths.count_by_path(t("region"), hops, machinery, "r_name", ["c_custkey"])


@query("""
WITH e AS (SELECT DISTINCT s_nationkey, l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT a.s_nationkey AS s_nationkey_a, b.s_nationkey AS s_nationkey_b, count(*) AS shared
FROM e a JOIN e b ON a.l_partkey = b.l_partkey AND a.s_nationkey < b.s_nationkey GROUP BY ALL
""")
def shared_neighbors(t: Tables) -> DataFrame:
    """Nations whose suppliers sold the same parts."""
    sold = t("lineitem").select("l_suppkey", "l_partkey").distinct()
    edges = sold.join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return paths.shared_neighbors(edges, "s_nationkey", "l_partkey")


@query("""
WITH first15 AS (
  SELECT r_name, n_name, c_custkey, c_name FROM region LEFT JOIN nation ON r_regionkey = n_regionkey
  LEFT JOIN customer ON n_nationkey = c_nationkey WHERE r_name = 'ASIA' ORDER BY c_name NULLS LAST, n_name LIMIT 15)
SELECT r_name, n_name, c_name, o_orderkey, o_orderpriority FROM first15 LEFT JOIN orders ON c_custkey = o_custkey
""")
def optional_path(t: Tables) -> DataFrame:
    first = [
        Hop(t("nation").select("n_nationkey", "n_name", "n_regionkey"), {"r_regionkey": "n_regionkey"}, optional=True),
        Hop(t("customer").select("c_custkey", "c_name", "c_nationkey"), {"n_nationkey": "c_nationkey"}, optional=True),
    ]
    then = [Hop(t("orders").select("o_custkey", "o_orderkey", "o_orderpriority"), {"c_custkey": "o_custkey"}, optional=True)]
    order = [F.asc_nulls_last("c_name"), F.asc_nulls_last("n_name")]
    found = paths.path_top_k(t("region").filter("r_name = 'ASIA'"), first, order, 15, then)
    return found.select("r_name", "n_name", "c_name", "o_orderkey", "o_orderpriority")
