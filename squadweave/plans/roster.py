"""The roster build: pages to raw records, records to clean tables, tables to a graph, and questions on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadweave import schemas
from squadweave.functions import codes, text
from squadweave.functions.fixed_values import CLASS_YEARS
from squadweave.functions.roles import extract_roles
from squadweave.operators import extract, graph, paths, quality, resolve
from squadweave.operators.paths import Hop
from squadweave.session import tune
from squadweave.sources import seeds, tables, versions

# Positions per player that a strict load takes, as a row-wise load would: it reads three position columns.
STRICT_POSITIONS = 3

# Header texts of raw tables that differ from the column names here.
RENAMED = {
    "Class Year": "class_year", "B/T": "bt", "High School": "high_school", "member of": "member_of",
    "founded year": "founded_year", "number of teams": "number_of_teams", "Role List": "role_list",
}


def plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[RENAMED.get(name, name.lower()) for name in df.columns])


# ---- Pages to raw records ----


def extract_rosters(spark: SparkSession, page_path: str, raw_dir: str, form: str = "parquet") -> None:
    """Write the raw tables ``players``, ``coaches``, ``highschools`` and ``rejected`` of all listed pages.

    The cards are written once and every table is derived from them, so no
    page is parsed twice. ``seq`` keeps the load order: newest season first.
    """
    pages = tables.read_pages(spark, page_path, seeds.page_list(spark), form)
    tables.write_table(extract.roster_cards(pages), f"{raw_dir}/cards")
    cards = spark.read.parquet(f"{raw_dir}/cards").withColumn("seq", F.struct("batch_no", "page_no", "card_no"))
    players = extract.roster_players(cards)
    tables.write_table(players, f"{raw_dir}/players", ["college", *extract.PLAYER_FIELDS, "season", "seq"])
    tables.write_table(
        extract.roster_coaches(cards), f"{raw_dir}/coaches", ["college", *extract.COACH_FIELDS, "season", "seq"]
    )
    schools = tables.derive_dimension(spark.read.parquet(f"{raw_dir}/players"), "high_school")
    tables.write_table(schools, f"{raw_dir}/highschools")
    tables.write_table(extract.rejected_cards(cards), f"{raw_dir}/rejected")


RAW_TABLES = {"players": schemas.RAW_PLAYERS, "coaches": schemas.RAW_COACHES, "highschools": schemas.NAMES}


def read_raw_csv(spark: SparkSession, raw_dir: str, rejected_dir: str | None = None) -> dict[str, DataFrame]:
    """Raw tables from headered CSV files; ``seq`` is the place of a row in its file.

    With ``rejected_dir`` lines with too many or too few fields are left out of
    the tables and written to ``<rejected_dir>/<table>``; without it they are
    cut or padded.
    """
    found = {}
    for name, schema in RAW_TABLES.items():
        path = f"{raw_dir}/{name}.csv"
        if rejected_dir is not None:
            tables.write_table(tables.malformed_rows(spark, path, schema, order="seq"), f"{rejected_dir}/{name}")
        rows = tables.read_table(spark, path, schema, order="seq", well_formed=rejected_dir is not None)
        found[name] = plain_names(rows)
    return found


def read_raw(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Raw tables as ``extract_rosters`` wrote them."""
    return {name: spark.read.parquet(f"{raw_dir}/{name}") for name in ("players", "coaches", "highschools")}


# ---- Records to clean tables ----


def resolve_high_schools(players: DataFrame, schools: DataFrame, cutoff: float = 70.0) -> DataFrame:
    """Mapping of the players' high schools to the best match, the first in name order on ties."""
    return resolve.canonicalize(players, "high_school", schools, "name", "name", cutoff=cutoff)


def clean_players(players: DataFrame, mapping: DataFrame) -> DataFrame:
    """Clean player records; every position has a column, as many as the longest list has entries."""
    rows = tables.null_tokens(players)
    batting, throwing = codes.split_pair(F.col("bt"))
    rows = resolve.apply_mapping(rows, "high_school", mapping)
    rows = rows.withColumns(
        {
            "position_list": codes.split_codes(F.col("position")),
            "batting": batting,
            "throwing": throwing,
            "bt": text.null_or_invalid_to_na(F.col("bt"), "Year"),
            "class_year": codes.map_codes(F.col("class_year"), CLASS_YEARS),
            "hometown": text.standardize_place(F.col("hometown")),
            "team": codes.map_codes(F.col("college"), seeds.team_of_college(), miss="null", trim=False),
        }
    )
    width = codes.longest(players.select(codes.split_codes(F.col("position")).alias("position_list")), "position_list")
    return rows.select("*", *codes.widen(F.col("position_list"), width))


def clean_coaches(coaches: DataFrame) -> DataFrame:
    rows = resolve.collapse(tables.null_tokens(coaches), ["name", "college", "season"], "title")
    return rows.withColumn(
        "team", codes.map_codes(F.col("college"), seeds.team_of_college(), miss="null", trim=False)
    ).withColumn("role_list", extract_roles(F.col("title")))


def clean_high_schools(schools: DataFrame, mapping: DataFrame) -> DataFrame:
    """Canonical names; ``seq`` is the first listed name that led to each."""
    renamed = resolve.apply_mapping(schools.select("name", F.col("name").alias("seq")), "name", mapping)
    return resolve.dedup_keep_first(renamed, ["name"], ["seq"])


def clean_all(raw: dict[str, DataFrame], clean_dir: str) -> None:
    """Write the clean tables ``players``, ``coaches``, ``highschools``, the school ``mapping`` and its ``dedup_metrics``."""
    spark = tune(raw["players"].sparkSession)
    tables.write_table(resolve_high_schools(tables.null_tokens(raw["players"]), raw["highschools"]), f"{clean_dir}/mapping")
    mapping = spark.read.parquet(f"{clean_dir}/mapping")
    tables.write_table(clean_players(raw["players"], mapping), f"{clean_dir}/players")
    tables.write_table(clean_coaches(raw["coaches"]), f"{clean_dir}/coaches")
    tables.write_table(clean_high_schools(raw["highschools"], mapping), f"{clean_dir}/highschools")
    tables.write_table(resolve.dedup_metrics(mapping), f"{clean_dir}/dedup_metrics")


# ---- Clean tables to a graph ----

NODE_KEYS = {
    "Conference": ["name"], "HighSchool": ["name"], "Team": ["name"], "Player": ["name", "hometown"],
    "Position": ["name"], "Coach": ["name"], "College": ["name"],
}
PLAYER = {"name": "name", "hometown": "hometown"}


@dataclass
class Graph:
    """Node tables by label and edge tables by type."""

    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]


def player_rows(players: DataFrame, recency: str = "file", positions: int | None = None) -> DataFrame:
    """Player records as the graph takes them, with the order in which writes count.

    By default a later row of the load wins. With ``recency='season'`` a later
    season does, and the load order only decides within it. ``positions``
    keeps only so many of a record's positions, the first ones.
    """
    held = F.col("position_list") if positions is None else F.slice("position_list", 1, positions)
    order = F.struct("seq") if recency == "file" else F.struct("season", "seq")
    return players.select(
        "name", "hometown", "team", "high_school", "class_year",
        *[text.safe_int(F.col(name).cast("string")).alias(name) for name in ("height", "weight", "jersey", "season")],
        F.col("batting").alias("batting_hand"),
        F.col("throwing").alias("throwing_hand"),
        held.alias("positions"),
        order.alias("order"),
    )


NODE_PROPS = {
    "Conference": ["region", "abbreviation", "founded_year", "number_of_teams", "headquarters"],
    "Player": ["height", "weight", "batting_hand", "throwing_hand"],
}

# Labels whose rows come from seed tables: there a key that occurs twice is an error, elsewhere rows merge.
SEEDED = ("Conference", "Team", "Position", "College")


def node_rows(clean: dict[str, DataFrame], recency: str = "file") -> dict[str, DataFrame]:
    """The rows that the nodes of each label are merged from, in the order that ``order`` says."""
    spark = clean["players"].sparkSession
    rows = {
        "Conference": seeds.conferences(spark),
        "HighSchool": clean["highschools"].select("name"),
        "Team": seeds.teams(spark).select(F.col("team").alias("name")),
        "Player": player_rows(clean["players"], recency),
        "Position": seeds.positions(spark),
        "Coach": clean["coaches"].select("name"),
        "College": seeds.colleges(spark),
    }
    return {label: df if "order" in df.columns else df.withColumn("order", F.lit(0)) for label, df in rows.items()}


def build_nodes(clean: dict[str, DataFrame], recency: str = "file") -> dict[str, DataFrame]:
    return {
        label: graph.merge_nodes(rows, NODE_KEYS[label], NODE_PROPS.get(label, []), ["order"])
        for label, rows in node_rows(clean, recency).items()
    }


def build_edges(
    clean: dict[str, DataFrame], nodes: dict[str, DataFrame], strict: bool = True, recency: str = "file"
) -> dict[str, DataFrame]:
    """All edges but the transfers.

    A strict build drops what a row-wise load would: a row that fails one
    match takes no further part, and only the first ``STRICT_POSITIONS``
    positions count. Otherwise every edge asks only for its own two ends.
    """
    spark = clean["players"].sparkSession
    rows = player_rows(clean["players"], recency, STRICT_POSITIONS if strict else None)
    team_rows = seeds.teams(spark)
    team, school, member = {"team": "name"}, {"high_school": "name"}, {"member_of": "abbreviation"}
    coach_seq = ["college", "season"] if recency == "file" else ["season", "college"]
    return {
        "PLAYS_FOR": graph.edge_plays_for(
            rows, nodes["Player"], nodes["Team"], PLAYER, team, "season", ["jersey", "class_year", "positions"], ["order"]
        ),
        "ATTENDED": graph.edge_attended(
            rows, nodes["Player"], nodes["HighSchool"], PLAYER, school, *((nodes["Team"], team) if strict else ())
        ),
        "HAS_POSITION": graph.edge_has_position(
            rows, nodes["Player"], nodes["Position"], PLAYER, "positions", {"position": "name"},
            [(nodes["Team"], team), (nodes["HighSchool"], school)] if strict else [],
        ),
        "MEMBER_OF": graph.edge_member_of(
            team_rows, nodes["Team"], nodes["Conference"], team, member, "name"
        ).withColumnRenamed("group_key", "conference"),
        "REPRESENTS": graph.edge_represents(
            team_rows, nodes["Team"], nodes["College"], team, {"college": "name"},
            *((nodes["Conference"], member) if strict else ()),
        ),
        "COACHES": graph.edge_coaches(
            clean["coaches"].withColumn("role", F.col("role_list")), nodes["Coach"], nodes["Team"],
            {"name": "name"}, team, ["role", "season"], coach_seq,
        ),
    }


def unmatched_rows(clean: dict[str, DataFrame], nodes: dict[str, DataFrame], recency: str = "file") -> dict[str, DataFrame]:
    """Key values of edge rows that meet no node, with the rows lost to each, by edge type.

    Null keys are among them: a row that names no team plays for none.
    """
    rows = player_rows(clean["players"], recency)
    team_rows = seeds.teams(clean["players"].sparkSession)
    team = {"team": "name"}
    return {
        "PLAYS_FOR": quality.unmatched_report(rows, nodes["Team"], team),
        "ATTENDED": quality.unmatched_report(rows, nodes["HighSchool"], {"high_school": "name"}),
        "HAS_POSITION": quality.unmatched_report(
            rows.select(F.explode("positions").alias("position")), nodes["Position"], {"position": "name"}
        ),
        "MEMBER_OF": quality.unmatched_report(team_rows, nodes["Conference"], {"member_of": "abbreviation"}),
        "REPRESENTS": quality.unmatched_report(team_rows, nodes["College"], {"college": "name"}),
        "COACHES": quality.unmatched_report(clean["coaches"], nodes["Team"], team),
    }


def build_transfers(plays_for: DataFrame) -> DataFrame:
    return graph.transfers(plays_for, list(PLAYER), "team", "season")


def load_all(
    spark: SparkSession, clean_dir: str, graph_dir: str, strict: bool = True, recency: str = "file"
) -> Graph:
    """Write the whole graph anew: nodes, edges, and the transfers last, with reports of what is not in it.

    Keys are checked on the rows before they merge: a seed table whose key
    occurs twice stops the load, rows with a null key go to
    ``rejected/<label>``. ``unmatched/<type>`` lists the keys that met no node
    and the rows lost to each. Every table is read back once written, so a lost
    executor costs no more than the table at work.

    All of it goes into a version of its own, which readers take up only when
    it is complete: a load that fails leaves the graph as it was.
    """
    tune(spark)
    clean = {name: spark.read.parquet(f"{clean_dir}/{name}") for name in ("players", "coaches", "highschools")}
    version = versions.begin(spark, graph_dir)
    nodes = {}
    for label, rows in node_rows(clean, recency).items():
        keys = NODE_KEYS[label]
        if label in SEEDED:
            quality.require_unique(rows, keys, label)
        tables.write_table(graph.null_key_rows(rows, keys), f"{version}/rejected/{label}")
    for label, df in build_nodes(clean, recency).items():
        tables.write_table(df, f"{version}/nodes/{label}")
        nodes[label] = spark.read.parquet(f"{version}/nodes/{label}")
    for kind, df in build_edges(clean, nodes, strict, recency).items():
        tables.write_table(df, f"{version}/edges/{kind}")
    for kind, df in unmatched_rows(clean, nodes, recency).items():
        tables.write_table(df, f"{version}/unmatched/{kind}")
    plays_for = spark.read.parquet(f"{version}/edges/PLAYS_FOR")
    tables.write_table(build_transfers(plays_for), f"{version}/edges/TRANSFERRED_TO")
    versions.complete(spark, version)
    return read_graph(spark, graph_dir)


EDGE_TYPES = ("PLAYS_FOR", "ATTENDED", "HAS_POSITION", "MEMBER_OF", "REPRESENTS", "COACHES", "TRANSFERRED_TO")


def read_graph(spark: SparkSession, graph_dir: str) -> Graph:
    """The latest complete version of a graph."""
    version = versions.latest(spark, graph_dir)
    return Graph(
        {label: spark.read.parquet(f"{version}/nodes/{label}") for label in NODE_KEYS},
        {kind: spark.read.parquet(f"{version}/edges/{kind}") for kind in EDGE_TYPES},
    )


def read_report(spark: SparkSession, graph_dir: str, kind: str, name: str) -> DataFrame:
    """A report of the latest version: ``kind`` is ``rejected`` (by label) or ``unmatched`` (by edge type)."""
    return spark.read.parquet(f"{versions.latest(spark, graph_dir)}/{kind}/{name}")


# What makes an edge one edge, and what it carries.
EDGE_KEYS = {
    "PLAYS_FOR": ["name", "hometown", "team", "season"], "ATTENDED": ["name", "hometown", "high_school"],
    "HAS_POSITION": ["name", "hometown", "position"], "MEMBER_OF": ["team", "conference"], "REPRESENTS": ["team", "college"],
    "COACHES": ["name", "team"],
}
EDGE_PROPS = {"PLAYS_FOR": ["jersey", "class_year", "positions"], "COACHES": ["role", "season"]}


def refresh(
    spark: SparkSession, graph_dir: str, batch: dict[str, DataFrame], strict: bool = True, recency: str = "file"
) -> Graph:
    """Merge a batch of clean tables into a stored graph, nodes and edges, as a new version.

    The batch wins over what is stored; merging it again changes nothing.
    Transfers follow from all stored and new seasons.
    """
    tune(spark)
    stored = read_graph(spark, graph_dir)
    version = versions.begin(spark, graph_dir)
    nodes = {}
    for label, rows in node_rows(batch, recency).items():
        merged = graph.merge_idempotent(
            stored.nodes[label], rows, NODE_KEYS[label], NODE_PROPS.get(label, []), ["order"]
        )
        tables.write_table(merged, f"{version}/nodes/{label}")
        nodes[label] = spark.read.parquet(f"{version}/nodes/{label}")
        tables.write_table(graph.null_key_rows(rows, NODE_KEYS[label]), f"{version}/rejected/{label}")
    for kind, df in build_edges(batch, nodes, strict, recency).items():
        merged = graph.merge_idempotent(stored.edges[kind], df, EDGE_KEYS[kind], EDGE_PROPS.get(kind, []), [])
        tables.write_table(merged, f"{version}/edges/{kind}")
    for kind, df in unmatched_rows(batch, nodes, recency).items():
        tables.write_table(df, f"{version}/unmatched/{kind}")
    plays_for = spark.read.parquet(f"{version}/edges/PLAYS_FOR")
    tables.write_table(build_transfers(plays_for), f"{version}/edges/TRANSFERRED_TO")
    versions.complete(spark, version)
    return read_graph(spark, graph_dir)


def refresh_players(stored: Graph, players: DataFrame, out_path: str, recency: str = "file") -> None:
    """Merge a batch of clean player records into the stored nodes and write them to a new place."""
    props = ["height", "weight", "batting_hand", "throwing_hand"]
    merged = graph.merge_idempotent(
        stored.nodes["Player"], player_rows(players, recency), NODE_KEYS["Player"], props, ["order"]
    )
    tables.write_table(merged, out_path)


# ---- Questions ----


def top_high_schools(g: Graph, k: int = 15) -> DataFrame:
    """High schools that the most players attended."""
    return paths.top_producers(g.edges["ATTENDED"], "high_school", list(PLAYER), k)


def transfers_between_teams(g: Graph) -> DataFrame:
    return paths.transfer_counts(g.edges["TRANSFERRED_TO"])


def left_handed_pitchers(g: Graph) -> DataFrame:
    """Players per conference who pitch left-handed."""
    hops = [
        Hop(g.edges["PLAYS_FOR"].select("name", "hometown", "team"), {"team": "team"}),
        Hop(g.edges["HAS_POSITION"], PLAYER),
    ]
    pitches = F.col("position") == "Left-Handed Pitcher"
    return paths.count_by_path(g.edges["MEMBER_OF"], hops, pitches, "conference", list(PLAYER))


def teams_sharing_high_schools(g: Graph) -> DataFrame:
    """Pairs of teams with the number of high schools that both have players from."""
    played = g.edges["PLAYS_FOR"].select("name", "hometown", "team").distinct()
    from_school = paths.expand(played, Hop(g.edges["ATTENDED"], PLAYER))
    return paths.shared_neighbors(from_school, "team", "high_school")


def head_coaches_by_conference(g: Graph) -> DataFrame:
    hops = [Hop(g.edges["COACHES"].withColumnRenamed("name", "coach"), {"team": "team"})]
    return paths.count_by_path(
        g.edges["MEMBER_OF"], hops, F.array_contains("role", "Head Coach"), "conference", ["coach"]
    )


def conference_players(g: Graph, abbreviation: str, limit: int = 15) -> DataFrame:
    """Teams, players and positions of a conference, for its first players by name.

    Every hop is optional: a conference without teams still gives a row.
    """
    start = g.nodes["Conference"].filter(F.col("abbreviation") == abbreviation).select(F.col("name").alias("conference"))
    member = g.edges["MEMBER_OF"].select("conference", "team")
    plays = g.edges["PLAYS_FOR"]
    first = [
        Hop(member, {"conference": "conference"}, optional=True),
        Hop(plays, {"team": "team"}, optional=True),
    ]
    order = [F.asc_nulls_last(name) for name in ("name", "hometown", "season", "team")]
    return paths.path_top_k(start, first, order, limit, [Hop(g.edges["HAS_POSITION"], PLAYER, optional=True)])
