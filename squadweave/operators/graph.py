"""Node and edge tables: order-aware merges, matching and derived edges.

Every merge first keeps the last write of each identity, which Spark
pre-aggregates before the shuffle, and only then looks the endpoints up. A
node or key that holds a large share of all rows thus reaches the joins as few
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from squadweave.sources.tables import present


def last_write(rows: DataFrame, keys: list[str], props: list[str], seq: list[str]) -> DataFrame:
    """One row per key with the properties, nulls included, of its last row by ``seq``."""
    keyed = present(rows, keys)
    if not props:
        return keyed.select(*keys).distinct()
    last = keyed.groupBy(*keys).agg(F.max_by(F.struct(*props), F.struct(*seq)).alias("_last"))
    return last.select(*keys, "_last.*")


def merge_nodes(rows: DataFrame, keys: list[str], props: list[str] = (), seq: list[str] = ()) -> DataFrame:
    """One node per key. Rows with a null key are no nodes, see ``null_key_rows``."""
    return last_write(rows, list(keys), list(props), list(seq))


def merge_edges(
    rows: DataFrame,
    src: list[str],
    dst: list[str],
    edge_key: list[str] = (),
    props: list[str] = (),
    seq: list[str] = (),
) -> DataFrame:
    """One edge per source, destination and edge key, with the last written properties."""
    return last_write(rows, [*src, *dst, *edge_key], list(props), list(seq))


def merge_idempotent(stored: DataFrame, batch: DataFrame, keys: list[str], props: list[str], seq: list[str]) -> DataFrame:
    """The stored table after a batch. The batch wins over what is stored; merging it again changes nothing."""
    old = stored.select(*keys, *props).withColumn("_age", F.lit(0))
    new = batch.select(*keys, *props, *seq).withColumn("_age", F.lit(1))
    return last_write(old.unionByName(new, allowMissingColumns=True), keys, props, ["_age", *seq])


def null_key_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that cannot be merged, as part of their key is null."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return rows.filter(missing)


def match(rows: DataFrame, nodes: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose columns meet a node: ``on`` maps row columns to node columns. Nulls meet nothing."""
    keys = nodes.select(*[F.col(node).alias(f"_node_{at}") for at, node in enumerate(on.values())])
    met = [F.col(row) == F.col(f"_node_{at}") for at, row in enumerate(on)]
    return rows.join(keys, met, "left_semi")


def edge_plays_for(
    rows: DataFrame,
    players: DataFrame,
    teams: DataFrame,
    player: dict[str, str],
    team: dict[str, str],
    season: str,
    props: list[str],
    seq: list[str],
) -> DataFrame:
    """Player to team, one edge per season.

    ``player`` and ``team`` map row columns to node columns, here and below.
    """
    edges = merge_edges(rows, list(player), list(team), [season], props, seq)
    return match(match(edges, players, player), teams, team)


def edge_attended(
    rows: DataFrame,
    players: DataFrame,
    schools: DataFrame,
    player: dict[str, str],
    school: dict[str, str],
    teams: DataFrame | None = None,
    team: dict[str, str] | None = None,
) -> DataFrame:
    """Player to school. With ``teams`` only rows that also meet a team count, as in a row-wise load."""
    columns = [*player, *school, *(team or ())]
    kept = match(match(rows.select(*columns).distinct(), players, player), schools, school)
    if team:
        kept = match(kept, teams, team).select(*player, *school).distinct()
    return kept


def edge_has_position(
    rows: DataFrame,
    players: DataFrame,
    positions: DataFrame,
    player: dict[str, str],
    position_list: str,
    position: dict[str, str],
    also: list[tuple[DataFrame, dict[str, str]]] = (),
) -> DataFrame:
    """Player to every known position of a list; null and empty positions do not count.

    With ``also`` only rows that meet those nodes too count, as in a row-wise load.
    """
    (name,) = position
    extra = [column for _, on in also for column in on]
    single = rows.select(*player, *extra, F.explode(position_list).alias(name)).filter(F.col(name) != "")
    kept = match(match(single.distinct(), positions, position), players, player)
    for nodes, on in also:
        kept = match(kept, nodes, on)
    return kept.select(*player, name).distinct() if extra else kept


def edge_member_of(
    rows: DataFrame, teams: DataFrame, groups: DataFrame, team: dict[str, str], group: dict[str, str], group_key: str
) -> DataFrame:
    """Team to group. A row names its group by another property than the group's key."""
    ((row_column, node_column),) = group.items()
    named = groups.select(F.col(node_column).alias("_group"), F.col(group_key).alias("group_key"))
    kept = match(rows.select(*team, row_column).distinct(), teams, team)
    return kept.join(named, F.col(row_column) == F.col("_group")).select(*team, "group_key").distinct()


def edge_represents(
    rows: DataFrame,
    teams: DataFrame,
    colleges: DataFrame,
    team: dict[str, str],
    college: dict[str, str],
    groups: DataFrame | None = None,
    group: dict[str, str] | None = None,
) -> DataFrame:
    """Team to college. With ``groups`` only rows that also meet a group count, as in a row-wise load."""
    kept = match(rows.select(*team, *college, *(group or ())).distinct(), teams, team)
    if group:
        kept = match(kept, groups, group).select(*team, *college).distinct()
    return match(kept, colleges, college)


def edge_coaches(
    rows: DataFrame,
    coaches: DataFrame,
    teams: DataFrame,
    coach: dict[str, str],
    team: dict[str, str],
    props: list[str],
    seq: list[str],
) -> DataFrame:
    """Coach to team. The season is a property, so only the last written one stays."""
    edges = merge_edges(rows, list(coach), list(team), [], props, seq)
    return match(match(edges, coaches, coach), teams, team)


def transfers(plays_for: DataFrame, player: list[str], team: str, season: str, period: int = 1) -> DataFrame:
    """Player to a team played for one ``period`` after another team.

    One edge per player and new team: that of the latest season, and among
    several old teams the last in order. Only the last two teams of a player
    and season can ever be an old team, so no pairs of teams are formed.
    """
    known = present(plays_for.select(*player, team, season), [*player, team, season])
    stays = known.filter((F.col(season) + period).isNotNull()).distinct()
    last_two = (
        stays.withColumn("_at", F.row_number().over(W.partitionBy(*player, season).orderBy(F.desc(team))))
        .filter("_at <= 2")
        .groupBy(*player, (F.col(season) + period).alias(season))
        .agg(
            F.max(F.when(F.col("_at") == 1, F.col(team))).alias("_last"),
            F.max(F.when(F.col("_at") == 2, F.col(team))).alias("_before"),
        )
    )
    moves = (
        stays.join(last_two, [*player, season])
        .withColumn("from_team", F.when(F.col("_last") != F.col(team), F.col("_last")).otherwise(F.col("_before")))
        .filter(F.col("from_team").isNotNull())
    )
    return moves.groupBy(*player, F.col(team).alias("to_team")).agg(
        F.max_by("from_team", season).alias("from_team"), F.max(season).alias(season)
    )
