"""Row dedup, grouping sets and leaderboards over game details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "unknown"
OVERALL = "(overall)"
LEVEL = "player_name__team_id__season"


def join_games(details: DataFrame, games: DataFrame) -> DataFrame:
    """Details with the columns of their game; the key appears once."""
    return details.join(games, "game_id")


def dedupe_rows(rows: DataFrame, keys: list[str], first_by: list[str]) -> DataFrame:
    """One row per key: the first by ``first_by``, then by all other columns.

    The order is total, so the survivor does not depend on the run.  Spark
    keeps one row per key and map task before the shuffle (WindowGroupLimit):
    a key with a third of the rows arrives as one row per task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in first_by]
    w = Window.partitionBy(*keys).orderBy(*first_by, *rest)
    return (
        rows.withColumn("row_num", F.row_number().over(w))
        .filter("row_num = 1")
        .drop("row_num")
    )


def _points(lines: DataFrame, players: DataFrame | None, *keys: str) -> DataFrame:
    """Sum of points and row count per player name and ``keys``.

    With a separate player table the sums are taken per player id first and
    the names joined to the sums, not to the lines.  Ids sharing a name are
    added up in the second grouping.
    """
    sums = [F.sum("pts").alias("points"), F.count(F.lit(1)).alias("hits")]
    if players is None:
        return lines.groupBy("player_name", *keys).agg(*sums)
    per_id = lines.groupBy("player_id", *keys).agg(*sums)
    return (
        per_id.join(players, "player_id", "left")
        .groupBy("player_name", *keys)
        .agg(F.sum("points").alias("points"), F.sum("hits").alias("hits"))
    )


def grouping_sets_points(
    lines: DataFrame, players: DataFrame | None = None
) -> DataFrame:
    """Points per (player, team, season), player, team and overall.

    The finest level is summed first, so the four-fold expansion runs over its
    groups instead of over the lines.
    """
    keys = ["player_name", "team_id", "season"]
    finest = _points(lines, players, "team_id", "season").select(
        *[F.coalesce(F.col(k).cast("string"), F.lit(UNKNOWN)).alias(k) for k in keys],
        "points", "hits",
    )
    out = finest.groupingSets(
        [[F.col(k) for k in keys], [F.col("player_name")], [F.col("team_id")], []],
        *[F.col(k) for k in keys],
    ).agg(
        *[F.grouping(k).alias(f"rolled_{k}") for k in keys],
        F.sum("points").alias("total_points"),
        F.sum("hits").alias("number_of_hits"),
    )

    def rolled(k: str) -> Column:
        return F.col(f"rolled_{k}") == 1

    level = (
        F.when(~rolled("season"), F.lit(LEVEL))
        .when(~rolled("player_name"), F.lit("player_name"))
        .when(~rolled("team_id"), F.lit("team_id"))
        .otherwise(F.lit("overall"))
    )
    return out.select(
        level.alias("aggregation_level"),
        *[F.when(rolled(k), F.lit(OVERALL)).otherwise(F.col(k)).alias(k) for k in keys],
        "total_points",
        "number_of_hits",
    ).orderBy(F.desc_nulls_last("total_points"), "aggregation_level", *keys)


def _top(sums: DataFrame, by: str, keys: list[str], n: int) -> DataFrame:
    """First n by ``by`` descending, NULL last, ties by the keys."""
    return sums.orderBy(F.desc_nulls_last(by), *keys).limit(n)


def top_player(
    lines: DataFrame, per: str, players: DataFrame | None = None, n: int = 1
) -> DataFrame:
    """Most points of a player per ``per`` ('team_id' or 'season')."""
    sums = _points(lines, players, per).select(
        "player_name", per, F.col("points").alias("total_points")
    )
    return _top(sums, "total_points", ["player_name", per], n)


def top_team_wins(games: DataFrame, n: int = 1) -> DataFrame:
    """Most wins; a game without a result counts for nobody."""
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).when(
        F.col("home_team_wins") == 0, F.col("away_team_id")
    )
    wins = (
        games.select(winner.alias("team_id"))
        .filter("team_id is not null")
        .groupBy("team_id")
        .agg(F.count(F.lit(1)).alias("total_wins"))
    )
    return _top(wins, "total_wins", ["team_id"], n)
