"""Rolling windows over games and longest streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideframe.operators import ordered as O

# Games in a stretch, points a game must exceed.
STRETCH_GAMES = 90
STREAK_POINTS = 10


def team_lines(details: DataFrame, games: DataFrame) -> DataFrame:
    """Teams with their games, from details with one row per player.

    Pairs are made distinct before the join, so a game with very many details
    joins as one row per team.
    """
    return details.select("game_id", "team_id").distinct().join(games, "game_id")


def team_games(lines: DataFrame) -> DataFrame:
    """One row per team and game: (team_id, game_date, game_id, win).

    Lines may hold several rows per team and game; the grouping removes them
    with map-side combine.
    """
    home = (F.col("team_id") == F.col("home_team_id")) & (F.col("home_team_wins") == 1)
    away = (F.col("team_id") == F.col("away_team_id")) & (F.col("home_team_wins") == 0)
    won = F.when(home | away, 1).otherwise(0).cast("bigint")
    return lines.groupBy("team_id", "game_date", "game_id").agg(F.max(won).alias("win"))


def rolling_wins(
    lines: DataFrame,
    games_in_stretch: int = STRETCH_GAMES,
    n: int | None = 1,
    block_rows: int = O.BLOCK_ROWS,
) -> DataFrame:
    """Most wins of a team in consecutive games; the best n teams (None: all).

    Games are ordered by date and id.  There are few teams, so games are
    numbered with running totals instead of one window per team.
    """
    games = (
        team_games(lines)
        .withColumn("ids", O.id_range("game_id"))
        .withColumn("game", F.lit(1).cast("bigint"))
    )
    numbered = O.running_totals(
        games, ["team_id"], ["game_date", "ids"], "game_id", ["game", "win"]
    )
    rolling = O.rolling_sum(
        numbered.select("team_id", "run_game", "run_win"),
        ["team_id"], "run_game", "run_win", games_in_stretch, "wins", block_rows,
    )
    best = rolling.groupBy("team_id").agg(
        F.max("wins").alias(f"max_wins_in_{games_in_stretch}_games")
    )
    if n is None:
        return best
    return best.orderBy(
        F.desc_nulls_last(f"max_wins_in_{games_in_stretch}_games"), "team_id"
    ).limit(n)


def _join_runs(parts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One part per ``keys`` out of its consecutive parts, ordered by ``order``.

    A part is described by ``misses`` in it, hits before the first miss
    (``head``), hits after the last (``tail``; the head when there is no miss)
    and the longest run (``best``).  The number of misses so far names a run, so
    a tail and the heads that follow it meet in one group.  One shuffle by keys.
    """
    w = (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("misses").over(w), F.lit(0).cast("bigint"))
    first = F.struct(F.col("before").alias("run"), F.col("head").alias("hits"))
    last = F.struct(
        (F.col("before") + F.col("misses")).alias("run"), F.col("tail").alias("hits")
    )
    ends = F.when(F.col("misses") == 0, F.array(first)).otherwise(F.array(first, last))
    return (
        parts.withColumn("before", before)
        .select(*keys, "best", F.inline(ends))
        .groupBy(*keys, "run")
        .agg(F.sum("hits").alias("hits"), F.max("best").alias("best"))
        .groupBy(*keys)
        .agg(
            F.max("run").alias("misses"),
            F.min_by("hits", "run").alias("head"),
            F.max_by("hits", "run").alias("tail"),
            F.max(F.greatest("hits", "best")).alias("best"),
        )
    )


def longest_streak(
    details: DataFrame,
    games: DataFrame,
    players: DataFrame | None = None,
    player_name: str | None = None,
    points: float = STREAK_POINTS,
) -> DataFrame:
    """Longest run of games with more than ``points`` points, per player.

    A game counts once per player, with the player's points in it; no points
    is a miss.  Points are summed before the join with games, of which only the
    date is needed.  Games are ordered by date and id.  Runs are joined within a
    range of ids of a day, then within the day, then over the days, so that no
    task ever holds all games of a player.
    """
    by = "player_id" if "player_id" in details.columns else "player_name"
    if player_name is not None:
        if players is None:
            details = details.filter(F.col("player_name") == player_name)
        else:
            wanted = players.filter(F.col("player_name") == player_name)
            details = details.join(wanted.select("player_id"), "player_id", "left_semi")
    hit = F.when(F.col("pts") > points, 1).otherwise(0).cast("bigint")
    scores = (
        details.filter(F.col(by).isNotNull())
        .groupBy(by, "game_id")
        .agg(F.sum("pts").alias("pts"))
        .join(games.select("game_id", "game_date"), "game_id")
        .select(
            by, "game_date", O.id_range("game_id").alias("ids"), "game_id",
            (1 - hit).alias("misses"),
            *[hit.alias(c) for c in ("head", "tail", "best")],
        )
    )
    runs = _join_runs(scores, [by, "game_date", "ids"], "game_id")
    runs = _join_runs(runs, [by, "game_date"], "ids")
    longest = (
        _join_runs(runs, [by], "game_date")
        .filter("best > 0")
        .select(by, F.col("best").alias("longest_streak"))
    )
    if players is not None:
        longest = longest.join(players, "player_id", "left").select(
            "player_id", "player_name", "longest_streak"
        )
    return longest
