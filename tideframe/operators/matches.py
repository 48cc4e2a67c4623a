"""Joins over match data: broadcast, bucketed, and the reports on top."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions.joins import broadcast_if_small, heavy_keys, salted_join
from tideframe.operators.tables import write_bucketed

# Fixed value.
KILLING_SPREE = "Killing Spree"

PLAYER_KEY = ["match_id", "player_gamertag"]


def medals_with_maps(medals: DataFrame, maps: DataFrame) -> DataFrame:
    """Medals joined with their map, which is broadcast after a size check."""
    return medals.join(broadcast_if_small(maps), "mapid").withColumnRenamed(
        "name", "map_name"
    )


def match_join(
    matches: DataFrame, details: DataFrame, medals: DataFrame, maps: DataFrame
) -> DataFrame:
    """One row per medal with its match, player and map.

    A medal joins the details of its own player, so a match does not multiply
    players with medals.
    """
    return _described(medals.join(details, PLAYER_KEY).join(matches, "match_id"), maps)


def _described(awarded: DataFrame, maps: DataFrame) -> DataFrame:
    return awarded.join(broadcast_if_small(maps), "mapid").select(
        "match_id", "is_team_game", "playlist_id", "completion_date",
        "player_gamertag", "player_total_kills", "player_total_deaths",
        "medal_type", "mapid", F.col("name").alias("map_name"),
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed_match_join(
    spark: SparkSession,
    matches: DataFrame,
    details: DataFrame,
    medals: DataFrame,
    maps: DataFrame,
    folder: str,
    prefix: str,
    buckets: int | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """match_join over three tables bucketed by match_id: no shuffle to join.

    A bucket is joined by one task.  ``buckets`` defaults to the session's
    shuffle partitions; choose it so that a bucket is about 1 GB.  Where single
    matches may outgrow that, use match_join, whose shuffles AQE splits.
    The tables are overwritten by every call with the same ``prefix``.
    """
    stored = _bucketed(spark, matches, details, medals, folder, prefix, buckets, partition_by)
    return match_join(*stored, maps)


def _bucketed(
    spark: SparkSession, matches: DataFrame, details: DataFrame, medals: DataFrame,
    folder: str, prefix: str, buckets: int | None, partition_by: str | None,
) -> list[DataFrame]:
    """The three tables written in buckets of match_id and read back."""
    buckets = buckets or shuffle_partitions(spark)
    # Settings of this join only: no automatic broadcast, and buckets of
    # match_id also serve the join on (match_id, player_gamertag).
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    stored = []
    for name, df, part in [
        ("matches", matches, partition_by),
        ("match_details", details, None),
        ("medals_matches_players", medals, None),
    ]:
        table = f"{prefix}_{name}_bucketed"
        write_bucketed(df, table, f"{folder}/{name}_bucketed", "match_id", buckets, part)
        stored.append(own.table(table))
    return stored


#: Share of the rows from which a match counts as heavy: a hundredth.
HEAVY = 0.01


def heavy_match_join(
    spark: SparkSession,
    matches: DataFrame,
    details: DataFrame,
    medals: DataFrame,
    maps: DataFrame,
    folder: str,
    prefix: str,
    buckets: int | None = None,
    partition_by: str | None = None,
    share: float = HEAVY,
) -> DataFrame:
    """``bucketed_match_join`` for tables in which single matches outgrow a bucket.

    Matches with at least ``share`` of the medals or of the details are stored
    beside the buckets and joined through salts, each spread over as many parts
    as there are buckets.  They are at most 2 / share, found by a sketch.  All
    other matches stay in buckets and are joined without a shuffle.
    """
    heavy = sorted({*heavy_keys(medals, "match_id", share), *heavy_keys(details, "match_id", share)})
    is_heavy = F.col("match_id").isin(heavy)
    rest = [df.filter(~is_heavy) for df in (matches, details, medals)]
    stored = _bucketed(spark, *rest, folder, prefix, buckets, partition_by)
    joined = match_join(*stored, maps)
    if not heavy:
        return joined
    own = stored[0].sparkSession
    apart = []
    for name, df in (("matches", matches), ("match_details", details), ("medals_matches_players", medals)):
        path = f"{folder}/{name}_heavy"
        df.filter(is_heavy).write.mode("overwrite").parquet(path)
        apart.append(own.read.schema(df.schema).parquet(path))
    few, players, awarded = apart
    pairs = salted_join(awarded, players, PLAYER_KEY, buckets or shuffle_partitions(spark))
    return joined.unionByName(_described(pairs.join(broadcast_if_small(few), "match_id"), maps))


def played(
    matches: DataFrame,
    details: DataFrame,
    medals: DataFrame,
    maps: DataFrame,
    medal: str = KILLING_SPREE,
) -> DataFrame:
    """One row per match and player that the full join keeps, for all reports.

    match_id, player_gamertag, player_total_kills, sprees, playlist_id, mapid,
    map_name.  Medals are counted per match and player before the join, so it
    never multiplies rows, however many medals a player has.
    """
    per_player = medals.groupBy(*PLAYER_KEY).agg(
        F.count_if(F.col("medal_type") == medal).alias("sprees")
    )
    known = matches.join(broadcast_if_small(maps), "mapid").select(
        "match_id", "playlist_id", "mapid", F.col("name").alias("map_name")
    )
    return (
        details.select(*PLAYER_KEY, "player_total_kills")
        .join(per_player, PLAYER_KEY)
        .join(known, "match_id")
    )


def avg_kills_per_player(rows: DataFrame) -> DataFrame:
    """Average kills per match, of ``played``."""
    return _ranked(
        rows.groupBy("player_gamertag").agg(
            F.avg("player_total_kills").alias("avg_kills_per_game")
        ),
        "avg_kills_per_game",
    )


def most_played(rows: DataFrame, by: list[str]) -> DataFrame:
    """Matches per playlist or map, most played first, of ``played``.

    Match ids are made distinct first, with map-side combine, so a match with
    very many players counts as one row.
    """
    return _ranked(
        rows.select("match_id", *by).distinct().groupBy(*by)
        .agg(F.count(F.lit(1)).alias("matches_played")),
        "matches_played",
    )


def killing_sprees(rows: DataFrame) -> DataFrame:
    """Killing-spree medals per map, of ``played``; a map played without any shows 0."""
    return _ranked(
        rows.groupBy("mapid", "map_name").agg(F.sum("sprees").alias("total_killing_spree_medals")),
        "total_killing_spree_medals",
    )


def _ranked(df: DataFrame, by: str) -> DataFrame:
    ties = [c for c in df.columns if c != by]
    return df.orderBy(F.desc_nulls_last(by), *ties)


def locally_sorted(report: DataFrame, by: str) -> DataFrame:
    """The report laid out for a write: ranges of ``by``, sorted within files.

    sortWithinPartitions alone orders each partition only; the range partition
    before it makes the files follow each other as well.
    """
    ties = [c for c in report.columns if c != by]
    order = [F.desc_nulls_last(by), *ties]
    return report.repartitionByRange(*order).sortWithinPartitions(*order)
