"""Hot keys: a third or more of the rows share one key, results stay whole."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tideframe.operators import datelist as D
from tideframe.functions.joins import heavy_keys, salted_join
from tideframe.operators import matches as M
from tideframe.operators import month_array as H
from tideframe.operators import rollup as U
from tideframe.operators import sessions as W
from tideframe.operators import streaks as K

N = 40_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds scaled down to the test's rows, no broadcast."""
    old = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def tables(spark, tmp_path):
    """Game 0 holds 40 % of the details; team 1 plays half of the games."""
    h = F.xxhash64("id")
    details = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 5 < 2, 0).otherwise(F.pmod(h, F.lit(3000))).alias("game_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).alias("player_id"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(30)).cast("double").alias("pts"),
    )
    games = spark.range(0, 3000).select(
        F.col("id").alias("game_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(h, F.lit(50)).cast("int")).alias("game_date"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 9).alias("home_team_id"),
        (F.lit(10) + F.col("id") % 7).alias("away_team_id"),
        (F.col("id") % 3 % 2).cast("int").alias("home_team_wins"),
    )
    details.write.parquet(str(tmp_path / "d"))
    games.write.parquet(str(tmp_path / "g"))
    return spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "g"))


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_join_with_a_hot_game_is_split(spark, small_skew, tables):
    details, games = tables
    lines = U.join_games(details, games)
    out = U.dedupe_rows(lines, ["game_id", "player_id"], ["game_date"])
    assert "skew=true" in final_plan(out)
    assert out.count() == details.select("game_id", "player_id").distinct().count()


def test_streaks_with_a_hot_game(spark, small_skew, tables):
    details, games = tables
    got = K.longest_streak(details, games)
    best = {}
    scored = (
        details.groupBy("player_id", "game_id").agg(F.sum("pts").alias("pts"))
        .join(games, "game_id").orderBy("player_id", "game_date", "game_id")
    )
    player = run = None
    for r in scored.collect():
        run = 0 if r["player_id"] != player else run
        player = r["player_id"]
        run = run + 1 if r["pts"] > 10 else 0
        best[player] = max(best.get(player, 0), run)
    assert dict(rows(got)) == {k: v for k, v in best.items() if v}


def test_hot_game_reaches_the_join_as_one_row_per_team(spark, small_skew, tables):
    details, games = tables
    teams = details.withColumn("team_id", F.lit(1).cast("bigint"))
    lines = K.team_lines(teams, games)
    assert lines.count() == details.select("game_id").distinct().count()


def test_hot_device_and_host(spark):
    events = spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("device_id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise("cold").alias("host"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("id"), F.lit(86400 * 20)))
        .cast("timestamp_ntz").alias("event_time"),
    ).withColumn("ip", F.col("device_id"))
    lists = D.datelist_snapshot(events, "device_id", "dates")
    assert lists.filter("device_id = 0").select(F.size("dates")).first()[0] == 20
    assert lists.count() == events.select("device_id").distinct().count()
    assert W.session_hits(events).agg(F.sum("num_hits")).first()[0] == N
    total = H.month_array_explode(H.host_month_array(events)).agg(F.sum("value")).first()[0]
    assert total == N


# --- heavy matches of the bucketed join -------------------------------------------


def match_tables(spark, n=N):
    """Match 0 holds a third of the medals and of the details, match 1 a tenth."""
    i = F.col("id")
    of = F.when(i % 3 == 0, 0).when(i % 10 == 1, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(2000)) + 2)
    player = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(400))
    base = spark.range(0, n, 1, 8).select(of.alias("match_id"), player.alias("player_gamertag"), "id")
    medals = base.select("match_id", "player_gamertag", (F.col("id") % 5).cast("string").alias("medal_type"))
    details = base.groupBy("match_id", "player_gamertag").agg(
        F.sum("id").cast("int").alias("player_total_kills"), F.lit(1).alias("player_total_deaths"))
    matches = base.select("match_id").distinct().select(
        "match_id", F.lit(True).alias("is_team_game"), F.lit("ranked").alias("playlist_id"),
        F.lit("2020-01-01").cast("date").alias("completion_date"), F.lit(1).alias("mapid"))
    return matches, details, medals, spark.createDataFrame([(1, "Map")], "mapid int, name string")


def run_heavy(spark, tables, tmp_path, share=0.05):
    return M.heavy_match_join(
        spark, *tables, str(tmp_path / "t"), "t" + uuid.uuid4().hex[:8], buckets=8, share=share)


def test_sketch_names_the_heavy_keys(spark):
    _, _, medals, _ = match_tables(spark)
    assert sorted(heavy_keys(medals, "match_id", 0.05)) == [0, 1]
    assert heavy_keys(medals, "match_id", 0.2) == [0]
    assert heavy_keys(medals.filter("false"), "match_id", 0.2) == []
    assert heavy_keys(medals.withColumn("match_id", F.lit(None).cast("long")), "match_id", 0.2) == []
    with pytest.raises(ValueError):
        heavy_keys(medals, "match_id", 1e-6)


def test_heavy_matches_are_spread_and_whole(spark, tmp_path):
    """Tasks of the join: the longest has at most three times the rows of the median."""
    tables = match_tables(spark)
    out = run_heavy(spark, tables, tmp_path)
    assert out.exceptAll(M.match_join(*tables)).isEmpty() and out.count() == tables[2].count()
    # the join has a session of its own; small partitions stay apart as large ones would
    out.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2] and len(sizes) >= 12


def test_other_matches_stay_in_their_buckets(spark, tmp_path):
    """Only the heavy ones are shuffled; without such matches nothing is."""
    tables = match_tables(spark, 3000)
    p = plan(run_heavy(spark, tables, tmp_path))
    assert p.count("Exchange hashpartitioning") == 2 and p.count("SelectedBucketsCount: 8 out of 8") == 3
    p = plan(run_heavy(spark, tables, tmp_path, share=0.9))
    assert "Exchange hashpartitioning" not in p


def test_salted_join_keeps_every_row(spark):
    left = spark.createDataFrame([(1, "a")] * 50 + [(2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, w string")
    assert rows(salted_join(left, right, ["k"], 7)) == rows(left.join(right, "k"))
