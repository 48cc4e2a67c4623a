"""Match joins: grain, layout, hot matches, reports."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tideframe.operators import matches as M
from tideframe.operators.tables import write_bucketed
from tideframe.session import work_folder


@pytest.fixture
def roles(spark):
    matches = spark.createDataFrame(
        [("m1", True, "ranked", date(2020, 1, 1), "x"), ("m2", False, "ranked", date(2020, 1, 2), "y"),
         ("m3", False, "social", date(2020, 1, 2), "y"), ("empty", False, "social", date(2020, 1, 2), "y")],
        "match_id string, is_team_game boolean, playlist_id string, completion_date date, mapid string",
    )
    details = spark.createDataFrame(
        [("m1", "a", 10, 1), ("m1", "b", 2, 1), ("m2", "a", 4, 1), ("m3", "b", 6, 1), ("empty", "c", 9, 9)],
        "match_id string, player_gamertag string, player_total_kills int, player_total_deaths int",
    )
    medals = spark.createDataFrame(
        [("m1", "a", "Killing Spree"), ("m1", "a", "Killing Spree"), ("m1", "a", "Other"),
         ("m1", "b", "Other"), ("m2", "a", "Other"), ("m3", "b", "Killing Spree"),
         ("m3", "nobody", "Killing Spree")],
        "match_id string, player_gamertag string, medal_type string",
    )
    maps = spark.createDataFrame([("x", "Map X"), ("y", "Map Y")], "mapid string, name string")
    return matches, details, medals, maps


def test_medals_join_their_own_player_only(spark, roles):
    out = M.match_join(*roles)
    assert rows(out, "match_id", "player_gamertag", "player_total_kills", "medal_type") == [
        ("m1", "a", 10, "Killing Spree"), ("m1", "a", 10, "Killing Spree"),
        ("m1", "a", 10, "Other"), ("m1", "b", 2, "Other"), ("m2", "a", 4, "Other"),
        ("m3", "b", 6, "Killing Spree"),
    ]


def test_reports_do_not_count_medals(spark, roles):
    played = M.played(*roles)
    assert rows(M.avg_kills_per_player(played)) == [("a", 7.0), ("b", 4.0)]
    assert rows(M.most_played(played, ["playlist_id"])) == [("ranked", 2), ("social", 1)]
    assert rows(M.most_played(played, ["mapid", "map_name"])) == [
        ("x", "Map X", 1), ("y", "Map Y", 2)
    ]
    assert rows(M.killing_sprees(played)) == [("x", "Map X", 2), ("y", "Map Y", 1)]


def test_reports_are_ranked(spark, roles):
    report = M.avg_kills_per_player(M.played(*roles))
    ranked = report.collect()
    assert [r[0] for r in ranked] == ["a", "b"]
    local = M.locally_sorted(report, "avg_kills_per_game")
    assert rows(local) == [("a", 7.0), ("b", 4.0)]
    assert "rangepartitioning" in plan(local)


def test_small_map_is_broadcast_with_automatic_broadcast_off(spark, roles):
    medals = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "none")], "medal_id string, mapid string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = M.medals_with_maps(medals, roles[3])
        assert "BroadcastHashJoin" in plan(out)
        assert rows(out, "medal_id", "map_name") == [("1", "Map X"), ("2", "Map Y")]
        from tideframe.functions.joins import broadcast_if_small

        big = medals.join(broadcast_if_small(roles[3], max_rows=1), "mapid")
        assert "BroadcastHashJoin" not in plan(big)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _bucketed(spark, roles, **kw):
    name = "t" + uuid.uuid4().hex[:8]
    return M.bucketed_match_join(spark, *roles, work_folder(spark, "b"), name, **kw)


def test_bucketed_join_has_no_hash_exchange(spark, roles):
    matches, details, medals, maps = roles
    matches = matches.withColumn("completion_year", F.year("completion_date"))
    spread = [(f"g{i}", "p", "Other") for i in range(50)]
    medals = medals.unionByName(spark.createDataFrame(spread, medals.schema))
    scores = [(g, p, 1, 1) for g, p, _ in spread]
    details = details.unionByName(spark.createDataFrame(scores, details.schema))
    out = _bucketed(spark, (matches, details, medals, maps), buckets=4, partition_by="completion_year")
    p = plan(out)
    assert "hashpartitioning" not in p and p.count("SortMergeJoin") == 2
    assert "match_details_bucketed" in p
    assert rows(out) == rows(M.match_join(*roles))


def test_hot_match_is_in_the_bucketed_join_too(spark, roles):
    matches, details, medals, maps = roles
    hot = medals.unionByName(
        spark.range(1000).select(
            F.lit("m1").alias("match_id"), F.lit("b").alias("player_gamertag"),
            F.lit("Other").alias("medal_type"),
        )
    )
    out = _bucketed(spark, (matches, details, hot, maps), buckets=4)
    assert "match_details_bucketed" in plan(out)
    assert out.count() == M.match_join(matches, details, hot, maps).count() == 1006


def test_same_prefix_overwrites(spark, roles):
    folder = work_folder(spark, "b")
    before = len(spark.catalog.listTables())
    for _ in range(2):
        out = M.bucketed_match_join(spark, *roles, folder, "again", buckets=2)
    assert rows(out) == rows(M.match_join(*roles))
    assert len(spark.catalog.listTables()) == before + 3


def test_rewriting_a_bucketed_table_does_not_double_it(spark, roles):
    path, name = work_folder(spark, "sink"), "sink_" + uuid.uuid4().hex[:8]
    joined = M.match_join(*roles)
    for _ in range(2):
        out = write_bucketed(joined, name, path, "match_id", 4, "completion_date")
    assert rows(out, *joined.columns) == rows(joined)
