"""Sketches, bitmaps, robust spikes, intervals of ratios, schema drift: values and mergeability."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta
from math import sqrt
from statistics import median

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tideframe.operators import bitmaps as BM
from tideframe.operators import checks as C
from tideframe.operators import distinct as DC
from tideframe.operators import experiments as E
from tideframe.schemas import INPUTS
from tideframe.sources import drift as DR

D0 = date(2024, 1, 1)


# --- distinct counts ---------------------------------------------------------


@pytest.fixture
def lines(spark):
    i = F.col("id")
    return spark.range(0, 60_000, 1, 6).select(
        (i % 7).alias("player_id"), F.when(i % 5 != 0, i % 3).alias("team_id"), (F.lit(2000) + i % 2).alias("season"),
        F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("game_id"))


@pytest.fixture
def players(spark):
    """Two players share a name, one has none."""
    return spark.createDataFrame([(0, "a"), (1, "b"), (2, "b"), (3, "c"), (4, None), (5, "d")], "player_id long, player_name string")


def test_exact_games_per_level(lines, players):
    got = {tuple(r)[:4]: r.games for r in DC.games_per_level(lines, players).collect()}
    names = {0: "a", 1: "b", 2: "b", 3: "c", 5: "d"}
    want = {}
    for r in lines.collect():
        name, team = names.get(r.player_id, "unknown"), "unknown" if r.team_id is None else str(r.team_id)
        for key in ((DC.LEVEL, name, team, str(r.season)), ("player_name", name, *["(overall)"] * 2),
                    ("team_id", "(overall)", team, "(overall)"), ("overall", *["(overall)"] * 3)):
            want.setdefault(key, set()).add(r.game_id)
    assert got == {k: len(v) for k, v in want.items()}


def test_estimates_are_near_and_add_up(lines, players):
    """Within four standard errors, and the same from one table of sketches or two."""
    exact = {tuple(r)[:4]: r.games for r in DC.games_per_level(lines, players).collect()}
    whole = DC.game_sketches(lines)
    halves = DC.unite(DC.game_sketches(lines.filter("game_id % 2 = 0")),
                      DC.game_sketches(lines.filter("game_id % 2 = 1 or player_id = 3")))
    for sketches in (whole, halves):
        got = {tuple(r)[:4]: r.games for r in DC.estimated_games_per_level(sketches, players).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - n) <= 4 * 1.04 / 64 * n for k, n in exact.items())


def test_overall_count_is_not_one_task(lines, players):
    """The game is part of the key that levels are shuffled by first."""
    p = plan(DC.games_per_level(lines, players))
    assert any("hashpartitioning" in x and "game_id" in x and "player_name" in x for x in p.splitlines())


def test_odd_players_and_games(spark):
    """Ids that come twice, with one name or two; names that read as no name; rows without player, team or game."""
    i = F.col("id")
    lines = spark.range(0, 3000, 1, 3).select(
        F.when(i % 11 < 10, i % 11).alias("player_id"), F.when(i % 5 != 0, i % 3).alias("team_id"), (i % 2).alias("season"),
        F.when((i % 7 != 0) & (i % 11 != 7), F.pmod(F.xxhash64("id"), F.lit(90))).alias("game_id"))
    known = [(0, "a"), (0, "a"), (1, "b"), (1, "c"), (2, "unknown"), (3, None), (4, "d"), (5, "d"), (6, "e"), (7, "f"), (8, "(overall)"), (12, "g"), (None, "h")]
    want = {}
    for r in lines.collect():
        team = "unknown" if r.team_id is None else str(r.team_id)
        for name in {n or "unknown" for p, n in known if p == r.player_id and p is not None} or {"unknown"}:
            for key in ((DC.LEVEL, name, team, str(r.season)), ("player_name", name, *["(overall)"] * 2),
                        ("team_id", "(overall)", team, "(overall)"), ("overall", *["(overall)"] * 3)):
                want.setdefault(key, set()).update([] if r.game_id is None else [r.game_id])
    players = spark.createDataFrame(known, "player_id long, player_name string")
    got = {tuple(r)[:4]: r.games for r in DC.games_per_level(lines, players).collect()}
    assert got == {k: len(v) for k, v in want.items()} and 0 in got.values()
    near = {tuple(r)[:4]: r.games for r in DC.estimated_games_per_level(DC.game_sketches(lines), players).collect()}
    assert near.keys() == got.keys() and all(abs(near[k] - n) <= max(1, 4 * 1.04 / 64 * n) for k, n in got.items())


def test_teams_by_name(spark):
    """A team without a name and one named ``unknown`` are one team, also in one game of one player."""
    lines = spark.createDataFrame([(p, t, 1, g) for p in (1, 2, 3) for t in (None, "unknown", "x") for g in (7, 8)],
                                  "player_id long, team_id string, season int, game_id long")
    players = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "player_id long, player_name string")
    got = DC.games_per_level(lines, players).collect()
    assert len(got) == 2 * 2 + 2 + 2 + 1 and {r.games for r in got} == {2}


def test_pairs_are_shuffled_once_for_counts_and_sketches(spark, lines, players):
    """By player; then only sums and united sketches, by the columns they are joined on. Nothing is shuffled per level."""
    games = lines.select("game_id", "season").dropDuplicates(["game_id"])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lines.drop("season").join(games, "game_id")
        keys = ["aggregation_level", *DC.KEYS]
        estimated = DC.estimated_games_per_level(DC.game_sketches(joined), players).withColumnRenamed("games", "estimate")
        both = DC.games_per_level(joined, players).join(estimated, keys)
        assert both.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    final = plan(both).partition("Initial Plan")[0]
    by = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"(?<!\], )Exchange hashpartitioning\((.*), \d+\)", final)]
    assert [x for x in by if "aggregation_level" in x or "team_id" in x] == [", ".join(keys)] * 2
    assert len(re.findall(r"\], Exchange hashpartitioning\(player_id#\d+L, \d+\), REPARTITION", final)) == 2
    assert len(re.findall(r"(?<!\], )Exchange hashpartitioning\(player_id#\d+L, \d+\), REPARTITION", final)) == 1


# --- bitmaps -------------------------------------------------------------------


def test_active_users_of_gaps_and_buckets(spark):
    r = random.Random(2)
    events = [(r.choice([0, 1, 32_767, 32_768, 40_000, 10**9]), D0 + timedelta(days=r.choice([0, 1, 5, 6, 7, 30, 75])))
              for _ in range(60)] + [(None, D0), (5, None)]
    df = spark.createDataFrame(events, "user_id long, day date")
    got = {r.day: tuple(r)[1:] for r in BM.active_users(BM.daily_bitmaps(df)).collect()}
    known = [(u, d) for u, d in events if u is not None and d is not None]
    first, last = min(d for _, d in known), max(d for _, d in known)
    assert set(got) == {first + timedelta(days=i) for i in range((last - first).days + 1)}
    for day, counts in got.items():
        assert counts == tuple(len({u for u, d in known if day - timedelta(days=n) < d <= day}) for n in (1, 7, 28))


def test_bitmaps_of_parts_add_up(spark):
    df = spark.range(0, 5000).select(
        F.pmod(F.xxhash64("id"), F.lit(90_000)).alias("user_id"),
        F.date_add(F.lit(D0), (F.col("id") % 9).cast("int")).alias("day"))
    parts = BM.merge_bitmaps(BM.daily_bitmaps(df.filter("user_id % 3 = 0")), BM.daily_bitmaps(df.filter("user_id % 2 = 0 or user_id % 3 > 0")))
    assert rows(BM.active_users(parts)) == rows(BM.active_users(BM.daily_bitmaps(df)))


def test_events_are_never_made_distinct(spark):
    df = spark.createDataFrame([(1, D0)], "user_id long, day date")
    p = plan(BM.daily_bitmaps(df))
    assert p.count("Exchange") == 1 and "partial_bitmap_construct_agg" in p


# --- robust spikes --------------------------------------------------------------


def spiky(spark):
    """Eight weeks; a few very large Mondays hide a moderate one from a rule of deviations."""
    counts = {}
    for i in range(56):
        counts[D0 + timedelta(days=i)] = 40 + i % 7 + i % 3
    for i, n in ((14, 900), (28, 900), (35, 120)):
        counts[D0 + timedelta(days=i)] = n
    events = [("h", datetime.combine(d, datetime.min.time())) for d, n in counts.items() for _ in range(n)]
    return counts, spark.createDataFrame(events, "host string, ts timestamp_ntz")


@pytest.mark.parametrize("sketch", [False, True])
def test_planted_spikes_are_found(spark, sketch):
    counts, events = spiky(spark)
    found = {r.day for r in C.robust_spikes(events, "ts", "host", sketch).filter("is_spike").collect()}
    assert found == {D0 + timedelta(days=i) for i in (14, 28, 35)}
    by_deviation = {r.day for r in C.spikes(events, "ts", "host").filter("is_spike").collect()}
    assert D0 + timedelta(days=35) not in by_deviation


def test_medians_by_weekday(spark):
    counts, events = spiky(spark)
    for r in C.robust_spikes(events, "ts", "host").collect():
        alike = [n for d, n in counts.items() if d.weekday() == r.day.weekday()]
        m = median(alike)
        assert (r.n, r.median, r.deviation) == (counts[r.day], m, median(abs(n - m) for n in alike))


def test_null_source_is_a_source(spark):
    events = spark.createDataFrame([(None, datetime(2024, 1, 1)), (None, datetime(2024, 1, 8)), ("a", None)],
                                   "host string, ts timestamp_ntz")
    assert rows(C.robust_spikes(events, "ts", "host"), "host", "n", "is_spike") == [(None, 1, False), (None, 1, False)]


# --- experiments -------------------------------------------------------------------


def users(spark, n=600, off=()):
    r = random.Random(1)
    data = []
    for u in range(n):
        views = r.randrange(1, 9)
        data += [(u, "ABC"[u % 3] if u not in off else "A", "view")] * views
        data += [(u, "ABC"[u % 3] if u not in off else "A", "click")] * r.randrange(0, views + 1)
    return data, spark.createDataFrame(data, "user_id long, cell string, event_type string")


def test_ratio_interval_is_that_of_the_users(spark):
    data, df = users(spark)
    moments = E.ratio_moments(df, "click", "view")
    for r in E.ratio_intervals(moments).collect():
        per = {}
        for u, c, kind in data:
            if c == r.cell:
                per.setdefault(u, [0, 0])[kind == "view"] += 1
        n, x, y = len(per), sum(p[0] for p in per.values()), sum(p[1] for p in per.values())
        ratio = x / y
        var = sum((p[0] - ratio * p[1]) ** 2 for p in per.values()) / (n - 1)
        error = E.NORMAL_975 * sqrt(n * var) / y
        assert (r.users, r.ratio) == (n, ratio)
        assert r.low == pytest.approx(ratio - error) and r.high == pytest.approx(ratio + error)


def test_moments_add_up(spark):
    _, df = users(spark)
    parts = [E.ratio_moments(df.filter(f"user_id % 4 {op} 1"), "click", "view") for op in ("<=", ">")]
    assert rows(E.add_moments(parts[0].unionByName(parts[1]))) == rows(E.ratio_moments(df, "click", "view"))


def test_cells_without_views_or_with_one_user(spark):
    df = spark.createDataFrame([(1, "A", "click"), (2, "B", "view"), (3, "C", "view"), (4, "C", "view"), (4, "C", "click")],
                               "user_id long, cell string, event_type string")
    got = {r.cell: (r.users, r.ratio, r.low is None) for r in E.ratio_intervals(E.ratio_moments(df, "click", "view")).collect()}
    assert got == {"A": (1, None, True), "B": (1, 0.0, True), "C": (2, 0.5, False)}


def test_planted_imbalance_is_reported(spark):
    for off, is_off in (((), False), (set(range(1, 250, 3)), True)):
        r = E.sample_ratio(E.ratio_moments(users(spark, 600, off)[1], "click", "view")).first()
        sizes = [200 + len(off), 200 - len(off), 200]
        assert r.users == 600 and r.chi2 == pytest.approx(sum((n - 200) ** 2 / 200 for n in sizes)) and r.is_off == is_off
    none = E.sample_ratio(E.ratio_moments(users(spark)[1].filter("false"), "click", "view")).first()
    assert tuple(none) == (0, None, None)
    missing = E.sample_ratio(E.ratio_moments(users(spark)[1].filter("cell <> 'C'"), "click", "view")).first()
    assert missing.is_off and missing.users == 400


# --- schema drift ---------------------------------------------------------------------


def test_drift_is_reported_per_file(spark, tmp_path):
    """One file fits, one has a wider column, one lacks a column, one has a nested one."""
    good = spark.createDataFrame([(1, "a", 1.5, datetime(2024, 1, 1))], "id int, name string, v double, at timestamp_ntz")
    for name, df in {
        "good": good, "wide": good.withColumn("id", F.col("id").cast("bigint")), "less": good.drop("name"),
        "nested": good.withColumn("v", F.struct("v", F.array("id").alias("ids"))),
        "narrow": good.withColumn("v", F.col("v").cast("float")), "other": good.withColumn("name", F.lit(True)),
    }.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/t/{name}")
    (tmp_path / "t" / "broken.parquet").write_bytes(b"no footer")
    got = DR.schema_drift(spark, f"{tmp_path}/t", good.schema)
    name = F.when(F.col("file").contains("broken"), "broken").otherwise(F.regexp_extract("file", "t/([a-z]+)/", 1)).alias("f")
    assert rows(got.filter("status <> 'unreadable'").select(name, "column_name", "declared", "found", "status")) == sorted([
        ("wide", "id", "int", "bigint", "widened"), ("less", "name", "string", None, "missing"),
        ("nested", "v", "double", None, "missing"), ("nested", "v.v", None, "double", "unexpected"),
        ("nested", "v.ids.element", None, "int", "unexpected"), ("narrow", "v", "double", "float", "narrowed"),
        ("other", "name", "string", "boolean", "type"),
    ], key=lambda r: [(x is not None, x or "") for x in r])
    assert rows(got.filter("status = 'unreadable'").select(name)) == [("broken",)]


def test_files_of_the_tables_fit(spark):
    for t in ("orders", "events", "lineitem"):
        found = DR.schema_drift(spark, f"/root/testdata/sf0.001/{t}.parquet", INPUTS[t])
        assert rows(found, "column_name", "status") == []


@pytest.mark.parametrize("declared,found,said", [
    ("int", "bigint", "widened"), ("bigint", "int", "narrowed"), ("bigint", "decimal(20,0)", "widened"),
    ("decimal(10,2)", "decimal(12,2)", "widened"), ("decimal(10,2)", "decimal(10,4)", "type"), ("int", "double", "widened"),
    ("bigint", "double", "type"), ("date", "timestamp_ntz", "widened"), ("string", "int", "type"), ("int", "int", None),
])
def test_kinds_of_change(declared, found, said):
    assert DR.status(declared, found) == said


def test_contents_are_not_read(spark):
    p = plan(DR.schema_drift(spark, "/root/testdata/sf0.001/orders.parquet", INPUTS["orders"]))
    assert "ReadSchema: struct<path:string>" in p
