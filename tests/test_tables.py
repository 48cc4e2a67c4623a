"""Upserts, inserts that skip keys, snapshot overwrites."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tideframe.streaming.sinks import missing_rows_batches
from tideframe.operators import tables as B
from tideframe.operators.datelist import datelist_backfill, datelist_snapshot, datelist_step
from tideframe.sources.tables import csv_table
from tideframe.schemas import MAPS

SCHEMA = "id int, month string, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(spark, path):
    df = spark.read.schema(frame(spark).schema).parquet(path)
    return rows(df, "id", "month", "v")


def test_upsert_replaces_inserts_and_is_idempotent(spark):
    old = frame(spark, (1, "a", 1), (2, "a", 2))
    new = frame(spark, (2, "a", 20), (3, "a", 30))
    out = B.keyed_upsert(old, new, ["id", "month"])
    want = [(1, "a", 1), (2, "a", 20), (3, "a", 30)]
    assert rows(out) == want
    assert rows(B.keyed_upsert(out, new, ["id", "month"])) == want


def test_upsert_into_partitions_leaves_others_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    B.write_snapshot(frame(spark, (1, "a", 1), (2, "a", 2), (9, "b", 9)), path, "month")
    b_files = sorted(p.name for p in (tmp_path / "t" / "month=b").iterdir())
    new = frame(spark, (2, "a", 20), (3, "c", 30))
    for i in range(2):
        B.upsert_partitions(
            spark, path, new, ["id", "month"], "month", str(tmp_path / f"staging{i}")
        )
    assert stored(spark, path) == [(1, "a", 1), (2, "a", 20), (3, "c", 30), (9, "b", 9)]
    assert sorted(p.name for p in (tmp_path / "t" / "month=b").iterdir()) == b_files


def test_snapshot_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        B.write_snapshot(frame(spark, (1, "a", 1)), path, "month")
    B.write_snapshot(frame(spark, (2, "b", 2)), path, "month")
    assert stored(spark, path) == [(1, "a", 1), (2, "b", 2)]


def test_new_keys_come_once(spark):
    """As an insert that does nothing on conflict; an upsert takes one as well."""
    old = frame(spark, (1, "a", 1))
    new = frame(spark, (1, "a", 7), (2, "a", 5), (2, "a", 3), (2, "a", 3))
    assert rows(B.skip_existing(old, new, ["id", "month"])) == [(2, "a", 3)]
    assert rows(B.keyed_upsert(old, new, ["id", "month"])) == [(1, "a", 7), (2, "a", 3)]


def test_replayed_batches_add_only_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "sink")
    frame(spark, (1, "a", 1)).write.parquet(path)
    write = missing_rows_batches(
        lambda s: s.read.parquet(path), lambda df: df.write.mode("append").parquet(path), ["id", "month"]
    )
    for _ in range(2):
        write(frame(spark, (1, "a", 9), (2, "b", 2)), 0)
    assert stored(spark, path) == [(1, "a", 1), (2, "b", 2)]


def test_insert_skips_known_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    B.write_snapshot(frame(spark, (1, "a", 1)), path, "month")
    for _ in range(2):
        B.insert_missing(spark, path, frame(spark, (1, "a", 99), (2, "a", 2)), ["id"], "month")
    assert stored(spark, path) == [(1, "a", 1), (2, "a", 2)]


def test_overwrite_insert_matches_columns_by_name(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex[:8]
    frame(spark, (1, "a", 1)).write.option("path", str(tmp_path / "t")).saveAsTable(name)
    B.overwrite_table(frame(spark, (2, "b", 5)).select("v", "month", "id"), name)
    assert rows(spark.table(name)) == [(2, "b", 5)]


def test_csv_has_declared_types_and_checked_header(spark, tmp_path):
    f = tmp_path / "maps.csv"
    f.write_text("mapid,name\n1,Alpha\n2,\n")
    df = csv_table(spark, str(f), MAPS)
    assert df.schema == MAPS
    assert rows(df) == [("1", "Alpha"), ("2", None)]


def test_step_over_a_bucketed_state_does_not_shuffle_the_state(spark, tmp_path):
    name, key, lists = "state_" + uuid.uuid4().hex[:8], "device_id", "dates"
    day = [datetime(2024, 2, 1, 8) + timedelta(days=i) for i in range(4)]
    ev = spark.createDataFrame(
        [(f"d{i % 20}", day[i % 4]) for i in range(60)] + [("late", day[3])],
        "device_id string, event_time timestamp_ntz",
    )
    first = datelist_snapshot(ev, key, lists, day[1].date())
    state = B.write_bucketed(first, name, str(tmp_path / "s"), key, 8, "date")
    for d in (day[2].date(), day[3].date(), day[3].date()):
        step = datelist_step(spark.table(name), ev, key, lists, d)
        p = plan(step)
        state_side = p[p.index("SortMergeJoin"):].split(":- ", 1)[1].split("+- Exchange")[0]
        assert "FileScan" in state_side and "Bucketed: true" in state_side
        B.insert_snapshot(step, name, key, 8)
    want = datelist_backfill(ev, key, lists).filter("date >= date'2024-02-02'")
    assert rows(spark.table(name), key, lists, "date") == rows(want)
    assert state.columns == [key, lists, "date"]


def test_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        out = B.write_bucketed(
            df, "hot_" + uuid.uuid4().hex[:8], str(tmp_path / "t"), "k", 4
        )
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert out.count() == 400_000
    buckets = [f.name.rsplit("_", 1)[1][:5] for f in (tmp_path / "t").glob("part-*")]
    counts = sorted(buckets.count(b) for b in set(buckets))
    assert len(counts) == 4 and counts[-1] > 2 * counts[0]
