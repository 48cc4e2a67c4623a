"""Data-quality checks."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from tideframe.operators import checks as C
from tideframe.session import work_folder

D0 = date(2024, 1, 1)


def daily(spark, counts):
    data = [
        (datetime(2024, 1, 1, 1) + timedelta(days=i),)
        for i, n in enumerate(counts) for _ in range(n)
    ]
    return spark.createDataFrame(data, "ts timestamp_ntz")


def test_freshness_and_missing_days(spark):
    df = daily(spark, [1, 0, 2, 0, 0, 1])
    assert rows(C.freshness(df, "src", "ts", date(2024, 1, 8))) == [
        ("src", date(2024, 1, 6), 2, 3)
    ]
    assert rows(C.missing_days(df, "ts")) == [
        (D0 + timedelta(days=i),) for i in (1, 3, 4)
    ]
    assert C.missing_days(daily(spark, []), "ts").count() == 0


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, None, "z")], "a int, b string, extra string")
    declared = T.StructType.fromDDL("a long, b string, c date")
    assert rows(C.schema_differences(df, declared, "t"), "column_name", "status", "null_rows") == [
        ("a", "type", 0), ("b", "ok", 1), ("c", "missing", None), ("extra", "unexpected", 0)
    ]


def test_unique_key(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    assert rows(C.unique_key_violations(df, ["a", "b"])) == [(1, None, 2)]


def test_domain_counts_null_as_outside(spark):
    df = spark.createDataFrame([("star",), ("bad",), ("Good",), (None,)], "q string")
    assert rows(C.domain(df, "q", ["star", "bad"])) == [("q", 4, 2, 0.5)]


def test_spikes_need_a_full_week_before(spark):
    out = C.spikes(daily(spark, [10, 12, 11, 9, 10, 11, 10, 40, 10]), "ts")
    assert [d for d, s in rows(out, "day", "is_spike") if s] == [D0 + timedelta(days=7)]
    assert rows(out, "day", "trailing_mean")[6][1] is None


def test_work_folder_without_a_checkpoint_folder_is_under_the_warehouse():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://x/warehouse"}.get(key, default)

    class Session:
        conf = Conf()

    assert work_folder(Session(), "x").startswith("hdfs://x/warehouse/_work/x-")


def test_work_folder_lies_in_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a.startswith(base) and a != b
