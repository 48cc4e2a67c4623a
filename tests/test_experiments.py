"""Experiment metrics and totals on hand-made rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tideframe.operators import experiments as E


def events(spark):
    d = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)]
    return E.allocate(
        spark.createDataFrame(
            [(0, "view", d[0]), (0, "click", d[0]), (0, "view", d[1]), (3, "view", d[0]),
             (3, "view", d[2]), (1, "purchase", d[0]), (4, "view", d[0])],
            "user_id long, event_type string, day date",
        )
    )


def test_allocation_is_stable_and_counts_users_once(spark):
    assert rows(E.allocation(events(spark))) == [("A", 2, 5), ("B", 2, 2)]
    ids = spark.range(3000).withColumnRenamed("id", "user_id")
    salted = E.allocate(ids, "news").groupBy("cell").count()
    assert all(n > 850 for _, n in rows(salted)) and salted.count() == 3
    other = E.allocate(ids, "jobs").join(
        E.allocate(ids, "news").withColumnRenamed("cell", "c2"), "user_id"
    )
    assert 800 < other.filter(F.col("cell") == F.col("c2")).count() < 1200


def test_click_through(spark):
    assert rows(E.click_through(events(spark))) == [("A", 1, 4, 0.25), ("B", 0, 1, 0.0)]


def test_retention_is_the_next_day_only(spark):
    got = rows(E.dau_retention(events(spark)).filter("cell = 'A'"), "day", "dau", "retained")
    assert got == [(date(2024, 1, 30), 2, 1), (date(2024, 1, 31), 1, 0), (date(2024, 2, 1), 1, 0)]


def test_conversion(spark):
    assert rows(E.conversion(events(spark), "purchase")) == [("A", 2, 0, 0.0), ("B", 2, 1, 0.5)]


def test_engagement(spark):
    assert rows(E.engagement(events(spark))) == [
        (date(2024, 1, 1), 6, 4, 1.5), (date(2024, 2, 1), 1, 1, 1.0)
    ]


def test_profit_totals(spark):
    m = [date(2024, 1, 1), date(2024, 2, 1)]
    df = spark.createDataFrame(
        [("a", m[0], Decimal("1.10")), ("a", m[0], Decimal("2.20")), ("b", m[1], Decimal("5.00"))],
        "segment string, month date, profit decimal(20,2)",
    )
    assert [(s, float(p)) for s, _, p in rows(E.profit_by_unit(df))] == [("a", 3.3), ("b", 5.0)]
    assert [(d, float(p), t) for d, p, t in rows(E.profit_total(df))] == [
        (None, 8.3, 1), (m[0], 3.3, 0), (m[1], 5.0, 0)
    ]
