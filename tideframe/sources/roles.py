"""The roles of the operators' inputs, filled from the Parquet tables.

Plain projections, joins on keys and, where a role has a coarser grain, one
aggregation.  Keys keep the numeric type of their table, which is cheaper to
shuffle than text.  No join carries a hint: Spark broadcasts a dimension when its
size allows and otherwise shuffles, with AQE splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.sources.tables import parquet_table


def actor_films(spark: SparkSession, folder: str) -> DataFrame:
    """Films without the actor's name, which ``actor_names`` holds once."""
    key = F.col("o_orderkey")
    return parquet_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("actorid"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("order-"), key.cast("string")).alias("film"),
        (key % 1000).cast("int").alias("votes"),
        (F.col("o_totalprice") / 50000).alias("rating"),
        key.cast("string").alias("filmid"),
    )


def actor_names(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("actorid"), F.col("c_name").alias("actor")
    )


def web_events(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "events").select(
        F.col("user_id").alias("device_id"),
        F.col("user_id").alias("ip"),
        F.col("event_type").alias("host"),
        F.col("ts").alias("event_time"),
    )


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Years of events: the orders of a customer with one priority are a device's."""
    return parquet_table(spark, folder, "orders").select(
        F.concat_ws("-", "o_custkey", F.substring("o_orderpriority", 1, 1)).alias("device_id"),
        F.col("o_custkey").alias("ip"),
        F.col("o_orderpriority").alias("host"),
        F.col("o_orderdate").alias("event_time"),
    )


def last_arrival(events: DataFrame) -> Column:
    """The last day on which a device was seen for the first time."""
    first = events.groupBy("device_id").agg(F.min(F.to_date("event_time")).alias("d"))
    return first.agg(F.max("d").alias("d")).scalar()


def player_days(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date("ts")
    return parquet_table(spark, folder, "events").select(
        F.col("user_id").alias("player_name"),
        day.alias("effective_date"),
        F.year(day).alias("current_season"),
    )


def games(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_table(spark, folder, "orders")
    customer = parquet_table(spark, folder, "customer")
    status = F.col("o_orderstatus")
    return orders.join(
        customer, orders["o_custkey"] == customer["c_custkey"]
    ).select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        F.year("o_orderdate").alias("season"),
        F.col("c_nationkey").cast("bigint").alias("home_team_id"),
        ((F.col("c_nationkey") + 1) % 25).cast("bigint").alias("away_team_id"),
        F.when(status == "F", 1).when(status == "O", 0).alias("home_team_wins"),
    )


def game_days(spark: SparkSession, folder: str) -> DataFrame:
    """Games where only their date matters: no join."""
    return parquet_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.to_date("o_orderdate").alias("game_date")
    )


def player_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Details where only the player matters: no join."""
    return parquet_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_partkey").alias("player_id"),
        F.col("l_quantity").alias("pts"),
    )


def _with_team(lines: DataFrame, games: DataFrame) -> DataFrame:
    return (
        lines.join(games, "game_id")
        .withColumn(
            "team_id",
            F.when(F.col("at_home"), F.col("home_team_id")).otherwise(F.col("away_team_id")),
        )
        .drop("at_home")
    )


def game_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Details joined with their games, one row per detail; players by id."""
    lines = parquet_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_partkey").alias("player_id"),
        F.col("l_quantity").alias("pts"),
        (F.col("l_linenumber") % 2 == 1).alias("at_home"),
    )
    return _with_team(lines, games(spark, folder))


def game_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Teams with their games: sides are made distinct before the join, so a
    game with very many details joins as two rows."""
    sides = (
        parquet_table(spark, folder, "lineitem")
        .select(
            F.col("l_orderkey").alias("game_id"),
            (F.col("l_linenumber") % 2 == 1).alias("at_home"),
        )
        .distinct()
    )
    return _with_team(sides, games(spark, folder))


def players(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return parquet_table(spark, folder, "part").select(
        key.alias("player_id"),
        F.concat("p_name", F.lit("#"), key.cast("string")).alias("player_name"),
    )


def matches(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_table(spark, folder, "orders")
    customer = parquet_table(spark, folder, "customer")
    day = F.to_date("o_orderdate")
    return orders.join(
        customer, orders["o_custkey"] == customer["c_custkey"]
    ).select(
        F.col("o_orderkey").alias("match_id"),
        (F.col("o_orderstatus") == "F").alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        day.alias("completion_date"),
        F.col("c_nationkey").alias("mapid"),
    )


def match_details(spark: SparkSession, folder: str) -> DataFrame:
    """One row per match and player."""
    return (
        parquet_table(spark, folder, "lineitem")
        .groupBy(
            F.col("l_orderkey").alias("match_id"),
            F.col("l_suppkey").alias("player_gamertag"),
        )
        .agg(
            F.sum("l_quantity").cast("int").alias("player_total_kills"),
            F.sum("l_linenumber").cast("int").alias("player_total_deaths"),
        )
    )


def medals_matches_players(spark: SparkSession, folder: str) -> DataFrame:
    """One row per medal awarded."""
    lines = parquet_table(spark, folder, "lineitem")
    part = parquet_table(spark, folder, "part")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"]).select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("player_gamertag"),
        F.col("p_type").alias("medal_type"),
    )


def maps(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("mapid"),
        F.col("n_name").alias("name"),
    )


def medals(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("medal_id"),
        F.col("s_nationkey").alias("mapid"),
    )


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day")
    )


def customer_profit(spark: SparkSession, folder: str) -> DataFrame:
    """(c_custkey, month, profit).

    Amounts are summed per order before the join with orders: hot orders leave
    each map task as a few rows.
    """
    amount = F.col("l_extendedprice").cast("decimal(18,2)") * (
        F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    )
    per_order = (
        parquet_table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(amount).alias("profit"))
    )
    return (
        per_order.join(parquet_table(spark, folder, "orders"), "o_orderkey")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"),
            F.trunc(F.to_date("o_orderdate"), "MM").alias("month"),
        )
        .agg(F.sum("profit").alias("profit"))
    )


def order_profit(spark: SparkSession, folder: str) -> DataFrame:
    """(segment, month, profit) per customer and month."""
    customer = parquet_table(spark, folder, "customer")
    return customer_profit(spark, folder).join(customer, "c_custkey").select(
        F.col("c_mktsegment").alias("segment"), "month", "profit"
    )
