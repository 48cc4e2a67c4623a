"""Metrics of experiments with three cells, and business totals by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideframe.functions import expressions as X

# The cells of an experiment; A is the control.
CELLS = ["A", "B", "C"]


def cell(user: Column, salt: str | None = None) -> Column:
    """Cell of a user: a hash with the experiment's salt, or the id itself."""
    code = user if salt is None else F.xxhash64(user, F.lit(salt))
    n = F.pmod(code, F.lit(len(CELLS)))
    return F.get(F.array(*[F.lit(c) for c in CELLS]), n.cast("int"))


def allocate(events: DataFrame, salt: str | None = None) -> DataFrame:
    return events.withColumn("cell", cell(F.col("user_id"), salt))


def allocation(events: DataFrame) -> DataFrame:
    """Users and events per cell; users are made distinct before counting."""
    per_user = events.groupBy("cell", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("cell").agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("events")
    )


def click_through(events: DataFrame) -> DataFrame:
    """Clicks per view and cell."""
    n = events.groupBy("cell").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    return n.withColumn("ctr", F.col("clicks") / F.nullif("views", F.lit(0)))


def dau_retention(events: DataFrame) -> DataFrame:
    """Active users per cell and day, and the share that is back a day later.

    Days are distinct per user first, so the window has at most one row per
    user and day of the calendar.
    """
    days = events.select("cell", "user_id", "day").distinct()
    w = Window.partitionBy("cell", "user_id").orderBy("day")
    back = F.lead("day").over(w) == F.date_add("day", 1)
    return (
        days.withColumn("back", F.coalesce(back, F.lit(False)))
        .groupBy("cell", "day")
        .agg(F.count(F.lit(1)).alias("dau"), F.count_if("back").alias("retained"))
        .withColumn("retention", F.col("retained") / F.col("dau"))
    )


def conversion(events: DataFrame, target: str) -> DataFrame:
    """Share of a cell's users with at least one target event."""
    per_user = events.groupBy("cell", "user_id").agg(
        F.bool_or(F.col("event_type") == target).alias("converted")
    )
    return (
        per_user.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("users"), F.count_if("converted").alias("converted"))
        .withColumn("conversion", F.col("converted") / F.col("users"))
    )


def profit_by_unit(profit: DataFrame) -> DataFrame:
    """Profit per (segment, month)."""
    return profit.groupBy("segment", "month").agg(F.sum("profit").alias("profit"))


def profit_total(profit: DataFrame) -> DataFrame:
    """Profit per month and overall (month NULL)."""
    monthly = profit.groupBy("month").agg(F.sum("profit").alias("profit"))
    return monthly.rollup("month").agg(
        F.sum("profit").alias("profit"), F.grouping("month").cast("int").alias("is_total")
    )


def growth_total(daily: DataFrame) -> DataFrame:
    """Per day: active, new, returned and lost entities, and the net change.

    ``daily`` has entities per date and daily state (growth.growth_counts).
    """

    def entities(*states: str) -> Column:
        named = F.col("daily_active_state").isin(*states)
        return F.sum(F.when(named, F.col("entities")).otherwise(0))

    return (
        daily.groupBy("date")
        .agg(
            entities(X.NEW, X.CONTINUED, X.RETURNED).alias("active"),
            entities(X.NEW).alias("new"),
            entities(X.RETURNED).alias("returned"),
            entities(X.RETIRED).alias("lost"),
        )
        .withColumn("net_change", F.col("new") + F.col("returned") - F.col("lost"))
    )


def engagement(events: DataFrame) -> DataFrame:
    """Events, active users and events per user by month."""
    per_user = events.groupBy(F.trunc("day", "MM").alias("month"), "user_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        per_user.groupBy("month")
        .agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("active_users"))
        .withColumn("events_per_user", F.col("events") / F.col("active_users"))
    )


# 97.5 % of the normal distribution; 99.9 % of chi-square with two
# degrees of freedom, those of three cells.
NORMAL_975 = 1.959963984540054
CHI2_999 = 13.815510557964274

#: The sums from which a ratio's interval follows; they add up over parts.
MOMENTS = ["users", "x", "y", "xx", "yy", "xy"]


def ratio_moments(events: DataFrame, top: str, bottom: str) -> DataFrame:
    """(cell, users, x, y, xx, yy, xy): sums over users of their counts of two event types.

    Users are the unit that was assigned, so events of one user are added up
    before anything is squared.  The sums are whole numbers: parts of the data
    whose users differ may be added in any order.
    """
    per_user = events.groupBy("cell", "user_id").agg(
        F.count_if(F.col("event_type") == top).alias("x"), F.count_if(F.col("event_type") == bottom).alias("y"))
    x, y = F.col("x"), F.col("y")
    return per_user.groupBy("cell").agg(
        F.count(F.lit(1)).alias("users"), F.sum(x).alias("x"), F.sum(y).alias("y"),
        F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy"), F.sum(x * y).alias("xy"))


def add_moments(parts: DataFrame) -> DataFrame:
    """Moments of parts with different users as those of the whole."""
    return parts.groupBy("cell").agg(*[F.sum(m).alias(m) for m in MOMENTS])


def ratio_intervals(moments: DataFrame) -> DataFrame:
    """(cell, users, ratio, low, high): x / y with its 95 % interval by the delta method.

    The variance of a ratio of sums over users; NULL for a cell without ``y``
    or with one user.
    """
    n, x, y = (F.col(c).cast("double") for c in ("users", "x", "y"))
    xx, yy, xy = (F.col(c).cast("double") for c in ("xx", "yy", "xy"))
    ratio = x / F.nullif(y, F.lit(0.0))
    # sums of squared deviations of x - ratio * y, whose mean is 0
    spread = (xx - 2 * ratio * xy + ratio * ratio * yy) / F.nullif(n - 1, F.lit(0.0))
    error = F.sqrt(F.when(spread < 0, 0.0).otherwise(spread) * n) / y
    return moments.select(
        "cell", "users", ratio.alias("ratio"),
        (ratio - NORMAL_975 * error).alias("low"), (ratio + NORMAL_975 * error).alias("high"))


def sample_ratio(moments: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """(users, chi2, is_off): whether the cells' sizes fit the shares they were given.

    Three equal cells by default.  A cell that nobody is in counts with 0 users.
    ``is_off`` at a chance of one in a thousand, for three cells.
    """
    shares = shares or dict.fromkeys(CELLS, 1 / len(CELLS))
    sizes = [F.coalesce(F.sum(F.when(F.col("cell") == c, F.col("users"))), F.lit(0)).alias(f"n_{c}") for c in shares]
    one = moments.agg(*sizes)
    total = sum((F.col(f"n_{c}") for c in shares), F.lit(0))
    terms = [(F.col(f"n_{c}") - total * p) * (F.col(f"n_{c}") - total * p) / F.nullif(total * p, F.lit(0.0))
             for c, p in shares.items()]
    chi2 = sum(terms[1:], terms[0])
    return one.select(
        total.cast("bigint").alias("users"), chi2.alias("chi2"), (chi2 > CHI2_999).alias("is_off"))
