"""Distinct counts over grouping sets: exact, and from sketches that add up.

Both start from the distinct (group, game) pairs, shuffled once by player: most
groups have so few games that their sketches are larger than the games.  What
comes after is added up before it is shuffled, by the columns of the result, so
that counts and estimates can be joined as they lie.  Sketches stored per day or
season are united to any coarser level later without another look at the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideframe.operators.rollup import LEVEL, OVERALL, UNKNOWN

KEYS = ["player_name", "team_id", "season"]
#: Logarithm of a sketch's registers; the standard error is 1.04 / 2^(LG_K / 2), 1.6 %.
LG_K = 12
#: The keys each level keeps; the others are ``(overall)``.
LEVELS = {LEVEL: KEYS, "player_name": ["player_name"], "team_id": ["team_id"], "overall": []}


def _pairs(lines: DataFrame) -> DataFrame:
    """Distinct games of each finest group."""
    return lines.select("player_id", "team_id", "season", "game_id").distinct()


def _text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(UNKNOWN)).alias(key)


def _named(rows: DataFrame, players: DataFrame) -> DataFrame:
    """Names beside player ids, and NULL keys as ``unknown``."""
    joined = rows.join(players, "player_id", "left")
    return joined.select(*[_text(k) for k in KEYS], *[c for c in joined.columns if c not in KEYS])


def _at(level: str) -> list[Column]:
    """The level and its keys, as the result has them."""
    return [F.lit(level).alias("aggregation_level"),
            *[(F.col(k) if k in LEVELS[level] else F.lit(OVERALL)).alias(k) for k in KEYS]]


def _counted(
    rows: DataFrame, known: Column, of: list[str], by: list[str], finer: str, coarser: str, only: str = "true"
) -> DataFrame:
    """(level, keys, n) of two levels: 1 for the first row with a ``known`` game ``of`` a group, by ``by`` also within it.

    Rows are left to ``only`` some after the window: a join that drops players
    would shuffle its own pairs, not those of the sketches.
    """
    w = Window.partitionBy(*of).orderBy(*by)
    row = F.row_number().over(w)
    return rows.withColumns({"finer": known & (row == F.rank().over(w)), "coarser": known & (row == 1)}).filter(only).select(
        F.inline(F.array(
            F.struct(*_at(finer), F.col("finer").cast("bigint").alias("n")),
            F.struct(*_at(coarser), F.col("coarser").cast("bigint").alias("n")))))


def games_per_level(lines: DataFrame, players: DataFrame) -> DataFrame:
    """(aggregation_level, keys, games): distinct games, exactly.

    Pairs are at hand by player id, which is enough for a name that is nobody
    else's; those of shared and unknown names are shuffled by name and game.  A
    count is then a sum of rows, added up where they lie: no level, not even the
    overall one, is counted by one task.
    """
    pairs, known = _pairs(lines), F.col("game_id").isNotNull()
    name = F.col("player_name").cast("string")
    alone = (name != UNKNOWN) & (F.count(F.lit(1)).over(Window.partitionBy(name)) == 1)
    named = _named(pairs.repartition("player_id"), players.withColumn("is_alone", alone))
    shared = named.filter(~F.coalesce("is_alone", F.lit(False))).select(*KEYS, "game_id").repartition("player_name", "game_id")
    # The pairs are counted, which keeps Spark from pruning them and shuffling the lines once more for the teams.
    sides = pairs.groupBy(_text("team_id"), "game_id").agg(F.count("game_id").alias("pairs"))
    return _counted(
        named, known, ["player_id", "player_name", "game_id"], ["team_id", "season"], LEVEL, "player_name", "is_alone"
    ).unionByName(
        _counted(shared, known, ["player_name", "game_id"], ["team_id", "season"], LEVEL, "player_name")
    ).unionByName(
        _counted(sides, F.col("pairs") > 0, ["game_id"], ["team_id"], "team_id", "overall")
    ).groupBy("aggregation_level", *KEYS).agg(F.sum("n").alias("games"))


def game_sketches(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(player_id, team_id, season, sketch): a mergeable sketch of each finest group's games."""
    return _pairs(lines).repartition("player_id").groupBy("player_id", "team_id", "season").agg(
        F.hll_sketch_agg("game_id", lg_k).alias("sketch"))


def unite(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Two tables of sketches as one; a game in both counts once."""
    keys = ["player_id", "team_id", "season"]
    return older.unionByName(newer).groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_games_per_level(sketches: DataFrame, players: DataFrame) -> DataFrame:
    """``games_per_level`` as estimates, from sketches alone."""
    level = F.explode(F.array(*[F.struct(*_at(x)) for x in LEVELS])).alias("level")
    return _named(sketches, players).select(level, "sketch").select("level.*", "sketch").groupBy(
        "aggregation_level", *KEYS).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("games"))
