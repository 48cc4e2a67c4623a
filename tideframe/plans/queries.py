"""The registered queries: operators over the roles of the Parquet tables.

Each takes (spark, folder) and reads its whole tables.  Steps (state of t from
state of t-1) run for the last year of the data, or for the last day on which
somebody new came, so that every state occurs.

A query sets adaptive execution and the number of partitions, by the size of
its folder, in its session (session.tune).  Queries that
write use tables and folders named by the application, which the next run
overwrites.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions import expressions as X
from tideframe.operators import bitmaps as BM
from tideframe.operators import checks as C
from tideframe.operators import cumulative as A
from tideframe.operators import datelist as D
from tideframe.operators import distinct as DC
from tideframe.operators import experiments as E
from tideframe.operators import growth as G
from tideframe.operators import matches as M
from tideframe.operators import month_array as H
from tideframe.operators import rollup as U
from tideframe.operators import scd as S
from tideframe.operators import sessions as W
from tideframe.operators import streaks as K
from tideframe.operators import tables as B
from tideframe.plans.present import films_text, flat
from tideframe.schemas import INPUTS, QUALITY_CLASSES
from tideframe.session import tune, work_folder
from tideframe.sources import roles as R
from tideframe.sources.drift import schema_drift
from tideframe.sources.tables import csv_table, parquet_table
from tideframe.streaming import late as SL
from tideframe.streaming import sessions as SS
from tideframe.streaming import sources as SO
from tideframe.streaming.sinks import parquet_batches, parquet_ledger, read_parquet_ledger

Query = Callable[[SparkSession, str], DataFrame]

# The medal that plays the part of the killing spree in the test tables.
SPREE = "PROMO"

# The name of an actor goes along with the history.
NAMED = ("actor",)

QUERIES: dict[str, Query] = {}


def register(f: Query) -> Query:
    """Registers ``f``, to be run in a session with adaptive execution on."""

    @wraps(f)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(tune(spark, folder), folder)

    QUERIES[f.__name__] = run
    return f


def _own_name(spark: SparkSession, name: str) -> str:
    """A table name of this application, overwritten by its next run."""
    return f"{name}_{re.sub('[^a-z0-9]', '_', spark.sparkContext.applicationId.lower())}"


def _own_folder(spark: SparkSession, name: str) -> str:
    """The folder of such a table."""
    base = work_folder(spark, name).rpartition("/")[0]
    return f"{base}/{name}-{spark.sparkContext.applicationId}"


# --- cumulative snapshots ---------------------------------------------------


def _with_film_text(df: DataFrame) -> DataFrame:
    return df.withColumn("films", films_text(F.col("films")))


def _last_year(spark: SparkSession, folder: str) -> Column:
    """Last year with an order: a scan of one column."""
    orders = parquet_table(spark, folder, "orders")
    return orders.agg(F.year(F.max("o_orderdate")).alias("year")).scalar()


def _attributes(spark: SparkSession, folder: str, names: DataFrame | None = None) -> DataFrame:
    films = R.actor_films(spark, folder)
    return A.actor_attributes(films, _last_year(spark, folder), names)


@register
def actor_cumulative(spark: SparkSession, folder: str) -> DataFrame:
    films = R.actor_films(spark, folder)
    names = R.actor_names(spark, folder)
    return _with_film_text(
        A.actor_backfill(films, _last_year(spark, folder), names=names)
    )


@register
def actor_cumulative_step(spark: SparkSession, folder: str) -> DataFrame:
    films = R.actor_films(spark, folder)
    names = R.actor_names(spark, folder)
    last = _last_year(spark, folder)
    before = A.actor_backfill(films.filter(F.col("year") < last), last - 1, names=names)
    return _with_film_text(A.actor_step(before, films, last, names=names))


@register
def quality_class(spark: SparkSession, folder: str) -> DataFrame:
    return R.actor_films(spark, folder).select(
        "filmid", X.quality_class(F.col("rating")).alias("quality_class")
    )


@register
def device_datelist(spark: SparkSession, folder: str) -> DataFrame:
    events = R.web_events(spark, folder)
    return flat(D.datelist_backfill(events, "device_id", "device_activity_datelist"))


def _state(df: DataFrame, name: str) -> DataFrame:
    """``df`` as the state table it stands for: written, and read by the step."""
    path = _own_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _arrival_day(events: DataFrame) -> date:
    """The day of a step: a scheduled job knows it, here one small job finds it."""
    return events.sparkSession.range(1).select(R.last_arrival(events)).first()[0]


def _device_step(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Date lists of the day before the step's and of its day."""
    events = R.order_events(spark, folder)
    day = _arrival_day(events)
    name = "device_activity_datelist"
    before = _state(D.datelist_snapshot(events, "device_id", name, day - timedelta(days=1)), "device-state")
    return before, D.datelist_step(before, events, "device_id", name, day)


@register
def device_datelist_step(spark: SparkSession, folder: str) -> DataFrame:
    _, now = _device_step(spark, folder)
    return flat(now)


@register
def host_datelist(spark: SparkSession, folder: str) -> DataFrame:
    events = R.web_events(spark, folder)
    return flat(D.datelist_backfill(events, "host", "host_activity_datelist"))


@register
def host_month_array(spark: SparkSession, folder: str) -> DataFrame:
    return flat(H.host_month_array(R.order_events(spark, folder)))


@register
def host_month_upsert(spark: SparkSession, folder: str) -> DataFrame:
    events = R.order_events(spark, folder)
    day = _arrival_day(events)
    state = _state(H.host_month_array(events, day - timedelta(days=1)), "host-months")
    new = H.host_month_step(state, events, day)
    return flat(B.keyed_upsert(state, new, H.KEY))


@register
def month_array_explode(spark: SparkSession, folder: str) -> DataFrame:
    return flat(H.month_array_explode(H.host_month_array(R.order_events(spark, folder))))


@register
def insert_skip_existing(spark: SparkSession, folder: str) -> DataFrame:
    """Devices of the step day that the state of the day before does not hold."""
    before, now = _device_step(spark, folder)
    return flat(B.skip_existing(before, now, ["device_id"]))


# --- writes ---------------------------------------------------------------------


def _classes(spark: SparkSession, folder: str) -> DataFrame:
    return _attributes(spark, folder).select("actorid", "quality_class", "current_year")


def _start(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("current_year").parquet(path)


def _stored(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register
def snapshot_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """All years but the last, then the last two over them: nothing doubles."""
    rows, last = _classes(spark, folder), _last_year(spark, folder)
    out = _own_folder(spark, "snapshots")
    _start(rows.filter(F.col("current_year") < last), out)
    B.write_snapshot(rows.filter(F.col("current_year") >= last - 1), out, "current_year")
    return _stored(rows, out)


@register
def overwrite_insert(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table of all years but the last, overwritten with all rows."""
    rows, last = _classes(spark, folder), _last_year(spark, folder)
    name = _own_name(spark, "classes")
    earlier = rows.filter(F.col("current_year") < last)
    earlier.write.mode("overwrite").option("path", _own_folder(spark, "classes")).saveAsTable(name)
    B.overwrite_table(rows, name)
    return spark.table(name)


@register
def insert_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of all years but the last, and those of the last that an actor never had before."""
    rows, last = _classes(spark, folder), _last_year(spark, folder)
    out = _own_folder(spark, "insert-missing")
    _start(rows.filter(F.col("current_year") < last), out)
    new = rows.filter(F.col("current_year") == last)
    for _ in range(2):  # the second time there is nothing left to insert
        B.insert_missing(spark, out, new.unionByName(new), ["actorid", "quality_class"], "current_year")
    return _stored(rows, out)


@register
def upsert_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Old rows of all years but the last; upserted are the actors' years whose class changed."""
    rows, last = _classes(spark, folder), _last_year(spark, folder)
    out = _own_folder(spark, "upserted")
    old = rows.filter(F.col("current_year") < last).withColumn("quality_class", F.lit("old"))
    _start(old, out)
    before = rows.select(
        "actorid", (F.col("current_year") + 1).alias("current_year"), F.col("quality_class").alias("was"))
    changed = rows.join(before, ["actorid", "current_year"]).filter(~F.col("quality_class").eqNullSafe(F.col("was")))
    B.upsert_partitions(
        spark, out, changed.select(*rows.columns), ["actorid", "current_year"], "current_year",
        work_folder(spark, "upsert-staging"),
    )
    return _stored(rows, out)


@register
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV with a header and read with their declared types."""
    orders = parquet_table(spark, folder, "orders")
    out = _own_folder(spark, "orders-csv")
    orders.write.mode("overwrite").option("header", True).csv(out)
    return flat(csv_table(spark, out, orders.schema))


# --- slowly changing dimensions -----------------------------------------------


@register
def scd2_backfill(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = _attributes(spark, folder, R.actor_names(spark, folder))
    return S.stamp(S.scd2_backfill(snapshots, carry=NAMED), _last_year(spark, folder))


def _year(spark: SparkSession, folder: str) -> int:
    """The year of a step: a scheduled job knows it, here one small job finds it."""
    return spark.range(1).select(_last_year(spark, folder)).first()[0]


def _history_before(
    spark: SparkSession, folder: str, carry: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame, int]:
    """A stored table of two stamped histories, the stored snapshots, and the step's year."""
    last = _year(spark, folder)
    names = R.actor_names(spark, folder) if carry else None
    purpose = "named" if carry else "plain"
    snapshots = _state(_attributes(spark, folder, names), f"snapshots-{purpose}")
    before, older = (
        S.stamp(S.scd2_backfill(snapshots.filter(F.col("current_year") < y), carry=carry), y - 1)
        for y in (last, last - 1)
    )
    return _state(before.unionByName(older), f"history-{purpose}"), snapshots, last


@register
def scd2_incremental(spark: SparkSession, folder: str) -> DataFrame:
    history, snapshots, last = _history_before(spark, folder, NAMED)
    return S.scd2_incremental(history, snapshots, last, carry=NAMED)


@register
def scd2_expand_changed(spark: SparkSession, folder: str) -> DataFrame:
    history, snapshots, last = _history_before(spark, folder)
    return S.scd2_expand_changed(history, snapshots, last)


@register
def scd2_splice(spark: SparkSession, folder: str) -> DataFrame:
    """A history whose snapshot three years ago was wrong, put right by the true one.

    Then, idle actors were missing and the others had other classes.
    """
    snapshots = _attributes(spark, folder, R.actor_names(spark, folder))
    last = _year(spark, folder)
    then, rated = F.col("current_year") == last - 3, F.col("quality_class")
    wrong = snapshots.filter(~then | F.col("is_active")).withColumn(
        "quality_class", F.when(then, F.when(rated == "bad", "star").otherwise("bad")).otherwise(rated))
    history = _state(S.stamp(S.scd2_backfill(wrong, carry=NAMED), last), "history-wrong")
    return S.scd2_splice(history, snapshots, last - 3, carry=NAMED)


@register
def scd2_group_summary(spark: SparkSession, folder: str) -> DataFrame:
    return S.scd2_group_summary(_attributes(spark, folder))


# --- activity bits --------------------------------------------------------------


@register
def device_datelist_int(spark: SparkSession, folder: str) -> DataFrame:
    return flat(D.activity_bits(R.order_events(spark, folder), "device_id"))


@register
def host_datelist_int(spark: SparkSession, folder: str) -> DataFrame:
    return flat(D.activity_bits(R.order_events(spark, folder), "host"))


def _last_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Device date lists of the last day, as the state table holds them."""
    events = R.order_events(spark, folder)
    return D.datelist_snapshot(events, "device_id", "device_activity_datelist")


@register
def datelist_int_from_lists(spark: SparkSession, folder: str) -> DataFrame:
    return flat(
        D.datelist_bits(_last_snapshot(spark, folder), "device_id", "device_activity_datelist")
    )


@register
def calendar_grid(spark: SparkSession, folder: str) -> DataFrame:
    return flat(
        D.calendar_grid(_last_snapshot(spark, folder), "device_id", "device_activity_datelist")
    )


@register
def active_days_bits(spark: SparkSession, folder: str) -> DataFrame:
    bits = D.activity_bits(R.order_events(spark, folder), "device_id")
    return D.active_days_bits(bits, "device_id")


# --- dedup, rollups, leaderboards -------------------------------------------------


@register
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = R.game_lines(spark, folder).select(
        "game_id", "team_id", "player_id", "game_date", "season", "home_team_id", "pts"
    )
    return flat(U.dedupe_rows(lines, ["game_id", "team_id", "player_id"], ["game_date"]))


@register
def grouping_sets_points(spark: SparkSession, folder: str) -> DataFrame:
    return U.grouping_sets_points(R.game_lines(spark, folder), R.players(spark, folder))


@register
def grouping_sets_games(spark: SparkSession, folder: str) -> DataFrame:
    return DC.games_per_level(R.game_lines(spark, folder), R.players(spark, folder))


@register
def grouping_sets_games_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Estimates from sketches, told by whether they lie within four standard errors."""
    lines, players = R.game_lines(spark, folder), R.players(spark, folder)
    exact = DC.games_per_level(lines, players)
    keys = ["aggregation_level", *DC.KEYS]
    estimated = DC.estimated_games_per_level(DC.game_sketches(lines), players)
    off = F.abs(F.col("estimate") - F.col("games"))
    return exact.join(estimated.withColumnRenamed("games", "estimate"), keys).select(
        *keys, (off <= F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (DC.LG_K / 2) * F.col("games"))).alias("is_near"))


@register
def top_player_team(spark: SparkSession, folder: str) -> DataFrame:
    return U.top_player(R.game_lines(spark, folder), "team_id", R.players(spark, folder))


@register
def top_player_season(spark: SparkSession, folder: str) -> DataFrame:
    return U.top_player(R.game_lines(spark, folder), "season", R.players(spark, folder))


@register
def top_team_wins(spark: SparkSession, folder: str) -> DataFrame:
    return U.top_team_wins(R.games(spark, folder))


# --- growth ----------------------------------------------------------------------


@register
def growth_daily_state(spark: SparkSession, folder: str) -> DataFrame:
    return flat(G.growth_backfill(R.player_days(spark, folder)).drop("yearly_active_state"))


def _order_days(spark: SparkSession, folder: str, player: str = "ip") -> DataFrame:
    """Order days give years of absence, which the month of events does not."""
    return R.order_events(spark, folder).select(
        F.col(player).alias("player_name"), F.to_date("event_time").alias("effective_date")
    )


@register
def growth_yearly_state(spark: SparkSession, folder: str) -> DataFrame:
    """Entities per day and yearly state."""
    return flat(G.growth_counts(_order_days(spark, folder), "yearly_active_state"))


@register
def growth_yearly_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every entity's yearly state on the last day."""
    days = _order_days(spark, folder)
    last = X.latest(days, F.col("effective_date"))
    return flat(
        G.growth_snapshot(days, last).select(
            "player_name", "last_active_date", "yearly_active_state", "date"
        )
    )


@register
def growth_step(spark: SparkSession, folder: str) -> DataFrame:
    day = _arrival_day(R.order_events(spark, folder))
    days = _order_days(spark, folder, "device_id")
    before = _state(G.growth_snapshot(days, day - timedelta(days=1)), "growth-state")
    return flat(G.growth_step(before, days, day))


@register
def growth_latest_activity(spark: SparkSession, folder: str) -> DataFrame:
    return flat(G.latest_activity(R.player_days(spark, folder)))


# --- streaks -----------------------------------------------------------------------


@register
def rolling_90_wins(spark: SparkSession, folder: str) -> DataFrame:
    return K.rolling_wins(R.game_sides(spark, folder))


@register
def rolling_90_wins_by_team(spark: SparkSession, folder: str) -> DataFrame:
    return K.rolling_wins(R.game_sides(spark, folder), n=None)


@register
def longest_streak(spark: SparkSession, folder: str) -> DataFrame:
    return K.longest_streak(
        R.player_scores(spark, folder), R.game_days(spark, folder), R.players(spark, folder)
    )


# --- matches -------------------------------------------------------------------------


def _match_roles(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    return (
        R.matches(spark, folder),
        R.match_details(spark, folder),
        R.medals_matches_players(spark, folder),
        R.maps(spark, folder),
    )


@register
def broadcast_join_maps(spark: SparkSession, folder: str) -> DataFrame:
    return M.medals_with_maps(R.medals(spark, folder), R.maps(spark, folder))


def _yearly(matches: DataFrame) -> DataFrame:
    return matches.withColumn("completion_year", F.year("completion_date"))


@register
def bucketed_match_join(spark: SparkSession, folder: str) -> DataFrame:
    """Stored by year, because a day of the test tables is a handful of rows."""
    matches, details, medals, maps = _match_roles(spark, folder)
    return flat(
        M.bucketed_match_join(
            spark, _yearly(matches), details, medals, maps,
            _own_folder(spark, "bucketed-matches"), _own_name(spark, "t"),
            partition_by="completion_year",
        )
    )


def _hot_match(spark: SparkSession, folder: str) -> tuple[DataFrame, ...]:
    """The match roles with the first third of the orders as one match."""
    matches, details, medals, maps = _match_roles(spark, folder)
    third = matches.agg(F.floor(F.max("match_id") / 3).cast("long").alias("m")).scalar()
    hot = F.greatest("match_id", third)
    one = F.min(F.struct("completion_date", "is_team_game", "playlist_id", "mapid")).alias("one")
    sums = [F.sum(c).cast("int").alias(c) for c in ("player_total_kills", "player_total_deaths")]
    return (
        matches.groupBy(hot.alias("match_id")).agg(one).select("match_id", "one.*"),
        details.groupBy(hot.alias("match_id"), "player_gamertag").agg(*sums),
        medals.withColumn("match_id", hot),
        maps,
    )


@register
def heavy_match_join(spark: SparkSession, folder: str) -> DataFrame:
    """One match with a third of all rows: it goes through salts, the rest through buckets."""
    matches, details, medals, maps = _hot_match(spark, folder)
    return flat(
        M.heavy_match_join(
            spark, _yearly(matches), details, medals, maps,
            _own_folder(spark, "heavy-matches"), _own_name(spark, "h"),
            partition_by="completion_year",
        )
    )


@register
def joined_matches_sink(spark: SparkSession, folder: str) -> DataFrame:
    joined = _yearly(M.match_join(*_match_roles(spark, folder)))
    return flat(
        B.write_bucketed(
            joined, _own_name(spark, "joined_matches"), _own_folder(spark, "joined-matches"),
            "match_id", M.shuffle_partitions(spark), "completion_year",
        )
    )


def _played(spark: SparkSession, folder: str) -> DataFrame:
    return M.played(*_match_roles(spark, folder), medal=SPREE)


@register
def avg_kills_per_player(spark: SparkSession, folder: str) -> DataFrame:
    return M.avg_kills_per_player(_played(spark, folder))


@register
def most_played_playlist(spark: SparkSession, folder: str) -> DataFrame:
    return M.most_played(_played(spark, folder), ["playlist_id"])


@register
def most_played_map(spark: SparkSession, folder: str) -> DataFrame:
    return M.most_played(_played(spark, folder), ["mapid", "map_name"])


@register
def map_killing_sprees(spark: SparkSession, folder: str) -> DataFrame:
    return M.killing_sprees(_played(spark, folder))


@register
def sorted_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """The three reports in a layout for writing, sorted within files.

    What they share, a row per match and player, is written once.
    """
    out = _own_folder(spark, "played")
    shared = _played(spark, folder)
    shared.write.mode("overwrite").parquet(out)
    rows = spark.read.schema(shared.schema).parquet(out)

    def row(df: DataFrame, report: str, key: str, value: str) -> DataFrame:
        return M.locally_sorted(df, value).select(
            F.lit(report).alias("report"), F.col(key).cast("string").alias("entry"),
            F.col(value).cast("double").alias("value"),
        )

    return C.all_of(
        [
            row(M.avg_kills_per_player(rows), "avg_kills",
                "player_gamertag", "avg_kills_per_game"),
            row(M.most_played(rows, ["playlist_id"]), "most_played_playlist",
                "playlist_id", "matches_played"),
            row(M.killing_sprees(rows), "killing_sprees",
                "mapid", "total_killing_spree_medals"),
        ]
    )


# --- sessions --------------------------------------------------------------------------


@register
def session_hits(spark: SparkSession, folder: str) -> DataFrame:
    return flat(W.session_hits(R.web_events(spark, folder)))


@register
def hits_per_session_host(spark: SparkSession, folder: str) -> DataFrame:
    return W.hits_per_session(W.session_hits(R.web_events(spark, folder)))


@register
def hits_per_session_id(spark: SparkSession, folder: str) -> DataFrame:
    """The same from single events that carry the id of their session."""
    return W.hits_per_session_id(W.with_session_id(R.web_events(spark, folder)))


def _hits(raw: DataFrame) -> DataFrame:
    """A stream of the events table as hits with a watermark; ``event_id`` goes along."""
    return SO.with_watermark(
        raw.select(
            F.col("user_id").alias("ip"),
            F.col("event_type").alias("host"),
            F.col("ts").alias("window_timestamp"),
            "event_id",
        )
    )


def _event_stream(own: SparkSession, folder: str) -> DataFrame:
    return SO.file_stream(own, folder, INPUTS["events"], glob="events.parquet")


def _event_sessions(spark: SparkSession, folder: str) -> tuple[SparkSession, DataFrame, str]:
    """A session for streams, the stream of sessions, and a new folder for its output."""
    own = SS.streaming_session(spark)
    return own, SS.session_windows(_hits(_event_stream(own, folder))), work_folder(spark, "stream-sessions")


@register
def stream_session_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The same stream, each micro-batch handed to a writer."""
    own, sessions, out = _event_sessions(spark, folder)
    write = parquet_batches(f"{out}/sessions")
    SS.run(SS.start_to_batches(sessions, write, f"{out}/checkpoint", once=True))
    return flat(own.read.parquet(f"{out}/sessions").select(*sessions.columns))


@register
def stream_session_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Runs the stream over the events file to its end and reads the sink."""
    own, sessions, out = _event_sessions(spark, folder)
    SS.run(SS.start_to_files(sessions, f"{out}/sessions", f"{out}/checkpoint", once=True))
    return flat(own.read.schema(sessions.schema).parquet(f"{out}/sessions"))


@register
def stream_session_all(spark: SparkSession, folder: str) -> DataFrame:
    """Closed sessions from the sink and the open ones from the state store: all of them."""
    own, sessions, out = _event_sessions(spark, folder)
    SS.run(SS.start_to_files(sessions, f"{out}/sessions", f"{out}/checkpoint", once=True))
    closed = own.read.schema(sessions.schema).parquet(f"{out}/sessions")
    return flat(closed.unionByName(SS.open_sessions(own, f"{out}/checkpoint")))


@register
def stream_session_redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is delivered twice, as an at-least-once topic may; sessions count it once."""
    own, _, out = _event_sessions(spark, folder)
    twice = _event_stream(own, folder).unionByName(_event_stream(own, folder))
    sessions = SS.session_windows(SO.drop_redelivered(_hits(twice), ["event_id"]))
    SS.run(SS.start_to_files(sessions, f"{out}/sessions", f"{out}/checkpoint", once=True))
    return flat(own.read.schema(sessions.schema).parquet(f"{out}/sessions"))


@register
def stream_session_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Batches behind a ledger; each is handed over twice, and counts once."""
    own, sessions, out = _event_sessions(spark, folder)
    write = parquet_ledger(f"{out}/sink", "events")

    def replayed(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            write(batch, batch_id)

    SS.run(SS.start_to_batches(sessions, replayed, f"{out}/checkpoint", once=True))
    rows = read_parquet_ledger(own, f"{out}/sink", sessions.schema)
    return flat(rows.select(*sessions.columns))


@register
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Errors arrive after everything else, and after a restart: most are late.

    Closed sessions, open ones and late rows, which account for every event.
    """
    own, out = SS.streaming_session(spark), work_folder(spark, "stream-late")
    events = own.read.schema(INPUTS["events"]).parquet(f"{folder}/events.parquet")
    error = F.col("event_type") == "error"
    for arriving in (events.filter(~error), events.filter(error)):
        arriving.write.mode("append").parquet(f"{out}/in")
        found = SL.sessions_and_late(_hits(SO.file_stream(own, f"{out}/in", INPUTS["events"])))
        SS.run(SS.start_to_files(found, f"{out}/out", f"{out}/checkpoint", once=True))
    rows = own.read.schema(found.schema).parquet(f"{out}/out")
    return flat(rows.unionByName(SL.open_spans(own, f"{out}/checkpoint")))


@register
def web_traffic_messages(spark: SparkSession, folder: str) -> DataFrame:
    """JSON messages made of the events and parsed as the topic's would be."""
    events = R.web_events(spark, folder)
    text = F.date_format("event_time", SO.EVENT_TIME_PATTERN)
    messages = events.select(
        F.to_json(
            F.struct(
                F.col("ip").cast("string").alias("ip"), text.alias("event_time"), F.lit("").alias("referrer"), "host",
                F.concat(F.lit("/"), F.col("host")).alias("url"),
                F.lit("{}").alias("geodata"),
            )
        ).alias("value")
    )
    return flat(SO.parse_web_traffic(messages))


# --- experiments and business totals ------------------------------------------------------


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    return E.allocate(R.user_events(spark, folder))


@register
def experiment_allocation(spark: SparkSession, folder: str) -> DataFrame:
    return E.allocation(_cells(spark, folder))


@register
def experiment_ctr(spark: SparkSession, folder: str) -> DataFrame:
    return E.click_through(_cells(spark, folder))


@register
def experiment_dau_retention(spark: SparkSession, folder: str) -> DataFrame:
    return flat(E.dau_retention(_cells(spark, folder)))


@register
def experiment_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return E.conversion(_cells(spark, folder), "purchase")


@register
def active_user_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with orders on a day, in a week and in four weeks, over seven years."""
    orders = R.order_events(spark, folder).select(
        F.col("ip").alias("user_id"), F.to_date("event_time").alias("day"))
    return flat(BM.active_users(BM.daily_bitmaps(orders)))


@register
def experiment_ctr_interval(spark: SparkSession, folder: str) -> DataFrame:
    rows = E.ratio_intervals(E.ratio_moments(_cells(spark, folder), "click", "view"))
    return rows.select("cell", "users", *[F.round(c, 9).alias(c) for c in ("ratio", "low", "high")])


@register
def experiment_sample_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = E.sample_ratio(E.ratio_moments(_cells(spark, folder), "click", "view"))
    return rows.withColumn("chi2", F.round("chi2", 9))


@register
def profit_by_unit(spark: SparkSession, folder: str) -> DataFrame:
    return flat(E.profit_by_unit(R.order_profit(spark, folder)))


@register
def profit_total(spark: SparkSession, folder: str) -> DataFrame:
    return flat(E.profit_total(R.customer_profit(spark, folder)))


@register
def growth_daily(spark: SparkSession, folder: str) -> DataFrame:
    return flat(G.growth_counts(R.player_days(spark, folder)))


@register
def growth_total(spark: SparkSession, folder: str) -> DataFrame:
    return flat(E.growth_total(G.growth_counts(R.player_days(spark, folder))))


@register
def engagement_total(spark: SparkSession, folder: str) -> DataFrame:
    return flat(E.engagement(R.user_events(spark, folder)))


# --- checks ---------------------------------------------------------------------------------

SOURCES = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]


@register
def check_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Every source against the last day of the events."""
    expected = X.latest(parquet_table(spark, folder, "events"), X.day("ts"))
    return flat(
        C.all_of(
            [
                C.freshness(parquet_table(spark, folder, t), t, ts, expected)
                for t, ts in SOURCES
            ]
        )
    )


@register
def check_missing_days(spark: SparkSession, folder: str) -> DataFrame:
    return flat(
        C.all_of(
            [
                C.missing_days(parquet_table(spark, folder, t), ts).select(
                    F.lit(t).alias("source"), "day"
                )
                for t, ts in SOURCES
            ]
        )
    )


@register
def check_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The files' own schemas against the declared ones."""
    return C.all_of(
        [
            C.schema_differences(spark.read.parquet(f"{folder}/{t}.parquet"), INPUTS[t], t)
            for t, _ in SOURCES
        ]
    )


@register
def check_unique_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = parquet_table(spark, folder, "lineitem")
    return C.unique_key_violations(lines, ["l_orderkey", "l_linenumber"])


@register
def check_domain(spark: SparkSession, folder: str) -> DataFrame:
    attributes = _attributes(spark, folder)
    status = C.domain(parquet_table(spark, folder, "orders"), "o_orderstatus", ["F", "O"])
    return C.all_of([C.domain(attributes, "quality_class", QUALITY_CLASSES), status])


@register
def check_spikes(spark: SparkSession, folder: str) -> DataFrame:
    return flat(C.spikes(R.web_events(spark, folder), "event_time", "host"))


@register
def check_robust_spikes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per priority and day against the median of their weekday."""
    return flat(C.robust_spikes(R.order_events(spark, folder), "event_time", "host"))


@register
def check_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by status in one folder; two of the writers changed the schema on their own."""
    orders = parquet_table(spark, folder, "orders")
    out = _own_folder(spark, "drifting")
    status = F.col("o_orderstatus")
    price = F.struct(F.col("o_totalprice").alias("amount"), F.lit("EUR").alias("currency"))
    writers = {
        "F": orders,
        "O": orders.withColumn("o_custkey", F.col("o_custkey").cast("decimal(20,0)")).drop("o_orderpriority"),
        "P": orders.withColumn("o_totalprice", price),
    }
    for name, rows in writers.items():
        rows.filter(status == name).write.mode("overwrite").parquet(f"{out}/writer={name}")
    writer = F.regexp_extract("file", "writer=([^/]+)", 1).alias("writer")
    found = schema_drift(spark, out, INPUTS["orders"])
    return found.select(writer, "column_name", "declared", "found", "status").distinct()
