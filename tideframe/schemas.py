"""Declared schemas: the operator's tables and the Parquet inputs.

Reads always pass a schema, so no job is spent on inference and join keys
cannot end up as text on one side and a number on the other.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<date>": T.ArrayType(T.DateType()),
    "array<bigint>": T.ArrayType(T.LongType()),
}


def _schema(**cols: str | T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(n, t if isinstance(t, T.DataType) else _TYPES[t])
            for n, t in cols.items()
        ]
    )


# The classes of an actor's year, best first.
QUALITY_CLASSES = ["star", "good", "average", "bad"]

FILM = _schema(film="string", votes="int", rating="double", filmid="string")

ACTOR_FILMS = _schema(
    actor="string", actorid="string", year="int",
    film="string", votes="int", rating="double", filmid="string",
)

ACTORS = _schema(
    actor="string", actorid="string", year="int", films_part="int",
    films=T.ArrayType(FILM),
    quality_class="string", years_since_film="int",
    current_year="int", is_active="boolean",
)

ACTORS_HISTORY = _schema(
    actorid="string", actor="string", quality_class="string", is_active="boolean",
    start_date="int", end_date="int", current_year="int",
)

USER_DEVICES_CUMULATED = _schema(
    device_id="string", device_activity_datelist="array<date>", date="date",
)

HOSTS_CUMULATED = _schema(
    host="string", host_activity_datelist="array<date>", date="date",
)

HOST_ACTIVITY_REDUCED = _schema(
    host="string", month_start="date", metric_name="string",
    metric_array="array<bigint>",
)

PLAYERS = _schema(
    player_name="string", first_active_date="date", last_active_date="date",
    dates_active="array<date>", date="date",
)

GAMES = _schema(
    game_id="bigint", game_date="date", season="int", home_team_id="bigint",
    away_team_id="bigint", home_team_wins="int",
)

GAME_DETAILS = _schema(
    game_id="bigint", team_id="bigint", player_id="bigint",
    player_name="string", pts="double",
)

MATCHES = _schema(
    match_id="string", is_team_game="boolean", playlist_id="string",
    completion_date="date", mapid="string",
)

MATCH_DETAILS = _schema(
    match_id="string", player_gamertag="string",
    player_total_kills="int", player_total_deaths="int",
)

MEDALS_MATCHES_PLAYERS = _schema(
    match_id="string", player_gamertag="string", medal_type="string",
)

MAPS = _schema(mapid="string", name="string")

MEDALS = _schema(medal_id="string", mapid="string")

# One JSON message of the web traffic topic.
WEB_TRAFFIC = _schema(
    ip="string", event_time="string", referrer="string",
    host="string", url="string", geodata="string",
)

SESSIONS = _schema(
    session_start="timestamp", session_end="timestamp",
    ip="string", host="string", num_hits="bigint",
)

# The Parquet inputs the registered queries read.
INPUTS = {
    "nation": _schema(n_nationkey="int", n_name="string", n_regionkey="int"),
    "customer": _schema(
        c_custkey="bigint", c_name="string", c_nationkey="int",
        c_acctbal="double", c_mktsegment="string",
    ),
    "supplier": _schema(
        s_suppkey="bigint", s_name="string", s_nationkey="int", s_acctbal="double",
    ),
    "part": _schema(
        p_partkey="bigint", p_name="string", p_brand="string",
        p_type="string", p_size="int", p_retailprice="double",
    ),
    "orders": _schema(
        o_orderkey="bigint", o_custkey="bigint", o_orderstatus="string",
        o_totalprice="double", o_orderdate="timestamp_ntz", o_orderpriority="string",
    ),
    "lineitem": _schema(
        l_orderkey="bigint", l_partkey="bigint", l_suppkey="bigint",
        l_linenumber="int", l_quantity="double", l_extendedprice="double",
        l_discount="double", l_tax="double", l_returnflag="string",
        l_linestatus="string", l_shipdate="timestamp_ntz",
    ),
    "events": _schema(
        event_id="bigint", ts="timestamp_ntz", user_id="bigint",
        event_type="string", value="double", props="string",
    ),
}
