"""Explicit schemas for every layer (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


COORDINATES = _fields(("lon", D), ("lat", D))

# Bronze (``date`` is the partition column).  Landed keys beyond these are stored as text.
BRONZE = _fields(
    ("stationcode", S),
    ("name", S),
    ("nom_arrondissement_communes", S),
    ("code_insee_commune", S),
    ("numbikesavailable", L),
    ("mechanical", L),
    ("ebike", L),
    ("numdocksavailable", L),
    ("capacity", L),
    ("is_installed", S),
    ("is_renting", S),
    ("is_returning", S),
    ("coordonnees_geo.lat", D),
    ("coordonnees_geo.lon", D),
    ("duedate", S),
    ("ingested_at", TS),
    ("date", T.DateType()),
)

SILVER = _fields(
    ("station_code", S),
    ("station_name", S),
    ("arrondissement", S),
    ("code_insee", S),
    ("bikes_available", L),
    ("bikes_mechanical", L),
    ("bikes_electric", L),
    ("docks_available", L),
    ("capacity", L),
    ("is_installed", B),
    ("is_renting", B),
    ("is_returning", B),
    ("latitude", D),
    ("longitude", D),
    ("last_reported", TS),
    ("ingested_at", TS),
    ("date", T.DateType()),
    ("prev_bikes_available", L),
    ("bikes_delta", L),
    ("minutes_since_last_snapshot", L),
    ("depletion_rate_per_minute", D),
)
SILVER_COLUMNS = [f.name for f in SILVER.fields]

# Where a row comes from: the bronze file (from ``date=`` on) and the row's place in it.  Stored beside
# each silver row, read only by the merge.
SOURCE_COLUMNS = ["__source", "__row"]
# Side tables of silver: each station's place in time, the heavy stations of each day, and (one table a
# day) each station's newest row.
POSITIONS, SKETCHES, LATEST = "_positions", "_sketches", "_latest"
STORED_SILVER = T.StructType([*SILVER.fields, T.StructField("__source", T.StringType()), T.StructField("__row", T.LongType())])

AT_RISK = _fields(
    ("station_code", S),
    ("station_name", S),
    ("arrondissement", S),
    ("latitude", D),
    ("longitude", D),
    ("bikes_available", L),
    ("depletion_rate_per_minute", D),
    ("minutes_until_empty", D),
    ("last_reported", TS),
)

EMPTY_DURATION = _fields(
    ("station_code", S),
    ("station_name", S),
    ("arrondissement", S),
    ("last_seen_with_bikes", TS),
    ("checked_at", TS),
    ("minutes_empty", L),
)

DISTRICT_STATS = _fields(
    ("arrondissement", S),
    ("total_stations", L),
    ("total_bikes", L),
    ("total_mechanical", L),
    ("total_electric", L),
    ("total_docks_available", L),
    ("total_capacity", L),
    ("fill_rate_pct", D),
    ("empty_stations", L),
    ("full_stations", L),
)

GOLD_SCHEMAS = {
    "stations_at_risk": AT_RISK,
    "stations_empty_duration": EMPTY_DURATION,
    "district_stats": DISTRICT_STATS,
}

RUN_STEP = _fields(("step_key", S), ("status", S), ("start_time", D), ("end_time", D))
RUN_LOG = _fields(
    ("run_id", S),
    ("job", S),
    ("status", S),
    ("start_time", D),
    ("end_time", D),
    ("steps", T.ArrayType(RUN_STEP, True)),
)

FILE_LISTING = _fields(("path", S), ("modificationTime", T.TimestampType()), ("length", L))
