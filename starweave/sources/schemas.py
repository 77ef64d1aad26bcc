"""Declared schemas: every source is read with a StructType, never inferred.

Holds the driver tables, the raw activity-log and song-metadata layouts, the
star tables, the query-first tables, the column widths of the warehouse DDL
and the field mapping of the mapped JSON load (S4).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import SparkSession
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def struct(spec: str) -> T.StructType:
    """Build a StructType from ``name type, name type`` (simple types only)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


# --- driver tables ---------------------------------------------------------

TABLES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table_schema(name: str) -> T.StructType:
    return struct(TABLES[name])


# --- raw inputs of the music star ------------------------------------------

# Field names, order and types of the raw inputs must equal the reference's.

# Activity log, one JSON object per line (staging_events).
LOG = struct(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, ts bigint, "
    "userAgent string, userId int"
)

# Song metadata, one JSON object per file (staging_songs).
SONG = struct(
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int"
)

# Column names, order and types below must equal the reference's.

# --- star tables ------------------------------------------------------------

STAR: dict[str, T.StructType] = {
    "songplays": struct(
        "songplay_id string, start_time timestamp_ntz, user_id int, level string, song_id string, "
        "artist_id string, session_id int, location string, user_agent string"
    ),
    "users": struct("user_id int, first_name string, last_name string, gender string, level string"),
    "songs": struct("song_id string, title string, artist_id string, year int, duration double"),
    "artists": struct(
        "artist_id string, name string, location string, latitude double, longitude double"
    ),
    "time": struct(
        "start_time timestamp_ntz, hour int, day int, week int, month int, year int, weekday int"
    ),
}

STAR_KEYS: dict[str, list[str]] = {
    "songplays": ["songplay_id"],
    "users": ["user_id"],
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "time": ["start_time"],
}

# Column widths of the warehouse DDL (varchar(n)); C7 enforces them.
WIDTHS: dict[str, dict[str, int]] = {
    "songplays": {"songplay_id": 32, "level": 256, "song_id": 256, "artist_id": 256,
                  "location": 256, "user_agent": 256},
    "users": {"first_name": 256, "last_name": 256, "gender": 256, "level": 256},
    "songs": {"song_id": 256, "title": 256, "artist_id": 256},
    "artists": {"artist_id": 256, "name": 256, "location": 256},
}

# JSON field -> (staging column, type), in table order. The reference's
# mapping file is not published; this is the staging_events layout.
LOG_MAPPING: list[tuple[str, str, str]] = [
    ("artist", "artist", "string"),
    ("auth", "auth", "string"),
    ("firstName", "firstname", "string"),
    ("gender", "gender", "string"),
    ("itemInSession", "iteminsession", "int"),
    ("lastName", "lastname", "string"),
    ("length", "length", "double"),
    ("level", "level", "string"),
    ("location", "location", "string"),
    ("method", "method", "string"),
    ("page", "page", "string"),
    ("registration", "registration", "double"),
    ("sessionId", "sessionid", "int"),
    ("song", "song", "string"),
    ("status", "status", "int"),
    ("ts", "ts", "bigint"),
    ("userAgent", "useragent", "string"),
    ("userId", "userid", "int"),
]

# --- capstone inputs --------------------------------------------------------

AIRPORT = struct(
    "ident string, type string, name string, elevation_ft double, continent string, "
    "iso_country string, iso_region string, municipality string, gps_code string, "
    "iata_code string, local_code string, coordinates string"
)

DEMOGRAPHICS = struct(
    "City string, State string, Median_Age double, Male_Population int, Female_Population int, "
    "Total_Population int, Number_of_Veterans int, Foreign_born int, Average_Household_Size double, "
    "State_Code string, Race string, Count int"
)

STATE = struct("State string, Abbrev string, Code string")

TEMPERATURE = struct(
    "Region string, Country string, State string, City string, Month string, Day string, "
    "Year string, AvgTemperature string"
)


# --- K13: create / drop from typed definitions ---------------------------------


def ddl(schema: T.StructType, widths: Mapping[str, int] = MappingProxyType({}), keys: Sequence[str] = ()) -> str:
    """Column definitions: types, ``varchar(n)`` for the widths given, NOT NULL for keys."""

    def column(f: T.StructField) -> str:
        text = isinstance(f.dataType, T.StringType) and f.name in widths
        kind = f"varchar({widths[f.name]})" if text else f.dataType.simpleString()
        return f"`{f.name}` {kind}{' NOT NULL' if f.name in keys else ''}"

    return ", ".join(map(column, schema.fields))


def create_all(
    spark: SparkSession,
    schemas: Mapping[str, T.StructType],
    location: str | None = None,
    widths: Mapping[str, Mapping[str, int]] | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` for each schema.

    Idempotent. With ``location`` each table lives under ``location/name``.
    ``widths`` (table -> column -> n) makes text columns ``varchar(n)``, which
    an insert of a longer value violates; ``keys`` (table -> columns) declares
    key columns NOT NULL. A parquet table has no unique keys; the quality
    checks look for repeats.
    """
    done = []
    for name, schema in schemas.items():
        where = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        columns = ddl(schema, (widths or {}).get(name, {}), (keys or {}).get(name, ()))
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet{where}")
        done.append(name)
    return done


def drop_all(spark: SparkSession, names) -> list[str]:
    """``DROP TABLE IF EXISTS`` for each name; idempotent."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    return list(names)
