"""Query-first tables over the play log.

The play log is lineitem with its part's natural key: session = order key,
item = line number, user = supplier key, artist = brand, song = part name,
length = retail price, level = return flag. A key-value INSERT keeps the
last row per primary key; the log's arrival order is its ship time (ties
broken by the row's values).
"""

from __future__ import annotations

from starweave.operators.loads import write_table
from starweave.plans import roles
from starweave.plans.lookup import build_query_table, lookup
from starweave.plans.registry import register
from starweave.plans.roles import Tables
from starweave.session import scratch_path

# parameters of the three questions (the reference used literals)
SESSION, ITEM = 338, 1
USER, USER_SESSION = 64, 338
SONG = "small ring"

LOG_SQL = """
log AS (
    SELECT l.l_orderkey AS sessionId, l.l_linenumber AS itemInSession, l.l_suppkey AS userId,
           l.l_returnflag AS level, epoch_us(l.l_shipdate) // 1000 AS ts,
           p.p_name AS song, p.p_brand AS artist, p.p_retailprice AS length
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
"""


def _log(t: Tables):
    return roles.play_log_with_keys(t)


BY_SESSION_SQL = f"""
WITH {LOG_SQL}
SELECT sessionId, itemInSession, artist, song, length FROM (
    SELECT *, row_number() OVER (PARTITION BY sessionId, itemInSession
                                 ORDER BY ts DESC, artist DESC, song DESC, length DESC) AS rn
    FROM log) WHERE rn = 1
"""


@register("song_info_by_session", BY_SESSION_SQL, "C12 K11 K12 (PRIMARY KEY (sessionId, itemInSession))")
def song_info_by_session(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_query_table(_log(t), ["sessionId"], ["itemInSession"],
                             ["sessionId", "itemInSession", "artist", "song", "length"], "ts")


BY_USER_SQL = f"""
WITH {LOG_SQL}
SELECT userId, sessionId, itemInSession, artist, song, level FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, sessionId, itemInSession
                                 ORDER BY ts DESC, artist DESC, song DESC, level DESC) AS rn
    FROM log) WHERE rn = 1
"""


@register("song_info_by_user", BY_USER_SQL, "C12 K11 K12 (PRIMARY KEY ((userId, sessionId), itemInSession))")
def song_info_by_user(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_query_table(_log(t), ["userId", "sessionId"], ["itemInSession"],
                             ["userId", "sessionId", "itemInSession", "artist", "song", "level"], "ts")


BY_SONG_SQL = f"""
WITH {LOG_SQL}
SELECT song, userId, level FROM (
    SELECT *, row_number() OVER (PARTITION BY song, userId ORDER BY ts DESC, level DESC) AS rn
    FROM log) WHERE rn = 1
"""


@register("user_info_by_song", BY_SONG_SQL, "C12 K11 K12 A8 (PRIMARY KEY (song, userId))")
def user_info_by_song(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_query_table(_log(t), ["song"], ["userId"], ["song", "userId", "level"], "ts")


def _stored(spark, df, name):
    """Write a query-first table once (sorted runs of its key) and open it."""
    path = scratch_path(spark, name)
    write_table(df, path)
    return spark.read.parquet(path)


@register(
    "q_point",
    BY_SESSION_SQL.replace("WHERE rn = 1", f"WHERE rn = 1 AND sessionId = {SESSION} AND itemInSession = {ITEM}"),
    "F6 (point lookup by full primary key on the stored table)",
)
def q_point(spark, sf_dir):
    table = _stored(spark, song_info_by_session(spark, sf_dir), "song_info_by_session")
    return lookup(table, sessionId=SESSION, itemInSession=ITEM).select("artist", "song", "length",
                                                                        "sessionId", "itemInSession")


@register(
    "q_partition_sorted",
    BY_USER_SQL.replace("WHERE rn = 1", f"WHERE rn = 1 AND userId = {USER} AND sessionId = {USER_SESSION}"),
    "F7 L4 (composite partition key lookup, rows in clustering order)",
)
def q_partition_sorted(spark, sf_dir):
    table = _stored(spark, song_info_by_user(spark, sf_dir), "song_info_by_user")
    return lookup(table, ["itemInSession"], userId=USER, sessionId=USER_SESSION)


@register(
    "q_by_song",
    BY_SONG_SQL.replace("WHERE rn = 1", f"WHERE rn = 1 AND song = '{SONG}'"),
    "F8 (every user of one song: partition lookup, many rows)",
)
def q_by_song(spark, sf_dir):
    table = _stored(spark, user_info_by_song(spark, sf_dir), "user_info_by_song")
    return lookup(table, ["userId"], song=SONG)
