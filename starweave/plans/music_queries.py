"""Music star queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starweave.functions.time import millis_to_date, millis_to_timestamp, to_epoch_millis
from starweave.operators.clean import first_per_key
from starweave.operators.loads import dense_ids, insert_absent, insert_not_in, keyed_overwrite, upsert
from starweave.plans import roles
from starweave.plans.music import build_artists, build_songplays, build_songs, build_time, build_users
from starweave.plans.registry import register
from starweave.plans.roles import Tables

# ---------------------------------------------------------------------------
# shared oracle fragments (DuckDB)
# ---------------------------------------------------------------------------

PLAYS = """
plays AS (
    SELECT l.l_orderkey AS session_id, l.l_suppkey AS user_id, l.l_returnflag AS level,
           epoch_us(l.l_shipdate) // 1000 AS ts, l.l_linenumber AS item,
           CAST(l.l_tax AS VARCHAR) AS location, CAST(l.l_discount AS VARCHAR) AS user_agent,
           p.p_name AS song, p.p_brand AS artist, p.p_retailprice AS length
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    WHERE l.l_linestatus = 'O'),
songs AS (
    SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_id, p_brand AS artist_name,
           CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS duration
    FROM part)
"""

SECONDS = "TIMESTAMP '1970-01-01 00:00:00' + to_seconds(ts // 1000)"
MILLIS = "make_timestamp(ts * 1000)"


def _songplays(spark, sf_dir, **kw):
    t = Tables(spark, sf_dir)
    return build_songplays(
        roles.play_log(t),
        roles.song_staging(t),
        page_filter=roles.play_filter(),
        key_source=(roles.song_keys(t), "l_partkey", "p_partkey"),
        **kw,
    )


@register(
    "fact_left_md5",
    f"""
WITH {PLAYS},
f AS (SELECT *, {SECONDS} AS start_time FROM plays)
SELECT md5(CAST(f.session_id AS VARCHAR) || CAST(f.start_time AS VARCHAR)) AS songplay_id,
       f.start_time, f.user_id, f.level, s.song_id, s.artist_id, f.session_id, f.location, f.user_agent
FROM f LEFT JOIN songs s
  ON f.song = s.title AND f.artist = s.artist_name AND f.length = s.duration
""",
    "C4 J2 E2 E15 E20 E21 F1 (flagship)",
)
def fact_left_md5(spark, sf_dir):
    return _songplays(spark, sf_dir, how="left", key="md5", precision="second")


@register(
    "fact_inner_3key",
    f"""
WITH {PLAYS},
f AS (SELECT *, {MILLIS} AS start_time FROM plays)
SELECT f.start_time, f.user_id, f.level, s.song_id, s.artist_id, f.session_id, f.location, f.user_agent
FROM f JOIN songs s
  ON f.artist = s.artist_name AND f.song = s.title AND f.length = s.duration
""",
    "C4 J1 E1",
)
def fact_inner_3key(spark, sf_dir):
    return _songplays(spark, sf_dir, how="inner", key="none", precision="millisecond")


@register(
    "fact_inner_3key_direct",
    f"""
WITH {PLAYS},
f AS (SELECT *, {MILLIS} AS start_time FROM plays)
SELECT f.start_time, f.user_id, f.level, s.song_id, s.artist_id, f.session_id, f.location, f.user_agent
FROM f JOIN songs s
  ON f.artist = s.artist_name AND f.song = s.title AND f.length = s.duration
""",
    "C4 J1 E1 (log carries the natural key itself)",
)
def fact_inner_3key_direct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_songplays(
        roles.play_log_with_keys(t),
        roles.song_staging(t),
        how="inner",
        key="none",
        precision="millisecond",
        page_filter=roles.play_filter(),
    )


@register(
    "fact_distinct_sequence",
    f"""
WITH {PLAYS},
f AS (SELECT DISTINCT {SECONDS} AS start_time, p.user_id, p.level, s.song_id, s.artist_id,
             p.session_id, p.location, p.user_agent
      FROM plays p JOIN songs s
        ON p.artist = s.artist_name AND p.song = s.title AND p.length = s.duration)
SELECT row_number() OVER (ORDER BY start_time, user_id, level, song_id, artist_id, session_id, location, user_agent) - 1
         AS songplay_id, *
FROM f
""",
    "C4 J1 A4 K14 (IDENTITY(0,1) over SELECT DISTINCT)",
)
def fact_distinct_sequence(spark, sf_dir):
    return _songplays(spark, sf_dir, how="inner", key="sequence", precision="second",
                      distinct=True, id_start=0)


@register(
    "fact_lookup_first",
    f"""
WITH {PLAYS},
first_song AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY title, artist_name, duration
                                     ORDER BY song_id, artist_id) AS rn
        FROM songs) WHERE rn = 1),
f AS (SELECT *, {MILLIS} AS start_time FROM plays)
SELECT f.start_time, f.user_id, f.level, s.song_id, s.artist_id, f.session_id, f.location, f.user_agent
FROM f LEFT JOIN first_song s
  ON f.song = s.title AND f.artist = s.artist_name AND f.length = s.duration
""",
    "C4 J3 L3",
)
def fact_lookup_first(spark, sf_dir):
    return _songplays(spark, sf_dir, how="first_match", key="none", precision="millisecond")


@register(
    "fact_rounded_key",
    f"""
WITH {PLAYS},
f AS (SELECT *, {SECONDS} AS start_time FROM plays)
SELECT md5(CAST(f.session_id AS VARCHAR) || CAST(f.start_time AS VARCHAR)) AS songplay_id,
       f.start_time, f.user_id, f.level, s.song_id, s.artist_id, f.session_id, f.location, f.user_agent
FROM f LEFT JOIN songs s
  ON f.song = s.title AND f.artist = s.artist_name
 AND CAST(f.length AS DECIMAL(18,0)) = CAST(s.duration AS DECIMAL(18,0))
""",
    "C4 J4 E19",
)
def fact_rounded_key(spark, sf_dir):
    return _songplays(spark, sf_dir, how="left", key="md5", precision="second", rounded=True)


# ---------------------------------------------------------------------------
# time dimension
# ---------------------------------------------------------------------------


@register(
    "time_dim_mon0",
    """
WITH s AS (SELECT DISTINCT make_timestamp((epoch_us(ts) // 1000) * 1000) AS start_time FROM events)
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, CAST(isodow(start_time) - 1 AS INTEGER) AS weekday
FROM s
""",
    "C3 E1 E5-E10 (Monday = 0)",
)
def time_dim_mon0(spark, sf_dir):
    t = Tables(spark, sf_dir)
    log = t.events.select(to_epoch_millis("ts").alias("ts"))
    return build_time(log.select(millis_to_timestamp("ts").alias("start_time")), weekday_base="mon0")


@register(
    "time_dim_from_fact",
    f"""
WITH {PLAYS},
f AS (SELECT DISTINCT {SECONDS} AS start_time FROM plays)
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, CAST(dayofweek(start_time) AS INTEGER) AS weekday
FROM f
""",
    "C3 S12 A7 E10 (Sunday = 0, read from the loaded fact)",
)
def time_dim_from_fact(spark, sf_dir):
    fact = fact_left_md5(spark, sf_dir)
    return build_time(fact, weekday_base="sun0")


@register(
    "time_dim_day_sun1",
    """
WITH s AS (SELECT DISTINCT CAST(ts AS DATE) AS start_time FROM events)
SELECT start_time, 0 AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, CAST(dayofweek(start_time) + 1 AS INTEGER) AS weekday
FROM s
""",
    "C3 E3 E10 (day precision, Sunday = 1)",
)
def time_dim_day_sun1(spark, sf_dir):
    t = Tables(spark, sf_dir)
    days = t.events.select(millis_to_date(to_epoch_millis("ts")).alias("start_time"))
    return build_time(days, weekday_base="sun1")


@register(
    "time_dim_insert_absent",
    """
SELECT DISTINCT o_orderdate AS start_time, CAST(hour(o_orderdate) AS INTEGER) AS hour,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(week(o_orderdate) AS INTEGER) AS week,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday
FROM orders
""",
    "C3 K9 (insert start times not yet loaded)",
)
def time_dim_insert_absent(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dates = t.orders.select(F.col("o_orderdate").alias("start_time"))
    loaded = build_time(dates.where(F.col("start_time") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return build_time(dates, target=loaded)


# ---------------------------------------------------------------------------
# users dimension (C2): four policies over the orders log
# ---------------------------------------------------------------------------

USER_ROWS = """
u AS (SELECT o_custkey AS user_id, o_orderstatus AS first_name, CAST(year(o_orderdate) AS VARCHAR) AS last_name,
             CAST(month(o_orderdate) AS VARCHAR) AS gender, o_orderpriority AS level,
             o_orderdate, o_orderkey FROM orders)
"""

USER_TARGET = """
t AS (SELECT c_custkey AS user_id, c_name AS first_name, CAST(c_nationkey AS VARCHAR) AS last_name,
             CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS gender, c_mktsegment AS level
      FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-05-06'))
"""


@register(
    "users_first",
    f"""
WITH {USER_ROWS}
SELECT user_id, first_name, last_name, gender, level FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate, o_orderkey) AS rn FROM u)
WHERE rn = 1
""",
    "C2 A6 L3 (first row per user wins)",
)
def users_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_users(roles.user_log(t), policy="first", order_by=["ts", "o_orderkey"],
                       page_filter=F.lit(True))


@register(
    "users_distinct",
    f"""
WITH {USER_ROWS}
SELECT DISTINCT user_id, first_name, last_name, gender, level FROM u
""",
    "C2 A4 (SELECT DISTINCT)",
)
def users_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_users(roles.user_log(t), policy="distinct", page_filter=F.lit(True))


@register(
    "users_upsert_level",
    f"""
WITH {USER_ROWS}, {USER_TARGET},
last_u AS (SELECT user_id, level FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM u) WHERE rn = 1),
first_u AS (SELECT user_id, first_name, last_name, gender FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate, o_orderkey) AS rn
    FROM u) WHERE rn = 1)
SELECT t.user_id, t.first_name, t.last_name, t.gender, COALESCE(l.level, t.level) AS level
FROM t LEFT JOIN last_u l ON t.user_id = l.user_id
UNION ALL
SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level
FROM first_u f JOIN last_u l ON f.user_id = l.user_id
WHERE f.user_id NOT IN (SELECT user_id FROM t)
""",
    "C2 K8 (ON CONFLICT DO UPDATE SET level)",
)
def users_upsert_level(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_users(roles.user_log(t), policy="upsert_level", order_by=["ts", "o_orderkey"],
                       target=roles.early_users(t), page_filter=F.lit(True))


@register(
    "users_absent_only",
    f"""
WITH {USER_ROWS}, {USER_TARGET}
SELECT * FROM t
UNION ALL
SELECT DISTINCT user_id, first_name, last_name, gender, level FROM u WHERE user_id NOT IN (SELECT user_id FROM t)
""",
    "C2 K10 F11 J6 (INSERT ... WHERE key NOT IN target)",
)
def users_absent_only(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_users(roles.user_log(t), policy="absent_only", target=roles.early_users(t),
                       page_filter=F.lit(True))


@register(
    "users_upsert_direct",
    f"""
WITH {USER_ROWS}, {USER_TARGET},
last_u AS (SELECT user_id, level FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM u) WHERE rn = 1),
first_u AS (SELECT user_id, first_name, last_name, gender FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate, o_orderkey) AS rn
    FROM u) WHERE rn = 1)
SELECT t.user_id, t.first_name, t.last_name, t.gender, COALESCE(l.level, t.level) AS level
FROM t LEFT JOIN last_u l ON t.user_id = l.user_id
UNION ALL
SELECT f.user_id, f.first_name, f.last_name, f.gender, l.level
FROM first_u f JOIN last_u l ON f.user_id = l.user_id
WHERE f.user_id NOT IN (SELECT user_id FROM t)
""",
    "K8 through the generic upsert operator",
)
def users_upsert_direct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    updates = t.orders.select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("first_name"),
        F.year("o_orderdate").cast("string").alias("last_name"),
        F.month("o_orderdate").cast("string").alias("gender"),
        F.col("o_orderpriority").alias("level"),
        "o_orderdate",
        "o_orderkey",
    )
    return upsert(roles.early_users(t), updates, ["user_id"], ["level"], ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------------------
# songs / artists dimensions
# ---------------------------------------------------------------------------

SONG_ROWS = """
s AS (SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_id, p_size AS year,
             CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS duration, p_brand AS name, p_type AS location,
             CAST(p_size AS DOUBLE) AS latitude, CAST(-p_size AS DOUBLE) AS longitude
      FROM part),
early AS (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-02-21')
"""


@register(
    "artists_first",
    f"""
WITH {SONG_ROWS}
SELECT artist_id, name, location, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY name, location, latitude, longitude) AS rn
    FROM s) WHERE rn = 1
""",
    "C1 A6 K9 (first artist row wins)",
)
def artists_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_artists(roles.song_staging(t), policy="first")


@register(
    "artists_distinct",
    f"""
WITH {SONG_ROWS}
SELECT DISTINCT artist_id, name, location, latitude, longitude FROM s
""",
    "C1 A4",
)
def artists_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_artists(roles.song_staging(t), policy="distinct")


@register(
    "songs_not_in",
    f"""
WITH {SONG_ROWS},
t AS (SELECT song_id, title, artist_id, year, duration FROM s WHERE song_id IN (SELECT l_partkey FROM early))
SELECT * FROM t
UNION ALL
SELECT DISTINCT song_id, title, artist_id, year, duration FROM s
WHERE song_id NOT IN (SELECT song_id FROM t)
""",
    "C1 K10 F11 J6 (dims_not_in)",
)
def songs_not_in(spark, sf_dir):
    t = Tables(spark, sf_dir)
    target = build_songs(roles.early_songs(t), policy="first")
    batch = roles.song_staging(t).select(*target.columns)
    return insert_not_in(target, batch, "song_id")


@register(
    "songs_insert_absent",
    f"""
WITH {SONG_ROWS},
t AS (SELECT song_id, title, artist_id, year, duration FROM s WHERE song_id IN (SELECT l_partkey FROM early)),
b AS (SELECT * FROM (
        SELECT song_id, title, artist_id, year, duration,
               row_number() OVER (PARTITION BY title ORDER BY song_id) AS rn
        FROM s) WHERE rn = 1)
SELECT * FROM t
UNION ALL
SELECT song_id, title, artist_id, year, duration FROM b
WHERE song_id NOT IN (SELECT song_id FROM t)
""",
    "K9 (first song per title from the batch, keys not yet loaded)",
)
def songs_insert_absent(spark, sf_dir):
    t = Tables(spark, sf_dir)
    target = build_songs(roles.early_songs(t), policy="first")
    batch = roles.song_staging(t).select(*target.columns)
    # first song per title arrives first; then ON CONFLICT (song_id) DO NOTHING
    firsts = first_per_key(batch, ["title"], ["song_id"], keep="first")
    return insert_absent(target, firsts, ["song_id"], ["song_id"])


# ---------------------------------------------------------------------------
# events: sequence keys and keyed overwrite
# ---------------------------------------------------------------------------


@register(
    "fact_sequence_key",
    """
SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS songplay_id, event_id, ts, user_id, value
FROM events
""",
    "K14 (dense surrogate key from 0, IDENTITY(0,1))",
)
def fact_sequence_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plays = t.events.select("event_id", "ts", "user_id", "value")
    return dense_ids(plays, ["ts", "event_id"], name="songplay_id", start=0)


@register(
    "keyed_overwrite",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn
    FROM events) WHERE rn = 1
""",
    "K11 A8 (last write per primary key wins)",
)
def keyed_overwrite_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return keyed_overwrite(t.events, ["user_id", "event_type"], ["event_id"])
