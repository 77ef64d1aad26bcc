"""End-to-end flows: the ordered warehouse load, the repeated-batch stream
load, and the star query the schema is built for."""

from __future__ import annotations

from pyspark.sql import functions as F

from starweave.plans import roles
from starweave.plans.music_queries import PLAYS, SECONDS, SONG_ROWS
from starweave.plans.warehouse import load_warehouse
from starweave.plans.registry import register
from starweave.plans.roles import Tables
from starweave.session import scratch_path
from starweave.operators.loads import write_table
from starweave.sources.schemas import table_schema
from starweave.streaming.incremental import incremental_load


# The log comes in two periods; the catalogue of the first holds the early songs only.
SECOND_PERIOD_MS = 893_980_800_000  # 1998-05-01


def _two_periods(spark, sf_dir, again=False):
    t = Tables(spark, sf_dir)
    dst = scratch_path(spark, "warehouse")
    log = roles.play_log(t)
    first, second = (log.where(c) for c in (F.col("ts") < SECOND_PERIOD_MS, F.col("ts") >= SECOND_PERIOD_MS))
    whole = roles.song_staging(t)
    periods = [(first, roles.early_songs(t).select(*whole.columns)), (second, whole)]
    for events, songs in periods + periods[1:] * again:
        result = load_warehouse(
            spark, events, songs, dst, how="left", page_filter=roles.play_filter(),
            key_source=(roles.song_keys(t), "l_partkey", "p_partkey"),
            users_order=["ts", "sessionId", "itemInSession"], optional=("firstName", "lastName", "gender"),
        )
    return result


PERIODS = f"""
WITH {PLAYS},
{SONG_ROWS.strip()},
f AS (SELECT *, {SECONDS} AS start_time FROM plays),
fact AS (
  SELECT md5(CAST(f.session_id AS VARCHAR) || CAST(f.start_time AS VARCHAR)) AS songplay_id,
         f.start_time, f.user_id, f.level, g.song_id, g.artist_id, f.session_id,
         f.location, f.user_agent
  FROM f LEFT JOIN songs g ON f.song = g.title AND f.artist = g.artist_name AND f.length = g.duration
    AND (f.ts >= {SECOND_PERIOD_MS} OR g.song_id IN (SELECT l_partkey FROM early))),
users AS (
  SELECT user_id, level FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, session_id DESC, item DESC) AS rn
    FROM plays) WHERE rn = 1),
artists AS (
  SELECT artist_id, name, location, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id NOT IN (SELECT l_partkey FROM early),
             name, location, latitude, longitude) AS rn
    FROM s) WHERE rn = 1),
times AS (SELECT DISTINCT start_time FROM f)
"""


@register(
    "warehouse_load",
    PERIODS + "SELECT * FROM fact",
    "section 3.2 K5 K7 (stage -> fact -> dims -> checks; two periods, the last one twice)",
)
def warehouse_load(spark, sf_dir):
    # the second period is delivered twice: a rerun changes nothing
    return spark.read.parquet(_two_periods(spark, sf_dir, again=True).paths["songplays"]).drop("year", "month")


@register("warehouse_users", PERIODS + "SELECT * FROM users", "K8 C2 (users of both periods, last level)")
def warehouse_users(spark, sf_dir):
    return spark.read.parquet(_two_periods(spark, sf_dir).paths["users"]).select("user_id", "level")


@register(
    "warehouse_dims",
    PERIODS
    + """
SELECT 'songs' AS table_name, CAST(song_id AS VARCHAR) AS id, title AS a, artist_id AS b, CAST(year AS VARCHAR) AS c FROM s
UNION ALL SELECT 'artists', artist_id, name, location, CAST(latitude AS VARCHAR) FROM artists
UNION ALL SELECT 'time', CAST(start_time AS VARCHAR), CAST(hour(start_time) AS VARCHAR),
  CAST(week(start_time) AS VARCHAR), CAST(dayofweek(start_time) AS VARCHAR) FROM times
""",
    "K9 C1 C3 S12 (songs, artists and time keep earlier periods)",
)
def warehouse_dims(spark, sf_dir):
    paths = _two_periods(spark, sf_dir).paths
    songs, artists, time = (spark.read.parquet(paths[n]) for n in ("songs", "artists", "time"))
    text = lambda c: F.col(c).cast("string")
    return (
        songs.select(F.lit("songs").alias("table_name"), text("song_id").alias("id"), F.col("title").alias("a"),
                     F.col("artist_id").alias("b"), text("year").alias("c"))
        .union(artists.select(F.lit("artists"), "artist_id", "name", "location", text("latitude")))
        .union(time.select(F.lit("time"), text("start_time"), text("hour"), text("week"), text("weekday")))
    )


def _key_checks(name: str, source: str, key: str) -> str:
    return f"""
SELECT '{name}' AS table_name, '*' AS column_name, 'min_rows' AS check_name, COUNT(*) AS value, COUNT(*) >= 1 AS passed FROM {source}
UNION ALL SELECT '{name}', '{key}', 'not_null', 0, TRUE UNION ALL SELECT '{name}', '{key}', 'unique', 0, TRUE
UNION ALL SELECT 'songplays', '{key}', 'references={key}', COUNT(*), COUNT(*) = 0 FROM fact
  WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {source})
"""


@register(
    "warehouse_checks",
    PERIODS + "UNION ALL".join(_key_checks(n, x, k) for n, x, k in (
        ("users", "users", "user_id"), ("songs", "s", "song_id"), ("artists", "artists", "artist_id"), ("time", "times", "start_time"))),
    "Q1 Q2 Q3 Q6 Q8 K15 (checks of the loaded tables, run in the load)",
)
def warehouse_checks(spark, sf_dir):
    return _two_periods(spark, sf_dir).checks


@register(
    "stream_append_new",
    "SELECT * FROM orders",
    "K5 K9 S13 (hourly re-load as a stream: new files, duplicates across batches)",
)
def stream_append_new(spark, sf_dir):
    t = Tables(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    write_table(t.orders, landing, rebalance=True)
    # a late re-delivery of one period lands again as new files
    late = t.orders.where(F.year("o_orderdate") == F.lit(1998))
    write_table(late, landing, mode="append")
    target = scratch_path(spark, "orders_loaded")
    checkpoint = scratch_path(spark, "orders_stream_ckpt")
    schema = table_schema("orders")
    # stored by order year: a batch is compared only with the years it touches
    years = {"year": F.year("o_orderdate")}
    incremental_load(spark, landing, schema, target, ["o_orderkey"], ["o_orderdate", "o_orderkey"],
                     checkpoint, partitions=years)
    # a second run resumes from the checkpoint: nothing new, nothing doubled
    incremental_load(spark, landing, schema, target, ["o_orderkey"], ["o_orderdate", "o_orderkey"],
                     checkpoint, partitions=years)
    return spark.read.parquet(target).select(*schema.fieldNames())


@register(
    "star_revenue",
    """
SELECT r.r_name, CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))))
            AS DOUBLE) AS revenue,
       COUNT(DISTINCT o.o_orderkey) AS n_orders
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
""",
    "G1 (ours: revenue by region and year over the star)",
)
def star_revenue(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # revenue per order first: a partial aggregate whose output is already
    # partitioned on the order key, so the join with orders adds no exchange
    # on this side and meets one row per order instead of every line
    rev = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(rev).alias("rev"))
    o = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    geo = (t.customer.select("c_custkey", "c_nationkey")
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("c_custkey", "r_name"))
    joined = (per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(geo, F.col("o_custkey") == F.col("c_custkey")))
    return joined.groupBy("r_name", "order_year").agg(
        F.sum("rev").cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("n_orders"),
    )
