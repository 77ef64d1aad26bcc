"""The driver tables in the vocabulary of the reference's star schemas.

Role mapping (whole tables, no subsets):

* ``lineitem`` is the activity log: one play per line, session = order key,
  item in session = line number, user = supplier key, level = return flag,
  page = line status (``'O'`` plays the part of ``'NextSong'``), ts = ship
  time in epoch milliseconds, location = tax, user agent = discount, and a
  foreign key to the part played.
* ``part`` holds the natural key of a play (song = name, artist = brand,
  length = retail price) and is the song metadata the plays are matched
  against. The catalogue has no duration for parts of type PROMO, so plays of
  those find no song and the left/inner/anti semantics show.
* ``events`` is a second log with microsecond timestamps (time conversions,
  sequence keys, keyed overwrite); ``orders`` is a log of users whose
  level (order priority) changes over time; ``customer`` is a users table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.time import to_epoch_millis
from starweave.session import use_utc
from starweave.sources.readers import load_table

PLAY_PAGE = "O"
#: Parts of this type are in the catalogue without a duration.
UNTIMED_TYPE = "PROMO"
#: What was loaded before this day is the earlier period of the load queries.
EARLY_SHIPMENTS, EARLY_ORDERS = "1995-02-21", "1995-05-06"


class Tables:
    """Lazily opened driver tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = use_utc(spark)
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = load_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def play_log(t: Tables) -> DataFrame:
    """lineitem as an activity log (raw LOG column names)."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("sessionId"),
        F.col("l_linenumber").alias("itemInSession"),
        F.col("l_suppkey").alias("userId"),
        F.col("l_returnflag").alias("level"),
        F.col("l_linestatus").alias("page"),
        to_epoch_millis("l_shipdate").alias("ts"),
        F.col("l_tax").cast("string").alias("location"),
        F.col("l_discount").cast("string").alias("userAgent"),
        F.col("l_partkey"),
    )


def play_filter():
    return F.col("page") == F.lit(PLAY_PAGE)


def song_keys(t: Tables) -> DataFrame:
    """The natural key of every part: what a play of that part carries."""
    return t.part.select(
        "p_partkey",
        F.col("p_name").alias("song"),
        F.col("p_brand").alias("artist"),
        F.col("p_retailprice").alias("length"),
    )


def play_log_with_keys(t: Tables) -> DataFrame:
    """The log with its natural key resolved (lineitem joined to part)."""
    keys = song_keys(t)
    log = play_log(t)
    return log.join(keys, log["l_partkey"] == keys["p_partkey"]).drop("p_partkey")


def song_staging(t: Tables) -> DataFrame:
    """part in the song-metadata layout."""
    timed = F.when(F.col("p_type") != F.lit(UNTIMED_TYPE), F.col("p_retailprice"))
    return t.part.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        timed.alias("duration"),
        F.col("p_size").alias("year"),
        F.col("p_type").alias("artist_location"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        (F.lit(0) - F.col("p_size")).cast("double").alias("artist_longitude"),
    )


def early_songs(t: Tables) -> DataFrame:
    """The songs an earlier period loaded: those shipped by then."""
    shipped = t.lineitem.where(F.col("l_shipdate") < F.lit(EARLY_SHIPMENTS).cast("timestamp_ntz"))
    return song_staging(t).join(shipped.select(F.col("l_partkey").alias("song_id")), "song_id", "left_semi")


def early_users(t: Tables) -> DataFrame:
    """The users an earlier period loaded: customers who had ordered by then."""
    ordered = t.orders.where(F.col("o_orderdate") < F.lit(EARLY_ORDERS).cast("timestamp_ntz"))
    seen = t.customer.join(ordered.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    return seen.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_nationkey").cast("string").alias("last_name"),
        F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("gender"),
        F.col("c_mktsegment").alias("level"),
    )


def user_log(t: Tables) -> DataFrame:
    """orders as a users log: level = priority, name = status, ts = date."""
    return t.orders.select(
        F.col("o_custkey").alias("userId"),
        F.col("o_orderstatus").alias("firstName"),
        F.year("o_orderdate").cast("string").alias("lastName"),
        F.month("o_orderdate").cast("string").alias("gender"),
        F.col("o_orderpriority").alias("level"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey"),
    )
