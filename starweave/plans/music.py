"""The music-log star schema (C1-C4): songs, artists, users, time, songplays.

The reference builds this schema four times with different semantics; here
each difference is a parameter:

* join ``how``: ``inner`` (exact match, every match kept), ``left`` (plays
  kept without a song), ``first_match`` (at most one song per play);
* ``rounded``: compare lengths after ``numeric(18,0)`` rounding;
* ``precision`` of the start time: millisecond, second or day;
* ``weekday_base`` of the time dimension: mon0, sun0, sun1;
* dedupe policy of the dimensions: any / distinct / first / upsert / absent.

Inputs use the raw layouts in ``sources.schemas`` (``LOG``, ``SONG``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.text import md5_key
from starweave.functions.time import start_time, time_parts
from starweave.operators.clean import dedupe, distinct_rows, first_per_key
from starweave.operators.joins import natural_key_join
from starweave.operators.loads import dense_ids, insert_absent, insert_not_in, upsert

NEXT_SONG = "NextSong"

# Natural key of a play against the song metadata: (log column, song column).
PLAY_KEY = [("song", "title"), ("artist", "artist_name"), ("length", "duration")]

SONG_COLUMNS = {
    "song_id": "song_id",
    "title": "title",
    "artist_id": "artist_id",
    "year": "year",
    "duration": "duration",
}
ARTIST_COLUMNS = {
    "artist_id": "artist_id",
    "name": "artist_name",
    "location": "artist_location",
    "latitude": "artist_latitude",
    "longitude": "artist_longitude",
}
USER_COLUMNS = {
    "user_id": "userId",
    "first_name": "firstName",
    "last_name": "lastName",
    "gender": "gender",
    "level": "level",
}


FACT_COLUMNS = {
    "start_time": "start_time",
    "user_id": "userId",
    "level": "level",
    "song_id": "song_id",
    "artist_id": "artist_id",
    "session_id": "sessionId",
    "location": "location",
    "user_agent": "userAgent",
}


def _layout(df: DataFrame, mapping: dict[str, str], optional: Sequence[str] = ()) -> list[Column]:
    """The star columns; a source column that is absent must be named in ``optional``."""
    absent = [src for src in mapping.values() if src not in df.columns and src not in optional]
    if absent:
        raise ValueError(f"source columns missing: {absent} (name them in optional to leave them out)")
    return [F.col(src).alias(dst) for dst, src in mapping.items() if src in df.columns]


def _project(df: DataFrame, mapping: dict[str, str], optional: Sequence[str] = ()) -> DataFrame:
    """Rename into the star layout."""
    return df.select(_layout(df, mapping, optional))


def _dimension(
    rows: DataFrame,
    key: str,
    policy: str,
    order_by,
    target: DataFrame | None,
) -> DataFrame:
    """The four dedupe rules of C1/C2 applied to projected rows."""
    if policy == "any":  # dropDuplicates([key]): any row per key
        return dedupe(rows, [key])
    if policy == "distinct":  # SELECT DISTINCT: one row per distinct row
        return distinct_rows(rows)
    if policy == "first":  # ON CONFLICT DO NOTHING over arrival order
        if target is not None:
            return insert_absent(target, rows, [key], order_by)
        return first_per_key(rows, [key], order_by, keep="first")
    if policy == "absent_only":  # DISTINCT ... WHERE key NOT IN target
        if target is None:
            return distinct_rows(rows)
        return insert_not_in(target, rows, key)
    raise ValueError(f"unknown dimension policy {policy!r}")


def build_songs(
    song_df: DataFrame, policy: str = "first", order_by=None, target=None, optional: Sequence[str] = ()
) -> DataFrame:
    """Songs dimension from song metadata."""
    rows = _project(song_df, SONG_COLUMNS, optional)
    return _dimension(rows, "song_id", policy, order_by or ["song_id"], target)


def build_artists(
    song_df: DataFrame, policy: str = "first", order_by=None, target=None, optional: Sequence[str] = ()
) -> DataFrame:
    """Artists dimension from song metadata."""
    rows = _project(song_df, ARTIST_COLUMNS, optional)
    return _dimension(rows, "artist_id", policy, order_by or ["artist_id"], target)


def next_song(log: DataFrame, page_filter: Column | None = None) -> DataFrame:
    """the plays of an activity log (``page = 'NextSong'``)."""
    return log.where(page_filter if page_filter is not None else F.col("page") == F.lit(NEXT_SONG))


def build_users(
    log: DataFrame,
    policy: str = "upsert_level",
    order_by=None,
    target: DataFrame | None = None,
    page_filter: Column | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """Users dimension from the plays of a log.

    ``any`` (one row per user, arbitrary), ``distinct`` (one row per distinct
    user row: a user seen at two levels appears twice), ``first`` (first row
    per user by ``order_by``), ``upsert_level`` (names from the first row,
    level from the last), ``absent_only`` (distinct rows of users not yet in
    ``target``).
    """
    plays = next_song(log, page_filter)
    order_by = order_by or ["ts"]
    user_cols = _layout(plays, USER_COLUMNS, optional)
    if policy in ("upsert_level", "first"):
        seq = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by]).alias("_seq")
        ordered = plays.select(*user_cols, seq)
    if policy == "upsert_level":
        base = target if target is not None else ordered.drop("_seq").limit(0)
        return upsert(base, ordered, ["user_id"], ["level"], ["_seq"])
    if policy == "first":
        first = first_per_key(ordered, ["user_id"], ["_seq"], keep="first").drop("_seq")
        if target is None:
            return first
        return insert_absent(target, first, ["user_id"], ["user_id"])
    return _dimension(plays.select(*user_cols), "user_id", policy, None, target)


def build_time(
    times: DataFrame,
    column: str = "start_time",
    weekday_base: str = "mon0",
    target: DataFrame | None = None,
) -> DataFrame:
    """Time dimension: distinct start times with their parts.

    ``times`` is any frame with a start-time column: the plays of a log, or
    the loaded fact (the warehouse variants read ``songplays``). With a
    ``target`` only start times not yet present are added (K9).
    """
    rows = times.select(F.col(column).alias("start_time")).where(F.col("start_time").isNotNull()).distinct()
    dim = rows.select("start_time", *time_parts("start_time", weekday_base))
    if target is None:
        return dim
    return insert_absent(target, dim, ["start_time"], ["start_time"])


def match_songs(
    keys: DataFrame,
    songs: DataFrame,
    how: str = "left",
    rounded: bool = False,
    on: Sequence[tuple[str, str]] = PLAY_KEY,
    song_cols: Sequence[str] = ("song_id", "artist_id"),
) -> DataFrame:
    """The natural-key match (J1-J4) of rows carrying (song, artist, length)."""
    key_cols = [rc for _, rc in on if rc not in song_cols]
    dim = songs.select(*dict.fromkeys(key_cols), *song_cols)
    joined = natural_key_join(
        keys,
        dim,
        on,
        how=how,
        dim_order=[F.col(c) for c in song_cols],
        rounded=["length"] if rounded else (),
    )
    return joined.select(*keys.columns, *song_cols)


def build_songplays(
    log: DataFrame,
    songs: DataFrame,
    how: str = "left",
    key: str = "md5",
    precision: str = "second",
    rounded: bool = False,
    page_filter: Column | None = None,
    key_source: tuple[DataFrame, str, str] | None = None,
    distinct: bool = False,
    id_start: int = 1,
    optional: Sequence[str] = (),
) -> DataFrame:
    """C4: the songplays fact.

    * ``how``: inner | left | first_match (see ``natural_key_join``).
    * ``key``: ``md5`` of session id and start time, ``sequence`` (dense ids
      from ``id_start`` in start-time order: 1 like ``serial``, 0 like
      ``IDENTITY(0,1)``), or ``none``.
    * ``distinct``: SELECT DISTINCT over the fact columns (warehouse variant).
    * ``key_source=(dim, fk, pk)``: the log does not carry the natural key
      itself but a foreign key ``fk`` into ``dim`` that holds (song, artist,
      length). The song match is then computed once per ``dim`` row and the
      log joins it on ``fk``: one shuffle of the log instead of two, or
      none where the planner or AQE broadcasts the matched dimension.
      Building the frame starts no job.
    """
    plays = next_song(log, page_filter).withColumn("start_time", start_time("ts", precision))
    if key_source is None:
        fact = match_songs(plays, songs, how, rounded)
    else:
        dim, fk, pk = key_source
        matched = match_songs(dim, songs, how, rounded).drop(*[c for c in dim.columns if c != pk])
        fact = plays.join(matched, plays[fk] == matched[pk], "inner").drop(matched[pk])
    out = _project(fact, FACT_COLUMNS, optional)
    if distinct:
        out = out.distinct()
    if key == "md5":
        return out.select(md5_key("session_id", "start_time").alias("songplay_id"), *out.columns)
    if key == "sequence":
        return dense_ids(out, [F.col("start_time"), *[F.col(c) for c in out.columns if c != "start_time"]],
                         name="songplay_id", start=id_start)
    if key == "none":
        return out
    raise ValueError("key must be md5, sequence or none")
