"""Dimensions across periods, versions of a table, and checks that can fail."""

import pytest
from pyspark.sql import functions as F

from starweave.operators.quality import DataQualityError
from starweave.operators.versions import current_path, publish, read_current
from starweave.plans.warehouse import load_warehouse
from starweave.session import scratch_path

LOG = "page string, ts long, userId string, firstName string, lastName string, gender string, level string, " \
      "sessionId long, location string, userAgent string, song string, artist string, length double"
SONGS = "song_id string, title string, artist_id string, artist_name string, year int, duration double, " \
        "artist_location string, artist_latitude double, artist_longitude double"
HOUR = 3_600_000


def _play(user, level, hour, session, song="s"):
    return ("NextSong", hour * HOUR, user, f"F{user}", f"L{user}", "F", level, session, "here", "agent", song, "a", 1.0)


def _songs(spark, *ids):
    return spark.createDataFrame([(i, i, f"A{i}", "a", 2000, 1.0, "x", 1.5, None) for i in ids], SONGS)


def test_users_of_the_first_hour_survive_the_second(spark):
    dst = scratch_path(spark, "hours")
    one = spark.createDataFrame([_play("1", "free", 1, 10)], LOG)
    two = spark.createDataFrame([_play("2", "paid", 2, 11), _play("1", "paid", 2, 12, "t")], LOG)
    load_warehouse(spark, one, _songs(spark, "s"), dst)
    result = load_warehouse(spark, two, _songs(spark, "t"), dst, on_failure="raise")
    table = lambda n: spark.read.parquet(result.paths[n])
    users = {r.user_id: (r.first_name, r.last_name, r.gender, r.level) for r in table("users").collect()}
    assert users == {"1": ("F1", "L1", "F", "paid"), "2": ("F2", "L2", "F", "paid")}
    assert {r.song_id for r in table("songs").collect()} == {"s", "t"}
    assert {(r.artist_id, r.latitude) for r in table("artists").collect()} == {("As", 1.5), ("At", 1.5)}
    assert table("time").count() == 2
    fact = table("songplays")
    assert fact.count() == 3 and {(r.location, r.user_agent) for r in fact.collect()} == {("here", "agent")}
    assert all(r.passed for r in result.checks.collect())


def test_truncating_users_breaks_the_reference_and_the_checks_say_so(spark):
    dst = scratch_path(spark, "hours-truncate")
    modes = {"users": "truncate"}
    load_warehouse(spark, spark.createDataFrame([_play("1", "free", 1, 10)], LOG), _songs(spark, "s"), dst, dim_modes=modes)
    two = spark.createDataFrame([_play("2", "paid", 2, 11)], LOG)
    with pytest.raises(DataQualityError, match="user_id"):
        load_warehouse(spark, two, _songs(spark, "s"), dst, dim_modes=modes, on_failure="raise")


def test_a_null_user_fails_the_null_check(spark):
    dst = scratch_path(spark, "hours-null")
    log = spark.createDataFrame([_play(None, "free", 1, 10)], LOG)
    result = load_warehouse(spark, log, _songs(spark, "s"), dst)
    bad = [(r.table_name, r.check_name, r.value) for r in result.checks.collect() if not r.passed]
    assert ("users", "not_null", 1) in bad


def test_append_mode_adds_every_period(spark):
    dst = scratch_path(spark, "hours-append")
    log = spark.createDataFrame([_play("1", "free", 1, 10)], LOG)
    for _ in range(2):
        result = load_warehouse(spark, log, _songs(spark, "s"), dst, dim_modes={"songs": "append"})
    assert spark.read.parquet(result.paths["songs"]).count() == 2
    with pytest.raises(ValueError):
        load_warehouse(spark, log, _songs(spark, "s"), dst, dim_modes={"songs": "upsert"})


def test_a_failed_version_leaves_the_one_before(spark):
    base = scratch_path(spark, "versions")
    assert read_current(spark, base) is None
    publish(spark.range(3), base)
    with pytest.raises(Exception):
        publish(spark.range(3).select(F.assert_true(F.col("id") < 2), "id"), base)
    assert read_current(spark, base).count() == 3
    for n in (4, 5, 6):
        publish(read_current(spark, base).union(spark.range(1)), base)
        assert read_current(spark, base).count() == n
    assert current_path(spark, base).endswith("v00000005")


def test_a_load_compares_rows_once_and_stages_no_second_copy_of_the_fact(spark):
    """Repeated, rerun and late rows are told apart without the derived columns, in one grouping."""
    import glob
    import os

    from starweave.session import checkpoint_root

    copies = lambda: set(glob.glob(os.path.join(checkpoint_root(spark), "starweave", "append-batch-*")))
    dst, before = scratch_path(spark, "once"), copies()
    old = ("NextSong", -500, "3", "F3", "L3", "F", "free", 12, None, "agent", "s", "a", 1.0)  # half a second before 1970
    one = [_play("1", "free", 1, 10), _play("1", "free", 1, 10), _play(None, "free", 2, None), old]
    two = one + [_play("2", "paid", 800, 11), _play("1", "free", 1, 10, "t"), (*_play("4", "free", 3, 13)[:1], None, *_play("4", "free", 3, 13)[2:])]
    for rows in (one, two, two):
        result = load_warehouse(spark, spark.createDataFrame(rows, LOG), _songs(spark, "s"), dst)
    fact = spark.read.parquet(result.paths["songplays"])
    got = sorted(((r.user_id, r.session_id, r.song_id, r.year, r.month) for r in fact.collect()), key=str)
    assert got == sorted([("1", 10, "s", 1970, 1), (None, None, "s", 1970, 1), ("3", 12, "s", 1970, 1), ("2", 11, "s", 1970, 2),
                          ("1", 10, None, 1970, 1), ("4", 13, "s", None, None)], key=str)
    again = F.md5(F.concat(F.col("session_id").cast("string"), F.col("start_time").cast("string")))
    assert fact.where(~F.col("songplay_id").eqNullSafe(again)).count() == 0
    nulls = {r.column_name: r.n for r in spark.read.parquet(current_path(spark, f"{dst}/_quality/songplays/measures"))
             .groupBy("column_name").agg(F.sum("n_rows").alias("n")).collect()}
    assert nulls["user_id"] == 6  # every period's checks are there, the one before 1970 and the unknown one too
    assert copies() == before


def test_orphans_are_the_rows_of_lost_keys_in_every_period(spark):
    from starweave.operators.quality_state import Reference, refresh, state_report

    base = scratch_path(spark, "lost")
    rows = spark.createDataFrame([(1, 2020), (1, 2021), (2, 2020), (2, 2021), (2, 2021), (None, 2020)], "k int, p int")
    refs = {"k": Reference("id", dim=spark.createDataFrame([(1,), (None,)], "id int"))}
    value = lambda: {r.check_name: r.value for r in state_report(spark, base, "t", references=refs).collect()}["references=id"]
    refresh(rows, base, ["p"], {"k": "k"}, refs)
    assert value() == 3
    refs = {"k": Reference("id", dim=spark.createDataFrame([(1,), (2,)], "id int"))}
    refresh(rows.where("p = 2020"), base, ["p"], {"k": "k"}, refs)
    assert value() == 0
