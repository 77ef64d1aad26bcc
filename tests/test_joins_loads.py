"""Joins and load modes on literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from starweave.operators import (
    anti_join,
    append,
    append_new,
    dedupe,
    dense_ids,
    first_per_key,
    insert_absent,
    insert_not_in,
    keyed_overwrite,
    natural_key_join,
    not_in,
    read_if_exists,
    truncate_insert,
    upsert,
)
from starweave.plans.music import build_songplays, build_users
from starweave.session import scratch_path
from starweave.sources.schemas import LOG, SONG

T0 = 1541106106796


def _log(spark):
    rows = [
        # one match, one miss, one matching two songs, one non-play
        ("A", "Ann", "F", 0, "Lee", 200.0, "free", "X", "PUT", "NextSong", 1, "s1", T0, "ua", 7),
        ("B", "Ann", "F", 1, "Lee", 100.0, "free", "X", "PUT", "NextSong", 1, "nope", T0 + 1000, "ua", 7),
        ("C", "Bob", "M", 0, "Kim", 300.0, "paid", "Y", "PUT", "NextSong", 2, "s3", T0 + 2000, "ua", 8),
        ("A", "Bob", "M", 1, "Kim", 200.0, "paid", "Y", "GET", "Home", 2, "s1", T0 + 3000, "ua", 8),
    ]
    data = [
        {"artist": r[0], "firstName": r[1], "gender": r[2], "itemInSession": r[3], "lastName": r[4],
         "length": r[5], "level": r[6], "location": r[7], "method": r[8], "page": r[9],
         "sessionId": r[10], "song": r[11], "ts": r[12], "userAgent": r[13], "userId": r[14],
         "auth": None, "registration": None, "status": 200}
        for r in rows
    ]
    return spark.createDataFrame([tuple(d[f.name] for f in LOG.fields) for d in data], LOG)


def _songs(spark):
    rows = [
        (1, "AR1", None, None, None, "A", "S1", "s1", 200.0, 2000),
        (1, "AR3", None, None, None, "C", "S3a", "s3", 300.0, 2001),
        (1, "AR3", None, None, None, "C", "S3b", "s3", 300.0, 2001),
        (1, "AR9", None, None, None, "B", "S9", "nope", 216.2, 2001),
    ]
    return spark.createDataFrame(rows, SONG)


def test_three_join_semantics(spark):
    log, songs = _log(spark), _songs(spark)
    inner = build_songplays(log, songs, how="inner", key="none")
    left = build_songplays(log, songs, how="left", key="none")
    first = build_songplays(log, songs, how="first_match", key="none")
    assert inner.count() == 3  # the miss dropped, the double match doubled
    assert left.count() == 4
    assert first.count() == 3
    firsts = {r.session_id: r.song_id for r in first.where(F.col("user_id") == 8).collect()}
    assert firsts == {2: "S3a"}  # smallest song id wins


def test_rounded_join_matches_nearby_lengths(spark):
    log = spark.createDataFrame([("nope", "B", 215.6)], "song string, artist string, length double")
    songs = _songs(spark)
    on = [("song", "title"), ("artist", "artist_name"), ("length", "duration")]
    assert natural_key_join(log, songs, on, how="inner").count() == 0
    assert natural_key_join(log, songs, on, how="inner", rounded=["length"]).count() == 1


def test_md5_key_is_whole_second(spark):
    fact = build_songplays(_log(spark), _songs(spark), how="left", key="md5")
    r = fact.where(F.col("song_id") == "S1").first()
    assert r.start_time == dt.datetime(2018, 11, 1, 21, 1, 46)
    assert len(r.songplay_id) == 32


def test_not_in_null_rules(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(2,)], "k int")
    assert sorted(r.k for r in not_in(df, "k", target, "k").collect()) == [1]
    with_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert not_in(df, "k", with_null, "k").count() == 0
    assert anti_join(df, target, [("k", "k")]).count() == 2  # 1 and null


def test_user_policies(spark):
    less = {"optional": ("lastName", "gender")}  # absent from this log
    rows = [(7, "Ann", "free", 1), (7, "Anna", "paid", 2), (8, "Bob", "free", 3)]
    log = spark.createDataFrame(rows, "userId int, firstName string, level string, ts bigint") \
        .withColumn("page", F.lit("NextSong"))
    up = {r.user_id: (r.first_name, r.level) for r in build_users(log, "upsert_level", **less).collect()}
    assert up == {7: ("Ann", "paid"), 8: ("Bob", "free")}
    assert build_users(log, "distinct", **less).where("user_id = 7").count() == 2
    first = {r.user_id: (r.first_name, r.level) for r in build_users(log, "first", **less).collect()}
    assert first[7] == ("Ann", "free")


def test_upsert_keeps_target_columns(spark):
    target = spark.createDataFrame([(7, "Old", "free")], "user_id int, first_name string, level string")
    updates = spark.createDataFrame([(7, "New", "paid", 1), (9, "Zed", "free", 2), (9, "Zed2", "paid", 3)],
                                    "user_id int, first_name string, level string, seq int")
    got = {r.user_id: (r.first_name, r.level) for r in upsert(target, updates, ["user_id"], ["level"], "seq").collect()}
    assert got == {7: ("Old", "paid"), 9: ("Zed", "paid")}


def test_insert_absent_and_not_in(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "z", 1), (2, "b", 2), (2, "c", 3)], "k int, v string, seq int")
    got = sorted((r.k, r.v) for r in insert_absent(target, batch, ["k"], "seq").collect())
    assert got == [(1, "a"), (2, "b")]
    got = sorted((r.k, r.v) for r in insert_not_in(target, batch.drop("seq"), "k").collect())
    assert got == [(1, "a"), (2, "b"), (2, "c")]  # DISTINCT is over whole rows


def test_first_and_last_per_key_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "a"), (1, 9, "q"), (2, 1, "m")], "k int, seq int, v string")
    first = {r.k: r.v for r in first_per_key(df, ["k"], "seq").collect()}
    assert first == {1: "a", 2: "m"}  # tie on seq broken by the row
    last = {r.k: r.v for r in keyed_overwrite(df, ["k"], "seq").collect()}
    assert last == {1: "q", 2: "m"}
    assert dedupe(df).count() == 4
    assert dedupe(df, ["k"]).count() == 2


def test_dense_ids_match_row_number(spark):
    from pyspark.sql import Window

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("x"))
    ids = dense_ids(df, "x", name="sk", start=1, num_partitions=7)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("x")))
    assert sorted(map(tuple, ids.select("sk", "x").collect())) == sorted(map(tuple, expected.select("sk", "x").collect()))


def test_rerun_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    p_append, p_new, p_trunc = (scratch_path(spark, n) for n in ("a", "n", "t"))
    for _ in range(2):
        append(df, p_append)
        append_new(df, p_new, ["k", "v"])
        truncate_insert(df, p_trunc)
    assert spark.read.parquet(p_append).count() == 4
    assert spark.read.parquet(p_new).count() == 2  # null key part compared null-safely
    assert spark.read.parquet(p_trunc).count() == 2
    assert read_if_exists(spark, scratch_path(spark, "missing")) is None


def test_append_new_partitioned_prunes_untouched_periods(spark):
    """A batch is compared only with the stored periods it touches.

    An unreadable file sits in a period the batch does not touch: the append
    succeeds only if that directory is pruned from the stored scan.
    """
    import os

    schema = "k int, v string, year int, month int"
    first = spark.createDataFrame([(1, "a", 2020, 1), (2, "b", 2020, 2), (3, "c", 2021, 1)], schema)
    path = scratch_path(spark, "periods")
    append_new(first, path, ["k", "year", "month"], partition_by=["year", "month"])
    with open(os.path.join(path, "year=2020", "month=2", "part-broken.parquet"), "wb") as fh:
        fh.write(b"not parquet")

    # touches (2020, 1) and (2021, 1): one key already stored, one new, one
    # row with a null period (its own directory)
    batch = spark.createDataFrame(
        [(1, "a", 2020, 1), (4, "d", 2021, 1), (5, "e", None, None)], schema)
    for _ in range(2):  # the rerun appends nothing
        append_new(batch, path, ["k", "year", "month"], partition_by=["year", "month"])
    stored = spark.read.schema(schema).parquet(path).where(
        ~(F.col("year").eqNullSafe(2020) & F.col("month").eqNullSafe(2)))
    assert sorted((r.k, r.year, r.month) for r in stored.collect()) == [
        (1, 2020, 1), (3, 2021, 1), (4, 2021, 1), (5, None, None)]


def test_dense_ids_independent_of_read_splits(spark):
    """The stored rows are read back in many small splits; ids stay dense and ordered."""
    from pyspark.sql import Window

    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20000).alias("x"), F.lit("pad").alias("p"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted(map(tuple, dense_ids(df, "x", name="sk", start=0, num_partitions=3).select("sk", "x").collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = df.select((F.row_number().over(Window.orderBy("x")) - 1).alias("sk"), "x")
    assert got == sorted(map(tuple, expected.collect()))


def test_read_if_exists_raises_on_other_errors(spark):
    import pytest
    from pyspark.sql.utils import AnalysisException

    assert read_if_exists(spark, scratch_path(spark, "nothing-here")) is None
    path = scratch_path(spark, "stored")
    spark.createDataFrame([(1,)], "k int").write.parquet(path)
    assert read_if_exists(spark, path).count() == 1
    # an analysis error other than "nothing stored" is not mistaken for an empty target
    with pytest.raises(AnalysisException):
        read_if_exists(spark, path, schema="k int, k int")


def test_append_new_truncates_its_staged_batch(spark):
    import glob
    import os

    from starweave.session import checkpoint_root

    schema = "k int, year int"
    path = scratch_path(spark, "staged-cleanup")
    df = spark.createDataFrame([(1, 2020), (2, 2021)], schema)
    append_new(df, path, ["k", "year"], partition_by=["year"])
    before = set(glob.glob(os.path.join(checkpoint_root(spark), "starweave", "append-batch-*")))
    append_new(df.union(spark.createDataFrame([(3, 2021)], schema)), path, ["k", "year"], partition_by=["year"])
    staged = set(glob.glob(os.path.join(checkpoint_root(spark), "starweave", "append-batch-*"))) - before
    assert len(staged) == 1
    assert spark.read.parquet(staged.pop()).count() == 0
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_upsert_picks_deterministically_among_duplicate_target_rows(spark):
    target = spark.createDataFrame([(1, "b", "free"), (1, "a", "paid"), (2, "c", "free")],
                                   "user_id int, name string, level string")
    updates = spark.createDataFrame([(2, "z", "paid", 5)], "user_id int, name string, level string, ts int")
    got = {r.user_id: (r.name, r.level) for r in upsert(target, updates, ["user_id"], ["level"], "ts").collect()}
    # key 1: no update; its row is the smallest of its target rows, whole
    # key 2: name kept from the target, level from the update
    assert got == {1: ("a", "paid"), 2: ("c", "paid")}
    # an update that sets the column to null is applied, not skipped
    nulled = updates.union(spark.createDataFrame([(2, "z", None, 6)], updates.schema))
    got = {r.user_id: r.level for r in upsert(target, nulled, ["user_id"], ["level"], "ts").collect()}
    assert got == {1: "paid", 2: None}


def test_incremental_load_csv_landing_into_parquet(spark):
    from starweave.streaming.incremental import incremental_load

    schema = "k int, v string, day date"
    rows = spark.createDataFrame(
        [(1, "a", dt.date(2020, 1, 5)), (2, "b", dt.date(2020, 2, 5)), (3, "c", dt.date(2021, 1, 5))], schema)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing-csv", "loaded", "ckpt"))
    rows.write.option("header", "true").csv(landing)
    years = {"year": F.year("day")}
    args = dict(fmt="csv", options={"header": "true"}, partitions=years)
    assert incremental_load(spark, landing, rows.schema, target, ["k"], ["day"], ckpt, **args) >= 1
    # a late re-delivery of key 2 plus a new key lands as another file
    spark.createDataFrame([(2, "b", dt.date(2020, 2, 5)), (4, "d", dt.date(2021, 3, 1))], schema) \
        .write.mode("append").option("header", "true").csv(landing)
    for _ in range(2):  # the second run finds nothing new
        incremental_load(spark, landing, rows.schema, target, ["k"], ["day"], ckpt, **args)
    stored = spark.read.parquet(target)  # the target is parquet, whatever the landing format
    assert sorted((r.k, r.year) for r in stored.collect()) == [(1, 2020), (2, 2020), (3, 2021), (4, 2021)]


def test_not_in_empty_target_takes_null_keys(spark):
    """SQL: against an empty set NOT IN is true, for a null key too."""
    from starweave.operators.joins import not_in

    batch = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    empty = spark.createDataFrame([], "t int")
    assert sorted(r.k or 0 for r in not_in(batch, "k", empty, "t").collect()) == [0, 1, 2]
    target = spark.createDataFrame([(2,), (2,)], "t int")
    assert [r.k for r in not_in(batch, "k", target, "t").collect()] == [1]
    nulls = spark.createDataFrame([(2,), (None,)], "t int")
    assert not_in(batch, "k", nulls, "t").count() == 0


def test_append_new_does_not_depend_on_batching(spark):
    schema = "k int, v string"
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "d")]
    whole, cut = scratch_path(spark, "append-whole"), scratch_path(spark, "append-cut")
    append_new(spark.createDataFrame(rows, schema), whole, ["k"])
    for row in rows:
        append_new(spark.createDataFrame([row], schema), cut, ["k"])
    got = [sorted(map(tuple, spark.read.parquet(p).collect()), key=str) for p in (whole, cut)]
    assert got[0] == got[1] == [(1, "a"), (2, "b"), (None, "d")]


def test_checkpoint_folder_is_asked_for_off_local(spark):
    import types

    import pytest

    from starweave.session import checkpoint_root

    sc = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        checkpoint_root(types.SimpleNamespace(sparkContext=sc))
