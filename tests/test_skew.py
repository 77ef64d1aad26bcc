"""Hot keys: one key holding a third of all rows must not change results, and
must not be funnelled whole through one task where the operator can avoid it."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from starweave.operators import dense_ids, first_per_key, natural_key_join, query_layout, upsert, write_table
from starweave.session import scratch_path

N = 30_000


def _skewed(spark):
    # key 0 owns a third of the rows; the rest are spread over 2,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("seq"),
        (F.col("id") * 7 % 101).alias("v"),
    )


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def test_first_per_key_hot_key_is_combined_map_side(spark):
    df = _skewed(spark)
    out = first_per_key(df, ["k"], "seq")
    plan = _plan(out)
    # the partial aggregate sits below the shuffle: each task sends one row per key
    assert plan.index("partial_min(") > plan.index("Exchange hashpartitioning")
    got = {r.k: r.seq for r in out.collect()}
    assert got[0] == 0 and len(got) == 2001
    expected = {r.k: r["m"] for r in df.groupBy("k").agg(F.min("seq").alias("m")).collect()}
    assert got == expected


def test_upsert_with_hot_key(spark):
    target = spark.createDataFrame([(0, "t0", 5)], "k long, name string, v long")
    updates = _skewed(spark).select("k", F.lit("u").alias("name"), "v", "seq")
    out = {r.k: (r.name, r.v) for r in upsert(target, updates, ["k"], ["v"], "seq").collect()}
    last0 = updates.where("k = 0").orderBy(F.desc("seq")).first().v
    assert out[0] == ("t0", last0)
    assert len(out) == 2001


def test_query_layout_splits_a_hot_partition_key(spark):
    df = _skewed(spark)
    laid = query_layout(df, ["k"], ["seq"], num_partitions=8)
    parts = (laid.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 2  # the hot partition key is spread by its clustering key
    # and every partition is sorted on (k, seq)
    rows = laid.select(F.spark_partition_id().alias("p"), "k", "seq").collect()
    by_p = {}
    for r in rows:
        by_p.setdefault(r.p, []).append((r.k, r.seq))
    assert all(v == sorted(v) for v in by_p.values())


def test_spread_write_of_hot_partition_value(spark):
    df = _skewed(spark).withColumn("bucket", F.when(F.col("k") == 0, F.lit("hot")).otherwise(F.lit("cold")))
    path = scratch_path(spark, "spread")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16KB")  # the hot value is many advisory sizes large
    try:
        write_table(df, path, partition_by=["bucket"], rebalance=True)
    finally:
        spark.conf.set(key, before)
    hot_files = [f for f in os.listdir(os.path.join(path, "bucket=hot")) if f.endswith(".parquet")]
    assert len(hot_files) >= 2
    back = spark.read.parquet(path)
    assert back.count() == N and back.where("bucket = 'hot'").count() == N // 3


def test_hot_natural_key_join(spark):
    log = _skewed(spark).select(F.col("k").cast("string").alias("song"), "seq")
    dim = spark.createDataFrame([("0", "S0"), ("0", "S0b"), ("1", "S1")], "title string, song_id string")
    inner = natural_key_join(log, dim, [("song", "title")], how="inner")
    assert inner.count() == 2 * (N // 3) + log.where("song = '1'").count()
    first = natural_key_join(log, dim, [("song", "title")], how="first_match", dim_order="song_id")
    assert first.count() == N
    assert first.where("song = '0'").select("song_id").distinct().collect()[0].song_id == "S0"


def test_dense_ids_with_tied_order_values(spark):
    df = _skewed(spark)
    ids = dense_ids(df, ["k", "seq"], name="sk", start=1, num_partitions=6)
    got = ids.select("sk").collect()
    assert sorted(r.sk for r in got) == list(range(1, N + 1))
    rows = ids.orderBy("sk").select("k", "seq").collect()
    assert [(r.k, r.seq) for r in rows] == sorted((r.k, r.seq) for r in rows)


def test_append_new_with_a_hot_period(spark):
    from starweave.operators import append_new

    df = _skewed(spark).withColumn("period", F.when(F.col("k") == 0, F.lit(1)).otherwise(F.col("k") % 4 + 2))
    path = scratch_path(spark, "hot-period")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16KB")
    try:
        append_new(df.where("seq % 2 = 0"), path, ["seq", "period"], partition_by=["period"])
        for _ in range(2):  # the second batch is staged; the rerun appends nothing
            append_new(df, path, ["seq", "period"], partition_by=["period"])
    finally:
        spark.conf.set(key, before)
    hot_files = [f for f in os.listdir(os.path.join(path, "period=1")) if f.endswith(".parquet")]
    assert len(hot_files) >= 4  # each load's hot-period rows are spread over several tasks
    back = spark.read.parquet(path)
    assert back.count() == N and back.select("seq").distinct().count() == N
    assert back.where("period = 1").count() == N // 3


def test_shuffled_natural_key_join_splits_the_hot_key_at_run_time(spark):
    """Without a broadcast, AQE splits the hot key's partition of the log
    (inner and left joins); the final plan after the action shows it."""
    log = _skewed(spark).select(F.col("k").cast("string").alias("song"), "seq")
    dim = spark.range(0, 2001).select(F.col("id").cast("string").alias("title"), (F.col("id") * 10).alias("song_id"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for how in ("inner", "left"):
            out = natural_key_join(log, dim, [("song", "title")], how=how)
            assert len(out.collect()) == N
            assert "SortMergeJoin(skew=true)" in _plan(out), how
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_query_table_files_cover_disjoint_key_ranges(spark):
    """A query-first table is stored so that each file holds one contiguous
    range of the partition key; min/max footer statistics then let a lookup
    skip every other file."""
    import glob

    import pyarrow.parquet as pq

    df = _skewed(spark)
    path = scratch_path(spark, "layout")
    write_table(query_layout(df, ["k"], ["seq"], num_partitions=8), path)
    ranges = []
    for f in glob.glob(os.path.join(path, "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        col = meta.schema.names.index("k")
        stats = [meta.row_group(i).column(col).statistics for i in range(meta.num_row_groups)]
        if stats:
            ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    ranges.sort()
    assert len(ranges) >= 2
    # neighbours may share a boundary key (the hot key is split by seq), never more
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_anti_joins_split_the_hot_key_at_run_time(spark):
    """NOT IN and orphans over stored tables: the hot key of the many side is split."""
    from starweave.operators.joins import not_in, orphans

    log_path, dim_path = scratch_path(spark, "anti-log"), scratch_path(spark, "anti-dim")
    _skewed(spark).withColumn("pad", F.repeat(F.lit("x"), 40)).write.parquet(log_path)
    spark.range(1, 2001).withColumnRenamed("id", "t").write.parquet(dim_path)
    log, dim = spark.read.parquet(log_path), spark.read.parquet(dim_path)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for out in (not_in(log, "k", dim, "t"), orphans(log, "k", dim, "t")):
            assert len(out.collect()) == N // 3
            assert "SortMergeJoin(skew=true)" in _plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
