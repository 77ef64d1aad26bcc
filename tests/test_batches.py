"""Loads that read and rewrite only what a batch touches, keys that continue, and state kept per period."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from starweave.operators.clean import first_per_key
from starweave.operators.loads import append_new, insert_absent, insert_not_in, keyed_overwrite, upsert, write_table
from starweave.operators.parts import PART, bucket_of, create_ranges, merge_buckets, merge_ranges, read_parts
from starweave.operators.quality import TableChecks, fk_report, report
from starweave.operators.quality_state import Reference, in_periods, refresh, state_report, touched_values
from starweave.operators.sequences import compact, extend_ids, highest_id
from starweave.operators.versions import publish, read_current, truncate_load
from starweave.plans.lookup import build_query_table, lookup, lookup_positions
from starweave.plans.warehouse import load_warehouse
from starweave.session import checkpoint_root, discard, scratch_path
from tests.test_warehouse import LOG, _play, _songs

USERS = "id long, name string, level string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(base):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{base}/**/*.parquet", recursive=True)}


def spoil(*folders):
    """Replace every data file by one that cannot be read."""
    for folder in folders:
        for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
            os.remove(f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc") if os.path.exists(
                f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc") else None
            with open(path, "wb") as f:
                f.write(b"not parquet")


# merges of touched buckets


def batches(seed):
    rng = random.Random(seed)
    out = []
    for n in range(3):
        hot = rng.randrange(40)
        ids = [rng.choice([hot, rng.randrange(40), None]) for _ in range(60)]
        out.append([(i, f"n{n}-{k}", rng.choice("ab"), k) for k, i in enumerate(ids)])
    return out


@pytest.mark.parametrize("mode", ["upsert", "insert_absent", "overwrite"])
def test_bucket_merges_equal_the_whole_table_load(spark, mode):
    base = scratch_path(spark, "buckets")
    want = spark.createDataFrame([], USERS)
    for batch in batches(3):
        df = spark.createDataFrame(batch, USERS + ", seq int").repartition(3)
        merge_buckets(df, base, ["id"], mode, 8, columns=["id", "name", "level"], update_cols=["level"], order_by="seq")
        if mode == "upsert":
            want = upsert(want, df, ["id"], ["level"], ["seq"])
        elif mode == "insert_absent":
            want = insert_absent(want, df, ["id"], ["seq"])
        else:
            both = want.withColumn("seq", F.lit(-1)).unionByName(df)
            want = keyed_overwrite(both, ["id"], ["seq"]).drop("seq")
        want = spark.createDataFrame(want.collect(), USERS)
        assert rows_of(read_parts(spark, base).select("id", "name", "level")) == rows_of(want)


@pytest.mark.parametrize("first", [[], [(1, "a", "x")], [(1, "a", "x"), (None, "n", "x")]])
def test_not_in_keeps_the_null_rule(spark, first):
    base = scratch_path(spark, "not-in")
    target = spark.createDataFrame(first, USERS)
    merge_buckets(target, base, ["id"], "not_in", 4)
    batch = spark.createDataFrame([(1, "b", "y"), (2, "c", "y"), (2, "d", "y"), (2, "d", "y"), (None, "e", "y")], USERS)
    merge_buckets(batch, base, ["id"], "not_in", 4)
    assert rows_of(read_parts(spark, base)) == rows_of(insert_not_in(target, batch, "id"))
    merge_buckets(batch, base, ["id"], "not_in", 4)  # again
    want = insert_not_in(spark.createDataFrame(insert_not_in(target, batch, "id").collect(), USERS), batch, "id")
    assert rows_of(read_parts(spark, base)) == rows_of(want)


def test_untouched_buckets_keep_their_files_and_are_not_read(spark):
    base = scratch_path(spark, "kept")
    whole = spark.range(200).select("id", F.lit("n").alias("name"), F.lit("old").alias("level"))
    merge_buckets(whole, base, ["id"], "insert_absent", 16)
    before = files(base)
    part = spark.range(1).select(bucket_of([F.lit(7).cast("long")], 16)).first()[0]
    others = [d for d in glob.glob(f"{base}/{PART}=*") if not d.endswith(f"={part}")]
    spoil(*others)
    after_spoil = files(base)
    one = spark.createDataFrame([(7, "new", "new")], USERS)
    assert merge_buckets(one, base, ["id"], "upsert", 16, update_cols=["level"], order_by="name") == [part]
    kept = {p: t for p, t in files(base).items() if f"/{PART}={part}/" not in p}
    assert kept == {p: t for p, t in after_spoil.items() if f"/{PART}={part}/" not in p}
    assert set(kept) == {p for p in before if f"/{PART}={part}/" not in p}
    stored = {r.id: (r.name, r.level) for r in read_parts(spark, base, [part]).collect()}
    assert stored[7] == ("n", "new") and set(v for k, v in stored.items() if k != 7) <= {("n", "old")}


def test_bucket_merge_takes_a_narrower_type_an_empty_batch_and_appends(spark):
    base = scratch_path(spark, "types")
    merge_buckets(spark.createDataFrame([(5, "a", "x")], USERS), base, ["id"], "insert_absent", 8)
    ints = spark.createDataFrame([(5, "b", "y")], "id int, name string, level string")
    merge_buckets(ints, base, ["id"], "upsert", 8, update_cols=["level"], order_by="name")
    assert rows_of(read_parts(spark, base)) == [(5, "a", "y")]
    assert merge_buckets(ints.limit(0), base, ["id"], "upsert", 8, update_cols=["level"], order_by="name") == []
    merge_buckets(ints, base, ["id"], "append", 8)
    assert rows_of(read_parts(spark, base)) == [(5, "a", "y"), (5, "b", "y")]
    with pytest.raises(ValueError):
        merge_buckets(ints, base, ["id"], "replace", 8)
    assert read_parts(spark, scratch_path(spark, "none")) is None


def test_merges_leave_no_scratch_tables(spark):
    base = scratch_path(spark, "own")
    left = lambda: {p for p in glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/starweave/*") if "parts-" in p}
    before = left()
    merge_buckets(spark.createDataFrame([(5, "a", "x")], USERS), base, ["id"], "insert_absent", 8)
    assert left() == before
    with pytest.raises(ValueError):
        discard(spark, "/tmp/elsewhere")


# merges of touched ranges


def test_range_merge_equals_a_rebuild_and_leaves_other_ranges(spark):
    base = scratch_path(spark, "ranges")
    rng = random.Random(1)
    first = [(f"s{rng.randrange(300):03d}", rng.randrange(20), "a", 1) for _ in range(2000)]
    df = spark.createDataFrame(first, "song string, user int, level string, ts int")
    create_ranges(build_query_table(df, ["song"], ["user"], ["song", "user", "level"], "ts"), base, ["song"], ["user"], ranges=8)
    before = files(base)
    # below the first bound, in one range, and repeated in the batch
    batch = [("s010", 3, "b", 5), ("s010", 3, "c", 6), ("a", 1, "low", 2), (None, 1, "null", 2)]
    late = spark.createDataFrame(batch, "song string, user int, level string, ts int")
    touched = merge_ranges(late, base, ["song"], ["user"], "ts")
    assert 1 <= len(touched) <= 2
    want = build_query_table(spark.createDataFrame(first + batch, df.schema), ["song"], ["user"], ["song", "user", "level"], "ts")
    assert rows_of(read_parts(spark, base)) == rows_of(want)
    untouched = lambda fs: {p: t for p, t in fs.items() if not any(f"/{PART}={n}/" in p for n in touched) and "_bounds" not in p}
    assert untouched(files(base)) == untouched(before) and untouched(before)
    assert [r.level for r in lookup(read_parts(spark, base), ["user"], song="s010").where("user = 3").collect()] == ["c"]
    # every file still holds its rows in order
    for path in files(base):
        if "_bounds" in path:
            continue
        keys = [(r.song is not None, r.song or "", r.user) for r in spark.read.parquet(path).collect()]
        assert keys == sorted(keys)


def test_range_bounds_of_times(spark):
    base = scratch_path(spark, "time-ranges")
    at = F.timestamp_micros(F.col("id") * 333_333_333 + 1).cast("timestamp_ntz")
    rows = spark.range(1000).select(at.alias("ts"), F.col("id").alias("v"))
    create_ranges(rows, base, ["ts"], ranges=150)
    before = len(files(base))
    assert len(merge_ranges(rows.where("v = 500"), base, ["ts"], [], "v")) == 1
    assert rows_of(read_parts(spark, base)) == rows_of(rows) and len(files(base)) >= before - 1


# surrogate keys


def test_ids_continue_and_a_rerun_changes_nothing(spark):
    base = scratch_path(spark, "ids")
    schema = "k string, seq int"
    one = spark.createDataFrame([("b", 2), ("a", 3), ("b", 9), (None, 1)], schema)
    two = spark.createDataFrame([("c", 5), ("a", 1), ("d", 4), (None, 7)], schema)
    get = lambda df: {(r.k, r.id) for r in extend_ids(df, base, ["k"], "seq").collect()}
    assert get(one) == {(None, 1), ("b", 2), ("a", 3)}
    assert highest_id(spark, base) == 3
    assert get(two) == {("c", 5), ("a", 3), ("d", 4), (None, 1)}
    stored = files(base)
    assert get(two) == {("c", 5), ("a", 3), ("d", 4), (None, 1)} and get(one) == {(None, 1), ("b", 2), ("a", 3)}
    assert files(base) == stored and highest_id(spark, base) == 5
    assert extend_ids(one.limit(0), base, ["k"], "seq").count() == 0
    small = compact(spark, base, ["k"])
    assert {(r.k, r.id) for r in extend_ids(two, small, ["k"], "seq").collect()} == {("c", 5), ("a", 3), ("d", 4), (None, 1)}


def test_ids_of_no_rows_at_all(spark):
    base = scratch_path(spark, "no-ids")
    empty = spark.createDataFrame([], "k string, seq int")
    assert extend_ids(empty, base, ["k"], "seq", start=0).columns == ["id", "k", "seq"]
    assert highest_id(spark, base, start=0) == -1
    one = spark.createDataFrame([("x", 1)], "k string, seq int")
    assert extend_ids(one, base, ["k"], "seq", start=0).first().id == 0


# quality state

FACT = "year int, u long, s string"


def _load(spark, base, state, rows, references):
    batch = spark.createDataFrame(rows, FACT)
    write_table(batch, base, mode="append", partition_by=["year"])
    touched = touched_values(batch, ["year"])
    refresh(spark.read.schema(FACT).parquet(base).where(in_periods(["year"], touched)), state, ["year"], {"u": "u", "s": "s"}, references)


def _full(spark, base, users, songs):
    fact = spark.read.parquet(base)
    specs = [TableChecks("f", fact, key=["u", "s"], unique=False)]
    return report(specs, [("f", fact, "u", users, "id"), ("f", fact, "s", songs, "song")])


def test_state_equals_the_full_check_over_periods_and_late_rows(spark):
    base, state, dim = (scratch_path(spark, n) for n in ("fact", "fact-state", "users-dim"))
    songs = spark.createDataFrame([("x",), (None,)], "song string")
    references = {"u": Reference("id", base=dim, buckets=4), "s": Reference("song", dim=songs)}
    loads = [
        ([(2001, 1, "x"), (2001, 2, None), (2001, 2, "y"), (2001, None, "x")], [1]),
        ([(2002, 1, "y"), (2002, 3, "x"), (None, 9, "x")], [1, 2]),  # user 2 turns up a period late
        ([(2001, 4, "z"), (2001, 3, "x")], [3]),  # late rows of the first period
    ]
    for n, (rows, users) in enumerate(loads):
        merge_buckets(spark.createDataFrame([(u,) for u in users], "id long"), dim, ["id"], "insert_absent", 4)
        _load(spark, base, state, rows, references)
        got = state_report(spark, state, "f", ["u", "s"], references=references)
        assert rows_of(got) == rows_of(_full(spark, base, read_parts(spark, dim), songs)), n


def test_second_period_reads_no_file_of_the_first(spark):
    base, state = scratch_path(spark, "fact"), scratch_path(spark, "fact-state")
    users = spark.createDataFrame([(1,)], "id long")
    references = {"u": Reference("id", dim=users)}
    _load(spark, base, state, [(2001, 1, "x"), (2001, 2, "x")], references)
    spoil(f"{base}/year=2001", f"{state}/keys/year=2001")
    _load(spark, base, state, [(2002, 1, None), (2002, 5, "x")], references)
    got = {(r.column_name, r.check_name): r.value for r in state_report(spark, state, "f", ["s"], references=references).collect()}
    assert got == {("*", "min_rows"): 4, ("s", "not_null"): 1, ("u", "references=id"): 2}


def test_a_shrinking_dimension_is_looked_up_for_every_period(spark):
    base, state = scratch_path(spark, "fact"), scratch_path(spark, "fact-state")
    for year, users in ((2001, [1, 2]), (2002, [3])):
        dim = spark.createDataFrame([(u,) for u in users], "id long")
        references = {"u": Reference("id", dim=dim)}
        batch = spark.createDataFrame([(year, u, "x") for u in users], FACT)
        write_table(batch, base, mode="append", partition_by=["year"])
        refresh(batch, state, ["year"], {"u": "u"}, references, dimensions_shrink=True)
    assert [r.value for r in state_report(spark, state, "f", references=references, min_rows=None).collect()] == [2]


def test_state_of_nothing(spark):
    state = scratch_path(spark, "nothing")
    refresh(spark.createDataFrame([], FACT), state, ["year"], {"u": "u"}, {"u": Reference("id", dim=spark.range(3))})
    got = state_report(spark, state, "f", ["u"], unique=["u"], references={"u": Reference("id")}, expected_rows=0)
    assert [(r.check_name, r.value, r.passed) for r in got.collect()] == [
        ("min_rows", 0, False), ("expected_rows", 0, True), ("not_null", 0, True), ("unique", 0, True), ("references=id", 0, True)]


def test_repeats_within_a_period_are_found(spark):
    state = scratch_path(spark, "repeats")
    rows = spark.createDataFrame([(2001, 1, "x"), (2001, 1, "y"), (2001, None, "z"), (2002, 2, "x")], FACT)
    refresh(rows, state, ["year"], {"u": "u"})
    got = state_report(spark, state, "f", unique=["u"], min_rows=None).collect()
    assert [(r.check_name, r.value) for r in got] == [("unique", 1)]


# the warehouse load


def _hours(spark, dst, **how):
    one = spark.createDataFrame([_play("1", "free", 1, 10), _play("9", "free", 1, 10, "gone")], LOG)
    two = spark.createDataFrame([_play("2", "paid", 900, 11), _play("1", "paid", 900, 12, "t")], LOG)
    late = spark.createDataFrame([_play("3", "free", 2, 13)], LOG)
    for log, songs in ((one, ["s"]), (two, ["t"]), (late, ["s", "t"]))[: how.pop("hours", 3)]:
        result = load_warehouse(spark, log, _songs(spark, *songs), dst, **how)
    return result


@pytest.mark.parametrize("modes,hours", [({}, 3), ({"songs": "not_in", "artists": "not_in", "time": "not_in"}, 2)])
def test_bucketed_warehouse_equals_the_versioned_one(spark, modes, hours):
    whole = _hours(spark, scratch_path(spark, "versions"), dim_modes=modes, hours=hours)
    parts = _hours(spark, scratch_path(spark, "buckets"), dim_modes=modes, buckets=4, hours=hours)
    assert rows_of(whole.checks) == rows_of(parts.checks)
    for name in ("users", "songs", "artists", "time"):
        want = spark.read.parquet(whole.paths[name])
        got = spark.read.parquet(parts.paths[name]).drop(PART)
        assert rows_of(got.select(*want.columns)) == rows_of(want), name
    assert rows_of(spark.read.parquet(whole.paths["songplays"])) == rows_of(spark.read.parquet(parts.paths["songplays"]))
    with pytest.raises(ValueError):
        _hours(spark, scratch_path(spark, "refused"), dim_modes={"songs": "truncate"}, buckets=4, hours=1)


def test_a_later_hour_reads_nothing_of_an_earlier_month(spark):
    dst = scratch_path(spark, "months")
    load_warehouse(spark, spark.createDataFrame([_play("1", "free", 1, 10)], LOG), _songs(spark, "s"), dst)
    spoil(f"{dst}/songplays/year=1970/month=1")
    result = load_warehouse(spark, spark.createDataFrame([_play("1", "paid", 900, 11)], LOG), _songs(spark, "s"), dst, on_failure="raise")
    assert {r.value for r in result.checks.where("check_name like 'references%'").collect()} == {0}


def test_truncate_load_survives_a_failed_job(spark):
    base = scratch_path(spark, "truncate")
    truncate_load(spark.range(3), base, columns=["id"])
    with pytest.raises(Exception):
        truncate_load(spark.range(3).select(F.assert_true(F.col("id") < 2), "id"), base)
    assert read_current(spark, base).count() == 3
    truncate_load(spark.range(1), base)
    assert read_current(spark, base).count() == 1 and publish(spark.range(2), base)


# skipped files, positions


def _scanned(df):
    """Rows the file scans of a finished plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    out = 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        out += metric.get().value() if metric.isDefined() else 0
    return out


def test_bloom_filters_skip_files_without_a_key(spark):
    from starweave.operators.loads import _listed

    path = scratch_path(spark, "bloom")
    # every file spans the whole key range, so minima and maxima skip none
    for n in range(4):
        ids = spark.range(n, 40_000, 4).select(F.col("id"), F.concat(F.lit("v"), F.col("id")).alias("v"))
        append_new(ids.coalesce(1), path, ["id"], bloom="id", bloom_values=20_000)
    stored = spark.read.parquet(path)
    batch = spark.createDataFrame([(5, "x"), (39_997, "x")], "id long, v string")
    assert _scanned(_listed(batch, stored, "id").select("id")) < stored.count() / 2
    append_new(spark.createDataFrame([(5, "x"), (50_000, "x"), (None, "x")], "id long, v string"), path, ["id"], bloom="id")
    append_new(spark.createDataFrame([(None, "x")], "id long, v string"), path, ["id"], bloom="id")
    # above the list's bound the result is the same
    append_new(spark.range(0, 40_001).select("id", F.lit("y").alias("v")), path, ["id"], bloom="id")
    assert spark.read.parquet(path).count() == 40_000 + 3
    with pytest.raises(ValueError):
        append_new(batch, path, ["id"], bloom="v")


def test_positions_inside_a_partition_of_many_files(spark):
    from starweave.operators.loads import query_layout

    rows = spark.range(3000).select((F.col("id") % 10 < 4).cast("int").alias("k"), (F.col("id") * 7919 % 3000).alias("c"))
    path = scratch_path(spark, "laid")
    query_layout(rows, ["k"], ["c"], num_partitions=12).write.parquet(path)
    placed = lookup_positions(spark.read.parquet(path), ["c"], k=1)
    got = {(r.c, r.position) for r in placed.collect()}
    assert got == {(c, n) for n, c in enumerate(sorted(r.c for r in rows.where("k = 1").collect()))}
    assert len(glob.glob(f"{path}/*.parquet")) > 4
    assert lookup_positions(spark.read.parquet(path), ["c"], k=5).count() == 0


def test_first_rows_by_arrival_do_not_depend_on_splits(spark):
    from starweave.sources.readers import read_csv, read_json, with_arrival, with_line_number
    from starweave.sources.schemas import struct

    path = scratch_path(spark, "arrival")
    rows = spark.range(4000).select((F.col("id") * 31 % 97).alias("k"), F.col("id").alias("v"), F.lit("x" * 40).alias("pad"))
    rows.repartitionByRange(3, "v").sortWithinPartitions("v").write.json(path)
    as_csv = scratch_path(spark, "arrival-csv")
    rows.repartitionByRange(3, "v").sortWithinPartitions("v").write.option("header", "true").csv(as_csv)
    as_parquet = scratch_path(spark, "arrival-parquet")
    rows.repartitionByRange(3, "v").sortWithinPartitions("v").write.parquet(as_parquet)
    schema = struct("k bigint, v bigint, pad string")
    want_first = {k: min(v for v in range(4000) if v * 31 % 97 == k) for k in range(97)}
    want_last = {k: max(v for v in range(4000) if v * 31 % 97 == k) for k in range(97)}
    open_cost, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = {c: spark.conf.get(c) for c in (open_cost, most)}
    try:
        for size in ("134217728", "5000"):
            spark.conf.set(most, size)
            spark.conf.set(open_cost, "1")
            for df in (read_json(spark, path, schema), read_csv(spark, as_csv, schema), spark.read.parquet(as_parquet)):
                placed = with_arrival(df)
                for keep, want in (("first", want_first), ("last", want_last)):
                    assert {r.k: r.v for r in first_per_key(placed, ["k"], "_arrival", keep).collect()} == want
            lines = with_line_number(read_json(spark, path, schema).withColumn("f", F.col("_metadata.file_path")))
            by_file = {}
            for r in lines.collect():
                by_file.setdefault(r.f, {})[r._line] = r.v
            for numbered in by_file.values():
                assert sorted(numbered) == list(range(1, len(numbered) + 1))
                assert [numbered[i] for i in sorted(numbered)] == sorted(numbered.values())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_sorted_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """More rows make more files, not larger ones, also where a third of the rows are of one day."""
    from starweave.plans import scale_queries

    day = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 365).cast("int")
    spark.range(30_000).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        F.date_add(F.lit("1995-01-01").cast("date"), day).cast("timestamp_ntz").alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"),
    ).write.parquet(f"file:{tmp_path}/orders.parquet")
    written = []
    write = scale_queries.write_table
    monkeypatch.setattr(scale_queries, "write_table", lambda df, path, **kw: written.append(path) or write(df, path, **kw))
    monkeypatch.setattr(scale_queries, "RANGE_ROWS", 1_000, raising=False)
    row = scale_queries.sorted_layout_files(spark, f"file:{tmp_path}").first()
    assert (row.n_rows, row.several_files, row.overlapping_files, row.rows_out_of_order) == (30_000, True, 0, 0)
    sizes = [r["count"] for r in spark.read.parquet(written[0]).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 25 and max(sizes) < 3_000
