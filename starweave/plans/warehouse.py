"""Run the warehouse load in its data-dependency order (section 3.2).

stage events and songs -> load the fact -> load the four dimensions (the
time dimension reads the loaded fact) -> quality checks. Orchestration
(schedules, retries) belongs to the caller's scheduler; the order here is
only the data dependency. Staging holds one period and is a truncate + load;
dimensions keep what earlier periods loaded, each by its own mode, and are
published as fresh versions (``operators.versions``), so a failed job leaves
the version before it. With ``buckets`` they lie in key-hash directories
instead, and a period rewrites only those it touches (``operators.parts``).
The fact's checks are kept per period (``operators.quality_state``): a load
reads no row of the periods it does not touch.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.text import md5_key
from starweave.functions.time import start_time
from starweave.operators.loads import append, append_new, insert_not_in
from starweave.operators.parts import PART, merge_buckets, read_parts
from starweave.operators.quality import TableChecks, assert_passed, report
from starweave.operators.quality_state import Reference, in_periods, refresh, state_report, touched_values
from starweave.operators.versions import current_path, publish, read_current, truncate_load
from starweave.plans.music import (
    ARTIST_COLUMNS, SONG_COLUMNS, USER_COLUMNS, _layout, _project,
    build_artists, build_songplays, build_songs, build_time, build_users, next_song,
)

# How each dimension takes a period: ``insert_absent`` adds keys not stored
# yet, ``not_in`` adds the distinct rows of such keys, ``upsert`` (users) also
# updates the level of stored ones, ``append`` adds all rows of the period,
# ``truncate`` keeps the period's rows only.
DIM_MODES = {"users": "upsert", "songs": "insert_absent", "artists": "insert_absent", "time": "insert_absent"}
MODES = ("insert_absent", "not_in", "upsert", "append", "truncate")
KEYS = {"users": "user_id", "songs": "song_id", "artists": "artist_id", "time": "start_time"}
#: Dimensions whose rows all refer to stored keys once: their repeats are checked.
ONE_ROW_A_KEY = ("upsert", "insert_absent")
PERIOD = ["year", "month"]
#: Staged rows and the fact are the bulk of what a load writes.
COMPACT = {"compression": "zstd"}


@dataclass
class WarehouseLoad:
    paths: dict[str, str]
    checks: DataFrame


def load_warehouse(
    spark: SparkSession,
    events: DataFrame,
    songs: DataFrame,
    dst: str,
    how: str = "left",
    key: str = "md5",
    precision: str = "second",
    page_filter: Column | None = None,
    key_source: tuple[DataFrame, str, str] | None = None,
    dim_modes: Mapping[str, str] | None = None,
    users_order=("ts",),
    weekday_base: str = "sun0",
    fact_mode: str = "append_new",
    on_failure: str = "report",
    optional: tuple[str, ...] = (),
    buckets: int | None = None,
) -> WarehouseLoad:
    """Stage, load fact, load dimensions, check.

    Returns the paths to read and the check report, which has been computed
    (``on_failure="raise"`` raises on a failed check). Calls for successive
    periods go to the same ``dst``. Source columns named in ``optional`` may
    be absent; any other absent column is an error.

    ``buckets`` lays each dimension out in that many key-hash directories
    (read without the column ``part``) and rewrites the touched ones; its
    checks are kept per directory. It must be the same in every call, and a
    dimension that is truncated is rewritten whole anyway, so it is refused.
    """
    modes = {**DIM_MODES, **(dim_modes or {})}
    if set(modes) != set(DIM_MODES) or not set(modes.values()) <= set(MODES):
        raise ValueError(f"dim_modes: {sorted(DIM_MODES)} by one of {MODES}")
    if any(mode == "upsert" for name, mode in modes.items() if name != "users"):
        raise ValueError("only users have an updated column")
    if buckets and "truncate" in modes.values():
        raise ValueError("a truncated dimension has no buckets")
    base = dst.rstrip("/")
    staging = {name: f"{base}/{name}" for name in ("staging_events", "staging_songs")}
    fact_path = f"{base}/songplays"
    dims = {name: f"{base}/{name}" for name in DIM_MODES}

    # stage (K7): delete all, then load
    for name, rows in (("staging_events", events), ("staging_songs", songs)):
        staging[name] = truncate_load(rows, staging[name], options=COMPACT)
    staged_events = spark.read.parquet(staging["staging_events"])
    staged_songs = spark.read.parquet(staging["staging_songs"])

    plays = next_song(staged_events, page_filter)
    at = start_time("ts", precision)
    touched = touched_values(plays.select(F.year(at).alias("year"), F.month(at).alias("month")), PERIOD)

    # fact (K5): plain append as in the reference, or idempotent append
    fact = build_songplays(staged_events, staged_songs, how=how, key=key, precision=precision,
                           page_filter=page_filter, key_source=key_source, optional=optional)
    if fact_mode == "append":
        append(fact, fact_path)
    elif fact_mode == "append_new":
        # the stored fact is partitioned by start year and month; a rerun or
        # the next hour compares only against the periods it touches, which
        # the staged plays' start times give; the key and the period are
        # functions of the row, so rows are told apart without them
        derived = {"year": F.year("start_time"), "month": F.month("start_time")}
        dated = fact.withColumns(derived)
        if key == "md5":
            derived["songplay_id"] = md5_key("session_id", "start_time")
        append_new(dated, fact_path, dated.columns, partition_by=PERIOD, touched=touched, derived=derived, options=COMPACT)
        fact = dated
    else:
        raise ValueError("fact_mode must be append or append_new")
    loaded = spark.read.schema(fact.schema).parquet(fact_path)  # declared: no file is opened to learn it

    # dimensions; time reads the loaded fact (S12), within the staged period only
    ts = plays.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if ts.lo is None:
        period = loaded.limit(0)
    else:
        at = lambda ms: F.timestamp_millis(F.lit(ms)).cast("timestamp_ntz")
        period = loaded.where(F.col("start_time").between(F.date_trunc("day", at(ts.lo)), at(ts.hi)))
        if fact_mode == "append_new":
            period = period.where(in_periods(PERIOD, touched))
    rewritten: dict[str, list[int]] = {}
    for name, mode in modes.items():
        if buckets:
            rows, order = _dimension_rows(name, staged_events, staged_songs, period, page_filter, optional,
                                          weekday_base, users_order)
            columns = [c for c in rows.columns if c not in order or c == KEYS[name]]
            rewritten[name] = merge_buckets(rows, dims[name], [KEYS[name]], mode, buckets, columns=columns,
                                            update_cols=["level"] if name == "users" else (), order_by=order)
            continue
        stored = None if mode == "truncate" else read_current(spark, dims[name])
        target = None if mode == "append" else stored
        policy = {"insert_absent": "first", "not_in": "absent_only"}.get(mode, "distinct")
        if name == "users":
            policy = "upsert_level" if mode == "upsert" else policy
            rows = build_users(staged_events, policy=policy, order_by=list(users_order), target=target,
                               page_filter=page_filter, optional=optional)
        elif name == "songs":
            rows = build_songs(staged_songs, policy=policy, target=target, optional=optional)
        elif name == "artists":
            rows = build_artists(staged_songs, policy=policy, target=target, optional=optional)
        elif mode == "not_in" and target is not None:
            rows = insert_not_in(target, build_time(period, weekday_base=weekday_base), "start_time")
        else:
            rows = build_time(period, weekday_base=weekday_base, target=target)
        publish(stored.unionByName(rows) if mode == "append" and stored is not None else rows, dims[name])
    where = dims if buckets else {n: current_path(spark, p) for n, p in dims.items()}
    paths = {**staging, "songplays": fact_path, **where}

    # checks (Q6): of the dimensions, and the fact's references
    unique = {n: [k] if modes[n] in ONE_ROW_A_KEY else [] for n, k in KEYS.items()}
    if buckets:
        refs = {k: Reference(k, base=dims[n], buckets=buckets) for n, k in KEYS.items()}
        for name, k in KEYS.items():
            if modes[name] == "append":  # its files are not rewritten: every directory may have grown
                rewritten[name] = list(range(buckets))
            if rewritten[name]:
                rows = read_parts(spark, dims[name], rewritten[name], number=True)
                refresh(rows, f"{base}/_quality/{name}", [PART], {k: k})
        parts = [state_report(spark, f"{base}/_quality/{n}", n, [k], unique[n]) for n, k in KEYS.items()]
    else:
        tables = {n: spark.read.parquet(paths[n]) for n in dims}
        refs = {k: Reference(k, dim=tables[n]) for n, k in KEYS.items()}
        parts = [report([TableChecks(n, tables[n], key=[k], unique=bool(unique[n]))]) for n, k in KEYS.items()]
    if fact_mode == "append_new":
        state = f"{base}/_quality/songplays"
        refresh(loaded.where(in_periods(PERIOD, touched)), state, PERIOD, {k: k for k in KEYS.values()}, refs,
                dimensions_shrink="truncate" in modes.values())
        parts.append(state_report(spark, state, "songplays", references=refs, min_rows=None))
    else:  # an unpartitioned fact has no periods: all of it is read
        known = {n: _dimension(spark, dims[n], paths[n], buckets) for n in dims}
        parts.append(report([], [("songplays", loaded, k, known[n], k) for n, k in KEYS.items()]))
    rows = [r for p in parts for r in p.collect()]  # a few rows per table
    checks = spark.createDataFrame(rows, parts[0].schema)
    if on_failure == "raise":
        assert_passed(checks)
    return WarehouseLoad(paths, checks)


def _dimension(spark: SparkSession, base: str, path: str, buckets: int | None) -> DataFrame:
    return read_parts(spark, base) if buckets else spark.read.parquet(path)


def _dimension_rows(
    name: str, events: DataFrame, songs: DataFrame, period: DataFrame, page_filter, optional, weekday_base, users_order
) -> tuple[DataFrame, list[str]]:
    """A period's rows of a dimension, and the columns of their order."""
    if name == "users":
        plays = next_song(events, page_filter)
        order = [F.col(c) if isinstance(c, str) else c for c in users_order]
        names = [f"_seq{i}" for i in range(len(order))]
        rows = plays.select(*_layout(plays, USER_COLUMNS, optional), *[c.alias(n) for c, n in zip(order, names)])
        return rows, names
    if name == "time":
        return build_time(period, weekday_base=weekday_base), ["start_time"]
    rows = _project(songs, SONG_COLUMNS if name == "songs" else ARTIST_COLUMNS, optional)
    return rows, [KEYS[name]]
