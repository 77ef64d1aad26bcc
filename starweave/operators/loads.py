"""Sinks and load modes.

Two kinds of functions live here:

* frame -> frame load semantics (``upsert``, ``insert_absent``,
  ``insert_not_in``, ``keyed_overwrite``, ``dense_ids``) that compute the new
  version of a table. Parquet tables have no MERGE, so a load computes the new
  version and writes it to a fresh path; a plan never overwrites a path it
  reads from.
* writers (``write_table``, ``append_new``, ``query_layout``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starweave.operators.clean import _c, _names, first_per_key
from starweave.operators.joins import anti_join, not_in
from starweave.session import scratch_path

ColumnLike = Column | str

# Most distinct values of the Bloom-filtered column that a batch's scan of the
# stored rows is narrowed by; each is one equality that file footers answer.
MAX_LISTED_KEYS = 200

# Most directory-partition values (e.g. periods of a fact) one appended batch
# may touch for the stored table to be pruned to them by a static filter.
MAX_TOUCHED_PARTITIONS = 10_000


# --------------------------------------------------------------------------
# writers
# --------------------------------------------------------------------------


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    rebalance: bool = False,
    options: Mapping[str, str] | None = None,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> str:
    """Write a frame.

    * ``partition_by``: directory partitions; keep them low-cardinality.
    * ``rebalance``: shuffle with Spark's ``REBALANCE`` hint on the
      partition columns first. AQE then cuts a value that holds a large share
      of the rows (say one year holding a third) into advisory-size tasks and
      merges small ones, so file sizes stay bounded without sending a hot
      value to one task. Without it rows are written from the partitions they
      are in.
    * ``sort_within``: sort inside each task so parquet min/max statistics
      skip row groups on later filters (the sort key of L5).
    * ``observe``: aggregates of the written rows, collected by the writing
      tasks themselves (``operators.quality.write_checked``).
    """
    out = df
    if rebalance:
        out = out.hint("rebalance", *partition_by)
    if sort_within or partition_by:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    if observe:
        out = out.observe(observe[0], *observe[1])
    writer = out.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


# Analysis errors that mean "nothing stored yet": no such path, or a folder
# without any data file to take a schema from.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame | None:
    """Open a previously written table, or None when there is none yet.

    Any other failure is raised: treating an unreadable target as empty
    would make an idempotent load append its whole batch again.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as exc:
        if exc.getCondition() in _ABSENT:
            return None
        raise


def append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K5 as in the reference: a rerun appends the same rows again."""
    return write_table(df, path, mode="append", fmt=fmt)


def append_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    stage: bool = True,
    order_by: ColumnLike | Sequence[ColumnLike] | None = None,
    max_touched: int = MAX_TOUCHED_PARTITIONS,
    bloom: str | None = None,
    bloom_values: int = 1_000_000,
    touched: Sequence[Sequence] | None = None,
    derived: Mapping[str, Column] | None = None,
    options: Mapping[str, str] | None = None,
) -> str:
    """K5 made idempotent: append only rows whose key is not stored yet.

    A key the batch repeats is stored once, its first row by ``order_by`` and
    then by the row itself, so the result does not depend on how rows are cut
    into batches that arrive in that order. Keys compare null-safely, so rows with a null key part are not appended
    again by a rerun. With ``partition_by`` (directory partitions that are
    part of the key, e.g. the period of a fact) the stored table is written
    partitioned, and a batch is compared only with the stored partitions it
    touches, so an hourly load does not re-read the whole history:

    1. the batch is written once to the shared scratch folder, partitioned
       like the target. It is computed once (not again to find its periods),
       and its lineage is cut, so a lost executor does not recompute it.
       Once the append has committed, the staged copy is truncated;
    2. the periods it touches are read from the staged partition columns
       alone, checked to be at most ``max_touched`` and turned
       into a static filter on the stored table's partition columns, which
       prunes the stored scan when it is planned. (A semi-join on the periods
       would not: dynamic pruning needs a selective filter on the batch.)
       A batch touching more periods is compared with the whole history.

    ``stage=False`` skips step 1 for a batch that is cheap and deterministic
    to read twice, such as a micro-batch of landed files.

    A caller that knows the periods (at least those of the batch) gives them as
    ``touched``; then the batch is read once and not staged. ``derived`` gives
    key columns that are functions of the other keys (a hash key, the period):
    rows are compared without them, and only periods travel to the writing
    tasks, which compute the rest. Where the keys so left are the whole row,
    its repeats and the stored rows fall out in one grouping: each row is
    shuffled once for both, a hot one combined before.

    ``bloom`` names a key column whose files get a Bloom filter (sized for
    ``bloom_values`` distinct values a file). A batch with at most
    ``MAX_LISTED_KEYS`` values of it pushes them to the stored scan as
    equalities, and files that hold none of them are skipped by their footers.
    A larger batch compares as without.
    """
    spark = df.sparkSession
    partition_by, derived, options = list(partition_by), dict(derived or {}), dict(options or {})
    if bloom:
        if bloom not in keys:
            raise ValueError("bloom must be one of the keys")
        options |= {f"parquet.bloom.filter.enabled#{bloom}": "true",
                    f"parquet.bloom.filter.expected.ndv#{bloom}": str(bloom_values)}
    columns, keys = df.columns, [k for k in keys if k not in derived]
    stored_schema = df.select(*[c for c in columns if c not in partition_by], *partition_by).schema
    batch = df.drop(*derived)
    grouped = touched is not None and set(batch.columns) == set(keys)
    if not grouped:
        batch = first_per_key(batch, keys, order_by if order_by is not None else [F.lit(0)])
    current, staged = read_if_exists(spark, path, fmt, schema=stored_schema), None
    if current is not None and partition_by:
        if touched is None:
            periods = batch.withColumns(derived)
            if stage:
                staged = write_table(periods, scratch_path(spark, "append-batch"), fmt=fmt, partition_by=partition_by,
                                     rebalance=True)
                periods = spark.read.format(fmt).schema(stored_schema).load(staged)
                batch = periods.select(*batch.columns)
            # one job gives both the bound check and the values: at most
            # max_touched + 1 small rows reach the driver
            touched = periods.select(*partition_by).distinct().take(max_touched + 1)
        if len(touched) <= max_touched:
            current = current.where(in_periods(partition_by, touched))
    if current is not None:
        current = _listed(batch, current, bloom)
    if grouped:
        fresh = _absent_rows(batch, current)
    elif current is None:
        fresh = batch
    else:
        fresh = anti_join(batch, current, [(k, k) for k in keys], null_safe=True)
    fresh = fresh.withColumns({k: c for k, c in derived.items() if k in partition_by})
    if partition_by:
        fresh = fresh.hint("rebalance", *partition_by)
    fresh = fresh.withColumns({k: c for k, c in derived.items() if k not in partition_by}).select(*columns)
    write_table(fresh, path, mode="append", fmt=fmt, partition_by=partition_by, options=options)
    if staged:
        # the append has committed: truncate the staged copy, so the shared
        # folder does not keep a second copy of every batch
        spark.createDataFrame([], stored_schema).write.mode("overwrite").format(fmt).save(staged)
    return path


def in_periods(names: Sequence[str], periods: Sequence[tuple]) -> Column:
    """Whether a row is in one of the periods, never null; on directory columns this prunes when files are listed.

    Periods that differ in the last column only are one ``IN`` list.
    """
    *front, last = names
    lists: dict[tuple, list] = {}
    for period in periods:
        lists.setdefault(tuple(period[:-1]), []).append(period[-1])
    found = []
    for values, ends in lists.items():
        some = [e for e in ends if e is not None]
        one = F.coalesce(F.col(last).isin(some), F.lit(False)) if some else F.lit(False)
        if None in ends:
            one = one | F.col(last).isNull()
        for name, value in zip(front, values):
            one = F.col(name).eqNullSafe(F.lit(value)) & one
        found.append(one)
    return _any(found)


def _any(conds: Sequence[Column]) -> Column:
    """Whether one of the conditions holds; a balanced tree keeps the expression shallow."""
    conds = list(conds)
    while len(conds) > 1:
        conds = [a | b for a, b in zip(conds[::2], conds[1::2])] + ([conds[-1]] if len(conds) % 2 else [])
    return conds[0] if conds else F.lit(False)


def _absent_rows(batch: DataFrame, current: DataFrame | None) -> DataFrame:
    """The distinct rows of ``batch`` that ``current`` lacks; nulls compare equal."""
    if current is None:
        return batch.distinct()
    rows = batch.withColumn("_new", F.lit(1)).unionByName(current.select(*batch.columns).withColumn("_new", F.lit(0)))
    found = rows.groupBy(*batch.columns).agg(F.min("_new").alias("_new"))
    return found.where(F.col("_new") == F.lit(1)).drop("_new")


def _listed(batch: DataFrame, current: DataFrame, column: str | None) -> DataFrame:
    """``current`` narrowed to a small batch's values of ``column``, as equalities that reach the footers.

    (A longer ``IN`` would reach them as a range only.)
    """
    if column is None:
        return current
    found = batch.select(column).distinct().take(MAX_LISTED_KEYS + 1)
    if len(found) > MAX_LISTED_KEYS:
        return current
    kind = current.schema[column].dataType
    conds = [F.col(column).isNull() if r[0] is None else F.col(column) == F.lit(r[0]).cast(kind) for r in found]
    return current.where(_any(conds))


def truncate_insert(df: DataFrame, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> str:
    """K6/K7 default: delete all rows, then insert.

    ``columns`` gives the target's column order; the insert in the reference
    is by position, so the frame is projected into that order first.
    """
    out = df.select(*columns) if columns else df
    return write_table(out, path, mode="overwrite", fmt=fmt)


def insert_by_position(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """K6 into a catalog table: ``insertInto`` matches columns by position."""
    df.write.insertInto(table, overwrite=overwrite)


# --------------------------------------------------------------------------
# load semantics: frame -> new version of the target
# --------------------------------------------------------------------------


def _batch_order(order_by) -> list[Column]:
    return [_c(c) for c in _names(order_by)]


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    order_by: ColumnLike | Sequence[ColumnLike],
) -> DataFrame:
    """K8: ``ON CONFLICT (key) DO UPDATE SET c = EXCLUDED.c`` for ``update_cols``.

    Rows of ``updates`` are applied in ``order_by`` order. Keys already in
    the target keep every other column; only ``update_cols`` take the value of
    the key's last update. A key new to the target enters with its first
    update's values, then takes later updates of ``update_cols``.
    One grouped aggregate, no window: ``min``/``max`` combine map-side.
    """
    keys, update_cols = list(keys), list(update_cols)
    cols = target.columns
    rest = [c for c in cols if c not in keys]
    order = _batch_order(order_by)
    o_names = [f"_o{i}" for i in range(len(order))]
    p_names = [f"_p{j}" for j in range(len(rest))]
    u = updates.select(
        *keys,
        F.lit(1).alias("_src"),
        *[c.alias(n) for c, n in zip(order, o_names)],
        *[F.col(c).alias(n) for c, n in zip(rest, p_names)],
    )
    # Target rows sort before every update (_src = 0); their order values are
    # null and only the row itself breaks ties among them.
    t = target.select(
        *keys,
        F.lit(0).alias("_src"),
        *[F.lit(None).cast(u.schema[n].dataType).alias(n) for n in o_names],
        *[F.col(c).alias(n) for c, n in zip(rest, p_names)],
    )
    # One struct (source, order, row) ranks the rows and carries them: its
    # min is the first row (the fixed columns come from it), its max over the
    # updates the last update (the updated columns come from it). A key
    # without updates keeps its first row whole.
    ranked = F.struct("_src", *o_names, *p_names)
    out = t.unionByName(u).groupBy(*keys).agg(
        F.min(ranked).alias("_first"),
        F.max(F.when(F.col("_src") == F.lit(1), ranked)).alias("_last"),
    )
    picks = {}
    for c, n in zip(rest, p_names):
        first = F.col(f"_first.{n}")
        picks[c] = (F.when(F.col("_last").isNull(), first).otherwise(F.col(f"_last.{n}"))
                    if c in update_cols else first).alias(c)
    return out.select(*[picks.get(c, F.col(c)) for c in cols])


def insert_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: ColumnLike | Sequence[ColumnLike],
) -> DataFrame:
    """K9: ``ON CONFLICT (key) DO NOTHING``: first write wins, whole row.

    The batch is first reduced to its first row per key (arrival order given
    by ``order_by``); keys present in the target are left untouched.
    """
    first = first_per_key(batch, keys, order_by, keep="first").select(*target.columns)
    fresh = anti_join(first, target, [(k, k) for k in keys])
    return target.unionByName(fresh)


def insert_not_in(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``INSERT SELECT DISTINCT ... WHERE key NOT IN (SELECT key FROM t)``.

    DISTINCT is over whole rows, so one key with two different rows in the
    batch enters twice (the reference's behaviour); SQL null rules of
    ``NOT IN`` are kept (see ``joins.not_in``).
    """
    rows = batch.select(*target.columns).distinct()
    return target.unionByName(not_in(rows, key, target, key))


def keyed_overwrite(
    df: DataFrame,
    keys: Sequence[str],
    seq: ColumnLike | Sequence[ColumnLike],
) -> DataFrame:
    """Key-value store INSERT semantics; the last row per key wins whole."""
    return first_per_key(df, keys, seq, keep="last")


def query_layout(
    df: DataFrame,
    partition_keys: Sequence[str],
    clustering_keys: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Lay a query-first table out by (partition key, clustering key).

    Range partitioning on the full primary key keeps each partition key in
    one contiguous, sorted run of files (so a lookup reads few row groups via
    parquet min/max statistics), while a partition key that owns a large
    share of rows is split across several tasks by its clustering key rather
    than sent whole to one task as hash bucketing would.
    """
    order = [*partition_keys, *clustering_keys]
    if num_partitions:
        out = df.repartitionByRange(num_partitions, *order)
    else:
        out = df.repartitionByRange(*order)
    return out.sortWithinPartitions(*order)


def dense_ids(
    df: DataFrame,
    order_by: ColumnLike | Sequence[ColumnLike],
    name: str = "id",
    start: int = 1,
    num_partitions: int | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Gap-free surrogate keys ``start, start+1, ...`` in ``order_by``.

    Equal to a global ``row_number`` but without funnelling all rows through
    one task:

    1. rows are range-partitioned and sorted;
    2. each row is tagged with its range partition and its index inside it;
    3. the tagged rows are written once as a parquet table in the shared
       ``spark.checkpoint.dir`` (compressed, columnar; each partition is
       committed by exactly one task attempt, so the tags of a retried task
       cannot disagree with the counts, and the lineage is cut);
    4. each range partition is counted, and the running offsets - one row
       per partition, so their size is bounded by the partition count - are
       broadcast back to the stored rows.

    The tags travel with the rows, so the numbering does not depend on how
    the stored table is split when read back. ``order_by`` should be unique
    for a reproducible numbering. A caller that gives the path of the stored
    rows (``scratch``) removes them when the result has been written; keys that
    continue over loads are in ``operators.sequences``.
    """
    spark = df.sparkSession
    order = _batch_order(order_by)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    pid = F.spark_partition_id()
    tagged = ranged.sortWithinPartitions(*order).withColumns({
        "_pid": pid,
        "_idx": F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33),
    })
    stored = spark.read.parquet(write_table(tagged, scratch or scratch_path(spark, "dense-ids")))
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        stored.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_idx") + F.lit(start))
        .select(name, *df.columns)
    )
