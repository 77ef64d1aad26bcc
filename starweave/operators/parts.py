"""Stored tables that a load rewrites in parts: only the directories a batch touches.

Rows lie in directories ``part=<number>``, given by their key: a hash bucket
(``merge_buckets``) or a range of the sorted keys (``merge_ranges``). A merge
finds the parts its batch touches, computes their new rows from the stored
parts and the batch, writes these to the shared scratch folder, and replaces
the touched directories with Spark's dynamic partition overwrite. So no plan
overwrites what it reads, the other directories keep their files, and a task
that fails leaves the table as it was. The swap of directories at the job's
end is the file committer's; if the driver is lost in it, the load is run
again with the same batch, and every mode but ``append`` gives the same table.

Scratch copies are removed once the merge has committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.clean import _names, first_per_key
from starweave.operators.joins import anti_join
from starweave.operators.loads import ColumnLike, insert_absent, read_if_exists, upsert, write_table
from starweave.session import discard, scratch_path

PART = "part"
MODES = ("upsert", "insert_absent", "not_in", "overwrite", "append")
#: Most ranges a table is cut into: their bounds are held in one array.
MOST_RANGES = 10_000
#: Text forms that lose nothing of a time.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def bucket_of(keys: Sequence[Column | str], buckets: int) -> Column:
    """The bucket of a key. Types matter: an int and a bigint of one value hash apart."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _beside(base: str, name: str) -> str:
    """A folder beside the data; folders with an underscore are not read as data."""
    return f"{base.rstrip('/')}/_{name}"


def _declare(spark: SparkSession, base: str, schema: T.StructType) -> None:
    """Keep the table's schema beside it, so that no data file is opened to learn it."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(_beside(base, "schema"))


def _stored(spark: SparkSession, base: str) -> DataFrame | None:
    """The table with its part number, None where there is none."""
    declared = read_if_exists(spark, _beside(base, "schema"))
    if declared is None:
        return None
    schema = T.StructType([*declared.schema.fields, T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(base)


def read_parts(
    spark: SparkSession, base: str, parts: Sequence[int] | None = None, number: bool = False
) -> DataFrame | None:
    """The stored table, None where there is none.

    ``parts`` reads these directories only (a filter on the directory, applied
    when files are listed). ``number`` keeps the column ``part``.
    """
    stored = _stored(spark, base)
    if stored is None:
        return None
    if parts is not None:
        stored = stored.where(F.col(PART).isin([int(p) for p in parts]))
    return stored if number else stored.drop(PART)


def touched_parts(rows: DataFrame, most: int) -> list[int]:
    """Part numbers in ``rows (part, ..)``: at most ``most`` small values reach the driver."""
    found = rows.select(PART).distinct().take(most + 1)
    if len(found) > most:
        raise ValueError(f"more than {most} parts")
    return sorted(r[0] for r in found)


def _replace(rows: DataFrame, base: str, sort: Sequence[str] = ()) -> None:
    """Write ``rows (.., part)`` to scratch, then over the stored directories they name."""
    spark = rows.sparkSession
    staged = scratch_path(spark, "parts-new")
    if sort:
        rows = rows.repartitionByRange(PART, *sort).sortWithinPartitions(PART, *sort)
    else:
        rows = rows.hint("rebalance", PART)
    rows.write.partitionBy(PART).parquet(staged)
    again = spark.read.schema(rows.schema).parquet(staged)
    if sort:  # a file's rows are read in order, and files are not mixed
        again = again.sortWithinPartitions(PART, *sort)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(base)
    discard(spark, staged)


def _like(batch: DataFrame, schema: T.StructType) -> list[Column]:
    """Columns of ``schema`` from the batch, in its types (so that equal keys hash alike)."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]


def _merged(
    current: DataFrame, batch: DataFrame, keys: list[str], mode: str, order: list[ColumnLike], update_cols: Sequence[str]
) -> DataFrame:
    columns = current.columns
    if mode == "upsert":
        return upsert(current, batch, keys, update_cols, order)
    if mode == "insert_absent":
        return insert_absent(current, batch, keys, order)
    # overwrite: the batch's last row per key, whole; keys compare null-safely
    last = first_per_key(batch, keys, order, keep="last").select(*columns)
    return anti_join(current, last, [(k, k) for k in keys], null_safe=True).unionByName(last)


def merge_buckets(
    batch: DataFrame,
    base: str,
    keys: Sequence[str],
    mode: str,
    buckets: int,
    columns: Sequence[str] | None = None,
    update_cols: Sequence[str] = (),
    order_by: ColumnLike | Sequence[ColumnLike] | None = None,
) -> list[int]:
    """K8-K11 into a table of ``buckets`` key-hash directories; returns those rewritten.

    ``columns`` are the table's (default: the batch's); the batch may carry
    more, for ``order_by``. ``mode``:

    * ``upsert`` (K8), ``insert_absent`` (K9), ``overwrite`` (K11, last row wins);
    * ``append`` adds files and rewrites none;
    * ``not_in`` (K10): distinct rows whose single key is not stored. SQL's
      null rule is kept: against an empty table every row enters; else a null
      key never does, and one stored null key (looked up in its own bucket)
      keeps everything out.

    ``buckets`` must stay the same for a table. A bucket is a shuffle key's
    share of the table, so choose it for bucket sizes of some 100 MB; a batch
    of ``k`` keys rewrites at most ``k`` of them.
    """
    if mode not in MODES:
        raise ValueError(f"mode: one of {MODES}")
    keys, spark = list(keys), batch.sparkSession
    columns = list(columns or batch.columns)
    stored = _stored(spark, base)
    if stored is None:
        schema = batch.select(*columns).schema
        _declare(spark, base, schema)
    else:
        schema = stored.select(*columns).schema
    order = _names(order_by) or [F.lit(0)]
    marks = [f"_order{i}" for i in range(len(order))]
    rows = batch.withColumns({m: F.col(c) if isinstance(c, str) else c for m, c in zip(marks, order)})
    rows = rows.select(*_like(batch, schema), *marks).withColumn(PART, bucket_of(keys, buckets))
    staged = scratch_path(spark, "parts-batch")
    write_table(rows, staged, partition_by=[PART], rebalance=True)
    rows = spark.read.schema(rows.schema).parquet(staged)
    touched = touched_parts(rows, buckets)

    if mode == "append":  # further files, nothing is rewritten
        write_table(rows.select(*columns, PART), base, mode="append", partition_by=[PART], rebalance=True)
        discard(spark, staged)
        return []
    empty = spark.createDataFrame([], schema)
    current = empty if stored is None else read_parts(spark, base, touched).select(*columns)
    if mode == "not_in":
        if len(keys) != 1:
            raise ValueError("not_in takes one key")
        (key,) = keys
        rows = rows.select(*columns).distinct()
        if stored is not None and stored.select(PART).limit(1).count():
            null_part = spark.range(1).select(bucket_of([F.lit(None).cast(schema[key].dataType)], buckets)).first()[0]
            barred = read_parts(spark, base, [null_part]).where(F.col(key).isNull()).limit(1).count()
            rows = rows.where(F.col(key).isNotNull() & F.lit(not barred))
            rows = anti_join(rows, current, [(key, key)])
            touched = touched_parts(rows.select(bucket_of(keys, buckets).alias(PART)), buckets)
            current = read_parts(spark, base, touched).select(*columns)
        new = current.unionByName(rows.select(*columns))
    else:
        new = _merged(current, rows.drop(PART), keys, mode, [F.col(m) for m in marks], update_cols)
    if touched:
        _replace(new.select(*columns).withColumn(PART, bucket_of(keys, buckets)), base)
    discard(spark, staged)
    return touched


# --- ranges (K12) -----------------------------------------------------------


def create_ranges(
    df: DataFrame, base: str, partition_keys: Sequence[str], clustering_keys: Sequence[str] = (), ranges: int = 200
) -> str:
    """Store a query-first table in sorted key ranges, and the ranges' lower bounds beside it."""
    if not 0 < ranges <= MOST_RANGES:
        raise ValueError(f"ranges: 1 to {MOST_RANGES}")
    spark, order = df.sparkSession, [*partition_keys, *clustering_keys]
    laid = df.repartitionByRange(ranges, *order).withColumn(PART, F.spark_partition_id())
    laid = laid.sortWithinPartitions(*order)
    laid.write.mode("error").partitionBy(PART).parquet(base)
    _declare(spark, base, df.schema)
    stored = spark.read.schema(laid.schema).parquet(base)
    lowest = F.min(F.struct(*order)).alias("low")
    stored.groupBy(PART).agg(lowest).coalesce(1).write.parquet(_beside(base, "bounds"))
    return base


def range_of(spark: SparkSession, base: str, order: Sequence[str]) -> Column:
    """The range of a key: the last one whose lower bound is not above it; keys below all go to the first.

    The bounds are one constant array (at most ``MOST_RANGES`` keys pass the driver),
    searched in two steps: every 100th bound, then the 100 behind it.
    """
    bounds = spark.read.parquet(_beside(base, "bounds"))
    every = F.sort_array(F.collect_list(F.struct("low", PART)))
    row = bounds.agg(F.count(F.lit(1)).alias("n"), every.alias("a")).select("n", F.to_json("a", EXACT).alias("a")).first()
    if row.n > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges")
    # a constant, parsed once when the plan is made
    kind = T.ArrayType(T.StructType([bounds.schema["low"], bounds.schema[PART]]))
    array = F.from_json(F.lit(row.a), kind, EXACT)
    key = F.struct(*[F.col(c) for c in order])
    upto = lambda a: F.size(F.filter(a, lambda b: b["low"] <= key))
    step = 100
    tops = F.filter(array, lambda b, i: i % step == 0)
    block = F.greatest(upto(tops) - 1, F.lit(0)) * step
    inside = F.greatest(upto(F.slice(array, block + 1, F.lit(step))), F.lit(1))
    return F.get(array, (block + inside - 1).cast("int"))[PART]


def merge_ranges(
    batch: DataFrame,
    base: str,
    partition_keys: Sequence[str],
    clustering_keys: Sequence[str],
    seq: ColumnLike | Sequence[ColumnLike],
) -> list[int]:
    """K11 into a table of ``create_ranges``: the batch's last row per key replaces the stored one.

    Rows are routed to ranges by the stored bounds; only the ranges they fall
    in are read, merged and rewritten, sorted. Returns these. Lookups stay as
    they are: a file holds one contiguous key range.
    """
    spark, keys = batch.sparkSession, [*partition_keys, *clustering_keys]
    stored = _stored(spark, base)
    columns = [c for c in stored.columns if c != PART]
    last = first_per_key(batch, keys, seq, keep="last")
    last = last.select(*_like(last, stored.select(*columns).schema))
    rows = last.withColumn(PART, range_of(spark, base, keys))
    staged = scratch_path(spark, "ranges-batch")
    write_table(rows, staged, partition_by=[PART], rebalance=True)
    rows = spark.read.schema(rows.schema).parquet(staged)
    touched = touched_parts(rows, MOST_RANGES)
    if touched:
        current = stored.where(F.col(PART).isin(touched)).select(*columns, PART)
        kept = anti_join(current, rows, [(k, k) for k in keys], null_safe=True)
        _replace(kept.unionByName(rows), base, sort=keys)
    discard(spark, staged)
    return touched

