"""Quality checks kept per period (K15, Q1-Q3, Q6, Q8): a load checks what it has touched.

A fact grows by periods, so checking it whole costs more with every load. Here
each period's part of the checks is computed once and stored:

* ``keys/<period>``: for every checked column, each value and its rows. All
  columns come from one scan: rows are unpivoted with ``stack`` and counted,
  map-side first, so a hot key is one row per task;
* ``measures``: per period, rows, nulls and distinct values of each column;
* ``orphans``: per period, the values that had no dimension row when last
  looked at.

A load refreshes the periods it has touched (late rows refresh an old one) by
dynamic partition overwrite, reads their keys back, and looks up the keys of these, and the orphans
known from before, since dimensions grow; everything else stays unread. The
report of the whole table is summed from the measures and the orphans.

A period is recomputed whole from its rows, not added to, so running a load
again changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.operators.loads import MAX_TOUCHED_PARTITIONS, in_periods, write_table
from starweave.operators.parts import bucket_of, read_parts
from starweave.operators.quality import REPORT_SCHEMA
from starweave.operators.versions import publish, read_current
from starweave.session import discard, scratch_path


@dataclass
class Reference:
    """The dimension a column refers to: a frame, or a table of key-hash directories.

    Of a table in ``buckets`` directories (``operators.parts``) only those of
    the looked-up keys are read.
    """

    key: str
    dim: DataFrame | None = None
    base: str | None = None
    buckets: int = 0

    def keys_for(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        """``(key)`` of the dimension as text, at least those of ``wanted (key)``."""
        dim = self.dim
        if self.base is not None:
            stored = read_parts(spark, self.base)
            if stored is None:
                return spark.createDataFrame([], "key string")
            kind = stored.schema[self.key].dataType
            part = bucket_of([F.col("key").cast(kind)], self.buckets).alias("part")
            parts = [r.part for r in wanted.select(part).distinct().take(self.buckets)]
            dim = read_parts(spark, self.base, parts)
        return dim.select(F.col(self.key).cast("string").alias("key"))


def touched_values(rows: DataFrame, names: Sequence[str], most: int = MAX_TOUCHED_PARTITIONS) -> list[tuple]:
    """Distinct values of the directory columns in ``rows``: at most ``most`` small rows reach the driver."""
    found = rows.select(*names).distinct().take(most + 1)
    if len(found) > most:
        raise ValueError(f"more than {most} periods in one load")
    return [tuple(r) for r in found]


def profile(rows: DataFrame, period: Sequence[str], columns: Mapping[str, Column | str]) -> DataFrame:
    """``(period.., column_name, key, n)``: rows per value of each column, in one scan.

    ``columns`` maps a name to a column or expression; values compare as text.
    """
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns.values()]
    flat = [x for name, text in zip(columns, texts) for x in (F.lit(name), text)]
    one = rows.select(*period, F.stack(F.lit(len(columns)), *flat).alias("column_name", "key"))
    return one.groupBy(*period, "column_name", "key").agg(F.count(F.lit(1)).alias("n"))


def measures(keys: DataFrame, period: Sequence[str]) -> DataFrame:
    """``(period.., column_name, n_rows, n_nulls, n_values)`` from a profile."""
    return keys.groupBy(*period, "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.count("key").alias("n_values"),
    )


def _without(candidates: DataFrame, references: Mapping[str, Reference], scratch: list[str]) -> DataFrame:
    """The candidates ``(.., column_name, key, n)`` whose key has no dimension row.

    Only the bare keys meet the dimension. The lost ones are stored (their
    paths are added to ``scratch``), so that the planner knows their size:
    where they are few, the candidates stay where they are.
    """
    spark, out = candidates.sparkSession, None
    for name, reference in references.items():
        mine = candidates.where((F.col("column_name") == F.lit(name)) & F.col("key").isNotNull())
        wanted = mine.select("key").distinct()
        known = reference.keys_for(spark, wanted).select(F.col("key").alias("_known"))
        lost = wanted.join(known, F.col("key") == F.col("_known"), "left_anti").select(F.col("key").alias("_lost"))
        scratch.append(write_table(lost, scratch_path(spark, "quality-lost")))
        lost = spark.read.schema(lost.schema).parquet(scratch[-1])
        left = mine.join(lost, F.col("key") == F.col("_lost"), "left_semi")
        out = left if out is None else out.unionByName(left)
    return candidates.limit(0) if out is None else out


def refresh(
    rows: DataFrame,
    base: str,
    period: Sequence[str],
    columns: Mapping[str, Column | str],
    references: Mapping[str, Reference] | None = None,
    dimensions_shrink: bool = False,
) -> None:
    """Recompute the stored state of the periods in ``rows``, which holds all rows of these.

    With ``dimensions_shrink`` (a dimension that is truncated and loaded
    again) the stored keys of every period are looked up, not only the touched
    ones: still no row of the fact is read.
    """
    spark, base, period = rows.sparkSession, base.rstrip("/"), list(period)
    touched = touched_values(rows, period)
    if touched:
        fresh = profile(rows, period, columns)
        write_table(fresh, f"{base}/keys", partition_by=period, rebalance=True,
                    options={"partitionOverwriteMode": "dynamic"})
        stored = spark.read.schema(fresh.schema).parquet(f"{base}/keys")
        fresh = stored.where(in_periods(period, touched))
    else:
        stored = fresh = spark.createDataFrame([], profile(rows, period, columns).schema)

    known = read_current(spark, f"{base}/measures")  # a row per period and column
    new = measures(fresh, period)
    if known is not None:
        new = known.where(~in_periods(period, touched)).select(*new.columns).unionByName(new)
    publish(new, f"{base}/measures")
    if not references:
        return
    before = read_current(spark, f"{base}/orphans")
    names = [*period, "column_name", "key", "n"]
    if dimensions_shrink:
        candidates = stored.select(*names)
    elif before is None:
        candidates = fresh.select(*names)
    else:
        others = before.where(~in_periods(period, touched))
        candidates = fresh.select(*names).unionByName(others.select(*names))
    lost: list[str] = []  # candidates are stored rows: each column reads its own
    publish(_without(candidates, references, lost), f"{base}/orphans")
    discard(spark, *lost)


def state_report(
    spark: SparkSession,
    base: str,
    table: str,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    references: Mapping[str, Reference] | None = None,
    min_rows: int | None = 1,
    expected_rows: int | None = None,
    reference_table: str | None = None,
) -> DataFrame:
    """The report of ``operators.quality`` over the whole table, from its stored state alone.

    ``unique`` needs columns whose value belongs to one period only (a key the
    period is derived from): repeats are counted within periods. No stored
    state counts as an empty table.
    """
    base = base.rstrip("/")
    stored = read_current(spark, f"{base}/measures")
    if stored is None:
        stored = spark.createDataFrame([], "column_name string, n_rows long, n_nulls long, n_values long")
    orphans = read_current(spark, f"{base}/orphans")
    if orphans is None:
        orphans = spark.createDataFrame([], "column_name string, n long")
    totals = stored.groupBy("column_name").agg(*[F.sum(c).cast("long").alias(c) for c in ("n_rows", "n_nulls", "n_values")])
    found = {r.column_name: r for r in totals.collect()}  # one row per checked column
    lost = {r.column_name: r.n for r in orphans.groupBy("column_name").agg(F.sum("n").alias("n")).collect()}
    rows = []
    n = max((r.n_rows for r in found.values()), default=0)
    if min_rows is not None:
        rows.append((table, "*", "min_rows", n, n >= min_rows))
    if expected_rows is not None:
        rows.append((table, "*", "expected_rows", n, n == expected_rows))
    for name in not_null:
        nulls = found[name].n_nulls if name in found else 0
        rows.append((table, name, "not_null", nulls, nulls == 0))
    for name in unique:
        again = found[name].n_rows - found[name].n_nulls - found[name].n_values if name in found else 0
        rows.append((table, name, "unique", again, again == 0))
    for name, reference in (references or {}).items():
        rows.append((reference_table or table, name, f"references={reference.key}", lost.get(name, 0), not lost.get(name, 0)))
    return spark.createDataFrame(rows, REPORT_SCHEMA)
