"""Data-quality checks (Q1-Q8, K15) as one aggregate pass per table.

A check set on a table is a single global aggregate (row count, null keys,
distinct keys) whose few output values are turned into report rows
``(table, column, check, value, passed)``. Type checks read only the schema.
The report is a DataFrame; ``assert_passed`` raises on failures after
collecting just the failing report rows (a handful, bounded by the number of
checks).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starweave.operators.joins import orphans
from starweave.operators.loads import write_table

REPORT_SCHEMA = "table_name string, column_name string, check_name string, value bigint, passed boolean"
REPORT_COLUMNS = ["table_name", "column_name", "check_name", "value", "passed"]


class DataQualityError(ValueError):
    """Raised by ``assert_passed`` when a check failed."""


@dataclass
class TableChecks:
    """Checks for one table.

    * ``min_rows`` (Q1): at least this many rows (default 1: not empty).
    * ``key`` (Q2, Q3): columns that must be non-null and unique together.
    * ``expected_rows`` (Q5): exact row count.
    * ``types`` (Q4): column -> expected ``df.dtypes`` string.
    * ``not_null`` / ``unique``: switch the key checks off individually.
    """

    table: str
    df: DataFrame
    key: Sequence[str] = ()
    min_rows: int | None = 1
    expected_rows: int | None = None
    types: Mapping[str, str] = field(default_factory=dict)
    not_null: bool = True
    unique: bool = True


def _row(table: str, column: str, check: str, value, passed):
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.lit(value).cast("bigint").alias("value") if not hasattr(value, "alias") else value.cast("bigint").alias("value"),
        (passed if hasattr(passed, "alias") else F.lit(passed)).alias("passed"),
    )


def table_report(spec: TableChecks) -> DataFrame:
    """Q1-Q5 for one table in a single aggregate job."""
    df, key = spec.df, list(spec.key)
    aggs = [F.count(F.lit(1)).alias("n")]
    if spec.not_null:
        for k in key:
            aggs.append(F.count_if(F.col(k).isNull()).alias(f"null_{k}"))
    if key and spec.unique:
        full = None
        for k in key:
            full = F.col(k).isNotNull() if full is None else full & F.col(k).isNotNull()
        aggs.append(F.count_if(full).alias("n_keyed"))
        aggs.append(F.count_distinct(*[F.col(k) for k in key]).alias("n_distinct"))
    stats = df.agg(*aggs)

    rows = []
    n = F.col("n")
    if spec.min_rows is not None:
        rows.append(_row(spec.table, "*", "min_rows", n, n >= F.lit(spec.min_rows)))
    if spec.expected_rows is not None:
        rows.append(_row(spec.table, "*", "expected_rows", n, n == F.lit(spec.expected_rows)))
    if spec.not_null:
        for k in key:
            nulls = F.col(f"null_{k}")
            rows.append(_row(spec.table, k, "not_null", nulls, nulls == F.lit(0)))
    if key and spec.unique:
        dups = F.col("n_keyed") - F.col("n_distinct")
        rows.append(_row(spec.table, ",".join(key), "unique", dups, dups == F.lit(0)))
    actual = dict(df.dtypes)
    for column, expected in spec.types.items():
        ok = actual.get(column) == expected
        rows.append(_row(spec.table, column, f"type={expected}", 0 if ok else 1, ok))
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def write_checked(spec: TableChecks, path: str, **write) -> DataFrame:
    """A1/Q1/Q2/Q4/Q5 of a frame while it is written: the report of ``table_report``, without a second scan.

    The writing tasks count their rows and null keys (an ``Observation`` on the
    frame as it is written, behind any shuffle of ``write_table``). Repeated
    keys cannot be counted that way: a spec that asks for them is an error.
    ``write`` goes to ``write_table``.
    """
    if spec.key and spec.unique:
        raise ValueError("repeats are not counted while writing; set unique=False")
    df, key = spec.df, list(spec.key) if spec.not_null else []
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in key]]
    write_table(df, path, observe=(seen, counts), **write)
    got = seen.get
    rows, n = [], got.get("n", 0)
    if spec.min_rows is not None:
        rows.append((spec.table, "*", "min_rows", n, n >= spec.min_rows))
    if spec.expected_rows is not None:
        rows.append((spec.table, "*", "expected_rows", n, n == spec.expected_rows))
    for k in key:
        nulls = got.get(f"null_{k}", 0)
        rows.append((spec.table, k, "not_null", nulls, nulls == 0))
    actual = dict(df.dtypes)
    for column, expected in spec.types.items():
        ok = actual.get(column) == expected
        rows.append((spec.table, column, f"type={expected}", 0 if ok else 1, ok))
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def fk_report(table: str, fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Count fact rows whose foreign key has no dimension row.

    The fact is reduced to one row per foreign key, with its count, before
    the join: partial counts combine map-side, so no key is hot there.
    """
    counts = fact.groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
    n = orphans(counts, fk, dim, pk).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    return n.select(
        F.lit(table).alias("table_name"),
        F.lit(fk).alias("column_name"),
        F.lit(f"references={pk}").alias("check_name"),
        F.col("n").cast("bigint").alias("value"),
        (F.col("n") == F.lit(0)).alias("passed"),
    )


def report(specs: Sequence[TableChecks], fks: Sequence[tuple] = ()) -> DataFrame:
    """Q6: run check sets over many tables; one report frame."""
    parts = [table_report(s) for s in specs] + [fk_report(*f) for f in fks]
    if not parts:
        raise ValueError("no checks given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every key seen more than once, with its count.

    A grouped count combines map-side, so a key holding a large share of
    rows costs one partial count per task, not one task with all its rows.
    """
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("count_total"))
        .where(F.col("count_total") > F.lit(1))
    )


def assert_passed(report_df: DataFrame) -> None:
    """Raise ``DataQualityError`` listing the failed checks (``raise`` mode)."""
    failed = report_df.where(~F.col("passed")).collect()
    if failed:
        lines = [
            f"{r.table_name}.{r.column_name} {r.check_name}: value {r.value}" for r in failed
        ]
        raise DataQualityError("data quality check failed: " + "; ".join(lines))


def column_type_ok(df: DataFrame, column: str, expected: str) -> bool:
    """Q4: metadata-only type test (no job)."""
    return dict(df.dtypes).get(column) == expected
