"""Projection, filter and dedupe operators.

"First wins" / "last wins" are deterministic here: the reference relied on
arrival order, which Spark does not keep, so every such operator takes an
order. The pick is a grouped ``min`` / ``max`` of one struct (order columns,
then the row), which is a partial (map-side) aggregate: a key that owns a
third of all rows is reduced to one row per map task before the shuffle, so a
hot key never lands whole in one task, and no window sort of the full input
is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _names(cols: ColumnLike | Sequence[ColumnLike] | None) -> list[ColumnLike]:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def project(df: DataFrame, mapping: Mapping[str, ColumnLike] | Sequence[str]) -> DataFrame:
    """Select and rename in one pass.

    ``mapping`` is either a list of column names or ``{new_name: source}``
    where the source is a column name or a Column expression.
    """
    if isinstance(mapping, Mapping):
        return df.select([_c(src).alias(dst) for dst, src in mapping.items()])
    return df.select(*mapping)


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in a single projection."""
    return df.withColumns(dict(exprs))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """P3."""
    return df.drop(*names)


def keep_where(df: DataFrame, *conditions: Column, **equals) -> DataFrame:
    """conjunction of predicates and ``col == literal`` tests.

    Written as plain filters so Catalyst pushes them into the scan.
    """
    cond = None
    for c in [*conditions, *(F.col(k) == F.lit(v) for k, v in equals.items())]:
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """SELECT DISTINCT (nulls compare equal)."""
    return (df.select(*cols) if cols else df).distinct()


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: ColumnLike | Sequence[ColumnLike],
    keep: str = "first",
) -> DataFrame:
    """One row per key, the first (or last) by ``order_by``.

    The rest of the row is appended to the order as a tie-break, so the pick
    is deterministic even when the order ties. Output keeps ``df``'s columns.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    # One struct (order columns, then the rest of the row) is both the order
    # and the payload, so the aggregation buffer - and each partial row that
    # is shuffled - carries the row once (min_by(row, order) would carry it
    # twice). Fields are named by position: order and row columns may share
    # names.
    order = [_c(c) for c in _names(order_by)]
    ranked = F.struct(
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(f"_p{j}") for j, c in enumerate(others)],
    )
    if keep == "first":
        picked = F.min(ranked)
    elif keep == "last":
        picked = F.max(ranked)
    else:
        raise ValueError("keep must be 'first' or 'last'")
    return (
        df.groupBy(*keys)
        .agg(picked.alias("_picked"))
        .select(*keys, *[F.col(f"_picked._p{j}").alias(c) for j, c in enumerate(others)])
        .select(*df.columns)
    )


def dedupe(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: ColumnLike | Sequence[ColumnLike] | None = None,
    keep: str = "first",
) -> DataFrame:
    """Drop duplicate rows, or keep one row per key.

    Without ``keys`` whole rows are deduplicated. With ``keys`` and no
    ``order_by`` any row per key is kept, exactly as ``dropDuplicates`` does
    (the kept row may change between runs); pass ``order_by`` to make it
    deterministic.
    """
    if not keys:
        return df.dropDuplicates()
    if order_by is None:
        return df.dropDuplicates(list(keys))
    return first_per_key(df, keys, order_by, keep)


def nonblank(df: DataFrame, *cols: str) -> DataFrame:
    """skip rows whose given columns are null or empty strings."""
    cond = None
    for name in cols:
        c = F.col(name).isNotNull() & (F.col(name) != F.lit(""))
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)
