"""Key-matching joins of a log against a dimension.

Physical strategy is left to Catalyst + AQE: a dimension below the broadcast
threshold (estimated statically, or measured after its shuffle by AQE) is
broadcast, anything larger takes a sort-merge join whose hot keys AQE splits.
No join here hints an unbounded side for broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.text import to_decimal18
from starweave.operators.clean import first_per_key

JOIN_KINDS = ("inner", "left", "first_match")


def _key_frames(
    log: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    rounded: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Put both sides' key values under shared temporary names.

    Columns listed in ``rounded`` (log-side names) go through the
    ``numeric(18,0)`` rounding on both sides first (J4).
    """
    names = []
    lcols, rcols = {}, {}
    for i, (lc, rc) in enumerate(on):
        k = f"_k{i}"
        names.append(k)
        lcol, rcol = F.col(lc), F.col(rc)
        if lc in rounded:
            lcol, rcol = to_decimal18(lcol), to_decimal18(rcol)
        lcols[k], rcols[k] = lcol, rcol
    return log.withColumns(lcols), dim.withColumns(rcols), names


def natural_key_join(
    log: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    dim_order: Column | str | Sequence[Column | str] | None = None,
    rounded: Sequence[str] = (),
) -> DataFrame:
    """Match log rows to dimension rows on equal natural-key values.

    * ``inner`` (J1): unmatched log rows dropped, every match kept.
    * ``left`` (J2): unmatched log rows kept with null dimension columns.
    * ``first_match`` (J3): at most one match per log row, the first by
      ``dim_order``; unmatched rows kept. The dimension is reduced to one row
      per key before the join, so the log is never multiplied.

    ``rounded`` names log-side key columns compared after rounding both sides
    to ``decimal(18,0)`` (J4). Key equality is exact and null never matches.
    Returns the log's columns followed by the dimension's columns.
    """
    if how not in JOIN_KINDS:
        raise ValueError(f"how must be one of {JOIN_KINDS}")
    lk, rk, keys = _key_frames(log, dim, on, rounded)
    if how == "first_match":
        if dim_order is None:
            raise ValueError("first_match needs dim_order to make the pick deterministic")
        rk = first_per_key(rk, keys, dim_order, keep="first")
    joined = lk.join(rk, on=keys, how="inner" if how == "inner" else "left")
    return joined.select(*[lk[c] for c in log.columns], *[rk[c] for c in dim.columns])


def anti_join(
    df: DataFrame,
    target: DataFrame,
    on: Sequence[tuple[str, str]],
    null_safe: bool = False,
) -> DataFrame:
    """J6 (``ON CONFLICT DO NOTHING`` shape): rows whose key has no match.

    Both sides reach the join straight from their exchanges (a repeated
    target key drops no row twice, so the target is not made distinct first):
    AQE can then split a key that holds a large share of ``df``. With
    ``null_safe`` a null key part matches a null (``<=>``), which makes a
    rerun of a load with nullable key columns idempotent; it is still an
    equi-join (hash or sort-merge), not a nested loop.
    """
    lk, rk, keys = _key_frames(df, target, on)
    right = rk.select(*[F.col(k).alias(f"{k}_t") for k in keys])
    cond = None
    for k in keys:
        c = lk[k].eqNullSafe(right[f"{k}_t"]) if null_safe else lk[k] == right[f"{k}_t"]
        cond = c if cond is None else cond & c
    return lk.join(right, cond, how="left_anti").select(*df.columns)


def not_in(df: DataFrame, key: str, target: DataFrame, target_key: str) -> DataFrame:
    """``WHERE key NOT IN (SELECT target_key FROM target)``.

    SQL's three-valued rule is kept. Against an empty target every row
    qualifies, one with a null key too; otherwise a null key never does, and
    a single null in the target's keys makes the result empty. Both facts
    about the target are scalar subqueries computed once, not a broadcast of
    it; the anti join itself can be split where a key is hot.
    """
    tk = F.col(target_key)
    n_keys = target.select(F.count(F.lit(1)).alias("n")).scalar()
    n_nulls = target.select(F.count_if(tk.isNull()).alias("n")).scalar()
    keys = target.select(tk.alias("_k")).where(F.col("_k").isNotNull())
    kept = df.join(keys, F.col(key) == F.col("_k"), "left_anti")
    known = (n_nulls == F.lit(0)) & F.col(key).isNotNull()
    return kept.where((n_keys == F.lit(0)) | known).select(*df.columns)


def orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Fact rows whose non-null foreign key has no dimension row.

    A foreign key that a large share of the fact holds is split by AQE.
    """
    keys = dim.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    return (
        fact.where(F.col(fk).isNotNull())
        .join(keys, F.col(fk) == F.col("_pk"), "left_anti")
        .select(*fact.columns)
    )
