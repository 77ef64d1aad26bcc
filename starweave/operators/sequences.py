"""Surrogate keys that continue over loads.

A stored map holds every natural key that ever got an id. A load numbers only
the keys the map lacks, from the highest id on, and appends them; known keys
keep theirs, and a load run again finds all its keys and changes nothing.

The map lies in directories ``upto=<highest id>/part=<key hash>``. Each load
adds one ``upto``; since its name holds the highest id, the next load's first
id comes from listing directories, not from a scan. A load looks its keys up
in the hash directories they fall in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.clean import _c, _names, first_per_key
from starweave.operators.loads import ColumnLike, dense_ids, read_if_exists, write_table
from starweave.operators.parts import PART, bucket_of, touched_parts
from starweave.session import discard, scratch_path

UPTO = "upto"


def _map(spark: SparkSession, base: str, keys: Sequence[T.StructField], name: str) -> DataFrame | None:
    schema = T.StructType([*keys, T.StructField(name, T.LongType()), T.StructField(UPTO, T.LongType()),
                           T.StructField(PART, T.IntegerType())])
    return read_if_exists(spark, base, schema=schema)


def _same(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return cond


def highest_id(spark: SparkSession, base: str, start: int = 1) -> int:
    """The highest id given so far, ``start - 1`` where there is none."""
    stored = read_if_exists(spark, base)
    top = None if stored is None else stored.select(F.max(F.col(UPTO).cast("long"))).first()[0]
    return start - 1 if top is None else top


def extend_ids(
    rows: DataFrame,
    base: str,
    keys: Sequence[str],
    order_by: ColumnLike | Sequence[ColumnLike],
    name: str = "id",
    buckets: int = 16,
    start: int = 1,
) -> DataFrame:
    """Give every natural key of ``rows`` an id, and return the rows with it (first column ``name``).

    New keys are numbered without gaps in the order of their first row by
    ``order_by``. A null key part is a value like any other. ``rows`` is read
    twice (its keys, then the join), so it should be a stored table. One load
    at a time may extend a map. ``buckets`` must stay the same for a map.

    A key that a large share of the rows hold is one row per task before the
    lookup, and AQE splits its share of the last join.
    """
    spark, keys, base = rows.sparkSession, list(keys), base.rstrip("/")
    fields = [rows.schema[k] for k in keys]
    order = [_c(c).alias(f"o{i}") for i, c in enumerate(_names(order_by))]
    # the order travels with the key, so that a tie of orders falls to the key itself
    first = first_per_key(rows.select(*keys, F.struct(*order).alias("_first")), keys, ["_first"])
    staged = scratch_path(spark, "sequence-keys")
    first = first.withColumn(PART, bucket_of(keys, buckets))
    first = spark.read.schema(first.schema).parquet(write_table(first, staged, partition_by=[PART], rebalance=True))
    touched = touched_parts(first, buckets)

    stored = _map(spark, base, fields, name)
    fresh, top = first, start - 1
    if stored is not None:
        top = highest_id(spark, base, start)
        known = stored.where(F.col(PART).isin(touched)).select(*[F.col(k).alias(f"_{k}") for k in keys])
        fresh = first.join(known, _same(keys), "left_anti")
    numbered = scratch_path(spark, "sequence-ids")
    new = dense_ids(fresh, ["_first", *keys], name=name, start=top + 1, scratch=numbered).select(*keys, name, PART)
    # a plan that finds no new key writes an empty table; it is not appended
    end = spark.read.parquet(numbered).count()
    if end:
        write_table(new, f"{base}/{UPTO}={top + end}", mode="overwrite", partition_by=[PART], rebalance=True)
    discard(spark, staged, numbered)

    every = _map(spark, base, fields, name)
    if every is None:  # no rows ever
        return rows.limit(0).select(F.lit(None).cast("long").alias(name), *rows.columns)
    ids = every.where(F.col(PART).isin(touched)).select(F.col(name).alias("_id"), *[F.col(k).alias(f"_{k}") for k in keys])
    return rows.join(ids, _same(keys)).select(F.col("_id").alias(name), *rows.columns)


def compact(spark: SparkSession, base: str, keys: Sequence[str], name: str = "id") -> str:
    """The map of many loads as one of few files, at a fresh path (the caller switches over)."""
    top = highest_id(spark, base)
    stored = spark.read.parquet(base).select(*keys, name, PART)
    to = f"{base.rstrip('/')}-{top}"
    write_table(stored, f"{to}/{UPTO}={top}", mode="error", partition_by=[PART], rebalance=True)
    return to
