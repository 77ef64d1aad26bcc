"""Query-first tables (C11, C12): merged event file and keyed lookups.

A query-first table is the last row per primary key (key-value INSERT is an
upsert of the whole row), laid out range-partitioned and sorted on
(partition key, clustering key), so a lookup by partition key reads a few
row groups through parquet statistics and returns rows in clustering order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starweave.operators.clean import nonblank
from starweave.operators.loads import keyed_overwrite, query_layout, write_table
from starweave.sources.readers import read_csv


def merge_event_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    out_path: str,
    columns: Sequence[str],
    required: str,
    schema=None,
) -> str:
    """C11: read many event CSV files (header skipped in each), drop rows whose
    ``required`` column is empty, keep ``columns`` and write one quoted CSV
    data set (every field quoted, header written, many part files)."""
    raw = read_csv(spark, paths, schema=schema, header=True,
                   options={"recursiveFileLookup": "true"})
    rows = nonblank(raw, required).select(*columns)
    return write_table(rows, out_path, fmt="csv",
                       options={"header": "true", "quoteAll": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def build_query_table(
    df: DataFrame,
    partition_keys: Sequence[str],
    clustering_keys: Sequence[str],
    columns: Sequence[str],
    seq: Column | str | Sequence[Column | str],
) -> DataFrame:
    """K11 + K12: last row per primary key, laid out by (partition, clustering)."""
    keys = [*partition_keys, *clustering_keys]
    latest = keyed_overwrite(df.select(*columns, *([seq] if isinstance(seq, (str, Column)) else seq)), keys, seq)
    return query_layout(latest.select(*columns), partition_keys, clustering_keys)


def lookup_positions(table: DataFrame, clustering_keys: Sequence[str], name: str = "position", **key_values) -> DataFrame:
    """A partition's rows with their place in clustering order, from 0, in as many tasks as it has files.

    ``table`` is a stored query-first table, read straight from its files: a
    file holds one sorted run of keys, and runs do not overlap. So a row's
    place is its row number in its file, less that of the partition's first row
    there, plus the partition's rows in the files before: one small row per
    file is summed up and joined back. Nothing is sorted.
    """
    rows = lookup(table, **key_values)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"), F.min(F.struct(*clustering_keys)).alias("_low")
    )
    before = Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(files, "_file")
    return placed.select(*table.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias(name))


def lookup(table: DataFrame, clustering_keys: Sequence[str] = (), **key_values) -> DataFrame:
    """Rows of one partition (or one full key), in clustering order."""
    cond = None
    for k, v in key_values.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    out = table.where(cond) if cond is not None else table
    return out.orderBy(*clustering_keys) if clustering_keys else out
