"""Versions of a stored table: a load writes a fresh folder, then it is the current one.

A version is the folder ``v<number>`` under the table's path. It counts once
Spark has committed it (``_SUCCESS``), so a job that fails halfway leaves the
version before it in place, and no plan overwrites what it reads. Folders are
listed through Hadoop's file system, so any store Spark can write to will do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from starweave.operators.loads import write_table


def _versions(spark: SparkSession, base: str) -> tuple[list[int], int]:
    """Committed version numbers, and the highest number taken by any folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return [], 0
    done, top = [], 0
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v") and name[1:].isdigit():
            top = max(top, int(name[1:]))
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                done.append(int(name[1:]))
    return sorted(done), top


def current_path(spark: SparkSession, base: str) -> str | None:
    """Folder of the current version, None where nothing was published."""
    done, _ = _versions(spark, base.rstrip("/"))
    return f"{base.rstrip('/')}/v{done[-1]:08d}" if done else None


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    path = current_path(spark, base)
    return spark.read.parquet(path) if path else None


def publish(df: DataFrame, base: str, partition_by: Sequence[str] = (), keep: int = 2, options: Mapping[str, str] | None = None) -> str:
    """Write ``df`` as the next version and drop all but the last ``keep``.

    One version before the new one stays by default, for readers that have
    opened it.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    _, top = _versions(spark, base)
    path = write_table(df, f"{base}/v{top + 1:08d}", mode="error", partition_by=partition_by, options=options)
    done, _ = _versions(spark, base)
    for old in done[:-keep] if keep else []:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/v{old:08d}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return path


def truncate_load(
    df: DataFrame, base: str, columns: Sequence[str] | None = None, keep: int = 1, options: Mapping[str, str] | None = None
) -> str:
    """K6/K7: delete all rows, then insert, as one switch: a failed job leaves the rows of before.

    ``columns`` gives the target's column order (the insert is by position).
    """
    return publish(df.select(*columns) if columns else df, base, keep=keep, options=options)
