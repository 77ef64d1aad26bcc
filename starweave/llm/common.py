"""Small shared helpers: stored intermediates and vectorised word handling."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.session import scratch_path

#: A word is a run of ``[^\x20\x09-\x0D]``.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


#: Lists of the paths that ``stored`` has written, of who asked for them.
_watching: list[list[str]] = []


@contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """The paths of tables that ``stored`` writes meanwhile, in order."""
    used: list[str] = []
    _watching.append(used)
    try:
        yield used
    finally:
        _watching[:] = [w for w in _watching if w is not used]


def stored(df: DataFrame, name: str, per_file: int = 0) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    The result no longer depends on executors that computed it, and later
    steps read it instead of computing it again. ``per_file`` bounds the rows
    of a file (0: no bound).
    """
    path = scratch_path(df.sparkSession, name)
    for used in _watching:
        used.append(path)
    df.write.option("maxRecordsPerFile", per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 1_000, size: int = 8 << 20) -> None:
    """Bound the Arrow batches of texts that the session hands to Python, in rows and bytes.

    A batch is held several times over on its way (JVM, Python, results), by
    each worker of an executor.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def sampled(df: DataFrame, turn: Column, most: int, rows: int | None = None, spare: float = 4.0) -> DataFrame:
    """At most ``most`` rows of ``df``, the same in every run: those whose hash ``turn`` is smallest.

    Rows are first thinned to about ``spare * most`` by their hash (``rows`` is
    the row count, counted if not given), so what meets in one task to be
    ordered is bounded whatever the input. ``turn`` is a signed 64-bit hash.
    """
    rows = df.count() if rows is None else rows
    share = min(1.0, spare * most / max(1, rows))
    if share < 1:
        df = df.where(turn < F.lit(int(-(2**63) + share * 2**64)))
    return df.orderBy(turn).limit(most)


def utf8(column: pa.Array) -> pa.Array:
    """The column as binary, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.binary()), b"")


@cache
def _trim():
    """The C library's call that returns freed memory to the system, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return unused memory of a Python worker: it lives on, and its next task may be another stage's."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)``: all bytes of a binary column and where each row starts."""
    column = pa.concat_arrays([column]) if column.offset else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def is_space(data: np.ndarray) -> np.ndarray:
    """Whether each byte is white space."""
    return (data - np.uint8(9) <= 4) | (data == 32)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte range of every word, and the index of each row's first word.

    ``first`` has one more entry than there are rows.
    """
    inside = ~is_space(data)
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
