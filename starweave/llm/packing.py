"""Harmonic packing of token ids into sequences (Lee and Lee, 1985).

A document is cut into pieces whose lengths are the capacity, its halvings
down to ``LEAST`` and one rest under that. A piece of length L belongs to the
class of reciprocal ``k = capacity // L`` and a bin of that class holds k
pieces. Workers number their pieces of each class on their own; adding the
counts of the workers before them gives every piece its place, so bins fill up
across workers without any of them seeing another's pieces.

Full bins of halved lengths have no padding, those of a rest of L tokens less
than L. Under k pieces per class are left over, a fixed number whatever the
input: of halved lengths they make sequences at powers of two, of the rests
they fill bins one after the other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starweave.llm.common import pieces, small_batches, stored, utf8
from starweave.llm.tokens import BATCH_BYTES, transducer

CAPACITY = 4096
#: The shortest halving of the capacity; rests are shorter.
LEAST = 64
FIELDS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, place long"


def cuts(tokens: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of a document's pieces, in order."""
    out = [capacity] * (tokens // capacity)
    rest, size = tokens % capacity, capacity // 2
    while size >= least:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


def _pieces(path: str, end: int, capacity: int, least: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, worker = transducer(path), TaskContext.get().partitionId()
        placed: dict[int, int] = {}
        for batch in pieces(batches, "text", BATCH_BYTES):
            rows, ids = [], []
            for doc, text in zip(batch["doc_id"].to_pylist(), machine.encode(utf8(batch["text"]))):
                tokens = np.append(text, np.uint32(end)).astype("<u4")
                raw, at = memoryview(tokens.tobytes()), 0
                for length in cuts(len(tokens), capacity, least):
                    held = raw[4 * at : 4 * (at + length)]
                    place = placed.get(length, 0)
                    placed[length] = place + 1
                    rows.append((doc, at, length, zlib.crc32(held), len(tokens), worker, place))
                    if with_ids:
                        ids.append(tokens[at : at + length].tolist())
                    at += length
            columns = [pa.array(c, pa.int32() if i == 5 else pa.int64()) for i, c in enumerate(zip(*rows))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "place"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def layout(totals: dict[int, int], capacity: int = CAPACITY, least: int = LEAST) -> list[tuple]:
    """Where the pieces of each length go: rows ``(length, first, last, per_bin, sequence, offset)``.

    Pieces numbered first..last of a length go, ``per_bin`` to a bin, to the
    sequences from ``sequence`` on, the first one at ``offset``.
    """
    rows, sequence, rests = [], 0, []
    for length in sorted(totals, reverse=True):
        n, per_bin = totals[length], capacity // length
        full = n // per_bin
        if full:
            rows.append((length, 0, full * per_bin - 1, per_bin, sequence, 0))
            sequence += full
        left, at = n - full * per_bin, full * per_bin
        if length < least:
            rests.append((length, at, left))
            continue
        while left:  # sequences of 2^b pieces
            size = 1 << (left.bit_length() - 1)
            rows.append((length, at, at + size - 1, size, sequence, 0))
            sequence, at, left = sequence + 1, at + size, left - size
    offset = 0
    for length, at, left in rests:
        while left:
            if offset + length > capacity:
                sequence, offset = sequence + 1, 0
            take = min(left, (capacity - offset) // length)
            rows.append((length, at, at + take - 1, take, sequence, offset))
            offset, at, left = offset + take * length, at + take, left - take
    return rows


def pack(
    docs: DataFrame,
    path: str,
    end: int = 2,
    capacity: int = CAPACITY,
    least: int = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document's ids are the tokenizer's, without special tokens added, and
    then ``end``. ``capacity`` and ``least`` are powers of two. Null text is
    empty: the document is the id ``end``. Rows with equal or null ids are
    packed each. Other columns are not read; an empty table gives an empty
    result.

    The pieces are written once to the shared folder with their places, so the
    numbering does not change if a task runs again. The driver holds one count
    per class (under ``least`` plus the halvings).
    """
    if capacity & (capacity - 1) or least & (least - 1) or not 0 < least <= capacity:
        raise ValueError("capacity and least are powers of two, least <= capacity")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    small_batches(docs)
    fields = FIELDS + (", ids array<int>" if with_ids else "")
    cut = stored(rows.mapInArrow(_pieces(path, end, capacity, least, with_ids), fields), "pieces")
    counts = stored(cut.groupBy("worker", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("worker").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("worker", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = cut.join(stored(offsets, "piece-offsets"), ["worker", "length"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("place"))
    spark = docs.sparkSession
    bins = spark.createDataFrame(
        layout(totals, capacity, least),
        "at_length long, first long, last long, per_bin long, sequence long, at_offset long",
    )
    within = (F.col("length") == F.col("at_length")) & F.col("number").between(F.col("first"), F.col("last"))
    placed = numbered.join(F.broadcast(bins), within)  # a few rows per class, whatever the input
    turn = F.col("number") - F.col("first")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(turn / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("at_offset") + (turn % F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
