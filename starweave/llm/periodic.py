"""Periodic run detection by internal pattern matching.

A run with smallest period ``q`` and at least two periods holds, near its
start, an aligned block of a dyadic length ``B`` with ``2B <= q < 4B`` (of one
word for ``q < 4``) that occurs again ``q`` words on. So for every level each
aligned block is looked for in its neighbouring window, ``[b + 2B, b + 4B)``:

* suffix array: prefix doubling ranks the words' suffixes; a block's
  occurrences are a range of the array, since a rank is where its range starts;
* wavelet tree over the array: the range's smallest position not below ``x``
  (range successor) gives the next occurrence in about ``log n`` steps;
* progressions: occurrences that overlap by half are evenly spaced, by the
  block's own period, as far as that periodic stretch goes. A whole
  progression is skipped with one extension. Its terms that can be a period
  of a run are those aligned with an end of the block's own stretch and some
  first ones, found by arithmetic.

Each candidate period is checked by extending both ways (binary lifting over
the ranks). An interval found with several periods keeps the smallest.

The words of a document are numbered apart from those of others, so a batch
of documents is one sequence and no match leaves its document.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import pieces, utf8

#: Bytes of text searched together.
BATCH_BYTES = 2_000_000
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Ranks:
    """Ranks of all blocks of dyadic length, and extensions by binary lifting."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.n, self.levels, self.sizes = n, [], []
        _, number, counts = np.unique(symbols, return_inverse=True, return_counts=True)
        rank = (np.cumsum(counts) - counts)[number].astype(np.int32)  # how many suffixes are smaller
        size = counts[number].astype(np.int32)
        step = 1
        while True:
            self.levels.append(rank)
            self.sizes.append(size)
            left = np.flatnonzero(size > 1)
            if not len(left):
                break
            behind = left + step
            after = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
            key = rank[left].astype(np.int64) * (n + 1) + after + 1
            order = np.argsort(key, kind="stable")
            left, key = left[order], key[order]
            old = rank[left]
            at = np.arange(len(left))
            new_key = np.diff(key, prepend=-1) != 0
            new_old = np.diff(old, prepend=-1) != 0
            first_key = np.maximum.accumulate(np.where(new_key, at, 0))
            first_old = np.maximum.accumulate(np.where(new_old, at, 0))
            cuts = np.flatnonzero(new_key)
            rank, size = rank.copy(), size.copy()
            rank[left] = old + first_key - first_old
            size[left] = np.repeat(np.diff(np.append(cuts, len(left))), np.diff(np.append(cuts, len(left))))
            step *= 2

    def suffixes(self) -> np.ndarray:
        out = np.empty(self.n, dtype=np.int64)
        out[self.levels[-1]] = np.arange(self.n)
        return out

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the sequence has in common from ``i`` and from ``j > i`` on."""
        out = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            rank, far = self.levels[level], j + out
            same = (far < self.n) & (rank[np.minimum(i + out, self.n - 1)] == rank[np.minimum(far, self.n - 1)])
            out += same.astype(np.int64) << level
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words in common up to and with ``i`` and ``j > i``, backwards; ``i`` may be -1."""
        out = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            rank, near, far = self.levels[level], i - out - (1 << level) + 1, j - out - (1 << level) + 1
            same = (near >= 0) & (rank[np.maximum(near, 0)] == rank[np.maximum(far, 0)])
            out += same.astype(np.int64) << level
        return out


class WaveletTree:
    """Range successor over an array of positions, for many queries together."""

    def __init__(self, values: np.ndarray, limit: int):
        self.bits = max(1, int(limit).bit_length())
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            high = (values >> bit & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(high)]).astype(np.int32))
            self.zeros.append(len(values) - int(high.sum()))
            values = np.concatenate([values[~high], values[high]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of ``[lo, hi)`` not below ``x``; -1 where there is none."""
        out = np.full(len(lo), -1, dtype=np.int64)
        able = np.flatnonzero((x < 1 << self.bits) & (lo < hi))
        a, b, want = lo[able].astype(np.int64), hi[able].astype(np.int64), x[able]
        below = np.zeros(len(able), dtype=np.int64)  # values under x
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            a1, b1 = ones[a], ones[b]
            high = (want >> bit & 1).astype(bool)
            below += np.where(high, (b - b1) - (a - a1), 0)
            a, b = np.where(high, zeros + a1, a - a1), np.where(high, zeros + b1, b - b1)
        there = below < hi[able] - lo[able]
        able, nth = able[there], below[there]
        a, b = lo[able].astype(np.int64), hi[able].astype(np.int64)
        value = np.zeros(len(able), dtype=np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            a1, b1 = ones[a], ones[b]
            low = (b - b1) - (a - a1)
            high = nth >= low
            nth = np.where(high, nth - low, nth)
            value += high.astype(np.int64) << bit
            a, b = np.where(high, zeros + a1, a - a1), np.where(high, zeros + b1, b - b1)
        out[able] = value
        return out


def _terms(ranks: Ranks, b, p, gap, last, end):
    """Terms of progressions ``p, p + gap, .. last`` that can be a period of a run from block ``b`` on.

    The block lies in the stretch ``[left, right)`` of period ``gap``, the
    progression in ``[left2, right2)``. Where the stretches are one, the
    smallest period is ``gap``. Else a term extends to the nearer ends of both
    unless it is aligned with one of them; what it extends beyond its own
    distance never grows along the progression, so those that can do are the
    first ones, up to a bound.
    """
    left, left2 = (a - ranks.backward(a - 1, a + gap - 1) for a in (b, p))
    right, right2 = (a + gap + ranks.forward(a, a + gap) for a in (b, p))
    apart = np.flatnonzero(left != left2)
    b, p, gap, last, end, left, left2, right, right2 = (
        a[apart] for a in (b, p, gap, last, end, left, left2, right, right2)
    )
    most = np.minimum(last, end - 1)
    bound = np.minimum(np.minimum(right - left + b, (b - left + right2 + b) // 2), right2 - left2 + b)
    bound = np.where(right - left2 >= 0, np.minimum(bound, most), -1)
    many = np.maximum(0, (bound - p) // gap + 1)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    blocks, places = [np.repeat(b, many)], [np.repeat(p, many) + nth * np.repeat(gap, many)]
    for aligned in (left2 + b - left, right2 - right + b):
        fits = (aligned >= p) & (aligned <= most) & ((aligned - p) % gap == 0)
        blocks.append(b[fits])
        places.append(aligned[fits])
    return np.concatenate(blocks), np.concatenate(places)


def candidates(ranks: Ranks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(block, place)``: aligned blocks and later occurrences whose distance may be a run's period."""
    suffixes = ranks.suffixes()
    often = ranks.sizes[0][suffixes] > 1  # words that occur once have no place in the tree
    before = np.concatenate([[0], np.cumsum(often)])
    tree = WaveletTree(suffixes[often], ranks.n)
    for level, (rank, size) in enumerate(zip(ranks.levels, ranks.sizes)):
        length = 1 << level
        b = np.arange(0, ranks.n, length)
        b = b[size[b] > 1]
        if not len(b):
            continue
        lo, hi = before[rank[b]], before[rank[b] + size[b]]
        x, end = b + (2 * length if level else 1), b + 4 * length
        p = tree.successor(lo, hi, x)
        while True:
            live = (p >= 0) & (p < end)
            b, lo, hi, end, p = (a[live] for a in (b, lo, hi, end, p))
            if not len(b):
                break
            after = tree.successor(lo, hi, p + 1)
            gap = after - p
            even = (after >= 0) & (2 * gap <= length)
            yield b[~even], p[~even]
            if even.any():
                at, first, by = b[even], p[even], gap[even]
                last = first + (by + ranks.forward(first, first + by) - length) // by * by
                yield _terms(ranks, at, first, by, last, end[even])
                after[even] = tree.successor(lo[even], hi[even], last + 1)
            p = after


def runs_of(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of the runs of a sequence, by start, then period."""
    none = np.zeros(0, dtype=np.int64)
    if not len(symbols):
        return none, none, none
    ranks = Ranks(symbols)
    found = []
    for b, p in candidates(ranks):
        d = p - b
        start, end = b - ranks.backward(b - 1, p - 1), p + ranks.forward(b, p)
        fits = end - start >= np.maximum(least, 2 * d)
        found.append(np.stack([start[fits], end[fits], d[fits]]))
    start, end, period = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # one interval has one smallest period
    new = (np.diff(start, prepend=-1) != 0) | (np.diff(end, prepend=-1) != 0)
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def laid(words: list[bytes], ident: str) -> list[bytes]:
    """The words with a run laid into the tail of every tenth document, by the crc32 of its id."""
    h = crc32(ident.encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + (words[at : at + period] * -(-(n - at) // period))[: n - at]


def _search(least: int, lay: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            texts, base, symbols = [], 0, []
            for ident, text in zip(batch["ident"].to_pylist(), utf8(batch["text"]).to_pylist()):
                words = text.split()  # of bytes: at the six white-space bytes
                if lay:
                    words = laid(words, ident)
                own: dict[bytes, int] = {}
                symbols.append(np.array([own.setdefault(w, len(own)) for w in words], dtype=np.int64) + base)
                base += len(own)
                texts.append(words)
            first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
            start, end, period = runs_of(np.concatenate(symbols), least)
            doc = np.searchsorted(first, start, side="right") - 1
            # words behind a run's first period go
            gone = np.zeros(int(first[-1]) + 1, dtype=np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, end, -1)
            kept = np.cumsum(gone[:-1]) == 0
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(
                pa.array(cuts),
                pa.StructArray.from_arrays(
                    [pa.array(start - first[doc]), pa.array(end - start), pa.array(period)],
                    fields=list(RUNS.value_type),
                ),
            )
            left = [
                b" ".join(words if kept[a:b].all() else [w for w, k in zip(words, kept[a:b].tolist()) if k])
                for words, a, b in zip(texts, first, first[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], runs, pa.array(left, pa.binary())], names=["doc_id", "runs", "collapsed"]
            )

    return run


def periodic_runs(
    docs: DataFrame, least: int = 12, lay: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, runs, collapsed)`` per row.

    ``runs`` are the maximal stretches of consecutive words
    (``[^\\x20\\x09-\\x0D]+``) with smallest period ``q`` that are at least
    ``least`` words and two periods long: ``(start, length, period)`` by start,
    then period, words numbered from 0. ``collapsed`` is the text, in UTF-8,
    without the words that some run has behind its first period, words joined
    by one space. With ``lay`` every tenth document (by crc32 of its id) has a
    run laid into its tail first (known runs, for trials).

    Null and empty texts have no runs and an empty ``collapsed``. A null id is
    written as nothing for ``lay``. Rows are searched on their own, so repeated
    rows have equal results, and there are no ties: an interval has one
    smallest period. A very long text is one task's work, in memory of about
    50 bytes a word and 8 more for each doubling of its longest repeat; time
    grows with ``n log n`` whatever repeats. An empty table gives an empty
    table. Other columns are not read.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("ident"),
        docs[text_col].cast("string").alias("text"),
    )
    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(_search(least, lay), schema)
