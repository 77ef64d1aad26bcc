"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint is eight bytes. Two that differ in at most four bits share at
least four of the eight positional bytes: that is the minimum the count filter
asks for. Posting lists of single positional bytes would hold a 256th of all
fingerprints each, so the index lists what three positions hold together: a
block. Blocks are chosen so that any four positions contain one (a Turan
system: split the positions in three groups and take triples within a group
and pairs of a group with one of the next). Every pair that shares four bytes
meets in a block; there its shared positional bytes are tallied, pairs under
the minimum go, and the rest are verified by their differing bits.

A posting list with more than ``LIST`` fingerprints is cut into chunks, and
pairs of chunks are compared by separate tasks. Lists of near copies link
almost all their pairs: such a group sends only a spanning forest of its
links, which connects the same documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import pieces, small_batches, stored, utf8
from starweave.llm.components import connected_components

#: Shingles whose bits are counted at a time.
BLOCK = 16_384
#: Fingerprints of a posting list that one task compares with each other.
LIST = 2_048
#: Groups up to this size send their links, larger ones a spanning forest of them.
SMALL = 16


def fingerprint(text: bytes, shingle: int, hash64) -> int:
    """SimHash of a text: a bit is 1 if more than half of the shingles' hashes have it."""
    words = text.lower().split()  # of bytes: A-Z, and the six white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    stops = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(stops), BLOCK):
        spans = zip(starts[at : at + BLOCK], stops[at : at + BLOCK])
        hashes = np.array([hash64(joined[s:e], 42) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in pieces(batches, "text"):
            prints = [fingerprint(t, shingle, xxh64_intdigest) for t in utf8(batch["text"]).to_pylist()]
            column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` with its last column, ``text``, replaced by ``fp`` (the fingerprint as a signed long)."""
    small_batches(rows)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["fp long"])
    return rows.mapInArrow(_fingerprints(shingle), schema)


def blocks(positions: int = 8) -> list[tuple[int, int, int]]:
    """Triples of positions such that any four positions contain one."""
    groups = [tuple(range(g, positions, 3)) for g in range(3)]
    out = [t for g in groups for t in combinations(g, 3)]
    for g, after in zip(groups, groups[1:] + groups[:1]):
        out += [tuple(sorted((*pair, one))) for pair in combinations(g, 2) for one in after]
    return out


def linked(x: np.ndarray, y: np.ndarray, least: int, most_bits: int) -> np.ndarray:
    """Count filter, then verification, of fingerprint pairs (broadcast against each other)."""
    apart = x ^ y
    shared = (apart[..., None].view(np.uint8) == 0).sum(axis=-1)
    return (shared >= least) & (np.bitwise_count(apart) <= most_bits)


def _spanning(prints: np.ndarray, least: int, most_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A forest with the components of a group's links: each fingerprint is reached once."""
    away = np.ones(len(prints), dtype=bool)
    for seed in range(len(prints)):
        queue = [seed] if away[seed] else []
        away[seed] = False
        while queue:
            at, rest = queue.pop(), np.flatnonzero(away)
            near = rest[linked(prints[rest], prints[at], least, most_bits)]
            away[near] = False
            queue += near.tolist()
            yield np.full(len(near), prints[at]), prints[near]


def _links(least: int, most_bits: int):
    """Links of consecutive rows ``(list, fp)`` that share a list; a list may run over batches."""

    def of(lists: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.diff(lists, prepend=lists[:1] - 1))
        sizes = np.diff(np.append(starts, len(lists)))
        found = []
        small = np.repeat(sizes <= SMALL, sizes)
        few_lists, few = lists[small], prints[small]
        for step in range(1, SMALL):
            same = np.flatnonzero(few_lists[step:] == few_lists[:-step]) if len(few) > step else few[:0]
            if not len(same):
                break
            x, y = few[same], few[same + step]
            hit = linked(x, y, least, most_bits)
            found.append((x[hit], y[hit]))
        for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            found += _spanning(prints[start : start + size], least, most_bits)
        a, b = (np.concatenate([f[i] for f in found]) if found else prints[:0] for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            lists = np.concatenate([lists, np.asarray(batch["list"])])
            prints = np.concatenate([prints, np.asarray(batch["fp"]).view(np.uint64)])
            if len(lists):
                cut = int(np.searchsorted(-(lists != lists[-1]).astype(int), 0))  # the last list may go on
                if cut:
                    yield of(lists[:cut], prints[:cut])
                lists, prints = lists[cut:], prints[cut:]
        if len(lists):
            yield of(lists, prints)

    return run


def link_edges(prints: DataFrame, most_bits: int) -> DataFrame:
    """Edges ``(a, b)`` between distinct ``prints (fp)`` with the components of all links."""
    least = 8 - most_bits
    if not 0 <= most_bits <= 4:
        raise ValueError("the index guarantees four shared bytes: at most 4 bits")
    masks = [sum(0xFF << (8 * p) for p in block) for block in blocks()]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    # a list's key: its block and the bytes there, hashed; another list with the same hash only adds candidates
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    postings = prints.select("fp", F.explode(keys).alias("list"))
    # lists of one fingerprint have no pairs; long ones are dealt out as pairs of chunks
    sizes = postings.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    long = stored(sizes.where(F.col("n") > LIST), "simhash-long")
    rows = postings.join(long, "list", "left")
    chunks = F.coalesce(F.ceil(F.col("n") / LIST), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks")).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pair = F.when(F.col("chunks") == 1, F.col("list")).otherwise(
        F.xxhash64("list", F.least("own", "other"), F.greatest("own", "other"))
    )
    dealt = rows.select(pair.alias("list"), "fp").repartition("list").sortWithinPartitions("list", "fp")
    return dealt.mapInArrow(_links(least, most_bits), "a long, b long")


def simhash_dedup(
    docs: DataFrame,
    shingle: int = 4,
    most_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, *keep, fingerprint, component_id, group_fp)`` per row of ``docs``.

    Texts are lower-cased in A-Z and cut at the six ASCII white-space bytes;
    shingles are of ``shingle`` words, repeats counted; a text with fewer words
    is one shingle. Null and wordless texts have fingerprint zero and link like
    any other. ``component_id`` is the smallest non-null id that links of at
    most ``most_bits`` bits reach, null if all ids there are; ``group_fp`` is a
    fingerprint that names the group. Repeated rows and ids get a row each. Columns of ``docs`` other than ``keep`` are not read;
    an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.col(text_col).alias("text"))
    found = stored(fingerprints(rows, shingle), "simhash-prints")
    firsts = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    parts = connected_components(link_edges(firsts.select("fp"), most_bits), "simhash-links")
    named = firsts.join(parts, F.col("fp") == F.col("node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(named.join(least, "component").select("fp", "component", "component_id"), "simhash-components")
    alone = F.col("component").isNull()
    known = firsts.join(named, "fp", "left").select(
        "fp", F.when(alone, F.col("first")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("component", "fp").alias("group_fp"),
    )
    known = stored(known, "simhash-classes")
    return found.join(known, "fp").select(
        "doc_id", *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_fp"
    )
