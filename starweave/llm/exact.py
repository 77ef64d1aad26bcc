"""Exact dedup through a minimal perfect hash over historical distinct digests.

The distinct digests of the history are dealt to segments by their first
bytes. Each segment gets a minimal perfect hash in the way of BBHash
(Limasset et al., 2017): keys try a slot of a bit array, those that collide go
on to the next, smaller array, and a key's slot is the rank of its bit. A slot
holds the full digest, the winner (the smallest id) and the number of rows
that have the digest. A lookup hashes to one slot and compares all 32 bytes;
what differs is not a member and is grouped by digest on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import SPACE_CLASS, mixed, stored

#: Bits a level has for each key that is still without a slot.
GAMMA = 2.0
#: Keys of a segment on average; a segment's arrays take about 60 bytes a key.
SEGMENT_KEYS = 20_000
SEGMENT = "segment int, n int, levels binary, level_bits array<long>, digests binary, winners binary, counts binary"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.encode(normalised(text), "UTF-8"), 256))


def _bit(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Where each key (two 64-bit words of its digest) falls in the array of a level."""
    seed = mixed(np.array([level + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
    return (mixed(keys[:, 0] ^ seed) + mixed(keys[:, 1] + seed)) % np.uint64(bits)


def _keys(digests: list[bytes] | pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def build(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays by level, and each key's slot in 0..n-1. Keys must be distinct."""
    levels: list[np.ndarray] = []
    slot = np.full(len(keys), -1, dtype=np.int64)
    left, rank = np.arange(len(keys)), 0
    while len(left):
        bits = max(64, int(GAMMA * len(left)))
        at = _bit(keys[left], len(levels), bits).astype(np.int64)
        alone = np.bincount(at, minlength=bits) == 1
        levels.append(alone)
        placed = alone[at]
        slot[left[placed]] = rank + np.cumsum(alone)[at[placed]] - 1
        rank += int(placed.sum())
        left = left[~placed]
        if len(levels) > 200:
            raise ValueError("digests of a segment are not distinct")
    return levels, slot


def slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot each key hashes to, -1 where no level has its bit (no member)."""
    out = np.full(len(keys), -1, dtype=np.int64)
    left, rank = np.arange(len(keys)), 0
    for n, bits in enumerate(levels):
        at = _bit(keys[left], n, len(bits)).astype(np.int64)
        hit = bits[at]
        out[left[hit]] = rank + np.cumsum(bits)[at[hit]] - 1
        rank += int(bits.sum())
        left = left[~hit]
    return out


def _segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys = _keys(rows["digest"])
    levels, slot = build(keys)
    order = np.argsort(slot)
    located = np.stack([rows["named"].to_numpy("<i8"), rows["winner"].to_numpy("<i8")], axis=1)
    return pd.DataFrame(
        {
            "segment": [key[0]],
            "n": [len(keys)],
            "levels": [b"".join(np.packbits(x).tobytes() for x in levels)],
            "level_bits": [[len(x) for x in levels]],
            "digests": [keys[order].tobytes()],
            "winners": [located[order].tobytes()],
            "counts": [rows["n_rows"].to_numpy("<i8")[order].tobytes()],
        }
    )


def _segment_of(column: str, segments: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(segments)).cast("int")


def build_index(history: DataFrame, segments: int) -> DataFrame:
    """One row per segment of the index over ``history (digest, winner, n_rows)`` with distinct digests."""
    rows = history.select(
        _segment_of("digest", segments).alias("segment"), "digest", "n_rows",
        F.col("winner").isNotNull().alias("named"), F.coalesce("winner", F.lit(0)).alias("winner"),
    )
    return rows.groupBy("segment").applyInPandas(_segment, SEGMENT)


def _levels(row) -> list[np.ndarray]:
    levels, at = [], 0
    for bits in row.level_bits:
        size = (int(bits) + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(row.levels[at : at + size], np.uint8), count=int(bits)).astype(bool))
        at += size
    return levels


def _lookup(key: tuple, asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame({"digest": asked["digest"], "member": False, "named": False, "winner": 0, "n_rows": 0})
    if len(index) and len(asked):
        row = next(index.itertuples())
        keys = _keys(asked["digest"])
        slot = slots(keys, _levels(row))
        held = np.frombuffer(row.digests, "<u8").reshape(-1, 4)
        hit = slot >= 0
        hit[hit] = (held[slot[hit]] == keys[hit]).all(axis=1)  # byte check
        located = np.frombuffer(row.winners, "<i8").reshape(-1, 2)[slot[hit]]
        out["member"] = hit
        out.loc[hit, "named"] = located[:, 0] == 1
        out.loc[hit, "winner"] = located[:, 1]
        out.loc[hit, "n_rows"] = np.frombuffer(row.counts, "<i8")[slot[hit]]
    return out


def lookup(digests: DataFrame, index: DataFrame, segments: int) -> DataFrame:
    """``(digest, member, winner, n_rows)`` for distinct ``digests (digest)``."""
    asked = digests.select(_segment_of("digest", segments).alias("segment"), "digest")
    found = (
        asked.groupBy("segment")
        .cogroup(index.groupBy("segment"))
        .applyInPandas(_lookup, "digest binary, member boolean, named boolean, winner long, n_rows long")
    )
    return found.select("digest", "member", F.expr("if(named, winner, null)").alias("winner"), "n_rows")


def distinct_digests(rows: DataFrame) -> DataFrame:
    """``(digest, winner, n_rows)`` of rows ``(doc_id, digest)``: the smallest id and the count, combined map-side."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count("*").alias("n_rows"))


def exact_dedup(
    docs: DataFrame,
    history: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_keys: int = SEGMENT_KEYS,
) -> DataFrame:
    """``(doc_id, digest, member, keep_id, group_size, kept)`` per row of ``docs``.

    ``history`` (same columns) holds the rows seen so far; without it, the
    batch is its own history, so every digest is a member and the winner is
    the smallest id of the batch. With it, a member's winner is the history's
    and no row of the batch that is a member stays; nonmembers are grouped by
    digest and the smallest id stays. ``group_size`` counts rows of history
    (for members) or of the batch (for nonmembers).

    Null text is the empty text. Of equal texts the smallest non-null id wins;
    a group without any id has a null ``keep_id`` and all its rows are kept,
    since none can be named. Repeated rows with one id are equal to their
    winner and count as kept; a caller that wants one row takes one. An empty
    table gives an empty result. Other columns are not read.
    """
    own = history is None
    seen = docs if own else history

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("digest"))

    batch = stored(rows(docs), "digests")
    past = stored(distinct_digests(batch if own else rows(seen)), "history")
    segments = max(1, -(-past.count() // segment_keys))
    index = stored(build_index(past, segments), "mph")
    # one lookup per distinct digest, so a text that a third of the rows share is asked once
    asked = past.select("digest") if own else batch.select("digest").distinct()
    found = stored(lookup(asked, index, segments), "lookups")
    joined = batch.join(found, "digest")
    members = joined.where("member").select(
        "doc_id", "digest", "member", F.col("winner").alias("keep_id"), F.col("n_rows").alias("group_size"),
        F.expr("doc_id <=> winner" if own else "false").alias("kept"),
    )
    if own:
        return members
    rest = joined.where("not member").select("doc_id", "digest")
    firsts = stored(distinct_digests(rest), "nonmembers")
    return members.union(
        rest.join(firsts, "digest").select(
            "doc_id", "digest", F.lit(False), "winner", "n_rows", F.expr("doc_id <=> winner")
        )
    )
