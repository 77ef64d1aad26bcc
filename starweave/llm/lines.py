"""Line dedup: documents probe a sharded minimal perfect hash over distinct line hashes.

A line counts by its key: stripped at both ends, A-Z in lower case, hashed to
128 bits. Five passes, none of which joins lines with lines or sends a line's
text anywhere:

1. Each batch of texts is cut into lines once. What is stored is the batch's
   distinct hashes, in how many of its documents each occurs, and for every
   line the number of its hash in the batch.
2. Counts are summed by hash, map-side first, so a line that a third of all
   documents have costs a task one row.
3. The distinct hashes are dealt to shards. Each shard gets a minimal perfect
   hash; a slot of its arrays holds a fingerprint (the half of the hash that
   does not choose the shard) and the count in as few bytes as the shard's
   largest count needs.
4. Batches probe the arrays: a batch sends its distinct hashes to groups of
   shards and gets back the places of those found often enough. A group that
   is asked very often (it holds a line that many batches have) is copied, and
   batches are dealt to its copies.
5. The answers become line numbers per document, and documents drop them. The
   texts are shuffled this once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import pieces, stored, utf8
from starweave.llm.exact import build, slots

#: White space stripped off a line.
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text of a batch.
BATCH_BYTES = 4_000_000
#: Distinct hashes of a shard on average, and shards that one task holds together.
SHARD_KEYS, GROUP_SHARDS = 20_000, 64
#: Hashes that one task looks up in a group of shards, on average at most.
ASKS = 1_000_000
SPLIT = "batch long, keys binary, counts binary, k1 binary, k2 binary, ends binary, codes binary"
INDEX = "shard int, asks long, levels binary, level_bits array<long>, prints binary, counts binary, width int"


def lines_of(text: bytes) -> Iterator[bytes]:
    """The lines of a text, each but the last with its line feed."""
    yield from BytesIO(text)
    if not text or text.endswith(b"\n"):
        yield b""


def _split(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        part = TaskContext.get().partitionId() << 33
        for number, batch in enumerate(pieces(batches, "text", BATCH_BYTES)):
            seen: dict[bytes, int] = {}
            codes, ends = array("i"), []
            for text in utf8(batch["text"]).to_pylist():
                for line in lines_of(text):
                    key = line.strip(SPACES).lower()
                    if len(key) >= least_chars and (least_chars < 2 or len(key.decode("utf-8", "replace")) >= least_chars):
                        codes.append(seen.setdefault(xxh3_128_digest(key), len(seen)))
                    else:
                        codes.append(-1)
                ends.append(len(codes))
            code, end = np.array(codes, dtype=np.int64), np.array(ends, dtype=np.int32)
            doc = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
            once = np.unique((doc * len(seen) + code)[code >= 0])  # a key counts once per document
            counts = np.bincount(once % max(1, len(seen)), minlength=len(seen)).astype(np.int32)
            row = [part + number, b"".join(seen), counts.tobytes(),
                   *(np.asarray(batch[k]).tobytes() for k in ("k1", "k2")),
                   end.tobytes(), codes.tobytes()]
            names = [x.split()[0] for x in SPLIT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)

    return run


def _hashes(keys: bytes) -> np.ndarray:
    """Two signed 64-bit halves of each hash."""
    return np.frombuffer(keys, dtype="<i8").reshape(-1, 2)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts in zip(batch["keys"], batch["counts"]):
            both = _hashes(keys.as_py())
            n = np.frombuffer(counts.as_py(), dtype=np.int32).astype(np.int64)
            columns = [pa.array(np.ascontiguousarray(c)) for c in (both[:, 0], both[:, 1], n)]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "n"])


def _shard(key: tuple, rows: pa.Table) -> pa.Table:
    h1, h2, n, asks = (np.asarray(rows[c]) for c in ("h1", "h2", "n", "asks"))
    levels, slot = build(np.stack([h1, h2], axis=1).view(np.uint64))
    order = np.argsort(slot)
    width = next(w for w in (1, 2, 4, 8) if int(n.max()) < 1 << 8 * w)
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "asks": pa.array([int(asks.sum())], pa.int64()),
            "levels": [b"".join(np.packbits(x).tobytes() for x in levels)],
            "level_bits": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
            "prints": [h2[order].tobytes()],
            "counts": [n[order].astype(f"<u{width}").tobytes()],
            "width": pa.array([width], pa.int32()),
        }
    )


def build_index(counted: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the index over ``counted (h1, h2, n, asks)`` with distinct ``(h1, h2)``."""
    rows = counted.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), "h1", "h2", "n", "asks")
    return rows.groupBy("shard").applyInArrow(_shard, INDEX)


def _asked(shards: int):
    """Each batch's hashes by group of shards: ``(grp, batch, at, keys)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, keys in zip(batch["batch"], batch["keys"]):
                both = _hashes(keys.as_py())
                group = (both[:, 0] % shards) // GROUP_SHARDS
                order = np.argsort(group, kind="stable")
                cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
                ranges = list(zip(cuts, np.append(cuts[1:], len(order))))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group[order][cuts], pa.int64()),
                        pa.array([number.as_py()] * len(cuts), pa.int64()),
                        pa.array([order[a:b].astype(np.int32).tobytes() for a, b in ranges], pa.binary()),
                        pa.array([both[order[a:b]].tobytes() for a, b in ranges], pa.binary()),
                    ],
                    names=["grp", "batch", "at", "keys"],
                )

    return run


def _levels(row: dict) -> list[np.ndarray]:
    out, at = [], 0
    for bits in row["level_bits"]:
        size = (bits + 7) // 8
        out.append(np.unpackbits(np.frombuffer(row["levels"], np.uint8, size, at), count=bits).astype(bool))
        at += size
    return out


def _probe(least_docs: int, shards: int):
    def run(key: tuple, asks: pa.Table, index: pa.Table) -> pa.Table:
        sent = [_hashes(k.as_py()) for k in asks["keys"]]
        both = np.concatenate([np.zeros((0, 2), np.int64), *sent])
        shard = both[:, 0] % shards
        order = np.argsort(shard, kind="stable")
        often = np.zeros(len(both), dtype=bool)
        for i in range(index.num_rows):
            row = {c: index[c][i].as_py() for c in ("shard", "levels", "level_bits", "prints", "counts", "width")}
            a, b = np.searchsorted(shard[order], [row["shard"], row["shard"] + 1])
            mine = order[a:b]
            slot = slots(both[mine].view(np.uint64), _levels(row))
            found = slot >= 0
            mine, slot = mine[found], slot[found]
            same = np.frombuffer(row["prints"], "<i8")[slot] == both[mine, 1]
            often[mine] = same & (np.frombuffer(row["counts"], f"<u{row['width']}")[slot] >= least_docs)
        ends = np.cumsum([len(x) for x in sent], dtype=np.int64)
        batch, at = [], []
        for number, places, end in zip(asks["batch"], asks["at"], ends):
            places = np.frombuffer(places.as_py(), dtype=np.int32)
            hit = places[often[end - len(places) : end]]
            if len(hit):
                batch.append(number.as_py())
                at.append(hit.tobytes())
        return pa.table({"batch": pa.array(batch, pa.int64()), "at": pa.array(at, pa.binary())})

    return run


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(k1, k2, gone)``: line numbers to drop, of each document that has any."""
    for rows in batches:
        for row in rows.to_pylist():
            k1, k2 = (np.frombuffer(row[k], "<i8") for k in ("k1", "k2"))
            ends, codes = (np.frombuffer(row[k], np.int32) for k in ("ends", "codes"))
            often = np.zeros(len(row["keys"]) // 16 + 1, dtype=bool)  # the last one stands for code -1
            for at in row["at"]:
                often[np.frombuffer(at, np.int32)] = True
            gone = np.flatnonzero(often[codes])
            doc = np.searchsorted(ends, gone, side="right")
            has = np.unique(doc)
            start = np.append(0, ends[:-1])
            cuts = np.searchsorted(doc, np.append(has, len(ends)))
            lines = [(gone[a:b] - start[d]).astype(np.int32).tobytes() for d, a, b in zip(has, cuts, cuts[1:])]
            columns = [pa.array(k1[has]), pa.array(k2[has]), pa.array(lines, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "gone"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", BATCH_BYTES):
        n_lines, n_dropped, kept = [], [], []
        for text, gone in zip(utf8(batch["text"]).to_pylist(), batch["gone"].to_pylist()):
            n_lines.append(text.count(b"\n") + 1)
            n_dropped.append(len(gone) // 4 if gone else 0)
            if gone:
                left = np.ones(n_lines[-1], dtype=bool)
                left[np.frombuffer(gone, np.int32)] = False
                text = b"\n".join(line.removesuffix(b"\n") for line, keep in zip(lines_of(text), left) if keep)
            kept.append(text)
        columns = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "n_lines", "n_dropped", "kept"])


def line_dedup(
    docs: DataFrame, least_docs: int = 10, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept)`` per row: ``kept`` is the text without frequent lines, in UTF-8.

    A line ends at ``\\n``. Its key is the line without white space
    (``[\\x20\\x09-\\x0D]``) at its ends, A-Z in lower case. Lines whose key has
    at least ``least_chars`` code points and occurs in at least ``least_docs``
    documents go, in every document; the others stay as they are, joined by
    ``\\n``. No line of a frequent key is kept, so there are no ties.

    Null and empty texts are one empty line. Every row is a document: rows
    that repeat an id or a whole row count each (null ids too), and get equal
    results. A text is cut by one task, line by line; its line numbers take
    four bytes a line. An empty table gives an empty table. Other columns are
    not read.
    """
    # identical rows have equal keys and equal results; two hashes make 128 bits
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    ident: list[Column] = [F.xxhash64(docs[id_col], text).alias("k1"), F.xxhash64(text, docs[id_col], F.lit(1)).alias("k2")]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), *ident)

    split = stored(rows.select("text", "k1", "k2").mapInArrow(_split(least_chars), SPLIT), "lines")
    each = split.select("keys", "counts").mapInArrow(_counted, "h1 long, h2 long, n long")
    counted = stored(each.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.count("*").alias("asks")), "line-counts")
    shards = max(1, -(-counted.count() // SHARD_KEYS))
    index = stored(build_index(counted, shards), "line-index")
    index = index.withColumn("grp", F.expr(f"cast(shard div {GROUP_SHARDS} as long)"))

    # a group asked more than ASKS times is copied
    copies = index.groupBy("grp").agg(F.expr(f"greatest(1, cast(ceil(sum(asks) / {ASKS}) as int))").alias("copies"))
    asks = split.select("batch", "keys").mapInArrow(_asked(shards), "grp long, batch long, at binary, keys binary")
    asks = asks.join(copies, "grp").withColumn("copy", F.expr("cast(pmod(xxhash64(batch), copies) as int)"))
    index = index.join(copies, "grp").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    answers = (
        asks.select("grp", "copy", "batch", "at", "keys")
        .groupBy("grp", "copy")
        .cogroup(index.drop("copies", "asks").groupBy("grp", "copy"))
        .applyInArrow(_probe(least_docs, shards), "batch long, at binary")
    )
    answers = answers.groupBy("batch").agg(F.collect_list("at").alias("at"))  # at most a batch's distinct lines
    gone = split.join(answers, "batch").select("k1", "k2", "ends", "codes", "keys", "at")
    gone = gone.mapInArrow(_dropped, "k1 long, k2 long, gone binary")
    gone = stored(gone.groupBy("k1", "k2").agg(F.max("gone").alias("gone")), "lines-gone")
    # each row's text and the numbers of its lines that go
    found = rows.join(gone, ["k1", "k2"], "left").select("doc_id", "text", "gone")
    return found.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, kept binary")
