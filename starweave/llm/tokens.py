"""Token counts and ids by a tokenizer compiled into a word transducer.

White space ends every token of the vocabularies handled here, so a tokenizer
is a deterministic transducer over bytes that returns to its rest state at
white space. It is compiled as texts are read: a path from the rest state (a
word) is run once through the vocabulary's merges, which ``merges`` holds in
flat arrays (words with other letters than Latin through the tokenizers
library), and the transition on the white space that closes it is annotated
with the tokens it emits.

A chunk of a text is a map on states. Entered in the rest state or inside a
word, it emits the tokens of the words it holds whole and leaves inside its
last word; what it does with the word it is entered in depends on that word's
beginning alone. The map is therefore ``(head, count, tail)``, these maps
compose associatively, and a text's count is the prefix scan of its chunks'.
Chunks are summarised independently of each other.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import bytes_of, is_space, pieces, small_batches, utf8, words_of
from starweave.llm.merges import Merges, flat, plain_words, spread

#: Compiled paths a worker keeps (some 50 bytes each); beyond that, those of a batch last for the batch.
MOST_PATHS = 100_000
#: Longer words are compiled for a batch only.
LONGEST_PATH = 48
#: Longer words are for the library: the merges run a word in as many rounds as it has merges.
LONGEST_PLAIN = 1_000
#: Bytes of text whose words are looked up together.
BATCH_BYTES = 2_000_000
#: Characters of a chunk.
CHUNK = 65_536


@dataclass
class Words:
    """Words of a column: their bytes, each row's first word (one entry more), and paths."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    path: np.ndarray

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()


class Transducer:
    """Emitted tokens of words, compiled on first sight."""

    def __init__(self, path: str, with_ids: bool):
        self.path = path
        self.with_ids = with_ids
        self.merges = Merges(path)
        self.number = pa.array([], pa.binary())  # paths, in order of compilation
        self.kept = 0  # of these, from the first on, after the last batch
        self.sizes = np.zeros(0, dtype=np.int64)
        self.begins = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    @cached_property
    def library(self):
        """The tokenizers library, loaded for the first word that needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def _tokens(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of tokens of the words, where each word's begin, and all tokens: by the compiled merges where they do."""
        data, size = flat(words)
        usual = plain_words(data, np.cumsum(size)) & (size <= LONGEST_PLAIN) & self.merges.usable
        sizes, begins = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        ids = np.zeros(0, np.uint32)
        if usual.any():
            held = data if usual.all() else data[np.repeat(usual, size)]
            sizes[usual], ids = self.merges.run_words(held, np.cumsum(size[usual]))
        if not usual.all():
            texts = [w.decode("utf-8") for w in words.filter(pa.array(~usual)).to_pylist()]
            runs = self.library.encode_batch_fast(texts, add_special_tokens=False)
            sizes[~usual] = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
            rest = np.fromiter(chain.from_iterable(r.ids for r in runs), dtype=np.uint32, count=int(sizes[~usual].sum()))
            ids = np.concatenate([ids, rest])
        for part in (usual, ~usual):
            begins[part] = np.cumsum(sizes[part]) - sizes[part]
        begins[~usual] += int(sizes[usual].sum())
        return sizes, begins, ids

    def _forget(self) -> None:
        """Keep short paths only, at most ``MOST_PATHS``, the oldest."""
        if len(self.number) == self.kept:
            return
        stay = np.concatenate([np.arange(self.kept), self.kept + np.flatnonzero(flat(self.number[self.kept :])[1] <= LONGEST_PATH)])
        stay = stay[:MOST_PATHS]
        self.number, sizes = self.number.take(pa.array(stay)), self.sizes[stay]
        if self.with_ids:
            self.ids = self.ids[spread(self.begins[stay], sizes)]
        self.sizes, self.begins, self.kept = sizes, np.cumsum(sizes) - sizes, len(stay)

    def paths(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """Numbers of the words' paths until the next call, compiling those that are new."""
        self._forget()
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        coded = pa.concat_arrays([self.number, words]).dictionary_encode()
        self.number = coded.dictionary
        new = self.number[self.kept :]
        if len(new):
            sizes, begins, ids = self._tokens(new)
            self.sizes = np.concatenate([self.sizes, sizes])
            self.begins = np.concatenate([self.begins, begins + len(self.ids)])
            if self.with_ids:
                self.ids = np.concatenate([self.ids, ids])
        return np.asarray(coded.indices)[self.kept :]

    def words(self, column: pa.Array) -> Words:
        """Paths of all words of a binary column; each distinct word is looked up once."""
        data, offsets = bytes_of(column)
        starts, ends, first = words_of(data, offsets)
        cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(data[~is_space(data)])]
        return Words(data, starts, ends, first, self.paths(pa.Array.from_buffers(pa.binary(), len(starts), buffers)))

    def count(self, word: bytes) -> int:
        """Tokens that a word emits."""
        return int(self._tokens(pa.array([word], pa.binary()))[0][0])

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Token ids of each text of a binary column."""
        words = self.words(column)
        sizes = self.sizes[words.path]
        ends = np.cumsum(sizes)
        ids = self.ids[spread(self.begins[words.path], sizes)]
        so_far = np.concatenate([[0], ends])
        return np.split(ids, so_far[words.first[1:-1]])


@cache
def transducer(path: str, with_ids: bool = True) -> Transducer:
    """One per Python worker and vocabulary, kept between tasks."""
    return Transducer(path, with_ids)


#: State map of a chunk: ``(closed, head, count, tail)``. A chunk that holds no
#: white space is not closed and is all head.
Map = tuple[bool, bytes, int, bytes]


def state_maps(column: pa.Array, outer: list[tuple[bool, bool]], machine: Transducer) -> list[Map]:
    """What each chunk of a binary column does; ``outer``: is it its text's first, its last?

    At a text's ends the outer words are whole.
    """
    words = machine.words(column)
    emitted = np.concatenate([[0], np.cumsum(machine.sizes[words.path])])
    out: list[Map] = []
    for i, (first, last) in enumerate(outer):
        lo, hi = int(words.first[i]), int(words.first[i + 1])
        head = tail = b""
        if not (first and last):
            chunk = column[i].as_py()
            left = first or not chunk or chunk[:1].isspace()
            right = last or not chunk or chunk[-1:].isspace()
            if not left and not right and hi - lo == 1 or not chunk and not first and not last:
                out.append((False, chunk, 0, b""))
                continue
            if not left and lo < hi:
                head, lo = words.word(lo), lo + 1
            if not right and lo < hi:
                tail, hi = words.word(hi - 1), hi - 1
        out.append((True, head, int(emitted[hi] - emitted[lo]), tail))
    return out


def compose(a: Map, b: Map, machine: Transducer) -> Map:
    """``a`` and then ``b``; associative."""
    if not a[0]:
        return b[0], a[1] + b[1], b[2], b[3]
    if not b[0]:
        return True, a[1], a[2], a[3] + b[1]
    between = a[3] + b[1]
    return True, a[1], a[2] + b[2] + (machine.count(between) if between else 0), b[3]


def _summaries(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path, False)
        for batch in pieces(batches, "chunk", BATCH_BYTES):
            rows = zip(batch["part"].to_pylist(), batch["parts"].to_pylist())
            maps = state_maps(utf8(batch["chunk"]), [(part == 0, part == parts - 1) for part, parts in rows], machine)
            closed, heads, counts, tails = zip(*maps)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], batch["n_bytes"], batch["part"], pa.array(closed),
                 pa.array(heads, pa.binary()), pa.array(counts, pa.int64()), pa.array(tails, pa.binary())],
                names=["row", "doc_id", "n_bytes", "part", "closed", "head", "count", "tail"],
            )

    return run


def _scan(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path, False)
        for batch in batches:
            totals = []
            for maps in batch["maps"].to_pylist():
                steps = [(m["closed"], m["head"], m["count"], m["tail"]) for m in maps]
                *_, whole = accumulate(steps, lambda a, b: compose(a, b, machine))
                totals.append(whole[2])  # the text's ends are closed: no head or tail is left
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs``.

    ``path`` is a tokenizers file whose tokens end at white space. Counts are
    the library's own, without special tokens added; special strings inside a
    text count as the library's default takes them. Null text is empty: no
    bytes, no tokens. Rows with equal or null ids are counted each. Long texts
    are cut into chunks of ``chunk`` characters; only chunk summaries are
    shuffled. Other columns are not read; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"),
        F.greatest(F.lit(1), F.ceil(F.length(text) / chunk)).cast("int").alias("parts"),
    )
    part = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    cut = F.when(F.col("parts") == 1, F.col("text")).otherwise(
        F.substring("text", F.col("part") * chunk + 1, F.lit(chunk))
    )
    small_batches(docs)
    maps = part.select("row", "doc_id", "n_bytes", "part", "parts", cut.alias("chunk")).mapInArrow(
        _summaries(path),
        "row long, doc_id long, n_bytes long, part int, closed boolean, head binary, count long, tail binary",
    )
    texts = maps.groupBy("row", "doc_id", "n_bytes").agg(
        F.sort_array(F.collect_list(F.struct("part", "closed", "head", "count", "tail"))).alias("maps")
    )
    counted = texts.select("doc_id", "n_bytes", "maps").mapInArrow(_scan(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
