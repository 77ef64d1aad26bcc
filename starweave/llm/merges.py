"""A BPE vocabulary compiled into flat arrays, run on many words together.

The merges become a hash table of symbol pairs (two arrays of fixed size,
bounded by the vocabulary and not by the words that a corpus has). All words
of a batch are rewritten side by side: in each round every word replaces the
leftmost pair of its lowest rank, until no pair of it is in the table. That is
the order in which the tokenizers library merges.

Only what this module knows exactly is taken: words of printable ASCII and of
the letters U+00C0 to U+017E, where normal form, lower case and the classes of
the splitting pattern are plain. Other words are for the library.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa

from starweave.llm.common import bytes_of

#: Strings of special tokens start with it.
SPECIAL = "<|"
#: Kinds of bytes to the vocabulary's splitting pattern, in lower case; letters beyond ASCII have bytes from 128 on.
LETTER, DIGIT, OTHER = 0, 1, 2
KIND = np.full(256, OTHER, dtype=np.uint8)
KIND[ord("a") : ord("z") + 1] = KIND[128:] = LETTER
KIND[ord("0") : ord("9") + 1] = DIGIT
LOWER = np.array([b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b for b in range(256)], dtype=np.uint8)
#: Letters of two bytes that are taken, and their lower case, by code point.
TAKEN = np.zeros(0x180, dtype=bool)
TAKEN[0xC0:0x17F] = True
TAKEN[[0xD7, 0xF7, 0x130, 0x149]] = False
SMALL = np.array([ord(chr(c).lower()) if TAKEN[c] else c for c in range(0x180)], dtype=np.int64)
#: The splitting pattern and normalisation this module stands for.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMAL = ["NFC", "Replace", "Lowercase"]
#: Slots of the pair table; a power of two.
SLOTS = 1 << 19
#: Rank of a pair that never merges.
NONE = np.int64(1 << 30)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 0
    for byte in range(256):
        if byte in prints:
            out.append(chr(byte))
        else:
            out.append(chr(0x100 + extra))
            extra += 1
    return out


class Merges:
    """The compiled tables of a tokenizers file; ``usable`` says if the file is of the kind known here."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.usable = self._known(spec)
        if not self.usable:
            return
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], dtype=np.int64)
        self.last = np.array([vocab.get(c + end, -1) for c in letters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self._build(left << 20 | right)
        self.first = self.rank(np.repeat(self.inner, 256), np.tile(self.inner, 256)).reshape(256, 256)
        self.final = self.rank(np.repeat(self.inner, 256), np.tile(self.last, 256)).reshape(256, 256)

    @staticmethod
    def _known(spec: dict) -> bool:
        model, normal, split = spec["model"], spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        parts = [n["type"] for n in normal.get("normalizers", [])]
        first = (split.get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        marked = all(t["content"].startswith(SPECIAL) for t in spec.get("added_tokens", []))
        return model["type"] == "BPE" and bool(model.get("end_of_word_suffix")) and parts == NORMAL and first == SPLIT and plain and marked

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)).astype(np.int64)  # 19 bits

    def _build(self, keys: np.ndarray) -> None:
        """Open addressing: a key lies in the first free slot from its own on; lower ranks come first."""
        self.keys = np.full(SLOTS, -1, dtype=np.int64)
        self.ranks = np.full(SLOTS, -1, dtype=np.int64)
        _, first = np.unique(keys, return_index=True)
        left = np.sort(first)
        at = self._slot(keys[left])
        while len(left):
            free = self.keys[at] == -1
            _, one = np.unique(at[free], return_index=True)
            chosen = np.flatnonzero(free)[one]
            self.keys[at[chosen]], self.ranks[at[chosen]] = keys[left[chosen]], left[chosen]
            rest = np.ones(len(left), dtype=bool)
            rest[chosen] = False
            left, at = left[rest], (at[rest] + 1) % SLOTS

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it never merges."""
        key = left << 20 | right
        at = self._slot(key)
        held = self.keys[at]
        out = np.where(held == key, self.ranks[at], NONE)
        open_ = np.flatnonzero((held != key) & (held != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) % SLOTS
            held = self.keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    def run(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sizes, ids)`` of pieces (of ``size`` bytes, not empty, one after the other)."""
        sizes, ends = np.zeros(len(size), dtype=np.int64), np.cumsum(size)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        rank = np.full(len(data), NONE, dtype=np.int64)  # of the pair that starts here
        rank[:-1] = self.first[data[:-1], data[1:]]
        rank[ends - 1] = NONE
        long = ends[size > 1] - 2
        rank[long] = self.final[data[long], data[long + 1]]
        live, counts, place = np.arange(len(size)), size.astype(np.int64), np.arange(len(data))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # pieces, their sizes, symbols
        while len(live):
            starts = np.cumsum(counts) - counts
            best = np.minimum.reduceat(rank << 32 | place[: len(rank)], starts)
            merging = best >> 32 < NONE
            keep = np.repeat(merging, counts)
            if not merging.all():
                done.append((live[~merging], counts[~merging], symbol[~keep]))
                live, counts, best, starts = live[merging], counts[merging], best[merging], starts[merging]
            at = best & 0xFFFFFFFF
            symbol[at] = self.merged[best >> 32]
            keep[at + 1] = False
            symbol, rank = symbol[keep], rank[keep]
            counts = counts - 1
            begin = np.cumsum(counts) - counts
            at = at - starts + begin
            rank[at] = NONE
            pair = np.concatenate([at[at + 1 < begin + counts], at[at > begin] - 1])
            rank[pair] = self.rank(symbol[pair], symbol[pair + 1])
        for pieces, held, _ in done:
            sizes[pieces] = held
        begins = np.cumsum(sizes) - sizes
        ids = np.zeros(int(sizes.sum()), dtype=np.uint32)
        for pieces, held, symbols in done:
            ids[spread(begins[pieces], held)] = symbols
        return sizes, ids

    def run_words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sizes, ids)`` of plain words, given by their bytes and ends; each distinct piece is run once."""
        if not len(ends):
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        low = lowered(data)
        cut = cuts(low, ends)
        at = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(np.append(at, len(low)).astype(np.int32)), pa.py_buffer(low)]
        coded = pa.Array.from_buffers(pa.binary(), len(at), buffers).dictionary_encode()
        sizes, ids = self.run(*flat(coded.dictionary))
        path = np.asarray(coded.indices)
        each = sizes[path]
        out = ids[spread((np.cumsum(sizes) - sizes)[path], each)]
        word = np.searchsorted(ends, at, side="right")
        return np.bincount(word, weights=each, minlength=len(ends)).astype(np.int64), out

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(sizes, ids)`` of plain words."""
        data, size = flat(pa.array([w.encode() for w in words], pa.binary()))
        return self.run_words(data, np.cumsum(size))


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``begins[k], begins[k] + 1, ...``, ``sizes[k]`` of them, for each k."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and their number by row."""
    data, at = bytes_of(column)
    return data, np.diff(at)


def _pairs(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of first bytes of the letters of two bytes that are taken."""
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    inside = np.ones(len(data) + 1, dtype=bool)
    inside[ends] = False
    lead = lead[inside[lead + 1] & (data[lead + 1] >> 6 == 2)]
    return lead[TAKEN[_points(data, lead)]]


def _points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    return (data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F


def lowered(data: np.ndarray) -> np.ndarray:
    """Plain words in lower case."""
    low = LOWER[data]
    lead = np.flatnonzero(data >= 0xC3)
    points = SMALL[_points(data, lead)]
    low[lead], low[lead + 1] = 0xC0 | points >> 6, 0x80 | points & 0x3F
    return low


def cuts(low: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a piece of the splitting pattern starts at each byte of plain words in lower case."""
    kind = KIND[low]
    cut = kind == DIGIT
    cut[1:] |= kind[1:] != kind[:-1]
    begins = np.append(0, ends[:-1])
    cut[begins] = True
    quote = np.flatnonzero(low == ord("'"))
    if len(quote):
        word = np.searchsorted(ends, quote, side="right")
        after = (quote == begins[word]) | (kind[quote - 1] != OTHER)  # else the run before takes it
        quote, stop = quote[after], ends[word[after]]
        padded = np.append(low, np.zeros(2, np.uint8))
        one = np.where(quote + 1 < stop, padded[quote + 1], 0)
        two = np.where(quote + 2 < stop, padded[quote + 2], 0)
        short = np.isin(one, list(b"stmd"))
        long = np.isin(one, list(b"rv")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        cut[quote[short | long] + 1] = False
        rest = np.concatenate([quote[short] + 2, quote[long] + 3])
        cut[rest[rest < len(low)]] = True
    return cut


def plain_words(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word (given by all bytes and their ends) is made of letters the merges are compiled for."""
    out = np.diff(ends, prepend=0) > 0
    if not out.any():
        return out
    other = (data < 0x21) | (data > 0x7E)
    lead = _pairs(data, ends)
    other[lead] = other[lead + 1] = False
    special = np.flatnonzero((data[:-1] == ord(SPECIAL[0])) & (data[1:] == ord(SPECIAL[1])))
    other[special] |= np.searchsorted(ends, special, side="right") == np.searchsorted(ends, special + 1, side="right")
    out[np.searchsorted(ends, np.flatnonzero(other), side="right")] = False
    return out


def all_plain(words: list[str]) -> list[bool]:
    """Whether each word is made of letters the merges are compiled for."""
    data, size = flat(pa.array([w.encode() for w in words], pa.binary()))
    return plain_words(data, np.cumsum(size)).tolist()


@lru_cache(1 << 16)
def plain(word: str) -> bool:
    return all_plain([word])[0]
