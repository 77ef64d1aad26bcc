"""Toxicity by a counterfactually regularised linear classifier.

Features are hashed: each distinct word of a text, lower-cased in A-Z, and its
first four bytes. The loss is logistic; every labelled text has a counterfactual
pair, and the squared difference of the pair's scores is a penalty. For a text
that names an identity group the pair is the text and the text with its terms
swapped for others of their sets. Any other text is paired with itself in a
neutral frame that mentions a group: two terms of one set, chosen by the
text's hash, added to it in turn. So the penalty acts on every corpus, also on
the words and stems that terms share with others. What a score takes from naming a group is
thereby reduced, not what it takes from the words around it.

Features of identity terms are learnable from the first text that has them
(other features must be clear and frequent), so that a bias of the labels
would show and the penalty has to undo it.

Learning uses a bounded sample of labelled rows (``sample``); scoring reads
every whole text, vectorised over the bytes of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from xxhash import xxh3_64_intdigest

from starweave.llm.common import bytes_of, mixed, pieces, sampled, small_batches, stored, utf8

#: Hashed features, and labelled rows that are learned from at most.
SIZE, SAMPLE = 1 << 18, 10_000
#: A feature must be in so many of the sampled texts.
SEEN = 3
#: Bytes of a word that are hashed side by side with other words'; the rest of a longer word is hashed on its own.
LONGEST = 48
#: Rounds of learning, weight decay, smoothing of shares, and the log ratio under which a feature is left out.
ROUNDS, DECAY, SMOOTH, CLEAR = 80, 3e-4, 0.5, 1.5
#: Weight of the counterfactual penalty.
BALANCE = 1.0
#: Sets of terms that stand for each other.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "bisexual", "straight"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
)
Sets = tuple[tuple[str, ...], ...]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: ASCII letters and all bytes of other letters make words.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # SIZE + 1, the bias last

    def score(self, column: pa.Array) -> np.ndarray:
        row, feature = features(column, self.weights[:-1] != 0)
        total = np.bincount(row, self.weights[feature], minlength=len(column)) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


@cache
def _swaps(identity: Sets) -> tuple[dict[str, str], re.Pattern]:
    """Each term's next of its set, and the pattern of all terms."""
    other = {term: terms[(i + 1) % len(terms)] for terms in identity for i, term in enumerate(terms)}
    return other, re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, other), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)


def swapped(text: str, identity: Sets = IDENTITY) -> str | None:
    """The text with each identity term swapped for the next of its set; None if there is none."""
    if not identity:
        return None
    other, terms = _swaps(identity)
    out, n = terms.subn(lambda m: other.get(m[0].lower(), m[0]), text)
    return out if n else None


def framed(text: str, identity: Sets) -> tuple[str, str]:
    """Two terms of one set, to be mentioned after the text in turn; both chosen by its hash."""
    turn = xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    terms = identity[turn % len(identity)]
    at = turn // len(identity) % len(terms)
    return terms[at], terms[(at + 1) % len(terms)]


def _word_end(data: np.ndarray, at: int, limit: int) -> int:
    """Where the word that goes on at ``at`` ends, looked for in growing steps."""
    step = 256
    while at < limit:
        other = np.flatnonzero(~_LETTER[_LOWER[data[at : min(limit, at + step)]]])
        if len(other):
            return at + int(other[0])
        at, step = min(limit, at + step), 2 * step
    return limit


def features(column: pa.Array, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` pairs of a binary column, each once; ``of`` marks the features that count.

    Works on the bytes in bounded blocks. A word's hash depends on its bytes alone.
    """
    data, offsets = bytes_of(column)
    rows, found = [], []
    for lo in range(0, len(data), 1 << 20):
        hi = min(len(data), lo + (1 << 20))
        # a block takes the words that start in it, and so reads on to the end of its last word
        inside = _LETTER[_LOWER[data[lo:hi]]]
        before = np.concatenate([_LETTER[_LOWER[data[lo - 1 : lo]]] if lo else np.zeros(1, bool), inside[:-1]])
        before[offsets[(offsets >= lo) & (offsets < hi)] - lo] = False
        starts = np.flatnonzero(inside & ~before) + lo
        if not len(starts):
            continue
        word, length = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
        stem = word
        row = np.searchsorted(offsets, starts, side="right") - 1
        limit = offsets[row + 1]
        live, at = np.arange(len(starts)), starts.copy()
        while len(live) and length[live[0]] < LONGEST:  # one byte of every word that goes on
            word[live] = word[live] * _STEP + _LOWER[data[at]] + np.uint64(1)
            length[live] += 1
            if length[live[0]] == 4:
                stem = word.copy()
            at = at + 1
            on = at < limit[live]
            on[on] = _LETTER[_LOWER[data[at[on]]]]
            live, at = live[on], at[on]
        for k, a in zip(live.tolist(), at.tolist()):
            rest = _LOWER[data[a : _word_end(data, a, int(limit[k]))]]
            word[k] = mixed(word[k : k + 1] ^ np.uint64(xxh3_64_intdigest(rest.tobytes())))[0]
            length[k] += len(rest)
        stem = np.where(length >= 4, stem, word)
        each = np.concatenate([mixed(word), mixed(stem ^ np.uint64(0x5555))]) % np.uint64(SIZE)
        each, row = each.astype(np.int64), np.concatenate([row, row])
        if of is not None:
            each, row = each[of[each]], row[of[each]]
        pair = np.unique(row * SIZE + each)
        rows.append(pair // SIZE)
        found.append(pair % SIZE)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.concatenate(rows) * SIZE + np.concatenate(found))  # a long text may span blocks
    return pair // SIZE, pair % SIZE


def _packed(column: pa.Array) -> list[np.ndarray]:
    """Features of each row."""
    row, feature = features(column)
    ends = np.searchsorted(row, np.arange(len(column) + 1))
    return [feature[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _binary(each: list[np.ndarray]) -> pa.Array:
    return pa.array([e.astype("<i4").tobytes() for e in each], pa.binary())


def named(identity: Sets) -> dict[str, np.ndarray]:
    """Features of each identity term."""
    terms = sorted({t for s in identity for t in s})
    return dict(zip(terms, _packed(pa.array([t.encode() for t in terms], pa.binary()))))


def _featurise(identity: Sets):
    """``(toxic, own, gone, come)``: features as packed 32-bit numbers; what the counterfactual pair's texts have apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = named(identity)
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch["text"].to_pylist()]
            own = _packed(utf8(batch["text"]))
            other = [swapped(t, identity) for t in texts]
            swap = _packed(pa.array([(t or "").encode() for t in other], pa.binary()))
            base = list(own)
            for i, t in enumerate(other):
                if t is None and identity:
                    a, b = framed(texts[i], identity)
                    base[i], swap[i] = np.union1d(own[i], of[a]), np.union1d(own[i], of[b])
            if not identity:
                swap = base
            gone, come = [np.setdiff1d(a, b) for a, b in zip(base, swap)], [np.setdiff1d(b, a) for a, b in zip(base, swap)]
            columns = [batch["toxic"], _binary(own), _binary(gone), _binary(come)]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "own", "gone", "come"])

    return run


class Rows:
    """Sparse rows; a feature that is present has its scale."""

    def __init__(self, packed: list[bytes], scale: np.ndarray | None = None):
        each = [np.frombuffer(p, "<i4") for p in packed]
        self.n = len(each)
        self.row = np.repeat(np.arange(self.n), [len(e) for e in each])
        self.feature = np.concatenate([*each, np.zeros(0, "<i4")]).astype(np.int64)
        if scale is not None:
            held = scale[self.feature] != 0
            self.row, self.feature = self.row[held], self.feature[held]
            self.value = scale[self.feature]

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature] * self.value, minlength=self.n) + weights[-1]

    def back(self, values: np.ndarray) -> np.ndarray:
        out = np.bincount(self.feature, values[self.row] * self.value, minlength=SIZE + 1)
        out[-1] += values.sum()
        return out


def fit(
    toxic: np.ndarray, own: list[bytes], gone: list[bytes], come: list[bytes], identity: Sets = IDENTITY,
    balance: float = BALANCE, rounds: int = ROUNDS, decay: float = DECAY,
) -> Model:
    """Adam on the penalised loss over all rows; ``gone`` and ``come`` are what each row's counterfactual pair has apart.

    Features are scaled by the log ratio of their smoothed shares in toxic and
    in other texts (Wang and Manning, 2012), so that words common to both
    hardly count and the few that tell them apart are learned first.
    """
    weights = np.zeros(SIZE + 1)
    if not len(toxic):
        weights[-1] = -2.0
        return Model(weights)
    every = Rows(own)
    seen = np.bincount(every.feature, minlength=SIZE)
    bad = np.bincount(every.feature, toxic[every.row], minlength=SIZE)
    n_bad = toxic.sum()
    ratio = np.log((bad + SMOOTH) / (n_bad + 2 * SMOOTH)) - np.log((seen - bad + SMOOTH) / (len(toxic) - n_bad + 2 * SMOOTH))
    scale = np.where((seen >= SEEN) & (np.abs(ratio) > CLEAR), ratio, 0.0)
    group = np.unique(np.concatenate([*named(identity).values(), np.zeros(0, np.int64)]))
    group = group[seen[group] > 0]
    scale[group] = np.where(np.abs(ratio[group]) > CLEAR, ratio[group], np.copysign(CLEAR, ratio[group]))
    x, a, b = Rows(own, scale), Rows(gone, scale), Rows(come, scale)
    share = min(0.95, max(0.05, toxic.mean()))
    weights[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        error = 1 / (1 + np.exp(-np.clip(x.dot(weights), -500, 500))) - toxic
        slope = x.back(error) / x.n
        apart = a.dot(weights) - b.dot(weights)
        slope += 2 * balance * (a.back(apart) - b.back(apart)) / x.n
        slope[:-1] += decay * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
    weights[:-1] *= scale
    weights[:-1][np.abs(weights[:-1]) < 0.02] = 0
    return Model(weights)


def held_out(doc_id):
    """Rows whose labels are never learned."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % 4 == 2


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample: int = SAMPLE, identity: Sets = IDENTITY, balance: float = BALANCE,
) -> Model:
    """A model from at most ``sample`` labelled rows, in an order fixed by a hash of the id.

    Held-out rows, null labels and null ids are left out; an id with several
    labels is toxic if one says so. Without labelled rows every text scores
    the same low value. ``identity`` gives the sets of terms that stand for each
    other (lower case), ``balance`` the weight of the counterfactual penalty.
    Null and empty texts are learned from as texts without words; a very long
    one is hashed in bounded blocks. Other columns are not read.
    """
    small_batches(docs)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "toxicity-known")
    known = stored(sampled(known, F.xxhash64(F.lit("toxicity"), "id"), sample), "toxicity-labels")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chosen = texts.join(known, "id").select("toxic", "text")
    rows = stored(chosen.mapInArrow(_featurise(identity), "toxic int, own binary, gone binary, come binary"), "toxicity-features")
    # an id may have several rows; the sample stays within its bound
    rows = rows.orderBy(F.xxhash64("own"), "toxic").limit(sample).collect()
    rows.sort(key=lambda r: (r.toxic, r.own))
    toxic = np.array([float(r.toxic > 0) for r in rows])
    return fit(toxic, *([r[c] for r in rows] for c in ("own", "gone", "come")), identity, balance)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with its score between 0 and 1 in ``out`` (a column of that name is replaced).

    Null and empty texts get the score of a text without known words. A very
    long text is read whole, in bounded blocks. Repeated rows score alike; an
    empty table gives an empty result. Other columns pass through whatever they are called.
    """
    rows = docs.drop(out) if out != text_col else docs
    small_batches(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # SIZE numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            found = shipped.value.score(utf8(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, DoubleType())]))
