"""Substring dedup by de Bruijn compaction of repeated word windows.

A window of ``width`` words is an edge of the de Bruijn graph of the corpus.
Edges are dealt out the way graph compactors do it (Chikhi et al., 2016): each
window has a minimizer, the 8-word run in it with the smallest hash, equal
windows have it at the same place, and consecutive windows with one minimizer
form a path that travels together. Five passes over the texts, joined with
the answers of the shuffles between them:

1. Minimizers that occur once in the corpus cannot be in a repeated window.
   Each batch of texts sends its distinct minimizers to buckets and gets back
   which of them repeat: about one hash per six words, and one bit.
2. Windows with a repeating minimizer are sent, once per batch, with their
   coordinates, and come back with the coordinates of their first occurrence:
   the source. Two windows are equal if the independent 64-bit hashes of the
   minimizer and of the whole window both are. Both together choose the bucket,
   so the many different windows around a frequent line spread over all.
3. The joined sources make paths: consecutive windows whose sources are
   consecutive too are a nonbranching repeated path and are compacted into one
   span with one source. Both windows of a step lie in one text, so no step
   crosses batches. A span claims to be equal to the words at its source; a
   batch sends each distinct claim once, with the SHA-256 of its words, to the
   batch that holds the source.
4. There the words at the source are hashed and the claim is confirmed or not.
5. Words under confirmed spans go.

A batch sends a hash or a claim once however often it has it, so a passage that
a third of all texts share costs a bucket one entry per batch, not one per
text. The texts are shuffled once; Spark reuses that exchange in all passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import bytes_of, mixed, utf8, words_of

#: Words of a minimizer.
MINIMIZER = 8
#: Bytes of text of a batch, and of text per bucket of hashes, on average.
BATCH_BYTES, BUCKET_BYTES = 2_000_000, 12_000_000
#: Bytes hashed at a time.
BLOCK = 1 << 20
#: The primes of XXH64.
_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
_BASE = 0x9E3779B97F4A7C15
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source_id", pa.int64()), ("source_start", pa.int32())]))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int) -> np.ndarray:
    """64-bit hash of each word's bytes; families are independent."""
    signs = np.random.default_rng(family).integers(0, 1 << 64, 256, dtype=np.uint64)
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + BLOCK)))
        a, b = starts[lo], ends[hi - 1]
        power, inverse = _powers(2 * BLOCK) if b - a < 2 * BLOCK else _powers.__wrapped__(int(b - a) + 1)
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(signs[data[a:b]] * power[: b - a], out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
        lo = hi
    return mixed(out)


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out = out * _MULTIPLIER + words[j : n + j]
    return mixed(out)


def batch_of(order: np.ndarray, text: np.ndarray, batches: int) -> np.ndarray:
    """``pmod(xxhash64(order_id, text_hash), batches)`` as Spark has it, seed 42."""
    h = np.full(len(order), 42, dtype=np.uint64)
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in _PRIMES)
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    for column in (order, text):
        h = (h + p5 + np.uint64(8)) ^ (turned(column.astype(np.int64).view(np.uint64) * p2, 31) * p1)
        h = turned(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h = h ^ (h >> np.uint64(32))
    return h.view(np.int64) % np.int64(batches)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the indices of its entries, in their order; sorted once."""
    order = np.argsort(bucket, kind="stable")
    held = bucket[order]
    cuts = np.flatnonzero(np.diff(held, prepend=held[:1] + 1)) if len(held) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(held)]):
        yield int(held[lo]), order[lo:hi]


@dataclass
class Batch:
    """Texts in order of (id, text hash), and their windows in that order."""

    rows: pa.Table  # without repeats of a row
    copies: np.ndarray  # of each row
    texts: pa.Array
    first: np.ndarray  # of each text, its first word; one more entry
    at: np.ndarray  # of each window, its first word
    minimizer: np.ndarray  # of each window, the hash
    place: np.ndarray  # of each window, the word where its minimizer is
    words: np.ndarray  # second hash of each word
    width: int

    @classmethod
    def of(cls, rows: pa.Table, width: int, hashed: bool = True) -> Batch:
        """The batch; without ``hashed`` its texts and words only."""
        rows = rows.sort_by([("order_id", "ascending"), ("text_hash", "ascending")])
        order, key = (np.asarray(rows[c].combine_chunks()) for c in ("order_id", "text_hash"))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (order[1:] != order[:-1]) | (key[1:] != key[:-1])
        copies = np.diff(np.append(np.flatnonzero(new), len(new)))
        if not new.all():
            rows = rows.filter(pa.array(new))
        texts = utf8(rows["text"])
        data, offsets = bytes_of(texts)
        starts, ends, first = words_of(data, offsets)
        if not hashed:
            none = first[:0].astype(np.uint64)
            return cls(rows, copies, texts, first, first[:0], none, first[:0], none, width)
        counts = np.diff(first)
        inner = np.ones(len(starts), dtype=bool)
        for text in np.flatnonzero(counts):
            inner[max(first[text], first[text + 1] - width + 1) : first[text + 1]] = False
        at = np.flatnonzero(inner)
        runs = _rolled(word_hashes(data, starts, ends, 1), min(MINIMIZER, width))
        least, place = runs[at], at.copy()
        for j in range(1, width - min(MINIMIZER, width) + 1):
            other = runs[at + j]
            less = other < least
            least[less] = other[less]
            place[less] = at[less] + j
        return cls(rows, copies, texts, first, at, least, place, word_hashes(data, starts, ends, 2), width)

    def minimizers(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimizers, sorted, and whether each occurs at several places."""
        one = np.flatnonzero(np.diff(self.place, prepend=-1))
        distinct, counts = np.unique(self.minimizer[one], return_counts=True)
        return distinct, counts > 1

    def entries(self, repeating: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows with a repeating minimizer: their indices, window hashes, the distinct
        ones' first index among them in order, and the number of each one's entry."""
        window = np.flatnonzero(np.isin(self.minimizer, repeating))
        whole = _rolled(self.words, self.width)[self.at[window]] if len(window) else self.minimizer[:0]
        lead = self.minimizer[window]
        turn = np.lexsort((lead, whole))  # stable: the first of equal windows comes first
        new = np.ones(len(turn), dtype=bool)
        new[1:] = (np.diff(whole[turn]) != 0) | (np.diff(lead[turn]) != 0)
        first, entry = turn[new], np.empty_like(turn)
        entry[turn] = np.cumsum(new) - 1
        order = np.argsort(first)
        turn = np.empty_like(order)
        turn[order] = np.arange(len(order))
        return window, whole, first[order], turn[entry]

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """``(order id, text hash)`` of each text."""
        return tuple(np.asarray(self.rows[c].combine_chunks()) for c in ("order_id", "text_hash"))

    def coordinates(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(order id, text hash, word)`` of windows."""
        text = np.searchsorted(self.first, self.at[window], side="right") - 1
        order, key = self.names()
        return order[text], key[text], (self.at[window] - self.first[text]).astype(np.int32)


def _places(lead: np.ndarray, whole: np.ndarray, buckets: int) -> np.ndarray:
    """Pass 2's bucket of each window: equal windows meet, others with the same minimizer need not."""
    return mixed(whole + lead * _MULTIPLIER) % np.uint64(buckets)


def _table(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.table({n: pa.array(list(c), t) for (n, t), c in zip(schema.items(), columns)})


ASKED = {"bucket": pa.int64(), "batch": pa.int64(), "hashes": pa.binary(), "several": pa.binary()}
REPEATS = {"batch": pa.int64(), "bucket": pa.int64(), "n": pa.int32(), "repeats": pa.binary()}
EDGES = {
    "bucket": pa.int64(), "batch": pa.int64(), "minimizer": pa.binary(), "whole": pa.binary(),
    "order_id": pa.binary(), "text_hash": pa.binary(), "start": pa.binary(),
}
SOURCES = {"batch": pa.int64(), "bucket": pa.int64(), "n": pa.int32(), "has": pa.binary(), "source_id": pa.binary(), "source_hash": pa.binary(), "source_start": pa.binary()}
#: To the batch ``to``: claims of ``batch`` (kind 1), or its own spans (kind 0); then the answers to ``batch``.
CLAIMS = {"to": pa.int64(), "batch": pa.int64(), "kind": pa.int32(), "data": pa.binary()}
VERDICTS = {"batch": pa.int64(), "source": pa.int64(), "kind": pa.int32(), "n": pa.int32(), "data": pa.binary()}
CLAIM = np.dtype([("id", "<i8"), ("hash", "<i8"), ("start", "<i4"), ("length", "<i4"), ("digest", "u1", 32)])
SPAN = np.dtype([("row", "<i4"), ("start", "<i4"), ("end", "<i4"), ("source_id", "<i8"), ("source_start", "<i4"), ("claim", "<i4")])
DDL = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}


def _ddl(schema: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{n} {DDL[t]}" for n, t in schema.items())


def _ask(width: int, buckets: int):
    """Pass 1: a batch's distinct minimizers by bucket."""

    def run(key, rows):
        distinct, several = Batch.of(rows, width).minimizers()
        bucket, out = distinct % np.uint64(buckets), []
        for b, mine in _dealt(bucket):
            out.append((b, key[0].as_py(), distinct[mine].tobytes(), np.packbits(several[mine]).tobytes()))
        return _table(ASKED, out)

    return run


def _repeats(key, rows):
    """A bucket: which minimizers occur in several batches, or at several places of one."""
    held = [np.frombuffer(h, np.uint64) for h in rows["hashes"].to_pylist()]
    sizes = [len(h) for h in held]
    several = [np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(rows["several"].to_pylist(), sizes)]
    _, entry, counts = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    again = (counts[entry] > 1) | (np.concatenate(several) > 0)
    parts = np.split(again, np.cumsum(sizes)[:-1])
    names = rows["batch"].to_pylist()
    return _table(REPEATS, [(b, key[0].as_py(), n, np.packbits(p).tobytes()) for b, n, p in zip(names, sizes, parts)])


def _repeating(batch: Batch, answers: pa.Table, buckets: int) -> np.ndarray:
    distinct, _ = batch.minimizers()
    mine, out = dict(_dealt(distinct % np.uint64(buckets))), [distinct[:0]]
    for row in answers.to_pylist():
        out.append(distinct[mine[row["bucket"]]][np.unpackbits(np.frombuffer(row["repeats"], np.uint8), count=row["n"]).astype(bool)])
    return np.concatenate(out)


def _edges(width: int, buckets: int):
    """Pass 2: a batch's distinct windows with a repeating minimizer, with their first coordinates in it."""

    def run(key, rows, answers):
        if not rows.num_rows or not answers.num_rows:
            return _table(EDGES, [])
        batch = Batch.of(rows, width)
        window, whole, first, _ = batch.entries(_repeating(batch, answers, buckets))
        lead, out = batch.minimizer[window[first]], []
        order, text, start = batch.coordinates(window[first])
        bucket = _places(lead, whole[first], buckets)
        columns = (lead, whole[first], order, text, start)
        for b, mine in _dealt(bucket):
            out.append((b, key[0].as_py(), *[c[mine].tobytes() for c in columns]))
        return _table(EDGES, out)

    return run


def _sources(key, rows):
    """A bucket: the first occurrence of each window that another batch has earlier."""

    def column(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in rows[name].to_pylist()])

    lead, whole = column("minimizer", np.uint64), column("whole", np.uint64)
    order, text, start = column("order_id", np.int64), column("text_hash", np.int64), column("start", np.int32)
    turn = np.lexsort((start, text, order, lead, whole))
    new = np.ones(len(turn), dtype=bool)
    new[1:] = (whole[turn][1:] != whole[turn][:-1]) | (lead[turn][1:] != lead[turn][:-1])
    source = np.empty(len(turn), dtype=np.int64)
    source[turn] = turn[np.maximum.accumulate(np.where(new, np.arange(len(turn)), 0))]
    has = source != np.arange(len(turn))
    names, sizes, out, at = rows["batch"].to_pylist(), [len(x) // 8 for x in rows["whole"].to_pylist()], [], 0
    for b, n in zip(names, sizes):
        mine = has[at : at + n]
        from_ = source[at : at + n][mine]
        out.append((b, key[0].as_py(), n, np.packbits(mine).tobytes(), order[from_].tobytes(), text[from_].tobytes(), start[from_].tobytes()))
        at += n
    return _table(SOURCES, out)


def _claims(width: int, buckets: int, batches: int):
    """Pass 3: compacted spans, and what they claim about the words at their sources."""

    def run(key, rows, answers, sources):
        if not rows.num_rows or not answers.num_rows:
            return _table(CLAIMS, [])
        batch = Batch.of(rows, width)
        window, whole, first, entry = batch.entries(_repeating(batch, answers, buckets))
        held = dict(_dealt(_places(batch.minimizer[window[first]], whole[first], buckets)))
        # every window's source: the first in this batch, unless another batch has it earlier
        order, text, start = (c.copy() for c in batch.coordinates(window[first]))
        elsewhere = np.zeros(len(first), dtype=bool)
        for row in sources.to_pylist():
            mine = held[row["bucket"]]
            mine = mine[np.unpackbits(np.frombuffer(row["has"], np.uint8), count=row["n"]).astype(bool)]
            elsewhere[mine] = True
            order[mine] = np.frombuffer(row["source_id"], np.int64)
            text[mine] = np.frombuffer(row["source_hash"], np.int64)
            start[mine] = np.frombuffer(row["source_start"], np.int32)
        again = elsewhere[entry]
        again |= np.arange(len(window)) != first[entry]
        window, entry = window[again], entry[again]
        if not len(window):
            return _table(CLAIMS, [])
        at = batch.at[window]
        # nonbranching paths: the window and its source both move on by one word
        own = np.searchsorted(batch.first, at, side="right") - 1
        o, t, s = order[entry], text[entry], start[entry]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(own) != 0) | (np.diff(o) != 0) | (np.diff(t) != 0) | (np.diff(s) != 1)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(at)) - 1
        own, o, t, s = own[head], o[head], t[head], s[head]
        spans = np.zeros(len(head), dtype=SPAN)
        spans["row"], spans["start"], spans["source_id"], spans["source_start"] = own, at[head] - batch.first[own], o, s
        spans["end"] = at[last] - batch.first[own] + width
        said: dict[tuple, int] = {}  # distinct claims
        words, of, which = [], -1, np.empty(len(head), dtype=np.int64)
        for i, span in enumerate(spans.tolist()):
            if span[0] != of:
                of, words = span[0], batch.texts[span[0]].as_py().split()
            told = (int(o[i]), int(t[i]), span[4], span[2] - span[1], sha256(b" ".join(words[span[1] : span[2]])).digest())
            which[i] = said.setdefault(told, len(said))
        claims = np.array([(*c[:4], np.frombuffer(c[4], np.uint8)) for c in said], dtype=CLAIM)
        # claims in order of the batch they go to; a span names its claim in that order
        out, place, n = [], np.empty(len(claims), dtype=np.int64), 0
        for b, mine in _dealt(batch_of(claims["id"], claims["hash"], batches)):
            out.append((b, key[0].as_py(), 1, claims[mine].tobytes()))
            place[mine] = np.arange(n, n + len(mine))
            n += len(mine)
        spans["claim"] = place[which]
        out.append((key[0].as_py(), key[0].as_py(), 0, spans.tobytes()))
        return _table(CLAIMS, out)

    return run


def _verify(width: int):
    """Pass 4: whether the words at the source are those claimed; a batch's own spans pass through."""

    def run(key, rows, claims):
        if not rows.num_rows or not claims.num_rows:
            return _table(VERDICTS, [])
        batch = Batch.of(rows, width, hashed=False)
        row_of = {name: i for i, name in enumerate(zip(*(n.tolist() for n in batch.names())))}
        out, asked = [], []
        for row in claims.to_pylist():
            if row["kind"] == 0:
                out.append((row["batch"], row["to"], 0, 0, row["data"]))
            else:
                asked.append((row["batch"], np.frombuffer(row["data"], CLAIM)))
        if asked:
            every = np.concatenate([c for _, c in asked])
            true = np.zeros(len(every), dtype=bool)
            words, of = [], None
            for i in np.lexsort((every["hash"], every["id"])).tolist():  # one text after the other
                name, start, length = (int(every["id"][i]), int(every["hash"][i])), int(every["start"][i]), int(every["length"][i])
                if name != of:
                    of, words = name, batch.texts[row_of[name]].as_py().split()
                true[i] = sha256(b" ".join(words[start : start + length])).digest() == every["digest"][i].tobytes()
            at = 0
            for name, c in asked:
                out.append((name, key[0].as_py(), 1, len(c), np.packbits(true[at : at + len(c)]).tobytes()))
                at += len(c)
        return _table(VERDICTS, out)

    return run


def _remove(width: int):
    """Pass 5: words under confirmed spans go."""

    def run(key, rows, verdicts):
        batch = Batch.of(rows, width, hashed=False)
        held, true = np.zeros(0, dtype=SPAN), [np.zeros(0, dtype=bool)]
        for row in sorted(verdicts.to_pylist(), key=lambda r: r["source"]):
            if row["kind"] == 0:
                held = np.frombuffer(row["data"], SPAN)
            else:
                true.append(np.unpackbits(np.frombuffer(row["data"], np.uint8), count=row["n"]).astype(bool))
        held = held[np.concatenate(true)[held["claim"]]]
        total = int(batch.first[-1])
        steps = np.zeros(total + 1, dtype=np.int32)
        np.add.at(steps, batch.first[held["row"]] + held["start"], 1)
        np.add.at(steps, batch.first[held["row"]] + held["end"], -1)
        kept = np.cumsum(steps)[:total] == 0
        spans: list[list] = [[] for _ in range(len(batch.texts))]
        for row, start, end, source, at, _ in held.tolist():
            spans[row].append((start, end, source, at))
        out = []
        marks = kept.tolist()
        for i, raw in enumerate(batch.texts.to_pylist()):
            lo, hi = int(batch.first[i]), int(batch.first[i + 1])
            left = b" ".join(compress(raw.split(), marks[lo:hi]))
            out.append((hi - lo, hi - lo - sum(marks[lo:hi]), left.decode("utf-8"), sha256(left).hexdigest(), spans[i]))
        made = _table({"n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string(), "kept_sha256": pa.string(), "spans": _SPANS}, out)
        made = pa.table({"doc_id": batch.rows["doc_id"], **{n: made[n] for n in made.column_names}})
        return made if (batch.copies == 1).all() else made.take(pa.array(np.repeat(np.arange(len(made)), batch.copies)))

    return run


def remove_repeats(
    docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text",
    batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text, kept_sha256, spans)`` per row of ``docs``.

    Words are runs without ASCII white space. A word goes if it is in a window
    of ``width`` words that also starts earlier: in a smaller id, or earlier in
    the same text; windows are judged on the input. ``kept_text`` joins what
    is left by single spaces. ``spans`` are the compacted repeated paths, as
    word ranges with the id and word of their source; each was confirmed by the
    SHA-256 of the words there, and only confirmed ones remove words (one that is
    not confirmed would take two 64-bit hashes equal for different words).

    Null text has no words. Null ids come after all others. Texts under one id
    are ordered by a hash of the text; rows with one id and one text are one
    document and get the same result. A very long text is one row of a batch,
    held whole by its task. Other columns are not read; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    last = 2**63 - 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(last)).alias("order_id"), F.xxhash64("text").alias("text_hash"), "text")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    batches, buckets = size // batch_bytes + 1, size // bucket_bytes + 1
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), batches // 32)
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("order_id", "text_hash"), F.lit(batches)))
    rows = rows.repartition(parts, "batch")  # the one shuffle of the texts
    asked = rows.groupBy("batch").applyInArrow(_ask(width, buckets), _ddl(ASKED))
    answers = asked.groupBy("bucket").applyInArrow(_repeats, _ddl(REPEATS))
    edges = rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_edges(width, buckets), _ddl(EDGES))
    sources = edges.groupBy("bucket").applyInArrow(_sources, _ddl(SOURCES))
    # both answers of a batch in one table, for one cogroup
    told = answers.select("batch", "bucket", "n", "repeats", *[F.lit(None).cast("binary").alias(c) for c in list(SOURCES)[3:]])
    told = told.union(sources.select("batch", "bucket", "n", F.lit(None).cast("binary"), *list(SOURCES)[3:]))
    claim = _claims(width, buckets, batches)

    def claims_of(key, held, both):
        ours = both["repeats"].is_valid()
        return claim(key, held, both.filter(ours), both.filter(pc.invert(ours)))

    claims = rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(claims_of, _ddl(CLAIMS))
    verdicts = rows.groupBy("batch").cogroup(claims.groupBy("to")).applyInArrow(_verify(width), _ddl(VERDICTS))
    return rows.groupBy("batch").cogroup(verdicts.groupBy("batch")).applyInArrow(
        _remove(width),
        "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, "
        "spans array<struct<start: int, end: int, source_id: long, source_start: int>>",
    )
