"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. With ``p`` and ``s`` code points of common prefix and suffix,
that is ``p + s >= longer length - 1``. Words lie as rows of padded code-point
matrices, once from the front and once from the back; blocks of rows are
compared with blocks of rows, column by column, which gives ``p`` and ``s`` of
all pairs of a tile together.

Which blocks meet: with longer length ``m``, the edit lies in some region
``[lo, hi)`` of the longer word, and the words agree on ``lo`` code points
before it and ``m - hi`` behind it. Words are grouped by ``(m, lo, hi, head,
tail)``, starting with the two halves of the word. A group with more than
``GROUP`` words is cut again: its words go on to the two halves of its region.
A region of one place holds words that are all near each other, so no group
outgrows the alphabet. No pair is lost (the edit is in one of the halves), and
none is counted twice: a pair belongs to the region its common prefix ends in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import pieces, stored, utf8

#: A run of letters once A-Z are in lower case.
RUN = re.compile("[a-zÀ-ÿ]+")
NO_RUN = re.compile("[^a-zÀ-ÿ]")
#: Code points looked at together; a task's distinct words held before they are sent on.
SLICE, HELD = 1 << 20, 200_000
#: Words of a group that is compared as it is; words of a block; rows of a task's groups on average.
GROUP, BLOCK, TASK_ROWS = 512, 64, 50_000
#: Cells of tiles that are compared together.
CELLS = 1 << 21
KEY = ["m", "lo", "hi", "head", "tail"]


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in pieces of about ``size`` code points that cut no run."""
    at = 0
    while at < len(text):
        cut = NO_RUN.search(text, at + size)
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


def _runs(least_chars: int, drop_every: int | None):
    def rows(total: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in pieces(batches, "text"):
            for ident, text in zip(batch["id"].to_pylist(), utf8(batch["text"]).to_pylist()):
                own: Counter = Counter()
                for part in slices(text.lower().decode("utf-8", "replace")):  # of bytes: A-Z only
                    own.update(RUN.findall(part))
                start = crc32(f"{ident}:".encode())
                for word, n in own.items():
                    if len(word) < least_chars:
                        continue
                    if drop_every:
                        h = crc32(word.encode(), start)
                        if h % drop_every == 0:
                            word = word[: h % len(word)] + word[h % len(word) + 1 :]
                            if len(word) < least_chars:
                                continue
                    total[word] += n
            if len(total) >= HELD:
                yield rows(total)
                total.clear()
        if total:
            yield rows(total)

    return run


def word_counts(
    docs: DataFrame,
    least_chars: int = 5,
    least_count: int = 3,
    drop_every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(word, n)`` of the distinct runs ``[A-Za-z\\u00C0-\\u00FF]+`` of all texts, A-Z in lower case.

    Words have at least ``least_chars`` code points and ``least_count``
    occurrences. With ``drop_every``, a run loses a code point where the
    crc32 ``h`` of ``<id>:<run>`` is a multiple of it: that at ``h % length``
    (known misspellings, for trials). Counts are summed in the tasks first, so
    a very frequent word is a row per task.

    Null texts have no runs; a null id is written as nothing. Very long texts
    are searched in slices that cut no run. Repeated rows count each. An empty
    table gives an empty table. Other columns are not read.
    """
    rows = docs.select(
        F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text_col].cast("string").alias("text")
    )
    found = rows.mapInArrow(_runs(least_chars, drop_every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded code points from the front, from the back, and the lengths."""
    size = np.array([len(w) for w in words], dtype=np.int32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4") + 1  # 0 is padding
    flat = flat.astype(np.uint8 if not len(flat) or flat.max() < 256 else np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    front = np.zeros((len(words), int(size.max(initial=0))), dtype=flat.dtype)
    back = front.copy()
    front[row, place] = flat
    back[row, size[row] - 1 - place] = flat
    return front, back, size


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many leading columns each row of each block of ``x`` shares with each row of ``y``'s block."""
    alive = np.ones((x.shape[0], x.shape[1], y.shape[1]), dtype=bool)
    n = np.zeros(alive.shape, dtype=np.int32)
    for column in range(x.shape[2]):
        alive &= x[:, :, None, column] == y[:, None, :, column]
        if not alive.any():
            break
        n += alive
    return n


def near_pairs(words: list[str], group: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Row numbers ``(i, j)``, ``i < j``, of near words of one group; rows lie sorted by ``group`` from 0."""
    blocks = -(-len(words) // BLOCK)
    pad = blocks * BLOCK - len(words)
    front, back, size = matrices(words + [""] * pad)
    group = np.append(group, np.full(pad, -1))
    m, lo, hi = (np.append(a, np.zeros(pad, a.dtype)) for a in (m, lo, hi))
    shaped = {k: a.reshape(blocks, BLOCK, *a.shape[1:]) for k, a in
              (("f", front), ("b", back), ("g", group), ("s", size), ("m", m), ("lo", lo), ("hi", hi))}
    last = shaped["g"].max(axis=1)  # of each block, the group that may reach into the next ones
    first = shaped["g"][:, 0]
    step = max(1, CELLS // BLOCK**2)
    for apart in range(blocks):
        at = np.flatnonzero(last[: blocks - apart] >= first[apart:])
        at = at[first[apart:][at] >= 0]
        if not len(at) and apart:
            break
        for a in range(0, len(at), step):
            x, y = at[a : a + step], at[a : a + step] + apart
            width = int(max(shaped["s"][x].max(), shaped["s"][y].max()))
            same = shaped["g"][x][:, :, None] == shaped["g"][y][:, None, :]
            longer = np.maximum(shaped["s"][x][:, :, None], shaped["s"][y][:, None, :])
            p = common(shaped["f"][x][:, :, :width], shaped["f"][y][:, :, :width])
            s = common(shaped["b"][x][:, :, :width], shaped["b"][y][:, :, :width])
            of = shaped["m"][x][:, :, None]
            near = same & (longer == of) & (p + s >= longer - 1)
            near &= (p >= shaped["lo"][x][:, :, None]) & (p < shaped["hi"][x][:, :, None])
            tile, i, j = np.nonzero(near)
            i, j = x[tile] * BLOCK + i, y[tile] * BLOCK + j
            yield i[i < j], j[i < j]


def _tiles(key: tuple, rows: pa.Table) -> pa.Table:
    """Near words of a task's groups: per word their number and the best, of largest count, then smallest."""
    rows = rows.sort_by([(c, "ascending") for c in [*KEY, "word"]])
    codes = [rows[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in KEY]
    new = np.zeros(rows.num_rows, dtype=bool)
    for code in codes:
        new[1:] |= code[1:] != code[:-1]
    words = rows["word"].to_pylist()
    n, m, lo, hi = (rows[c].to_numpy() for c in ("n", "m", "lo", "hi"))
    found = list(near_pairs(words, np.cumsum(new), m, lo, hi))
    i = np.concatenate([np.zeros(0, np.int64)] + [a for a, _ in found])
    j = np.concatenate([np.zeros(0, np.int64)] + [b for _, b in found])
    i, j = np.append(i, j), np.append(j, i)
    # rows of one word may lie in several groups: number words in code-point order
    names = rows["word"].combine_chunks().dictionary_encode()
    by_name = names.dictionary.cast(pa.binary())
    order = pc.sort_indices(by_name)
    by_name = by_name.take(order)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    number = rank[names.indices.to_numpy()]
    a, b = number[i], number[j]
    best = np.lexsort((b, -n[j], a))
    a, b, top = a[best], b[best], n[j][best]
    start = np.flatnonzero(np.diff(a, prepend=-1))
    return pa.table(
        {
            "word": by_name.take(pa.array(a[start])).cast(pa.string()),
            "n_near": np.diff(np.append(start, len(a))),
            "near_n": top[start],
            "near": by_name.take(pa.array(b[start])).cast(pa.string()),
        }
    )


def _placed(rows: DataFrame, regions) -> DataFrame:
    """Each row of ``(word, n, m)`` in each of ``regions`` (an array of ``(lo, hi)``), with its head and tail."""
    out = rows.withColumn("region", F.explode(regions)).select("word", "n", "m", "region.lo", "region.hi")
    return out.select(
        "*", F.expr("substring(word, 1, lo)").alias("head"),
        F.expr("substring(word, length(word) - (m - hi) + 1, m - hi)").alias("tail"),
    )


def _halves(lo: str, hi: str):
    middle = f"cast(({lo} + {hi}) div 2 as int)"
    whole = f"array(named_struct('lo', {lo}, 'hi', {middle}), named_struct('lo', {middle}, 'hi', {hi}))"
    return F.expr(f"if({hi} - {lo} < 2, array(named_struct('lo', {lo}, 'hi', {hi})), {whole})")


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``(word, n_near, best)`` of the words of ``(word, n)`` that have near words.

    ``best`` is the near word of largest ``n``, the smallest in code-point
    order of several: a struct ``(less, word)``, ``less`` being ``-n``.
    """
    sizes = words.select("word", "n", F.explode(F.expr("array(length(word), length(word) + 1)")).alias("m"))
    placed = _placed(sizes, _halves("0", "m"))
    found = None
    while True:
        placed = stored(placed, "spelling-regions")
        groups = placed.groupBy(*KEY).agg(F.count("*").alias("size"), F.max(F.length("word")).alias("long"))
        groups = stored(groups.where("size > 1 and long = m"), "spelling-groups")
        ready = (F.col("size") <= group) | F.expr("hi - lo < 2")
        state = groups.agg(F.sum(F.when(ready, F.col("size"))), F.count_if(~ready)).first()
        tasks = max(1, -(-(state[0] or 0) // TASK_ROWS))
        rows = placed.join(groups.where(ready).select(*KEY), KEY)
        rows = rows.withColumn("task", F.pmod(F.xxhash64(*KEY), F.lit(tasks)))
        tiles = rows.groupBy("task").applyInArrow(_tiles, "word string, n_near long, near_n long, near string")
        tiles = stored(tiles, "spelling-near")
        found = tiles if found is None else found.union(tiles)
        if not state[1]:
            break
        left = placed.join(groups.where(~ready).select(*KEY), KEY)
        placed = _placed(left.select("word", "n", "m", F.col("lo").alias("l"), F.col("hi").alias("h")).select(
            "word", "n", "m", _halves("l", "h").alias("regions")), F.col("regions"))
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))


def spelling_variants(words: DataFrame, ratio: int = 2, group: int = GROUP) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words in ``(word, n)``; counts of repeated rows add up.

    ``form`` is a word's near word of largest ``n`` (of several the smallest in
    code-point order) if that is at least ``ratio`` times the word's, else
    null; ``root`` follows forms to the last one. Counts at least double at
    each step (``ratio`` 2), so there are no loops and pointer doubling ends
    after a few joins. ``n_near`` counts near words, 0 if there are none.

    Null and empty words have no near words but those that differ by one code
    point; a null word is left out. Very long words are cut into smaller
    regions like others. An empty table gives an empty table.
    """
    if ratio < 2:
        raise ValueError("ratio: at least 2")
    words = words.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(words, "spelling-words")
    near = near_words(words, group)
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"if(-best.less >= {ratio} * n, best.word, null)").alias("form"),
        F.expr(f"if(-best.less >= {ratio} * n, -best.less, null)").alias("form_n"),
    )
    joined = stored(joined, "spelling-forms")
    roots = stored(joined.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        roots = stored(moved, "spelling-roots")
        if not roots.where("moved").count():
            break
    return joined.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
