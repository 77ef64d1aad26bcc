"""Line dedup, spelling variants and periodic runs against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import lines, periodic, spelling
from tests.llm.fixtures import SCHEMA, documents, table

ROWS = documents(11)
SPACE = "\x20\t\n\x0b\x0c\r"


def a_to_z(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# line dedup


def lined_rows():
    rng = random.Random(5)
    often = ["Subscribe now", "  subscribe NOW\t", "ÄPFEL und Birnen", "é", "\x0bx\x0c"]
    rows = [(i, "\n".join(rng.choice(often + [f"own line {i} {j}", "", " \t"]) for j in range(rng.randrange(1, 9))), "s") for i in range(60)]
    rows += [(i, "a line that all of these have\r\nand one of their own %d" % i, "s") for i in range(100, 130)]
    return rows + [(200, "\n" * 3000, "s"), (201, "x" * 50_000 + "\né", "s")]


def without_lines(rows, least_docs, least_chars):
    key = lambda line: a_to_z(line.strip(SPACE))
    count = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")})
    gone = lambda k: len(k) >= least_chars and count[k] >= least_docs
    out = []
    for i, t, _ in rows:
        each = (t or "").split("\n")
        left = [x for x in each if not gone(key(x))]
        out.append((i, len(each), len(each) - len(left), "\n".join(left)))
    return Counter(out)


@pytest.mark.parametrize("least_docs,least_chars,clash", [(10, 1, False), (2, 1, True), (10, 2, False), (1, 3, False)])
def test_lines_match_brute_force(spark, least_docs, least_chars, clash):
    rows = lined_rows() + ROWS
    got = lines.line_dedup(table(spark, rows, clash), least_docs, least_chars).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in got) == without_lines(rows, least_docs, least_chars)


def test_lines_with_many_shards_and_copies_of_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 20)
    monkeypatch.setattr(lines, "GROUP_SHARDS", 3)
    monkeypatch.setattr(lines, "ASKS", 25)
    monkeypatch.setattr(lines, "BATCH_BYTES", 500)
    rows = lined_rows()
    got = lines.line_dedup(table(spark, rows), 10, 1).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in got) == without_lines(rows, 10, 1)


def test_lines_of_an_empty_table(spark):
    assert lines.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


# spelling variants


def counted(rows, least_chars, least_count, drop_every):
    total = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = a_to_z(run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_chars and n >= least_count}


def near(a, b):
    """One edit apart, by trying each."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words):
    close = defaultdict(list)
    every = sorted(words)
    for x, a in enumerate(every):
        for b in every[x + 1 :]:
            if near(a, b):
                close[a].append(b)
                close[b].append(a)
    form = {}
    for w in every:
        best = min(close[w], key=lambda o: (-words[o], o.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(close[w]), words.get(form[w])) for w in every}


@pytest.mark.parametrize("drop_every,clash", [(None, False), (7, True)])
def test_word_counts_match_brute_force(spark, drop_every, clash):
    rows = ROWS + [(5, "ÀÿB×÷c " * 3 + "abcdé", "s")]
    got = spelling.word_counts(table(spark, rows, clash), 5, 3, drop_every).collect()
    assert {r.word: r.n for r in got} == counted(rows, 5, 3, drop_every)


def test_slices_cut_no_run():
    rng = random.Random(2)
    text = "".join(rng.choice("aé .\n") for _ in range(5000)) + "b" * 300
    for size in (1, 7, 100):
        parts = list(spelling.slices(text, size))
        assert "".join(parts) == text
        assert [w for p in parts for w in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


def vocabulary(seed, n=700):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(n)}
    words |= {"hot" + "".join(rng.choice("xyz") for _ in range(4)) for _ in range(60)} | {"a" * k for k in range(1, 12)}
    words |= {"日本語x", "日本語y", "日本語", "long" * 500, "long" * 500 + "s", "long" * 400 + "lonk" + "long" * 99}
    return {w: 2 ** rng.randrange(12) for w in words}


@pytest.mark.parametrize("group", [4, 512])
def test_variants_match_brute_force(spark, group):
    words = vocabulary(group)
    df = spark.createDataFrame([*words.items(), (None, 3)], "word string, n long").repartition(3)
    got = spelling.spelling_variants(df, group=group).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == variants(words)
    assert len(got) == len(words)


def test_variants_of_repeated_rows_and_of_an_empty_table(spark):
    df = spark.createDataFrame([("hello", 2), ("hello", 3), ("hallo", 1)], "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df).collect()}
    assert got == {"hello": (None, "hello", 5, 1, None), "hallo": ("hello", "hello", 1, 1, 5)}
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    assert spelling.word_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, ratio=1)


# periodic runs


def runs(w, least):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def sequences(seed, many):
    rng = random.Random(seed)
    for _ in range(many):
        n, letters = rng.randrange(0, 150), rng.choice([1, 2, 2, 3, 5])
        kind = rng.random()
        if kind < 0.3:
            yield [rng.randrange(letters) for _ in range(n)]
        elif kind < 0.8:
            w = []
            while len(w) < n:
                w += [rng.randrange(letters) for _ in range(rng.randrange(1, 16))] * rng.randrange(1, 7)
                if rng.random() < 0.3:
                    w = (w * 3)[: rng.randrange(1, 3 * len(w) + 1)]
            yield w[:400]
        else:
            x, y = [0], [0, 1]
            while len(y) < n:
                x, y = y, y + x
            yield y[:n]


@pytest.mark.parametrize("least", [2, 12])
def test_runs_match_brute_force(least):
    for w in sequences(least, 400):
        start, end, period = periodic.runs_of(np.array(w, dtype=np.int64), least)
        got = sorted(zip(start.tolist(), (end - start).tolist(), period.tolist()))
        assert got == sorted(runs(w, least)), w


def test_range_successor_matches_a_scan():
    rng = np.random.default_rng(4)
    values = rng.permutation(300)
    tree = periodic.WaveletTree(values, 300)
    lo = rng.integers(0, 300, 500)
    hi = np.minimum(300, lo + rng.integers(0, 60, 500))
    x = rng.integers(0, 700, 500)
    want = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


@pytest.mark.parametrize("lay,clash", [(False, True), (True, False)])
def test_periodic_runs_match_brute_force(spark, lay, clash):
    rows = [r for r in ROWS if len(r[1] or "") < 4000]
    rows += [(1000 + i, " ".join(f"w{x}" for x in w), "s") for i, w in enumerate(sequences(9, 60))]
    rows += [(5000, "so \xa0 so\n" * 40, None), (5001, "ja " * 900 + "nein", None)]
    got = periodic.periodic_runs(table(spark, rows, clash), 12, lay).collect()
    want = []
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = crc32(("" if i is None else str(i)).encode())
        if lay and h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        found = runs(w, 12)
        kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in found)]
        want.append((i, tuple(found), " ".join(kept)))
    assert Counter((r.doc_id, tuple(map(tuple, r.runs)), bytes(r.collapsed).decode()) for r in got) == Counter(want)


def test_periodic_runs_of_an_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_new_operators_leave_the_session_as_it_was(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    docs = table(spark, ROWS)
    for df in (lines.line_dedup(docs), spelling.spelling_variants(spelling.word_counts(docs)), periodic.periodic_runs(docs)):
        df.agg(F.count("*")).collect()
    assert before == {k: spark.conf.get(k, None) for k in before}
