"""The compiled merges against the tokenizers library."""

from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from starweave.llm import merges, queries, tokens
from starweave.llm.common import utf8
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary())


@pytest.fixture(scope="module")
def machine():
    out = merges.Merges(queries.vocabulary())
    assert out.usable
    return out


def check(machine, library, words):
    sizes, ids = machine.words(words)
    runs = library.encode_batch_fast(words, add_special_tokens=False)
    assert sizes.tolist() == [len(r.ids) for r in runs]
    assert ids.tolist() == [i for r in runs for i in r.ids]


def test_every_plain_letter_and_random_words(machine, library):
    letters = [chr(c) for c in range(0x21, 0x180) if merges.plain(chr(c))]
    assert len(letters) > 200
    rng = random.Random(3)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 15))) for _ in range(5000)]
    pairs = [a + b for a in letters for b in "aÉ'1.ž"]
    check(machine, library, letters + pairs + words + ["it's", "I'LL", "'''s", "aaaa" * 90, "1234", "a1b2", "...", "<>|"])


def test_every_word_of_the_documents(machine, library):
    texts = pq.read_table(f"{SMALL}/documents.parquet", columns=["text"])["text"].to_pylist()
    words = sorted({w for t in texts for w in (t or "").split() if merges.plain(w)})
    assert len(words) > 1000
    check(machine, library, words)


def test_words_with_other_letters_go_to_the_library(machine):
    for word in ("東京", "á", "İ", "ŉ", "ſ", "x y", "\u0085", "a\x1cb", "<|endoftext|>", "½", "ª", "×"):
        assert not merges.plain(word)
    both = tokens.Transducer(queries.vocabulary(), True)
    library = Tokenizer.from_file(queries.vocabulary())
    texts = ["Größe und 東京 <|endoftext|>x it's", "", "ﬁ ½ 1½ x y", "plain words only", "a" * 100 + " tail"]
    import pyarrow as pa

    got = both.encode(utf8(pa.array(texts)))
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_pair_table_holds_all_merges_and_nothing_else(machine):
    held = machine.keys[machine.keys >= 0]
    left, right = held >> 20, held & 0xFFFFF
    order = np.argsort(machine.ranks[machine.keys >= 0])
    assert machine.rank(left, right)[order].tolist() == sorted(machine.ranks[machine.keys >= 0].tolist())
    assert (machine.rank(right + 70_000, left) == merges.NONE).all()


def test_words_of_both_kinds_keep_their_own_tokens(library):
    """New words are compiled as they come, repeats once; those for the library go behind, with their own ids."""
    assert merges.all_plain(["plain", "東京", "Größe"]) == [True, False, True]
    machine = tokens.Transducer(queries.vocabulary(), True)
    words = [w.encode() for w in ("zeta", "東京", "alpha", "zeta", "½x", "Größe", "東京")]
    at = machine.paths(words)
    assert at[0] == at[3] and at[1] == at[6] and len(machine.number) == 5
    got = [machine.ids[machine.begins[k] : machine.begins[k] + machine.sizes[k]].tolist() for k in at]
    assert got == [library.encode(w.decode(), add_special_tokens=False).ids for w in words]


def test_contractions_are_split_as_the_library_splits_them(machine, library):
    rng = random.Random(5)
    words = ["".join(rng.choice("''''stmdrevlLE1.aÉ") for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    check(machine, library, words + ["'s", "a's's", "..'s", "'ll'", "x're2", "É've", "'", "'l", "'L"])


def test_compiling_words_takes_no_call_a_word():
    """All new words of a batch are split, told apart and run in arrays: 411 CPU seconds a GB went on calls for each."""
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdefgÉ'1.") for _ in range(8)).encode() for _ in range(20_000)})
    machine = tokens.Transducer(queries.vocabulary(), True)
    calls = 0

    def count(frame, event, what):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        machine.paths(words)
    finally:
        sys.setprofile(None)
    assert len(machine.number) == len(words) and calls < len(words) / 4


def test_kept_paths_keep_their_tokens_over_batches(library, monkeypatch):
    """Few paths are kept, long words of either kind for a batch only; each batch's tokens are the library's."""
    monkeypatch.setattr(tokens, "MOST_PATHS", 20)
    monkeypatch.setattr(tokens, "LONGEST_PATH", 6)
    monkeypatch.setattr(tokens, "LONGEST_PLAIN", 12)
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcdeÉ東'1") for _ in range(rng.randrange(1, 16))) for _ in range(120)]
    machine = tokens.Transducer(queries.vocabulary(), True)
    for size in (0, 5, 30, 60, 60, 0, 60):
        texts = [" ".join(rng.choice(pool) for _ in range(size)) for _ in range(4)] + [""]
        got = machine.encode(utf8(pa.array(texts)))
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert machine.kept <= 20
    assert machine.kept == 20 and all(len(w) <= 6 for w in machine.number[:20].to_pylist())
    assert [machine.count(w.encode()) for w in pool] == [len(library.encode(w, add_special_tokens=False).ids) for w in pool]
