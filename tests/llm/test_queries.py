"""Registered training-data queries against DuckDB, and the pipeline against a plain version."""

from __future__ import annotations

from collections import Counter, defaultdict
from pathlib import Path

import pytest

from starweave.llm import mixing, queries, toxicity
from starweave.llm.common import scratch_tables, stored
from tests.conftest import SMALL
from tests.llm.fixtures import documents, table
from tests.llm.test_operators import normal, roots, simhash_of
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_duckdb(spark, con, name):
    assert compare(spark, name, SMALL, con)["status"] == "ok"


def test_all_operators_and_the_pipeline_are_registered():
    from __spark_entry__ import queries as every

    names = every()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_native_query_runs_no_python(spark):
    plan = queries.QUERIES["op9_source_mix"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    rows = documents(4)
    docs = table(spark, rows, clash=True)
    assert [f.__name__ for _, f in cp.STAGES] == ["non_toxic", "distinct_texts", "distinct_fingerprints", "mixed", "packed"]

    kept = cp.non_toxic(spark, docs, SMALL)
    assert kept.columns == docs.columns
    model = toxicity.train(docs, queries.table(spark, SMALL, "labels"))
    bad = {(r.doc_id, r.text) for r in toxicity.score(docs, model, out="tox").where("tox >= 0.3").collect()}
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((i, t) for i, t, _ in rows if (i, t) not in bad)

    one = stored(cp.distinct_texts(spark, docs, SMALL), "one")
    assert one.columns == docs.columns
    first = defaultdict(list)
    for i, t, _ in rows:
        first[normal(t)].append(i)
    want = Counter((min((x for x in ids if x is not None), default=None), text) for text, ids in first.items())
    assert Counter((r.doc_id, normal(r.text)) for r in one.collect()) == want

    near = cp.distinct_fingerprints(spark, docs, SMALL).collect()
    prints = [simhash_of(t, 4) for _, t, _ in rows]
    root = roots(sorted(set(prints)), [(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 4])
    groups = defaultdict(list)
    for (i, _, _), p in zip(rows, prints):
        groups[root[p]].append(i)
    least = Counter(min((x for x in ids if x is not None), default=None) for ids in groups.values())
    assert Counter(r.doc_id for r in near) == least

    mixed = cp.mixed(spark, one, SMALL)
    assert mixed.columns == docs.columns
    copies = Counter({(r.doc_id, r.text): r.copies for r in mixing.mix(one).select("doc_id", "text", "mix.copies").collect() if r.copies})
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == copies

    pieces = cp.packed(spark, one, SMALL).collect()
    tokens = {(r.doc_id, r.doc_tokens) for r in pieces}
    assert sum(r.length for r in pieces) >= sum(n for _, n in tokens)
    assert {r.doc_id for r in pieces} == {r.doc_id for r in one.collect()}


def test_pipeline_stages_take_an_empty_table(spark):
    import corpus_pipeline as cp

    docs = queries.table(spark, SMALL, "documents").limit(0)
    for _, stage in cp.STAGES:
        docs = stored(stage(spark, docs, SMALL), "empty")
        assert docs.count() == 0


def test_pipeline_runs(spark):
    import corpus_pipeline as cp

    with scratch_tables() as used:
        rows = cp.run(spark, SMALL).collect()
    # of all stages but the last only the table that packing reads is left
    last = max(i for i, p in enumerate(used) if "/pipeline-" in p)
    assert [p for p in used[: last + 1] if Path(p).exists()] == [used[last]]
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id, r.doc_tokens].append((r.start, r.length))
    # sequences are filled without gaps up to their capacity
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    # every kept document is there whole, as often as the mix took it
    ids = {r.doc_id for r in queries.table(spark, SMALL, "documents").collect()}
    for (doc, tokens), pieces in texts.items():
        copies = Counter(pieces)[0, min(p for s, p in pieces if s == 0)]
        assert doc in ids and copies in (1, 2)
        assert sum(length for _, length in pieces) == copies * tokens


def test_chosen_rows_do_not_depend_on_partitions(spark):
    import corpus_pipeline as cp

    rows = [(1, "same text", s) for s in ("b", "a", "d", "c")] + [(None, "same text", s) for s in ("x", "w")]
    chosen = set()
    for parts in (1, 3, 6):
        docs = spark.createDataFrame(rows[:: 1 if parts > 1 else -1], "doc_id long, text string, source string").repartition(parts)
        kept = cp.distinct_texts(spark, docs, SMALL).collect()
        assert len(kept) == 1
        chosen.add(tuple(kept[0]))
    assert len(chosen) == 1
