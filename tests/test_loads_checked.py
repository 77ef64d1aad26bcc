"""Counts taken while writing, rejects of the mapped load, and labels of several formats."""

import json

import pytest
from pyspark.sql import functions as F

from starweave.operators.quality import TableChecks, table_report, write_checked
from starweave.plans import travel
from starweave.plans.travel import decode_labels, load_immigration
from starweave.session import scratch_path
from starweave.sources.readers import REJECTED, read_json_mapped


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["p"], "rebalance": True}, {"sort_within": ["k"]}])
def test_checks_of_a_write_equal_those_of_a_scan(spark, layout):
    df = spark.range(1000).select(F.nullif(F.col("id") % 7, F.lit(0)).alias("k"), (F.col("id") % 3).alias("p"))
    spec = TableChecks("t", df, key=["k", "p"], unique=False, expected_rows=1000, types={"k": "bigint", "p": "int"})
    path = scratch_path(spark, "checked")
    assert rows_of(write_checked(spec, path, **layout)) == rows_of(table_report(spec))
    assert spark.read.parquet(path).count() == 1000


def test_checks_of_an_empty_write_and_of_repeats(spark):
    empty = spark.range(0).select(F.col("id").alias("k"))
    got = write_checked(TableChecks("t", empty, key=["k"], unique=False), scratch_path(spark, "empty"))
    assert rows_of(got) == [("t", "*", "min_rows", 0, False), ("t", "k", "not_null", 0, True)]
    with pytest.raises(ValueError):
        write_checked(TableChecks("t", empty, key=["k"]), scratch_path(spark, "repeats"))


def test_an_immigration_load_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)
    source = {src: F.lit("x") for src, _ in travel.IMMIGRATION_COLUMNS if src not in ("arrival_date", "departure_date", "cicid")}

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    merged = spark.range(50).select(F.col("id").cast("double").alias("cicid"), F.lit(1.0).alias("arrdate"),
                                    F.lit(2.0).alias("depdate"), *[v.alias(k) for k, v in source.items()])
    merged = merged.mapInArrow(count, merged.schema)
    path = scratch_path(spark, "immigration")
    checks = load_immigration(spark, merged, path, order_by=["arrival_date"])
    assert all(r.passed for r in checks.collect()) and checks.count() == 3
    assert spark.read.parquet(path).count() == 50 and seen.value == 50


def test_rejects_of_the_mapped_load(spark, tmp_path):
    lines = [json.dumps({"a": "1", "b": "x"}), '{"a": "2', json.dumps({"a": "three", "b": "y"}), json.dumps({"b": "z"})]
    (tmp_path / "f.json").write_text("\n".join(lines))
    mapping = [("a", "n", "int"), ("b", "s", "string")]
    got = rows_of(read_json_mapped(spark, f"file:{tmp_path}", mapping, on_error="reject"))
    assert got == sorted([(1, "x", None), (None, None, '{"a": "2'), (None, None, '{"a":"three","b":"y"}'), (None, "z", None)], key=repr)
    assert REJECTED in read_json_mapped(spark, f"file:{tmp_path}", mapping, on_error="reject").columns
    assert rows_of(read_json_mapped(spark, f"file:{tmp_path}", mapping, on_error="null")) == sorted(
        [(1, "x"), (None, None), (None, "y"), (None, "z")], key=repr)
    with pytest.raises(Exception, match="three"):
        (tmp_path / "f.json").write_text(lines[2])
        read_json_mapped(spark, f"file:{tmp_path}", mapping).collect()


FORMATS = [("mode", "1", "Air"), ("mode", "2", "Sea"), ("addr", "AL", "ALABAMA"), ("addr", "99", "Other"), ("addr", "1", "one"),
           ("mode", None, "lost"), ("mode", "1", "Air")]


def test_labels_of_several_formats_in_one_pass(spark, monkeypatch):
    formats = spark.createDataFrame(FORMATS, "format string, code string, label string")
    df = spark.createDataFrame([(1, "AL"), (3, "XX"), (None, None), (2, "1")], "m int, a string")
    out = decode_labels(df, formats, {"mode": ("m", "mode"), "state": ("a", "addr", "99")})
    assert [(r.mode, r.state) for r in out.collect()] == [("Air", "ALABAMA"), (None, "Other"), (None, "Other"), ("Sea", "one")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    empty = decode_labels(df, formats.limit(0), {"mode": ("m", "mode")})
    assert {r.mode for r in empty.collect()} == {None}
    two = formats.union(spark.createDataFrame([("mode", "1", "Rail")], formats.schema))
    with pytest.raises(Exception):
        decode_labels(df, two, {"mode": ("m", "mode")}).collect()
    monkeypatch.setattr(travel, "MOST_LABELS", 3)
    with pytest.raises(Exception, match="more than 3 labels"):
        decode_labels(df, formats, {"mode": ("m", "mode")}).collect()


def test_a_lookup_does_not_search_the_whole_list(spark):
    """60,000 codes and 400,000 rows: searching the list for every row took minutes."""
    import time

    formats = spark.range(60_000).select(F.lit("port").alias("format"), F.col("id").cast("string").alias("code"), F.concat(F.lit("p"), "id").alias("label"))
    df = spark.range(20_000, 820_000, 2).select(F.col("id").alias("k"))
    started = time.time()
    got = decode_labels(df, formats, {"port": ("k", "port", "7")}).groupBy((F.col("port") == F.concat(F.lit("p"), "k")).alias("own"), (F.col("port") == "p7").alias("other")).count()
    assert {(r.own, r.other): r["count"] for r in got.collect()} == {(True, False): 20_000, (False, True): 380_000}
    assert time.time() - started < 30
