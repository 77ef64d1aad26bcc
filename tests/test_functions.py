"""Scalar functions on literal frames: the ANSI cases first."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starweave.functions import (
    date_from_parts,
    ifnull_text,
    md5_key,
    millis_to_date,
    millis_to_second,
    millis_to_timestamp,
    parse_number,
    sas_to_date,
    split_item,
    time_parts,
    to_decimal18,
    to_double,
    truncate_width,
    weekday,
)
from starweave.sources.readers import enforce_widths


def one(spark, df, col):
    return [r[col] for r in df.collect()]


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(1541106106796,)], "ts bigint")
    r = df.select(
        millis_to_timestamp("ts").alias("ms"),
        millis_to_second("ts").alias("s"),
        millis_to_date("ts").alias("d"),
    ).first()
    assert r.ms == dt.datetime(2018, 11, 1, 21, 1, 46, 796000)
    assert r.s == dt.datetime(2018, 11, 1, 21, 1, 46)
    assert r.d == dt.date(2018, 11, 1)


def test_weekday_bases_and_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 11, 4, 13, 5),)], "t timestamp_ntz")
    r = df.select(
        weekday("t", "mon0").alias("a"), weekday("t", "sun0").alias("b"), weekday("t", "sun1").alias("c")
    ).first()
    assert (r.a, r.b, r.c) == (6, 0, 1)
    parts = df.select(*time_parts("t")).first()
    assert (parts.hour, parts.day, parts.week, parts.month, parts.year) == (13, 4, 44, 11, 2018)
    with pytest.raises(ValueError):
        weekday("t", "sat0")


def test_day_precision_hour_is_zero(spark):
    df = spark.createDataFrame([(1541106106796,)], "ts bigint")
    assert df.select(F.hour(millis_to_date("ts")).alias("h")).first().h == 0


def test_sas_dates(spark):
    df = spark.createDataFrame([(20545.0,), (None,), (float("nan"),), (1e20,), (-3.9,)], "x double")
    got = one(spark, df.select(sas_to_date("x").alias("d")), "d")
    assert got == [dt.date(2016, 4, 1), None, None, None, dt.date(1959, 12, 29)]


def test_date_from_parts_invalid_is_null(spark):
    df = spark.createDataFrame([("2015", "0", "1"), ("2015", "13", "1"), ("2015", "2", "28")], "y string, m string, d string")
    got = one(spark, df.select(date_from_parts("y", "m", "d").alias("d")), "d")
    assert got == [None, None, dt.date(2015, 2, 28)]


def test_split_and_double(spark):
    df = spark.createDataFrame([("US-CA", " 40.07"), ("US", "x"), (None, None)], "r string, c string")
    r = df.select(split_item("r", "-", 1).alias("s"), to_double("c").alias("v")).collect()
    assert [x.s for x in r] == ["CA", None, None]
    assert [x.v for x in r] == [40.07, None, None]


def test_ifnull_text_on_double(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "m double")
    assert one(spark, df.select(ifnull_text("m", "Not reported").alias("x")), "x") == ["Not reported", "1.0"]


def test_md5_null_in_null_out(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a")], "s int, t string")
    got = one(spark, df.select(md5_key("s", "t").alias("k")), "k")
    assert got[0] == "a3ed2f6ae4b4fd3a0b5e4e8b0b8cb6e6" or len(got[0]) == 32
    assert got[1] is None


def test_decimal18_rounds_half_up(spark):
    df = spark.createDataFrame([(215.6,), (216.2,), (2.5,), (0.5,)], "x double")
    got = one(spark, df.select(to_decimal18("x").alias("d")), "d")
    assert got == [Decimal(216), Decimal(216), Decimal(3), Decimal(1)]


def test_parse_number_modes(spark):
    df = spark.createDataFrame([("12",), ("x",)], "v string")
    assert one(spark, df.select(parse_number("v", "int", "null").alias("n")), "n") == [12, None]
    with pytest.raises(Exception):
        df.select(parse_number("v", "int", "fail").alias("n")).collect()
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:  # fails without ANSI mode too
        with pytest.raises(Exception, match="cannot parse as int"):
            df.select(parse_number("v", "int", "fail").alias("n")).collect()
        good = spark.createDataFrame([("12",), (None,)], "v string")
        assert one(spark, good.select(parse_number("v", "int", "fail").alias("n")), "n") == [12, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_widths(spark):
    df = spark.createDataFrame([("abcdef",)], "s string")
    assert enforce_widths(df, {"s": 3}).first().s == "abc"
    assert df.select(truncate_width("s", 4).alias("s")).first().s == "abcd"
    with pytest.raises(Exception):
        enforce_widths(df, {"s": 3}, mode="fail").collect()


def test_create_drop_tables_idempotent(spark):
    import uuid

    from starweave.session import scratch_path
    from starweave.sources.schemas import STAR, create_all, drop_all

    names = {f"{n}_{uuid.uuid4().hex[:8]}": s for n, s in STAR.items()}
    loc = scratch_path(spark, "catalog_test")
    assert create_all(spark, names, location=loc) == list(names)
    create_all(spark, names, location=loc)  # second run is a no-op
    for name, schema in names.items():
        assert [f.name for f in spark.table(name).schema.fields] == [f.name for f in schema.fields]
    drop_all(spark, list(names))
    drop_all(spark, list(names))
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_readers(spark):
    from starweave.session import scratch_path
    from starweave.sources.readers import read_json, read_json_mapped, templated_path, with_lineage
    from starweave.sources.schemas import LOG_MAPPING
    from pyspark.sql import types as T

    path = scratch_path(spark, "log_json")
    spark.createDataFrame(
        [("A", "NextSong", 1541106106796, "12", "x"), ("B", "Home", 1541106106797, "bad", "y")],
        "artist string, page string, ts bigint, userId string, song string",
    ).coalesce(1).write.json(templated_path("{p}/2018/11", p=path))
    with pytest.raises(Exception, match="userId is not a int"):
        read_json_mapped(spark, path + "/2018/11", LOG_MAPPING).collect()
    back = read_json_mapped(spark, path + "/2018/11", LOG_MAPPING, on_error="null")
    assert back.columns == [c for _, c, _ in LOG_MAPPING]
    assert sorted((r.artist, r.userid) for r in back.collect()) == [("A", 12), ("B", None)]
    nested = read_json(spark, path, T.StructType([T.StructField("artist", T.StringType())]), recursive=True,
                       glob_filter="*.json")
    files = {r.source_file.rsplit("/", 3)[-3] for r in with_lineage(nested).collect()}
    assert files == {"2018"}


def test_reader_error_modes(spark):
    from pyspark.sql import types as T

    from starweave.session import scratch_path
    from starweave.sources.readers import REJECTED, read_csv, read_json

    path = scratch_path(spark, "broken")
    lines = ['{"k": 1, "v": "a"}', '{"k": 2, "v', '{"k": "x", "v": "b"}', "{}"]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        read_json(spark, path, T.StructType.fromDDL("k int, v string")).collect()
    kept = read_json(spark, path, T.StructType.fromDDL("k int, v string"), on_error="null")
    assert kept.count() == 4
    split = read_json(spark, path, T.StructType.fromDDL("k int, v string"), on_error="reject").collect()
    assert sorted(r[REJECTED] for r in split if r[REJECTED]) == sorted([lines[1], lines[2]])
    assert {(r.k, r.v) for r in split if r[REJECTED] is None} == {(1, "a"), (None, None)}
    path = scratch_path(spark, "broken-csv")
    spark.createDataFrame([("1,a",), ("z,b",)], "value string").write.text(path)
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        read_csv(spark, path, T.StructType.fromDDL("k int, v string"), header=False).collect()
    split = read_csv(spark, path, T.StructType.fromDDL("k int, v string"), header=False, on_error="reject").collect()
    assert {(r.k, r[REJECTED]) for r in split} == {(1, None), (None, "z,b")}


@pytest.mark.parametrize("width", [1, 2, 3, 4, 5, 7, 11])
def test_byte_widths_cut_at_whole_characters(spark, width):
    from starweave.functions.text import truncate_width
    from starweave.sources.readers import enforce_widths

    texts = ["", "a", "abcdefghijklmnop", "äöü", "aä€😀", "😀😀", "€€€€", "a" * 10 + "😀", "x😀y", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def cut(t):
        if t is None:
            return None
        out = ""
        for c in t:
            if len((out + c).encode()) > width:
                break
            out += c
        return out

    got = [r.c for r in df.select(truncate_width("t", width, "bytes").alias("c")).collect()]
    assert got == [cut(t) for t in texts]
    narrow = enforce_widths(df, {"t": width}, unit="bytes")
    assert [r.t for r in enforce_widths(narrow, {"t": width}, "fail", "bytes").collect()] == got
    with pytest.raises(Exception, match="value too long"):
        enforce_widths(df, {"t": width}, "fail", "bytes").collect()
    with pytest.raises(ValueError):
        truncate_width("t", width, "words")
