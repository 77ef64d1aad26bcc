"""Quality checks and the capstone builders on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starweave.operators import DataQualityError, TableChecks, assert_passed, report
from starweave.operators.quality import column_type_ok, duplicate_keys, fk_report
from starweave.plans.lookup import build_query_table, lookup, merge_event_files
from starweave.plans.travel import (
    ADDRESS_LABELS,
    MODE_LABELS,
    attach_labels,
    build_airports,
    build_immigration,
    build_state,
    build_temperature,
    label_table,
)
from starweave.session import scratch_path
from starweave.sources.schemas import AIRPORT, STATE, TEMPERATURE


def _checks(df):
    return {(r.column_name, r.check_name): r.passed for r in df.collect()}


def test_quality_failures(spark):
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    nul = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert _checks(report([TableChecks("t", dup, key=["k"])]))[("k", "unique")] is False
    assert _checks(report([TableChecks("t", nul, key=["k"])]))[("k", "not_null")] is False
    assert _checks(report([TableChecks("t", empty, key=["k"])]))[("*", "min_rows")] is False
    with pytest.raises(DataQualityError):
        assert_passed(report([TableChecks("t", dup, key=["k"])]))
    assert_passed(report([TableChecks("t", nul.where("k is not null"), key=["k"], expected_rows=1)]))
    assert [tuple(r) for r in duplicate_keys(dup, ["k"]).collect()] == [(1, 2)]


def test_fk_and_types(spark):
    fact = spark.createDataFrame([(1,), (3,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "pk int")
    r = fk_report("f", fact, "fk", dim, "pk").first()
    assert (r.value, r.passed) == (1, False)
    assert column_type_ok(dim, "pk", "int") and not column_type_ok(dim, "pk", "date")


def test_state_and_temperature(spark):
    state = spark.createDataFrame([("California", "Calif.", "CA"), ("California", "Calif.", "CA"),
                                   ("Texas", "Tex.", "TX")], STATE)
    st, checks = build_state(state, expected_rows=2)
    assert st.count() == 2 and all(r.passed for r in checks.collect())
    temps = spark.createDataFrame([
        ("NA", "US", "California", "LA", "1", "2", "2015", "60.5"),
        ("NA", "US", "California", "LA", "1", "2", "2015", "60.5"),  # duplicate
        ("NA", "US", "Texas", "Austin", "0", "1", "2016", "-99"),    # bad date, missing value
        ("NA", "US", "Nowhere", "X", "1", "1", "2016", "1"),         # unknown state
        ("NA", "CA", "Texas", "Y", "1", "1", "2016", "1"),           # not US
        ("NA", "US", "Texas", "Z", "1", "1", "2014", "1"),           # too early
    ], TEMPERATURE)
    out = build_temperature(spark, temps, st).collect()
    assert len(out) == 2
    la = [r for r in out if r.city == "LA"][0]
    assert (la.state_code, la.AvgTemperature, la.date) == ("CA", 60.5, dt.date(2015, 1, 2))
    austin = [r for r in out if r.city == "Austin"][0]
    assert austin.date is None and austin.AvgTemperature == -99.0
    cleaned = build_temperature(spark, temps, st, missing_value=-99.0)
    assert [r.AvgTemperature for r in cleaned.where("city = 'Austin'").collect()] == [None]


def test_airports(spark):
    rows = [
        ("00A", "heliport", "Total", 11.0, "NA", "US", "US-PA", "Bensalem", "00A", None, "00A", "40.07, -74.93"),
        ("00A", "heliport", "Total", 11.0, "NA", "US", "US-PA", "Bensalem", "00A", None, "00A", "40.07, -74.93"),
        ("X1", "small", "Elsewhere", 5.0, "EU", "FR", "FR-IDF", "Paris", None, None, None, "1, 2"),
        ("ident", "type", "name", None, "continent", "iso_country", "iso_region", "municipality",
         "gps_code", "iata_code", "local_code", "coordinates"),  # header line read as data
    ]
    out = build_airports(spark.createDataFrame(rows, AIRPORT), order_by=["ident"]).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.state_code, r.latitude, r.longitude) == ("PA", 40.07, -74.93)
    assert "continent" not in out[0].asDict()


def test_immigration(spark):
    df = spark.createDataFrame(
        [(1.0, 20545.0, None, None, None), (1.0, 20545.0, None, None, None), (2.0, None, 20550.0, 1.0, "CA")],
        "cicid double, arrdate double, depdate double, i94mode double, i94addr string",
    )
    for c in ["i94yr", "i94mon", "i94cit", "i94res", "i94port", "i94bir", "i94visa", "dtadfile", "visapost",
              "occup", "entdepa", "entdepd", "entdepu", "matflag", "biryear", "dtaddto", "gender", "insnum",
              "airline", "admnum", "fltno", "visatype"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    fact, checks = build_immigration(spark, df, order_by=["arrival_date"])
    got = {r.cicid: (r.arrival_date, r.mode, r.state) for r in fact.collect()}
    assert got == {1.0: (dt.date(2016, 4, 1), "Not reported", "99"), 2.0: (None, "1.0", "CA")}
    assert all(r.passed for r in checks.collect())


def test_labels(spark):
    df = spark.createDataFrame([("CA",), ("ZZ",), (None,)], "addr string")
    lab = label_table(spark, ADDRESS_LABELS)
    got = [r.name for r in attach_labels(df, "addr", lab, "name", other_code="99").orderBy("addr").collect()]
    assert got == ["All Other Codes", "CALIFORNIA", "All Other Codes"]
    modes = spark.createDataFrame([(1,), (5,)], "m int")
    got = {r.m: r.label for r in attach_labels(modes, "m", label_table(spark, MODE_LABELS, "int"), "label").collect()}
    assert got == {1: "Air", 5: None}


def test_merge_events_and_lookup(spark):
    raw = scratch_path(spark, "raw_events")
    rows = [("A", "x", "F", 0, "L", 1.5, "free", "loc", 338, "s", 10),
            ("", "y", "M", 1, "K", 2.5, "paid", "loc", 338, "t", 10),
            ("B", "z", "M", 4, "K", 3.5, "paid", "loc", 338, "u", 11)]
    cols = "artist string, firstName string, gender string, itemInSession int, lastName string, length double, " \
           "level string, location string, sessionId int, song string, userId int"
    df = spark.createDataFrame(rows, cols)
    df.coalesce(1).write.option("header", "true").csv(raw + "/a")
    df.coalesce(1).write.option("header", "true").csv(raw + "/b")
    out = scratch_path(spark, "merged")
    merge_event_files(spark, raw, out, ["artist", "sessionId", "itemInSession", "song", "length"], "artist",
                      schema=df.schema)
    merged = spark.read.option("header", "true").schema(
        "artist string, sessionId int, itemInSession int, song string, length double").csv(out)
    assert merged.count() == 4  # two files, the empty artist dropped from each
    text = spark.read.text(out).where(~F.col("value").startswith('"artist"')).first().value
    assert text.startswith('"')  # every field quoted
    table = build_query_table(merged.withColumn("seq", F.lit(1)), ["sessionId"], ["itemInSession"],
                              ["sessionId", "itemInSession", "artist", "song", "length"], "seq")
    hit = lookup(table, ["itemInSession"], sessionId=338).collect()
    assert [r.itemInSession for r in hit] == [0, 4]
