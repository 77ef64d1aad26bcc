"""Loads over several batches that read and rewrite only what a batch touches, and
what goes with them: keys that continue, byte widths, arrival order, counts taken
while writing, skipped files, label maps, positions inside a partition."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starweave.operators.clean import first_per_key
from starweave.operators.loads import append_new, upsert, write_table
from starweave.operators.parts import create_ranges, merge_buckets, merge_ranges, read_parts
from starweave.operators.quality import TableChecks, write_checked
from starweave.operators.quality_state import Reference, in_periods, refresh, state_report, touched_values
from starweave.operators.sequences import extend_ids
from starweave.plans import lookup_queries, music_queries, roles  # noqa: F401  (their SQL is registered on import)
from starweave.plans.lookup import build_query_table
from starweave.plans.music import SONG_COLUMNS
from starweave.plans.registry import ORACLES, register
from starweave.plans.roles import Tables
from starweave.plans.travel import ADDRESS_LABELS, MODE_LABELS, build_demographics, decode_labels, label_table, load_immigration
from starweave.plans.travel_queries import _immigration_input, _immigration_sql, _values
from starweave.session import scratch_path
from starweave.sources.readers import enforce_widths, read_csv, read_json, read_parquet, with_arrival
from starweave.sources.schemas import DEMOGRAPHICS, table_schema

CUT = "1995-06-01"
BUCKETS = 16
#: Rows of a sorted file, which one task sorts and one task checks.
RANGE_ROWS = 1_000_000


def _before(column: str, day: str = CUT):
    return F.col(column) < F.lit(day).cast("timestamp_ntz")


# --- K15, Q6, Q8 --------------------------------------------------------------


@register(
    "dq_incremental",
    f"""
WITH f AS (SELECT l_partkey AS part, nullif(l_suppkey, 3) AS supp, l_orderkey AS ord FROM lineitem),
known AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
SELECT 'plays' AS table_name, '*' AS column_name, 'min_rows' AS check_name, COUNT(*) AS value, COUNT(*) >= 1 AS passed FROM f
UNION ALL SELECT 'plays', 'supp', 'not_null', COUNT(*), COUNT(*) = 0 FROM f WHERE supp IS NULL
UNION ALL SELECT 'plays', 'ord', 'not_null', COUNT(*), COUNT(*) = 0 FROM f WHERE ord IS NULL
UNION ALL SELECT 'plays', 'part', 'references=p_partkey', COUNT(*), COUNT(*) = 0 FROM f WHERE part NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
UNION ALL SELECT 'plays', 'supp', 'references=s_suppkey', COUNT(*), COUNT(*) = 0 FROM f WHERE supp NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
UNION ALL SELECT 'plays', 'ord', 'references=o_orderkey', COUNT(*), COUNT(*) = 0 FROM f WHERE ord NOT IN (SELECT o_orderkey FROM known)
""",
    "K15 Q1 Q2 Q6 Q8 J7 (state per period: two periods, then late rows of the first; one dimension grows)",
)
def dq_incremental(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact, state, parts = (scratch_path(spark, n) for n in ("plays", "plays-quality", "parts-dim"))
    plays = t.lineitem.select(
        F.col("l_partkey").alias("part"), F.nullif(F.col("l_suppkey"), F.lit(3)).alias("supp"),
        F.col("l_orderkey").alias("ord"), "l_shipdate", "l_returnflag", F.year("l_shipdate").alias("year"),
    )
    late = _before("l_shipdate") & (F.col("l_returnflag") == "R")
    small = t.part.where(F.col("p_size") <= 40).select("p_partkey")
    loads = [
        (plays.where(_before("l_shipdate") & ~late), small.where(F.col("p_partkey") % 2 == 0)),
        (plays.where(~_before("l_shipdate")), small),  # the dimension grows: orphans of the first period are found
        (plays.where(late), small),
    ]
    references = {
        "part": Reference("p_partkey", base=parts, buckets=BUCKETS),
        "supp": Reference("s_suppkey", dim=t.supplier.where("s_acctbal > 0")),
        "ord": Reference("o_orderkey", dim=t.orders.where("o_orderstatus <> 'P'")),
    }
    columns = {"part": "part", "supp": "supp", "ord": "ord"}
    for batch, dim in loads:
        merge_buckets(dim, parts, ["p_partkey"], "insert_absent", BUCKETS)
        write_table(batch, fact, mode="append", partition_by=["year"], rebalance=True)
        touched = touched_values(batch, ["year"])
        stored = spark.read.parquet(fact).where(in_periods(["year"], touched))
        refresh(stored, state, ["year"], columns, references)
    return state_report(spark, state, "plays", ["supp", "ord"], references=references)


# --- K8-K10 -------------------------------------------------------------------


@register("upsert_touched", ORACLES["users_upsert_level"], "K8 (users in key-hash directories; three loads, touched ones rewritten)")
def upsert_touched(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "users-buckets")
    early = roles.early_users(t)
    merge_buckets(early, base, ["user_id"], "insert_absent", BUCKETS, order_by="user_id")
    log = roles.user_log(t).select(F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
                                   F.col("lastName").alias("last_name"), "gender", "level", "ts", "o_orderkey")
    for batch in (log.where(_before("ts")), log.where(~_before("ts"))):
        merge_buckets(batch, base, ["user_id"], "upsert", BUCKETS, columns=early.columns, update_cols=["level"],
                      order_by=["ts", "o_orderkey"])
    return read_parts(spark, base)


@register("not_in_touched", ORACLES["songs_not_in"], "K10 F11 (NOT IN as a stored mode; the second load is delivered twice)")
def not_in_touched(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "songs-buckets")
    rows = roles.song_staging(t).select([F.col(src).alias(dst) for dst, src in SONG_COLUMNS.items()])
    early = roles.early_songs(t).select([F.col(src).alias(dst) for dst, src in SONG_COLUMNS.items()])
    for batch in (early, rows, rows):
        merge_buckets(batch, base, ["song_id"], "not_in", BUCKETS)
    return read_parts(spark, base)


# --- K11, K12 -----------------------------------------------------------------


@register("query_table_update", ORACLES["user_info_by_song"], "K11 K12 F6-F8 (later plays merged into the key ranges they fall in)")
def query_table_update(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "by-song")
    log = roles.play_log_with_keys(t).select("song", "userId", "level", "ts")
    cut = F.unix_millis(F.lit(CUT).cast("timestamp"))
    first = build_query_table(log.where(F.col("ts") < cut), ["song"], ["userId"], ["song", "userId", "level"], "ts")
    create_ranges(first, base, ["song"], ["userId"], ranges=BUCKETS)
    merge_ranges(log.where(F.col("ts") >= cut), base, ["song"], ["userId"], "ts")
    return read_parts(spark, base)


# --- K14 ----------------------------------------------------------------------


@register(
    "sequence_continues",
    f"""
WITH o AS (SELECT *, o_orderdate >= TIMESTAMP '{CUT}' AS second FROM orders),
k AS (SELECT o_custkey, min(second) AS second, arg_min(o_orderdate, (second, o_orderdate, o_orderkey)) AS d,
             arg_min(o_orderkey, (second, o_orderdate, o_orderkey)) AS ord FROM o GROUP BY o_custkey),
n AS (SELECT o_custkey, row_number() OVER (ORDER BY second, d, ord) AS user_key FROM k)
SELECT n.user_key, o_orderkey, o.o_custkey FROM orders o JOIN n ON o.o_custkey = n.o_custkey
""",
    "K14 (ids of two periods without gaps; the second is delivered twice and changes nothing)",
)
def sequence_continues(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ids = scratch_path(spark, "customer-ids")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    first, second = orders.where(_before("o_orderdate")), orders.where(~_before("o_orderdate"))
    for batch in (first, second, second):
        extend_ids(batch, ids, ["o_custkey"], ["o_orderdate", "o_orderkey"], name="user_key")
    # all orders again: every key is known
    found = extend_ids(orders, ids, ["o_custkey"], ["o_orderdate", "o_orderkey"], name="user_key")
    return found.select("user_key", "o_orderkey", "o_custkey")


# --- S6, C7, E18 --------------------------------------------------------------


def _cut_sql(width: int) -> str:
    return f"left(text, list_max(list_filter(range(0, {width} + 1), lambda k: strlen(left(text, k::INT)) <= {width}))::INT)"


@register(
    "byte_widths",
    f"SELECT doc_id, {_cut_sql(7)} AS w7, {_cut_sql(50)} AS w50, left(text, 50) AS c50 FROM documents",
    "S6 C7 E18 (varchar(n) in UTF-8 bytes and in characters; no value is cut inside a character)",
)
def byte_widths(spark, sf_dir):
    t = Tables(spark, sf_dir)
    text = F.col("text")
    rows = t.documents.select("doc_id", text.alias("w7"), text.alias("w50"), text.alias("c50"))
    rows = enforce_widths(rows, {"w7": 7, "w50": 50}, unit="bytes")
    rows = enforce_widths(rows, {"c50": 50})
    # what was cut fits: a longer value would end the job
    return enforce_widths(rows, {"w7": 7, "w50": 50}, mode="fail", unit="bytes")


# --- K8, K9, K11, L3, A6 ------------------------------------------------------


@register("arrival_upsert", ORACLES["users_upsert_level"], "K8 L3 A6 (first and last by file and row alone)")
def arrival_upsert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders-in-order")
    # the files hold the log in its order; their rows carry no column used to order them below
    write_table(t.orders.orderBy("o_orderdate", "o_orderkey"), path, fmt="json",
                options={"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    log = with_arrival(read_json(spark, path, table_schema("orders")))
    rows = log.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("first_name"),
        F.year("o_orderdate").cast("string").alias("last_name"), F.month("o_orderdate").cast("string").alias("gender"),
        F.col("o_orderpriority").alias("level"), "_arrival",
    )
    return upsert(roles.early_users(t), rows, ["user_id"], ["level"], ["_arrival"])


@register("arrival_first", ORACLES["users_first"], "A6 L3 K9 (first row of a key by parquet file and row number)")
def arrival_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "users-in-order")
    log = roles.user_log(t).select(F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
                                   F.col("lastName").alias("last_name"), "gender", "level", "ts", "o_orderkey")
    write_table(log.orderBy("ts", "o_orderkey").drop("ts", "o_orderkey"), path)
    rows = with_arrival(spark.read.parquet(path))
    return first_per_key(rows, ["user_id"], "_arrival").drop("_arrival")


# --- A1, Q1, Q4, Q5 (C10, C5) -------------------------------------------------


@register(
    "immigration_checks",
    f"""
WITH fact AS ({_immigration_sql()})
SELECT 'immigration' AS table_name, '*' AS column_name, 'min_rows' AS check_name, COUNT(*) AS value, COUNT(*) >= 1 AS passed FROM fact
UNION ALL SELECT 'immigration', 'arrival_date', 'type=date', 0, TRUE
UNION ALL SELECT 'immigration', 'departure_date', 'type=date', 0, TRUE
""",
    "C10 Q1 Q4 A1 (the load's checks, counted by its own write)",
)
def immigration_checks(spark, sf_dir):
    merged = _immigration_input(spark, sf_dir)
    return load_immigration(spark, merged, scratch_path(spark, "immigration"), order_by=["arrival_date"])


@register(
    "observed_checks",
    """
SELECT 'orders' AS table_name, '*' AS column_name, 'min_rows' AS check_name, COUNT(*) AS value, COUNT(*) >= 1 AS passed FROM orders
UNION ALL SELECT 'orders', '*', 'expected_rows', COUNT(*), FALSE FROM orders
UNION ALL SELECT 'orders', 'status', 'not_null', COUNT(*) FILTER (WHERE o_orderstatus = 'P'), COUNT(*) FILTER (WHERE o_orderstatus = 'P') = 0 FROM orders
""",
    "A1 Q1 Q2 Q5 (row and null counts taken by the writing tasks, behind a shuffle)",
)
def observed_checks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), F.year("o_orderdate").alias("year"))
    spec = TableChecks("orders", rows, key=["status"], unique=False, expected_rows=25)
    return write_checked(spec, scratch_path(spark, "orders-observed"), partition_by=["year"], rebalance=True)


# --- K5 -----------------------------------------------------------------------


@register("append_bloom", "SELECT * FROM orders", "K5 (files with a Bloom filter on the key; a small batch skips files without its keys)")
def append_bloom(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders-bloom")
    few = t.orders.where(F.col("o_orderdate") >= F.lit("1998-07-25").cast("timestamp_ntz"))
    rest = t.orders.where(F.col("o_orderdate") < F.lit("1998-07-25").cast("timestamp_ntz"))
    for batch in (rest, few, few, t.orders):
        append_new(batch, path, ["o_orderkey"], bloom="o_orderkey")
    return read_parquet(spark, path, schema=table_schema("orders"))


# --- X1 -----------------------------------------------------------------------


@register(
    "label_formats",
    f"""
SELECT o.o_orderkey, l.l_linenumber, country.n_name AS country, port.s_name AS port, m.label AS mode,
       COALESCE(a.label, 'All Other Codes') AS address
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation country ON country.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0 AND s_suppkey <= 660) port ON port.s_suppkey = l.l_suppkey
LEFT JOIN {_values(MODE_LABELS, False)} AS m(code, label) ON l.l_linenumber = m.code
LEFT JOIN {_values(ADDRESS_LABELS, True)} AS a(code, label) ON l.l_returnflag || 'L' = a.code
""",
    "X1 (country, port, mode and address codes from one table of formats, in one pass)",
)
def label_formats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "formats")
    named = lambda df, fmt, code, label: df.select(
        F.lit(fmt).alias("format"), F.col(code).cast("string").alias("code"), F.col(label).alias("label"))
    formats = (
        named(t.nation, "country", "n_nationkey", "n_name")
        # a port list has 660 entries
        .union(named(t.supplier.where("s_acctbal > 0 and s_suppkey <= 660"), "port", "s_suppkey", "s_name"))
        .union(named(label_table(spark, MODE_LABELS, "int"), "mode", "code", "label"))
        .union(named(label_table(spark, ADDRESS_LABELS), "address", "code", "label"))
    )
    write_table(formats, path)
    o, c, li = t.orders, t.customer, t.lineitem
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"])
    rows = rows.withColumn("addr", F.concat("l_returnflag", F.lit("L")))
    decoded = decode_labels(rows, read_parquet(spark, path), {
        "country": ("c_nationkey", "country"), "port": ("l_suppkey", "port"), "mode": ("l_linenumber", "mode"),
        "address": ("addr", "address", "99"),
    })
    return decoded.select("o_orderkey", "l_linenumber", "country", "port", "mode", "address")


# --- C8 -----------------------------------------------------------------------


@register(
    "demographics_full",
    """
SELECT DISTINCT c_name AS City, round(c_acctbal / 100, 1) AS Median_Age, CAST(c_custkey % 1000 AS INTEGER) AS Male_Population,
       CAST(c_custkey % 900 AS INTEGER) AS Female_Population, CAST(c_custkey % 1000 + c_custkey % 900 AS INTEGER) AS Total_Population,
       CASE WHEN c_custkey % 7 > 0 THEN CAST(c_custkey % 7 AS INTEGER) END AS Number_of_Veterans,
       CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 5 AS INTEGER) END AS Foreign_born,
       round(c_nationkey / 10.0::DOUBLE, 1) AS Average_Household_Size, left(c_mktsegment, 2) AS State_Code,
       c_mktsegment AS Race, c_nationkey AS Count
FROM customer
""",
    "C8 S8 P3 A5 (all twelve columns of the ';' CSV in their types; the state name goes, repeated rows too)",
)
def demographics_full(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "demographics")
    key, whole = F.col("c_custkey"), lambda c: c.cast("int")
    source = t.customer.select(
        F.col("c_name").alias("City"), F.concat(F.lit("State; of "), F.col("c_nationkey").cast("string")).alias("State"),
        F.round(F.col("c_acctbal") / 100, 1).alias("Median_Age"), whole(key % 1000).alias("Male_Population"),
        whole(key % 900).alias("Female_Population"), whole(key % 1000 + key % 900).alias("Total_Population"),
        whole(F.nullif(key % 7, F.lit(0))).alias("Number_of_Veterans"), whole(F.nullif(key % 5, F.lit(0))).alias("Foreign_born"),
        F.round(F.col("c_nationkey") / 10, 1).alias("Average_Household_Size"), F.substring("c_mktsegment", 1, 2).alias("State_Code"),
        F.col("c_mktsegment").alias("Race"), F.col("c_nationkey").alias("Count"),
    )
    write_table(source.unionByName(source), path, fmt="csv", options={"header": "true", "sep": ";"})
    return build_demographics(read_csv(spark, path, schema=DEMOGRAPHICS, header=True, sep=";"))


# --- C12 ----------------------------------------------------------------------


def _named_log(t: Tables):
    """The play log with its users' names: the supplier's name and nation."""
    names = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    names = names.select(F.col("s_suppkey").alias("userId"), F.col("s_name").alias("firstName"), F.col("n_name").alias("lastName"))
    return roles.play_log_with_keys(t).join(names, "userId", "left")


NAMED = f"""
WITH {lookup_queries.LOG_SQL.strip()},
named AS (SELECT log.*, s_name AS firstName, n_name AS lastName
          FROM log LEFT JOIN supplier ON s_suppkey = userId LEFT JOIN nation ON n_nationkey = s_nationkey)
"""


@register(
    "song_info_by_user_named",
    NAMED + """
SELECT userId, sessionId, itemInSession, artist, song, firstName, lastName FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, sessionId, itemInSession ORDER BY ts DESC, artist DESC, song DESC) AS rn
    FROM named) WHERE rn = 1
""",
    "C12 K11 K12 (with the user's first and last name)",
)
def song_info_by_user_named(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_query_table(_named_log(t), ["userId", "sessionId"], ["itemInSession"],
                             ["userId", "sessionId", "itemInSession", "artist", "song", "firstName", "lastName"], "ts")


@register(
    "user_info_by_song_named",
    NAMED + """
SELECT song, userId, firstName, lastName FROM (
    SELECT *, row_number() OVER (PARTITION BY song, userId ORDER BY ts DESC) AS rn FROM named) WHERE rn = 1
""",
    "C12 K11 K12 A8 (who listened to a song: first and last name)",
)
def user_info_by_song_named(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return build_query_table(_named_log(t), ["song"], ["userId"], ["song", "userId", "firstName", "lastName"], "ts")


# --- L5 -----------------------------------------------------------------------


@register(
    "sorted_layout_files",
    """
SELECT COUNT(*) AS n_rows, MIN(o_orderdate) AS low, MAX(o_orderdate) AS high, TRUE AS several_files,
       CAST(0 AS BIGINT) AS overlapping_files, CAST(0 AS BIGINT) AS rows_out_of_order FROM orders
""",
    "L5 (file minima and maxima do not overlap and rows are in order inside files; fails without the sort)",
)
def sorted_layout_files(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders-sorted")
    # as many ranges as the rows need, one file each: a task sorts one range. Days with many rows are cut by key
    ranges = max(8, -(-t.orders.count() // RANGE_ROWS))
    write_table(t.orders.repartitionByRange(ranges, "o_orderdate", "o_orderkey"), path, sort_within=["o_orderdate"])
    rows = with_arrival(read_parquet(spark, path, schema=table_schema("orders")))
    rows = rows.select("_arrival.file", "_arrival.row", "o_orderdate")
    # a given number of partitions, so that small compressed ones are not merged into one that is large in
    # memory; more than there are files, so that few share a task
    rows = rows.repartition(4 * ranges, "file")
    before = F.lag("o_orderdate").over(Window.partitionBy("file").orderBy("row"))
    files = rows.withColumn("late", before > F.col("o_orderdate")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"),
        F.count_if("late").alias("late"),
    )
    # a file starts where the one before it ends, or behind
    last = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("over", last > F.col("low")).agg(
        F.sum("n").alias("n_rows"), F.min("low").alias("low"), F.max("high").alias("high"),
        (F.count(F.lit(1)) > 1).alias("several_files"), F.count_if("over").alias("overlapping_files"),
        F.sum("late").alias("rows_out_of_order"),
    )
