"""Sources and sinks: write-and-read-back queries over whole driver tables.

Each query writes to a fresh folder under the shared ``spark.checkpoint.dir``
and returns the frame read back; the oracle is the original table.
(S1-S13, K1-K7, K13, L5, C7, C11, E18)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starweave.functions.text import split_item, to_double
from starweave.operators.loads import append, append_new, insert_by_position, write_table
from starweave.operators.versions import read_current, truncate_load
from starweave.plans.lookup import merge_event_files
from starweave.plans.music_queries import fact_left_md5, PLAYS, SECONDS
from starweave.plans.registry import register
from starweave.plans.roles import Tables
from starweave.session import scratch_path
from starweave.sources.readers import (
    REJECTED,
    TEXT_OPTIONS,
    enforce_widths,
    read_csv,
    read_json,
    read_json_mapped,
    read_parquet,
    read_table,
    templated_path,
    with_lineage,
)
from starweave.sources.schemas import STAR_KEYS, WIDTHS, create_all, drop_all, struct, table_schema

@register(
    "csv_quote_all",
    """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> ''
""",
    "C11 S10 F3 P6 K4 (merge many event CSV files into one quoted CSV)",
)
def csv_quote_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw = scratch_path(spark, "event_csv")
    # many raw files, each with its own header line
    write_table(t.events.repartition("event_id"), raw, fmt="csv",
                options={"header": "true", **TEXT_OPTIONS})
    merged = scratch_path(spark, "event_merged")
    merge_event_files(spark, raw, merged, ["event_id", "ts", "user_id", "event_type", "value"],
                      required="event_type", schema=table_schema("events"))
    out_schema = struct("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
    return read_csv(spark, merged, schema=out_schema, header=True)


@register(
    "json_mapped",
    """
SELECT event_id AS id, ts AS event_time, user_id AS userid, event_type AS page, value AS amount
FROM events
""",
    "S2 S4 K7 (JSON lines through an ordered field mapping)",
)
def json_mapped(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "events_json")
    write_table(t.events, path, fmt="json", options=TEXT_OPTIONS)
    mapping = [
        ("event_id", "id", "bigint"),
        ("ts", "event_time", "timestamp_ntz"),
        ("user_id", "userid", "bigint"),
        ("event_type", "page", "string"),
        ("value", "amount", "double"),
    ]
    return read_json_mapped(spark, path, mapping)


@register(
    "json_auto_truncate",
    """
SELECT doc_id, left(text, list_max(list_filter(range(0, 257), lambda k: strlen(left(text, k::INT)) <= 256))::INT) AS text,
       md5(text) AS text_md5, lang, source, n_chars FROM documents
""",
    "S1 S3 S5 S6 C7 E18 (nested JSON folders, by-name load, truncatecolumns; the warehouse counts bytes)",
)
def json_auto_truncate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "documents_json")
    # nested layout lang=../source=../*.json, read through a directory glob
    # like song_data/*/*/*.json; basePath keeps the directory values
    write_table(t.documents, path, fmt="json", partition_by=["lang", "source"], rebalance=True,
                options=TEXT_OPTIONS)
    # by-name load ('auto'): only declared fields are read, in any file order
    schema = struct("text string, n_chars bigint, doc_id bigint")
    back = read_json(spark, f"{path}/*/*/*.json", schema, options={"basePath": path})
    # the whole text came back intact (its digest), then the varchar(256) load
    back = back.select("doc_id", "text", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")
    return enforce_widths(back, {"text": 256, "lang": 256, "source": 256}, mode="truncate", unit="bytes")


@register(
    "json_recursive_lineage",
    """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT event_type) AS n_dirs, CAST(SUM(value * 100) AS BIGINT) AS value_cents
FROM events
""",
    "S3 (recursive file discovery by suffix, file lineage kept)",
)
def json_recursive_lineage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "events_tree")
    write_table(t.events, path, fmt="json", partition_by=["event_type"], rebalance=True, options=TEXT_OPTIONS)
    schema = struct("event_id bigint, value double")
    back = with_lineage(read_json(spark, path, schema, recursive=True, glob_filter="*.json"))
    folder = F.regexp_extract(F.col("source_file"), "event_type=([^/]+)/", 1)
    return back.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(folder).alias("n_dirs"),
        F.sum(F.round(F.col("value") * 100).cast("decimal(20,0)")).cast("bigint").alias("value_cents"),
    )


@register(
    "csv_header",
    """
SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
FROM nation
""",
    "C5 S7 K3 A5 (CSV with header, strings only, duplicates dropped)",
)
def csv_header(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "nation_csv")
    write_table(t.nation.unionByName(t.nation), path, fmt="csv", options={"header": "true"})
    return read_csv(spark, path, header=True).dropDuplicates()


@register(
    "csv_semicolon_schema",
    """
SELECT DISTINCT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
FROM customer
""",
    "C8 S8 P3 A5 (';' CSV, names from the declared schema by position)",
)
def csv_semicolon_schema(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "customer_csv")
    write_table(t.customer, path, fmt="csv", options={"header": "true", "sep": ";"})
    schema = struct("id bigint, name string, nation int, balance double, segment string")
    return read_csv(spark, path, schema=schema, header=True, sep=";").drop("nation").dropDuplicates()


@register(
    "csv_noheader",
    """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(string_split(s_name, '#')[2] AS DOUBLE) AS serial
FROM supplier
""",
    "C9 S9 F4 A6 E13 E12 (no header option: header row filtered out)",
)
def csv_noheader(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "supplier_csv")
    write_table(t.supplier, path, fmt="csv", options={"header": "true"})
    # the header line stays as a row; it does not fit the declared types
    back = read_csv(spark, path, schema=table_schema("supplier"), header=False, on_error="null")
    # the header line came back as a row with null numbers; the key filter drops it
    kept = back.where(F.col("s_suppkey").isNotNull()).dropDuplicates(["s_suppkey"])
    return kept.withColumn("serial", to_double(split_item("s_name", "#", 1)))


@register(
    "parquet_partitioned",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders
""",
    "K1 K2 S11 (parquet partitioned by year, month)",
)
def parquet_partitioned(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders_by_month")
    dated = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    write_table(dated, path, partition_by=["year", "month"], rebalance=True)
    return read_parquet(spark, path)


@register(
    "parquet_partition_read",
    """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders WHERE year(o_orderdate) = 1998
""",
    "S13 (source path templated by run context: one period reloaded)",
)
def parquet_partition_read(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "orders_by_year")
    dated = t.orders.withColumn("year", F.year("o_orderdate"))
    write_table(dated, base, partition_by=["year"], rebalance=True)
    # reload one period: path built from a run context; the partition value
    # comes back from the directory through basePath
    path = templated_path("{base}/year={year}", base=base, year=1998)
    back = spark.read.option("basePath", base).parquet(path)
    return back.select("o_orderkey", "o_totalprice", "year")


@register(
    "parquet_merge_schema",
    """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""",
    "S11 (parquet files with different columns, schema merged, missing -> null)",
)
def parquet_merge_schema(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "orders_merge")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    write_table(t.orders.where(cut).select("o_orderkey", "o_custkey", "o_totalprice"), f"{base}/part=a")
    write_table(t.orders.where(~cut).select("o_orderkey", "o_custkey", "o_orderpriority"), f"{base}/part=b")
    back = read_parquet(spark, base, merge_schema=True)
    return back.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@register(
    "sorted_layout",
    "SELECT * FROM orders",
    "L5 (sort key on load: rows sorted inside files for min/max skipping)",
)
def sorted_layout(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders_sorted")
    write_table(t.orders.repartitionByRange("o_orderdate"), path, sort_within=["o_orderdate"])
    return read_parquet(spark, path, schema=table_schema("orders"))


@register(
    "dim_append",
    "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
    "K5 (append; a rerun appends the same rows again)",
)
def dim_append(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "supplier_append")
    append(t.supplier, path)
    append(t.supplier, path)
    return read_parquet(spark, path, schema=table_schema("supplier"))


@register(
    "dim_truncate",
    "SELECT s_name, s_suppkey, s_acctbal, s_nationkey FROM supplier",
    "K6 K7 (truncate + insert in target column order; rerun unchanged)",
)
def dim_truncate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "supplier_truncate")
    order = ["s_name", "s_suppkey", "s_acctbal", "s_nationkey"]
    for _ in range(2):  # each load is one switch to a fresh version
        truncate_load(t.supplier, path, columns=order)
    return read_current(spark, path)


@register(
    "append_new",
    "SELECT * FROM orders",
    "K5 made idempotent (append rows whose key is not stored yet; run twice)",
)
def append_new_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "orders_append_new")
    early = t.orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    append_new(early, path, ["o_orderkey"])
    append_new(t.orders, path, ["o_orderkey"])
    append_new(t.orders, path, ["o_orderkey"])
    return read_parquet(spark, path, schema=table_schema("orders"))


@register(
    "catalog_insert_by_position",
    f"""
WITH {PLAYS},
f AS (SELECT *, {SECONDS} AS start_time FROM plays)
SELECT md5(CAST(f.session_id AS VARCHAR) || CAST(f.start_time AS VARCHAR)) AS songplay_id,
       f.start_time, f.user_id, f.level, s.song_id, s.artist_id, f.session_id,
       f.location, f.user_agent
FROM f LEFT JOIN songs s
  ON f.song = s.title AND f.artist = s.artist_name AND f.length = s.duration
""",
    "K13 K6 S12 (typed tables with widths and NOT NULL keys: create, insert by position, read by name, drop)",
)
def catalog_insert_by_position(spark, sf_dir):
    import uuid

    fact = fact_left_md5(spark, sf_dir)
    name = f"songplays_{uuid.uuid4().hex[:12]}"
    location = scratch_path(spark, "catalog")
    typed = dict(location=location, widths={name: WIDTHS["songplays"]}, keys={name: STAR_KEYS["songplays"]})
    for _ in range(2):  # idempotent
        create_all(spark, {name: fact.schema}, **typed)
    insert_by_position(fact, name)
    loaded = read_table(spark, name).schema
    drop_all(spark, [name])  # the catalog entry; the files under location stay
    return spark.read.schema(loaded).parquet(f"{location}/{name}")


@register(
    "json_rejects",
    """
SELECT doc_id, lang, source, n_chars, NULL AS rejected FROM documents WHERE source IS DISTINCT FROM 'src1'
UNION ALL
SELECT NULL, NULL, NULL, NULL, substr('{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"lang":"' || lang || '"', 1, 14)
FROM documents WHERE source = 'src1'
""",
    "S4 S5 (broken lines go to the rejects, none becomes a row of nulls)",
)
def json_rejects(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents.drop("text")
    whole = F.to_json(F.struct("doc_id", "lang", "source", "n_chars"))
    line = F.when(F.col("source") == "src1", F.substring(whole, 1, 14)).otherwise(whole)
    path = scratch_path(spark, "broken-lines")
    docs.select(line.alias("value")).write.text(path)
    read = read_json(spark, path, docs.schema, on_error="reject")
    return read.select("doc_id", "lang", "source", "n_chars", F.col(REJECTED).alias("rejected"))


@register(
    "json_mapped_rejects",
    """
SELECT CASE WHEN source IN ('src1', 'src2') THEN NULL ELSE doc_id END AS id,
       CASE WHEN source IN ('src1', 'src2') THEN NULL ELSE n_chars END AS chars,
       CASE WHEN source = 'src1' THEN left('{"doc_id":"' || CAST(doc_id AS VARCHAR) || '"', 11)
            WHEN source = 'src2' THEN '{"doc_id":"' || CAST(doc_id AS VARCHAR) || '","n_chars":"many"}' END AS rejected
FROM documents
""",
    "S4 (mapped load with rejects: broken lines, and values that do not cast)",
)
def json_mapped_rejects(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    chars = F.when(F.col("source") == "src2", F.lit("many")).otherwise(F.col("n_chars").cast("string"))
    whole = F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), chars.alias("n_chars"), "lang"))
    line = F.when(F.col("source") == "src1", F.substring(whole, 1, 11)).otherwise(whole)
    path = scratch_path(spark, "mapped-lines")
    docs.select(line.alias("value")).write.text(path)
    mapping = [("doc_id", "id", "bigint"), ("n_chars", "chars", "bigint")]
    return read_json_mapped(spark, path, mapping, on_error="reject").withColumnRenamed(REJECTED, "rejected")
