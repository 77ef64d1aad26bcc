"""Queries whose input holds what an operator is there for: nulls, blanks, missing
values, codes without a label, and a partition with many rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from starweave.operators.clean import keep_where, nonblank
from starweave.operators.loads import query_layout
from starweave.operators.quality import TableChecks, report
from starweave.plans.lookup import lookup_positions
from starweave.plans.registry import register
from starweave.plans.roles import Tables
from starweave.plans.travel import attach_labels, build_state, build_temperature
from starweave.session import scratch_path


@register(
    "labels_from_table",
    """
SELECT c_custkey, c_nationkey,
       COALESCE(r_name, (SELECT r_name FROM region WHERE r_regionkey = 0)) AS label
FROM customer LEFT JOIN region ON r_regionkey = c_nationkey
""",
    "X1 (label list read as an input table; codes without a label take code 0's)",
)
def labels_from_table(spark, sf_dir):
    t = Tables(spark, sf_dir)
    labels = t.region.select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("label"))
    return attach_labels(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", labels, "label", other_code=0)


@register(
    "temperature_missing",
    """
SELECT DISTINCT c.c_mktsegment AS Country, CAST(n.n_nationkey AS VARCHAR) AS state_code, c.c_name AS city,
       CASE WHEN o.o_orderstatus <> 'P' THEN o.o_totalprice END AS AvgTemperature, CAST(o.o_orderdate AS DATE) AS date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE c.c_mktsegment = 'BUILDING' AND year(o.o_orderdate) >= 1998
""",
    "X2 K17 C6 (-99 is missing; the checked state dimension goes on to the join)",
)
def temperature_missing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o, c, d = t.orders, t.customer, F.col("o_orderdate")
    states = t.nation.select(F.col("n_name").alias("State"), F.col("n_name").alias("Abbrev"),
                             F.col("n_nationkey").cast("string").alias("Code"))
    state, _ = build_state(states.union(states), expected_rows=25)
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("State"))
    reading = F.when(F.col("o_orderstatus") == "P", "-99").otherwise(F.col("o_totalprice").cast("string"))
    temps = o.join(c, o["o_custkey"] == c["c_custkey"]).join(names, "c_nationkey").select(
        F.col("c_mktsegment").alias("Country"), "State", F.col("c_name").alias("City"),
        F.year(d).cast("string").alias("Year"), F.month(d).cast("string").alias("Month"),
        F.dayofmonth(d).cast("string").alias("Day"), reading.alias("AvgTemperature"),
    )
    return build_temperature(spark, temps, state, country="BUILDING", min_year="1998", missing_value=-99.0)


def _gappy(t: Tables):
    """events with null types, blank names and users that one column or the other lacks."""
    e = t.events
    return e.select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
        F.when(F.col("event_type") == "click", F.lit("")).otherwise(F.col("event_type")).alias("name"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("a"),
        F.when(F.col("value") > 10, F.col("value")).alias("b"),
    )


GAPPY = """
WITH g AS (
    SELECT event_id, nullif(event_type, 'error') AS kind,
           CASE WHEN event_type = 'click' THEN '' ELSE event_type END AS name,
           nullif(event_type, 'view') AS a, CASE WHEN value > 10 THEN value END AS b
    FROM events)
"""


@register(
    "filters_that_drop",
    GAPPY + "SELECT event_id, kind, name, a, b FROM g WHERE kind IS NOT NULL AND name <> '' AND (a IS NOT NULL OR b IS NOT NULL)",
    "F2 F3 F5 (nulls, blanks and rows without either value are there and go)",
)
def filters_that_drop(spark, sf_dir):
    rows = _gappy(Tables(spark, sf_dir))
    either = F.col("a").isNotNull() | F.col("b").isNotNull()
    return nonblank(keep_where(rows, F.col("kind").isNotNull(), either), "name")


@register(
    "dq_nulls_found",
    GAPPY
    + """
SELECT 'gappy' AS table_name, 'kind' AS column_name, 'not_null' AS check_name,
       COUNT(*) FILTER (WHERE kind IS NULL) AS value, COUNT(*) FILTER (WHERE kind IS NULL) = 0 AS passed FROM g
UNION ALL SELECT 'gappy', 'b', 'not_null', COUNT(*) FILTER (WHERE b IS NULL), COUNT(*) FILTER (WHERE b IS NULL) = 0 FROM g
""",
    "Q2 A2 F10 (the null check fails where there are nulls)",
)
def dq_nulls_found(spark, sf_dir):
    return report([TableChecks("gappy", _gappy(Tables(spark, sf_dir)), key=["kind", "b"], min_rows=None, unique=False)])


@register(
    "partition_in_order",
    """
WITH hot AS (SELECT user_id, event_type FROM events GROUP BY 1, 2 ORDER BY COUNT(*) DESC, 1, 2 LIMIT 1)
SELECT e.user_id, e.event_type, e.event_id, e.ts, row_number() OVER (ORDER BY e.ts, e.event_id) - 1 AS position
FROM events e JOIN hot ON e.user_id = hot.user_id AND e.event_type = hot.event_type
""",
    "F7 L4 K12 (the largest composite partition, its rows in clustering order with their position)",
)
def partition_in_order(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "by-user-and-type")
    laid = query_layout(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"])
    laid.write.parquet(path)
    stored = spark.read.parquet(path)
    hot = stored.groupBy("user_id", "event_type").count().orderBy(F.desc("count"), "user_id", "event_type").first()
    if hot is None:
        return stored.withColumn("position", F.lit(0).cast("long"))
    # one partition key's rows and their places, from as many tasks as files
    placed = lookup_positions(stored, ["ts", "event_id"], user_id=hot.user_id, event_type=hot.event_type)
    return placed.select("user_id", "event_type", "event_id", "ts", "position")
