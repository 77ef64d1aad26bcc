"""Data-quality report queries."""

from __future__ import annotations

from starweave.operators.quality import TableChecks, duplicate_keys, report, table_report
from starweave.plans.music_queries import fact_left_md5
from starweave.plans.registry import ORACLES, register
from starweave.plans.roles import Tables


def _check_sql(table: str, key: list[str], source: str, expected: int | None = None,
               types: list[tuple[str, bool]] = (), min_rows: bool = True, not_null: bool = True,
               unique: bool = True) -> str:
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in key)
    parts = []
    if min_rows:
        parts.append(
            f"SELECT '{table}' AS table_name, '*' AS column_name, 'min_rows' AS check_name, "
            f"COUNT(*) AS value, COUNT(*) >= 1 AS passed FROM {source}"
        )
    if expected is not None:
        parts.append(
            f"SELECT '{table}' AS table_name, '*' AS column_name, 'expected_rows' AS check_name, "
            f"COUNT(*) AS value, COUNT(*) = {expected} AS passed FROM {source}"
        )
    for k in key if not_null else []:
        parts.append(
            f"SELECT '{table}' AS table_name, '{k}' AS column_name, 'not_null' AS check_name, "
            f"COUNT(*) FILTER (WHERE {k} IS NULL) AS value, "
            f"COUNT(*) FILTER (WHERE {k} IS NULL) = 0 AS passed FROM {source}"
        )
    if key and unique:
        cols = ", ".join(key)
        excess = f"(COUNT(*) FILTER (WHERE {keyed}) - COUNT(DISTINCT ({cols})) FILTER (WHERE {keyed}))"
        parts.append(
            f"SELECT '{table}' AS table_name, '{','.join(key)}' AS column_name, 'unique' AS check_name, "
            f"{excess} AS value, {excess} = 0 AS passed FROM {source}"
        )
    for name, ok in types:
        parts.append(f"SELECT '{table}' AS table_name, '{name.split('=')[0]}' AS column_name, "
                     f"'type={name.split('=')[1]}' AS check_name, CAST({0 if ok else 1} AS BIGINT) AS value, "
                     f"{str(ok).upper()} AS passed")
    return "\nUNION ALL\n".join(parts)


DQ_SQL = "\nUNION ALL\n".join([
    _check_sql("orders", ["o_orderkey"], "orders",
               types=[("o_orderdate=timestamp_ntz", True), ("o_orderkey=int", False)]),
    _check_sql("lineitem", ["l_orderkey", "l_linenumber"], "lineitem"),
    _check_sql("customer", ["c_custkey"], "customer"),
    _check_sql("nation", ["n_nationkey"], "nation", expected=25),
    _check_sql("events", ["event_id"], "events"),
])


@register("dq_report", DQ_SQL, "Q1 Q2 Q3 Q4 Q5 Q6 A1 A2 K15 (one aggregate pass per table)")
def dq_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return report([
        TableChecks("orders", t.orders, key=["o_orderkey"],
                    types={"o_orderdate": "timestamp_ntz", "o_orderkey": "int"}),
        TableChecks("lineitem", t.lineitem, key=["l_orderkey", "l_linenumber"]),
        TableChecks("customer", t.customer, key=["c_custkey"]),
        TableChecks("nation", t.nation, key=["n_nationkey"], expected_rows=25),
        TableChecks("events", t.events, key=["event_id"]),
    ])


FK_SQL = """
SELECT 'lineitem' AS table_name, 'l_orderkey' AS column_name, 'references=o_orderkey' AS check_name,
       COUNT(*) AS value, COUNT(*) = 0 AS passed
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'documents', 'doc_id', 'references=doc_id', COUNT(*), COUNT(*) = 0
FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT 'events', 'user_id', 'references=c_custkey', COUNT(*), COUNT(*) = 0
FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)
"""


@register("dq_fk", FK_SQL, "Q8 J7 K15 (foreign keys implied by REFERENCES)")
def dq_fk(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return report([], fks=[
        ("lineitem", t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
        ("documents", t.documents, "doc_id", t.labels, "doc_id"),
        ("events", t.events, "user_id", t.customer, "c_custkey"),
    ])


@register(
    "dq_duplicate_keys",
    """
SELECT l_orderkey, l_linenumber, CAST(SUM(1) AS BIGINT) AS count_total FROM lineitem
GROUP BY 1, 2 HAVING SUM(1) > 1
""",
    "Q3 A3 F12 (keys seen more than once, with their counts)",
)
def dq_duplicate_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register(
    "dq_fact_checks",
    f"""
WITH f AS ({ORACLES["fact_left_md5"]})
SELECT 'songplays' AS table_name, '*' AS column_name, 'min_rows' AS check_name, COUNT(*) AS value,
       COUNT(*) >= 1 AS passed FROM f
UNION ALL SELECT 'songplays', 'songplay_id', 'not_null', COUNT(*) FILTER (WHERE songplay_id IS NULL),
       COUNT(*) FILTER (WHERE songplay_id IS NULL) = 0 FROM f
UNION ALL SELECT 'songplays', 'songplay_id', 'unique',
       COUNT(songplay_id) - COUNT(DISTINCT songplay_id), COUNT(songplay_id) - COUNT(DISTINCT songplay_id) = 0 FROM f
""",
    "Q1-Q3 on the loaded fact: md5(session || second) keys collide",
)
def dq_fact_checks(spark, sf_dir):
    fact = fact_left_md5(spark, sf_dir)
    return report([TableChecks("songplays", fact.select("songplay_id"), key=["songplay_id"])])


# The check families one at a time over the star's source tables
# (SURVEY 7.3: dq_counts, dq_nulls, dq_duplicates, dq_types, dq_expected).

SINGLE_TABLES = [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]),
                 ("customer", ["c_custkey"]), ("events", ["event_id"])]


def _only(spark, sf_dir, **flags):
    t = Tables(spark, sf_dir)
    return report([TableChecks(name, getattr(t, name), key=key, **flags) for name, key in SINGLE_TABLES])


def _only_sql(**flags) -> str:
    return "\nUNION ALL\n".join(_check_sql(name, key, name, **flags) for name, key in SINGLE_TABLES)


@register("dq_counts", _only_sql(not_null=False, unique=False), "Q1 A1 (not empty)")
def dq_counts(spark, sf_dir):
    return _only(spark, sf_dir, not_null=False, unique=False)


@register("dq_nulls", _only_sql(min_rows=False, unique=False), "Q2 A2 F10 (key has no null)")
def dq_nulls(spark, sf_dir):
    return _only(spark, sf_dir, min_rows=None, unique=False)


@register("dq_duplicates", _only_sql(min_rows=False, not_null=False), "Q3 (key is unique)")
def dq_duplicates(spark, sf_dir):
    return _only(spark, sf_dir, min_rows=None, not_null=False)


@register(
    "dq_types",
    _check_sql("orders", [], "orders", min_rows=False,
               types=[("o_orderdate=timestamp_ntz", True), ("o_totalprice=double", True), ("o_orderkey=int", False)]),
    "Q4 (columns have the expected types)",
)
def dq_types(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return table_report(TableChecks("orders", t.orders, min_rows=None, types={
        "o_orderdate": "timestamp_ntz", "o_totalprice": "double", "o_orderkey": "int"}))


@register(
    "dq_expected",
    _check_sql("nation", [], "nation", expected=25, min_rows=False)
    + "\nUNION ALL\n" + _check_sql("region", [], "region", expected=5, min_rows=False),
    "Q5 (row count equals the expected count)",
)
def dq_expected(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return report([TableChecks("nation", t.nation, min_rows=None, expected_rows=25),
                   TableChecks("region", t.region, min_rows=None, expected_rows=5)])
