"""Operators: cleaning, joins, load modes and quality checks."""

from starweave.operators.clean import (
    dedupe,
    distinct_rows,
    drop_columns,
    first_per_key,
    keep_where,
    nonblank,
    project,
    with_columns,
)
from starweave.operators.joins import (
    anti_join,
    natural_key_join,
    not_in,
    orphans,
)
from starweave.operators.loads import (
    append,
    append_new,
    dense_ids,
    insert_absent,
    insert_by_position,
    insert_not_in,
    keyed_overwrite,
    query_layout,
    read_if_exists,
    truncate_insert,
    upsert,
    write_table,
)
from starweave.operators.parts import create_ranges, merge_buckets, merge_ranges, read_parts
from starweave.operators.quality import (
    DataQualityError,
    TableChecks,
    assert_passed,
    column_type_ok,
    duplicate_keys,
    fk_report,
    report,
    table_report,
    write_checked,
)
from starweave.operators.quality_state import Reference, refresh, state_report
from starweave.operators.sequences import extend_ids
from starweave.operators.versions import publish, read_current, truncate_load

__all__ = [
    "DataQualityError",
    "Reference",
    "TableChecks",
    "anti_join",
    "append",
    "append_new",
    "assert_passed",
    "column_type_ok",
    "create_ranges",
    "dedupe",
    "dense_ids",
    "distinct_rows",
    "drop_columns",
    "duplicate_keys",
    "extend_ids",
    "first_per_key",
    "fk_report",
    "insert_absent",
    "insert_by_position",
    "insert_not_in",
    "keep_where",
    "keyed_overwrite",
    "merge_buckets",
    "merge_ranges",
    "natural_key_join",
    "nonblank",
    "not_in",
    "orphans",
    "project",
    "publish",
    "query_layout",
    "read_current",
    "read_if_exists",
    "read_parts",
    "refresh",
    "report",
    "state_report",
    "table_report",
    "truncate_insert",
    "truncate_load",
    "upsert",
    "with_columns",
    "write_checked",
    "write_table",
]
