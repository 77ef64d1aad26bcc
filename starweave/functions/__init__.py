"""Column -> Column built-ins used by the operators."""

from starweave.functions.text import (
    ifnull_text,
    md5_key,
    parse_number,
    split_item,
    to_decimal18,
    to_double,
    truncate_width,
)
from starweave.functions.time import (
    date_from_parts,
    millis_to_date,
    millis_to_second,
    millis_to_timestamp,
    sas_to_date,
    start_time,
    time_parts,
    to_epoch_millis,
    weekday,
)

__all__ = [
    "date_from_parts",
    "ifnull_text",
    "md5_key",
    "millis_to_date",
    "millis_to_second",
    "millis_to_timestamp",
    "parse_number",
    "sas_to_date",
    "split_item",
    "start_time",
    "time_parts",
    "to_decimal18",
    "to_double",
    "to_epoch_millis",
    "truncate_width",
    "weekday",
]
