"""String, cast and key functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double(col: Column | str) -> Column:
    """String -> double; unparsable input -> null (ANSI-safe)."""
    return _c(col).try_cast("double")


def parse_number(col: Column | str, to: str = "int", on_error: str = "null") -> Column:
    """Parse a string to a numeric type.

    ``on_error="fail"`` fails the job on the first value that does not
    parse, whatever the session's ANSI setting; ``on_error="null"`` maps bad
    values to null.
    """
    c = _c(col)
    parsed = c.try_cast(to)
    if on_error == "fail":
        bad = c.isNotNull() & parsed.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit(f"cannot parse as {to}: "), c.cast("string")))) \
            .otherwise(parsed)
    if on_error == "null":
        return parsed
    raise ValueError("on_error must be 'fail' or 'null'")


def split_item(col: Column | str, sep: str, index: int) -> Column:
    """``split(x, sep)[index]`` with null for a missing item.

    The separator is matched literally; ``get`` returns null out of range
    where ``[i]`` would fail under ANSI.
    """
    return F.get(F.split(_c(col), "\\Q" + sep + "\\E"), index)


def ifnull_text(col: Column | str, default: str) -> Column:
    """``IFNULL(x, 'text')`` for any type, rendered as string."""
    return F.coalesce(_c(col).cast("string"), F.lit(default))


def md5_key(*cols: Column | str) -> Column:
    """``md5(a || b || ...)``; a null part gives a null key like ``||``."""
    return F.md5(F.concat(*[_c(c).cast("string") for c in cols]))


#: What a ``varchar(n)`` counts: code points (row stores) or UTF-8 bytes (column-store warehouses).
WIDTH_UNITS = ("chars", "bytes")


def width_of(col: Column | str, unit: str = "chars") -> Column:
    """Length of a string in code points or UTF-8 bytes."""
    if unit not in WIDTH_UNITS:
        raise ValueError(f"unit: one of {WIDTH_UNITS}")
    return F.length(_c(col)) if unit == "chars" else F.octet_length(_c(col))


def truncate_width(col: Column | str, width: int, unit: str = "chars") -> Column:
    """Cut a string to ``width`` characters, or at the last whole one within ``width`` bytes.

    For bytes: ``width`` code points are at least ``width`` bytes, so only
    those are encoded. A cut between two bytes is a cut between code points
    unless the byte behind it continues one (``10xxxxxx``); a code point has at
    most three such bytes, so one of the last four places will do.
    """
    if unit not in WIDTH_UNITS:
        raise ValueError(f"unit: one of {WIDTH_UNITS}")
    head = F.substring(_c(col), 1, width)
    if unit == "chars" or width <= 0:
        return head
    raw = F.encode(head, "UTF-8")
    keep = F.lit(max(0, width - 3))
    for cut in range(max(0, width - 2), width + 1):
        behind = F.hex(F.substring(raw, cut + 1, 1))
        keep = F.when(~behind.between("80", "BF"), F.lit(cut)).otherwise(keep)
    cut = F.substring(raw, F.lit(1), keep)
    return F.when(F.octet_length(head) <= width, head).otherwise(F.decode(cut, "UTF-8"))


def to_decimal18(col: Column | str) -> Column:
    """The ``numeric(18,0)`` column type: rounds half up to integers."""
    return _c(col).cast("decimal(18,0)")
