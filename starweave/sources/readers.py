"""File readers with declared schemas (S1-S13) and width enforcement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.functions.text import truncate_width, width_of
from starweave.sources.schemas import table_schema

# Text formats keep microseconds only with an explicit pattern; the default
# round trip cuts timestamps to milliseconds.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

TEXT_OPTIONS = {"timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_FORMAT}


#: Text of a record that does not fit the schema, with ``on_error="reject"``.
REJECTED = "_rejected"
MODES = {"fail": "FAILFAST", "null": "PERMISSIVE", "reject": "PERMISSIVE"}


def _reader(spark: SparkSession, schema, recursive: bool, glob_filter: str | None, options, on_error: str):
    """``on_error``: what a malformed record does. ``fail`` ends the read (a load
    without an error allowance), ``null`` keeps it with nulls, ``reject`` keeps
    its text in the column ``_rejected``, which is null for sound records."""
    if on_error not in MODES:
        raise ValueError(f"on_error: one of {sorted(MODES)}")
    r = spark.read.option("mode", MODES[on_error])
    if on_error == "reject":
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", REJECTED)
    if schema is not None:
        r = r.schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    return r.options(**TEXT_OPTIONS).options(**(options or {}))


def with_lineage(df: DataFrame, name: str = "source_file") -> DataFrame:
    """S3: keep the file each row came from (the ``_metadata`` column)."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    recursive: bool = False,
    glob_filter: str | None = None,
    options: Mapping[str, str] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """JSON lines under a path, glob or nested directories.

    Field names match case-insensitively (``'auto'`` by-name load);
    ``recursive`` + ``glob_filter="*.json"`` replaces a directory walk.
    ``on_error``: fail, null or reject (see ``_reader``).
    """
    r = _reader(spark, schema, recursive, glob_filter, options, on_error)
    return r.json(paths if isinstance(paths, str) else list(paths))


def read_json_mapped(
    spark: SparkSession,
    paths: str | Sequence[str],
    mapping: Sequence[tuple[str, str, str]],
    raw_schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Load JSON through an ordered field mapping ``(field, column, type)``.

    Only mapped fields are read. Without ``raw_schema`` each top-level field
    is declared as a string; pass a nested ``raw_schema`` to map dotted paths
    such as ``song.title``. ``on_error="fail"`` ends the load on a broken line
    or a value that does not cast; ``"null"`` makes them null; ``"reject"``
    makes such a record a row of nulls with its text in the column
    ``_rejected`` (the line, or the mapped fields of one whose values do not
    cast), which is null for sound records.
    """
    if raw_schema is None:
        raw_schema = T.StructType()
        for field, _, _ in mapping:
            if "." in field:
                raise ValueError(f"dotted field {field!r} needs a nested raw_schema")
            if field not in raw_schema.fieldNames():
                raw_schema.add(field, T.StringType())
    r = _reader(spark, raw_schema, False, None, options, on_error)
    df = r.json(paths if isinstance(paths, str) else list(paths))
    if on_error == "reject":
        bad = F.lit(False)
        for field, _, kind in mapping:
            bad = bad | (F.col(field).isNotNull() & F.col(field).try_cast(kind).isNull())
        fields = F.to_json(F.struct(*[F.col(f).cast("string").alias(f.replace(".", "_")) for f, _, _ in mapping]))
        rejected = F.coalesce(F.col(REJECTED), F.when(bad, fields))
        df = df.withColumn(REJECTED, rejected)
        sound = [F.when(F.col(REJECTED).isNull(), F.col(f).try_cast(t)).alias(c) for f, c, t in mapping]
        return df.select(*sound, REJECTED)

    def value(field: str, kind: str) -> Column:
        cast = F.col(field).try_cast(kind)
        if on_error == "null":
            return cast
        bad = F.col(field).isNotNull() & cast.isNull()
        message = F.concat(F.lit(f"{field} is not a {kind}: "), F.col(field).cast("string"))
        return F.when(bad, F.raise_error(message)).otherwise(cast)

    return df.select([value(f, t).alias(c) for f, c, t in mapping])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    header: bool = True,
    sep: str = ",",
    multiline: bool = False,
    options: Mapping[str, str] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """CSV with or without header, any delimiter, many files.

    With a declared schema columns are named by position from the schema
    (S8). ``header=False`` keeps a header line as a data row (S9). Without a
    schema every column is a string (S7). ``on_error`` as in ``read_json``.
    """
    r = _reader(spark, schema, False, None, options, on_error)
    r = r.option("header", str(header).lower()).option("sep", sep)
    if multiline:
        r = r.option("multiLine", "true").option("escape", '"')
    return r.csv(paths if isinstance(paths, str) else list(paths))


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Parquet, optionally merging the schemas of all files.

    Columns missing from some files come back null for their rows.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(*([paths] if isinstance(paths, str) else list(paths)))


def templated_path(template: str, **context) -> str:
    """A source path built from run context, e.g. ``{year}/{month}``."""
    return template.format(**context)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A loaded table by catalog name, or by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``) with its declared schema."""
    return spark.read.schema(table_schema(name)).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def enforce_widths(df: DataFrame, widths: Mapping[str, int], mode: str = "truncate", unit: str = "chars") -> DataFrame:
    """``varchar(n)`` columns, ``n`` in code points or UTF-8 ``bytes``.

    ``truncate`` cuts longer values (``truncatecolumns``), never inside a code
    point; ``fail`` raises at run time on the first value that does not fit.
    """
    exprs = {}
    for name, n in widths.items():
        if name not in df.columns:
            continue
        c = F.col(name)
        if mode == "truncate":
            exprs[name] = truncate_width(c, n, unit)
        elif mode == "fail":
            exprs[name] = F.when(
                width_of(c, unit) > F.lit(n),
                F.raise_error(F.concat(F.lit(f"value too long for {name} varchar({n}): "), c)),
            ).otherwise(c)
        else:
            raise ValueError("mode must be 'truncate' or 'fail'")
    return df.withColumns(exprs) if exprs else df


# --- arrival order (K8, K9, K11, L3, A6) ---------------------------------------


def with_arrival(df: DataFrame, name: str = "_arrival") -> DataFrame:
    """The place of each row in its files: ``(file, block, row)``, to order first and last rows by.

    Order by this column is order by file path, then by row in the file, which
    a job that goes through files one after the other would see. ``df`` must
    come straight from a file reader. Parquet rows have a row number in their
    file. In text formats a row is placed by the start of its block and its
    turn within the task that reads the block: the numbers depend on how files
    are split, the order does not.
    """
    rows = "_metadata.row_index" in _metadata_fields(df)
    block = F.lit(0).cast("long") if rows else F.col("_metadata.file_block_start")
    row = F.col("_metadata.row_index") if rows else F.monotonically_increasing_id()
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), row.alias("row")))


def _metadata_fields(df: DataFrame) -> set[str]:
    return {f"_metadata.{n}" for n in df.select("_metadata").schema["_metadata"].dataType.fieldNames()}


def with_line_number(df: DataFrame, name: str = "_line") -> DataFrame:
    """S3: the number of each row in its file, from 1, whatever the splits (header lines are not counted).

    A block's first number is the rows of the blocks before it: counts per
    block (few rows beside the data) are summed per file and joined back.
    """
    placed = with_arrival(df, "_at")
    blocks = placed.groupBy("_at.file", "_at.block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at.row").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = (F.col("_at.file") == F.col("file")) & (F.col("_at.block") == F.col("block"))
    number = F.col("_before") + F.col("_at.row") - F.col("_first") + 1
    return placed.join(blocks, same).select(*df.columns, number.alias(name))
