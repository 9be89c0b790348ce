"""Catalogue scans (S1, S2) and the plain text-line scan (S3).

Catalogue files are header-less CSV: fields separated by commas, no
quoting, surrounding blanks trimmed, the literal text ``NULL`` for a
missing value. Columns are named and typed by a declared schema, so the
reader never infers anything and Catalyst prunes columns and pushes
filters into the scan. Parquet copies of the same tables are read with
the same schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_scratch_table
from .schemas import SOURCE_POINT_COLUMNS, object_schema, source_schema

CSV_OPTIONS = {
    "header": "false",
    "sep": ",",
    "nullValue": "NULL",
    "quote": "",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}

# Written catalogues (CSV or its text lines) are compressed: a line is mostly ``,NULL``. Compressed
# text cannot be split, so many files of bounded length keep its scan parallel.
WRITE_OPTIONS = {"compression": "lz4", "maxRecordsPerFile": "500000"}


def read_catalog(spark: SparkSession, path: str | list[str],
                 schema: T.StructType, fmt: str = "csv",
                 mode: str = "FAILFAST",
                 corrupt_column: str | None = None) -> DataFrame:
    """Scan a catalogue file or directory with a declared schema.

    ``mode="FAILFAST"`` raises on an unparseable value, like the original
    job. ``mode="PERMISSIVE"`` with ``corrupt_column`` keeps such lines
    in a quarantine column instead. Note that with column pruning a bad
    value is only seen if the query reads that column and row.
    """
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(*_paths(path))
    if fmt != "csv":
        raise ValueError(f"unsupported catalogue format {fmt!r}")
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", mode)
    if corrupt_column:
        schema = T.StructType(list(schema.fields)
                              + [T.StructField(corrupt_column, T.StringType())])
        reader = (reader.schema(schema)
                  .option("columnNameOfCorruptRecord", corrupt_column))
    return reader.csv(_paths(path))


def write_catalog(df: DataFrame, path: str) -> None:
    """Rows as a catalogue directory (compressed CSV in the layout of
    :func:`read_catalog`; ``df`` has the table's columns in their order)."""
    df.write.options(**CSV_OPTIONS, **WRITE_OPTIONS).csv(path)


def scan_with_rejects(spark: SparkSession, path: str | list[str],
                      schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S1 / S2 of a CSV catalogue, every line in exactly one of two results:
    the rows that parse, and ``line, reason`` of the lines that do not (blank
    lines included). The reason is the number of fields where that is wrong,
    else the first column whose text is no value of its type. All columns
    are parsed, whatever a query reads of them: once, into a stored table that
    both results read."""
    corrupt = "corrupt_line"
    while corrupt in schema.fieldNames():
        corrupt += "_"
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    blank = F.trim("value") == ""
    # Exploded, so that a line is parsed once and not by the filter and again
    # by every use of its row.
    parsed = read_lines(spark, path).select("value", F.explode(F.array(
        F.from_csv("value", F.lit(f"{ddl}, `{corrupt}` string"), options))).alias("row"))
    bad = blank | F.col("row").isNull() | F.col("row")[corrupt].isNotNull()
    stored = write_scratch_table(parsed.select(
        *[F.col("row")[f.name].alias(f.name) for f in schema.fields],
        F.when(bad, F.col("value")).alias(corrupt)), "catalog-scan")
    rows = stored.where(F.col(corrupt).isNull()).select(*schema.fieldNames())
    # One SQL text: a plan of as many column objects is slow to build.
    fault = "coalesce(" + ", ".join(
        f"CASE WHEN trim(get(f, {k})) NOT IN ('', 'NULL') "
        f"AND try_cast(trim(get(f, {k})) AS {c.dataType.simpleString()}) IS NULL "
        f"THEN 'bad {c.name}' END" for k, c in enumerate(schema.fields)) + ", 'bad value')"
    fields = F.split("line", CSV_OPTIONS["sep"], -1)
    rejects = (stored.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"))
               .select("line", fields.alias("f")).select("line", F.when(
                   F.trim("line") == "", "empty line").when(
                   F.size("f") != len(schema.fields),
                   F.concat(F.size("f").cast("string"), F.lit(" fields")))
                   .otherwise(F.expr(fault)).alias("reason")))
    return rows, rejects


def read_source(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                **kwargs) -> DataFrame:
    """S1: the Source (detection) table."""
    return read_catalog(spark, path, source_schema(), fmt=fmt, **kwargs)


def read_object(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                **kwargs) -> DataFrame:
    """S2: the Object table."""
    return read_catalog(spark, path, object_schema(), fmt=fmt, **kwargs)


def source_points(source: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P1: the points view of a Source scan.

    Columns ``source_id, object_id, ra, decl`` plus any ``keep`` columns.
    The original jobs kept only RA and Decl; here the id travels with the
    point so outputs stay traceable, and other attributes can be kept.
    """
    cols: list[Column] = [F.col(src).alias(dst)
                          for src, dst in SOURCE_POINT_COLUMNS.items()]
    cols += [F.col(c) for c in (keep or [])]
    return source.select(*cols)


def read_lines(spark: SparkSession, path: str | list[str],
               line_sep: str | None = None) -> DataFrame:
    """S3: plain text lines, one row per line in column ``value``. Without
    ``line_sep`` any of the usual line ends separates lines."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(_paths(path))


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)
