"""Sinks: one directory per cell (K1, with G6) and plain summary rows (K2).

K1 writes ``dir/cell=<name>/part-*``; the cell column is not written into
the rows, as in the original job: the directory carries it. How rows are
spread over writer tasks before the write (G6) is a choice:

* ``hash``: hash on the cell. Right when every cell is bounded, e.g.
  after the capacity split (at most ``cap`` rows per output cell).
* ``salted`` (needs per-cell counts, one row per cell): a cell with ``n``
  rows is hashed over ``ceil(n / rows_per_file)`` writer tasks by a salt
  derived from the row's columns, so a cell holding a third of
  all rows is written by many tasks. The counts come from the job's own
  histogram, so this costs no extra pass over the data.
* ``range`` (default when no counts are given): range partitioning on
  ``(cell, tie-break columns)``; balanced for any distribution, but its
  split-point sampling runs the input plan once more, so store the input
  first when it is expensive to recompute.

* ``rebalance``: Spark's own hint on the output cell. AQE splits the
  partitions of large cells in the write stage and merges small ones, to
  the session's advisory partition size, from what the shuffle measured: no
  counts, salt or sampling. Without AQE it is ``hash``.

AQE sizes the write tasks; ``max_records_per_file`` bounds file size. The
rows written are counted on the way (Spark's ``Observation``), so a job can
hold them against what it should have written without another pass.

Cell names such as ``2.10`` look numeric, so readers must not infer the
partition column's type (``2.1`` and ``2.10`` would merge). ``read_cells``
always declares it as a string.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sizing import broadcast_if_small
from .small import NULL_NAME, small_outputs, write_small

ROWS_PER_FILE = 1_000_000
BYTES_PER_TASK = 16 * 1024 * 1024   # of outputs that are read back


def write_cells(df: DataFrame, path: str, cell_col: str = "cell",
                columns: list[str] | None = None,
                split_by: list[str] | None = None, fmt: str = "parquet",
                partitioning: str | None = None,
                cell_counts: DataFrame | None = None,
                rows_per_file: int = ROWS_PER_FILE,
                num_partitions: int | None = None,
                max_records_per_file: int | None = None,
                overflow_col: str | None = None,
                output_rows: int | None = None,
                mode: str = "errorifexists") -> int:
    """K1 + G6: write one directory per cell; returns the rows written.

    ``columns`` selects the payload (default: every column); the original
    job wrote only ``ra,decl``. ``split_by`` are the columns that spread a
    large cell over several tasks (default: the whole payload, so only
    equal rows stay together). ``partitioning`` is ``hash``, ``salted``,
    ``range`` or ``rebalance`` (default: ``salted`` when ``cell_counts`` - columns ``cell,
    n_stars``, one row per cell - is given, else ``range``). With
    ``overflow_col`` an output is ``cell=<name>/k=<overflow>``: the name of
    a directory stays short however many outputs a cell has. ``output_rows``
    is a known bound on their rows; in a ``file:`` folder small ones, spread
    by ``hash``, are written as :mod:`.small` says. An output folder that
    exists is an error, unless ``mode="overwrite"``.
    """
    outputs = [cell_col] + ([overflow_col] if overflow_col else [])
    payload = columns or [c for c in df.columns if c not in outputs]
    split = split_by if split_by is not None else payload
    mode_ = partitioning or ("salted" if cell_counts is not None else "range")
    out = df.select(*outputs, *payload, *[c for c in split if c not in payload])
    if mode_ == "hash":
        out = (out.repartition(num_partitions, *outputs) if num_partitions
               else out.repartition(*outputs))
    elif mode_ == "salted":
        if cell_counts is None:
            raise ValueError("salted partitioning needs cell_counts")
        ways = cell_counts.select(
            F.col("cell").alias(cell_col),
            F.greatest(F.lit(1), F.ceil(F.col("n_stars") / F.lit(rows_per_file))
                       .cast("int")).alias("_ways"))
        out = out.join(broadcast_if_small(ways), cell_col, "left").withColumn(
            "_salt", F.pmod(F.xxhash64(*split), F.coalesce("_ways", F.lit(1))))
        out = (out.repartition(num_partitions, *outputs, "_salt") if num_partitions
               else out.repartition(*outputs, "_salt"))
    elif mode_ == "range":
        keys = outputs + [c for c in split if c not in outputs]
        out = (out.repartitionByRange(num_partitions, *keys) if num_partitions
               else out.repartitionByRange(*keys))
    elif mode_ == "rebalance":
        out = out.hint("rebalance", *outputs)
    else:
        raise ValueError("partitioning must be hash, salted, range or rebalance")
    out = out.select(*[F.col(c).alias("k") if c == overflow_col else c for c in outputs],
                     *payload)
    parts = [cell_col] + (["k"] if overflow_col else [])
    if overflow_col and mode_ == "hash" and mode in ("errorifexists", "overwrite"):
        folder = small_outputs(out, path, fmt, output_rows)
        if folder:
            return write_small(out, parts, folder, fmt, mode)
    written = Observation()
    out = out.observe(written, F.count(F.lit(1)).alias("n"))
    writer = out.write.mode(mode).partitionBy(*parts).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "false")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(path)
    return written.get["n"]


def read_cells(spark: SparkSession, path: str, payload_schema: T.StructType,
               cell_col: str = "cell", fmt: str = "parquet",
               overflow: bool = False) -> DataFrame:
    """Read a K1 output back; ``cell`` is a string column. ``overflow`` for
    outputs with a ``k`` level (long), which are many (:func:`read_outputs`)."""
    options = {"header": "false"} if fmt == "csv" else {}
    if overflow:
        # A small file is parsed as a whole: a reader of lines takes longer to make.
        whole = {"multiLine": "true", "lineSep": "\n"} if fmt == "csv" else {}
        return read_outputs(spark, path, payload_schema, cell_col, fmt, options | whole)
    schema = T.StructType([*payload_schema.fields, T.StructField(cell_col, T.StringType())])
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_outputs(spark: SparkSession, path: str, payload_schema: T.StructType | str,
                 cell_col: str = "cell", fmt: str = "parquet",
                 options: dict[str, str] | None = None,
                 without: list[str] | None = None) -> DataFrame:
    """The rows of ``cell=<name>/k=<overflow>`` outputs, with both columns.

    The columns are taken from the files' paths, since Spark's discovery of
    partition columns takes time in the square of the directories; a filter
    on them still leaves out files. Each task reads many of the files.
    ``without``: files whose names hold one of these texts are left out."""
    files = (spark.read.schema(payload_schema).options(**(options or {})).format(fmt)
             .option("recursiveFileLookup", "true").load(path))
    size = int(str(files._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    if without:
        files = files.where(~F.col("_metadata.file_name").rlike("|".join(without)))
    at = F.col("_metadata.file_path")
    return files.select(
        "*", _from_path(at, -3, cell_col).alias(cell_col),
        _from_path(at, -2, "k").cast("long").alias("k")).coalesce(
            max(3 * spark.sparkContext.defaultParallelism, math.ceil(size / BYTES_PER_TASK)))


def _from_path(at: Column, nth: int, key: str) -> Column:
    """The value in a directory's name, from the path of a file below it."""
    name = F.substring_index(F.substring_index(at, "/", nth), "/", 1)
    # The path is a URI, and Spark escapes characters in the name before.
    for _ in range(2):
        name = F.when(F.contains(name, F.lit("%")),
                      F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)
    return F.nullif(F.substr(name, F.lit(len(key) + 2)), F.lit(NULL_NAME))


def write_rows(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K2: aggregate rows as header-less comma-separated lines."""
    df.write.mode(mode).option("header", "false").csv(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", "false").csv(path)
