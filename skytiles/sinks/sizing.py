"""Rows per output for a byte target, measured on encoded rows.

How many bytes a row takes depends on the payload, the format, its
compression, and on how many rows share a file (dictionaries, headers and
footers). So rows are drawn over the whole input, encoded as the sink encodes
its outputs, and the files weighed; then encoded once more in files of the
size found, whose weight gives the final figure.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import input_bytes, scratch_path, scratch_scope, write_scratch_table

SAMPLE_ROWS = 100_000    # rows that are encoded: what one task writes in a moment
FILES = 64               # files of the size found that are written to weigh them


class OutputSize(NamedTuple):
    rows: int              # rows of an output of about the target size
    bytes_per_row: float   # in an output of that many rows

    def min_cells(self, total_rows: int) -> int:
        """Cells that the rows fill once each."""
        return max(1, -(-total_rows // self.rows))


def output_size(points: DataFrame, target_bytes: int, columns: list[str] | None = None,
                fmt: str = "parquet", total_rows: int | None = None,
                sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> OutputSize:
    """Rows of an output of about ``target_bytes``.

    ``columns`` is the payload (default: all). ``total_rows`` saves a count.
    One narrow pass draws about ``sample_rows`` rows evenly over the input
    (all, where there are fewer), each by chance of its own; they are stored,
    and one task encodes them. Files larger than the sample are extrapolated
    from it. An empty input raises.
    """
    if target_bytes < 1:
        raise ValueError("the target must be at least one byte")
    spark = points.sparkSession
    payload = points.select(*columns) if columns else points
    total = payload.count() if total_rows is None else total_rows
    with scratch_scope(spark):
        drawn = payload if total <= sample_rows else payload.sample(sample_rows / total, seed)
        sample = write_scratch_table(drawn, "size-sample").coalesce(1)
        rows, size = _encoded(sample, fmt, None)
        if not rows:
            raise ValueError("no points: their size cannot be measured")
        per_row = size / rows
        fit = max(1, int(target_bytes / per_row))
        for _ in range(2):               # smaller files pay more for each row
            if fit >= rows:
                break
            part = sample.sample(min(1.0, FILES * fit / rows), seed)
            n, weight = _encoded(part, fmt, fit)
            if not n:
                break
            per_row = weight / n
            fit = max(1, int(target_bytes / per_row))
    return OutputSize(fit, per_row)


def _encoded(sample: DataFrame, fmt: str, rows_per_file: int | None) -> tuple[int, int]:
    """Rows written and the bytes of their files."""
    path = scratch_path(sample.sparkSession, "size-encoded")
    seen = Observation()
    writer = sample.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "false")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.save(path)
    return seen.get["n"], input_bytes(sample.sparkSession, path)
