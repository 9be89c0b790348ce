"""Whole catalogue jobs (J1-J6), composed from the operators.

The ``*_assignment`` functions are lazy pipelines, but for the bounding
box: its four numbers are computed first (one aggregate over two columns)
and enter the plan as literals. The ``run_*`` functions also write their
output and return what they report. Tables they store on the way lie under
the shared checkpoint folder and are deleted at the end.

``store_points`` is for row-oriented input (CSV), where every pass parses
every byte: the points are parsed once, stored as narrow Parquet, and all
passes read that. With Parquet input the passes read only what they need,
and nothing is stored.

``target_bytes`` sizes the outputs by bytes in place of rows: the payload's
rows are weighed as the sink encodes them (:func:`output_size`), the cap or
the rows of a file follow, and with ``min_cells=None`` the grid as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import MAX_SMALL_ROWS, collect_small, is_small
from ..operators.capacity import (MAX_PER_CELL, ORDER, ROWS_PER_TASK, capacity_split,
                                  cell_counts)
from ..operators.grid import (DECL_PADDING, RA_PADDING, assign_cell,
                              assign_padded, grid_side)
from ..operators.histogram import capped_histogram, cell_histogram
from ..operators.strips import N_STRIPS, STRIP_MARGIN, assign_strips
from ..operators.summary import bounds, object_counts, object_summary
from ..session import scratch_scope, scratch_scope_off, write_scratch_table
from ..sinks.cells import ROWS_PER_FILE, write_cells, write_rows
from ..sinks.sizing import output_size

MIN_CELLS = 40  # default grid size: 5 GB inputs / 128 MB outputs


def grid_assignment(points: DataFrame, min_cells: int = MIN_CELLS) -> DataFrame:
    """J1 body: raw bounds (A4), ``n x n`` grid (G1), one cell per point (G2)."""
    return assign_cell(points, bounds(points), grid_side(min_cells))


def strip_assignment(points: DataFrame, n_strips: int = N_STRIPS,
                     margin: float = STRIP_MARGIN) -> DataFrame:
    """J2 body: RA strips with neighbour copies (G3)."""
    return assign_strips(points, n_strips, margin)


def neighbour_pairs(points: DataFrame, min_cells: int = MIN_CELLS,
                    ra_pad: float = RA_PADDING, decl_pad: float = DECL_PADDING,
                    decl_band: str = "j", sphere: bool = False) -> DataFrame:
    """J3 first half: re-centred bounds (A5), padded cells (G4)."""
    return assign_padded(points, bounds(points, recentre=True), grid_side(min_cells),
                         ra_pad, decl_pad, decl_band=decl_band, sphere=sphere)


def neighbour_assignment(points: DataFrame, min_cells: int = MIN_CELLS,
                         ra_pad: float = RA_PADDING,
                         decl_pad: float = DECL_PADDING,
                         cap: int = MAX_PER_CELL,
                         order_by: tuple[str, ...] = ORDER,
                         decl_band: str = "j", method: str = "auto",
                         cell_rows_bound: int | None = None,
                         sphere: bool = False) -> DataFrame:
    """J3 body: padded cells (A5, G4) then the capacity split (G5), lazily.

    Output: the input columns plus ``i, j, cell, cell_rank, overflow``.
    ``cell_rows_bound``: a known bound on any cell's size, such as the
    number of points (a point is in a given cell at most once); it lets
    ``method="auto"`` skip the statistics pass. For parquet inputs
    ``points.count()`` reads only file footers.
    """
    pairs = neighbour_pairs(points, min_cells, ra_pad, decl_pad, decl_band, sphere)
    return capacity_split(pairs, cap, order_by=order_by, method=method,
                          cell_rows_bound=cell_rows_bound)


def run_partition_job(points: DataFrame, output_dir: str,
                      columns: list[str] | None = None, fmt: str = "parquet",
                      min_cells: int | None = MIN_CELLS, ra_pad: float = RA_PADDING,
                      decl_pad: float = DECL_PADDING, cap: int = MAX_PER_CELL,
                      order_by: tuple[str, ...] = ORDER,
                      decl_band: str = "j", method: str = "auto",
                      rows_per_task: int = ROWS_PER_TASK,
                      store_points: bool = False,
                      mode: str = "errorifexists", sphere: bool = False,
                      target_bytes: int | None = None) -> DataFrame:
    """J3 end to end; returns the histogram of the outputs (A6).

    Passes over the points: the bounds (two columns), the stars per cell
    (two columns, one small table), then assignment, ranking and the write,
    hash-spread on the output (every output holds at most ``cap`` rows).
    Outputs are ``cell=<name>/k=<overflow>``. The histogram follows from the
    stars per cell and the cap; the outputs are not listed or read. The rows
    written are counted on the way and held against the stars per cell.
    """
    spark = points.sparkSession
    with scratch_scope(spark):
        if store_points:
            points = write_scratch_table(points, "partition-points")
        min_cells, cap = _sized(points, columns, fmt, target_bytes, min_cells, cap)
        pairs = neighbour_pairs(points, min_cells, ra_pad, decl_pad, decl_band, sphere)
        counts = write_scratch_table(cell_counts(pairs), "partition-counts")
        capped = capacity_split(pairs, cap, order_by=order_by, method=method,
                                rows_per_task=rows_per_task, counts=counts)
        written = write_cells(capped.drop("i", "j", "cell_rank"), output_dir, columns=columns,
                              fmt=fmt, partitioning="hash", overflow_col="overflow",
                              output_rows=None if target_bytes else cap, mode=mode)
        check_written(counts, written)
        kept = _kept(counts)
    return capped_histogram(kept, cap)


def run_grid_job(points: DataFrame, output_dir: str, min_cells: int | None = MIN_CELLS,
                 columns: list[str] | None = None, fmt: str = "parquet",
                 rows_per_file: int = ROWS_PER_FILE, store_points: bool = False,
                 mode: str = "errorifexists", target_bytes: int | None = None) -> DataFrame:
    """J1 end to end: write one directory per cell, return the histogram.

    The assignment is a column expression, so it is not stored: the
    histogram (one row per cell) is an aggregate that reads only RA and
    Decl from the input. Spark's rebalance hint spreads large cells over
    several writers (with ``target_bytes`` a salt from the histogram does, so
    that each writes about one file of that size), and the rows written are
    held against the histogram.
    """
    with scratch_scope(points.sparkSession):
        if store_points:
            points = write_scratch_table(points, "grid-points")
        min_cells, rows_per_file = _sized(points, columns, fmt, target_bytes, min_cells,
                                          rows_per_file)
        cells = grid_assignment(points, min_cells).drop("i", "j")
        return _written(cells, output_dir, columns, fmt, rows_per_file, mode,
                        "salted" if target_bytes else "rebalance")


def run_strip_job(points: DataFrame, output_dir: str, n_strips: int = N_STRIPS,
                  margin: float = STRIP_MARGIN, columns: list[str] | None = None,
                  fmt: str = "parquet", rows_per_file: int = ROWS_PER_FILE,
                  store_points: bool = False, mode: str = "errorifexists",
                  target_bytes: int | None = None) -> DataFrame:
    """J2 end to end: write one directory per strip, return the histogram.

    Strip membership is a pure column expression, so the strip counts are
    one cheap aggregate over the input. The write is that of the grid job.
    """
    with scratch_scope(points.sparkSession):
        if store_points:
            points = write_scratch_table(points, "strip-points")
        _, rows_per_file = _sized(points, columns, fmt, target_bytes, n_strips, rows_per_file)
        strips = strip_assignment(points, n_strips, margin).drop("strip")
        return _written(strips, output_dir, columns, fmt, rows_per_file, mode,
                        "salted" if target_bytes else "rebalance")


def _sized(points: DataFrame, columns: list[str] | None, fmt: str, target_bytes: int | None,
           min_cells: int | None, rows: int) -> tuple[int, int]:
    """The least number of cells and the rows of an output, both as given or
    from the byte target."""
    if target_bytes is None:
        if min_cells is None:
            raise ValueError("the number of cells or a byte target is needed")
        return min_cells, rows
    total = points.count()
    size = output_size(points, target_bytes, columns, fmt, total)
    return (size.min_cells(total) if min_cells is None else min_cells), size.rows


def _written(cells: DataFrame, output_dir: str, columns: list[str] | None, fmt: str,
             rows_per_file: int, mode: str, partitioning: str) -> DataFrame:
    counts = write_scratch_table(cell_histogram(cells), "cell-counts")
    written = write_cells(cells, output_dir, columns=columns, fmt=fmt, partitioning=partitioning,
                          cell_counts=counts if partitioning == "salted" else None,
                          rows_per_file=rows_per_file,
                          max_records_per_file=rows_per_file, mode=mode)
    check_written(counts, written)
    return _kept(counts)


def check_written(counts: DataFrame, written: int) -> None:
    """Conservation: what was written is what the cells were counted to
    hold. Raises otherwise; the outputs are then not to be used."""
    expected = counts.agg(F.sum("n_stars")).first()[0] or 0
    if written != expected:
        raise RuntimeError(f"{written} rows were written, {expected} were counted")


def _kept(counts: DataFrame) -> DataFrame:
    """A per-cell table that outlives the scratch folder: held by the driver
    up to a checked size, stored outside the scope beyond it."""
    if is_small(counts, MAX_SMALL_ROWS):
        return collect_small(counts, MAX_SMALL_ROWS)
    with scratch_scope_off():
        return write_scratch_table(counts, "kept-counts")


def run_object_summary_job(points: DataFrame, output_dir: str,
                           mode: str = "errorifexists", **kwargs) -> None:
    """J4 end to end: summary rows as header-less CSV lines (K2)."""
    write_rows(object_summary(points, **kwargs), output_dir, mode)


def run_object_count_job(points: DataFrame, output_dir: str,
                         mode: str = "errorifexists") -> None:
    """J5 end to end: ``object_id,count`` lines (K2)."""
    write_rows(object_counts(points), output_dir, mode)
