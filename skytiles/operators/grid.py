"""Rectangular grids over the catalogue's bounding box (G1, G2, G4).

A grid is ``n x n`` equal rectangles over a bounding box. It is carried
as a single row ``(g_x0, g_y0, g_w, g_h, g_n, g_x1, g_y1)``: cell
``(i, j)`` spans RA ``[x0 + i*w, x0 + (i+1)*w]`` and Decl
``[y0 + j*h, y0 + (j+1)*h]``, except that the last column and row end
exactly at the box's maximum (``x0 + n*w`` can round one ulp below it,
which without padding would drop the extreme star).
The bounding box is four numbers: given directly, or computed by a
one-row global aggregate (partial min/max per task, one row to the
driver). The grid then enters the plan as literals, so there is no join
or subquery, Catalyst folds the constant parts (``w > 0`` branches,
``x0``, ``w``), and the assignment is a narrow, shuffle-free stage inside
whole-stage codegen.

Edges are always computed as ``x0 + k*w`` (never by accumulation), the
same formula the DuckDB oracle uses, so border decisions agree exactly.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coords import FULL_TURN, cell_name, checked, recentre_ra

# --- Fixed values of the catalogue jobs. ---
# Padding around each cell for the neighbour-aware assignment (degrees).
RA_PADDING = 0.1
DECL_PADDING = 0.1
# Target output file size used to size the grid from the input size.
TARGET_FILE_BYTES = 128 * 1024 * 1024

GRID_COLUMNS = ["g_x0", "g_y0", "g_w", "g_h", "g_n", "g_x1", "g_y1"]
BOUNDS_SCHEMA = T.StructType([T.StructField(c, T.DoubleType())
                              for c in ("min_ra", "max_ra", "min_decl", "max_decl")])


def grid_side(min_cells: int) -> int:
    """Side ``n`` of the smallest square grid with at least ``min_cells``
    cells; any positive number of cells will do, as the assignment never
    lists them."""
    if min_cells < 1:
        raise ValueError("a grid needs at least one cell")
    return math.isqrt(min_cells - 1) + 1


def cells_for_size(total_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Minimum number of cells so that outputs are about ``target_bytes``."""
    return max(1, math.ceil(total_bytes / target_bytes))


def bounds_row(spark: SparkSession, min_ra: float, max_ra: float,
               min_decl: float, max_decl: float) -> DataFrame:
    """A known bounding box as a one-row DataFrame."""
    return spark.createDataFrame([(float(min_ra), float(max_ra),
                                   float(min_decl), float(max_decl))], BOUNDS_SCHEMA)


def bounds_values(bounds) -> tuple[float, float, float, float]:
    """``(min_ra, max_ra, min_decl, max_decl)`` from a one-row bounds
    DataFrame (evaluated here: one row of four numbers) or a tuple."""
    if isinstance(bounds, DataFrame):
        row = bounds.first()
        values = None if row is None else (row["min_ra"], row["max_ra"],
                                           row["min_decl"], row["max_decl"])
    else:
        values = tuple(bounds)
    if values is None or any(v is None for v in values):
        raise ValueError("no points: the bounding box is empty")
    if not all(math.isfinite(v) for v in values):
        raise ValueError(f"the bounding box is not finite: {values}")
    return tuple(float(v) for v in values)


def grid_params(bounds, n: int) -> dict:
    """``g_x0, g_y0, g_w, g_h, g_n, g_x1, g_y1`` of an ``n x n`` grid."""
    if n < 1:
        raise ValueError("grid side must be >= 1")
    x0, x1, y0, y1 = bounds_values(bounds)
    return {"g_x0": x0, "g_y0": y0, "g_w": (x1 - x0) / n, "g_h": (y1 - y0) / n,
            "g_n": n, "g_x1": x1, "g_y1": y1}


def with_grid(points: DataFrame, bounds, n: int) -> DataFrame:
    """Attach the grid parameters to every point as literals."""
    return points.withColumns({c: F.lit(v) for c, v in grid_params(bounds, n).items()})


def grid_cells(bounds, n: int, decl_band: str = "j",
               spark: SparkSession | None = None) -> DataFrame:
    """G1: the ``n*n`` cells as rows ``cell, i, j, left_ra, right_ra,
    low_decl, high_decl``.

    ``decl_band="i"`` reproduces the published neighbour-aware job, whose
    cell ``i.j`` takes its Decl band from the column index ``i``.
    """
    _check_band(decl_band)
    spark = spark or (bounds.sparkSession if isinstance(bounds, DataFrame)
                      else SparkSession.getActiveSession())
    idx = spark.range(n * n).select((F.col("id") / n).cast("int").alias("i"),
                                    (F.col("id") % n).cast("int").alias("j"))
    row = F.col(decl_band)
    return with_grid(idx, bounds, n).select(
        cell_name("i", "j").alias("cell"), "i", "j",
        _edge("g_x0", "g_w", F.col("i")).alias("left_ra"),
        _upper_edge("g_x0", "g_w", "g_x1", F.col("i")).alias("right_ra"),
        _edge("g_y0", "g_h", row).alias("low_decl"),
        _upper_edge("g_y0", "g_h", "g_y1", row).alias("high_decl"))


def assign_cell(points: DataFrame, bounds, n: int,
                ra_col: str = "ra", decl_col: str = "decl") -> DataFrame:
    """G2: one cell per point, by counting the grid edges below it.

    ``i`` = number of RA edges ``x0 + k*w`` (k = 0..n-1) strictly below
    RA; ``j`` likewise for Decl, except that ``j = 0`` when ``i = 0``.
    Indexes therefore run 1..n, with 0 only on the lower borders, and the
    minimum-RA star is in ``0.0``. Adds ``i, j, cell``. A null, NaN or
    infinite coordinate stops the job.
    """
    g = with_grid(points, bounds, n)
    i = _edges_below(checked(ra_col, "RA"), "g_x0", "g_w")
    below = _edges_below(checked(decl_col, "Decl"), "g_y0", "g_h")
    # Written so that a bad Decl is noticed in column 0 as well.
    j = F.when(below >= 0, F.when(F.col("i") == 0, F.lit(0)).otherwise(below))
    return (g.withColumn("i", i).withColumn("j", j)
            .withColumn("cell", cell_name("i", "j"))
            .drop(*GRID_COLUMNS))


def assign_padded(points: DataFrame, bounds, n: int,
                  ra_pad: float = RA_PADDING, decl_pad: float = DECL_PADDING,
                  ra_col: str = "ra", decl_col: str = "decl",
                  recentre: bool = True, decl_band: str = "j",
                  outside: str | None = None, sphere: bool = False) -> DataFrame:
    """G4: every cell whose rectangle, grown by the padding on all four
    sides, contains the point (inclusive borders). Adds ``i, j, cell``;
    one output row per (point, cell).

    Candidate cells are computed per point from its coordinates (a small
    index range on each axis, widened by one to absorb rounding) and then
    checked exactly, so the work per point is the number of nearby cells,
    not ``n*n``. With ``recentre=True`` (default) RA is mapped to
    (-180, 180] first, matching bounds from ``bounds(..., recentre=True)``;
    the output keeps the original RA column.

    A null, NaN or infinite coordinate stops the job. So does a star
    outside the padded box (a box computed from the same points holds them
    all), unless ``outside`` names a cell for such stars; they then get
    that cell with ``i = j = -1``.

    The padding is Cartesian. ``sphere=True`` measures it on the sky: RA is
    a circle, and the padding in RA is that of :func:`ra_reach`, which grows
    towards the poles. With equal paddings a star is then in every cell that
    holds a point of the sky within that distance, also across RA 180 (or 0)
    and across a pole. Each full turn to either side has an index range of
    its own, so the work per star stays the number of nearby cells.
    """
    _check_band(decl_band)
    turns = (-FULL_TURN, 0.0, FULL_TURN) if sphere else (0.0,)
    x = recentre_ra(ra_col) if recentre else F.col(ra_col)
    g = with_grid(points, bounds, n).withColumns(
        {"_x": checked(x, "RA"), "_y": checked(decl_col, "Decl")})
    y = F.col("_y")
    if sphere:
        g = g.withColumn("_reach", ra_reach(y, ra_pad))
        ra_pad = F.col("_reach")

    turned = [F.col("_x") + t if t else F.col("_x") for t in turns]

    def reaches(left: Column, right: Column) -> Column:
        return reduce(Column.__or__, [(x >= left - ra_pad) & (x <= right + ra_pad)
                                      for x in turned])

    in_box = (reaches(F.col("g_x0"), F.col("g_x1"))
              & (y >= F.col("g_y0") - decl_pad) & (y <= F.col("g_y1") + decl_pad))
    nowhere = F.array(F.lit(-1)) if outside is not None else F.raise_error(F.concat(
        F.lit("star outside the box: "), F.col("_x").cast("string"), F.lit(" "),
        y.cast("string"))).cast("array<int>")
    ranges = [_candidates(x, "g_x0", "g_w", ra_pad) for x in turned]
    if sphere:
        none = F.array().cast("array<int>")
        ranges = [F.array_distinct(F.concat(*[F.coalesce(r, none) for r in ranges]))]
    ci = F.when(in_box, ranges[0]).otherwise(nowhere)
    if decl_band == "j":
        cj = _candidates(y, "g_y0", "g_h", decl_pad)
    else:
        cj = F.sequence(F.lit(0), F.col("g_n") - 1)
    cj = F.when(in_box, cj).otherwise(F.array(F.lit(-1)))
    row = F.col("i") if decl_band == "i" else F.col("j")
    name = cell_name("i", "j")
    if outside is not None:
        name = F.when(F.col("i") < 0, F.lit(outside)).otherwise(name)
    inside = (F.col("i") < 0) | (reaches(_edge("g_x0", "g_w", F.col("i")),
                                         _upper_edge("g_x0", "g_w", "g_x1", F.col("i")))
              & (y >= _edge("g_y0", "g_h", row) - decl_pad)
              & (y <= _upper_edge("g_y0", "g_h", "g_y1", row) + decl_pad))
    return (g.withColumn("i", F.explode(ci)).withColumn("j", F.explode(cj))
            .where(inside)
            .withColumn("cell", name)
            .drop("_x", "_y", "_reach", *GRID_COLUMNS))


def ra_reach(decl: str | Column, radius: float) -> Column:
    """Largest difference in RA (degrees) between a star and any point of
    the sky within ``radius`` degrees of it: ``asin(sin(radius) /
    cos(decl))``, and half a turn where that circle holds a pole."""
    decl = F.col(decl) if isinstance(decl, str) else decl
    sine = F.lit(math.sin(math.radians(radius))) / F.cos(F.radians(decl))
    return F.when(F.abs(decl) + radius >= 90.0, FULL_TURN / 2).otherwise(
        F.degrees(F.asin(F.least(sine, F.lit(1.0)))))


# ---------------------------------------------------------------- helpers

def _check_band(decl_band: str) -> None:
    if decl_band not in ("i", "j"):
        raise ValueError("decl_band must be 'i' or 'j'")


def _edge(origin: str, width: str, k: Column) -> Column:
    """Grid edge ``origin + k*width`` (k converted to double)."""
    return F.col(origin) + k.cast("double") * F.col(width)


def _upper_edge(origin: str, width: str, top: str, k: Column) -> Column:
    """Upper edge of cell ``k``: ``origin + (k+1)*width``, or the box's
    maximum for the last cell."""
    return F.when(k + 1 >= F.col("g_n"), F.col(top)).otherwise(
        _edge(origin, width, k + 1))


def _edges_below(v: Column, origin: str, width: str) -> Column:
    """Exact number of edges ``origin + k*width``, k = 0..n-1, below ``v``.

    A guess from division is corrected by testing the two edges around
    it; edges are monotone in k, so a guess off by one is repaired.
    """
    n = F.col("g_n")
    w = F.col(width)
    ratio = (v - F.col(origin)) / F.when(w > 0, w)
    guess = F.ceil(F.least(F.greatest(ratio, F.lit(0.0)),
                           n.cast("double"))).cast("int")
    down = F.when((guess >= 1) & ~(_edge(origin, width, guess - 1) < v), 1).otherwise(0)
    up = F.when((guess <= n - 1) & (_edge(origin, width, guess) < v), 1).otherwise(0)
    flat = F.when(v > F.col(origin), n).otherwise(0)
    return F.when(w > 0, guess - down + up).otherwise(flat)


def _candidates(v: Column, origin: str, width: str, pad: float | Column) -> Column:
    """Index range that can contain ``v`` once cells are padded by ``pad``;
    one index of slack on each side. Zero width: every index."""
    n = F.col("g_n")
    w = F.col(width)

    def idx(t: Column) -> Column:
        r = (t - F.col(origin)) / F.when(w > 0, w)
        r = F.least(F.greatest(r, F.lit(-2.0)), (n + 1).cast("double"))
        return F.floor(r).cast("int")

    lo = F.greatest(idx(v - pad) - 1, F.lit(0))
    hi = F.least(idx(v + pad) + 1, n - 1)
    lo = F.when(w > 0, lo).otherwise(0)
    hi = F.when(w > 0, hi).otherwise(n - 1)
    return F.when(lo <= hi, F.sequence(lo, hi))
