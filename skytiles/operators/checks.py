"""Stars whose coordinates cannot be used.

The assignments stop at such a star. A job that should go on instead
parts the points first: every row is in exactly one of the two results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coords import good_coordinate


def quarantine(points: DataFrame, ra_col: str = "ra", decl_col: str = "decl",
               max_ra: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: bad rows have a null, NaN or infinite coordinate, or
    an RA above ``max_ra`` (360 for the strips)."""
    good = good_coordinate(ra_col) & good_coordinate(decl_col)
    if max_ra is not None:
        good = good & (F.col(ra_col) <= max_ra)
    good = F.coalesce(good, F.lit(False))
    return points.where(good), points.where(~good)
