"""Right-ascension strips with copies to the neighbouring strip (G3).

The sky is cut into ``n`` strips of ``360/n`` degrees. A point belongs
to strip ``i`` = number of strip edges ``0, L, 2L, ..., 360`` strictly
below its RA (``ceil(ra/L)``, 1..n for RA in (0, 360], 0 for RA 0), and
is copied to the neighbouring strip when it lies within ``margin`` of
the shared edge. Strip 1 and strip n are neighbours (wraparound at RA
0/360). Comparisons with the margin are inclusive. RA is used as given
(no re-centring); a null, NaN or infinite RA, or one above 360, stops the
job. Pure column expressions: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coords import FULL_TURN, checked

# --- Fixed values of the RA-strip job. ---
N_STRIPS = 40
STRIP_MARGIN = 1


def strip_width(n_strips: int, margin: float) -> int:
    if n_strips < 2 or 360 % n_strips:
        raise ValueError("the number of strips must divide 360 and be >= 2")
    width = 360 // n_strips
    if width <= 2 * margin:
        raise ValueError("strips must be wider than twice the margin")
    return width


def assign_strips(points: DataFrame, n_strips: int = N_STRIPS,
                  margin: float = STRIP_MARGIN, ra_col: str = "ra") -> DataFrame:
    """G3: one row per (point, strip); adds ``strip`` (int) and ``cell``
    (the strip number as text)."""
    L = strip_width(n_strips, margin)
    ra = checked(ra_col, "RA", F.col(ra_col) <= FULL_TURN)
    i = F.col("strip")
    below = F.when(i == 1, n_strips).otherwise(i - 1)
    above = F.when(i == n_strips, 1).otherwise(i + 1)
    neighbour = (F.when(F.col("_ra") <= (i - 1) * L + margin, below)
                 .when(F.col("_ra") >= i * L - margin, above))
    first = F.greatest(F.ceil(F.col("_ra") / F.lit(float(L))), F.lit(0)).cast("int")
    return (points.withColumn("_ra", ra).withColumn("strip", first)
            .withColumn("strip", F.explode(F.array_compact(F.array(i, neighbour))))
            .withColumn("cell", F.col("strip").cast("string")).drop("_ra"))
