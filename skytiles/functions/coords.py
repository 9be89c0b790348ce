"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values used by the catalogue jobs. ---
# Right ascension above this is re-centred by subtracting a full turn.
RA_WRAP = 180.0
FULL_TURN = 360.0
# Suffix appended to a cell name each time the cell overflows its cap.
OVERFLOW_SUFFIX = "bis"
# Character of the per-cell size bar.
BAR_CHAR = "*"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def good_coordinate(value: str | Column) -> Column:
    """True for a number a star can be placed by: not null, NaN or infinite."""
    value = _c(value)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def checked(value: str | Column, what: str, allowed: Column | None = None) -> Column:
    """The value, or an error when it is no good coordinate (or not
    ``allowed``). One rule for all assignments: a star is placed or the job
    stops; see :func:`skytiles.operators.quarantine` for the third way."""
    value = _c(value)
    good = good_coordinate(value) if allowed is None else good_coordinate(value) & allowed
    text = F.concat(F.lit(f"bad {what}: "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.when(good, value).otherwise(F.raise_error(text).cast("double"))


def recentre_ra(ra: str | Column) -> Column:
    """Map RA from [0, 360) to (-180, 180]: ``ra > 180 -> ra - 360``."""
    ra = _c(ra)
    return F.when(ra > RA_WRAP, ra - FULL_TURN).otherwise(ra)


def restore_ra(ra_centred: str | Column) -> Column:
    """Inverse of :func:`recentre_ra`: ``ra < 0 -> ra + 360``."""
    ra = _c(ra_centred)
    return F.when(ra < 0, ra + FULL_TURN).otherwise(ra)


def cell_name(i: str | Column, j: str | Column) -> Column:
    """Grid cell name ``"i.j"`` (concatenation of casts: no per-row
    formatter, stays in generated code)."""
    return F.concat(_c(i).cast("string"), F.lit("."), _c(j).cast("string"))


def overflow_name(cell: str | Column, k: str | Column,
                  suffix: str = OVERFLOW_SUFFIX) -> Column:
    """Name of the k-th overflow copy of a cell: the suffix repeated k times."""
    return F.concat(_c(cell), F.repeat(F.lit(suffix), _c(k).cast("int")))


def log_bar(n: str | Column, char: str = BAR_CHAR) -> Column:
    """Size bar of ``ceil(log10(n))`` characters; one star gives an empty bar."""
    return F.repeat(F.lit(char), F.ceil(F.log10(_c(n))).cast("int"))
