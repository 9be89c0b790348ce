"""Size checks for small per-cell tables before they are broadcast or
brought to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest per-cell table broadcast to executors or collected on the driver.
# A grid for 128 MB outputs has this many cells at 12 TB; the rows keep a
# broadcast to a few MB. Larger tables are joined by shuffle.
MAX_SMALL_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most
    ``max_rows + 1`` of them)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """Broadcast hint only behind a checked row bound; otherwise the join
    falls back to a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def collect_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """Compute a small table once and keep it as a local relation; a table
    over the bound stays a lazy (distributed) DataFrame."""
    return _local(df, max_rows) or df


def ship_small(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> tuple[DataFrame, bool]:
    """A table computed once and broadcast, where it is small (as it is
    beyond that), and whether it is empty."""
    local = _local(df, max_rows)
    return (df, False) if local is None else (F.broadcast(local), local.isEmpty())


def _local(df: DataFrame, max_rows: int) -> DataFrame | None:
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)
