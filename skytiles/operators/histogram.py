"""Points per cell with a logarithmic size bar (A6).

The bar has ``ceil(log10(n))`` characters: a bar of length b means
``10^(b-1) < n <= 10^b``, and a single point gives an empty bar. The
counts stay a distributed aggregate (partial counts before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coords import OVERFLOW_SUFFIX, log_bar, overflow_name

# --- Fixed value: separator of the printed histogram lines ("2.3-->***"). ---
HISTOGRAM_ARROW = "-->"


def cell_histogram(df: DataFrame, cell_col: str = "cell") -> DataFrame:
    """Rows ``cell, n_stars, bar``."""
    return (df.groupBy(F.col(cell_col).alias("cell"))
            .agg(F.count(F.lit(1)).alias("n_stars"))
            .withColumn("bar", log_bar("n_stars")))


def by_output(split: DataFrame, *aggregates: Column, out_col: str = "cell",
              suffix: str = OVERFLOW_SUFFIX) -> DataFrame:
    """Aggregates per output of a cap (columns ``cell, overflow``). The rows
    are grouped by the overflow number and the name is made once per output:
    it grows with the number, so it is no key to group or move rows by."""
    return (split.groupBy("cell", "overflow").agg(*aggregates)
            .withColumn("cell", overflow_name("cell", "overflow", suffix))
            .withColumnRenamed("cell", out_col).drop("overflow"))


def output_histogram(split: DataFrame, suffix: str = OVERFLOW_SUFFIX) -> DataFrame:
    """:func:`cell_histogram` of the outputs of a cap."""
    return by_output(split, F.count(F.lit(1)).alias("n_stars"), suffix=suffix) \
        .withColumn("bar", log_bar("n_stars"))


def capped_histogram(counts: DataFrame, cap: int,
                     suffix: str = OVERFLOW_SUFFIX) -> DataFrame:
    """The histogram of the outputs that a cap makes of cells with
    ``n_stars`` stars (columns ``cell, n_stars``): all but the last output of
    a cell are full. Needs no pass over the stars or the written files."""
    outputs = counts.select("cell", "n_stars", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n_stars") - 1) / cap))).alias("k"))
    n = F.least(F.lit(cap).cast("long"), F.col("n_stars") - F.col("k") * cap)
    return (outputs.select(overflow_name("cell", "k", suffix).alias("cell"), n.alias("n_stars"))
            .withColumn("bar", log_bar("n_stars")))


def histogram_lines(hist: DataFrame) -> DataFrame:
    """The histogram as text lines ``cell-->bar`` (column ``value``), the
    form the original jobs printed; write with ``write.text`` or show."""
    return hist.select(F.concat("cell", F.lit(HISTOGRAM_ARROW), "bar").alias("value"))
