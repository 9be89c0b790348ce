"""Catalogue summaries: line counts (A1), per-object counts and summaries
(A2, A3) and bounding boxes (A4, A5).

All are single aggregates: Spark computes partial results map-side and
merges them after one small shuffle (or, for global aggregates, a single
one-row exchange), so the work per task stays bounded whatever the key
distribution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coords import recentre_ra


def line_counts(lines: DataFrame, first: str = "a", second: str = "b",
                col: str = "value") -> DataFrame:
    """A1: number of lines containing ``first`` and ``second`` (case-sensitive).

    Both counts come from one pass over the input.
    """
    value = F.col(col)
    return lines.agg(
        F.count_if(value.contains(first)).alias("lines_with_a"),
        F.count_if(value.contains(second)).alias("lines_with_b"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def object_counts(points: DataFrame, object_col: str = "object_id") -> DataFrame:
    """A2: detections per object; rows without an object are dropped (F1)."""
    return (points.where(F.col(object_col).isNotNull())
            .groupBy(object_col).agg(F.count(F.lit(1)).alias("n_sources")))


# Ids of up to 16 digits have a text key that is a long; the rare longer
# ones, of up to 19, have a decimal. A key is the digits, filled up with
# zeros behind, then two places for how many they are, so keys sort as the
# texts do. Negative ids come before all others and, by their digits, in the
# same order: their keys are moved below zero. SQL texts: a plan built of
# many small column objects takes longer than the query.
_KEYS = {
    "_short": "CASE WHEN length(_t) <= 16 THEN CAST(concat(rpad(_t, 16, '0'), "
              "lpad(length(_t), 2, '0')) AS BIGINT) - IF(_m, 4000000000000000000L, 0L) END",
    "_wide": "CASE WHEN length(_t) > 16 THEN CAST(CAST(concat(rpad(_t, 19, '0'), "
             "lpad(length(_t), 2, '0')) AS DECIMAL(23, 0)) "
             "- IF(_m, 10000000000000000000000BD, 0BD) AS DECIMAL(24, 0)) END"}
_KEY_TEXT = ("concat(IF({key} < 0, '-', ''), left({t}, CAST(right({t}, 2) AS INT)))")


def _last_as_text() -> tuple[list[Column], Column]:
    """The text maximum of integer ids as the maximum of a number, which a
    hash aggregate updates in place (it cannot keep a string). Returns the
    key columns, made of the digits ``_t`` and the sign ``_m``, and the text
    made of their maxima."""
    def text(key: str, places: int, below: str) -> str:
        padded = f"lpad(CAST(IF({key} < 0, {key} + {below}, {key}) AS STRING), {places}, '0')"
        return _KEY_TEXT.format(key=key, t=padded)

    return ([F.expr(sql).alias(name) for name, sql in _KEYS.items()],
            F.expr(f"greatest({text('_short', 18, '4000000000000000000L')}, "
                   f"{text('_wide', 21, '10000000000000000000000BD')})"))


def object_summary(points: DataFrame, object_col: str = "object_id",
                   source_col: str = "source_id", ra_col: str = "ra",
                   decl_col: str = "decl", numeric_last: bool = False) -> DataFrame:
    """A3: per object, the number of detections, the last source id and the
    RA/Decl ranges. Rows without an object are dropped (F1).

    ``last_source`` is the maximum source id compared as text (so ``"9"``
    is after ``"10"``), as the catalogue job does; ``numeric_last=True``
    compares numbers instead.
    """
    src = F.col(source_col)
    rows = points.where(F.col(object_col).isNotNull())
    if numeric_last:
        parts, last = {"last_source": F.max(src)}, F.col("last_source")
    elif isinstance(points.schema[source_col].dataType, T.IntegralType):
        keys, last = _last_as_text()
        rows = rows.select(object_col, ra_col, decl_col, (src < 0).alias("_m"),
                           F.ltrim(src.cast("string"), F.lit("-")).alias("_t"))
        rows = rows.select(object_col, ra_col, decl_col, *keys)
        parts = {name: F.max(name) for name in _KEYS}
    else:
        parts, last = {"last_source": F.max(src.cast("string"))}, F.col("last_source")
    return (rows.groupBy(object_col)
            .agg(F.count(F.lit(1)).alias("n_sources"),
                 *[c.alias(name) for name, c in parts.items()],
                 F.min(ra_col).alias("min_ra"), F.max(ra_col).alias("max_ra"),
                 F.min(decl_col).alias("min_decl"),
                 F.max(decl_col).alias("max_decl"))
            .select(object_col, "n_sources", last.alias("last_source"), "min_ra", "max_ra",
                    "min_decl", "max_decl"))


def bounds(points: DataFrame, ra_col: str = "ra", decl_col: str = "decl",
           recentre: bool = False) -> DataFrame:
    """A4 / A5: one-row bounding box ``min_ra, max_ra, min_decl, max_decl``.

    With ``recentre=True`` RA is first mapped to (-180, 180] (P2), which
    keeps a region straddling RA 0 compact.
    """
    ra = recentre_ra(ra_col) if recentre else F.col(ra_col)
    return points.agg(F.min(ra).alias("min_ra"), F.max(ra).alias("max_ra"),
                      F.min(decl_col).alias("min_decl"),
                      F.max(decl_col).alias("max_decl"))


def footer_bounds(spark: SparkSession, path: str | list[str], ra_col: str = "ra",
                  decl_col: str = "decl") -> DataFrame:
    """A4 of a Parquet catalogue from its file footers: Spark's aggregate
    push-down (the V2 reader) takes minimum and maximum of both columns
    from the footers' statistics and reads no row.

    The result is that of :func:`bounds`. Where a footer has no statistics
    of a column (a file with NaN, or one of nulls only) Spark refuses, and the
    files are scanned. Re-centred bounds are not known to footers. The files
    must have their columns in one order (Spark finds statistics by place).
    """
    files = [path] if isinstance(path, str) else list(path)
    own = spark.newSession()           # the settings are those of this read alone
    for key, value in FOOTER_SETTINGS.items():
        own.conf.set(key, value)
    box = bounds(own.read.parquet(*files), ra_col, decl_col)
    try:
        row = box.toArrow()
    except Exception as e:              # Spark's own class differs between its releases
        if NO_STATISTICS not in str(e):
            raise
        return bounds(spark.read.parquet(*files), ra_col, decl_col)
    # Footers write a least zero as -0.0.
    return spark.createDataFrame(row, box.schema).select(
        *[(F.col(c) + F.lit(0.0)).alias(c) for c in box.columns])


NO_STATISTICS = "No min/max found"
# The V1 reader, Spark's default for Parquet, does not push aggregates down.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "",
                   "spark.sql.parquet.aggregatePushdown": "true"}
