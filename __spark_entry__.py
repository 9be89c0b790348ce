"""

Every query reads the benchmark tables (through the points view derived
from ``lineitem``, see ``skytiles.sources.testdata``, or the text tables) and
runs over whole tables. Each oracle of the catalogue queries is plain SQL
in the brute-force form (edge counting by joining edge tables, theta joins
against every cell and strip), so it checks the operators' candidate-cell
and arithmetic shortcuts rather than repeating them.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytiles.functions.sizing import collect_small
from skytiles.operators import (assign_cell, assign_padded, assign_strips,
                                bounds, by_output, capacity_split, cell_counts,
                                cell_histogram, footer_bounds, grid_cells, grid_side, line_counts,
                                object_counts, object_summary, output_histogram, quarantine,
                                spread_outputs, with_out_cell)
from skytiles.plans import (neighbour_assignment, run_grid_job, run_object_count_job,
                            run_object_summary_job, run_partition_job, run_strip_job)
from skytiles.session import scratch_path
from skytiles.sinks import read_cells, read_rows
from skytiles.sources import document_lines, sky_points
from skytiles.sources.testdata import (SKY_ORDER, bad_sky_points, bad_sky_sql_view,
                                       hot_sky_points, hot_sky_sql_view, sky_sql_view)

# The text-pipeline operators are optional. (A folder without code has no origin.)
_llm = importlib.util.find_spec("skytiles.llm")
if _llm is not None and _llm.origin:
    import corpus_pipeline
    from skytiles.llm.queries import ORACLES as LLM_ORACLES
    from skytiles.llm.queries import QUERIES as LLM_QUERIES
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
else:
    LLM_ORACLES, LLM_QUERIES = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered queries.
MIN_CELLS = 40          # grid side 7
PAD = 0.1               # cell padding, degrees
SKY_PAD = 2.5           # the same, measured on the sky
OUTPUT_BYTES = 65_536   # target of the byte-sized outputs
CAP = 10000             # points per output cell in the partition job
SPLIT_CAP = 500         # a smaller cap, so the overflow cells appear
N_STRIPS = 40
STRIP_MARGIN = 1
N = grid_side(MIN_CELLS)


# ------------------------------------------------------------------ Spark

def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sky_points(spark, sf_dir)


def q_bounds(spark, sf_dir):
    return bounds(_points(spark, sf_dir))


def q_bounds_wrapped(spark, sf_dir):
    return bounds(_points(spark, sf_dir), recentre=True)


def q_catalog_scan(spark, sf_dir):
    return _points(spark, sf_dir).select("source_id", "object_id", "ra", "decl")


def q_line_counts(spark, sf_dir):
    return line_counts(document_lines(spark, sf_dir))


def q_object_counts(spark, sf_dir):
    return object_counts(_points(spark, sf_dir))


def q_object_summary(spark, sf_dir):
    return object_summary(_points(spark, sf_dir))


def q_object_summary_numeric(spark, sf_dir):
    return object_summary(_points(spark, sf_dir), numeric_last=True)


def q_grid_cells(spark, sf_dir):
    return grid_cells(bounds(_points(spark, sf_dir), recentre=True), N)


def q_grid_cells_column_band(spark, sf_dir):
    return grid_cells(bounds(_points(spark, sf_dir), recentre=True), N, decl_band="i")


def _cell_assign(spark, sf_dir):
    pts = _points(spark, sf_dir)
    return assign_cell(pts, bounds(pts), N)


def q_cell_assign(spark, sf_dir):
    return _cell_assign(spark, sf_dir).select(
        "source_id", "ra", "decl", "i", "j", "cell")


def q_cell_histogram(spark, sf_dir):
    return cell_histogram(_cell_assign(spark, sf_dir))


def q_ra_strips(spark, sf_dir):
    return assign_strips(_points(spark, sf_dir), N_STRIPS, STRIP_MARGIN).select(
        "source_id", "ra", "decl", "strip", "cell")


def q_strip_histogram(spark, sf_dir):
    return cell_histogram(assign_strips(_points(spark, sf_dir), N_STRIPS,
                                        STRIP_MARGIN))


def _padded(spark, sf_dir, decl_band="j"):
    pts = _points(spark, sf_dir)
    return assign_padded(pts, bounds(pts, recentre=True), N, PAD, PAD,
                         decl_band=decl_band)


def q_padded_cells(spark, sf_dir):
    return _padded(spark, sf_dir).select("source_id", "ra", "decl", "i", "j", "cell")


def q_padded_cells_column_band(spark, sf_dir):
    return _padded(spark, sf_dir, "i").select(
        "source_id", "ra", "decl", "i", "j", "cell")


def q_padded_cells_sphere(spark, sf_dir):
    """G4 with the padding measured on the sky: the catalogue goes round the
    whole circle, so stars near RA 180 are in cells at both ends."""
    pts = _points(spark, sf_dir)
    return assign_padded(pts, bounds(pts, recentre=True), N, SKY_PAD, SKY_PAD, sphere=True) \
        .select("source_id", "ra", "decl", "i", "j", "cell")


def _named_split(padded, stars, **how):
    split = capacity_split(padded, SPLIT_CAP, order_by=SKY_ORDER, **how)
    return with_out_cell(spread_outputs(split, stars, SPLIT_CAP)).select(
        "source_id", "ra", "decl", "cell", "cell_rank", "out_cell")


def q_capacity_split(spark, sf_dir):
    padded = _padded(spark, sf_dir)
    counts = collect_small(cell_counts(padded))
    return _named_split(padded, counts, counts=counts)


def q_capacity_split_two_phase(spark, sf_dir):
    # Same result through the skew-splitting path: with a task budget of
    # 1/64 of the points the average cell is too large for a task.
    padded = _padded(spark, sf_dir)
    return _named_split(padded, collect_small(cell_counts(padded)), method="two_phase",
                        rows_per_task=-(-_points(spark, sf_dir).count() // 64))


def q_partition_job(spark, sf_dir):
    pts = _points(spark, sf_dir)
    pairs = neighbour_assignment(pts, MIN_CELLS, PAD, PAD, CAP,
                                 order_by=tuple(SKY_ORDER),
                                 cell_rows_bound=pts.count())  # parquet footers
    return output_histogram(pairs)


def q_bad_coordinates_quarantine(spark, sf_dir):
    """Stars without a coordinate are parted off; the others get their cell.
    Every row is counted once, under a cell or under ``quarantine``."""
    good, bad = quarantine(bad_sky_points(spark, sf_dir))
    cells = assign_cell(good, bounds(good), N).select("cell", "source_id") \
        .unionByName(bad.select(F.lit("quarantine").alias("cell"), "source_id"))
    return cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n_stars"),
                                     F.sum("source_id").alias("sum_source_id"))


def q_cell_sink_roundtrip(spark, sf_dir):
    """K1 through the grid job (J1): write one directory per cell, read the
    cells back, summarise per cell."""
    path = scratch_path(spark, "cell-sink")
    run_grid_job(_points(spark, sf_dir), path, MIN_CELLS,
                 columns=["source_id", "ra", "decl"])
    payload = T.StructType([T.StructField("source_id", T.LongType()),
                            T.StructField("ra", T.DoubleType()),
                            T.StructField("decl", T.DoubleType())])
    back = read_cells(spark, path, payload)
    return back.groupBy("cell").agg(F.count(F.lit(1)).alias("n_stars"),
                                    F.min("source_id").alias("min_source_id"),
                                    F.max("source_id").alias("max_source_id"),
                                    F.min("ra").alias("min_ra"),
                                    F.max("decl").alias("max_decl"))


def q_strip_sink_roundtrip(spark, sf_dir):
    """K1 through the strip job (J2): one directory per strip, read back."""
    path = scratch_path(spark, "strip-sink")
    run_strip_job(_points(spark, sf_dir), path, N_STRIPS, STRIP_MARGIN,
                  columns=["source_id", "ra", "decl"])
    payload = T.StructType([T.StructField("source_id", T.LongType()),
                            T.StructField("ra", T.DoubleType())])
    back = read_cells(spark, path, payload)
    return back.groupBy("cell").agg(F.count(F.lit(1)).alias("n_stars"),
                                    F.min("source_id").alias("min_source_id"),
                                    F.max("ra").alias("max_ra"))


_POINT = T.StructType([T.StructField("source_id", T.LongType()),
                       T.StructField("ra", T.DoubleType()),
                       T.StructField("decl", T.DoubleType())])


def _written_outputs(spark, path):
    """The outputs of a partition job, counted in the files."""
    back = read_cells(spark, path, _POINT, overflow=True)
    return output_histogram(back.withColumnRenamed("k", "overflow"))


def q_partition_sink_roundtrip(spark, sf_dir):
    """K1 through the neighbour-aware job (J3) end to end, with the job's
    own cap: capped, written one directory per output; histogram of the
    written files."""
    path = scratch_path(spark, "partition-sink")
    run_partition_job(_points(spark, sf_dir), path, columns=["source_id", "ra", "decl"],
                      min_cells=MIN_CELLS, ra_pad=PAD, decl_pad=PAD,
                      cap=CAP, order_by=tuple(SKY_ORDER))
    return _written_outputs(spark, path)


def q_partition_sink_column_band(spark, sf_dir):
    """J3 as published: the Decl band from the column index, `ra,decl` text
    files; the stars counted and their coordinates summed up in the files."""
    path = scratch_path(spark, "band-sink")
    run_partition_job(_points(spark, sf_dir), path, columns=["ra", "decl"], fmt="csv",
                      min_cells=MIN_CELLS, ra_pad=PAD, decl_pad=PAD, cap=SPLIT_CAP,
                      order_by=tuple(SKY_ORDER), decl_band="i")
    back = read_cells(spark, path, T.StructType(_POINT.fields[1:]), fmt="csv", overflow=True)
    return by_output(
        back.withColumnRenamed("k", "overflow"),
        F.count(F.lit(1)).alias("n_stars"), F.min("ra").alias("min_ra"),
        F.max("ra").alias("max_ra"), F.min("decl").alias("min_decl"),
        F.max("decl").alias("max_decl"), F.countDistinct("ra", "decl").alias("n_places"))


def q_hot_region_partition_sink(spark, sf_dir):
    """J3 end to end where one cell holds about a third of all stars (a
    hot region derived from every row of lineitem). With a task budget of
    1/16 of the points, the cap's auto method detects the hot cell and
    divides it by counting; the outputs are read back from the files, with
    the sum of their ids, so a wrong rank shows."""
    pts = hot_sky_points(spark, sf_dir)
    budget = -(-pts.count() // 16)
    path = scratch_path(spark, "hot-sink")
    run_partition_job(pts, path, columns=["source_id", "ra", "decl"],
                      min_cells=MIN_CELLS, ra_pad=PAD, decl_pad=PAD, cap=CAP,
                      order_by=tuple(SKY_ORDER), rows_per_task=budget)
    back = read_cells(spark, path, _POINT, overflow=True)
    return by_output(
        back.withColumnRenamed("k", "overflow"),
        F.count(F.lit(1)).alias("n_stars"), F.sum("source_id").alias("sum_source_id"),
        F.min("source_id").alias("min_source_id"), F.max("source_id").alias("max_source_id"))


def q_deep_overflow_sink(spark, sf_dir):
    """J3 on the hot region with a cap of 1/400 of the points, so the hot
    cell has more than 100 outputs at every scale; counted in the files."""
    pts = hot_sky_points(spark, sf_dir)
    path = scratch_path(spark, "deep-sink")
    run_partition_job(pts, path, columns=["source_id", "ra", "decl"], min_cells=MIN_CELLS,
                      ra_pad=PAD, decl_pad=PAD, cap=-(-pts.count() // 400),
                      order_by=tuple(SKY_ORDER))
    return _written_outputs(spark, path)


def q_byte_sized_partition_sink(spark, sf_dir):
    """J3 with its cap from a byte target, on the hot region. Stars and ids
    are counted in the files, and the files are weighed: outputs over twice
    the target, and outputs under half of it that are not their cell's last."""
    path = scratch_path(spark, "sized-sink")
    run_partition_job(hot_sky_points(spark, sf_dir), path, columns=["source_id", "ra", "decl"],
                      min_cells=MIN_CELLS, ra_pad=PAD, decl_pad=PAD,
                      order_by=tuple(SKY_ORDER), target_bytes=OUTPUT_BYTES)
    stars = read_cells(spark, path, _POINT, overflow=True).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n_stars"), F.sum("source_id").alias("sum_source_id"))
    place = r"cell=([^/]+)/k=(\d+)/"
    outputs = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "part-*").load(path).select("path", "length")
               .groupBy(F.regexp_extract("path", place, 1).alias("cell"),
                        F.regexp_extract("path", place, 2).cast("long").alias("k"))
               .agg(F.sum("length").alias("bytes")))
    last = outputs.groupBy("cell").agg(F.max("k").alias("last"))
    sizes = outputs.join(last, "cell").groupBy("cell").agg(
        F.count_if(F.col("bytes") > 2 * OUTPUT_BYTES).alias("n_too_large"),
        F.count_if((F.col("bytes") < OUTPUT_BYTES / 2) & (F.col("k") < F.col("last")))
        .alias("n_too_small"))
    return stars.join(sizes, "cell", "full")


def q_source_csv_scan(spark, sf_dir):
    """S1 on whole tables: the points view laid out as the 107-column
    Source catalogue (header-less CSV, ``NULL`` for missing values; the
    three point columns and the id filled, the rest null), scanned back
    positionally with the declared schema, then summarised per object."""
    from skytiles.sources import read_source, source_points, source_schema, write_catalog

    pts = _points(spark, sf_dir)
    filled = {"sourceId": "source_id", "objectId": "object_id",
              "ra": "ra", "decl": "decl"}
    layout = [(F.col(filled[f.name]) if f.name in filled else F.lit(None))
              .cast(f.dataType).alias(f.name) for f in source_schema().fields]
    path = scratch_path(spark, "source-csv")
    write_catalog(pts.select(*layout), path)
    return object_summary(source_points(read_source(spark, path)))


def q_object_csv_scan(spark, sf_dir):
    """S2 on whole tables: the points laid out as the 229-column Object
    catalogue (id, coordinates, one value of the first and of the last
    band, the last column), scanned back positionally."""
    from skytiles.sources import object_schema, read_object, write_catalog

    filled = {"objectId": F.col("source_id"), "iauId": F.concat(F.lit("J"), F.col("l_partkey")),
              "ra_PS": F.col("ra"), "decl_PS": F.col("decl"), "uNumObs": F.col("l_suppkey"),
              "yFlags": F.col("object_id"), "subChunkId": F.col("l_partkey")}
    layout = [filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
              for f in object_schema().fields]
    path = scratch_path(spark, "object-csv")
    write_catalog(_points(spark, sf_dir).select(*layout), path)
    return read_object(spark, path).select(
        F.col("objectId").alias("object_id"), F.col("iauId").alias("iau_id"),
        F.col("ra_PS").alias("ra"), F.col("decl_PS").alias("decl"),
        F.col("uNumObs").alias("u_obs"), F.col("yFlags").alias("y_flags"),
        F.col("subChunkId").alias("sub_chunk"))


def q_source_csv_rejects(spark, sf_dir):
    """S1 with malformed lines: the points in the Source layout, some with a
    text in place of RA, some cut off after five fields. Every line is
    counted under ``good`` or the reason it is rejected for."""
    from skytiles.sources import scan_with_rejects, source_schema
    from skytiles.sources.catalog import CSV_OPTIONS, WRITE_OPTIONS

    first = F.col("source_id") % 8 == 1
    filled = {"sourceId": F.col("source_id"), "objectId": F.col("object_id"),
              "ra": F.when(first & F.col("object_id").isNull(), "n/a").otherwise(
                  F.col("ra").cast("string")), "decl": F.col("decl")}
    layout = [filled.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
              for f in source_schema().fields]
    line = F.to_csv(F.struct(*layout), {"sep": ",", "nullValue": CSV_OPTIONS["nullValue"]})
    cut = (F.col("source_id") % 8 == 2) & F.col("object_id").isNotNull()
    path = scratch_path(spark, "source-rejects")
    _points(spark, sf_dir).select(F.when(cut, F.substring_index(line, ",", 5)).otherwise(line)
                                  .alias("value")).write.options(**WRITE_OPTIONS).text(path)
    rows, rejects = scan_with_rejects(spark, path, source_schema())
    lines = rows.select(F.lit("good").alias("outcome"), F.col("sourceId").alias("id")).union(
        rejects.select("reason", F.substring_index("line", ",", 1).cast("long")))
    return lines.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_lines"),
                                        F.sum("id").alias("sum_source_id"))


def q_bounds_from_footers(spark, sf_dir):
    """A4 of a Parquet catalogue (the points view, written) from the file
    footers alone."""
    path = scratch_path(spark, "footer-points")
    _points(spark, sf_dir).select("source_id", "ra", "decl").write.parquet(path)
    return footer_bounds(spark, path)


SUMMARY_SCHEMA = T.StructType([
    T.StructField("object_id", T.LongType()),
    T.StructField("n_sources", T.LongType()),
    T.StructField("last_source", T.StringType()),
    T.StructField("min_ra", T.DoubleType()),
    T.StructField("max_ra", T.DoubleType()),
    T.StructField("min_decl", T.DoubleType()),
    T.StructField("max_decl", T.DoubleType()),
])


def q_summary_sink_roundtrip(spark, sf_dir):
    """K2 through the summary job (J4): text lines, read back."""
    path = scratch_path(spark, "summary-sink")
    run_object_summary_job(_points(spark, sf_dir), path)
    return read_rows(spark, path, SUMMARY_SCHEMA)


def q_count_sink_roundtrip(spark, sf_dir):
    """K2 through the count job (J5): text lines, read back."""
    path = scratch_path(spark, "count-sink")
    run_object_count_job(_points(spark, sf_dir), path)
    return read_rows(spark, path, "object_id bigint, n_sources bigint")


def q_stream_partition_job(spark, sf_dir):
    """Streaming J3: the points arrive as several files, processed one file
    per micro-batch; the cap per output cell holds across batches."""
    from skytiles.streaming import read_stream_output, start_partition_stream

    pts = _points(spark, sf_dir).select("source_id", "ra", "decl", *SKY_ORDER[3:])
    landing = scratch_path(spark, "stream-landing")
    pts.repartition(4, "source_id").write.parquet(landing)
    box = tuple(bounds(pts, recentre=True).first())  # four numbers
    stream = (spark.readStream.schema(pts.schema).option("maxFilesPerTrigger", 1)
              .parquet(landing))
    out, ckpt = (scratch_path(spark, p) for p in ("stream-out", "stream-ckpt"))
    q = start_partition_stream(stream, box, N, out, ckpt, cap=SPLIT_CAP, ra_pad=PAD,
                               decl_pad=PAD, columns=["source_id", "ra", "decl"])
    q.awaitTermination()
    written = read_stream_output(spark, out, "source_id bigint, ra double, decl double")
    return output_histogram(written.withColumnRenamed("k", "overflow"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the neighbour-aware partition job (J3) on sf0.001,
    reported as the per-output-cell histogram."""
    return q_partition_job(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "bounds": q_bounds,
        "bounds_wrapped": q_bounds_wrapped,
        "catalog_scan": q_catalog_scan,
        "source_csv_scan": q_source_csv_scan,
        "object_csv_scan": q_object_csv_scan,
        "source_csv_rejects": q_source_csv_rejects,
        "bounds_from_footers": q_bounds_from_footers,
        "line_counts": q_line_counts,
        "object_counts": q_object_counts,
        "object_summary": q_object_summary,
        "object_summary_numeric": q_object_summary_numeric,
        "grid_cells": q_grid_cells,
        "grid_cells_column_band": q_grid_cells_column_band,
        "cell_assign": q_cell_assign,
        "cell_histogram": q_cell_histogram,
        "ra_strips": q_ra_strips,
        "strip_histogram": q_strip_histogram,
        "padded_cells": q_padded_cells,
        "padded_cells_column_band": q_padded_cells_column_band,
        "padded_cells_sphere": q_padded_cells_sphere,
        "capacity_split": q_capacity_split,
        "capacity_split_two_phase": q_capacity_split_two_phase,
        "partition_job": q_partition_job,
        "cell_sink_roundtrip": q_cell_sink_roundtrip,
        "strip_sink_roundtrip": q_strip_sink_roundtrip,
        "partition_sink_roundtrip": q_partition_sink_roundtrip,
        "partition_sink_column_band": q_partition_sink_column_band,
        "hot_region_partition_sink": q_hot_region_partition_sink,
        "deep_overflow_sink": q_deep_overflow_sink,
        "byte_sized_partition_sink": q_byte_sized_partition_sink,
        "bad_coordinates_quarantine": q_bad_coordinates_quarantine,
        "summary_sink_roundtrip": q_summary_sink_roundtrip,
        "count_sink_roundtrip": q_count_sink_roundtrip,
        "stream_partition_job": q_stream_partition_job,
        **LLM_QUERIES,
    }


# ----------------------------------------------------------------- oracle

_SKY = f"sky AS (\n  {sky_sql_view()}\n)"
_HOT_SKY = f"sky AS (\n  {hot_sky_sql_view()}\n)"
_WRAPPED = ("wsky AS (SELECT *, CASE WHEN ra > 180 THEN ra - 360 ELSE ra END"
            " AS ra_c FROM sky)")
_BOUNDS_RAW = (f"b AS (SELECT min(ra) AS x0, min(decl) AS y0,"
               f" (max(ra) - min(ra)) / {N} AS w,"
               f" (max(decl) - min(decl)) / {N} AS h FROM sky)")
_BOUNDS_WRAPPED = (f"b AS (SELECT min(ra_c) AS x0, min(decl) AS y0,"
                   f" (max(ra_c) - min(ra_c)) / {N} AS w,"
                   f" (max(decl) - min(decl)) / {N} AS h,"
                   f" max(ra_c) AS x1, max(decl) AS y1 FROM wsky)")
_IDX = f"k AS (SELECT CAST(range AS INTEGER) AS k FROM range({N}))"
# The last column / row ends at the box's maximum.
_CELLS = ("cells AS (SELECT ci.k AS i, cj.k AS j,"
          " b.x0 + CAST(ci.k AS DOUBLE) * b.w AS left_ra,"
          f" CASE WHEN ci.k = {N} - 1 THEN b.x1"
          " ELSE b.x0 + CAST(ci.k + 1 AS DOUBLE) * b.w END AS right_ra,"
          " b.y0 + CAST({row} AS DOUBLE) * b.h AS low_decl,"
          f" CASE WHEN {{row}} = {N} - 1 THEN b.y1"
          " ELSE b.y0 + CAST({row} + 1 AS DOUBLE) * b.h END AS high_decl"
          " FROM k ci, k cj, b)")
_NAME = "CAST({i} AS VARCHAR) || '.' || CAST({j} AS VARCHAR)"
_BAR = "repeat('*', CAST(ceil(log10(count(*))) AS INTEGER))"

# Edge counting as the original loop does it: i = edges below RA,
# j = edges below Decl unless i = 0.
_ASSIGN = f"""
WITH {_SKY},
{_BOUNDS_RAW},
{_IDX},
ai AS (
  SELECT s.*, CAST((SELECT count(*) FROM k
                    WHERE s.ra > b.x0 + CAST(k.k AS DOUBLE) * b.w) AS INTEGER) AS i,
         CAST((SELECT count(*) FROM k
               WHERE s.decl > b.y0 + CAST(k.k AS DOUBLE) * b.h) AS INTEGER) AS jd
  FROM sky s, b
),
assigned AS (
  SELECT *, CASE WHEN i = 0 THEN 0 ELSE jd END AS j FROM ai
)"""

_PADDED = f"""
WITH {_SKY},
{_WRAPPED},
{_BOUNDS_WRAPPED},
{_IDX},
{{cells}},
pairs AS (
  SELECT s.source_id, s.ra, s.decl, s.l_partkey, s.l_suppkey, s.l_shipdate,
         c.i, c.j, {_NAME.format(i="c.i", j="c.j")} AS cell
  FROM wsky s JOIN cells c
    ON s.ra_c >= c.left_ra - CAST({PAD} AS DOUBLE)
   AND s.ra_c <= c.right_ra + CAST({PAD} AS DOUBLE)
   AND s.decl >= c.low_decl - CAST({PAD} AS DOUBLE)
   AND s.decl <= c.high_decl + CAST({PAD} AS DOUBLE)
)"""


def _padded_sql(row: str, hot: bool = False) -> str:
    sql = _PADDED.format(cells=_CELLS.format(row=row))
    return sql.replace(_SKY, _HOT_SKY) if hot else sql


_RANKED = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cell ORDER BY
            source_id, ra, decl, l_partkey, l_suppkey, l_shipdate) AS cell_rank
  FROM pairs
),
split AS (
  SELECT *, cell || repeat('bis', CAST(floor((cell_rank - 1) / {cap}) AS INTEGER))
            AS out_cell
  FROM ranked
)"""

# A star belongs to every strip whose closed interval, widened by the
# margin, holds it on the circle. RA 0 lies on the edge before strip 1.
_STRIPS = f"""
WITH {_SKY},
strip AS (SELECT CAST(range AS INTEGER) AS strip,
                 (range - 1) * {360 // N_STRIPS} - {STRIP_MARGIN} AS low,
                 range * {360 // N_STRIPS} + {STRIP_MARGIN} AS high
          FROM range(1, {N_STRIPS} + 1)),
strips AS (
  SELECT source_id, ra, decl, strip FROM sky, strip
  WHERE ra > 0 AND (ra BETWEEN low AND high OR ra + 360 BETWEEN low AND high
                    OR ra - 360 BETWEEN low AND high)
  UNION ALL
  SELECT source_id, ra, decl, unnest([0, 1]) FROM sky WHERE ra = 0
)"""


def oracle_sql() -> dict[str, str]:
    summary = f"""
WITH {_SKY}
SELECT object_id, count(*) AS n_sources,
       max(CAST(source_id AS VARCHAR)) AS last_source,
       min(ra) AS min_ra, max(ra) AS max_ra,
       min(decl) AS min_decl, max(decl) AS max_decl
FROM sky WHERE object_id IS NOT NULL GROUP BY object_id"""
    return {
        "bounds": f"""
WITH {_SKY}
SELECT min(ra) AS min_ra, max(ra) AS max_ra,
       min(decl) AS min_decl, max(decl) AS max_decl FROM sky""",
        "bounds_from_footers": f"""
WITH {_SKY}
SELECT min(ra) AS min_ra, max(ra) AS max_ra,
       min(decl) AS min_decl, max(decl) AS max_decl FROM sky""",
        "source_csv_rejects": f"""
WITH {_SKY}
SELECT CASE WHEN source_id % 8 = 2 AND object_id IS NOT NULL THEN '5 fields'
            WHEN source_id % 8 = 1 AND object_id IS NULL THEN 'bad ra' ELSE 'good' END AS outcome,
       count(*) AS n_lines, CAST(sum(source_id) AS BIGINT) AS sum_source_id
FROM sky GROUP BY 1""",
        "bounds_wrapped": f"""
WITH {_SKY}, {_WRAPPED}
SELECT min(ra_c) AS min_ra, max(ra_c) AS max_ra,
       min(decl) AS min_decl, max(decl) AS max_decl FROM wsky""",
        "catalog_scan": f"""
WITH {_SKY}
SELECT source_id, object_id, ra, decl FROM sky""",
        "line_counts": """
WITH lines AS (
  SELECT unnest(string_split(text, chr(10))) AS value FROM documents
)
SELECT count(*) FILTER (WHERE contains(value, 'a')) AS lines_with_a,
       count(*) FILTER (WHERE contains(value, 'b')) AS lines_with_b,
       count(*) AS n_lines
FROM lines""",
        "object_counts": f"""
WITH {_SKY}
SELECT object_id, count(*) AS n_sources
FROM sky WHERE object_id IS NOT NULL GROUP BY object_id""",
        "object_summary": summary,
        "source_csv_scan": summary,
        "object_csv_scan": f"""
WITH {_SKY}
SELECT source_id AS object_id, 'J' || CAST(l_partkey AS VARCHAR) AS iau_id, ra, decl,
       l_suppkey AS u_obs, object_id AS y_flags, l_partkey AS sub_chunk
FROM sky""",
        "count_sink_roundtrip": f"""
WITH {_SKY}
SELECT object_id, count(*) AS n_sources
FROM sky WHERE object_id IS NOT NULL GROUP BY object_id""",
        "bad_coordinates_quarantine": _ASSIGN.replace(
            _SKY, f"all_sky AS ({bad_sky_sql_view()}),\nsky AS (SELECT * FROM all_sky"
                  " WHERE ra IS NOT NULL AND decl IS NOT NULL)") + f"""
SELECT {_NAME.format(i="i", j="j")} AS cell, count(*) AS n_stars,
       CAST(sum(source_id) AS BIGINT) AS sum_source_id
FROM assigned GROUP BY 1
UNION ALL
SELECT 'quarantine', count(*), CAST(sum(source_id) AS BIGINT)
FROM all_sky WHERE ra IS NULL OR decl IS NULL""",
        "deep_overflow_sink": _padded_sql("cj.k", hot=True) + _RANKED.format(
            cap="(SELECT CAST(ceil(count(*) / 400.0) AS BIGINT) FROM sky)") + f"""
SELECT out_cell AS cell, count(*) AS n_stars, {_BAR} AS bar
FROM split GROUP BY out_cell""",
        "partition_sink_column_band": _padded_sql("ci.k") + _RANKED.format(cap=SPLIT_CAP) + """
SELECT out_cell AS cell, count(*) AS n_stars, min(ra) AS min_ra, max(ra) AS max_ra,
       min(decl) AS min_decl, max(decl) AS max_decl,
       count(DISTINCT (ra, decl)) AS n_places
FROM split GROUP BY out_cell""",
        "grid_cells": f"""
WITH {_SKY}, {_WRAPPED}, {_BOUNDS_WRAPPED}, {_IDX}, {_CELLS.format(row="cj.k")}
SELECT {_NAME.format(i="i", j="j")} AS cell, i, j,
       left_ra, right_ra, low_decl, high_decl
FROM cells""",
        "grid_cells_column_band": f"""
WITH {_SKY}, {_WRAPPED}, {_BOUNDS_WRAPPED}, {_IDX}, {_CELLS.format(row="ci.k")}
SELECT {_NAME.format(i="i", j="j")} AS cell, i, j,
       left_ra, right_ra, low_decl, high_decl
FROM cells""",
        "object_summary_numeric": f"""
WITH {_SKY}
SELECT object_id, count(*) AS n_sources, max(source_id) AS last_source,
       min(ra) AS min_ra, max(ra) AS max_ra,
       min(decl) AS min_decl, max(decl) AS max_decl
FROM sky WHERE object_id IS NOT NULL GROUP BY object_id""",
        "cell_assign": _ASSIGN + f"""
SELECT source_id, ra, decl, i, j, {_NAME.format(i="i", j="j")} AS cell
FROM assigned""",
        "cell_histogram": _ASSIGN + f"""
SELECT {_NAME.format(i="i", j="j")} AS cell, count(*) AS n_stars, {_BAR} AS bar
FROM assigned GROUP BY 1""",
        "ra_strips": _STRIPS + """
SELECT source_id, ra, decl, strip, CAST(strip AS VARCHAR) AS cell FROM strips""",
        "strip_histogram": _STRIPS + f"""
SELECT CAST(strip AS VARCHAR) AS cell, count(*) AS n_stars, {_BAR} AS bar
FROM strips GROUP BY 1""",
        "padded_cells": _padded_sql("cj.k") + """
SELECT source_id, ra, decl, i, j, cell FROM pairs""",
        "padded_cells_column_band": _padded_sql("ci.k") + """
SELECT source_id, ra, decl, i, j, cell FROM pairs""",
        # Every star against every cell, a full turn to either side as well.
        "padded_cells_sphere": f"""
WITH {_SKY},
{_WRAPPED},
{_BOUNDS_WRAPPED},
{_IDX},
{_CELLS.format(row="cj.k")},
reach AS (
  SELECT *, CASE WHEN abs(decl) + {SKY_PAD} >= 90 THEN 180.0 ELSE
    degrees(asin(least(1.0, sin(radians({SKY_PAD})) / cos(radians(decl))))) END AS reach
  FROM wsky
)
SELECT s.source_id, s.ra, s.decl, c.i, c.j, {_NAME.format(i="c.i", j="c.j")} AS cell
FROM reach s JOIN cells c
  ON s.decl >= c.low_decl - CAST({SKY_PAD} AS DOUBLE)
 AND s.decl <= c.high_decl + CAST({SKY_PAD} AS DOUBLE)
 AND (s.ra_c BETWEEN c.left_ra - reach AND c.right_ra + reach
      OR s.ra_c - 360 BETWEEN c.left_ra - reach AND c.right_ra + reach
      OR s.ra_c + 360 BETWEEN c.left_ra - reach AND c.right_ra + reach)""",
        "byte_sized_partition_sink": _padded_sql("cj.k", hot=True) + """
SELECT cell, count(*) AS n_stars, CAST(sum(source_id) AS BIGINT) AS sum_source_id,
       CAST(0 AS BIGINT) AS n_too_large, CAST(0 AS BIGINT) AS n_too_small
FROM pairs GROUP BY cell""",
        "capacity_split": _padded_sql("cj.k") + _RANKED.format(cap=SPLIT_CAP) + """
SELECT source_id, ra, decl, cell, cell_rank, out_cell FROM split""",
        "capacity_split_two_phase": _padded_sql("cj.k") + _RANKED.format(cap=SPLIT_CAP)
        + """
SELECT source_id, ra, decl, cell, cell_rank, out_cell FROM split""",
        "partition_job": _padded_sql("cj.k") + _RANKED.format(cap=CAP) + f"""
SELECT out_cell AS cell, count(*) AS n_stars, {_BAR} AS bar
FROM split GROUP BY out_cell""",
        "cell_sink_roundtrip": _ASSIGN + f"""
SELECT {_NAME.format(i="i", j="j")} AS cell, count(*) AS n_stars,
       min(source_id) AS min_source_id, max(source_id) AS max_source_id,
       min(ra) AS min_ra, max(decl) AS max_decl
FROM assigned GROUP BY 1""",
        "summary_sink_roundtrip": summary,
        "strip_sink_roundtrip": _STRIPS + """
SELECT CAST(strip AS VARCHAR) AS cell, count(*) AS n_stars,
       min(source_id) AS min_source_id, max(ra) AS max_ra
FROM strips GROUP BY 1""",
        "hot_region_partition_sink": _padded_sql("cj.k", hot=True)
        + _RANKED.format(cap=CAP) + """
SELECT out_cell AS cell, count(*) AS n_stars, CAST(sum(source_id) AS BIGINT) AS sum_source_id,
       min(source_id) AS min_source_id, max(source_id) AS max_source_id
FROM split GROUP BY out_cell""",
        "partition_sink_roundtrip": _padded_sql("cj.k") + _RANKED.format(cap=CAP)
        + f"""
SELECT out_cell AS cell, count(*) AS n_stars, {_BAR} AS bar
FROM split GROUP BY out_cell""",
        # Counts per output cell do not depend on the arrival order.
        "stream_partition_job": _padded_sql("cj.k") + _RANKED.format(cap=SPLIT_CAP) + f"""
SELECT out_cell AS cell, count(*) AS n_stars, {_BAR} AS bar
FROM split GROUP BY out_cell""",
        **LLM_ORACLES,
    }
