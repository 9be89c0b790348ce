import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import points_df
from skytiles.operators import assign_cell, bounds, cell_histogram
from skytiles.plans import (neighbour_assignment, run_grid_job,
                            run_object_summary_job, run_partition_job,
                            run_strip_job)
from skytiles.sinks import read_cells, read_rows, write_cells

PAYLOAD = T.StructType([T.StructField("source_id", T.LongType()),
                        T.StructField("ra", T.DoubleType()),
                        T.StructField("decl", T.DoubleType())])


def _random_points(spark, n=3000, seed=5):
    rnd = random.Random(seed)
    return points_df(spark, [(t, rnd.choice([None, 1, 2, 3]), rnd.uniform(350, 360),
                              rnd.uniform(-5, 5)) for t in range(n)])


def test_cell_names_do_not_merge(spark, tmp_dir):
    # With 11 columns, "1.1" and "1.10" both exist; inference would merge them.
    pts = _random_points(spark)
    cells = assign_cell(pts, bounds(pts), 11)
    write_cells(cells.select("cell", "source_id", "ra", "decl"), f"{tmp_dir}/c")
    back = read_cells(spark, f"{tmp_dir}/c", PAYLOAD)
    want = {r.cell: r["count"] for r in cells.groupBy("cell").count().collect()}
    got = {r.cell: r["count"] for r in back.groupBy("cell").count().collect()}
    assert "1.10" in got and "1.1" in got
    assert got == want


def test_csv_cells_hold_ra_decl_lines(spark, tmp_dir):
    pts = _random_points(spark, 200)
    cells = assign_cell(pts, bounds(pts), 3)
    write_cells(cells, f"{tmp_dir}/csv", columns=["ra", "decl"], fmt="csv")
    dirs = [d for d in os.listdir(f"{tmp_dir}/csv") if d.startswith("cell=")]
    assert len(dirs) == cells.select("cell").distinct().count()
    some = os.path.join(f"{tmp_dir}/csv", dirs[0])
    part = [f for f in os.listdir(some) if f.startswith("part-")][0]
    line = open(os.path.join(some, part)).readline().strip()
    assert len(line.split(",")) == 2


def test_partition_job_end_to_end(spark, tmp_dir):
    pts = _random_points(spark)
    hist = run_partition_job(pts, f"{tmp_dir}/out", min_cells=9, cap=200)
    written = read_cells(spark, f"{tmp_dir}/out", PAYLOAD, overflow=True)
    files = {r.cell + "bis" * r.k: r["count"]
             for r in written.groupBy("cell", "k").count().collect()}
    assert files == {r.cell: r.n_stars for r in hist.collect()}
    assert max(files.values()) <= 200 and any(c.endswith("bis") for c in files)


def test_a_cell_with_very_many_outputs(spark, tmp_dir):
    pts = points_df(spark, [(t, None, 5.0, 5.0) for t in range(1500)])
    hist = run_partition_job(pts, f"{tmp_dir}/deep", min_cells=1, cap=10)
    assert hist.count() == 150
    written = read_cells(spark, f"{tmp_dir}/deep", PAYLOAD, overflow=True)
    assert {r.k: r["count"] for r in written.groupBy("k").count().collect()} == {
        k: 10 for k in range(150)}


def test_jobs_leave_no_scratch_and_refuse_to_overwrite(spark, tmp_dir):
    from skytiles.session import checkpoint_root
    root = checkpoint_root(spark).removeprefix("file:")
    pts = _random_points(spark, 300)
    before = set(os.listdir(root))
    hists = [run_partition_job(pts, f"{tmp_dir}/p", min_cells=4, cap=50, store_points=True,
                               method="two_phase", rows_per_task=100),
             run_grid_job(pts, f"{tmp_dir}/g", min_cells=4, store_points=True),
             run_strip_job(pts, f"{tmp_dir}/s", store_points=True)]
    assert set(os.listdir(root)) == before
    assert all(h.agg(F.sum("n_stars")).first()[0] >= 300 for h in hists)
    for job, name in ((run_partition_job, "p"), (run_grid_job, "g"), (run_strip_job, "s")):
        with pytest.raises(Exception, match="already exists"):
            job(pts, f"{tmp_dir}/{name}")
    assert run_grid_job(pts, f"{tmp_dir}/g", mode="overwrite").count() > 0


def test_capped_histogram(spark):
    from skytiles.operators import capped_histogram
    counts = spark.createDataFrame([("0.0", 25), ("0.1", 10), ("1.0", 1)],
                                   "cell string, n_stars bigint")
    got = {r.cell: (r.n_stars, r.bar) for r in capped_histogram(counts, 10).collect()}
    assert got == {"0.0": (10, "*"), "0.0bis": (10, "*"), "0.0bisbis": (5, "*"),
                   "0.1": (10, "*"), "1.0": (1, "")}


def test_grid_and_strip_jobs(spark, tmp_dir):
    pts = _random_points(spark, 500)
    hist = run_grid_job(pts, f"{tmp_dir}/g", min_cells=4)
    assert hist.agg(F.sum("n_stars")).first()[0] == 500
    run_strip_job(pts, f"{tmp_dir}/s")
    assert spark.read.parquet(f"{tmp_dir}/s").count() >= 500


def test_summary_rows_round_trip(spark, tmp_dir):
    pts = _random_points(spark, 300)
    run_object_summary_job(pts, f"{tmp_dir}/sum")
    schema = "object_id bigint, n_sources bigint, last_source string, " \
             "min_ra double, max_ra double, min_decl double, max_decl double"
    back = read_rows(spark, f"{tmp_dir}/sum", schema)
    assert back.count() == 3
    assert back.agg(F.sum("n_sources")).first()[0] == \
        pts.where(F.col("object_id").isNotNull()).count()


def test_results_do_not_depend_on_partitioning(spark):
    pts = _random_points(spark, 1500)
    a = neighbour_assignment(pts.coalesce(1), min_cells=16, cap=50)
    b = neighbour_assignment(pts.repartition(7), min_cells=16, cap=50)
    key = ["source_id", "cell", "overflow", "cell_rank"]
    assert sorted(map(tuple, a.select(key).collect())) == \
        sorted(map(tuple, b.select(key).collect()))


def test_histogram_bars(sample_points):
    cells = assign_cell(sample_points, bounds(sample_points), 7)
    rows = cell_histogram(cells).collect()
    assert sum(r.n_stars for r in rows) == 56
    for r in rows:      # 10^(b-1) < n <= 10^b
        assert set(r.bar) <= {"*"} and 10 ** (len(r.bar) - 1) < r.n_stars <= 10 ** len(r.bar)


def test_salted_write_splits_a_hot_cell(spark, tmp_dir):
    # One cell holds most rows; with counts it is written by several tasks.
    rows = [(t, None, 0.0, 0.0) for t in range(3000)] + \
           [(3000 + t, None, 5.0, 5.0) for t in range(100)]
    pts = points_df(spark, rows).withColumn(
        "cell", F.when(F.col("ra") == 0.0, "0.0").otherwise("1.1"))
    hist = cell_histogram(pts)
    # An explicit partition count: AQE would merge tiny partitions back.
    write_cells(pts, f"{tmp_dir}/w", cell_counts=hist, rows_per_file=500,
                columns=["source_id", "ra", "decl"], num_partitions=16)
    hot = [f for f in os.listdir(f"{tmp_dir}/w/cell=0.0") if f.startswith("part-")]
    assert len(hot) >= 4
    back = read_cells(spark, f"{tmp_dir}/w", PAYLOAD)
    assert {r.cell: r["count"] for r in back.groupBy("cell").count().collect()} == \
        {"0.0": 3000, "1.1": 100}


def test_hash_and_range_writes_hold_the_same_rows(spark, tmp_dir):
    pts = _random_points(spark, 400)
    cells = assign_cell(pts, bounds(pts), 3).select("cell", "source_id", "ra", "decl")
    for mode in ("hash", "range"):
        write_cells(cells, f"{tmp_dir}/{mode}", partitioning=mode)
    a = read_cells(spark, f"{tmp_dir}/hash", PAYLOAD)
    b = read_cells(spark, f"{tmp_dir}/range", PAYLOAD)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_partition_job_csv_histogram(spark, tmp_dir):
    pts = _random_points(spark, 600)
    hist = run_partition_job(pts, f"{tmp_dir}/csv", fmt="csv", columns=["ra", "decl"],
                             min_cells=4, cap=100)
    assert hist.agg(F.sum("n_stars")).first()[0] == \
        neighbour_assignment(pts, min_cells=4, cap=100).count()
    assert hist.agg(F.max("n_stars")).first()[0] <= 100


def test_histogram_lines_format(spark):
    from skytiles.operators import histogram_lines
    df = spark.createDataFrame([("0.0",)] + [("2.3",)] * 11 + [("7.2",)] * 100, "cell string")
    got = sorted(r.value for r in histogram_lines(cell_histogram(df)).collect())
    assert got == ["0.0-->", "2.3-->**", "7.2-->**"]


def test_scratch_space_is_under_the_checkpoint_folder(spark):
    from skytiles.session import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(root + "/x-")


def test_partition_job_with_stored_points_matches(spark, tmp_dir):
    pts = _random_points(spark, 800)
    a = run_partition_job(pts, f"{tmp_dir}/a", min_cells=9, cap=60)
    b = run_partition_job(pts, f"{tmp_dir}/b", min_cells=9, cap=60, store_points=True)
    c = run_partition_job(pts, f"{tmp_dir}/c", min_cells=9, cap=60,
                          method="two_phase", rows_per_task=100)
    key = lambda h: sorted(map(tuple, h.collect()))
    assert key(a) == key(b) == key(c)


def _files(folder):
    return [f for f in os.listdir(folder) if f.startswith("part-")]


def test_rebalanced_write_splits_a_hot_cell(spark, tmp_dir):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k) for k in keys}
    pts = spark.range(60_000).select(
        F.col("id").alias("source_id"), F.rand(1).alias("ra"), F.rand(2).alias("decl"),
        F.when(F.col("id") % 20 > 0, "0.0").otherwise("1.1").alias("cell")).repartition(8)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = write_cells(pts, f"{tmp_dir}/r", partitioning="rebalance")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert n == 60_000
    assert len(_files(f"{tmp_dir}/r/cell=0.0")) >= 4 > len(_files(f"{tmp_dir}/r/cell=1.1"))
    back = read_cells(spark, f"{tmp_dir}/r", PAYLOAD)
    assert {r.cell: r["count"] for r in back.groupBy("cell").count().collect()} == \
        {"0.0": 57_000, "1.1": 3_000}


def test_jobs_raise_when_stars_are_lost(spark, tmp_dir, monkeypatch):
    from skytiles.plans import jobs
    pts = _random_points(spark, 300)
    real = jobs.write_cells
    monkeypatch.setattr(jobs, "write_cells",
                        lambda df, *a, **k: real(df.where("source_id <> 7"), *a, **k))
    for job, name in ((run_partition_job, "p"), (run_grid_job, "g"), (run_strip_job, "s")):
        with pytest.raises(RuntimeError, match="were counted"):
            job(pts, f"{tmp_dir}/{name}")


def test_a_damaged_output_shows_in_the_counted_files(spark, tmp_dir):
    import shutil
    pts = _random_points(spark, 400)
    hist = run_partition_job(pts, f"{tmp_dir}/d", min_cells=4, cap=60)
    some = next(c for c in sorted(os.listdir(f"{tmp_dir}/d")) if c.startswith("cell="))
    shutil.rmtree(f"{tmp_dir}/d/{some}/k=0")
    back = read_cells(spark, f"{tmp_dir}/d", PAYLOAD, overflow=True)
    files = {r.cell + "bis" * r.k: r["count"]
             for r in back.groupBy("cell", "k").count().collect()}
    assert files != {r.cell: r.n_stars for r in hist.collect()}
