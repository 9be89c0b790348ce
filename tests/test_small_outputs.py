"""Outputs of few rows: written by the tasks themselves, read by their paths."""
import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import WriterCommitMessage

from conftest import points_df
from skytiles.plans import run_partition_job
from skytiles.sinks import read_cells, write_cells
from skytiles.sinks import small

SCHEMA = "id bigint, text string, x double, day date, at timestamp, n int"


def _rows(spark):
    rnd = random.Random(8)
    odd = [None, "", " a ", 'say "so"', "a,b", "new\nline", "häuser", "\\", "#", "x" * 40]
    reals = [None, 0.1, -0.0, 1e-7, 1e300, float("inf"), float("nan"), 123456789.25]
    names = ["0.1", "0.10", "a b", "x/y%z", "p+q", "é:=", None]
    return spark.createDataFrame(
        [(rnd.choice(names), k % 3, k, rnd.choice(odd), rnd.choice(reals),
          rnd.choice([None, dt.date(2020, 1, 1 + k % 28)]),
          rnd.choice([None, dt.datetime(2020, 1, 1, 0, 0, k % 60, 7)]), rnd.choice([None, k]))
         for k in range(400)], f"cell string, o bigint, {SCHEMA}")


def _key(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_small_outputs_are_those_of_sparks_writer(spark, tmp_dir, fmt):
    rows = _rows(spark).repartition(5)
    how = dict(fmt=fmt, partitioning="hash", overflow_col="o")
    assert write_cells(rows, f"{tmp_dir}/spark", **how) == 400
    assert write_cells(rows, f"{tmp_dir}/small", output_rows=100, **how) == 400
    places = [sorted(os.path.relpath(d, f"{tmp_dir}/{w}") for d in glob.glob(f"{tmp_dir}/{w}/*/*"))
              for w in ("spark", "small")]
    assert places[0] == places[1] and len(places[0]) == 21
    assert not glob.glob(f"{tmp_dir}/small/**/.*.crc", recursive=True)
    assert sorted(os.listdir(f"{tmp_dir}/small")) == sorted(
        [*{p.split("/")[0] for p in places[0]}, "_SUCCESS"])
    if fmt == "csv":        # the very lines
        lines = [{p: sorted("".join(open(f).read() for f in glob.glob(f"{tmp_dir}/{w}/{glob.escape(p)}/part-*"))
                            .split("\n")) for p in places[0]} for w in ("spark", "small")]
        assert lines[0] == lines[1]
        back = [read_cells(spark, f"{tmp_dir}/{w}", spark.createDataFrame([], SCHEMA).schema,
                           fmt="csv", overflow=True) for w in ("spark", "small")]
        assert _key(back[0]) == _key(back[1])
        assert sorted((r.id, r.text) for r in back[1].where("text like '%line'").collect()) == \
            sorted((r.id, r.text) for r in rows.where("text like '%line'").collect())
        return
    plain = spark.read.schema(f"{SCHEMA}, cell string, k bigint")
    want = _key(plain.parquet(f"{tmp_dir}/spark"))
    assert want == _key(plain.parquet(f"{tmp_dir}/small"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for w in ("spark", "small"):
        assert want == _key(read_cells(spark, f"{tmp_dir}/{w}", schema, overflow=True))


def test_capped_job_starts_no_process_for_its_files(spark, tmp_dir):
    rnd = random.Random(3)
    pts = points_df(spark, [(t, None, rnd.uniform(0, 4), rnd.uniform(0, 4)) for t in range(900)])
    hist = run_partition_job(pts, f"{tmp_dir}/out", columns=["ra", "decl"], fmt="csv",
                             min_cells=4, cap=20)
    files = glob.glob(f"{tmp_dir}/out/cell=*/k=*/*")
    assert len(files) == hist.count() and not glob.glob(f"{tmp_dir}/out/cell=*/k=*/.*")
    assert max(len(open(f).readlines()) for f in files) == 20
    with pytest.raises(FileExistsError, match="already exists"):
        run_partition_job(pts, f"{tmp_dir}/out", columns=["ra", "decl"], fmt="csv",
                          min_cells=4, cap=20)
    again = run_partition_job(pts, f"{tmp_dir}/out", columns=["ra", "decl"], fmt="csv",
                              min_cells=1, cap=30, mode="overwrite")
    assert len(glob.glob(f"{tmp_dir}/out/cell=*/k=*/*")) == again.count()


def test_a_failed_attempt_is_not_published(spark, tmp_dir, monkeypatch):
    real = small.write_outputs

    def twice(batches, *a):
        batches = list(batches)
        real(batches, *a)               # as of an attempt that was lost
        return real(batches, *a)

    monkeypatch.setattr(small, "write_outputs", twice)
    rows = spark.range(50).select(F.lit("c").alias("cell"), (F.col("id") % 2).alias("o"), "id")
    n = write_cells(rows, f"{tmp_dir}/w", partitioning="hash", overflow_col="o", output_rows=50)
    back = read_cells(spark, f"{tmp_dir}/w", spark.range(1).schema, overflow=True)
    assert n == back.count() == back.select("id").distinct().count() == 50


def test_outputs_are_read_without_discovery_of_their_directories(spark, tmp_dir):
    rows = spark.range(120).select(F.lit("2.10").alias("cell"), (F.col("id") % 40).alias("o"), "id")
    write_cells(rows, f"{tmp_dir}/w", partitioning="hash", overflow_col="o", output_rows=3)
    back = read_cells(spark, f"{tmp_dir}/w", spark.range(1).schema, overflow=True)
    relation = back._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    assert relation.partitionSchema().length() == 0
    assert {(r.cell, r.k) for r in back.collect()} == {("2.10", k) for k in range(40)}
    one = back.where("cell = '2.10' and k = 7")
    assert sorted(r.id for r in one.collect()) == [7, 47, 87]
    assert back.where("cell = '2.1'").count() == 0
    assert back.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism


def _writer(folder):
    return small._SmallStreamWriter({"folder": folder, "keys": "cell,k", "codec": "snappy"})


def _attempt(spark, writer, ids):
    batch = spark.createDataFrame([("c", 0, i) for i in ids], "cell string, k bigint, id bigint")
    return writer.write(iter(batch.toArrow().to_batches()))


def test_a_micro_batch_is_published_once(spark, tmp_dir):
    folder, schema = f"{tmp_dir}/s", "id bigint"
    writer = _writer(folder)
    ids = lambda **how: sorted(r.id for r in small_rows(**how).collect())
    small_rows = lambda **how: read_outputs(spark, folder, schema, **how)
    from skytiles.sinks.cells import read_outputs
    lost = _attempt(spark, writer, [90])
    writer.commit([_attempt(spark, writer, [1, 2]), None, _attempt(spark, writer, [3])], 0)
    assert ids() == [1, 2, 3] and lost.attempt and not os.path.exists(f"{folder}/_temporary")
    writer.commit([_attempt(spark, writer, [1, 2, 3])], 0)      # again, after a crash
    assert ids() == [1, 2, 3]
    # A crash amid the renames of the next one.
    half = _attempt(spark, writer, [4, 5])
    with open(f"{folder}/_batches/1.begun", "w") as f:
        json.dump([half.attempt], f)
    small.publish(folder, [half.attempt])
    assert ids() == [1, 2, 3, 4, 5]
    assert ids(without=small.unpublished(folder)) == [1, 2, 3]
    writer.commit([_attempt(spark, writer, [4, 5, 6])], 1)
    assert ids() == [1, 2, 3, 4, 5, 6] and small.unpublished(folder) == []
    gone = _attempt(spark, writer, [7])
    writer.abort([gone, None], 2)
    assert ids() == [1, 2, 3, 4, 5, 6]


def test_an_attempt_out_of_sight_raises(tmp_dir):
    with pytest.raises(FileNotFoundError):
        message = WriterCommitMessage()
        message.attempt = "elsewhere"
        _writer(f"{tmp_dir}/s").commit([message], 0)


def _stream(spark, tmp_dir, cap):
    from skytiles.streaming import read_stream_output, start_partition_stream
    schema = "source_id bigint, ra double, decl double"
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
        .parquet(f"{tmp_dir}/in")
    start_partition_stream(stream, (0.0, 4.0, 0.0, 4.0), 2, f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                           cap=cap).awaitTermination()
    return read_stream_output(spark, f"{tmp_dir}/out", schema)


@pytest.mark.parametrize("caps", [(30, 5000), (5000, 30)])
def test_stream_with_a_small_cap_and_the_sink_it_began_with(spark, tmp_dir, caps):
    rnd = random.Random(4)
    for turn, cap in enumerate(caps):
        points_df(spark, [(turn * 200 + t, None, rnd.uniform(0, 4), rnd.uniform(0, 4))
                          for t in range(200)]) \
            .select("source_id", "ra", "decl").write.parquet(f"{tmp_dir}/in/{turn}")
        rows = _stream(spark, tmp_dir, cap)
        assert rows.select("source_id").distinct().count() == 200 * (turn + 1)
        assert os.path.isdir(f"{tmp_dir}/out/_spark_metadata") == (caps[0] == 5000)
        small_files = not glob.glob(f"{tmp_dir}/out/cell=*/k=*/.*.crc")
        assert small_files == (caps[0] == 30)
