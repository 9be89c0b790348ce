import random

import pytest

from conftest import points_df
from skytiles.operators import assign_padded, bounds_row
from skytiles.streaming import read_stream_output, start_partition_stream

PAYLOAD = "source_id bigint, ra double, decl double"


def _points(spark, n, seed):
    rnd = random.Random(seed)
    return points_df(spark, [(seed * 100000 + t, None, rnd.uniform(0, 4),
                              rnd.uniform(0, 4)) for t in range(n)])


def _stream(spark, tmp_dir, box, **kwargs):
    stream = (spark.readStream.schema(PAYLOAD).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/in"))
    q = start_partition_stream(stream, box, 2, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", **kwargs)
    q.awaitTermination()
    return read_stream_output(spark, f"{tmp_dir}/out", PAYLOAD)


def test_stream_keeps_cap_across_batches_and_restarts(spark, tmp_dir):
    files = [_points(spark, 400, s) for s in range(3)]
    box = bounds_row(spark, 0.0, 4.0, 0.0, 4.0)
    # Two files in the first run, one more after a restart.
    for k, df in enumerate(files):
        if k == 2:
            _stream(spark, tmp_dir, box, cap=150)
        df.select("source_id", "ra", "decl").coalesce(1).write.parquet(f"{tmp_dir}/in/f{k}")
    out = _stream(spark, tmp_dir, box, cap=150)
    got = {(r.cell, r.k): r["count"] for r in out.groupBy("cell", "k").count().collect()}
    allpts = files[0].unionByName(files[1]).unionByName(files[2])
    want = {r.cell: r["count"] for r in assign_padded(
        allpts, box, 2, recentre=False).groupBy("cell").count().collect()}
    assert got == {(c, k): min(150, n - 150 * k) for c, n in want.items()
                   for k in range(-(-n // 150))}


def test_stream_keeps_stars_outside_the_box(spark, tmp_dir):
    points_df(spark, [(1, None, 1.0, 1.0), (2, None, 9.0, 1.0), (3, None, 8.0, 8.0)]) \
        .select("source_id", "ra", "decl").write.parquet(f"{tmp_dir}/in/f0")
    out = _stream(spark, tmp_dir, (0.0, 2.0, 0.0, 2.0), ra_pad=0.0, decl_pad=0.0)
    cells = {r.source_id: r.cell for r in out.collect()}
    assert cells[2] == cells[3] == "outside" and cells[1] != "outside"


def test_stream_needs_a_stream(spark):
    with pytest.raises(ValueError):
        start_partition_stream(_points(spark, 5, 1), (0.0, 4.0, 0.0, 4.0), 2, "/o", "/c")
