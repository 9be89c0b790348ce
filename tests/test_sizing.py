"""Outputs sized by bytes: what the jobs write is weighed."""
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import points_df
from skytiles.__main__ import main
from skytiles.plans import run_grid_job, run_partition_job, run_strip_job
from skytiles.session import checkpoint_root
from skytiles.sinks import output_size

TARGET = 24_000


def _points(spark, wide, n=30_000):
    rnd = random.Random(3)
    pts = points_df(spark, [(k, None, rnd.uniform(0.1, 359.9), rnd.gauss(0, 10))
                            for k in range(n)])
    if not wide:
        return pts.drop("object_id")
    return pts.withColumns({f"t{c}": F.sha2(F.concat_ws("-", F.lit(c), "source_id"), 256)
                            for c in range(6)})


def _outputs(path):
    """Bytes of the files, by their folder."""
    found = {}
    for folder, _, names in os.walk(path):
        own = [os.path.getsize(os.path.join(folder, x)) for x in names if x.startswith("part-")]
        if own:
            found[os.path.relpath(folder, path)] = own
    return found


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_capped_outputs_weigh_about_the_target(spark, tmp_dir, wide, fmt):
    pts = _points(spark, wide)
    cap = output_size(pts, TARGET, fmt=fmt).rows
    hist = run_partition_job(pts, f"{tmp_dir}/p", fmt=fmt, min_cells=4, target_bytes=TARGET)
    assert max(r.n_stars for r in hist.collect()) == cap
    full = 0
    outputs = _outputs(f"{tmp_dir}/p")
    for place, sizes in outputs.items():
        cell, k = place.split("/")
        assert sum(sizes) <= 2 * TARGET
        if f"{cell}/k={int(k[2:]) + 1}" in outputs:       # not its cell's last
            full += 1
            assert sum(sizes) >= TARGET / 2, place
    assert full >= 10


@pytest.mark.parametrize("wide", [False, True])
def test_grid_and_strip_files_weigh_about_the_target(spark, tmp_dir, wide):
    pts = _points(spark, wide)
    run_grid_job(pts, f"{tmp_dir}/g", min_cells=1, target_bytes=TARGET)
    run_strip_job(pts, f"{tmp_dir}/s", n_strips=4, target_bytes=TARGET)
    for path in (f"{tmp_dir}/g", f"{tmp_dir}/s"):
        sizes = [x for own in _outputs(path).values() for x in own]
        assert max(sizes) <= 2 * TARGET
        assert sum(x for x in sizes if x >= TARGET / 2) >= 0.6 * sum(sizes)


def test_the_grid_follows_the_target(spark, tmp_dir):
    pts = _points(spark, True, 6_000)
    size = output_size(pts, TARGET)
    hist = run_grid_job(pts, f"{tmp_dir}/g", min_cells=None, target_bytes=TARGET)
    assert size.min_cells(6_000) == -(-6_000 // size.rows)
    # n x n cells, the least square that holds them; sparse ones may be empty.
    assert size.min_cells(6_000) / 2 <= hist.count() <= 3 * size.min_cells(6_000) + 6
    with pytest.raises(ValueError):
        run_grid_job(pts, f"{tmp_dir}/x", min_cells=None)


def test_a_drawn_sample_weighs_like_all_rows(spark):
    pts = _points(spark, True)
    whole = output_size(pts, 1 << 20)
    drawn = output_size(pts, 1 << 20, sample_rows=3_000)
    assert abs(drawn.bytes_per_row / whole.bytes_per_row - 1) < 0.1


def test_limits_of_the_size(spark):
    pts = _points(spark, False, 2_000)
    before = set(os.listdir(checkpoint_root(spark).removeprefix("file:")))
    assert output_size(pts, 1).rows == 1                  # never less than a row
    assert output_size(pts, 1 << 40).rows > 1 << 30       # extrapolated
    assert output_size(pts, TARGET, columns=["ra"]).rows > output_size(pts, TARGET).rows
    with pytest.raises(ValueError):
        output_size(pts.where("false"), TARGET)
    with pytest.raises(ValueError):
        output_size(pts, 0)
    # What was encoded to be weighed is deleted.
    assert set(os.listdir(checkpoint_root(spark).removeprefix("file:"))) == before


def test_cli_measures(spark, tmp_dir, source_sample, capsys):
    for job in (["partition", "auto", source_sample, f"{tmp_dir}/p", "--sphere"],
                ["grid", "auto", source_sample, f"{tmp_dir}/g"],
                ["strips", source_sample, f"{tmp_dir}/s"]):
        assert main([*job, "--measure", "--target-bytes", "2000"], spark=spark) == 0
        lines = capsys.readouterr().out.split("\n")[:-1]
        assert lines and all("-->" in ln for ln in lines)
