import contextlib
import io
import os

import pytest

from skytiles.session import checkpoint_root
from skytiles.__main__ import main
from skytiles.sources import source_schema
from skytiles.sources.schemas import column_index


def run(spark, argv):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(argv, spark=spark) == 0
    return buf.getvalue().split("\n")[:-1]


def _catalogue(path, rows):
    schema = source_schema()
    with open(path, "w") as f:
        for sid, obj, ra, decl in rows:
            cells = ["NULL"] * len(schema)
            cells[column_index(schema, "sourceId")] = str(sid)
            cells[column_index(schema, "objectId")] = "NULL" if obj is None else str(obj)
            cells[column_index(schema, "ra")] = repr(ra)
            cells[column_index(schema, "decl")] = repr(decl)
            f.write(",".join(cells) + "\n")


def test_cli_jobs_on_a_catalogue(spark, tmp_dir):
    cat = f"{tmp_dir}/cat.csv"
    _catalogue(cat, [(k, k % 3 or None, 350.0 + k * 0.01, -1.0 + k * 0.003)
                     for k in range(900)])
    lines = run(spark, ["partition", "9", cat, f"{tmp_dir}/p", "--cap", "100",
                        "--columns", "ra,decl", "--out-format", "csv",
                        "--rows-per-task", "200"])
    assert lines and all("-->" in ln for ln in lines)
    assert any(ln.split("-->")[0].endswith("bis") for ln in lines)
    part = next(os.path.join(f"{tmp_dir}/p", d, "k=0") for d in os.listdir(f"{tmp_dir}/p")
                if d.startswith("cell="))
    first = open(os.path.join(part, next(x for x in os.listdir(part)
                                         if x.startswith("part-")))).readline()
    assert len(first.strip().split(",")) == 2
    assert run(spark, ["grid", "4", cat, f"{tmp_dir}/g"])
    assert run(spark, ["strips", cat, f"{tmp_dir}/s"])
    counts = run(spark, ["counts", cat])
    assert sorted(counts) == ["1,300", "2,300"]
    assert run(spark, ["summary", cat, f"{tmp_dir}/sum"]) == []
    assert len(os.listdir(f"{tmp_dir}/sum")) > 0


def test_cli_bounds_and_partition_on_the_sample(spark, tmp_dir, source_sample, sample_sql):
    (line,) = run(spark, ["bounds", source_sample])
    for value in sample_sql.execute("SELECT min(ra), max(decl) FROM star").fetchone():
        assert repr(value) in line
    lines = run(spark, ["partition", "5", source_sample, f"{tmp_dir}/out"])
    assert sorted(ln.split("-->")[0] for ln in lines) == [
        f"{i}.{j}" for i in range(3) for j in range(3)]


def test_cli_sizes_the_grid_by_bytes_and_overwrites_when_told(spark, tmp_dir, source_sample):
    size = os.path.getsize(source_sample)
    argv = ["grid", "auto", source_sample, f"{tmp_dir}/g", "--target-bytes", str(size // 30)]
    assert len(run(spark, argv)) > 9            # a 6 x 6 grid
    with pytest.raises(Exception, match="already exists"):
        main(argv, spark=spark)
    assert run(spark, [*argv, "--overwrite"])


def test_cli_parses_csv_once(spark, tmp_dir, source_sample):
    """Every pass after the first reads the stored points."""
    spark.sparkContext.setJobGroup("once", "once")
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    moved = f"{tmp_dir}/moved.csv"
    with open(source_sample) as src, open(moved, "w") as dst:
        dst.write(src.read())
    scans = []
    real = spark.read.__class__.csv

    def counted(self, path, *a, **kw):
        df = real(self, path, *a, **kw)
        scans.append(path)
        return df

    spark.read.__class__.csv = counted
    try:
        run(spark, ["partition", "9", moved, f"{tmp_dir}/p", "--cap", "20"])
    finally:
        spark.read.__class__.csv = real
    assert scans == [[moved]]
    assert set(os.listdir(root)) == before
