import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import points_df
from skytiles.operators import (assign_padded, bounds, by_output, capacity_split, cell_counts,
                                cell_histogram, output_histogram, spread_outputs, with_out_cell)


@pytest.fixture(scope="module")
def pairs(spark):
    rnd = random.Random(11)
    # A hot spot: a third of the points in one corner.
    pts = [(t, None, rnd.uniform(0, 10), rnd.uniform(0, 10)) for t in range(2000)]
    pts += [(2000 + t, None, rnd.uniform(0, 0.5), rnd.uniform(0, 0.5)) for t in range(1000)]
    df = points_df(spark, pts)
    return assign_padded(df, bounds(df, recentre=True), 3).cache()


def _ranks(df):
    return {(r.source_id, r.cell): (r.cell_rank, r.overflow) for r in df.collect()}


def test_window_equals_two_phase(pairs):
    a = capacity_split(pairs, 100, method="window")
    b = capacity_split(pairs, 100, method="two_phase", rows_per_task=50)
    c = capacity_split(pairs, 100, method="auto", rows_per_task=10)
    assert _ranks(a) == _ranks(b) == _ranks(c)


def test_cap_holds_and_counts_kept(pairs):
    out = with_out_cell(capacity_split(pairs, 100, method="two_phase", rows_per_task=64))
    per_out = out.groupBy("out_cell").count()
    assert per_out.agg(F.max("count")).first()[0] <= 100
    base = {r.cell: r["count"] for r in pairs.groupBy("cell").count().collect()}
    got = {r.cell: r["count"] for r in out.groupBy("cell").count().collect()}
    assert base == got
    names = {r.out_cell for r in per_out.collect()}
    assert "0.0bis" in names and "0.0bisbis" in names


def test_rank_follows_order(spark):
    df = points_df(spark, [(s, None, 0.0, 0.0) for s in (5, 3, 9, 1)]) \
        .withColumn("cell", F.lit("0.0"))
    got = {r.source_id: r.out_cell for r in with_out_cell(capacity_split(df, 2)).collect()}
    assert got == {1: "0.0", 3: "0.0", 5: "0.0bis", 9: "0.0bis"}


def test_suffix_configurable(spark):
    df = points_df(spark, [(s, None, 0.0, 0.0) for s in range(3)]) \
        .withColumn("cell", F.lit("1.2"))
    got = sorted(r.out_cell for r in with_out_cell(capacity_split(df, 1),
                                                   suffix="second").collect())
    assert got == ["1.2", "1.2second", "1.2secondsecond"]


def test_bad_arguments(pairs):
    with pytest.raises(ValueError):
        capacity_split(pairs, 0)
    with pytest.raises(ValueError):
        capacity_split(pairs, 10, method="nope")


def test_two_phase_with_clumped_and_repeated_ids(spark):
    rnd = random.Random(2)
    # Two far-apart clumps of ids, many ids repeated; ties broken by ra.
    rows = [(rnd.choice([1, 2, 3, 10**15]), None, float(t), 0.0) for t in range(1500)]
    df = points_df(spark, rows).withColumn("cell", F.lit("3.3"))
    order = ["source_id", "ra"]
    a = capacity_split(df, 40, order_by=order, method="window")
    b = capacity_split(df, 40, order_by=order, method="two_phase", rows_per_task=100)
    key = lambda d: sorted((r.ra, r.cell_rank, r.overflow) for r in d.collect())
    assert key(a) == key(b)


def test_two_phase_over_all_kinds_of_order_columns(spark):
    rnd = random.Random(6)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-320, 1e308, -1e308]
    big = [None, 2 ** 62, 2 ** 62 + 1, -2 ** 63, 2 ** 63 - 1, 0]
    rows = [("c" if k % 4 else "d", rnd.choice(odd + [rnd.uniform(-1, 1)]), rnd.choice(big),
             rnd.choice([None, True, False]),
             rnd.choice([None, dt.date(2020, 1, 1 + k % 28)]),
             rnd.choice([None, dt.datetime(2020, 1, 1, 0, 0, k % 60)]), rnd.choice(["", None, "x"]),
             k % 7) for k in range(1200)]
    df = spark.createDataFrame(rows, "cell string, x double, n long, b boolean, d date, "
                                     "t timestamp, s string, k int").repartition(5)
    for order in (["x", "n", "b", "d", "t", "s"], ["b", "n", "x"], ["s", "n"], ["t", "d", "k"]):
        ranked = [sorted(map(repr, capacity_split(df, 30, order, method=m, rows_per_task=40)
                             .collect())) for m in ("window", "two_phase")]
        assert ranked[0] == ranked[1], order


def test_only_hot_cells_are_divided(spark, monkeypatch):
    from skytiles.operators import capacity
    rows = [(k, None, 0.0, 0.0) for k in range(900)] + [(k, None, 9.0, 0.0) for k in range(40)]
    df = points_df(spark, rows).withColumn(
        "cell", F.when(F.col("ra") == 0.0, "hot").otherwise("cold"))
    stored = []
    monkeypatch.setattr(capacity, "write_scratch_table",
                        lambda t, name: stored.append(t.toPandas()) or t)
    monkeypatch.setattr(capacity, "BINS", 4)
    out = capacity_split(df, 50, rows_per_task=60)
    assert all(set(t["cell"]) == {"hot"} for t in stored)
    assert max(stored[-1]["_n"]) <= 60          # the last round's steps fit a task
    ranks = {r.source_id: r.cell_rank for r in out.where("cell = 'hot'").collect()}
    assert ranks == {k: k + 1 for k in range(900)}


def test_equal_rows_of_the_order_are_ranked_alike_by_both_methods(spark):
    df = points_df(spark, [(1, t, 0.0, 0.0) for t in range(300)]).withColumn("cell", F.lit("0.0"))
    a, b = [sorted(map(tuple, capacity_split(d, 20, method=m, rows_per_task=25).collect()))
            for m, d in (("window", df), ("two_phase", df.repartition(6)))]
    assert a == b


def _one_cell(spark, n):
    return points_df(spark, [(t, None, float(t % 7), float(t % 3)) for t in range(n)]) \
        .withColumn("cell", F.lit("1.2"))


def test_long_names_of_outputs_are_stored_once(spark, tmp_dir):
    rows = _one_cell(spark, 30000)
    split = capacity_split(rows, 15)
    spread = spread_outputs(split, cell_counts(rows), 15)
    size = []
    for k, df in enumerate((split, spread)):
        path = f"{tmp_dir}/{k}"
        with_out_cell(df).write.parquet(path)
        size.append(sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)
                        if f.endswith(".parquet")))
    assert size[1] < size[0] / 2, size
    a, b = [sorted(map(tuple, d.collect())) for d in (split, spread)]
    assert a == b
    assert spread_outputs(split, cell_counts(rows), 300) is split      # short names


def test_outputs_are_grouped_by_number_and_named_after(spark):
    split = capacity_split(_one_cell(spark, 95), 10)
    got = output_histogram(split)
    named = cell_histogram(with_out_cell(split), "out_cell")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, named.collect()))
    places = by_output(split, F.countDistinct("ra", "decl").alias("n"))
    plan = places._jdf.queryExecution().optimizedPlan().toString()
    groups = [ln for ln in plan.splitlines() if "Aggregate" in ln]
    assert groups and all("overflow" in ln and "repeat" not in ln.split("], [")[0]
                          for ln in groups)
    assert {r.cell: r.n for r in places.collect()}["1.2bis"] == 10
