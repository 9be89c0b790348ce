import random

import pytest

from conftest import points_df
from skytiles.operators import bounds, object_counts, object_summary


def test_object_counts_sample(sample_points, sample_sql):
    got = [tuple(r) for r in object_counts(sample_points).collect()]
    assert got == sample_sql.execute("SELECT object_id, count(*) FROM star "
                                     "WHERE object_id IS NOT NULL GROUP BY 1").fetchall()
    assert got[0][1] == 6


def test_object_summary_sample(sample_points, sample_sql):
    got = [tuple(r) for r in object_summary(sample_points).collect()]
    assert got == sample_sql.execute(
        "SELECT object_id, count(*), max(CAST(source_id AS VARCHAR)), min(ra), max(ra), "
        "min(decl), max(decl) FROM star WHERE object_id IS NOT NULL GROUP BY 1").fetchall()


def test_bounds_sample(sample_points, sample_sql):
    b = bounds(sample_points).first()
    assert tuple(b) == sample_sql.execute(
        "SELECT min(ra), max(ra), min(decl), max(decl) FROM star").fetchone()
    w = bounds(sample_points, recentre=True).first()
    assert w.min_ra == b.min_ra - 360 and w.max_ra == b.max_ra - 360
    assert (w.min_decl, w.max_decl) == (b.min_decl, b.max_decl)


def test_last_source_equals_the_text_maximum(spark):
    rnd = random.Random(9)
    edge = [0, 1, 9, 10, 99, 100, -1, -9, -10, 10 ** 16, 10 ** 17 - 1, 10 ** 17, 10 ** 18 - 1,
            10 ** 18, 2 ** 63 - 1, -2 ** 63, -(10 ** 17), -(10 ** 18), -(2 ** 63) + 1]
    groups = [[e] for e in edge] + [[None], [None, 5]]
    groups += [rnd.sample(edge, rnd.randint(2, 6)) for _ in range(200)]
    groups += [[rnd.choice((1, -1, 1)) * rnd.randrange(10 ** rnd.randint(1, 18))
                for _ in range(rnd.randint(1, 5))] for _ in range(200)]
    df = points_df(spark, [(s, g, 0.0, 0.0) for g, own in enumerate(groups) for s in own])
    for r in object_summary(df).collect():
        texts = [str(s) for s in groups[r.object_id] if s is not None]
        assert r.last_source == (max(texts) if texts else None), groups[r.object_id]


def test_last_source_is_text_maximum(spark):
    df = points_df(spark, [(9, 1, 0.0, 0.0), (10, 1, 1.0, 1.0), (None, None, 2.0, 2.0)])
    r = object_summary(df).first()
    assert r.last_source == "9" and r.n_sources == 2
    assert object_summary(df, numeric_last=True).first().last_source == 10


def test_recentre_wraps_only_above_180(spark):
    df = points_df(spark, [(1, 1, 180.0, 0.0), (2, 1, 180.5, 1.0), (3, 1, 359.0, 2.0)])
    b = bounds(df, recentre=True).first()
    assert (b.min_ra, b.max_ra) == (-179.5, 180.0)


def test_bounds_from_footers(spark, tmp_dir):
    import contextlib
    import io

    from skytiles.operators import footer_bounds
    from skytiles.operators.summary import FOOTER_SETTINGS
    points = spark.range(5000).selectExpr("id as source_id", "id * 0.07 as ra", "10 - id as decl")
    points.withColumn("decl", points["decl"].cast("double")) \
        .withColumn("ra", points["ra"].cast("double")).repartition(3).write.parquet(f"{tmp_dir}/a")
    back = spark.read.parquet(f"{tmp_dir}/a")
    assert footer_bounds(spark, f"{tmp_dir}/a").collect() == bounds(back).collect()
    own = spark.newSession()
    for key, value in FOOTER_SETTINGS.items():
        own.conf.set(key, value)
    with contextlib.redirect_stdout(io.StringIO()) as text:
        bounds(own.read.parquet(f"{tmp_dir}/a")).explain("formatted")
    assert "PushedAggregation: [MIN(ra), MAX(ra), MIN(decl), MAX(decl)]" in text.getvalue()
    # Nulls are no bounds; NaN and columns of nulls have no statistics.
    for name, rows in (("null", [(1, 2.0, None), (2, None, 1.0)]),
                       ("nan", [(1, float("nan"), 1.0), (2, 0.5, 2.0)]),
                       ("none", [(1, None, 1.0), (2, None, 2.0)])):
        spark.createDataFrame(rows, "source_id long, ra double, decl double") \
            .write.parquet(f"{tmp_dir}/{name}")
        got = footer_bounds(spark, f"{tmp_dir}/{name}").collect()
        assert repr(got) == repr(bounds(spark.read.parquet(f"{tmp_dir}/{name}")).collect())
