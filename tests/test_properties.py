"""Property tests with generated inputs. Each example runs a
batch of points through Spark, so example counts are kept small."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import points_df
from skytiles.operators import assign_cell, assign_padded, assign_strips, bounds_row
from skytiles.functions.coords import recentre_ra, restore_ra

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
finite = st.floats(min_value=-1e3, max_value=1e3, allow_nan=False)


@SETTINGS
@given(ras=st.lists(st.floats(min_value=0, max_value=360, allow_nan=False,
                              exclude_max=True), min_size=1, max_size=60))
def test_recentre_then_restore_is_identity(spark, ras):
    df = points_df(spark, [(k, None, r, 0.0) for k, r in enumerate(ras)])
    out = df.select("ra", restore_ra(recentre_ra("ra")).alias("back")).collect()
    for r in out:
        assert r.back == r.ra


@SETTINGS
@given(ras=st.lists(st.floats(min_value=0, max_value=360, allow_nan=False),
                    min_size=1, max_size=60))
def test_strips_one_or_two_distinct(spark, ras):
    df = points_df(spark, [(k, None, r, 0.0) for k, r in enumerate(ras)])
    got = {}
    for r in assign_strips(df).collect():
        got.setdefault(r.source_id, []).append(r.strip)
    for k in range(len(ras)):
        assert 1 <= len(got[k]) <= 2 and len(set(got[k])) == len(got[k])


@st.composite
def grid_and_points(draw):
    x0 = draw(finite)
    y0 = draw(finite)
    w = draw(st.floats(min_value=0.0, max_value=50, allow_nan=False))
    h = draw(st.floats(min_value=0.0, max_value=50, allow_nan=False))
    n = draw(st.integers(min_value=1, max_value=26))
    fx = st.floats(min_value=0, max_value=1, allow_nan=False)
    pts = draw(st.lists(st.tuples(fx, fx), min_size=1, max_size=40))
    pad = draw(st.sampled_from([0.0, 0.1, 1.0, 5.0]))
    return x0, y0, w, h, n, [(x0 + a * w, y0 + b * h) for a, b in pts], pad


@SETTINGS
@given(case=grid_and_points())
def test_one_cell_each_and_padded_equals_brute_force(spark, case):
    x0, y0, w, h, n, pts, pad = case
    x1, y1 = x0 + w, y0 + h
    df = points_df(spark, [(k, None, x, y) for k, (x, y) in enumerate(pts)])
    box = bounds_row(spark, x0, x1, y0, y1)
    one = assign_cell(df, box, n).collect()
    assert sorted(r.source_id for r in one) == list(range(len(pts)))
    cw, ch = (x1 - x0) / n, (y1 - y0) / n
    want = set()
    for k, (x, y) in enumerate(pts):
        for i in range(n):
            for j in range(n):
                right = x1 if i == n - 1 else x0 + (i + 1) * cw
                top = y1 if j == n - 1 else y0 + (j + 1) * ch
                if (x >= x0 + i * cw - pad and x <= right + pad
                        and y >= y0 + j * ch - pad and y <= top + pad):
                    want.add((k, f"{i}.{j}"))
    got = {(r.source_id, r.cell) for r in
           assign_padded(df, box, n, pad, pad, recentre=False).collect()}
    assert got == want
    # Every point inside the box is in at least one padded cell.
    assert {k for k, _ in got} == set(range(len(pts)))
