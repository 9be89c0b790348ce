import math

import pytest

from conftest import points_df
from skytiles.operators import assign_strips
from skytiles.operators.strips import strip_width


def _strips(spark, ras):
    df = points_df(spark, [(k, None, float(ra), 3.0) for k, ra in enumerate(ras)])
    out = {}
    for r in assign_strips(df).collect():
        out.setdefault(r.source_id, []).append(r.strip)
    return [sorted(out[k]) for k in range(len(ras))]


def test_strip_probes(spark):
    ras = [1, 359, 8, 17, 351, 10, 11, 111, 211, 0, 360]
    want = [[1, 40], [40, 1], [1, 2], [2, 3], [39, 40], [2, 1], [2], [13], [24],
            [0, 1], [40, 1]]
    assert _strips(spark, ras) == [sorted(w) for w in want]


def _counted_strip(ra, width=9):
    return sum(edge < ra for edge in range(0, 361, width))


def test_strip_counts_edges(spark):
    ras = []
    for e in range(0, 361, 9):
        ras += [float(e), math.nextafter(e, -math.inf), math.nextafter(e, math.inf)]
    ras = [r for r in ras if 0 <= r <= 360]
    df = points_df(spark, [(k, None, ra, 0.0) for k, ra in enumerate(ras)])
    first = {}
    for r in assign_strips(df).collect():
        first.setdefault(r.source_id, set()).add(r.strip)
    for k, ra in enumerate(ras):
        assert _counted_strip(ra) in first[k], ra
        assert 1 <= len(first[k]) <= 2


def test_sample_all_in_last_strip(sample_points):
    got = {r.strip for r in assign_strips(sample_points).collect()}
    assert got == {40}
    assert assign_strips(sample_points).count() == 56


@pytest.mark.parametrize("ra", [None, float("nan"), 365.0, float("inf")])
def test_bad_ra_stops_the_strips(spark, ra):
    with pytest.raises(Exception, match="bad RA"):
        assign_strips(points_df(spark, [(1, None, ra, 0.0)])).collect()


def test_strip_validation():
    with pytest.raises(ValueError):
        strip_width(50, 1)
    with pytest.raises(ValueError):
        strip_width(1, 1)
    with pytest.raises(ValueError):
        strip_width(180, 1)
    assert strip_width(40, 1) == 9


def test_negative_ra_goes_to_strip_zero(spark):
    # No strip edge lies below a negative RA, so the strip is 0; -0.5 is
    # within the margin of the edge at 0 and is copied to strip 1.
    assert _strips(spark, [-5.0, -0.5]) == [[0], [0, 1]]
