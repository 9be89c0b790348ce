import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import points_df
from skytiles.operators import (assign_cell, assign_padded, bounds, bounds_row,
                                grid_cells, grid_side, quarantine)


def test_grid_side():
    assert [grid_side(m) for m in (1, 3, 5, 40, 49, 50, 676)] == [1, 2, 3, 7, 7, 8, 26]
    # No upper limit: a grid for 100 TB in outputs of 128 MB.
    assert [grid_side(m) for m in (677, 1000, 745_059)] == [27, 32, 864]
    for bad in (-1, 0):
        with pytest.raises(ValueError):
            grid_side(bad)


def test_more_than_676_cells(spark):
    n = grid_side(1000)
    pts = points_df(spark, [(i * n + j, None, i + 0.5, j + 0.5)
                            for i in range(n) for j in range(n)])
    box = bounds_row(spark, 0.0, n, 0.0, n)
    assert assign_cell(pts, box, n).select("cell").distinct().count() == n * n >= 1000
    got = assign_padded(pts, box, n, 0.1, 0.1, recentre=False)
    assert {(r.source_id, r.cell) for r in got.collect()} == {
        (i * n + j, f"{i}.{j}") for i in range(n) for j in range(n)}


@pytest.mark.parametrize("ra,decl", [(None, 2.0), (12.0, None), (float("nan"), 2.0),
                                     (12.0, float("nan")), (float("inf"), 2.0)])
def test_bad_coordinates_stop_the_assignment(spark, ra, decl):
    pts = points_df(spark, [(1, None, 12.0, 2.0), (2, None, ra, decl)])
    box = bounds_row(spark, 10.0, 20.0, 1.0, 5.0)
    for cells in (assign_cell(pts, box, 2), assign_padded(pts, box, 2)):
        with pytest.raises(Exception, match="bad (RA|Decl)"):
            cells.select("cell").collect()


def test_quarantine_parts_every_row(spark):
    values = [1.0, 359.0, 361.0, None, float("nan"), float("inf"), -float("inf")]
    pts = points_df(spark, [(k, None, ra, decl) for k, (ra, decl) in enumerate(
        (a, b) for a in values for b in values)])
    for limit, good_ras in ((None, 3), (360.0, 2)):
        good, bad = quarantine(pts, max_ra=limit)
        assert good.count() == good_ras * 3 and good.count() + bad.count() == len(values) ** 2
        assert good.union(bad).select("source_id").distinct().count() == len(values) ** 2


def test_star_outside_the_box(spark):
    pts = points_df(spark, [(1, None, 1.0, 1.0), (2, None, 9.0, 1.0), (3, None, 1.0, -4.0)])
    box = bounds_row(spark, 0.0, 2.0, 0.0, 2.0)
    with pytest.raises(Exception, match="outside the box"):
        assign_padded(pts, box, 2, recentre=False).collect()
    got = assign_padded(pts, box, 2, 0.0, 0.0, recentre=False, outside="elsewhere").collect()
    assert {(r.source_id, r.cell) for r in got if r.source_id > 1} == {
        (2, "elsewhere"), (3, "elsewhere")}
    assert len([r for r in got if r.source_id > 1]) == 2


def test_grid_cells_layout(spark):
    cells = grid_cells(bounds_row(spark, 0.0, 3.0, 10.0, 16.0), 3).orderBy("i", "j").collect()
    assert len(cells) == 9
    c = {r.cell: r for r in cells}
    assert (c["2.1"].left_ra, c["2.1"].right_ra) == (2.0, 3.0)
    assert (c["2.1"].low_decl, c["2.1"].high_decl) == (12.0, 14.0)
    # The published job took the Decl band from the column index.
    ci = {r.cell: r for r in grid_cells(bounds_row(spark, 0.0, 3.0, 10.0, 16.0), 3,
                                        decl_band="i").collect()}
    assert (ci["2.1"].low_decl, ci["2.1"].high_decl) == (14.0, 16.0)


def test_assign_cell_probe(spark):
    b = bounds_row(spark, 357.954210, 358.090417, 2.564629, 3.175271)
    n = grid_side(3)
    got = assign_cell(points_df(spark, [(1, None, 358.08, 2.94)]), b, n).first().cell
    assert got == "2.2"


def test_assign_cell_borders(spark):
    # Grid 0..4 x 0..4, n = 2: edges at 0 and 2 (4 is the upper bound).
    b = bounds_row(spark, 0.0, 4.0, 0.0, 4.0)
    rows = [(1, None, 0.0, 3.0),   # minimum RA: 0.0 whatever the Decl
            (2, None, 1.0, 0.0),   # minimum Decl: i.0
            (3, None, 2.0, 2.0),   # on an inner edge: lower cell
            (4, None, 2.5, 2.5),
            (5, None, 4.0, 4.0)]   # maximum corner
    got = {r.source_id: r.cell for r in assign_cell(points_df(spark, rows), b, 2).collect()}
    assert got == {1: "0.0", 2: "1.0", 3: "1.1", 4: "2.2", 5: "2.2"}


def _counted_cell(ra, decl, x0, w, y0, h, n):
    """The cell by counting the edges below the star."""
    i = sum(x0 + k * w < ra for k in range(n))
    j = sum(y0 + k * h < decl for k in range(n)) if i else 0
    return f"{i}.{j}"


def test_assign_cell_counts_edges(spark):
    x0, x1, y0, y1, n = -2.0457904192962246, -1.9095832700858182, 2.56, 3.18, 7
    w, h = (x1 - x0) / n, (y1 - y0) / n
    rnd = random.Random(7)
    pts = []
    for k in range(n + 1):
        for dx in (-1, 0, 1):
            ra = math.nextafter(x0 + k * w, math.inf if dx > 0 else -math.inf) if dx else x0 + k * w
            ra = min(max(ra, x0), x1)
            pts.append((len(pts), None, ra, rnd.uniform(y0, y1)))
    pts += [(len(pts) + t, None, rnd.uniform(x0, x1), rnd.uniform(y0, y1)) for t in range(300)]
    got = {r.source_id: r.cell for r in
           assign_cell(points_df(spark, pts), bounds_row(spark, x0, x1, y0, y1), n).collect()}
    for sid, _, ra, decl in pts:
        assert got[sid] == _counted_cell(ra, decl, x0, w, y0, h, n), (ra, decl)


def test_assign_cell_sample_histogram(sample_points, sample_sql):
    cells = assign_cell(sample_points, bounds(sample_points), grid_side(40))
    hist = {r.cell: r["count"] for r in cells.groupBy("cell").count().collect()}
    want = sample_sql.execute("""
        WITH b AS (SELECT min(ra) x, (max(ra) - min(ra)) / 7 w, min(decl) y,
                          (max(decl) - min(decl)) / 7 h FROM star),
        c AS (SELECT (SELECT count(*) FROM range(7) k WHERE x + k.range * w < ra) i,
                     (SELECT count(*) FROM range(7) k WHERE y + k.range * h < decl) j
              FROM star, b)
        SELECT i || '.' || CASE WHEN i = 0 THEN 0 ELSE j END, count(*) FROM c GROUP BY 1
        """).fetchall()
    assert hist == dict(want) and len(want) > 15


def test_unpadded_grid_keeps_the_extreme_star(spark):
    # x0 + 26 * ((x1 - x0) / 26) rounds below x1: the last edge is the maximum.
    x0, x1 = -3.656, 0.596
    assert x0 + 26 * ((x1 - x0) / 26) < x1
    pts = points_df(spark, [(1, None, x1, x1), (2, None, x0, x0)])
    got = assign_padded(pts, bounds_row(spark, x0, x1, x0, x1), 26, 0.0, 0.0,
                        recentre=False).collect()
    assert sorted((r.source_id, r.cell) for r in got) == [(1, "25.25"), (2, "0.0")]


def test_zero_extent_gives_one_cell(spark):
    pts = points_df(spark, [(1, None, 5.0, 5.0), (2, None, 5.0, 5.0)])
    got = assign_cell(pts, bounds(pts), 3).select("cell").distinct().collect()
    assert [r.cell for r in got] == ["0.0"]
    padded = assign_padded(pts, bounds(pts), 3, recentre=False)
    assert padded.count() == 2 * 9


# ------------------------------------------------------------- padded (G4)

_PADDED_SQL = """
    WITH s AS (SELECT source_id, CASE WHEN ra > 180 THEN ra - 360 ELSE ra END ra, decl FROM star),
    b AS (SELECT min(ra) x0, max(ra) x1, min(decl) y0, max(decl) y1 FROM s),
    c AS (SELECT i.range i, j.range j, x0 + i.range * (x1 - x0) / {n} lo,
                 x0 + (i.range + 1) * (x1 - x0) / {n} hi,
                 y0 + {band}.range * (y1 - y0) / {n} down,
                 y0 + ({band}.range + 1) * (y1 - y0) / {n} up
          FROM range({n}) i, range({n}) j, b)
    SELECT i || '.' || j, count(*) FROM s JOIN c
      ON ra BETWEEN lo - 0.1 AND hi + 0.1 AND decl BETWEEN down - 0.1 AND up + 0.1
    GROUP BY 1"""


@pytest.mark.parametrize("cells,band", [(5, "j"), (40, "j"), (40, "i")])
def test_padded_sample_histograms(sample_points, sample_sql, cells, band):
    b = bounds(sample_points, recentre=True)
    n = grid_side(cells)
    hist = {r.cell: r["count"] for r in assign_padded(
        sample_points, b, n, decl_band=band).groupBy("cell").count().collect()}
    assert hist == dict(sample_sql.execute(_PADDED_SQL.format(n=n, band=band)).fetchall())


def test_padded_column_band_repeats_each_column(sample_points):
    # The published job: every j of a column holds the same stars.
    b = bounds(sample_points, recentre=True)
    pairs = assign_padded(sample_points, b, grid_side(40), decl_band="i")
    per_col = pairs.groupBy("i").agg(F.countDistinct("j").alias("nj"),
                                     F.count(F.lit(1)).alias("n")).collect()
    for r in per_col:
        assert r.nj == 7 and r.n % 7 == 0


def _brute_padded(pts, x0, x1, y0, y1, n, pad, band="j"):
    w, h = (x1 - x0) / n, (y1 - y0) / n
    out = set()
    for sid, _, ra, decl in pts:
        for i in range(n):
            for j in range(n):
                r = i if band == "i" else j
                right = x1 if i == n - 1 else x0 + (i + 1) * w
                top = y1 if r == n - 1 else y0 + (r + 1) * h
                if (ra >= x0 + i * w - pad and ra <= right + pad
                        and decl >= y0 + r * h - pad and decl <= top + pad):
                    out.add((sid, f"{i}.{j}"))
    return out


@pytest.mark.parametrize("n,pad,band", [(3, 0.1, "j"), (7, 0.1, "j"), (26, 0.1, "j"),
                                        (7, 0.0, "j"), (5, 0.3, "i"), (26, 0.02, "j")])
def test_padded_equals_brute_force(spark, n, pad, band):
    rnd = random.Random(n)
    x0, x1, y0, y1 = -3.0, 2.0, -1.0, 1.5
    w, h = (x1 - x0) / n, (y1 - y0) / n
    pts = []
    for t in range(400):
        ra, decl = rnd.uniform(x0, x1), rnd.uniform(y0, y1)
        if t % 4 == 0:   # exactly on an edge, or on a padding limit
            ra = x0 + rnd.randrange(n + 1) * w + rnd.choice((0.0, pad, -pad))
        if t % 5 == 0:
            decl = y0 + rnd.randrange(n + 1) * h + rnd.choice((0.0, pad, -pad))
        pts.append((t, None, ra, decl))
    got = assign_padded(points_df(spark, pts), bounds_row(spark, x0, x1, y0, y1), n,
                        pad, pad, recentre=False, decl_band=band)
    assert {(r.source_id, r.cell) for r in got.collect()} == \
        _brute_padded(pts, x0, x1, y0, y1, n, pad, band)


def test_padded_every_point_somewhere(spark):
    rnd = random.Random(3)
    pts = [(t, None, rnd.uniform(-10, 10), rnd.uniform(-5, 5)) for t in range(500)]
    df = points_df(spark, pts)
    got = assign_padded(df, bounds(df, recentre=True), 7)
    assert got.select("source_id").distinct().count() == 500


def test_padded_keeps_original_ra(spark):
    df = points_df(spark, [(1, None, 359.5, 0.0), (2, None, 0.5, 1.0)])
    got = {r.source_id: r.ra for r in assign_padded(df, bounds(df, recentre=True), 2).collect()}
    assert got == {1: 359.5, 2: 0.5}


def test_empty_input_has_no_grid(spark):
    empty = points_df(spark, [])
    with pytest.raises(ValueError):
        assign_cell(empty, bounds(empty), 3)


def test_cells_for_size():
    from skytiles.operators import cells_for_size
    assert cells_for_size(5 * 1024 ** 3) == 40
    assert cells_for_size(1) == 1
    assert grid_side(cells_for_size(5 * 1024 ** 3)) == 7


def test_one_star_catalogue(spark):
    one = points_df(spark, [(7, 1, 12.5, -3.0)])
    assert [r.cell for r in assign_cell(one, bounds(one), 7).collect()] == ["0.0"]
    cells = assign_padded(one, bounds(one, recentre=True), 2).collect()
    assert sorted(r.cell for r in cells) == ["0.0", "0.1", "1.0", "1.1"]


def _sky_distance(a, b):
    (ra1, d1), (ra2, d2) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = (math.sin((d2 - d1) / 2) ** 2
         + math.cos(d1) * math.cos(d2) * math.sin((ra2 - ra1) / 2) ** 2)
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(h))))


def _sphere_stars():
    """Stars all round, many near RA 180 and 0 and near both poles."""
    rnd = random.Random(11)
    stars = [(rnd.uniform(0, 360), rnd.uniform(-90, 90)) for _ in range(150)]
    stars += [((180 + rnd.uniform(-4, 4)) % 360, rnd.uniform(-80, 80)) for _ in range(150)]
    stars += [(rnd.uniform(-3, 3) % 360, rnd.uniform(-80, 80)) for _ in range(100)]
    stars += [(rnd.uniform(0, 360), s * rnd.uniform(84, 90)) for s in (-1, 1) for _ in range(80)]
    return stars + [(10.0, 90.0), (200.0, -90.0), (180.0, 0.0), (0.0, 0.0), (179.999, 45.0)]


@pytest.mark.parametrize("n,pad", [(1, 2.0), (6, 2.0), (9, 0.5)])
def test_padding_on_the_sphere_keeps_neighbours_together(spark, n, pad):
    """A star is in every cell that holds a star within the padding of it."""
    stars = _sphere_stars()
    pts = points_df(spark, [(k, None, *s) for k, s in enumerate(stars)])
    box = bounds(pts, recentre=True)
    pairs = [(r.source_id, r.cell) for r in
             assign_padded(pts, box, n, pad, pad, sphere=True).collect()]
    got = set(pairs)
    assert len(got) == len(pairs)                       # a cell once, from whichever turn
    own = [(r.source_id, r.cell) for r in
           assign_padded(pts, box, n, 0.0, 0.0).collect()]
    met = 0
    for k, cell in own:
        for other, star in enumerate(stars):
            if _sky_distance(stars[k], star) <= pad - 1e-9:
                assert (other, cell) in got, (stars[k], star, cell)
                met += (other, cell) not in own
    assert met > 20 or n == 1
    # Cartesian padding misses some of these.
    flat = {(r.source_id, r.cell) for r in assign_padded(pts, box, n, pad, pad).collect()}
    assert flat <= got and (n == 1 or flat < got)


def test_padding_on_the_sphere_is_exact(spark):
    """Every star against every cell, by the circle's distance to its RA range."""
    stars, n, pad = _sphere_stars(), 7, 1.5
    pts = points_df(spark, [(k, None, *s) for k, s in enumerate(stars)])
    box = bounds(pts, recentre=True)
    cells = grid_cells(box, n).collect()
    want = set()
    for k, (ra, decl) in enumerate(stars):
        reach = 180.0 if abs(decl) + pad >= 90 else math.degrees(
            math.asin(math.sin(math.radians(pad)) / math.cos(math.radians(decl))))
        for c in cells:
            half = (c.right_ra - c.left_ra) / 2
            away = abs((ra - (c.left_ra + half) + 180) % 360 - 180) - half
            if away <= reach and c.low_decl - pad <= decl <= c.high_decl + pad:
                want.add((k, c.cell))
    got = {(r.source_id, r.cell) for r in
           assign_padded(pts, box, n, pad, pad, sphere=True).collect()}
    assert got == want


def test_padding_on_the_sphere_outside_and_bad_coordinates(spark):
    box = bounds_row(spark, 170.0, 180.0, -5.0, 5.0)
    pts = points_df(spark, [(1, None, 180.4, 0.0), (2, None, 190.0, 0.0), (3, None, 175.0, 0.0)])
    got = assign_padded(pts, box, 1, 0.5, 0.5, sphere=True, outside="far").collect()
    assert sorted((r.source_id, r.cell) for r in got) == [(1, "0.0"), (2, "far"), (3, "0.0")]
    for ra, decl in [(None, 0.0), (175.0, None), (175.0, float("nan"))]:
        with pytest.raises(Exception, match="bad (RA|Decl)"):
            assign_padded(points_df(spark, [(1, None, 175.0, 0.0), (2, None, ra, decl)]), box, 1,
                          0.5, 0.5, sphere=True).select("cell").collect()
