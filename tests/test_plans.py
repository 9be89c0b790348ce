"""Plan regression tests: the physical plans keep the properties the
design relies on (no joins for the grid, pruned and pushed-down scans,
one shuffle for the cap, partial aggregation)."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import TESTDATA, needs_testdata

SF = f"{TESTDATA}/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@needs_testdata
@pytest.mark.parametrize("name", ["cell_assign", "padded_cells", "padded_cells_sphere", "ra_strips",
                                  "grid_cells"])
def test_assignment_has_no_join(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for bad in ("NestedLoopJoin", "CartesianProduct", "SortMergeJoin", "HashJoin"):
        assert bad not in p, bad


@needs_testdata
def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["padded_cells"](spark, SF))
    schemas = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("l_comment" not in s and "l_shipmode" not in s
                           for s in schemas)
    p = plan(E.queries()["bounds"](spark, SF))
    (schema,) = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert schema == ("ReadSchema: struct<l_quantity:double,l_extendedprice:double,"
                      "l_tax:double>")


@needs_testdata
def test_cap_is_one_window_over_one_cell_shuffle(spark):
    p = plan(E.queries()["capacity_split"](spark, SF))
    exchanges = [ln for ln in p.splitlines() if "hashpartitioning" in ln]
    assert len(exchanges) == 1 and "hashpartitioning(cell" in exchanges[0]
    assert "Window" in p


@needs_testdata
def test_two_phase_cap_moves_rows_once(spark):
    p = plan(E.queries()["capacity_split_two_phase"](spark, SF))
    exchanges = [ln for ln in p.splitlines() if "hashpartitioning" in ln]
    assert len(exchanges) == 1 and "hashpartitioning(cell" in exchanges[0] \
        and "_step1" in exchanges[0]
    assert p.count("\n(") and "SortMergeJoin" not in p and "rangepartitioning" not in p
    assert "Sample" not in p and "capacity-ranges" not in p


@needs_testdata
def test_text_maximum_keeps_the_hash_aggregate(spark):
    p = plan(E.queries()["object_summary"](spark, SF))
    assert "HashAggregate" in p and "SortAggregate" not in p


@needs_testdata
def test_aggregates_are_partial(spark):
    for name in ("object_summary", "cell_histogram", "bounds"):
        p = plan(E.queries()[name](spark, SF))
        assert "partial_" in p, name


def test_object_filter_pushed_into_catalogue_scan(spark, tmp_dir):
    # A file of its own: a cached scan of the same file would show up as an
    # in-memory scan instead.
    from skytiles.operators import object_summary
    from skytiles.sources import read_source, source_points, source_schema
    path = f"{tmp_dir}/cat.csv"
    with open(path, "w") as f:
        f.write(",".join(["1"] * len(source_schema())) + "\n")
    p = plan(object_summary(source_points(read_source(spark, path))))
    assert "PushedFilters: [IsNotNull(objectId)]" in p
    assert "ReadSchema: struct<sourceId:bigint,objectId:bigint,ra:double,decl:double>" in p
