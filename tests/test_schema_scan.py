import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import catalogue_line
from skytiles.sources import (object_schema, read_lines, read_object,
                              read_source, source_points, source_schema)
from skytiles.sources.schemas import column_index


def test_schema_positions_and_lengths():
    s, o = source_schema(), object_schema()
    assert len(s) == 107 and len(o) == 229
    assert [s[i].name for i in (0, 3, 106)] == ["sourceId", "objectId", "flagForWcs"]
    assert [o[i].name for i in (0, 23, 228)] == ["objectId", "extendedness", "subChunkId"]
    assert column_index(s, "ra") == 6 and column_index(s, "decl") == 9
    assert not s["sourceId"].nullable and s["objectId"].nullable
    assert o["iauId"].dataType.simpleString() == "string"
    assert o["yFlags"].dataType.simpleString() == "bigint"


def _fixture_line(values):
    return catalogue_line(source_schema(), values)


def test_csv_scan_trims_nulls_and_types(spark, tmp_dir):
    lines = [
        _fixture_line({"sourceId": " 10 ", "objectId": "7", "ra": " 1.5",
                       "decl": "-2.25 ", "filterId": "3"}),
        _fixture_line({"sourceId": "9", "ra": "359.9", "decl": "0"}),
    ]
    path = f"{tmp_dir}/cat.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    pts = source_points(read_source(spark, path)).orderBy("source_id").collect()
    assert [tuple(r) for r in pts] == [(9, None, 359.9, 0.0), (10, 7, 1.5, -2.25)]


def test_bad_value_only_fails_when_read(spark, tmp_dir):
    # FAILFAST raises on a bad coordinate, but only for rows the query keeps:
    # the object filter comes first, as in the tuple variant of the summary.
    lines = [_fixture_line({"sourceId": "1", "objectId": "5", "ra": "1", "decl": "1"}),
             _fixture_line({"sourceId": "2", "ra": "oops", "decl": "1"})]
    path = f"{tmp_dir}/bad.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    src = read_source(spark, path)
    kept = src.where(F.col("objectId").isNotNull()).select("sourceId").collect()
    assert [r[0] for r in kept] == [1]
    quarantined = (read_source(spark, path, mode="PERMISSIVE", corrupt_column="_bad")
                   .select("sourceId", "ra", "_bad").where(F.col("_bad").isNotNull()))
    assert [r.sourceId for r in quarantined.collect()] == [2]


def test_sample_scans(spark, source_sample, object_sample, sample_sql):
    """Every field of both layouts, against an independent reader."""
    for name, scan, schema in (("source", read_source(spark, source_sample), source_schema()),
                               ("object", read_object(spark, object_sample), object_schema())):
        texts = sample_sql.execute(f"SELECT * FROM {name}").fetchall()
        rows = scan.collect()
        assert len(rows) == len(texts) and len(scan.columns) == len(schema)
        for row, text in zip(rows, texts):
            for value, t, field in zip(row, text, schema.fields):
                kind = field.dataType.simpleString()
                want = t if t is None or kind == "string" else \
                    float(t) if kind == "double" else int(t)
                assert value == want, field.name


def test_parquet_scan_uses_schema(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2, 3.0, 4.0)],
                               "sourceId bigint, objectId bigint, ra double, decl double")
    df.write.parquet(f"{tmp_dir}/p")
    pts = source_points(read_source(spark, f"{tmp_dir}/p", fmt="parquet"))
    assert [tuple(r) for r in pts.collect()] == [(1, 2, 3.0, 4.0)]


def test_text_lines(spark, tmp_dir):
    path = f"{tmp_dir}/t.txt"
    with open(path, "w") as f:
        f.write("abc\nbbb\nxyz\naaa\n")
    from skytiles.operators import line_counts
    r = line_counts(read_lines(spark, path)).first()
    assert (r.lines_with_a, r.lines_with_b, r.n_lines) == (2, 2, 4)


def test_line_counts_on_a_text_file(spark, tmp_dir):
    from skytiles.operators import line_counts
    text = "".join(f"line {k} {'a' * (k % 3)}{'b' * (k % 2)}\n" for k in range(500)) + "ab"
    with open(f"{tmp_dir}/text", "w") as f:
        f.write(text)
    lines = text.split("\n")
    want = (sum("a" in ln for ln in lines), sum("b" in ln for ln in lines), len(lines))
    r = line_counts(read_lines(spark, f"{tmp_dir}/text")).first()
    assert (r.lines_with_a, r.lines_with_b, r.n_lines) == want


def test_empty_and_trailing_fields_are_null(spark, tmp_dir):
    line = _fixture_line({"sourceId": "4", "ra": "1", "decl": "2"})
    cells = line.split(",")
    cells[column_index(source_schema(), "objectId")] = ""   # empty field
    cells[-1] = ""                                          # trailing empty field
    path = f"{tmp_dir}/empty.csv"
    with open(path, "w") as f:
        f.write(",".join(cells) + "\n")
    r = read_source(spark, path).select("sourceId", "objectId", "flagForWcs").first()
    assert tuple(r) == (4, None, None)


def test_every_line_is_a_row_or_a_reject(spark, tmp_dir):
    from conftest import catalogue_line
    from skytiles.sources import scan_with_rejects
    schema = source_schema()
    good = {"sourceId": "7", "ra": " 1.5 ", "decl": "-2", "objectId": "NULL"}
    lines = [catalogue_line(schema, good), catalogue_line(schema, {**good, "ra": "abc"}),
             catalogue_line(schema, {**good, "ra": ""}), "1,2,3", "",
             catalogue_line(schema, {**good, "sourceId": "1.5"}),
             catalogue_line(schema, good) + ",9"]
    with open(f"{tmp_dir}/bad.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    rows, rejects = scan_with_rejects(spark, f"{tmp_dir}/bad.csv", schema)
    assert rows.columns == schema.fieldNames()
    assert sorted(map(str, (r.ra for r in rows.collect()))) == ["1.5", "None"]
    assert sorted((r.reason, r.line) for r in rejects.collect()) == sorted(
        [("bad ra", lines[1]), ("3 fields", "1,2,3"), ("empty line", ""),
         ("bad sourceId", lines[5]), (f"{len(schema) + 1} fields", lines[6])])
    assert rejects.select("reason").count() == 5 and rows.select("decl").count() == 2


def _lineitem(spark, path, n=3000):
    """A lineitem table of ``n`` rows of its own."""
    spark.range(n).selectExpr(
        "id div 4 AS l_orderkey", "id * 37 % 900 AS l_partkey", "id * 11 % 70 AS l_suppkey",
        "cast(id % 4 + 1 AS int) AS l_linenumber", "cast(id * 7 % 50 AS double) AS l_quantity",
        "id * 13.37D AS l_extendedprice", "0.01D * (id % 9) AS l_tax",
        "if(id % 3 = 0, 'R', 'N') AS l_returnflag", "'F' AS l_linestatus",
        "timestamp_seconds(id * 86400) AS l_shipdate").write.parquet(f"{path}/lineitem.parquet")
    return path


def _written_by(spark, monkeypatch, tmp_dir, name):
    """What the query returns, and the bytes a line of its catalogue takes."""
    data, out = _lineitem(spark, f"{tmp_dir}/in"), f"{tmp_dir}/out"
    monkeypatch.setattr(E, "scratch_path", lambda spark, name: out)
    rows = E.queries()[name](spark, data).collect()
    files = [f"{out}/{f}" for f in os.listdir(out) if f.startswith("part-")]
    lines = spark.read.text(out).count()
    return rows, lines, sum(map(os.path.getsize, files)) / lines


def test_object_catalogue_takes_little_disk(spark, monkeypatch, tmp_dir):
    rows, lines, size = _written_by(spark, monkeypatch, tmp_dir, "object_csv_scan")
    assert lines == len(rows) == 3000 and size < 200      # as plain text over 1,100
    assert sum(r.y_flags is None for r in rows) == 1000
    assert sorted(r.object_id for r in rows) == [8 * (k // 4) + k % 4 + 1 for k in range(3000)]


def test_source_catalogue_takes_little_disk(spark, monkeypatch, tmp_dir):
    rows, lines, size = _written_by(spark, monkeypatch, tmp_dir, "source_csv_scan")
    assert lines == 3000 and size < 150                   # as plain text over 500
    assert sum(r.n_sources for r in rows) == 2000


def test_rejects_parse_a_line_once(spark, monkeypatch, tmp_dir):
    from skytiles.sources import scan_with_rejects
    with open(f"{tmp_dir}/cat.csv", "w") as f:
        f.write(_fixture_line({"sourceId": "5", "ra": "1", "decl": "2"}) + "\nx,y\n")
    rows, rejects = scan_with_rejects(spark, f"{tmp_dir}/cat.csv", source_schema())
    both = rows.select("sourceId").union(rejects.select(F.length("line").cast("long")))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "from_csv" not in plan and sorted(r[0] for r in both.collect()) == [3, 5]
    rows, lines, size = _written_by(spark, monkeypatch, f"{tmp_dir}/q", "source_csv_rejects")
    assert sum(r.n_lines for r in rows) == 3000 and lines == 3000 and size < 150
