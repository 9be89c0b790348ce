import os
import random
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"

needs_testdata = pytest.mark.skipif(not os.path.exists(f"{TESTDATA}/sf0.001"),
                                    reason="benchmark tables not available")


@pytest.fixture(scope="session")
def spark():
    from skytiles.session import local_session
    s = local_session("*", shuffle_partitions=8, app="skytiles-tests")
    yield s
    s.stop()


def catalogue_line(schema, values: dict) -> str:
    """A catalogue line with the given fields filled, ``NULL`` elsewhere."""
    names = schema.fieldNames()
    cells = ["NULL"] * len(names)
    for name, value in values.items():
        cells[names.index(name)] = value
    return ",".join(cells)


def _any_value(rnd, field) -> str:
    kind = field.dataType.simpleString()
    if kind == "string":
        return f"J{rnd.randrange(10 ** 6)}"
    if kind == "double":
        return repr(rnd.uniform(-100, 100))
    return str(rnd.randrange(100))


def _sample(path, schema, n, seed, own) -> str:
    """A made-up catalogue file: not-null fields and some others filled,
    ``own(k, rnd)`` on top; blanks around some values."""
    rnd = random.Random(seed)
    with open(path, "w") as f:
        for k in range(n):
            values = {c.name: _any_value(rnd, c) for c in schema.fields
                      if not c.nullable or rnd.random() < 0.4}
            values |= own(k, rnd)
            f.write(catalogue_line(schema, {c: rnd.choice(["", " "]) + v + rnd.choice(["", " "])
                                            for c, v in values.items()}) + "\n")
    return str(path)


@pytest.fixture(scope="session")
def source_sample(tmp_path_factory) -> str:
    """56 detections in a small field near RA 358; only the last six belong
    to an object."""
    from skytiles.sources import source_schema
    return _sample(tmp_path_factory.mktemp("s") / "source.csv", source_schema(), 56, 41,
                   lambda k, rnd: {
                       "sourceId": str(rnd.randrange(10 ** 16, 10 ** 17) + k),
                       "objectId": "430000000000001" if k >= 50 else "NULL",
                       "ra": repr(rnd.uniform(357.95, 358.09)),
                       "decl": repr(rnd.uniform(2.56, 3.18))})


@pytest.fixture(scope="session")
def object_sample(tmp_path_factory) -> str:
    from skytiles.sources import object_schema
    return _sample(tmp_path_factory.mktemp("o") / "object.csv", object_schema(), 50, 42,
                   lambda k, rnd: {"objectId": str(10 ** 14 + k)})


@pytest.fixture(scope="session")
def sample_points(spark, source_sample):
    from skytiles.sources import read_source, source_points
    return source_points(read_source(spark, source_sample)).cache()


@pytest.fixture(scope="session")
def sample_sql(source_sample, object_sample):
    """An independent reader of the made-up files: DuckDB over plain text
    columns ``c0, c1, ...`` (blanks trimmed, ``NULL`` as null)."""
    con = duckdb.connect()
    for name, path, width in (("source", source_sample, 107), ("object", object_sample, 229)):
        columns = ", ".join(f"'c{k}': 'VARCHAR'" for k in range(width))
        trimmed = ", ".join(f"nullif(trim(c{k}), 'NULL') AS c{k}" for k in range(width))
        con.execute(f"CREATE VIEW {name} AS SELECT {trimmed} FROM read_csv('{path}', "
                    f"header=false, delim=',', quote='', columns={{{columns}}})")
    con.execute("CREATE VIEW star AS SELECT CAST(c0 AS BIGINT) AS source_id, "
                "CAST(c3 AS BIGINT) AS object_id, CAST(c6 AS DOUBLE) AS ra, "
                "CAST(c9 AS DOUBLE) AS decl FROM source")
    return con


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def points_df(spark, rows):
    """Points from (source_id, object_id, ra, decl) tuples."""
    return spark.createDataFrame(
        rows, "source_id bigint, object_id bigint, ra double, decl double")
