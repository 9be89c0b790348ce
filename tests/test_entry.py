"""The driver contract: entry runs, every query has an oracle, and every
query equals its oracle on the smallest benchmark tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import TESTDATA, needs_testdata

SF = f"{TESTDATA}/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_every_catalogue_query_has_an_oracle():
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.LLM_ORACLES) and set(E.LLM_ORACLES) <= set(
        E.LLM_QUERIES)


@needs_testdata
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["cell", "n_stars", "bar"] and len(rows) > 0


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@needs_testdata
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(r[c] for c in cols) for r in df.collect())
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert got == want
