"""Points and text views derived from the benchmark tables.

The benchmark tables carry no sky coordinates, so a points view is
derived from ``lineitem`` with expressions that are identical in Spark
SQL and in the DuckDB oracle:

* ``source_id = l_orderkey*8 + l_linenumber``
* ``object_id`` = ``l_partkey``, or null for returned items (flag ``R``)
* ``ra = l_extendedprice % 360.0``
* ``decl = l_quantity*2.0 - 50.0 + l_tax``

``l_partkey, l_suppkey, l_shipdate`` stay as attributes; together with the
point columns they give a total order (``SKY_ORDER``), which makes the
capacity split deterministic even where ``source_id`` repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .catalog import read_lines

SKY_SQL = {
    "source_id": "l_orderkey * 8 + l_linenumber",
    "object_id": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END",
    "ra": "l_extendedprice % 360.0",
    "decl": "l_quantity * 2.0 - 50.0 + l_tax",
}
SKY_ATTRIBUTES = ["l_partkey", "l_suppkey", "l_shipdate"]
SKY_ORDER = ["source_id", "ra", "decl", "l_partkey", "l_suppkey", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sky_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points view over ``lineitem`` (see module docstring)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(e).alias(n) for n, e in SKY_SQL.items()],
                     *SKY_ATTRIBUTES)


def sky_sql_view() -> str:
    """The same view as a SQL ``SELECT`` for the oracle (DuckDB dialect)."""
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in SKY_SQL.items())
    return (f"SELECT\n    {cols},\n    {', '.join(SKY_ATTRIBUTES)}\n"
            f"  FROM lineitem")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of ``documents``: every text written to text files and
    scanned back by :func:`skytiles.sources.catalog.read_lines`."""
    path = scratch_path(spark, "document-lines")
    table(spark, sf_dir, "documents").where("text is not null").select("text") \
        .write.option("lineSep", "\n").text(path)
    return read_lines(spark, path, line_sep="\n")


# A hot region: every third order's stars moved into a 0.01-degree box
# near RA 10, Decl 0, so one cell holds about a third of all stars.
HOT_SQL = dict(SKY_SQL)
HOT_SQL["ra"] = ("CASE WHEN l_orderkey % 3 = 0 THEN 10.0 + (l_extendedprice % 1.0) * 0.01 "
                 "ELSE l_extendedprice % 360.0 END")
HOT_SQL["decl"] = ("CASE WHEN l_orderkey % 3 = 0 THEN l_tax * 0.1 "
                   "ELSE l_quantity * 2.0 - 50.0 + l_tax END")


def hot_sky_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points view with a hot region (``HOT_SQL``); every row kept."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(e).alias(n) for n, e in HOT_SQL.items()],
                     *SKY_ATTRIBUTES)


def hot_sky_sql_view() -> str:
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in HOT_SQL.items())
    return (f"SELECT\n    {cols},\n    {', '.join(SKY_ATTRIBUTES)}\n"
            f"  FROM lineitem")


# Some stars without a usable coordinate.
BAD_SQL = dict(SKY_SQL)
BAD_SQL["ra"] = ("CASE WHEN l_returnflag = 'R' THEN NULL "
                 "ELSE l_extendedprice % 360.0 END")
BAD_SQL["decl"] = ("CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN NULL "
                   "ELSE l_quantity * 2.0 - 50.0 + l_tax END")


def bad_sky_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points view with missing coordinates (``BAD_SQL``)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(e).alias(n) for n, e in BAD_SQL.items()],
                     *SKY_ATTRIBUTES)


def bad_sky_sql_view() -> str:
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in BAD_SQL.items())
    return (f"SELECT\n    {cols},\n    {', '.join(SKY_ATTRIBUTES)}\n"
            f"  FROM lineitem")
