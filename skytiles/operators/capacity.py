"""Capacity split (G5): at most ``cap`` points per output cell.

Within each cell, points are ranked by a total order; the k-th block of
``cap`` points goes to the cell's k-th overflow copy. The number ``k`` is
the result (``overflow``); its name, the suffix repeated k times (``2.3``,
``2.3bis``, ``2.3bisbis``), is made only where it is shown
(:func:`with_out_cell`), since it grows with k. The cap is global and
deterministic: it does not depend on task layout or arrival order.

Ranking needs every row of a cell in order, which with a plain window
puts a whole cell in one task. When a cell is larger than
``rows_per_task`` the ``two_phase`` method splits that cell, and no other,
by counting: the rows of the cell are counted in ``BINS`` equal steps of the
leading order column, a step that still holds too many rows is divided
further, over the next order column where the first has one value left,
until every step fits a task. A row's rank is the number of rows in the
steps before its own, from the small table of counts, plus its place in
its step. So the rows move once, in a window over ``(cell, step)`` that
cold cells pass as one step; nothing is sampled or stored. Each round of
counting is a narrow pass over the rows of oversized steps.

Numbers, dates, times and booleans can be divided. From an order column of
another type on, a step is not divided any further: its rows are ranked by
one task, right but not bounded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coords import OVERFLOW_SUFFIX, overflow_name
from ..functions.sizing import collect_small, ship_small
from ..session import write_scratch_table

# --- Fixed value of the neighbour-aware job: points per output file. ---
MAX_PER_CELL = 10000

ROWS_PER_TASK = 2_000_000
BINS = 256        # steps that a part of a cell is counted in at once
LEADING = 3       # digits of the order whose bounds every round finds
MAX_ROUNDS = 16   # of counting; each divides oversized steps by up to BINS
NAMES_BYTES = 600_000      # of output names in a task; Parquet's dictionaries hold 1 MiB
MAX_NAME_TASKS = 20_000
ORDER = ("source_id", "ra", "decl")


def capacity_split(assigned: DataFrame, cap: int = MAX_PER_CELL,
                   order_by: list[str] | tuple[str, ...] = ORDER,
                   cell_col: str = "cell", method: str = "auto",
                   rows_per_task: int = ROWS_PER_TASK,
                   cell_rows_bound: int | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """Adds ``cell_rank`` (1-based, per cell) and ``overflow`` (0-based).

    ``order_by`` gives the order of a cell's rows; rows that it leaves equal
    are ordered by a hash of all their columns, so the result is the same
    for every method and task layout. ``method`` is ``window``,
    ``two_phase`` or ``auto``: two-phase only when some cell exceeds
    ``rows_per_task``, which the rows per cell tell. They are taken from
    ``counts`` (columns ``cell, n_stars``) where given, and counted
    otherwise, unless ``cell_rows_bound`` - a proven upper bound on any
    cell's row count, such as the number of input points, since a point is
    in a given cell at most once - already shows that no cell can.
    """
    if cap < 1:
        raise ValueError("cap must be >= 1")
    order_by = list(order_by)
    if method not in ("auto", "window", "two_phase"):
        raise ValueError("method must be auto, window or two_phase")
    if method == "auto" and cell_rows_bound is not None \
            and cell_rows_bound <= rows_per_task:
        method = "window"
    hot = None
    if method == "auto" or (method == "two_phase" and counts is not None):
        if counts is None:
            counts = cell_counts(assigned, cell_col)
        # At most total / rows_per_task cells are that large.
        hot, none = ship_small(counts.where(F.col("n_stars") > rows_per_task)
                               .select(F.col("cell").alias(cell_col)))
        method = "window" if none else "two_phase"
    ties = _tie_break(assigned, [cell_col, *order_by])
    if method == "window":
        ranked = assigned.withColumn("cell_rank", _place([cell_col], order_by, ties))
    else:
        ranked = _rank_two_phase(assigned, hot, order_by, ties, cell_col, rows_per_task)
    return ranked.withColumn("overflow", F.floor((F.col("cell_rank") - 1) / F.lit(cap)))


def cell_counts(assigned: DataFrame, cell_col: str = "cell") -> DataFrame:
    """Rows ``cell, n_stars``: one partial aggregate that reads only what the
    cells need."""
    return assigned.groupBy(F.col(cell_col).alias("cell")).agg(
        F.count(F.lit(1)).alias("n_stars"))


def with_out_cell(split: DataFrame, cell_col: str = "cell", out_col: str = "out_cell",
                  suffix: str = OVERFLOW_SUFFIX) -> DataFrame:
    """The name of each row's output cell, for showing."""
    return split.withColumn(out_col, overflow_name(cell_col, "overflow", suffix))


def spread_outputs(split: DataFrame, counts: DataFrame, cap: int, cell_col: str = "cell",
                   suffix: str = OVERFLOW_SUFFIX) -> DataFrame:
    """The rows of a split, laid out for showing their outputs' names: the
    rows of an output together, and so few outputs to a task that their names
    fit the dictionary of a columnar file, which then holds each name once and
    not once a row. Names grow with the overflow number, so those of a cell
    take space in the square of its rows. Nothing moves while the names of
    every cell are short (``counts``: columns ``cell, n_stars``)."""
    k = F.ceil(F.col("n_stars") / F.lit(cap)).cast("double")
    names = k * (F.length("cell") + F.lit(4)) + F.lit(len(suffix)) * k * (k - 1) / 2
    longest, total = counts.agg(F.max(names), F.sum(names)).first()
    if not longest or longest <= NAMES_BYTES:
        return split
    return split.repartition(min(MAX_NAME_TASKS, math.ceil(total / NAMES_BYTES)),
                             cell_col, "overflow")


def _tie_break(df: DataFrame, known: list[str]) -> list[Column]:
    """A hash of the row, unless the order columns are all there is."""
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return [F.xxhash64(*hashed)] if set(hashed) - set(known) else []


def _place(keys: list[str], order_by: list[str], ties: list[Column]) -> Column:
    w = Window.partitionBy(*keys).orderBy(*order_by, *ties)
    return F.row_number().over(w).cast("long")


def _digits(df: DataFrame, order_by: list[str]) -> list[Column]:
    """The order columns as finite doubles that sort as they do, up to the
    first column of a type without such a form. Each is exact, so equal
    doubles are equal values."""
    digits: list[Column] = []
    for name in order_by:
        field = next(f for f in df.schema.fields if f.name == name)
        kind, value = field.dataType, F.col(name)
        if isinstance(kind, T.TimestampType):
            kind, value = T.LongType(), F.unix_micros(value)
        elif isinstance(kind, T.DateType):
            kind, value = T.IntegerType(), F.unix_date(value)
        elif isinstance(kind, T.BooleanType):
            kind, value = T.IntegerType(), value.cast("int")
        if isinstance(kind, T.LongType):      # more bits than a double holds
            own = [F.shiftright(value, 32).cast("double"),
                   value.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")]
        elif isinstance(kind, T.IntegralType):
            own = [value.cast("double")]
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = value.cast("double")
            infinite = F.lit(float("inf"))
            # Null, -Infinity, numbers, Infinity, NaN, as Spark sorts them.
            kinds = F.when(F.isnan(value), 3.0).when(value == infinite, 2.0).when(
                value == -infinite, 0.0).otherwise(1.0)
            digits.append(F.when(value.isNull(), -1.0).otherwise(kinds))
            own = [F.when(F.isnan(value) | (F.abs(value) == infinite), 0.0).otherwise(value)]
        else:
            break
        if not isinstance(kind, (T.DoubleType, T.FloatType)) and field.nullable:
            digits.append(value.isNotNull().cast("double"))
        digits += [F.coalesce(d, F.lit(0.0)) for d in own]
    return digits


def _rank_two_phase(df: DataFrame, hot: DataFrame | None, order_by: list[str],
                    ties: list[Column], cell_col: str, rows_per_task: int) -> DataFrame:
    """``hot``: the cells that may be divided (any, where it is not given)."""
    digits = _digits(df, order_by)
    narrow = df.select(cell_col, F.array(*digits).alias("_digits"))
    if hot is not None:
        narrow = narrow.join(hot, cell_col)
    counted = collect_small(_counted(narrow, [cell_col], LEADING, len(digits)))
    # The parts of a round are disjoint and oversized, so they are few.
    parts, none = _divisible(counted, narrow, [cell_col], len(digits), rows_per_task)
    out, keys, done = df.withColumn("_digits", F.array(*digits)), [cell_col], []
    while not none and len(keys) <= MAX_ROUNDS:
        step = f"_step{len(keys)}"
        narrow = narrow.join(parts, keys).withColumn(step, _step()) \
            .drop("_digit", "_lo", "_hi")
        out = out.join(parts, keys, "left").withColumn(step, F.coalesce(_step(), F.lit(0))) \
            .drop("_digit", "_lo", "_hi")
        keys = [*keys, step]
        counted = write_scratch_table(_counted(narrow, keys, LEADING, len(digits)),
                                      "capacity-steps")
        parts, none = _divisible(counted, narrow, keys, len(digits), rows_per_task)
        # Steps that are not divided further are final.
        final = counted.select(*keys, "_n")
        done.append(final if none else final.join(parts.select(*keys), keys, "left_anti"))
    out = out.drop("_digits")
    if not done:                    # nothing to divide, or nothing to divide by
        return out.withColumn("cell_rank", _place([cell_col], order_by, ties))
    final = done[0]
    for more in done[1:]:
        final = final.unionByName(more, allowMissingColumns=True)
    final = final.fillna(0, subset=keys[1:])
    before = Window.partitionBy(cell_col).orderBy(*keys[1:]).rowsBetween(
        Window.unboundedPreceding, -1)
    shifts, _ = ship_small(final.select(*keys, F.sum("_n").over(before).alias("_before")))
    return (out.withColumn("_place", _place(keys, order_by, ties))
            .join(shifts, keys, "left")
            .withColumn("cell_rank", F.col("_place") + F.coalesce("_before", F.lit(0)))
            .drop("_place", "_before", *keys[1:]))


def _step() -> Column:
    """The step of a row's digit between the part's bounds; grows with it.
    Null outside the parts. Halves, so that the span of two doubles is one."""
    span = F.col("_hi") / 2 - F.col("_lo") / 2
    at = F.get("_digits", F.col("_digit")) / 2 - F.col("_lo") / 2
    return F.when(F.col("_digit").isNotNull(), F.least(
        F.floor(at / span * BINS), F.lit(BINS - 1)).cast("int"))


def _counted(narrow: DataFrame, keys: list[str], most: int, n_digits: int) -> DataFrame:
    """Rows of every part, and the bounds of its first ``most`` digits."""
    return narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[
        f(F.get("_digits", F.lit(k))).alias(f"{n}{k}")
        for k in range(min(most, n_digits)) for n, f in (("_lo", F.min), ("_hi", F.max))])


def _divisible(counted: DataFrame, narrow: DataFrame, keys: list[str], n_digits: int,
               rows_per_task: int, known: int = LEADING) -> tuple[DataFrame, bool]:
    """Of counted parts the oversized ones that can be divided: the first
    digit that is not one value throughout, and its bounds; and whether there
    are none. Where the known digits are all one value, the others' bounds
    take a further pass."""
    digit = low = high = F.lit(None)
    for k in reversed(range(min(known, n_digits))):
        several = F.col(f"_hi{k}") > F.col(f"_lo{k}")
        digit = F.when(several, F.lit(k)).otherwise(digit)
        low = F.when(several, F.col(f"_lo{k}")).otherwise(low)
        high = F.when(several, F.col(f"_hi{k}")).otherwise(high)
    large = collect_small(counted.where(F.col("_n") > rows_per_task).select(
        *keys, digit.cast("int").alias("_digit"), low.cast("double").alias("_lo"),
        high.cast("double").alias("_hi")))
    # A span too small for a double is not divided.
    found = large.where((F.col("_hi") / 2 - F.col("_lo") / 2) > 0)
    if known < n_digits:
        alike, none = ship_small(large.where(F.col("_digit").isNull()).select(*keys))
        if not none:
            rest = _counted(narrow.join(alike, keys), keys, n_digits, n_digits)
            found = found.union(_divisible(collect_small(rest), narrow, keys, n_digits,
                                           rows_per_task, n_digits)[0])
    return ship_small(found)
