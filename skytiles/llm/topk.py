"""Exact top-k search: norm-sorted inner products.

Vectors are quantised to integers, sorted by length (longest first) and
packed into blocks; queries are packed into blocks as well. The longest
block of each number of components gives every query a first k-th best
score, in a narrow pass over the queries. Then the queries go out in waves of
a fixed size, and each task takes the blocks of its part of the table in
their order against the whole wave: blocks are read where they lie and never
shuffled. A block is met only by queries to which its longest vector could
still matter (Cauchy-Schwarz). Within a block the vectors are compared step by
step in a basis rotated by the singular vectors of a sample: the inner
product of the leading coordinates plus the product of the residual lengths is
an upper bound; queries and vectors that no pair needs any more leave after
each step, and pairs whose bound reaches the query's k-th best score get their
exact integer product. The rotation decides how much is pruned, never the
result: bounds carry a margin for rounding, and equal scores are never pruned.

A task holds one wave of queries with their k best rows so far and one block,
and compares a bounded number of pairs at once, whatever the number of
components; what it hands on are at most k rows per query.

Defined cases: a vector that is null, or holds a null, NaN or infinite
component, takes no part; vectors meet only vectors of their own number of
components; a query never meets its own row, but does meet other rows that
repeat its id; equal scores go to the smaller id; a query with fewer than
k candidates gets all of them; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, write_scratch_table
from .common import share_code

SCALE = 256
BLOCK_BYTES = 4 << 20       # of a packed block of candidates, at 8 bytes a component
QUERY_BYTES = 1 << 20       # of a packed block of queries
ROW_WORDS = 8               # a row's share of a block beside its components
WAVE_BYTES = 32 << 20       # of the query blocks that are broadcast at once
PAIRS = 1 << 20             # pairs of a query and a vector compared at once
SAMPLE = 4096               # vectors whose singular vectors give the rotation
HEADS = (0.125, 0.25, 0.5, 0.75)    # shares of the coordinates after which pairs are pruned

_PACKED = ("part int, made int, dim int, rows int, longest double, uids binary, ids binary, "
           "vectors binary")
_FOUND = "q_uid bigint, q_id bigint, score bigint, id bigint, uid bigint"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Rows ``uid, id, v, dim, length``: components ``floor(scale * x)``."""
    x = F.col(vector_col)
    usable = x.isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return (vectors.where(usable)
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
            .where("id is not null")
            .withColumn("dim", F.size("v"))
            .withColumn("length", F.sqrt(F.aggregate(
                "v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))
            .withColumn("uid", F.monotonically_increasing_id()))


def packed(rows: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of :func:`quantised` packed into blocks in their order, numbered
    from 1 within their partition."""
    def run(batches):
        from pyspark import TaskContext
        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}

        def block(dim):
            nonlocal made
            ids, uids, lengths, vs = zip(*held.pop(dim))
            made += 1
            return (part, made, dim, len(ids), float(max(lengths)),
                    np.array(uids, "<i8").tobytes(), np.array(ids, "<i8").tobytes(),
                    np.array(vs, "<i8").reshape(len(ids), dim).tobytes())

        def out(blocks):
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(),
                     pa.binary(), pa.binary())
            names = ("part", "made", "dim", "rows", "longest", "uids", "ids", "vectors")
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*blocks), kinds)], names)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            vectors = batch.column(4)
            for i, (id_, uid, length, dim) in enumerate(zip(*columns)):
                own = held.setdefault(dim, [])
                own.append((id_, uid, length, np.asarray(vectors[i].values)))
                if len(own) * (dim + ROW_WORDS) * 8 >= block_bytes:
                    yield out([block(dim)])
        for dim in list(held):
            yield out([block(dim)])

    return rows.select("id", "uid", "length", "dim", "v").mapInArrow(run, _PACKED)


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, drawn by hash: those of
    the largest singular values first."""
    sample = (rows.where(F.col("dim") == dim).select("v", F.xxhash64("uid").alias("by"))
              .orderBy("by").limit(SAMPLE).toArrow().column("v"))
    x = np.array(sample.to_pylist(), np.float64).reshape(-1, dim)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1] if len(x) and dim else np.eye(dim)


class Block:
    """An unpacked block: ids, integer vectors, rotated vectors, and the
    residual lengths after each head."""

    def __init__(self, uids, ids, vectors, dim: int, rotate: np.ndarray):
        self.uids, self.ids = np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8")
        self.exact = np.frombuffer(vectors, "<i8").reshape(len(self.ids), dim)
        self.rotated = self.exact.astype(np.float64) @ rotate
        squares = np.cumsum((self.rotated ** 2)[:, ::-1], axis=1)[:, ::-1] if dim else \
            np.zeros((len(self.ids), 0))
        self.rest = [np.sqrt(squares[:, h]) if h < dim else np.zeros(len(self.ids))
                     for h in heads(dim)]
        self.length = np.sqrt(squares[:, 0]) if dim else np.zeros(len(self.ids))


def heads(dim: int) -> list[int]:
    return sorted({max(1, int(dim * share)) for share in HEADS})


def best_rows(rows, scores, ids, uids, k: int):
    """The k best of every row, best first, equal scores by id; and the rows
    that have k, with their k-th score."""
    order = np.lexsort((uids, ids, -scores, rows))
    rows, scores, ids, uids = (x[order] for x in (rows, scores, ids, uids))
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else order
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
    kth = place == k - 1
    kept = place < k
    return tuple(x[kept] for x in (rows, scores, ids, uids)), (rows[kth], scores[kth])


def _exact(queries: Block, candidates: Block, q, c, alive):
    """The pairs alive, and their integer products."""
    qi, ci = np.nonzero(alive)
    # Below this length every partial sum is exact in a double.
    plain = float(queries.length[q].max()) * float(candidates.length[c].max()) < 2.0 ** 52
    kind = np.float64 if plain else np.int64
    if len(qi) * 8 >= alive.size:
        scores = (queries.exact[q].astype(kind) @ candidates.exact[c].astype(kind).T)[qi, ci]
    else:
        step = max(1, PAIRS // max(1, queries.exact.shape[1]))
        scores = np.concatenate([
            np.einsum("ij,ij->i", queries.exact[q[qi[a:a + step]]].astype(kind),
                      candidates.exact[c[ci[a:a + step]]].astype(kind))
            for a in range(0, len(qi), step)])
    return q[qi], c[ci], scores.astype(np.int64)


def block_pairs(queries: Block, candidates: Block, least: np.ndarray, tally: list[int]):
    """``(query rows, candidate rows, scores)`` of the pairs that score
    ``least`` of their query or more, for a bounded number of pairs at a time;
    the first two figures of ``tally`` grow by the pairs and by those that got
    an exact product. ``least`` may rise between two results."""
    dim, n = queries.exact.shape[1], len(candidates.ids)
    size = max(1, PAIRS // max(1, n))
    for at in range(0, len(queries.ids), size):
        q, c = np.arange(at, min(at + size, len(queries.ids))), np.arange(n)
        tally[0] += len(q) * n
        goal = least[q]

        def upper(inner, a, b):
            scale = queries.length[q][:, None] * candidates.length[c][None, :]
            return inner + a[q][:, None] * b[c][None, :] + (1e-9 * scale + 1e-6) >= goal[:, None]

        alive = upper(0.0, queries.length, candidates.length)
        inner, done = np.zeros(alive.shape), 0
        for step, head in enumerate(heads(dim)):
            rows, columns = alive.any(axis=1), alive.any(axis=0)
            if not rows.all() or not columns.all():
                q, c, goal = q[rows], c[columns], goal[rows]
                alive, inner = alive[rows][:, columns], inner[rows][:, columns]
            if not alive.size:
                break
            inner += queries.rotated[q, done:head] @ candidates.rotated[c, done:head].T
            done = head
            alive &= upper(inner, queries.rest[step], candidates.rest[step])
        if alive.size:
            alive &= queries.uids[q][:, None] != candidates.uids[c][None, :]
        if not alive.any():
            continue
        qi, ci, scores = _exact(queries, candidates, q, c, alive)
        tally[1] += len(qi)
        good = scores >= least[qi]
        yield qi[good], ci[good], scores[good]


class Wanted:
    """A block of queries with their k best rows so far, and the score that
    another row must reach."""

    def __init__(self, row: dict, turn: np.ndarray, k: int):
        self.dim, self.k = row["dim"], k
        self.queries = Block(row["uids"], row["ids"], row["vectors"], row["dim"], turn)
        self.least = np.full(len(self.queries.ids), -np.inf)
        if row.get("least"):
            self.least[:] = np.frombuffer(row["least"], "<f8")
        self.best = (np.zeros(0, np.int64),) * 4

    def meet(self, candidates: Block, tally: list[int]) -> None:
        for qi, ci, scores in block_pairs(self.queries, candidates, self.least, tally):
            new = (qi, scores, candidates.ids[ci], candidates.uids[ci])
            self.best, (full, kth) = best_rows(
                *[np.concatenate(x) for x in zip(self.best, new)], self.k)
            self.least[full] = np.maximum(self.least[full], kth)

    def found(self) -> pa.RecordBatch:
        rows, scores, ids, uids = self.best
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.queries.uids[rows], self.queries.ids[rows], scores, ids,
                                   uids)], ["q_uid", "q_id", "score", "id", "uid"])

    def need(self) -> float:
        """The length below which no vector matters to any of the queries."""
        if not len(self.least):
            return float("inf")
        return float(np.where(self.least <= 0, 0.0, self.least / np.maximum(
            self.queries.length, 1e-300)).min()) * (1 - 1e-9)


def _lead(asked: DataFrame, lead: list[dict], rotate: dict[int, np.ndarray], k: int) -> DataFrame:
    """The query blocks after the longest block: their k best rows there
    (``best``, packed), the score to reach (``least``, packed; minus infinity
    where there are fewer than k) and the length that a vector needs."""
    shared = asked.sparkSession.sparkContext.broadcast((lead, rotate))
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
             pa.binary(), pa.binary(), pa.float64())
    names = ("part", "made", "dim", "uids", "ids", "vectors", "best", "least", "need")

    def run(batches):
        blocks, turns = shared.value
        longest = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if dim not in longest:
                    own = next(x for x in blocks if x["dim"] == dim)
                    longest = {dim: Block(own["uids"], own["ids"], own["vectors"], dim,
                                          turns[dim])}
                wanted = Wanted(row, turns[dim], k)
                wanted.meet(longest[dim], [0, 0])
                sink = pa.BufferOutputStream()
                best = wanted.found()
                with pa.ipc.new_stream(sink, best.schema) as writer:
                    writer.write_batch(best)
                out = (row["part"], row["made"], dim, row["uids"], row["ids"], row["vectors"],
                       sink.getvalue().to_pybytes(), wanted.least.astype("<f8").tobytes(),
                       wanted.need())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip(out, kinds)], names)

    return write_scratch_table(asked.mapInArrow(
        run, "part int, made int, dim int, uids binary, ids binary, vectors binary, "
             "best binary, least binary, need double"), "topk-queries-led")


def _first_found(led: DataFrame) -> DataFrame:
    """The rows that the longest blocks gave."""
    def run(batches):
        for batch in batches:
            for best in batch.column(0).to_pylist():
                yield from pa.ipc.open_stream(best)

    return led.select("best").mapInArrow(run, _FOUND)


def _wave(blocks: DataFrame, wave: list[dict], rotate: dict[int, np.ndarray], k: int,
          tallies) -> str:
    """Every block against one wave of queries; the path of what was found."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((wave, rotate))

    def run(batches):
        rows, turns = shared.value
        asked: list[Wanted] = []
        tally = [0, 0]
        for batch in batches:
            for row in batch.to_pylist():
                asked = asked or [Wanted(x, turns[x["dim"]], k) for x in rows]
                block = None
                for wanted in asked:
                    if wanted.dim != row["dim"] or wanted.need() > row["longest"]:
                        continue
                    block = block or Block(row["uids"], row["ids"], row["vectors"], row["dim"],
                                           turns[row["dim"]])
                    wanted.meet(block, tally)
        for own, total in zip(tallies or (), tally):
            own.add(total)
        for wanted in asked:
            yield wanted.found()

    least = min(row["need"] for row in wave)
    path = scratch_path(spark, "topk-wave")
    blocks.where(F.col("longest") >= least).mapInArrow(run, _FOUND).write.parquet(path)
    shared.destroy()
    return path


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE,
          report: dict[str, int] | None = None) -> DataFrame:
    """Rows ``query_id, rank, id, score``. ``is_query`` is a condition on
    the id, written for a column named ``id``. ``report`` is told the
    ``pairs`` of queries and vectors in blocks that were met after the longest,
    and how many of them got an ``exact`` product (by Spark accumulators: a
    task that runs twice counts twice)."""
    spark = vectors.sparkSession
    share_code(spark)
    rows = write_scratch_table(quantised(vectors, id_col, vector_col, scale), "topk-vectors")
    rotate = {r["dim"]: rotation(rows, r["dim"])
              for r in rows.select("dim").distinct().collect()}
    by_length = rows.repartitionByRange(F.col("dim"), F.desc("length"), "uid") \
        .sortWithinPartitions("dim", F.desc("length"), "uid")
    blocks = write_scratch_table(packed(by_length, BLOCK_BYTES), "topk-blocks")
    queries = rows.where(is_query).repartitionByRange(F.col("dim"), "uid")
    asked = write_scratch_table(packed(queries, QUERY_BYTES), "topk-queries")

    # The longest block of each dimension: one of a fixed size each.
    longest = blocks.groupBy("dim").agg(
        F.max_by(F.struct("part", "made"), F.struct("longest", "part", "made")).alias("x")) \
        .select("x.part", "x.made")
    lead = blocks.join(F.broadcast(longest), ["part", "made"]).toArrow().to_pylist()
    led = _lead(asked, lead, rotate, k)
    others = blocks.join(F.broadcast(longest), ["part", "made"], "left_anti")

    # Waves: blocks numbered over all partitions, a fixed number in each.
    at, before = 0, {}
    for r in asked.groupBy("part").agg(F.max("made").alias("n")).orderBy("part").collect():
        before[r["part"]] = at
        at += r["n"]
    tallies = [spark.sparkContext.accumulator(0) for _ in range(2)] if report is not None else None
    size = max(1, WAVE_BYTES // QUERY_BYTES)
    paths = []
    for first in range(0, at, size):
        wave = led.where(_between(before, first, first + size)).drop("best").toArrow().to_pylist()
        paths.append(_wave(others, wave, rotate, k, tallies))
    if report is not None:
        report.update(pairs=tallies[0].value, exact=tallies[1].value)
    found = _first_found(led)
    if paths:
        found = found.unionByName(spark.read.parquet(*paths))
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), "id", "uid")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("q_id").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                    "id", "score"))


def _between(before: dict[int, int], first: int, end: int) -> Column:
    """Blocks numbered ``first`` to ``end``: those of a partition follow the
    blocks of the partitions before it."""
    parts = sorted(before)
    inside = F.lit(False)
    for part, following in zip(parts, [*parts[1:], None]):
        last = float("inf") if following is None else before[following]
        if before[part] < end and last > first:
            inside |= ((F.col("part") == part) & (F.col("made") > first - before[part])
                       & (F.col("made") <= end - before[part]))
    return inside
