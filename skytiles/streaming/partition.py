"""Incremental neighbour-aware partitioning with Structured Streaming.

New catalogue files arriving in a directory are assigned to padded grid
cells (G4) and appended to the per-cell outputs, with the cap per output
cell (G5) kept over the whole stream: a cell's running count is Spark's own
keyed state, and its next star goes to output ``count // cap``. The order
in a cell is the order of arrival, as in the original job.

Outputs are ``cell=<name>/k=<overflow>`` Parquet files of the streaming
file sink, so state, files and progress commit together (exactly once). With
a small cap and a ``file:`` folder they are those of
:class:`skytiles.sinks.small.SmallStream`, which publishes a micro-batch once
as well, and spares the processes that Hadoop starts for every file.

The grid must be known up front (a stream has no "all rows" to take
bounds from): pass a box, e.g. from a batch bounds job over existing data,
or the whole sky. Stars outside the padded box go to the cell ``outside``;
none is lost.

The rows of a cell in one micro-batch pass through one task, a chunk at a
time; bound the micro-batch (``maxFilesPerTrigger``, ``maxBytesPerTrigger``)
to bound that.
"""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.capacity import MAX_PER_CELL
from ..operators.grid import DECL_PADDING, RA_PADDING, assign_padded
from ..sinks.cells import read_outputs
from ..sinks.small import (SmallStream, has_batches, local_folder, parquet_codec, small_outputs,
                           unpublished)

OUTSIDE = "outside"


def start_partition_stream(points: DataFrame, bounds, n: int, output_dir: str,
                           checkpoint_dir: str, cap: int = MAX_PER_CELL,
                           ra_pad: float = RA_PADDING,
                           decl_pad: float = DECL_PADDING,
                           columns: list[str] | None = None,
                           decl_band: str = "j", recentre: bool = True,
                           available_now: bool = True,
                           processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental partition job on a streaming points DataFrame.

    ``points`` comes from ``spark.readStream`` (e.g. the catalogue CSV
    reader's options with ``readStream``); ``bounds`` is a known box: a
    tuple ``(min_ra, max_ra, min_decl, max_decl)`` or a static one-row
    DataFrame. ``decl_band`` and ``recentre`` as in ``assign_padded``.
    Returns the running query.
    """
    if not points.isStreaming:
        raise ValueError("points must be a streaming DataFrame")
    if cap < 1:
        raise ValueError("cap must be >= 1")
    payload = columns or points.columns
    pairs = assign_padded(points, bounds, n, ra_pad, decl_pad, recentre=recentre,
                          decl_band=decl_band, outside=OUTSIDE).select("cell", *payload)

    def append(_, chunks, state):
        seen = state.get[0] if state.exists else 0
        for rows in chunks:
            yield rows.assign(nth=seen + np.arange(len(rows)))
            seen += len(rows)
        state.update((seen,))

    out = T.StructType([*pairs.schema.fields, T.StructField("nth", T.LongType())])
    rows = (pairs.groupBy("cell")
            .applyInPandasWithState(append, out, "seen long", "append",
                                    GroupStateTimeout.NoTimeout)
            .select("cell", F.floor(F.col("nth") / F.lit(cap)).alias("k"), *payload))
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint_dir)
    folder = _small_folder(rows, output_dir, cap)
    if folder:
        os.makedirs(folder, exist_ok=True)
        points.sparkSession.dataSource.register(SmallStream)
        writer = writer.format(SmallStream.name()).options(
            folder=folder, keys="cell,k", codec=parquet_codec(points.sparkSession))
    else:
        writer = writer.format("parquet").partitionBy("cell", "k").option("path", output_dir)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_stream_output(spark, output_dir: str, payload_schema: str) -> DataFrame:
    """Read the stream's output; ``cell`` stays a string, ``k`` is the
    overflow number. Micro-batches that are not published whole are left out."""
    folder = local_folder(spark, output_dir)
    return read_outputs(spark, output_dir, payload_schema,
                        without=unpublished(folder) if folder else [])


def _small_folder(rows: DataFrame, output_dir: str, cap: int) -> str | None:
    """The folder, where the tasks write the files themselves. A stream keeps
    the sink it began with: readers look for that one's log."""
    folder = local_folder(rows.sparkSession, output_dir)
    if folder and has_batches(folder):
        return folder
    if folder and os.path.isdir(f"{folder}/_spark_metadata"):
        return None
    return small_outputs(rows, output_dir, "parquet", cap)
