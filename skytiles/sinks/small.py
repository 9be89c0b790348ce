"""Many small outputs in a folder that every machine has mounted (``file:``).

Hadoop's local file system starts a ``chmod`` process for every directory,
file and checksum file it makes. An output of a few hundred rows is one of
each, so those processes take nearly all of the time of a job with a small
cap. Here the writer tasks make directories and files by plain system calls,
from Arrow batches in which the rows of an output follow each other. The
outputs are those of Spark's own writer, but for the checksum files: a
directory each, with Parquet or the lines of Spark's CSV generator.

A task writes into an attempt folder of its own below ``_temporary`` and
returns its name. Attempts that failed are never named, so after a retry or
a speculative copy each row is published once: the driver renames the outputs
of the named attempts into place and deletes the rest.

Other file systems, larger outputs and nested columns go through Spark's
writer (:func:`small_outputs` tells).
"""

from __future__ import annotations

import errno
import json
import os
import shutil
import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

SMALL_ROWS = 1_000      # up to here making a file costs more than filling it; a task holds them
_TEMPORARY = "_temporary"
_BATCHES = "_batches"   # of a stream: what has been published
_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
          T.TimestampNTZType)
_CODECS = {"snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "none": "none",
           "uncompressed": "none"}
_ESCAPED = frozenset([*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"])   # as Spark has them
NULL_NAME = "__HIVE_DEFAULT_PARTITION__"

# Python workers get this module's code by value: they need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def local_folder(spark: SparkSession, path: str) -> str | None:
    """A ``file:`` folder as the machines' own path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def small_outputs(df: DataFrame, path: str, fmt: str, output_rows: int | None) -> str | None:
    """The folder, if outputs of at most ``output_rows`` rows of ``df`` are
    to be written there by the tasks themselves."""
    if output_rows is None or output_rows > SMALL_ROWS or fmt not in ("csv", "parquet"):
        return None
    if not all(isinstance(f.dataType, _PLAIN) for f in df.schema.fields):
        return None
    if fmt == "parquet" and parquet_codec(df.sparkSession) is None:
        return None
    return local_folder(df.sparkSession, path)


def parquet_codec(spark: SparkSession) -> str | None:
    """The session's Parquet compression, if Arrow writes it."""
    return _CODECS.get(spark.conf.get("spark.sql.parquet.compression.codec", "snappy").lower())


def write_small(df: DataFrame, keys: list[str], folder: str, fmt: str, mode: str) -> int:
    """One directory per output of ``df``, named by the two ``keys``, which
    are not written into the rows. The rows of an output are in one
    partition. Returns the rows written."""
    if os.path.lexists(folder):
        if mode != "overwrite":
            raise FileExistsError(f"{folder} already exists")
        shutil.rmtree(folder)
    payload = [c for c in df.columns if c not in keys]
    rows = df.sortWithinPartitions(*keys)
    if fmt == "csv":
        rows = rows.select(*keys, F.concat(F.to_csv(F.struct(*payload)), F.lit("\n"))
                           .alias("_line"))
    else:
        rows = rows.select(*keys, *payload)
    codec = parquet_codec(df.sparkSession)

    def task(batches):
        attempt, n = write_outputs(batches, folder, keys, fmt, codec)
        yield pa.RecordBatch.from_pydict({"attempt": [attempt], "n": [n]})

    os.makedirs(folder)
    try:
        done = rows.mapInArrow(task, "attempt string, n bigint").collect()
        publish(folder, [r.attempt for r in done])
    finally:
        shutil.rmtree(f"{folder}/{_TEMPORARY}", ignore_errors=True)
    open(f"{folder}/_SUCCESS", "w").close()
    return sum(r.n for r in done)


def write_outputs(batches, folder: str, keys: list[str], fmt: str,
                  codec: str | None) -> tuple[str, int]:
    """What a task does with its batches (the keys, then the payload or the
    line): a file for each run of rows with equal keys. Returns the attempt's
    name and its rows."""
    attempt, rows, files, held, of = uuid.uuid4().hex, 0, 0, [], None
    root = f"{folder}/{_TEMPORARY}/{attempt}"
    os.makedirs(root)

    def flush() -> None:
        nonlocal files
        where = f"{root}/" + "/".join(f"{k}={_place(v)}" for k, v in zip(keys, of))
        os.makedirs(where, exist_ok=True)
        file = f"{where}/part-{attempt}-{files:06d}.{fmt}"
        files += 1
        if fmt == "csv":
            with open(file, "wb") as f:
                f.writelines(_text(part.column(0)) for part in held)
        else:
            pq.write_table(pa.Table.from_batches(held), file, compression=codec,
                           store_schema=False)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows += batch.num_rows
        names = batch.columns[:len(keys)]
        body = batch.select(range(len(keys), batch.num_columns))
        codes = [c.dictionary_encode("encode").indices.to_numpy() for c in names]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
        starts = [0, *changes.tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            output = [c[start].as_py() for c in names]
            if held and output != of:
                flush()
                held = []
            held.append(body.slice(start, end - start))
            of = output
    if held:
        flush()
    return attempt, rows


def _text(lines: pa.Array) -> memoryview:
    """The lines' bytes, which lie one after the other in the array."""
    _, offsets, data = lines.buffers()
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(lines.type) else np.int32)
    return memoryview(data)[ends[lines.offset]:ends[lines.offset + len(lines)]]


def _place(value) -> str:
    """A value as Spark spells it in the name of a directory."""
    if value is None or value == "":
        return NULL_NAME
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def publish(folder: str, attempts: list[str]) -> None:
    """Renames the outputs of attempts into place. An attempt that cannot be
    seen from here raises: then the machines do not share the folder."""
    for attempt in attempts:
        root = f"{folder}/{_TEMPORARY}/{attempt}"
        for cell in os.listdir(root):
            os.makedirs(f"{folder}/{cell}", exist_ok=True)
            for k in os.listdir(f"{root}/{cell}"):
                here, there = f"{root}/{cell}/{k}", f"{folder}/{cell}/{k}"
                try:
                    os.rename(here, there)
                except OSError as e:            # the output has files already
                    if e.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                        raise
                    for name in os.listdir(here):
                        os.rename(f"{here}/{name}", f"{there}/{name}")


# ------------------------------------------------------------------ streams

class SmallStream(DataSource):
    """The sink ``skytiles_outputs`` of a stream. Options: ``folder``,
    ``keys`` (the first columns, with commas) and ``codec``. The rows of an
    output follow each other."""

    @classmethod
    def name(cls) -> str:
        return "skytiles_outputs"

    def streamWriter(self, schema, overwrite):
        return _SmallStreamWriter(self.options)


class _SmallStreamWriter(DataSourceStreamArrowWriter):
    """Publishes a micro-batch once. Its attempts are noted in
    ``_batches/<number>.begun`` before the first rename; after the last the
    note loses its ending. A batch that runs again after a crash is dropped
    where its note has no ending; otherwise what was published of it is
    deleted first."""

    def __init__(self, options):
        self.folder, self.codec = options["folder"], options["codec"]
        self.keys = options["keys"].split(",")

    def write(self, iterator):
        message = WriterCommitMessage()
        message.attempt, _ = write_outputs(iterator, self.folder, self.keys, "parquet", self.codec)
        return message

    def commit(self, messages, batchId):
        whole = f"{self.folder}/{_BATCHES}/{batchId}"
        begun = f"{whole}.begun"
        if not os.path.exists(whole):
            attempts = [m.attempt for m in messages if m is not None]
            if os.path.exists(begun):
                with open(begun) as f:
                    _delete_files(self.folder, json.load(f))
            os.makedirs(os.path.dirname(whole), exist_ok=True)
            with open(f"{whole}.new", "w") as f:
                json.dump(attempts, f)
            os.replace(f"{whole}.new", begun)
            publish(self.folder, attempts)
            os.rename(begun, whole)
        shutil.rmtree(f"{self.folder}/{_TEMPORARY}", ignore_errors=True)

    def abort(self, messages, batchId):
        for m in messages:
            if m is not None:
                shutil.rmtree(f"{self.folder}/{_TEMPORARY}/{m.attempt}", ignore_errors=True)


def _delete_files(folder: str, attempts: list[str]) -> None:
    names = tuple(f"part-{a}-" for a in attempts)
    for at, _, files in os.walk(folder):
        if f"/{_TEMPORARY}" not in at[len(folder):]:
            for file in files:
                if names and file.startswith(names):
                    os.remove(f"{at}/{file}")


def has_batches(folder: str) -> bool:
    """True where a stream has published by :class:`SmallStream`."""
    return os.path.isdir(f"{folder}/{_BATCHES}")


def unpublished(folder: str) -> list[str]:
    """Attempts of a micro-batch whose publishing has begun and not ended."""
    found = []
    for name in os.listdir(f"{folder}/{_BATCHES}") if has_batches(folder) else []:
        if name.endswith(".begun"):
            with open(f"{folder}/{_BATCHES}/{name}") as f:
                found += json.load(f)
    return found
