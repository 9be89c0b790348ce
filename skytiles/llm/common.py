"""Helpers shared by the text operators: tables, Arrow byte views, hashing.

Texts reach Python as Arrow string columns; the helpers look at their
UTF-8 bytes in place (no per-row Python strings) and hash words with a
handful of vectorised passes. A batch is cut into slices of a few MB, so
working memory does not follow the batch size.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizing import MAX_SMALL_ROWS, is_small

SLICE_BYTES = 2 << 20     # text bytes handled at once
PIECE_BYTES = 1 << 20     # bytes hashed at once
BATCH_BYTES = "8m"        # rows sent to a Python worker at once
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, with the package made importable in the
    Python workers (needed where the driver runs from another folder)."""
    share_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def share_code(spark: SparkSession) -> None:
    """Makes the package importable in the Python workers, and bounds the
    batches that they are sent by bytes, unless the session does so itself:
    ten thousand rows of text can be very large."""
    if not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *[p for p in paths if p]])


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES):
    """Row slices of ``batch`` holding about ``max_bytes`` of the column
    each (one row at least)."""
    arr = batch.column(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(arr), 0)
                         .to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = int(np.searchsorted(ends, base + max_bytes, side="right"))
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the row offsets into them; a null
    is empty."""
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    _, offsets, data = arr.buffers()
    offs = np.frombuffer(offsets, kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def factorized(lists: list[list[str]], texts: list[str | None]) \
        -> tuple[np.ndarray, list[str], np.ndarray]:
    """Codes of all strings (parts of the texts) in order, the distinct
    strings, and the length of every list."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = list(chain.from_iterable(lists))
    if any("\0" in t for t in texts if t):    # pandas' tables end strings there
        coded = pa.array(flat, pa.string()).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), counts
    import pandas as pd         # only the workers that need it hold it in memory
    values = np.empty(len(flat), object)
    values[:] = flat
    codes, unique = pd.factorize(values)
    return codes, list(unique), counts


# ------------------------------------------------------------------ hashing

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        base = np.full(n, _P if which == "up" else _P_INV, np.uint64)
        base[0] = 1
        have = _powers[which] = np.cumprod(base)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Words of every row: maximal runs of bytes with ``table[byte] != 0``,
    where ``table`` also maps the byte (lower-casing).

    Returns ``(hashes, starts, ends, counts)``: 64-bit hash, byte span and
    the number of words per row.
    """
    mapped = table[data]
    inside = mapped != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = offsets[1:-1]
    bounds = bounds[bounds < len(data)]
    first[bounds] = inside[bounds]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = bounds[bounds > 0] - 1
    last[before] = inside[before]
    ends = np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):       # whole words, about PIECE_BYTES at a time
        to = int(np.searchsorted(ends, starts[at] + PIECE_BYTES, side="right"))
        to = max(to, at + 1)
        a, b = starts[at], ends[to - 1]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(mapped[a:b].astype(np.uint64) * _power_table("up", b - a)[:b - a],
                  out=sums[1:])
        s, e = starts[at:to] - a, ends[at:to] - a
        hashes[at:to] = (sums[e] - sums[s]) * _power_table("down", b - a)[s]
        at = to
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, starts, ends, counts


def word_table(is_word) -> np.ndarray:
    """Byte table for :func:`word_hashes`: 0 outside words, otherwise the
    byte with A-Z lower-cased (byte 0 as 255, which UTF-8 never holds)."""
    return np.array([(b + 32 if 65 <= b <= 90 else b or 255) if is_word(b) else 0
                     for b in range(256)], np.uint8)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``n`` consecutive words from each word on (``len - n + 1``
    values, also across rows: the caller masks those)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = np.full(m, n, np.uint64)
    for j in range(n):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + hashes[j:j + m]
    return mix(out)


# --------------------------------------------------- fixed-size membership

MEMBER_BITS = 1 << 25


def member_bitmap(keys: DataFrame, key: str, bits: int = MEMBER_BITS) -> DataFrame:
    """One row, one array: a bitmap of ``bits`` bits in 64-bit words with
    the hash of every key set (4 MB by default, whatever the key count)."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    words = (keys.select(slot.alias("s"))
             .groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("v")))
    set_words = words.agg(F.sort_array(F.collect_list(F.struct("w", "v"))).alias("e"))
    # Zeros between one set word and the next, and after the last.
    n = F.size("e")
    zeros = F.transform(F.sequence(F.lit(0), n), lambda i: F.array_repeat(
        F.lit(0).cast("long"),
        (F.when(i < n, F.get("e", i)["w"]).otherwise(F.lit(bits >> 6))
         - F.when(i > 0, F.get("e", i - 1)["w"]).otherwise(F.lit(-1)) - 1).cast("int")))
    filled = F.flatten(F.zip_with(
        zeros, F.transform("e", lambda x: F.array(x["v"])),
        lambda z, v: F.concat(z, F.coalesce(v, F.expr("cast(array() as array<bigint>)")))))
    return set_words.select(filled.alias("bitmap"))


def member_test(key: str, keys: DataFrame, keys_col: str, bits: int = MEMBER_BITS) -> Column:
    """True where a key may be among ``keys`` (always where it is). The
    bitmap has a fixed size, so it is safe to ship; when very many keys fill
    it, it merely filters less."""
    bitmap = member_bitmap(keys, keys_col, bits).scalar()
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    word = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1


def maybe_member(df: DataFrame, key: str, keys: DataFrame, keys_col: str,
                 bits: int = MEMBER_BITS) -> DataFrame:
    """Rows whose key may be among ``keys`` (no member is lost): a cheap
    filter before a shuffle join."""
    return df.where(member_test(key, keys, keys_col, bits))


def without_keys(df: DataFrame, on: dict, gone: DataFrame,
                 max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """The rows of ``df`` whose key (``on``: column of ``gone`` -> expression
    over ``df``, not null) is not in ``gone``; columns unchanged.

    A table of checked size is broadcast. Beyond it only rows that may
    be in it are shuffled: all others pass a bitmap test and stay put."""
    names = {c: unused_name(df, f"key_{c}") for c in on}
    keyed = df.select("*", *[e.alias(names[c]) for c, e in on.items()])
    gone = gone.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    keys = list(names.values())
    if is_small(gone, max_rows):
        left = keyed.join(F.broadcast(gone), keys, "left_anti")
    else:
        gone = gone.withColumn("slot", F.xxhash64(*keys))
        slot = unused_name(df, "slot")
        keyed = keyed.withColumn(slot, F.xxhash64(*keys))
        hit = member_test(slot, gone, "slot")
        left = keyed.where(~hit).drop(slot).union(
            keyed.where(hit).drop(slot).join(gone.select(*keys), keys, "left_anti")
            .select(*df.columns, *keys))
    return left.select(*df.columns)


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (in any case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
