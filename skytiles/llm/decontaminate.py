"""Benchmark decontamination by winnowing.

A text is a sequence of words (runs of ASCII digits, letters and all
non-ASCII characters, A-Z lower-cased). Of every ``span - gram + 1``
consecutive ``gram``-word hashes - exactly one span of ``span`` words -
the smallest is kept (the rightmost of equal ones). Two texts that share a
span keep the same hash of it, so joining kept hashes finds a point of
every shared span; each hit is then extended word by word to both sides
and counts where it reaches ``span`` words. An item with fewer words than
a span is one window: its whole-text hash is looked up at every word.

Documents are first filtered against a bitmap of the items' hashes. The
bitmap has a fixed size (4 MB), loses no hash, and only decides what is
worth shuffling; the join compares hashes and words exactly.

Defined cases: null and empty texts have no words and no hits; an item
without words occurs nowhere; an item id of null marks hits but is not
listed; equal items are listed under each of their ids; rows that repeat a
doc_id are judged each on its own text; very long texts are read whole, a
slice's worth of words at a time; without documents there is no row, and
without items no hit; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_scratch_table
from .common import (MEMBER_BITS, gram_hashes, share_code, string_bytes, text_slices,
                     without_keys, word_hashes, word_table)

SPAN = 10      # words of a window
GRAM = 5       # words of a fingerprint

# --- Fixed value: word bytes are 0-9, A-Z, a-z and everything non-ASCII.
WORD_BYTES = word_table(lambda b: b >= 0x80 or chr(b).isalnum())

_HIT = "h bigint, need int, at int, size int, lead int, words string"


def fingerprints(hashes: np.ndarray, counts: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Winnowing: first-word positions (over all rows, ascending) of the
    kept ``gram``-word hashes."""
    grams = gram_hashes(hashes, gram)
    width = span - gram + 1
    m = len(hashes) - span + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    least, pick = grams[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, width):
        nxt = grams[j:j + m]
        lower = nxt <= least
        np.copyto(least, nxt, where=lower)
        pick[lower] = j
    row_end = np.repeat(np.cumsum(counts), counts)[:m]
    start = np.arange(m)
    whole = start + span <= row_end
    return np.unique(start[whole] + pick[whole])


def _positions(part, table, member=None, short=(), whole_items=False, span=SPAN, gram=GRAM):
    """Per row of a slice: word count and its hits (``_HIT`` tuples)."""
    data, offsets = string_bytes(part.column("text"))
    hashes, starts, ends, counts = word_hashes(data, offsets, table)
    row_end = np.cumsum(counts)
    row_of = np.repeat(np.arange(len(counts)), counts)
    hits: list[list[tuple]] = [[] for _ in counts]
    mapped = table[data]

    def words(a: int, b: int) -> str:
        return b" ".join(mapped[starts[i]:ends[i]].tobytes() for i in range(a, b)).decode()

    def add(at: np.ndarray, size: int, need: int, h: np.ndarray) -> None:
        if member is not None:
            keep = member(h)
            at, h = at[keep], h[keep]
        side = need - size
        for i, value in zip(at.tolist(), h.view(np.int64).tolist()):
            row = int(row_of[i])
            first, last = int(row_end[row] - counts[row]), int(row_end[row])
            a, b = max(first, i - side), min(last, i + size + side)
            hits[row].append((value, need, i - first, size, i - a, words(a, b)))

    at = fingerprints(hashes, counts, span, gram)
    add(at, gram, span, gram_hashes(hashes, gram)[at] if len(at) else np.zeros(0, np.uint64))
    for n in short:
        h = gram_hashes(hashes, n)
        at = np.arange(len(h))
        at = at[at + n <= row_end[row_of[at]]]
        if whole_items:
            at = at[counts[row_of[at]] == n]
        add(at, n, n, h[at])
    return counts, hits


def item_fingerprints(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Rows ``item_id, h, need, at, size, lead, words``: the kept hashes of
    every item, with the words around them."""
    share_code(benchmark.sparkSession)
    narrow = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                _, hits = _positions(part, WORD_BYTES, None, range(1, span), True, span, gram)
                ids = part.column("item_id")
                rows = [(i, *hit) for i, own in enumerate(hits) for hit in own]
                columns = list(zip(*rows)) if rows else [[] for _ in range(7)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0], pa.int64())),
                     *[pa.array(c, t) for c, t in zip(columns[1:], (
                         pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(),
                         pa.string()))]],
                    ["item_id", "h", "need", "at", "size", "lead", "words"])

    kind = narrow.schema["item_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"item_id {kind}, {_HIT}").distinct()


def _hash_bitmap(items: DataFrame, bits: int = MEMBER_BITS) -> np.ndarray:
    """Bitmap of the items' hashes; at most ``bits / 64`` rows reach the
    driver, whatever the number of items."""
    slot = F.pmod("h", F.lit(bits))
    words = (items.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("v"))
             .toArrow())
    bitmap = np.zeros(bits >> 6, np.uint64)
    bitmap[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return bitmap


def candidate_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document row: ``row``, ``doc_id``, ``t1, t2`` (hashes of
    the text), ``n_words`` and the ``hits`` that may be shared."""
    spark = docs.sparkSession
    share_code(spark)
    bitmap = spark.sparkContext.broadcast(_hash_bitmap(items))
    short = sorted(r["need"] for r in items.where(F.col("need") < span)
                   .select("need").distinct().collect())     # fewer than ``span`` values
    bits = np.uint64(MEMBER_BITS - 1)

    def member(h: np.ndarray) -> np.ndarray:
        slot = h & bits
        return (bitmap.value[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t1"),
                         F.xxhash64(F.lit(1), F.coalesce(F.col(text_col), F.lit(""))).alias("t2"))
    hit_type = pa.struct([("h", pa.int64()), ("need", pa.int32()), ("at", pa.int32()),
                          ("size", pa.int32()), ("lead", pa.int32()), ("words", pa.string())])
    names = [hit_type.field(i).name for i in range(hit_type.num_fields)]

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                counts, hits = _positions(part, WORD_BYTES, member, short, False, span, gram)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("t1"), part.column("t2"),
                     pa.array(counts, pa.int64()),
                     pa.array([[dict(zip(names, h)) for h in own] for own in hits],
                              pa.list_(hit_type))],
                    ["doc_id", "t1", "t2", "n_words", "hits"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    found = narrow.mapInArrow(
        run, f"doc_id {kind}, t1 bigint, t2 bigint, n_words bigint, "
             "hits array<struct<h: bigint, need: int, at: int, size: int, lead: int, "
             "words: string>>")
    return write_scratch_table(
        found.withColumn("row", F.monotonically_increasing_id()), "winnow-candidates")


def _run_length(a: Column, b: Column, steps: int) -> Column:
    """How many leading entries of two arrays agree, up to ``steps``."""
    out = F.lit(steps)
    for k in reversed(range(steps)):
        out = F.when(F.get(a, F.lit(k)) == F.get(b, F.lit(k)), out).otherwise(k)
    return out


def _sides(prefix: str) -> tuple[Column, Column, Column]:
    words = F.split(f"{prefix}words", " ")
    lead, size = F.col(f"{prefix}lead"), F.col(f"{prefix}size")
    left = F.reverse(F.slice(words, F.lit(1), lead))
    middle = F.slice(words, lead + 1, size)
    right = F.slice(words, lead + size + 1, F.greatest(F.size(words) - lead - size, F.lit(0)))
    return left, middle, right


def shared_spans(candidates: DataFrame, items: DataFrame, span: int = SPAN,
                 gram: int = GRAM) -> DataFrame:
    """Rows ``row, item_id, start, stop``: stretches of document words that
    an item shares, each as long as a window at least."""
    hits = candidates.select("row", F.explode("hits").alias("hit")).select(
        "row", *[F.col(f"hit.{c}").alias(f"d_{c}")
                 for c in ("h", "need", "at", "size", "lead", "words")])
    own = items.select("item_id", *[F.col(c).alias(f"i_{c}")
                                    for c in ("h", "need", "size", "lead", "words")]).distinct()
    pairs = hits.join(own, (F.col("d_h") == F.col("i_h")) & (F.col("d_need") == F.col("i_need")))
    dl, dm, dr = _sides("d_")
    il, im, ir = _sides("i_")
    side = span - gram
    long = F.col("d_need") == span
    met = (pairs.where(dm == im)
           .withColumn("left", F.when(long, _run_length(dl, il, side)).otherwise(0))
           .withColumn("right", F.when(long, _run_length(dr, ir, side)).otherwise(0))
           .where(F.col("left") + F.col("right") + F.col("d_size") >= F.col("d_need")))
    return met.select("row", "item_id", (F.col("d_at") - F.col("left")).alias("start"),
                      (F.col("d_at") + F.col("d_size") + F.col("right")).alias("stop"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, t1, t2, n_words, n_hit,
    item_ids`` (sorted strings). Hit words are counted once each, however
    many windows cover them."""
    items = write_scratch_table(item_fingerprints(benchmark, item_col, item_text_col),
                                "winnow-items")
    found = candidate_hits(docs, items, id_col, text_col)
    spans = write_scratch_table(shared_spans(found, items), "winnow-spans")
    covered = (spans.select("row", "start", "stop").distinct()
               .select("row", F.explode(F.sequence("start", F.col("stop") - 1)).alias("p"))
               .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    listed = (spans.groupBy("row")
              .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string")))
                   .alias("item_ids")))
    none = F.expr("cast(array() as array<string>)")
    return (found.drop("hits").join(covered.join(listed, "row"), "row", "left")
            .select("doc_id", "t1", "t2", "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("item_ids", none).alias("item_ids")))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Rows ``t1, t2``: hashes of the texts that hold a window of any item.
    Equal windows of several items are joined once."""
    items = write_scratch_table(item_fingerprints(benchmark), "winnow-items")
    found = candidate_hits(docs, items, id_col, text_col)
    any_item = items.withColumn("item_id", F.lit(0)).distinct()
    rows = shared_spans(found.where(F.size("hits") > 0), any_item).select("row").distinct()
    return write_scratch_table(found.select("row", "t1", "t2").join(rows, "row", "left_semi")
                               .select("t1", "t2").distinct(), "winnow-texts")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The documents without any hit word, columns unchanged. The decision
    depends on the text alone, so it is taken back by text hash; clean
    documents are not shuffled."""
    hit = contaminated_texts(docs, benchmark, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return without_keys(docs, {"t1": F.xxhash64(text), "t2": F.xxhash64(F.lit(1), text)}, hit)
