"""Best-fit packing of documents into fixed-length token sequences.

A document's tokens, closed by an end id, are one piece; only a document
longer than a sequence is cut, into full pieces and a rest. Pieces are
packed by best fit decreasing: from the longest to the shortest, each goes
to the open sequence that it leaves the least room in. A segment tree over
the remaining capacities finds that sequence: leaf ``c`` holds how many open
sequences have room for exactly ``c`` tokens, inner nodes hold sums, and one
descent finds the smallest capacity of at least the piece's length, so a
piece costs logarithmic time in the sequence length, however many
sequences are open.

Pieces are dealt to shards of about ``SHARD`` pieces by a hash of their
row, so that rows with equal ids or texts spread out, and each shard is
packed by one task. Every shard then has a few sequences left that are not
full: those emptier than ``FULL`` are opened again and their pieces packed
together, as long as they need fewer shards than before. Full pieces are a
sequence by themselves and never move.

Tokens are read once and stored with the pieces; what is shuffled is a
row number, a piece number and a length.

Defined cases: a null or empty text is its end id alone; rows that repeat
an id or a text are pieces each; a null id is kept; very long texts are cut
as said; columns besides id and text are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_scratch_table
from .alignment import byte_letters
from .common import factorized, share_code, text_slices

LENGTH = 4096        # tokens of a sequence
END_ID = 1           # closes every document
SHARD = 50_000       # pieces packed by one task
FULL = 0.98          # sequences filled less are opened again
SLICE = 4 << 20      # text bytes handled at once
MARK = "\x01"        # stands behind every word for the fast encoder


# --------------------------------------------------------------- tokenizer

class WordTokens:
    """A lower-casing BPE vocabulary with word ends (tokenizers JSON).

    Words never share a token, so texts are cut at blanks and every distinct
    cut is encoded once. Cuts of plain Latin letters, digits and ASCII signs
    take a fast way to the same ids: every word gets a mark behind it, and a
    byte-level encoder with the vocabulary's own merges, the mark in the place
    of the word end, does the rest. All other cuts go to the tokenizer."""

    # --- Fixed values: how this kind of vocabulary cuts a lower-cased text.
    LETTER = "A-Za-zÀ-ÖØ-öø-įı-ſ"
    WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\\s0-9{LETTER}]+|\n")
    ODD = f"[^\\t\\r\\n -~{LETTER}]"
    WORD_END = "</w>"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self._slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._odd = re.compile("|".join([self.ODD, *[
            re.escape(t["content"]) for t in spec["added_tokens"]]]))
        vocab, letter = spec["model"]["vocab"], byte_letters()
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))]
                 for m in spec["model"]["merges"]]
        if order != sorted(order) or spec["model"]["end_of_word_suffix"] != self.WORD_END:
            raise ValueError("only vocabularies with word ends and ids in merge order "
                             "are supported")
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {}
        for token, i in vocab.items():
            if i not in special:
                body = token.removesuffix(self.WORD_END)
                ranks[bytes(letter[c] for c in body)
                      + (MARK.encode() if body != token else b"")] = i
        self._fast = tiktoken.Encoding("words", pat_str=f"[^{MARK}]*{MARK}",
                                       mergeable_ranks=ranks, special_tokens={})
        self._break = ranks[f"\n{MARK}".encode()]

    def encode_cuts(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the cuts (none with a line break) one after another, and
        their number per cut."""
        text = "\n".join(cuts)
        ends = np.cumsum(np.fromiter(map(len, cuts), np.int64, len(cuts)) + 1)
        odd = np.array([m.start() for m in self._odd.finditer(text)], np.int64)
        rest = np.unique(np.searchsorted(ends, odd, side="right"))
        plain = np.ones(len(cuts), bool)
        plain[rest] = False
        counts = np.zeros(len(cuts), np.int64)
        ids = np.zeros(0, np.int64)
        if plain.any():
            if len(rest):
                text = "\n".join(c for c, ok in zip(cuts, plain.tolist()) if ok)
            words = self.WORD.findall(text.lower() + "\n")
            ids = self._fast.encode_to_numpy(MARK.join(words) + MARK,
                                             disallowed_special=()).astype(np.int64)
            breaks = np.flatnonzero(ids == self._break)
            counts[plain] = np.diff(breaks, prepend=-1) - 1
            ids = np.delete(ids, breaks)
        if len(rest):
            found = [e.ids for e in self._slow.encode_batch([cuts[k] for k in rest.tolist()],
                                                            add_special_tokens=False)]
            counts[rest] = [len(x) for x in found]
            # Into the order of the cuts.
            whole = np.empty(int(counts.sum()), np.int64)
            mine = np.repeat(plain, counts)
            whole[mine], whole[~mine] = ids, [i for x in found for i in x]
            ids = whole
        return ids, counts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cuts = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        codes, unique, per_text = factorized(cuts, texts)
        ids, counts = self.encode_cuts(unique)
        first = np.cumsum(counts) - counts
        lengths = counts[codes]
        ends = np.cumsum(lengths)
        flat = ids[np.repeat(first[codes] - (ends - lengths), lengths)
                   + np.arange(int(ends[-1]) if len(ends) else 0)]
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])].tolist()
        return [flat[a:b] for a, b in zip(borders[:-1], borders[1:])]


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """A vocabulary, loaded once per Python process."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def cut_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", length: int = LENGTH, end_id: int = END_ID,
                  with_ids: bool = True) -> DataFrame:
    """Stored rows ``row, id, piece, start, length, crc, ids``: the pieces of
    every document row (``row`` numbers them), with the CRC-32 of their ids
    as little-endian unsigned 32-bit integers, and those bytes themselves
    unless ``with_ids`` is false."""
    share_code(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        tokens = word_tokens(tokenizer_path)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                of, piece, sizes, crcs, data = [], [], [], [], []
                for k, ids in enumerate(tokens.encode(part.column("text").to_pylist())):
                    whole = np.append(ids, end_id).astype("<u4").tobytes()
                    for p in range(0, len(whole), 4 * length):
                        own = whole[p:p + 4 * length]
                        of.append(k)
                        piece.append(p // (4 * length))
                        sizes.append(len(own) // 4)
                        crcs.append(zlib.crc32(own))
                        data.append(own if with_ids else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(of, pa.int64())),
                     pa.array(of, pa.int64()), pa.array(piece, pa.int32()),
                     pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()),
                     pa.array(data, pa.binary())],
                    ["id", "of", "piece", "length", "crc", "ids"])

    kind = narrow.schema["id"].dataType.simpleString()
    pieces = narrow.mapInArrow(run, f"id {kind}, of bigint, piece int, length bigint, "
                                    "crc bigint, ids binary").drop("of")
    pieces = pieces.withColumn("start", F.col("piece").cast("long") * length) \
        .withColumn("row", F.monotonically_increasing_id())
    return write_scratch_table(pieces if with_ids else pieces.drop("ids"), "packing-pieces")


# ----------------------------------------------------------------- packing

class OpenSequences:
    """Open sequences by remaining capacity: a segment tree of counts over
    the capacities, and the sequences of each capacity."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.waiting: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, sequence: int, capacity: int) -> None:
        self.waiting[capacity].append(sequence)
        node = self.leaves + capacity
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The sequence with the least room for ``size`` tokens, and its
        room; it is no longer open. None when none has room."""
        tree, node = self.tree, self.leaves + size
        while not tree[node]:                # nearest filled subtree to the right
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
            if not node & (node - 1):        # beyond the last leaf
                return None
        while node < self.leaves:
            node *= 2
            if not tree[node]:
                node += 1
        capacity = node - self.leaves
        while node:
            tree[node] -= 1
            node >>= 1
        return self.waiting[capacity].pop(), capacity


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit decreasing: the sequence and offset of every piece."""
    bins = OpenSequences(length)
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used = 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = bins.take(size) if size < length else None
        if found is None:
            found = (used, length)
            used += 1
        sequence[k], offset[k] = found[0], length - found[1]
        if found[1] > size:
            bins.add(found[0], found[1] - size)
    return sequence, offset


def _pack(pieces: DataFrame, shards: int, length: int, salt: int) -> DataFrame:
    """Rows ``row, length, shard, sequence, offset, filled``: each of the
    shards packed by one task."""
    share_code(pieces.sparkSession)
    dealt = pieces.select("row", "length", F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(shards))
                          .cast("int").alias("shard"))

    def run(key, group):
        order = np.argsort(group.column("row").to_numpy())      # whatever order rows came in
        group = group.take(pa.array(order))
        sizes = group.column("length").to_numpy()
        sequence, offset = best_fit(sizes, length)
        filled = np.bincount(sequence, weights=sizes).astype(np.int64)[sequence]
        for name, values in (("sequence", sequence), ("offset", offset), ("filled", filled)):
            group = group.append_column(name, pa.array(values))
        return group.select(["row", "length", "shard", "sequence", "offset", "filled"])

    return dealt.groupBy("shard").applyInArrow(
        run, "row bigint, length bigint, shard int, sequence bigint, offset bigint, "
             "filled bigint")


def place_pieces(pieces: DataFrame, length: int = LENGTH, shard: int = SHARD,
                 full: float = FULL) -> DataFrame:
    """Rows ``row, sequence_id, offset`` for the rows ``row, length`` of a
    stored table: every piece's sequence and place in it."""
    zero = F.lit(0).cast("long")
    placed = pieces.where(F.col("length") >= length).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), zero.alias("offset"))
    open_ = pieces.where(F.col("length") < length)
    shards, round_ = -(-open_.count() // shard), 0
    while shards:
        round_ += 1
        packed = write_scratch_table(_pack(open_, shards, length, round_), "packing-round")
        open_ = packed.where(F.col("filled") < full * length)
        fewer = -(-open_.count() // shard) if shards > 1 else 0
        if fewer >= shards:
            fewer = 0
        closed = packed.where(F.col("filled") >= full * length) if fewer else packed
        number = F.lit(round_ << 56) + F.col("shard") * F.lit(1 << 32) + F.col("sequence")
        placed = placed.union(closed.select("row", number.alias("sequence_id"), "offset"))
        shards = fewer
    return placed


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", length: int = LENGTH, end_id: int = END_ID,
                   with_ids: bool = True, shard: int = SHARD) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, crc, sequence_id,
    offset`` and, unless ``with_ids`` is false, ``ids``."""
    pieces = cut_documents(docs, tokenizer_path, id_col, text_col, length, end_id, with_ids)
    placed = place_pieces(pieces, length, shard)
    return pieces.join(placed, "row").drop("row").withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows ``sequence_id, n_pieces, ids``: the packed sequences themselves,
    each of bounded length, from the pieces with their ids."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(own.alias("p")).select(
        "sequence_id", F.size("p").alias("n_pieces"),
        F.expr("aggregate(p, X'', (all, x) -> concat(all, x.ids))").alias("ids"))
