"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes into tokens; a token sequence is known by
the byte offsets where its tokens end. Where both end, they are aligned,
and the tokens between two such points form a group. Two places in the end
arrays are kept, and with them the shift between the indexes:

* while the ends are equal at the current shift, the tokens are one to one.
  Exponential probing compares stretches of 1, 2, 4, ... entries of the two
  arrays at once and jumps over each equal one; an unequal stretch is halved
  until its first entry differs;
* there an irregular group starts. The side that lags is moved on until both
  end together, which ends the group and gives the new shift.

Inside an irregular group every stretch between two neighbouring ends of
either side lies in one token of each, so these stretches are the links of
the group; a one-to-one group is a link by itself.

How often a pair of ids is linked in the corpus is counted from one row per
document and pair. These counts come back to the documents by a join: the
table of counts is broadcast where its checked size allows that, and joined
by shuffle beyond it.

Defined cases: null and empty texts, and texts that either tokenizer does
not give back byte by byte (such as texts with a literal space mark), have
no tokens: zeros, and an empty groups text. Rows are judged each on their
own, so rows that repeat an id are several rows, and a null id is kept. Very long texts
are one row like any other; the walk is linear in the tokens. An empty
table gives an empty result. Columns besides id and text are ignored.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import broadcast_if_small
from ..session import write_scratch_table
from .common import factorized, share_code, text_slices

SPACE = "▁"
MAX_BROADCAST_PAIRS = 1_000_000    # counted pairs that are broadcast at most
SOME_CUTS = 64                     # cuts that B encodes at once
LANE = 512                         # tokens of A that are walked by one lane


# -------------------------------------------------------------- tokenizers

def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable
    ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """A byte-level BPE vocabulary (tokenizers JSON) whose merges are in the
    order of its ids; special tokens in a text are plain text."""

    # --- Fixed value: how this kind of vocabulary cuts a text before merging.
    PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
               r"|\s+(?!\S)|\s+")
    LONG_BLANK = re.compile(r"\s{1000}")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"]}
        letter, vocab = byte_letters(), spec["model"]["vocab"]
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))]
                 for m in spec["model"]["merges"]]
        if order != sorted(order):
            raise ValueError("only vocabularies with ids in merge order are supported")
        ranks = {bytes(letter[c] for c in t): i for t, i in vocab.items() if i not in special}
        self.table = [b""] * (max(vocab.values()) + 1)
        for token, i in ranks.items():
            self.table[i] = token
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        self._fast = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self._slow = Tokenizer.from_file(path)
        self._slow.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        text = " " + text
        if self.LONG_BLANK.search(text):     # too deep for the fast one's pattern engine
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)


class PieceTokens:
    """A sentencepiece model; byte pieces are their byte, the space mark is
    a space."""

    def __init__(self, path: str):
        import sentencepiece
        sp = self._sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                      sp.id_to_piece(i).replace(SPACE, " ").encode("utf-8")
                      for i in range(sp.get_piece_size())]
        if any(b" " in t.lstrip(b" ") for t in self.table) \
                or sp.normalize(" a  b ") != "  a  b ".replace(" ", SPACE):
            raise ValueError("only models with identity normalisation, a leading space "
                             "mark and no inner one are supported")
        self.sizes = np.array([len(t) for t in self.table], np.int64)

    def encode(self, text: str) -> list[int]:
        return self._sp.encode(text)

    def encode_cuts(self, cuts: list[str]) -> list[int]:
        """Ids of the cuts one after another (the model slows down on long
        texts)."""
        some = [" ".join(cuts[k:k + SOME_CUTS]) for k in range(0, len(cuts), SOME_CUTS)]
        return [i for ids in self._sp.encode(some, num_threads=1) for i in ids]


_loaded: dict[tuple, object] = {}


def _tokenizer(kind: type, path: str):
    """A tokenizer, loaded once per Python process."""
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


# --------------------------------------------------------------- alignment

def _equal_blocks(a, b, i, j, step, stop):
    """Per lane: do the next ``step`` ends agree, and lie before its stop?"""
    ok = (i + step <= stop) & (j + step < len(b))
    at = np.flatnonzero(ok)
    if step == 1:
        ok[at] = a[i[at]] == b[j[at]]
    else:
        near = np.arange(step)
        ok[at] = (a[i[at][:, None] + near] == b[j[at][:, None] + near]).all(axis=1)
    return ok


def irregular_groups(a: np.ndarray, b: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Rows ``first, stop`` of A and ``first, stop`` of B for every group that
    is not one to one, in order. Both arrays ascend and end alike.

    Walks many stretches (lanes) of the arrays in step. A lane starts at
    every ``lane``-th end of A that is an end of B too, with the shift found
    there by bisection."""
    if not len(a):
        return np.zeros((0, 4), np.int64)
    i = np.arange(0, len(a), lane)
    j = np.zeros(len(i), np.int64)
    j[1:] = np.searchsorted(b, a[i[1:] - 1]) + 1
    common = np.ones(len(i), bool)
    common[1:] = b[j[1:] - 1] == a[i[1:] - 1]
    i, j = i[common], j[common]
    stop = np.append(i[1:], len(a))
    pad = np.full(1, -1, a.dtype)
    a, b = np.concatenate([a, pad]), np.concatenate([b, pad - 1])
    found = []
    while len(i):
        # One-to-one stretch at the shift j - i: longer and longer probes,
        # then shorter and shorter ones.
        live, step = np.arange(len(i)), 1
        failed = np.zeros(len(i), np.int64)
        while len(live):
            ok = _equal_blocks(a, b, i[live], j[live], step, stop[live])
            i[live[ok]] += step
            j[live[ok]] += step
            failed[live[~ok]] = step
            live, step = live[ok], step * 2
        while step > 1:
            step //= 2
            live = np.flatnonzero(failed > step)
            ok = live[_equal_blocks(a, b, i[live], j[live], step, stop[live])]
            i[ok] += step
            j[ok] += step
        open_ = i < stop
        i, j, stop = i[open_], j[open_], stop[open_]
        # Irregular group: the side that lags moves on until both end.
        first_a, first_b = i.copy(), j.copy()
        live = np.arange(len(i))
        while len(live):
            x, y = a[i[live]], b[j[live]]
            i[live[x < y]] += 1
            j[live[x > y]] += 1
            live = live[x != y]
        i += 1
        j += 1
        found.append(np.stack([first_a, i, first_b, j], axis=1))
        open_ = i < stop
        i, j, stop = i[open_], j[open_], stop[open_]
    found = np.concatenate(found)
    return found[np.argsort(found[:, 0], kind="stable")]


def _inside(n: int, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Flags of the entries in any of the stretches."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, stop, -1)
    return np.cumsum(edge[:-1]) > 0


def links(a: np.ndarray, b: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token indexes of all links (pairs of overlapping tokens)."""
    odd_a, odd_b = _inside(len(a), odd[:, 0], odd[:, 1]), _inside(len(b), odd[:, 2], odd[:, 3])
    in_a, in_b = np.flatnonzero(odd_a), np.flatnonzero(odd_b)
    ends = np.sort(np.concatenate([a[in_a], b[in_b]]), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    left = in_a[np.searchsorted(a[in_a], ends)]
    right = in_b[np.searchsorted(b[in_b], ends)]
    return (np.concatenate([np.flatnonzero(~odd_a), left]),
            np.concatenate([np.flatnonzero(~odd_b), right]))


class _Digits:
    """Decimal texts of ids as byte rows."""

    def __init__(self, size: int):
        self.width = len(str(max(size - 1, 0)))
        text = [str(i).encode() for i in range(size)]
        self.length = np.array([len(t) for t in text], np.int64)
        self.rows = np.frombuffer(b"".join(t.ljust(self.width + 1) for t in text),
                                  np.uint8).reshape(size, self.width + 1)


def _groups_text(ids_a, ids_b, start_a, start_b, groups, digits) -> list[str]:
    """``a1,a2|b1;a3|b2,b3;`` of the groups of every cut."""
    group_a, group_b = np.cumsum(start_a) - 1, np.cumsum(start_b) - 1
    sizes_a, sizes_b = np.bincount(group_a), np.bincount(group_b)
    place_a = np.arange(len(ids_a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(sizes_a)[group_b]
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark = np.full(len(ids), ord(","), np.uint8)
    last = np.cumsum(sizes_a + sizes_b) - 1
    mark[last] = ord(";")
    mark[last - sizes_b] = ord("|")
    rows, length = digits.rows[ids], digits.length[ids]
    rows[np.arange(len(ids)), length] = mark
    text = rows[np.arange(rows.shape[1]) <= length[:, None]].tobytes().decode()
    ends = np.concatenate([[0], np.cumsum(length + 1)[last]])[
        np.concatenate([[0], np.cumsum(groups)])].tolist()
    return [text[s:e] for s, e in zip(ends[:-1], ends[1:])]


# Cuts are made at single spaces between visible characters. Neither
# tokenizer has a token across one: A's pattern starts a match at such a
# space, and B's pieces hold the space mark only at their start.
_VISIBLE = r"[\w!-/:-@\[-`{-~]"
_CUT = re.compile(f"(?<={_VISIBLE})(?= {_VISIBLE})")
_PLAIN = re.compile(f"{_VISIBLE}(?:.*{_VISIBLE})?", re.DOTALL)


def text_cuts(texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Cuts of all texts (each without the space before it): their codes,
    the distinct cuts, and how many cuts every text has."""
    cuts = [t.split(" ") if t else [] for t in texts]
    codes, unique, counts = factorized(cuts, texts)
    odd = np.array([_PLAIN.fullmatch(c) is None for c in unique], bool)
    if odd.any():                  # texts with other runs of white space
        rows = np.repeat(np.arange(len(texts)), counts)
        for k in np.unique(rows[odd[codes]]).tolist():
            cuts[k] = [c[1:] for c in _CUT.split(" " + texts[k])]
        codes, unique, counts = factorized(cuts, texts)
    return codes, unique, counts


def _tokens(cuts: list[str], one: ByteTokens, two: PieceTokens):
    """Ids of A and of B of the cuts one after another, and their numbers
    per cut; None where one of the tokenizers does not give the text back."""
    text = " ".join(cuts)
    whole = (" " + text).encode("utf-8")
    ids_a, ids_b = one.encode(text), two.encode_cuts(cuts)
    if b"".join(map(one.table.__getitem__, ids_a)) != whole \
            or b"".join(map(two.table.__getitem__, ids_b)) != whole:
        return None
    ends = np.cumsum([len(c.encode("utf-8")) + 1 for c in cuts])
    counts = [np.diff(np.searchsorted(np.cumsum(t.sizes[ids]), ends, side="right"), prepend=0)
              for t, ids in ((one, ids_a), (two, ids_b))]
    return ids_a, ids_b, *counts


def _aligned_cuts(cuts: list[str], one: ByteTokens, two: PieceTokens, digits: _Digits):
    """The cuts' order, and in it per cut: token counts of A and B (zero
    where a tokenizer does not give it back), groups, their text, and how
    many links; all links."""
    easy = [k for k, c in enumerate(cuts) if SPACE not in c and _PLAIN.fullmatch(c)]
    parts = _tokens([cuts[k] for k in easy], one, two) if easy else None
    if parts is None:
        easy, parts = [], ([], [], [], [])
    rest = sorted(set(range(len(cuts))) - set(easy))
    ids_a, ids_b, counts_a, counts_b = map(list, parts)
    for k in rest:
        found = _tokens([cuts[k]], one, two) or ([], [], [0], [0])
        for have, more in zip((ids_a, ids_b, counts_a, counts_b), found):
            have.extend(more)
    ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
    place = np.array([*easy, *rest], np.int64)
    # The cuts one after another: each ends at a common end.
    a, b = np.cumsum(one.sizes[ids_a]), np.cumsum(two.sizes[ids_b])
    odd = irregular_groups(a, b)
    start_a, start_b = np.ones(len(a), bool), np.ones(len(b), bool)
    start_a[_inside(len(a), odd[:, 0] + 1, odd[:, 1])] = False
    start_b[_inside(len(b), odd[:, 2] + 1, odd[:, 3])] = False
    n_a, n_b = np.array(counts_a, np.int64), np.array(counts_b, np.int64)
    cut_a = np.repeat(np.arange(len(cuts)), n_a)
    groups = np.bincount(cut_a[start_a], minlength=len(cuts))
    text = _groups_text(ids_a, ids_b, start_a, start_b, groups, digits)
    left, right = links(a, b, odd)
    order = np.argsort(left, kind="stable")
    pairs = (ids_a[left] * len(two.table) + ids_b[right])[order]
    return place, n_a, n_b, groups, text, n_a + n_b - groups, pairs


def _aligned_slice(part: pa.RecordBatch, one: ByteTokens, two: PieceTokens,
                   digits: _Digits) -> pa.RecordBatch:
    texts = part.column("text").to_pylist()
    codes, cuts, counts = text_cuts(texts)
    place, n_a, n_b, groups, text, n_links, pairs = _aligned_cuts(cuts, one, two, digits)
    codes = np.argsort(place)[codes]
    rows = np.repeat(np.arange(len(texts)), counts)
    whole = np.ones(len(texts), bool)
    whole[rows[n_a[codes] == 0]] = False        # a cut that is not given back
    used = whole[rows]
    codes, rows = codes[used], rows[used]

    def total(per_cut: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(texts), np.int64)
        np.add.at(sums, rows, per_cut[codes])
        return sums

    borders = np.searchsorted(rows, np.arange(len(texts) + 1)).tolist()
    own = codes.tolist()
    joined = ["".join(map(text.__getitem__, own[s:e]))[:-1]
              for s, e in zip(borders[:-1], borders[1:])]
    # Every link of every row, then the distinct pairs of a row.
    size = n_links[codes]
    first = (np.cumsum(n_links) - n_links)[codes]
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)
    span = len(one.table) * len(two.table)
    code, times = np.unique(np.repeat(rows, size) * span + pairs[at], return_counts=True)
    offsets = pa.array(np.searchsorted(code, np.arange(len(texts) + 1) * span).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [part.column("id"), *[pa.array(total(x)) for x in (n_a, n_b, groups, n_links)],
         pa.array(joined, pa.string()),
         pa.ListArray.from_arrays(offsets, pa.array(
             code % span // len(two.table) << 32 | code % len(two.table))),
         pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
        ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_a, n_b, n_groups, n_links``, the
    ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of A and B in order), and its
    distinct linked id pairs: ``pairs`` (A id in the upper, B id in the lower
    half) and ``times``. A narrow pass, a slice of texts in memory at once."""
    share_code(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        one, two = _tokenizer(ByteTokens, byte_path), _tokenizer(PieceTokens, piece_path)
        digits = _Digits(max(len(one.table), len(two.table)))
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield _aligned_slice(part, one, two, digits)

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             "groups string, pairs array<bigint>, times array<int>").withColumnRenamed("id", id_col)


def store_alignment(aligned: DataFrame) -> DataFrame:
    """The aligned rows written once (they are read twice from here on),
    with a number ``row`` each."""
    return write_scratch_table(aligned.withColumn("row", F.monotonically_increasing_id()),
                               "alignment-documents")


def _linked(stored: DataFrame) -> DataFrame:
    return stored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))


def pair_counts(stored: DataFrame) -> DataFrame:
    """Rows ``pair, links, best``: how many links of the corpus hold an id
    pair, and whether no pair with the same B id has more. Counted map-side
    first, so a frequent pair is one row per task."""
    counts = write_scratch_table(
        _linked(stored).groupBy("pair").agg(F.sum("times").alias("links")), "alignment-counts")
    piece = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(piece.alias("piece")).agg(F.max("links").alias("most"))
    counts = counts.withColumn("piece", piece).join(broadcast_if_small(most), "piece")
    return write_scratch_table(counts.select(
        "pair", "links", (F.col("links") == F.col("most")).alias("best")), "alignment-pairs")


def score_documents(stored: DataFrame, counts: DataFrame,
                    max_broadcast: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """The stored rows with ``n_best`` (links whose pair is the most frequent
    of its B id) and ``count_sum`` (over the links, how often the corpus
    holds their pair)."""
    sums = (_linked(stored).join(broadcast_if_small(counts, max_broadcast), "pair")
            .groupBy("row").agg(
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                F.sum(F.col("times") * F.col("links")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (stored.drop("pairs", "times").join(sums, "row", "left").drop("row")
            .withColumn("n_best", F.coalesce("n_best", zero))
            .withColumn("count_sum", F.coalesce("count_sum", zero)))
