"""SentencePiece encoding and decoding with a prefix table.

For a merge-type (BPE) model every prefix of a text has exactly one last
token, and a token sequence is the encoding of its text exactly when each
neighbouring pair is: two tokens are *compatible* when encoding their
concatenation gives the two back. So the last token of a prefix is the
one token among those ending there (found by an automaton over the
pieces, longest first) that is compatible with the last token of the
prefix before it. The table of last tokens is filled left to right, and
the ids are read backwards from the end.

Pieces hold the space mark only at their start, so a text is cut at runs
of it (and at characters that occur in no longer piece) without changing
the result; equal cuts of a slice are encoded once, all of them together,
one character position per step.

Defined cases: a null text is an empty one (begin and end id only); an
unknown character becomes its byte pieces, or the unknown id where the
model has none; rows are independent, so ties, repeated rows and extra
columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import factorized, share_code, text_slices

SPACE = "▁"
PAIR_SLOTS = 1 << 20       # remembered pair tests
STEP_CHARS = 256           # longer cuts are walked one by one


class PrefixTable:
    """Encoder for one model file."""

    def __init__(self, model_path: str):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for probe in ("", " a  b ", "Ａ ﬁ x\n\tÉ"):
            want = (SPACE + probe.replace(" ", SPACE)) if probe else ""
            if sp.normalize(probe) != want:
                raise ValueError("only models with identity normalisation and a "
                                 "leading space mark are supported")
        n = sp.get_piece_size()
        special = [i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)
                   or sp.is_byte(i) or sp.is_unused(i)]
        skip = set(special)
        self.symbols = [None if i in skip else sp.id_to_piece(i) for i in range(n)]
        self.score = {p: sp.get_score(i) for i, p in enumerate(self.symbols) if p is not None}
        self.ids = {p: i for i, p in enumerate(self.symbols) if p is not None}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("pieces with an inner space mark are not supported")
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = sp.is_byte(self.byte_ids[0])
        self.unk = sp.unk_id()
        self.bos, self.eos, self.size = sp.bos_id(), sp.eos_id(), n
        self._automaton()
        self.steps: dict[int, tuple] = {}
        self.pair_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_ok = np.zeros(PAIR_SLOTS, bool)

    # ---------------------------------------------------------- automaton

    def _automaton(self) -> None:
        """Trie of all pieces with more than one character, and of the
        characters in them, completed to a transition table."""
        long = [p for p in self.score if len(p) > 1]
        chars = sorted({c for p in long for c in p})
        for c in chars:                      # a character that is no piece itself
            if c not in self.ids:
                self.ids[c] = len(self.symbols)
                self.symbols.append(c)
        self.classes = np.zeros(0x110000, np.uint16)
        for k, c in enumerate(chars):
            self.classes[ord(c)] = k + 1
        inner = "".join(re.escape(c) for c in chars if c != SPACE)
        inside = f"[{inner}]" if inner else r"(?!)"
        outside = f"[^{inner}{SPACE}]"
        self.cuts = re.compile(f"{SPACE}+{inside}*|{inside}+|{outside}+")
        children: list[dict[int, int]] = [{}]
        depth, parent_of, symbol_at = [0], [(0, 0)], [-1]
        for p in chars + long:
            node = 0
            for c in p:
                k = int(self.classes[ord(c)])
                nxt = children[node].get(k)
                if nxt is None:
                    nxt = children[node][k] = len(children)
                    children.append({})
                    depth.append(depth[node] + 1)
                    parent_of.append((node, k))
                    symbol_at.append(-1)
                node = nxt
            symbol_at[node] = self.ids[p]
        count, width = len(children), len(chars) + 1
        goto = np.zeros((count, width), np.int32)
        fail = np.zeros(count, np.int32)
        longest = np.array(symbol_at, np.int32)
        shorter = np.full(len(self.symbols), -1, np.int32)
        for node in sorted(range(count), key=depth.__getitem__):
            if node:
                up, k = parent_of[node]
                # The parent's row was completed without its own children.
                fail[node] = goto[fail[up], k] if up else 0
                goto[node] = goto[fail[node]]
                if symbol_at[node] >= 0:
                    shorter[symbol_at[node]] = longest[fail[node]]
                else:
                    longest[node] = longest[fail[node]]
            for k, child in children[node].items():
                goto[node, k] = child
        self.goto, self.longest, self.shorter = goto, longest, shorter
        self.length = np.array([len(p) if p else 0 for p in self.symbols], np.int32)

    # ------------------------------------------------- pair compatibility

    def _merge_steps(self, symbol: int) -> tuple:
        """How a piece is built alone: scores of its merges in order, and
        its first and last part before each and at the end. The scores are
        None when merging does not give the piece back."""
        have = self.steps.get(symbol)
        if have is None:
            parts, scores = list(self.symbols[symbol]), []
            firsts, lasts = [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    s = self.score.get(parts[i] + parts[i + 1])
                    if s is not None and (best is None or s > best):
                        best, at = s, i
                if best is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                scores.append(best)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            have = self.steps[symbol] = (scores if len(parts) == 1 else None, firsts, lasts)
        return have

    def _compatible(self, left: int, right: int) -> bool:
        """Do the two pieces stay apart when encoded together? Both are
        built in their own order, the better merge first; at no point may
        a merge across the border come first. Of equal scores the leftmost
        merge is first."""
        right_scores, firsts, _ = self._merge_steps(right)
        if right_scores is None:
            return False
        if left < 0:
            return True
        left_scores, _, lasts = self._merge_steps(left)
        i = j = 0
        while True:
            a = left_scores[i] if i < len(left_scores) else None
            b = right_scores[j] if j < len(right_scores) else None
            cross = self.score.get(lasts[i] + firsts[j])
            if cross is not None and not (a is not None and a >= cross) \
                    and not (b is not None and b > cross):
                return False
            if a is None and b is None:
                return True
            if b is None or (a is not None and a >= b):
                i += 1
            else:
                j += 1

    def _compatible_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = (left.astype(np.int64) + 1) << 32 | right.astype(np.int64)
        slot = ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                >> np.uint64(44)).astype(np.int64)
        ok = self.pair_ok[slot]
        missing = np.flatnonzero(self.pair_key[slot] != code)
        if len(missing):
            new, inverse = np.unique(code[missing], return_inverse=True)
            found = np.array([self._compatible((c >> 32) - 1, c & 0xFFFFFFFF)
                              for c in new.tolist()], bool)
            ok[missing] = found[inverse]
            self.pair_key[slot[missing]] = code[missing]
            self.pair_ok[slot[missing]] = ok[missing]
        return ok

    # ----------------------------------------------------------- encoding

    def _fallback(self, ch: str) -> list[int]:
        known = self.ids.get(ch)
        if known is not None and known < self.size:
            return [known]
        if self.has_bytes:
            return [self.byte_ids[b] for b in ch.encode("utf-8")]
        return [self.unk]

    def _one(self, word: str) -> list[int]:
        """The prefix table of one long cut."""
        last, state = [-1], 0
        for end, k in enumerate(self.classes[[ord(c) for c in word]].tolist(), 1):
            state = int(self.goto[state, k])
            token = int(self.longest[state])
            while not self._compatible_pairs(np.array([last[end - int(self.length[token])]]),
                                             np.array([token]))[0]:
                token = int(self.shorter[token])
            last.append(token)
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= int(self.length[last[at]])
        return ids[::-1]

    def encode_cuts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many cuts: all ids in order, and how many per cut."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        start = np.cumsum(size) - size
        kind = self.classes[points]
        plain = kind[start] > 0 if len(words) else np.zeros(0, bool)
        several: dict[int, list[int]] = {}
        for i in np.flatnonzero(~plain).tolist():
            several[i] = [t for c in words[i] for t in self._fallback(c)]
        for i in np.flatnonzero(plain & (size > STEP_CHARS)).tolist():
            several[i] = self._one(words[i])
        rows = np.flatnonzero(plain & (size <= STEP_CHARS))
        rows = rows[np.argsort(-size[rows], kind="stable")]
        counts = np.zeros(len(words), np.int64)
        tails = []                              # tokens from the end, per step
        if len(rows):
            length, begin = size[rows], start[rows]
            last = np.full((len(rows), int(length[0]) + 1), -1, np.int32)
            state = np.zeros(len(rows), np.int32)
            for j in range(int(length[0])):
                active = int(np.searchsorted(-length, -j, side="left"))
                state = self.goto[state[:active], kind[begin[:active] + j]]
                todo = np.arange(active)
                token = self.longest[state]
                while len(todo):
                    before = last[todo, j + 1 - self.length[token]]
                    ok = self._compatible_pairs(before, token)
                    last[todo[ok], j + 1] = token[ok]
                    todo, token = todo[~ok], self.shorter[token[~ok]]
            at, live = length.copy(), np.arange(len(rows))
            while len(live):
                token = last[live, at[live]]
                tails.append((rows[live], token))
                at[live] -= self.length[token]
                counts[rows[live]] += 1
                live = live[at[live] > 0]
            odd = {int(r) for w, t in tails for r in w[t >= self.size]}
            for r in odd:                       # a part that is no piece itself
                several[r] = self._one(words[r])
        for i, ids in several.items():
            several[i] = [t for s in ids for t in (
                [s] if s < self.size else self._fallback(self.symbols[s]))]
            counts[i] = len(several[i])
        ends = np.cumsum(counts)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for step, (row, token) in enumerate(tails):
            if several:
                keep = np.array([r not in several for r in row.tolist()], bool)
                row, token = row[keep], token[keep]
            ids[ends[row] - 1 - step] = token
        for i, own in several.items():
            ids[ends[i] - counts[i]:ends[i]] = own
        return ids, counts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text, with begin and end id."""
        cuts = [self.cuts.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        codes, words, per_text = factorized(cuts, texts)
        ids, counts = self.encode_cuts(words)
        first = np.cumsum(counts) - counts
        lengths = counts[codes]
        ends = np.cumsum(lengths)
        all_ids = ids[np.repeat(first[codes] - (ends - lengths), lengths)
                      + np.arange(int(ends[-1]) if len(ends) else 0)]
        borders = np.concatenate([[0], np.cumsum(per_text)])
        token_ends = np.concatenate([[0], ends])
        out = []
        for a, b in zip(token_ends[borders[:-1]].tolist(), token_ends[borders[1:]].tolist()):
            own = np.empty(b - a + 2, "<u4")
            own[0], own[-1] = self.bos, self.eos
            own[1:-1] = all_ids[a:b]
            out.append(own)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The model's own text of an id sequence (begin and end id leave
        no trace)."""
        return self.sp.decode(ids.tolist())


_tables: dict[str, PrefixTable] = {}


def prefix_table(model_path: str) -> PrefixTable:
    """The table of a model, built once per Python process."""
    if model_path not in _tables:
        _tables[model_path] = PrefixTable(model_path)
    return _tables[model_path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``ids`` (binary: the ids as
    little-endian unsigned 32-bit integers) and ``decoded`` (their text).
    A narrow pass: no shuffle, a slice of texts in memory at a time."""
    share_code(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        table = prefix_table(model_path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids = table.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"),
                     pa.array([x.tobytes() for x in ids], pa.binary()),
                     pa.array([table.decode(x) for x in ids], pa.string())],
                    ["id", "ids", "decoded"])

    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"id {kind}, ids binary, decoded string")
    return out.withColumnRenamed("id", id_col)


def ids_array(ids: bytes) -> np.ndarray:
    """The ids of one row as numbers."""
    return np.frombuffer(ids, "<u4")
