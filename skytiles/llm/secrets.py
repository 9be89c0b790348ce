"""Secret scans: fixed patterns, and password guess cost in credential contexts.

Three base kinds are plain patterns. The method adds the kind ``guess``:
a value that a text presents as a credential (``pwd: ...``, ``passphrase
= ...``, ``user:...@host``) is cut into words, dates, repeats, keyboard
walks and brute-force stretches so that the number of guesses an attacker
needs is smallest over all segmentations (a repeat's unit has up to ``UNIT``
characters); where even that smallest number is at least
``10 ** MIN_GUESSES``, the value is reported. Placeholders such as
``password=changeme123`` cost few guesses and are left alone.

Spans are in code points, the end exclusive. A base span is the whole
match of its pattern, a ``guess`` span the value alone. All kinds are
looked for in whole texts.

Defined cases: a null or empty text has no spans; rows are independent, so
ties, repeated rows and extra columns do not matter; the span list is
ordered by start, then kind in the order of ``KINDS``; very long texts are
searched whole, and a value's cost takes time linear in its length; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share_code, string_bytes, text_slices

# --- Fixed values: kinds in their order, patterns, least lengths.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Where the method looks for values.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|auth|private)"""
    r"""[_-]?key)["']?[\x20\t]*(?:=>|[:=])[\x20\t]*["']?([^\s"'<>,;]{6,})""",
    re.IGNORECASE | re.ASCII)
USERINFO = re.compile(r"://[^\s/:@\"'<>]+:([^\s/@\"'<>]{6,})@")
MIN_GUESSES = 10.0        # log10

# Common passwords and password parts, most frequent first (a parameter).
WORDS = tuple("""password admin welcome login secret changeme letmein test default example user
guest root master hello dragon monkey football baseball shadow sunshine princess superman batman
love iloveyou trustno access abc pass token key your my the here placeholder value none null
sample demo temp private public server database mysql oracle summer winter spring autumn
january february march april june july august september october november december monday friday
google facebook company office home work system service account internet computer money happy
lucky flower cookie coffee orange purple yellow green black white silver golden diamond tiger
eagle falcon soccer hockey michael jordan daniel charlie thomas jessica ashley george matthew
andrew joshua hunter ranger buster killer pepper ginger maggie cheese starwars pokemon matrix
freedom whatever required missing unknown empty insert enter string redacted hidden
""".split())
# Keyboard rows whose neighbours make a walk.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4301!$57+", "aaeoiisstt")

_PLACE = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
# Each form of a date; the last one's final number may end after each digit.
_DATES = tuple(map(re.compile, (
    r"(?:19|20)\d\d", r"(?:19|20)\d\d[01]\d[0-3]\d", r"[0-3]\d[01]\d(?:19|20)\d\d",
    r"\d{1,4}[-/._]\d{1,2}[-/._](\d{1,4})")))
UNIT = 32                         # characters of a repeated unit
_TURN = math.log10(4.6)
_SEGMENT = math.log10(2)          # each further segment at least doubles the guesses


class _Starts:
    """Starts of segments that may end anywhere further on, where a segment
    of ``k`` units costs its start's value and log10(k). A start stays only
    while it can still be the cheapest for some end."""

    def __init__(self, least: int):
        self.least, self.open = least, []

    def add(self, at: int, value: float) -> None:
        """To be called where ``at`` reaches its ``least`` units."""
        if all(v + math.log10((at + self.least - s) / self.least) > value
               for s, v in self.open):
            # What a longer segment pays for its length only shrinks.
            self.open = [(s, v) for s, v in self.open if v < value] + [(at, value)]

    def cheapest(self, end: int) -> float:
        return min((v + math.log10(end - s) for s, v in self.open), default=math.inf)


def _steps(value: str) -> list:
    """Per place the keyboard step to the next character, or None."""
    out: list = [None] * len(value)
    for i in range(len(value) - 1):
        a, b = _PLACE.get(value[i]), _PLACE.get(value[i + 1])
        if a is not None and b is not None and a != b \
                and abs(b[0] - a[0]) <= 1 and abs(b[1] - a[1]) <= 1:
            out[i] = (b[0] - a[0], b[1] - a[1])
    return out


def _date_ends(value: str, at: int) -> set[int]:
    ends = set()
    for form in _DATES:
        found = form.match(value, at)
        if found:
            ends.update(range(found.start(1) + 1, found.end() + 1) if form.groups
                        else [found.end()])
    return ends


@lru_cache(maxsize=4096)
def guess_cost(value: str, words: tuple[str, ...] = WORDS) -> float:
    """log10 of the guesses that the cheapest of all segmentations needs."""
    rank = _ranks(words)
    longest = max(map(len, rank), default=0)
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    n = len(value)
    steps = _steps(low)
    changes = [0] * (n + 1)                # of the step's direction, up to a place
    for i in range(1, n):
        changes[i] = changes[i - 1] + (steps[i] != steps[i - 1])
    walks = _Starts(3)
    same = [0] * (UNIT + 1)                # characters that repeat those a unit before
    repeats: list[dict[int, _Starts]] = [{} for _ in range(UNIT + 1)]
    best = [0.0] + [math.inf] * n          # cheapest up to here, any last segment
    open_ = [math.inf] * (n + 1)           # ... that ends in a brute-force stretch
    start = [0.0] * (n + 1)                # ... and a further segment begun
    for at in range(n + 1):
        # Segments that end here: walks of three or more keys, and repeats.
        if at >= 2 and steps[at - 2] is None:
            walks = _Starts(3)
        elif at >= 3 and steps[at - 3] is not None:
            walks.add(at - 3, start[at - 3] + (1 - changes[at - 3]) * _TURN)
            best[at] = min(best[at], walks.cheapest(at) + changes[at - 2] * _TURN
                           + math.log10(47))
        for size in range(1, min(UNIT, at - 1) + 1):
            if value[at - 1] != value[at - 1 - size]:
                if same[size]:
                    same[size] = 0
                    repeats[size].clear()
                continue
            same[size] += 1
            least = 3 if size == 1 else 2
            if same[size] >= (least - 1) * size:
                unit = value[at - size:at]
                starts = repeats[size].setdefault(at % size, _Starts(least))
                starts.add(at // size - least, start[at - least * size]
                           + (1.0 if size == 1 else guess_cost(unit, words)))
                best[at] = min(best[at], starts.cheapest(at // size))
        if at == n:
            break
        start[at] = best[at] + (_SEGMENT if at else 0.0)
        # Segments that begin here.
        brute = min(start[at], open_[at]) + 1.0     # ten guesses a character
        open_[at + 1] = min(open_[at + 1], brute)
        best[at + 1] = min(best[at + 1], brute)
        for size in range(3, min(longest, n - at) + 1):
            for text, extra in ((low, 0.0), (plain, 1.0)):
                found = rank.get(text[at:at + size])
                if found:
                    mixed = value[at:at + size] not in (low[at:at + size],
                                                        value[at:at + size].capitalize())
                    best[at + size] = min(best[at + size], start[at] + math.log10(found)
                                          + extra + (1.0 if mixed else 0.0))
        for end in _date_ends(value, at):
            best[end] = min(best[end], start[at] + math.log10(365 * 60) + 0.6)
    return best[n]


@lru_cache(maxsize=8)
def _ranks(words: tuple[str, ...]) -> dict[str, int]:
    return {w: k for k, w in reversed(list(enumerate(words, 1)))}


def find_spans(text: str | None, min_guesses: float = MIN_GUESSES,
               words: tuple[str, ...] = WORDS) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` of one text."""
    if not text:
        return []
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= MIN_VALUE]
        values = {m.span(1) for p in (CONTEXT, USERINFO) for m in p.finditer(text)}
        found += [("guess", a, b) for a, b in values
                  if guess_cost(text[a:b], words) >= min_guesses]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if len(m.group()) >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m.group()) >= MIN_HEX]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[[*range(48, 58), *range(97, 103)]] = True


def _worth_a_look(arr: pa.Array) -> np.ndarray:
    """Rows that may hold a span: an assignment sign, the access prefix, or
    a long run of hex digits (found on the bytes of the whole slice)."""
    hit = np.zeros(len(arr), bool)
    for sign in (":", "=", "AKIA"):
        hit |= pc.fill_null(pc.match_substring(arr, sign), False).to_numpy(zero_copy_only=False)
    data, offsets = string_bytes(arr)
    other = np.concatenate([[-1], np.flatnonzero(~_HEX_BYTES[data]), [len(data)]])
    for i in np.flatnonzero(np.diff(other) > MIN_HEX).tolist():
        a, b = other[i] + 1, other[i + 1]           # a run; it may cross rows
        hit[np.searchsorted(offsets, a, side="right") - 1:
            np.searchsorted(offsets, b - 1, side="right")] = True
    return hit


def _slice_spans(arr: pa.Array, min_guesses: float, words: tuple[str, ...]) -> list[list]:
    spans: list[list] = [[] for _ in range(len(arr))]
    for i in np.flatnonzero(_worth_a_look(arr)).tolist():
        spans[i] = find_spans(arr[i].as_py(), min_guesses, words)
    return spans


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_guesses: float = MIN_GUESSES, words: tuple[str, ...] = WORDS) -> DataFrame:
    """One row per document: ``id_col`` and ``spans``, an ordered array of
    ``kind, start, end``. A narrow pass without a shuffle."""
    share_code(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = _slice_spans(part.column("text"), min_guesses, words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"),
                     pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in own]
                               for own in rows], pa.list_(span))], ["id", "spans"])

    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(
        run, f"id {kind}, spans array<struct<kind: string, start: int, end: int>>")
    return out.withColumnRenamed("id", id_col)


def mask_spans(text: str, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones together) replaced."""
    out, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None,
                 min_guesses: float = MIN_GUESSES, words: tuple[str, ...] = WORDS) -> DataFrame:
    """The documents with secrets masked in their texts, all columns kept;
    ``length_col`` gets the new length where a text changed."""
    share_code(docs.sparkSession)
    names = docs.columns

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                arr = part.column(text_col)
                rows = _slice_spans(arr, min_guesses, words)
                changed = [i for i, own in enumerate(rows) if own]
                columns = list(part.columns)
                if changed:
                    texts = arr.to_pylist()
                    for i in changed:
                        texts[i] = mask_spans(texts[i], rows[i])
                    columns[names.index(text_col)] = pa.array(texts, arr.type)
                    if length_col is not None:
                        sizes = part.column(length_col).to_pylist()
                        for i in changed:
                            sizes[i] = len(texts[i])
                        columns[names.index(length_col)] = pa.array(
                            sizes, part.column(length_col).type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
