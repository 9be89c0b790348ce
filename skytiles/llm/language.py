"""Language ID: averaged hashed subword embeddings with a linear softmax.

The subwords of a text are its 2-, 3- and 4-byte grams (ASCII letters
lower-cased, other ASCII characters as one separator), hashed to
``BUCKETS`` embeddings. A text is the average of its grams' embeddings; a
linear layer and softmax give the language. Both are trained by stochastic
gradient descent in numpy on a sample of at most about ``PER_LANGUAGE``
labelled texts of each language and ``SAMPLE`` of all (whole texts, drawn by
hash from all labelled rows; the bounds are parameters). Every label is
learned, by one task; a language adds 16 weights and the grams its texts
hold to the model. A part of the sample calibrates the model: a temperature for the probabilities, and the probability below
which a prediction is rejected.

A softmax is sure of texts of no learned language too, so a prediction is
also rejected where the text is not like that language: where the mean log
frequency of its grams there, less the language's usual value, is below
what nearly all sample texts reach (each against counts without itself),
and further towards what texts reach in languages not their own.

Predictions read the text alone. As the model is linear, the numbers of a
gram's embedding are summed per text and meet the output layer once, or,
with few languages, a gram's embedding times the output layer is one row of
a small table; the work per gram does not grow with the languages.

Defined cases: a null text, or one without a letter (any Unicode letter),
is ``und`` with score 0 and is rejected; one without a gram is rejected; so
is every text when no labelled row exists. Of equally likely languages the
first by name is taken. Very long texts are read whole, in time linear in
their bytes. An empty table gives an empty result. Rows without a label are predicted but not learned from.
Repeated rows are each predicted; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import broadcast_if_small
from ..session import write_scratch_table
from .common import share_code, string_bytes, text_slices

UNKNOWN = "und"
GRAMS = (2, 3, 4)
BUCKETS = 1 << 15
SLICE = 1 << 20           # text bytes handled at once
WIDTH = 16                # numbers in an embedding
PER_LANGUAGE = 400        # labelled texts learned from, per language
SAMPLE = 100_000          # labelled texts learned from, of all languages
CALIBRATION = 4000        # texts that set temperature and thresholds
EPOCHS = 8
RATE = 0.6
MAX_REJECT = 0.002        # share of the calibration texts that may be rejected, either way
PRIOR = 0.5               # added to each gram's count in its frequency

# ASCII letters lower-cased, other ASCII one separator, the rest unchanged.
_FOLD = np.array([b | 32 if 65 <= b <= 90 or 97 <= b <= 122 else 32 if b < 128 else b
                  for b in range(256)], np.uint8)
_IS_LETTER = np.array([65 <= (b & ~32) <= 90 and b < 128 for b in range(256)])


def gram_buckets(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the ``n``-byte gram from each byte on; ``BUCKETS`` where it
    would leave its row."""
    out = np.full(len(data), BUCKETS, np.int32)
    m = len(data) - n + 1
    if m <= 0:
        return out
    x = np.full(m, n, np.uint32)
    for j in range(n):
        x = x * np.uint32(0x01000193) ^ data[j:j + m]
    out[:m] = (x * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)
    ends = offsets[1:]
    for j in range(1, n):
        beyond = ends - j
        out[beyond[beyond >= offsets[:-1]]] = BUCKETS
    return out


def _slice_bytes(part: pa.RecordBatch, column: str):
    raw, offsets = string_bytes(part.column(column))
    return raw, _FOLD[raw], offsets


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(offsets) - 1, np.float64)
    some = offsets[1:] > offsets[:-1]
    if some.any():
        sums[some] = np.add.reduceat(values, offsets[:-1][some])
    return sums


def _stretches(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some rows, and the rows' offsets in them."""
    size = offsets[rows + 1] - offsets[rows]
    ends = np.concatenate([[0], np.cumsum(size)])
    return np.arange(int(ends[-1])) + np.repeat(offsets[rows] - ends[:-1], size), ends


@dataclass
class LanguageModel:
    languages: list[str]
    embed: np.ndarray          # number x gram bucket; the last column is zero
    out: np.ndarray            # number x language
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    # Per language, less the usual mean: log frequency of grams not met, the
    # grams met, and theirs.
    usual: list[tuple[float, np.ndarray, np.ndarray]] = field(default_factory=list)
    least: float = -np.inf            # likeness below which a text is rejected

    def __post_init__(self):
        self.table = ((self.out.T @ self.embed).astype(np.float32)
                      if len(self.languages) <= WIDTH else None)

    def _judge(self, folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, and likeness to the likeliest language."""
        size = np.diff(offsets)
        grams = sum(np.maximum(size - n + 1, 0) for n in GRAMS)
        buckets = [gram_buckets(folded, offsets, n) for n in GRAMS]
        # One column a language, or one a number of the embedding: the same
        # sums, in the cheaper order.
        few = len(self.languages) <= WIDTH
        columns = self.table if few else self.embed
        sums = np.zeros((len(size), len(columns)))
        for own in buckets:
            for k, column in enumerate(columns):
                sums[:, k] += _row_sums(column[own], offsets)
        logits = sums / np.maximum(grams, 1)[:, None]
        p = softmax(((logits if few else logits @ self.out) + self.bias) / self.temperature)
        alike = np.zeros(len(size))
        if self.usual:
            best = p.argmax(axis=1)
            order = np.argsort(best, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(best[order])) + 1):
                if not len(rows):
                    continue
                usual = self._usual_row(int(best[rows[0]]))
                at, ends = _stretches(offsets, rows)
                for own in buckets:
                    alike[rows] += _row_sums(usual[own[at]], ends)
            alike = np.where(grams > 0, alike / np.maximum(grams, 1), -np.inf)
        return p, alike

    def _usual_row(self, k: int) -> np.ndarray:
        """Log frequencies of all grams in a language; the last entry, of no
        gram, is zero."""
        floor, met, values = self.usual[k]
        row = np.full(BUCKETS + 1, floor, np.float32)
        row[met], row[BUCKETS] = values, 0
        return row

    def predict(self, arr: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability of every row."""
        return self.judge(arr)[:2]

    def judge(self, arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated probability and acceptance of every row."""
        raw, offsets = string_bytes(arr)
        letters = _row_sums(_IS_LETTER[raw].astype(np.float64), offsets) > 0
        for i in np.flatnonzero(~letters & (offsets[1:] > offsets[:-1])).tolist():
            letters[i] = any(c.isalpha() for c in arr[i].as_py())
        score = np.zeros(len(arr))
        names = [UNKNOWN] * len(arr)
        accepted = np.zeros(len(arr), bool)
        if self.languages:
            p, alike = self._judge(_FOLD[raw], offsets)
            best = p.argmax(axis=1)
            score[letters] = p.max(axis=1)[letters]
            for i in np.flatnonzero(letters).tolist():
                names[i] = self.languages[best[i]]
            accepted = letters & (score >= self.threshold) & (alike >= self.least)
        return names, score, accepted


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sampled_grams(docs: DataFrame, allowed: Column | None = None, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang",
                  per_language: int = PER_LANGUAGE, most: int = SAMPLE) -> DataFrame:
    """Rows ``lang, buckets, counts``: gram counts of about ``per_language``
    labelled texts of every language, drawn by a hash of the id; fewer where
    the languages are so many that this came to over ``most`` texts."""
    share_code(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if allowed is not None:
        rows = rows.where(allowed)
    sizes = write_scratch_table(rows.groupBy(F.col(lang_col).alias("large")).agg(
        F.count("*").alias("n")), "language-sizes")
    per_language = max(1, min(per_language, most // max(1, sizes.count())))
    # Only languages of more texts are thinned out; the table of those is
    # shipped where it is small, so that no text is shuffled.
    large = sizes.where(F.col("n") > per_language)
    steps = 1 << 30
    draw = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id_col)), F.lit(steps))
    narrow = (rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                          draw.alias("draw"))
              .join(broadcast_if_small(large), F.col("lang") == F.col("large"), "left")
              .where(F.col("n").isNull() | (F.col("draw") < F.ceil(
                  F.lit(float(per_language)) / F.col("n") * steps)))
              .select("lang", "text"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                _, folded, offsets = _slice_bytes(part, "text")
                grams = [gram_buckets(folded, offsets, n) for n in GRAMS]
                buckets, counts = [], []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    own = np.concatenate([g[a:b] for g in grams])
                    u, c = np.unique(own[own < BUCKETS], return_counts=True)
                    buckets.append(u.astype(np.int32))
                    counts.append(c.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array(buckets, pa.list_(pa.int32())),
                     pa.array(counts, pa.list_(pa.int32()))], ["lang", "buckets", "counts"])

    return narrow.mapInArrow(run, "lang string, buckets array<int>, counts array<int>")


def _sample_rows(batches) -> list[tuple[str, np.ndarray, np.ndarray]]:
    found = []
    for batch in batches:
        buckets, counts = batch.column("buckets"), batch.column("counts")
        u, c = buckets.flatten().to_numpy(), counts.flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(buckets.value_lengths().to_numpy())]).tolist()
        found += [(lang, u[a:b], c[a:b]) for lang, a, b in zip(
            batch.column("lang").to_pylist(), ends[:-1], ends[1:]) if b > a]
    # An order that does not depend on how rows arrived.
    return sorted(found, key=lambda s: (s[0], s[1].tobytes(), s[2].tobytes()))


def labelled_sample(docs: DataFrame, allowed: Column | None = None,
                    **kwargs) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """The sample of :func:`sampled_grams`, brought to the driver."""
    return _sample_rows(sampled_grams(docs, allowed, **kwargs).toArrow().to_batches())


def fit(docs: DataFrame, allowed: Column | None = None, **kwargs) -> LanguageModel:
    """Trains on the bounded sample, in one task of the cluster; the driver
    gets the model alone."""
    def run(batches):
        model = train(_sample_rows(batches))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["m"])

    sample = write_scratch_table(sampled_grams(docs, allowed, **kwargs), "language-sample")
    found = sample.repartition(1).mapInArrow(run, "m binary").collect()
    return pickle.loads(bytes(found[0]["m"])) if found else train([])


def train(sample: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS,
          rate: float = RATE, max_reject: float = MAX_REJECT, seed: int = 11) -> LanguageModel:
    """Fits embeddings and softmax on four fifths of the sample, calibrates
    on the rest (on all of it when it is tiny)."""
    languages = sorted({s[0] for s in sample})
    if not languages:
        return LanguageModel([], np.zeros((WIDTH, BUCKETS + 1), np.float32),
                             np.zeros((WIDTH, 0)), np.zeros(0))
    held = [s for i, s in enumerate(sample) if i % 5 == 0]
    fit = [s for i, s in enumerate(sample) if i % 5] or held
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    out = rng.normal(0, 0.1, (WIDTH, len(languages)))
    bias = np.zeros(len(languages))
    place = {name: k for k, name in enumerate(languages)}
    # Languages count alike, however many texts each has.
    sizes = Counter(s[0] for s in fit)
    share = {k: len(fit) / (len(languages) * max(1, sizes[k])) for k in languages}
    total, step = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)).tolist():
            lang, u, c = fit[i]
            lr = rate * (1 - step / total)
            step += 1
            weight = c / c.sum()
            x = weight @ embed[u]
            logit = x @ out + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[place[lang]] -= 1
            p *= share[lang]
            back = out @ p
            out -= lr * np.outer(x, p)
            bias -= 0.1 * lr * p
            # Averages make small steps: scale by the number of grams met.
            embed[u] -= (lr * len(u) * np.minimum(weight, 1.0))[:, None] * back * 0.2
    columns = np.concatenate([embed.T, np.zeros((WIDTH, 1))], axis=1).astype(np.float32)
    model = LanguageModel(languages, columns, out, bias)

    held = (held if len(held) >= 20 else sample)[:CALIBRATION]
    logits = np.array([(c / c.sum()) @ embed[u] @ out + bias for _, u, c in held])
    truth = np.array([place[s[0]] for s in held])
    at = np.arange(len(held))
    model.temperature = float(min(
        np.geomspace(1, 20, 60),
        key=lambda t: -np.log(softmax(logits / t)[at, truth] + 1e-12).mean()))
    p = softmax(logits / model.temperature)
    right, best = p.argmax(axis=1) == truth, p.max(axis=1)
    # Reject what is less likely than not, and below the surest wrong
    # prediction, within the allowed share.
    wrong = max(0.5, best[~right].max() if (~right).any() else 0.0)
    model.threshold = float(min(wrong, np.quantile(best, max_reject, method="lower")))
    model.usual, model.least = _likeness(sample, place, max_reject)
    return model


def _likeness(sample, place: dict[str, int], max_reject: float) -> tuple[list, float]:
    """Log frequencies of grams in each language, less the median of its
    sample texts' means, and the least likeness that is accepted."""
    of = [[] for _ in place]
    for lang, u, c in sample:
        of[place[lang]].append((u, c))
    usual, totals = [], np.zeros(len(place))
    for k, own in enumerate(of):
        counts = np.zeros(BUCKETS)
        for u, c in own:
            counts[u] += c
        totals[k] = counts.sum()
        base = totals[k] + PRIOR * BUCKETS
        met = np.flatnonzero(counts)
        usual.append((float(np.log(PRIOR / base)), met.astype(np.int32),
                      np.log((counts[met] + PRIOR) / base)))
    # A language's usual mean: the median over its own texts, each against
    # counts without itself.
    own_means, middle = [], np.zeros(len(place))
    for k, own in enumerate(of):
        counts = np.zeros(BUCKETS)
        counts[usual[k][1]] = np.exp(usual[k][2]) * (totals[k] + PRIOR * BUCKETS) - PRIOR
        means = [np.log((counts[u] - c + PRIOR) / (totals[k] - c.sum() + PRIOR * BUCKETS))
                 @ (c / c.sum()) for u, c in own]
        middle[k] = np.median(means)
        own_means += [m - middle[k] for m in means]
    known = np.quantile(own_means, max_reject, method="lower")
    usual = [(f - m, met, (v - m).astype(np.float32))
             for (f, met, v), m in zip(usual, middle.tolist())]
    # Texts of a language left out: the likest of the others (of a bounded
    # number of texts and languages). With a single language a text of grams
    # never met stands for them.
    least, step = known, max(1, len(sample) // CALIBRATION)
    others = list(range(0, len(place), max(1, len(place) // 64)))
    unknown = usual[0][0]
    if len(place) > 1:
        tables = []
        for k in others:
            row = np.full(BUCKETS, usual[k][0])
            row[usual[k][1]] = usual[k][2]
            tables.append(row)
        likest = []
        for lang, u, c in sample[::step]:
            weight = c / c.sum()
            likest.append(max((t[u] @ weight for k, t in zip(others, tables)
                               if k != place[lang]), default=-np.inf))
        unknown = np.quantile(likest, 0.99)
    if unknown < known:
        least = (known + unknown) / 2
    return usual, float(least)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, lang_pred, score, rejected``."""
    spark = docs.sparkSession
    share_code(spark)
    shared = spark.sparkContext.broadcast(model)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                names, score, accepted = own.judge(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(names, pa.string()), pa.array(score),
                     pa.array(~accepted)],
                    ["id", "lang_pred", "score", "rejected"])

    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents whose language is recognised, columns unchanged."""
    spark = docs.sparkSession
    share_code(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in text_slices(batch, text_col, SLICE):
                yield part.filter(pa.array(own.judge(part.column(text_col))[2]))

    return docs.mapInArrow(run, docs.schema)
