"""Quality classifier by co-training on two views of a document.

The *content* view is the text: averaged hashed 3-byte grams. The
*metadata* view is what is known around it: language, source, length, and
the layout figures of the page (lines, word length, shares of capitals,
digits, signs and distinct words), each as a bin. Each view has a logistic
classifier. Over ``ROUNDS`` rounds each labels the documents of an
unlabelled pool it is surest of, and hands them to the *other* view to
learn from. At the end both are calibrated on labelled documents kept
apart, and their calibrated log-odds are combined with weights fitted
there, to score all documents.

Training runs in numpy on the driver, on bounded samples drawn by hash:
about ``LABELLED`` labelled documents and a pool of about ``POOL`` others
(whole texts, as gram counts; both bounds are parameters). Scoring is one
narrow pass.

Defined cases: a null or empty text has no grams and is scored on its
metadata; null metadata is a bin of its own; rows that repeat a label of
one document are averaged (half and more is good), labels without a value
are ignored; without labels of both kinds every score is the share of good
labels (0.5 without any); repeated rows are each scored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (maybe_member, mix, share_code, string_bytes, text_slices, word_hashes,
                     word_table)

GRAM_BITS = 14
META_BITS = 12
LABELLED = 1500
POOL = 2500
ROUNDS = 4
HANDED = 0.05             # share of the pool that a view hands over in a round
STEPS = 60                # gradient steps of a fit

_WORDS = word_table(lambda b: b > 0x20)
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_LINE = np.array([b == 10 for b in range(256)])


def _shares(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the 3 bytes from each place on; the last two places of a
    row share the bucket ``2 ** GRAM_BITS``, which has no weight."""
    out = np.full(len(data), 1 << GRAM_BITS, np.int32)
    if len(data) >= 3:
        d = data.astype(np.uint32)
        x = d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16)
        out[:-2] = (x * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    for j in (1, 2):
        at = offsets[1:] - j
        out[at[at >= offsets[:-1]]] = 1 << GRAM_BITS
    return out


def metadata_bins(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed bins of the metadata view, one column per figure."""
    size = np.diff(offsets)
    hashes, _, _, counts = word_hashes(data, offsets, _WORDS)
    distinct, at = np.zeros(len(size)), 0
    for i, n in enumerate(counts.tolist()):
        distinct[i] = len(np.unique(hashes[at:at + n])) / n if n else 0.0
        at += n
    fine = lambda x: np.minimum(x * 40, 20).astype(np.int64)
    figures = [
        np.log2(size + 1).astype(np.int64), np.log2(counts + 1).astype(np.int64),
        fine(distinct * np.log2(counts + 2) / 10),
        fine(_shares(_UPPER[data], offsets)), fine(_shares(_DIGIT[data], offsets)),
        fine(_shares(_SIGN[data], offsets)), fine(_shares(_LINE[data], offsets) * 5),
        np.minimum(size / np.maximum(counts, 1), 20).astype(np.int64)]
    for name in ("lang", "source"):
        coded = part.column(name).dictionary_encode()
        words = coded.dictionary.to_pylist()
        value = np.array([hash_text(w) for w in words] or [0], np.int64)
        index = coded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        nulls = np.asarray(coded.indices.is_null())
        figures.append(np.where(nulls, -1, value[np.minimum(index, len(value) - 1)]))
    known = np.asarray(part.column("n_chars").fill_null(-1)).astype(np.float64)
    figures.append(np.where(known < 0, -1, np.log2(np.maximum(known, 0) + 1) * 2).astype(np.int64))
    columns = [mix((f.astype(np.int64).view(np.uint64)) * np.uint64(64) + np.uint64(k))
               >> np.uint64(64 - META_BITS) for k, f in enumerate(figures)]
    return np.stack(columns, axis=1).astype(np.int32)


def hash_text(s: str) -> int:
    x = np.uint64(1469598103934665603)
    with np.errstate(over="ignore"):
        for b in s.encode():
            x = (x ^ np.uint64(b)) * np.uint64(1099511628211)
    return int(x >> np.uint64(8))


# -------------------------------------------------------------- training

@dataclass
class Sparse:
    """Rows of (feature, value) pairs."""
    rows: np.ndarray
    features: np.ndarray
    values: np.ndarray
    n: int

    def logits(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.rows, self.values * w[self.features], self.n) + bias


@dataclass
class LinearView:
    weights: np.ndarray
    bias: float = 0.0
    squares: np.ndarray = field(default=None, repr=False)

    def fit(self, x: Sparse, target: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> None:
        """Weighted logistic regression, adaptive gradient steps with a
        little decay, from where the last fit ended."""
        if self.squares is None:
            self.squares = np.full(len(self.weights) + 1, 1e-8)
        share = weight / weight.sum()
        for _ in range(steps):
            error = (1 / (1 + np.exp(-x.logits(self.weights, self.bias))) - target) * share
            grad = np.append(np.bincount(x.features, x.values * error[x.rows],
                                         len(self.weights)), error.sum())
            grad[:-1] += 1e-5 * self.weights
            self.squares += grad ** 2
            move = 0.5 * grad / np.sqrt(self.squares)
            self.weights -= move[:-1]
            self.bias -= move[-1]


@dataclass
class QualityModel:
    content: np.ndarray         # weight per gram bucket, the last 0
    metadata: np.ndarray
    bias: tuple[float, float]
    mixture: tuple[float, float, float]     # of the two log-odds, and a constant

    def score(self, part: pa.RecordBatch) -> np.ndarray:
        data, offsets = string_bytes(part.column("text"))
        size = np.maximum(np.diff(offsets) - 2, 1)
        sums = np.concatenate([[0.0], np.cumsum(self.content[grams(data, offsets)],
                                                dtype=np.float64)])
        text = (sums[offsets[1:]] - sums[offsets[:-1]]) / size + self.bias[0]
        meta = self.metadata[metadata_bins(part, data, offsets)].sum(axis=1) + self.bias[1]
        a, b, c = self.mixture
        return 1 / (1 + np.exp(-np.clip(a * text + b * meta + c, -30, 30)))


def _narrow(docs: DataFrame, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), "text", F.col("lang").cast("string"),
                       F.col("source").cast("string"), F.col("n_chars").cast("long"))


def _sampled(rows: DataFrame, extra: str) -> list[tuple]:
    """Features of sampled rows on the driver: ``(label, buckets, counts,
    bins)``, in an order that does not depend on how they arrived."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                data, offsets = string_bytes(part.column("text"))
                g, bins = grams(data, offsets), metadata_bins(part, data, offsets)
                u, c = [], []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    own = g[a:b]
                    x, k = np.unique(own[own < 1 << GRAM_BITS], return_counts=True)
                    u.append(x.astype(np.int32))
                    c.append(k.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(extra), pa.array(u, pa.list_(pa.int32())),
                     pa.array(c, pa.list_(pa.int32())),
                     pa.array(list(bins), pa.list_(pa.int32()))], ["label", "u", "c", "bins"])

    got = rows.mapInArrow(run, "label int, u array<int>, c array<int>, bins array<int>").toArrow()
    out = [(label, np.asarray(u, np.int32), np.asarray(c, np.int32), np.asarray(b, np.int32))
           for label, u, c, b in zip(*(got.column(k).to_pylist()
                                       for k in ("label", "u", "c", "bins")))]
    return sorted(out, key=lambda r: (r[0] or 0, r[3].tobytes(), r[1].tobytes(), r[2].tobytes()))


def _matrices(rows: list[tuple]) -> tuple[Sparse, Sparse]:
    size = np.array([len(r[1]) for r in rows], np.int64)
    text = Sparse(np.repeat(np.arange(len(rows)), size),
                  np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int32),
                  np.concatenate([r[2] / max(1, r[2].sum()) for r in rows]) if rows
                  else np.zeros(0), len(rows))
    width = len(rows[0][3]) if rows else 0
    meta = Sparse(np.repeat(np.arange(len(rows)), width),
                  np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, np.int32),
                  np.ones(len(rows) * width), len(rows))
    return text, meta


def _joined(a: Sparse, b: Sparse, pick: np.ndarray) -> Sparse:
    """The rows of ``a``, then the picked rows of ``b``."""
    place = np.full(b.n, -1)
    place[pick] = a.n + np.arange(len(pick))
    own = place[b.rows] >= 0
    return Sparse(np.concatenate([a.rows, place[b.rows[own]]]),
                  np.concatenate([a.features, b.features[own]]),
                  np.concatenate([a.values, b.values[own]]), a.n + len(pick))


def train(labelled: list[tuple], pool: list[tuple], rounds: int = ROUNDS,
          handed: float = HANDED) -> QualityModel:
    """Co-training; a quarter of the labelled rows is kept apart for
    calibration."""
    y_all = np.array([r[0] for r in labelled], float)
    share = float(y_all.mean()) if len(y_all) else 0.5
    flat = QualityModel(np.zeros((1 << GRAM_BITS) + 1), np.zeros(1 << META_BITS), (0.0, 0.0),
                        (0.0, 0.0, math.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    apart = np.arange(len(labelled)) % 4 == 0
    y = y_all[~apart]
    if len(set(y.tolist())) < 2:
        return flat
    fit = [r for r, h in zip(labelled, apart) if not h]
    views = (LinearView(np.zeros((1 << GRAM_BITS) + 1)), LinearView(np.zeros(1 << META_BITS)))
    base, extra = _matrices(fit), _matrices(pool)
    got = [(np.zeros(0, np.int64), np.zeros(0)) for _ in views]   # pseudo-labelled pool rows
    for turn in range(rounds + 1):
        for k, view in enumerate(views):
            pick, target = got[k]
            x = _joined(base[k], extra[k], pick)
            t = np.concatenate([y, target])
            # Both labels count alike; a pseudo-label counts half.
            weight = np.where(t > 0.5, 0.5 / max(1, (t > 0.5).sum()),
                              0.5 / max(1, (t <= 0.5).sum()))
            weight[len(y):] *= 0.5
            view.fit(x, t, weight)
        if turn == rounds or not pool:
            break
        for k, view in enumerate(views):
            sure = extra[k].logits(view.weights, view.bias)
            free = np.setdiff1d(np.arange(len(pool)), got[1 - k][0])
            n = max(1, int(handed * len(pool)))
            order = free[np.argsort(sure[free], kind="stable")]
            good = order[::-1][:max(1, round(n * share))]
            bad = order[:max(1, round(n * (1 - share)))]
            good, bad = good[sure[good] > 0], bad[sure[bad] < 0]
            pick, target = got[1 - k]
            got[1 - k] = (np.concatenate([pick, good, bad]),
                          np.concatenate([target, np.ones(len(good)), np.zeros(len(bad))]))
    held = _matrices([r for r, h in zip(labelled, apart) if h])
    z = np.stack([m.logits(v.weights, v.bias) for m, v in zip(held, views)], axis=1)
    scale = np.maximum(z.std(axis=0), 1e-6)
    design = np.column_stack([z / scale, np.ones(len(z))])
    mixture, truth = np.array([1.0, 1.0, 0.0]), y_all[apart]
    for _ in range(50):         # ridge-damped Newton steps
        p = 1 / (1 + np.exp(-design @ mixture))
        grad = design.T @ (p - truth) + 0.1 * mixture
        hess = design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(3)
        mixture = mixture - np.linalg.solve(hess, grad)
    a, b = mixture[:2] / scale
    content = views[0].weights.copy()
    content[-1] = 0.0
    return QualityModel(content, views[1].weights, (views[0].bias, views[1].bias),
                        (float(a), float(b), float(mixture[2])))


def fit_quality(docs: DataFrame, labels: DataFrame, allowed: Column | None = None,
                id_col: str = "doc_id", label_col: str = "quality",
                n_labelled: int = LABELLED, n_pool: int = POOL) -> QualityModel:
    """Draws the samples and trains. ``allowed`` (a condition on the id)
    keeps documents out of training altogether."""
    share_code(docs.sparkSession)
    steps = 1 << 30

    def draw(salt: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(steps))

    def bound(size: int, most: int) -> Column:
        return F.lit(math.ceil(min(1.0, most / max(size, 1)) * steps))

    own = docs if allowed is None else docs.where(allowed)
    marks = (labels if allowed is None else labels.where(allowed)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")) \
        .where("id is not null and y is not null") \
        .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    chosen = marks.where(draw("quality labels") < bound(marks.count(), n_labelled))
    rows = _narrow(own, id_col)
    labelled = _sampled(maybe_member(rows, "id", chosen, "id").join(chosen, "id"), "y")
    size = own.count()
    pool = _sampled(rows.where(draw("quality pool") < bound(size, n_pool))
                    .withColumn("y", F.lit(None).cast("int")), "y")
    return train(labelled, pool)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """One row per document: ``id_col`` and ``score`` (0 to 1, good is
    high)."""
    spark = docs.sparkSession
    share_code(spark)
    shared = spark.sparkContext.broadcast(model)
    narrow = _narrow(docs, id_col)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(shared.value.score(part))], ["id", "score"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
