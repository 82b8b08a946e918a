"""Quality classifier by positive-unlabelled learning.

Only labelled good texts are trusted; the rest of the corpus is an unlabelled mixture. The share of good texts in that
mixture is estimated from how a first classifier ranks both samples: among the texts it ranks highest there are hardly
bad ones, so the ratio of both samples' shares above a threshold is smallest, and close to the prior, there. The
classifier then minimises the non-negative unbiased risk

    prior * E_good[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_good[loss(-)])

with the logistic loss. Features are counts over the whole text. Of the labelled texts a bounded sample is learned from
(``GOOD`` ids, those with the smallest hashes, one row each); the unlabelled mixture are all texts outside the held-out
rows. Their features are written once, in blocks. Moments, the prior's counts, and the gradient and curvature of each
step of Newton's method are sums over these blocks; only such sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstguard.llm.common import written

#: Ids of the labelled sample, at most.
GOOD = 6000
#: Steps of Newton's method, at most, and the size of gradient that ends them.
STEPS, SMALL = 30, 1e-7
DECAY = 1e-3
#: Length of a step that is turned round.
TURNED = 0.1
#: Of the good sample, how much must lie above a threshold that the prior is read from.
LEAST_SHARE = 0.5
THRESHOLD = 0.7

CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\r\n", b"!?", b"#*$%&|<>",
    b".,;:", b"\"'()[]", b"-_/\\=+~^@`{}", bytes(range(128, 256)),
]
_OF_BYTE = np.full(256, len(CLASSES))
for _i, _c in enumerate(CLASSES):
    _OF_BYTE[list(_c)] = _i
FEATURES = len(CLASSES) + 9


def features(text: str) -> np.ndarray:
    """Shares of byte classes, and lengths and repetition of words and lines; zeros for an empty text."""
    out = np.zeros(FEATURES)
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    out[: len(CLASSES)] = np.bincount(_OF_BYTE, counts, len(CLASSES) + 1)[:-1] / len(raw)
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    triples = max(1, n - 2)
    out[len(CLASSES) :] = (
        np.log1p(n), lengths.mean(), lengths.std(), len(set(words)) / n, len(set(zip(words, words[1:], words[2:]))) / triples,
        len(set(lines)) / len(lines), np.log1p(n / len(lines)), np.mean(lengths > 20), 1.0,
    )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(x) @ self.weights, -30, 30)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Mixture:
    """The unlabelled texts: sums over the blocks of their features."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks

    def total(self, work) -> np.ndarray:
        """The sum of ``work(matrix)``, an array, over all blocks; added exactly, so that no order changes it."""

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for frame in frames:
                for packed in frame["x"]:
                    part = work(np.frombuffer(packed, np.float64).reshape(-1, FEATURES))
                    total = part if total is None else total + part
            if total is not None:
                yield pd.DataFrame({"v": [total.tolist()]})

        sums = (
            self.blocks.mapInPandas(run, "v array<double>").select(F.posexplode("v").alias("at", "v")).groupBy("at")
            .agg(F.sum(F.col("v").cast("decimal(38,12)")).alias("v")).collect()
        )
        out = np.zeros(len(sums))
        for row in sums:
            out[row["at"]] = float(row["v"])
        return out


class Matrix(Mixture):
    """The same over a matrix at hand."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix

    def total(self, work) -> np.ndarray:
        return work(self.matrix)


def _slope(model: Model, w: np.ndarray, half: bool):
    """Rows, summed loss, gradient and curvature of softplus(x w), over every other row if ``half``."""

    def work(x: np.ndarray) -> np.ndarray:
        z = model.inputs(x[::2] if half else x)
        b = z @ w
        s = _sigmoid(b)
        return np.concatenate([[len(z), np.logaddexp(0, b).sum()], z.T @ s, (z.T @ (z * (s * (1 - s))[:, None])).ravel()])

    return work


def _parts(sums: np.ndarray, size: int) -> tuple[float, float, np.ndarray, np.ndarray]:
    n = max(sums[0], 1)
    return sums[0], sums[1] / n, sums[2 : 2 + size] / n, sums[2 + size :].reshape(size, size) / n


def _newton(step, size: int) -> np.ndarray:
    """``step(w)`` gives gradient, curvature and whether the step is turned round."""
    w = np.zeros(size)
    for _ in range(STEPS):
        g, h, turned = step(w)
        if not turned:
            g = g + DECAY * w
        if np.abs(g).max() < SMALL:
            break
        d = np.linalg.solve(h + DECAY * np.eye(size), g)
        d *= min(1.0, 5.0 / max(np.abs(d).max(), 1e-12))
        w = w - (TURNED * d if turned else d)
    return w


def against(model: Model, good: np.ndarray, mixture: Mixture):
    """Good texts against the mixture, on one half of both: only the order of scores matters."""
    p = model.inputs(good[::2])

    def step(w: np.ndarray):
        _, _, g, h = _parts(mixture.total(_slope(model, w, True)), p.shape[1])
        s = _sigmoid(-(p @ w))
        return g - p.T @ s / len(p), h + p.T @ (p * (s * (1 - s))[:, None]) / len(p), False

    return step


def risk(model: Model, good: np.ndarray, mixture: Mixture, prior: float):
    """The non-negative risk. Its part of the bad texts, mean softplus(z) of the mixture less ``prior`` times that of the
    good ones, cannot be below zero; where it is, the step that lowers it is turned round."""
    p = model.inputs(good)

    def step(w: np.ndarray):
        _, loss, g, h = _parts(mixture.total(_slope(model, w, False)), p.shape[1])
        a = p @ w
        bad = loss - prior * np.logaddexp(0, a).mean()
        if bad < 0:
            return -(g - prior * p.T @ _sigmoid(a) / len(p)), h, True
        # softplus(-a) - softplus(a) = -a
        return g - prior * p.mean(axis=0), h, False

    return step


def estimate_prior(good: np.ndarray, counts) -> float:
    """Smallest ratio of the mixed to the good texts' share above any threshold, from scores of the good ones and, for
    the mixture, ``counts(thresholds)``: how many there are, and how many reach each."""
    thresholds = np.quantile(good, np.linspace(0, 1 - LEAST_SHARE, 20))
    n, *above = counts(thresholds)
    ratios = [m / max(n, 1) / (good >= t).mean() for t, m in zip(thresholds, above)]
    return float(np.clip(min(ratios), 0.02, 0.98))


def fit(good: np.ndarray, mixture: Mixture) -> Model | None:
    moments = mixture.total(lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(moments) or not moments[0]:
        return None
    mean, square = (moments[1:].reshape(2, FEATURES) / moments[0])
    model = Model(mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6, np.zeros(0), 0.5)
    size = model.inputs(good[:1]).shape[1]
    first = _newton(against(model, good, mixture), size)

    def counts(thresholds: np.ndarray) -> np.ndarray:
        """Over the half that the first classifier has not seen."""

        def work(x: np.ndarray) -> np.ndarray:
            scores = model.inputs(x[1::2]) @ first
            return np.array([len(scores), *((scores >= t).sum() for t in thresholds)], float)

        return mixture.total(work)

    if len(good) > 1 and moments[0] > 1:
        model.prior = estimate_prior(model.inputs(good[1::2]) @ first, counts)
    model.weights = _newton(risk(model, good, mixture, model.prior), size)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(texts: pd.Series) -> list[np.ndarray]:
    return [features(t or "") for t in texts]


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            yield pd.DataFrame({"x": [np.array(_features(frame["text"])).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, good: int = GOOD) -> Model | None:
    """A model from the good labels outside the held-out rows, and all texts outside them; None if there are no such.

    A doc_id that stands in several rows gives one row to the good sample, that with the least features; all of them are
    unlabelled texts. Rows without a doc_id are not learned from.
    """
    mine = docs.select("doc_id", "text").filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    trusted = labels.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & (F.col("quality") == 1))
    ids = trusted.select("doc_id").distinct().join(mine.select("doc_id").distinct(), "doc_id", "left_semi")
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(good)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "x": [x.tolist() for x in _features(frame["text"])]})

    # at most ``good`` ids
    sample = mine.join(F.broadcast(ids), "doc_id").mapInPandas(run, "doc_id long, x array<double>")
    rows = sample.groupBy("doc_id").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    if not rows:
        return None
    mixture = Mixture(written(mine.select("text").mapInPandas(_blocks, "x binary")))
    return fit(np.array([r["x"] for r in rows]).reshape(-1, FEATURES), mixture)


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0.5 without a model) and ``predicted`` in place of ``text``.

    A null or empty text has features of its own (all zero) and is scored like any other. Repeated rows score alike; an
    empty table gives an empty one. Other columns are passed through and never used.
    """

    def score(texts: pd.Series) -> pd.Series:
        if model is None or not len(texts):
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(model.score(np.array([features(t or "") for t in texts])))

    scored = docs.withColumn("score", F.pandas_udf(score, "double")("text")).drop("text")
    return scored.withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
