"""Quality of texts by Bradley-Terry ranking: scores learned from preference pairs.

A document of label 1 is preferred to one of label 0. The chance that document a beats b is
the logistic function of w.(x_a - x_b), x being features of the text alone; w minimises the
logistic loss over such pairs. The threshold on w.x is the quantile of the learning rows'
scores below which as many rows lie as have label 0. Scores are mapped to 0..1 so that the
threshold lands on ``CUT``.

A null text is an empty one, which has features, and so a score, like any other. Rows are
scored one by one: repeated rows and null ids come out as they went in. Without rows of
both labels to learn from, every score is 0.5. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm import training
from paylake.llm.common import keyed_text, slices

CUT = 0.3
PAIRS = 60_000
_DIGITS, _MARKS, _STOPS = b"0123456789", b"#$%&*@^~=<>{}[]\\_", b".,;:?"


def features(text: str) -> list[float]:
    """Shares of kinds of characters, words and lines, and how much repeats."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, w, k = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / n

    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(len(words)),
        n / w,
        share(_DIGITS),
        share(_MARKS),
        share(b"!"),
        share(b"|"),
        share(_STOPS),
        sum(map(str.isupper, words)) / w,
        sum(map(str.istitle, words)) / w,
        distinct / w,
        # Distinct words grow more slowly than words: set against what prose of that length has.
        np.log1p(distinct) - 0.8 * np.log1p(len(words)),
        (pairs + 1) / w,
        sum(map(eq, words, words[1:])) / w,
        1 - len(set(lines)) / k,
        np.log1p(len(words) / k),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / k,
    ]


N_FEATURES = len(features(""))


def expanded(x: np.ndarray) -> np.ndarray:
    """Features, and for each that is a share its logarithm: small shares matter too."""
    return np.hstack([x, np.log(np.abs(x) + 0.003)])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def score(self, x: np.ndarray) -> np.ndarray:
        own = ((expanded(x) - self.mean) / self.scale).clip(-8, 8) @ self.weights
        z = (own - self.threshold) / self.spread + np.log(CUT / (1 - CUT))
        # Rounded, so that a text's score does not depend on the batch it came in.
        return (1 / (1 + np.exp(-z.clip(-40, 40)))).round(9)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS) -> Model | None:
    """Newton's method on ``pairs`` random preference pairs; None without both labels."""
    if y.min(initial=1) == y.max(initial=0) or not len(y):
        return None
    x = expanded(x)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = ((x - mean) / scale).clip(-8, 8)
    random = np.random.default_rng(7)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    diff = z[random.choice(good, pairs)] - z[random.choice(bad, pairs)]
    w = np.zeros(z.shape[1])
    ridge = 1e-3 * np.eye(len(w))
    for _ in range(30):
        p = 1 / (1 + np.exp((diff @ w).clip(-40, 40)))  # how wrong each pair still is
        gradient = -(diff * p[:, None]).mean(axis=0) + ridge @ w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + ridge
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = np.sort(z @ w)
    # Between the last row below the quantile and the first above it.
    at = int(round((y == 0).mean() * len(y)))
    threshold = float((scores[max(at - 1, 0)] + scores[min(at, len(y) - 1)]) / 2)
    return Model(mean, scale, w, threshold, float(max(scores.std() / 3, 1e-6)))


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), N_FEATURES)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """A model from a bounded sample; only features and labels reach the driver."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["label"],
                    pa.array(list(_matrix(batch["text"].to_pylist())), pa.list_(pa.float64())),
                ],
                names=["doc_id", "label", "x"],
            )

    rows = (
        training.sample(docs, labels, label)
        .select("doc_id", "label", "text")
        .mapInArrow(measure, "doc_id long, label int, x array<double>")
        .toPandas()
        .sort_values(["doc_id", "label"], kind="stable")
    )
    if rows.empty:
        return None
    return fit(np.array(rows["x"].tolist()), rows["label"].to_numpy())


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs``: its score, and whether it reaches ``CUT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch["text"].to_pylist())
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(score, pa.float64()),
                    pa.array((score >= CUT).astype(np.int32), pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = keyed_text(docs)
    return rows.select("doc_id", training.held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, SCHEMA
    )
