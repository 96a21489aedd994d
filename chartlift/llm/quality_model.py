"""Quality by a regularised quadratic discriminant (operator 6).

Every document becomes a vector of transformed statistics (logarithms of sizes, log-odds of shares). Each class has a
mean and a covariance, summed over all training documents by Spark; a covariance is shrunk towards its diagonal and
towards the pooled one. A score is the logistic function of the difference of the two Mahalanobis log-densities,
with the classes' log-odds added; Cholesky factors are computed once and travel with the model.

Null and empty texts have a vector like others (all counts zero). Without training rows of both labels every score
is 0.5. Repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import map_texts, texts_of
from chartlift.llm.labels import held_out, training_labels
from chartlift.runtime import settle

CUT = 0.3
TO_DIAGONAL = 0.1
TO_POOLED = 0.1
RIDGE = 0.05
SYMBOLS = b"#*$%&|<>@^~_=+{}[]\\/"
MARKS = b".,;:!?"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
NAMES = (
    "log_words", "log_word_length", "upper", "symbols", "marks", "digits", "other", "distinct_words", "distinct_lines", "short_words",
    "shouts", "repeated_next", "log_line_words", "sentence_ends",
)


def _odds(part: float, whole: float) -> float:
    """The log-odds of a share, with half a count added to both sides."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(text: str) -> list[float]:
    """The vector of one text, in the order of NAMES."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    lines = [x for x in raw.split(b"\n") if x]

    def count(characters: bytes) -> int:
        return size - len(raw.translate(None, characters))

    upper, lower, symbols, marks, digits = map(count, (UPPER, LOWER, SYMBOLS, MARKS, DIGITS))
    visible = sum(map(len, words))
    again = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    ends = sum(map(raw.count, (b". ", b".\n", b"! ", b"? "))) + raw.endswith((b".", b"!", b"?"))
    short = sum(1 for length in map(len, words) if length <= 3)
    shouts = raw.count(b"!!") + raw.count(b"??")
    return [
        float(np.log1p(n)), float(np.log1p(visible / max(1, n))), _odds(upper, max(upper, visible)), _odds(symbols, max(symbols, visible)),
        _odds(marks, max(marks, visible)), _odds(digits, visible), _odds(max(0, visible - upper - lower - symbols - marks - digits), visible),
        _odds(len(set(words)), n), _odds(len(set(lines)), len(lines)), _odds(short, n), _odds(min(shouts, n), n), _odds(again, n),
        float(np.log1p(n / max(1, len(lines)))), _odds(min(ends, n), n),
    ]


@dataclass
class Model:
    means: np.ndarray  # one row for each label
    factors: np.ndarray  # inverses of the Cholesky factors
    log_scale: np.ndarray  # log-determinants of the factors
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, inverse, scale in zip(self.means, self.factors, self.log_scale, strict=True):
            z = (x - mean) @ inverse.T
            density.append(-0.5 * (z * z).sum(axis=1) - scale)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -60, 60)))


def fit(measured: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model | None:
    """From sums over all training rows; two rows of sums come to the driver."""
    rows = measured.join(training_labels(labels, label_col), "doc_id").select("label", "stats")
    size = len(NAMES)

    def add_up(batches):
        n, sums, squares = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
        for batch in batches:
            label = np.array(batch.column("label").to_pylist(), dtype=np.int64)
            x = np.array(batch.column("stats").to_pylist(), dtype=float).reshape(-1, size)
            for y in (0, 1):
                own = x[label == y]
                n[y] += len(own)
                sums[y] += own.sum(axis=0)
                squares[y] += own.T @ own
        flat = [np.concatenate([[n[y]], sums[y], squares[y].ravel()]) for y in (0, 1)]
        columns = [[y for y in (0, 1) for _ in flat[y]], [i for y in (0, 1) for i in range(len(flat[y]))], np.concatenate(flat)]
        types = [pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["label", "place", "value"])

    parts = rows.mapInArrow(add_up, "label int, place int, value double")
    total = np.zeros((2, 1 + size + size * size))
    for label, place, value in parts.groupBy("label", "place").agg(F.sum("value")).collect():
        total[label, place] = value
    n = total[:, 0]
    if min(n) < 2:
        return None
    means = total[:, 1 : 1 + size] / n[:, None]
    covariances = total[:, 1 + size :].reshape(2, size, size) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (covariances * n[:, None, None]).sum(axis=0) / n.sum()
    factors, scales = [], []
    for covariance in covariances:
        shrunk = (1 - TO_POOLED) * covariance + TO_POOLED * pooled
        shrunk = (1 - TO_DIAGONAL) * shrunk + TO_DIAGONAL * np.diag(np.diag(shrunk)) + RIDGE * np.eye(size)
        factor = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(factor))
        scales.append(np.log(np.diag(factor)).sum())
    return Model(means, np.array(factors), np.array(scales), float(np.log(n[1] / n[0])))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the vector of statistics, in one scan."""

    def make():
        return lambda ids, texts: {"doc_id": ids, "stats": [statistics(t) for t in texts]}

    return map_texts(texts_of(docs, id_col, text_col), make, "doc_id long, stats array<double>")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (score at least 0.3) for every text."""
    measured = settle(measure(docs, id_col, text_col))
    model = fit(measured, labels)

    def judge(batches):
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist(), dtype=float).reshape(-1, len(NAMES))
            scores = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    found = measured.mapInArrow(judge, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
