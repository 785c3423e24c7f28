"""Operator 12: quality classifier, a linear hinge-loss model over n-grams scaled by class log-count ratios."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.session import stored

#: Labelled rows that the model is fitted on, at most and about: the bound of its sample; and the n-grams that they may hold together.
TRAIN_ROWS, TRAIN_GRAMS = 12_000, 1 << 24
#: n-grams are numbered by a hash into so many buckets.
BUCKETS = 1 << 18
#: Smoothing of the counts, the cost of the hinge loss, passes of the descent, and the score from which a text is predicted good.
ALPHA, COST, EPOCHS, GOOD = 1.0, 1.0, 12, 0.7
#: One row in so many of the sample is kept out of the descent and turns margins into probabilities.
CALIBRATION = 4
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: str) -> str:
    """The form of a token: case of a word, a number, or a mark and whether it is repeated."""
    if token[0].isalpha():
        return "A" if token.isupper() and len(token) > 1 else "T" if token[0].isupper() else "a"
    if token[0].isdigit():
        return "0"
    return token if len(token) == 1 else token[0] + "+"


class Grams:
    """Texts to sorted buckets of their n-grams: words and word pairs, and runs of one to three token forms.

    A form also says whether its token repeats the one before, so that runs of one word are n-grams of their own. The memo of tokens is
    emptied between texts when it is full.
    """

    MEMO = 1 << 17

    def __init__(self):
        self.memo: dict[str, tuple[int, int]] = {}

    def buckets(self, text: str | None) -> np.ndarray:
        tokens = _TOKEN.findall(text or "")
        if not tokens:
            return np.zeros(0, dtype=np.int32)
        memo = self.memo
        if len(memo) > self.MEMO:
            memo.clear()
        for t in set(tokens):
            if t not in memo:
                memo[t] = (zlib.crc32(t.lower().encode("utf-8", "surrogatepass")), zlib.crc32(b"\0" + _shape(t).encode("utf-8", "surrogatepass")))
        pairs = np.array([memo[t] for t in tokens], dtype=np.uint64)
        words, forms = pairs[:, 0], pairs[:, 1]
        again = np.zeros(len(words), dtype=np.uint64)
        again[1:] = words[1:] == words[:-1]
        forms = forms * np.uint64(2) + again
        two = forms[:-1] * np.uint64(31) + forms[1:]
        with np.errstate(over="ignore"):
            kinds = [words + np.uint64(1 << 40), words[:-1] * np.uint64(1_000_003) + words[1:] + np.uint64(1 << 41), forms + np.uint64(1 << 42), two * np.uint64(17) + np.uint64(1 << 43), two[:-1] * np.uint64(10_007) + forms[2:] + np.uint64(1 << 44)]
            mixed = np.concatenate(kinds) * _MIX
        return np.unique((mixed >> np.uint64(64 - 18)).astype(np.int32))


@dataclass
class QualityModel:
    """Weights by bucket (already scaled by the log-count ratios), the bias, and the logistic of the margin."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum() / np.sqrt(max(1, len(buckets))) + self.bias)

    def score(self, buckets: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(buckets) + self.offset, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of a bucket's share among good rows over its share among bad ones, smoothed towards the classes' sizes; 0 for buckets never seen."""
    good, bad = (np.bincount(np.concatenate([r for r, v in zip(rows, y) if v == c] or [np.zeros(0, dtype=np.int32)]), minlength=BUCKETS).astype(float) for c in (1, -1))
    n, n1, n0 = len(y), int((y == 1).sum()), int((y == -1).sum())
    return np.log((good + ALPHA * n1 / n) / n1) - np.log((bad + ALPHA * n0 / n) / n0)


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights over `values`-scaled indicators of unit scale, and the bias, that minimise |w|^2 / 2 + sum of the rows' costs times their hinge loss.

    One dual variable per row lies between 0 and the row's cost; each step solves for one of them exactly, in an order shuffled
    anew in each pass. Both classes weigh alike.
    """
    w, bias = np.zeros(BUCKETS), 0.0
    n = len(y)
    cost = np.where(y > 0, COST * n / (2 * max(1, (y > 0).sum())), COST * n / (2 * max(1, (y < 0).sum())))
    scaled = [values[r] / np.sqrt(max(1, len(r))) for r in rows]
    norms = np.array([float(x @ x) + 1.0 for x in scaled])
    alpha, rng = np.zeros(n), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(n).tolist():
            r, x = rows[i], scaled[i]
            slack = y[i] * (w[r] @ x + bias) - 1
            new = min(max(alpha[i] - slack / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w * values, bias


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic that best fits the labels, by damped Newton steps on smoothed targets."""
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, 0.0

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        gap, weight = p - target, p * (1 - p) + 1e-9
        gradient = np.array([gap @ margins, gap.sum()])
        hessian = np.array([[weight @ (margins * margins) + 1e-9, weight @ margins], [weight @ margins, weight.sum() + 1e-9]])
        determinant = hessian[0, 0] * hessian[1, 1] - hessian[0, 1] ** 2
        if abs(determinant) < 1e-15:
            break
        step = np.array([hessian[1, 1] * gradient[0] - hessian[0, 1] * gradient[1], hessian[0, 0] * gradient[1] - hessian[0, 1] * gradient[0]]) / determinant
        size, now = 1.0, loss(slope, offset)
        while size > 1e-6 and loss(slope - size * step[0], offset - size * step[1]) > now:
            size /= 2
        slope, offset = slope - size * step[0], offset - size * step[1]
        if np.abs(size * step).max() < 1e-9:
            break
    return float(max(slope, 0.0)), float(offset)


def fit_rows(rows: list[np.ndarray], good: np.ndarray) -> QualityModel:
    """A model of labelled rows; with a single class, or none, every score is the smoothed share of good rows."""
    share = (good.sum() + 1) / (len(good) + 2)
    constant = QualityModel(np.zeros(BUCKETS, dtype=np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    if not 0 < good.sum() < len(good):
        return constant
    held = np.arange(len(good)) % CALIBRATION == 0
    if not all(0 < good[s].sum() < s.sum() for s in (held, ~held)):
        held = np.zeros(len(good), dtype=bool)
    inner = [r for r, h in zip(rows, held) if not h]
    y = np.where(good, 1, -1)[~held]
    weights, bias = dual_coordinate_descent(inner, log_count_ratios(inner, y), y)
    model = QualityModel(weights, bias, 1.0, 0.0)
    at = held if held.any() else ~held
    margins = np.array([model.margin(r) for r, h in zip(rows, at) if h])
    model.slope, model.offset = _logistic(margins, good[at])
    model.weights = weights.astype(np.float32)
    return model


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = Grams()
    for batch in batches:
        out = [grams.buckets(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in out], pa.binary()), pa.array([len(x) for x in out], pa.int64())], ["id", "good", "grams", "n"])


def fit(docs: DataFrame, labels: DataFrame, may_train, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """The model of the labelled documents for which `may_train`, a condition on the label table's key, holds.

    About TRAIN_ROWS labelled keys at most are used, those with the smallest hash values, and of their n-grams about TRAIN_GRAMS; the
    documents are then one scan against these few keys. A key whose labels contradict each other is left out, as are null keys and labels; a key with several texts trains by the
    least one, a null text is empty.
    """
    named = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & may_train)
    known = named.groupBy(F.col(key).cast("long").alias("id")).agg(F.min(label).alias("least"), F.max(label).alias("most")).where("least = most")
    lot = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(1 << 30))
    n = known.count()
    some = known.where(lot < F.lit(int((1 << 30) * min(1.0, TRAIN_ROWS / max(1, n))))).select("id", (F.col("least") == 1).alias("good"))
    ours = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = ours.join(F.broadcast(some), "id").groupBy("id").agg(F.first("good").alias("good"), F.min("text").alias("text"))
    rows = stored(texts.select("id", "good", "text").mapInArrow(_training, "id long, good boolean, grams binary, n long"), "quality")
    total = rows.agg(F.sum("n")).first()[0] or 0
    kept = rows.where(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, TRAIN_GRAMS / max(1, total)))))
    got = kept.select("good", "grams").orderBy(F.xxhash64("id", F.lit(14)), "id").collect()
    return fit_rows([np.frombuffer(r["grams"], np.int32) for r in got], np.array([r["good"] for r in got], dtype=bool))


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score, predicted) of every document's whole text.

    score is the probability that the label is 1, predicted is 1 from GOOD on. Labels are learned only where crc32(key as text) mod 4
    is not 2; held_out is that remainder's flag. Every row gets a score, repeated rows each; null and empty texts get the score of a text without n-grams. A null key is held_out false
    and never trains. Without labels, or with a single class, all scores are one constant. Other columns are not read; an empty table gives an
    empty result.
    """
    held = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, ~held, key, text, label))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            scores = pa.array([model.value.score(grams.buckets(t.as_py())) for t in batch.column(2)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], ["id", "held_out", "score"])

    rows = docs.select(F.col(key).alias("id"), held.alias("held_out"), F.col(text).alias("text"))
    scored = rows.mapInArrow(score, f"id {docs.schema[key].dataType.simpleString()}, held_out boolean, score double")
    return scored.select(F.col("id").alias(key), "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
