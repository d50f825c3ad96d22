"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

P(grade > g_k | text) = sigmoid(w.x - t_k) with one weight vector shared by all grades and ordered thresholds t_1 < t_2
< ...; x are shares of hashed word, word-shape and word-ending features. Expected grade and tail probability follow.

The model is fit on at most `SAMPLE` rated ids (by hash of the id), one text each, collected as sparse counts of at most
`WIDTH` buckets, so the driver's work is bounded; every text is scored whole, one pass, no shuffle. A word's summed weight is kept in a bounded per-worker
table, so scoring costs one look-up for each word.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass
from itertools import groupby, islice
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import appended, map_texts, one_text_each, table

SAMPLE = 4_000
WIDTH = 1 << 16
KEPT = 200_000
ROUNDS = 150
#: Shares are small; scaled up so that weights stay of order one.
SCALE = 8.0


def shape(word: str) -> str:
    """Letters as X, x and digits as 9, runs cut to two: "Onndble###" is "Xxx##"."""
    coded = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return "".join(c * min(2, len(list(g))) for c, g in groupby(coded))


def features(word: str) -> tuple[int, int, int]:
    """Hash buckets of a word: itself in lower case, its shape, its shape's last two characters with the length class."""
    s = shape(word)
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % WIDTH for x in ("w" + word.lower(), "s" + s, "e" + s[-2:] + str(min(len(word) // 4, 4))))


#: Bucket of the share of words that repeat the one before.
REPEATS = zlib.crc32(b"repeats") % WIDTH


def repeats(words: list[str]) -> float:
    return sum(map(eq, words, islice(words, 1, None))) / len(words)


def shares(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and shares of a text; none for a null or wordless one."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    i, n = np.unique([i for w in words for i in features(w)], return_counts=True)
    return np.append(i, REPEATS), np.append(n / n.sum(), repeats(words))


@dataclass
class OrdinalModel:
    """Shared weights, ordered thresholds, and the grades they part."""

    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade > grades[k]) for each score (row) and k (column)."""
        return 1 / (1 + np.exp(-np.clip(s[:, None] - self.thresholds[None, :], -40, 40)))

    def expected(self, s: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(s) @ np.diff(self.grades) if len(self.grades) > 1 else np.full(len(s), self.grades[0])


def fit(rows: list[np.ndarray], values: list[np.ndarray], ratings: np.ndarray, rounds: int = ROUNDS, decay: float = 1e-4) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam. rows and values: buckets and shares of each text; ratings: its grade.

    No ratings give weights of zero and one grade, 0; a single grade gives that grade for any text.
    """
    grades = sorted({float(r) for r in ratings}) or [0.0]
    k = len(grades) - 1
    if k == 0:
        return OrdinalModel(grades, np.zeros(WIDTH, np.float32), np.zeros(0))
    y = np.searchsorted(grades, ratings.astype(float))
    idx, val = np.concatenate(rows), np.concatenate(values) * SCALE
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    above = (y[:, None] > np.arange(k)[None, :]).astype(float)
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(WIDTH), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, t = theta[:WIDTH], theta[WIDTH] + np.concatenate([[0.0], np.cumsum(np.exp(theta[WIDTH + 1 :]))])
        s = np.bincount(row, weights=w[idx] * val, minlength=len(rows))
        # Likelihood of the cumulative link: P(y = j) = F_j - F_{j+1}, F_0 = 1, F_{k+1} = 0.
        tail = 1 / (1 + np.exp(-np.clip(s[:, None] - t[None, :], -40, 40)))
        full = np.concatenate([np.ones((len(s), 1)), tail, np.zeros((len(s), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(s), 1)), tail * (1 - tail), np.zeros((len(s), 1))], axis=1)
        at = np.arange(len(s))
        prob = np.maximum(full[at, y] - full[at, y + 1], 1e-12)
        up, down = slope[at, y] / prob, slope[at, y + 1] / prob
        ds = (up - down) / len(s)  # d log-likelihood / d score
        dt = np.zeros((len(s), k + 2))
        dt[at, y] -= up
        dt[at, y + 1] += down
        dt = dt[:, 1:-1].sum(axis=0) / len(s)
        gaps = np.cumsum(dt[::-1])[::-1]
        grad = np.concatenate([np.bincount(idx, weights=val * ds[row], minlength=WIDTH) - decay * w, [gaps[0]], gaps[1:] * np.exp(theta[WIDTH + 1 :])])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    t = theta[WIDTH] + np.concatenate([[0.0], np.cumsum(np.exp(theta[WIDTH + 1 :]))])
    return OrdinalModel(grades, theta[:WIDTH].astype(np.float32), t)


class _Sums(dict):
    """word -> its summed weight."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        got = float(sum(self.weights[i] for i in features(word)))
        if len(self) < KEPT:
            self[word] = got
        return got


def score_text(sums: _Sums, text: str | None) -> float:
    words = (text or "").split()
    if not words:
        return 0.0
    return SCALE * (sum(map(sums.__getitem__, words)) / (3 * len(words)) + float(sums.weights[REPEATS]) * repeats(words))


def train(docs: DataFrame, ratings: DataFrame, rating_col: str, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> OrdinalModel:
    """Fit on at most `sample` rated ids; rows without id or rating are no ratings, unknown ids have no text.

    An id rated several times has the highest of its ratings; of an id's several rows one counts, by hash of the text.
    """
    rated = ratings.where(F.col(id_col).isNotNull() & F.col(rating_col).isNotNull()).select(F.col(id_col).cast("long").alias("r_id"), F.col(rating_col).cast("double").alias("r"))
    rows = one_text_each(docs, rated.groupBy("r_id").agg(F.max("r").alias("r")), "r_id", id_col, text_col, sample)

    def work(cols):
        found = [shares(t) for t in cols[0]]
        return [[i.tolist() for i, _ in found], [n.tolist() for _, n in found], cols[1]]

    got = map_texts(rows.select("t", "r"), "idx array<int>, share array<float>, r double", work).toPandas()
    return fit([np.array(x, dtype=np.int64) for x in got["idx"]], [np.array(x, dtype=np.float64) for x in got["share"]], got["r"].to_numpy())


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """docs with expected_grade double and p_top double (probability of the highest grade); clashing columns are replaced.

    A null or wordless text is scored by the thresholds alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tag = uuid.uuid4().hex  # workers live on: their tables are for one model

    def work(cols):
        m = shared.value
        sums = table("quality", tag, lambda: _Sums(m.weights))
        s = np.array([score_text(sums, t) for t in cols[0]], dtype=np.float64)
        top = m.tails(s)[:, -1] if len(m.grades) > 1 else np.ones(len(s))
        return [m.expected(s).tolist(), top.tolist()]

    return appended(docs, [text_col], "expected_grade double, p_top double", work)


def select(docs: DataFrame, ratings: DataFrame, rating_col: str, least: float = 0.5, **options) -> DataFrame:
    """score() after train(), with keep boolean: the tail probability of the highest grade is `least` or more."""
    model = train(docs, ratings, rating_col, **options)
    own = [c for c in docs.columns if c.lower() != "keep"]
    return score(docs.select(own), model).withColumn("keep", F.col("p_top") >= least)
