"""Quality by ordinal cumulative-link regression on graded ratings.

All grades share one weight per hashed text feature; each grade but the lowest has a
threshold, and the thresholds keep their order. The chance that a text reaches a grade
is the logistic of its score less that grade's threshold, which gives the expected
grade and the tail probability that selects documents.

Features are counted per occurrence and averaged over the text: runs of three
character classes (punctuation signs stand for themselves), hashed words, and words
that repeat one of their neighbours. It is fitted on a bounded sample of rated rows
(``SAMPLE_ROWS`` per grade); every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import Words, chunks, plain, text_bytes
from apptflow.llm.labelled import labelled_sample

SAMPLE_ROWS = 2500
ROUNDS = 300
RATE = 0.3
SHRINK = 1e-5

_CLASS = np.full(256, 7, np.int32)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
_CLASS[[32, 10]] = 4, 5
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 16 + np.arange(32)
_RUNS = 1 << 18
_WORDS = 1 << 16
_NEAR = 4
SIZE = _RUNS + _WORDS + _NEAR
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def _features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(document, feature) of every occurrence, for each of the two kinds."""
    data, ends = text_bytes(column)
    kind = _CLASS[data]
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.flatnonzero(doc[:-2] == doc[2:]) if len(doc) > 2 else np.zeros(0, np.int64)
    runs = (doc[at], (kind[at] << 12) | (kind[at + 1] << 6) | kind[at + 2]) if len(at) else (at, at)
    words = Words(column, _WORD)
    h = words.hashes()
    owner = words.doc()
    own = [(owner, _RUNS + (h % np.uint64(_WORDS)).astype(np.int64))]
    for step in range(1, _NEAR):
        same = np.flatnonzero(h[step:] == h[:-step]) if len(h) > step else np.zeros(0, np.int64)
        same = same[owner[same] == owner[same + step]]
        own.append((owner[same], np.full(len(same), _RUNS + _WORDS + step)))
    return [runs, (np.concatenate([o[0] for o in own]), np.concatenate([o[1] for o in own]))]


@dataclass
class Ordinal:
    grades: list[int]
    weight: np.ndarray
    thresholds: np.ndarray

    def reach(self, column: pa.Array) -> np.ndarray:
        """Chance of each text to reach each grade but the lowest."""
        n = len(column)
        score = np.zeros(n)
        for doc, feature in _features(column):
            many = np.maximum(np.bincount(doc, minlength=n), 1)
            score += np.bincount(doc, self.weight[feature], n) / many
        return _logistic(score[:, None] - self.thresholds[None, :])

    def expected(self, reach: np.ndarray) -> np.ndarray:
        if not self.grades:
            return np.full(len(reach), np.nan)
        return self.grades[0] + reach @ np.diff(np.array(self.grades, float))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(texts: list[str], ratings: list[int]) -> Ordinal:
    """Weights and thresholds by gradient steps on the likelihood of the grades."""
    grades = sorted(set(ratings))
    if len(grades) < 2:
        return Ordinal(grades, np.zeros(SIZE), np.zeros(0))
    rank = np.searchsorted(grades, ratings)
    column = plain(pa.array(texts, pa.large_string()))
    docs, features, values = [], [], []
    for at in range(0, len(texts), 200):
        part = column.slice(at, 200)
        for doc, feature in _features(part):
            many = np.bincount(doc, minlength=len(part))
            pair, count = np.unique(doc * SIZE + feature, return_counts=True)
            docs.append(pair // SIZE + at)
            features.append(pair % SIZE)
            values.append(count / many[pair // SIZE])
    doc, feature, value = (np.concatenate(x) for x in (docs, features, values))
    used, feature = np.unique(feature, return_inverse=True)

    n, k = len(texts), len(grades) - 1
    w = np.zeros(len(used))
    start = np.array([(rank > j).mean() for j in range(k)])
    cuts = -np.log(start / (1 - start))
    cuts = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.05))])
    state = [np.zeros(len(used) + k), np.zeros(len(used) + k)]
    for step in range(1, ROUNDS + 1):
        gaps = np.exp(cuts[1:])
        theta = cuts[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(doc, value * w[feature], n)
        low = np.where(rank > 0, _logistic(score - theta[np.maximum(rank - 1, 0)]), 1.0)
        high = np.where(rank < k, _logistic(score - theta[np.minimum(rank, k - 1)]), 0.0)
        chance = np.maximum(low - high, 1e-9)
        # slope of log(low - high) by the score, and by each of the two thresholds
        up, down = low * (1 - low) / chance, high * (1 - high) / chance
        g_score = up - down
        g_theta = np.bincount(rank, down, k + 1)[:k] - np.bincount(rank, up, k + 1)[1:]
        g_cuts = np.concatenate([[g_theta.sum()], [g_theta[j + 1 :].sum() * gaps[j] for j in range(k - 1)]])
        grad = np.concatenate([np.bincount(feature, value * g_score[doc], len(used)) / n - SHRINK * w, g_cuts / n])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = state[0] / (1 - 0.9**step) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-7)
        w += RATE * move[: len(used)]
        cuts += 0.1 * RATE * move[len(used) :]
    weight = np.zeros(SIZE)
    weight[used] = w
    return Ordinal(grades, weight, cuts[0] + np.concatenate([[0.0], np.cumsum(np.exp(cuts[1:]))]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ordinal:
    """Fits on the ratings of rows that are not held out."""
    return fit(*labelled_sample(docs, labels, "quality", sample_rows))


def grade(docs: DataFrame, model: Ordinal, at_least: int | None = None) -> DataFrame:
    """doc_id, _th, expected_grade, tail_prob and selected for every row.

    ``tail_prob`` is the chance to reach grade ``at_least`` (by default the highest);
    rows with 0.5 or more are selected. A null text counts as an empty one, whose score
    is zero. Repeated rows each get a row. Without two grades to learn from the
    expected grade is the only grade (null if there is none) and all rows are selected.
    An empty table gives an empty result. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    wanted = at_least if at_least is not None or not model.grades else model.grades[-1]

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        higher = [i for i, g in enumerate(own.grades[1:]) if wanted is not None and g >= wanted]
        for whole in parts:
            for part in chunks(whole):
                reach = own.reach(plain(part.column("text")))
                tail = reach[:, higher[0]] if higher else np.ones(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_th"),
                        pa.array(own.expected(reach), from_pandas=True),
                        pa.array(tail),
                        pa.array(tail >= 0.5),
                    ],
                    ["doc_id", "_th", "expected_grade", "tail_prob", "selected"],
                )

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_th"),
    )
    return rows.mapInArrow(
        batch, "doc_id long, _th long, expected_grade double, tail_prob double, selected boolean"
    )
