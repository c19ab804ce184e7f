"""Language identification with word-first backoff.

A word that the model knows adds its log frequency in each language. A word it does
not know is cut into its longest known character n-grams: at each place the longest
n-gram (of at most ``ORDER`` characters) that the model has is taken, shorter ones only
where it lacks the longer, each step back with a discount. The language with the
highest total wins; the score is its share among all languages.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` per language,
chosen by a hash of the id) and has at most ``MAX_WORDS`` words and ``MAX_GRAMS``
n-grams, so what the tasks receive does not grow with the corpus. Prediction reads
every whole text.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import chunks, give_back, lean, plain

#: labelled rows per language that the model is fitted on, and how many words and n-grams of
#: them it holds, dealt out to the languages in equal parts
SAMPLE_ROWS = 3000
MAX_WORDS = 60_000
MAX_GRAMS = 200_000
ORDER = 5
BACKOFF = 0.4
#: a word outside the model counts less than one in it
UNSEEN_WEIGHT = 0.5
MEMO_WORDS = 100_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
# word characters that are neither letters nor digits, such as ², ½ and Ⅷ
_NUMBERS = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not (c.isalpha() or c.isdecimal())
)
_BLANKED = {ord(c): " " for c in _NUMBERS}


def words_of(text: str) -> list[str]:
    """The runs of letters in a text."""
    if not text.isascii() and not _NUMBERS.isdisjoint(text):
        text = text.translate(_BLANKED)
    return _LETTERS.findall(text)


@dataclass
class Model:
    """Per-language log probabilities: rows of ``table`` are words, then n-grams."""

    langs: list[str]
    word_rows: dict[str, int]
    words: np.ndarray
    gram_rows: dict[str, int]
    grams: np.ndarray
    floor: float
    #: rows of all words met so far by this worker, those of the model first
    memo: dict[str, int] = field(default_factory=dict, repr=False)
    scores: np.ndarray | None = field(default=None, repr=False)

    def _meet(self, new: list[str]) -> None:
        """Gives words outside the model their rows: log scores by their n-grams."""
        known, missing = self.gram_rows, len(self.grams)
        rows, steps, cut = [], [], [0]
        for word in new:
            text, at = f"^{word}$", 0
            while at < len(text):
                for n in range(min(ORDER, len(text) - at), 0, -1):
                    row = known.get(text[at : at + n])
                    if row is not None:
                        break
                else:
                    row, n = missing, 1
                rows.append(row)
                steps.append(ORDER - n)
                at += n
            cut.append(len(rows))
        grams = np.concatenate([self.grams, np.full((1, len(self.langs)), self.floor)])
        parts = grams[rows] + (np.array(steps) * math.log(BACKOFF))[:, None]
        first = len(self.memo)
        self.scores[first : first + len(new)] = UNSEEN_WEIGHT * np.add.reduceat(parts, cut[:-1])
        for i, word in enumerate(new):
            self.memo[word] = first + i

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each whole text."""
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        words = [words_of(t.lower()) for t in texts]
        found: list[tuple[str, float]] = []
        for at in range(0, len(words), 64):
            new = {w for ws in words[at : at + 64] for w in ws} - self.memo.keys()
            if self.scores is None or len(self.memo) + len(new) > len(self.scores):
                new = {w for ws in words[at : at + 64] for w in ws} - self.word_rows.keys()
                self.memo = dict(self.word_rows)
                room = np.zeros((max(MEMO_WORDS, len(new)), len(self.langs)))
                self.scores = np.concatenate([self.words, room])
            if new:
                self._meet(sorted(new))
            found += [self._decide(ws) for ws in words[at : at + 64]]
        return [f[0] for f in found], [f[1] for f in found]

    def _decide(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNKNOWN, 0.0
        ids = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        total = self.scores[ids].sum(axis=0)
        share = np.exp(total - total.max())
        best = int(total.argmax())
        return self.langs[best], float(share[best] / share.sum())


def fit(texts: list[str], labels: list[str]) -> Model:
    """The model of labelled texts; ties in the counts are cut off in word order."""
    langs = sorted(set(labels))
    words: dict[str, Counter] = {g: Counter() for g in langs}
    for text, lang in zip(texts, labels, strict=True):
        words[lang].update(words_of(text.lower()))

    def rows(counts: dict[str, Counter], most: int, least: int) -> tuple[dict[str, int], np.ndarray]:
        total = Counter()
        for c in counts.values():
            total.update(c)
        # each language has its share of the places: a small one does not lose its words
        kept = set()
        for c in counts.values():
            own = sorted((w for w in c if total[w] >= least), key=lambda w: (-c[w], w))
            kept.update(own[: most // len(langs)])
        kept = sorted(kept, key=lambda w: (-total[w], w))
        have = np.array([[counts[g][w] for g in langs] for w in kept], float).reshape(-1, len(langs))
        size = np.array([max(1, sum(counts[g].values())) for g in langs], float)
        return {w: i for i, w in enumerate(kept)}, np.log((have + 0.1) / (size + 0.1 * max(1, len(kept))))

    word_rows, word_table = rows(words, MAX_WORDS, 2)
    # n-grams are compared within their length; those of one length at a time are held
    gram_rows: dict[str, int] = {}
    tables = []
    for size in range(1, ORDER + 1):
        grams: dict[str, Counter] = {g: Counter() for g in langs}
        for lang in langs:
            for word, n in words[lang].items():
                marked = f"^{word}$"
                for i in range(len(marked) - size + 1):
                    grams[lang][marked[i : i + size]] += n
        names, log_p = rows(grams, MAX_GRAMS // ORDER, 1 if size < 3 else 3)
        gram_rows |= {g: i + len(gram_rows) for g, i in names.items()}
        tables.append(log_p)
    gram_table = np.concatenate(tables) if tables else np.zeros((0, len(langs)))
    return Model(langs, word_rows, word_table, gram_rows, gram_table, -20.0)


def held_out(doc_id: Column | str) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on about ``sample_rows`` rows per language, those with the lowest hash.

    Never on more than twice as many in all. Languages are few, as labels of a model.
    """
    rows = docs.where("lang is not null and text is not null").where(
        ~F.coalesce(held_out("doc_id"), F.lit(True))
    )
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("language"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)), -20.0)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    part = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    sample = rows.select("text", "lang", order.alias("_o"), part.alias("_p")).where(F.col("_p") < share)
    # a firm bound, should many rows share an id
    sample = sample.orderBy("_o", "text").limit(2 * sample_rows * len(counts)).select("text", "lang")
    got = sample.toArrow()
    texts, labels = got.column("text").to_pylist(), got.column("lang").to_pylist()
    del got
    model = fit(texts, labels)
    del texts, labels
    give_back()
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, _th, lang_pred, score for every row; only the text is looked at.

    A null text or one without a letter is ``und`` with score 0. Repeated rows each get
    a row. An empty table gives an empty result; a model without a language says
    ``und`` throughout. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for whole in parts:
            for part in chunks(whole):
                texts = plain(part.column("text")).cast(pa.large_string()).to_pylist()
                lang, score = own.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_th"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "_th", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_th"),
    )
    return rows.mapInArrow(lean(batch), "doc_id long, _th long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` in one of the model's languages, all columns unchanged.

    Texts without a letter go, as they are ``und`` for ``predict`` too, and those that no
    language explains with a share of ``min_score``, if one is given. A model without a language rejects nothing that has a letter.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for whole in parts:
            for part in chunks(whole):
                texts = plain(part.column("text")).cast(pa.large_string()).to_pylist()
                if own.langs:
                    lang, score = own.predict(texts)
                    keep = [g != UNKNOWN and s >= min_score for g, s in zip(lang, score, strict=True)]
                else:
                    keep = [bool(words_of(t)) for t in texts]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(lean(batch), docs.schema)
