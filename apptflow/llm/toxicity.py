"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words adds up, over all letter triples that occur in both in order
and within ``REACH`` letters, a weight that falls by ``DECAY`` with each letter
skipped, divided by what words of their lengths can have at most. A letter that was
put in or left out costs some triples, not the match. Characters that are no letters
are left out and runs of single letters are one word, so "i-d-i" and "i d i" are "idi".

A word begins and ends with a mark, so a part of a word is not the word.

Words of labelled sentences are compared with landmark words (Nyström). A sentence of a
toxic document is toxic only in some word, which nobody marked; the word that stands
for it is chosen by the machine and the machine trained again (``ROUNDS`` times), beside
all words that toxic documents have far more often than chance explains.

The same kernel one level up compares stretches of ``SPAN`` words by the word pairs in
them: pairs in order, up to ``GAP`` words apart, weighted down with each word skipped. Its
landmarks are stretches of labelled sentences, its features the pairs that toxic documents
have far more often than chance explains, so an insult of ordinary words is found, also
with words in between. A text scores as its most toxic word or stretch.

A machine on Nyström features is a weighted sum over landmarks, each a sum over
triples (or pairs); both sums are merged into one weight per triple, so reading a text
costs a few look-ups per letter and word, whatever the number of landmarks. It is fitted on
a bounded sample of labelled rows (``SAMPLE_ROWS`` per label); every whole text is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import chunks, mix, plain, text_bytes
from apptflow.llm.labelled import labelled_sample

SAMPLE_ROWS = 1500
LANDMARKS = 256
ROUNDS = 3
REACH = 5
DECAY = 0.5
#: words of clean sentences that the machine learns from, most frequent first
CLEAN_WORDS = 12_000
COST = 10.0
#: words of a stretch, how far apart the words of a pair are, and numbers that pairs share
SPAN = 8
GAP = 3
PAIR_SLOTS = 1 << 18
#: pairs that the stretches are compared by, the most telling ones first
PAIRS = 2000

_PAIRS = [(j, k) for k in range(2, REACH) for j in range(1, k)]
_TRIPLES = 1 << 15

# letters are 1-26; digits and signs that stand for letters count as these; bytes of
# letters outside ASCII share the numbers from 27 on; the rest is no letter
_CODE = np.zeros(256, np.uint16)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
for _sign, _letter in zip("013457@$!", "oieastasi", strict=True):
    _CODE[ord(_sign)] = ord(_letter) - 96
_SIGN = np.zeros(256, bool)
_SIGN[[ord(s) for s in "@$!"]] = True
_CODE[128:] = 27 + np.arange(128) % 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Letters:
    """The letters of a chunk of text, cut into words and documents."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        known = _CODE[data] > 0
        # a sign stands for a letter only before one: "sh!t", not "home!"
        before = np.append(_CODE[data[1:]] * ~_SIGN[data[1:]] > 0, False) if len(data) else known
        at = np.flatnonzero(known & (~_SIGN[data] | before))
        self.code = _CODE[data[at]]
        doc = np.searchsorted(ends, at, "right") - 1
        gap = np.cumsum(_SPACE[data])[at] if len(at) else np.zeros(0, np.int64)
        new_doc, new = np.ones(len(at), bool), np.ones(len(at), bool)
        new_doc[1:] = doc[1:] != doc[:-1]
        new[1:] = (gap[1:] != gap[:-1]) | new_doc[1:]
        # a space between two single letters does not part words
        first = np.flatnonzero(new)
        single = np.diff(np.append(first, len(at))) == 1
        glued = np.zeros(len(first), bool)
        glued[1:] = single[1:] & single[:-1] & ~new_doc[first[1:]]
        new[first[glued]] = False
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        self.doc = doc[first]
        # a mark (0) before and after each word, so that a part of a word differs from it
        place = np.arange(len(first))
        self.first, self.size = first + 2 * place, size + 2
        self.word = np.repeat(place, self.size)
        code = np.zeros(len(at) + 2 * len(first), np.uint16)
        code[np.arange(len(at)) + 2 * np.repeat(place, size) + 1] = self.code
        self.code = code

    def triples(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(place of the first letter, triple, weight) for each pair of later letters."""
        c, word, n = self.code, self.word, len(self.code)
        for j, k in _PAIRS:
            if n <= k:
                continue
            at = np.flatnonzero(word[: n - k] == word[k:])
            yield at, (c[at] << 10) | (c[at + j] << 5) | c[at + k], DECAY ** (k - 2)

    def norm(self) -> np.ndarray:
        """The kernel's root for words whose triples all differ, by length."""
        return np.sqrt(_most(self.size))


def _most(size: np.ndarray) -> np.ndarray:
    total = np.zeros(len(size))
    for _, k in _PAIRS:
        total += np.maximum(size - k, 0) * DECAY ** (2 * (k - 2))
    return np.maximum(total, 1.0)


def _word_pairs(letters: Letters) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(first word, slot, weight) of pairs of words of one document, by distance."""
    if not len(letters.first):
        return
    at = np.arange(len(letters.code)) - letters.first[letters.word]
    letter = mix(letters.code.astype(np.uint64) + (at.astype(np.uint64) << np.uint64(8)))
    word = np.add.reduceat(letter, letters.first)
    for k in range(1, GAP + 1):
        first = np.flatnonzero(letters.doc[:-k] == letters.doc[k:])
        both = mix(word[first] * np.uint64(0x9E3779B97F4A7C15) + word[first + k])
        yield first, (both % np.uint64(PAIR_SLOTS)).astype(np.int64), DECAY ** (k - 1)


@dataclass
class Machine:
    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    pairs: np.ndarray | None = None
    pair_bias: float = -1.0

    def stretches(self, letters: Letters) -> np.ndarray:
        """The decision value of the stretch that begins at each word."""
        n = len(letters.first)
        total = np.zeros(n + 1)
        for first, slot, value in _word_pairs(letters):
            total[first] += self.pairs[slot] * value
        total = np.concatenate([[0.0], np.cumsum(total[:n])])
        end = np.searchsorted(letters.doc, letters.doc, "right")
        return total[np.minimum(np.arange(n) + SPAN, end)] - total[:n] + self.pair_bias

    def words(self, letters: Letters) -> np.ndarray:
        """The decision value of each word; over 0 is the toxic side."""
        sums = np.zeros(len(letters.code) + 1, np.float32)
        weight = self.weight
        for at, triple, value in letters.triples():
            sums[at] += weight[triple] * np.float32(value)
        if not len(letters.first):
            return np.zeros(0)
        return np.add.reduceat(sums[:-1], letters.first) / letters.norm() + self.bias

    def raw(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The decision value of each text: that of its most toxic word or stretch."""
        return self.values(Letters(data, ends), len(ends) - 1)

    def values(self, letters: Letters, texts: int) -> np.ndarray:
        out = np.full(texts, min(self.bias, -1.0))
        np.maximum.at(out, letters.doc, self.words(letters))
        if self.pairs is not None:
            np.maximum.at(out, letters.doc, self.stretches(letters))
        return out

    def score(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -40, 40)))


def _features(words: list[str]) -> np.ndarray:
    """Dense triple features of words, scaled to the kernel; few words only."""
    data, ends = _joined(words)
    letters = Letters(data, ends)
    out = np.zeros((len(words), _TRIPLES), np.float32)
    for at, triple, value in letters.triples():
        np.add.at(out, (letters.doc[letters.word[at]], triple), value)
    norm = np.ones(len(words))
    norm[letters.doc] = letters.norm()
    return out / norm[:, None].astype(np.float32)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(plain(pa.array(texts, pa.large_string())))


def _kernel(words: list[str], landmarks: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [_features(words[i : i + 500]) @ landmarks.T for i in range(0, len(words), 500)]
        or [np.zeros((0, len(landmarks)), np.float32)]
    ).astype(float)


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine by Newton steps on the active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        on = y * (x @ w) < 1
        a = x[on] * cost[on, None]
        new = np.linalg.solve(ridge + x[on].T @ a, a.T @ y[on])
        if np.abs(new - w).max() < 1e-6:
            break
        w = 0.5 * w + 0.5 * new
    return w[:-1], float(w[-1])


def _altered(word: str) -> list[str]:
    """A word with a letter put in, at three places; the letter follows from the word."""
    if len(word) < 5:
        return []
    cuts = sorted({1 + (len(word) * k) // 4 for k in (1, 2, 3)} - {len(word)})
    return [word[:c] + "xqzkw"[(len(word) + c) % 5] + word[c:] for c in cuts]


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_STRIP = ".,;:!?\"'()[]{}|%&$#*-_"


def _split(text: str) -> set[str]:
    return {w.strip(_STRIP).lower() for w in _WORD.findall(text)} - {""}


def _telling(
    bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of being in toxic texts, which things these have more often than chance
    explains given how many things are looked at, and their log-likelihood ratio."""
    odds = np.log((bad + 0.3) / n_bad) - np.log((good + 0.3) / n_good)
    seen, rows = bad + good, n_bad + n_good
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(bad > 0, bad * np.log(bad / (seen * n_bad / rows)), 0.0) + np.where(
            good > 0, good * np.log(good / (seen * n_good / rows)), 0.0
        )
    ratio = 2 * np.nan_to_num(ratio)
    return odds, (ratio > 2 * np.log(max(2, len(seen)))) & (odds > 1.5), ratio


def _some_at_a_time(texts: list[str], size: int = 1 << 20) -> Iterator[tuple[int, Letters]]:
    """The letters of the texts, some megabytes of text at a time, and the first one's place."""
    begin = 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (end == begin or held + len(texts[end]) <= size):
            held += len(texts[end])
            end += 1
        yield begin, Letters(*_joined(texts[begin:end]))
        begin = end


def _plain_pairs(letters: Letters, machine: Machine) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Word pairs without a word that the machine finds toxic by itself."""
    if not len(letters.first):
        return
    good = machine.words(letters) <= 0
    for k, (first, slot, value) in enumerate(_word_pairs(letters), 1):
        keep = good[first] & good[first + k]
        yield first[keep], slot[keep], value


def _stretches(
    letters: Letters, machine: Machine, number: np.ndarray, width: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(document, rows of pair weights) of the stretches that begin with a numbered pair."""
    rows, columns, values = [], [], []
    for first, slot, value in _plain_pairs(letters, machine):
        hit = number[slot] >= 0
        rows.append(first[hit])
        columns.append(number[slot[hit]])
        values.append(np.full(int(hit.sum()), value, np.float32))
    if not rows or not sum(map(len, rows)):
        return
    row, column, value = np.concatenate(rows), np.concatenate(columns), np.concatenate(values)
    order = np.argsort(row, kind="stable")
    row, column, value = row[order], column[order], value[order]
    begins = np.unique(row)
    doc = letters.doc[begins]
    end = np.minimum(begins + SPAN, np.searchsorted(letters.doc, doc, "right"))
    low, high = np.searchsorted(row, begins), np.searchsorted(row, end)
    for d in np.unique(doc).tolist():
        own = np.flatnonzero(doc == d)
        out = np.zeros((len(own), width), np.float32)
        for i, b in enumerate(own.tolist()):
            np.add.at(out[i], column[low[b] : high[b]], value[low[b] : high[b]])
        yield d, out


def _fit_pairs(texts: list[str], y: np.ndarray, machine: Machine) -> tuple[np.ndarray | None, float]:
    """A weight per slot of word pairs and a bias, or none if no pair tells anything.

    Pairs with a word that the machine finds toxic by itself are left to it.
    """
    seen = [np.zeros(0, np.int64)]
    for begin, letters in _some_at_a_time(texts):
        for first, slot, _ in _plain_pairs(letters, machine):
            seen.append(np.unique((letters.doc[first] + begin) * PAIR_SLOTS + slot))
    in_text = np.unique(np.concatenate(seen))
    slots, label = in_text % PAIR_SLOTS, y[in_text // PAIR_SLOTS]
    bad = np.bincount(slots[label == 1], minlength=PAIR_SLOTS)
    good = np.bincount(slots[label == 0], minlength=PAIR_SLOTS)
    seen = np.flatnonzero(bad + good)
    _, sure, ratio = _telling(bad[seen], good[seen], int(y.sum()), int(len(y) - y.sum()))
    chosen = np.flatnonzero(sure)
    chosen = seen[chosen[np.argsort(-ratio[chosen], kind="stable")][:PAIRS]]
    if not len(chosen):
        return None, -1.0

    # stretches by the chosen pairs: the best one of each toxic text, and those of clean texts
    # that have such a pair
    number = np.full(PAIR_SLOTS, -1)
    number[chosen] = np.arange(len(chosen))
    good_rows, bad_rows = [], []
    for begin, letters in _some_at_a_time(texts):
        for doc, stretch in _stretches(letters, machine, number, len(chosen)):
            if y[begin + doc] == 1:
                bad_rows.append(stretch[np.argmax(stretch.sum(axis=1))])
            else:
                good_rows += list(stretch)
        if len(good_rows) > 4 * SAMPLE_ROWS:  # they are wide
            good_rows = good_rows[::2]
    none = np.zeros(len(chosen), np.float32)  # all other stretches have none of the pairs
    x = np.stack([*bad_rows, *good_rows, none])
    side = np.array([1.0] * len(bad_rows) + [-1.0] * (len(good_rows) + 1))
    z = np.unique(x[:-1], axis=0)
    z = z[:: max(1, len(z) // LANDMARKS)][:LANDMARKS]
    val, vec = np.linalg.eigh((z @ z.T).astype(float) + 1e-6 * np.eye(len(z)))
    root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-4))) @ vec.T
    # with a word put in between, pairs of a stretch count less
    apart = DECAY * x[:-1][side[:-1] > 0]
    cost = np.concatenate([np.full(len(x) - 1, COST), [COST * len(x)], np.full(len(apart), COST / 4)])
    x, side = np.vstack([x, apart]), np.append(side, np.ones(len(apart)))
    w, bias = _svm((x @ z.T).astype(float) @ root, side, cost)
    pairs = np.zeros(PAIR_SLOTS, np.float32)
    pairs[chosen] = (root @ w) @ z
    return pairs, float(min(bias, -0.5))


def fit(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS) -> Machine:
    """The machine of labelled texts; one that says 0.5 or less if a label is missing."""
    y = np.array(toxic)
    none = Machine(np.zeros(_TRIPLES, np.float32), 0.0, 0.0, 0.0 if y.mean() > 0.5 else -1e-9) if len(y) else None
    if none is None or y.min() == y.max():
        return none or Machine(np.zeros(_TRIPLES, np.float32), 0.0, 0.0, -1e-9)
    ids: dict[str, int] = {}
    own = [np.unique([ids.setdefault(w, len(ids)) for w in _split(t)]).astype(np.int64) for t in texts]
    words = list(ids)
    in_text = np.bincount(np.concatenate(own), minlength=len(words)) if words else np.zeros(0)
    bad = np.bincount(np.concatenate([o for o, t in zip(own, toxic, strict=True) if t]), minlength=len(words))
    good = in_text - bad
    n_bad, n_good = int(y.sum()), int(len(y) - y.sum())
    long = np.array([len(w) >= 3 for w in words])
    odds, sure, _ = _telling(bad, good, n_bad, n_good)
    sure &= long
    value = np.where(sure, odds, -9.0)
    clean = [i for i in np.lexsort((np.arange(len(words)), -good)).tolist() if good[i] and long[i]]
    machine = None
    hard: list[int] = []
    for step in range(ROUNDS):
        chosen: Counter = Counter()
        for o, label in zip(own, toxic, strict=True):
            if label and len(o):
                best = int(o[np.argmax(value[o])])
                # a word that clean texts have as often stands for nothing
                if value[best] > (0.0 if step else 1.5) and odds[best] > 0.7 and bad[best] >= 2:
                    chosen[best] += 1
        # words that toxic texts have far more often than chance explains count in all of
        # them, also where another word was chosen
        for i in np.flatnonzero(sure).tolist():
            chosen[i] = max(chosen[i], int(bad[i]))
        if not chosen:
            break
        pos = sorted(chosen, key=lambda i: (-chosen[i], words[i]))[: landmarks * 4]
        rest = [i for i in clean if i not in chosen]
        neg = rest[: CLEAN_WORDS // 2]
        tail = rest[CLEAN_WORDS // 2 :]
        neg += tail[:: max(1, len(tail) // (CLEAN_WORDS // 2))]
        neg = list(dict.fromkeys([*neg, *(i for i in hard if i not in chosen)]))
        marks = pos[: landmarks // 2]
        marks += neg[:: max(1, len(neg) // (landmarks - len(marks)))][: landmarks - len(marks)]
        z = _features([words[i] for i in marks])
        val, vec = np.linalg.eigh((z @ z.T).astype(float) + 1e-6 * np.eye(len(marks)))
        root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-4))) @ vec.T
        altered = [v for i in pos for v in _altered(words[i])]
        x = _kernel([*(words[i] for i in pos), *altered, *(words[i] for i in neg)], z) @ root
        side = np.array([1.0] * (len(pos) + len(altered)) + [-1.0] * len(neg))
        heavy = COST * max(1.0, len(neg) / len(pos) / 10)
        cost = np.array([heavy] * len(pos) + [heavy / 8] * len(altered) + [COST] * len(neg))
        w, bias = _svm(x, side, cost)
        machine = Machine(((root @ w) @ z).astype(np.float32), bias, 1.0, 0.0)
        value = np.concatenate(
            [machine.raw(*_joined(words[i : i + 50_000])) for i in range(0, len(words), 50_000)]
        )
        # clean words that it takes for toxic ones, to learn from in the next round
        near = np.flatnonzero((value > -0.8) & (odds < 0.7) & (good > 0))
        hard = near[np.argsort(-value[near], kind="stable")][:CLEAN_WORDS].tolist()
    if machine is None:
        machine = Machine(np.zeros(_TRIPLES, np.float32), -1.0, 1.0, 0.0)
    weight, bias = machine.weight, machine.bias
    pairs, pair_bias = _fit_pairs(texts, y, machine)
    if pairs is None and not weight.any():
        return Machine(np.zeros(_TRIPLES, np.float32), 0.0, 0.0, none.shift)

    # decision values to probabilities, labels as frequent as they are in the sample
    whole = Machine(weight, bias, 1.0, 0.0, pairs, pair_bias)
    raw = np.full(len(texts), min(bias, -1.0))
    for begin, letters in _some_at_a_time(texts):
        size = int(letters.doc[-1]) + 1 if len(letters.doc) else 0
        raw[begin : begin + size] = whole.values(letters, size)
    share = np.full(len(y), 1 / len(y))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -40, 40)))
        g = share * (p - y)
        h = share * p * (1 - p) + 1e-9
        hess = np.array([[(h * raw * raw).sum() + 1e-4, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, [(g * raw).sum() + 1e-4 * a, g.sum()])
        a, b = a - 0.5 * move[0], b - 0.5 * move[1]
    return Machine(weight, bias, float(max(a, 1e-3)), float(b), pairs, pair_bias)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fits on the labels of rows that are not held out."""
    return fit(*labelled_sample(docs, labels, "toxic", sample_rows))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, _th and score (0 to 1) for every row; only the text is looked at.

    A null text, an empty one and one without a letter score like a text without any
    toxic word. Repeated rows each get a row. An empty table gives an empty result. Other
    columns are ignored, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for whole in parts:
            for part in chunks(whole):
                value = own.score(own.raw(*text_bytes(plain(part.column("text")))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_th"), pa.array(value)], ["doc_id", "_th", "score"]
                )

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_th"),
    )
    return rows.mapInArrow(batch, "doc_id long, _th long, score double")
