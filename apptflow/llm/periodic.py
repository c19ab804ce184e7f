"""Periodic runs of words, found with string synchronising sets.

A run is a longest stretch with a smallest period of which it holds two at least. For
each scale t = 1, 2, 4, ... the runs with periods from 3t to 6t - 1 are found:

* every window of t words gets a hash; position i belongs to the synchronising set if
  the smallest hash in i..i+t is that at i or at i+t. Membership depends on the 2t
  words from i on alone, so a run that repeats those words repeats the membership.
  Windows with a period of at most t/3 have no say;
* members less than 6t apart with equal 2t words (the context) propose their distance;
* what such windows hide is a run that consists of two touching stretches with one
  small period. These highly periodic regions are runs of earlier scales; each
  neighbouring pair supplies the distances that bring them into step.

A proposal is extended to both sides as far as words repeat at its distance and is a run
if it is two periods long. Of equal stretches the smallest period counts. Periods 1 and 2
are found by comparing neighbours.

Words are numbered by text, so equality is exact; windows are compared by a pair of
hashes modulo two primes. A document is one task's work and others are batched with it,
longest first: a scale looks at the documents that are long enough for it, and all of
its steps are array operations over the batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from apptflow.llm.common import chunks, keyed, mix, plain, sliding_min

LEAST = 12

# ------------------------------------------------------------------ window hashes

_PRIMES = (2147483647, 2147483629)
_BASES = (1048583331, 1791791823)


class Spans:
    """Compares stretches of a sequence of numbers."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.sums, self.powers = [], []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            p = np.uint64(prime)
            power = np.ones(1, np.uint64)
            step = np.uint64(base)
            while len(power) <= self.n:
                power = np.concatenate([power, power * step % p])
                step = step * step % p
            codes = mix(values.astype(np.uint64) + np.uint64(prime)) % p
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * power[: self.n] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, length) -> np.ndarray:
        """Whether the ``length`` values from a and from b on (a <= b) are equal."""
        out = None
        for prime, sums, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            p = np.uint64(prime)
            one = (sums[a + length] + p - sums[a]) * power[b - a] % p
            two = (sums[b + length] + p - sums[b]) % p
            out = one == two if out is None else out & (one == two)
        return out

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many values from a and b on are equal (a < b)."""
        done = np.zeros(len(a), np.int64)
        for k in range(max(self.n, 1).bit_length() - 1, -1, -1):
            step = 1 << k
            fits = np.flatnonzero(b + done + step <= self.n)
            ok = fits[self.same(a[fits] + done[fits], b[fits] + done[fits], step)]
            done[ok] += step
        return done

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many values before a and b are equal (a < b)."""
        done = np.zeros(len(a), np.int64)
        for k in range(max(self.n, 1).bit_length() - 1, -1, -1):
            step = 1 << k
            fits = np.flatnonzero(a - done - step >= 0)
            ok = fits[self.same(a[fits] - done[fits] - step, b[fits] - done[fits] - step, step)]
            done[ok] += step
        return done


# --------------------------------------------------------------------------- runs


@dataclass
class Runs:
    """Stretches ``start`` to ``end`` (past the last) with their smallest periods."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray

    def where(self, keep: np.ndarray) -> Runs:
        return Runs(self.start[keep], self.end[keep], self.period[keep])

    def merged(self, other: Runs) -> Runs:
        """Both, by start and end; of equal stretches the one with the smaller period."""
        start = np.concatenate([self.start, other.start])
        end = np.concatenate([self.end, other.end])
        period = np.concatenate([self.period, other.period])
        order = np.lexsort((period, end, start))
        all_of = Runs(start[order], end[order], period[order])
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(all_of.start) != 0) | (np.diff(all_of.end) != 0)
        return all_of.where(first)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _neighbours(values: np.ndarray) -> Runs:
    """The runs with periods 1 and 2."""
    none = np.zeros(0, np.int64)
    out = Runs(none, none, none)
    for p in (1, 2):
        if len(values) > p:
            start, end = _stretches(values[:-p] == values[p:])
            found = Runs(start, end + p, np.full(len(start), p))
            out = out.merged(found.where(end - start >= p))
    return out


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the stretches."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def synchronising(window: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions whose t + 1 windows have their smallest hash at the first or last one.

    ``window[i]`` is the hash of the t values from i on; those marked ``periodic`` are
    left out, and a position with no other window is not taken.
    """
    ranked = np.where(periodic, _TOP, window)
    least = sliding_min(ranked, t + 1)
    n = len(least)
    return np.flatnonzero((least != _TOP) & ((least == ranked[:n]) | (least == ranked[t : t + n])))


def _context_pairs(spans: Spans, window: np.ndarray, t: int, small: Runs):
    """(place, distance) of members of the set with equal contexts 3t to 6t - 1 apart."""
    wide = small.where(small.end - small.start >= t)
    quiet = _covered(len(window), wide.start, wide.end - t + 1)
    at = synchronising(window, t, quiet)
    at = at[at + 2 * t <= spans.n]
    places, distances = [], []
    for k in range(1, len(at)):
        gap = at[k:] - at[:-k]
        near = np.flatnonzero(gap < 6 * t)
        if not len(near):
            break
        near = near[gap[near] >= 3 * t]
        a, b = at[near], at[near + k]
        same = window[a] == window[b]
        a, b = a[same], b[same]
        same = spans.same(a, b, 2 * t)
        places.append(a[same])
        distances.append((b - a)[same])
    return places, distances


def _region_pairs(spans: Spans, t: int, small: Runs):
    """(place, distance) that two touching highly periodic regions of one period supply."""
    wide = small.where(small.end - small.start >= 3 * t - 1)
    order = np.argsort(wide.start, kind="stable")
    wide = wide.where(order)
    pair = np.flatnonzero((wide.period[:-1] == wide.period[1:]) & (wide.start[1:] <= wide.end[:-1]))
    places, distances = [], []
    for a1, b1, a2, b2, p in zip(
        wide.start[pair].tolist(),
        wide.end[pair].tolist(),
        wide.start[pair + 1].tolist(),
        wide.end[pair + 1].tolist(),
        wide.period[pair].tolist(),
        strict=True,
    ):
        # where the last period of the first region is found in the second
        shifts = a2 + np.arange(p) - (b1 - p)
        first = np.full(p, b1 - p)
        ok = np.flatnonzero(shifts > 0)
        step = shifts[ok[spans.same(first[ok], first[ok] + shifts[ok], p)]]
        if not len(step):
            continue
        low = 3 * t + (int(step[0]) - 3 * t) % p
        q = np.arange(low, 6 * t, p)
        start = np.maximum(a1, a2 - q)
        fits = np.minimum(b1, b2 - q) - start >= q
        places.append(start[fits])
        distances.append(q[fits])
    return places, distances


def find_runs(values: np.ndarray, lengths: np.ndarray) -> Runs:
    """All runs of sequences laid one after the other, longest first.

    ``values`` holds numbers (equal if the same), each sequence followed by one number
    that occurs nowhere else; ``lengths`` are without those.
    """
    ends = np.cumsum(lengths + 1)
    runs = _neighbours(values)
    spans, window, t = None, None, 1
    while len(lengths) and lengths[0] >= 6 * t:
        n = int(ends[np.count_nonzero(lengths >= 6 * t) - 1])
        if spans is None or n <= spans.n // 2:
            spans = Spans(values[:n])
        # hashes of t values from those of t / 2; equal windows have equal ones
        if window is None:
            window = mix(values[:n].astype(np.uint64))
        else:
            half = t // 2
            window = window[:n]
            window = mix(window[:-half] * np.uint64(0x9E3779B97F4A7C15) + window[half:])
        small = runs.where((3 * runs.period <= t) & (runs.end <= n))
        places, distances = _context_pairs(spans, window, t, small)
        more = _region_pairs(spans, t, small)
        at = np.concatenate([*places, *more[0], np.zeros(0, np.int64)])
        gap = np.concatenate([*distances, *more[1], np.zeros(0, np.int64)])
        if len(at):
            start = at - spans.left(at, at + gap)
            end = at + gap + spans.right(at, at + gap)
            found = Runs(start, end, gap)
            runs = runs.merged(found.where(end - start >= 2 * gap))
        t *= 2
    return runs


# ---------------------------------------------------------------------- operator


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers by text, each document closed by a number of its own."""
    lengths = np.array([len(t) for t in texts], np.int64)
    words = pa.array([w for t in texts for w in t], pa.large_binary())
    codes = words.dictionary_encode()
    base = len(codes.dictionary)
    ends = np.cumsum(lengths + 1)
    values = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    close = np.zeros(len(values), bool)
    close[ends - 1] = True
    values[close] = base + np.arange(len(lengths))
    values[~close] = codes.indices.to_numpy(zero_copy_only=False)
    return values, lengths


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, of one in ten (by its id) with a periodic rest."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


_COLUMNS = "doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, text string"


def _batch(parts: Iterator[pa.RecordBatch], plant: bool, least: int) -> Iterator[pa.RecordBatch]:
    for whole in parts:
        for part in chunks(whole):
            ids = part.column("doc_id").to_pylist()
            # bytes.split() parts at space and \t \n \v \f \r, and at nothing else
            texts = [t.split() for t in plain(part.column("text")).to_pylist()]
            if plant:
                texts = [planted(t, i) for t, i in zip(texts, ids, strict=True)]
            order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
            values, lengths = numbered([texts[k] for k in order])
            runs = find_runs(values, lengths)
            runs = runs.where(runs.end - runs.start >= least)
            first = np.cumsum(lengths + 1) - lengths - 1
            which = np.searchsorted(first, runs.start, "right") - 1
            sort = np.lexsort((runs.period, runs.start, which))
            runs, which = runs.where(sort), which[sort]
            gone = _covered(len(values), runs.start + runs.period, runs.end)
            cut = np.searchsorted(which, np.arange(len(texts) + 1))
            rows: list[tuple] = [()] * len(texts)
            for place, k in enumerate(order):
                mine, base = slice(cut[place], cut[place + 1]), first[place]
                words = texts[k]
                if mine.start < mine.stop:
                    drop = gone[base : base + len(words)].tolist()
                    words = [w for w, d in zip(words, drop, strict=True) if not d]
                start = runs.start[mine]
                size = runs.end[mine] - start
                rows[k] = (len(texts[k]), start - base, size, runs.period[mine], b" ".join(words))
            lists = [pa.array([r[c] for r in rows], pa.list_(pa.int64())) for c in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    *lists,
                    pa.array([r[4] for r in rows], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "starts", "lengths", "periods", "text"],
            )


def collapse(docs: DataFrame, least: int = LEAST, plant: bool = False) -> DataFrame:
    """One row per row of ``docs`` with its runs of at least ``least`` words.

    Columns: doc_id, n_words, starts, lengths, periods (one entry per run, by start and
    then period, word numbers from 0) and text, the words that stay joined by one space.
    A word goes if a run contains it after that run's first period. With ``plant`` one
    document in ten, chosen by its id, first gets a periodic rest, as a check.

    Null and empty texts have no words, no runs and an empty text. Repeated rows give
    repeated results; a null doc_id is kept and never planted. An empty table gives an
    empty result. Other columns are ignored, whatever their names.
    """

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batch(parts, plant, least)

    return keyed(docs).select("doc_id", "text").mapInArrow(batch, _COLUMNS)
