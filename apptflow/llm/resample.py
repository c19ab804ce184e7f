"""Importance resampling towards a target distribution, on hashed word runs.

Features are all runs of one to three consecutive words; a feature falls into the
bucket of its CRC-32. A bucket's gain is the log ratio of its share in the target texts
to that in the documents, a document's weight the sum of its features' gains, and its
score the weight plus Gumbel noise keyed by the id: the highest scores are a sample
without replacement in proportion to the exponential of the weights.

Texts of a batch are joined with a sentinel byte that no text holds. One regex pass
finds all words and sentinels; a binary search of the sentinels' places gives each word
its document and masks the runs that cross from one document to the next, before one
``bincount``. The CRC of a run comes from those of its words, a whole batch at a time.

The driver sees one count per bucket. Ranks come from a range-partitioned sort of the
best rows and one count per partition of it, never from one task.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from apptflow.llm.common import chunks, keyed, plain, stored

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42

# --------------------------------------------------------------- words of a batch

#: no byte of UTF-8; should a broken text hold it, it reads as another such byte
_SENTINEL = b"\xff"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLD = bytes.maketrans(_UPPER + _SENTINEL, _UPPER.lower() + b"\xfe")
_TOKEN = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")

# ------------------------------------------------------------- CRC of joined words

_SHORT = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by what it does to each byte."""
    out = tables[0][crc & 255]
    for k in (1, 2, 3):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & 255]
    return out


def _zero_byte_maps() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps of a CRC over 0 to _SHORT - 1 zero bytes, and over 2**k of them."""
    table = _crc_table()
    one = np.arange(256, dtype=np.uint32)
    maps = [np.stack([one << np.uint32(8 * k) for k in range(4)])]
    for _ in range(_SHORT - 1):
        maps.append((maps[-1] >> np.uint32(8)) ^ table[maps[-1] & 255])
    doubled = [maps[1]]
    for _ in range(31):
        doubled.append(_apply(doubled[-1], doubled[-1]))
    return np.stack(maps), doubled


_BY_LENGTH, _BY_POWER = _zero_byte_maps()


def crc_shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC carried over ``length`` zero bytes: CRC(ab) = shift(CRC(a), len b) ^ CRC(b)."""
    short = np.minimum(length, _SHORT - 1)
    out = _BY_LENGTH[short, 0, crc & 255]
    for k in (1, 2, 3):
        out = out ^ _BY_LENGTH[short, k, (crc >> np.uint32(8 * k)) & 255]
    long = np.flatnonzero(length >= _SHORT)
    if len(long):
        part, rest = crc[long], length[long]
        for k in range(int(rest.max()).bit_length()):
            odd = (rest >> k) & 1 == 1
            part[odd] = _apply(_BY_POWER[k], part[odd])
        out[long] = part
    return out


def feature_buckets(texts: list[bytes], buckets: int = BUCKETS, run: int = RUN):
    """Buckets of all features of the texts, the text each is of, and words per text."""
    data = _SENTINEL.join(t.translate(_FOLD) for t in texts) + _SENTINEL
    found = _TOKEN.findall(data)
    crc = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
    size = np.fromiter(map(len, found), np.int64, len(found))
    # a CRC tells single bytes apart, so this finds the sentinels and nothing else
    ends = np.flatnonzero((size == 1) & (crc == zlib.crc32(_SENTINEL)))
    at = np.arange(len(found))
    doc = np.searchsorted(ends, at)
    word = np.ones(len(found), bool)
    word[ends] = False
    counts = np.diff(ends, prepend=-1) - 1

    spaced = crc ^ crc_shift(np.full(len(crc), zlib.crc32(b" "), np.uint32), size)
    out, owner, joined = [crc[word] % buckets], [doc[word]], crc
    for k in range(1, run):
        if len(found) <= k:
            break
        joined = crc_shift(joined[:-1], size[k:] + 1) ^ spaced[k:]
        inside = (doc[k:] == doc[: len(doc) - k]) & word[k:]
        out.append(joined[inside] % buckets)
        owner.append(doc[k:][inside])
    return np.concatenate(out).astype(np.int64), np.concatenate(owner), counts


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in parts:
        for part in chunks(whole):
            yield part, plain(part.column("text")).to_pylist()


# ---------------------------------------------------------------------- operator


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """Features per bucket of all ``keyed`` rows."""

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in _batches(parts):
            total += np.bincount(feature_buckets(texts, buckets, run)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"]
        )

    found = docs.select("text").mapInArrow(batch, "bucket int, n long")
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # ``buckets`` rows at most
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the smoothed log ratio of the shares, rounded down."""
    buckets = len(source)
    total, aimed = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * total / ((s + 1.0) * aimed)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """(doc_id, _th, n_words, n_features, weight) of ``keyed`` rows."""

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _batches(parts):
            bucket, owner, counts = feature_buckets(texts, len(gain), run)
            n = len(texts)
            # whole numbers well below 2**53, so sums of doubles are exact
            weight = np.bincount(owner, gain[bucket].astype(np.float64), n).astype(np.int64)
            features = np.bincount(owner, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("_th"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(features.astype(np.int64)),
                    pa.array(weight),
                ],
                ["doc_id", "_th", "n_words", "n_features", "weight"],
            )

    return docs.mapInArrow(
        batch, "doc_id long, _th long, n_words long, n_features long, weight long"
    )


def noisy(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise keyed by seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    return weights.withColumn("score", (F.col("weight") + noise).cast("long"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` from 1 on, best score first, then smallest id (null last)."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_th")]
    placed = rows.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")
    )
    placed = stored(placed, "placed")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rank = (F.col("_before") + own + 1).cast("long")
    return placed.join(offsets, "_part").withColumn("rank", rank)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    run: int = RUN,
    seed: int = SEED,
    target_key: str = "item_id",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    Of the rows with at least ``min_words`` words, ``percent`` of a hundred (rounded
    down) with the highest scores are drawn and ranked from 1; the rest have a null rank.
    Ties go to the smaller doc_id. Null and empty texts have no words: weight 0, never
    drawn. Repeated rows are rows of their own with equal scores and ranks that follow
    each other; a null doc_id is written as nothing in the noise and comes last among
    equal scores. An empty table of documents gives an empty result, one of targets
    equal targets for all buckets. Other columns are ignored, whatever their names.
    """
    rows = keyed(docs)
    gain = gains(
        bucket_counts(rows, buckets, run), bucket_counts(keyed(target, target_key), buckets, run)
    )
    scored = stored(noisy(weigh(rows, gain, run), seed), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    # the quantile is off by one rank in 10,000 at most, far less than the one in a hundred
    # left for it, so all rows that can be drawn are at or above it
    cut = F.percentile_approx("score", max(0.0, 1 - (percent + 1) / 100), 10_000)
    known = able.agg(F.count("*").alias("n"), cut.alias("cut")).first()
    draw = percent * known.n // 100
    least = known.cut if known.cut is not None else 0
    best = (F.col("n_words") >= min_words) & (F.col("score") >= least)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = _ranked(scored.where(best)).select(
        *columns, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")
    )
    rest = scored.where(~best).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
