"""Line dedup: lines that many documents share stay in one document only.

Lines are exploded and normalised to a key (white space stripped at both ends, A-Z
lower-cased). Keys of at least ``min_chars`` code points are hashed, the distinct
documents of each hash are counted, and a key over the threshold keeps its lines in the
document with the largest id that holds it. Documents are put together again from the
places of the lines that stay.

What is shuffled for the decision is a hash, an id and a place per line; texts move
only to meet the places of their dropped lines, if those are too many to be sent to
where the texts are read. Counting goes by (hash, document) first, so a line that every
document has is counted in all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import chunks, keyed, plain, stored

MIN_CHARS = 20
MIN_DOCS = 3
#: stands for a null doc_id, which is smaller than every other
NO_ID = -(1 << 63)
_SPACE = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(_SPACE)), _UPPER, _UPPER.lower())


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, _th, place, key): the lines of ``keyed`` rows whose key is long enough.

    ``key`` is the first half of the key's SHA-256, ``place`` counts lines from 0.
    """
    lines = docs.select("doc_id", "_th", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    lines = lines.where(F.char_length(F.trim("line", F.lit(_SPACE))) >= min_chars)
    digest = F.substring(F.sha2(line_key(F.col("line")), 256), 1, 32)
    return lines.select("doc_id", "_th", "place", F.unhex(digest).alias("key"))


def common_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, last): keys that enough documents hold, and the largest id among these."""
    owner = F.coalesce("doc_id", F.lit(NO_ID))
    found = lines.groupBy("key").agg(F.count_distinct(owner).alias("n"), F.max(owner).alias("last"))
    return found.where(F.col("n") >= min_docs).select("key", "last")


def _rejoined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in parts:
        for part in chunks(whole):
            n_lines, n_dropped, kept = [], [], []
            texts = plain(part.column("text")).to_pylist()
            for text, gone in zip(texts, part.column("gone").to_pylist(), strict=True):
                count = text.count(b"\n") + 1
                if gone:
                    drop = set(gone)
                    text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in drop)
                n_lines.append(count)
                n_dropped.append(len(gone or ()))
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, text (what stays).

    A null or empty text is one empty line, which is too short to be dropped (for
    ``min_chars`` of 1 or more). A document that loses all lines has an empty text.
    Rows that share an id count as one document: all of them keep the lines that the
    largest id keeps, so repeated rows give repeated results. Rows without an id count
    together as one document with the smallest id. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    rows = keyed(docs)
    lines = stored(hashed_lines(rows, min_chars), "lines")
    common = stored(common_keys(lines, min_docs), "common")
    gone = lines.join(common, "key").where(F.coalesce("doc_id", F.lit(NO_ID)) < F.col("last"))
    gone = gone.groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"))
    gone = stored(gone.agg(F.collect_set("place").alias("gone")), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_t"))
    met = rows.join(gone, same, "left").select("doc_id", "text", "gone")
    return met.mapInArrow(_rejoined, "doc_id long, n_lines long, n_dropped long, text string")
