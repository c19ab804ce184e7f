"""Substring dedup by relative Lempel-Ziv parsing over content-defined blocks.

Every window of ``SPAN`` words belongs to its anchor, the leftmost smallest hash of
``GRAM`` words in it. The windows of one anchor stand side by side, and the words that
they cover are a block. Which words a block has depends on nothing but those words, so
equal texts are cut into equal blocks wherever they stand, and all blocks of all
documents together index every window exactly once.

The parse is greedy: a block that also stands in a document with a smaller id is taken
whole, as a reference to the first place that has it, and while the next block's first
place follows on the same reference the factor goes on. Every factor has ``SPAN`` words at
least. Where factors end the block differs from those of other documents in some words
only; the blocks at such boundaries (same anchor, different block) are checked window by
window against all others with that anchor, so a repeat that straddles two factors or two
references is found too, with a reference of its own.

Equality of blocks and windows is that of two 64-bit hashes together, of the anchor and of
the words; the words' own hashes mix in all of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from apptflow.llm.common import Words, chunks, keyed, mix, plain, prefix, sliding_min, spans, stored

SPAN = 50
GRAM = 16

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


def windows_of(words: Words, span: int, gram: int):
    """Starts and anchors of all windows: places and the anchor's hash."""
    n = len(words.start)
    if n < span:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    hashes = words.hashes()
    at = np.arange(n - gram + 1)
    grams = spans(prefix(hashes), at, at + gram)
    width = span - gram + 1
    least = sliding_min(grams, width)
    doc = words.doc()
    start = np.flatnonzero(doc[: n - span + 1] == doc[span - 1 :])
    # leftmost place of the minimum: the first gram at or after the window's start
    # that equals it
    anchor = np.full(len(least), -1)
    for o in range(width):
        open_ = anchor < 0
        hit = open_ & (grams[o : o + len(least)] == least)
        anchor[hit] = np.flatnonzero(hit) + o
    return start, anchor[start], least[start]


def blocks(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, _th, n_words, sha (of the words) and blocks of each document.

    In a block ``at`` is its first window and ``n`` its number of windows.
    """
    item = pa.struct([("anchor", pa.int64()), ("block", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in chunks(whole):
                column = plain(part.column("text"))
                words = Words(column, _WORD)
                start, anchor, value = windows_of(words, span, gram)
                doc = words.doc()[start]
                new = np.ones(len(start), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(start)))
                at = start[first]
                if len(at):
                    text = spans(prefix(words.hashes()), at, at + n + span - 1)
                    text = mix(text + mix((anchor[first] - at).astype(np.uint64)))
                else:
                    text = np.zeros(0, np.uint64)
                owner = doc[first]
                rows = pa.StructArray.from_arrays(
                    [
                        pa.array(value[first].view(np.int64)),
                        pa.array(text.view(np.int64)),
                        pa.array((at - words.first[owner]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    fields=list(item),
                )
                cut = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in column.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_th"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(sha),
                        pa.ListArray.from_arrays(pa.array(cut), rows),
                    ],
                    ["doc_id", "_th", "n_words", "sha", "blocks"],
                )

    schema = (
        "doc_id long, _th long, n_words long, sha string, "
        "blocks array<struct<anchor: long, block: long, at: int, n: int>>"
    )
    return docs.mapInArrow(batch, schema)


def _window_hashes(rows: DataFrame, span: int) -> DataFrame:
    """(anchor, block, low, th, at, place, window): each window of the given blocks.

    ``rows`` has a text and the blocks of it that have to be looked into; ``place`` is the
    window's place in its block and ``at`` that in its document, ``low`` with hash ``th``.
    """

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in chunks(whole):
                words = Words(plain(part.column("text")), _WORD)
                sums = prefix(words.hashes())
                found = part.column("todo")
                ends = found.offsets.to_numpy() - found.offsets[0].as_py()
                values = found.flatten()
                anchor, block, at, n = (values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
                base = words.first[owner] + at
                take = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(take)) - np.repeat(np.cumsum(n) - n, n)
                first = base[take] + place
                hashes = spans(sums, first, first + span).view(np.int64)
                low, th = (part.column(c).to_numpy(zero_copy_only=False)[owner][take] for c in ("doc_id", "_th"))
                where = (at[take] + place).astype(np.int32)
                columns = (anchor[take], block[take], low, th, where, place.astype(np.int32), hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], ["anchor", "block", "low", "th", "at", "place", "window"]
                )

    return rows.mapInArrow(
        batch, "anchor long, block long, low long, th long, at int, place int, window long"
    )


def _cut_out(rows: DataFrame) -> DataFrame:
    """Removes the word ranges in ``drop`` from each text; ranges may overlap."""

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in chunks(whole):
                texts = plain(part.column("text")).to_pylist()
                found = part.column("drop")
                ends = (found.offsets.to_numpy() - found.offsets[0].as_py()).tolist()
                values = found.flatten()
                at = values.field(0).to_numpy(zero_copy_only=False)
                to = values.field(1).to_numpy(zero_copy_only=False)
                gone, kept = [], []
                for k, text in enumerate(texts):
                    own = text.split()
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, at[ends[k] : ends[k + 1]], 1)
                    np.add.at(edge, to[ends[k] : ends[k + 1]], -1)
                    keep = np.cumsum(edge)[:-1] == 0
                    left = [w for w, good in zip(own, keep.tolist(), strict=True) if good]
                    gone.append(len(own) - len(left))
                    kept.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_th"),
                        pa.array(gone, pa.int64()),
                        pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string()),
                    ],
                    ["doc_id", "_th", "n_removed", "kept"],
                )

    return rows.mapInArrow(batch, "doc_id long, _th long, n_removed long, kept string")


def parse(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Documents, and the factors in them that repeat earlier documents.

    The first frame has doc_id, _th, n_words and sha (of the words joined by a space)
    for every row; the second one row per factor: doc_id, _th, start, end (word numbers, the
    last one excluded), and ref_doc, ref_th and ref_start, where the same words stand in a
    document with a smaller id. Factors may overlap.

    A factor covers windows whose words also start in a document with a smaller id.
    Texts of fewer than ``span`` words, null and empty ones have none. A document
    never repeats itself: rows with the same id count as one document. A null doc_id
    is no document to refer to and its row keeps all words. An empty table gives an
    empty result.
    """
    rows = stored(blocks(docs, span, gram), "blocks")
    every = rows.where("doc_id is not null").select("doc_id", "_th", F.explode("blocks").alias("b"))
    every = every.select("doc_id", "_th", "b.*")

    # anchors that occur in two documents at least; all others are new text
    shared = every.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # written down: a join with what was just summed by the same key could not be split
    shared = stored(shared.where("low < high").select("anchor"), "anchors")
    common = stored(every.join(shared, "anchor", "left_semi"), "shared")

    # the first place of each block; blocks that others share an anchor with
    place = F.struct(F.col("doc_id").alias("doc"), F.col("_th").alias("th"), F.col("at").alias("at"))
    first = common.groupBy("anchor", "block").agg(F.min(place).alias("ref"))
    first = stored(first.withColumn("low", F.col("ref.doc")), "first")
    mixed = first.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    mixed = stored(mixed, "mixed")
    boundary = first.drop("ref").join(mixed, "anchor", "left_semi")

    # windows at boundaries, from the first document of each block
    where = common.join(boundary.withColumnRenamed("low", "doc_id"), ["anchor", "block", "doc_id"], "left_semi")
    one = where.groupBy("anchor", "block", "doc_id").agg(F.min(F.struct("_th", "at", "n")).alias("s"))
    todo = one.select("doc_id", F.col("s._th").alias("_th"), "anchor", "block", F.col("s.at").alias("at"), F.col("s.n").alias("n"))
    todo = todo.groupBy("doc_id", "_th").agg(F.collect_list(F.struct("anchor", "block", "at", "n")).alias("todo"))
    looked = docs.join(todo, ["doc_id", "_th"]).select("doc_id", "_th", "text", "todo")
    inner = stored(_window_hashes(looked, span), "inner")
    place = F.struct(F.col("low").alias("doc"), "th", "at")
    oldest = stored(inner.groupBy("anchor", "window").agg(F.min(place).alias("oldest")), "oldest")
    late = inner.select("anchor", "block", "low", "place", "window").join(oldest, ["anchor", "window"])
    late = late.where("oldest.doc < low").groupBy("anchor", "block")
    # rows of one block and document repeat if the document does
    late = late.agg(F.collect_set(F.struct("place", "oldest")).alias("places"))
    first = stored(first.join(late, ["anchor", "block"], "left"), "classes")

    # a block is taken whole, or the windows of it that older documents have
    taken = common.join(first, ["anchor", "block"])
    whole = F.col("doc_id") > F.col("low")
    taken = taken.where(whole | F.col("places").isNotNull())

    def piece(start, size, ref):
        return F.struct(start.alias("start"), (start + size).alias("end"), ref.alias("ref"))

    pieces = F.when(whole, F.array(piece(F.col("at"), F.col("n") + (span - 1), F.col("ref")))).otherwise(
        F.transform("places", lambda p: piece(F.col("at") + p["place"], F.lit(span), p["oldest"]))
    )
    taken = taken.select("doc_id", "_th", F.explode(pieces).alias("p")).select("doc_id", "_th", "p.*")
    # a factor goes on while the next piece follows in the text and on the same reference
    order = Window.partitionBy("doc_id", "_th").orderBy("start", "end", "ref")
    line = F.struct("ref.doc", "ref.th", (F.col("start") - F.col("ref.at")).alias("shift"))
    taken = taken.withColumn("line", line)
    follows = (F.lag("line").over(order) == F.col("line")) & (F.lag("end").over(order) >= F.col("start"))
    taken = taken.withColumn("_new", F.when(follows, 0).otherwise(1))
    taken = taken.withColumn("_factor", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    factors = taken.groupBy("doc_id", "_th", "_factor").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("ref").alias("ref")
    )
    factors = factors.select(
        "doc_id",
        "_th",
        "start",
        "end",
        F.col("ref.doc").alias("ref_doc"),
        F.col("ref.th").alias("ref_th"),
        F.col("ref.at").alias("ref_start"),
    )
    return rows.select("doc_id", "_th", "n_words", "sha"), factors


def dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (text, null where nothing went).

    See ``parse`` for the rules. Repeated rows each get a row. Other columns are ignored.
    """
    own = keyed(docs)
    rows, factors = parse(own, span, gram)
    drop = factors.groupBy("doc_id", "_th").agg(F.collect_list(F.struct("start", "end")).alias("drop"))
    cut = _cut_out(own.join(drop, ["doc_id", "_th"]).select("doc_id", "_th", "text", "drop"))
    cut = cut.groupBy("doc_id", "_th").agg(F.max("n_removed").alias("n_removed"), F.max("kept").alias("kept"))
    return rows.join(cut, ["doc_id", "_th"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.sha2("kept", 256), "sha").alias("kept_sha256"),
        "kept",
    )
