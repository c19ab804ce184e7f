"""Benchmark decontamination by winnowing.

A window is ``span`` consecutive words. Of every ``span - GRAM + 1`` neighbouring
hashes of ``GRAM`` words the smallest is kept as a fingerprint; a shared window has the
same hashes on both sides, so it always shares a fingerprint. Items shorter than a
window are one window themselves; for each such length every gram of that length is a
fingerprint (a window of one hash). Fingerprints of documents and items are joined,
each hit is extended to the windows that hold it, and those are compared as text.

A filter of fixed size (``FILTER_BITS``), made of the items' fingerprints, goes to the
tasks and drops most document fingerprints before any shuffle. It can let too many
pass, never too few; the joins decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from apptflow.llm.common import Words, chunks, keyed, lean, mix, plain, prefix, sliding_min, spans, stored

SPAN = 10
GRAM = 5
FILTER_BITS = 1 << 24

# lower-cased bytes; digits, a-z and every byte of a non-ASCII character make words
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _grams(words: Words, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; those that leave a document too."""
    n = len(words.start)
    if n < size:
        return np.zeros(0, np.uint64)
    at = np.arange(n - size + 1)
    return spans(prefix(words.hashes()), at, at + size)


def _inside(words: Words, size: int) -> np.ndarray:
    """Which grams lie in one document."""
    doc = words.doc()
    return doc[: len(doc) - size + 1] == doc[size - 1 :]


def fingerprints(words: Words, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept grams of ``size``-word windows."""
    hashes = _grams(words, gram)
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    inside = _inside(words, gram)
    width = size - gram + 1
    # a gram across a border may not win over one inside
    ranked = np.where(inside, hashes, np.uint64(0xFFFFFFFFFFFFFFFF))
    least = sliding_min(ranked, min(width, len(ranked)))
    keep = np.zeros(len(ranked), bool)
    for o in range(len(ranked) - len(least) + 1):
        keep[o : o + len(least)] |= ranked[o : o + len(least)] == least
    at = np.flatnonzero(keep & inside)
    return at, hashes[at]


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one = mix(hashes + np.uint64(0x9E3779B97F4A7C15))
    bits = np.uint64(FILTER_BITS - 1)
    return (one & bits).astype(np.int64), ((one >> np.uint64(32)) & bits).astype(np.int64)


_FINGER = "size int, finger long"


def _item_rows(items: DataFrame, span: int, gram: int) -> DataFrame:
    """(item_id, size, finger, windows): an item's fingerprints and window texts."""

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in chunks(whole):
                words = Words(plain(part.column("text")), _WORD, _FOLD)
                ids, size_of, finger, texts = [], [], [], []
                for k, item in enumerate(part.column("doc_id").to_pylist()):
                    a, b = int(words.first[k]), int(words.first[k + 1])
                    if a == b:
                        continue
                    own = words.text(a, b)
                    size = min(span, b - a)
                    ids.append(item)
                    size_of.append(size)
                    texts.append(
                        [b" ".join(own[i : i + size]) for i in range(len(own) - size + 1)]
                    )
                    one = Words(plain(part.column("text").slice(k, 1)), _WORD, _FOLD)
                    mine = fingerprints(one, size, gram if size == span else size)[1]
                    finger.append(np.unique(mine).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(size_of, pa.int32()),
                        pa.array(finger, pa.list_(pa.int64())),
                        pa.array(texts, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                    ],
                    ["item_id", "size", "fingers", "windows"],
                )

    schema = "item_id long, size int, fingers array<long>, windows array<string>"
    return keyed(items, "item_id").select("doc_id", "text").mapInArrow(batch, schema)


def _filter(fingers: DataFrame) -> bytes:
    """The fixed-size filter of all (size, finger) pairs, built in tasks and merged."""

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for part in parts:
            size = part.column("size").to_numpy(zero_copy_only=False).astype(np.uint64)
            h = part.column("finger").to_numpy(zero_copy_only=False).view(np.uint64)
            for slot in _slots(h ^ mix(size)):
                bits[slot] = True
        packed = np.packbits(bits)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(packed[at].astype(np.int32))],
            ["at", "bits"],
        )

    merged = np.zeros(FILTER_BITS // 8, np.uint8)
    found = fingers.mapInArrow(batch, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    rows = found.toArrow()  # FILTER_BITS / 8 rows at most
    merged[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return merged.tobytes()


def _document_rows(docs: DataFrame, sizes: list[int], packed: bytes, span: int, gram: int) -> DataFrame:
    """(doc_id, _th, n_words, hits): each document with the fingerprints that passed.

    A hit holds the window length, the fingerprint, the place of the first window
    that can hold it, and the words of all windows that can.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(packed)
    hit_type = pa.list_(
        pa.struct([("size", pa.int32()), ("finger", pa.int64()), ("at", pa.int32()), ("words", pa.list_(pa.string()))])
    )

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(sent.value, np.uint8)).view(bool)
        for whole in parts:
            for part in chunks(whole):
                words = Words(plain(part.column("text")), _WORD, _FOLD)
                doc = words.doc()
                hits: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for size in sizes:
                    width = gram if size == span else size
                    at, h = fingerprints(words, size, width)
                    one, two = _slots(h ^ mix(np.full(len(h), size, np.uint64)))
                    passed = bits[one] & bits[two]
                    for p, f in zip(at[passed].tolist(), h[passed].view(np.int64).tolist(), strict=True):
                        d = int(doc[p])
                        a = max(int(words.first[d]), p - (size - width))
                        b = min(int(words.first[d + 1]), p + size)
                        near = [w.decode() for w in words.text(a, b)]
                        hits[d].append(
                            {"size": size, "finger": f, "at": a - int(words.first[d]), "words": near}
                        )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("_th"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(hits, hit_type),
                    ],
                    ["doc_id", "_th", "n_words", "hits"],
                )

    schema = (
        "doc_id long, _th long, n_words long, "
        "hits array<struct<size: int, finger: long, at: int, words: array<string>>>"
    )
    return docs.mapInArrow(lean(batch), schema)


def overlaps(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, item_ids (array of long).

    ``n_hit`` counts the words inside an occurrence of a window of an item and
    ``item_ids`` are the items with such windows, sorted. Null and empty texts have
    no words and no hits; items without words match nothing; rows of ``items`` that
    share an id count as one item, and a null item id is not listed. Repeated rows of
    ``docs`` each get a row. With an empty table of items nothing is hit.
    """
    bench = stored(_item_rows(items, span, gram), "items")
    most = bench.agg(F.sum(F.size("windows"))).first()[0] or 0
    fingers = stored(bench.select("size", F.explode("fingers").alias("finger")).distinct(), "fingers", most)
    # a window has 1 to ``span`` words, so this is a handful of values
    sizes = sorted(r.size for r in fingers.select(F.col("size")).distinct().toLocalIterator())
    rows = stored(_document_rows(keyed(docs), sizes, _filter(fingers), span, gram), "documents")

    hits = rows.select("doc_id", "_th", F.explode("hits").alias("h"))
    hits = hits.select("doc_id", "_th", "h.*").join(fingers, ["size", "finger"], "left_semi")
    ranges = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    windows = hits.where(F.size("words") >= F.col("size")).select(
        "doc_id",
        "_th",
        "size",
        F.explode(
            F.transform(
                ranges,
                lambda i: F.struct(
                    (F.col("at") + i).alias("start"),
                    F.array_join(F.slice("words", i + 1, F.col("size")), " ").alias("window"),
                ),
            )
        ).alias("w"),
    )
    windows = windows.select("doc_id", "_th", "size", "w.*").distinct()
    known = bench.select("size", "item_id", F.explode("windows").alias("window")).distinct()
    known = stored(known, "windows", most)
    distinct = stored(known.select("size", "window").distinct(), "distinct", most)
    found = windows.join(distinct, ["size", "window"], "left_semi")
    found = stored(found, "found")

    document = ["doc_id", "_th"]
    reach = F.max(F.col("start") + F.col("size")).over(
        Window.partitionBy(*document).orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    fresh = F.col("start") + F.col("size") - F.greatest("start", F.coalesce(reach, F.lit(0)))
    covered = found.select(*document, "start", "size").distinct().select(
        *document, F.greatest(fresh, F.lit(0)).alias("fresh")
    )
    covered = covered.groupBy(*document).agg(F.sum("fresh").alias("n_hit"))
    listed = found.select(*document, "size", "window").distinct().join(known, ["size", "window"])
    listed = listed.select(*document, "item_id").distinct().groupBy(*document)
    listed = listed.agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    none = F.lit(None)
    hit = covered.withColumn("item_ids", none.cast("array<long>")).unionByName(
        listed.withColumn("n_hit", none.cast("long"))
    )
    hit = hit.groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_t")).agg(
        F.max("n_hit").alias("n_hit"), F.first("item_ids", ignorenulls=True).alias("item_ids")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_t"))
    return rows.select(*document, "n_words").join(hit, same, "left").select(
        "doc_id",
        "_th",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
    )


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, all columns unchanged.

    Extra columns are passed on whatever their names. The keys of the rows that go are
    stored, so that few of them are sent to where the texts are read.
    """
    hit = overlaps(docs, items, span, gram).where("n_hit > 0").select("doc_id", "_th").distinct()
    hit = stored(hit, "hit")
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)  # no name of theirs can clash
    at = {c: F.col(n) for c, n in zip(docs.columns, names, strict=True)}
    text = F.xxhash64(F.coalesce(at["text"].cast("string"), F.lit("")))
    same = at["doc_id"].cast("long").eqNullSafe(F.col("doc_id")) & (text == F.col("_th"))
    return rows.join(hit, same, "left_anti").toDF(*docs.columns)
