"""SimHash near-duplicates: fingerprints, binary trie self-join, components.

Fingerprints are computed per document in Arrow batches. Equal ones meet in an
aggregate, so copies never form pairs. Distinct fingerprints are joined over a
binary trie: its first ``depth`` bits name a node, every fingerprint goes to the
node pairs that its own node forms with all nodes at most ``max_bits`` away, and each
node pair is then walked downwards, both sides together, adding up differing bits and
dropping a pair of subtrees once the budget is exceeded. ``depth`` grows until no
node holds more than ``NODE_ROWS`` fingerprints; a node that no depth can split is
walked in blocks of that size, so a task's memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import chunks, components, keyed, lean, plain, stored, text_bytes

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: most fingerprints of one trie node that are walked at once
NODE_ROWS = 1 << 16
DEPTHS = (6, 8, 10, 12, 14, 16, 18, 20)
#: subtrees of so few pairs are compared directly
LEAF_PAIRS = 64
#: what tasks receive to tell rows that stay for sure: so many rows of 64 marks at most
MARK_PLACES = 1 << 18

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(words: list[bytes], shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a document's words; 0 if it has none."""
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(g, seed) for g in grams), np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, _th, fp): one row per input row; fp as a signed 64-bit value."""

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in chunks(whole):
                data, ends = text_bytes(plain(part.column("text")))
                raw = data.tobytes().translate(_LOWER)
                cut = ends.tolist()
                fps = [
                    fingerprint(raw[a:b].split(), shingle) for a, b in zip(cut, cut[1:], strict=False)
                ]
                fp = pa.array(np.array(fps, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_th"), fp], ["doc_id", "_th", "fp"]
                )

    return keyed(docs).mapInArrow(lean(batch), "doc_id long, _th long, fp long")


# ----------------------------------------------------------------- trie self-join


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def walk(
    left: np.ndarray, right: np.ndarray | None, bit: int, used: int, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the budget below one pair of trie nodes.

    ``left`` and ``right`` are sorted, distinct, and equal above ``bit`` within each
    side; ``used`` bits already differ between the sides. ``right`` None joins
    ``left`` with itself, each pair once. A node is a range of its side's array.
    """
    same_side = right is None
    right = left if same_side else right
    n = np.array
    state = [n([0]), n([len(left)]), n([0]), n([len(right)]), n([used])]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(state[0]):
        a0, a1, b0, b1, err = state
        size = (a1 - a0) * (b1 - b0)
        leaf = (size <= LEAF_PAIRS) | (bit < 0)
        if leaf.any():
            found.append(_leaves(left, right, *(x[leaf] for x in state[:4]), same_side, max_bits))
            a0, a1, b0, b1, err = (x[~leaf] for x in state)
        if not len(a0):
            break
        one = np.uint64(1) << np.uint64(bit)
        high = ~((one << np.uint64(1)) - np.uint64(1)) if bit < 63 else np.uint64(0)
        am = np.searchsorted(left, (left[a0] & high) | one)
        bm = np.searchsorted(right, (right[b0] & high) | one)
        own = same_side & (a0 == b0) & (a1 == b1)
        kids = [
            (a0, am, b0, bm, err, np.ones(len(a0), bool)),
            (am, a1, bm, b1, err, np.ones(len(a0), bool)),
            (a0, am, bm, b1, err + 1, np.ones(len(a0), bool)),
            (am, a1, b0, bm, err + 1, ~own),
        ]
        state = [np.concatenate([k[i] for k in kids]) for i in range(5)]
        keep = np.concatenate([k[5] for k in kids])
        keep &= (state[0] < state[1]) & (state[2] < state[3]) & (state[4] <= max_bits)
        state = [x[keep] for x in state]
        bit -= 1
    if not found:
        return left[:0], left[:0]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _leaves(left, right, a0, a1, b0, b1, same_side, max_bits):
    """Compares all pairs of small node pairs; larger ones, of equal values, in turn."""
    out_a, out_b = [], []
    size = (a1 - a0) * (b1 - b0)
    order = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(order, (order[at - 1] if at else 0) + (1 << 20), "right")))
        s = size[at:to]
        which = np.repeat(np.arange(at, to), s)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(s) - s, s)
        wide = (b1 - b0)[which]
        i, j = a0[which] + inner // wide, b0[which] + inner % wide
        good = _popcount(left[i] ^ right[j]) <= max_bits
        if same_side:
            good &= (i < j) | ((a0 != b0) | (a1 != b1))[which]
        out_a.append(left[i[good]])
        out_b.append(right[j[good]])
        at = to
    return np.concatenate(out_a), np.concatenate(out_b)


def trie_links(distinct: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """(f, g): pairs of different fingerprints with at most ``max_bits`` differing bits.

    ``distinct`` has one row per fingerprint in column ``fp``.
    """
    deepest = DEPTHS[-1]
    counts = distinct.groupBy(F.shiftrightunsigned("fp", 64 - deepest).alias("node")).agg(F.count("*").alias("n"))
    counts = stored(counts, "nodes", 1 << deepest)  # one count serves all depths
    for depth in DEPTHS:
        node = F.shiftrightunsigned("node", deepest - depth).alias("node")
        sizes = counts.groupBy(node).agg(F.sum("n").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= node_rows:
            break
    large = sizes.where(F.col("n") > node_rows)
    flips = [0] + [
        sum(1 << b for b in bits)
        for k in range(1, max_bits + 1)
        for bits in combinations(range(depth), k)
    ]

    # each fingerprint meets a node pair; side 0 is the smaller node of the pair
    own = F.shiftrightunsigned("fp", 64 - depth)
    rows = distinct.select("fp", own.alias("own"), F.explode(F.lit(flips)).alias("flip"))
    rows = rows.select("fp", "own", F.col("own").bitwiseXOR(F.col("flip")).alias("other"))
    if large.isEmpty():
        rows = rows.withColumns({"i": F.lit(0).cast("long"), "o": F.lit(0).cast("long")})
    else:
        # nodes that no depth splits: their blocks meet all blocks of the other node, and the
        # fingerprints of all other nodes stay as many as they are
        spread = stored(large.select("node", F.ceil(F.col("n") / node_rows).alias("spread")), "large")
        for mine in ("own", "other"):
            parts = spread.select(F.col("node").alias(mine), F.col("spread").alias(f"{mine}_parts"))
            rows = rows.join(parts, mine, "left").fillna(1, [f"{mine}_parts"])
        block = F.pmod(F.xxhash64("fp"), F.col("own_parts"))
        every = F.sequence(F.lit(0).cast("long"), F.col("other_parts") - 1)
        rows = rows.select("fp", "own", "other", block.alias("i"), F.explode(every).alias("o"))
    lower, to_self = F.col("own") < F.col("other"), F.col("own") == F.col("other")
    first = lower | (to_self & (F.col("i") <= F.col("o")))
    rows = rows.select(
        "fp",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(first, F.col("i")).otherwise(F.col("o")).alias("bi"),
        F.when(first, F.col("o")).otherwise(F.col("i")).alias("bj"),
        F.when(first, 0).otherwise(1).alias("side"),
    )

    keys = ["low", "high", "bi", "bj"]

    def joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for part in parts:
            cols = [part.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "side", "fp")]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
            rest = cols
            if not len(cols[0]):
                continue
            head = np.stack(cols[:4])
            cut = np.flatnonzero((head[:, 1:] != head[:, :-1]).any(axis=0)) + 1
            if len(cut):  # the last group may go on in the next batch
                yield from pairs([c[: cut[-1]] for c in cols], np.concatenate([[0], cut]))
                rest = [c[cut[-1] :] for c in cols]
        if rest is not None and len(rest[0]):
            yield from pairs(rest, np.array([0, len(rest[0])]))

    def pairs(cols, cut) -> Iterator[pa.RecordBatch]:
        low, high, bi, bj, side, fp = cols
        fp = fp.view(np.uint64)
        out_f, out_g = [], []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            used = int(low[a] ^ high[a]).bit_count()
            if low[a] == high[a] and bi[a] == bj[a]:
                f, g = walk(np.sort(fp[a:b]), None, 63 - depth, 0, max_bits)
            else:
                mid = a + int(np.searchsorted(side[a:b], 1))
                if mid in (a, b):
                    continue
                f, g = walk(np.sort(fp[a:mid]), np.sort(fp[mid:b]), 63 - depth, used, max_bits)
            if len(f):
                out_f.append(f)
                out_g.append(g)
        if out_f:
            f, g = np.concatenate(out_f).view(np.int64), np.concatenate(out_g).view(np.int64)
            for at in range(0, len(f), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[at : at + (1 << 16)]), pa.array(g[at : at + (1 << 16)])], ["f", "g"]
                )

    grouped = rows.repartition(*keys).sortWithinPartitions(*keys, "side")
    return grouped.mapInArrow(lean(joined), "f long, g long")


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _th, fp) for every row, and (fp, first_id, component) for every fingerprint."""
    fps = stored(fingerprints(docs, shingle), "simhash")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct", fps.count())
    links = trie_links(distinct.select("fp"), max_bits)
    groups = components(links, "f", "g").withColumnRenamed("node", "fp")
    classes = distinct.join(groups, "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    return fps, stored(classes, "classes", distinct.count())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long) and component_id for every row of ``docs``.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows get
    one row each. ``component_id`` is the smallest doc_id reachable over links. Rows
    with a null doc_id get a fingerprint and the component of their text, whose id is
    then the smallest one that is not null (null if there is none). An empty table
    gives an empty result. Other columns are ignored.
    """
    fps, classes = _grouped(docs, shingle, max_bits)
    ids = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = stored(ids, "ids", classes.count())
    classes = classes.join(ids, "component").select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each group of near copies, all columns unchanged.

    The document with the smallest doc_id stays, one without an id only if none has one;
    of rows that share it, the smallest by a hash of the text and then by the columns.
    Groups are those of ``near_duplicates``, so rows that share an id but not a group each
    stand for their own.
    """
    fps, classes = _grouped(docs, shingle, max_bits)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th")
    # per fingerprint first, stored, so that the join can split a hot one
    best = stored(fps.groupBy("fp").agg(F.min(row).alias("row")), "best", classes.count())
    best = best.join(classes, "fp").groupBy("component").agg(F.min("row").alias("row"))
    best = best.select(F.col("row.doc_id").alias("_id"), F.col("row._th").alias("_hash"))
    # keys decide: only those of rows that go or repeat are looked up where the texts are
    keys = fps.groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_hash")).agg(F.count("*").alias("n"))
    keys = stored(keys, "keys", fps.count())
    same_key = keys["_id"].eqNullSafe(F.col("b._id")) & (keys["_hash"] == F.col("b._hash"))
    best = stored(best, "first", classes.count())
    most = keys.count()
    gone = stored(keys.join(best.alias("b"), same_key, "left_anti").select("_id", "_hash"), "gone", most)
    repeated = stored(keys.where("n > 1").select("_id", "_hash"), "repeated", most)
    marks = _marks(gone.unionByName(repeated))
    own_id = F.col("doc_id").cast("long")
    own_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("_row"), own_id.alias("_own"), own_hash.alias("_th"))
    place, bit = _mark("_own", "_th")
    marked = rows.withColumns({"_place": place, "_bit": bit}).join(F.broadcast(marks), "_place", "left")
    # texts move only where the marks leave it open whether their row goes or repeats
    found = F.coalesce(F.getbit("_bits", "_bit"), F.lit(0)) == 1
    sure, rows = marked.where(~found).select("_row"), marked.where(found).select("_row", "_own", "_th")

    def in_(found: DataFrame):
        return rows["_own"].eqNullSafe(found["_id"]) & (rows["_th"] == found["_hash"])

    kept = rows.join(gone, in_(gone), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, in_(repeated), "left_anti").select("_row")
        several = kept.join(repeated, in_(repeated), "left_semi").groupBy("_own", "_th").agg(F.min("_row").alias("_row"))
        kept = once.unionByName(several.select("_row"))
    kept = sure.unionByName(kept.select("_row"))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def _mark(key: str, text_hash: str):
    """The place among ``MARK_PLACES``, and the bit there, that mark a row's key."""
    h = F.xxhash64(key, text_hash)
    bit = F.shiftrightunsigned(h, 32).bitwiseAND(63).cast("int")
    return F.pmod(h, F.lit(MARK_PLACES)).alias("_place"), bit.alias("_bit")


def _marks(keys: DataFrame) -> DataFrame:
    """(_place, _bits): 64 marks a place, set for all keys (_id, _hash) and by chance for few others.

    At most ``MARK_PLACES`` rows at any number of keys, so every task can have them all.
    """
    marks = keys.select(*_mark("_id", "_hash")).distinct()
    marks = marks.groupBy("_place").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    return stored(marks, "marks", min(keys.count(), MARK_PLACES))


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
