"""Helpers the operators share: stored tables, text batches, words, components."""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.session import checkpoint_ready

CHUNK_BYTES = 1 << 20
#: rows of keys that are worth a file of their own
FILE_ROWS = 50_000


# ---------------------------------------------------------------- stored tables


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    With ``rows``, about the most rows that it can have, a table of few rows gets few files
    whatever the number of shuffle partitions: each costs its executor several processes,
    which set the file's permissions. A lost executor costs only its tasks: the table can be read by any other one.
    The files are removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    if not checkpoint_ready(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.parquet(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Only the id and the text, with ``_th``, a hash of the text.

    Rows are told apart by id and text, so that an id that occurs with different
    texts gets a result for each. A clashing column of the caller's cannot reach
    the operator, because every other column is dropped here.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_th")
    )


# ------------------------------------------------------------------ text batches


def give_back() -> None:
    """Hands memory that this process holds but does not use back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def lean(batch: Callable) -> Callable:
    """``batch`` for ``mapInArrow``, handing back at a task's end the memory it has used.

    Python workers stay for the stages to come, and allocators keep what is freed.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from batch(parts)
        finally:
            give_back()

    return run


def plain(column: pa.Array) -> pa.Array:
    """A text column with 64-bit offsets and without nulls (null becomes empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    return column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column from ``plain`` and the offsets of its rows in them."""
    n = len(column)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]), ends - ends[0]


def chunks(
    batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of text each; one row at least."""
    if not batch.num_rows:
        return
    ends = text_bytes(plain(batch.column(column)))[1]
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + size, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


# ------------------------------------------------------- words as arrays of hashes

_MUL = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_MUL_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i``; see ``spans``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", _MUL, len(values)), out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ``values[start:end]`` for many spans at once."""
    down = _power("down", _MUL_INV, len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


#: longer words are hashed one by one
_LONG = 512


def _mixed(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    out = mix(size.astype(np.uint64) * _MUL)
    long = np.flatnonzero(size > _LONG)
    left = np.flatnonzero((size > 0) & (size <= _LONG))
    for at in range(0, _LONG, 8):
        if not len(left):
            break
        rest = size[left] - at
        # bytes behind the word's end do not count
        mask = _TOP >> (np.uint64(8) * (8 - np.minimum(rest, 8)).astype(np.uint64))
        out[left] = mix((out[left] ^ (eight[start[left] + at] & mask)) * _MUL)
        left = left[rest > 8]
    for k in long.tolist():
        word = data[start[k] : start[k] + size[k]].tobytes()
        out[k] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), "<u8")[0]
    return out


class Words:
    """Where the words of a chunk are: ``is_word`` says which bytes belong to words."""

    def __init__(self, column: pa.Array, is_word: np.ndarray, fold: np.ndarray | None = None):
        data, self.ends = text_bytes(column)
        n = len(data)
        self.data = data if fold is None else fold[data]
        word = is_word[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        edge = self.ends[(self.ends > 0) & (self.ends < n)]
        before[edge], after[edge - 1] = False, False
        self.start = np.flatnonzero(word & ~before)
        self.stop = np.flatnonzero(word & ~after) + 1
        #: first word of each document, and one past the last of all
        self.first = np.searchsorted(self.start, self.ends)
        self.counts = np.diff(self.first)
        self._hashes: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        """A hash per word: its bytes are mixed in, eight at a time.

        Unlike a polynomial in the letters it has no words that collide by their pattern.
        """
        if self._hashes is None:
            self._hashes = _mixed(self.data, self.start, self.stop - self.start)
        return self._hashes

    def doc(self) -> np.ndarray:
        """The document's place in the chunk, for each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def text(self, first: int, last: int) -> list[bytes]:
        data = self.data
        return [
            data[a:b].tobytes()
            for a, b in zip(self.start[first:last].tolist(), self.stop[first:last].tolist())
        ]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


# ------------------------------------------------------------ connected components


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that can be reached over the edges.

    Alternates two star steps until nothing changes: every node hands its larger
    neighbours to its smallest one, then its smaller ones. Each step is an
    aggregate with a partial part in each task and one join; rounds grow with the
    logarithm of a component's size. Each round is written to the shared folder.
    Nodes without an edge do not appear.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = stored(pairs, "edges")
    most, before = 2 * pairs.count(), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # written down, so that the join can split a node with very many neighbours
        least = stored(least.select("u", F.least("u", "m").alias("m")), "least", most)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "edges", most)
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least", most)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        pairs = stored(pairs, "edges", most)
        sums = pairs.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if sums == before:
            break
        before = sums
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
