"""Best-fit packing of token sequences by exact complements.

Documents are tokenised once, in Arrow batches. What the packing plan needs of the
corpus is one count per piece length, so the plan has at most ``capacity`` inputs at
any corpus size. It indexes the lengths, the sums of pairs and the sums of triples,
fills each gap exactly while such a combination is available, and gives what is left
to the best fit. It says how many sequences have which lengths; a piece finds its
place from its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from apptflow.llm.common import chunks, keyed, lean, plain, stored, text_bytes

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: parts of texts whose ids a Python worker remembers, and their bytes
MEMO_PARTS = 250_000
MEMO_BYTES = 12 << 20
#: text that is tokenised at once
CHUNK_BYTES = 1 << 20
#: a length's pieces are ranked in so many independent parts
RANK_PARTS = 256
SHIFT = 44


# ------------------------------------------------------------------- tokenising

# bytes by what they do to a token: white space parts words; runs of letters, single digits
# and runs of other signs are tokens' borders; the rest leaves its whole word to the tokenizer
_GAP, _LETTER, _DIGIT, _OTHER, _WHOLE = range(5)
_KIND = np.full(256, _WHOLE, np.uint8)
_KIND[33:127] = _OTHER
_KIND[[9, 10, 11, 12, 13, 32]] = _GAP
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[[ord("'"), ord("<")]] = _WHOLE  # endings such as 's, and special tokens
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# what is cut out of words below: no byte of a word that is left whole
_CUT = re.compile(rb"(?:[!-&(-;=-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level tokenizers write for each byte: itself if it can be seen
    in Latin-1, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: b for b in seen} | {b: 256 + k for k, b in enumerate(rest)}


def parts_of(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Parts of texts that are tokenised each by itself, and the parts before each text.

    Texts are joined in ``data``; text k begins at ``ends[k]``. Parts are lower-cased, but
    for words that are left whole.
    """
    n = len(data)
    kind, low = _KIND[data], _LOWER[data]
    # letters of Latin-1 with two bytes: all but the two signs among them
    lead = np.flatnonzero(data[:-1] == 0xC3)
    follow = data[lead + 1]
    lead = lead[((follow & 0xC0) == 0x80) & (follow != 0x97) & (follow != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    upper = lead[data[lead + 1] <= 0x9E] + 1
    low[upper] += 0x20

    held = kind != _GAP
    first = held.copy()
    first[1:] &= ~held[:-1]
    edge = ends[(ends > 0) & (ends < n)]
    first[edge] = held[edge]
    begin = first.copy()
    begin[1:] |= held[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    if (kind == _WHOLE).any():
        words = np.flatnonzero(first)
        whole = np.zeros(n, bool)
        whole[held] = np.repeat(
            np.logical_or.reduceat(kind == _WHOLE, words),
            np.diff(np.append(np.searchsorted(np.flatnonzero(held), words), held.sum())),
        )
        begin &= ~whole | first
        low = np.where(whole, data, low)
    place = np.cumsum(held, dtype=np.int32) - held  # a chunk is no longer than that
    offsets = np.append(place[begin], held.sum()).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(low[held])]
    )
    return parts, np.searchsorted(np.flatnonzero(begin), ends)


class Tokens:
    """Token ids of texts, as the tokenizer gives them without special tokens of its own.

    White space always parts tokens, and so do the borders between letters, digits and other
    signs: the ids of a text are those of its parts. Parts are numbered by text in Arrow,
    the ids of those seen before are remembered in flat arrays, and only new ones are
    tokenised. Parts of letters of Latin-1, digits and plain signs go to the tokenizer's
    model directly; words with anything else go to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.parts = pa.array([], pa.large_binary())
        self.ids = np.zeros(0, np.uint32)
        self.cuts = np.zeros(1, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text column from ``plain``, all in one array, and where each text begins."""
        data, ends = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        parts, before = parts_of(data, ends)
        if len(self.parts) > MEMO_PARTS or self.parts.nbytes > MEMO_BYTES:
            self._forget()
        coded = parts.dictionary_encode()
        part = self._known(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        size = self.cuts[part + 1] - self.cuts[part]
        done = np.cumsum(size)
        at = np.arange(done[-1] if len(done) else 0)
        at += np.repeat(self.cuts[part] - done + size, size)
        return self.ids[at], np.append(0, done)[before]

    def _forget(self) -> None:
        """Drops the older half of the parts."""
        half = len(self.parts) // 2
        # a copy: a slice would keep all of them
        self.parts = self.parts.take(pa.array(np.arange(half, len(self.parts))))
        self.ids = self.ids[self.cuts[half] :].copy()
        self.cuts = self.cuts[half:] - self.cuts[half]

    def _known(self, parts: pa.Array) -> np.ndarray:
        """The number of each part among the remembered ones, to which new ones are added."""
        place = pc.index_in(parts, value_set=self.parts)
        new = pc.is_null(place).to_numpy(zero_copy_only=False)
        out = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if new.any():
            fresh = parts.filter(pa.array(new))
            ids = self._tokenised(fresh.to_pylist())
            out[new] = len(self.parts) + np.arange(len(ids))
            self.parts = pa.concat_arrays([self.parts, fresh])
            self.ids = np.concatenate([self.ids, np.array([i for own in ids for i in own], np.uint32)])
            sizes = np.cumsum(np.array([len(own) for own in ids], np.int64))
            self.cuts = np.concatenate([self.cuts, self.cuts[-1] + sizes])
        return out

    def _tokenised(self, parts: list[bytes]) -> list[list[int]]:
        letters, tokenize = self.letters, self.model.tokenize
        whole = [k for k, p in enumerate(parts) if not _CUT.fullmatch(p)]
        out: list = [
            [t.id for t in tokenize(p.decode("latin-1").translate(letters))] if _CUT.fullmatch(p) else None
            for p in parts
        ]
        for k, ids in zip(whole, self._words([parts[k].decode() for k in whole]), strict=True):
            out[k] = ids
        return out

    def _words(self, words: list[str]) -> list[list[int]]:
        """Ids of words that are left whole; many share one call."""
        out: list[list[int]] = []
        for at in range(0, len(words), 2000):
            group = words[at : at + 2000]
            done = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in group])
            starts = np.fromiter((o[0] for o in done.offsets), np.int64, len(done.ids))
            cut = [0, *np.searchsorted(starts, ends).tolist()]
            out += [done.ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        return out


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the tokenizer is on this machine; asked by each worker for itself."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, _th, piece, start, length, ids_crc32): what has to be packed."""
    names = ["doc_id", "_th", "piece", "start", "length", "ids_crc32"]

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens(tokenizer_path(tokenizer))
        for whole in parts:
            for part in chunks(whole, size=CHUNK_BYTES):
                ids, begin = coder.encode(plain(part.column("text")))
                ids = np.insert(ids, begin[1:], end_id).astype("<u4", copy=False)
                begin = begin + np.arange(len(begin))
                count = -(-np.diff(begin) // capacity)
                take = np.repeat(np.arange(part.num_rows), count)
                piece = np.arange(len(take)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                low = begin[take] + start
                high = np.minimum(low + capacity, begin[take + 1])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                rows = pa.array(take)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(rows),
                        part.column("_th").take(rows),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(high - low),
                        pa.array(crc, pa.int64()),
                    ],
                    names,
                )

    return docs.mapInArrow(
        lean(batch), "doc_id long, _th long, piece int, start long, length long, ids_crc32 long"
    )


# ------------------------------------------------------------------------- plan


@dataclass
class Plan:
    """Runs of equal sequences: pieces of one length take consecutive places of a run.

    Row k: the pieces of ``length`` with ranks from ``rank`` on, up to the next row of
    that length, lie at ``offset`` of the sequences from ``sequence`` on.
    """

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    exact: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (self.length << SHIFT) + self.rank
        at = np.searchsorted(keys, (length << SHIFT) + rank, "right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


class _Index:
    """Lengths on hand, and which pairs and triples of lengths add up to a sum."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.capacity = len(left) - 1
        have = np.flatnonzero(left)
        self.pairs: dict[int, np.ndarray] = {}
        sums = have[:, None] + have[None, :]
        first, second = np.nonzero((have[:, None] >= have[None, :]) & (sums <= self.capacity))
        total, larger = have[first] + have[second], have[first]
        # larger parts first: short pieces stay for gaps that need them
        order = np.lexsort((-larger, total))
        total, larger = total[order], larger[order]
        cut = np.flatnonzero(np.diff(total)) + 1
        if len(total):
            self.pairs = dict(zip(total[[0, *cut]].tolist(), np.split(larger, cut), strict=True))
        present = np.zeros(self.capacity + 1, np.int64)
        present[have] = 1
        two = np.zeros(self.capacity + 1, np.int64)
        two[list(self.pairs)] = 1
        self.triples = np.convolve(present, two)[: self.capacity + 1] > 0

    def pair(self, gap: int, prune: bool = True) -> tuple[int, int] | None:
        large = self.pairs.get(gap)
        if large is None or not len(large):
            return None
        small = gap - large
        ok = np.flatnonzero((self.left[large] > 0) & (self.left[small] > (large == small)))
        if not len(ok):
            return None
        if prune:  # a length that is used up does not come back
            self.pairs[gap] = large[ok[0] :]
        return int(large[ok[0]]), int(small[ok[0]])

    def triple(self, gap: int) -> tuple[int, int, int] | None:
        if not self.triples[gap]:
            return None
        for a in np.flatnonzero(self.left[:gap])[::-1].tolist():
            if a * 3 < gap:
                break
            self.left[a] -= 1
            two = self.pair(gap - a, prune=False) if gap > a else None
            self.left[a] += 1
            if two and two[0] <= a:
                return (a, *two)
        self.triples[gap] = False
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        if gap <= self.capacity and self.left[gap] > 0:
            return (gap,)
        return self.pair(gap) or self.triple(gap)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """How to pack ``counts[length]`` pieces of each length.

    The longest piece left opens a sequence. If one, two or three lengths on hand fill
    its gap exactly, they do; otherwise the longest piece that fits goes in and the
    rest of the gap is treated the same way. Each step is done at once as often as
    the counts allow, so the work depends on the number of lengths only.
    """
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    index = _Index(left)
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int]] = []
    sequences = exact = 0
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            break
        chosen, gap = [top], capacity - top
        left[top] -= 1
        filled = gap == 0
        while gap:
            more = index.exact(gap)
            if more:
                chosen += more
                for m in more:
                    left[m] -= 1
                gap, filled = 0, True
                break
            fits = np.flatnonzero(left[: gap + 1])
            if not len(fits):
                break
            best = int(fits[-1])
            chosen.append(best)
            left[best] -= 1
            gap -= best
        for c in chosen:
            left[c] += 1
        need = {c: chosen.count(c) for c in chosen}
        times = min(int(left[c]) // k for c, k in need.items())
        at = 0
        for c in chosen:
            rows.append((c, int(used[c]), sequences, at))
            used[c] += times
            left[c] -= times
            at += c
        sequences += times
        exact += times * filled
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return Plan(*cols, sequences, exact)


# ---------------------------------------------------------------------- operator


def pack(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece of every document, with its place in a sequence.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or
    empty text is the closing id alone. The string of a special token in a text is that
    token, as the tokenizer reads it; none are added. Every row is packed, repeated rows too. An
    empty table gives an empty result. A null doc_id is kept. Other columns are ignored.

    Pieces of one length are ranked in ``RANK_PARTS`` parts side by side, so a length
    that most pieces have (whole sequences, copies) is spread over many tasks.
    """
    rows = pieces(keyed(docs), tokenizer, capacity, end_id)
    part = F.pmod(F.xxhash64("doc_id", "_th", "piece"), F.lit(RANK_PARTS)).cast("int")
    rows = stored(rows.withColumn("_part", part), "pieces")
    counts = rows.groupBy("length", "_part").agg(F.count("*").alias("n"))
    sized = stored(counts, "lengths")
    totals = {r.length: r.n for r in sized.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    done = plan(totals, capacity)

    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    base = sized.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "_th")
    ranked = rows.withColumn("_own", F.row_number().over(order) - 1).join(base, ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_own"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            size = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = done.places(size, rank)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in out), pa.array(sequence), pa.array(offset)],
                [*out, "sequence_id", "offset"],
            )

    return ranked.select(*out, "_rank").mapInArrow(
        lean(place),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
