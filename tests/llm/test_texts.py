"""Resampling, periodic runs and line dedup against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from apptflow.llm import lines, periodic, queries, resample

ODD = [None, "", " \n\t", "\n\n", "a", "É", "x " * 3000, "x " * 3000, "y" * 40_000, "a\x00b \x1f c"]


def write(tmp_path, **tables) -> str:
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------------- lines


def line_documents(seed: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    pool = [f"{'Shared' if i % 2 else 'Grüße'} line number {i} of the pool" for i in range(12)]
    pool += ["short", "exactly twenty chars", "nineteen characters", ""]
    out: list[tuple[int | None, str | None]] = []
    for _ in range(80):
        own = []
        for _ in range(rng.randint(1, 9)):
            line = rng.choice(pool) if rng.random() < 0.6 else f"own line {rng.random()} of a document"
            line = rng.choice([str, str.upper, str])(line) if line.isascii() else line
            own.append(rng.choice(["", " ", "\t\x0b", " "]) + line + rng.choice(["", "  ", "\r"]))
        out.append((rng.randrange(70), "\n".join(own)))
    out += [(1000 + i, t) for i, t in enumerate(ODD)]
    return out + out[:4] + [(None, out[0][1]), (None, out[1][1])]


def brute_lines(docs):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    holders: dict[str, set[int]] = {}
    rank = lambda d: -(1 << 63) if d is None else d
    for d, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(rank(d))
    out = []
    for d, text in docs:
        parts = (text or "").split("\n")
        kept = [
            x for x in parts
            if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) > rank(d))
        ]
        out.append((d, len(parts), len(parts) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(spark, make_docs, tmp_path, seed):
    docs = line_documents(seed)
    sf = write(tmp_path, documents=make_docs(docs))
    got = sorted((tuple(r) for r in queries.op13_lines(spark, sf).collect()), key=repr)
    assert got == brute_lines(docs)
    assert any(n for _, _, n, _ in got)


def test_lines_keep_the_rest_of_the_text(make_docs):
    line = "A line that three documents share"
    docs = [(i, f"first {i}\n  {line.upper() if i else line} \nlast\n") for i in range(3)]
    got = {r.doc_id: r.text for r in lines.dedup(make_docs(docs)).collect()}
    assert got == {0: "first 0\nlast\n", 1: "first 1\nlast\n", 2: docs[2][1]}


def test_lines_of_an_empty_table(make_docs):
    assert lines.dedup(make_docs([])).collect() == []


def test_one_hot_line_is_counted_in_parts(make_docs):
    docs = [(i, f"the line that every document has\nown {i % 7}") for i in range(400)]
    got = {r.doc_id: r.n_dropped for r in lines.dedup(make_docs(docs)).collect()}
    assert got == {i: int(i != 399) for i in range(400)}


# --------------------------------------------------------------------- resampling


def features(text: str | None) -> list[str]:
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def brute_resample(docs, items):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s, t = np.zeros(10000), np.zeros(10000)
    for _, text in docs:
        for f in features(text)[0]:
            s[bucket(f)] += 1
    for _, text in items:
        for f in features(text)[0]:
            t[bucket(f)] += 1
    gain = [
        math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000))))
        for a, b in zip(s, t, strict=True)
    ]
    rows = []
    for d, text in docs:
        own, n = features(text)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(sha(f"42:{'' if d is None else d}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(own), weight, score, None, n])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(able[: 5 * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_resampling_equals_brute_force(spark, make_docs, tmp_path, seed):
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}," for i in range(60)] + ["long" * 40, "Q"]
    some = [(i, rng.choice([" ", "\n", "--"]).join(rng.choices(words, k=rng.randrange(60)))) for i in range(300)]
    docs = some + some[:3] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, some[5][1])]
    items = [(i, " ".join(rng.choices(words[:9], k=rng.randrange(30)))) for i in range(12)] + [(3, None)]
    sf = write(
        tmp_path,
        documents=make_docs(docs),
        benchmark=spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, score string"),
    )
    got = sorted((tuple(r) for r in queries.op11_resampling(spark, sf).collect()), key=repr)
    assert got == brute_resample(docs, items)
    assert max(r[4] or 0 for r in got) > 5


def test_resampling_ranks_ties_by_id(spark, make_docs):
    docs = [(None if i == 70 else 100 + i % 70, "one word " * 10) for i in range(140)]
    none = spark.createDataFrame([], "item_id long, text string")
    got = resample.resample(make_docs(docs), none, percent=50).collect()
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 71))
    assert all((-a.score, a.doc_id) <= (-b.score, b.doc_id) for a, b in zip(drawn, drawn[1:]))


def test_resampling_of_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(make_docs([]), none).collect() == []
    rows = resample.resample(make_docs([(1, "a b"), (2, None)]), none).collect()
    assert {(r.doc_id, r.n_features, r["rank"]) for r in rows} == {(1, 3, None), (2, 0, None)}


def test_crc_of_joined_words():
    rng = random.Random(3)
    sizes = [0, 1, 2, 5, 62, 63, 64, 65, 200, 5000]
    for _ in range(60):
        a, b = rng.randbytes(rng.choice(sizes)), rng.randbytes(rng.choice(sizes))
        moved = resample.crc_shift(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))
        assert int(moved[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


# ----------------------------------------------------------------------- periodic


def brute_runs(w: list) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, also short ones."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def periodic_words(rng: random.Random) -> list[int]:
    kind, n = rng.randrange(7), rng.randrange(200)
    if kind < 2:
        return [rng.randrange(2 + 3 * kind) for _ in range(n)]
    if kind == 2:
        block = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        return [rng.randrange(3) for _ in range(9)] + (block * 12)[:n] + [rng.randrange(3) for _ in range(9)]
    if kind == 3:  # touching stretches of one small period
        return (([0, 1] * rng.randrange(1, 40) + [0]) * rng.randrange(1, 5))[:300]
    if kind == 4:
        out = []
        for _ in range(rng.randrange(1, 6)):
            out += [rng.randrange(2) for _ in range(rng.randrange(1, 4))] * rng.randrange(1, 30)
        return (out + out)[: rng.randrange(1, 300)]
    if kind == 5:  # Fibonacci word: as many runs as possible
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    w = [0]  # Thue-Morse word and its inverse
    while len(w) < n:
        w += [1 - x for x in w]
    return w + [1 - x for x in w]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = sorted((periodic_words(rng) for _ in range(rng.randrange(1, 7))), key=len, reverse=True)
        values, expected, at = [], [], 0
        for k, d in enumerate(docs):
            expected += [(s + at, e + at, q) for s, e, q in brute_runs(d)]
            values += [*d, 1000 + k]
            at += len(d) + 1
        runs = periodic.find_runs(np.array(values, np.int64), np.array([len(d) for d in docs], np.int64))
        got = sorted(zip(runs.start.tolist(), runs.end.tolist(), runs.period.tolist(), strict=True))
        assert got == sorted(expected)


def brute_periodic(docs):
    out = []
    for d, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), 1 if d is None else zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, full = g % n, list(w)
            p = 1 + (n - a) // (3 + g % 8)
            w = [full[i] if i < a else full[a + (i - a) % p] for i in range(n)]
        runs = [(s, e - s, q) for s, e, q in brute_runs(w) if e - s >= 12]
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
        ratio = 1000 * best[1] // best[2] if runs else None
        listed = sha("".join(f"{s},{size},{q}\n" for s, size, q in runs))
        kept = sha(" ".join(x for i, x in enumerate(w) if i not in gone))
        out.append((d, len(runs), *best, ratio, listed, kept))
    return sorted(out, key=repr)


def test_periodic_equals_brute_force(spark, make_docs, tmp_path):
    rng = random.Random(7)
    docs: list[tuple[int | None, str | None]] = []
    for i in range(150):
        w = periodic_words(rng) if i % 3 else [rng.randrange(500) for _ in range(rng.randrange(200))]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(f"é{x}" for x in w)))
    docs += docs[:5] + [(None, docs[1][1])] + [(1000 + i, (t or "")[:400] or t) for i, t in enumerate(ODD)]
    sf = write(tmp_path, documents=make_docs(docs))
    got = sorted((tuple(r) for r in queries.op12_periodic(spark, sf).collect()), key=repr)
    assert got == brute_periodic(docs)


def test_long_periodic_text_in_linear_steps(make_docs):
    block = [f"w{i}" for i in range(9000)]
    text = " ".join(["ab cd"] * 30_000 + ["ab"] + block * 3)
    (row,) = periodic.collapse(make_docs([(1, text)])).collect()
    found = list(zip(row.starts, row.lengths, row.periods, strict=True))
    assert found == [(0, 60_001, 2), (60_001, 27_000, 9000)]
    assert row.text == " ".join(["ab cd", *block])


def test_periodic_of_an_empty_table(make_docs):
    assert periodic.collapse(make_docs([])).collect() == []
