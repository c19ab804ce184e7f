"""Decontamination, substring dedup, SimHash and packing against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from apptflow.llm import decontaminate, packing, queries, simhash, substrings
from apptflow.llm.common import Words, components, keyed, plain, stored

ODD = [None, "", " \n\t", "a", "A", "é", "word", "x " * 3000, "x " * 3000, "y" * 40_000]


def corpus(seed: int, n: int = 60, vocabulary: int = 40) -> list[tuple[int | None, str | None]]:
    """Documents with shared passages, copies, near copies, repeated rows and odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}," for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(160)]
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        kind = rng.randrange(5)
        if kind == 1:
            a = rng.randrange(100)
            text += passage[a : a + rng.randint(40, 62)] + [rng.choice(words) for _ in range(5)]
        elif kind == 2 and out:
            text = (rng.choice(out)[1] or "").split(" ")
        elif kind == 3 and out:
            text = (rng.choice(out)[1] or "").split(" ")
            text[rng.randrange(len(text))] = "changed"
        out.append((rng.randrange(10 * n), rng.choice([" ", "  ", "\n"]).join(text)))
    out += [(1000 * n + i, t) for i, t in enumerate(ODD)]
    out += out[:5] + [(None, out[3][1]), (None, "alone")]
    return out


# ----------------------------------------------------------------- decontamination


def words_of(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_overlaps(docs, items):
    windows: dict[tuple[str, ...], set[int]] = {}
    for i, text in items:
        w = words_of(text)
        size = min(10, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).add(i)
    sizes = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w, hit, found = words_of(text), set(), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                if (key := tuple(w[a : a + size])) in windows:
                    hit.update(range(a, a + size))
                    found |= windows[key]
        out.append((d, len(w), len(hit), sorted(x for x in found if x is not None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps_equal_brute_force(spark, make_docs, seed):
    docs = corpus(seed)
    rng = random.Random(seed)
    items = [(7, "w1 É3,"), (8, None), (9, ""), (7, "w2"), (11, "changed")]
    for i in range(15):
        w = (rng.choice(docs)[1] or "").split()
        a = rng.randrange(len(w) + 1)
        items.append((20 + i, " ".join(w[a : a + rng.randint(1, 30)])))
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, size int")
    got = decontaminate.overlaps(make_docs(docs), table).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=repr)
    assert got == brute_overlaps(docs, items)
    clean = decontaminate.clean(make_docs(docs), table)
    assert clean.columns == make_docs(docs).columns
    assert clean.count() == sum(not hit for _, _, hit, _ in got)


def test_overlaps_of_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.overlaps(make_docs([]), one).collect() == []
    rows = decontaminate.overlaps(make_docs([(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.item_ids) for r in rows] == [(2, 0, [])]


def test_clean_passes_on_columns_with_names_used_inside(spark):
    names = ["_id", "_t", "_th", "text", "doc_id", "n_hit", "c0"]
    rows = [(1, 2, 3, "one two three", 5, 6, 7), (1, 2, 3, None, None, 6, 7), (1, 2, 3, "a b", 5, 6, 7)]
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names))
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    clean = decontaminate.clean(docs, items)
    assert clean.columns == names
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted(map(tuple, rows[1:]), key=repr)


def test_contamination_digests(spark, make_docs, tmp_path):
    docs = corpus(3)
    rng = random.Random(3)
    items = [(100 - i, " ".join((rng.choice(docs)[1] or "").split()[: rng.randint(1, 14)])) for i in range(30)]
    make_docs(docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted((tuple(r) for r in queries.op2_decontamination(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for d, n, hit, ids in brute_overlaps(docs, items):
        listed = ",".join(sorted(map(str, ids)))
        want.append((d, n, hit, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hit > 0))
    assert got == sorted(want, key=repr)


# ---------------------------------------------------------------- substring dedup


def brute_substrings(docs, span):
    def split(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text or "")

    first: dict[tuple[str, ...], int] = {}
    for d, text in docs:
        w = split(text)
        for a in range(len(w) - span + 1 if d is not None else 0):
            key = tuple(w[a : a + span])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, text in docs:
        w, gone = split(text), set()
        for a in range(len(w) - span + 1 if d is not None else 0):
            if first[tuple(w[a : a + span])] < d:
                gone.update(range(a, a + span))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "span", "gram"), [(1, 50, 16), (2, 50, 16), (3, 12, 4), (4, 6, 2)])
def test_substrings_equal_brute_force(make_docs, seed, span, gram):
    docs = corpus(seed, vocabulary=40 if span > 20 else 6)
    got = substrings.dedup(make_docs(docs), span, gram).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr)
    assert got == brute_substrings(docs, span)


def test_words_that_collide_in_a_polynomial_are_told_apart(make_docs):
    """A Thue-Morse word and its inverse have equal polynomials modulo 2**64 in any base."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    for size in (64, 256, 1024, 4096):
        pair = [word[:size], word[:size].translate(str.maketrans("ab", "ba"))]
        around = [f"w{i}" for i in range(60)]
        docs = [(i, " ".join([*around[:30], odd, *around[30:]])) for i, odd in enumerate(pair)]
        got = {r.doc_id: r.n_removed for r in substrings.dedup(make_docs(docs)).collect()}
        assert got == {0: 0, 1: 0}, size


def test_hashes_of_words_follow_their_bytes():
    rng = random.Random(4)
    texts = {bytes(rng.choices(b"ab\x01\xff", k=n)) for n in [*range(1, 40), 511, 512, 513, 600] for _ in range(20)}
    texts = sorted(texts)
    every = np.ones(256, bool)
    every[32] = False
    column = plain(pa.array([b" ".join(texts), b"", b"x " + texts[0]], pa.large_binary()))
    hashes = Words(column, every).hashes()
    assert len(set(hashes.tolist())) == len(texts) + 1
    assert hashes[-1] == hashes[0]


def test_factors_name_the_words_they_repeat(make_docs):
    docs = [d for d in corpus(1) if d[0] is not None]
    rows = keyed(make_docs(docs))
    texts = {(r.doc_id, r._th): r.text.split() for r in rows.collect()}
    _, factors = substrings.parse(rows, 50, 16)
    found = {tuple(r) for r in factors.select("doc_id", "_th", "start", "end", "ref_doc", "ref_th", "ref_start").collect()}
    assert len(found) > 10
    for d, t, a, b, ref, ref_t, at in found:
        assert ref < d and b - a >= 50
        assert texts[d, t][a:b] == texts[ref, ref_t][at : at + b - a]
    assert max(b - a for _, _, a, b, *_ in found) > 100  # pieces run together on one reference


def test_substrings_of_an_empty_table(make_docs):
    assert substrings.dedup(make_docs([])).collect() == []


# ------------------------------------------------------------------------ simhash


def brute_fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, f) in enumerate(rows):
        for j in range(i):
            if (f ^ rows[j][1]).bit_count() <= 2:
                group[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, f, least.get(root(i))) for i, (d, f) in enumerate(rows)), key=repr)


def test_simhash_equals_brute_force(make_docs):
    docs = corpus(5)
    long = [f"t{i}" for i in range(900)]
    for i in range(25):  # near copies: a few words differ
        text = list(long)
        text[30 * i] = "other"
        docs.append((50_000 + i, " ".join(text)))
    got = simhash.near_duplicates(make_docs(docs)).collect()
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr)
    want = brute_classes([(d, brute_fingerprint(t)) for d, t in docs])
    assert got == want
    assert any(c is not None and c != d for d, _, c in got if d is not None and d >= 50_000)


@pytest.mark.parametrize("node_rows", [1 << 16, 40])
def test_trie_links_equal_brute_force(spark, node_rows):
    """Random and close fingerprints; a small node size makes blocks of one node."""
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    for v in list(values)[:60]:
        values |= {v ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3)}
    ball = rng.getrandbits(64)
    values |= {ball ^ b for b in range(256)}
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.trie_links(spark.createDataFrame(rows, "fp long"), node_rows=node_rows).collect()
    got = [frozenset((r.f % (1 << 64), r.g % (1 << 64))) for r in links]
    want = {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == want


def test_each_group_keeps_one_row_whatever_its_ids_are(make_docs):
    rng = random.Random(8)
    a, b, c, d, e = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(40)) for x in "abcde")
    docs = make_docs([(None, a), (None, a), (None, b), (7, c), (7, d), (7, d), (3, d), (None, c), (9, e)])
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(None, a), (None, b), (7, c), (3, d), (9, e)], key=repr)


def shuffled_rows(df) -> int:
    """Rows that the exchanges of a collected frame have written."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        written = node.metrics().get("shuffleRecordsWritten")
        total += written.get().value() if written.isDefined() else 0
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        else:
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_texts_that_stay_for_sure_are_not_shuffled(spark, make_docs):
    """Also where the keys of the rows that go are too many for a broadcast."""
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(400)]
    rows = [*enumerate(texts), *((1000 + k, texts[k]) for k in range(40)), (5, texts[5])]
    docs = stored(make_docs(rows), "docs")  # its own exchange is not in the plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash.representatives(docs)
        got = sorted((r.doc_id, r.text) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == list(enumerate(texts))
    # of 441 rows 42 are in question
    assert 0 < shuffled_rows(kept) < 400


def test_marks_miss_no_key_at_any_number_of_places(spark, make_docs, monkeypatch):
    """Marks that others share cost a look-up, not a row."""
    monkeypatch.setattr(simhash, "MARK_PLACES", 1)
    test_each_group_keeps_one_row_whatever_its_ids_are(make_docs)


def test_tables_of_few_rows_get_few_files(spark):
    """Rounds that store small tables do not write one file a shuffle partition."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.range(1, 500).select((F.col("id") - F.col("id") % 10).alias("f"), F.col("id").alias("g"))
        found = components(links, "f", "g")
        files = found.inputFiles()
        got = {r.node: r.component for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 10 for i in range(500)}
    assert len(files) == 1


def test_simhash_of_an_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []


# ------------------------------------------------------------------------ packing


def test_packing_is_whole_and_gapless(make_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    docs = corpus(6) + [(77_000, "Σας ΟΔΟΣ <|endoftext|> don't it's x y é 日本語 \x1c z 12"), (77_001, "end ΟΔΟΣ")]
    got = packing.pack(make_docs(docs)).collect()
    want = []
    for d, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), 2048)):
            cut = ids[a : a + 2048]
            want.append((d, p, a, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 1


def test_packing_uses_exact_complements():
    plan = packing.plan({1500: 3, 548: 1, 300: 1, 248: 1, 200: 2, 148: 1}, 2048)
    assert plan.sequences == 3 and plan.exact == 3
    rng = np.random.default_rng(3)
    for n in (1, 7, 5000):
        sizes = rng.integers(1, 2049, n)
        values, counts = np.unique(sizes, return_counts=True)
        plan = packing.plan(dict(zip(values.tolist(), counts.tolist(), strict=True)))
        rank = np.concatenate([np.arange(c) for c in counts])
        sequence, offset = plan.places(np.repeat(values, counts), rank)
        filled = np.bincount(sequence, np.repeat(values, counts), plan.sequences)
        assert filled.max() <= 2048 and filled.min() > 0
        assert (offset + np.repeat(values, counts) <= 2048).all()


def test_packing_of_an_empty_table(make_docs):
    assert packing.pack(make_docs([])).collect() == []
