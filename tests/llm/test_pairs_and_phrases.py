"""Set join, hard negatives and phrases against brute force on small awkward tables."""

import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from recordloom.llm import collocations, hard_negatives, jaccard_join, queries
from recordloom.llm.blocks import blocks, distinct_pairs, shingles, words

DDL = "doc_id bigint, text string, lang string, node bigint, bucket string, w1 int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def family(r, base, edits):
    words = list(base)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    """Copies of several sizes around the threshold, chains, tiny and long texts, nulls, repeats."""
    r = random.Random(3)
    out = [None, "", " \t\n", "One", "one", "a b", "A  B", "a b c", "x" * 5000, "é ü ß é ü ß é ü"]
    for size in (4, 12, 20, 33, 60, 150, 400):
        base = [f"w{r.randrange(10**6)}" for _ in range(size)]
        out += [family(r, base, e) for e in (0, 0, 1, 1, 2, 3, 4, 6, 8)]
        chain = list(base)
        for _ in range(6):  # each like the next only
            chain[r.randrange(size)] = f"step{r.randrange(10**6)}"
            out.append(" ".join(chain).upper())
        out.append(" ".join(base[: max(1, size * 95 // 100)]))
    big = [f"v{i % 700}" for i in range(6000)]
    out += [" ".join(big), " ".join(big[:-50]), " ".join([*big, *(f"tail{i}" for i in range(400))])]
    return out


def sets_of(texts, size):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def components(rows, sets, numerator):
    up = {i: i for i in range(len(rows))}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in itertools.combinations(range(len(rows)), 2):
        both = len(sets[x] & sets[y])
        if sets[x] and sets[y] and 100 * both >= numerator * (len(sets[x]) + len(sets[y]) - both):
            up[root(x)] = root(y)
    least = {}
    for x, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(x)] = min(least.get(root(x), doc_id), doc_id)
    return [least.get(root(x)) for x in range(len(rows))]


@pytest.mark.parametrize("block", [1024, 3])
def test_op11(spark, texts, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = [(i * 3 % 997, t, "en", 1, "b", 0) for i, t in enumerate(texts)] + [(0, texts[0], "en", 1, "b", 0), (30, texts[20], None, None, None, None), (None, texts[20], None, None, None, None), (None, None, None, None, None, None)]
    sets = sets_of([x[1] for x in rows], 3)
    want = sorted(((x[0], len(s), c) for x, s, c in zip(rows, sets, components(rows, sets, 90), strict=True)), key=repr)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, DDL).repartition(5))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DDL)).count() == 0


def test_op11_finds_all_links_of_a_large_family(spark, monkeypatch):
    """No hub: members are like a few others only, over more rows than a block has."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    r = random.Random(8)
    base = [f"w{i}" for i in range(90)]
    rows = [(i, family(r, base, r.choice([1, 2, 3])), None, None, None, None) for i in range(70)]
    sets = sets_of([x[1] for x in rows], 3)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, DDL).repartition(3))
    assert [c for _, _, c in sorted(map(tuple, got.collect()))] == components(rows, sets, 90)


def test_segments_never_miss_a_link():
    """Linked sets share a bucket, and parities never reject them."""
    r, links = random.Random(1), 0
    for size in (1, 2, 3, 5, 8, 9, 10, 11, 18, 19, 20, 21, 38, 57, 95, 200, 640):
        for _ in range(6):
            a = sorted({r.getrandbits(64) for _ in range(size)})
            drop, add = r.randrange(size // 9 + 1), r.randrange(size // 9 + 1)
            b = sorted({*a[drop:], *(r.getrandbits(64) for _ in range(add))}) or a
            both = len(set(a) & set(b))
            h = np.array(a + b, np.uint64)
            n = np.array([len(a), len(b)])
            x, y = jaccard_join.signatures(np.repeat([0, 1], n), h, n)
            if 100 * both >= 90 * (len(a) + len(b) - both):
                links += 1
                assert set(x.tolist()) & set(y.tolist())
                p, q = (jaccard_join.parity(np.array(v, np.uint64)) for v in (a, b))
                assert len(jaccard_join.passing(len(a), p, np.array([len(b)]), {len(q): q[None]}, np.array([[len(q), 0]]))) == 1
    assert links > 50


def test_sets_with_many_empty_segments_meet():
    """All n-grams in one fragment: only the bucket of such sets is left."""
    low = np.arange(1, 21, dtype=np.uint64)
    other = np.concatenate([low[:-1], [np.uint64(77)]])
    h, n = np.concatenate([low, np.sort(other)]), np.array([20, 20])
    x, y = jaccard_join.signatures(np.repeat([0, 1], n), h, n)
    assert set(x.tolist()) & set(y.tolist())


def negatives_by_hand(rows, low=30, high=90):
    live = []
    for i, vec, label in dict.fromkeys((i, None if v is None else tuple(v), c) for i, v, c in rows):
        if i is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        live.append((i, [math.floor(256 * x) for x in vec], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a in live:
        if a[0] % 100:
            continue
        score = lambda b: sum(x * y for x, y in zip(a[1], b[1]))  # noqa: B023, E731
        liked = sorted((-score(b), b[0]) for b in live if b[2] == a[2] and b[0] != a[0])[:5]
        for s, p in liked:
            hit = sorted((-score(b), b[0]) for b in live if b[2] != a[2] and low * -s <= 100 * score(b) <= high * -s)[:10]
            out += [(a[0], p, k + 1, x, -s, -t) for k, (t, x) in enumerate(hit)]
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<double>, label int, v string, cell int"


@pytest.mark.parametrize(("cell", "shard", "requests"), [(4096, 4096, 4096), (20, 16, 2)])
def test_op12(spark, cell, shard, requests, monkeypatch):
    for name, value in (("CELL", cell), ("SHARD", shard), ("REQUESTS", requests)):
        monkeypatch.setattr(hard_negatives, name, value)
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 5))
    rows = [(i * 4 % 2003, (centres[i % 6] + r.normal(size=5) * 0.3).round(2).tolist(), i % 4) for i in range(700)]
    rows += [(5000 + i, rows[0][1], i % 2) for i in range(60)]  # a common vector
    rows += [(100, [0.0] * 5, 1), (200, [0.0] * 5, 1), (300, [1.0], 2), (-100, [1.0, 1.0], 2), (-7, [], 3), (9000, [1.5, -2.0, 0.1, 3.0, 4.0], 77)]
    rows += [(9001, None, 1), (9002, [1.0, None, 1.0, 1.0, 1.0], 1), (9100, [float("nan")] * 5, 1), (9200, [float("inf")] * 5, 1), (None, [1.0] * 5, 1), (9300, [1.0] * 5, None)]
    rows += [rows[3], rows[0], (100, rows[5][1], 3)]
    r.shuffle(rows := [tuple(x) for x in rows])
    table = spark.createDataFrame([(a, b, c, "x", 1) for a, b, c in rows], VECTORS).repartition(4)
    assert sorted(map(tuple, hard_negatives.hard_negatives(table).collect())) == negatives_by_hand(rows)
    assert hard_negatives.hard_negatives(table.limit(0)).count() == 0


def test_op12_large_components(spark):
    rows = [(i, [float(1 << 20) + i, 3.0 * i, -1.0], i % 3) for i in range(0, 400, 20)]
    table = spark.createDataFrame([(a, b, c, "x", 1) for a, b, c in rows], VECTORS)
    assert sorted(map(tuple, hard_negatives.hard_negatives(table).collect())) == negatives_by_hand(rows)
    with pytest.raises(Exception, match="32 bits"):
        hard_negatives.hard_negatives(spark.createDataFrame([(1, [1e30], 1, "x", 1)], VECTORS)).collect()


def test_shard_search_prunes_and_is_exact():
    r = np.random.default_rng(0)
    n, x = 12_000, r.normal(size=(12_000, 3))
    vectors = np.floor(256 * x / np.sqrt((x * x).sum(axis=1))[:, None]).astype(np.int64)
    labels, ids = r.integers(0, 3, n), np.arange(n)
    shard = hard_negatives.Shard(ids, labels, vectors, float((vectors.astype(float) ** 2).sum(axis=1).max()))
    looked, real = [], hard_negatives.exact_scores
    hard_negatives.exact_scores = lambda rows, *rest: (looked.append(len(rows)), real(rows, *rest))[1]
    try:
        for a in range(0, n, 300):
            score = vectors @ vectors[a]
            windows = [(int(score[a] * lo), int(score[a] * 0.95)) for lo in (0.2, 0.8)]
            got = shard.nearest(a, labels[a], vectors[a], False, windows, 10)
            for (lo, hi), found in zip(windows, got, strict=True):
                hit = (labels != labels[a]) & (score >= lo) & (score <= hi)
                assert found == sorted(zip(score[hit].tolist(), ids[hit].tolist(), strict=True), key=lambda x: (-x[0], x[1]))[:10]
    finally:
        hard_negatives.exact_scores = real
    assert sum(looked) < 0.3 * n * len(range(0, n, 300))


def phrases_by_hand(rows, least, top):
    by = {}
    for _, text, lang, *_ in rows:
        f = by.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, f in by.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands, found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}, []
        for p, a in cands.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if any(100 * b >= 80 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("top", [2000, 7])
def test_op13(spark, top):
    r = random.Random(6)
    vocabulary = ["New", "york", "CITY", "of", "é", "ü", "日本", "x" * 300, "a-b", "it's", "\x00"]
    texts = []
    for _ in range(120):
        w = [r.choice(vocabulary) for _ in range(r.randrange(40))]
        for _ in range(3):
            w[len(w) // 2 : len(w) // 2] = ["New", "York", "City", "hall"][: r.randrange(2, 5)]
        texts.append("".join(x + r.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "!", ". "]) for x in w))
    texts += ["a a a a a a a a " * 20, None, "", " ,.!\n", "z" * 70000]
    rows = [(i, t, [None, "und", "en", "fr"][i % 4], 1, "b", 0) for i, t in enumerate(texts)] + [(5, texts[0], "en", 1, "b", 0)] * 2
    got = collocations.collocations(spark.createDataFrame(rows, DDL).repartition(4), least=6, top=top)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 6, top)
    assert collocations.collocations(spark.createDataFrame([], DDL)).count() == 0


@pytest.mark.parametrize("bits", [4, 9])
def test_hash_counts_are_exact_and_marked(bits):
    """Counts of hashes over several parts; the bit array marks what is frequent and next to nothing else."""
    r = np.random.default_rng(2)
    often, rare = (r.integers(-(1 << 62), 1 << 62, 2000) for _ in range(2))
    rows = []
    for part, k in enumerate((3, 2, 1)):  # 6 and 3 times
        terms, lengths = np.unique(np.concatenate([np.repeat(often, k), np.repeat(rare, k - 1)]), return_counts=True)
        batch = pa.RecordBatch.from_arrays([pa.array([part]), pa.array(["en"]), *(pa.array([x.tobytes()]) for x in (terms, lengths.astype(np.int32), lengths.astype(np.int32)))], ["part", "lang", "terms", "lengths", "positions"])
        rows += [pa.Table.from_batches([b]) for b in collocations._keys(1, bits, [])([batch])]
    keys = pa.concat_tables(rows).sort_by("bucket").combine_chunks().to_batches()
    found = pa.Table.from_batches(list(collocations._often(6)(keys)))
    assert sorted(found["hash"].to_pylist()) == sorted(collocations._hashes("en", [often]).view(np.int64).tolist()) and set(found["f"].to_pylist()) == {6}
    marks = pa.Table.from_batches(list(collocations._places(found.select(["hash"]).to_batches()))).sort_by("chunk").combine_chunks().to_batches()
    chunks = [x for b in collocations._chunks(marks) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    held = collocations._loaded(chunks)
    assert collocations._marked(held, "en", [often]).all()
    assert collocations._marked(held, "en", [rare]).mean() < 0.01 and collocations._marked(held, "fr", [often]).mean() < 0.01


@pytest.mark.parametrize("name", ["op11_vertical_jaccard", "op12_vptree_negatives", "op13_vertical_phrases"])
def test_oracles(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, sf_dir).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].astype(object).values.tolist())) == sorted(map(tuple, want[cols].astype(object).values.tolist()))


def test_set_sizes_do_not_depend_on_blocks(texts):
    for limit in (50, 1 << 20):
        sizes = [int(x) for b in blocks(pa.array(texts), limit) for x in np.bincount(distinct_pairs(*shingles(words(b), 3))[0], minlength=b.n_docs)]
        assert sizes == [len(s) for s in sets_of(texts, 3)]
