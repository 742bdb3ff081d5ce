"""Building blocks of the corpus operators, without Spark."""

import contextlib
import random
from types import SimpleNamespace
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from recordloom.llm import blocks, decontamination, maxent_lm, near_dedup, packing, pu_classifier, sstable, substring_dedup, tokens, warc

PIECES = ["a", "B", " ", "  ", "\n", "\n\n", " \n", "\t", "'s", "'", "é", "É", "1", "23", "<|endoftext|>", "<|startoftext|>", "!", "...", "Σ", "ß", "日本", "é", "\x1c", "\x85", "﻿", "İ", "🙂", "\r\n", "​", "　", "\x00"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    r, enc = random.Random(5), tokens.encoder(public_tokenizers.path(name))
    assert enc.safe
    for _ in range(3000):
        text = "".join(r.choice(PIECES) for _ in range(r.randint(0, 25)))
        assert enc.ids(text).tolist() == enc.whole(text)
    assert len(enc.ids(None)) == len(enc.ids("")) == 0


def test_encoder_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 8)
    enc = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(50):
        text = f"w{i} the w{i + 1}"
        assert enc.ids(text).tolist() == enc.whole(text)
    assert len(enc.young) + len(enc.old) <= 14


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library_on_special_strings_in_any_case(name):
    enc = tokens.Encoder(public_tokenizers.path(name))
    for text in ("a <|ENDOFTEXT|> b", "<|EndOfText|>", "x\n<|StartOfText|>\ty", "<|endoftext|>", "a<|ENDOFTEXT|>b"):
        assert enc.ids(text).tolist() == enc.whole(text)


def test_words_and_shingles():
    texts = ["A b  c\x0bd e f", None, "", " \n ", "one", "x y", "A b c d e f a b c d e f", "é" * 3 + " Ü"]
    for block in blocks.blocks(pa.array(texts), limit=7):
        w = blocks.words(block)
        doc, h = blocks.distinct_pairs(*blocks.shingles(w, 5))
        for i in range(block.n_docs):
            want = (texts[block.first + i] or "").encode().lower().split()
            assert w.first[i + 1] - w.first[i] == len(want)
            shingles = {tuple(want[j : j + 5]) for j in range(max(1, len(want) - 4))} if want else set()
            assert (doc == i).sum() == len(shingles)
    a, b = (next(blocks.blocks(pa.array([t]))) for t in ("q A b", "zz q a B"))
    assert set(blocks.words(a).hashes.tolist()) < set(blocks.words(b).hashes.tolist())


def test_sliced_arrays_are_read_in_place():
    texts = pa.array(["skip", "a b", None, "c"])[1:]
    got = [w for b in blocks.blocks(texts) for w in np.diff(blocks.words(b).first)]
    assert got == [2, 0, 1]


def test_shard_roundtrip(tmp_path):
    ids = [None, -5, 0, 7, 7, 1 << 40]
    values = [np.arange(n, dtype="<u2") for n in (3, 0, 70000 % 5000, 1, 2, 9)]
    w = sstable.ShardWriter(str(tmp_path / "x.sst"), 2)
    for i, v in zip(ids, values):
        w.add(sstable.key_of(i), v.tobytes())
    w.close()
    shard = sstable.Shard((tmp_path / "x.sst").read_bytes())
    assert [(i, v.tolist()) for i, v in shard.scan()] == [(i, v.tolist()) for i, v in zip(ids, values)]
    assert shard.get(0).tolist() == values[2].tolist() and len(shard.get(7)) == 1
    assert all(shard.get(i) is not None for i in ids) and shard.get(99) is None
    assert sum(shard.may_hold(i) for i in range(1000, 3000)) < 100
    assert shard.n_ids == sum(map(len, values))
    with pytest.raises(ValueError):
        sstable.Shard(b"\0" * 200)


def test_shard_blocks_are_searched(tmp_path):
    w = sstable.ShardWriter(str(tmp_path / "x.sst"), 2)
    for i in range(0, 3000, 3):
        w.add(sstable.key_of(i), np.full(200, i % 999, "<u2").tobytes())
    w.close()
    shard = sstable.Shard((tmp_path / "x.sst").read_bytes())
    assert len(shard.index) > 3
    assert all((shard.get(i)[0] == i % 999) == True if i % 3 == 0 else shard.get(i) is None for i in range(0, 3000, 7))  # noqa: E712


def _optimal(sizes, capacity):
    best, sizes = len(sizes), sorted(sizes, reverse=True)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in sorted(set(rooms)):
            if k >= sizes[i]:
                left = list(rooms)
                left.remove(k)
                place(i + 1, [*left, k - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


def test_bounds_and_best_fit_against_optimum():
    r = random.Random(2)
    for _ in range(60):
        capacity = r.choice([10, 17, 30])
        sizes = [r.randint(1, capacity) for _ in range(r.randint(0, 8))]
        bins = packing.best_fit_decreasing(np.array(sizes, int), capacity)
        loads = np.bincount(bins, weights=sizes) if sizes else np.array([0])
        assert loads.max() <= capacity
        best = _optimal(sizes, capacity)
        assert packing.lower_bound(np.array(sizes, int), capacity) <= best <= (bins.max() + 1 if sizes else 0)
    assert packing.lower_bound(np.array([6] * 5), 10) == 5


def test_register_estimates_and_merge():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**64, 900, dtype=np.uint64)
    a, b = pool[:600], pool[300:]
    regs = near_dedup.registers(np.repeat([0, 1, 2], [600, 600, 900]), np.concatenate([a, b, pool]), 3)
    assert (near_dedup.merge(regs[0], regs[1]) == regs[2]).all()
    got = near_dedup.estimate(600, 600, *[x[0] for x in near_dedup._compared(regs[0], regs[1:2])])
    assert abs(float(got) - 1 / 3) < 0.09
    alone = near_dedup.registers(np.zeros(1, int), pool[:1], 1)
    assert np.isfinite(alone).all() and not near_dedup.plausible(100, 50, np.array([0]), np.array([0]), np.array([640]))[0]


def test_repeated_windows_against_counting():
    r = random.Random(4)
    for _ in range(20):
        strings = ["".join(r.choice("ab") for _ in range(r.randint(8, 40))).encode() for _ in range(r.randint(1, 9))]
        strings += [strings[0][2:], b"a" * 20][: r.randint(0, 2)]
        strings = [s for s in dict.fromkeys(strings) if len(s) >= 8]
        keys = np.array([r.randint(0, 1) for _ in strings], np.uint64)
        weights = np.array([r.randint(1, 2) for _ in strings])
        seen = {}
        for s, k, n in zip(strings, keys.tolist(), weights.tolist()):
            for i in range(len(s) - 7):
                seen[k, s[i : i + 8]] = seen.get((k, s[i : i + 8]), 0) + n
        got = substring_dedup.repeated_windows([np.frombuffer(s, np.uint8) for s in strings], keys, weights, window=8, n_shards=3)
        want = [[seen[k, s[i : i + 8]] > 1 for i in range(len(s) - 7)] for s, k in zip(strings, keys.tolist())]
        assert [m.tolist() for m in got] == want


@pytest.mark.parametrize("gram", [32, 200, 399, 400])
def test_anchors_cover_each_window_once(gram):
    r = random.Random(8)
    texts = ["".join(r.choice("abc é") for _ in range(n)) for n in (0, 5, 399, 400, 900, 3000)] + ["ab" * 700, "x" * 300_000]
    for block in blocks.blocks(pa.array(texts)):
        s = substring_dedup.anchors(block.data, block.offsets, 400, gram)
        for i in range(block.n_docs):
            n = len(texts[block.first + i].encode())
            own = s["doc"] == i
            covered = [p for a, k in zip(s["start"][own], s["windows"][own]) for p in range(a, a + k)]
            assert covered == list(range(max(0, n - 399)))
            assert s["windows"].max(initial=0) <= substring_dedup.RUN * 400


def test_suffix_array_matches_naive_search():
    r = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    docs = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(30)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 6])))) for i in range(12)] + [(12, docs[0]), (13, None)]
    tests = decontamination.TestSet(items, 3)
    counts, hits = decontamination._search(pa.array(docs), tests)
    for d, text in enumerate(docs):
        w, covered = text.split(), set()
        assert counts[d] == len(w)
        for _, t in items:
            q = (t or "").split()
            size = min(3, len(q))
            for a in range(len(q) - size + 1 if size else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == q[a : a + size]:
                        covered.update(range(p, p + size))
        got = {p for a, b in decontamination._merged(hits[d][0]) for p in range(a, b)} if d in hits else set()
        assert got == covered


def test_warc_chain_rejects_magic_in_payloads():
    evil = warc.record(9, "http://evil", b"x" * 30, "0" * 64, False, None, "d")
    records = [warc.record(1, "http://a\r\nInjected: 1", b"plain", "1" * 64, False, None, "d"), warc.record(2, None, evil * 2 + b"WARC/1.1\r\n", "2" * 64, False, None, "d"), warc.record(None, "", b"", "3" * 64, True, 1, "d")]
    data = b"".join(records)
    found = [c for at in range(0, len(data), 64) for c in warc.candidates(data[at : at + 64 + warc.HEADER_BYTES], at, 64)]
    assert len(found) == 5
    offsets, ends = (np.array(x) for x in zip(*found))
    keep = warc.reachable(offsets, ends, len(data))
    starts = np.cumsum([0] + [len(r) for r in records[:-1]])
    assert sorted(offsets[keep].tolist()) == starts.tolist()
    assert "injected" not in warc.parse_header(data, 0)[0]
    with pytest.raises(ValueError):
        warc.reachable(offsets, ends, len(data) + 1)
    assert warc.reachable(np.empty(0, int), np.empty(0, int), 0).tolist() == []


def test_lm_probabilities_sum_to_one():
    r = np.random.default_rng(0)
    table = r.normal(size=(maxent_lm.CLASS_ROWS + maxent_lm.SLOT_ROWS, maxent_lm.SLOTS)).astype(np.float32)
    feature = maxent_lm.features(np.array([5, 7, 9]), np.array([0, 0, 0]), np.array([0, 1, 2]))
    total = np.zeros(3)
    for c in range(maxent_lm.CLASSES):
        cls = np.full(3, c)
        by_class, by_slot = maxent_lm.rows_of(feature, cls)
        p = np.exp(maxent_lm.Softmax(table).log_probability(by_class, cls))
        for s in range(maxent_lm.SLOTS):
            total += p * np.exp(maxent_lm.Softmax(table).log_probability(by_slot, np.full(3, s)))
    assert np.allclose(total, 1, atol=1e-4)
    # inside a shared slot: (count + 1) over tokens + words + 1, so known words and one unseen outcome fill it
    hashes = np.arange(1, 5001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts, endings = np.arange(5000, 0, -1), np.arange(5000) % maxent_lm.CLASSES
    cells = _cells(hashes, counts, endings)
    lex = maxent_lm.Lexicon(hashes, counts, endings, int(counts.sum()), 5000, cells)
    shared, filled = lex.slot >= maxent_lm.SINGLE, 0
    assert (~shared).sum() == maxent_lm.CLASSES * maxent_lm.SINGLE
    for c, k in set(zip(lex.cls[shared].tolist(), lex.slot[shared].tolist())):
        own = (lex.cls == c) & (lex.slot == k)
        assert np.isclose((lex.counts[own] + 1).sum() + 1, 10 ** lex.rest_log[c, k])
        filled += lex.counts[own].sum()
    assert lex.mass.sum() == counts.sum() and lex.mass[:, maxent_lm.SINGLE :].sum() == filled


def _cells(hashes, counts, endings):
    cells = {}
    for e, k, n in zip(endings.tolist(), maxent_lm.rest_slot(hashes).tolist(), counts.tolist()):
        had = cells.get((e, k), (0, 0))
        cells[e, k] = (had[0] + n, had[1] + 1)
    return cells


def test_warc_header_longer_than_the_overhang(tmp_path):
    urls = ["http://a/1", "http://a/" + "x" * 3 * warc.HEADER_BYTES, "http://a/2", "http://a/" + "y" * 2 * warc.HEADER_BYTES]
    data, at = b"", []
    for i, url in enumerate(urls):
        at.append(len(data))
        data += warc.record(i, url, b"body" * 40, "0", False, None, "1970-01-01T00:00:00Z")
    (tmp_path / "a.warc").write_bytes(data)
    for split in (at[1] + 5, 1000, 8 << 20):
        starts = list(range(0, len(data), split))
        batch = pa.RecordBatch.from_pydict({"archive": ["a.warc"] * len(starts), "n_bytes": [len(data)] * len(starts), "start": starts, "length": [split] * len(starts)})
        found = pa.Table.from_batches(warc._candidates_of(str(tmp_path))([batch]))
        assert found["offset"].to_pylist() == at and found["successor"].to_pylist() == [*at[1:], len(data)]


def test_lm_counts_cover_every_position_whatever_the_batches():
    texts = ["one two three two one", None, "", "a b " * 300, "one two three two one"]
    batch = lambda t: pa.RecordBatch.from_arrays([pa.array(t, pa.string())], ["text"])
    h, ending, _ = maxent_lm.tokens(next(blocks.blocks(pa.array(texts))))
    found, at, n = np.unique(h, return_index=True, return_counts=True)
    lex = SimpleNamespace(value=maxent_lm.Lexicon(found, n, ending[at], int(n.sum()), len(found), _cells(found, n, ending[at])))

    def total(dealt, tables):
        tables = None if tables is None else SimpleNamespace(value=tables)
        out = np.zeros((maxent_lm.CLASS_ROWS + maxent_lm.SLOT_ROWS) * maxent_lm.SLOTS)
        with _task():
            parts = [row for part in dealt for row in maxent_lm._gathered(lex, tables)([part])]
        for part in maxent_lm._added(sorted(parts, key=lambda r: r.column(1)[0].as_py())):
            at = part.column(1)[0].as_py() * maxent_lm.ROW_BLOCK * maxent_lm.SLOTS
            out[at : at + maxent_lm.ROW_BLOCK * maxent_lm.SLOTS] = maxent_lm._unpacked(part.column(2)[0].as_py())
        return out.reshape(-1, maxent_lm.SLOTS)

    observed = total([batch(texts)], None)
    start = maxent_lm.bias_tables(lex.value.mass)
    expected, share = maxent_lm.bias_expected(lex.value.mass, observed)
    assert np.allclose(expected.sum(axis=1), observed.sum(axis=1)) and np.allclose(share.sum(axis=1), 1)
    table = maxent_lm.updated(start, observed, expected, maxent_lm.SHRINK * share, maxent_lm.TRUST)
    for tables in (None, table):
        one, many = total([batch(texts)], tables), total([batch([t]) for t in texts], tables)
        assert (one == many).all()
        assert tables is not None or one.sum() == 2 * maxent_lm.FEATURES * len(h)


@contextlib.contextmanager
def _task():
    """A task context for functions that ask for their partition."""
    held = maxent_lm.TaskContext
    maxent_lm.TaskContext = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    try:
        yield
    finally:
        maxent_lm.TaskContext = held


def test_lm_samples_weigh_as_the_softmax():
    r = np.random.default_rng(5)
    table = r.normal(size=(maxent_lm.CLASS_ROWS + maxent_lm.SLOT_ROWS, maxent_lm.SLOTS)).astype(np.float32)
    n, ask = 400_000, maxent_lm.Proposals(r.random((maxent_lm.CLASSES, maxent_lm.SLOTS)) + 0.3)
    rows, target = np.tile(r.integers(0, maxent_lm.CLASS_ROWS, 5), (n, 1)), r.integers(0, maxent_lm.SLOTS, n)
    want = np.exp([maxent_lm.Softmax(table).log_probability(rows[:1], np.array([k]))[0] for k in range(maxent_lm.SLOTS)])
    for kind in (0, 7):
        outcome, weight = maxent_lm.Softmax(table).sampled(rows, target, np.full(n, kind), ask, r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) * (r.random(n) < 0.5).astype(np.uint64))
        got = np.bincount(outcome, weight, minlength=maxent_lm.SLOTS) / maxent_lm.UNIT / n
        assert np.abs(got - want).max() < 0.02 and abs(got.sum() - 1) < 0.02


def test_pu_features_do_not_depend_on_neighbours():
    texts = ["Some words here.", "### $$$ %%%", "", "a a a a a a", "x" * 5000]
    together = np.concatenate([pu_classifier.features(b) for b in blocks.blocks(pa.array(texts))])
    alone = np.concatenate([pu_classifier.features(b) for t in texts for b in blocks.blocks(pa.array([t]))])
    assert np.allclose(together, alone) and np.isfinite(together).all() and together.shape[1] == pu_classifier.WIDTH


def test_pu_prior_and_fit_separate():
    r = np.random.default_rng(3)
    make = lambda n, shift: np.abs(r.normal(0.05, 0.02, (n, pu_classifier.WIDTH)) + shift * (np.arange(pu_classifier.WIDTH) % 5 == 0) * 0.1).astype(np.float32)
    model, prior = pu_classifier.fit(make(600, 0), np.concatenate([make(700, 0), make(300, 1)]))
    assert 0.6 < prior < 0.85
    good, bad = pu_classifier._sigmoid(model.margin(make(200, 0))), pu_classifier._sigmoid(model.margin(make(200, 1)))
    assert (good >= 0.5).mean() > 0.9 and (bad < 0.5).mean() > 0.6


def test_crc_of_ids_is_of_32_bit_numbers():
    assert zlib.crc32(np.array([1, 2], "<u2").astype("<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0")


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from recordloom.llm import common

    session = lambda master, root=None: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: root), sparkContext=SimpleNamespace(master=master, applicationId="a"))
    assert common.shared_root(session("spark://x", "hdfs://y/z/")) == "hdfs://y/z"
    assert common.shared_root(session("local[2]")) == common.shared_root(session("local[2]"))
    with pytest.raises(ValueError):
        common.shared_root(session("yarn"))


def test_magic_in_payloads_is_searched_in_linear_time():
    """Megabytes of magic, bare, as fields, and as whole headers without end."""
    import time

    for line, per in ((warc.MAGIC, 1), (b"X: " + warc.MAGIC, 1), (warc.MAGIC + b"A: b\r\n" * 3, 1), (warc.MAGIC + b"Content-Length: 3\r\n", 1)):
        data = line * ((4 << 20) // len(line))
        began = time.perf_counter()
        found = warc.candidates(data + b"\r\n", 0, len(data))
        assert time.perf_counter() - began < 20 and len(found) <= 1


def test_candidates_are_what_headers_say():
    r = random.Random(11)
    parts = [warc.MAGIC, b"X: y\r\n", b"Content-Length: 4\r\n", b"content-length: 11\r\n", b"Content-Length: x\r\n", b"\r\n", b"no field\r\n", b"Z: WARC/1.1\r\n", b"tail", b": \r\n"]
    for _ in range(400):
        data = b"".join(r.choice(parts) for _ in range(r.randrange(30)))
        want, at = [], data.find(warc.MAGIC)
        while at >= 0:
            if parsed := warc.parse_header(data, at):
                want.append((at, parsed[1] + int(parsed[0]["content-length"]) + 4))
            at = data.find(warc.MAGIC, at + 1)
        assert warc.candidates(data, 0, len(data)) == want
