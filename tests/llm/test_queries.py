"""Corpus operators on small awkward tables, against brute force and SQL."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordloom.llm import decontamination, maxent_lm, near_dedup, packing, pu_classifier, quality_rules, queries, sstable, substring_dedup, token_counts, warc

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DDL = "doc_id bigint, text string, lang string, content bigint, words string, row_id int"
PROSE = " ".join(f"Word{i % 37}, thing{i % 23}" for i in range(300))


@pytest.fixture(scope="module")
def awkward():
    """Nulls, empties, ties, repeated rows, long and tiny texts; clashing column names."""
    texts = [None, "", " \n\t ", "One", "one", "a b c d", "A B c D", "a b c d e", PROSE, PROSE, PROSE + " tail", PROSE.upper(), "Erst, " * 900, "### $$$ %%% ***" * 30, "x" * 3000, "é" * 700 + " ü", PROSE[:500] + " and " + PROSE[700:1400], "<|endoftext|> in text <|startoftext|>"]
    rows = [(i, t, "en", 5, "w", i) for i, t in enumerate(texts)]
    return [*rows, rows[8], rows[0], (None, PROSE + " null id", "fr", 1, None, 1), (None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return spark.createDataFrame(awkward, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_op1(spark, docs, awkward, empty):
    lib, start, want = Tokenizer.from_file(BYTE), 0, []
    tie = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) as h").collect()}
    for doc_id, text in sorted(((r[0], r[1]) for r in awkward), key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]])):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(sstable.token_table(docs, BYTE, 2, shard_bytes=2000)) == sorted(want, key=repr)
    assert sstable.token_table(empty, BYTE, 2).count() == 0


def test_op3(spark, docs, awkward, empty):
    lib, want = Tokenizer.from_file(WORD), []
    for doc_id, text, *_ in awkward:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(doc_id, k, at, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 512)) for p in [ids[at : at + 512]]]
    got = packing.packed_documents(docs, WORD, 0, 512).toPandas()
    assert sorted(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).where(got.notna(), None).values.tolist()), key=repr) == sorted(want, key=repr)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= 512 and (g["offset"] == g["length"].cumsum() - g["length"]).all()
    assert packing.packed_documents(empty, WORD).count() == 0


def test_op3_exchanges_between_partitions(spark):
    sizes = [6, 4, 7, 3, 5, 5, 9, 1, 8, 2, 6, 4, 5, 5, 7, 3] * 20
    items = spark.createDataFrame(list(enumerate(sizes)), "item bigint, length bigint")
    packed = packing.pack(items, 10, per_group=16).toPandas().merge(items.toPandas(), on="item")
    assert len(packed) == len(sizes) and packed.groupby("sequence_id")["length"].sum().max() <= 10
    assert packed["sequence_id"].nunique() <= sum(sizes) / 10 * 1.05


def test_op4(spark, docs, awkward, empty):
    sets = []
    for _, text, *_ in awkward:
        w = lower(text)
        w = words(w)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(sets)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(n):
        groups[root(i)].append(awkward[i][0])
    want = []
    for i in range(n):
        ids = [x for x in groups[root(i)] if x is not None]
        least = min(ids) if ids else None
        if not sets[i]:
            least = awkward[i][0]
        want.append((awkward[i][0], len(sets[i]), least, awkward[i][0] == least))
    assert rows(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=repr)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_op4_chain_of_copies_finds_every_link(spark):
    base = [f"w{i}" for i in range(100)]
    texts = []
    for k in range(30):  # each copy changes a few words; neighbours are linked, ends are not
        texts.append(" ".join(base[:k] + [f"n{j}" for j in range(k, k + 1)] + base[k + 1 :]))
        base[k] = f"n{k}"
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = near_dedup.near_duplicates(df).toPandas()
    assert got["component_id"].tolist() == [0] * 30 and got["kept"].sum() == 1


def base_of(text):
    w, seen, dup = words(text), set(), 0
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


LABELS = "doc_id bigint, quality int, toxic int"


def test_op5(spark, docs, awkward, empty):
    labels = spark.createDataFrame([(8, 1, 0), (9, 1, 0), (16, 1, 0), (13, 0, 0), (None, 1, 0)], LABELS)
    got = quality_rules.quality_rules(docs, labels)
    assert rows(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(((r[0], *base_of(r[1])) for r in awkward), key=repr)
    assert not got.where("kept and base_failed").count()
    assert quality_rules.quality_rules(empty, labels).count() == 0
    free = quality_rules.quality_rules(docs, labels.limit(0))
    assert free.where("kept = base_failed").count() == 0


def test_op5_llr_against_numpy(spark, sf_dir):
    import xxhash

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.llr for r in quality_rules.quality_rules(docs, labels, buckets=997).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    word = lambda w: xxhash.xxh64_intdigest(w.encode(), 42)
    chain = lambda h: signed(_hash_longs(h))
    feats = {}
    for i, t in texts.items():
        h = [word(w) for w in words(t)]
        feats[i] = [chain([x]) % 997 for x in h] + [chain([x, y]) % 997 for x, y in zip(h[:-1], h[1:])]
    half = {i for i in good if signed(_hash_longs([i])) % 2 == 0}
    raw, target = collections.Counter(), collections.Counter()
    for i, f in feats.items():
        raw.update(f)
        if i in half:
            target.update(f)
    rs, ts = sum(raw.values()), sum(target.values())
    weight = {b: math.log((target[b] + 1) / (ts + 997)) - math.log((raw[b] + 1) / (rs + 997)) for b in raw}
    for i, f in feats.items():
        assert abs(got[i] - (sum(weight[b] for b in f) / len(f) if f else 0)) < 1e-9


def _hash_longs(values):
    """Spark's xxhash64 of long columns, seed 42."""
    m, p1, p2, p3, p4, p5 = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    rot = lambda x, r: ((x << r) | (x >> (64 - r))) & m
    h = 42
    for v in values:
        h = (h + p5 + 8) & m
        h ^= rot((v & m) * p2 & m, 31) * p1 & m
        h = (rot(h, 27) * p1 + p4) & m
        h ^= h >> 33
        h = h * p2 & m
        h ^= h >> 29
        h = h * p3 & m
        h ^= h >> 32
    return h


@pytest.mark.parametrize("hot", [1 << 18, 4, 0])
def test_op6(spark, docs, awkward, empty, hot):
    lib = Tokenizer.from_file(WORD)
    want = [(r[0], len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in awkward]
    assert rows(token_counts.token_counts(docs, WORD, hot_limit=hot)) == sorted(want, key=repr)
    assert token_counts.token_counts(empty, WORD).count() == 0


ITEMS = [(1, PROSE[100:260]), (10, "a B-c"), (2, PROSE[100:260]), (3, None), (4, "  "), (None, "one"), (1, PROSE[100:260]), (5, "never seen anywhere at all")]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_op7(spark, docs, awkward, empty, block):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    want = []
    for doc_id, text, *_ in awkward:
        w, hit, found = split(text), set(), set()
        for item, t in ITEMS:
            q = split(t)
            size = min(13, len(q))
            for a in range(len(q) - size + 1 if size else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == q[a : a + size]:
                        hit.update(range(p, p + size))
                        found |= {str(item)} - {"None"}
        want.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    got = decontamination.decontaminate(docs, items, block_bytes=block)
    assert rows(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want, key=repr)
    assert decontamination.decontaminate(empty, items).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_op7_repeated_items_are_one_block(spark, monkeypatch):
    """Five thousand equal items: one block, one pass, the same verdicts."""
    passes, real = [], decontamination.TestSet.__init__
    monkeypatch.setattr(decontamination.TestSet, "__init__", lambda self, items, window: (passes.append(len(items)), real(self, items, window))[1])
    docs = spark.createDataFrame([(1, PROSE), (2, "clean words only")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, PROSE[100:260])] * 5000 + [(8, ""), (9, None)], "item_id bigint, text string")
    got = decontamination.decontaminate(docs, items, block_bytes=1000)
    assert passes == [1] and [r.n_hit > 0 for r in got.orderBy("doc_id").collect()] == [True, False]
    got = decontamination.decontaminate(docs, spark.createDataFrame([(i, PROSE) for i in range(3)] + [(5, "seven")], "item_id bigint, text string"), block_bytes=500)
    assert sum(passes[1:]) == 4 and [r.n_items for r in got.orderBy("doc_id").collect()] == [3, 0]


def test_op7_longest_match(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"x y {text} z")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, f"q {text}")], "item_id bigint, text string")
    row = decontamination.decontaminate(docs, items).first()
    assert (row.longest_match, row.matches[0].doc_word, row.matches[0].item_word) == (40, 2, 1)


def test_op8(spark, docs, awkward, empty):
    labels = spark.createDataFrame([(i, int(i not in (12, 13)), 0) for i in range(18)], LABELS)
    got = pu_classifier.quality_scores(docs, labels).toPandas()
    assert len(got) == len(awkward) and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    for r in got.dropna().itertuples():
        assert r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 3 == 1)
    assert set(pu_classifier.quality_scores(docs, labels.limit(0)).toPandas()["score"]) == {0.5}
    assert pu_classifier.quality_scores(empty, labels).count() == 0


def test_op8_ignores_held_out_and_negative_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    first = rows(pu_classifier.quality_scores(docs, labels))
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    swapped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).where(held | (F.col("quality") == 1))
    assert rows(pu_classifier.quality_scores(docs, swapped)) == first


def test_op8_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = pu_classifier.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).toPandas()
    got = got[got["held_out"]].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    rank, good = got["score"].rank(), got["quality"] == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.95 and (got["predicted"] == got["quality"]).mean() > 0.93


def removed_by_hand(rows_in, window, passage):
    """op9's rows by counting every window of bytes, and every run of words."""
    count, runs, want = collections.Counter(), collections.Counter(), []
    data = [(i, (t or "").encode(), words(lower(t))) for i, t in rows_in]
    for _, b, w in data:
        count.update(b[i : i + window] for i in range(len(b) - window + 1))
        runs.update(tuple(w[i : i + passage]) for i in range(len(w) - passage + 1))
    for doc_id, b, w in data:
        gone, told = np.zeros(len(b), bool), np.zeros(len(w), bool)
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = True
        for i in range(len(w) - passage + 1):
            if runs[tuple(w[i : i + passage])] > 1:
                told[i : i + passage] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), int(told.sum())))
    return sorted(want, key=repr)


@pytest.mark.parametrize("window, passage, hot", [(400, 51, 1 << 19), (200, 51, 1 << 19), (200, 12, 1)])
def test_op9(docs, awkward, empty, window, passage, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", hot)  # 1: every shared anchor is split again
    assert rows(substring_dedup.remove_repeats(docs, window, passage=passage)) == removed_by_hand([r[:2] for r in awkward], window, passage)
    assert substring_dedup.remove_repeats(empty, window).count() == 0


def test_op9_long_texts(spark):
    """Texts of many chunks: one unit over and over, a passage inside, and a copy of a part."""
    long = "x" * 300_000 + "".join(f" w{i}" for i in range(40_000))
    data = [(1, long), (2, "y" + long[299_000:300_500]), (3, "".join(f" w{i}" for i in range(39_000, 39_200)) + " end")]
    assert rows(substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id bigint, text string"))) == removed_by_hand(data, 400, 51)


def test_op9_strip_cuts_passages_too(spark):
    shared = " ".join(f"a{i}" for i in range(51))  # over 50 words, under 400 bytes
    data = [(k, f"begin{k} {shared} end{k}") for k in range(3)] + [(9, "alone " + shared[:150])]
    out = substring_dedup.strip_repeats(spark.createDataFrame(data, "doc_id bigint, text string"), passage=51)
    assert len(shared) < 400 and rows(out) == [(0, "begin0  end0"), (1, "begin1  end1"), (2, "begin2  end2"), data[3]]


def test_op9_strip_keeps_columns(docs):
    out = substring_dedup.strip_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text is null").count() == docs.where("text is null").count()


def test_op10(spark):
    same, evil = "<p>" + "same " * 40, "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 5
    pages = [(5, "u", same), (3, "u\r\nX: y", same), (9, None, same), (1, "a", "tiny"), (2, "b", "tiny"), (7, "c", None), (8, "d", ""), (4, "e", evil), (6, "f", "é" * 200), (None, "g", same), (3, "u", same)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2)
    body = lambda h: (h or "").encode()
    want = []
    for page_id, _, html in pages:
        revisit = html == same and page_id != 3
        want.append((page_id, len(body(html)), hashlib.sha256(body(html)).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    got = warc.archived_pages(df, archive_bytes=700)
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert warc.archived_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("harm", ["zeroed", "cut", "emptied", "gone", "shortened"])
def test_op10_never_loses_records_in_silence(spark, tmp_path, harm):
    df = spark.createDataFrame([(i, "u", f"page {i} " * 30) for i in range(40)], "page_id bigint, url string, html string").repartition(4)
    manifest = warc.write_archives(df, str(tmp_path))
    assert warc.read_archives(manifest, str(tmp_path)).count() == 40
    path = sorted(tmp_path.glob("*.warc"))[1]
    data = path.read_bytes()
    if harm == "gone":
        path.unlink()
    else:
        path.write_bytes({"zeroed": b"\0" * len(data), "cut": data[: len(data) // 2], "emptied": b"", "shortened": data[: data.rfind(warc.MAGIC)]}[harm])
    with pytest.raises(Exception, match=path.name if harm != "zeroed" else "chain of records"):
        warc.read_archives(manifest, str(tmp_path)).collect()


def test_op2(spark, docs, awkward, empty):
    counts = collections.Counter()
    for doc_id, text, *_ in awkward:
        held = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2
        if not held:
            counts.update([*words(lower(text)), None])
    n, v = sum(counts.values()), len(counts)
    got = collections.defaultdict(list)
    for hot in (1 << 18, 3):
        out = maxent_lm.lm_scores(docs, hot_limit=hot).toPandas()
        assert len(out) == len(awkward) and (out["train_tokens"] == n).all() and np.isfinite(out["score"]).all() and (out["score"] < 0).all()
        got[hot] = sorted((round(x, 6) for x in out["base_score"]))
        want = []
        for _, text, *_ in awkward:
            t = [*words(lower(text)), None]
            want.append(round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6))
        assert np.allclose(got[hot], sorted(want), atol=1e-5)
        assert sorted(out["n_known"]) == sorted(sum(counts[w] > 0 for w in [*words(lower(r[1])), None]) for r in awkward)
    assert maxent_lm.lm_scores(empty).count() == 0


def test_op2_score_by_hand(spark, docs, awkward):
    """The model's score again, word by word, from the tables and the counts of all training words."""
    texts = [r[1] for r in awkward if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2]
    source = spark.createDataFrame([(t,) for t in texts], "text string")
    _, lexicon, _ = maxent_lm.vocabulary(source)
    table, lex = maxent_lm.train(source, lexicon), lexicon.value
    m, gold = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & m
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & m
        return x ^ (x >> 31)

    def ending(w):
        b = w.encode()
        return ((b[-2] if len(b) > 1 else 0) * 31 + b[-1] * 7) % 64

    counts = collections.Counter(w for t in texts for w in [*words(lower(t)), None])
    # hashes of words as the operator makes them; everything else is counted and multiplied here
    names = [w for w in counts if w is not None]
    from recordloom.llm import blocks
    import pyarrow as pa

    name = {None: int(maxent_lm.END)} | dict(zip(names, blocks.batch_words(pa.array(names))[0].tolist()))
    place = {h: i for i, h in enumerate(lex.hashes.tolist())}
    ranked = sorted(counts, key=lambda w: (w is not None, -counts[w], name[w]))
    cell = {}
    for rank, w in enumerate(ranked):
        cell[w] = (rank // 32, rank % 32) if rank < 2048 else (ending(w), 32 + (name[w] >> 40) % 32)
    assert len(ranked) > 50

    def context(w):
        if w in counts and counts[w] >= 16:
            return 64 + place[name[w]]
        return 0 if w is None else ending(w)

    def softmax(features, target, slots):
        rows = [f % (1 << 16) + (1 << 15) if slots else f % (1 << 15) for f in features]
        z = [sum(float(table[r][k]) for r in rows) for k in range(64)]
        top = max(z)
        return z[target] - top - math.log(sum(math.exp(x - top) for x in z))

    def score(text):
        total, seen = 0.0, [*words(lower(text)), None]
        for i, w in enumerate(seen):
            back = [context(seen[i - k]) if i >= k else m for k in (1, 2, 3)]
            kinds = [0, *back, (back[0] << 24 & m) ^ back[1]]
            features = [mix((x * gold + k + 1) & m) for k, x in enumerate(kinds)]
            cls, slot = cell[w]
            given = [mix((f + (cls + 1) * gold) & m) for f in features]
            total += (softmax(features, cls, False) + softmax(given, slot, True)) / math.log(10)
            if slot >= 32:
                held = [v for v in counts if cell[v] == cell[w]]
                total += math.log10((counts[w] + 1) / (sum(counts[v] + 1 for v in held) + 1))
        return total

    short = [r for r in awkward if r[0] in (0, 3, 5, 7, 8, 13) and r[1] in {*texts, None}]
    got = {r.doc_id: r.score for r in maxent_lm.lm_scores(docs).collect()}
    for r in short:
        if all(w in counts for w in words(lower(r[1]))):
            assert abs(got[r[0]] - score(r[1])) < 1e-3 * max(1, len(words(r[1])) / 50)


def test_op2_does_not_depend_on_partitions(spark, docs):
    first = rows(maxent_lm.lm_scores(docs.coalesce(1)), "doc_id", "n_tokens", "score")
    again = rows(maxent_lm.lm_scores(docs.repartition(7)), "doc_id", "n_tokens", "score")
    assert [r[:2] for r in first] == [r[:2] for r in again] and np.allclose([r[2] for r in first], [r[2] for r in again], rtol=1e-5)


def test_op2_beats_its_base_on_held_out_text(spark, sf_dir):
    out = maxent_lm.lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").toPandas()
    assert out["score"].sum() > out["base_score"].sum()


def test_op2_rounds_of_training_gain(spark, sf_dir):
    """Log10 a held-out token: each round gains; without any the model is no better than counts of words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mean = [maxent_lm.lm_scores(docs, rounds=r).where("held_out").selectExpr("sum(score) / sum(n_tokens) as s", "sum(base_score) / sum(n_tokens) as b").first() for r in (0, 1, 3)]
    assert abs(mean[0].s - mean[0].b) < 0.05
    assert mean[1].s > mean[0].s + 0.1 and mean[2].s > mean[1].s


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert rows(df, *columns) == sorted(want.fetchall(), key=repr)


def quality_by_hand(texts, good, buckets=1 << 16):
    """op5's verdicts of texts by id, from its definition."""
    import xxhash

    signed = lambda n: n - (1 << 64) if n >> 63 else n
    feats = {}
    for i, t in texts.items():
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(t)]
        feats[i] = [signed(_hash_longs([x])) % buckets for x in h] + [signed(_hash_longs([x, y])) % buckets for x, y in zip(h[:-1], h[1:])]
    half = {i for i in good if signed(_hash_longs([i])) % 2 == 0}
    raw, target = collections.Counter(), collections.Counter()
    for i, f in feats.items():
        raw.update(f)
        target.update(f if i in half else ())
    rs, ts = sum(raw.values()), sum(target.values())
    weight = {b: math.log((target[b] + 1) / (ts + buckets)) - math.log((raw[b] + 1) / (rs + buckets)) for b in raw}
    llr = {i: sum(weight[b] for b in f) / len(f) if f else 0.0 for i, f in feats.items()}
    failed = {i: base_of(t)[-1] for i, t in texts.items()}
    held = [math.floor(llr[i] / 1e-6) for i in good if i in texts and i not in half and not failed[i]]
    least = np.percentile(held, 0.1) * 1e-6 if held else -math.inf
    return {i: not failed[i] and llr[i] >= least - 1e-12 for i in texts}


def groups_by_hand(texts):
    """Least id of each text's near-duplicate component."""
    sets = {}
    for i, t in texts.items():
        w = words(lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in texts:
            k = len(sets[i] & sets[j]) if j < i else 0
            if k and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in texts}


def cut_by_hand(texts, window=400, passage=51):
    """Texts without repeated windows of bytes and repeated runs of words."""
    spread, runs, out = collections.Counter(), collections.Counter(), {}
    for t in texts.values():
        b, w = t.encode(), words(lower(t))
        spread.update(b[i : i + window] for i in range(len(b) - window + 1))
        runs.update(tuple(w[i : i + passage]) for i in range(len(w) - passage + 1))
    for i, t in texts.items():
        b, gone = t.encode(), np.zeros(len(t.encode()), bool)
        for k in range(len(b) - window + 1):
            if spread[b[k : k + window]] > 1:
                gone[k : k + window] = True
        places = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)]
        w = words(lower(t))
        for k in range(len(w) - passage + 1):
            if runs[tuple(w[k : k + passage])] > 1:
                gone[places[k][0] : places[k + passage - 1][1]] = True
        out[i] = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def test_pipeline_by_hand(spark, sf_dir):
    """All five stages over a whole table, against definitions applied text by text."""
    import corpus_pipeline as p

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = quality_by_hand(texts, good)
    texts = {i: t for i, t in texts.items() if kept[i]}
    group = groups_by_hand(texts)
    texts = cut_by_hand({i: t for i, t in texts.items() if group[i] == i})
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {tuple(q[a : a + min(13, len(q))]) for _, t in items for q in [split(t)] if q for a in range(len(q) - min(13, len(q)) + 1)}
    lib, want = Tokenizer.from_file(WORD), []
    for i, t in texts.items():
        w, hit = split(t), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                if tuple(w[a : a + size]) in windows:
                    hit.update(range(a, a + size))
        if not hit or 20 * len(hit) < len(w):
            ids = [*lib.encode(t, add_special_tokens=False).ids, 0]
            want += [(i, k, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048)) for x in [ids[at : at + 2048]]]
    got = p.run(spark, sf_dir)
    assert 0 < len(want) < 250 and rows(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
    assert got.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


def test_pipeline_stages_on_awkward_rows(spark, docs, empty, sf_dir):
    from recordloom.llm import stages

    table = docs
    for stage in (stages.quality_stage, stages.near_dedup_stage, stages.substring_stage, stages.decontamination_stage):
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == docs.columns and out.count() <= docs.count()
        assert stage(spark, empty, sf_dir).count() == 0
        table = stage(spark, table, sf_dir).cache()
        assert table.columns == docs.columns
    assert stages.substring_stage(spark, docs, sf_dir).where("text is null").count() == docs.where("text is null").count()
    packed = stages.packing_stage(spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert stages.packing_stage(spark, empty, sf_dir).count() == 0


def test_pipeline_keeps_one_of_rows_repeated_whole(spark, sf_dir):
    from recordloom.llm import stages as p

    long, other = " ".join(f"word{i}" for i in range(200)), " ".join(f"other{i}" for i in range(200))
    data = [(1, long, "en", "a")] * 3 + [(2, other, "en", "b"), (None, long[::-1], "en", "d"), (None, long[::-1], "en", "c"), (3, None, "en", "e"), (3, None, "en", "e")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string").repartition(3)
    single = p.near_dedup_stage(spark, docs, sf_dir).cache()
    assert single.columns == docs.columns
    assert rows(single, "doc_id", "text", "source") == sorted([(1, long, "a"), (2, other, "b"), (None, long[::-1], "c"), (3, None, "e")], key=repr)
    assert rows(p.substring_stage(spark, single, sf_dir), "doc_id", "text") == rows(single, "doc_id", "text")
