"""Phrase collocations from vertical positional inverted lists.

1. Texts are cut into blocks of one language and about one megabyte. In a block, every
   word gets the sorted list of its positions (piece ends leave a gap); these lists are
   written once to the shared folder and are all that later passes read.
2. A phrase is extended by merging its occurrence positions, moved by its length, with the
   postings of the next word; only occurrences whose phrase and whose suffix are frequent
   take part. The length of a list, summed over blocks, is the exact frequency.
3. Lengths are summed by the phrase's 64-bit hash, packed, so that an occurrence moves a few
   bytes and no words. Which hashes are frequent reaches the tasks as one bit array of fixed
   size a length. A false bit lets a longer phrase be counted that the sum drops again.
4. The words of a frequent phrase are looked up once, in one of the parts that have it.
5. Cuts, inclusion and ranks are joins and a ranked window over the tables of frequent phrases.

Rows: a null text is empty; a null language is ``und``, together with rows that say so;
empty texts and texts of separators have no words; ties in score and frequency go by the
phrase's bytes; repeated rows count as often as they are there; an empty table gives an
empty result; other columns are not looked at. Words and phrases are told apart by 64 bits
within their language.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import LOWER, blocks, mix, words
from .common import AtomicFile, batch_of, drop, filesystem, lean, make_dir, mapped, materialise, scratch, small_side

LONGEST = 4
FILTER_BITS = 27
CHUNK_BITS = 16
HELD_KEYS = 1 << 22

_U = np.uint64
_W = [f"w{i + 1}" for i in range(LONGEST)]

#: Piece ends `[.,;:!?\x0A-\x0D]` and, with them, space and tab: what is no word byte.
ENDS = np.zeros(256, dtype=bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
INSIDE = ~ENDS
INSIDE[[0x20, 0x09]] = False

_POSTINGS = pa.schema([("part", pa.int64()), ("lang", pa.string()), ("terms", pa.binary()), ("words", pa.list_(pa.string())), ("lengths", pa.binary()), ("positions", pa.binary())])


def positions_of(data: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Position of every word: neighbours within a piece differ by one, others by more."""
    piece = np.cumsum(ENDS[data])[starts] if len(starts) else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    gap = np.zeros(len(starts), np.int64)
    gap[1:] = (np.diff(piece) != 0) | (np.diff(doc) != 0)
    return (np.arange(len(starts)) + np.cumsum(gap)).astype(np.int32)


def _postings(batches):
    """Inverted lists of blocks: terms ascending, list lengths, positions list by list; ``part`` is the task that made them."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1)
        for lang in pc.unique(langs).to_pylist():
            for block in blocks(texts.filter(pc.equal(langs, lang))):
                w = words(block, INSIDE)
                if not len(w.hashes):
                    continue
                order = np.argsort(w.hashes, kind="stable")
                terms, at, lengths = np.unique(w.hashes, return_index=True, return_counts=True)
                text = LOWER[block.data].tobytes()
                called = [text[a:b].decode() for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]
                positions = positions_of(block.data, w.starts, w.first)[order]
                yield batch_of({"part": [part], "lang": [lang], "terms": [terms.tobytes()], "words": [called], "lengths": [lengths.astype(np.int32).tobytes()], "positions": [positions.tobytes()]}, _POSTINGS)


def _seed(lang: str, size: int) -> np.uint64:
    return _U(int.from_bytes(hashlib.blake2b(f"{size}:{lang}".encode(), digest_size=8).digest(), "little"))


def _hashes(lang: str, columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of each phrase, given by its words' columns."""
    h = np.full(len(columns[0]), _seed(lang, len(columns)), np.uint64)
    for c in columns:
        h = mix(h ^ c.view(np.uint64)) + _U(0x9E3779B97F4A7C15)
    return mix(h)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: bytes that are mostly zero take next to no room."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def _numbers(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1).T).view(kind).ravel()


_KEYS = "bucket int, part bigint, keys binary, counts binary"


def _keys(size: int, bits: int, filters: list):
    """Hashes of the phrases of each part with their counts, packed by bucket: a hash's top ``bits`` bits."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def out(part, held):
        (keys,), counts = _summed([np.concatenate([k for k, _ in held])], np.concatenate([c for _, c in held]))
        bucket = (keys >> _U(64 - bits)).astype(np.int32)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]])
        rows = [(int(bucket[i]), part, _planes(np.diff(keys[i:j], prepend=_U(0))), _planes(counts[i:j].astype("<u4"))) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return batch_of(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    def run(batches):
        frequent, part, held, rows = None, None, [], 0
        for batch in batches:
            frequent = [_loaded(b.value) for b in filters] if frequent is None else frequent
            for of, lang, *lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (of != part or rows > HELD_KEYS):
                    yield out(part, held)
                    held, rows = [], 0
                part = of
                terms, lengths, positions = (np.frombuffer(x, t) for x, t in zip(lists, (np.int64, np.int32, np.int32), strict=True))
                if size == 1:
                    found, counts = _hashes(lang, [terms]), lengths.astype(np.int64)
                else:
                    found = _hashes(lang, occurrences(lang, terms, lengths, positions, size, frequent))
                    (found,), counts = _summed([found], np.ones(len(found), np.int64))
                if len(found):
                    held.append((found, counts))
                    rows += len(found)
        if held:
            yield out(part, held)

    return run


def _often(least: int):
    """Rows sorted by bucket: hashes that occur ``least`` times, their counts, and one of the parts that have them."""
    schema = pa.schema([("hash", pa.int64()), ("f", pa.int64()), ("part", pa.int64())])

    def total(held):
        keys = np.concatenate([k for k, _, _ in held])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        f = np.add.reduceat(np.concatenate([c for _, c, _ in held])[order], at)
        part = np.concatenate([np.full(len(k), p, np.int64) for k, _, p in held])[order][at]
        keep = f >= least
        return batch_of({"hash": keys[at][keep].view(np.int64), "f": f[keep], "part": part[keep]}, schema)

    def run(batches):
        bucket, held = None, []
        for batch in batches:
            for of, part, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != bucket and held:
                    yield total(held)
                    held = []
                bucket = of
                held.append((np.cumsum(_numbers(keys, "<u8"), dtype=np.uint64), _numbers(counts, "<u4").astype(np.int64), part))
        if held:
            yield total(held)

    return run


def _places(batches):
    """Places of hashes in the bit array."""
    schema = pa.schema([("chunk", pa.int32()), ("low", pa.int32())])
    for batch in batches:
        slot = np.unique(batch.column(0).to_numpy().view(np.uint64) >> _U(64 - FILTER_BITS)).astype(np.int64)
        yield batch_of({"chunk": (slot >> CHUNK_BITS).astype(np.int32), "low": (slot & ((1 << CHUNK_BITS) - 1)).astype(np.int32)}, schema)


def _chunks(batches):
    """Rows sorted by chunk: one bit array a chunk."""
    schema, chunk, bits = pa.schema([("chunk", pa.int32()), ("bits", pa.binary())]), None, None
    for batch in batches:
        which, low, out = batch.column(0).to_numpy(), batch.column(1).to_numpy(), {"chunk": [], "bits": []}
        edges = np.flatnonzero(np.diff(which)) + 1
        for part, of in zip(np.split(low, edges), which[np.concatenate([[0], edges]).astype(int)].tolist() if len(which) else [], strict=False):
            if of != chunk:
                if bits is not None:
                    out["chunk"].append(chunk)
                    out["bits"].append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
                chunk, bits = of, np.zeros(1 << CHUNK_BITS, bool)
            bits[part] = True
        yield batch_of(out, schema)
    if bits is not None:
        yield batch_of({"chunk": [chunk], "bits": [zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)]}, schema)


def frequent_hashes(lists: DataFrame, size: int, least: int, bits: int, filters: list) -> DataFrame:
    """Phrases of ``size`` words that occur ``least`` times: hash, f, part.

    Some six bytes are shuffled for each phrase of a part, in buckets of bounded size.
    """
    keys = mapped(lists, _keys(size, bits, filters), _KEYS)
    return materialise(keys.repartition("bucket").sortWithinPartitions("bucket"), f"frequent{size}", lean(_often(least)), "hash bigint, f bigint, part bigint")


def bits_of(frequent: DataFrame) -> list[tuple[int, bytes]]:
    """Hashes as a bit array of 2**FILTER_BITS bits in compressed chunks.

    At most 2**(FILTER_BITS - CHUNK_BITS) rows and 16 MB reach the driver, whatever the input.
    """
    marked = mapped(frequent.select("hash"), _places, "chunk int, low int")
    parts = mapped(marked.repartition("chunk").sortWithinPartitions("chunk"), _chunks, "chunk int, bits binary")
    return [(r["chunk"], bytes(r["bits"])) for r in parts.collect()]


def _loaded(chunks: list[tuple[int, bytes]]) -> np.ndarray:
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    wide = 1 << (CHUNK_BITS - 3)
    for chunk, data in chunks:
        bits[chunk * wide : (chunk + 1) * wide] = np.frombuffer(zlib.decompress(data), np.uint8)
    return bits


def _marked(bits: np.ndarray, lang: str, columns: list[np.ndarray]) -> np.ndarray:
    slot = (_hashes(lang, columns) >> _U(64 - FILTER_BITS)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def occurrences(lang: str, terms: np.ndarray, lengths: np.ndarray, positions: np.ndarray, size: int, frequent: list[np.ndarray]) -> list[np.ndarray]:
    """Word columns of all occurrences of phrases of ``size`` words whose shorter parts are marked.

    ``frequent[i]`` holds the marks of phrases of i + 1 words; marks for ``size`` words are heeded as well.
    """
    live = _marked(frequent[0], lang, [terms])
    at = positions[np.repeat(live, lengths)]
    end = int(at.max()) + size + 1 if len(at) else size + 1
    word, posted = np.zeros(end, np.int64), np.zeros(end, bool)
    word[at], posted[at] = np.repeat(terms[live], lengths[live]), True
    held = np.flatnonzero(posted)
    for n in range(1, size):
        if n > 1:  # lists of phrases that are frequent themselves
            held = held[_marked(frequent[n - 1], lang, [word[held + i] for i in range(n)])]
        begins = np.zeros(end, bool)
        begins[held] = True
        # merge with the next word's postings; the suffix that ends there is in a kept list too
        held = held[posted[held + n] & begins[held + 1]]
    columns = [word[held + i] for i in range(size)]
    if len(frequent) == size:
        columns = [c[keep] for keep in [_marked(frequent[-1], lang, columns)] for c in columns]
    return columns


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows added up."""
    if not len(counts):
        return columns, counts
    order = np.lexsort(columns)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(counts[order], at)


def _totals(batches):
    schema, total = pa.schema([("lang", pa.string()), ("n", pa.int64())]), Counter()
    for batch in batches:
        for lang, lengths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[lang] += int(np.frombuffer(lengths, np.int32).sum())
    yield batch_of({"lang": list(total), "n": list(total.values())}, schema)


def _wanted_files(folder: str):
    """Rows (part, size, hash) sorted by part: one file a part, hashes by size."""

    def run(batches):
        part, held = None, []

        def put():
            sizes, hashes = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            body = [np.sort(hashes[sizes == n].view(np.uint64)) for n in range(1, LONGEST + 1)]
            with AtomicFile(f"{folder}/{part}") as f:
                f.write(np.array([len(x) for x in body], "<i8").tobytes() + b"".join(x.tobytes() for x in body))

        done = 0
        for batch in batches:
            parts, sizes, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]]).astype(int)
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if j > i:
                    if parts[i] != part and held:
                        put()
                        held, done = [], done + 1
                    part = int(parts[i])
                    held.append((sizes[i:j], hashes[i:j]))
        if held:
            put()
            done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["n"])

    return run


def _wanted(folder: str, part: int) -> list[np.ndarray]:
    fs, path = filesystem(f"{folder}/{part}")
    if fs.get_file_info(path).type.name == "NotFound":
        return [np.empty(0, np.uint64)] * LONGEST
    with fs.open_input_stream(path) as f:
        data = f.read()
    sizes = np.frombuffer(data[: 8 * LONGEST], "<i8")
    return np.split(np.frombuffer(data[8 * LONGEST :], np.uint64), np.cumsum(sizes)[:-1])


def _named(folder: str, filters: list):
    """The words of every wanted phrase, once from the part that was chosen for it."""
    schema = pa.schema([("size", pa.int32()), ("hash", pa.int64()), ("lang", pa.string()), *[(w, pa.int64()) for w in _W], ("word", pa.string())])

    def rows(size, lang, hashes, columns, called=None):
        none = pa.nulls(len(hashes), pa.int64())
        return batch_of({"size": np.full(len(hashes), size, np.int32), "hash": hashes.view(np.int64), "lang": pa.array([lang] * len(hashes), pa.string()), "word": called or pa.nulls(len(hashes), pa.string())} | {w: columns[i] if i < size else none for i, w in enumerate(_W)}, schema)

    def run(batches):
        frequent, part, wanted = None, None, []
        for batch in batches:
            frequent = [_loaded(b.value) for b in filters] if frequent is None else frequent
            for at, (of, lang, terms, lengths, positions) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)), strict=True)):
                if of != part:
                    part, wanted = of, _wanted(folder, of)
                lists = np.frombuffer(terms, np.int64), np.frombuffer(lengths, np.int32), np.frombuffer(positions, np.int32)
                for size in range(1, LONGEST + 1):
                    if not len(wanted[size - 1]):
                        continue
                    columns = [lists[0]] if size == 1 else occurrences(lang, *lists, size, frequent[:size])
                    hashes, first = np.unique(_hashes(lang, columns), return_index=True)
                    hit = np.isin(hashes, wanted[size - 1], assume_unique=True)
                    hashes, first = hashes[hit], first[hit]
                    if len(hashes):
                        wanted[size - 1] = np.setdiff1d(wanted[size - 1], hashes, assume_unique=True)
                        called = batch.column(3)[at].values.take(pa.array(first)) if size == 1 else None
                        yield rows(size, lang, hashes, [c[first] for c in columns], called)

    return run


def _cut_scores(levels: list[DataFrame], size: int, scale: int) -> DataFrame:
    """Phrases of ``size`` words with their lowest-scoring cut."""
    found, cuts = levels[size - 1].select("lang", *_W[:size], F.col("f").alias("a")), []
    for k in range(1, size):
        first = levels[k - 1].select("lang", *_W[:k], F.col("f").alias(f"l{k}"))
        rest = levels[size - k - 1].select("lang", *[F.col(_W[i]).alias(_W[k + i]) for i in range(size - k)], F.col("f").alias(f"r{k}"))
        found = found.join(first, ["lang", *_W[:k]]).join(rest, ["lang", *_W[k:size]])
        score = F.expr(f"(cast(a as decimal(27,0)) * {scale}) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*cuts))
    return found.select("lang", *_W[:size], "a", best["l"].alias("l"), best["r"].alias("r"), best["score"].alias("score"))


def _longer(levels: list[DataFrame], size: int) -> DataFrame:
    """For phrases of ``size`` words inside longer ones: the largest frequency of such a longer phrase."""
    parts = [
        levels[n - 1].select("lang", *[F.col(_W[at + i]).alias(_W[i]) for i in range(size)], "f")
        for n in range(size + 1, LONGEST + 1)
        for at in range(n - size + 1)
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("lang", *_W[:size]).agg(F.max("f").alias("longer"))


def phrase_tables(docs: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, list[DataFrame]]:
    """Word totals (lang, n), and frequent phrases of 1 to 4 words (lang, w1.., f; the first with ``word``)."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    ddl = "part bigint, lang string, terms binary, words array<string>, lengths binary, positions binary"
    lists = materialise(source, "postings", lean(_postings), ddl)
    plain, filters, found = lists.select("part", "lang", "terms", "lengths", "positions"), [], []
    # buckets of about a million keys; a block has up to a megabyte of text
    bits = min(24, max(4, math.ceil(math.log2(max(1, lists.count() / 4)))))
    for size in range(1, LONGEST + 1):
        found.append(frequent_hashes(plain, size, least, bits, filters))
        filters.append(spark.sparkContext.broadcast(bits_of(found[-1])))
    totals = materialise(mapped(lists.select("lang", "lengths"), _totals, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    folder = scratch(spark, "wanted")
    make_dir(folder)
    every = reduce(DataFrame.unionByName, [f.select("part", F.lit(n).alias("size"), "hash") for n, f in enumerate(found, 1)])
    mapped(every.repartition("part").sortWithinPartitions("part"), _wanted_files(folder), "n bigint").agg(F.sum("n")).collect()
    named = f"size int, hash bigint, lang string, {', '.join(f'{w} bigint' for w in _W)}, word string"
    # a part whose file was read by two tasks names a phrase twice
    written = materialise(lists, "phrase-words", lean(_named(folder, filters)), named)
    words_of = written.dropDuplicates(["size", "hash"])
    levels = []
    for n, f in enumerate(found, 1):
        own = words_of.where(F.col("size") == n).select("hash", "lang", *_W[:n], *(["word"] if n == 1 else []))
        levels.append(materialise(own.join(f.select("hash", "f"), "hash").drop("hash"), f"phrases{n}"))
    for held in filters:
        held.unpersist()
    drop(lists, folder, written, *found)
    return totals, levels


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, inside: int = 80, scale: int = 2_000_000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A candidate goes where a longer candidate that holds it has ``inside`` percent of its
    frequency or more.
    """
    totals, levels = phrase_tables(docs, least, text_col, lang_col)
    parts = []
    for size in range(2, LONGEST + 1):
        rows = _cut_scores(levels, size, scale)
        if size < LONGEST:
            rows = rows.join(_longer(levels, size), ["lang", *_W[:size]], "left")
            covered = F.col("longer").cast("decimal(27,0)") * 100 >= F.col("a").cast("decimal(27,0)") * inside
            rows = rows.where(F.col("longer").isNull() | ~covered)
        parts.append(rows.select("lang", *[F.col(w) if i < size else F.lit(None).cast("bigint").alias(w) for i, w in enumerate(_W)], "a", "l", "r", "score"))
    rows = reduce(DataFrame.unionByName, parts)
    # ranks with ties first, so that texts of words are joined to few rows
    by = "partition by lang order by score desc, a desc"
    rows = materialise(rows.withColumn("place", F.expr(f"rank() over ({by})")).where(F.col("place") <= top).drop("place"), "ranked")
    named = small_side(levels[0].select("lang", "w1", "word"), row_bytes=96)
    for i, w in enumerate(_W):
        rows = rows.join(named.select("lang", F.col("w1").alias(w), F.col("word").alias(f"t{i}")), ["lang", w], "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", *[f"t{i}" for i in range(LONGEST)]))
    rows = rows.withColumn("rank", F.expr(f"row_number() over ({by}, phrase)")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
