"""Removal of long repeated substrings by merging shard Burrows-Wheeler transforms.

A text is a sequence of units: its bytes, or its words. A window is a run of so many
units that is removed if it starts anywhere else too.

1. Every window belongs to the least k-gram hash inside it. Consecutive windows of
   one anchor form a string (their units together), cut after ``RUN`` window lengths.
   Equal windows have equal anchors wherever they start, so only strings that share
   an anchor need comparing. Strings are named by hash and counted before any bytes
   move; an anchor that occurs once is dropped.
2. The bytes of one copy of each distinct remaining string go to its anchor's
   task. There strings form shards. A suffix is read in symbols of a part of the window;
   each shard's suffixes are sorted to that many symbols, which gives the shard's
   transform: the symbol before each suffix, in suffix order.
3. Shards are merged by iterative interleave refinement: the interleave, first
   shard by shard, is stably sorted by the transforms' next symbols, once a symbol
   of depth; no suffix is sorted again. The round that first parts two neighbours
   is their common prefix. Intervals that no round has parted share a window; those of
   total multiplicity two or more are repeated. Strings carry their number of
   occurrences, so that copies are merged as one; nothing is decided by counting alone.
4. An anchor with more than ``HOT_BYTES`` of distinct strings (a passage that many texts
   hold in different surroundings) is not merged but split: its windows are anchored
   again by longer k-grams, at last by the whole window. Equal windows stay together,
   windows that differ near the anchor part, so that no task gets an unbounded group.
5. Repeated windows are joined back to the strings' occurrences, merged per text,
   and cut out.

Texts are named by a 128-bit content key. A task emits the strings of at most two
copies of a text, which is all that a multiplicity of two or more needs; all copies
lose the same bytes. Texts are not shuffled but for those that hold compared strings.

Rows: null is empty; texts shorter than a window have none, so an empty table gives no
rows and a text of any length is taken whole, in chunks; repeated rows are repeats of
each other; ids, null or not, play no part in matching; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, blocks, prefix_hash, prefix_of, range_hash, words
from .common import CONTENT, batch_of, drop, lean, mapped, materialise, small_side, text_keys

WINDOW = 400
PASSAGE_WORDS = 51
GRAMS = (0.08, 0.9, 1.0)
RUN = 4
HOT_BYTES = 1 << 20
MERGE_BYTES = 1 << 18
SHARDS = 4
CHUNK = 1 << 18
ANCHOR_BYTES = 1 << 18
SEEN = 1 << 20
BYTES, WORDS = "byte", "word"

_U = np.uint64


def _prefix(data: np.ndarray) -> np.ndarray:
    return prefix_hash(data) if data.dtype == np.uint8 else prefix_of(data)


def anchors(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Strings of texts (units ``data``, text i at offsets[i]..offsets[i+1]): text, start, windows,
    anchor and content hashes, and whether the anchor's k-gram occurs at several places of the string."""
    names = ("doc", "start", "windows", "anchor", "string", "multi")
    found = []
    for at in range(0, max(1, len(data) - window + 1), CHUNK):
        part = data[at : at + CHUNK + window - 1]
        n = len(part) - window + 1
        if n <= 0:
            break
        total = _prefix(part)
        place = np.arange(len(part) - gram + 1)
        grams = range_hash(total, place, place + gram)
        packed = (grams & ~_U((1 << 24) - 1)) | place.astype(np.uint64)
        width = window - gram + 1
        pad = -len(packed) % width
        tiles = np.concatenate([packed, np.full(pad, ~_U(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(tiles, axis=1).ravel()
        behind = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _U((1 << 24) - 1)).astype(np.int64)
        del tiles, ahead, behind, packed
        doc = np.searchsorted(offsets, np.arange(at, at + n), side="right") - 1
        valid = np.arange(at, at + n) + window <= offsets[doc + 1]
        value = grams[least]
        starts = valid.copy()
        starts[1:] &= ~valid[:-1] | (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(starts)
        if not len(first):
            continue
        gaps = np.append(np.flatnonzero(~valid), n)
        stop = np.minimum(np.append(first[1:], n), gaps[np.searchsorted(gaps, first)])
        # cut long runs, always at the same places after the run's start
        pieces = -(-(stop - first) // (RUN * window))
        run = np.repeat(np.arange(len(first)), pieces)
        first = first[run] + (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * (RUN * window)
        stop = np.minimum(first + RUN * window, stop[run])
        moves = np.concatenate([[0], np.cumsum(least[1:] != least[:-1])])
        found.append({"doc": doc[first], "start": at + first - offsets[doc[first]], "windows": stop - first, "anchor": value[first], "string": range_hash(total, first, stop + window - 1), "multi": (moves[stop - 1] > moves[first]).astype(np.int32)})
    return {k: np.concatenate([f[k] for f in found]) if found else np.empty(0, np.uint64 if k in ("anchor", "string") else np.int64) for k in names}


_STRINGS = "anchor bigint, string bigint, content bigint, content2 bigint, doc_id bigint, starts array<bigint>, windows bigint, multi int, at bigint, size bigint"
_PLACE = (*CONTENT, "doc_id", "at", "size")


def _strings_of(unit, window, gram):
    """Strings of whole texts, or of the window ranges in a fifth column; at most two copies of a text in a task."""
    schema = pa.schema([("anchor", pa.int64()), ("string", pa.int64()), ("content", pa.int64()), ("content2", pa.int64()), ("doc_id", pa.int64()), ("starts", pa.list_(pa.int64())), ("windows", pa.int64()), ("multi", pa.int32()), ("at", pa.int64()), ("size", pa.int64())])

    def run(batches):
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            new = np.zeros(batch.num_rows, bool)
            for i, key in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                times = seen.get(key, 0)
                if times < 2:
                    seen[key], new[i] = times + 1, True
            if len(seen) > SEEN:
                seen.clear()
            batch = batch if new.all() else batch.filter(pa.array(new))
            ranges = batch.column(4).to_pylist() if batch.num_columns > 4 else None
            for block in blocks(batch.column(3), ANCHOR_BYTES):
                w = words(block) if unit == WORDS else None
                data, offsets = (block.data, block.offsets) if w is None else (w.hashes, w.first)
                row, shift, origin = np.arange(block.n_docs), np.zeros(block.n_docs, np.int64), offsets[:-1]
                if ranges is not None:
                    parts = [(i, r["start"], offsets[i] + r["start"], r["windows"] + window - 1) for i in range(block.n_docs) for r in ranges[block.first + i] or ()]
                    if not parts:
                        continue
                    row, shift, origin, sizes = np.array(parts, np.int64).T
                    data, offsets = np.concatenate([data[a : a + n] for _, _, a, n in parts]), np.concatenate([[0], np.cumsum(sizes)])
                s = anchors(data, offsets, window, gram)
                at, size = s["start"] + shift[s["doc"]], s["windows"] + window - 1
                start = at
                if w is not None:  # where the string's bytes are
                    first = origin[s["doc"]] + s["start"]
                    at = w.starts[first] - block.offsets[row[s["doc"]]]
                    size = w.ends[first + size - 1] - w.starts[first]
                # one row for a string that a text holds in several places
                place = row[s["doc"]]
                order = np.lexsort((start, s["string"], s["anchor"], place))
                new = np.zeros(len(order), bool)
                new[:1] = True
                for key in (place, s["anchor"], s["string"]):
                    new[1:] |= key[order][1:] != key[order][:-1]
                lead = order[new]
                starts = pa.ListArray.from_arrays(pa.array(np.append(np.flatnonzero(new), len(order)), pa.int32()), pa.array(start[order], pa.int64()))
                take = pa.array(place[lead] + block.first, pa.int64())
                yield batch_of({"anchor": s["anchor"][lead].view(np.int64), "string": s["string"][lead].view(np.int64), "content": batch.column(1).take(take), "content2": batch.column(2).take(take), "doc_id": batch.column(0).take(take), "starts": starts, "windows": s["windows"][lead], "multi": s["multi"][lead], "at": at[lead], "size": size[lead]}, schema)

    return run


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks 0.. of values, equal for equal."""
    order = np.argsort(values)
    ranked = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]])) if len(values) else []
    return out


def _stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable sorting permutation of small whole numbers, by sorting numbers that end in the place."""
    bits = max(1, int(len(keys)).bit_length())
    if not len(keys) or int(keys.max()) >= 1 << (62 - bits):
        return np.argsort(keys, kind="stable")
    packed = (keys.astype(np.int64) << bits) | np.arange(len(keys))
    packed.sort()
    return packed & ((1 << bits) - 1)


class ShardTransform:
    """Suffixes of some strings in order of their first ``depth`` symbols, and the symbol before each."""

    def __init__(self, places: np.ndarray, symbols: np.ndarray, after: np.ndarray, before: np.ndarray, depth: int):
        """``after``/``before``: the place one symbol on or back, cyclic through a string's end."""
        rank, span = symbols, 1
        local = np.zeros(len(symbols), np.int64)
        local[places] = np.arange(len(places))
        rank, step = symbols[places], local[after[places]]
        while span < depth:
            ended = symbols[places] == 0
            nxt = np.where(ended, 0, rank[step] + 1)
            rank = _dense(rank.astype(np.int64) * (int(nxt.max(initial=0)) + 1) + nxt)
            step, span = step[step], span * 2
        self.suffixes = places[_stable_order(rank)]
        self.transform = symbols[before[self.suffixes]]


def merge_transforms(shards: list[ShardTransform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave refinement: all suffixes in merged order, and for each the number of
    symbols (at most ``depth``) that it shares with the one before."""
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.suffixes) for s in shards])
    transforms = np.concatenate([s.transform for s in shards]).astype(np.int32)
    n = len(source)
    common, group = np.full(n, depth, np.int8), np.zeros(n, np.int32)
    if n:
        common[0] = 0
    for t in range(depth):
        symbol = np.empty(n, np.int32)
        symbol[np.argsort(source, kind="stable")] = transforms  # each shard's transform is read in its own order
        order = _stable_order(symbol)
        source, symbol, group = source[order], symbol[order], group[order]
        parted = np.ones(n, bool)
        parted[1:] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        common[parted & (common > t)] = t
        group = np.cumsum(parted, dtype=np.int32)
    merged = np.empty(n, np.int32)
    merged[np.argsort(source, kind="stable")] = np.concatenate([s.suffixes for s in shards])
    return merged, common


def repeated_windows(strings: list[np.ndarray], keys: np.ndarray, weights: np.ndarray, window: int = WINDOW, n_shards: int = SHARDS) -> list[np.ndarray]:
    """Per string (an array of units) a mask of its windows that occur again under the same key.

    ``weights`` counts the copies of each string; all copies share one entry.
    """
    depth = next(d for d in (4, 3, 5, 2, 1) if window % d == 0)
    symbol = window // depth
    # one end unit each, so that every remainder of a place by the symbol ends in an end mark
    end_unit = np.zeros(1, strings[0].dtype)
    data = np.concatenate([x for s in strings for x in (s, end_unit)])
    offsets = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])]).astype(np.int32)
    owner = np.repeat(np.arange(len(strings), dtype=np.int32), np.diff(offsets))
    place = np.arange(len(data), dtype=np.int32)
    begin = offsets[owner]
    full = place + symbol < offsets[owner + 1]
    whole = np.flatnonzero(full)
    hashed = range_hash(_prefix(data), whole, whole + symbol) ^ (keys[owner[whole]] * _U(0x9E3779B97F4A7C15))
    symbols = np.zeros(len(data), np.int32)
    symbols[whole] = _dense(hashed) + 1
    del hashed, whole
    # one symbol on, or back to the first place of the same remainder: a cycle through the end mark
    after = np.where(full, place + np.int32(symbol), begin + (place - begin) % np.int32(symbol))
    before = np.empty(len(data), np.int32)
    before[after] = place
    cuts = np.linspace(0, len(strings), min(n_shards, len(strings)) + 1).astype(int)
    shards = [ShardTransform(place[offsets[a] : offsets[b]], symbols, after, before, depth) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    merged, common = merge_transforms(shards, depth)
    interval = np.cumsum(common < depth) - 1
    counts = np.bincount(interval, weights=weights[owner[merged]])
    repeated = np.zeros(len(data), bool)
    repeated[merged] = counts[interval] >= 2
    return [repeated[a : b - window] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the true runs of a mask."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def units_of(strings: list[bytes], unit: str) -> list[np.ndarray]:
    """Bytes of each string, or hashes of its words."""
    if unit == BYTES:
        return [np.frombuffer(s, np.uint8) for s in strings]
    w = words(Block(0, np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in strings])])))
    return np.split(w.hashes, w.first[1:-1])


def _merge_task(unit, window):
    """Rows sorted by anchor (anchor, string, weight, bytes): repeated window ranges per string."""
    schema = pa.schema([("anchor", pa.int64()), ("string", pa.int64()), ("from", pa.list_(pa.int32())), ("to", pa.list_(pa.int32()))])

    def solve(rows):
        masks = repeated_windows(units_of([r[3] for r in rows], unit), np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[2] for r in rows]), window)
        spans = [runs(m) for m in masks]
        keep = [i for i, s in enumerate(spans) if len(s[0])]
        return batch_of({"anchor": [rows[i][0] for i in keep], "string": [rows[i][1] for i in keep], "from": [spans[i][0] for i in keep], "to": [spans[i][1] for i in keep]}, schema)

    def run(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != held[-1][0]:
                    seen = set()
                    if size >= MERGE_BYTES:
                        yield solve(held)
                        held, size = [], 0
                if row[1] not in seen:
                    seen.add(row[1])
                    held.append(row)
                    size += len(row[3])
        if held:
            yield solve(held)

    return run


def merged_spans(spans) -> list[tuple[int, int]]:
    """Union of (from, to) ranges; ranges that touch join."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _level(docs: DataFrame, occurrences: DataFrame, unit: str, window: int, last: bool, held: list) -> tuple[DataFrame, DataFrame | None]:
    """Ranges of repeated windows (content keys, spans array<struct<a,b>>), and window ranges of hot anchors, if any.

    Tables that the ranges are read from are added to ``held``.
    """
    # most strings share their anchor with no other: anchors are counted alone, before anything wider moves
    anchors_of = occurrences.groupBy("anchor").agg(F.sum(F.size("starts") + F.col("multi")).alias("total")).where("total > 1").select("anchor")
    kept = materialise(anchors_of, "shared-anchors")
    occurrences, every = materialise(occurrences.join(small_side(kept, row_bytes=24), "anchor", "left_semi"), "shared-occurrences"), occurrences
    drop(kept, every)
    # one of the copies: the same for all columns, by a hash of where it is
    chosen = F.xxhash64(*_PLACE)
    strings = occurrences.groupBy("anchor", "string").agg(F.sum(F.size("starts")).alias("weight"), *[F.min_by(c, chosen).alias(c) for c in _PLACE])
    groups = strings.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("size").alias("bytes"))
    hot = F.lit(False) if last else (F.col("bytes") > HOT_BYTES) & (F.col("kinds") > 1)
    shared = materialise(strings.join(groups.select("anchor", hot.alias("hot")), "anchor").select("anchor", "string", "weight", "hot", *_PLACE), "shared-strings")
    compared = shared.where("not hot")

    # the text of one copy of each string: its holder, found by content and id
    keyed = [F.col(c).alias(f"at_{c}") for c in (*CONTENT, "doc_id")]
    wanted = compared.groupBy(*keyed).agg(F.collect_list(F.struct("anchor", "string", "weight", "at", "size")).alias("wanted"))
    keys = materialise(compared.select(*keyed).distinct(), "holders")
    same = (F.col("content") == F.col("at_content")) & (F.col("content2") == F.col("at_content2")) & F.col("doc_id").eqNullSafe(F.col("at_doc_id"))
    texts = docs.join(small_side(keys), same, "left_semi").join(wanted, same).select(F.col("text").cast("binary").alias("text"), F.explode("wanted").alias("w"))
    # F.substring takes no columns before Spark 4; the expression does
    parts = texts.select("w.anchor", "w.string", "w.weight", F.expr("substring(text, cast(w.at as int) + 1, cast(w.size as int))").alias("bytes"))
    parts = parts.repartition("anchor").sortWithinPartitions("anchor")
    merged = materialise(parts, "repeated-windows", lean(_merge_task(unit, window)), "anchor bigint, string bigint, from array<int>, to array<int>")
    drop(keys)
    held += [occurrences, shared, merged]

    # a text's spans stay in arrays: one row for a string and text, however often it holds the string
    each = lambda start: F.transform(F.arrays_zip("from", "to"), lambda r: F.struct((start + r["from"]).alias("a"), (start + r["to"] + (window - 1)).alias("b")))
    spans = occurrences.join(merged, ["anchor", "string"]).select(*CONTENT, F.flatten(F.transform("starts", each)).alias("spans")).distinct()
    split = shared.where("hot").select("anchor").distinct()
    if last or split.isEmpty():
        return spans, None
    ranges = F.transform("starts", lambda start: F.struct(start.alias("start"), F.col("windows").alias("windows")))
    again = occurrences.join(split, "anchor", "left_semi").select(*CONTENT, ranges.alias("ranges")).distinct()
    return spans, materialise(again.groupBy(*CONTENT).agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "hot-ranges")


def repeated_spans(docs: DataFrame, window: int = WINDOW, unit: str = BYTES) -> DataFrame:
    """Ranges of units to remove per distinct text: content keys, spans array<struct<a,b>>; a table in the shared folder.

    ``docs`` has doc_id, the content keys and text.
    """
    every, ranges, held = None, None, []
    docs = docs.select("doc_id", *CONTENT, "text")
    for share in GRAMS:
        source = docs if ranges is None else docs.join(small_side(ranges, F.size("ranges")), [*CONTENT]).select("doc_id", *CONTENT, "text", "ranges")
        occurrences = materialise(source, "strings", lean(_strings_of(unit, window, max(1, int(share * window)))), _STRINGS)
        held.append(ranges)
        spans, ranges = _level(docs, occurrences, unit, window, share == GRAMS[-1], held)
        every = spans if every is None else every.unionByName(spans)
        if ranges is None:
            break
    spans = materialise(every.groupBy(*CONTENT).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")), "removal-spans")
    drop(*held)
    return spans


def covered(spans) -> F.col:
    """Units covered by a sorted array of spans (a, b)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["b"] - F.greatest(s["a"], acc["to"]))).alias("n"), F.greatest(acc["to"], s["b"]).alias("to"))
    return F.coalesce(F.aggregate(spans, zero, step, lambda acc: acc["n"]), F.lit(0).cast("bigint"))


def cut_bytes(text: str | None, spans, word_spans=None) -> tuple[bytes, bytes, list[tuple[int, int]]]:
    """A text's bytes, what is left of them, and the maximal removed runs (byte spans, and spans of words)."""
    data, at, kept = (text or "").encode("utf-8"), 0, []
    places = [(s["a"], s["b"]) for s in spans or ()]
    if word_spans:
        w = words(Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)])))
        places += [(int(w.starts[s["a"]]), int(w.ends[s["b"] - 1])) for s in word_spans]
    cut = merged_spans(places)
    for a, b in cut:
        kept.append(data[at:a])
        at = b
    return data, b"".join([*kept, data[at:]]), cut


def _digests(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_passage_words", pa.int64())])
    for batch in batches:
        rows = {c: [] for c in schema.names}
        for doc_id, text, spans, passages in zip(*batch.columns, strict=True):
            data, left, cut = cut_bytes(text.as_py(), spans.as_py())
            for c, v in zip(schema.names, (doc_id.as_py(), len(data), len(data) - len(left), len(cut), hashlib.sha256(left).hexdigest(), passages.as_py()), strict=True):
                rows[c].append(v)
        yield batch_of(rows, schema)


def _cut_column(place):
    def run(batches):
        for batch in batches:
            spans, word_spans = batch.columns[-2:]
            texts = [text.as_py() if not (s.is_valid or w.is_valid) else cut_bytes(text.as_py(), s.as_py(), w.as_py())[1].decode("utf-8", "ignore") for text, s, w in zip(batch.column(place), spans, word_spans, strict=True)]
            columns = batch.columns[:-2]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-2])

    return run


def _spans_table(source: DataFrame, window: int, passage: int | None) -> DataFrame:
    """Per content: spans of bytes, and spans of words of repeated passages (null if ``passage`` is None)."""
    spans = repeated_spans(source, window)
    if passage is None:
        return spans.select(*CONTENT, "spans", F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("word_spans"))
    passages = repeated_spans(source, passage, WORDS).withColumnRenamed("spans", "word_spans")
    both = materialise(spans.join(passages, [*CONTENT], "full"), "both-spans")
    drop(spans, passages)
    return both


def _with_spans(source: DataFrame, window: int, passage: int | None) -> DataFrame:
    both = _spans_table(source, window, passage)
    entries = F.greatest(F.size("spans"), F.lit(0)) + F.greatest(F.size("word_spans"), F.lit(0))
    return source.join(small_side(both, entries), [*CONTENT], "left").drop(*CONTENT)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", passage: int | None = PASSAGE_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words.

    Bytes go by the rule of ``window`` bytes. ``n_passage_words`` only reports: words inside runs of
    ``passage`` words (compared with A-Z lower-cased) that start anywhere else too, which may be
    shorter than the window.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *text_keys(F.col(text_col)), F.col(text_col).alias("text"))
    rows = _with_spans(source, window, passage).select("doc_id", "text", "spans", covered(F.col("word_spans")).alias("n_passage_words"))
    return mapped(rows, _digests, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_passage_words bigint")


def strip_repeats(docs: DataFrame, window: int = WINDOW, passage: int | None = None) -> DataFrame:
    """The documents with what is left of their texts; other columns stay.

    Repeated windows of ``window`` bytes go, and with ``passage`` repeated runs of so many words.
    ``docs`` has doc_id and text. Bytes of a character that a cut has split are
    left out; n_chars, if there, counts the new text.
    """
    # the columns travel in a struct, so that none can clash with those used here
    source = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), *text_keys(F.col("text")), F.col("text").alias("text"))
    extra = [f"{c}_{uuid.uuid4().hex}" for c in ("spans", "words")]
    joined = _with_spans(source, window, passage).select("doc.*", F.col("spans").alias(extra[0]), F.col("word_spans").alias(extra[1]))
    out = mapped(joined, _cut_column(docs.columns.index("text")), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
