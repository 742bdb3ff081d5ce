"""Benchmark decontamination by training suffix arrays.

Each task keeps, shard by shard (an Arrow batch of whole documents), a suffix
array over the words of its documents, cut to the length of a window. Only
suffixes whose first words all occur in the benchmark can match, so only those
are sorted. Every benchmark suffix is then located by binary search; a window
that occurs gives the shard's suffixes of one interval, hence all places. Runs of
hits on one diagonal give the longest verbatim match per document and item.

Documents are never shuffled. The benchmark is the stated query set. Its items, each once,
are dealt by hash to blocks of about ``block_bytes`` of text (a longer item is a block of
that length), one broadcast and one pass over the documents for each block that has items;
passes are merged by row.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of text with A-Z lower-cased. An item
of fewer than ``window`` words, but not none, is one window. Words are compared by
64-bit hashes. Null or empty texts have no words and are clean; repeated documents
are judged row by row; repeated items count once by id; items without an id mark
words but are not listed; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ALNUM, batch_words
from .common import CONTENT, batch_of, lean, mapped, materialise, text_keys

WINDOW = 13
BLOCK_BYTES = 4 << 20


class TestSet:
    """Distinct windows of a block of items, as sorted search keys.

    A key is the window's word numbers, four big-endian bytes each; ``low`` and
    ``high`` bound the interval of suffixes that begin with it.
    """

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.window = window
        self.ids = [i for i, _ in items]
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        hashes, first = batch_words(texts, ALNUM) if items else (np.empty(0, np.uint64), np.zeros(1, np.int64))
        self.vocabulary = np.unique(hashes)
        numbers = self.numbers(hashes)
        places: dict[bytes, list[tuple[int, int]]] = {}
        for item in range(len(items)):
            row = numbers[first[item] : first[item + 1]].astype(">u4").tobytes()
            size = min(window, len(row) // 4)
            for at in range(len(row) // 4 - size + 1 if size else 0):
                places.setdefault(row[4 * at : 4 * (at + size)], []).append((item, at))
        keys = sorted(places)
        self.sizes = np.array([len(k) // 4 for k in keys], np.int64)
        wide = f"S{4 * window}"
        self.low = np.array(keys, wide) if keys else np.empty(0, wide)
        self.high = np.array([k.ljust(4 * window, b"\xff") for k in keys], wide) if keys else np.empty(0, wide)
        self.places = [places[k] for k in keys]
        self.least = int(self.sizes.min()) if keys else 0

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """1-based vocabulary numbers, 0 for words of no item."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(numbers: np.ndarray, ends: np.ndarray, window: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes that begin with at least ``least`` known words: positions and keys.

    ``ends`` holds, per word, where its document ends. Keys stop at the first
    unknown word or the document's end.
    """
    n = len(numbers)
    stop = np.where(numbers == 0, np.arange(n), n)
    known = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], ends) - np.arange(n)
    at = np.flatnonzero(known >= least)
    take = np.arange(window)
    padded = np.concatenate([numbers, np.zeros(window, numbers.dtype)])
    rows = np.where(take < np.minimum(known[at], window)[:, None], padded[at[:, None] + take], 0).astype(">u4")
    keys = np.ascontiguousarray(rows).view(f"S{4 * window}").ravel()
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def _search(texts: pa.Array, tests: TestSet):
    """Words per document, and per document with hits: intervals and longest match per item."""
    hashes, first = batch_words(texts, ALNUM)
    counts, hits = np.diff(first), {}
    if not len(tests.low) or not len(hashes):
        return counts, hits
    doc = np.repeat(np.arange(len(counts)), counts)
    at, keys = suffix_array(tests.numbers(hashes), first[1:][doc], tests.window, tests.least)
    low, high = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    for w in np.flatnonzero(high > low):
        size = int(tests.sizes[w])
        for place in np.sort(at[low[w] : high[w]]).tolist():
            d = int(doc[place])
            spans, diagonals = hits.setdefault(d, ([], {}))
            word = place - int(first[d])
            spans.append((word, word + size))
            for item, offset in tests.places[w]:
                diagonals.setdefault((item, word - offset), []).append((word, size))
    return counts, hits


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_MATCH = pa.struct([("item_id", pa.int64()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])
_SCHEMA = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("content", pa.int64()), ("content2", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("matches", pa.list_(_MATCH))])
_DDL = "row_id bigint, doc_id bigint, content bigint, content2 bigint, n_words bigint, spans array<struct<a:bigint,b:bigint>>, matches array<struct<item_id:bigint,doc_word:bigint,item_word:bigint,words:bigint>>"


def _scan(tests):
    def run(batches):
        for batch in batches:
            counts, hits = _search(batch.column(2), tests.value)
            spans, matches = [[] for _ in counts], [[] for _ in counts]
            for d, (found, diagonals) in hits.items():
                spans[d] = [{"a": a, "b": b} for a, b in _merged(found)]
                longest: dict[object, tuple] = {}
                for (item, diagonal), placed in diagonals.items():
                    for a, b in _merged([(w, w + s) for w, s in placed]):
                        ident = tests.value.ids[item]
                        longest[ident] = max(longest.get(ident, (0,)), (b - a, -a, -(a - diagonal)))
                matches[d] = [{"item_id": i, "doc_word": -a, "item_word": -o, "words": n} for i, (n, a, o) in longest.items()]
            yield batch_of({"row_id": batch.column(0), "doc_id": batch.column(1), "content": batch.column(3), "content2": batch.column(4), "n_words": counts, "spans": spans, "matches": matches}, _SCHEMA)

    return run


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, spans of hit words, and the longest match of each item."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")).where(F.octet_length("text") > 0).distinct()
    items = materialise(items, "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-total // block_bytes)))))
    filled = [r["block"] for r in items.select("block").distinct().orderBy("block").collect()]
    source = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *text_keys(F.col(text_col)))
    passes = []
    for k in filled or [0]:
        block = items.where(F.col("block") == k).collect()
        tests = spark.sparkContext.broadcast(TestSet([(r["item_id"], r["text"]) for r in block], window))
        if len(filled) < 2:
            return mapped(source, _scan(tests), _DDL).drop("row_id")
        passes.append(materialise(source, "suffix-hits", lean(_scan(tests)), _DDL))
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("row_id").agg(F.first("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in CONTENT], F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("matches")).alias("matches"))
    return merged.drop("row_id")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **kw) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, matches, and the content keys.

    A document is contaminated if hits cover at least one word in twenty.
    """
    found = matches(docs, benchmark, window, **kw)
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["b"] - F.greatest(s["a"], acc["to"]))).alias("n"), F.greatest(acc["to"], s["b"]).alias("to"))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    n_hit = F.aggregate(F.array_sort("spans"), zero, step, lambda acc: acc["n"])
    listed = F.array_sort(F.array_distinct(F.transform(F.filter("matches", lambda m: m["item_id"].isNotNull()), lambda m: m["item_id"].cast("string"))))
    out = found.select("doc_id", *CONTENT, "n_words", n_hit.alias("n_hit"), listed.alias("items"), F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0)).alias("longest_match"), "matches")
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "longest_match",
        "matches",
        *CONTENT,
    )
