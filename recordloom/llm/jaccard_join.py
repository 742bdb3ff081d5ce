"""Exact similarity join on sets of word n-grams, by vertical partitioning.

The global order of n-grams is that of their 64-bit hashes. Cut into fragments, it cuts
every set into segments.

1. Documents with equal sets are one node (two 64-bit sums over the set name it).
2. Two sets of a length class that are similar enough differ in at most d n-grams. With
   d + 1 + e fragments, at least e + 1 of their segments are equal, and where at most e
   segments are empty one of these is not: nodes that share a segment meet in a bucket.
   Sets with more than e empty segments meet in a bucket of their own. Neighbouring length
   classes meet as well, so no link is lost. Buckets with the same members are one.
3. In a bucket, pairs are tested by the parities of their n-grams, folded to one width: sets
   that differ in x n-grams differ in at most x parities, so what fails cannot be a link.
   Blocks of bounded size first give a spanning forest of the pairs that pass.
4. Pairs that pass are counted fragment by fragment: each fragment gives a partial overlap,
   their sum decides. Verified links are contracted.
5. Forests are made again between what is still apart; at last every pair that passes between
   different components is counted. Pairs inside a component are never formed.

Rows: null or empty texts, and texts without words, have empty sets and are linked with
nothing; a text of fewer words than an n-gram is one n-gram; repeated rows belong together
and each is returned; null ids take part but never name a component unless it has no other
id; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import blocks, distinct_pairs, mix, shingles, words
from .common import CONTENT, batch_of, drop, lean, mapped, materialise, small_side, text_keys
from .graph import connected_components

NGRAM = 3
NUMERATOR, DENOMINATOR = 90, 100
PARTS = 4
BLOCK = 1024
LEAST_BITS = 512
FORESTS = 2

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def differing(sizes):
    """Most n-grams in which two linked sets of these sizes, together, can differ."""
    return sizes * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def length_classes(longest: int) -> np.ndarray:
    """Upper ends of length classes: linked sets are of one class or of neighbouring ones."""
    ends = [1]
    while ends[-1] < longest:
        # the largest size that a set of one more can be linked with
        ends.append((ends[-1] + 1) * DENOMINATOR // NUMERATOR)
    return np.array(ends, np.int64)


def fragments(end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of fragments of a class, and how many empty segments it allows for."""
    most = differing(2 * end)
    spare = np.where(most > 0, 2 + most // 32, 0)
    return most + 1 + spare, spare


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, at) if len(at) else np.empty(0, np.uint64)


def signatures(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Buckets of every document, from (document, n-gram) pairs in order: hashes of its
    segments in its own length class and the next."""
    ends = length_classes(int(n.max(initial=1)) * DENOMINATOR // NUMERATOR + 2)
    own, found = np.searchsorted(ends, n), [[] for _ in n]
    value = mix(h + _GOLD)
    for step in (0, 1):
        cls = own + step
        count, spare = fragments(ends[cls])
        part = (((h >> _U(32)) * count[doc].astype(np.uint64)) >> _U(32)).astype(np.int64)
        new = np.ones(len(h), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        of = doc[at]
        key = mix(_sums(value, at) ^ mix((cls[of].astype(np.uint64) << _U(32)) + part[at].astype(np.uint64))).view(np.int64)
        cuts = np.searchsorted(of, np.arange(len(n) + 1))
        for i in range(len(n)):
            if n[i]:
                keys = key[cuts[i] : cuts[i + 1]]
                found[i].append(keys)
                if count[i] - len(keys) > spare[i]:
                    found[i].append(mix(np.array([int(cls[i]) + (1 << 40)], np.uint64)).view(np.int64))
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]


def parity(h: np.ndarray) -> np.ndarray:
    """Parities of a set's n-grams in the least power of two of places that holds them."""
    width = max(LEAST_BITS, 1 << int(len(h) - 1).bit_length()) if len(h) else LEAST_BITS
    slot = (mix(h ^ _GOLD) & _U(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(slot, minlength=width).astype(np.uint8) & 1, bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Parities in fewer places: halves are added."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _sets(batches):
    """Names and sizes of all sets; buckets and parities of those that the task has not had yet."""
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("content2", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("parity", pa.binary())])
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        out = {name: [] for name in ("node", "check", "n", "keys", "parity")}
        for block in blocks(batch.column(3)):
            doc, h = distinct_pairs(*shingles(words(block), NGRAM))
            n = np.bincount(doc, minlength=block.n_docs)
            cut = np.searchsorted(doc, np.arange(block.n_docs + 1))
            names = []
            for seed in (1, 2):
                total = np.concatenate([[_U(0)], np.cumsum(mix(h ^ _U(seed)))]).astype(np.uint64)
                names.append(np.where(n > 0, np.maximum(mix(total[cut[1:]] - total[cut[:-1]]), _U(1)), _U(0)).view(np.int64))
            new = np.zeros(block.n_docs, bool)
            for i, name in enumerate(zip(*(x.tolist() for x in names), strict=True)):
                if name[0] and name not in seen:
                    new[i] = True
                    seen.add(name)
            if len(seen) > 1 << 20:
                seen.clear()
            keep = new[doc]
            keys = iter(signatures((np.cumsum(new) - 1)[doc[keep]], h[keep], n[new]) if new.any() else [])
            out["node"] += [x or None for x in names[0].tolist()]
            out["check"] += names[1].tolist()
            out["n"] += n.tolist()
            out["keys"] += [next(keys) if x else None for x in new]
            out["parity"] += [parity(h[cut[i] : cut[i + 1]]).tobytes() if x else None for i, x in enumerate(new)]
        yield batch_of({"doc_id": batch.column(0), "content": batch.column(1), "content2": batch.column(2)} | out, schema)


class _Forest:
    """Sets of components that are joined already."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while x in self.up:
            x = self.up[x]
        return x

    def joins(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def passing(size: int, bits: np.ndarray, sizes: np.ndarray, others: dict[int, np.ndarray], order: np.ndarray) -> np.ndarray:
    """Places of the sets that may be linked with one of ``size`` and ``bits``: lengths and parities allow it.

    ``others`` holds parities by width, ``order`` their row in it.
    """
    fit = (DENOMINATOR * np.minimum(sizes, size) >= NUMERATOR * np.maximum(sizes, size)).nonzero()[0]
    keep = np.zeros(len(fit), bool)
    for width, rows in others.items():
        mine = order[fit, 0] == width
        if mine.any():
            least = min(width, len(bits))
            apart = np.bitwise_count(fold(rows[order[fit[mine], 1]], least) ^ fold(bits, least)).sum(axis=-1)
            keep[mine] = apart <= differing(sizes[fit[mine]] + size)
    return fit[keep]


def _candidates(forest: bool):
    """Rows sorted by (bucket, i, j): pairs of different components that may be linked; as a
    forest, no pair whose components are joined by others of its block pair."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(rows):
        _, i, j, size, node, comp, block, bits = (np.array(x) if k < 7 else x for k, x in enumerate(zip(*rows, strict=True)))
        bits = [np.frombuffer(x, np.uint64) for x in bits]
        widths = np.array([len(x) for x in bits])
        others = {int(w): np.stack([bits[k] for k in np.flatnonzero(widths == w)]) for w in np.unique(widths)}
        order = np.stack([widths, np.zeros(len(bits), np.int64)], axis=1)
        for w in others:
            order[widths == w, 1] = np.arange((widths == w).sum())
        known, out = _Forest(), ([], [])
        # the component with most rows is only ever looked at from outside
        names, counts = np.unique(comp, return_counts=True)
        main = names[np.argmax(counts)]
        left, right = np.flatnonzero(block == i[0]), np.flatnonzero(block == j[0])
        for x in range(len(node)):
            if comp[x] == main:
                continue
            other = right if block[x] == i[0] else left
            # both of the others: looked at from the first of them only
            other = other[(comp[other] != comp[x]) & ((comp[other] == main) | (other > x))]
            if not len(other):
                continue
            passed = other[passing(int(size[x]), bits[x], size[other], others, order[other])]
            for y in passed.tolist():
                if not forest or known.joins(int(comp[x]), int(comp[y])):
                    out[0].append(int(max(node[x], node[y])))
                    out[1].append(int(min(node[x], node[y])))
        return out

    def run(batches):
        held, key = [], None
        for batch in batches:
            a, b = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key and held:
                    x, y = pairs(held)
                    a, b, held = a + x, b + y, []
                key = row[:3]
                held.append(row)
            yield batch_of({"a": a, "b": b}, schema)
        if held:
            yield batch_of(dict(zip("ab", pairs(held), strict=True)), schema)

    return run


def _between(live: DataFrame, parts: DataFrame | None, nodes: DataFrame, forest: bool, seed: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and may be linked."""
    placed = live.withColumn("component", F.col("node")) if parts is None else live.join(small_side(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x <> y").select("bucket", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    rows = placed.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("node", F.lit(seed)), "blocks"))
    if forest:  # within blocks only: as many pairs as rows at most
        rows = rows.select("bucket", F.col("block").alias("i"), F.col("block").alias("j"), "node", "component", "block")
    else:
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
        rows = rows.select("bucket", "node", "component", "block", other).select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "block")
    rows = rows.join(nodes.select("node", "n", "parity"), "node").select("bucket", "i", "j", "n", "node", "component", "block", "parity")
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "n", "node")
    return mapped(rows, _candidates(forest), "a bigint, b bigint").distinct()


def _segments(batches):
    """Parts of the sets of texts: node, part, elements."""
    schema = pa.schema([("node", pa.int64()), ("part", pa.int32()), ("elements", pa.binary())])
    for batch in batches:
        nodes = batch.column(0).to_pylist()
        for block in blocks(batch.column(1)):
            doc, h = distinct_pairs(*shingles(words(block), NGRAM))
            cut = np.searchsorted(doc, np.arange(block.n_docs + 1))
            out = {"node": [], "part": [], "elements": []}
            for i in range(block.n_docs):
                own = h[cut[i] : cut[i + 1]]
                edges = np.searchsorted(own, (np.arange(1, PARTS, dtype=np.uint64) * _U((1 << 64) // PARTS)))
                for part, x in enumerate(np.split(own, edges)):
                    out["node"].append(nodes[block.first + i])
                    out["part"].append(part)
                    out["elements"].append(x.tobytes())
            yield batch_of(out, schema)


def _partial(batches):
    """Partial overlap of two segments."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64())])
    for batch in batches:
        shared = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield batch_of({"a": batch.column(0), "b": batch.column(1), "shared": shared}, schema)


def linked(pairs: DataFrame, segments: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose partial overlaps, summed over all fragments, make a link: a, b."""
    sides = [segments.select(F.col("node").alias(n), "part", F.col("elements").alias(f"of_{n}")) for n in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], ["b", "part"]).select("a", "b", "of_a", "of_b")
    counts = mapped(both, _partial, "a bigint, b bigint, shared bigint").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    for n in "ab":
        counts = counts.join(nodes.select(F.col("node").alias(n), F.col("n").alias(f"n_{n}")), n)
    return materialise(counts.where(DENOMINATOR * F.col("shared") >= NUMERATOR * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b"), "links")


def _told_apart(rows: DataFrame, twins: DataFrame) -> DataFrame:
    """Rows whose node names a set by 128 bits: all but one of the sets that share 64 get another."""
    new = F.when(F.col("first").isNotNull() & (F.col("check") != F.col("first")), F.xxhash64("node", "check")).otherwise(F.col("node"))
    return rows.join(small_side(twins), "node", "left").withColumn("node", new).drop("first")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *text_keys(text), text.alias("text"))
    made = materialise(source, "sets", lean(_sets), "doc_id bigint, content bigint, content2 bigint, node bigint, check bigint, n bigint, keys array<bigint>, parity binary")
    names = made.where("node is not null").groupBy("node").agg(F.min("check").alias("first"), F.max("check").alias("other"))
    twins = materialise(names.where("first <> other").select("node", "first"), "twins")
    apart = (lambda x: x) if twins.isEmpty() else (lambda x: _told_apart(x, twins))
    dealt = apart(made.where("keys is not null").select("node", "check", "keys")).select("node", F.explode("keys").alias("bucket")).repartition("bucket")
    # buckets of one node, by far the most, end where they were dealt: one exchange of two numbers a row
    alone = Window.partitionBy("bucket")
    met = dealt.select("bucket", "node", F.min("node").over(alone).alias("x"), F.max("node").over(alone).alias("y")).where("x <> y")
    postings = materialise(met.select("bucket", "node").distinct(), "met-buckets")
    shared = postings.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).where("size > 1")
    # buckets with the same members are one
    kept = materialise(shared.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"), "kept-buckets")
    live = materialise(postings.join(small_side(kept), "bucket").select("bucket", "node"), "buckets")
    chosen = materialise(live.select("node").distinct(), "chosen")
    rows = apart(made.where("parity is not null").select("node", "check", "doc_id", *CONTENT, "n", "parity"))
    nodes = rows.join(small_side(chosen), "node", "left_semi").groupBy("node").agg(F.max(F.struct("doc_id", *CONTENT)).alias("at"), F.max("n").alias("n"), F.max("parity").alias("parity"))
    nodes = materialise(nodes.select("node", F.col("at.doc_id").alias("at_id"), *[F.col(f"at.{c}").alias(f"at_{c}") for c in CONTENT], "n", "parity"), "nodes")
    rows = materialise(apart(made.select("node", "check", "doc_id", "n")).select("doc_id", "n", "node"), "rows")
    drop(made, kept, chosen, postings)
    wanted = small_side(nodes.select("node", "at_id", *[f"at_{c}" for c in CONTENT]))
    same = [source[c] == F.col(f"at_{c}") for c in CONTENT]
    texts = source.join(wanted, same[0] & same[1] & source["doc_id"].eqNullSafe(F.col("at_id"))).select("node", "text").dropDuplicates(["node"])
    segments = materialise(texts, "segments", lean(_segments), "node bigint, part int, elements binary")

    parts, links = None, None
    for step in range(FORESTS + 1):
        pairs = materialise(_between(live, parts, nodes, step < FORESTS, step), "pairs")
        more = linked(pairs, segments, nodes)
        drop(pairs, parts)
        links = more if links is None else materialise(links.unionByName(more), "links")
        parts = materialise(connected_components(links), "parts")
    drop(live, segments, nodes, links)

    least = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = materialise(least.join(small_side(parts), "node", "left").select("node", F.coalesce("component", "node").alias("component"), "least"), "placed")
    first = materialise(placed.groupBy("component").agg(F.min("least").alias("component_id")), "components")
    called = materialise(placed.join(small_side(first), "component").select("node", "component_id"), "called")
    drop(placed, first, parts)
    full = rows.where("node is not null").join(small_side(called), "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    bare = rows.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(bare)
