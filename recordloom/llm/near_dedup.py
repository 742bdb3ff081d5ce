"""Near-duplicate documents by SetSketch registers.

1. Every document becomes a set of distinct 5-word shingles (64-bit hashes). Each
   shingle starts a Poisson process of rate ``A`` per register; a register keeps
   the least arrival time of all shingles, as the integer floor(1 - log_b(time)).
   Registers are mergeable (maximum of values) and locality-sensitive. Documents
   with the same word sequence are one node from here on.
2. Four registers make a band; nodes that share a band value meet in a bucket.
   48 bands, of the first 192 registers, miss a pair at the threshold with probability 1e-8.
3. In each bucket the node with the most company is the hub; every other node is
   compared with it: first the joint maximum-likelihood estimate of the similarity
   from registers and set sizes, then the full sets. Verified links are contracted.
4. Buckets that still hold more than one component are searched for links between
   components, in pairs of bounded blocks of registers: the likelihood test drops
   what is clearly apart (four standard errors), the rest is verified on full sets.
   Pairs inside a component are never formed.

A group of any size is thus handled by hub comparisons, dealt over salted tasks of
at most ``PER_TASK`` texts, and no step holds a group in one task or the driver.

Rows: null or empty texts, and texts without words, have empty sets and are linked
with nothing; texts of fewer than five words are one shingle; repeated rows belong
together; null ids take part but never name a component unless it has no other id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import blocks, distinct_pairs, mix, sequence_hashes, shingles, words
from .common import CONTENT, batch_of, drop, lean, mapped, materialise, small_side, text_keys
from .graph import connected_components

REGISTERS = 640
BAND = 4
BANDS = 48
DOCS = 2048
BASE = 1.001
RATE = 20.0
SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
SLACK = 4 * (0.75 * 0.25 / REGISTERS) ** 0.5
PER_TASK = 256
BLOCK = 1024

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_DRAWS = 1 << 18


def registers(doc: np.ndarray, hashes: np.ndarray, n_docs: int, m: int = REGISTERS, base: float = BASE, rate: float = RATE) -> np.ndarray:
    """SetSketch registers (n_docs x m, uint16) of distinct (document, hash) pairs.

    A shingle's arrivals over all registers form one ascending sequence; it stops as
    soon as it has passed the document's largest register.
    """
    best = np.full(n_docs * m, np.inf)
    time, alive, drawn, step = np.zeros(len(hashes)), np.arange(len(hashes)), 0, 1
    while len(alive):
        k = max(1, min(step, _DRAWS // len(alive)))
        seeds = mix(hashes[alive][:, None] + (np.arange(drawn + 1, drawn + k + 1, dtype=np.uint64) * _GOLD))
        gaps = -np.log(((seeds >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (rate * m)
        at = time[alive][:, None] + np.cumsum(gaps, axis=1)
        slot = ((mix(seeds) >> _U(32)) * _U(m)) >> _U(32)
        np.minimum.at(best, (doc[alive][:, None] * m + slot.astype(np.int64)).ravel(), at.ravel())
        time[alive] = at[:, -1]
        drawn, step = drawn + k, min(64, step * 2)
        alive = alive[time[alive] < best.reshape(n_docs, m).max(axis=1)[doc[alive]]]
    values = np.floor(1 - np.log(best) / np.log(base))
    return np.clip(np.where(np.isfinite(values), values, 0), 0, 65535).astype(np.uint16).reshape(n_docs, m)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _score(similarity: np.ndarray, size_a, size_b, above, below, same, base: float):
    """Derivative of the joint log-likelihood in the similarity."""
    u = size_a / (size_a + size_b)
    v = 1 - u
    shrink = (base - 1) / base
    p = lambda x: -np.log1p(-x * shrink) / np.log(base)
    slope = lambda x: shrink / ((1 - x * shrink) * np.log(base))
    a, b = np.maximum(u - v * similarity, 1e-12), np.maximum(v - u * similarity, 1e-12)
    return -above * v * slope(a) / p(a) - below * u * slope(b) / p(b) + same * (v * slope(a) + u * slope(b)) / np.maximum(1 - p(a) - p(b), 1e-12)


def estimate(size_a, size_b, above, below, same, base: float = BASE) -> np.ndarray:
    """Maximum-likelihood similarity of two sets of known sizes, from the numbers of
    registers of the first that are above, below and equal to the second's."""
    size_a, size_b = np.asarray(size_a, float), np.asarray(size_b, float)
    low = np.zeros(np.broadcast(size_a, same).shape)
    high = low + np.minimum(size_a, size_b) / np.maximum(size_a, size_b)
    for _ in range(40):
        mid = (low + high) / 2
        up = _score(mid, size_a, size_b, above, below, same, base) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def plausible(size_a, size_b, above, below, same) -> np.ndarray:
    """False where sizes rule a link out or the estimate is over four standard errors short."""
    size_a, size_b = np.asarray(size_a, float), np.asarray(size_b, float)
    possible = DENOMINATOR * np.minimum(size_a, size_b) >= NUMERATOR * np.maximum(size_a, size_b)
    return possible & (_score(np.float64(NUMERATOR / DENOMINATOR - SLACK), size_a, size_b, above, below, same, BASE) >= 0)


def _sketches(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("content2", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("n", pa.int64()), ("registers", pa.binary())])
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        node, check, size, regs = [], [], [], []
        for block in blocks(batch.column(3)):
            w = words(block)
            doc, h = distinct_pairs(*shingles(w, SHINGLE))
            names, checks = (sequence_hashes(w, seed).view(np.int64).tolist() for seed in (0, 1))
            n = np.bincount(doc, minlength=block.n_docs)
            new = np.zeros(block.n_docs, bool)
            for i, name in enumerate(zip(names, checks, strict=True)):
                if name[0] and name not in seen:
                    new[i] = True
                    seen.add(name)
            if len(seen) > 1 << 20:
                seen.clear()
            keep = new[doc]
            made = _made((np.cumsum(new) - 1)[doc[keep]], h[keep], int(new.sum()))
            node += [x or None for x in names]
            check += checks
            size += n.tolist()
            regs += [next(made).tobytes() if x else None for x in new]
        yield batch_of({"doc_id": batch.column(0), "content": batch.column(1), "content2": batch.column(2), "node": node, "check": check, "n": size, "registers": regs}, schema)


def _made(doc, hashes, n_docs):
    """Register rows, made for a bounded number of documents at a time; ``doc`` ascends."""
    for at in range(0, n_docs, DOCS):
        part = slice(*np.searchsorted(doc, [at, at + DOCS]))
        yield from registers(doc[part] - at, hashes[part], min(DOCS, n_docs - at))


def buckets_of(regs: np.ndarray) -> np.ndarray:
    """Bucket per band of register rows: four 16-bit registers fill 64 bits, mixed with the band's number."""
    values = np.ascontiguousarray(regs[:, : BANDS * BAND]).view(np.uint64)
    return mix(mix(values) + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD).view(np.int64)


def _bands(batches):
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64())])
    for batch in batches:
        if batch.num_rows:
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            yield batch_of({"bucket": buckets_of(rows).ravel(), "node": np.repeat(batch.column(0).to_numpy(), BANDS)}, schema)


def _compared(a: np.ndarray, b: np.ndarray):
    """Registers of a above, below, equal to those of each row of b."""
    same = (b == a).sum(axis=1)
    above = (a > b).sum(axis=1)
    return above, REGISTERS - above - same, same


def _verify(batches):
    """Rows sorted by (hub, salt, hub first): links of members with their hub, on full sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    hub = None
    for batch in batches:
        a, b = [], []
        hubs, salts, nodes, sizes = (batch.column(i).to_pylist() for i in range(4))
        regs, at = batch.column(4).to_pylist(), 0
        for block in blocks(batch.column(5)):
            doc, h = distinct_pairs(*shingles(words(block), SHINGLE))
            cut = np.searchsorted(doc, np.arange(block.n_docs + 1))
            for i in range(block.n_docs):
                own, mine = h[cut[i] : cut[i + 1]], np.frombuffer(regs[at], np.uint16)
                if nodes[at] == hubs[at]:
                    hub = (hubs[at], salts[at], sizes[at], mine, own)
                elif hub[:2] == (hubs[at], salts[at]) and plausible(hub[2], sizes[at], *_compared(hub[3], mine[None]))[0]:
                    shared = len(np.intersect1d(hub[4], own, assume_unique=True))
                    if DENOMINATOR * shared >= NUMERATOR * (len(own) + len(hub[4]) - shared):
                        a.append(nodes[at])
                        b.append(hub[0])
                at += 1
        yield batch_of({"a": a, "b": b}, schema)


def verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (node, hub) whose full sets are similar enough: a, b.

    Members of a hub are dealt over salted groups of about ``PER_TASK``; the hub's
    text joins each group once.
    """
    load = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PER_TASK).alias("salts"))
    members = pairs.join(load, "hub").select("hub", F.pmod(F.xxhash64("node"), "salts").alias("salt"), "node")
    heads = members.select("hub", "salt").distinct().select("hub", "salt", F.col("hub").alias("node"))
    rows = members.unionByName(heads).join(texts, "node").join(sketches, "node").select("hub", "salt", "node", "n", "registers", "text")
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("hub") != F.col("node"))
    return materialise(rows, "links", lean(_verify), "a bigint, b bigint")


def _between(batches):
    """Rows sorted by (bucket, i, j): pairs of different components that the likelihood lets
    pass, each in the first bucket that it shares."""
    schema = pa.schema([("node", pa.int64()), ("hub", pa.int64())])

    def pairs(rows):
        node, comp, size, block, regs = (np.array(x) for x in zip(*((r[3], r[4], r[5], r[6], np.frombuffer(r[7], np.uint16)) for r in rows), strict=True))
        bucket, i, j = rows[0][:3]
        shared = buckets_of(np.stack(regs))
        band = int(np.flatnonzero((shared == bucket).all(axis=0))[0])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        out_a, out_b = [], []
        for at, x in enumerate(left.tolist()):
            others = right[at + 1 :] if i == j else right
            others = others[comp[others] != comp[x]]
            if len(others):
                others = others[~(shared[others, :band] == shared[x, :band]).any(axis=1)]
                passed = others[plausible(size[x], size[others], *_compared(regs[x], regs[others]))]
                out_a += np.minimum(node[passed], node[x]).tolist()
                out_b += np.maximum(node[passed], node[x]).tolist()
        return out_a, out_b

    held, key = [], None
    for batch in batches:
        a, b = [], []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != key and held:
                x, y = pairs(held)
                a, b, held = a + x, b + y, []
            key = row[:3]
            held.append(row)
        yield batch_of({"node": a, "hub": b}, schema)
    if held:
        a, b = pairs(held)
        yield batch_of({"node": a, "hub": b}, schema)


def _cross_pairs(live: DataFrame, parts: DataFrame, sketches: DataFrame) -> DataFrame:
    """Plausible pairs (node, hub) between different components of one bucket."""
    placed = live.join(parts, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x <> y").select("bucket", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    rows = placed.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    rows = rows.select("bucket", "node", "component", "block", other).select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component", "block")
    rows = rows.join(sketches, "node").select("bucket", "i", "j", "node", "component", "n", "block", "registers")
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return mapped(rows, _between, "node bigint, hub bigint").distinct()


def _twins(rows: DataFrame) -> DataFrame:
    """Node hashes that different word sequences share, with the least of their check hashes."""
    names = rows.where("node is not null").groupBy("node").agg(F.min("check").alias("first"), F.max("check").alias("other"))
    return materialise(names.where("first <> other").select("node", "first"), "twins")


def _told_apart(rows: DataFrame, twins: DataFrame) -> DataFrame:
    """Rows whose node names a word sequence by 128 bits: all but one of the sequences that share a hash get another."""
    if twins.isEmpty():
        return rows
    new = F.when(F.col("first").isNotNull() & (F.col("check") != F.col("first")), F.xxhash64("node", "check")).otherwise(F.col("node"))
    return rows.join(small_side(twins), "node", "left").withColumn("node", new).drop("first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (doc_id is the component's), and the content keys."""
    text = F.col(text_col)
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *text_keys(text), text.alias("text"))
    made = materialise(source, "sketches", lean(_sketches), "doc_id bigint, content bigint, content2 bigint, node bigint, check bigint, n bigint, registers binary")
    twins = _twins(made)
    named = _told_apart(made.where("registers is not null"), twins)
    nodes = materialise(named.groupBy("node").agg(F.max(F.struct("doc_id", *CONTENT)).alias("at"), F.max("n").alias("n"), F.max("registers").alias("registers")), "nodes")
    rows = materialise(_told_apart(made, twins).select("doc_id", "n", "node", *CONTENT), "rows")
    drop(made, twins)
    bands = mapped(nodes.select("node", "registers"), _bands, "bucket bigint, node bigint")
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    live = materialise(bands.join(shared, "bucket").select("bucket", "node", "size"), "buckets")

    company = live.groupBy("node").agg(F.sum("size").alias("company"))
    chosen = nodes.join(company.select("node"), "node", "left_semi")
    sketches = materialise(chosen.select("node", "n", "registers"), "candidate-sketches")
    wanted = materialise(chosen.select("node", F.col("at.doc_id").alias("at_id"), *[F.col(f"at.{c}").alias(c) for c in CONTENT]), "candidates")
    drop(nodes)
    near = small_side(wanted)
    texts = source.join(near, (source["content"] == near["content"]) & (source["content2"] == near["content2"]) & source["doc_id"].eqNullSafe(F.col("at_id"))).select("node", "text")
    texts = materialise(texts, "candidate-texts")
    drop(wanted)

    hubs = live.join(company, "node").groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("top")).select("bucket", F.col("top.node").alias("hub"))
    stars = live.join(hubs, "bucket").where("node <> hub").select("node", "hub").distinct()
    links = verified(stars, texts, sketches)
    parts = materialise(connected_components(links), "parts")
    cross = materialise(_cross_pairs(live, parts, sketches), "cross-pairs")
    more = verified(cross, texts, sketches)
    drop(live, sketches, texts, cross, parts)
    parts = connected_components(links.unionByName(more))
    drop(links, more)

    least = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = materialise(least.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "least"), "placed")
    # a table of its own, so that the rows of a large component can be dealt to several tasks
    first = materialise(placed.groupBy("component").agg(F.min("least").alias("component_id")), "components")
    called = materialise(placed.join(small_side(first), "component").select("node", "component_id"), "called")
    drop(placed, first)
    full = rows.where("node is not null").join(small_side(called), "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id", *CONTENT)
    bare = rows.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *CONTENT)
    return full.unionByName(bare).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *CONTENT)
