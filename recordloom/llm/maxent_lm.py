"""Language-model scoring by a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) P(slot | class, history) P(word | slot).
Both softmaxes have hashed features: a bias, the previous word, the words two and
three back (skips), and the pair of the two previous words. All training words are
dealt to the classes and to slots inside them: each of the most frequent words has a
slot of its own; the others, in a class by their ending, are spread by hash over
the class's other slots, inside which add-one counts of the whole training corpus give
the word, with one outcome for unseen words. The probabilities of all words and these
outcomes sum to one. In histories, every word that training has seen ``CONTEXT_COUNT``
times (and is among the ``hot_limit`` words that travel) is told apart, the others by ending.

1. Counts of all training tokens: partial counts per task, one shuffle.
2. Training starts from bias rows alone, the shares of classes and slots; all other weights are 0.
3. Distributed gradient updates: counts of (feature row, outcome) observed over all training
   positions against counts that the model expects, each weight moved by the logarithm of their
   ratio. What the start expects follows in closed form. The later rounds share out the training
   documents by a hash of the text, so that they are one epoch: every training position gives one
   expected outcome at the round's tables, drawn by a hash of the position and weighted so that it is
   an unbiased sample of the gradient's expected part (importance sampling of the softmax). All
   counts are whole numbers and add up over tasks, so that the result depends neither on
   partitions nor on cores. Tables have a fixed size.
4. Scoring in sparse numpy batches. Counts of the most frequent words travel to the
   tasks (at most ``hot_limit``); the rest, rare and so without hot keys, is joined
   by word, and only needs the sum of log10(count + 1) per document.

Rows: null and empty texts consist of the end token alone; repeated rows are scored
row by row and each counts in training; a null id counts as the empty text for the
held-out rule; an empty table gives no rows; texts of any length are taken whole, in
blocks; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import LOWER, Block, blocks, mix, words
from .common import batch_of, frequency_bucket, frequent_from, lean, mapped, materialise

CLASSES = SLOTS = 64
SINGLE = 32
CONTEXT_COUNT = 16
CLASS_ROWS = 1 << 15
SLOT_ROWS = 1 << 16
FEATURES = 5
ROUNDS = 3
CHUNK = 16384
BATCH = 2048
HELD = 1 << 23
RATE = 0.4
PRIOR = 20
SHRINK, TRUST = 30.0, 0.4
HOT_LIMIT = 1 << 18
ROW_BLOCK = 1 << 10
SLOT_SHIFT = 40
PROPOSALS = 1 << 12
UNIT = 16
FAN_IN = 64
PLACE_BITS = 21

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
END = _U(0xE0D0E0D0E0D0E0D1)


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end token per document, the class by ending, and documents' first tokens."""
    w = words(block)
    data = LOWER[block.data]
    last = data[w.ends - 1].astype(np.int64)
    before = np.where(w.ends - w.starts > 1, data[np.maximum(w.ends - 2, 0)], 0).astype(np.int64)
    ending = (before * 31 + last * 7) % CLASSES
    at = w.first[1:]
    first = w.first + np.arange(len(w.first))
    return np.insert(w.hashes, at, END), np.insert(ending, at, 0), first


def rest_slot(hashes: np.ndarray) -> np.ndarray:
    """Slot, among those that are shared, of words without one of their own."""
    return SINGLE + ((hashes >> _U(SLOT_SHIFT)) % _U(SLOTS - SINGLE)).astype(np.int64)


class Lexicon:
    """Counts, contexts, classes and slots of the most frequent words, and what the slots hold in all."""

    def __init__(self, hashes, counts, endings, total: int, distinct: int, cells: dict[tuple[int, int], tuple[int, int]]):
        """``cells``: tokens and distinct words of all training words by (ending, shared slot)."""
        order = np.argsort(hashes)
        self.hashes, self.counts, endings = hashes[order], counts[order], endings[order].astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[np.lexsort((self.hashes, -self.counts, (self.hashes != END) * 1))] = np.arange(len(order))
        self.context = np.where(self.counts >= CONTEXT_COUNT, CLASSES + np.arange(len(order)), endings)
        own = rank < CLASSES * SINGLE
        self.cls = np.where(own, rank // SINGLE, endings)
        self.slot = np.where(own, rank % SINGLE, rest_slot(self.hashes))
        self.total, self.distinct = total, distinct
        # tokens and words that share slots
        tokens_left, words_left = np.zeros((CLASSES, SLOTS)), np.zeros((CLASSES, SLOTS))
        for cell, (n, v) in cells.items():
            tokens_left[cell], words_left[cell] = n, v
        np.subtract.at(tokens_left, (endings[own], rest_slot(self.hashes[own])), self.counts[own])
        np.subtract.at(words_left, (endings[own], rest_slot(self.hashes[own])), 1)
        self.rest_log = np.log10(np.maximum(tokens_left + words_left, 0) + 1)
        self.mass = tokens_left
        np.add.at(self.mass, (self.cls[own], self.slot[own]), self.counts[own])
        # places by the leading bits of a hash: most words are found in one step, the others by bisection
        self.shift = _U(64 - PLACE_BITS)
        self.places = np.zeros(1 << PLACE_BITS, np.int32)
        self.places[(self.hashes >> self.shift).astype(np.int64)] = np.arange(len(order))

    def look_up(self, hashes, ending):
        """Per token: place in the lexicon or -1, context, class, slot."""
        if not len(self.hashes):
            return np.full(len(hashes), -1), ending, ending, rest_slot(hashes)
        at = self.places.take((hashes >> self.shift).astype(np.int64))
        hit = self.hashes.take(at) == hashes
        other = np.flatnonzero(~hit)
        at[other] = np.minimum(np.searchsorted(self.hashes, hashes[other]), len(self.hashes) - 1)
        hit[other] = self.hashes[at[other]] == hashes[other]
        return np.where(hit, at, -1), np.where(hit, self.context.take(at), ending), np.where(hit, self.cls.take(at), ending), np.where(hit, self.slot.take(at), rest_slot(hashes))


def features(context: np.ndarray, start: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Feature hashes (places x FEATURES) of the history of the tokens at ``place``.

    ``start`` holds, per place, where its document starts; nothing crosses that.
    """
    n, back = len(place), []
    for k in (1, 2, 3):
        inside = place - k >= start
        back.append(np.where(inside, context[np.maximum(place - k, 0)], -1).astype(np.uint64))
    kinds = [np.zeros(n, _U), back[0], back[1], back[2], (back[0] << _U(24)) ^ back[1]]
    return np.stack([mix(k * _GOLD + _U(i + 1)) for i, k in enumerate(kinds)], axis=1)


def rows_of(feature: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the class features, and of the slot features given the class."""
    slot = mix(feature + (cls.astype(np.uint64)[:, None] + _U(1)) * _GOLD)
    return (feature % _U(CLASS_ROWS)).astype(np.int64), (slot % _U(SLOT_ROWS)).astype(np.int64) + CLASS_ROWS


class Softmax:
    """Softmaxes over the outcomes of a table's rows, a batch at a time in the same memory."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.z, self.part = np.empty((BATCH, SLOTS), np.float32), np.empty((BATCH, SLOTS), np.float32)

    def weights(self, rows: np.ndarray) -> np.ndarray:
        """Exponentials of the sums of the features' rows (places x FEATURES). Weights are logarithms of
        ratios of counts, so that their sums are far from what float32 cannot hold."""
        z, part = self.z[: len(rows)], self.part[: len(rows)]
        np.take(self.table, rows[:, 0], axis=0, out=z, mode="clip")
        for k in range(1, rows.shape[1]):
            np.take(self.table, rows[:, k], axis=0, out=part, mode="clip")
            np.add(z, part, out=z)
        return np.exp(z, out=z)

    def log_probability(self, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithm of the softmax at ``target``."""
        out = np.empty(len(rows))
        for at in range(0, len(rows), BATCH):
            z = self.weights(rows[at : at + BATCH])
            chosen = z.ravel().take(np.arange(len(z)) * SLOTS + target[at : at + BATCH])
            out[at : at + BATCH] = np.log(chosen.astype(np.float64) / (z @ np.ones(SLOTS, np.float32)))
        return out

    def sampled(self, rows: np.ndarray, target: np.ndarray, kind: np.ndarray, ask: Proposals, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One outcome of each softmax, and its weight in ``UNIT``ths, so that weights are on average the softmax's shares.

        Half of the outcomes are ``target``, half come from the proposals of ``kind``; the weight
        is the softmax's share over that mixture's, rounded at random by ``chance``.
        """
        proposal = ask.outcomes.take(kind * PROPOSALS + ((chance >> _U(8)) % _U(PROPOSALS)).astype(np.int64))
        outcome = np.where(chance & _U(1), target, proposal)
        mixed = (outcome == target) * 0.5 + ask.shares.take(kind * SLOTS + outcome)
        weight = np.exp(self.log_probability(rows, outcome)) / mixed
        return outcome, np.floor(weight * UNIT + (chance >> _U(40)).astype(np.float64) * 2.0**-24)


class Proposals:
    """Outcomes by the share that they have in training, at least one in ``PROPOSALS``: kind 0 for classes, kind 1 + class for its slots.

    ``shares`` are halved, as half of the outcomes come from here.
    """

    def __init__(self, mass: np.ndarray):
        shares = [mass.sum(axis=1), *mass]
        self.outcomes, self.shares = np.empty((CLASSES + 1, PROPOSALS), np.int64), np.empty((CLASSES + 1, SLOTS))
        for k, m in enumerate(shares):
            sure = PROPOSALS - SLOTS
            cut = np.round(np.cumsum(m + 1e-9) / (m + 1e-9).sum() * sure).astype(np.int64)
            times = np.diff(np.concatenate([[0], cut])) + 1
            self.outcomes[k], self.shares[k] = np.repeat(np.arange(SLOTS), times), times / PROPOSALS / 2


def bias_rows() -> tuple[int, np.ndarray]:
    """The row of the class bias, and of the slot bias of each class."""
    none = np.zeros(1, np.int64)
    bias = features(none, none, none)[:, :1]
    by_class, by_slot = rows_of(np.repeat(bias, CLASSES, axis=0), np.arange(CLASSES))
    return int(by_class[0, 0]), by_slot[:, 0]


def bias_tables(mass: np.ndarray) -> np.ndarray:
    """Where training starts: bias rows give the shares of classes and slots, all other weights are 0."""
    share = mass + 0.5
    table = np.zeros((CLASS_ROWS + SLOT_ROWS, SLOTS), np.float32)
    by_class, by_slot = bias_rows()
    table[by_class] = np.log(share.sum(axis=1) / share.sum())
    table[by_slot] = np.log(share / share.sum(axis=1, keepdims=True))
    return table


def bias_expected(mass: np.ndarray, observed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts that the start expects of every row's positions, in closed form, and the shares they follow from.

    A slot row is shared by features of many classes, so that its expectation takes the slots' shares over all of them.
    """
    share = np.empty(observed.shape)
    by_class, by_slot = mass.sum(axis=1) + SLOTS * 0.5, observed[CLASS_ROWS:].sum(axis=0) + 0.5
    share[:CLASS_ROWS], share[CLASS_ROWS:] = by_class / by_class.sum(), by_slot / by_slot.sum()
    return observed.sum(axis=1, keepdims=True) * share, share


def updated(tables: np.ndarray, observed: np.ndarray, expected: np.ndarray, prior, rate: float) -> np.ndarray:
    """One gradient step: the log-likelihood's gradient is observed - expected; each weight moves by the
    logarithm of their ratio, which is that difference over a step size of its own, smoothed by ``prior``."""
    return (tables + rate * np.log((observed + prior) / (expected + prior))).astype(np.float32)


def _counts(batches):
    schema = pa.schema([("word", pa.int64()), ("ending", pa.int32()), ("n", pa.int64())])
    for batch in batches:
        hashes, endings = [], []
        for block in blocks(batch.column(0)):
            h, e, _ = tokens(block)
            hashes.append(h)
            endings.append(e)
        if hashes:
            word, at, n = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
            yield batch_of({"word": word.view(np.int64), "ending": np.concatenate(endings)[at], "n": n}, schema)


_BLOCKS = "salt bigint, block int, cells binary"
_BLOCK_SCHEMA = pa.schema([("salt", pa.int64()), ("block", pa.int32()), ("cells", pa.binary())])


def _packed(cells: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(cells, "<i8" if cells.dtype == np.int64 else "<i4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, "<i8" if len(raw) == 8 * ROW_BLOCK * SLOTS else "<i4")


class Tally:
    """Counts of (row, outcome), added up from many positions at a time."""

    def __init__(self):
        self.counts, self.held, self.size = np.zeros((CLASS_ROWS + SLOT_ROWS) * SLOTS, np.int64), [], 0
        self.weights: list = []

    def add(self, rows: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None) -> None:
        self.held.append((rows * SLOTS + target[:, None]).astype(np.int32).ravel())
        if weight is not None:
            self.weights.append(np.repeat(weight, rows.shape[1]))
        self.size += rows.size
        if self.size >= HELD:
            self.total()

    def total(self) -> np.ndarray:
        if self.held:
            found = np.bincount(np.concatenate(self.held), np.concatenate(self.weights) if self.weights else None, minlength=len(self.counts))
            np.add(self.counts, found, out=self.counts, casting="unsafe")
            self.held, self.weights, self.size = [], [], 0
        return self.counts


def _gathered(lexicon, tables):
    """Counts of (row, outcome) over a task's positions, in blocks of rows: observed ones, or with tables sampled ones that the model expects."""

    def run(batches):
        lex, model, tally = lexicon.value, Softmax(tables.value) if tables else None, Tally()
        ask = Proposals(lex.mass) if tables else None
        for batch in batches:
            for block in blocks(batch.column(0)):
                h, ending, first = tokens(block)
                _, context, cls, slot = lex.look_up(h, ending)
                start = np.repeat(first[:-1], np.diff(first))
                for at in range(0, len(h), CHUNK):
                    place = np.arange(at, min(at + CHUNK, len(h)))
                    feature = features(context, start[place], place)
                    by_class, by_slot = rows_of(feature, cls[place])
                    one, two, w1, w2 = cls[place], slot[place], None, None
                    if model is not None:
                        chance = mix(feature[:, 4] + h[place] + (place - start[place]).astype(np.uint64) * _GOLD)
                        two, w2 = model.sampled(by_slot, two, one + 1, ask, mix(chance))
                        one, w1 = model.sampled(by_class, one, np.zeros(len(one), np.int64), ask, chance)
                    tally.add(by_class, one, w1)
                    tally.add(by_slot, two, w2)
        salt, counts = TaskContext.get().partitionId() // FAN_IN, tally.total()
        for k, at in enumerate(range(0, len(counts), ROW_BLOCK * SLOTS)):
            cells = counts[at : at + ROW_BLOCK * SLOTS]
            if cells.any():
                narrow = cells if cells.max() >> 31 else cells.astype(np.int32)
                yield batch_of({"salt": [salt], "block": [k], "cells": [_packed(narrow)]}, _BLOCK_SCHEMA)

    return run


def _added(batches):
    """Rows sorted by salt and block: one row with the sum for each."""
    key, total = None, None
    for batch in batches:
        for salt, block, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (salt, block) != key:
                if key is not None:
                    yield batch_of({"salt": [0], "block": [key[1]], "cells": [_packed(total)]}, _BLOCK_SCHEMA)
                key, total = (salt, block), np.zeros(ROW_BLOCK * SLOTS, np.int64)
            total += _unpacked(cells)
    if key is not None:
        yield batch_of({"salt": [0], "block": [key[1]], "cells": [_packed(total)]}, _BLOCK_SCHEMA)


def gather(texts: DataFrame, lexicon, tables=None) -> np.ndarray:
    """Counts of (row, outcome) over all positions of ``texts``; sums of fixed size reach the driver.

    They are added in two steps, so that no task adds the blocks of more than ``FAN_IN`` tasks, or their sums.
    """
    rows = mapped(texts, _gathered(lexicon, tables), _BLOCKS)
    for _ in range(2):
        rows = mapped(rows.repartition("salt", "block").sortWithinPartitions("salt", "block"), _added, _BLOCKS)
    counts = np.zeros((CLASS_ROWS + SLOT_ROWS, SLOTS), np.float32)
    for row in rows.collect():
        at = row["block"] * ROW_BLOCK
        counts[at : at + ROW_BLOCK] = _unpacked(bytes(row["cells"])).reshape(ROW_BLOCK, SLOTS)
    return counts


def train(training: DataFrame, lexicon, rounds: int = ROUNDS) -> np.ndarray:
    """Tables after ``rounds`` of gradient updates from bias rows alone.

    What the start expects is known in closed form, so the first round needs no sampling; the
    others share out the training documents, one epoch in all.
    """
    context = training.sparkSession.sparkContext
    tables, bias = bias_tables(lexicon.value.mass), bias_rows()
    if not rounds:
        return tables
    observed = gather(training, lexicon)
    expected, share = bias_expected(lexicon.value.mass, observed)
    start, held = tables, np.concatenate([[bias[0]], bias[1]])
    tables = updated(tables, observed, expected, SHRINK * share, TRUST)
    tables[held] = start[held]  # bias rows are at their optimum
    for number in range(rounds - 1):
        sent = context.broadcast(tables)
        expected = gather(training.where(F.pmod(F.xxhash64("text"), F.lit(rounds - 1)) == number), lexicon, sent) / UNIT
        sent.unpersist()
        part = expected[bias[0]].sum() / max(observed[bias[0]].sum(), 1)
        tables = updated(tables, observed * part, expected, PRIOR, RATE) if part else tables
    return tables


def _scores(lexicon, tables):
    schema = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()), ("rare", pa.list_(pa.int64())), ("rare_n", pa.list_(pa.int32()))])

    def run(batches):
        lex, softmax = lexicon.value, Softmax(tables.value)
        for batch in batches:
            n_tokens, known, base, model, rare, rare_n = [], [], [], [], [], []
            for block in blocks(batch.column(3)):
                h, ending, first = tokens(block)
                at, context, cls, slot = lex.look_up(h, ending)
                start, place, logs = np.repeat(first[:-1], np.diff(first)), np.arange(len(h)), np.empty(len(h))
                for a in range(0, len(h), CHUNK):
                    part = slice(a, a + CHUNK)
                    by_class, by_slot = rows_of(features(context, start[part], place[part]), cls[part])
                    logs[part] = (softmax.log_probability(by_class, cls[part]) + softmax.log_probability(by_slot, slot[part])) / np.log(10)
                hit = at >= 0
                count_log = np.where(hit, np.log10(lex.counts[np.maximum(at, 0)] + 1.0), 0) if len(lex.counts) else np.zeros(len(h))
                logs += np.where(slot >= SINGLE, count_log - lex.rest_log[cls, slot], 0)
                sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: B023, E731
                n_tokens += np.diff(first).tolist()
                known += sums(hit.astype(np.int64)).tolist()
                base += sums(count_log).tolist()
                model += sums(logs).tolist()
                doc = np.repeat(np.arange(block.n_docs), np.diff(first))[~hit]
                order = np.lexsort((h[~hit], doc))
                doc, left = doc[order], h[~hit][order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (left[1:] != left[:-1])
                starts = np.flatnonzero(new)
                times = np.diff(np.append(starts, len(doc)))
                cut = np.searchsorted(doc[starts], np.arange(block.n_docs + 1))
                left = left[starts].view(np.int64)
                rare += [left[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
                rare_n += [times[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            yield batch_of({"row_id": batch.column(0), "doc_id": batch.column(1), "held_out": batch.column(2), "n_tokens": n_tokens, "known": known, "base": base, "model": model, "rare": rare, "rare_n": rare_n}, schema)

    return run


def vocabulary(training: DataFrame, hot_limit: int = HOT_LIMIT) -> tuple[DataFrame, object, int]:
    """Counts of all training tokens (word, ending, n), the broadcast lexicon, and the frequency bucket from which words are in it.

    Reaches the driver: at most ``hot_limit`` words, and the sums of CLASSES * (SLOTS - SINGLE) cells.
    """
    counts = materialise(mapped(training, _counts, "word bigint, ending int, n bigint").groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n")), "word-counts")
    shared = (SINGLE + F.shiftrightunsigned("word", SLOT_SHIFT) % (SLOTS - SINGLE)).alias("slot")
    cells = {(r["ending"], r["slot"]): (r["n"], r["v"]) for r in counts.groupBy("ending", shared).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    least = frequent_from(counts, "n", hot_limit)
    hot = counts.where((frequency_bucket(F.col("n")) >= least) | (F.col("word") == int(END.astype(np.int64)))).toPandas()
    lexicon = Lexicon(hot["word"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64), hot["ending"].to_numpy(np.int64), sum(n for n, _ in cells.values()), sum(v for _, v in cells.values()), cells)
    return counts, training.sparkSession.sparkContext.broadcast(lexicon), least


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 2, folds: int = 7, hot_limit: int = HOT_LIMIT, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32 of the id's text has remainder ``fold`` modulo ``folds`` are held out of all learning.
    """
    spark = docs.sparkSession
    held = (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds) == fold
    source = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("bigint").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    training = source.where(~F.col("held_out")).select("text")
    counts, lexicon, least = vocabulary(training, hot_limit)
    tables = spark.sparkContext.broadcast(train(training, lexicon, rounds))
    total, distinct = lexicon.value.total, lexicon.value.distinct
    rows = materialise(source, "lm-rows", lean(_scores(lexicon, tables)), "row_id bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, model double, rare array<bigint>, rare_n array<int>")
    rare = rows.where(F.size("rare") > 0).select("row_id", F.explode(F.arrays_zip("rare", "rare_n")).alias("e")).select("row_id", F.col("e.rare").alias("word"), F.col("e.rare_n").alias("k"))
    found = rare.join(counts.where(frequency_bucket(F.col("n")) < least).select("word", "n"), "word").groupBy("row_id").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("logs"), F.sum(F.col("k").cast("bigint")).alias("more"))
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return (
        rows.drop("rare", "rare_n")
        .join(found, "row_id", "left")
        .select("doc_id", "held_out", "n_tokens", (F.col("known") + more).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + logs - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"), (F.col("model") + logs).alias("score"))
    )
