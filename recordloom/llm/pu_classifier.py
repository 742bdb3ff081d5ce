"""Quality classifier by positive-unlabelled learning.

Only trusted positives (labels with quality 1, outside the held-out fold) and
unlabelled web text are used; negative labels are never looked at.

* Features of a text: shares of hashed byte pairs, and shape figures (lengths,
  character classes, repetition), cut into bins. All are numpy vector operations
  over blocks of texts.
* The class prior is estimated: a positive-against-unlabelled model ranks two
  halves of the sample, and the least ratio of unlabelled to positive share above a
  threshold bounds the share of positives from above.
* The model minimises the non-negative unbiased risk
  prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)): where the
  second part turns negative, the step goes back up instead. The bias is then moved
  so that the share of unlabelled texts with a score of one half is the prior.

The fit uses bounded samples (``positives`` and ``unlabelled`` rows, smallest by
hash), collected as compact feature rows; every row of the input is scored.

Rows: null and empty texts are scored as texts without bytes; repeated rows and
null ids are scored row by row; without positives every score is one half.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, blocks, distinct_pairs, mix, shingles, words
from .common import batch_of, mapped, materialise

POSITIVES = 6_000
UNLABELLED = 12_000
PAIRS = 512
STEPS = 300

_PAIR = (mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(77)) % np.uint64(PAIRS)).astype(np.int64)
_CLASSES = ["#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!?", ".,;:", "\n", " \t\r\x0b\x0c", "/@_=-+~^"]
_IN_CLASS = np.zeros((len(_CLASSES) + 1, 256), np.float32)
for _k, _chars in enumerate(_CLASSES):
    _IN_CLASS[_k, [ord(c) for c in _chars]] = 1
_IN_CLASS[-1, 128:] = 1
SHAPES = len(_CLASSES) + 1 + 9
WIDTH = PAIRS + SHAPES


def features(block: Block) -> np.ndarray:
    """Feature rows (documents x WIDTH, float32) of a block."""
    n, cuts = block.n_docs, block.offsets
    size = np.diff(cuts).astype(np.float64)
    doc = np.repeat(np.arange(n), np.diff(cuts))
    data = block.data
    pair = _PAIR[data[:-1].astype(np.int64) * 256 + data[1:]] if len(data) > 1 else np.empty(0, np.int64)
    inside = doc[1:] == doc[:-1]
    pairs = np.bincount(doc[:-1][inside] * PAIRS + pair[inside], minlength=n * PAIRS).reshape(n, PAIRS)
    shares = np.sqrt(pairs / np.maximum(size, 1)[:, None])
    per_doc = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])[cuts])
    classes = [per_doc(_IN_CLASS[k][data]) / np.maximum(size, 1) for k in range(len(_IN_CLASS))]
    w = words(block)
    count = np.diff(w.first).astype(np.float64)
    some = np.maximum(count, 1)
    own = w.doc
    d, h = distinct_pairs(own, w.hashes)
    distinct = np.bincount(d, minlength=n)
    where = np.lexsort((w.hashes, own))
    new = np.ones(len(where), bool)
    new[1:] = (own[where][1:] != own[where][:-1]) | (w.hashes[where][1:] != w.hashes[where][:-1])
    times = np.diff(np.append(np.flatnonzero(new), len(where)))
    most = np.zeros(n)
    np.maximum.at(most, d, times)
    twin = (w.hashes[1:] == w.hashes[:-1]) & (own[1:] == own[:-1])
    twins = np.bincount(own[1:][twin], minlength=n)
    runs, run_hashes = shingles(w, 5)
    unique, _ = distinct_pairs(runs, run_hashes)
    all_runs, own_runs = np.bincount(runs, minlength=n), np.bincount(unique, minlength=n)
    span = np.bincount(own, weights=(w.ends - w.starts), minlength=n)
    single = np.bincount(own, weights=(w.ends - w.starts) <= 1, minlength=n)
    long = np.bincount(own, weights=(w.ends - w.starts) > 20, minlength=n)
    shape = [np.log1p(size) / 12, np.log1p(count) / 10, span / some / 20, distinct / some, most / some, twins / some, own_runs / np.maximum(all_runs, 1), single / some, long / some]
    return np.concatenate([shares, np.stack(classes + shape, axis=1)], axis=1).astype(np.float32)


class Model:
    """Linear model over byte-pair shares and binned shapes."""

    BINS = 12

    def __init__(self, sample: np.ndarray):
        shapes = sample[:, PAIRS:]
        self.edges = [np.unique(np.quantile(shapes[:, k], np.linspace(0, 1, self.BINS + 1)[1:-1])) for k in range(shapes.shape[1])]
        self.mean = sample[:, :PAIRS].mean(axis=0)
        self.scale = sample[:, :PAIRS].std(axis=0) + 1e-3
        self.weights = np.zeros(PAIRS + sum(len(e) + 1 for e in self.edges) + 1, np.float64)

    def expand(self, rows: np.ndarray) -> np.ndarray:
        parts = [np.clip((rows[:, :PAIRS] - self.mean) / self.scale, -6, 6) / 8]
        for k, e in enumerate(self.edges):
            parts.append(np.eye(len(e) + 1, dtype=np.float32)[np.searchsorted(e, rows[:, PAIRS + k], side="right")])
        parts.append(np.ones((len(rows), 1)))
        return np.concatenate(parts, axis=1).astype(np.float32)

    def margin(self, rows: np.ndarray) -> np.ndarray:
        return self.expand(rows) @ self.weights


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _adam(weights, gradient, steps, rate=0.05, decay=1e-3):
    m = v = np.zeros_like(weights)
    for t in range(1, steps + 1):
        g = gradient(weights.astype(np.float32)) + decay * weights
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        weights = weights - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return weights


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.2) -> float:
    """Share of positives among the unlabelled, from scores of rows that the ranking has not seen."""
    cuts = np.quantile(positive, np.linspace(0.02, 1 - least_share, 40))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    noise = np.sqrt(u * (1 - u) / len(unlabelled)) / p + u * np.sqrt(p * (1 - p) / len(positive)) / p**2
    return float(np.clip((u / p + noise).min(), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = STEPS) -> tuple[Model, float]:
    """Model and class prior from feature rows."""
    model = Model(unlabelled)
    p, u = model.expand(positive), model.expand(unlabelled)
    if prior is None:
        a, b = p[::2], u[::2]
        risk = lambda w: (-(1 - _sigmoid(a @ w)) @ a / len(a) + _sigmoid(b @ w) @ b / len(b)) / 2
        w = _adam(model.weights, risk, steps // 2)
        prior = class_prior(p[1::2] @ w, u[1::2] @ w)

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        negative = -np.log1p(-np.minimum(su, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-9)).mean()
        step = su @ u / len(u) - prior * (sp @ p) / len(p)
        if negative < 0:
            return -step
        return step - prior * ((1 - sp) @ p) / len(p)

    model.weights = _adam(model.weights, gradient, steps)
    # one half is where the share of positives among the unlabelled is the prior
    model.weights[-1] -= np.quantile(u @ model.weights, 1 - prior)
    return model, prior


def _feature_rows(batches):
    schema = pa.schema([("positive", pa.bool_()), ("features", pa.binary())])
    for batch in batches:
        rows = [r.tobytes() for block in blocks(batch.column(1)) for r in features(block)]
        yield batch_of({"positive": batch.column(0), "features": rows}, schema)


def _score_rows(sent):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        model = sent.value
        for batch in batches:
            scores = [_sigmoid(model.margin(features(block))) if model else np.full(block.n_docs, 0.5) for block in blocks(batch.column(2))]
            yield batch_of({"doc_id": batch.column(0), "held_out": batch.column(1), "score": np.concatenate(scores) if scores else []}, schema)

    return run


def samples(source: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of the two bounded samples; ids are drawn by hash before any text is read."""
    order = lambda c, seed: (F.xxhash64(F.lit(seed), c), c)
    open_ids = source.where("not held_out and doc_id is not null").select("doc_id").distinct()
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().join(open_ids, "doc_id", "left_semi")
    chosen = trusted.orderBy(*order("doc_id", 1)).limit(positives).withColumn("positive", F.lit(True)).unionByName(open_ids.orderBy(*order("doc_id", 2)).limit(unlabelled).withColumn("positive", F.lit(False)))
    chosen = materialise(chosen.select(F.col("doc_id").alias("chosen_id"), "positive"), "sample-ids")
    rows = source.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("positive", "text")
    rows = mapped(rows, _feature_rows, "positive boolean, features binary").toPandas()
    table = lambda part: np.frombuffer(b"".join(part), np.float32).reshape(-1, WIDTH)
    # collected order depends on the scan; sort so that the fit does not
    return tuple(table(sorted(rows.loc[rows["positive"] == kind, "features"])) for kind in (True, False))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 1, folds: int = 3, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Rows whose crc32 of the id's text has remainder ``fold`` modulo ``folds`` are held out of the fit.
    """
    held = (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds) == fold
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    yes, some = samples(source, labels, positives, unlabelled)
    model = fit(yes, some, prior)[0] if len(yes) > 1 and len(some) > 1 else None
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return mapped(source, _score_rows(sent), "doc_id bigint, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
