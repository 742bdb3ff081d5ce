"""The quality classifier again in plain Python: features, class prior, risk, scores."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from recordloom.llm import pu_classifier as pu
from recordloom.llm.blocks import blocks


def mix(x):
    m = (1 << 64) - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & m
    return x ^ (x >> 31)


def features(text):
    """All figures of one text, one after the other."""
    data = (text or "").encode()
    size, low = max(len(data), 1), bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    pairs = [0] * pu.PAIRS
    for a, b in zip(data, data[1:]):
        pairs[mix((a * 256 + b + 77) & ((1 << 64) - 1)) % pu.PAIRS] += 1
    shares = [math.sqrt(x / size) for x in pairs]
    classes = [sum(chr(b) in c for b in data if b < 128) / size for c in pu._CLASSES] + [sum(b >= 128 for b in data) / size]
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    n, some, times = len(w), max(len(w), 1), collections.Counter(w)
    runs = [tuple(w[i : i + 5]) for i in range(max(1, n - 4))] if w else []
    shape = [
        math.log1p(len(data)) / 12, math.log1p(n) / 10, sum(map(len, w)) / some / 20, len(times) / some, max(times.values(), default=0) / some,
        sum(a == b for a, b in zip(w, w[1:])) / some, len(set(runs)) / max(len(runs), 1), sum(len(x) <= 1 for x in w) / some, sum(len(x) > 20 for x in w) / some,
    ]
    return shares + classes + shape


def some_texts(n, seed):
    r, out = random.Random(seed), []
    for i in range(n):
        good = i % 2
        w = [r.choice(["the", "river", "Over", "stone,", "and", "was.", "x", "été"]) if good else r.choice(["$$$", "BUY", "now!!", "www", "aaaaaaaaaaaaaaaaaaaaaaaaa", "12"]) for _ in range(r.randrange(60))]
        out.append(r.choice([" ", "\n"]).join(w))
    return out


TEXTS = [None, "", " \n", "a", "A a", "é" * 9, "one two three four five one two three four five", *some_texts(40, 1)]


def test_features_by_hand():
    got = np.concatenate([pu.features(b) for b in blocks(pa.array(TEXTS), 200)])
    assert np.allclose(got, [features(t) for t in TEXTS], atol=2e-4)


def quantile(values, q):
    values, at = sorted(values), q * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


def expanded(rows, sample):
    """Rows as the linear model sees them: scaled shares, one place for the bin of each shape, a bias."""
    mean = [sum(s[k] for s in sample) / len(sample) for k in range(pu.PAIRS)]
    scale = [math.sqrt(sum((s[k] - mean[k]) ** 2 for s in sample) / len(sample)) + 1e-3 for k in range(pu.PAIRS)]
    edges = [sorted({quantile([s[k] for s in sample], i / pu.Model.BINS) for i in range(1, pu.Model.BINS)}) for k in range(pu.PAIRS, pu.WIDTH)]
    out = []
    for row in rows:
        x = [max(-6.0, min(6.0, (row[k] - mean[k]) / scale[k])) / 8 for k in range(pu.PAIRS)]
        for k, e in enumerate(edges):
            at = sum(edge <= row[pu.PAIRS + k] for edge in e)
            x += [float(i == at) for i in range(len(e) + 1)]
        out.append([*x, 1.0])
    return out


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def adam(width, gradient, steps):
    w, m, v = [0.0] * width, [0.0] * width, [0.0] * width
    for t in range(1, steps + 1):
        g = [a + 1e-3 * b for a, b in zip(gradient(w), w)]
        m = [0.9 * a + 0.1 * b for a, b in zip(m, g)]
        v = [0.999 * a + 0.001 * b * b for a, b in zip(v, g)]
        w = [x - 0.05 * (a / (1 - 0.9**t)) / (math.sqrt(b / (1 - 0.999**t)) + 1e-8) for x, a, b in zip(w, m, v)]
    return w


def mean_row(rows, weights):
    return [sum(c * r[k] for c, r in zip(weights, rows)) / len(rows) for k in range(len(rows[0]))]


def fit(positive, unlabelled, prior, steps):
    """Weights that minimise prior * R+(p) + max(0, R-(u) - prior * R-(p)), the bias moved at the end."""
    p, u = expanded(positive, unlabelled), expanded(unlabelled, unlabelled)

    def gradient(w):
        sp, su = [sigmoid(dot(x, w)) for x in p], [sigmoid(dot(x, w)) for x in u]
        rest = sum(-math.log(1 - s) for s in su) / len(u) - prior * sum(-math.log(1 - s) for s in sp) / len(p)
        step = [a - prior * b for a, b in zip(mean_row(u, su), mean_row(p, sp))]
        if rest < 0:  # the other way up
            return [-x for x in step]
        return [a - prior * b for a, b in zip(step, mean_row(p, [1 - s for s in sp]))]

    w = adam(len(p[0]), gradient, steps)
    w[-1] -= quantile([dot(x, w) for x in u], 1 - prior)
    return w, u


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_risk_by_hand(prior):
    """The same weights after some steps, also where the second part of the risk turns negative."""
    good, web = [features(t) for t in some_texts(24, 5)[1::2]], [features(t) for t in some_texts(30, 6)]
    rows = [np.array(x, np.float32) for x in (good, web)]
    model, kept = pu.fit(*rows, prior=prior, steps=12)
    exact = [r.astype(float).tolist() for r in rows]
    w, u = fit(*exact, prior, 12)
    assert kept == prior and np.allclose(model.weights, w, atol=5e-3)
    assert np.allclose(pu._sigmoid(model.margin(rows[1])), [sigmoid(dot(x, w)) for x in u], atol=5e-3)
    assert abs(np.mean([dot(x, w) >= 0 for x in u]) - prior) < 0.1


def test_prior_by_hand():
    r = random.Random(2)
    positive, unlabelled = [r.gauss(1, 1) for _ in range(300)], [r.gauss(1, 1) if r.random() < 0.4 else r.gauss(-2, 1) for _ in range(500)]
    best = 1.0
    for i in range(40):
        cut = quantile(positive, 0.02 + i * (0.8 - 0.02) / 39)
        p, u = (sum(x >= cut for x in v) / len(v) for v in (positive, unlabelled))
        best = min(best, u / p + math.sqrt(u * (1 - u) / len(unlabelled)) / p + u * math.sqrt(p * (1 - p) / len(positive)) / p**2)
    assert abs(pu.class_prior(np.array(positive), np.array(unlabelled)) - best) < 1e-9 and 0.3 < best < 0.6


def test_scores_follow_from_the_features(spark):
    """The query's scores again: rows of the samples found by hand, features by hand, the model's margin by hand."""
    import zlib

    texts = some_texts(120, 9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id bigint, quality int, toxic int")
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(120)]
    rows = [np.array(sorted((np.array(features(texts[i]), np.float32) for i in keep), key=lambda f: f.tobytes())) for keep in ([i for i in range(120) if not held[i] and i % 2], [i for i in range(120) if not held[i]])]
    model, _ = pu.fit(*rows, prior=0.5)
    want = [sigmoid(float(m)) for m in model.margin(np.array([features(t) for t in texts], np.float32))]
    got = {r.doc_id: r for r in pu.quality_scores(docs, labels, prior=0.5).collect()}
    assert [got[i].held_out for i in range(120)] == held
    assert np.allclose([got[i].score for i in range(120)], want, atol=0.1) and np.mean([got[i].predicted == i % 2 for i in range(120)]) > 0.9
