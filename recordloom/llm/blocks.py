"""Vectorised byte-level text primitives (numpy, no per-word Python objects).

Texts arrive as Arrow string arrays; their UTF-8 buffers are viewed, not
copied. Work proceeds in blocks of whole documents of about one megabyte, so
that temporaries stay small whatever the batch size; a longer document is a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: ASCII upper case to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of `[^\x20\x09-\x0D]+`.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_STEP = 0x5851F42D4C957F2D | 1
_STEP_INV = pow(_STEP, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 2 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums S with S[j]-S[i] = sum of byte values times step**position over [i, j)."""
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * powers(_STEP, len(data)), out=total[1:])
    return total


def prefix_of(values: np.ndarray) -> np.ndarray:
    """Like ``prefix_hash`` over 64-bit values in place of bytes."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(_STEP, len(values)), out=total[1:])
    return total


def range_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the byte ranges [start, end); equal bytes have equal hashes anywhere."""
    back = powers(_STEP_INV, len(total))
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64) * _GOLD)


@dataclass
class Block:
    """Whole documents first..first+len(offsets)-2 of a batch, in one byte array."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of an Arrow string or binary array; nulls are empty documents."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield Block(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of a block: byte ranges, 64-bit hashes, and per document the first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(block: Block, word_bytes: np.ndarray = NON_SPACE) -> Words:
    """Maximal runs of word bytes in lower-cased text; runs never cross documents."""
    data = LOWER[block.data]
    inside = word_bytes[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = block.offsets[(block.offsets > 0) & (block.offsets < len(data))]
    start[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(starts, ends, range_hash(prefix_hash(data), starts, ends), np.searchsorted(starts, block.offsets))


_SHINGLE = _U(0xD6E8FEB86659FD93)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and hash of every run of ``size`` words.

    A document of fewer words, but not none, gives its whole sequence once.
    """
    n = np.diff(w.first)
    total = len(w.hashes)
    if total >= size:
        h = np.zeros(total - size + 1, dtype=np.uint64)
        for k in range(size):
            h = h * _SHINGLE + w.hashes[k : total - size + 1 + k]
        doc = w.doc
        keep = doc[: total - size + 1] == doc[size - 1 :]
        docs, h = doc[: total - size + 1][keep], mix(h[keep])
    else:
        docs, h = np.empty(0, np.int64), np.empty(0, np.uint64)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            has = n[short] > k
            extra[has] = extra[has] * _SHINGLE + w.hashes[w.first[short[has]] + k]
        extra = mix(extra + n[short].astype(np.uint64))
        docs, h = np.concatenate([docs, short]), np.concatenate([h, extra])
    return docs, h


def distinct_pairs(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, ordered by document and hash."""
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return docs[new], hashes[new]


def batch_words(texts: pa.Array, word_bytes: np.ndarray = NON_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a whole batch, and per document its first word (one more at the end)."""
    hashes, first, total = [], [np.zeros(1, np.int64)], 0
    for block in blocks(texts):
        w = words(block, word_bytes)
        hashes.append(w.hashes)
        first.append(w.first[1:] + total)
        total += len(w.hashes)
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), np.concatenate(first)


def sequence_hashes(w: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of each document's word sequence; 0 for a document without words. Seeds give independent hashes."""
    total = prefix_of(mix(w.hashes + _U(seed)) if seed else w.hashes)
    n = np.diff(w.first)
    back = powers(_STEP_INV, len(total))
    found = mix((total[w.first[1:]] - total[w.first[:-1]]) * back[w.first[:-1]] + n.astype(np.uint64) * _GOLD)
    return np.where(n > 0, np.maximum(found, _U(1)), _U(0))
