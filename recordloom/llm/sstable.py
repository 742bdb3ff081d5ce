"""Sorted-string-table shards of token ids, keyed by document identifier.

File layout, all integers little-endian unless noted::

    block*      zstd frames; see below
    index       zstd frame: per block  key, offset u64, size u32, entries u32
    bloom       bit array, ``BLOOM_HASHES`` probes a key
    footer      fixed 64 bytes: index offset/size, bloom offset/size, entries,
                ids, bytes per id, magic

An uncompressed block is a run of entries ``shared, rest, size (varints),
key suffix, value``: the key shares its first ``shared`` bytes with the entry
before it, the first entry of a block shares none. Keys are the identifier as
eight big-endian bytes with the sign bit flipped, so that byte order is number
order; the null identifier is the empty key, the smallest. The sparse index
holds each block's last key: a lookup asks the Bloom filter, bisects the index
and reads one block.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import AtomicFile, batch_of, make_dir, materialise, scratch
from .tokens import encoder

MAGIC = b"RLSSTAB1"
FOOTER = struct.Struct("<QQQQQQQ8s")
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 32 << 20
BLOOM_BITS = 10
BLOOM_HASHES = 7


def key_of(doc_id: int | None) -> bytes:
    """Order-preserving key of an identifier."""
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return None if not key else struct.unpack(">Q", key)[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * b) % bits for i in range(BLOOM_HASHES)]


class ShardWriter:
    """Writes one shard; keys must come in ascending order (equal keys may repeat)."""

    def __init__(self, path: str, id_bytes: int):
        self.file, self.id_bytes = AtomicFile(path), id_bytes
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.block, self.in_block, self.last = bytearray(), 0, b""
        self.index, self.keys, self.ids = [], [], 0

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.in_block:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.in_block += 1
        self.last = key
        self.keys.append(key)
        self.ids += len(value) // self.id_bytes
        if len(self.block) >= BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        if self.in_block:
            data = self.zstd.compress(bytes(self.block))
            self.index.append((self.last, self.file.offset, len(data), self.in_block))
            self.file.write(data)
            self.block, self.in_block = bytearray(), 0

    @property
    def size(self) -> int:
        return self.file.offset + len(self.block)

    def close(self) -> None:
        self._end_block()
        index = self.zstd.compress(b"".join(_varint(len(k)) + k + struct.pack("<QII", *rest) for k, *rest in self.index))
        bits = max(64, len(self.keys) * BLOOM_BITS)
        bloom = np.zeros((bits + 7) // 8, np.uint8)
        for key in set(self.keys):
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        at = self.file.offset
        self.file.write(index)
        self.file.write(bloom.tobytes())
        self.file.write(FOOTER.pack(at, len(index), at + len(index), bits, len(self.keys), self.ids, self.id_bytes, MAGIC))
        self.file.publish()


class Shard:
    """Reads a shard from its bytes."""

    def __init__(self, data: bytes):
        self.data = data
        at, size, self.bloom_at, self.bits, self.entries, self.n_ids, id_bytes, magic = FOOTER.unpack(data[-FOOTER.size :])
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.dtype = np.dtype(f"<u{id_bytes}")
        self.zstd = zstandard.ZstdDecompressor()
        raw, self.index, i = self.zstd.decompress(data[at : at + size]), [], 0
        while i < len(raw):
            n, i = _read_varint(raw, i)
            self.index.append((raw[i : i + n], *struct.unpack_from("<QII", raw, i + n)))
            i += n + 16
        self.last_keys = [x[0] for x in self.index]

    def _block(self, number: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, at, size, entries = self.index[number]
        raw, i, key = self.zstd.decompress(self.data[at : at + size]), 0, b""
        for _ in range(entries):
            shared, i = _read_varint(raw, i)
            rest, i = _read_varint(raw, i)
            length, i = _read_varint(raw, i)
            key = key[:shared] + raw[i : i + rest]
            i += rest
            yield key, np.frombuffer(raw, self.dtype, length // self.dtype.itemsize, i)
            i += length

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All entries in key order."""
        for number in range(len(self.index)):
            for key, ids in self._block(number):
                yield id_of(key), ids

    def may_hold(self, doc_id: int | None) -> bool:
        return all(self.data[self.bloom_at + (p >> 3)] >> (p & 7) & 1 for p in _probes(key_of(doc_id), self.bits))

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """Ids of the first document of that identifier."""
        if not self.may_hold(doc_id):
            return None
        key = key_of(doc_id)
        number = bisect_left(self.last_keys, key)
        if number == len(self.index):
            return None
        return next((ids for k, ids in self._block(number) if k == key), None)


_MANIFEST = "shard string, n_docs bigint, n_ids bigint, n_bytes bigint"


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode documents and write them as shards in ascending order of identifier.

    One range shuffle of the texts orders them across tasks; each task sorts its
    range, encodes it and writes shards of bounded size, so neither a task nor the
    driver ever holds more than one shard. Returns a manifest row per shard.
    Null texts are empty; null identifiers come first; equal identifiers follow
    each other in order of a hash of the text.
    """
    make_dir(folder)
    schema = pa.schema([("shard", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches):
        enc, out, number = encoder(tokenizer), None, 0
        tail = b"" if end_id is None else np.asarray([end_id], enc.dtype).tobytes()
        done = {c: [] for c in schema.names}

        def close():
            done["shard"].append(name)
            out.close()
            for c, v in (("n_docs", len(out.keys)), ("n_ids", out.ids), ("n_bytes", out.file.offset)):
                done[c].append(v)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():07d}-{number:05d}.sst"
                    out, number = ShardWriter(f"{folder}/{name}", enc.dtype.itemsize), number + 1
                out.add(key_of(doc_id.as_py()), enc.ids(text.as_py()).tobytes() + tail)
                if out.size >= shard_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield batch_of(done, schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"), F.monotonically_increasing_id().alias("row"))
    # rows of one id, even equal ones, may be dealt to several tasks
    ordered = rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row").select("doc_id", "text")
    return materialise(ordered, "shard-manifest", run, _MANIFEST)


def read_shards(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document of the shards: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: a running sum over the
    manifest (one row per shard) plus the place inside the shard.
    """
    schema = pa.schema([("shard", pa.string()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = {c: [] for c in schema.names}
                place, name = 0, path.as_py().rpartition("/")[2]
                for doc_id, ids in Shard(content.as_py()).scan():
                    for c, v in zip(schema.names, (name, doc_id, place, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                        rows[c].append(v)
                    place += len(ids)
                yield batch_of(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.sst").load(folder).select("path", "content")
    parsed = files.mapInArrow(run, "shard string, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return parsed.join(bases, "shard").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, **kw) -> DataFrame:
    """Write the shards, read them back, one row per document."""
    folder = folder or scratch(docs.sparkSession, "shards")
    manifest = write_shards(docs, tokenizer, folder, end_id, **kw)
    return read_shards(docs.sparkSession, folder, manifest)
