"""Best-fit packing with certified bounds.

Documents become pieces of at most ``capacity`` tokens (only longer ones are
cut). Pieces are dealt to partitions; each runs best-fit decreasing, and
dual-feasible functions give a lower bound for its bins. Partitions that meet
their bound are proved optimal; the others give the pieces of their bins that are
not full to a common pool, and all partitions those of bins that are far from
full, which add up over partitions. The pool is dealt anew and packed again; a
round counts only if it saves bins. The same functions over the histogram of all
lengths bound the whole: rounds end where that bound is met.

Only (id, length) rows are shuffled, never ids or texts. A partition holds a
bounded number of pieces, so memory does not grow with the input.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, materialise
from .tokens import encoder, forget

PARTITION_ITEMS = 200_000
ROUNDS = 3
LOOSE = 0.9


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item. Items go, longest first, into the fullest bin that takes them.

    Bins with the same room are interchangeable, so they are kept by room in
    stacks, and the least sufficient room is found in one bit mask.
    """
    out = np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = bins = 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, at, bins = capacity, bins, bins + 1
        left = room - size
        if not rooms[left]:
            mask |= 1 << left
        rooms[left].append(at)
        out[i] = at
    return out


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Bins that any packing of the lengths (each ``counts`` times) needs, by two families of dual-feasible functions.

    ``U_e``: items over capacity-e count whole, items under e not at all.
    ``u_k``: x -> floor((k+1)x)/k, or x where (k+1)x is whole.
    Each maps sizes so that no full bin exceeds 1; the sum of images is a bound.
    """
    if not len(lengths):
        return 0
    sizes, n = np.unique(lengths, return_counts=True) if counts is None else (lengths, counts)
    best = -(-int((sizes * n).sum()) // capacity)
    total, count = np.concatenate([[0], np.cumsum(sizes * n)]), np.concatenate([[0], np.cumsum(n)])
    cuts = np.unique(np.concatenate([[0], sizes[sizes * 2 <= capacity], sizes[sizes * 2 <= capacity] + 1]))
    cuts = cuts[cuts * 2 <= capacity]
    large, small = np.searchsorted(sizes, capacity - cuts, side="right"), np.searchsorted(sizes, cuts, side="left")
    inner = total[large] - total[np.minimum(small, large)]
    best = max(best, int((count[-1] - count[large] - (-inner // capacity)).max()))
    for k in range(1, 33):
        scaled = sizes * (k + 1)
        whole = scaled % capacity == 0
        # images times k * capacity, in whole numbers
        images = np.where(whole, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((images * n).sum()) // (k * capacity)))
    return best


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", release: bool = False) -> DataFrame:
    """Token pieces of documents: doc_id, piece, start, length, ids_crc32, item (a number of their own). Null texts hold only the end id.

    With ``release`` each task drops the worker's cache of pre-tokens when it ends: the worker
    stays, and what comes next may run no Python that would.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("item", pa.int64())])

    def run(batches):
        enc, item = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = {c: [] for c in schema.names}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(enc.ids(text.as_py()).astype("<u4"), np.uint32(end_id))
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    for c, v in zip(schema.names, (doc_id, k, at, len(part), zlib.crc32(part.tobytes()), item), strict=True):
                        rows[c].append(v)
                    item += 1
            yield batch_of(rows, schema)
        if release:
            forget()

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return materialise(source, "pieces", run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, item bigint")


_PACKED = "item bigint, length bigint, grp bigint, bin bigint, offset bigint, fill bigint, bins bigint, bound bigint"


def _pack_group(capacity):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
        sizes = pdf["length"].to_numpy()
        pdf["bin"] = best_fit_decreasing(sizes, capacity)
        pdf["offset"] = pdf.groupby("bin")["length"].cumsum() - pdf["length"]
        pdf["fill"] = pdf.groupby("bin")["length"].transform("sum")
        pdf["bins"], pdf["bound"] = int(pdf["bin"].max()) + 1, lower_bound(sizes, capacity)
        return pdf[["item", "length", "grp", "bin", "offset", "fill", "bins", "bound"]]

    return run


def _round(items: DataFrame, number: int, capacity: int, per_group: int) -> DataFrame:
    """Deal items to groups, pack each group."""
    groups = max(1, -(-items.count() // per_group))
    dealt = items.select("item", "length", (F.lit(number << 40) + F.pmod(F.xxhash64(F.col("item"), F.lit(number)), F.lit(groups))).cast("bigint").alias("grp"))
    return materialise(dealt.groupBy("grp").applyInPandas(_pack_group(capacity), _PACKED), "packed")


def _bins(packed: DataFrame) -> int:
    return packed.select("grp", "bins").distinct().agg(F.sum("bins").alias("b")).first()["b"] or 0


def whole_bound(items: DataFrame, capacity: int) -> int:
    """Lower bound for all items, from the histogram of lengths (at most ``capacity`` rows)."""
    seen = sorted(items.groupBy("length").count().collect())
    return lower_bound(np.array([r[0] for r in seen], np.int64), capacity, np.array([r[1] for r in seen], np.int64))


def pack(items: DataFrame, capacity: int, per_group: int = PARTITION_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """Pack rows (item, length), length at most capacity: item, sequence_id, offset, certified.

    ``certified`` marks sequences of partitions that meet their lower bound.
    """
    alone = items.where(F.col("length") == capacity).select("item", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), F.lit(True).alias("certified"))
    shorter = items.where(F.col("length") < capacity)
    packed, least = _round(shorter, 0, capacity, per_group), whole_bound(shorter, capacity)
    settled, bins = [], _bins(packed)
    for number in range(1, rounds + 1):
        if bins <= least:
            break
        loose = ((F.col("bins") > F.col("bound")) & (F.col("fill") < capacity)) | (F.col("fill") <= LOOSE * capacity)
        pool = packed.where(loose)
        before = pool.select("grp", "bin").distinct().count()
        again = _round(pool, number, capacity, per_group)
        saved = before - _bins(again)
        if saved <= 0:
            break
        settled.append(packed.where(~loose))
        packed, bins = again, bins - saved
    for part in settled:
        packed = packed.unionByName(part)
    # a group has fewer bins than items, so 20 bits hold a bin's number
    return packed.select("item", (F.col("grp") * (1 << 20) + F.col("bin")).alias("sequence_id"), "offset", (F.col("bins") == F.col("bound")).alias("certified")).unionByName(alone)


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, release: bool = False, **kw) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Repeated rows are packed row by row; null ids stay null; an empty table gives no rows.
    """
    cut = pieces(docs, tokenizer, end_id, capacity, release=release)
    placed = pack(cut.select("item", "length"), capacity, **kw)
    return cut.join(placed, "item").drop("item")
