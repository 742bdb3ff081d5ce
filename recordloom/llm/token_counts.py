"""Token counts: every distinct pre-token is tokenised once, documents only sum.

1. Each task counts the pre-tokens of its documents; a shuffle sums them.
2. The tokenizer runs once over each distinct pre-token and keeps the number of
   pieces, never the ids.
3. The most frequent pre-tokens (at most ``hot_limit`` of them) travel to the
   tasks; a document's frequencies times their piece counts sum up locally.
4. The rest, rare by construction and so without hot keys, is joined by
   pre-token and summed per row.

Row semantics: null and empty texts have zero bytes and tokens; repeated rows
and null ids are counted row by row; other columns of the input are not read.
Texts that hold a special token's string are encoded whole by the library.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, frequency_bucket, frequent_from, materialise
from .tokens import encoder

HOT_LIMIT = 1 << 18
_FLUSH = 1 << 18


def _frequencies(path):
    schema = pa.schema([("piece", pa.binary()), ("n", pa.int64())])

    def run(batches):
        enc, seen = encoder(path), Counter()
        for batch in batches:
            for text in batch.column(0):
                pieces = enc.pieces(text.as_py() or "")
                if pieces:
                    seen.update(pieces)
                if len(seen) > _FLUSH:
                    yield batch_of({"piece": list(seen), "n": list(seen.values())}, schema)
                    seen.clear()
        yield batch_of({"piece": list(seen), "n": list(seen.values())}, schema)

    return run


def _piece_counts(path):
    schema = pa.schema([("piece", pa.binary()), ("n", pa.int64()), ("tokens", pa.int32())])

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            tokens = [len(ids) // enc.dtype.itemsize for ids in enc.encode_pieces(batch.column(0).to_pylist())]
            yield batch_of({"piece": batch.column(0), "n": batch.column(1), "tokens": tokens}, schema)

    return run


def _local_sums(path, hot):
    schema = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_hot", pa.int64()), ("tail", pa.list_(pa.binary())), ("tail_n", pa.list_(pa.int32()))])

    def run(batches):
        enc, known = encoder(path), hot.value
        for batch in batches:
            size, near, tail, tail_n = [], [], [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                pieces = enc.pieces(text)
                size.append(len(text.encode("utf-8")))
                if pieces is None:
                    near.append(len(enc.whole(text)))
                    tail.append([])
                    tail_n.append([])
                    continue
                found = list(map(known.get, pieces))
                rare = Counter(p for p, k in zip(pieces, found, strict=True) if k is None) if None in found else {}
                near.append(sum(filter(None, found)))
                tail.append(list(rare))
                tail_n.append(list(rare.values()))
            yield batch_of({"row_id": batch.column(0), "doc_id": batch.column(1), "n_bytes": size, "n_hot": near, "tail": tail, "tail_n": tail_n}, schema)

    return run


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", hot_limit: int = HOT_LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens."""
    spark = docs.sparkSession
    source = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    freq = source.select("text").mapInArrow(_frequencies(tokenizer), "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    counted = materialise(freq, "pretokens", _piece_counts(tokenizer), "piece binary, n bigint, tokens int")
    least = frequent_from(counted, "n", hot_limit)
    bucket = frequency_bucket(F.col("n"))
    hot = spark.sparkContext.broadcast({bytes(r[0]): r[1] for r in counted.where(bucket >= least).select("piece", "tokens").collect()})
    rows = materialise(source, "token-rows", _local_sums(tokenizer, hot), "row_id bigint, doc_id bigint, n_bytes bigint, n_hot bigint, tail array<binary>, tail_n array<int>")
    rare = rows.where(F.size("tail") > 0).select("row_id", F.explode(F.arrays_zip("tail", "tail_n")).alias("e")).select("row_id", F.col("e.tail").alias("piece"), F.col("e.tail_n").alias("k"))
    sums = rare.join(counted.where(bucket < least).select("piece", "tokens"), "piece").groupBy("row_id").agg(F.sum(F.col("k").cast("bigint") * F.col("tokens")).alias("n_rare"))
    return rows.select("row_id", "doc_id", "n_bytes", "n_hot").join(sums, "row_id", "left").select("doc_id", "n_bytes", (F.col("n_hot") + F.coalesce("n_rare", F.lit(0))).alias("n_tokens"))
