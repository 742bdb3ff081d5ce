"""Shared folder handling and small helpers of the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROW_GROUP_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BROADCAST_BYTES = 64 << 20


_own_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a cluster
    has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _own_roots.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="recordloom-")
        _own_roots[context.applicationId] = root
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` from here on, whatever the length of texts.

    The setting is only ever lowered, and always to the same value, so that jobs of
    one session do not disturb each other.
    """
    held = str(spark.conf.get(BYTES_SETTING, None)).rstrip("bB")
    if not (held.isdigit() and int(held) <= BATCH_BYTES):
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))


def mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes, by a worker that holds no other operator's caches."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(lean(run), schema)


def materialise(df: DataFrame, label: str, through: Callable | None = None, schema: str | None = None) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back.

    The rows survive the loss of any executor, and every later use reads them
    instead of running the Python code above them again. ``through`` is a function
    for ``mapInArrow`` with result ``schema``; its batches are written by the worker
    that makes them.

    Each task writes one Parquet file under a private name and publishes it by one
    rename, so a repeated task replaces the same file. Arrow writes it, because
    Hadoop's local file system starts a process for every file that it creates.
    Where Arrow does not know the folder's scheme, Spark's own writer is used.
    ``drop`` deletes the table when nothing needs it any more.
    """
    path, spark = scratch(df.sparkSession, label), df.sparkSession
    shape = T.StructType.fromDDL(schema) if schema else df.schema
    bounded_batches(spark)
    try:
        make_dir(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        (df.mapInArrow(through, schema) if through else df).write.option("compression", "zstd").parquet(path)
        return _table(spark, path, shape)
    written = df.mapInArrow(_parquet_writer(path, to_arrow_schema(shape), through), "rows bigint")
    written.agg(F.sum("rows")).collect()
    return _table(spark, path, shape)


def materialise_native(df: DataFrame, label: str) -> DataFrame:
    """Like ``materialise``, by Spark's own writer: no Python runs on the executors."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return _table(df.sparkSession, path, df.schema)


def _table(spark: SparkSession, path: str, shape: T.StructType) -> DataFrame:
    table = spark.read.schema(shape).parquet(path)
    table.scratch_path = path
    return table


def drop(*tables: DataFrame | str | None) -> None:
    """Delete materialised tables, or folders of the shared folder, that no plan will read again."""
    for table in tables:
        path = getattr(table, "scratch_path", table)
        session = SparkSession.getActiveSession()
        if isinstance(path, str) and session is not None:
            where = session._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(session._jsc.hadoopConfiguration()).delete(where, True)


def _parquet_writer(path: str, layout: pa.Schema, through: Callable | None):
    def run(batches):
        name = f"part-{TaskContext.get().partitionId():07d}.parquet"
        held, size, rows, out = [], 0, 0, None
        for batch in through(batches) if through else batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            rows += batch.num_rows
            if size >= ROW_GROUP_BYTES:
                out = _write_group(out, f"{path}/{name}", layout, held)
                held, size = [], 0
        if held:
            out = _write_group(out, f"{path}/{name}", layout, held)
        if out:
            out[1].close()
            out[0].publish()
        del held, out
        trim()
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], ["rows"])

    return run


def _write_group(out, path, layout, held):
    if out is None:
        file = AtomicFile(path)
        out = file, pq.ParquetWriter(file.sink, layout, compression="zstd", compression_level=1, use_dictionary=False, write_statistics=False)
    out[1].write_table(pa.Table.from_batches([pa.RecordBatch.from_arrays(b.columns, schema=layout) for b in held]))
    return out


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system of a path or URI, and the path inside it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def make_dir(path: str) -> None:
    fs, inner = filesystem(path)
    fs.create_dir(inner, recursive=True)


class AtomicFile:
    """Write a file under a private name, publish it by one rename.

    A task that is killed or run twice leaves either the whole file or a
    ``.part`` file that no reader looks at.
    """

    def __init__(self, path: str):
        self.fs, self.path = filesystem(path)
        head, _, tail = self.path.rpartition("/")
        self.part = f"{head}/.{tail}.{uuid.uuid4().hex}.part"
        self.sink = self.fs.open_output_stream(self.part)
        self.offset = 0

    def write(self, data: bytes) -> None:
        self.sink.write(data)
        self.offset += len(data)

    def publish(self) -> None:
        if not self.sink.closed:
            self.sink.close()
        self.fs.move(self.part, self.path)

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            self.publish()
        else:
            self.sink.close()
            self.fs.delete_file(self.part)


def trim() -> None:
    """Give freed memory back to the system: workers stay alive between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable) -> Callable:
    """A worker function for ``mapInArrow`` that first drops what other operators cached in
    the worker, and trims its memory when it ends."""

    def leaner(batches):
        tokens = sys.modules.get(f"{__package__}.tokens")
        if tokens:
            tokens.forget()
        gc.collect()
        trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return leaner


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """Record batch of plain columns in the order of ``schema``."""
    arrays = []
    for field in schema:
        values = columns[field.name]
        arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: Columns that name a text by 128 bits.
CONTENT = ("content", "content2")


def text_keys(column) -> list:
    """The two 64-bit content keys of a text column, named as in ``CONTENT``; null counts as empty."""
    text = F.coalesce(column, F.lit(""))
    return [F.xxhash64(text).alias(CONTENT[0]), F.xxhash64(F.lit(1), text).alias(CONTENT[1])]


def frequency_bucket(count) -> F.col:
    """Quarter-octave bucket of a positive count."""
    return F.floor(F.log2(count) * 4).cast("int")


def frequent_from(df: DataFrame, count: str, limit: int) -> int:
    """Smallest bucket b such that at most ``limit`` rows have a bucket of b or more.

    Collects one row per bucket (under 256 whatever the input). The rows from b on
    may be broadcast: their number is bounded by ``limit``.
    """
    sizes = df.groupBy(frequency_bucket(F.col(count)).alias("b")).count().collect()
    total, at = 0, 1 << 20
    for row in sorted(sizes, key=lambda r: -r["b"]):
        total += row["count"]
        if total > limit:
            break
        at = row["b"]
    return at


def small_side(table: DataFrame, entries=None, row_bytes: int = 64) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``BROADCAST_BYTES``, else as it is, for a shuffle join.

    It is counted first: rows of ``row_bytes``, and 32 bytes for each of a row's ``entries`` (a column).
    """
    size = F.count("*") * row_bytes
    if entries is not None:
        size = size + 32 * F.coalesce(F.sum(entries.cast("bigint")), F.lit(0))
    return F.broadcast(table) if table.agg(size).first()[0] <= BROADCAST_BYTES else table


def rows_of_keys(docs: DataFrame, keys: DataFrame, columns: dict, how: str, write: Callable = materialise) -> DataFrame:
    """Rows of ``docs`` whose keys are (``left_semi``) or are not (``left_anti``) among ``keys``.

    ``columns`` maps a column of ``keys`` to the expression over ``docs`` that it is compared
    with, null equal to null. Keys are counted first: few are broadcast, more are joined by
    shuffle. ``write`` is ``materialise_native`` in native stages.
    """
    keys = write(keys.select(*columns).distinct(), "keys")
    names = {c: f"key_{uuid.uuid4().hex}" for c in columns}
    right = small_side(keys.select(*[F.col(c).alias(n) for c, n in names.items()]))
    same = F.lit(True)
    for c, value in columns.items():
        same = same & value.eqNullSafe(F.col(names[c]))
    return docs.join(right, same, how)
