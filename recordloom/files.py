"""Files of any file system that Spark knows: small documents from the driver, parts from tasks.

The driver goes through Hadoop's file system. Tasks go through Arrow's, under a private
name that one rename publishes, so that a repeated or lost task leaves a whole file or none.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

_own_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _own_roots.get(context.applicationId) or _own_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="recordloom-"))
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# --- on the driver -----------------------------------------------------------


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        # without the local file system's checksums: they have no place in packages, and hide what was changed
        fs = spark._jvm.org.apache.hadoop.fs.RawLocalFileSystem()
        fs.initialize(spark._jvm.java.net.URI("file:///"), spark._jsc.hadoopConfiguration())
    return fs, where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.mkdirs(where)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder to a name that is free; aborts if it is not."""
    fs, where = _at(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(where, target):
        raise FileExistsError(new)


def read(spark: SparkSession, path: str) -> bytes:
    """A small document."""
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write(spark: SparkSession, path: str, body: bytes) -> None:
    """A small document: written beside its place, then renamed over it."""
    fs, where = _at(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(body))
    finally:
        stream.close()
    if not fs.rename(part, where):  # stores that do not rename over a file
        fs.delete(where, False)
        if not fs.rename(part, where):
            raise OSError(f"{path} could not be published")


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path inside the folder and length of every file below it, hidden ones too."""
    fs, where = _at(spark, folder)
    head = f"{fs.makeQualified(where).toUri().getPath().rstrip('/')}/"
    found, files = {}, fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        found[f.getPath().toUri().getPath().removeprefix(head)] = f.getLen()
    # checksums that the local file system keeps beside a file are no files of the folder
    beside = {"/".join([*n.split("/")[:-1], f".{n.split('/')[-1]}.crc"]) for n in found}
    return sorted((n, size) for n, size in found.items() if n not in beside)


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


# --- in tasks ----------------------------------------------------------------


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system of a path or URI, and the path inside it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


class Part:
    """A file that appears whole or not at all, with the digest, length and lines of what was written."""

    def __init__(self, path: str):
        self.fs, self.path = filesystem(path)
        head, _, tail = self.path.rpartition("/")
        self.fs.create_dir(head, recursive=True)
        self.hidden = f"{head}/.{tail}.{uuid.uuid4().hex}"
        self.sink, self.hash, self.bytes, self.lines = self.fs.open_output_stream(self.hidden), hashlib.sha256(), 0, 0

    def write(self, data: bytes) -> None:
        self.sink.write(data)
        self.hash.update(data)
        self.bytes += len(data)

    def publish(self) -> None:
        self.sink.close()
        self.fs.move(self.hidden, self.path)

    def abandon(self) -> None:
        self.sink.close()
        self.fs.delete_file(self.hidden)


def chunks(path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """A file's bytes, a piece at a time."""
    fs, inner = filesystem(path)
    with fs.open_input_stream(inner) as f:
        while data := f.read(size):
            yield data


def filled_lines(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, int]]:
    """Pieces with the number of lines that end in them and hold more than white space; the last line needs no end."""
    left = b""
    for data in pieces:
        *whole, left = (left + data).split(b"\n")
        yield data, sum(bool(x.strip()) for x in whole)
    if left.strip():
        yield b"", 1
