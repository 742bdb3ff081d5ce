"""The paged index as a stream by resume key, and as a scan that goes on where it stopped.

The stream's offset is the resume key, so a restart goes on after the last chunk that a
checkpoint names. The scan keeps every page that a task has read as a file of its own;
a later run plans only the pages that are missing. Both take an injected opener.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, SimpleDataSourceStreamReader, WriterCommitMessage

from .. import files
from ..operators.checks import Violation
from .index_api import FIELDS, Opener, _Page, _Pages, base_params, fetch, fingerprint, time_range

# --- stream by resume key ----------------------------------------------------


class _Chunks(SimpleDataSourceStreamReader):
    """Chunks of the index, one a step.

    The offset holds the next key and what is needed to see a repeat: the mark of the chunk
    before, and the mark of the last chunk whose number was a power of two, so that a circle of
    any length is found with an offset of fixed size.
    """

    def __init__(self, opener: Opener, pattern: str, page_size: int, seconds: float, first: str | None, last: str | None):
        self.opener, self.pattern, self.page_size, self.seconds = opener, pattern, page_size, seconds
        self.window = time_range(first, last)

    def initialOffset(self) -> dict:
        return {"key": None, "chunk": 0, "end": False, "before": None, "mark": None}

    def _chunk(self, at: dict) -> tuple[list[tuple], dict]:
        params = base_params(self.pattern, self.page_size) | self.window | {"showResumeKey": "true"} | ({"resumeKey": at["key"]} if at["key"] else {})
        payload = fetch(params, self.opener, time.monotonic() + self.seconds)
        rows = [[str(x) for x in r] for r in payload[1:]] if isinstance(payload, list) else []
        following = None
        if len(rows) >= 2 and not rows[-2] and len(rows[-1]) == 1:
            following, rows = rows[-1][0], rows[:-2]
        mark, number = fingerprint(rows), at["chunk"]
        if number and mark in (at["before"], at["mark"]) or following is not None and following == at["key"]:
            raise RuntimeError("index chunk repeated")
        power = number & (number - 1) == 0
        after = {"key": following, "chunk": number + 1, "end": following is None, "before": mark, "mark": mark if power else at["mark"]}
        return [(number, i, *row, mark) for i, row in enumerate(rows)], after

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["end"]:
            return iter(()), start
        rows, after = self._chunk(start)
        return iter(rows), after

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The same chunks again, after a restart; an index that changed in between aborts."""
        at = start
        while at["chunk"] < end["chunk"]:
            rows, at = self._chunk(at)
            yield from rows
        if at != end:
            raise RuntimeError("index chunks changed since they were first read")

    def commit(self, end: dict) -> None:
        pass


_CHUNK = "chunk int, at int, " + ", ".join(f"{f} string" for f in FIELDS) + ", fingerprint string"


def resume_source(opener: Opener, name: str = "web_archive_chunks") -> type[DataSource]:
    """A streaming data source class over an opener (which must pickle)."""

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return _CHUNK

        def simpleStreamReader(self, schema):
            o = self.options
            return _Chunks(opener, o["pattern"], int(o.get("page_size", 1000)), float(o.get("seconds", 180)), o.get("first"), o.get("last"))

    return Source


def read_chunks(spark: SparkSession, opener: Opener, pattern: str, **options: object) -> DataFrame:
    """A stream of index rows with the number of their chunk. ``seconds`` bounds how long a chunk may stall."""
    source = resume_source(opener)
    spark.dataSource.register(source)
    reader = spark.readStream.format(source.name()).option("pattern", pattern)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


# --- checkpointed scan -------------------------------------------------------


def scan_config(pattern: str, page_size: int) -> str:
    """Digest of everything that decides what a page holds."""
    return hashlib.sha256(json.dumps({"fields": FIELDS, "page_size": page_size, "pattern": pattern}, sort_keys=True).encode()).hexdigest()


def _page_name(number: int) -> str:
    return f"page-{number:08d}.json"


def _held(folder: str) -> dict[int, str]:
    """Numbers and configurations of the pages that a folder holds; each page's first bytes say them."""
    fs, at = files.filesystem(folder)
    found = {}
    import pyarrow.fs as pafs

    for info in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)):
        if info.base_name.startswith("page-") and info.base_name.endswith(".json"):
            with fs.open_input_stream(info.path) as f:
                found[int(info.base_name[5:-5])] = f.read(128).decode()[len('{"config": "') :][:64]
    return found


class _MissingPages(_Pages):
    """Pages that the folder does not hold yet."""

    def __init__(self, folder: str, *rest):
        super().__init__(*rest)
        self.folder = folder

    def partitions(self):
        held = _held(self.folder)
        if any(c != scan_config(self.pattern, self.page_size) for c in held.values()):
            raise RuntimeError("the folder holds pages of another scan")
        return [p for p in super().partitions() if p.value not in held] or [_Page(None)]

    def read(self, partition):
        if partition is None or partition.value is None:
            return iter(())
        return super().read(partition)


@dataclass
class _Pages_written(WriterCommitMessage):
    pages: list


class _PageWriter(DataSourceWriter):
    """One file a page, published whole by the task that read it; commit looks at all of them together."""

    def __init__(self, folder: str, config: str):
        self.folder, self.config = folder, config

    def write(self, iterator):
        done, page, rows, mark = [], None, [], None

        def keep():
            if page is not None:
                part = files.Part(f"{self.folder}/{_page_name(page)}")
                part.write(json.dumps({"config": self.config, "page": page, "fingerprint": mark, "rows": rows}).encode() + b"\n")
                part.publish()
                done.append((page, mark))

        for r in iterator:
            if r["page"] != page:
                keep()
                page, rows = r["page"], []
            rows.append([r[f] for f in FIELDS])
            mark = r["fingerprint"]
        keep()
        return _Pages_written(done)

    def commit(self, messages):
        pages = [p for m in messages if m for p in m.pages]
        if len({n for n, _ in pages}) < len(pages):
            raise RuntimeError("an index page was written twice")

    def abort(self, messages):
        """Pages that are whole stay: the next run does without reading them again."""


def scan_source(opener: Opener, name: str = "web_archive_scan") -> type[DataSource]:
    """A data source class that reads missing pages and keeps what was read."""

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "page int, at int, " + ", ".join(f"{f} string" for f in FIELDS) + ", fingerprint string"

        def reader(self, schema):
            o = self.options
            return _MissingPages(o["folder"], opener, o["pattern"], int(o["page_size"]), int(o.get("max_pages", 10_000)), float(o.get("seconds", 180)))

        def writer(self, schema, overwrite):
            o = self.options
            return _PageWriter(o["folder"], scan_config(o["pattern"], int(o["page_size"])))

    return Source


def scan(spark: SparkSession, opener: Opener, pattern: str, folder: str, page_size: int = 1000, **options: object) -> DataFrame:
    """All rows of the index: pages that the folder lacks are read and kept in it, then all are read from it.

    A run that is stopped loses at most the pages that were being read. A folder with pages of
    another scan aborts before anything is fetched.
    """
    source = scan_source(opener)
    spark.dataSource.register(source)
    files.make_folder(spark, folder)
    given = {"pattern": pattern, "folder": folder, "page_size": str(page_size)} | {k: str(v) for k, v in options.items()}
    spark.read.format(source.name()).options(**given).load().write.format(source.name()).options(**given).mode("append").save()
    return kept_pages(spark, folder, scan_config(pattern, page_size))


_KEPT = "config string, page int, fingerprint string, rows array<array<string>>"


def kept_pages(spark: SparkSession, folder: str, config: str) -> DataFrame:
    """Rows of a folder's pages. Pages of one configuration, numbered without a gap, none like another; else aborts."""
    pages = spark.read.schema(_KEPT).option("pathGlobFilter", "page-*.json").json(folder)
    if not files.listed(spark, folder):
        return pages.select("page", F.lit(0).alias("at"), *[F.lit("").alias(f) for f in FIELDS], "fingerprint").limit(0)
    seen = pages.agg(F.count("*").alias("n"), F.count("page").alias("whole"), F.max("page").alias("last"), F.count_distinct("page").alias("numbers"), F.count_distinct("fingerprint").alias("marks"), F.count_if(~F.col("config").eqNullSafe(config)).alias("strange")).first()
    if seen["strange"] or seen["whole"] < seen["n"]:
        raise Violation("the folder holds pages of another scan, or broken ones")
    if not seen["n"] == seen["numbers"] == seen["marks"] == (seen["last"] or 0) + 1:
        raise Violation("index pages are missing or repeated")
    each = pages.select("page", F.posexplode("rows").alias("at", "row"), "fingerprint")
    return each.select("page", "at", *[F.col("row")[i].alias(f) for i, f in enumerate(FIELDS)], "fingerprint")
