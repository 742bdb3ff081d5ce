"""Paged web-archive index behind an injected opener, and bounded catalog archives.

``opener(params) -> payload`` owns the network; without one nothing is fetched. The
Spark source makes one partition a page, so pages are read in parallel and a lost
task repeats its page alone.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import time
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.canonical import strict_json

# Fields, retried answers and bounds.
FIELDS = ["original", "timestamp", "digest", "statuscode", "length"]
RETRIED = {429, 500, 502, 503, 504}
ATTEMPTS, LONGEST_WAIT = 32, 60
CATALOG_BYTES, CATALOG_ENTRIES, MEMBER_BYTES, UNPACKED_BYTES = 32 << 20, 32, 8 << 20, 16 << 20

Opener = Callable[[dict[str, str]], object]


class Refused(Exception):
    """An answer with an HTTP status."""

    def __init__(self, status: int):
        super().__init__(f"HTTP {status}")
        self.status = status


def fetch(params: dict[str, str], opener: Opener, deadline: float, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> object:
    """One answer, retried with doubling waits until the deadline; a page query also retries 400."""
    last: Exception | None = None
    for attempt in range(ATTEMPTS):
        left = deadline - clock()
        if left <= 0:
            raise RuntimeError("index acquisition exceeded its deadline")
        try:
            return opener(params)
        except Refused as error:
            if error.status not in RETRIED and not (error.status == 400 and "page" in params):
                raise
            last = error
        except (OSError, ValueError) as error:
            last = error
        sleep(min(2 ** (attempt + 1), LONGEST_WAIT, max(0.0, deadline - clock())))
    raise RuntimeError(f"index request failed: {last}")


def fingerprint(rows: list[list[str]]) -> str:
    return hashlib.sha256(json.dumps(rows, sort_keys=True).encode()).hexdigest()


def time_range(first: str | None, last: str | None) -> dict[str, str]:
    """Range parameters; partial timestamps are compared at their widest."""
    for value in (first, last):
        if value is not None and not re.fullmatch("[0-9]{1,14}", value):
            raise ValueError("timestamps have 1 to 14 digits")
    if first and last:
        width = max(len(first), len(last))
        if first.ljust(width, "0") > last.ljust(width, "9"):
            raise ValueError("the range ends before it starts")
    return {k: v for k, v in (("from", first), ("to", last)) if v is not None}


def base_params(pattern: str, page_size: int, by_url: bool = True) -> dict[str, str]:
    params = {"url": pattern, "output": "json", "filter": "statuscode:200", "fl": ",".join(FIELDS), "limit": str(page_size)}
    return params | ({"collapse": "urlkey"} if by_url else {})


def split_page(payload: object, header: list[str] | None) -> tuple[list[str], list[list[str]]]:
    """Header and rows of a page; an empty page or another header aborts."""
    if not isinstance(payload, list) or len(payload) < 2:
        raise RuntimeError("index page is empty")
    found = [str(x) for x in payload[0]]
    if header is not None and found != header:
        raise RuntimeError("index page header changed")
    return found, [[str(x) for x in row] for row in payload[1:]]


def resume_chunks(pattern: str, page_size: int, opener: Opener, deadline: float, key: str | None = None, max_chunks: int = 10_000, **window: str | None) -> Iterator[tuple[list[list[str]], str | None]]:
    """Chunks by resume key: rows and the next key. A repeated chunk or key aborts."""
    seen: set[str] = set()
    for _ in range(max_chunks):
        params = base_params(pattern, page_size) | time_range(window.get("first"), window.get("last")) | {"showResumeKey": "true"} | ({"resumeKey": key} if key else {})
        payload = fetch(params, opener, deadline)
        rows = [[str(x) for x in r] for r in payload[1:]] if isinstance(payload, list) else []
        following = None
        if len(rows) >= 2 and not rows[-2] and len(rows[-1]) == 1:
            following, rows = rows[-1][0], rows[:-2]
        mark = fingerprint(rows)
        if mark in seen or (following and following == key):
            raise RuntimeError("index chunk repeated")
        seen.add(mark)
        yield rows, following
        if following is None:
            return
        key = following
    raise RuntimeError("index reached its cap of chunks without an end")


class _Page(InputPartition):
    pass


class _Pages(DataSourceReader):
    def __init__(self, opener: Opener, pattern: str, page_size: int, max_pages: int, seconds: float):
        self.opener, self.pattern, self.page_size, self.max_pages, self.seconds = opener, pattern, page_size, max_pages, seconds

    def partitions(self):
        answer = fetch(base_params(self.pattern, self.page_size) | {"showNumPages": "true"}, self.opener, time.monotonic() + self.seconds)
        pages = int(answer[1][0])
        if not 0 <= pages <= self.max_pages:
            raise RuntimeError(f"index reports {pages} pages, the cap is {self.max_pages}")
        return [_Page(i) for i in range(pages)]

    def read(self, partition):
        payload = fetch(base_params(self.pattern, self.page_size) | {"page": str(partition.value)}, self.opener, time.monotonic() + self.seconds)
        _, rows = split_page(payload, FIELDS)
        mark = fingerprint(rows)
        for at, row in enumerate(rows):
            yield (partition.value, at, *row, mark)


def index_source(opener: Opener, name: str = "web_archive_index") -> type[DataSource]:
    """A Spark data source class over an opener (which must pickle)."""

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "page int, at int, " + ", ".join(f"{f} string" for f in FIELDS) + ", fingerprint string"

        def reader(self, schema):
            o = self.options
            return _Pages(opener, o["pattern"], int(o.get("page_size", 1000)), int(o.get("max_pages", 10_000)), float(o.get("seconds", 180)))

    return Source


def read_index(spark: SparkSession, opener: Opener, pattern: str, **options: object) -> DataFrame:
    """Rows of all pages; check repeats with ``chains.page_violations``."""
    source = index_source(opener)
    spark.dataSource.register(source)
    reader = spark.read.format(source.name()).option("pattern", pattern)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def distinct_rows(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of pages, each once at its first place; with ``limit`` the first so many of them."""
    first = rows.groupBy(*FIELDS).agg(F.min(F.struct("page", "at")).alias("_place")).select(F.col("_place.page").alias("page"), F.col("_place.at").alias("at"), *FIELDS)
    return first if limit is None else first.orderBy("page", "at").limit(limit)


def parse_catalog(archive: bytes, names: tuple[str, ...] = ("discovered_bodies.json", "discovered_bodies.provenance.json")) -> list[dict]:
    """Objects of the named members of a ZIP, within bounds of size and number; nothing is unpacked to disk."""
    if len(archive) > CATALOG_BYTES:
        raise ValueError("catalog archive is too large")
    try:
        with zipfile.ZipFile(io.BytesIO(archive)) as z:
            members = z.infolist()
            listed = [m.filename for m in members]
            if len(members) > CATALOG_ENTRIES or len(set(listed)) < len(listed) or any(m.file_size > MEMBER_BYTES for m in members) or sum(m.file_size for m in members) > UNPACKED_BYTES:
                raise ValueError("catalog archive breaks its bounds")
            found = []
            for n in names:
                with z.open(n) as f:
                    body = f.read(MEMBER_BYTES + 1)
                if len(body) != z.getinfo(n).file_size:
                    raise ValueError(f"{n} has another size than its entry says")
                found.append(strict_json(body.decode("utf-8"), n))
    except (zipfile.BadZipFile, KeyError, EOFError, OSError, UnicodeDecodeError, RuntimeError, NotImplementedError) as error:
        raise ValueError(f"catalog archive cannot be read: {error}") from error
    if not all(isinstance(x, dict) for x in found):
        raise ValueError("catalog members must be objects")
    return found
