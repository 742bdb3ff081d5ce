"""WARC archives: deduplicated writing, and reading by boundary-chain verification.

Writing: payloads are digested in the JVM; of equal payloads of at least
``min_revisit`` bytes the one with the smallest id becomes a response, the others
revisit records that refer to it. The table of repeated digests is written first,
so that the join with the pages is a broadcast only if its size allows it. Pages
are not shuffled otherwise. Each task writes archives of bounded size.

Reading: an archive is split by bytes. Tasks look for the record magic in their
split, and emit for each candidate its offset and the offset where its record
would end. A payload may hold the magic too, so per archive pointer jumping from
offset 0 marks the reachable candidates in a logarithmic number of doublings; the
others are rejected. The chain must end at the archive's end with as many records as the
manifest states, and each payload must have the digest that its header states, or the
read fails; so it does where an archive is missing, cut, emptied or overwritten.

Null html is an empty payload. Rows without an id are written without one; they
are revisits of a repeated payload whose smallest id exists, else responses.
Repeated rows of the smallest id are all responses. An empty table writes nothing.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import AtomicFile, batch_of, filesystem, make_dir, materialise, scratch

MAGIC = b"WARC/1.1\r\n"
ARCHIVE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
HEADER_BYTES = 64 << 10
MIN_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("8c7cf9d0-54a1-4f7e-9a2b-0e5a3b1f4c6d")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record. Extension fields carry the table's ids."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", _clean(url or "about:blank")), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return MAGIC + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_header(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """Fields of a record header at an offset and where its block starts; None if there is none."""
    end = data.find(b"\r\n\r\n", at)
    if not data.startswith(MAGIC, at) or end < 0:
        return None
    fields = {}
    for line in data[at + len(MAGIC) : end].split(b"\r\n"):
        name, sep, value = line.partition(b": ")
        if not sep:
            return None
        fields[name.decode("latin-1").lower()] = value.decode("utf-8", "replace")
    if not fields.get("content-length", "").isascii() or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def typed_pages(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Pages with digest, record type and the id referred to."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digested = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("url"), html.alias("payload"), F.sha2(html, 256).alias("digest"))
    repeated = digested.where(F.length("payload") >= min_revisit).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("response")).where("n > 1").select("digest", "response")
    repeated = materialise(repeated, "repeated-payloads")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return digested.join(repeated, "digest", "left").select("page_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("response")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write a record per page; returns a manifest row (archive, n_bytes, n_records) per file."""
    make_dir(folder)
    schema = pa.schema([("archive", pa.string()), ("n_bytes", pa.int64()), ("n_records", pa.int64())])

    def run(batches):
        out, number, done = None, 0, {c: [] for c in schema.names}

        def close():
            out.publish()
            for c, v in zip(schema.names, (name, out.offset, count), strict=True):
                done[c].append(v)

        for batch in batches:
            for page_id, url, payload, digest, revisit, refers_to in zip(*(c for c in batch.columns), strict=True):
                if out is None:
                    name, count = f"part-{TaskContext.get().partitionId():07d}-{number:05d}.warc", 0
                    out, number = AtomicFile(f"{folder}/{name}"), number + 1
                out.write(record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), revisit.as_py(), refers_to.as_py(), date))
                count += 1
                if out.offset >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield batch_of(done, schema)

    return materialise(typed_pages(pages, min_revisit), "warc-manifest", run, "archive string, n_bytes bigint, n_records bigint")


def candidates(data: bytes, base: int, length: int) -> list[tuple[int, int]]:
    """(offset, successor) of every record magic that starts in the first ``length`` bytes of a split.

    Headers are read from the last magic to the first, and a line that one header has led
    through is not read again for another: a payload full of magic, bare or inside fields,
    takes time in proportion to its length.
    """
    starts, at = [], data.find(MAGIC)
    while 0 <= at < length:
        starts.append(at)
        at = data.find(MAGIC, at + 1)
    out: list[tuple[int, int]] = []
    led: dict[int, tuple[int, bytes | None] | None] = {}
    for at in reversed(starts):
        line, through = at + len(MAGIC), []
        while line not in led:
            end = data.find(b"\r\n", line)
            if end <= line or data.find(b": ", line, end) < 0:
                break
            through.append((line, end))
            line = end + 2
        if line in led:
            found = led[line]
        else:
            found = (line + 2, None) if through and data.startswith(b"\r\n", line) else None
        for line, end in reversed(through):
            if found and found[1] is None and data[line : line + 16].lower() == b"content-length: ":
                found = found[0], data[line + 16 : end]
            led[line] = found
        if found and found[1] and found[1].isdigit():
            out.append((base + at, base + found[0] + int(found[1]) + 4))
    return out[::-1]


def reachable(offsets: np.ndarray, successors: np.ndarray, size: int) -> np.ndarray:
    """Mask of candidates on the chain from offset 0, by pointer jumping."""
    n = len(offsets)
    order = np.argsort(offsets)
    at = np.searchsorted(offsets[order], successors)
    hit = (at < n) & (offsets[order][np.minimum(at, n - 1)] == successors) if n else np.empty(0, bool)
    end, lost = n, n + 1
    jump = np.full(n + 2, lost)
    jump[end] = end
    jump[:n] = np.where(hit, order[np.minimum(at, n - 1)], np.where(successors == size, end, lost)) if n else []
    mark = np.zeros(n + 2, bool)
    mark[np.flatnonzero(offsets == 0)] = True
    for _ in range(int(n + 2).bit_length()):
        mark[jump[mark]] = True
        jump = jump[jump]
    if size and (not mark[end] or mark[lost]):
        raise ValueError("the chain of records breaks off before the archive's end")
    return mark[:n]


def _split_of(f, length: int) -> bytes:
    """A split, and what follows it up to the end of the header of its last record magic, or to a line that is no field."""
    data = f.read(length + HEADER_BYTES)
    last = data.rfind(MAGIC, 0, length + len(MAGIC) - 1)
    line = last + len(MAGIC)
    while last >= 0:
        end = data.find(b"\r\n", line)
        if end < 0:
            if not (more := f.read(max(HEADER_BYTES, len(data) - last))):
                break
            data += more
        elif data.find(b": ", line, end) < 0:
            break
        else:
            line = end + 2
    return data


def _candidates_of(folder):
    schema = pa.schema([("archive", pa.string()), ("n_bytes", pa.int64()), ("offset", pa.int64()), ("successor", pa.int64())])

    def run(batches):
        for batch in batches:
            for name, size, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = filesystem(f"{folder}/{name}")
                with fs.open_input_file(path) as f:
                    f.seek(start)
                    found = candidates(_split_of(f, length), start, length)
                yield batch_of({"archive": [name] * len(found), "n_bytes": [size] * len(found), "offset": [x for x, _ in found], "successor": [y for _, y in found]}, schema)

    return run


_RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, archive string, offset bigint"


def _records_of(folder):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name, size = pdf["archive"].iloc[0], int(pdf["n_bytes"].iloc[0])
        stated = pdf[pdf["offset"] < 0]
        pdf = pdf[pdf["offset"] >= 0]
        offsets, ends = pdf["offset"].to_numpy(), pdf["successor"].to_numpy()
        rows, (fs, path) = [], filesystem(f"{folder}/{name}")
        if fs.get_file_info(path).size != size:
            raise ValueError(f"{name}: the manifest states {size} bytes")
        keep = reachable(offsets, ends, size)
        if keep.sum() != stated["successor"].sum():
            raise ValueError(f"{name}: {keep.sum()} records; the manifest states {stated['successor'].sum()}")
        with fs.open_input_file(path) as f:
            for at, end in sorted(zip(offsets[keep].tolist(), ends[keep].tolist(), strict=True)):
                f.seek(at)
                data = f.read(end - at)
                fields, block = parse_header(data, 0)
                body = data[data.find(b"\r\n\r\n", block) + 4 : -4]
                number = lambda k: int(fields[k]) if k in fields else None  # noqa: B023, E731
                digest, length = fields["warc-payload-digest"].removeprefix("sha256:"), number("x-payload-length")
                if fields["warc-type"] == "response" and (hashlib.sha256(body).hexdigest() != digest or len(body) != length):
                    raise ValueError(f"{name}: payload at {at} does not match its digest")
                rows.append((number("x-page-id"), length, digest, fields["warc-type"], number("x-refers-to-page-id"), name, at))
        out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset"])
        return out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return run


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the manifest's archives.

    Fails where an archive has another length than stated, where its chain of records does not
    lead from its start to its end, where it has another number of records than stated, and
    where a response's payload does not match its digest.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_bytes") - 1, F.lit(split_bytes).cast("bigint")))
    splits = manifest.where("n_bytes > 0").select("archive", "n_bytes", starts.alias("start"), F.lit(split_bytes).cast("bigint").alias("length"))
    splits = splits.repartition("archive", "start")
    found = splits.mapInArrow(_candidates_of(folder), "archive string, n_bytes bigint, offset bigint, successor bigint")
    # one row more of every archive holds its stated number of records, so that none is passed over in silence
    found = found.unionByName(manifest.select("archive", "n_bytes", F.lit(-1).cast("bigint").alias("offset"), F.col("n_records").alias("successor")))
    return found.groupBy("archive").applyInPandas(_records_of(folder), _RECORDS)


def archived_pages(pages: DataFrame, folder: str | None = None, **kw) -> DataFrame:
    """Write the archives, read them back, one row per record."""
    folder = folder or scratch(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **kw), folder)
