"""Deterministic outputs: tables, JSON documents, checksums, immutable packages."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions.canonical import content_digest
from ..operators.checks import Violation


def write_json(path: str | Path, document: object) -> None:
    """Sorted keys, two spaces, a final newline; published by one rename."""
    write_bytes(path, (json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n").encode("utf-8"))


def write_bytes(path: str | Path, body: bytes) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, part = tempfile.mkstemp(prefix=f".{path.name}.", dir=path.parent)
    with os.fdopen(handle, "wb") as f:
        f.write(body)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def append_bytes(path: str | Path, body: bytes) -> None:
    """Append whole lines; what a crash has left of a line at the end is cut off first."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("ab+") as f:
        end, step = f.tell(), 1 << 12
        while end:
            start = max(0, end - step)
            f.seek(start)
            whole = f.read(end - start).rfind(b"\n") + 1
            if whole or not start:
                f.truncate(start + whole)
                break
            step *= 2
        f.write(body)
        f.flush()
        os.fsync(f.fileno())


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet; columns of no type become text, as an empty table still needs a schema."""
    df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "void"}).write.mode(mode).parquet(path)


def write_ndjson(df: DataFrame, path: str, *order: str) -> None:
    """Rows as JSON lines in order."""
    df.orderBy(*order).select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.mode("overwrite").text(path)


def content_digest_of(df: DataFrame) -> dict[str, object]:
    """Row count and an order-free digest of a table's content: the same for any file layout."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    half = lambda at: F.sum(F.conv(F.substring(row, at, 8), 16, 10).cast("decimal(38,0)"))
    got = df.agg(F.count("*").alias("n"), *[half(1 + 8 * k).alias(f"h{k}") for k in range(8)]).first()
    return {"rows": got["n"], "sha256": content_digest([got["n"], *[str(got[f"h{k}"]) for k in range(8)]])}


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Path inside the folder, bytes and sha256 of every file, in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    inside = F.substring_index("path", f"/{name}/", -1)
    return files.select(inside.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")


SUMS = "CHECKSUMS.sha256"
DOCUMENT_ROWS = 1_000_000


def write_projection(folder: str, tables: Mapping[str, DataFrame], coverage: dict, name: str, version: str = "1.0.0") -> dict:
    """Write a projection's tables with coverage.json, dataset_info.json, CHECKSUMS.json (content of
    tables, whatever their files) and CHECKSUMS.sha256 (bytes of every file).

    Tables go to a staging folder beside the target, on the target's file system, and are moved at
    the end, so nothing partial is left.
    """
    spark = next(iter(tables.values())).sparkSession
    home, _, last = folder.rstrip("/").rpartition("/")
    stage = f"{home}/.{last}-{uuid.uuid4().hex}" if home else f".{last}-{uuid.uuid4().hex}"
    text = lambda document: (json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n").encode("utf-8")
    try:
        digests = {}
        for key, df in tables.items():
            write_table(df, f"{stage}/{key}.parquet")
            digests[key] = content_digest_of(spark.read.parquet(f"{stage}/{key}.parquet"))
        files.write(spark, f"{stage}/coverage.json", text(coverage))
        info = {"name": name, "version": version, "resources": [{"name": k, "path": f"{k}.parquet", "format": "parquet"} for k in tables], "coverage": "coverage.json"}
        files.write(spark, f"{stage}/dataset_info.json", text(info))
        files.write(spark, f"{stage}/CHECKSUMS.json", text({"tables": digests, "coverage": content_digest(coverage), "dataset_info": content_digest(info)}))
        files.write(spark, f"{stage}/{SUMS}", "".join(f"{r['sha256']}  {r['path']}\n" for r in checksums(spark, stage).collect()).encode())
        files.delete(spark, folder)
        files.rename(spark, stage, folder)
    except BaseException:
        files.delete(spark, stage)
        raise
    return digests


def verify_projection(spark: SparkSession, folder: str) -> dict:
    """Coverage of a projection whose checksums hold and whose counts reconcile; else aborts."""
    folder = folder.rstrip("/")
    text = lambda name: files.read(spark, f"{folder}/{name}").decode("utf-8")
    stated = [tuple(reversed(line.split("  ", 1))) for line in text(SUMS).splitlines()]
    found = [(r["path"], r["sha256"]) for r in checksums(spark, folder).collect() if r["path"] != SUMS]
    if sorted(stated) != sorted(found):
        raise Violation("projection files differ from their checksums")
    sums, coverage = json.loads(text("CHECKSUMS.json")), json.loads(text("coverage.json"))
    if content_digest(coverage) != sums["coverage"] or content_digest(json.loads(text("dataset_info.json"))) != sums["dataset_info"]:
        raise Violation("projection documents were changed")
    for key, want in sums["tables"].items():
        if content_digest_of(spark.read.parquet(f"{folder}/{key}.parquet")) != want:
            raise Violation(f"projection table {key} was changed")
    for flag in ("request_count_reconciles", "attachment_count_reconciles", "source_record_count_reconciles"):
        if not coverage.get(flag, True):
            raise Violation(f"projection does not reconcile: {flag}")
    return coverage


def manifest_document(meta: dict, rows: DataFrame) -> dict:
    """Manifest of a request table, which has to be small enough for one document; a larger one aborts."""
    if rows.count() > DOCUMENT_ROWS:
        raise Violation(f"a manifest document holds at most {DOCUMENT_ROWS} requests")
    requests = [r.asDict(recursive=True) for r in rows.orderBy("request_id").collect()]
    return {"meta": meta | {"record_count": len(requests)}, "requests": requests}


def write_manifest(folder: str, document: dict, rows: DataFrame) -> None:
    """Manifest document, its table and the list of authorities."""
    write_json(Path(folder) / "latest_manifest.json", document)
    write_table(rows, f"{folder}/latest_manifest.parquet")
    names = [r[0] for r in rows.select("authority").where("authority <> ''").distinct().orderBy("authority").collect()]
    write_json(Path(folder) / "authorities.json", {"authorities": names})


def export_table(spark: SparkSession, parquet: str, name: str = "requests") -> None:
    """Register a table over a Parquet path; the path is a value, never spliced into SQL."""
    spark.read.parquet(parquet).createOrReplaceTempView(name)


def export_bucketed(rows: DataFrame, path: str, name: str = "requests", key: str = "request_id", buckets: int = 32) -> DataFrame:
    """A catalogue table of the rows, bucketed and sorted by their key, at ``path``; returns it.

    Joins and differences by the key between tables of the same number of buckets read both
    sides where they lie: no exchange, whatever their size.
    """
    rows.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return rows.sparkSession.table(name)


def descriptors(name: str, description: str, source: str, version: str, record_count: int, license_url: str, home: str) -> dict[str, dict]:
    """Croissant, Frictionless and schema.org descriptions of a manifest table."""
    path, kind = "manifests/latest_manifest.parquet", "application/vnd.apache.parquet"
    return {
        "croissant.jsonld": {"@context": {"@language": "en", "@vocab": "https://schema.org/", "cr": "http://mlcommons.org/croissant/"}, "@type": "Dataset", "name": name, "description": description, "license": license_url, "distribution": [{"@type": "cr:FileObject", "name": "latest_manifest", "contentUrl": path, "encodingFormat": kind}], "recordSet": [{"@type": "cr:RecordSet", "name": "requests", "description": f"{record_count} request records"}]},
        "frictionless.json": {"profile": "data-package", "name": name, "title": name, "resources": [{"name": "requests", "path": path, "format": "parquet", "mediatype": kind}], "custom": {"source": source, "record_count": record_count}},
        "schema.org.jsonld": {"@context": "https://schema.org", "@type": "Dataset", "name": name, "description": description, "url": home, "isBasedOn": source, "version": version, "size": record_count},
    }


def append_ledger(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def store_objects(df: DataFrame, root: str, digest: str = "sha256", body: str = "body") -> int:
    """Write each distinct body once, at aa/bb/<digest>; a body with another digest aborts.

    ``root`` is a folder that all executors share. The input is read once: tasks count what
    they keep. Returns the number of objects.
    """
    import hashlib

    def put(batches):
        n = 0
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if hashlib.sha256(data).hexdigest() != name:
                    raise Violation(f"body does not match digest {name}")
                n += 1
                path = f"{root}/{name[:2]}/{name[2:4]}/{name}"
                fs, at = files.filesystem(path)
                if fs.get_file_info(at).size != len(data):
                    part = files.Part(path)
                    part.write(data)
                    part.publish()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    kept = df.dropDuplicates([digest]).select(digest, F.col(body).cast("binary").alias(body))
    return kept.mapInArrow(put, "n bigint").agg(F.sum("n")).first()[0] or 0


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """Name, digest and bytes of every object below ``root``, from its file.

    Tasks list the folders that they read: the driver hears of the folders at the top alone, of
    which there are 256 however many the objects.
    """
    import hashlib

    import pyarrow.fs as pafs

    def get(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                fs, at = files.filesystem(f"{root}/{folder}")
                found = ([], [], [])
                for info in fs.get_file_info(pafs.FileSelector(at, recursive=True)):
                    if info.is_file and not info.base_name.startswith((".", "_")):
                        digest, size = hashlib.sha256(), 0
                        with fs.open_input_stream(info.path) as body:
                            while data := body.read(1 << 20):
                                digest.update(data)
                                size += len(data)
                        for column, value in zip(found, (info.base_name, digest.hexdigest(), size), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.string()), pa.array(found[2], pa.int64())], ["name", "sha256", "bytes"])

    tops = [(name,) for name in files.folders(spark, root)]
    return spark.createDataFrame(tops, "folder string").repartition(64).mapInArrow(get, "name string, sha256 string, bytes bigint")
