"""Immutable packages of NDJSON files, written and verified by tasks.

A package is a folder of files and one manifest that lists them in order. Tasks write or
copy the files into a staging folder and report what they wrote; the driver only sees one
row a file. The manifest goes into the staging folder last, the folder is verified as it
is, and one rename makes it the package. The same content gives the same files, manifest
and identity, so that building it again changes nothing; other content under a number that
is taken, or a number before the last, aborts.

Rows of a table become lines in a total order and are cut into files of a fixed number of
lines by their place in it, so that neither partitions nor cores show in the result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions.canonical import canonical_bytes, content_digest
from ..operators.checks import Violation
from ..operators.prefix import ordinals

MANIFEST = "archive-package.json"
NOTE = "metadata/package-metadata.json"
FILE_ROWS = 1_000_000
_WRITTEN = "role string, number bigint, path string, bytes bigint, sha256 string, row_count bigint"
_SCHEMA = pa.schema([("role", pa.string()), ("number", pa.int64()), ("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("row_count", pa.int64())])


def package_id(manifest: dict) -> str:
    """Digest of all of a manifest but this field."""
    return content_digest({k: v for k, v in manifest.items() if k != "package_id"})


def _home(root: str, instance: str, revision: int) -> str:
    return f"{root.rstrip('/')}/packages/{instance}/{revision:020d}"


# --- phase one: tasks write --------------------------------------------------


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_SCHEMA), _SCHEMA, strict=True)], schema=_SCHEMA)


def _line_writer(folder: str, role: str):
    """Rows (number, line) sorted by file: one file for each number."""

    def run(batches):
        part, number = None, None

        def done():
            part.publish()
            return _batch([(role, number, name, part.bytes, part.hash.hexdigest(), part.lines)])

        try:
            for batch in batches:
                for at, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if at != number:
                        if part:
                            yield done()
                        number, name = at, f"{role}/{role}-{at:08d}.ndjson"
                        part = files.Part(f"{folder}/{name}")
                    part.write(line.encode() + b"\n")
                    part.lines += 1
            if part:
                yield done()
                part = None
        except BaseException:
            if part:
                part.abandon()
            raise

    return run


def write_lines(rows: DataFrame, order: list[str], folder: str, role: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows as JSON lines in order, ``file_rows`` to a file; what was written, one row a file. Runs when it is read."""
    columns = sorted(rows.columns)
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    placed = ordinals(rows, order, "_place").select(F.floor(F.col("_place") / file_rows).alias("number"), line.alias("line"), "_place")
    dealt = placed.repartition("number").sortWithinPartitions("number", "_place")
    return dealt.select("number", "line").mapInArrow(_line_writer(folder, role), _WRITTEN)


def copy_files(spark: SparkSession, sources: Mapping[str, str], folder: str) -> DataFrame:
    """Files {role: path} copied by tasks, a piece at a time; what was written, one row a file."""

    def run(batches):
        for batch in batches:
            for role, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = files.Part(f"{folder}/{role}.ndjson")
                try:
                    for data, lines in files.filled_lines(files.chunks(path)):
                        part.write(data)
                        part.lines += lines
                except BaseException:
                    part.abandon()
                    raise
                part.publish()
                yield _batch([(role, 0, f"{role}.ndjson", part.bytes, part.hash.hexdigest(), part.lines)])

    listed = spark.createDataFrame(list(sources.items()), "role string, path string")
    return listed.repartition(max(1, len(sources)), "role").mapInArrow(run, _WRITTEN)


# --- phase two: the driver commits -------------------------------------------


def build_package(spark: SparkSession, root: str, instance: str, revision: int, roles: Mapping[str, str | tuple[DataFrame, list[str]]], source: dict, metadata: dict, file_rows: int = FILE_ROWS) -> dict:
    """Build or confirm one package; returns its manifest.

    ``roles`` maps a role, in the package's order, to a file that is copied or to a table and
    the columns of its total order.
    """
    home, held = _home(root, instance, revision), indexed(spark, root, instance)
    if not files.exists(spark, home) and held and revision <= max(r["archive_revision"] for r in held):
        raise Violation(f"revision {revision} comes after a later one")
    stage = f"{root.rstrip('/')}/staging/{files.shared_folder(spark, 'package').rpartition('/')[2]}"
    try:
        files.make_folder(spark, stage)
        paths = {r: p for r, p in roles.items() if isinstance(p, str)}
        written = {r["role"]: [r] for r in copy_files(spark, paths, stage).collect()} if paths else {}
        for role, given in roles.items():
            if role not in paths:
                written[role] = sorted(write_lines(*given, stage, role, file_rows).collect(), key=lambda r: r["number"])
        body = canonical_bytes(metadata) + b"\n"
        files.write(spark, f"{stage}/{NOTE}", body)
        note = {"role": "other", "path": NOTE, "bytes": len(body), "sha256": content_digest_of(body), "row_count": None}
        found = [{k: r[k] for k in ("role", "path", "bytes", "sha256", "row_count")} for role in roles for r in written[role]] + [note]
        manifest = {
            "schema_version": "1.0.0",
            "instance_id": instance,
            "archive_revision": revision,
            "source": source,
            "counts": {role: sum(r["row_count"] for r in written[role]) for role in roles},
            "files": [{"order": i, **f} for i, f in enumerate(found, 1)],
        }
        manifest["package_id"] = package_id(manifest)
        files.write(spark, f"{stage}/{MANIFEST}", canonical_bytes(manifest) + b"\n")
        verify_package(spark, stage)
        if not files.exists(spark, home):
            files.rename(spark, stage, home)
        elif verify_package(spark, home)["package_id"] != manifest["package_id"]:
            raise Violation(f"revision {revision} of {instance} is taken by other content")
    finally:
        files.delete(spark, stage)
    publish_index(spark, root, instance)
    return manifest


def content_digest_of(body: bytes) -> str:
    import hashlib

    return hashlib.sha256(body).hexdigest()


# --- verification ------------------------------------------------------------

_FOUND = "package string, path string, bytes bigint, sha256 string, row_count bigint, linked boolean"
_FOUND_SCHEMA = pa.schema([("package", pa.string()), ("path", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("row_count", pa.int64()), ("linked", pa.bool_())])


def _digests(root: str):
    """Files (package, path): what is in them, read a piece at a time."""
    import hashlib

    def linked(package: str, path: str) -> bool:
        fs, inner = files.filesystem(f"{root}/{package}".rstrip("/"))
        if fs.type_name != "local":
            return False
        at = inner
        for step in path.split("/"):
            at = f"{at}/{step}"
            if os.path.islink(at):
                return True
        return False

    def run(batches):
        for batch in batches:
            rows = []
            for package, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where = f"{root}/{package}".rstrip("/")
                total, lines, digest = 0, 0, hashlib.sha256()
                for data, n in files.filled_lines(files.chunks(f"{where}/{path}")):
                    digest.update(data)
                    total, lines = total + len(data), lines + n
                rows.append((package, path, total, digest.hexdigest(), lines, linked(package, path)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_FOUND_SCHEMA), _FOUND_SCHEMA, strict=True)], schema=_FOUND_SCHEMA)

    return run


def file_differences(spark: SparkSession, root: str, manifests: Mapping[str, dict]) -> DataFrame:
    """Files of packages (folders under ``root``) that are not as their manifests state: package, path, problem.

    One full outer join of what is stated with what tasks have read.
    """
    there = [(p, path) for p in manifests for path, _ in files.listed(spark, f"{root}/{p}".rstrip("/")) if path != MANIFEST]
    told = [(p, f["path"], f["bytes"], f["sha256"], f["row_count"], f["order"], i) for p, m in manifests.items() for i, f in enumerate(m["files"], 1)]
    listed = spark.createDataFrame(there, "package string, path string")
    found = listed.repartition(max(1, min(len(there), 4 * spark.sparkContext.defaultParallelism)), "package", "path").mapInArrow(_digests(root), _FOUND)
    stated = spark.createDataFrame(told, "package string, path string, s_bytes bigint, s_sha256 string, s_rows bigint, s_order bigint, place bigint")
    twice = stated.groupBy("package", "path").agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in ("s_bytes", "s_sha256", "s_rows")], F.bool_and(F.col("s_order") == F.col("place")).alias("in_order"))
    problem = (
        F.when(F.col("times").isNull(), "is not listed")
        .when(F.col("bytes").isNull(), "is gone")
        .when(F.col("times") > 1, "is listed twice")
        .when(~F.col("in_order"), "is listed out of order")
        .when(F.col("linked"), "is a link")
        .when((F.col("bytes") != F.col("s_bytes")) | (F.col("sha256") != F.col("s_sha256")), "was changed")
        .when(F.col("row_count") != F.col("s_rows"), "has another number of rows")
    )
    joined = found.join(twice, ["package", "path"], "full_outer")
    return joined.select("package", "path", problem.alias("problem")).where("problem is not null")


def _manifest(spark: SparkSession, folder: str) -> dict:
    """A manifest that has the identity it states, and counts that follow from its files."""
    try:
        made = json.loads(files.read(spark, f"{folder}/{MANIFEST}"))
        sums: dict[str, int] = {}
        for f in made["files"]:
            if f["row_count"] is not None:
                sums[f["role"]] = sums.get(f["role"], 0) + f["row_count"]
        whole = package_id(made) == made["package_id"] and sums == {k: v for k, v in made["counts"].items() if v or k in sums}
    except Exception as error:  # any damage: no document, no object, no such field
        raise Violation(f"{folder}: the manifest cannot be read") from error
    if not whole:
        raise Violation(f"{folder}: the manifest was changed")
    return made


def _require_as_stated(spark: SparkSession, root: str, manifests: Mapping[str, dict]) -> None:
    bad = file_differences(spark, root, manifests).orderBy("package", "path").head(1)
    if bad:
        raise Violation(f"{bad[0]['package'] or root}: {bad[0]['path']} {bad[0]['problem']}")


def verify_package(spark: SparkSession, folder: str) -> dict:
    """Manifest of a package whose identity, listing, digests and counts hold; else aborts."""
    manifest = _manifest(spark, folder.rstrip("/"))
    _require_as_stated(spark, folder.rstrip("/"), {"": manifest})
    return manifest


def verify_store(spark: SparkSession, root: str) -> int:
    """Number of packages of a store whose indexes and packages agree; else aborts. All files are read in one job."""
    root, manifests = root.rstrip("/"), {}
    for instance in files.folders(spark, f"{root}/indexes"):
        rows = indexed(spark, root, instance)
        numbers = [r["archive_revision"] for r in rows]
        if any(b <= a for a, b in zip(numbers, numbers[1:])):
            raise Violation(f"revisions of {instance} do not rise")
        if [f"{n:020d}" for n in numbers] != files.folders(spark, f"{root}/packages/{instance}"):
            raise Violation(f"index and packages of {instance} differ")
        for r in rows:
            at = f"packages/{instance}/{r['archive_revision']:020d}"
            manifests[at] = _manifest(spark, f"{root}/{at}")
            if any(manifests[at][k] != r[k] for k in r) or manifests[at]["instance_id"] != instance:
                raise Violation(f"index and packages of {instance} differ")
    if manifests:
        _require_as_stated(spark, root, manifests)
    return len(manifests)


# --- indexes -----------------------------------------------------------------


def indexed(spark: SparkSession, root: str, instance: str) -> list[dict]:
    """Revisions that an instance's index names; an index of another kind or instance aborts."""
    at = f"{root.rstrip('/')}/indexes/{instance}/index.json"
    if not files.exists(spark, at):
        return []
    document = json.loads(files.read(spark, at))
    if document.get("schema_version") != "1.0.0" or document.get("instance_id") != instance or not isinstance(document.get("revisions"), list):
        raise Violation(f"{at} is no index of {instance}")
    return document["revisions"]


def publish_index(spark: SparkSession, root: str, instance: str) -> None:
    """Make an instance's index, its latest revision and the catalogue again from the packages that are there.

    Packages are the truth: the index follows from them, and only grows. A package
    that the index names and that is gone or has another identity aborts.
    """
    root, rows = root.rstrip("/"), []
    for number in files.folders(spark, f"{root}/packages/{instance}"):
        manifest = _manifest(spark, f"{root}/packages/{instance}/{number}")
        rows.append({k: manifest[k] for k in ("archive_revision", "package_id", "counts")})
    if any(r not in rows for r in indexed(spark, root, instance)):
        raise Violation(f"an indexed package of {instance} is gone or changed")
    for name, document in (("index.json", {"revisions": rows}), ("latest.json", {"revision": rows[-1]})):
        files.write(spark, f"{root}/indexes/{instance}/{name}", canonical_bytes({"schema_version": "1.0.0", "instance_id": instance} | document) + b"\n")
    listed = []
    for each in files.folders(spark, f"{root}/indexes"):
        every = indexed(spark, root, each)
        listed.append({"instance_id": each, "latest_archive_revision": every[-1]["archive_revision"], "latest_package_id": every[-1]["package_id"], "revision_count": len(every)})
    files.write(spark, f"{root}/catalog.json", canonical_bytes({"instances": listed}) + b"\n")
