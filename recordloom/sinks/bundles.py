"""Bundles of derived candidates, health and change documents, declared artifacts."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import FORBIDDEN_FIELDS, Violation, unique
from ..operators.manifest import candidate_delta
from ..sources.readers import read_jsonl
from .documents import write_bytes, write_json

# Names inside a bundle, and what a local bundle says of itself.
BUNDLE = "bundle-manifest.json"
PARTS = {"candidates.ndjson", "derived-manifest.json"}
UNPUBLISHED = "not_published"


def load_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates (candidate_id, payload) of JSON lines; missing or repeated ids and raw fields abort."""
    rows = read_jsonl(spark, path)
    keys = F.json_object_keys("value")
    found = rows.select(F.try_variant_get("row", "$.candidate_id", "string").alias("candidate_id"), F.to_json("row").alias("payload"), F.array_intersect(keys, F.array(*map(F.lit, FORBIDDEN_FIELDS))).alias("raw"))
    bad = found.agg(F.count_if(F.coalesce("candidate_id", F.lit("")) == "").alias("nameless"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("raw")))).alias("raw")).first()
    if bad["nameless"] or bad["raw"]:
        raise Violation(f"candidates without an id: {bad['nameless']}; raw fields: {', '.join(bad['raw'])}")
    if not unique(found, "candidate_id").isEmpty():
        raise Violation("candidate is repeated")
    return found.select("candidate_id", "payload")


def delta_note(before: DataFrame, after: DataFrame) -> dict:
    """Counts of both sides and the ids that were added, removed and changed, in order."""
    rows = candidate_delta(before, after, "candidate_id", "payload").groupBy("bucket").agg(F.array_sort(F.collect_list("candidate_id")).alias("ids")).collect()
    lists = {r["bucket"]: list(r["ids"]) for r in rows}
    return {"baseline_count": before.count(), "current_count": after.count()} | {k: lists.get(k, []) for k in ("added", "removed", "changed")}


def _facts(path: Path) -> dict:
    body = path.read_bytes()
    return {"path": path.name, "sha256": hashlib.sha256(body).hexdigest(), "bytes": len(body)}


def package_candidates(spark: SparkSession, manifest: str, candidates: str, folder: str, baseline: str | None = None) -> dict:
    """A local bundle of a draft manifest and its candidates, with what changed since a baseline."""
    stated = json.loads(Path(manifest).read_bytes())
    if stated.get("release_status") != "draft":
        raise Violation("only drafts are packaged locally")
    rows = load_candidates(spark, candidates)
    before = load_candidates(spark, baseline) if baseline else rows.limit(0)
    root = Path(folder)
    for name, source in (("candidates.ndjson", candidates), ("derived-manifest.json", manifest)):
        write_bytes(root / name, Path(source).read_bytes())
    bundle = {"publication_status": UNPUBLISHED, "candidate_status": "candidate", "record_count": rows.count(), "artifacts": [_facts(root / n) for n in sorted(PARTS)], "baseline_delta": delta_note(before, rows)}
    write_json(root / BUNDLE, bundle)
    return bundle


def verify_bundle(spark: SparkSession, folder: str) -> dict:
    """The bundle's statement, if its files, digests and candidates are as it says; else aborts."""
    root = Path(folder)
    bundle = json.loads((root / BUNDLE).read_bytes())
    if bundle.get("publication_status") != UNPUBLISHED:
        raise Violation("a local bundle is not published")
    named = {a.get("path"): a for a in bundle.get("artifacts") or []}
    if set(named) != PARTS or any(not (root / n).is_file() for n in PARTS):
        raise Violation("bundle holds other files than a bundle has")
    changed = [n for n in sorted(PARTS) if named[n] != _facts(root / n)]
    if changed:
        raise Violation(f"bundle file {changed[0]} was changed")
    if load_candidates(spark, str(root / "candidates.ndjson")).count() != bundle.get("record_count"):
        raise Violation("bundle states another number of candidates")
    return {"verified": True, "record_count": bundle["record_count"], "publication_status": UNPUBLISHED}


def declared_artifacts(spark: SparkSession, root: str, declared: dict[str, dict]) -> DataFrame:
    """Files (name, byte_count, sha256) of a declaration, if each is below the root with exactly those bytes; else aborts."""
    base = Path(root)
    for name in declared:
        at = base / name
        if name.startswith("/") or ".." in Path(name).parts or at.is_symlink() or not at.is_file():
            raise Violation(f"declared artifact {name} is not a file below the root")
    wanted = spark.createDataFrame([(n, int(m["byte_count"]), m["sha256"]) for n, m in sorted(declared.items())], "name string, byte_count bigint, sha256 string")
    files = spark.read.format("binaryFile").load([str(base / n) for n in declared])
    found = files.select(F.substring_index("path", f"/{base.name}/", -1).alias("name"), F.col("length").alias("byte_count"), F.sha2("content", 256).alias("sha256"))
    if not wanted.exceptAll(found).isEmpty():
        raise Violation("declared artifacts have other bytes")
    return wanted


def change_document(changes: DataFrame, generated_at: datetime) -> dict:
    """Change document of rows (bucket, request_id, url_title, digests): one list a bucket, in order of id."""
    fields = ["request_id", "url_title", "content_sha256", "previous_sha256"]
    rows = changes.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rows")).collect()
    lists = {r["bucket"]: [x.asDict() for x in r["rows"]] for r in rows}
    return {"meta": {"generated_at": generated_at.isoformat()}} | {k: lists.get(k, []) for k in ("added", "updated", "removed")}


def write_health(path: str, summary: dict, now: datetime) -> None:
    """A small health document of the last synchronisation."""
    write_json(path, {"timestamp": now.isoformat(), "sync": summary})


def scoped_count(meta: DataFrame, instance: str, jurisdiction: str | None = None, default: str | None = None) -> dict:
    """Records of a manifest's meta row if it is of the instance and jurisdiction, else none and why."""
    row = meta.first()
    if row is None:
        return {"record_count": 0, "last_updated": None, "source": "missing"}
    same = (row["instance_id"] or default) == instance and (jurisdiction is None or row["jurisdiction"] == jurisdiction.upper())
    if not same:
        return {"record_count": 0, "last_updated": None, "source": "scope-mismatch"}
    return {"record_count": row["record_count"] or 0, "last_updated": row["generated_at"], "source": "local"}
