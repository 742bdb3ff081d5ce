"""Further commands: validation of governing documents, discovery, capture, sync, mirrors, replays.

Each takes the parsed arguments and returns a document. ``valid`` false gives exit status 1,
``verified`` false 2, ``healthy`` false 1.
"""

from __future__ import annotations

import json
import shlex
import subprocess
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from . import files
from .functions import replay_json
from .operators import checks, contracts, events, manifest, mirrors, ranges, registry, reverify
from .operators.checks import Violation, event_rules, require, require_unique
from .session import session
from .sinks import bundles, documents, evidence
from .sources import index_api, readers
from .streaming import control, rollout, seed

# --- governing documents -----------------------------------------------------


def _text(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def _judged(problems: list[str]) -> dict:
    return {"valid": not problems, "problems": problems}


def validate_sampling_frame(a) -> dict:
    """Problems of a sampling frame."""
    return _judged(contracts.sampling_frame(session(), _text(a.document)))


def validate_targets(a) -> dict:
    """Problems of a registry of jurisdiction targets."""
    return _judged(contracts.target_registry(session(), _text(a.document)))


def validate_capabilities(a) -> dict:
    """Problems of a capability declaration, against what is supported (a JSON object of lists)."""
    return _judged(contracts.capabilities(session(), _text(a.document), a.schema, json.loads(_text(a.supported))))


def validate_mapping(a) -> dict:
    """Problems of a field mapping."""
    return _judged(contracts.field_mapping(session(), _text(a.document)))


def validate_derived(a) -> dict:
    """Problems of a derived layer's manifest."""
    return _judged(contracts.derived_manifest(session(), _text(a.document), a.contract, a.contract_id, a.provenance))


def validate_changes(a) -> dict:
    """Problems of a change document."""
    return _judged(checks.messages(readers.read_changes(session(), a.document), checks.change_rules()))


def package_derived(a) -> dict:
    """A local bundle of a draft manifest and its candidates."""
    return bundles.package_candidates(session(), a.manifest, a.candidates, a.output, a.baseline)


def verify_derived(a) -> dict:
    """A bundle's statement, if its files are as it says."""
    return bundles.verify_bundle(session(), a.folder)


# --- logs and manifests ------------------------------------------------------


def merge_events(a) -> dict:
    """Shards of an event log as one log in order; two payloads of one revision abort."""
    spark = session()
    shards = [readers.read_events(spark, path).drop("arrival") for path in a.shards]
    log = shards[0]
    for more in shards[1:]:
        log = log.unionByName(more, allowMissingColumns=True)
    merged = require(events.merge_shards(log, payload=F.col("payload")), event_rules()).persist()
    ordered = merged.orderBy("case_id", "source_index", "event_id").select(F.col("payload").cast("string").alias("value"))
    ordered.write.mode("overwrite").text(a.output)
    return {"merged": merged.count(), "output": a.output}


def build_manifest(a) -> dict:
    """Manifest of the request records in a derived folder."""
    spark = session()
    rows = manifest.normalize_records(readers.read_derived(spark, a.derived), hashed=True)
    require_unique(require(rows, [("request without a positive id", F.coalesce(F.col("request_id") < 1, F.lit(True)))]), "request", "request_id")
    document = documents.manifest_document({"source": a.source, "instance_id": a.instance} | ({"jurisdiction": a.jurisdiction.upper()} if a.jurisdiction else {}), rows)
    documents.write_manifest(a.output, document, rows)
    return document["meta"]


# --- discovery and capture ---------------------------------------------------


def discover_bodies(a) -> dict:
    """Bodies of a catalogue archive, with their jurisdictions if rules are given."""
    spark = session()
    found, origin = index_api.parse_catalog(Path(a.archive).read_bytes())
    listed = [b for b in found.get("bodies", []) if isinstance(b, dict)]
    rows = spark.createDataFrame([(b.get("url_name"), b.get("name"), [str(t) for t in b.get("tags") or []]) for b in listed], "slug string, name string, tags array<string>")
    require_unique(require(rows, [("body without a slug", F.coalesce("slug", F.lit("")) == "")]), "body", "slug")
    if a.rules:
        rows = registry.body_jurisdictions(rows, readers.jurisdiction_rules(spark, json.loads(_text(a.rules))))
    document = {"bodies": [r.asDict() for r in rows.orderBy("slug").collect()], "provenance": origin}
    documents.write_json(a.output, document)
    return {"bodies": len(document["bodies"]), "output": a.output}


def run_seed(a) -> dict:
    """Capture a queue with a command, as far as the caps allow; what a ledger has completed is passed over.

    ``{request_id}`` and ``{url_title}`` in the command are filled in; the bytes of its output count.
    Without a command the queue is only counted.
    """
    spark = session()
    queue = readers.read_queue(spark, a.queue)
    if not a.command_line:
        done = readers.read_ledger(spark, a.ledger) if Path(a.ledger).exists() else None
        left = queue if done is None else queue.join(done.select(F.col("request_id").cast("string").alias("_id")).distinct(), F.col("request_id").cast("string") == F.col("_id"), "left_anti")
        return {"queued": queue.count(), "to_capture": left.count()}

    def capture(request: dict) -> int:
        parts = [p.format(**{k: request.get(k) for k in ("request_id", "url_title")}) for p in shlex.split(a.command_line)]
        made = subprocess.run(parts, capture_output=True, timeout=a.timeout, check=False)
        if made.returncode:
            raise seed.CaptureFailed(made.returncode, made.stderr.decode("utf-8", "replace"))
        return len(made.stdout)

    rows = (r.asDict() for r in queue.toLocalIterator())
    return seed.run(rows, capture, a.ledger, seed.Caps(a.max_requests, a.max_bytes, a.max_minutes), a.keep_going)


# --- sync --------------------------------------------------------------------


def run_sync(a) -> dict:
    """Write what a change document brings as the next batch, read it back, then advance the state."""
    spark = session()
    rows = require(readers.read_changes(spark, a.changes), checks.change_rules())
    fresh = manifest.change_rows(rows)
    before = control.load_state(f"{a.folder}/state.json")
    if fresh.isEmpty():
        return {"changed": False, "state": before}
    want = documents.content_digest_of(fresh)
    number = before.get("batch", -1) + 1
    control.sync_batches(a.folder, lambda path: documents.content_digest_of(spark.read.parquet(path)) == want)(fresh, number)
    state = control.load_state(f"{a.folder}/state.json")
    bundles.write_health(f"{a.folder}/sync_health.json", {"batch": number, "rows": want["rows"]}, datetime.now(UTC))
    return {"changed": True, "state": state}


# --- mirrors and health ------------------------------------------------------


def doctor(a) -> dict:
    """Parity of mirrors' counts with the manifest's, in a scope of one instance and jurisdiction."""
    spark = session()
    if Path(a.manifest).exists():
        meta, _ = readers.read_manifest(spark, a.manifest)
        scope = bundles.scoped_count(meta.select(*[F.col(c) if c in meta.columns else F.lit(None).cast("string").alias(c) for c in ("instance_id", "jurisdiction", "generated_at", "record_count")]), a.instance, a.jurisdiction, a.instance)
    else:
        scope = {"record_count": 0, "last_updated": None, "source": "missing"}
    counts = [("local", scope["record_count"]), *[(n, int(c)) for n, _, c in (m.partition("=") for m in a.mirror)]]
    found = mirrors.parity(spark.createDataFrame(counts, "mirror string, n bigint"), tolerance=a.tolerance, per_mille=0)
    rows = [r.asDict() for r in found.orderBy("mirror").collect()]
    report = {"timestamp": datetime.now(UTC).isoformat(), "manifest": scope, "parity": rows, "healthy": all(r["within"] for r in rows)}
    if a.output:
        documents.write_json(a.output, report)
    return report


def publish_verify(a) -> dict:
    """Local artifacts against mirrors' listings (mirror=file); the evidence is kept by month."""
    spark = session()
    local = evidence.artifact_rows(a.root, a.artifact)
    if not local or not a.listing:
        raise Violation("nothing to verify: no artifact, or no mirror's listing")
    short = [(Path(r["name"]).name, r["size"], r["sha256"]) for r in local]
    have = spark.createDataFrame(short, "name string, size bigint, sha256 string")
    listings = spark.createDataFrame([(m, _text(p)) for m, _, p in (x.partition("=") for x in a.listing)], "mirror string, body string")
    remote = mirrors.listed_artifacts(listings).withColumn("sha256", F.regexp_replace("checksum", "^sha256:", "")).persist()
    reports = []
    for name in sorted(x.partition("=")[0] for x in a.listing):
        compared = mirrors.compare_artifacts(have, remote.where(F.col("mirror") == name).select("name", "size", "sha256"))
        reports.append({"mirror": name, "verified": mirrors.mirror_verified(compared).first()["verified"], "artifacts": [r.asDict() for r in compared.orderBy("name").collect()]})
    stated = spark.createDataFrame([(_text(a.manifest),)], "d string").select(replay_json.record_count(F.col("d"))).first()[0] if a.manifest else None
    bundle = {"verified": all(r["verified"] for r in reports), "record_count": stated, "reports": reports}
    evidence.write_versioned(a.output, "mirror_verification.json", bundle, date.fromisoformat(a.month) if a.month else datetime.now(UTC).date())
    return bundle


# --- replays, rollouts, controllers ------------------------------------------


def verify_replay(a) -> dict:
    """Journal, objects and checkpoint of a replay, checked from their bytes."""
    spark = session()
    members = spark.read.text(a.members).where("trim(value) <> ''").select(F.trim("value").alias("member"))
    reverify.require_whole(spark, a.folder, members)
    return {"verified": True, "members": members.count()}


def roll_out(a) -> dict:
    """Publish manifests of jurisdictions (name=file) and their national merge as one version."""
    spark = session()
    given = dict(j.split("=", 1) for j in a.jurisdiction)
    return rollout.roll_out(spark, a.root, a.version, list(given), lambda name: readers.read_manifest(spark, given[name])[1].drop("row"))


def rebuild_state(a) -> dict:
    """Controller batches rebuilt from merge runs (JSON lines: run, label, place; run, seq, record_count)."""
    spark = session()
    state = json.loads(_text(a.state))
    ddl = "label string, id_from bigint, id_to bigint, status string, record_count bigint"
    batches = spark.createDataFrame([(str(b.get("label") or ""), int(b["id_from"]), int(b["id_to"]), b.get("status"), b.get("record_count")) for b in state.get("batches", [])], ddl)
    runs = spark.read.schema("run string, label string, place bigint").json(a.runs)
    merged = spark.read.schema("run string, seq bigint, record_count bigint").json(a.merged)
    rows = ranges.rebuilt_batches(batches, runs, merged).persist()
    cursor = ranges.verified_cursor(rows, int(state.get("id_from") or 1)).first()["next_id"]
    state |= {"batches": [r.asDict() for r in rows.orderBy("id_from", "id_to", "label").collect()], "next_id": cursor, "summary": ranges.controller_summary(rows).first().asDict()}
    files.write(spark, a.output, (json.dumps(state, indent=2, sort_keys=True) + "\n").encode())
    return {"batches": len(state["batches"]), "next_id": cursor, "output": a.output}


NEED, SOME, MANY = {"required": True}, {"default": None}, {"action": "append", "default": []}
_DOCUMENT = (("document", {}),)

COMMANDS = {
    "validate-sampling-frame": (validate_sampling_frame, _DOCUMENT),
    "validate-targets": (validate_targets, _DOCUMENT),
    "validate-capabilities": (validate_capabilities, (*_DOCUMENT, ("--schema", NEED), ("--supported", NEED))),
    "validate-mapping": (validate_mapping, _DOCUMENT),
    "validate-derived": (validate_derived, (*_DOCUMENT, ("--contract", NEED), ("--contract-id", NEED), ("--provenance", MANY))),
    "validate-changes": (validate_changes, _DOCUMENT),
    "package-derived": (package_derived, (("--manifest", NEED), ("--candidates", NEED), ("--output", NEED), ("--baseline", SOME))),
    "verify-derived": (verify_derived, (("folder", {}),)),
    "merge-events": (merge_events, (("shards", {"nargs": "+"}), ("--output", NEED))),
    "build-manifest": (build_manifest, (("--derived", NEED), ("--output", NEED), ("--source", NEED), ("--instance", NEED), ("--jurisdiction", SOME))),
    "discover-bodies": (discover_bodies, (("--archive", NEED), ("--output", NEED), ("--rules", SOME))),
    "seed": (run_seed, (("--queue", NEED), ("--ledger", NEED), ("--command-line", SOME), ("--timeout", {"type": float, "default": 600.0}), ("--max-requests", {"type": int}), ("--max-bytes", {"type": int}), ("--max-minutes", {"type": float}), ("--keep-going", {"action": "store_true"}))),
    "sync": (run_sync, (("--changes", NEED), ("--folder", NEED))),
    "doctor": (doctor, (("--manifest", NEED), ("--instance", NEED), ("--jurisdiction", SOME), ("--mirror", MANY), ("--tolerance", {"type": int, "default": 5}), ("--output", SOME))),
    "publish-verify": (publish_verify, (("--root", NEED), ("--artifact", MANY), ("--listing", MANY), ("--manifest", SOME), ("--output", NEED), ("--month", SOME))),
    "verify-replay": (verify_replay, (("folder", {}), ("--members", NEED))),
    "rollout": (roll_out, (("--root", NEED), ("--version", NEED), ("--jurisdiction", MANY))),
    "rebuild-state": (rebuild_state, (("--state", NEED), ("--runs", NEED), ("--merged", NEED), ("--output", NEED))),
}
