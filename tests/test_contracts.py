"""Governing documents, derived bundles, the published projection."""

import json
from datetime import UTC, datetime

import pytest

from recordloom import __main__ as cli
from recordloom.operators import checks, contracts
from recordloom.sinks import bundles


def put(path, *rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n", encoding="utf-8")
    return str(path)


def frame(**kw):
    strata = [{"jurisdiction": j, "outcomes": ["access"], "request_cap": 5} for j in ("FEDERAL", "NSW")]
    return json.dumps({"capture_authorized": True, "publication_authorized": False, "private_hf_retention_authorized": True, "strata": strata, "operator_authorization": {"authorized_by": "a", "authorized_at": "b", "scope": "c"}, "rights_gates": dict.fromkeys(contracts.RIGHTS, True)} | kw)


def test_sampling_frame(spark):
    assert contracts.sampling_frame(spark, frame()) == []
    bad = frame(capture_authorized=False, strata=[{"jurisdiction": "XX", "outcomes": ["never"], "request_cap": 0}], rights_gates={})
    assert len(contracts.sampling_frame(spark, bad)) == 1 + len(contracts.RIGHTS) + 4
    assert "strata is no list with elements" in contracts.sampling_frame(spark, frame(strata=[]))
    with pytest.raises(checks.Violation):
        contracts.sampling_frame(spark, "[1]")


def test_target_registry(spark):
    evidence = dict.fromkeys(contracts.TARGET_EVIDENCE, "x")
    good = {"publication_allowed": False, "evidence_defaults": evidence, "targets": [{"target_id": "a", "status": "blocked", "evidence": {}, "blocker": "b"}, {"target_id": "b", "status": "archived", "evidence": {"manifest_sha256": "m", "capture_revision": "r"}}]}
    assert contracts.target_registry(spark, json.dumps(good)) == []
    bad = {"targets": [{"target_id": "a", "status": "archived"}, {"target_id": "a", "status": "gone"}]}
    found = contracts.target_registry(spark, json.dumps(bad))
    assert {"publication must stay disallowed", "target_id is repeated", "target of an unknown status", "archived target without its manifest and revision"} <= set(found)


def test_capabilities_and_mapping(spark):
    known = {"event": ["v1"]}
    doc = {"schema_version": "s", "consumer_id": "c", "capabilities": [{"contract_id": "event", "supported_versions": ["v1"]}]}
    assert contracts.capabilities(spark, json.dumps(doc), "s", known) == []
    doc["capabilities"] = [{"contract_id": "event", "supported_versions": ["v2"], "unknown_version_behavior": "accept"}, {"contract_id": "other"}]
    assert len(contracts.capabilities(spark, json.dumps(doc), "t", known)) == 4
    entry = {"classification": "exact", "native_field": "n", "riopa_field": "r", "rationale": "w", "evidence_fixture": "f.json#/a/b"}
    mapping = {"schema_version": "1.0.0", "source_revision": "0" * 40, "repository": "r", "profile_version": "p", "mappings": [entry, entry | {"native_field": "m", "classification": "unmapped", "riopa_field": None}]}
    assert contracts.field_mapping(spark, json.dumps(mapping)) == []
    got = {r.native_field: (r.native_value, r.projected_value) for r in contracts.projected_fields(spark, json.dumps(mapping), '{"a": {"b": [1]}}').collect()}
    assert got == {"n": ("[1]", "[1]"), "m": ("[1]", None)}
    mapping["mappings"] = [entry, entry | {"riopa_field": None}]
    assert contracts.field_mapping(spark, json.dumps(mapping)) == ["mapping without its target", "native_field is repeated"]


def test_replay_policy_checkpoint_selection(spark):
    policy = {"floor_seconds": 1, "ceiling_seconds": 9, "backoff_multiplier": 2, "jitter_fraction": 0, "decay_factor": 1, "window_size": 9, "minimum_window": 9, "failure_ratio": 1, "circuit_consecutive_failures": 2, "circuit_seconds": 5}
    row = lambda **kw: spark.createDataFrame([tuple(map(float, (policy | kw).values()))], list(policy))
    assert checks.messages(row(), contracts.replay_policy_rules()) == []
    assert checks.messages(row(floor_seconds=10, window_size=2.5, decay_factor=0), contracts.replay_policy_rules()) == ["floor exceeds ceiling", "decay outside (0, 1]", "window_size is no positive whole number", "least window exceeds the window"]
    members = spark.createDataFrame([("a",), ("b",)], "member_id string")
    states = spark.createDataFrame([("a", "complete"), ("b", "pending")], "member_id string, state string")
    assert contracts.checkpoint_problems(states, members, {"population": 2, "complete": 1, "pending": 1}) == []
    assert len(contracts.checkpoint_problems(states.withColumnRenamed("member_id", "x").selectExpr("concat(x, 'z') as member_id", "'lost' as state"), members, {"population": 2})) == 2
    chosen, missing = spark.createDataFrame([("a", "json"), ("b", "html")], "slug string, kind string"), spark.createDataFrame([("c",)], "slug string")
    assert contracts.selection_problems(chosen, missing, 3, {"json": 1, "html": 1}) == []
    assert len(contracts.selection_problems(chosen, missing.unionByName(chosen.select("slug")), 3, {"json": 2})) == 3


def test_derived_bundle(spark, tmp_path):
    manifest = put(tmp_path / "m.json", {"release_status": "draft"})
    now, old = put(tmp_path / "c.ndjson", {"candidate_id": "a", "v": 1}, {"candidate_id": "b", "v": 2}), put(tmp_path / "o.ndjson", {"v": 3, "candidate_id": "b"}, {"candidate_id": "z"})
    made = bundles.package_candidates(spark, manifest, now, str(tmp_path / "b"), old)
    assert made["baseline_delta"] == {"baseline_count": 2, "current_count": 2, "added": ["a"], "removed": ["z"], "changed": ["b"]}
    assert bundles.verify_bundle(spark, str(tmp_path / "b"))["record_count"] == 2
    (tmp_path / "b/candidates.ndjson").write_text("{}\n")
    with pytest.raises(checks.Violation):
        bundles.verify_bundle(spark, str(tmp_path / "b"))
    for bad in ({"candidate_id": ""}, {"candidate_id": "x", "ocr_text": "t"}):
        with pytest.raises(checks.Violation):
            bundles.load_candidates(spark, put(tmp_path / "bad.ndjson", bad))
    with pytest.raises(checks.Violation):
        bundles.package_candidates(spark, put(tmp_path / "v.json", {"release_status": "verified"}), now, str(tmp_path / "x"))


def test_declared_artifacts_changes_and_scope(spark, tmp_path):
    import hashlib

    (tmp_path / "a.txt").write_bytes(b"abc")
    stated = {"a.txt": {"byte_count": 3, "sha256": hashlib.sha256(b"abc").hexdigest()}}
    assert bundles.declared_artifacts(spark, str(tmp_path), stated).count() == 1
    for bad in ({"a.txt": {"byte_count": 4, "sha256": "0"}}, {"../a.txt": stated["a.txt"]}, {"b": stated["a.txt"]}):
        with pytest.raises(checks.Violation):
            bundles.declared_artifacts(spark, str(tmp_path), bad)
    rows = spark.createDataFrame([("added", 2, "b", "d", None), ("added", 1, "a", "c", None)], "bucket string, request_id int, url_title string, content_sha256 string, previous_sha256 string")
    doc = bundles.change_document(rows, datetime(2024, 1, 1, tzinfo=UTC))
    assert [r["request_id"] for r in doc["added"]] == [1, 2] and doc["removed"] == []
    meta = spark.createDataFrame([("nz", "AU", 7, "t")], "instance_id string, jurisdiction string, record_count int, generated_at string")
    assert bundles.scoped_count(meta, "nz", "au")["record_count"] == 7
    assert bundles.scoped_count(meta, "other")["source"] == "scope-mismatch" and bundles.scoped_count(meta.limit(0), "nz")["source"] == "missing"


def test_project_with_attachments(spark, tmp_path):
    log = put(tmp_path / "log.jsonl", {"event_id": "e1", "case_id": "c1", "activity": "a", "source_order": {"request_sequence": 7}}, {"event_id": "e2", "case_id": "c2", "activity": "a", "source_order": {"request_sequence": 8}})
    files = put(tmp_path / "att.jsonl", {"case_id": "c1", "name": "f"}, {"case_id": "c2", "name": "g"})
    gone = put(tmp_path / "gone.jsonl", {"case_id": "c2"})
    manifest = put(tmp_path / "m.json", {"meta": {"source": "https://s.test/", "record_count": 1, "captured_at": "t"}, "requests": [{"request_id": 7, "url_title": "x", "attachments": [{"name": "f"}], "state": "open"}]})
    note = put(tmp_path / "note.json", {"schema": "s", "candidate_count": 4, "other": 1})
    out = str(tmp_path / "out")
    assert cli.main(["project", "--events", log, "--output", out, "--takedowns", gone, "--manifest", manifest, "--attachments", files, "--source-reconciliation", note]) == 0
    assert cli.main(["verify", out]) == 0
    coverage = json.loads((tmp_path / "out/coverage.json").read_text())
    assert (coverage["attachment_count"], coverage["manifest_attachment_count"], coverage["attachment_count_reconciles"], coverage["source_record_count"]) == (1, 1, True, 1)
    assert coverage["takedown_ids"] == ["c2"] and coverage["source_events"] == ["log.jsonl"] and coverage["source_reconciliation"] == {"schema": "s", "candidate_count": 4, "counts": {}}
    record = spark.read.parquet(f"{out}/source_records.parquet").first()
    assert (record.canonical_url, record.attachment_count, record.source_state, record.raw_material_location) == ("https://s.test/request/x", 1, "open", "canonical_archive")
    assert spark.read.parquet(f"{out}/revisions.parquet").first().captured_at == "t"
    (tmp_path / "out/coverage.json").write_text("{}")
    assert cli.main(["verify", out]) == 1
    assert cli.main(["project", "--events", log, "--output", out, "--manifest", manifest, "--attachments", put(tmp_path / "v.jsonl", {"case_id": "c", "contract_version": "9"})]) == 1
