"""Commands from their arguments to exit status, output and files."""

import hashlib
import io
import json
import zipfile
from datetime import UTC, datetime

import pytest

from recordloom.__main__ import main
from recordloom.streaming import control, rollout


@pytest.fixture
def run(spark, capsys, tmp_path):
    def call(*argv):
        status = main([str(a) for a in argv])
        out = capsys.readouterr().out
        return status, json.loads(out) if out.strip().startswith("{") else None

    return call


def put(path, *rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return path


def document(path, value):
    path.write_text(json.dumps(value))
    return path


def test_documents_are_judged(run, tmp_path):
    bad = document(tmp_path / "bad.json", {})
    supported = document(tmp_path / "s.json", {"profiles": ["a"]})
    for name, more in (("validate-sampling-frame", ()), ("validate-targets", ()), ("validate-mapping", ()), ("validate-capabilities", ("--schema", "x", "--supported", supported)), ("validate-derived", ("--contract", "c", "--contract-id", "i"))):
        status, found = run(name, bad, *more)
        assert status == 1 and found["valid"] is False and found["problems"]
    d = "a" * 64
    good = document(tmp_path / "c.json", {"added": [{"request_id": 1, "url_title": "a", "content_sha256": d}], "removed": [{"request_id": 2, "url_title": "b"}]})
    assert run("validate-changes", good) == (0, {"valid": True, "problems": []})
    assert run("validate-changes", tmp_path / "absent")[1]["valid"]
    assert run("validate-changes", document(tmp_path / "c2.json", {"added": [{"request_id": 0, "url_title": "a"}]}))[0] == 1


def test_derived_bundle(run, tmp_path):
    stated, rows = document(tmp_path / "m.json", {"release_status": "draft"}), put(tmp_path / "c", {"candidate_id": "a"}, {"candidate_id": "b"})
    assert run("package-derived", "--manifest", stated, "--candidates", rows, "--output", tmp_path / "b")[1]["record_count"] == 2
    assert run("verify-derived", tmp_path / "b")[1]["verified"]
    (tmp_path / "b/candidates.ndjson").write_text("{}\n")
    assert run("verify-derived", tmp_path / "b")[0] == 1


def test_merged_log(run, tmp_path, spark):
    event = lambda i, **kw: {"event_id": f"e{i}", "case_id": f"c{i % 2}", "activity": "a", "source_index": i} | kw
    one, two = put(tmp_path / "1.jsonl", event(3), event(1)), put(tmp_path / "2.jsonl", event(2), event(1))
    assert run("merge-events", one, two, "--output", tmp_path / "out") == (0, {"merged": 3, "output": str(tmp_path / "out")})
    assert [json.loads(r.value)["event_id"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["e2", "e1", "e3"]
    assert run("merge-events", one, put(tmp_path / "3.jsonl", event(1, activity="b")), "--output", tmp_path / "o2")[0] == 1


def test_manifest_doctor_and_rollout(run, tmp_path, spark):
    for name, ids in (("nsw", (1, 2)), ("vic", (2, 3, 4))):
        (tmp_path / name).mkdir()
        for i in ids:
            document(tmp_path / name / f"{i}.json", {"id": i, "title": f"{name} {i}", "state": "open"})
        status, meta = run("build-manifest", "--derived", tmp_path / name, "--output", tmp_path / f"{name}-m", "--source", "s", "--instance", "au", "--jurisdiction", name)
        assert status == 0 and meta["record_count"] == len(ids) and meta["jurisdiction"] == name.upper()
    at = tmp_path / "nsw-m/latest_manifest.json"
    assert run("doctor", "--manifest", at, "--instance", "au", "--jurisdiction", "nsw", "--mirror", "a=2", "--mirror", "b=7")[1]["healthy"]
    status, found = run("doctor", "--manifest", at, "--instance", "au", "--mirror", "b=8", "--output", tmp_path / "h.json")
    assert status == 1 and found["parity"][0]["difference"] == 6 and json.loads((tmp_path / "h.json").read_text())["manifest"]["source"] == "local"
    assert run("doctor", "--manifest", at, "--instance", "au", "--jurisdiction", "vic")[1]["manifest"]["source"] == "scope-mismatch"
    assert run("doctor", "--manifest", tmp_path / "none", "--instance", "au")[1]["manifest"]["source"] == "missing"
    root = tmp_path / "roll"
    status, held = run("rollout", "--root", root, "--version", "1", "--jurisdiction", f"NSW={at}", "--jurisdiction", f"VIC={tmp_path}/vic-m/latest_manifest.json")
    assert status == 0 and held["tables"]["national"]["rows"] == 4
    assert {r.request_id: r.title for r in rollout.table(spark, str(root)).collect()}[2] == "vic 2"


def test_bodies_from_a_catalogue(run, tmp_path):
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("discovered_bodies.json", json.dumps({"bodies": [{"url_name": "b", "name": "B", "tags": ["NSW state"]}, {"url_name": "a", "name": "A", "tags": []}]}))
        z.writestr("discovered_bodies.provenance.json", json.dumps({"from": "test"}))
    (tmp_path / "c.zip").write_bytes(made.getvalue())
    rules = document(tmp_path / "r.json", {"jurisdictions": {"NSW": ["nsw_state"], "OTHER": []}, "default": "OTHER"})
    assert run("discover-bodies", "--archive", tmp_path / "c.zip", "--output", tmp_path / "b.json", "--rules", rules)[1]["bodies"] == 2
    held = json.loads((tmp_path / "b.json").read_text())
    assert [b["slug"] for b in held["bodies"]] == ["a", "b"] and held["provenance"] == {"from": "test"}


def test_seed_and_sync(run, tmp_path):
    queue = put(tmp_path / "q.jsonl", *({"request_id": i, "url_title": f"t{i}"} for i in (1, 2, 3)))
    ledger = tmp_path / "ledger.jsonl"
    assert run("seed", "--queue", queue, "--ledger", ledger)[1] == {"queued": 3, "to_capture": 3}
    status, found = run("seed", "--queue", queue, "--ledger", ledger, "--command-line", "echo {request_id}-{url_title}", "--max-requests", 2)
    assert status == 0 and (found["processed"], found["stopped_by"], found["bytes"]) == (2, "max_requests", 10)
    assert run("seed", "--queue", queue, "--ledger", ledger)[1] == {"queued": 3, "to_capture": 1}
    assert run("seed", "--queue", queue, "--ledger", ledger, "--command-line", "false", "--keep-going")[1]["failed"] == 1
    changes = document(tmp_path / "c.json", {"added": [{"request_id": 1, "url_title": "a", "content_sha256": "a" * 64}]})
    assert run("sync", "--changes", changes, "--folder", tmp_path / "s")[1]["state"]["batch"] == 0
    assert run("sync", "--changes", changes, "--folder", tmp_path / "s")[1]["state"]["batch"] == 1
    assert run("sync", "--changes", tmp_path / "none", "--folder", tmp_path / "s")[1] == {"changed": False, "state": json.loads((tmp_path / "s/state.json").read_text())}


def test_mirrors_are_verified(run, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.bin").write_bytes(b"abc")
    digest = hashlib.sha256(b"abc").hexdigest()
    z = document(tmp_path / "z.json", {"files": [{"key": "x/a.bin", "filesize": 3, "checksum": "md5:0"}]})
    o = document(tmp_path / "o.json", {"data": [{"attributes": {"name": "a.bin", "size": 3, "extra": {"hashes": {"sha256": digest}}}}]})
    m = document(tmp_path / "m.json", {"meta": {"record_count": 5}})
    args = ["publish-verify", "--root", tmp_path, "--artifact", "d/*", "--manifest", m, "--output", tmp_path / "v", "--month", "2024-05-01"]
    status, found = run(*args, "--listing", f"zenodo={z}", "--listing", f"osf={o}")
    assert status == 0 and found["verified"] and found["record_count"] == 5
    assert {r["mirror"]: r["artifacts"][0]["checksum_matches"] for r in found["reports"]} == {"zenodo": None, "osf": True}
    assert json.loads((tmp_path / "v/2024-05/mirror_verification.json").read_text()) == found
    document(tmp_path / "o.json", {"data": [{"attributes": {"name": "a.bin", "size": 4}}]})
    assert run(*args, "--listing", f"osf={o}")[0] == 2
    assert run(*args)[0] == 1


def test_replay_and_state(run, tmp_path):
    members = put(tmp_path / "members", "m1", "m2")
    folder = tmp_path / "r"
    policy = {"floor_seconds": 0.0, "ceiling_seconds": 1.0, "decay_factor": 1.0, "backoff_multiplier": 1.0, "jitter_fraction": 0.0, "window_size": 1, "minimum_window": 1, "failure_ratio": 2.0, "circuit_consecutive_failures": 9, "circuit_seconds": 1.0}
    control.replay(str(folder), ["m1", "m2"], lambda m: ("complete", m.encode(), None), policy, lambda: datetime(2024, 1, 1, tzinfo=UTC))
    assert run("verify-replay", folder, "--members", members) == (0, {"verified": True, "members": 2})
    (folder / "checkpoint.json").write_text('{"states": {}}')
    assert run("verify-replay", folder, "--members", members)[0] == 1
    state = document(tmp_path / "state.json", {"id_from": 1, "batches": [{"label": "1-10", "id_from": 1, "id_to": 10}, {"label": "11-20", "id_from": 11, "id_to": 20}]})
    runs, merged = put(tmp_path / "runs", {"run": "a", "label": "1-10", "place": 0}), put(tmp_path / "merged", {"run": "a", "seq": 1, "record_count": 7})
    status, found = run("rebuild-state", "--state", state, "--runs", runs, "--merged", merged, "--output", tmp_path / "new.json")
    held = json.loads((tmp_path / "new.json").read_text())
    assert status == 0 and found["next_id"] == 11 and held["batches"][0]["record_count"] == 7 and held["summary"]["pending_batches"] == 1
