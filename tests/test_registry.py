import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from recordloom.__main__ import main
from recordloom.operators import checks, registry
from recordloom.sinks import evidence
from recordloom.sources import readers
from recordloom.streaming import seed


def test_requested_and_lookup(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "instance_id string, enabled boolean")
    assert [r.instance_id for r in registry.requested(df, ["b"], "instance_id").collect()] == ["b"]
    with pytest.raises(checks.Violation, match="c"):
        registry.requested(df, ["b", "c"], "instance_id")
    assert [r.instance_id for r in registry.automation_targets(df).collect()] == ["a"]
    with pytest.raises(checks.Violation):
        registry.looked_up(df, df.where("instance_id = 'a'").select("instance_id"), "instance_id")


def test_jurisdictions(spark):
    rules = readers.jurisdiction_rules(spark, {"default": "OTHER", "jurisdictions": {"NSW": ["nsw state"], "VIC": ["vic", "NSW-State"], "OTHER": []}})
    bodies = spark.createDataFrame([("x", ["misc", "NSW_State"], 1), ("y", ["VIC!"], 2), ("z", [], 3), ("x", ["NSW state"], 4)], "slug string, tags array<string>, ord int")
    got = {r.slug: r.jurisdiction for r in registry.body_jurisdictions(bodies.where("ord < 4"), rules).collect()}
    assert got == {"x": "NSW", "y": "VIC", "z": "OTHER"}
    assert [(r.slug, r.ord) for r in registry.bodies_of(bodies, rules, "NSW", "ord").collect()] == [("x", 4)]
    with pytest.raises(checks.Violation):
        readers.jurisdiction_rules(spark, {"default": "NONE", "jurisdictions": {}})


def test_source_graph_aborts_on_strays(spark):
    i = spark.createDataFrame([("nz", "h")], "instance_id string, host string")
    s = spark.createDataFrame([("s", "h")], "site_id string, host string")
    t = spark.createDataFrame([("t", "s"), ("u", "gone")], "target_id string, site_id string")
    with pytest.raises(checks.Violation, match="u"):
        registry.source_graph(i, s, t)
    assert registry.source_graph(i, s, t.limit(1)).first().targets == ["t"]


def test_pointer_and_rules(spark):
    df = spark.createDataFrame([('{"a/b": [{"c": 5}]}',)], "d string")
    assert df.select(registry.pointed(F.col("d"), "/a~1b/0/c")).first()[0] == "5"
    with pytest.raises(ValueError):
        registry.json_path("x")
    rows = spark.createDataFrame([("https://a/request/x", "2020", "", "200")], "original string, timestamp string, digest string, statuscode string")
    assert len(checks.messages(rows, registry.index_row_rules())) == 2
    assert registry.capture_candidates(rows, "a").first().slug == "x" and registry.capture_candidates(rows, "b").count() == 0


def test_pinned_and_latest(spark):
    m = spark.createDataFrame([("k", "u")], "key string, url string")
    assert registry.pinned(m, m, "key", "url").count() == 1
    with pytest.raises(checks.Violation):
        registry.pinned(m, m.union(m), "key", "url")
    a = spark.createDataFrame([(1, True), (2, True), (3, False)], "run int, verified boolean")
    assert registry.latest_verified(a, "run").first().run == 2 and registry.latest_verified(a.where("run = 3"), "run").count() == 0
    assert registry.union_all(m, a).columns == ["key", "run", "url", "verified"]


def test_evidence(spark, tmp_path):
    one, two = evidence.write_versioned(str(tmp_path), "r.json", {"a": 1}, date(2026, 7, 1))
    assert "2026-07" in one and json.loads(open(two).read()) == {"a": 1}
    assert [r["name"] for r in evidence.artifact_rows(str(tmp_path), ["*/r.json", "latest/*"])] == ["2026-07/r.json", "latest/r.json"]
    df = spark.createDataFrame([("NSW", 1, "x"), ("VIC", 2, "y")], "jurisdiction string, id int, _note string")
    evidence.write_split(df, str(tmp_path / "split"), "jurisdiction")
    assert sorted(spark.read.parquet(str(tmp_path / "split")).columns) == ["id", "jurisdiction"]
    assert evidence.input_receipt(spark.read.format("binaryFile").load(str(tmp_path / "latest"))).first().files == 1
    card = evidence.dataset_card("T", ["en"], "cc0", {"rows": 3}, "About.")
    assert card.startswith("---\npretty_name: T") and "| rows | 3 |" in card
    assert evidence.provenance("r", [{"name": "b"}, {"name": "a"}], [], {})["inputs"][0]["name"] == "a"


def test_seed_resumes_retries_and_caps(tmp_path):
    ledger, waits, tries = str(tmp_path / "ledger.jsonl"), [], []

    def capture(request):
        tries.append(request["request_id"])
        if request["request_id"] == 2 and tries.count(2) < 3:
            raise seed.CaptureFailed(1, "Read Timeout")
        return 10

    queue = [{"request_id": i} for i in (1, 2, 3)]
    assert seed.run(queue, capture, ledger, seed.Caps(bytes=15), sleep=waits.append) == {"processed": 2, "failed": 0, "bytes": 20, "stopped_by": "max_bytes"}
    assert waits == [15.0, 30.0]
    assert seed.run(queue, capture, ledger)["processed"] == 1 and seed.completed_ids(ledger) == {"1", "2", "3"}

    def broken(request):
        raise seed.CaptureFailed(124, "timed out")

    with pytest.raises(seed.CaptureFailed):
        seed.run([{"request_id": 9}], broken, ledger, sleep=waits.append)
    assert len(waits) == 2
    assert seed.run([{"request_id": 9}], broken, ledger, keep_going=True)["failed"] == 1


def test_command_line(spark, tmp_path, capsys):
    log = tmp_path / "log.jsonl"
    log.write_text("\n".join(json.dumps(r) for r in [{"event_id": "e1", "case_id": "x:request:7", "activity": "a"}, {"event_id": "e2", "case_id": "x:request:7", "activity": "b", "source_index": 3}]) + "\n")
    doc = tmp_path / "m.json"
    doc.write_text(json.dumps({"meta": {"record_count": 1, "source": "s"}, "requests": [{"request_id": 7, "title": "T"}]}))
    assert main(["project", "--events", str(log), "--output", str(tmp_path / "p"), "--manifest", str(doc)]) == 0
    coverage = json.loads(capsys.readouterr().out)
    assert coverage["event_count"] == 2 and coverage["request_count_reconciles"] and coverage["source_record_count"] == 1
    assert main(["verify", str(tmp_path / "p")]) == 0
    assert main(["merge-manifests", str(doc), str(doc), "--output", str(tmp_path / "m"), "--source", "s"]) == 0
    capsys.readouterr()
    for name in ("c", "e", "a"):
        (tmp_path / name).write_text('{"x":1}\n')
    args = ["package", "--store", str(tmp_path / "store"), "--instance", "nz", "--revision", "1", "--cases", str(tmp_path / "c"), "--events", str(tmp_path / "e"), "--attachments", str(tmp_path / "a"), "--repository", "r", "--repository-revision", "0"]
    assert main(args) == 0 and main(["verify-store", str(tmp_path / "store")]) == 0
    (tmp_path / "c").write_text("{}\n")
    assert main(args) == 1
    assert main(["backfill", "--captured", "10", "--merged", "10000", "--mirror", "10000"]) == 2
    inv = tmp_path / "i.json"
    inv.write_text('["https://a/1", "https://a/2"]')
    capsys.readouterr()
    assert main(["completeness", "--enumerated", str(inv), "--channel", f"one={inv}", "--channel", f"two={inv}"]) == 0
    assert json.loads(capsys.readouterr().out)["redundancy"]["dual"] == 2
