import base64
import io
import json
import zipfile
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recordloom.operators import checks, discovery, events
from recordloom.sinks import documents
from recordloom.sources import index_api, readers
from recordloom.streaming import control, event_log, leases


def put(path, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf-8")
    return str(path)


def test_event_shards(spark, tmp_path):
    put(tmp_path / "log/001.jsonl", {"event_id": "e2", "case_id": "c1", "activity": "a", "source_index": 2}, "")
    put(tmp_path / "log/002.jsonl", {"event_id": "e1", "logical_request_id": "urn:x:request:7", "activity": "a", "source_order": {"event_sequence": 1, "request_sequence": 7}})
    got = {r.event_id: r for r in readers.read_events(spark, str(tmp_path / "log")).collect()}
    assert (got["e1"].case_id, got["e1"].source_index, got["e1"].request_id, got["e1"].revision, got["e1"].logical_id) == ("urn:x:request:7", 1, 7, 1, "e1")
    assert got["e2"].source_index == 2


@pytest.mark.parametrize("line", ["{", "[1]", "7"])
def test_bad_lines_abort(spark, tmp_path, line):
    with pytest.raises(checks.Violation):
        readers.read_jsonl(spark, put(tmp_path / "x.jsonl", {"a": 1}, line))


def test_takedowns_ledger_queue(spark, tmp_path):
    t = put(tmp_path / "t.jsonl", {"case_id": "c"}, {"case_id": "", "event_id": "e"}, {"id": 7}, {"case_id": 5, "event_id": "z"})
    assert sorted(r.id for r in readers.read_takedowns(spark, t).collect()) == ["c", "e"]
    done = put(tmp_path / "l.jsonl", {"request_id": 3, "status": "completed"}, {"request_id": "4", "status": "failed"})
    assert [r.request_id for r in readers.read_ledger(spark, done).collect()] == ["3"]
    with pytest.raises(checks.Violation):
        readers.read_queue(spark, put(tmp_path / "q.jsonl", {"title": "no id"}))
    with pytest.raises(checks.Violation, match="exceeds"):
        readers.read_queue(spark, put(tmp_path / "big.jsonl", {"request_id": 1, "title": "x" * readers.MAX_QUEUE_LINE}))


def test_derived_records(spark, tmp_path):
    put(tmp_path / "d/1.json", {"request_id": 1, "title": "A"})
    put(tmp_path / "d/requests/42/request.json", {"title": "B", "authority": "X"})
    put(tmp_path / "d/requests/42/attachments.json", json.dumps([{"name": "f.pdf", "size": 3}]))
    put(tmp_path / "d/requests/42/snapshot_meta.json", json.dumps({"resources": [{"warc_record_id": "w1"}, {}]}))
    put(tmp_path / "d/requests/42/page.html", "<p>")
    got = {r.request_id: r for r in readers.read_derived(spark, str(tmp_path / "d")).collect()}
    assert got[1].title == "A" and got[1].html_captured is False and got[1].attachments == []
    assert (got[42].title, got[42].html_captured, got[42].warc_record_ids, got[42].attachments[0].name) == ("B", True, ["w1"], "f.pdf")


def test_manifest(spark, tmp_path):
    doc = {"meta": {"source": "s", "record_count": 2}, "requests": [{"request_id": 1, "title": "A"}, {"request_id": 2, "authority": "B"}]}
    meta, rows = readers.read_manifest(spark, put(tmp_path / "m.json", json.dumps(doc, indent=1)))
    assert meta.first().record_count == 2 and [r.request_id for r in rows.orderBy("row").collect()] == [1, 2]


@pytest.mark.parametrize("body", ['["https://a/1", {"url": "https://a/2"}]', '{"rows": [{"original": "https://a/1"}, {"request_url": "https://a/2"}]}', '{"url": "https://a/1"}\n{"url": "https://a/2"}', '[["original", "timestamp"], ["https://a/1", "2020"], ["https://a/2"]]'])
def test_inventory_shapes(spark, tmp_path, body):
    (tmp_path / "i.json").write_text(body, encoding="utf-8")
    assert sorted(r.url for r in readers.read_inventory(spark, str(tmp_path / "i.json")).collect()) == ["https://a/1", "https://a/2"]


def test_inventory_without_address_aborts(spark, tmp_path):
    (tmp_path / "i.json").write_text('[{"title": "x"}]', encoding="utf-8")
    with pytest.raises(checks.Violation):
        readers.read_inventory(spark, str(tmp_path / "i.json"))


def test_historical_sources_merge(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿request_url,title,public_body_name,display_status,created_at\nhttps://A.test/request/x/?fbclid=1,T,Body,open,2020\nnot-a-url,,,,\n", encoding="utf-8")
    put(tmp_path / "c.json", json.dumps([["original", "timestamp", "digest"], ["https://a.test/request/x", "20200101", "D"], ["https://a.test/request/y"], {"original": "https://a.test/request/z", "digest": "E"}]))
    put(tmp_path / "f.json", json.dumps({"entries": [{"id": 5, "url": "https://a.test/request/y", "title": "Y", "public_body": {"name": "PB"}, "state": "open"}, 3]}))
    (tmp_path / "a.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>1</id><title>At</title><updated>u</updated><link href="https://a.test/request/w"/></entry></feed>', encoding="utf-8")
    put(tmp_path / "s.json", json.dumps({"data": {"records": [{"request_url": "https://a.test/request/v", "subject": "S"}]}}))
    (tmp_path / "s.tsv").write_text("url\ttitle\nhttps://a.test/request/u\tU\n", encoding="utf-8")
    parts = [("m.csv", "morph", 1), ("c.json", "internet_archive_cdx", 3), ("f.json", "alaveteli_feed_json", 1), ("a.xml", "alaveteli_atom", 1), ("s.json", "official_dataset", 1), ("s.tsv", "operator_export", 1)]
    frames = []
    for doc, (name, kind, n) in enumerate(parts):
        records, origin = readers.read_historical(spark, str(tmp_path / name), kind, doc)
        assert origin.first().record_count == n, name
        frames.append(records)
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    got = {r.source_url.rsplit("/", 1)[1]: r for r in discovery.merge_sources(every).collect()}
    assert sorted(got) == ["u", "v", "w", "x", "y", "z"]
    assert got["x"].title == "T" and got["x"].internet_archive_digests == ["D"] and got["y"].authority == "PB" and got["w"].title == "At" and got["v"].title == "S"
    with pytest.raises(ValueError):
        readers.read_historical(spark, "x", "unknown")


def test_index_pages(spark):
    class Fake:
        """Opener over fixed pages; defined here so that it travels by value."""

        def __init__(self, pages):
            self.pages = pages

        def __call__(self, params):
            if params.get("showNumPages"):
                return [["numpages"], [str(len(self.pages))]]
            return [index_api.FIELDS, *self.pages[int(params["page"])]]

    pages = [[["https://a/1", "20200101", "d1", "200", "5"]], [["https://a/2", "20200102", "d2", "200", "6"]]]
    got = index_api.read_index(spark, Fake(pages), "a/*", max_pages=5).orderBy("page").collect()
    assert [(r.page, r.original) for r in got] == [(0, "https://a/1"), (1, "https://a/2")]
    with pytest.raises(Exception, match="cap"):
        index_api.read_index(spark, Fake(pages), "a/*", max_pages=1).collect()


def test_index_retries_and_resume():
    calls = []

    def flaky(params):
        calls.append(params)
        if len(calls) < 3:
            raise index_api.Refused(503)
        return "ok"

    assert index_api.fetch({}, flaky, 1e9, sleep=lambda s: None, clock=lambda: 0.0) == "ok"
    with pytest.raises(index_api.Refused):
        index_api.fetch({}, lambda p: (_ for _ in ()).throw(index_api.Refused(400)), 1e9, sleep=lambda s: None, clock=lambda: 0.0)
    answers = iter([[["h"], ["r1"], [], ["key"]], [["h"], ["r2"]]])
    assert [c for c in index_api.resume_chunks("a", 1, lambda p: next(answers), 1e12)] == [([["r1"]], "key"), ([["r2"]], None)]
    with pytest.raises(ValueError):
        index_api.time_range("2021", "2020")
    assert index_api.time_range("2020", "202001") == {"from": "2020", "to": "202001"}


def test_catalog_archive():
    def pack(**files):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            for n, t in files.items():
                z.writestr(n, t)
        return b.getvalue()

    assert index_api.parse_catalog(pack(**{"a": '{"x":1}'}), ("a",)) == [{"x": 1}]
    for bad in (b"junk", pack(a='{"x":1,"x":2}'), pack(a="[]"), pack(b="{}")):
        with pytest.raises(ValueError):
            index_api.parse_catalog(bad, ("a",))


def test_projection_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("c", 1), ("d", 2)], "case_id string, n bigint")
    one = documents.write_projection(str(tmp_path / "p"), {"cases": df, "none": df.limit(0)}, {"event_count": 2}, "x")
    two = documents.write_projection(str(tmp_path / "q"), {"cases": df.repartition(3), "none": df.limit(0)}, {"event_count": 2}, "x")
    assert one == two
    assert documents.verify_projection(spark, str(tmp_path / "p")) == {"event_count": 2}
    documents.write_table(df.limit(1), str(tmp_path / "p/cases.parquet"))
    with pytest.raises(checks.Violation):
        documents.verify_projection(spark, str(tmp_path / "p"))
    bad = documents.write_projection(str(tmp_path / "r"), {"cases": df}, {"request_count_reconciles": False}, "x")
    assert bad
    with pytest.raises(checks.Violation):
        documents.verify_projection(spark, str(tmp_path / "r"))
    assert documents.checksums(spark, str(tmp_path / "p")).count() >= 3


def test_objects_ledger_manifest(spark, tmp_path):
    import hashlib

    body = b"abc"
    df = spark.createDataFrame([(hashlib.sha256(body).hexdigest(), bytearray(body))] * 2, "sha256 string, body binary")
    assert documents.store_objects(df, str(tmp_path / "o")) == 1
    with pytest.raises(Exception, match="does not match"):
        documents.store_objects(spark.createDataFrame([("0" * 64, bytearray(body))], "sha256 string, body binary"), str(tmp_path / "o"))
    documents.append_ledger(spark.createDataFrame([(1, "completed")], "request_id int, status string"), str(tmp_path / "ledger"))
    assert readers.read_ledger(spark, str(tmp_path / "ledger")).count() == 1
    rows = spark.createDataFrame([(2, "B"), (1, "A")], "request_id bigint, authority string")
    doc = documents.manifest_document({"source": "s"}, rows)
    assert doc["meta"]["record_count"] == 2 and doc["requests"][0]["request_id"] == 1
    documents.write_manifest(str(tmp_path / "m"), doc, rows)
    documents.export_table(spark, str(tmp_path / "m/latest_manifest.parquet"), "requests_test")
    assert spark.sql("SELECT count(*) FROM requests_test").first()[0] == 2
    assert documents.descriptors("n", "d", "s", "1", 2, "l", "h")["schema.org.jsonld"]["size"] == 2


def test_leases(spark):
    s = leases.reserve(leases.empty(spark), 10, 0, 4, 1)
    # asking again for one's own lease changes nothing, whatever else its row holds
    assert leases.reserve(s.withColumn("receipt", F.lit("note")), 10, 0, 4, 1).count() == 1
    for bad in ((4, 2, 2), (2, 2, 1), (9, 5, 3), (0, 0, 3), (0, 1, 0)):
        with pytest.raises(checks.Violation):
            leases.reserve(s, 10, *bad)
    with pytest.raises(checks.Violation):
        leases.complete(s, 1, 0, 3)
    s = leases.complete(s, 1, 0, 4, "r")
    assert leases.next_offset(s) == 4
    with pytest.raises(checks.Violation):
        leases.reserve(s, 10, 3, 2, 2)
    s = leases.reserve(s, 10, 4, 6, 2)
    with pytest.raises(checks.Violation):
        leases.abandon(s, 2, 4, 6, "failure", "", "d")
    s = leases.abandon(s, 2, 4, 6, "failure", "u", "d")
    assert sorted(r.role for r in s.collect()) == ["done", "failed"] and leases.next_offset(s) == 4


def test_replay_resumes(tmp_path):
    policy = {"floor_seconds": 1, "ceiling_seconds": 9, "backoff_multiplier": 2, "jitter_fraction": 0, "decay_factor": 1, "window_size": 9, "minimum_window": 9, "failure_ratio": 1, "circuit_consecutive_failures": 2, "circuit_seconds": 5}
    t = datetime(2024, 1, 1, tzinfo=UTC)
    seen = []

    def observe(ok):
        def run(m):
            seen.append(m)
            return ("complete", m.encode(), None) if ok or m == "a" else ("retryable", None, "3")

        return run

    first = control.replay(str(tmp_path), ["a", "b", "c", "d"], observe(False), policy, lambda: t)
    assert first == {"a": "complete", "b": "retryable", "c": "retryable", "d": "pending"}
    again = control.replay(str(tmp_path), ["a", "b", "c", "d"], observe(True), policy, lambda: t + timedelta(minutes=1))
    assert set(again.values()) == {"complete"} and seen.count("a") == 1
    lines = [json.loads(x) for x in (tmp_path / "journal.jsonl").read_text().splitlines()]
    assert [x["sequence"] for x in lines] == list(range(6)) and lines[1]["previous_entry_sha256"] == lines[0]["entry_sha256"]


def test_open_circuit_survives_a_restart(tmp_path):
    policy = {"floor_seconds": 1, "ceiling_seconds": 9, "backoff_multiplier": 2, "jitter_fraction": 0, "decay_factor": 1, "window_size": 9, "minimum_window": 9, "failure_ratio": 1, "circuit_consecutive_failures": 1, "circuit_seconds": 60}
    t, asked = datetime(2024, 1, 1, tzinfo=UTC), []
    fail = lambda m: asked.append(m) or ("retryable", None, None)
    control.replay(str(tmp_path), ["a", "b"], fail, policy, lambda: t)
    control.replay(str(tmp_path), ["a", "b"], fail, policy, lambda: t + timedelta(seconds=59))
    assert asked == ["a"]
    control.replay(str(tmp_path), ["a", "b"], fail, policy, lambda: t + timedelta(seconds=61))
    assert asked == ["a", "a"]


def test_journal_is_appended_after_a_torn_line(tmp_path):
    at = str(tmp_path / "j.jsonl")
    first = control.append_entry(at, {"member": "m" * 9000})
    with open(at, "ab") as f:
        f.write(b'{"torn')
    second = control.append_entry(at, {"member": "b"})
    lines = [json.loads(x) for x in open(at, encoding="utf-8")]
    assert lines == [first, second] and second["previous_entry_sha256"] == first["entry_sha256"] and second["sequence"] == 1
    with pytest.raises(checks.Violation):
        control.append_entry(at, {"sequence": 3})


def test_sync_state_advances_last(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    run = control.sync_batches(str(tmp_path), lambda p: False)
    with pytest.raises(checks.Violation):
        run(df, 0)
    assert control.load_state(str(tmp_path / "state.json")) == {}
    control.sync_batches(str(tmp_path), lambda p: True)(df, 0)
    assert control.load_state(str(tmp_path / "state.json"))["batch"] == 0
    control.sync_batches(str(tmp_path), lambda p: False)(df, 0)


def _events(path, *rows):
    put(path, *[dict(zip(["event_id", "case_id", "activity", "logical_id", "revision", "operation", "source_index"], r, strict=True)) for r in rows])


def test_stream_equals_batch(spark, tmp_path):
    _events(tmp_path / "in/1.json", ("e1", "c1", "a", "l1", 1, "upsert", 1), ("e2", "c1", "a", "l2", 1, "upsert", 2))
    _events(tmp_path / "in/2.json", ("e3", "c1", "a", "l1", 2, "retract", 3), ("e2", "c1", "a", "l2", 1, "upsert", 2))
    stream = event_log.read_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    q = event_log.latest_stream(stream).writeStream.outputMode("update").format("memory").queryName("latest_events").option("checkpointLocation", str(tmp_path / "cp1")).start()
    q.processAllAvailable()
    q.stop()
    last = {r.logical_id: r for r in spark.sql("SELECT * FROM latest_events ORDER BY revision").collect()}
    assert last["l1"].active is False and last["l2"].event_id == "e2"
    merge = event_log.upsert_batches(str(tmp_path / "table"))
    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.processAllAvailable()
    q.stop()
    batch = events.active_events(spark.read.schema(event_log.EVENT).json(str(tmp_path / "in")).dropDuplicates())
    assert sorted(r.event_id for r in event_log.active(spark, str(tmp_path / "table")).collect()) == sorted(r.event_id for r in batch.collect()) == ["e2"]


@pytest.mark.parametrize("second", [("e1", "c1", "b", "l1", 1, "upsert", 1), ("e9", "c1", "a", "l1", 1, "upsert", 1), ("e0", None, "a", "l1", 1, "upsert", 1)])
def test_stream_conflicts_abort(spark, tmp_path, second):
    """A revision that comes again with another payload aborts, also when a newer one has come between."""
    _events(tmp_path / "in/1.json", ("e1", "c1", "a", "l1", 1, "upsert", 1))
    _events(tmp_path / "in/2.json", ("e2", "c1", "a", "l1", 2, "upsert", 2))
    _events(tmp_path / "in/3.json", second)
    stream = event_log.read_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    q = event_log.latest_stream(stream).writeStream.outputMode("update").format("noop").option("checkpointLocation", str(tmp_path / "cp1")).start()
    with pytest.raises(Exception, match="two payloads"):
        q.processAllAvailable()
    merge = event_log.upsert_batches(str(tmp_path / "table"))
    parts = [spark.read.schema(event_log.EVENT).json(str(tmp_path / f"in/{k}.json")) for k in (1, 2, 3)]
    merge(parts[0], 0)
    merge(parts[1], 1)
    with pytest.raises(checks.Violation, match="l1:1"):
        merge(parts[2], 2)
    assert event_log.current(spark, str(tmp_path / "table")).first().event_id == "e2"


def test_stream_windows(spark, tmp_path):
    put(tmp_path / "w/1.json", {"ts": "2024-01-01T00:01:00", "activity": "a"}, {"ts": "2024-01-01T00:02:00", "activity": "a"})
    s = spark.readStream.schema("ts timestamp, activity string").json(str(tmp_path / "w"))
    q = event_log.windowed_activity(s).writeStream.outputMode("update").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT n FROM windows").first().n == 2


def test_base64_state_column(spark):
    from recordloom.functions import canonical

    body = json.dumps(canonical.encode_state({"b": 1}))
    assert base64 and spark.createDataFrame([(body,)], "b string").select(canonical.decoded_states("b")).first()[0] == '{"b":1}'
