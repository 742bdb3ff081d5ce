"""Streams and what goes on after a stop: event log, replay, resume keys, page scans, re-verification."""

import hashlib
import json
import sys
import time
from datetime import UTC, datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from recordloom import files
from recordloom.operators import events, reverify
from recordloom.operators.checks import Violation
from recordloom.operators.replay import Pacing
from recordloom.sources import index_api, index_stream
from recordloom.streaming import control, event_log, replay_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not have this module

LOG = [c.split()[0] for c in event_log.EVENT.split(", ")]


# --- log of buckets ----------------------------------------------------------


def log(spark, n, seed=0):
    """Revisions of a few logical events, with repeats."""
    rows = [(f"e{i}", f"c{i % 5}", "a", f"l{i % 23}", i // 23 + 1, "retract" if i % 7 == 0 else "upsert", i) for i in range(n)]
    return spark.createDataFrame(rows, event_log.EVENT)


def layout(spark, target):
    return event_log._layout(spark, target)["buckets"]


@pytest.mark.parametrize(("n_buckets", "compact"), [(1, 1), (6, 2), (6, 100)])
def test_log_of_buckets_equals_one_merge(spark, tmp_path, n_buckets, compact):
    target, every = str(tmp_path), log(spark, 200)
    merge = event_log.upsert_batches(target, n_buckets, compact)
    for k in range(5):
        merge(every.where((F.col("source_index") % 5 == k) | (F.col("source_index") < 10)), k)
    got = event_log.revisions(spark, target)
    assert sorted(map(repr, got.select(*LOG).collect())) == sorted(map(repr, events.merge_shards(every).select(*LOG).collect()))
    assert sorted(r.event_id for r in event_log.active(spark, target).collect()) == sorted(r.event_id for r in events.active_events(every).collect())
    if compact == 2:
        assert max(len(v) for v in layout(spark, target).values()) <= 4
    before = sorted(map(repr, got.collect()))
    event_log.vacuum(spark, target, keep=1)
    assert sorted(map(repr, event_log.revisions(spark, target).collect())) == before and event_log.versions(spark, target) == [4]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    target, merge = str(tmp_path), event_log.upsert_batches(str(tmp_path), 8, 100)
    merge(log(spark, 150), 0)
    before = {n: (tmp_path / n).stat().st_mtime_ns for n, _ in files.listed(spark, target) if n.endswith(".parquet")}
    old = layout(spark, target)
    one = spark.createDataFrame([("new", "c1", "a", "l3", 99, "upsert", 999)], event_log.EVENT)
    merge(one, 1)
    after = {n: (tmp_path / n).stat().st_mtime_ns for n, _ in files.listed(spark, target) if n.endswith(".parquet")}
    changed = [b for b, v in layout(spark, target).items() if old.get(b) != v]
    assert len(changed) == 1 and all(after[n] == t for n, t in before.items()) and len(after) == len(before) + 1
    merge(one, 1)  # a batch that comes again
    merge(one, 2)  # nothing new in it
    assert layout(spark, target) == event_log._layout(spark, target, before=2)["buckets"] and event_log.current(spark, target).where("logical_id = 'l3'").first().event_id == "new"


def test_conflict_in_an_old_bucket_aborts_the_batch(spark, tmp_path):
    target, merge = str(tmp_path), event_log.upsert_batches(str(tmp_path), 4, 1)
    for k in range(4):
        merge(log(spark, 60).where(F.col("source_index") % 4 == k), k)
    good = ("n1", "c", "a", "other", 1, "upsert", 1)
    for bad in (("e0", "c0", "changed", "l0", 1, "retract", 0), ("e0", None, "a", "l0", 1, "retract", 0)):
        with pytest.raises(Violation, match="l0:1"):
            merge(spark.createDataFrame([good, bad], event_log.EVENT), 9)
        assert event_log.versions(spark, target) == [0, 1, 2, 3] and event_log.current(spark, target).where("logical_id = 'other'").count() == 0
    merge(spark.createDataFrame([good], event_log.EVENT), 9)
    assert event_log.current(spark, target).where("logical_id = 'other'").count() == 1


# --- replay ------------------------------------------------------------------

POLICY = {"floor_seconds": 0.0, "ceiling_seconds": 60.0, "decay_factor": 0.5, "backoff_multiplier": 2.0, "jitter_fraction": 0.0, "window_size": 4, "minimum_window": 4, "failure_ratio": 2.0, "circuit_consecutive_failures": 2, "circuit_seconds": 0.05}


def observe(host, member):
    """Host b fails on its first attempts at m1 (counted in a file, as tasks run anywhere); m2 is gone."""
    if member == "m2":
        return "terminal", None, None
    if host.startswith("b:") and member == "m1":
        at = host[2:] + "/tries"
        with open(at, "a") as f:
            f.write("x")
        with open(at) as f:
            if len(f.read()) <= 3:
                return "retryable", None, None
    return "complete", f"{host[:1]}-{member}".encode(), None


def wait_for(query, done, seconds=90):
    end = time.time() + seconds
    while time.time() < end and not done():
        if query.exception():
            raise query.exception()
        time.sleep(0.3)


def test_replay_by_host(spark, tmp_path):
    """Hosts in parallel; a circuit opens and a timer closes it; a restart goes on from the state."""
    hosts = ["a", f"b:{tmp_path}"]
    put = lambda name, rows: (tmp_path / "in").mkdir(exist_ok=True) or (tmp_path / "in" / name).write_text("".join(json.dumps(dict(zip(["host", "member"], r))) + "\n" for r in rows))
    put("1.json", [(h, m) for h in hosts for m in ("m1", "m2", "m3")])
    folder = str(tmp_path / "out")

    def start():
        rows = spark.readStream.schema("host string, member string").json(str(tmp_path / "in"))
        stream = replay_stream.replay_stream(rows, folder, observe, POLICY)
        return stream.writeStream.foreachBatch(replay_stream.journal_batches(folder)).outputMode("update").trigger(processingTime="200 milliseconds").option("checkpointLocation", str(tmp_path / "cp")).start()

    def entries():
        found = replay_stream.journal(spark, folder)
        return [] if found is None else sorted(found.collect(), key=lambda r: (r.host, r.sequence))

    q = start()
    wait_for(q, lambda: sum(r.disposition != "retryable" for r in entries()) == 6)
    q.stop()
    put("2.json", [("a", "m1"), ("a", "m4")])  # one is settled already
    q = start()
    wait_for(q, lambda: any(r.member == "m4" for r in entries()))
    q.stop()
    got = entries()
    a, b = [r for r in got if r.host == "a"], [r for r in got if r.host != "a"]
    assert [(r.member, r.disposition) for r in a] == [("m1", "complete"), ("m2", "terminal"), ("m3", "complete"), ("m4", "complete")]
    assert sorted((r.member, r.disposition) for r in b) == sorted([("m1", "retryable")] * 3 + [("m1", "complete"), ("m2", "terminal"), ("m3", "complete")])
    assert [r.attempt for r in b if r.member == "m1"] == [1, 2, 3, 4]
    for rows in (a, b):
        assert [r.sequence for r in rows] == list(range(len(rows)))
        pacing, before = Pacing(0.0), None
        for r in rows:
            pacing = pacing.after(r.disposition, POLICY, r["at"])
            assert (r.delay, r.failures, r.open_until) == (pacing.delay, pacing.failures, pacing.open_until)
            assert r.previous_entry_sha256 == before and r.entry_sha256 == replay_stream.entry_digest(r.asDict())
            if r.object_sha256:
                assert (tmp_path / "out/objects" / r.object_sha256[:2] / r.object_sha256).read_bytes() == f"{r.host[:1]}-{r.member}".encode()
            before = r.entry_sha256


def test_replay_batch_that_is_lost_begins_again(spark, tmp_path):
    """The sink fails after objects are there: the next run repeats the batch and has nothing twice."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"host":"a","member":"m1"}\n{"host":"a","member":"m3"}\n')
    folder = str(tmp_path / "out")

    def run(sink):
        rows = spark.readStream.schema("host string, member string").json(str(tmp_path / "in"))
        q = replay_stream.replay_stream(rows, folder, observe, POLICY).writeStream.foreachBatch(sink).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).start()
        try:
            wait_for(q, lambda: replay_stream.journal(spark, folder) is not None and replay_stream.journal(spark, folder).count() == 2, 60)
        finally:
            q.stop()

    def broken(batch, number):
        batch.collect()
        raise OSError("sink is gone")

    with pytest.raises(Exception, match="sink is gone"):
        run(broken)
    assert len(list((tmp_path / "out/objects").rglob("*"))) > 0 and replay_stream.journal(spark, folder) is None
    run(replay_stream.journal_batches(folder))
    got = sorted(replay_stream.journal(spark, folder).collect(), key=lambda r: r.sequence)
    assert [(r.sequence, r.member, r.attempt) for r in got] == [(0, "m1", 1), (1, "m3", 1)]


# --- re-verification ---------------------------------------------------------


@pytest.fixture
def replayed(tmp_path):
    bodies = {"m1": b"one", "m2": None, "m3": b"three", "m4": b"one"}
    look = lambda m: ("complete", bodies[m], None) if bodies[m] else ("terminal", None, None)
    control.replay(str(tmp_path), list(bodies), look, POLICY, lambda: datetime(2024, 1, 1, tzinfo=UTC))
    return tmp_path, [*bodies, "m5"]


def entries_of(folder):
    return [json.loads(x) for x in (folder / "journal.jsonl").read_text().splitlines()]


def put_entries(folder, entries, chained=False):
    before = None
    for i, e in enumerate(entries):
        if chained:
            e |= {"sequence": i, "previous_entry_sha256": before}
            e["entry_sha256"] = reverify.own_digest(e)
            before = e["entry_sha256"]
    (folder / "journal.jsonl").write_text("".join(json.dumps(e, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n" for e in entries))


@pytest.mark.parametrize("size", [1, 2, 100])
def test_whole_replay_has_no_findings(spark, replayed, size):
    folder, members = replayed
    assert reverify.findings(spark, str(folder), members, size).collect() == []
    reverify.require_whole(spark, str(folder), members, size)


def tamper(folder, how):
    entries = entries_of(folder)
    check = json.loads((folder / "checkpoint.json").read_text())
    if how == "body":
        entries[1]["member"] = "m9"
        put_entries(folder, entries)
    elif how == "deleted":
        put_entries(folder, entries[:1] + entries[2:])
    elif how == "swapped":
        put_entries(folder, [entries[0], entries[2], entries[1], entries[3]])
    elif how == "last deleted":
        put_entries(folder, entries[:-1])
    elif how == "relinked":
        entries[2]["previous_entry_sha256"] = "0" * 64
        entries[2]["entry_sha256"] = reverify.own_digest(entries[2])
        put_entries(folder, entries)
    elif how == "no json":
        (folder / "journal.jsonl").write_text((folder / "journal.jsonl").read_text().replace('{"at"', '{at"', 1))
    elif how == "begins with a link":
        entries[0]["previous_entry_sha256"] = "1" * 64
        entries[0]["entry_sha256"] = reverify.own_digest(entries[0])
        put_entries(folder, entries)
    elif how == "stranger":
        entries[1]["member"] = "m9"
        put_entries(folder, entries, chained=True)
    elif how == "again":
        put_entries(folder, [*entries, dict(entries[0])], chained=True)
    elif how == "success without object":
        entries[1]["disposition"] = "complete"
        put_entries(folder, entries, chained=True)
    elif how == "object changed":
        next(p for p in (folder / "objects").rglob("*") if p.is_file()).write_bytes(b"other")
    elif how == "object gone":
        at = hashlib.sha256(b"three").hexdigest()
        (folder / "objects" / at[:2] / at).unlink()
    elif how == "object more":
        (folder / "objects/aa").mkdir(exist_ok=True)
        (folder / "objects/aa/stray").write_bytes(b"x")
    elif how == "state":
        check["states"]["m2"] = "complete"
        (folder / "checkpoint.json").write_text(json.dumps(check))
    elif how == "state gone":
        del check["states"]["m1"]
        (folder / "checkpoint.json").write_text(json.dumps(check))
    elif how == "state more":
        check["states"]["m9"] = "pending"
        (folder / "checkpoint.json").write_text(json.dumps(check))


@pytest.mark.parametrize("size", [1, 100])
@pytest.mark.parametrize(
    ("how", "said"),
    [
        ("body", "journal 1 does not have its own digest"), ("deleted", "journal 1 has another place"), ("swapped", "journal 1 has another place"), ("last deleted", "object|checkpoint m4"),
        ("relinked", "journal 2 does not follow"), ("no json", "journal 0 is no entry"), ("begins with a link", "journal 0 begins with a link"), ("stranger", "journal 1 is about an unknown"),
        ("again", "journal 4 comes after"), ("success without object", "journal 1 has an object and no success"), ("object changed", "has another digest"), ("object gone", "is gone"),
        ("object more", "is named by no entry"), ("state", "checkpoint m2 is not what"), ("state gone", "checkpoint m1 is missing"), ("state more", "checkpoint m9 is no member"),
    ],
)
def test_tampering_is_named_by_its_first_place(spark, replayed, how, said, size):
    folder, members = replayed
    for p in folder.rglob(".*.crc"):
        p.unlink()
    tamper(folder, how)
    with pytest.raises(Violation, match=said):
        reverify.require_whole(spark, str(folder), members, size)


# --- index by resume key -----------------------------------------------------


class Chunked:
    """Five chunks; what is asked is kept in a file, as the reader lives in a process of its own."""

    def __init__(self, folder, repeat=None, change=None):
        self.folder, self.repeat, self.change = str(folder), repeat, change

    def __call__(self, params):
        key = int(params.get("resumeKey", "0"))
        with open(f"{self.folder}/asked", "a") as f:
            f.write(f"{key}\n")
        shown = self.repeat if self.repeat is not None and key > self.repeat else key
        rows = [[f"http://h/{shown}/{i}", "2020", "D", "200", "1"] for i in range(3)]
        return [index_api.FIELDS, *rows, *([[], [str(key + 1)]] if key < 4 else [])]


def run_chunks(spark, opener, tmp_path, batches=None):
    out = str(tmp_path / "rows")
    df = index_stream.read_chunks(spark, opener, "h/*", page_size=3)
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        if batches is None:
            q.processAllAvailable()
            wait_for(q, lambda: files.exists(spark, out) and spark.read.parquet(out).select("chunk").distinct().count() == 5, 60)
        else:
            wait_for(q, lambda: files.exists(spark, f"{out}/_spark_metadata") and len(files.listed(spark, f"{out}/_spark_metadata")) >= batches, 60)
    finally:
        q.stop()
    return spark.read.parquet(out)


def test_stream_goes_on_after_a_stop(spark, tmp_path):
    (tmp_path / "log").mkdir()
    opener = Chunked(tmp_path / "log")
    run_chunks(spark, opener, tmp_path, batches=2)
    got = run_chunks(spark, opener, tmp_path)
    assert sorted(r.original for r in got.collect()) == sorted(f"http://h/{k}/{i}" for k in range(5) for i in range(3))


def test_reader_reads_the_same_between_offsets(tmp_path):
    reader = index_stream._Chunks(Chunked(tmp_path), "h/*", 3, 60, None, None)
    at, rows = reader.initialOffset(), []
    marks = [at]
    while not at["end"]:
        found, at = reader.read(at)
        rows += found
        marks.append(at)
    assert len(rows) == 15 and list(reader.readBetweenOffsets(marks[1], marks[4])) == rows[3:12] and list(reader.read(at)[0]) == []
    with pytest.raises(RuntimeError, match="changed"):
        list(reader.readBetweenOffsets(marks[1], marks[4] | {"before": "x"}))


@pytest.mark.parametrize("repeat", [0, 1, 3])
def test_repeated_chunk_aborts(tmp_path, repeat):
    reader = index_stream._Chunks(Chunked(tmp_path, repeat=repeat), "h/*", 3, 60, None, None)
    at = reader.initialOffset()
    with pytest.raises(RuntimeError, match="repeated"):
        while not at["end"]:
            _, at = reader.read(at)


def test_stalled_chunk_ends_at_its_deadline():
    def stalls(params):
        raise index_api.Refused(503)

    reader = index_stream._Chunks(stalls, "h/*", 3, 0.2, None, None)
    with pytest.raises(RuntimeError, match="deadline"):
        reader.read(reader.initialOffset())


# --- checkpointed scan -------------------------------------------------------


class Paged:
    """Six pages; page ``broken`` cannot be read."""

    def __init__(self, folder, broken=None, same=None):
        self.folder, self.broken, self.same = str(folder), broken, same

    def __call__(self, params):
        if "showNumPages" in params:
            return [["numpages"], ["6"]]
        page = int(params["page"])
        if page == self.broken:
            raise index_api.Refused(404)
        with open(f"{self.folder}/page{page}", "a") as f:
            f.write("x")
        shown = 0 if page == self.same else page
        return [index_api.FIELDS, *[[f"http://h/{shown}/{i}", "2020", "D", "200", "1"] for i in range(4)]]


@pytest.mark.parametrize("broken", range(6))
def test_scan_goes_on_where_it_stopped(spark, tmp_path, broken):
    (tmp_path / "log").mkdir()
    keep = str(tmp_path / "pages")
    with pytest.raises(Exception, match="404|failed"):
        index_stream.scan(spark, Paged(tmp_path / "log", broken), "h/*", keep, 4)
    held = len(list((tmp_path / "pages").glob("page-*.json")))
    got = index_stream.scan(spark, Paged(tmp_path / "log"), "h/*", keep, 4)
    assert sorted((r.page, r["at"], r.original) for r in got.collect()) == [(p, i, f"http://h/{p}/{i}") for p in range(6) for i in range(4)]
    again = index_stream.scan(spark, Paged(tmp_path / "log", broken=0), "h/*", keep, 4)  # reads no page
    assert again.count() == 24 and held < 6
    with pytest.raises(Exception, match="another scan"):
        index_stream.scan(spark, Paged(tmp_path / "log"), "h/*", keep, 5)


def test_scan_refuses_repeated_or_lost_pages(spark, tmp_path):
    (tmp_path / "log").mkdir()
    with pytest.raises(Violation, match="repeated"):
        index_stream.scan(spark, Paged(tmp_path / "log", same=3), "h/*", str(tmp_path / "a"), 4)
    index_stream.scan(spark, Paged(tmp_path / "log"), "h/*", str(tmp_path / "b"), 4)
    (tmp_path / "b/page-00000002.json").unlink()
    with pytest.raises(Violation, match="missing"):
        index_stream.kept_pages(spark, str(tmp_path / "b"), index_stream.scan_config("h/*", 4))


# --- controller and small readers --------------------------------------------


def test_controller_moves_in_whole_steps(spark, tmp_path):
    folder, ddl = str(tmp_path), "label string, record_count bigint, worker_run_id string"
    step = control.controller_batches(folder, 1, 95, 10, 4)
    state = lambda: json.loads((tmp_path / "state.json").read_text())
    rows = lambda: sorted((r.id_from, r.label, r.status, r.record_count) for r in spark.read.parquet(state()["table"]).collect())
    step(spark.createDataFrame([], ddl), 0)
    assert [r[1] for r in rows()] == ["1-10", "11-20", "21-30", "31-40"] and state()["next_id"] == 1
    step(spark.createDataFrame([("1-10", 5, "w1"), ("21-30", 6, "w2")], ddl), 1)
    assert state()["next_id"] == 11 and state()["dispatch_next_id"] == 61 and [r[1:] for r in rows()][:3] == [("1-10", "merged", 5), ("11-20", "pending", None), ("21-30", "merged", 6)]
    before = state()
    step(spark.createDataFrame([("11-20", 1, "w")], ddl), 1)  # a batch that was done
    with pytest.raises(Violation, match="never dispatched"):
        step(spark.createDataFrame([("61-70", 1, "w")], ddl), 2)
    assert state() == before
    for number in range(2, 9):
        open_now = [(r[1], 1, "w") for r in rows() if r[2] == "pending"]
        step(spark.createDataFrame(open_now, ddl), number)
    assert state()["complete"] and state()["next_id"] == 96 and rows()[-1][1] == "91-95"


def test_small_readers(spark, tmp_path):
    import io
    import zipfile

    from recordloom.operators import checks
    from recordloom.sources import readers

    (tmp_path / "c.json").write_text(json.dumps({"added": [{"request_id": 1, "url_title": "a"}], "removed": [{"request_id": 2}]}))
    assert sorted((r.bucket, r.request_id, r.url_title) for r in readers.read_changes(spark, str(tmp_path / "c.json")).collect()) == [("added", 1, "a"), ("removed", 2, None)]
    assert readers.read_changes(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(Violation, match="object"):
        readers.read_changes(spark, str(tmp_path / "l.json"))
    (tmp_path / "e.ndjson").write_text('{"a":1}\n\n{"a":2}\n')
    assert readers.read_package_lines(spark, str(tmp_path / "e.ndjson"), "events").count() == 2
    (tmp_path / "e.ndjson").write_text("{}\n7\n")
    for path in ("e.ndjson", "gone.ndjson"):
        with pytest.raises(Violation, match="^events: "):
            readers.read_package_lines(spark, str(tmp_path / path), "events")
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("discovered_bodies.json", '{"bodies": []}')
        z.writestr("discovered_bodies.provenance.json", "{}")
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips/a.zip").write_bytes(made.getvalue())
    (tmp_path / "zips/b.zip").write_bytes(b"no archive")
    found = sorted(map(tuple, readers.read_catalogs(spark, str(tmp_path / "zips")).select("bodies", "provenance", "problem").collect()), key=repr)
    assert found[0][0] is None and "cannot be read" in found[0][2] or found[1][0] is None
    assert ('{"bodies": []}', "{}", None) in found
    pages = spark.createDataFrame([(0, 0, *"abcde"), (0, 1, *"abcdf"), (1, 0, *"abcde"), (2, 0, *"zbcde")], "page int, at int, " + ", ".join(f"{f} string" for f in index_api.FIELDS))
    assert [(r.page, r["at"], r.length) for r in index_api.distinct_rows(pages, 2).collect()] == [(0, 0, "e"), (0, 1, "f")] and index_api.distinct_rows(pages).count() == 3
    requests = spark.createDataFrame([(1, "a" * 64), (0, "x"), (None, None)], "request_id bigint, content_sha256 string")
    meta = spark.createDataFrame([("s", "nz", 3)], "source string, instance_id string, record_count bigint")
    assert checks.manifest_problems(meta, requests, ["s"], "nz") == ["request without a positive id", "content hash is not 64 characters"]
    assert checks.manifest_problems(meta, requests.limit(1), ["t"], "au", "NSW") == ["unknown source", "jurisdiction mismatch", "instance mismatch", "record count differs from requests"]
