"""Prefix scans, packages, bucketed exports and rollouts."""

import os
import random
import shutil

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.operators import manifest, prefix, ranges
from recordloom.operators.checks import Violation
from recordloom.sinks import documents, packages
from recordloom.streaming import rollout


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("rows", "parts"), [(400, 8), (3, 64), (1, 4), (0, 4)])
def test_scan_equals_the_plain_window(spark, monkeypatch, rows, parts):
    """Ties in the leading key, nulls, empty ranges, negative numbers."""
    monkeypatch.setattr(prefix, "SAMPLE", 40)
    r = random.Random(rows)
    data = [(i, r.choice([None, "a", "b", "zz"]), r.choice([None, 5, -3, 100]), r.randrange(4)) for i in range(rows)]
    df = spark.createDataFrame(data, "i bigint, s string, v bigint, tie int").repartition(5)
    order = ["tie", "s", "i"]
    got = prefix.scan(df, order, {"total": F.col("v"), "n": F.lit(1)}, {"top": F.col("v"), "last": F.struct("tie", "i")}, parts)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumns({"total": F.coalesce(F.sum("v").over(w), F.lit(0)), "n": F.count("*").over(w), "top": F.max("v").over(w), "last": F.max(F.struct("tie", "i")).over(w)})
    key = lambda x: repr(x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert rows < 2 or "SinglePartition" not in plan_of(got)
    if rows:
        assert [x.ordinal for x in prefix.ordinals(df, order, parts=parts).orderBy(*order).collect()] == list(range(rows))


def test_scan_over_one_hot_key(spark, monkeypatch):
    monkeypatch.setattr(prefix, "SAMPLE", 64)
    df = spark.range(2000).select(F.lit("hot").alias("k"), "id")
    got = prefix.scan(df, ["k", "id"], {"n": F.lit(1)}, parts=16)
    assert got.where("n <> id").count() == 0
    cuts = prefix.cuts_of(df, ["k", "id"], 16)
    assert len(cuts) == 15 and df.groupBy(prefix.range_of(df, ["k", "id"], cuts).alias("p")).count().agg(F.max("count")).first()[0] < 700


def test_caps(spark):
    df = spark.createDataFrame([(i, 10, 6.0, 100 - i) for i in range(20)], "i int, size int, secs double, free bigint")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(ranges.cap_running(df, "size", "i", max_bytes=35)) == [0, 1, 2, 3]
    assert ids(ranges.cap_running(df, "size", "i", max_rows=7, max_bytes=1000)) == list(range(7))
    assert ids(ranges.cap_running(df, "size", "i", seconds="secs", max_minutes=0.25)) == [0, 1, 2]
    assert ids(ranges.cap_running(df, "size", "i", free="free", min_free=97)) == [0, 1, 2, 3]
    found = ranges.adjacent_overlaps(spark.createDataFrame([(0, 5), (4, 9), (9, 12), (11, 11), (11, 20)], "start_offset bigint, end_offset bigint"))
    assert sorted((r.start_offset, r.end_offset, r.previous_end) for r in found.collect()) == [(4, 9, 5), (11, 11, 12)]


def lines(path, *rows):
    path.write_text("".join(r + "\n" for r in rows))
    return str(path)


@pytest.fixture
def store(spark, tmp_path):
    paths = {"cases": lines(tmp_path / "c", '{"a":1}', "", '{"b":2}'), "events": lines(tmp_path / "e", *(f'{{"n":{i}}}' for i in range(5)))}

    def build(revision, instance="nz", **roles):
        return packages.build_package(spark, str(tmp_path / "store"), instance, revision, paths | roles, {"repository": "r"}, {"kind": "snapshot"}, file_rows=4)

    return tmp_path / "store", build


def test_package_round_trip(spark, store):
    root, build = store
    first = build(1)
    assert first["counts"] == {"cases": 2, "events": 5}
    home = root / "packages/nz" / f"{1:020d}"
    before = {p: p.stat().st_mtime_ns for p in home.rglob("*") if p.is_file()}
    assert build(1) == first and {p: p.stat().st_mtime_ns for p in home.rglob("*") if p.is_file()} == before
    assert build(3)["archive_revision"] == 3
    with pytest.raises(Violation, match="later one"):
        build(2)
    with pytest.raises(Violation, match="other content"):
        build(3, events=lines(root / "x", '{"n":9}'))
    build(1, instance="au")
    assert packages.verify_store(spark, str(root)) == 3
    assert not list((root / "staging").iterdir())


def test_package_of_tables_does_not_depend_on_partitions(spark, store):
    root, build = store
    rows = spark.createDataFrame([(i % 7, i, None if i % 3 else f"é{i}") for i in range(50)], "k int, i bigint, t string")
    made = [packages.build_package(spark, f"{root}-{n}", "nz", 1, {"events": (rows.repartition(n), ["k", "i"])}, {}, {}, file_rows=20) for n in (1, 6)]
    assert made[0] == made[1] and [f["row_count"] for f in made[0]["files"]] == [20, 20, 10, None]
    text = "".join((root.parent / f"{root.name}-6/packages/nz/{1:020d}" / f["path"]).read_text() for f in made[0]["files"][:3])
    assert text.splitlines() == [f'{{"i":{i},"k":{k},"t":' + ("null" if i % 3 else f'"é{i}"') + "}" for k, i in sorted((i % 7, i) for i in range(50))]


@pytest.mark.parametrize(
    ("harm", "said"),
    [("byte", "was changed"), ("longer", "was changed"), ("extra", "is not listed"), ("hidden", "is not listed"), ("gone", "is gone"), ("link", "is a link"), ("linked folder", "is a link"), ("manifest", "manifest was changed"), ("no manifest", "cannot be read"), ("count", "manifest was changed")],
)
def test_every_change_of_a_package_is_found(spark, store, harm, said):
    root, build = store
    build(1)
    home = root / "packages/nz" / f"{1:020d}"
    at, note = home / "events.ndjson", home / packages.MANIFEST
    for p in home.rglob(".*.crc"):
        p.unlink()
    body = at.read_bytes()
    if harm == "byte":
        at.write_bytes(body.replace(b"3", b"4"))
    elif harm == "longer":
        at.write_bytes(body + b" ")
    elif harm in ("extra", "hidden"):
        (home / ("more.ndjson" if harm == "extra" else "metadata/.more")).write_text("{}\n")
    elif harm == "gone":
        at.unlink()
    elif harm == "link":
        shutil.move(at, root / "away")
        os.symlink(root / "away", at)
    elif harm == "linked folder":
        shutil.move(home / "metadata", root / "away")
        os.symlink(root / "away", home / "metadata")
    elif harm == "no manifest":
        note.write_text("[]")
    else:
        note.write_text(note.read_text().replace('"events":5', '"events":6') if harm == "count" else note.read_text().replace('"repository":"r"', '"repository":"s"'))
    with pytest.raises(Violation, match=said):
        packages.verify_package(spark, str(home))
    with pytest.raises(Violation):
        packages.verify_store(spark, str(root))


def test_a_manifest_that_lies_about_its_files(spark, store):
    """Identity and digests hold, order or rows do not."""
    import json

    from recordloom.functions.canonical import canonical_bytes

    root, build = store
    for change, said in ((lambda f: f[0].update(order=2), "out of order"), (lambda f: (f[0].update(row_count=4)), "number of rows"), (lambda f: f.append({**f[0], "order": 4}), "listed twice")):
        made = build(1)
        home = root / "packages/nz" / f"{1:020d}"
        files = [dict(f) for f in made["files"]]
        change(files)
        counts = {r: sum(f["row_count"] for f in files if f["role"] == r) for r in ("cases", "events")}
        false = {k: v for k, v in made.items() if k != "package_id"} | {"files": files, "counts": counts}
        false["package_id"] = packages.package_id(false)
        for p in home.rglob(".*.crc"):
            p.unlink()
        (home / packages.MANIFEST).write_bytes(canonical_bytes(json.loads(json.dumps(false))) + b"\n")
        with pytest.raises(Violation, match=said):
            packages.verify_package(spark, str(home))
        shutil.rmtree(root)


def test_store_and_index_have_to_agree(spark, store):
    root, build = store
    build(1)
    build(2)
    shutil.rmtree(root / "packages/nz" / f"{2:020d}")
    with pytest.raises(Violation, match="differ"):
        packages.verify_store(spark, str(root))
    with pytest.raises(Violation, match="gone or changed"):
        packages.publish_index(spark, str(root), "nz")


def test_a_failed_build_leaves_nothing(spark, store, tmp_path):
    root, build = store
    with pytest.raises(Exception):
        build(1, events=str(tmp_path / "not there"))
    assert not (root / "packages").exists() and not list((root / "staging").iterdir())


def test_difference_of_bucketed_tables_shuffles_nothing(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("request_id"), F.sha2(F.col("id").cast("string"), 256).alias("content_sha256"))
    old = documents.export_bucketed(rows.where("id <> 7"), str(tmp_path / "a"), "requests_old", buckets=8)
    new = documents.export_bucketed(rows.withColumn("content_sha256", F.when(F.col("request_id") == 9, "x").otherwise(F.col("content_sha256"))), str(tmp_path / "b"), "requests_new", buckets=8)
    diff = manifest.change_diff(old, new, "request_id", "content_sha256")
    assert "Exchange" not in plan_of(diff)
    assert sorted((r.request_id, r.bucket) for r in diff.collect()) == [(7, "added"), (9, "updated")]


def test_rollout_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    ddl = "request_id bigint, title string, state string"
    made = {"NSW": [(1, "a", "x"), (2, "b", "x")], "VIC": [(2, "later", "x"), (3, "c", "x")]}
    calls = []

    def capture(name):
        calls.append(name)
        return spark.createDataFrame(made[name], ddl)

    first = rollout.roll_out(spark, root, "1", ["NSW", "VIC"], capture)
    assert first["tables"]["national"]["rows"] == 3
    assert [(r.request_id, r.title, r.jurisdiction) for r in rollout.table(spark, root).orderBy("request_id").collect()] == [(1, "a", "NSW"), (2, "later", "VIC"), (3, "c", "VIC")]
    made["VIC"] = [(4, "d", "dry-run")]
    with pytest.raises(Violation, match="dry-run"):
        rollout.roll_out(spark, root, "2", ["NSW", "VIC"], capture)
    assert rollout.current_version(spark, root) == first and rollout.table(spark, root, "VIC").count() == 2
    made["VIC"] = [(4, "d", "x"), (4, "e", "x")]
    with pytest.raises(Violation, match="duplicate"):
        rollout.roll_out(spark, root, "2", ["NSW", "VIC"], capture)
    made["VIC"] = [(4, "d", "x")]
    assert rollout.roll_out(spark, root, "2", ["NSW", "VIC"], capture)["tables"]["VIC"]["rows"] == 1
    assert calls == ["NSW", "VIC", "NSW", "VIC", "VIC", "VIC"]  # what was done was not done again
    assert rollout.roll_out(spark, root, "2", ["NSW", "VIC"], capture)["version"] == "2" and len(calls) == 6
    with pytest.raises(Violation):
        rollout.table(spark, root, "QLD")


def test_rebuilt_batches(spark):
    batches = spark.createDataFrame([("1-10", 1, 10, "pending", None, None), ("11-20", 11, 20, "pending", 4, None), ("21-30", 21, 30, None, None, None), ("", 1, 2, "pending", 1, None)], "label string, id_from bigint, id_to bigint, status string, record_count bigint, worker_run_id string")
    runs = spark.createDataFrame([("r1", "1-10", 0), ("r1", "11-20", 1), ("r2", "41-50", 0)], "run string, label string, place int")
    merged = spark.createDataFrame([("r1", 1, 17), ("r2", 2, 5), ("r3", 3, 0)], "run string, seq bigint, record_count bigint")
    got = ranges.rebuilt_batches(batches, runs, merged)
    assert sorted(map(tuple, got.collect())) == [("1-10", 1, 10, "merged", 17), ("11-20", 11, 20, "merged", 4), ("21-30", 21, 30, "pending", None), ("41-50", 41, 50, "merged", 5)]
    # rows that merging made are not changed by a rebuild from the same receipts
    receipts = spark.createDataFrame([("1-10", 17, "r1")], "label string, record_count bigint, worker_run_id string")
    marked = ranges.mark_merged(batches.where("label <> ''"), receipts)
    again = ranges.rebuilt_batches(marked, runs.where("label = '1-10'"), merged)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, marked.select("label", "id_from", "id_to", F.coalesce("status", F.lit("pending")).alias("status"), "record_count").collect()))
    islands = ranges.run_islands(spark.createDataFrame([("r", "1-5", 0), ("r", "6-9", 1), ("r", "20-30", 2), ("q", "6-9", 0)], "run string, label string, place int"))
    assert sorted((r.run, r.label, r.island, r["first"]) for r in islands.collect()) == [("q", "6-9", 0, True), ("r", "1-5", 0, True), ("r", "20-30", 1, True), ("r", "6-9", 0, False)]


def test_summary_with_runs(spark):
    rows = [(f"{i}-{i}", i, i, "merged", 2, f"run{i % 12:02d}" if i else "") for i in range(30)]
    batches = spark.createDataFrame(rows, "label string, id_from bigint, id_to bigint, status string, record_count bigint, worker_run_id string")
    one = ranges.summarised(batches).first()
    assert one.captured_records == one.captured_records_summed_batches == 60 and one.worker_runs == [f"run{i:02d}" for i in range(12)]
    assert one.recent_worker_runs == ["run03", "run04", "run05", "run06", "run07", "run08", "run09", "run10", "run11", "run00"]
    assert ranges.summarised(batches, F.lit(0)).first().captured_records == 0


def test_duckdb_reads_the_lines_of_a_package(spark, store):
    root, build = store
    build(1)
    at = root / "packages/nz" / f"{1:020d}" / "events.ndjson"
    assert duckdb.sql(f"select count(*), sum(n) from read_json('{at}', format='newline_delimited')").fetchall() == [(5, 10)]
