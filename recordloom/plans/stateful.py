"""Queries over features that write, keep state or verify: they work on tables that Spark derives from the given ones."""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from .. import files
from ..functions import replay_json, urls
from ..operators import chains, checks, manifest, mirrors, ranges, registry, reverify
from ..sinks import documents, packages
from ..sources import readers
from ..streaming import event_log, leases, rollout
from . import catalog
from .catalog import LOG_SQL, query

# --- logs, packages, journals ------------------------------------------------


@query(f"WITH {LOG_SQL} SELECT logical_id, event_id, CAST(revision AS BIGINT) AS revision, operation, case_id FROM (SELECT *, row_number() OVER (PARTITION BY logical_id ORDER BY revision DESC, event_id DESC) AS r1 FROM log) WHERE r1 = 1")
def event_log_incremental(spark, sf_dir):
    """The log in five batches, some rows delivered again, merged into a log of hash buckets."""
    log = catalog.event_log(spark, sf_dir).select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in event_log.EVENT.split(", ")])
    target = files.shared_folder(spark, "event-log")
    merge = event_log.upsert_batches(target, n_buckets=16, compact_after=2)
    for k in range(5):
        again = F.pmod("revision", F.lit(10)) == (k + 5) % 10
        merge(log.where((F.pmod("revision", F.lit(5)) == k) | again), k)
    return event_log.current(spark, target).select("logical_id", "event_id", "revision", "operation", "case_id")


_PACKAGE_ROWS = 20_000


@query(f"""WITH e AS (SELECT '{{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey || '}}' AS line,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS place FROM lineitem),
c AS (SELECT '{{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || '}}' AS line, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders),
r AS (SELECT 'cases' AS role, * FROM c UNION ALL SELECT 'events', * FROM e)
SELECT role, role || '/' || role || '-' || lpad(CAST(place // {_PACKAGE_ROWS} AS VARCHAR), 8, '0') || '.ndjson' AS path, count(*) AS row_count,
  CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY place)) AS sha256
FROM r GROUP BY role, place // {_PACKAGE_ROWS}""")
def package_role_digests(spark, sf_dir):
    """Orders and their items as a package, verified and read back from its manifest."""
    items = catalog.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = catalog.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    roles = {"cases": (orders, ["o_orderkey"]), "events": (items, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])}
    root = files.shared_folder(spark, "package-store")
    packages.build_package(spark, root, "orders", 1, roles, {"repository": "orders"}, {"kind": "snapshot"}, file_rows=_PACKAGE_ROWS)
    made = packages.verify_package(spark, packages._home(root, "orders", 1))
    rows = [(f["role"], f["path"], f["row_count"], f["bytes"], f["sha256"]) for f in made["files"] if f["row_count"] is not None]
    return spark.createDataFrame(rows, "role string, path string, row_count bigint, bytes bigint, sha256 string")


def _chained(batches):
    """Journal lines of users' events, which come by user and in order; every 41st event is changed after it was signed."""
    user, before, i = None, None, 0
    for batch in batches:
        out = ([], [], [])
        for owner, event in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if owner != user:
                user, before, i = owner, None, 0
            rest = f'{{"event_id":{event},"previous_entry_sha256":{"null" if before is None else chr(34) + before + chr(34)},"sequence":{i}}}'
            before = hashlib.sha256(rest.encode()).hexdigest()
            shown = rest.replace(f'"event_id":{event},', f'"event_id":{event + 1},') if event % 41 == 0 else rest
            for column, value in zip(out, (owner, i, f'{shown[:-1]},"entry_sha256":"{before}"}}'), strict=True):
                column.append(value)
            i += 1
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["user_id", "place", "entry"])


def _journals(spark, sf_dir):
    events = catalog.table(spark, sf_dir, "events").select("user_id", "event_id")
    return events.repartition("user_id").sortWithinPartitions("user_id", "event_id").mapInArrow(_chained, "user_id bigint, place bigint, entry string")


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM events)
SELECT user_id, CAST(place // 16 AS BIGINT) AS segment, CAST(min(place) AS BIGINT) AS first, CAST(max(place) AS BIGINT) AS last,
  CASE WHEN count_if(event_id % 41 = 0) > 0 THEN 'does not have its own digest' END AS problem, CAST(min(CASE WHEN event_id % 41 = 0 THEN place END) AS BIGINT) AS problem_at
FROM e GROUP BY user_id, place // 16""")
def journal_segments(spark, sf_dir):
    """Hash-chained journals of the users' events, checked segment by segment."""
    lines = _journals(spark, sf_dir)
    return reverify.journal_segments(lines, ["user_id"], size=16).select("user_id", "segment", "first", "last", "problem", "problem_at")


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM events)
SELECT user_id, CAST(min(place) AS BIGINT) AS place, 'does not have its own digest' AS problem FROM e WHERE event_id % 41 = 0 GROUP BY user_id, place // 16""")
def journal_findings(spark, sf_dir):
    lines = _journals(spark, sf_dir)
    return reverify.chain_findings(reverify.journal_segments(lines, ["user_id"], size=16), ["user_id"])


# --- controllers -------------------------------------------------------------


@query("""WITH c AS (SELECT c_custkey, c_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey), r AS (SELECT min(n_regionkey) AS lo FROM c),
every AS (SELECT c_custkey + 1 AS request_id, n_regionkey AS k, c_name AS title FROM c UNION ALL SELECT c_custkey + 1, 99, c_name || ' again' FROM c WHERE (c_custkey + 1) % 9 = 0)
SELECT request_id, title, CASE WHEN k = 99 THEN 'late' ELSE 'region' || k END AS jurisdiction FROM every QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY k DESC) = 1""")
def rollout_national(spark, sf_dir):
    """Customers by region as jurisdictions, one more that replaces some of them, published as one version."""
    customers = catalog.table(spark, sf_dir, "customer").join(catalog.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = customers.select((F.col("c_custkey") + 1).cast("bigint").alias("request_id"), F.col("c_name").alias("title"), F.lit("open").alias("state"), "n_regionkey")
    parts = {f"region{r[0]}": rows.where(F.col("n_regionkey") == r[0]).drop("n_regionkey") for r in rows.select("n_regionkey").distinct().orderBy("n_regionkey").collect()}
    parts["late"] = rows.where("request_id % 9 = 0").drop("n_regionkey").withColumn("title", F.concat("title", F.lit(" again")))
    root = files.shared_folder(spark, "rollout")
    rollout.roll_out(spark, root, "1", list(parts), parts)
    return rollout.table(spark, root).select("request_id", "title", "jurisdiction")


@query("""WITH b AS (SELECT o_orderkey AS request_id, sha256(CAST(o_totalprice AS VARCHAR)) AS d FROM orders)
SELECT request_id, CASE WHEN request_id % 10 = 3 THEN 'added' WHEN request_id % 10 = 7 THEN 'removed' ELSE 'updated' END AS bucket FROM b WHERE request_id % 10 IN (3, 7) OR (request_id % 10 = 5)""")
def change_diff_bucketed(spark, sf_dir):
    """The difference of two exported tables that are bucketed by their key: joined where they lie."""
    rows = catalog.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_id"), F.sha2(F.col("o_totalprice").cast("string"), 256).alias("content_sha256"))
    tag, root = uuid.uuid4().hex, files.shared_folder(spark, "bucketed")
    old = documents.export_bucketed(rows.where("request_id % 10 <> 3"), f"{root}/old", f"requests_old_{tag}")
    changed = F.when(F.col("request_id") % 10 == 5, F.concat(F.lit("x"), "content_sha256")).otherwise(F.col("content_sha256"))
    new = documents.export_bucketed(rows.where("request_id % 10 <> 7").withColumn("content_sha256", changed), f"{root}/new", f"requests_new_{tag}")
    return manifest.change_diff(old, new, "request_id", "content_sha256").select("request_id", "bucket")


@query("""WITH b AS (SELECT o_orderkey, o_orderkey * 10 + 1 AS id_from, o_orderkey * 10 + 10 AS id_to, o_custkey FROM orders),
m AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM b WHERE o_custkey % 3 = 0)
SELECT (b.id_from || '-' || b.id_to) AS label, b.id_from, b.id_to, CASE WHEN m.n IS NULL THEN 'pending' ELSE 'merged' END AS status,
  CAST(CASE WHEN m.n = 1 THEN b.o_custkey * 7 WHEN m.n > 1 THEN 0 END AS BIGINT) AS record_count
FROM b LEFT JOIN m USING (o_orderkey) WHERE b.o_orderkey % 4 <> 0 OR m.n IS NOT NULL""")
def controller_rebuilt(spark, sf_dir):
    """Controller batches from what merge runs (a customer's orders) have taken; a quarter was never known."""
    o = catalog.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") * 10 + 1).alias("id_from"), (F.col("o_orderkey") * 10 + 10).alias("id_to"))
    o = o.withColumn("label", F.concat_ws("-", "id_from", "id_to"))
    batches = o.where("o_orderkey % 4 <> 0").select("label", "id_from", "id_to", F.lit(None).cast("string").alias("status"), F.lit(None).cast("bigint").alias("record_count"))
    taken = o.where("o_custkey % 3 = 0")
    runs = taken.select(F.col("o_custkey").cast("string").alias("run"), "label", F.col("o_orderkey").alias("place"))
    merged = taken.groupBy(F.col("o_custkey").cast("string").alias("run")).agg(F.min("o_orderkey").alias("seq"), (F.max("o_custkey") * 7).cast("bigint").alias("record_count"))
    return ranges.rebuilt_batches(batches, runs, merged)


@query("""WITH b AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'merged' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status, o_custkey AS n, 'clerk-' || (o_orderkey % 37) AS run FROM orders),
f AS (SELECT run, min(k) AS k FROM b GROUP BY run)
SELECT count_if(status = 'merged') AS merged_batches, CAST(coalesce(sum(n) FILTER (status = 'merged'), 0) AS BIGINT) AS captured_records, CAST(sum(5) AS BIGINT) AS dispatched_requested_ids,
  (SELECT string_agg(run, ',' ORDER BY run) FROM f) AS worker_runs, (SELECT string_agg(run, ',' ORDER BY k) FROM (SELECT * FROM f ORDER BY k DESC LIMIT 10)) AS recent_worker_runs FROM b""")
def controller_runs(spark, sf_dir):
    o = catalog.table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "merged").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    batches = o.select(F.col("o_orderkey").alias("id_from"), (F.col("o_orderkey") + 4).alias("id_to"), status.alias("status"), F.col("o_custkey").alias("record_count"), F.concat(F.lit("clerk-"), (F.col("o_orderkey") % 37).cast("string")).alias("worker_run_id"))
    one = ranges.summarised(batches)
    return one.select("merged_batches", "captured_records", "dispatched_requested_ids", F.array_join("worker_runs", ",").alias("worker_runs"), F.array_join("recent_worker_runs", ",").alias("recent_worker_runs"))


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderkey) AS place FROM orders) SELECT * FROM o""")
def status_order(spark, sf_dir):
    return mirrors.status_ordered(catalog.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "O"], "o_orderkey").select("o_orderkey", "place")


@query("""WITH s AS (SELECT o_orderkey // 500 AS k, min(o_orderkey) AS a, max(o_orderkey) + 1 AS b FROM orders GROUP BY 1), m AS (SELECT max(k) AS m FROM s),
done AS (SELECT k, k * 500 AS a, k * 500 + 500 AS b FROM s, m WHERE k < m - 1)
SELECT CAST((SELECT max(b) FROM done) AS BIGINT) AS next_offset, CAST((SELECT count(*) FROM done) + 1 AS BIGINT) AS spans, CAST(0 AS BIGINT) AS leased""")
def lease_spans(spark, sf_dir):
    """Spans of orders that are done; the next one is leased, given up, and stays open."""
    chunks = catalog.table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 500).alias("k")).distinct()
    top = chunks.agg(F.max("k")).first()[0]
    done = chunks.where(F.col("k") < top - 1).select(F.lit("done").alias("role"), (F.col("k") * 500).alias("start_offset"), (F.col("k") * 500 + 500).alias("end_offset"), F.lit(1).cast("bigint").alias("run_id"), F.lit(None).cast("string").alias("receipt"))
    spans = leases.empty(spark).unionByName(done)
    at = leases.next_offset(leases.checked(spans, (top + 1) * 500))
    held = leases.abandon(leases.reserve(spans, (top + 1) * 500, at, 500, 9), 9, at, 500, "failure", "log.txt", "d" * 64)
    again = leases.next_offset(held)
    return held.agg(F.lit(again).cast("bigint").alias("next_offset"), F.count("*").alias("spans"), F.count_if(F.col("role") == "lease").alias("leased"))


# --- parsing -----------------------------------------------------------------


@query("""SELECT o_orderkey, 'Request ' || o_orderkey AS title, 'Body ' || o_custkey AS authority, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'body-' || o_custkey END AS authority_slug,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority || ',' || o_orderstatus END AS tags, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'described' END AS state,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '2024' END AS first_seen, CAST(o_orderkey AS VARCHAR) AS request_id, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey END AS n FROM orders""")
def replay_json_fields(spark, sf_dir):
    """Documents whose authority is an object with tags, or a name; with fields that stand in for others."""
    o = catalog.table(spark, sf_dir, "orders")
    name = F.concat(F.lit("Body "), F.col("o_custkey").cast("string"))
    body = F.to_json(F.struct(name.alias("name"), F.concat(F.lit("body-"), F.col("o_custkey").cast("string")).alias("url_name"), F.lit("[TAGS]").alias("tags")))
    tags = F.concat(F.lit('[["'), F.col("o_orderpriority"), F.lit('","note"],"'), F.col("o_orderstatus"), F.lit('",7,null]'))
    body = F.replace(body, F.lit('"[TAGS]"'), tags)
    text = F.concat(
        F.lit('{"id":'), F.col("o_orderkey").cast("string"), F.lit(',"title":"Request '), F.col("o_orderkey").cast("string"), F.lit('",'),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('"public_body":{},"authority":"'), name, F.lit('"'))).otherwise(F.concat(F.lit('"public_body":'), body)),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(',"state":"'), F.col("o_orderstatus"), F.lit('"'))).otherwise(F.lit(',"state":"","described_state":"described"')),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).otherwise(F.lit(',"created_at":null,"date_created":"2024"')),
        F.lit(',"meta":{"record_count":'), F.when(F.col("o_orderkey") % 7 == 0, F.lit("null")).otherwise(F.col("o_orderkey").cast("string")), F.lit("}}"),
    )
    rows = o.select("o_orderkey", text.alias("t")).select("o_orderkey", replay_json.replay_fields(F.col("t")).alias("r"), replay_json.record_count(F.col("t")).alias("n"))
    return rows.select("o_orderkey", "r.title", "r.authority", "r.authority_slug", F.array_join("r.authority_tags", ",").alias("tags"), "r.state", "r.first_seen", "r.request_id", "n")


@query("""SELECT 'm' || (p_partkey // 50) || '-' || (p_partkey % 3) AS mirror, 'part-' || p_partkey AS name, CAST(p_size AS BIGINT) AS size,
  CASE p_partkey % 3 WHEN 0 THEN 'md5:' || p_partkey ELSE sha256(CAST(p_partkey AS VARCHAR)) END AS checksum, CASE p_partkey % 3 WHEN 0 THEN 'http://z/' || p_partkey WHEN 1 THEN 'http://o/' || p_partkey END AS url FROM part""")
def listing_artifacts(spark, sf_dir):
    """Listings of three shapes, fifty parts to each."""
    key = F.col("p_partkey").cast("string")
    digest = F.sha2(key, 256)
    one = F.to_json(F.struct(F.concat(F.lit("a/part-"), key).alias("key"), F.col("p_size").alias("filesize"), F.concat(F.lit("md5:"), key).alias("checksum"), F.struct(F.concat(F.lit("http://z/"), key).alias("self")).alias("links")))
    two = F.to_json(F.struct(F.struct(F.concat(F.lit("/b/part-"), key).alias("materialized_path"), F.lit("").alias("name"), F.col("p_size").alias("size"), F.struct(F.struct(digest.alias("sha256")).alias("hashes")).alias("extra")).alias("attributes"), F.struct(F.concat(F.lit("http://o/"), key).alias("html")).alias("links")))
    three = F.to_json(F.struct(F.concat(F.lit("part-"), key).alias("rfilename"), F.struct(F.col("p_size").alias("size"), digest.alias("sha256")).alias("lfs")))
    kind = F.col("p_partkey") % 3
    mirror = F.concat(F.lit("m"), F.floor(F.col("p_partkey") / 50).cast("string"), F.lit("-"), kind.cast("string"))
    rows = catalog.table(spark, sf_dir, "part").select(mirror.alias("mirror"), kind.alias("kind"), F.when(kind == 0, one).when(kind == 1, two).otherwise(three).alias("f"))
    name = F.when(F.col("kind") == 0, "files").when(F.col("kind") == 1, "data").otherwise("siblings")
    listings = rows.groupBy("mirror", "kind").agg(F.collect_list("f").alias("f")).select("mirror", F.concat(F.lit('{"'), name, F.lit('":['), F.array_join("f", ","), F.lit("]}")).alias("body"))
    return mirrors.listed_artifacts(listings)


# --- checks that name what is wrong ------------------------------------------


@query("""WITH m AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'retryable' ELSE 'terminal' END AS state FROM orders)
SELECT 'm' || k AS member_id, CASE WHEN k % 13 = 0 THEN 'member is outside the population' WHEN state = 'complete' THEN 'member has not failed' WHEN k % 11 = 0 THEN 'address is not the member''s' WHEN k % 7 = 0 THEN 'pinned row is missing'
  WHEN k % 9 = 0 THEN 'pinned row is ambiguous' WHEN k % 17 = 0 THEN 'pinned row does not match its digest' WHEN k % 19 = 0 THEN 'address is outside the approved scope' WHEN k % 23 = 0 THEN 'pinned row is another capture'
  WHEN k % 29 = 0 THEN 'archive address does not follow from the capture' WHEN k % 31 = 0 THEN 'capture is later than its retrieval' END AS problem FROM m""")
def replacement_checks(spark, sf_dir):
    """Replacements of failed members, with every kind of fault dealt over the orders."""
    k = F.col("o_orderkey")
    o = catalog.table(spark, sf_dir, "orders").select("o_orderkey")
    state = F.when(k % 4 == 0, "complete").when(k % 4 == 1, "retryable").otherwise("terminal")
    member, url, pin = F.concat(F.lit("m"), k.cast("string")), F.concat(F.lit("https://site.org/request/r"), k.cast("string")), F.sha2(k.cast("string"), 256)
    taken = F.lit("2024-01-02T03:04:05+00:00")
    members = o.where("o_orderkey % 13 <> 0").select(member.alias("member_id"), url.alias("canonical_url"), state.alias("state"))
    wanted = o.select(member.alias("member_id"), F.when(k % 11 == 0, F.concat(url, F.lit("x"))).otherwise(url).alias("candidate_url"), taken.alias("capture_timestamp"), pin.alias("source_row_sha256"))
    rows = o.unionByName(o.where("o_orderkey % 9 = 0")).where("o_orderkey % 7 <> 0").select(
        pin.alias("row_sha256"),
        F.when(k % 17 == 0, F.sha2(pin, 256)).otherwise(pin).alias("own_sha256"),
        F.when(k % 23 == 0, F.concat(member, F.lit("x"))).otherwise(member).alias("member_id"),
        url.alias("canonical_url"),
        taken.alias("capture_timestamp"),
        F.concat(F.lit("https://web.archive.org/web/"), F.when(k % 29 == 0, "20240102030406").otherwise("20240102030405"), F.lit("id_/"), url).alias("archive_url"),
        F.when(k % 19 == 0, "https://site.org/other/*").otherwise("https://site.org/request/*").alias("query_scope"),
        F.when(k % 31 == 0, "2024-01-01T00:00:00+00:00").otherwise("2024-02-01T00:00:00+00:00").alias("retrieved_at"),
    )
    return registry.replacement_problems(wanted, members, rows).select("member_id", "problem")


_HEADER = ["urlkey", "timestamp", "original", "statuscode", "digest"]


@query("""SELECT 's' || o_orderkey AS canonical_slug, CASE WHEN o_orderkey % 17 = 0 THEN 'no checkpoint' WHEN o_orderkey % 13 = 0 THEN 'not complete' WHEN o_orderkey % 11 = 0 THEN 'of another query' WHEN o_orderkey % 9 = 0 THEN 'names another body'
  WHEN o_orderkey % 7 = 0 THEN 'body is missing' WHEN o_orderkey % 19 = 0 THEN 'body was changed' WHEN o_orderkey % 23 = 0 THEN 'body holds other captures' WHEN o_orderkey % 29 = 0 THEN 'records differ from the body' END AS problem FROM orders""")
def checkpoint_bindings(spark, sf_dir):
    """Checkpoints of queries and the bodies that they name, with every kind of fault dealt over the orders."""
    k = F.col("o_orderkey")
    o = catalog.table(spark, sf_dir, "orders").select("o_orderkey")
    slug, kind, url = F.concat(F.lit("s"), k.cast("string")), F.lit("json"), F.concat(F.lit("https://site.org/request/s"), k.cast("string"))
    row = F.array(F.lit("key"), F.lit("20240101000000"), F.when(k % 23 == 0, F.concat(url, F.lit("/more"))).otherwise(url), F.lit("200"), F.lit("D"))
    records = F.when(k % 5 == 0, F.array().cast("array<array<string>>")).otherwise(F.array(row))
    records = F.when(k % 23 == 0, F.array(row)).otherwise(records)
    body = F.encode(F.when(F.size(records) > 0, F.to_json(F.concat(F.array(F.array(*[F.lit(h) for h in _HEADER])), records))).otherwise(F.lit("[]")), "UTF-8")
    name = F.concat(slug, F.lit("."), kind, F.lit(".json"))
    queries = o.select(slug.alias("canonical_slug"), kind.alias("media_kind"), url.alias("exact_url"))
    told = o.where("o_orderkey % 17 <> 0").select(
        slug.alias("canonical_slug"),
        kind.alias("media_kind"),
        F.when(k % 13 == 0, "pending").otherwise("complete").alias("status"),
        F.when(k % 11 == 0, F.concat(url, F.lit("x"))).otherwise(url).alias("exact_url"),
        records.alias("records"),
        F.when(k % 29 == 0, F.size(records) + 1).otherwise(F.size(records)).cast("bigint").alias("record_count"),
        F.when(k % 9 == 0, "other.json").otherwise(name).alias("response_body_filename"),
        F.sha2(F.when(k % 19 == 0, F.lit(b"x")).otherwise(body), 256).alias("response_sha256"),
        F.octet_length(body).cast("bigint").alias("response_byte_count"),
    )
    bodies = o.where("o_orderkey % 7 <> 0").select(name.alias("name"), body.alias("content"))
    return registry.bound_checkpoints(queries, told, bodies, _HEADER).select("canonical_slug", "problem")


@query("""WITH a AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN conv_id || ':0' WHEN turn = 3 THEN '' ELSE conv_id || ':' || turn END AS occurrence_id FROM conversations)
SELECT occurrence_id, count(*) AS n FROM a GROUP BY occurrence_id HAVING count(*) > 1 OR occurrence_id = ''""")
def occurrence_ids(spark, sf_dir):
    at = lambda x: F.concat(F.col("conv_id").cast("string"), F.lit(":"), x)
    ids = F.when(F.col("turn") % 5 == 4, at(F.lit("0"))).when(F.col("turn") == 3, "").otherwise(at(F.col("turn").cast("string")))
    return chains.occurrence_violations(catalog.table(spark, sf_dir, "conversations").select(ids.alias("occurrence_id")), "occurrence_id")


@query("""SELECT event_id, CASE WHEN user_id % 6 = 0 THEN 'unknown member' ELSE 'other identity' END AS problem FROM events WHERE user_id % 6 = 0 OR event_id % 10 = 0""")
def journal_identities(spark, sf_dir):
    e = catalog.table(spark, sf_dir, "events").select("event_id", "user_id")
    url = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    entries = e.withColumn("url", F.when(F.col("event_id") % 10 == 0, F.concat(url, F.lit("x"))).otherwise(url))
    members = e.select("user_id", url.alias("url")).distinct().where("user_id % 6 <> 0")
    return chains.identity_violations(entries, members, "user_id", "url").select("event_id", "problem")


@query("""SELECT 'f' || p_partkey AS path, CASE WHEN p_partkey % 10 = 0 THEN 'missing' WHEN p_partkey % 10 = 1 THEN 'not declared' ELSE 'differs' END AS problem FROM part WHERE p_partkey % 10 IN (0, 1, 2)""")
def inventory_differences(spark, sf_dir):
    p = catalog.table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("path"), F.col("p_size").cast("bigint").alias("bytes"), F.sha2("p_name", 256).alias("sha256"))
    declared = p.where("p_partkey % 10 <> 1")
    actual = p.where("p_partkey % 10 <> 0").withColumn("bytes", F.when(F.col("p_partkey") % 10 == 2, F.col("bytes") + 1).otherwise(F.col("bytes")))
    return mirrors.inventory_differences(declared, actual, "path", "bytes", "sha256")


@query("""SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'repeated' WHEN 1 THEN 'unknown' ELSE 'missing' END AS problem FROM orders WHERE o_orderkey % 10 IN (0, 1, 2)""")
def partition_problems(spark, sf_dir):
    o = catalog.table(spark, sf_dir, "orders").select("o_orderkey")
    outputs = o.where("o_orderkey % 10 <> 2").unionByName(o.where("o_orderkey % 10 = 0"))
    return mirrors.partition_problems(outputs, o.where("o_orderkey % 10 <> 1"), "o_orderkey")


@query("""WITH c AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'renamed' WHEN 1 THEN 'added' WHEN 2 THEN 'removed' ELSE 'updated' END AS bucket FROM orders)
SELECT 'unknown change bucket' AS rule, count_if(bucket = 'renamed') AS n FROM c UNION ALL SELECT 'change without a positive id', count_if(k % 7 = 0) FROM c UNION ALL SELECT 'change without a slug', count_if(k % 11 = 0) FROM c
UNION ALL SELECT 'added or updated change without a digest', count_if(bucket <> 'removed' AND k % 13 = 0) FROM c UNION ALL SELECT 'updated change without the previous digest', count_if(bucket = 'updated' AND k % 17 = 0) FROM c""")
def change_entry_rules(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = catalog.table(spark, sf_dir, "orders").select(
        F.when(k % 5 == 0, "renamed").when(k % 5 == 1, "added").when(k % 5 == 2, "removed").otherwise("updated").alias("bucket"),
        F.when(k % 7 == 0, 0).otherwise(k).alias("request_id"),
        F.when(k % 11 == 0, "").otherwise("slug").alias("url_title"),
        F.when(k % 13 == 0, "x").otherwise(F.sha2(k.cast("string"), 256)).alias("content_sha256"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.sha2(k.cast("string"), 256)).alias("previous_sha256"),
    )
    return spark.createDataFrame(list(checks.violations(rows, checks.change_rules()).items()), "rule string, n bigint")


@query("""SELECT sha256(text) AS sha256, max(octet_length(encode(text))) AS bytes FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def stored_objects(spark, sf_dir):
    """Texts as content-addressed objects: written once each, read back from their files."""
    body = F.encode("text", "UTF-8")
    rows = catalog.table(spark, sf_dir, "documents").where("text is not null").select(F.sha2(body, 256).alias("sha256"), body.alias("body"))
    root = files.shared_folder(spark, "objects")
    files.make_folder(spark, root)
    documents.store_objects(rows, root)
    return documents.read_objects(spark, root).select("sha256", "bytes")


@query("""SELECT page_id, 'https://web.archive.org/web/' || (20200101000000 + page_id) || 'id_/https://h.org/r/' || page_id || '?q=a%20b' AS replay_url FROM pages""")
def replay_urls(spark, sf_dir):
    url = F.concat(F.lit("https://h.org/r/"), F.col("page_id").cast("string"), F.lit("?q=a b"))
    return catalog.table(spark, sf_dir, "pages").select("page_id", urls.replay_url(url, (F.lit(20200101000000) + F.col("page_id")).cast("string")).alias("replay_url"))


@query("SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS request_id FROM orders WHERE o_orderstatus = 'F'")
def completed_ids(spark, sf_dir):
    """A ledger of captures, appended twice, and the ids that it has completed."""
    o = catalog.table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("request_id"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"))
    path = files.shared_folder(spark, "ledger")
    documents.append_ledger(rows, path)
    documents.append_ledger(rows.where("request_id % 2 = 0"), path)
    return readers.read_ledger(spark, path).select(F.col("request_id").cast("string").alias("request_id")).distinct()


@query("""SELECT DISTINCT CASE WHEN user_id % 3 = 0 THEN 'case-' || user_id WHEN user_id % 3 = 1 THEN 'e' || event_id ELSE 'i' || event_id END AS id FROM events""")
def takedown_inventory(spark, sf_dir):
    """Takedown rows that name a case, an event or a plain id, written and read as an inventory."""
    e = catalog.table(spark, sf_dir, "events")
    one = F.when(F.col("user_id") % 3 == 0, F.to_json(F.struct(F.concat(F.lit("case-"), F.col("user_id").cast("string")).alias("case_id"), F.lit("zz").alias("event_id"))))
    two = F.when(F.col("user_id") % 3 == 1, F.to_json(F.struct(F.lit("").alias("case_id"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"))))
    path = files.shared_folder(spark, "takedowns")
    e.select(F.coalesce(one, two, F.to_json(F.struct(F.concat(F.lit("i"), F.col("event_id").cast("string")).alias("id")))).alias("value")).write.text(path)
    return readers.read_takedowns(spark, path).select("id").distinct()


@query("""WITH m AS (SELECT conv_id, turn, role FROM conversations) SELECT CASE role WHEN 'user' THEN 'pending' WHEN 'assistant' THEN 'complete' ELSE 'terminal' END AS state, count(*) AS n FROM (SELECT conv_id, arg_max(role, turn) AS role FROM m GROUP BY conv_id) GROUP BY 1""")
def replay_state_counts(spark, sf_dir):
    """Members by their last state."""
    c = catalog.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", "pending").when(F.col("role") == "assistant", "complete").otherwise("terminal").alias("state"))
    last = chains.last_states(c.select("conv_id").distinct(), c, "conv_id", "turn", "state")
    return last.groupBy("state").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, event_id // 100 AS b, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, b, n, coalesce(sum(n) OVER (PARTITION BY 1 ORDER BY user_id, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, max(n) OVER (ORDER BY user_id, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM e""")
def running_totals(spark, sf_dir):
    """Running sum and maximum in a global order, by a scan in two levels."""
    from ..operators.prefix import scan

    e = catalog.table(spark, sf_dir, "events").groupBy("user_id", F.floor(F.col("event_id") / 100).alias("b")).agg(F.count("*").alias("n"))
    return scan(e, ["user_id", "b"], {"before": F.col("n")}, {"most": F.col("n")})


@query("""WITH o AS (SELECT o_custkey AS run, o_orderkey AS a FROM orders), w AS (SELECT *, max(a) OVER (PARTITION BY run ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM o)
SELECT run, a AS id_from, coalesce(a <> p + 1, true) AS first, CAST(sum(CASE WHEN coalesce(a <> p + 1, true) THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS island FROM w""")
def run_islands(spark, sf_dir):
    o = catalog.table(spark, sf_dir, "orders")
    labels = o.select(F.col("o_custkey").alias("run"), F.concat_ws("-", "o_orderkey", "o_orderkey").alias("label"), F.col("o_orderkey").alias("place"))
    return ranges.run_islands(labels).select("run", "id_from", "first", "island")


@query("""WITH k AS (SELECT max(o_orderkey) AS m FROM orders), b AS (SELECT unnest(generate_series(0, m // 2, 100)) AS a, m FROM k), s AS (SELECT max(a) + 100 AS start, max(m) AS m FROM b), p AS (SELECT unnest(generate_series(start, m, 100)) AS a, m FROM s LIMIT 20)
SELECT a || '-' || least(a + 99, m) AS label, CAST(a AS BIGINT) AS id_from, CAST(least(a + 99, m) AS BIGINT) AS id_to FROM p ORDER BY a LIMIT 20""")
def dispatch_plan(spark, sf_dir):
    """Half of the orders' ids are dispatched; the next twenty batches."""
    last = catalog.table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("m")).first()["m"]
    done = ranges.chunk_plan(spark, 0, last // 2 // 100 * 100 + 99, 100)
    return ranges.dispatch_plan(done, 0, last, 100, 20)


@query("""WITH r AS (SELECT o_orderkey // 50 AS k, count(*) AS n FROM orders WHERE o_orderkey < 1000 AND (o_orderkey // 50) % 7 <> 6 GROUP BY 1),
b AS (SELECT unnest(generate_series(0, 19)) AS k)
SELECT (k * 50) || '-' || (k * 50 + 49) AS label, CASE WHEN k < 8 AND n IS NOT NULL THEN 'merged' ELSE 'pending' END AS status, CAST(CASE WHEN k < 8 THEN n END AS BIGINT) AS record_count FROM b LEFT JOIN r USING (k) WHERE k < 15""")
def controller_transitions(spark, sf_dir):
    """Receipts of orders' batches in micro-batches of a controller: eight open at a time, one never comes back."""
    from ..streaming import control

    key = F.floor(F.col("o_orderkey") / 50)
    counted = catalog.table(spark, sf_dir, "orders").where("o_orderkey < 1000").groupBy(key.alias("k")).agg(F.count("*").alias("record_count")).where("k % 7 <> 6")
    receipts = counted.select("k", F.concat_ws("-", F.col("k") * 50, F.col("k") * 50 + 49).alias("label"), "record_count", F.lit("w").alias("worker_run_id"))
    folder = files.shared_folder(spark, "controller")
    step = control.controller_batches(folder, 0, 999, 50, 8)
    for number, part in enumerate((receipts.limit(0), receipts.where("k < 4"), receipts.where("k >= 4 and k < 8"))):
        step(part, number)
    state = control.load_state(files.filesystem(f"{folder}/state.json")[1])
    return spark.read.schema(control.BATCH).parquet(state["table"]).select("label", "status", "record_count")
