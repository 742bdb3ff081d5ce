"""Queries over the driver's tables, each with the SQL that must give the same rows.

The tables stand in for archive data: `events` is the process-event log, `pages`
the URL inventory and capture index, `documents` the request manifest, `orders` the
backfill controller's batches. Roles are derived the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import text, urls
from ..operators import chains, checks, completeness, discovery, events, manifest, mirrors, prefix, projection, ranges, registry, replay

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- event log ---------------------------------------------------------------

LOG_SQL = """log AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS source_index, 'case-' || user_id AS case_id, event_type AS activity, value, ts,
    user_id || ':' || event_type || ':' || (event_id % 5) AS logical_id, user_id,
    row_number() OVER (PARTITION BY user_id, event_type, event_id % 5 ORDER BY ts, event_id) AS revision,
    CASE WHEN event_type = 'error' THEN 'retract' ELSE 'upsert' END AS operation
  FROM events),
takedown AS (SELECT 'case-' || s_suppkey AS id FROM supplier WHERE s_acctbal < 500),
kept AS (SELECT * FROM log WHERE case_id NOT IN (SELECT id FROM takedown) AND event_id NOT IN (SELECT id FROM takedown)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY logical_id ORDER BY revision DESC, event_id DESC) AS rn FROM kept) WHERE rn = 1),
active AS (SELECT * FROM latest WHERE operation <> 'retract')
"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    logical = F.concat_ws(":", F.col("user_id").cast("string"), "event_type", (F.col("event_id") % 5).cast("string"))
    revision = F.row_number().over(Window.partitionBy("logical_id").orderBy("ts", F.col("source_index")))
    log = e.select(F.col("event_id").cast("string").alias("event_id"), F.col("event_id").alias("source_index"), F.concat(F.lit("case-"), F.col("user_id").cast("string")).alias("case_id"), F.col("event_type").alias("activity"), "value", "ts", logical.alias("logical_id"), "user_id")
    return log.withColumns({"revision": revision.cast("bigint"), "operation": F.when(F.col("activity") == "error", "retract").otherwise("upsert")})


def takedowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").where("s_acctbal < 500")
    return s.select(F.concat(F.lit("case-"), F.col("s_suppkey").cast("string")).alias("id"))


def _active(spark, sf_dir):
    return events.active_events(event_log(spark, sf_dir), takedowns(spark, sf_dir))


@query(f"WITH {LOG_SQL} SELECT case_id, count(*) AS event_count, min(source_index) AS first_source_index, max(source_index) AS last_source_index FROM active GROUP BY case_id")
def event_projection_cases(spark, sf_dir):
    return events.cases(_active(spark, sf_dir))


@query(f"WITH {LOG_SQL} SELECT logical_id, event_id, CAST(revision AS BIGINT) AS revision, operation, case_id FROM latest")
def event_latest_revision(spark, sf_dir):
    kept = events.without_takedowns(event_log(spark, sf_dir), takedowns(spark, sf_dir))
    return events.latest_revisions(kept).select("logical_id", "event_id", "revision", "operation", "case_id")


@query(f"WITH {LOG_SQL} SELECT case_id, source_index, event_id, activity FROM active ORDER BY case_id, source_index, event_id")
def event_active_sorted(spark, sf_dir):
    return events.ordered(_active(spark, sf_dir)).select("case_id", "source_index", "event_id", "activity")


@query(f"WITH {LOG_SQL} SELECT DISTINCT logical_id, CAST(revision AS BIGINT) AS revision, event_id, activity, value FROM log")
def event_merge_dedup(spark, sf_dir):
    log = event_log(spark, sf_dir).select("logical_id", "revision", "event_id", "activity", "value")
    late = log.where("activity in ('purchase', 'signup')")
    return events.merge_shards(log.unionByName(late), check=False)


@query(f"""WITH {LOG_SQL}, shards AS (
  SELECT logical_id, revision, activity || ':' || value AS p FROM log
  UNION ALL SELECT logical_id, revision, activity || ':' || (value + CASE WHEN activity = 'click' THEN 1 ELSE 0 END) AS p FROM log)
SELECT logical_id, CAST(revision AS BIGINT) AS revision, count(DISTINCT p) AS n_payloads FROM shards GROUP BY ALL HAVING count(DISTINCT p) > 1""")
def event_merge_conflicts(spark, sf_dir):
    log = event_log(spark, sf_dir).select("logical_id", "revision", "activity", "value")
    changed = log.withColumn("value", F.col("value") + F.when(F.col("activity") == "click", 1).otherwise(0))
    return events.conflicts(log.unionByName(changed))


@query(f"WITH {LOG_SQL} SELECT event_id, case_id FROM kept")
def takedown_antijoin(spark, sf_dir):
    return events.without_takedowns(event_log(spark, sf_dir), takedowns(spark, sf_dir)).select("event_id", "case_id")


@query("""SELECT 'urn:request:' || user_id AS case_id, CAST(user_id AS BIGINT) AS request_id, c_name AS title, sha256(c_name) AS content_sha256
FROM (SELECT DISTINCT user_id FROM events) e JOIN customer ON c_custkey = user_id""")
def source_records(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("urn:request:"), F.col("user_id").cast("string")).alias("case_id"))
    mapped = e.withColumn("request_id", text.request_sequence(F.lit(None).cast("string"), F.col("case_id")))
    requests = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request_id"), F.col("c_name").alias("title"), F.sha2("c_name", 256).alias("content_sha256"))
    return events.source_records(mapped, requests).select("case_id", "request_id", "title", "content_sha256")


@query(f"""WITH {LOG_SQL}
SELECT (SELECT count(*) FROM log) AS merged_event_count, (SELECT count(*) FROM kept WHERE operation = 'retract') AS retracted_event_count,
  count(*) AS event_count, count(DISTINCT case_id) AS case_count, (SELECT count(*) FROM log) - count(*) AS excluded_event_count,
  count(DISTINCT case_id) = (SELECT count(*) FROM customer) AS request_count_reconciles FROM active""")
def projection_coverage(spark, sf_dir):
    log = event_log(spark, sf_dir)
    kept = events.without_takedowns(log, takedowns(spark, sf_dir))
    active = events.not_retracted(events.latest_revisions(kept))
    return events.coverage(log, kept, active, table(spark, sf_dir, "customer").count())


@query("""SELECT coalesce(c.case_id, r.case_id) AS case_id, c.case_id IS NOT NULL AS in_log, r.case_id IS NOT NULL AS in_manifest
FROM (SELECT DISTINCT 'case-' || user_id AS case_id FROM events) c FULL JOIN (SELECT 'case-' || c_custkey AS case_id FROM customer) r ON c.case_id = r.case_id""")
def case_request_reconcile(spark, sf_dir):
    log = event_log(spark, sf_dir).select(F.col("case_id").alias("url"))
    wanted = table(spark, sf_dir, "customer").select(F.concat(F.lit("case-"), F.col("c_custkey").cast("string")).alias("url"))
    found = completeness.membership(wanted, {"in_log": log})
    return found.select(F.col("url").alias("case_id"), "in_log", F.col("expected").alias("in_manifest"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def payload_field_extract(spark, sf_dir):
    payload = F.try_parse_json("props")
    index = F.try_variant_get(payload, "$.k", "bigint")
    return table(spark, sf_dir, "events").select("event_id", text.source_index(index, F.lit(None).cast("bigint"), F.lit(True), F.lit(False)).alias("k"))


@query("SELECT count_if(user_id IS NULL) AS no_case, count_if(event_type = '') AS no_activity, count(*) - count(DISTINCT event_id) AS repeated FROM events")
def event_rule_counts(spark, sf_dir):
    log = event_log(spark, sf_dir).withColumn("contract_version", F.lit("1.0.0"))
    checks.require(log, checks.event_rules())
    return log.agg(F.count_if(F.col("user_id").isNull()).alias("no_case"), F.count_if(checks.blank(F.col("activity"))).alias("no_activity"), (F.count("*") - F.count_distinct("event_id")).alias("repeated"))


# --- addresses ---------------------------------------------------------------

URL_SQL = r"""u AS (
  SELECT page_id, url, html, lower(regexp_extract(url, '^(https?)://', 1)) AS scheme, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages),
norm AS (
  SELECT *, scheme || '://' || lower(host) || CASE WHEN path IN ('', '/') THEN '/' ELSE rtrim(path, '/') END || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS strict_url FROM u),
req AS (
  SELECT *, regexp_replace(url, '^(https?://[^/]+)/[a-z]+/', '\1/request/') AS request_url,
    regexp_replace(rtrim(path, '/'), '^/[a-z]+/', '') AS leaf FROM norm)
"""


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _requests(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("request_url", F.regexp_replace("url", r"^(https?://[^/]+)/[a-z]+/", "$1/request/"))


@query(f"WITH {URL_SQL} SELECT page_id, strict_url FROM norm")
def url_normalize_strict(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", urls.require_urls(F.col("url")).alias("strict_url"))


@query(f"WITH {URL_SQL} SELECT page_id, scheme || '://' || lower(host) || CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS discovery_url FROM norm")
def url_normalize_tracking(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", urls.discovery_url(F.col("url"), exact=True).alias("discovery_url"))


@query(f"""WITH {URL_SQL} SELECT page_id, regexp_matches(regexp_replace(path, '^/[a-z]+/', '/request/'), '^/request/[^/?.]+$') AS is_page,
  CASE WHEN contains(leaf, '/') THEN '' ELSE regexp_replace(leaf, '\\.json$', '') END AS slug FROM req""".replace("\\\\", "\\"))
def url_canonical_filter(spark, sf_dir):
    u = F.col("request_url")
    return _requests(spark, sf_dir).select("page_id", urls.is_request_page(u).alias("is_page"), urls.request_slug(u).alias("slug"))


@query(f"WITH {URL_SQL} SELECT DISTINCT lower(host) || '/request/*' AS pattern FROM u")
def url_host_pattern(spark, sf_dir):
    return _pages(spark, sf_dir).select(urls.host_pattern(F.col("url")).alias("pattern")).distinct()


@query(f"WITH {URL_SQL} SELECT page_id, scheme = 'https' AND query = '' AND NOT contains(url, '#') AS safe, strict_url = 'https://www.' || lower(host) AS odd FROM norm")
def url_safety(spark, sf_dir):
    u = F.col("url")
    return _pages(spark, sf_dir).select("page_id", (urls.is_safe_https(u) & (urls.query(u) == "")).alias("safe"), urls.in_scope(urls.normalize_url(u), F.concat(F.lit("https://www."), urls.host(u))).alias("odd"))


@query(f"WITH {URL_SQL} SELECT count(DISTINCT x) AS n_urls, count(*) - count(DISTINCT x) AS n_duplicates, CAST(0 AS BIGINT) AS n_synthetic FROM (SELECT regexp_replace(strict_url, '\\?.*$', '') AS x FROM norm UNION ALL SELECT strict_url FROM norm)")
def inventory_duplicates(spark, sf_dir):
    p = _pages(spark, sf_dir).select("url")
    return completeness.inventory_counts(completeness.inventory(p.select(F.regexp_replace("url", r"[?#].*$", "").alias("url")).unionByName(p)))


# --- completeness ------------------------------------------------------------

CHANNEL_SQL = f"""{URL_SQL},
expected AS (SELECT DISTINCT strict_url AS url FROM norm WHERE NOT contains(host, 'spam')),
live AS (SELECT DISTINCT strict_url AS url FROM norm WHERE scheme = 'https'),
index AS (SELECT DISTINCT strict_url AS url FROM norm WHERE regexp_matches(host, '^(www|m|blog)\\.')),
second AS (SELECT DISTINCT strict_url AS url FROM norm WHERE query <> '' OR contains(path, '.html')),
member AS (SELECT url, url IN (FROM expected) AS e, url IN (FROM live) AS live, url IN (FROM index) AS index, url IN (FROM second) AS second
  FROM (FROM expected UNION FROM live UNION FROM index UNION FROM second))
"""


def _membership(spark, sf_dir):
    p = _pages(spark, sf_dir)
    u = F.col("url")
    strict = lambda df: df.select(urls.require_urls(u).alias("url"))
    channels = {
        "live": strict(p.where(urls.scheme(u) == "https")),
        "index": strict(p.where(urls.host(u).rlike(r"^(www|m|blog)\."))),
        "second": strict(p.where((urls.query(u) != "") | F.contains(urls.path(u), F.lit(".html")))),
    }
    return completeness.membership(strict(p.where(~F.contains(urls.host(u), F.lit("spam")))), channels)


_METRIC = "SELECT '{c}' AS channel, count_if({c}) AS observed, count_if(e AND {c}) AS matched, count_if(e AND NOT {c}) AS missing, count_if({c} AND NOT e) AS unexpected, round(100 * count_if(e AND {c}) / count_if(e), 4) AS percent, count_if(e AND NOT {c}) = 0 AS complete FROM member"


@query(f"WITH {CHANNEL_SQL} " + " UNION ALL ".join(_METRIC.format(c=c) for c in ("live", "index", "second")))
def completeness_channels(spark, sf_dir):
    return completeness.channel_metrics(_membership(spark, sf_dir), ["live", "index", "second"])


@query(f"WITH {CHANNEL_SQL} SELECT count(*) AS denominator, count_if(live OR index OR second) AS at_least_one, count_if(live AND index) AS dual, count_if(CAST(live AS INT) + CAST(index AS INT) + CAST(second AS INT) >= 2) AS redundant FROM member WHERE e")
def completeness_redundancy(spark, sf_dir):
    return completeness.redundancy(_membership(spark, sf_dir), ["live", "index", "second"])


@query(f"WITH {CHANNEL_SQL} SELECT url, 'missing' AS kind FROM ((FROM expected) EXCEPT (FROM index)) UNION ALL SELECT url, 'unexpected' FROM ((FROM index) EXCEPT (FROM expected))")
def completeness_missing_unexpected(spark, sf_dir):
    missing, unexpected = completeness.url_lists(_membership(spark, sf_dir), "index")
    return missing.withColumn("kind", F.lit("missing")).unionByName(unexpected.withColumn("kind", F.lit("unexpected")))


@query("""SELECT source, count(*) AS n, count_if(source = 'src1' OR starts_with(lower(trim(coalesce(text, ''))), 'the ') OR lower(coalesce(lang, '')) = 'test') AS odd
FROM documents GROUP BY source""")
def synthetic_exclusion(spark, sf_dir):
    title = F.regexp_replace(F.lower(F.trim(F.coalesce("text", F.lit("")))), "^the ", "synthetic ")
    flagged = text.is_synthetic(F.col("source") == "src1", F.col("lang"), title)
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(flagged).alias("odd"))


# --- discovery ---------------------------------------------------------------


RECONCILE_SQL = f"""{URL_SQL},
found AS (SELECT page_id, strict_url, CASE WHEN contains(path, '.html') THEN 'historical_discovery_candidate' ELSE 'authoritative_discovery' END AS role FROM norm),
live AS (SELECT DISTINCT strict_url AS u FROM norm JOIN documents ON doc_id = page_id AND lang = 'en')"""
_STATUS = "CASE WHEN u IS NOT NULL THEN 'live_captured' WHEN role = 'historical_discovery_candidate' THEN 'archive_only_candidate' ELSE 'unresolved' END"


def _reconciled(spark, sf_dir):
    p = _pages(spark, sf_dir).withColumn("url", urls.require_urls(F.col("url")))
    role = F.when(F.contains(urls.path(F.col("url")), F.lit(".html")), discovery.CANDIDATE).otherwise("authoritative_discovery")
    english = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("page_id"))
    return discovery.reconcile_candidates(p.select("page_id", "url", role.alias("evidence_role")), p.join(english, "page_id", "left_semi"))


@query(f"WITH {RECONCILE_SQL} SELECT page_id, {_STATUS} AS status FROM found LEFT JOIN live ON u = strict_url")
def reconcile_candidates(spark, sf_dir):
    return _reconciled(spark, sf_dir).select("page_id", "status")


@query(f"WITH {RECONCILE_SQL} SELECT {_STATUS} AS status, count(*) AS n FROM found LEFT JOIN live ON u = strict_url GROUP BY 1")
def reconcile_candidate_counts(spark, sf_dir):
    return replay.state_counts(_reconciled(spark, sf_dir), "status")


@query(f"""WITH {URL_SQL}, rec AS (
  SELECT scheme || '://' || lower(host) || '/' AS source_url, page_id AS row, sha256(html) AS d, regexp_matches(path, '\\.html$') AS c, 'p' || page_id AS title FROM u),
b AS (SELECT source_url, arg_min(title, (c, row)) AS title, arg_min(c, (c, row)) AS wc, arg_min(c, row) AS fc, count(*) AS n_evidence,
  string_agg(d, ',' ORDER BY row) FILTER (WHERE c) AS digests FROM rec GROUP BY source_url)
SELECT source_url, CASE WHEN wc THEN '' ELSE title END AS title, CASE WHEN wc THEN 'historical_discovery_candidate' ELSE 'authoritative_discovery' END AS evidence_role,
  n_evidence, coalesce(digests, '') AS digests FROM b""")
def historical_merge(spark, sf_dir):
    u = F.col("url")
    archived = F.endswith(urls.path(u), F.lit(".html"))
    site = F.concat(urls.scheme(u), F.lit("://"), urls.host(u), F.lit("/"))
    digest = F.sha2("html", 256)
    rows = _pages(spark, sf_dir).select(
        site.alias("source_url"), F.when(archived, "internet_archive_cdx").otherwise("morph_io").alias("source"), F.when(archived, discovery.CANDIDATE).otherwise("authoritative_discovery").alias("evidence_role"),
        F.col("page_id").cast("string").alias("source_record_id"), F.when(archived, "").otherwise(F.concat(F.lit("p"), F.col("page_id").cast("string"))).alias("title"), F.lit("").alias("authority"), F.lit("").alias("state"),
        F.lit("").alias("observed_at"), F.when(archived, digest).otherwise("").alias("archive_digest"), F.lit(0).alias("doc"), F.col("page_id").alias("row"))
    merged = discovery.merge_sources(rows)
    return merged.select("source_url", "title", "evidence_role", F.size("evidence_sources").cast("bigint").alias("n_evidence"), F.array_join("internet_archive_digests", ",").alias("digests"))


@query(f"""WITH {URL_SQL}, slugs AS (SELECT regexp_replace(leaf, '\\.html$', '') AS slug, scheme || '://' || host || path AS url, page_id FROM req),
q AS (SELECT slug, coalesce(arg_min(url, page_id) FILTER (WHERE NOT contains(url, '.html')), arg_max(url, page_id) FILTER (WHERE contains(url, '.html'))) AS url FROM slugs GROUP BY slug),
a AS (SELECT slug, string_agg(DISTINCT url, ' ' ORDER BY url) AS urls FROM slugs GROUP BY slug)
SELECT CAST(c_custkey AS VARCHAR) AS request_id, CAST(c_custkey AS VARCHAR) AS slug, coalesce(urls, '') AS urls, q.url FROM customer LEFT JOIN a ON a.slug = CAST(c_custkey AS VARCHAR) LEFT JOIN q ON q.slug = a.slug""")
def backfill_queue(spark, sf_dir):
    p = _requests(spark, sf_dir).withColumn("bare", F.regexp_replace("request_url", r"[?#].*$", ""))
    twin = F.regexp_replace("bare", r"\.html$", ".json")
    plain = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "", "")
    rows = p.select(urls.request_slug(twin).alias("slug"), twin.alias("request_url"), plain.alias("shown"), "page_id")
    shown = rows.groupBy("slug").agg(F.array_join(F.array_sort(F.collect_set("shown")), " ").alias("urls"))
    queue = discovery.canonical_queue(rows.select("slug", F.when(F.endswith("request_url", F.lit(".json")), F.concat("shown", F.lit(".json"))).otherwise(F.col("shown")).alias("url"), F.col("page_id").alias("ord")))
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("request_id"), F.col("c_custkey").cast("string").alias("slug"))
    out = wanted.join(shown, "slug", "left").join(queue, "slug", "left").orderBy(*discovery.numeric_first(F.col("request_id")))
    return out.select("request_id", "slug", F.coalesce("urls", F.lit("")).alias("urls"), F.regexp_replace("url", r"\.json$", "").alias("url"))


@query("""WITH q AS (SELECT o_orderkey AS id, 'orders' AS origin FROM orders WHERE o_orderstatus <> 'P'), i AS (SELECT o_orderkey AS id, 'incoming' AS origin FROM orders WHERE o_orderpriority = '1-URGENT'),
done AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R')
SELECT id, origin FROM (FROM i UNION ALL SELECT * FROM q WHERE id NOT IN (SELECT id FROM i)) WHERE id NOT IN (SELECT id FROM done)""")
def queue_minus_ledger(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    queued = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.lit("orders").alias("origin"))
    incoming = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"), F.lit("incoming").alias("origin"))
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return discovery.queue_minus_ledger(queued, incoming, done, "id")


CAPTURE_SQL = f"""{URL_SQL}, cap AS (
  SELECT page_id, regexp_extract(path, '/([0-9]+)', 1) AS slug, CASE WHEN contains(path, '.html') THEN 'html' ELSE 'json' END AS kind,
    CAST(20240101000000 + length(html) AS VARCHAR) AS timestamp, sha256(html) AS digest FROM u)"""


def _captures(spark, sf_dir):
    u = F.col("url")
    kind = F.when(F.contains(urls.path(u), F.lit(".html")), "html").otherwise("json")
    return _pages(spark, sf_dir).select("page_id", F.regexp_extract(urls.path(u), "/([0-9]+)", 1).alias("slug"), kind.alias("kind"), (F.lit(20240101000000) + F.length("html")).cast("string").alias("timestamp"), F.sha2("html", 256).alias("digest"))


@query(f"WITH {CAPTURE_SQL} SELECT slug, kind, arg_max(page_id, (timestamp, -page_id)) AS page_id FROM cap GROUP BY ALL")
def latest_capture(spark, sf_dir):
    return discovery.latest_captures(_captures(spark, sf_dir), ["slug", "kind"], "timestamp", "page_id").select("slug", "kind", "page_id")


@query(f"WITH {CAPTURE_SQL} SELECT slug, arg_min(page_id, (timestamp, page_id)) AS page_id, min(timestamp) AS timestamp FROM cap GROUP BY slug")
def earliest_capture(spark, sf_dir):
    return discovery.earliest_captures(_captures(spark, sf_dir), "slug", "timestamp", "page_id").select("slug", "page_id", "timestamp")


@query(f"""WITH {CAPTURE_SQL}, l AS (SELECT slug, kind, arg_max(digest, (timestamp, -page_id)) AS digest FROM cap GROUP BY ALL)
SELECT slug, arg_min(kind, kind = 'html') AS kind, arg_min(digest, kind = 'html') AS digest FROM l GROUP BY slug""")
def media_preference(spark, sf_dir):
    latest = discovery.latest_captures(_captures(spark, sf_dir), ["slug", "kind"], "timestamp", "page_id")
    return discovery.preferred_media(latest, "slug", "kind", "digest")


@query(f"WITH {CAPTURE_SQL} SELECT slug, kind FROM (SELECT CAST(c_custkey AS VARCHAR) AS slug FROM customer EXCEPT SELECT slug FROM cap) CROSS JOIN (VALUES ('json'), ('html')) k(kind)")
def missing_slug_plan(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("slug"))
    return discovery.missing_plan(wanted, _captures(spark, sf_dir), ["json", "html"])


# --- manifests ---------------------------------------------------------------


@query("SELECT doc_id AS request_id, '' AS title, coalesce(source, '') AS authority, coalesce(lang, '') AS state, FALSE AS html_captured FROM documents")
def manifest_normalize(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("authority"), F.col("lang").alias("state"))
    return manifest.normalize_records(rows).select("request_id", "title", manifest.authority_name(F.col("authority")).alias("authority"), "state", "html_captured")


@query("SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN d.source ELSE 'relabelled' END AS authority FROM documents d LEFT JOIN labels l USING (doc_id)")
def manifest_merge_last_wins(spark, sf_dir):
    first = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("authority"), F.lit(0).alias("file"))
    second = table(spark, sf_dir, "labels").select("doc_id", F.lit("relabelled").alias("authority"), F.lit(1).alias("file"))
    return manifest.merge_last_wins(first.unionByName(second), "doc_id", "file")


DIFF_SQL = """b AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents WHERE source <> 'src1'),
a AS (SELECT doc_id, sha256(coalesce(CASE WHEN lang = 'fr' THEN lower(text) ELSE text END, '')) AS h FROM documents WHERE source <> 'src2'),
d AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'added' WHEN a.doc_id IS NULL THEN 'removed' WHEN a.h <> b.h THEN 'updated' END AS bucket, a.h AS content_sha256, b.h AS previous_sha256 FROM b FULL JOIN a ON a.doc_id = b.doc_id)"""


def _diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    digest = lambda c: F.sha2(F.coalesce(c, F.lit("")), 256).alias("h")
    before = d.where("source <> 'src1'").select("doc_id", digest(F.col("text")))
    # lower-case ASCII and the accented letters alike on both sides
    after = d.where("source <> 'src2'").select("doc_id", digest(F.when(F.col("lang") == "fr", F.lower("text")).otherwise(F.col("text"))))
    return before, after


@query(f"WITH {DIFF_SQL} SELECT * FROM d WHERE bucket IS NOT NULL")
def manifest_change_diff(spark, sf_dir):
    return manifest.change_diff(*_diff(spark, sf_dir), "doc_id", "h")


@query(f"WITH {DIFF_SQL} SELECT doc_id, replace(bucket, 'updated', 'changed') AS bucket FROM d WHERE bucket IS NOT NULL")
def candidate_delta(spark, sf_dir):
    return manifest.candidate_delta(*_diff(spark, sf_dir), "doc_id", "h")


@query(f"WITH {DIFF_SQL} SELECT doc_id AS request_id, 'd' || doc_id AS url_title, 'd' || doc_id AS title, bucket AS state, content_sha256 FROM d WHERE bucket IN ('added', 'updated')")
def change_materialize(spark, sf_dir):
    found = manifest.change_diff(*_diff(spark, sf_dir), "doc_id", "h")
    named = found.select(F.col("doc_id").alias("request_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("url_title"), "bucket", "content_sha256")
    return manifest.change_rows(named)


@query("SELECT sha256(coalesce(text, '')) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_address_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "doc_id")
    return manifest.distinct_objects(rows, "digest", "doc_id")


@query("SELECT DISTINCT source AS authority FROM documents WHERE source <> ''")
def authority_summary(spark, sf_dir):
    return manifest.authorities(table(spark, sf_dir, "documents").select(F.col("source").alias("authority")))


@query("SELECT source AS authority, quality AS state, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def authority_state_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("authority")).join(table(spark, sf_dir, "labels"), "doc_id")
    return manifest.authority_state_counts(rows.withColumnRenamed("quality", "state"))


@query("SELECT n_name, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN r_name ELSE 'OTHER' END AS jurisdiction FROM nation LEFT JOIN region ON r_regionkey = n_regionkey")
def jurisdiction_lookup(spark, sf_dir):
    rules = table(spark, sf_dir, "region").where("r_name in ('ASIA', 'EUROPE')").select(text.body_tag(F.col("r_name")).alias("tag"), F.col("r_name").alias("jurisdiction"), F.col("r_regionkey").alias("ord"))
    named = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), text.body_tag(F.concat(F.lit(" "), F.col("r_name"), F.lit("!"))).alias("body"))
    rows = table(spark, sf_dir, "nation").join(F.broadcast(named), "n_regionkey", "left")
    return manifest.jurisdiction_of(rows, rules, "body").select("n_name", "jurisdiction")


@query("""SELECT n_name, arg_min(label, (label = 'OTHER', s_suppkey)) AS label FROM (
  SELECT n_name, s_suppkey, CASE WHEN s_acctbal > 2000 THEN 'S' || s_suppkey ELSE 'OTHER' END AS label FROM supplier JOIN nation ON n_nationkey = s_nationkey) GROUP BY n_name""")
def authority_first_label(spark, sf_dir):
    label = F.when(F.col("s_acctbal") > 2000, F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).otherwise("OTHER")
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("n_name", "s_suppkey", label.alias("label"))
    return manifest.first_label(rows, "n_name", "label", "s_suppkey")


@query("""WITH p AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 400000 THEN o_orderstatus END AS profile FROM orders),
g AS (SELECT o_custkey, min(profile) AS lo, max(profile) AS hi FROM p GROUP BY 1)
SELECT o_orderkey, coalesce(profile, CASE WHEN lo = hi THEN lo END, 'UNRESOLVED') AS resolved FROM p JOIN g USING (o_custkey)""")
def authority_propagation(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_totalprice") > 400000, F.col("o_orderstatus")).alias("profile"))
    return manifest.propagate_profiles(rows, "o_custkey", "profile").select("o_orderkey", "resolved")


@query("""SELECT state, count(*) AS n FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'partially_successful' WHEN '2-HIGH' THEN 'successful' WHEN '3-MEDIUM' THEN 'rejected'
  WHEN '5-LOW' THEN 'waiting_response' ELSE '' END AS state FROM orders) GROUP BY state""")
def state_normalize(spark, sf_dir):
    shown = F.when(F.col("o_orderpriority") == "1-URGENT", "This was  Partially successful.").when(F.col("o_orderpriority") == "2-HIGH", "Successful").when(F.col("o_orderpriority") == "3-MEDIUM", "The body refused it").when(F.col("o_orderpriority") == "5-LOW", "currently waiting for a response").otherwise("unknown")
    rows = table(spark, sf_dir, "orders").select(text.normalize_state(shown).alias("state"))
    return replay.state_counts(rows, "state")


# --- mirrors and controller --------------------------------------------------


@query("""SELECT p_name || p_partkey AS name, CAST(p_size AS BIGINT) AS size, s_suppkey IS NOT NULL AS present, CAST(s_suppkey % 50 AS BIGINT) = p_size AS size_matches,
  CASE WHEN s_acctbal > 1000 THEN sha256(p_brand) = sha256(p_brand || CASE WHEN s_suppkey < 20 THEN 'x' ELSE '' END) END AS checksum_matches
FROM part LEFT JOIN supplier ON s_suppkey = p_partkey""")
def artifact_compare(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"), F.col("p_size").cast("bigint").alias("size"), F.sha2("p_brand", 256).alias("sha256"), "p_partkey", "p_brand")
    s = table(spark, sf_dir, "supplier").join(p.select("name", "p_partkey", "p_brand"), F.col("s_suppkey") == F.col("p_partkey"))
    stated = F.sha2(F.concat("p_brand", F.when(F.col("s_suppkey") < 20, "x").otherwise("")), 256)
    remote = s.select("name", (F.col("s_suppkey") % 50).cast("bigint").alias("size"), F.when(F.col("s_acctbal") > 1000, F.concat(F.lit("sha256:"), stated)).otherwise("unknown").alias("sha256"))
    return mirrors.compare_artifacts(p.drop("p_partkey", "p_brand"), remote)


@query("""WITH c AS (SELECT 'local' AS mirror, count(*) AS n FROM orders UNION ALL SELECT 'hub', count(*) FROM orders WHERE o_totalprice > 10000 UNION ALL SELECT 'deposit', count(*) FROM orders WHERE o_orderkey IS NOT NULL),
b AS (SELECT n AS base FROM c WHERE mirror = 'local')
SELECT mirror, n, n - base AS difference, abs(n - base) <= greatest(25, base // 1000) AS within FROM c, b WHERE mirror <> 'local'""")
def mirror_parity(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    tagged = [("local", o), ("hub", o.where("o_totalprice > 10000")), ("deposit", o.where("o_orderkey is not null"))]
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(m).alias("mirror"), "n") for m, df in tagged]
    return mirrors.parity(counts[0].unionByName(counts[1]).unionByName(counts[2]))


@query("SELECT o_custkey, count(*) AS total, count_if(o_orderstatus = 'F') AS done, least(100.0, round(100 * count_if(o_orderstatus = 'F') / count(*), 4)) AS percent, CAST(ceil(count(*) * 0.95) AS BIGINT) AS target FROM orders GROUP BY o_custkey")
def coverage_percent(spark, sf_dir):
    by = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    return by.select("o_custkey", "total", "done", ranges.coverage_percent(F.col("done"), F.col("total"), 4).alias("percent"), F.ceil(F.col("total") * F.lit(0.95)).alias("target"))


BATCH_SQL = """batch AS (SELECT o_orderkey * 10 AS id_from, o_orderkey * 10 + 9 AS id_to, CASE o_orderstatus WHEN 'F' THEN 'merged' WHEN 'P' THEN '' ELSE 'failed' END AS raw,
  CAST(o_custkey AS BIGINT) AS record_count FROM orders)"""


def _batches(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "merged").when(F.col("o_orderstatus") == "P", "").otherwise("failed")
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 10).alias("id_from"), (F.col("o_orderkey") * 10 + 9).alias("id_to"), status.alias("status"), F.col("o_custkey").cast("bigint").alias("record_count"), F.lit("").alias("label"))
    return ranges.normalize_batches(rows)


@query(f"""WITH {BATCH_SQL} SELECT count(*) AS dispatched_batches, count_if(raw = '') AS pending_batches, count_if(raw = 'merged') AS merged_batches, bool_or(raw <> 'merged') AS has_pending,
  CAST(sum(id_to - id_from + 1) AS BIGINT) AS dispatched_requested_ids, CAST(sum(record_count) FILTER (WHERE raw = 'merged') AS BIGINT) AS captured_records FROM batch""")
def controller_summary(spark, sf_dir):
    return ranges.controller_summary(_batches(spark, sf_dir))


@query(f"WITH {BATCH_SQL} SELECT id_from || '-' || id_to AS label, id_from, id_to FROM batch WHERE raw = '' ORDER BY id_from LIMIT 20")
def pending_requeue(spark, sf_dir):
    return ranges.pending(_batches(spark, sf_dir), 20).select("label", "id_from", "id_to")


@query("""SELECT o_orderstatus AS site, n_orders, n_lines, n_orders >= n_lines OR abs(n_orders - n_lines) <= greatest(25, n_lines // 1000) AS fully_verified, greatest(25, n_lines // 1000) AS tolerance FROM (
  SELECT o_orderstatus, count(DISTINCT o_orderkey) AS n_orders, count(l_orderkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1 GROUP BY 1)""")
def backfill_verify(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    by = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").groupBy(F.col("o_orderstatus").alias("site")).agg(F.count_distinct("o_orderkey").alias("n_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))
    verdict = ranges.backfill_verification(F.col("n_orders"), F.col("n_lines"), [F.col("n_lines")])
    return by.select("site", "n_orders", "n_lines", verdict["fully_verified"].alias("fully_verified"), verdict["tolerance"].alias("tolerance"))


@query(f"""WITH {BATCH_SQL}, o AS (SELECT *, coalesce(max(id_to) OVER (ORDER BY id_from, id_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0) AS reach FROM batch)
SELECT CAST(coalesce((SELECT min(reach) FROM o WHERE id_from > reach OR raw <> 'merged'), max(id_to) + 1) AS BIGINT) AS next_id FROM batch""")
def verified_cursor(spark, sf_dir):
    return ranges.verified_cursor(_batches(spark, sf_dir), origin=0)


LEASE_SQL = "lease AS (SELECT l_orderkey * 7 + l_linenumber AS s, l_orderkey * 7 + l_linenumber + CAST(floor(l_quantity) AS BIGINT) % 3 + 1 AS e FROM lineitem)"


def _leases(spark, sf_dir):
    start = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(start.cast("bigint").alias("start_offset"), (start + F.floor("l_quantity") % 3 + 1).cast("bigint").alias("end_offset"))


@query(f"""WITH {LEASE_SQL}, o AS (SELECT *, greatest(0, coalesce(max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS reach FROM lease)
SELECT CAST(coalesce((SELECT min(reach) FROM o WHERE s > reach), max(e)) AS BIGINT) AS next_offset FROM lease""")
def first_gap(spark, sf_dir):
    return ranges.first_unclaimed(_leases(spark, sf_dir))


@query(f"""WITH {LEASE_SQL}, o AS (SELECT *, greatest(0, coalesce(max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS reach FROM lease)
SELECT CAST(reach AS BIGINT) AS gap_from, CAST(s AS BIGINT) AS gap_to FROM o WHERE s > reach""")
def range_gaps(spark, sf_dir):
    return ranges.gaps(_leases(spark, sf_dir)).select(F.col("gap_from").cast("bigint").alias("gap_from"), F.col("gap_to").cast("bigint").alias("gap_to"))


@query("""WITH r AS (SELECT user_id, event_id, event_id AS s, event_id + 20 + CAST(floor(value) AS BIGINT) AS e, event_type FROM events)
SELECT a.event_id AS event_a, b.event_id AS event_b FROM r a JOIN r b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e WHERE a.event_type = 'error' AND b.event_type = 'purchase'""")
def range_overlap(spark, sf_dir):
    r = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_id").alias("start_offset"), (F.col("event_id") + 20 + F.floor("value")).alias("end_offset"), "event_type")
    a, b = r.where("event_type = 'error'").drop("event_type"), r.where("event_type = 'purchase'").drop("event_type")
    return ranges.overlaps(a, b, ["user_id"], width=64).select(F.col("event_id_a").alias("event_a"), F.col("event_id_b").alias("event_b"))


@query("""WITH r AS (SELECT user_id, event_id AS s, event_id + CAST(floor(value) AS BIGINT) + 1 AS e FROM events)
SELECT user_id, s AS start_offset, e AS end_offset, p AS previous_end FROM (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY s, e) AS p FROM r) WHERE p > s""")
def adjacent_overlap(spark, sf_dir):
    r = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("start_offset"), (F.col("event_id") + F.floor("value") + 1).alias("end_offset"))
    return ranges.adjacent_overlaps(r, shard="user_id")


@query("SELECT event_id, user_id FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) WHERE p IS NOT NULL AND NOT value > p")
def strict_order_violations(spark, sf_dir):
    return chains.order_violations(table(spark, sf_dir, "events"), "event_id", ["value"], ["user_id"]).select("event_id", "user_id")


@query("""WITH h AS (SELECT user_id, event_id, sha256(event_type || ':' || props) AS entry_sha256 FROM events)
SELECT user_id, CAST(row_number() OVER w - 1 AS BIGINT) AS sequence, entry_sha256, lag(entry_sha256) OVER w AS previous_sha256 FROM h WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def hash_chain_entries(spark, sf_dir):
    chained = chains.chain_entries(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.concat_ws(":", "event_type", "props"))
    return chained.select("user_id", "sequence", "entry_sha256", "previous_sha256")


@query("""WITH h AS (SELECT user_id, event_type, sha256(event_type || ':' || props) AS d, row_number() OVER w - 1 AS i, lag(sha256(event_type || ':' || props)) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, CAST(i AS BIGINT) AS sequence, 'link' AS problem FROM h WHERE event_type = 'error' AND p IS NOT NULL""")
def hash_chain_check(spark, sf_dir):
    chained = chains.chain_entries(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.concat_ws(":", "event_type", "props"))
    tampered = chained.withColumn("previous_entry_sha256", F.when(F.col("event_type") == "error", F.when(F.col("sequence") == 0, F.col("previous_sha256")).otherwise(F.sha2(F.lit("tampered"), 256))).otherwise(F.col("previous_sha256")))
    return chains.chain_violations(tampered, ["user_id"], digest=F.col("entry_sha256"))


@query("SELECT conv_id, turn, role FROM (SELECT *, lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p >= length(text)")
def attempt_monotonic(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("attempt", F.length("text"))
    return chains.attempt_violations(rows, "conv_id", "turn", "attempt").select("conv_id", "turn", "role")


@query("SELECT c_custkey AS conv_id, coalesce(arg_max(role, turn), 'pending') AS role FROM customer LEFT JOIN conversations ON conv_id = c_custkey GROUP BY c_custkey")
def last_member_state(spark, sf_dir):
    members = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("conv_id"))
    return chains.last_states(members, table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


@query("""WITH f AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS f FROM events),
g AS (SELECT *, sum(1 - f) OVER (PARTITION BY user_id ORDER BY event_id) AS isl FROM f)
SELECT event_id, CAST(sum(f) OVER w AS BIGINT) AS window_failures, count(*) OVER w AS window_size, CAST(sum(f) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS BIGINT) AS consecutive_failures
FROM g WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def sliding_failure_ratio(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return chains.failure_windows(e, "user_id", "event_id", F.col("event_type") == "error", 10).select("event_id", "window_failures", "window_size", "consecutive_failures")


@query("SELECT user_id, min(event_id) AS first_seen FROM events GROUP BY user_id ORDER BY first_seen DESC LIMIT 10")
def recent_runs(spark, sf_dir):
    return chains.recent_runs(table(spark, sf_dir, "events"), "user_id", "event_id", 10)


@query("""WITH m AS (SELECT max(o_orderkey) AS m FROM orders), g AS (SELECT unnest(generate_series(0, m, 250)) AS a, m FROM m)
SELECT a || '-' || least(a + 249, m) AS label, CAST(a AS BIGINT) AS id_from, CAST(least(a + 249, m) AS BIGINT) AS id_to FROM g""")
def chunk_plan(spark, sf_dir):
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("m")).first()["m"]
    return ranges.chunk_plan(spark, 0, last, 250)


@query("""WITH y AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders), a AS (SELECT unnest(generate_series(lo, hi - 1, 2)) AS a, hi FROM y),
b AS (SELECT a || '-' || least(a + 1, hi - 1) AS id, CAST(a AS BIGINT) AS from_year, CAST(least(a + 1, hi - 1) AS BIGINT) AS to_year FROM a UNION ALL SELECT hi || '-open', hi, NULL FROM y)
SELECT id, from_year, to_year, count(o_orderkey) AS n_orders FROM b LEFT JOIN orders ON year(o_orderdate) BETWEEN from_year AND coalesce(to_year, 9999) GROUP BY ALL""")
def year_buckets(spark, sf_dir):
    """Buckets of two years over the years of the orders, the last open, with the orders of each."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).groupBy("y").agg(F.count("*").alias("n")).persist()
    bounds = orders.agg(F.min("y").alias("lo"), F.max("y").alias("hi")).first()
    plan = ranges.require_contiguous_years(ranges.year_buckets(spark, bounds["lo"], bounds["hi"], 2))
    joined = plan.join(orders, (F.col("y") >= F.col("from_year")) & (F.col("y") <= F.coalesce("to_year", F.lit(9999))), "left")
    return joined.groupBy("id", "from_year", "to_year").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"))


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def role_partition_counts(spark, sf_dir):
    return mirrors.role_counts(table(spark, sf_dir, "conversations"), "role")


@query("""SELECT code, disposition, count(*) AS n FROM (SELECT CASE WHEN event_type = 'purchase' THEN 'success' WHEN event_type = 'error' THEN 'http_503' WHEN event_type = 'view' THEN 'http_404' WHEN event_type = 'click' THEN 'timeout' ELSE 'malformed_content' END AS code,
  CASE WHEN event_type = 'purchase' THEN 'complete' WHEN event_type IN ('error', 'click') THEN 'retryable' ELSE 'terminal' END AS disposition FROM events) GROUP BY ALL""")
def outcome_counts(spark, sf_dir):
    kind = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type").isin("error", "view"), "http").when(F.col("event_type") == "click", "transport").otherwise("terminal")
    status = F.when(F.col("event_type") == "error", 503).otherwise(404)
    out = replay.outcome(kind, status, F.lit("timeout"), F.lit("malformed_content"), F.lit(True)).alias("o")
    return table(spark, sf_dir, "events").select(out).select("o.*").groupBy("code", "disposition").agg(F.count("*").alias("n"))


# --- registries and selections -----------------------------------------------


@query(f"WITH {URL_SQL} SELECT count(*) AS input_count, count_if(scheme = 'https') AS output_count FROM norm")
def index_filter_counts(spark, sf_dir):
    return registry.filtered_index(_pages(spark, sf_dir), urls.scheme(F.col("url")) == "https")[1]


@query(f"""WITH {URL_SQL} SELECT page_id, CASE WHEN contains(path, '.html') THEN 'json' ELSE 'html' END AS kind, regexp_replace(leaf, '\\.html$', '') AS slug
FROM req WHERE regexp_matches(path, '^/[a-z]+/[^/]+/?$')""".replace("\\\\", "\\"))
def capture_candidates(spark, sf_dir):
    twin = F.regexp_replace(F.regexp_replace("request_url", r"[?#].*$", ""), r"\.html$", ".json")
    rows = _requests(spark, sf_dir).select("page_id", twin.alias("original"), F.lit("200").alias("statuscode"))
    return registry.capture_candidates(rows).select("page_id", "kind", "slug")


BODY_SQL = "body AS (SELECT s_name AS slug, s_suppkey, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"


def _bodies(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    s = table(spark, sf_dir, "supplier").join(n, F.col("n_nationkey") == F.col("s_nationkey"))
    return s.select(F.col("s_name").alias("slug"), "s_suppkey", F.array(F.concat(F.lit("The "), F.col("n_name")), F.concat(F.col("r_name"), F.lit("!"))).alias("tags"))


def _rules(spark, sf_dir):
    r = table(spark, sf_dir, "region").where("r_name in ('ASIA', 'EUROPE')")
    return r.select(text.body_tag(F.col("r_name")).alias("tag"), F.col("r_name").alias("jurisdiction"), F.col("r_regionkey").alias("ord"))


@query(f"WITH {BODY_SQL} SELECT slug, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN r_name ELSE 'OTHER' END AS jurisdiction FROM body")
def body_jurisdictions(spark, sf_dir):
    return registry.body_jurisdictions(_bodies(spark, sf_dir), _rules(spark, sf_dir))


@query(f"WITH {BODY_SQL} SELECT slug, s_suppkey FROM body WHERE r_name = 'ASIA'")
def authority_selection(spark, sf_dir):
    return registry.bodies_of(_bodies(spark, sf_dir), _rules(spark, sf_dir), "ASIA", "s_suppkey").select("slug", "s_suppkey")


@query("""SELECT r_name AS instance_id, (SELECT string_agg(n_name, ',' ORDER BY n_name) FROM nation WHERE n_regionkey = r_regionkey) AS sites,
  coalesce((SELECT string_agg(s_name, ',' ORDER BY s_name) FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = r_regionkey), '') AS targets FROM region""")
def source_graph(spark, sf_dir):
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    instances = region.select(F.col("r_name").alias("instance_id"), F.col("r_regionkey").alias("host"))
    sites = nation.select(F.col("n_name").alias("site_id"), F.col("n_regionkey").alias("host"))
    targets = table(spark, sf_dir, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_name").alias("target_id"), F.col("n_name").alias("site_id"))
    graph = registry.source_graph(instances, sites, targets)
    return graph.select("instance_id", F.array_join("sites", ",").alias("sites"), F.array_join("targets", ",").alias("targets"))


@query("SELECT conv_id, arg_max(role, turn) AS role, max(turn) AS turn FROM conversations GROUP BY conv_id")
def rows_last_by_id(spark, sf_dir):
    return registry.last_by_id(table(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), "conv_id", "turn")


@query("SELECT event_id, json_extract_string(props, '$.k') AS value FROM events")
def json_pointer_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", registry.pointed(F.col("props"), "/k").alias("value"))


@query("SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25 OFFSET 50")
def deterministic_slice(spark, sf_dir):
    return registry.slice_of(table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 50, 25).select("o_orderkey")


@query("""SELECT conv_id AS site_id, count(*) AS pages, CAST(sum(length(text)) AS BIGINT) AS rows, max(turn) + 1 = count(*) AND count(DISTINCT text) = count(*) AS complete
FROM conversations GROUP BY conv_id""")
def site_totals(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("site_id"), F.col("turn").alias("page"), F.length("text").alias("rows"), F.sha2("text", 256).alias("fingerprint"))
    return registry.site_totals(pages)


@query("""WITH a AS (SELECT l_orderkey AS site_id, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS site_id, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT o_orderkey AS site_id, coalesce(a.n, 0) AS rows_now, coalesce(b.n, 0) AS rows_before, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta, CAST(NULL AS DOUBLE) AS coverage
FROM orders LEFT JOIN a ON a.site_id = o_orderkey LEFT JOIN b ON b.site_id = o_orderkey""")
def site_progress(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "site_id")
    by = lambda df: df.groupBy("site_id").agg(F.count("*").alias("rows"))
    return registry.progress(table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "site_id"), by(lines), by(lines.where("l_returnflag = 'A'")))


@query("""SELECT side, n_name FROM (SELECT 'missing' AS side, n_name FROM (SELECT n_name, n_regionkey FROM nation EXCEPT ALL SELECT n_name, CASE WHEN n_regionkey = 1 THEN 0 ELSE n_regionkey END FROM nation)
UNION ALL SELECT 'extra', n_name FROM (SELECT n_name, CASE WHEN n_regionkey = 1 THEN 0 ELSE n_regionkey END AS r FROM nation EXCEPT ALL SELECT n_name, n_regionkey FROM nation))""")
def mapping_difference(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    moved = n.withColumn("n_regionkey", F.when(F.col("n_regionkey") == 1, 0).otherwise(F.col("n_regionkey")))
    return registry.same_mapping(moved, n).select("side", "n_name")


# --- archived pages ----------------------------------------------------------


@query(r"SELECT page_id, sha256(html) AS content_sha256, regexp_replace(rtrim(url, '/'), '^.*/', '') AS request_key FROM pages")
def html_identity(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", F.sha2("html", 256).alias("content_sha256"), F.regexp_replace(F.regexp_replace("url", "/+$", ""), "^.*/", "").alias("request_key"))


@query()
def html_core_fields(spark, sf_dir):
    session.bounded_batches(spark)  # a batch of 10,000 pages is any number of bytes
    fields = _pages(spark, sf_dir).select("page_id", text.html_fields("html").alias("f")).select("page_id", "f.*")
    return fields.select("page_id", "title", "authority", "authority_slug", text.law_used(F.col("subtitle")).alias("law_used"), text.normalize_state(F.col("state_text")).alias("state"), "state_text", "first_seen", "last_updated")


@query()
def html_visible_text(spark, sf_dir):
    session.bounded_batches(spark)  # a batch of 10,000 pages is any number of bytes
    return _pages(spark, sf_dir).select("page_id", text.visible_text("html").alias("visible_text"))


# --- published projection ----------------------------------------------------


@query(f"""WITH {LOG_SQL}, a AS (SELECT 'case-' || l_suppkey AS case_id, CAST(l_orderkey AS VARCHAR) AS event_id FROM lineitem)
SELECT case_id, count(*) AS attachment_count FROM a WHERE case_id NOT IN (SELECT id FROM takedown) AND event_id NOT IN (SELECT id FROM takedown) GROUP BY case_id""")
def projection_attachments(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("case-"), F.col("l_suppkey").cast("string")).alias("case_id"), F.col("l_orderkey").cast("string").alias("event_id"))
    return projection.attachment_cases(projection.kept_attachments(rows, takedowns(spark, sf_dir)))


@query("""SELECT 'urn:request:' || user_id AS case_id, CAST(user_id AS BIGINT) AS request_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'https://u.test/' || c_custkey ELSE 'https://s.test/request/r' || c_custkey END AS canonical_url, sha256(c_name) AS content_sha256,
  CAST(c_custkey % 4 AS BIGINT) AS attachment_count, c_mktsegment AS source_state, 'canonical_archive' AS raw_material_location
FROM (SELECT DISTINCT user_id FROM events) e JOIN customer ON c_custkey = user_id""")
def published_source_records(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("urn:request:"), F.col("user_id").cast("string")).alias("case_id"))
    mapped = e.withColumn("request_id", text.request_sequence(F.lit(None).cast("string"), F.col("case_id")))
    k = F.col("c_custkey")
    requests = table(spark, sf_dir, "customer").select(
        k.cast("bigint").alias("request_id"), F.concat(F.lit("r"), k.cast("string")).alias("url_title"), F.when(k % 2 == 0, F.concat(F.lit("https://u.test/"), k.cast("string"))).otherwise("").alias("canonical_url"),
        F.sha2("c_name", 256).alias("content_sha256"), F.array_repeat(F.lit("x"), (k % 4).cast("int")).alias("attachments"), F.col("c_mktsegment").alias("state"))
    found = projection.published_records(mapped, requests, F.lit("https://s.test/"))
    return found.select("case_id", "request_id", "canonical_url", "content_sha256", "attachment_count", "source_state", "raw_material_location")


@query(f"""WITH {LOG_SQL}, a AS (SELECT 'case-' || l_suppkey AS case_id, CAST(l_orderkey AS VARCHAR) AS event_id FROM lineitem),
n AS (SELECT (SELECT count(DISTINCT case_id) FROM active) AS case_count, (SELECT count(*) FROM a WHERE case_id NOT IN (SELECT id FROM takedown) AND event_id NOT IN (SELECT id FROM takedown)) AS attachment_count,
  CAST(NULL AS BIGINT) AS source_record_count, (SELECT count(*) FROM customer) AS manifest_request_count, CAST((SELECT sum(c_custkey % 4) FROM customer) AS BIGINT) AS manifest_attachment_count, TRUE AS attachments_given)
SELECT *, manifest_request_count = case_count AS request_count_reconciles, manifest_attachment_count = attachment_count AS attachment_count_reconciles, TRUE AS source_record_count_reconciles FROM n""")
def projection_verdict(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("case-"), F.col("l_suppkey").cast("string")).alias("case_id"), F.col("l_orderkey").cast("string").alias("event_id"))
    files = projection.kept_attachments(rows, takedowns(spark, sf_dir)).agg(F.count("*").alias("attachment_count"))
    manifest_rows = table(spark, sf_dir, "customer").select(F.array_repeat(F.lit("x"), (F.col("c_custkey") % 4).cast("int")).alias("attachments"))
    figures = projection.manifest_figures(manifest_rows).select(F.col("requests").alias("manifest_request_count"), F.col("attachments").alias("manifest_attachment_count"))
    counts = _active(spark, sf_dir).agg(F.count_distinct("case_id").alias("case_count")).crossJoin(files).crossJoin(figures)
    return projection.reconciled(counts.withColumns({"source_record_count": F.lit(None).cast("bigint"), "attachments_given": F.lit(True)}))


@query("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(NULL AS BIGINT) AS size FROM nation UNION ALL SELECT CAST(p_partkey AS BIGINT), p_name, CAST(p_size AS BIGINT) FROM part")
def dynamic_union(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("bigint").alias("size"))
    return registry.union_all(a, b)


@query("SELECT r_name AS instance_id FROM region WHERE r_regionkey % 2 = 0")
def automation_targets(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select(F.col("r_name").alias("instance_id"), F.when(F.col("r_regionkey") % 2 == 0, F.lit(True)).alias("enabled"))
    return registry.automation_targets(rows).select("instance_id")


@query("SELECT n_name FROM nation WHERE n_nationkey IN (1, 3)")
def requested_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumn("key", F.col("n_nationkey").cast("string"))
    return registry.requested(rows, ["1", "3"], "key").select("n_name")


@query(f"WITH {URL_SQL} SELECT page_id, scheme = 'https' AND query = '' AND NOT contains(url, '#') AND NOT contains(host, '@') AS exact FROM u")
def url_exact_canonical(spark, sf_dir):
    u = F.col("url")
    return _pages(spark, sf_dir).select("page_id", urls.is_exact_canonical(u, urls.host(u)).alias("exact"))


@query("SELECT count_if(page_id % 7 = 0) AS bad_timestamp, CAST(0 AS BIGINT) AS bad_original, count_if(page_id % 5 = 0) AS bad_digest FROM pages")
def index_row_checks(spark, sf_dir):
    rows = _pages(spark, sf_dir).select(F.col("url").alias("original"), F.when(F.col("page_id") % 7 == 0, "2024").otherwise("20240101000000").alias("timestamp"), F.when(F.col("page_id") % 5 != 0, F.sha2("html", 256)).alias("digest"))
    names = ["bad_timestamp", "bad_original", "bad_digest"]
    return rows.agg(*[F.count_if(broken).alias(n) for n, (_, broken) in zip(names, registry.index_row_rules(), strict=True)])


@query("SELECT s_name AS mirror, CAST(s_suppkey % 3 AS BIGINT) AS n FROM supplier WHERE NOT (s_acctbal < 0 AND s_suppkey % 3 = 0)")
def mirror_eligibility(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("mirror"), F.when(F.col("s_acctbal") < 0, "unavailable").otherwise("ok").alias("status"), (F.col("s_suppkey") % 3).cast("bigint").alias("n"))
    return mirrors.eligible(rows).select("mirror", "n")


@query(f"""WITH {CAPTURE_SQL}, a AS (SELECT slug, 'https://a.test/request/' || slug || CASE WHEN page_id % 3 = 0 THEN '.json' ELSE '' END AS url, CASE WHEN page_id % 2 = 0 THEN digest ELSE '' END AS digest FROM cap WHERE slug <> ''),
g AS (SELECT slug, string_agg(DISTINCT url, ' ' ORDER BY url) AS urls, string_agg(DISTINCT digest, ' ' ORDER BY digest) FILTER (WHERE digest <> '') AS digests FROM a GROUP BY slug)
SELECT CAST(c_custkey AS VARCHAR) AS request_id, CAST(c_custkey AS VARCHAR) AS slug, coalesce(urls, '') AS urls, coalesce(digests, '') AS digests FROM customer LEFT JOIN g ON slug = CAST(c_custkey AS VARCHAR)""")
def reconciled_queue(spark, sf_dir):
    c = _captures(spark, sf_dir).where("slug <> ''")
    archive = c.select(F.concat(F.lit("https://a.test/request/"), "slug", F.when(F.col("page_id") % 3 == 0, ".json").otherwise("")).alias("url"), F.when(F.col("page_id") % 2 == 0, F.col("digest")).otherwise("").alias("digest"))
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("request_id"), F.col("c_custkey").cast("string").alias("slug"))
    found = discovery.reconciled_queue(wanted, archive)
    joined = lambda c: F.coalesce(F.array_join(c, " "), F.lit(""))
    return found.select("request_id", "slug", joined("archive_urls").alias("urls"), joined("archive_digests").alias("digests"))


@query(f"""WITH {BATCH_SQL}, r AS (SELECT o_orderkey * 10 AS id_from, o_custkey FROM orders WHERE o_totalprice > 300000)
SELECT batch.id_from || '-' || id_to AS label, CASE WHEN r.id_from IS NOT NULL THEN 'merged' WHEN raw = '' THEN 'pending' ELSE raw END AS status, CASE WHEN r.id_from IS NOT NULL THEN 1 ELSE record_count END AS record_count, 'w' || r.o_custkey AS worker_run_id
FROM batch LEFT JOIN r USING (id_from)""")
def merge_receipts(spark, sf_dir):
    k = F.col("o_orderkey") * 10
    receipts = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.concat_ws("-", k, k + 9).alias("label"), F.lit(1).cast("bigint").alias("record_count"), F.concat(F.lit("w"), F.col("o_custkey").cast("string")).alias("worker_run_id"))
    return ranges.mark_merged(_batches(spark, sf_dir), receipts).select("label", "status", "record_count", "worker_run_id")


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def approval_join(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return registry.approved(rows, table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey").select("s_suppkey", "n_name")


@query("SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def dimension_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return registry.looked_up(rows, table(spark, sf_dir, "region").select("r_regionkey", "r_name"), "r_regionkey").select("n_name", "r_name")


@query("SELECT n_name AS mirror, CAST(CASE WHEN n_regionkey = 1 THEN 99 ELSE n_regionkey END AS BIGINT) AS n FROM nation")
def report_upsert(spark, sf_dir):
    reports = table(spark, sf_dir, "nation").select(F.col("n_name").alias("mirror"), F.col("n_regionkey").cast("bigint").alias("n"))
    return mirrors.upsert_reports(reports, reports.where("n = 1").withColumn("n", F.lit(99).cast("bigint")))


@query(f"""WITH {CAPTURE_SQL}, l AS (SELECT slug, kind, arg_max(digest, (timestamp, -page_id)) AS digest FROM cap GROUP BY ALL),
s AS (SELECT slug, arg_min(kind, kind = 'html') AS kind FROM l GROUP BY slug), k AS (SELECT CAST(c_custkey AS VARCHAR) AS slug FROM customer UNION SELECT slug FROM cap)
SELECT slug, coalesce(kind, 'none') AS kind FROM k LEFT JOIN s USING (slug)""")
def completion_selection(spark, sf_dir):
    latest = discovery.latest_captures(_captures(spark, sf_dir), ["slug", "kind"], "timestamp", "page_id")
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("slug")).unionByName(latest.select("slug"))
    chosen, missing = discovery.complete_selection(keys, latest, "slug", "kind", "digest")
    return chosen.select("slug", "kind").unionByName(missing.select("slug", F.lit("none").alias("kind")))


@query("SELECT DISTINCT sha256(coalesce(text, '')) AS candidate_sha256 FROM documents")
def candidate_self_hash(spark, sf_dir):
    return replay.distinct_candidates(table(spark, sf_dir, "documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("candidate_sha256"), "doc_id")).select("candidate_sha256")


@query("""WITH i AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id FROM orders)
SELECT k AS o_orderkey, row_number() OVER (ORDER BY TRY_CAST(id AS BIGINT) IS NULL, TRY_CAST(id AS BIGINT), id) AS place FROM i""")
def type_aware_order(spark, sf_dir):
    mixed = F.when(F.col("o_orderkey") % 3 == 0, F.concat("o_orderpriority", F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", mixed.alias("id"))
    keys = {f"_k{i}": c for i, c in enumerate([F.col("id").try_cast("bigint").isNull(), F.col("id").try_cast("bigint"), F.col("id")])}
    return prefix.ordinals(rows.withColumns(keys), list(keys), "place").select("o_orderkey", (F.col("place") + 1).alias("place"))


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, count(*) OVER w AS n, coalesce(sum(o_custkey) OVER w, 0) AS b, count(*) OVER () AS every, sum(o_custkey) OVER () AS whole FROM orders
  WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE n < every * 9 // 10 AND b < whole * 3 // 4""")
def capped_queue(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    whole = rows.agg(F.count("*").alias("n"), F.sum("o_custkey").alias("b")).first()
    return ranges.cap_running(rows, "o_custkey", ["o_orderdate", "o_orderkey"], whole["n"] * 9 // 10, whole["b"] * 3 // 4).select("o_orderkey")


@query(f"WITH {BATCH_SQL} SELECT min(id_from) || '-' || max(id_to) AS label FROM batch")
def label_collapse(spark, sf_dir):
    return ranges.collapse_labels(_batches(spark, sf_dir))


@query("""WITH x AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 4 = 0 THEN 'https://x.test/' || p_partkey ELSE '' END AS e, CASE WHEN p_partkey % 3 <> 0 THEN 'https://s.test' END AS s FROM part)
SELECT p_partkey, coalesce(nullif(e, ''), CASE WHEN p_name <> '' THEN s || '/request/' || p_name END) AS url FROM x""")
def request_address(spark, sf_dir):
    k = F.col("p_partkey")
    explicit, source = F.when(k % 4 == 0, F.concat(F.lit("https://x.test/"), k.cast("string"))).otherwise(""), F.when(k % 3 != 0, F.lit("https://s.test//"))
    return table(spark, sf_dir, "part").select("p_partkey", urls.canonical_request_url(explicit, source, F.col("p_name")).alias("url"))


@query("SELECT conv_id, turn, right(coalesce(text, ''), 50) AS tail FROM conversations")
def text_tail(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.tail(F.col("text"), 50).alias("tail"))


@query("SELECT p_partkey, p_partkey % 5 >= 3 AS safe FROM part")
def relative_paths(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_name")
    at = F.when(k % 5 == 0, F.concat(F.lit("/"), n)).when(k % 5 == 1, F.concat(n, F.lit("/../x"))).when(k % 5 == 2, F.concat(F.lit("a//"), n)).otherwise(F.concat(F.lit("a/"), n))
    return table(spark, sf_dir, "part").select("p_partkey", text.safe_relative_path(at).alias("safe"))


@query("SELECT DISTINCT 'pkg+archive.' || strftime(ts, '%Y.%m') AS version FROM events")
def publication_versions(spark, sf_dir):
    return table(spark, sf_dir, "events").select(text.publication_version(F.lit("pkg"), F.col("ts")).alias("version")).distinct()


@query("SELECT DISTINCT lower(lang) AS language FROM documents WHERE lang IS NOT NULL")
def language_codes(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("lang is not null").select(text.language_of(F.concat(F.upper("lang"), F.lit("_NZ"))).alias("language")).distinct()


@query("SELECT coalesce(nullif(CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END, ''), 'id' || s_suppkey) AS slug, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_name END, nullif(CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END, ''), 'id' || s_suppkey) AS name FROM supplier")
def body_labels(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.when(k % 2 == 0, F.col("s_name")).otherwise(" ").alias("url_name"), F.concat(F.lit("id"), k.cast("string")).alias("id"), F.when(k % 3 == 0, F.col("s_name")).alias("title"), F.lit(None).cast("array<string>").alias("tags"))
    return registry.body_labels(rows).select("slug", "name")


@query("SELECT p_partkey, regexp_matches(p_brand, '^[A-Za-z0-9][A-Za-z0-9._-]{0,254}$') AS brand_safe, regexp_matches(p_name, '^[A-Za-z0-9][A-Za-z0-9._-]{0,254}$') AS name_safe FROM part")
def request_id_safety(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.safe_request_id(F.col("p_brand")).alias("brand_safe"), text.safe_request_id(F.col("p_name")).alias("name_safe"))


@query("SELECT max(turn) + 1 - count(DISTINCT turn) AS missing_pages, count(*) - count(DISTINCT text) AS repeated_pages, count(DISTINCT role) - 1 AS header_changes, count(*) - count(DISTINCT turn) AS repeated_ordinals FROM conversations")
def page_checks(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("turn").cast("bigint").alias("page"), F.col("role").alias("header"), F.col("text").alias("fingerprint"))
    return chains.page_violations(pages)


@query("""WITH c AS (SELECT s_suppkey IS NOT NULL AS present, CAST(s_suppkey % 50 AS BIGINT) = p_size AS size_matches FROM part LEFT JOIN supplier ON s_suppkey = p_partkey)
SELECT bool_and(present AND coalesce(size_matches, TRUE)) AS verified FROM c""")
def mirror_verdict(spark, sf_dir):
    return mirrors.mirror_verified(artifact_compare(spark, sf_dir).withColumn("checksum_matches", F.lit(None).cast("boolean")))


from . import stateful  # noqa: E402, F401  its queries register themselves
