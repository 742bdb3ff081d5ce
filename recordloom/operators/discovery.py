"""Historical discovery: merging sources, choosing captures, building queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from .checks import require_unique

CANDIDATE = "historical_discovery_candidate"


def merge_sources(records: DataFrame) -> DataFrame:
    """One row per source_url of several sources.

    ``records`` has source_url, source, evidence_role, source_record_id, title,
    authority, state, observed_at, archive_digest, and the arrival order doc, row.
    The first row wins, but the first authoritative row beats any candidate; then
    its blank fields count as absent. Evidence and digests keep every source, in
    order of arrival, without repeats.
    """
    order = F.struct("doc", "row")
    candidate = F.col("evidence_role") == CANDIDATE
    fields = ["source", "evidence_role", "source_record_id", "title", "authority", "state", "observed_at", "archive_digest"]
    evidence = F.struct(order.alias("at"), F.struct("source", "source_record_id", "observed_at", F.coalesce("archive_digest", F.lit("")).alias("archive_digest")).alias("e"))
    merged = records.groupBy("source_url").agg(
        F.min_by(F.struct(*fields), F.struct(candidate.alias("c"), order.alias("o"))).alias("w"),
        F.min_by("evidence_role", order).alias("first_role"),
        F.array_sort(F.collect_list(evidence)).alias("seen"),
    )
    replaced = (F.col("first_role") == CANDIDATE) & (F.col("w.evidence_role") != CANDIDATE)
    out = [F.when(replaced, F.nullif(F.col(f"w.{c}"), F.lit(""))).otherwise(F.col(f"w.{c}")).alias(c) for c in fields]
    digests = F.array_distinct(F.filter(F.transform("seen", lambda x: x["e"]["archive_digest"]), lambda d: d != ""))
    return merged.select("source_url", *out, F.array_distinct(F.transform("seen", lambda x: x["e"])).alias("evidence_sources"), digests.alias("internet_archive_digests"), F.lit(True).alias("capture_required"), F.lit("unverified").alias("verification_status"))


def reconcile_candidates(candidates: DataFrame, captured: DataFrame, url: str = "url", role: str = "evidence_role") -> DataFrame:
    """Status per candidate: live_captured, archive_only_candidate or unresolved."""
    live = captured.select(F.col(url).alias("_live")).distinct()
    status = F.when(F.col("_live").isNotNull(), "live_captured").when(F.col(role) == CANDIDATE, "archive_only_candidate").otherwise("unresolved")
    return candidates.join(live, candidates[url] == F.col("_live"), "left").withColumn("status", status).drop("_live")


def earliest_captures(rows: DataFrame, key: str, timestamp: str, *tie: str) -> DataFrame:
    """Earliest row per key; ties go to the smallest row."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(timestamp, *tie)).alias("r")).select("r.*")


def latest_captures(rows: DataFrame, keys: list[str], timestamp: str, order: str) -> DataFrame:
    """Latest row per keys; ties go to the row that came first."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), F.struct(F.col(timestamp), (-F.col(order)).alias("o"))).alias("r")).select("r.*")


def preferred_media(latest: DataFrame, key: str, kind: str, value: str) -> DataFrame:
    """Per key the JSON capture, else the HTML one: key, kind, value."""
    best = F.min_by(F.struct(kind, value), F.when(F.col(kind) == "json", 0).otherwise(1))
    return latest.groupBy(key).agg(best.alias("b")).select(key, f"b.{kind}", f"b.{value}")


def complete_selection(all_keys: DataFrame, latest: DataFrame, key: str, kind: str, value: str) -> tuple[DataFrame, DataFrame]:
    """The selection of captures and the keys without one; a repeated (key, kind) aborts."""
    require_unique(latest, "capture", key, kind)
    chosen = preferred_media(latest, key, kind, value)
    return chosen, all_keys.select(key).distinct().join(chosen, key, "left_anti")


def archive_by_slug(rows: DataFrame) -> DataFrame:
    """Archive rows (url, digest) grouped by request slug: sorted distinct urls and digests."""
    slugs = rows.withColumn("slug", urls.request_slug(F.col("url"))).where("slug <> ''")
    return slugs.groupBy("slug").agg(F.array_sort(F.collect_set("url")).alias("archive_urls"), F.array_sort(F.collect_set(F.nullif(F.col("digest"), F.lit("")))).alias("archive_digests"))


def numeric_first(column: Column) -> list[Column]:
    """Sort keys that put whole-number ids first, in number order."""
    number = F.when(column.rlike("^[0-9]+$"), column).try_cast("bigint")
    return [number.isNull(), number, column]


def reconciled_queue(manifest: DataFrame, archive: DataFrame) -> DataFrame:
    """Manifest (request_id, slug) with its archive evidence, numeric ids first; repeated ids or slugs abort."""
    require_unique(manifest, "request id", "request_id")
    require_unique(manifest, "request slug", "slug")
    return manifest.join(archive_by_slug(archive), "slug", "left").orderBy(*numeric_first(F.col("request_id")))


def canonical_queue(rows: DataFrame) -> DataFrame:
    """One address per slug of rows (slug, url, ord): the first that is no .json, else the last .json."""
    is_json = F.endswith(F.col("url"), F.lit(".json"))
    page = F.min_by(F.when(~is_json, F.col("url")), F.when(~is_json, F.col("ord")))
    twin = F.max_by(F.when(is_json, F.col("url")), F.when(is_json, F.col("ord")))
    return rows.groupBy("slug").agg(F.coalesce(page, twin).alias("url"))


def queue_minus_ledger(queued: DataFrame, incoming: DataFrame, completed: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Queue and incoming rows once by key, the last winning, without completed keys.

    Incoming rows come after queued ones; ``order`` tells which of the same side is last
    (without it the greatest row is taken, so that the result is the same on any number of tasks).
    """
    columns = queued.columns
    at = F.col(order) if order else F.struct(*columns)
    tagged = [df.select(F.struct(*columns).alias("r"), F.struct(F.lit(side).alias("side"), at.alias("at")).alias("o")) for side, df in enumerate((queued, incoming.select(columns)))]
    last = tagged[0].unionByName(tagged[1]).groupBy(F.col(f"r.{key}").alias("k")).agg(F.max_by("r", "o").alias("r")).select("r.*")
    return last.join(completed.select(key).distinct(), key, "left_anti")


def missing_plan(all_slugs: DataFrame, selected: DataFrame, kinds: list[str], key: str = "slug") -> DataFrame:
    """Queries for slugs without a capture: each slug with each of a few kinds.

    The kinds are a fixed list, so they are exploded in place of a join.
    """
    missing = all_slugs.select(key).distinct().join(selected.select(key).distinct(), key, "left_anti")
    return missing.select(key, F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"))
