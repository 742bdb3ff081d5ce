"""Tables and figures of a published projection: attachments, source records, revisions, coverage."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from .checks import CONTRACT, Violation
from .events import without_takedowns

# What a source record says about where raw material is.
RAW_LOCATION = "canonical_archive"


def kept_attachments(attachments: DataFrame, takedowns: DataFrame | None = None) -> DataFrame:
    """Attachment rows (case_id, event_id, contract_version, ...) that no takedown names.

    A row that is kept and has another contract version aborts; rows taken down may have any.
    """
    kept = attachments if takedowns is None else without_takedowns(attachments, takedowns)
    if "contract_version" in kept.columns:
        bad = kept.where(F.coalesce("contract_version", F.lit(CONTRACT)) != CONTRACT).take(1)
        if bad:
            raise Violation(f"unsupported attachment contract version {bad[0]['contract_version']}")
    return kept


def attachment_cases(attachments: DataFrame) -> DataFrame:
    """Attachments per case."""
    return attachments.groupBy("case_id").agg(F.count("*").alias("attachment_count"))


def request_of_case(events: DataFrame) -> DataFrame:
    """The one request that a case's events name: case_id, request_id; two different ones abort."""
    seen = events.where("request_id is not null").groupBy("case_id").agg(F.min("request_id").alias("request_id"), F.max("request_id").alias("other"))
    bad = seen.where("request_id <> other").take(1)
    if bad:
        raise Violation(f"case {bad[0]['case_id']} maps to requests {bad[0]['request_id']} and {bad[0]['other']}")
    return seen.drop("other")


def _of(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def published_records(events: DataFrame, requests: DataFrame, source: Column | None = None) -> DataFrame:
    """Source records as published, one per case whose request is in the manifest, in order of case.

    ``requests`` has one row per request_id and any of url_title, canonical_url, url,
    content_sha256, warc_record_ids, attachments, state, license, attribution; ``source`` is
    the manifest's address, from which addresses are built that are not stated.
    """
    sizes = F.size("attachments") if "attachments" in requests.columns else F.lit(0)
    stated = F.coalesce(F.nullif(_of(requests, "canonical_url", "string"), F.lit("")), _of(requests, "url", "string"))
    rows = requests.select(
        "request_id",
        urls.canonical_request_url(stated, F.lit(None).cast("string") if source is None else source, _of(requests, "url_title", "string")).alias("canonical_url"),
        _of(requests, "content_sha256", "string").alias("content_sha256"),
        F.coalesce(_of(requests, "warc_record_ids", "array<string>"), F.array().cast("array<string>")).alias("warc_record_ids"),
        F.greatest(F.coalesce(sizes, F.lit(0)), F.lit(0)).cast("bigint").alias("attachment_count"),
        _of(requests, "state", "string").alias("source_state"),
        _of(requests, "license", "string").alias("source_license"),
        _of(requests, "attribution", "string").alias("source_attribution"),
        F.lit(RAW_LOCATION).alias("raw_material_location"),
    )
    return request_of_case(events).join(rows, "request_id").select("case_id", *rows.columns).orderBy("case_id")


def revision_row(active: DataFrame, revision: str | None, captured_at: str | None = None) -> DataFrame:
    """One row that describes the projection: revision, captured_at, event_count, case_count."""
    name = revision or "local"
    return active.agg(F.lit(name).alias("revision"), F.lit(captured_at or name).alias("captured_at"), F.count("*").alias("event_count"), F.count_distinct("case_id").alias("case_count"))


def manifest_figures(requests: DataFrame) -> DataFrame:
    """One row over a manifest's requests: how many, their attachments, and rehearsal rows among them."""
    sizes = F.greatest(F.coalesce(F.size("attachments"), F.lit(0)), F.lit(0)) if "attachments" in requests.columns else F.lit(0)
    return requests.agg(F.count("*").alias("requests"), F.coalesce(F.sum(sizes), F.lit(0)).cast("bigint").alias("attachments"), F.count_if(_of(requests, "state", "string") == "dry-run").alias("rehearsals"))


def reconciled(counts: DataFrame) -> DataFrame:
    """Verdict columns on one row of counts: case_count, attachment_count, source_record_count (null without a manifest),
    manifest_request_count, manifest_attachment_count (null without one), attachments_given."""
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(True))
    return counts.withColumns(
        {
            "request_count_reconciles": same("manifest_request_count", "case_count"),
            "attachment_count_reconciles": ~F.col("attachments_given") | same("manifest_attachment_count", "attachment_count"),
            "source_record_count_reconciles": same("source_record_count", "case_count"),
        }
    )


def reconciliation_note(text: str) -> dict:
    """What coverage says of a source reconciliation document: its schema, candidates and counts by status."""
    document = json.loads(text)
    note = {"schema": None, "candidate_count": 0, "counts": {}}
    return note | {k: document[k] for k in note if k in document} if isinstance(document, dict) else note
