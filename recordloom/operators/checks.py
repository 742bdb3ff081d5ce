"""Fail-closed validation.

A rule is a name and a column that is true where the rule is broken. All rules of
a table run as one aggregate: an action of its own, because Spark drops assertions
in columns that nobody reads. The first broken rule in declared order aborts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


class Violation(ValueError):
    """A table breaks a rule."""


def violations(df: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """Rows that break each rule, in declared order; null counts as not broken."""
    row = df.agg(*[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{i}") for i, (_, broken) in enumerate(rules)]).first()
    return {name: row[f"r{i}"] for i, (name, _) in enumerate(rules)}


def require(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The table itself, if it breaks no rule."""
    for name, n in violations(df, rules).items():
        if n:
            raise Violation(f"{name} ({n} rows)")
    return df


def messages(df: DataFrame, rules: list[Rule]) -> list[str]:
    """Names of all broken rules."""
    return [name for name, n in violations(df, rules).items() if n]


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).count().where("count > 1")


def require_unique(df: DataFrame, what: str, *keys: str) -> DataFrame:
    if not unique(df, *keys).isEmpty():
        raise Violation(f"duplicate {what}")
    return df


def require_same(a: DataFrame, b: DataFrame, what: str) -> None:
    """Both tables hold the same rows, each as often."""
    if not a.exceptAll(b).isEmpty() or not b.exceptAll(a).isEmpty():
        raise Violation(f"{what} differ")


def is_digest(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


CONTRACT = "1.0.0"


def event_rules() -> list[Rule]:
    """Rules of process events."""
    return [
        ("event without event_id", blank(F.col("event_id"))),
        ("event without case_id", blank(F.col("case_id"))),
        ("event without activity", F.col("activity").isNull()),
        ("unsupported contract version", F.coalesce(F.col("contract_version"), F.lit(CONTRACT)) != CONTRACT),
    ]



def manifest_rules(sources: list[str], instance_id: str | None = None, jurisdiction: str | None = None) -> list[Rule]:
    """Rules of a manifest's one-row table: source, instance_id, jurisdiction, record_count, n_requests, n_bad_ids, n_bad_hashes."""
    rules = [
        ("unknown source", ~F.coalesce(F.col("source").isin(sources), F.lit(False))),
        ("record count differs from requests", ~F.col("record_count").eqNullSafe(F.col("n_requests"))),
        ("request without a positive id", F.col("n_bad_ids") > 0),
        ("content hash is not 64 characters", F.col("n_bad_hashes") > 0),
    ]
    if instance_id is not None:
        rules.insert(1, ("instance mismatch", ~F.col("instance_id").eqNullSafe(F.lit(instance_id))))
    if jurisdiction is not None:
        rules.insert(1, ("jurisdiction mismatch", ~F.col("jurisdiction").eqNullSafe(F.lit(jurisdiction))))
    return rules


def manifest_problems(meta: DataFrame, requests: DataFrame, sources: list[str], instance_id: str | None = None, jurisdiction: str | None = None) -> list[str]:
    """Broken rules of a manifest: its meta row and its requests (request_id, content_sha256), counted in one pass."""
    fields = {c: F.col(c) if c in meta.columns else F.lit(None).cast("string") for c in ("source", "instance_id", "jurisdiction", "record_count")}
    digest = F.col("content_sha256") if "content_sha256" in requests.columns else F.lit(None).cast("string")
    counted = requests.agg(F.count("*").alias("n_requests"), F.count_if(F.coalesce(F.col("request_id") < 1, F.lit(True))).alias("n_bad_ids"), F.count_if(F.coalesce(F.length(digest), F.lit(64)) != 64).alias("n_bad_hashes"))
    one = meta.select(*[v.alias(k) for k, v in fields.items()]).withColumn("record_count", F.col("record_count").cast("bigint")).crossJoin(counted)
    return messages(one, manifest_rules(sources, instance_id, jurisdiction))


def change_rules() -> list[Rule]:
    """Rules of change entries (bucket, request_id, url_title, digests)."""
    return [
        ("unknown change bucket", ~F.col("bucket").isin("added", "updated", "removed")),
        ("change without a positive id", F.coalesce(F.col("request_id"), F.lit(0)) < 1),
        ("change without a slug", blank(F.col("url_title"))),
        ("added or updated change without a digest", (F.col("bucket") != "removed") & ~is_digest(F.col("content_sha256"))),
        ("updated change without the previous digest", (F.col("bucket") == "updated") & ~is_digest(F.col("previous_sha256"))),
    ]


# Raw fields that a derived layer must not carry.
FORBIDDEN_FIELDS = ["request_body", "message_body", "ocr_text", "embedding", "embedding_vector", "attachment_bytes"]


def derived_rules(columns: list[str]) -> list[Rule]:
    """Rules of derived records (candidate_id, source_revision, any other columns)."""
    raw = sorted(set(columns) & set(FORBIDDEN_FIELDS))
    return [
        (f"raw fields in the derived layer: {', '.join(raw)}", F.lit(bool(raw))),
        ("candidate without an id", blank(F.col("candidate_id"))),
        ("candidate without a pinned revision", ~F.coalesce(F.col("source_revision").rlike("^[0-9a-f]{40}$|^[0-9a-f]{64}$"), F.lit(False))),
    ]


def range_rules() -> list[Rule]:
    """Rules of half-open offset ranges."""
    return [
        ("range without bounds", F.col("start_offset").isNull() | F.col("end_offset").isNull()),
        ("range is empty or backward", F.col("start_offset") >= F.col("end_offset")),
        ("range before the origin", F.col("start_offset") < 0),
    ]

