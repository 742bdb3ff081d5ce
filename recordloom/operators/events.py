"""Event log to projection: merge, takedown, latest revision, roll-ups, coverage.

Rows have event_id, case_id, activity, logical_id, revision, operation,
source_index and optional columns; ``with_keys`` fills the defaults. The order of
steps matters: takedown runs before the choice of the latest revision, so an older
revision becomes active again when the newest is taken down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import Violation


def with_keys(events: DataFrame) -> DataFrame:
    """Defaults: logical id from the event id, revision 1."""
    cols = events.columns
    logical = F.coalesce(F.nullif(F.col("logical_id"), F.lit("")), F.col("event_id"), F.lit("")) if "logical_id" in cols else F.coalesce("event_id", F.lit(""))
    revision = F.coalesce(F.col("revision").cast("bigint"), F.lit(1)) if "revision" in cols else F.lit(1)
    return events.withColumns({"logical_id": logical, "revision": revision.cast("bigint")})


def _whole(df: DataFrame, skip: tuple[str, ...] = ()) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns) if c not in skip]))


def conflicts(events: DataFrame, payload: Column | None = None) -> DataFrame:
    """Logical revisions that claim different payloads: logical_id, revision, n_payloads.

    Only a digest of the payload is shuffled; equal deliveries collapse before it.
    """
    digest = F.sha2(_whole(events) if payload is None else payload, 256)
    keyed = events.select("logical_id", "revision", digest.alias("d")).groupBy("logical_id", "revision")
    # equal least and greatest digests are one payload; only of the others the number is of interest
    mixed = keyed.agg(F.min("d").alias("low"), F.max("d").alias("high")).where("low <> high").select("logical_id", "revision")
    found = events.select("logical_id", "revision", digest.alias("d")).join(mixed, ["logical_id", "revision"])
    return found.groupBy("logical_id", "revision").agg(F.count_distinct("d").alias("n_payloads"))


#: How an abort for two payloads of one revision begins.
CLASH = "two payloads for one logical revision:"


def payload_digest(events: DataFrame) -> Column:
    return F.sha2(_whole(events), 256)


def merged_or_fail(events: DataFrame, digest: Column, held: DataFrame | None = None) -> DataFrame:
    """One row per logical revision in one aggregate; the job that reads it fails where a revision has two payloads.

    With ``held`` (logical_id, revision, _digest) only revisions that are not in it are
    returned, and those that are must have the same digest.
    """
    row = F.struct(*[F.col(c) for c in events.columns])
    rows = events.select("logical_id", "revision", digest.alias("d"), row.alias("e"), F.lit(False).alias("old"))
    if held is not None:
        none = F.lit(None).cast(events.select(row.alias("e")).schema["e"].dataType)
        rows = rows.unionByName(held.select("logical_id", "revision", F.col("_digest").alias("d"), none.alias("e"), F.lit(True).alias("old")))
    one = rows.groupBy("logical_id", "revision").agg(F.min("d").alias("low"), F.max("d").alias("high"), F.bool_or("old").alias("old"), F.any_value("e", True).alias("e"))
    name = F.concat(F.lit(f"{CLASH} "), F.coalesce("logical_id", F.lit("null")), F.lit(":"), F.coalesce(F.col("revision").cast("string"), F.lit("null")))
    # the filter also decides which rows stay, so that no plan can leave the test out
    same = F.when(F.col("low") != F.col("high"), F.raise_error(name).cast("boolean")).otherwise(~F.col("old"))
    return one.where(same).select("e.*")


def merge_shards(events: DataFrame, payload: Column | None = None, check: bool = True) -> DataFrame:
    """One row per logical revision; repeated deliveries collapse, different payloads abort.

    With ``check`` the log is read once for conflicts, before anything else happens; without it
    the rows are those of ``merged_or_fail``, whose job fails on a conflict.
    """
    if not check:
        return merged_or_fail(events, F.sha2(_whole(events) if payload is None else payload, 256))
    if bad := conflicts(events, payload).take(1):
        raise Violation(f"{CLASH} {bad[0]['logical_id']}:{bad[0]['revision']}")
    return events.dropDuplicates(["logical_id", "revision"])


def without_takedowns(rows: DataFrame, takedowns: DataFrame, columns: tuple[str, ...] = ("case_id", "event_id")) -> DataFrame:
    """Rows whose case and event are not in the takedown list (column ``id``); null never matches.

    No broadcast is forced: the planner broadcasts the list where its size allows.
    """
    ids = takedowns.select("id").where("id is not null").distinct()
    for c in columns:
        rows = rows.join(ids, rows[c] == ids["id"], "left_anti")
    return rows


def takedown_ids(rows: DataFrame) -> DataFrame:
    """One id per takedown row: the first of case_id, event_id, id that is not blank."""
    cols = [F.nullif(F.col(c), F.lit("")) for c in ("case_id", "event_id", "id") if c in rows.columns]
    return rows.select(F.coalesce(*cols).alias("id")).where("id is not null").distinct()


def latest_revisions(events: DataFrame) -> DataFrame:
    """Newest revision per logical id; equal revisions go to the larger event id.

    ``max_by`` aggregates before the shuffle, so a logical id with many revisions
    moves one row per task.
    """
    top = F.max_by(F.struct(*[F.col(c) for c in events.columns]), F.struct("revision", "event_id"))
    return events.groupBy("logical_id").agg(top.alias("e")).select("e.*")


def not_retracted(events: DataFrame) -> DataFrame:
    return events.where(~F.col("operation").eqNullSafe("retract"))


def active_events(events: DataFrame, takedowns: DataFrame | None = None) -> DataFrame:
    """Takedown, latest revision, retraction, in this order."""
    kept = events if takedowns is None else without_takedowns(events, takedowns)
    return not_retracted(latest_revisions(kept))


def ordered(events: DataFrame) -> DataFrame:
    return events.orderBy("case_id", "source_index", "event_id")


def cases(events: DataFrame) -> DataFrame:
    """Per case: event count and first and last place in the source."""
    return events.groupBy("case_id").agg(F.count("*").alias("event_count"), F.min("source_index").alias("first_source_index"), F.max("source_index").alias("last_source_index"))


def source_records(events: DataFrame, requests: DataFrame) -> DataFrame:
    """Cases with the request that they map to (columns case_id, request_id of events).

    A case that maps to two requests aborts, whether or not they are in the
    manifest; cases absent from it are dropped. Of repeated requests the caller
    passes the last.
    """
    mapped = events.where("request_id is not null").groupBy("case_id").agg(F.min("request_id").alias("request_id"), F.max("request_id").alias("other"))
    bad = mapped.where("request_id <> other").limit(1).collect()
    if bad:
        raise Violation(f"case {bad[0]['case_id']} maps to requests {bad[0]['request_id']} and {bad[0]['other']}")
    return mapped.drop("other").join(requests, "request_id")


def coverage(merged: DataFrame, kept: DataFrame, active: DataFrame, expected_cases: int | None = None) -> DataFrame:
    """One row of counts. Superseded, retracted and taken-down events are all
    excluded; every retract row left after takedown counts as retracted."""
    one = merged.agg(F.count("*").alias("merged_event_count"))
    two = kept.agg(F.count_if(F.col("operation").eqNullSafe("retract")).alias("retracted_event_count"))
    three = active.agg(F.count("*").alias("event_count"), F.count_distinct("case_id").alias("case_count"))
    out = one.crossJoin(two).crossJoin(three).withColumn("excluded_event_count", F.col("merged_event_count") - F.col("event_count"))
    wanted = F.lit(expected_cases).cast("bigint")
    return out.withColumn("request_count_reconciles", F.coalesce(F.col("case_count") == wanted, F.lit(True)))
