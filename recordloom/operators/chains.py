"""Ordered checks: strict order, hash chains, attempts, failure windows, recent runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.canonical import json_digest


def order_violations(rows: DataFrame, position: str, keys: list[str], shard: list[str] | None = None) -> DataFrame:
    """Rows whose keys do not exceed those of the row before, by position (inside shard columns, if given)."""
    w = Window.partitionBy(*(shard or [])).orderBy(position)
    mine = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    seen = rows.withColumn("_mine", mine)
    return seen.withColumn("_before", F.lag("_mine").over(w)).where(F.col("_before").isNotNull() & ~(F.col("_mine") > F.col("_before"))).drop("_mine", "_before")


def chain_violations(entries: DataFrame, shard: list[str] | None = None, digest: Column | None = None) -> DataFrame:
    """Breaks of a journal (sequence, previous_entry_sha256, entry_sha256[, body]): sequence, problem.

    Sequences count from 0, each entry names the digest of the one before, and
    ``digest`` (by default that of the canonical body) is the entry's own.
    """
    keys = shard or []
    w = Window.partitionBy(*keys).orderBy("sequence")
    own = digest if digest is not None else (json_digest(F.col("body")) if "body" in entries.columns else F.col("entry_sha256"))
    seen = entries.withColumns({"_i": F.row_number().over(w) - 1, "_before": F.lag("entry_sha256").over(w), "_own": own})
    problem = F.when(F.col("_i") != F.col("sequence"), "sequence").when(~F.col("_before").eqNullSafe(F.col("previous_entry_sha256")), "link").when(~F.col("_own").eqNullSafe(F.col("entry_sha256")), "digest")
    return seen.withColumn("problem", problem).where("problem is not null").select(*keys, "sequence", "problem")


def chain_entries(rows: DataFrame, shard: list[str], order: str, content: Column) -> DataFrame:
    """Journal rows whose link is the digest of the row before in the shard: adds sequence, previous_sha256, entry_sha256."""
    w = Window.partitionBy(*shard).orderBy(order)
    hashed = rows.withColumn("entry_sha256", F.sha2(content, 256))
    return hashed.withColumns({"sequence": (F.row_number().over(w) - 1).cast("bigint"), "previous_sha256": F.lag("entry_sha256").over(w)})


def attempt_violations(attempts: DataFrame, member: str, sequence: str, attempt: str) -> DataFrame:
    """Attempts whose number does not exceed the one before of the same member."""
    w = Window.partitionBy(member).orderBy(sequence)
    return attempts.withColumn("_before", F.lag(attempt).over(w)).where(F.col("_before") >= F.col(attempt)).drop("_before")


def occurrence_violations(attempts: DataFrame, occurrence: str) -> DataFrame:
    """Occurrence ids that are blank or not their attempt's alone: the id and how many attempts have it."""
    counted = attempts.groupBy(F.coalesce(occurrence, F.lit("")).alias(occurrence)).agg(F.count("*").alias("n"))
    return counted.where((F.col("n") > 1) | (F.col(occurrence) == ""))


def identity_violations(journal: DataFrame, members: DataFrame, member: str, *fields: str) -> DataFrame:
    """Journal entries about no member, or whose fields are not the member's: the entry and its problem."""
    known = members.select(member, F.struct(*fields).alias("_known"))
    mine = F.struct(*fields)
    problem = F.when(F.col("_known").isNull(), "unknown member").when(~mine.eqNullSafe(F.col("_known")), "other identity")
    return journal.join(known, member, "left").withColumn("problem", problem).drop("_known").where("problem is not null")


def last_states(members: DataFrame, journal: DataFrame, member: str, sequence: str, state: str, default: str = "pending") -> DataFrame:
    """Latest state of every member; members without entries have the default."""
    last = journal.groupBy(member).agg(F.max_by(state, sequence).alias(state))
    return members.select(member).join(last, member, "left").withColumn(state, F.coalesce(state, F.lit(default)))


def failure_windows(attempts: DataFrame, member: str, order: str, failed: Column, size: int) -> DataFrame:
    """Per attempt: failures and attempts among the last ``size``, and the current run of failures."""
    w = Window.partitionBy(member).orderBy(order)
    last = w.rowsBetween(-(size - 1), Window.currentRow)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = attempts.withColumn("_f", failed.cast("bigint"))
    marked = marked.withColumns({"window_failures": F.sum("_f").over(last), "window_size": F.count("*").over(last), "_island": F.sum(1 - F.col("_f")).over(upto)})
    run = Window.partitionBy(member, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("consecutive_failures", F.sum("_f").over(run)).drop("_f", "_island")


def recent_runs(rows: DataFrame, run: str, order: str, n: int) -> DataFrame:
    """The last ``n`` distinct runs by first appearance."""
    return rows.where(F.col(run).isNotNull()).groupBy(run).agg(F.min(order).alias("first_seen")).orderBy(F.desc("first_seen")).limit(n)


def page_violations(pages: DataFrame) -> DataFrame:
    """One row over index pages (page, header, fingerprint): gaps, repeats, header changes."""
    return pages.agg(
        (F.max("page") + 1 - F.count_distinct("page")).alias("missing_pages"),
        (F.count("*") - F.count_distinct("fingerprint")).alias("repeated_pages"),
        (F.count_distinct("header") - 1).alias("header_changes"),
        (F.count("*") - F.count_distinct("page")).alias("repeated_ordinals"),
    )
