"""Leases on ranges of a queue, as a table of spans.

A span is a row (role, start_offset, end_offset, run_id, receipt): role ``done`` for
completed work, ``lease`` for what a run holds now, ``failed`` for released work whose
receipt is kept. The rules are those of ranges: ``checks.range_rules`` for single
spans, ``ranges.overlaps`` for pairs, ``ranges.first_unclaimed`` for the cursor. A
transition takes the table and gives the next one, or aborts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranges
from ..operators.checks import Rule, Violation, range_rules, require

SPANS = "role string, start_offset bigint, end_offset bigint, run_id bigint, receipt string"
BUCKET = 1 << 16


def empty(spark: SparkSession) -> DataFrame:
    """A table without spans."""
    return spark.createDataFrame([], SPANS)


def span_rules(total: int) -> list[Rule]:
    """Rules of single spans of a queue of ``total`` rows."""
    known = F.coalesce(F.col("role").isin("done", "lease", "failed"), F.lit(False))
    return [
        ("queue is empty", F.lit(total < 1)),
        ("span of an unknown role", ~known),
        *range_rules(),
        ("span beyond the queue", F.col("end_offset") > total),
        ("lease without a run", (F.col("role") == "lease") & (F.coalesce("run_id", F.lit(0)) < 1)),
    ]


def _claims(spans: DataFrame) -> DataFrame:
    return spans.where("role in ('done', 'lease')").select(F.monotonically_increasing_id().alias("n"), "role", "start_offset", "end_offset", "run_id")


def _meeting(a: DataFrame, b: DataFrame) -> DataFrame:
    return ranges.overlaps(a, b, [], width=BUCKET)


def checked(spans: DataFrame, total: int) -> DataFrame:
    """The table itself, if its spans are inside the queue, do not overlap, and at most one is leased."""
    require(spans, span_rules(total))
    claims = _claims(spans).persist()
    try:
        if claims.where("role = 'lease'").limit(2).count() > 1:
            raise Violation("two leases at a time")
        if not _meeting(claims, claims).where("n_a < n_b").isEmpty():
            raise Violation("claimed spans overlap")
    finally:
        claims.unpersist()
    return spans


def _row(spark: SparkSession, role: str, start: int, end: int, run: int, receipt: str | None = None) -> DataFrame:
    return spark.createDataFrame([(role, start, end, run, receipt)], SPANS)


def _same(run: int, start: int, end: int) -> Column:
    """The lease of a run on exactly a span; whatever else its row holds."""
    return (F.col("role") == "lease") & (F.col("run_id") == run) & (F.col("start_offset") == start) & (F.col("end_offset") == end)


def reserve(spans: DataFrame, total: int, start: int, size: int, run: int) -> DataFrame:
    """The table with a lease on ``size`` rows from ``start``; a run that asks again for what it holds changes nothing."""
    wanted = _row(spans.sparkSession, "lease", start, start + size, run)
    require(wanted, span_rules(total))
    if not spans.where(_same(run, start, start + size)).isEmpty():
        return spans
    if not _meeting(_claims(spans), _claims(wanted)).isEmpty():
        raise Violation(f"rows {start} to {start + size} are claimed")
    return checked(spans.unionByName(wanted), total)


def _settle(spans: DataFrame, run: int, start: int, size: int, role: str, receipt: str | None) -> DataFrame:
    mine = _same(run, start, start + size)
    if spans.where(mine).count() != 1:
        raise Violation(f"run {run} holds no lease on rows {start} to {start + size}")
    moved = F.when(mine, F.lit(role)).otherwise(F.col("role"))
    return spans.withColumns({"role": moved, "receipt": F.when(mine, F.lit(receipt)).otherwise(F.col("receipt"))})


def complete(spans: DataFrame, run: int, start: int, size: int, receipt: str | None = None) -> DataFrame:
    """The run's lease becomes done; the receipt must state the leased span."""
    return _settle(spans, run, start, size, "done", receipt)


def abandon(spans: DataFrame, run: int, start: int, size: int, conclusion: str, artifact: str, digest: str) -> DataFrame:
    """The run's lease is released; its failure and the kept artifact must be named."""
    if conclusion != "failure" or not artifact or not digest:
        raise Violation("a lease is released by a failure with its artifact and digest")
    return _settle(spans, run, start, size, "failed", f"{artifact} {digest}")


def next_offset(spans: DataFrame) -> int:
    """First row of the queue that no done span covers."""
    done = spans.where("role = 'done'").select("start_offset", "end_offset")
    return ranges.first_unclaimed(done).first()["next_offset"]
