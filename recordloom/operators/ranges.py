"""Id ranges: plans, leases, cursors, overlaps and the controller's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .checks import Violation
from .prefix import scan

OFFSETS = ("start_offset", "end_offset")


def batch_status(status: Column) -> Column:
    return F.coalesce(F.nullif(status, F.lit("")), F.lit("pending"))


def normalize_batches(batches: DataFrame) -> DataFrame:
    """Batches with a label (default from-to) and a status (default pending)."""
    label = F.coalesce(F.nullif(F.col("label"), F.lit("")), F.concat_ws("-", "id_from", "id_to"))
    return batches.withColumns({"label": label, "status": batch_status(F.col("status"))})


def pending(batches: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` batches to retry: exactly those with status pending, in key order."""
    return batches.where(batch_status(F.col("status")) == "pending").orderBy("id_from", "id_to", "label").limit(limit)


def _running(df: DataFrame, start: str, end: str, shard: str | None) -> DataFrame:
    """Adds ``before``: the largest ``end`` of all rows before, in order of (start, end).

    With ``shard`` the order is taken inside that column, else by a scan in two levels.
    """
    if shard is not None:
        w = Window.partitionBy(shard).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("before", F.max(end).over(w))
    return scan(df, [start, end], maxima={"before": F.col(end)})


def gaps(ranges: DataFrame, start: str = OFFSETS[0], end: str = OFFSETS[1], origin: int = 0, shard: str | None = None) -> DataFrame:
    """Ranges that begin after everything before them has ended: gap_from, gap_to."""
    seen = _running(ranges, start, end, shard)
    reach = F.greatest(F.coalesce("before", F.lit(origin)), F.lit(origin))
    keep = [shard] if shard else []
    return seen.where(F.col(start) > reach).select(*keep, reach.alias("gap_from"), F.col(start).alias("gap_to"))


def first_unclaimed(ranges: DataFrame, start: str = OFFSETS[0], end: str = OFFSETS[1], origin: int = 0) -> DataFrame:
    """One row: the first offset that no range covers."""
    gap = gaps(ranges, start, end, origin).agg(F.min("gap_from").alias("g"))
    last = ranges.agg(F.max(end).alias("m"))
    return gap.crossJoin(last).select(F.coalesce("g", F.greatest("m", F.lit(origin)), F.lit(origin)).cast("bigint").alias("next_offset"))


def verified_cursor(batches: DataFrame, origin: int = 1) -> DataFrame:
    """One row: the id after the unbroken run of merged batches (inclusive bounds id_from, id_to).

    The run stops at the first gap or at the first batch that is not merged.
    """
    seen = _running(batches.where(F.col("id_to") >= origin), "id_from", "id_to", None)
    reach = F.greatest(F.coalesce(F.col("before") + 1, F.lit(origin)), F.lit(origin))
    open_batch = (F.col("id_from") > reach) | ((batch_status(F.col("status")) != "merged") & (F.col("id_to") >= reach))
    first = seen.where(open_batch).agg(F.min(reach).alias("stop"))
    last = batches.agg((F.max("id_to") + 1).alias("end"))
    return first.crossJoin(last).select(F.coalesce("stop", F.greatest("end", F.lit(origin)), F.lit(origin)).cast("bigint").alias("next_id"))


def adjacent_overlaps(ranges: DataFrame, start: str = OFFSETS[0], end: str = OFFSETS[1], shard: str | None = None) -> DataFrame:
    """Ranges that begin before the one before them, by start and end, has ended: adds previous_end.

    For half-open ranges this finds an overlap wherever there is one. Without ``shard`` the
    range before is the maximum so far of (start, end), so that a scan in two levels finds it.
    """
    if shard is not None:
        w = Window.partitionBy(shard).orderBy(start, end)
        return ranges.withColumn("previous_end", F.lag(end).over(w)).where(F.col("previous_end") > F.col(start))
    seen = scan(ranges, [start, end], maxima={"_last": F.struct(F.col(start).alias("s"), F.col(end).alias("e"))})
    return seen.withColumn("previous_end", F.col("_last.e")).drop("_last").where(F.col("previous_end") > F.col(start))


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], start: str = OFFSETS[0], end: str = OFFSETS[1], width: int | None = None) -> DataFrame:
    """Pairs of overlapping half-open ranges that share the keys.

    With ``width`` ranges meet in buckets of that length, so that no bucket holds
    more than what touches it; a pair is kept in the first bucket of its overlap.
    Columns of a and b get the suffixes _a and _b.
    """
    left, right = a.select(*[F.col(c).alias(f"{c}_a") for c in a.columns]), b.select(*[F.col(c).alias(f"{c}_b") for c in b.columns])
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"{k}_a") == F.col(f"{k}_b"))
    if width:
        spread = lambda df, s: df.withColumn(f"bucket_{s}", F.explode(F.sequence(F.floor(F.col(f"{start}_{s}") / width), F.floor((F.col(f"{end}_{s}") - 1) / width))))
        left, right = spread(left.where(F.col(f"{end}_a") > F.col(f"{start}_a")), "a"), spread(right.where(F.col(f"{end}_b") > F.col(f"{start}_b")), "b")
        on = on & (F.col("bucket_a") == F.col("bucket_b")) & (F.col("bucket_a") == F.floor(F.greatest(f"{start}_a", f"{start}_b") / width))
    pairs = left.join(right, on & (F.col(f"{start}_a") < F.col(f"{end}_b")) & (F.col(f"{start}_b") < F.col(f"{end}_a")))
    return pairs.drop("bucket_a", "bucket_b")


def chunk_plan(spark: SparkSession, first: int, last: int, span: int, limit: int | None = None) -> DataFrame:
    """Batches of ``span`` ids over first..last inclusive: label, id_from, id_to."""
    n = max(0, -(-(last - first + 1) // span))
    rows = spark.range(n if limit is None else min(n, limit)).select((F.col("id") * span + first).alias("id_from"))
    rows = rows.withColumn("id_to", F.least(F.col("id_from") + (span - 1), F.lit(last)))
    return rows.select(F.concat_ws("-", "id_from", "id_to").alias("label"), "id_from", "id_to")


def dispatch_from(batches: DataFrame, next_id: int) -> DataFrame:
    """One row: where dispatching goes on, after the verified cursor and every dispatched batch."""
    return batches.agg(F.greatest(F.lit(next_id), F.coalesce(F.max("id_to") + 1, F.lit(next_id))).cast("bigint").alias("dispatch_next_id"))


def year_buckets(spark: SparkSession, start: int, open_from: int, span: int = 5) -> DataFrame:
    """Closed buckets of years and one open bucket: id, from_year, to_year (null for the open one)."""
    if not 1000 <= start < open_from or span < 1:
        raise ValueError("years must have four digits and precede the open bucket; the span must be positive")
    closed = chunk_plan(spark, start, open_from - 1, span).select(F.col("label").alias("id"), F.col("id_from").alias("from_year"), F.col("id_to").alias("to_year"))
    last = spark.range(1).select(F.lit(f"{open_from}-open").alias("id"), F.lit(open_from).cast("bigint").alias("from_year"), F.lit(None).cast("bigint").alias("to_year"))
    return closed.unionByName(last)


def require_contiguous_years(plan: DataFrame) -> DataFrame:
    """Buckets follow each other and only the last is open."""
    w = Window.orderBy("from_year")
    seen = plan.withColumn("_next", F.lead("from_year").over(w))
    bad = seen.where((F.col("_next").isNull() & F.col("to_year").isNotNull()) | (F.col("_next").isNotNull() & ~F.col("to_year").eqNullSafe(F.col("_next") - 1)))
    if not bad.isEmpty():
        raise Violation("partition years must be contiguous and only the last open")
    return plan


def controller_summary(batches: DataFrame) -> DataFrame:
    """One row of counts by status, id span and captured records."""
    status = batch_status(F.col("status"))
    return batches.agg(
        F.count("*").alias("dispatched_batches"),
        F.count_if(status == "pending").alias("pending_batches"),
        F.count_if(status == "merged").alias("merged_batches"),
        F.coalesce(F.bool_or(status != "merged"), F.lit(False)).alias("has_pending"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col("id_to") - F.col("id_from") + 1)), F.lit(0)).cast("bigint").alias("dispatched_requested_ids"),
        F.coalesce(F.sum(F.when(status == "merged", F.coalesce("record_count", F.lit(0)))), F.lit(0)).cast("bigint").alias("captured_records"),
    )


def mark_merged(batches: DataFrame, receipts: DataFrame) -> DataFrame:
    """Batches with receipts (label, record_count, worker_run_id) become merged."""
    r = receipts.select("label", F.col("record_count").alias("_n"), F.col("worker_run_id").alias("_run"), F.lit(True).alias("_hit"))
    hit = F.coalesce("_hit", F.lit(False))
    out = batches.join(r, "label", "left")
    run = F.col("worker_run_id") if "worker_run_id" in batches.columns else F.lit(None).cast("string")
    return out.withColumns({"status": F.when(hit, "merged").otherwise(F.col("status")), "record_count": F.coalesce("_n", "record_count"), "worker_run_id": F.coalesce("_run", run)}).drop("_n", "_run", "_hit")


def collapse_labels(chunks: DataFrame) -> DataFrame:
    """One label from the least to the largest id of chunk labels from-to."""
    bound = lambda n: F.split_part("label", F.lit("-"), F.lit(n)).cast("bigint")
    return chunks.agg(F.concat_ws("-", F.min(bound(1)), F.max(bound(2))).alias("label"))


def backfill_verification(captured: Column, merged: Column, mirrors: list[Column]) -> dict[str, Column]:
    """Verdict columns: tolerance, captured against merged, mirrors against merged.

    More captured than merged records always covers them.
    """
    tolerance = F.greatest(F.lit(25), F.floor(merged / 1000)).cast("bigint")
    within = F.abs(captured - merged) <= tolerance
    covers = captured >= merged
    match = F.lit(True)
    for m in mirrors:
        match = match & F.coalesce(F.abs(m - merged) <= tolerance, F.lit(False))
    return {"tolerance": tolerance, "captured_within_tolerance": within, "captured_covers_merged": covers, "mirrors_match": match, "fully_verified": (covers | within) & match}


def cap_running(rows: DataFrame, size: str, order: str | list[str], max_rows: int | None = None, max_bytes: int | None = None, seconds: str | None = None, max_minutes: float | None = None, free: str | None = None, min_free: int | None = None) -> DataFrame:
    """Rows taken before a cap is reached, in a global order.

    Caps are tested before a row is taken, so the row that crosses stays: rows and bytes taken
    so far, minutes spent so far (``seconds`` of each row), and bytes left of the disk
    (``free`` of each row, as it was when the row came up; the first row below ``min_free`` ends it).
    """
    sums = {"_n": F.lit(1).cast("bigint"), "_b": F.coalesce(F.col(size), F.lit(0)).cast("bigint")}
    if max_minutes is not None:
        sums["_s"] = F.coalesce(F.col(seconds), F.lit(0)).cast("decimal(20,6)")
    low = F.lit(False)
    if min_free is not None:
        low = F.col(free) < min_free
        sums["_low"] = low.cast("bigint")
    seen = scan(rows, [order] if isinstance(order, str) else order, sums)
    if max_rows is not None:
        seen = seen.where(F.col("_n") < max_rows)
    if max_bytes is not None:
        seen = seen.where(F.col("_b") < max_bytes)
    if max_minutes is not None:
        seen = seen.where(F.col("_s") < max_minutes * 60)
    if min_free is not None:
        seen = seen.where((F.col("_low") == 0) & ~F.coalesce(low, F.lit(False)))
    return seen.drop(*sums)


def coverage_percent(done: Column, total: Column, places: int) -> Column:
    """Half-even percentage, capped at 100, 0 without a total."""
    return F.when(F.coalesce(total, F.lit(0)) <= 0, F.lit(0.0)).otherwise(F.least(F.lit(100.0), F.bround(100 * done / total, places)))


def run_islands(labels: DataFrame, run: str = "run", label: str = "label", place: str = "place") -> DataFrame:
    """Labels of runs as islands: batches that follow each other without a gap inside one run.

    ``labels`` are from-to, in the run's order ``place``. Adds id_from, id_to, island (its number
    in the run, from 0) and first (the island's first label).
    """
    bound = lambda n: F.split_part(F.col(label), F.lit("-"), F.lit(n)).cast("bigint")
    rows = labels.withColumns({"id_from": bound(1), "id_to": bound(2)})
    w = Window.partitionBy(run).orderBy("id_from", "id_to", place)
    begins = ~F.col("id_from").eqNullSafe(F.max("id_to").over(w.rowsBetween(Window.unboundedPreceding, -1)) + 1)
    rows = rows.withColumn("_begins", begins)
    return rows.withColumn("island", (F.sum(F.col("_begins").cast("bigint")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)).withColumnRenamed("_begins", "first")


def rebuilt_batches(batches: DataFrame, runs: DataFrame, merged: DataFrame) -> DataFrame:
    """Controller batches (label, id_from, id_to, status, record_count) rebuilt from what merge runs have taken.

    ``runs`` holds run, label, place (order inside the run); ``merged`` holds run, seq (order of runs)
    and record_count. Every label of a run is merged. The run's first label by ``place`` carries its
    count, the others keep theirs, or 0; a label in several runs goes by the last run that gave it a
    count. Labels that the controller never had come in; batches of no run stay as they are.
    """
    w = Window.partitionBy("run").orderBy("place", "label")
    numbered = runs.withColumn("_n", F.row_number().over(w)).join(merged.select("run", "seq", F.col("record_count").alias("_count")), "run")
    taken = numbered.groupBy("label").agg(F.max_by("_count", F.when(F.col("_n") == 1, F.col("seq"))).alias("_count"), F.max(F.when(F.col("_n") == 1, F.lit(True))).alias("_lead"), F.lit(True).alias("_taken"))
    known = batches.where(~(F.coalesce("label", F.lit("")) == ""))
    rows = known.join(taken, "label", "full_outer")
    bound = lambda n: F.split_part("label", F.lit("-"), F.lit(n)).cast("bigint")
    hit = F.coalesce("_taken", F.lit(False))
    return rows.select(
        "label",
        F.when(hit, bound(1)).otherwise(F.col("id_from")).cast("bigint").alias("id_from"),
        F.when(hit, bound(2)).otherwise(F.col("id_to")).cast("bigint").alias("id_to"),
        F.when(hit, F.lit("merged")).otherwise(batch_status(F.col("status"))).alias("status"),
        F.when(F.coalesce("_lead", F.lit(False)), F.col("_count")).when(hit, F.coalesce("record_count", F.lit(0))).otherwise(F.col("record_count")).cast("bigint").alias("record_count"),
    )


def summarised(batches: DataFrame, summary_captured: Column | None = None, place: str = "id_from", runs: int = 10) -> DataFrame:
    """``controller_summary`` with the recorded summary and the worker runs.

    The summary's own count of captured records wins over the sum of merged batches (which may count
    a record twice after bulk merges) wherever it is there, even as 0. ``worker_runs`` are distinct and
    sorted; ``recent_worker_runs`` are the last ten distinct ones in the order of their first batch.
    """
    run = F.nullif(F.col("worker_run_id"), F.lit(""))
    first = batches.select(run.alias("r"), F.col(place).alias("p")).where("r is not null").groupBy("r").agg(F.min("p").alias("p"))
    named = first.agg(F.array_sort(F.collect_list("r")).alias("worker_runs"))
    last = first.orderBy(F.desc("p"), F.desc("r")).limit(runs).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "r"))), lambda x: x["r"]).alias("recent_worker_runs"))
    one = controller_summary(batches).withColumn("captured_records_summed_batches", F.col("captured_records"))
    if summary_captured is not None:
        one = one.withColumn("captured_records", F.coalesce(summary_captured.cast("bigint"), F.col("captured_records")))
    return one.crossJoin(named).crossJoin(last)


def dispatch_plan(batches: DataFrame, next_id: int, id_to: int, span: int, limit: int | None = None) -> DataFrame:
    """Batches that dispatching comes to next: after the cursor and every dispatched batch, up to ``id_to``."""
    start = dispatch_from(batches, next_id).first()["dispatch_next_id"]
    return chunk_plan(batches.sparkSession, start, id_to, span, limit)


def controller_step(batches: DataFrame, receipts: DataFrame, id_from: int, id_to: int, span: int, limit: int) -> tuple[DataFrame, dict]:
    """One transition of the controller: receipts are merged, the cursor moves on, new batches are appended as pending.

    At most ``limit`` batches are open at a time. A receipt for a label that was never dispatched aborts.
    Returns the batches and the state (next_id, dispatch_next_id, complete).
    """
    if not receipts.join(batches, "label", "left_anti").isEmpty():
        raise Violation("receipt for a batch that was never dispatched")
    merged = mark_merged(batches, receipts)
    cursor = verified_cursor(merged, id_from).first()["next_id"]
    still = merged.where(batch_status(F.col("status")) != "merged").count()
    planned = dispatch_plan(merged, cursor, id_to, span, max(0, limit - still))
    new = planned.withColumns({c: F.lit("pending" if c == "status" else None).cast(merged.schema[c].dataType) for c in merged.columns if c not in planned.columns})
    after = merged.unionByName(new)
    dispatched = dispatch_from(after, cursor).first()["dispatch_next_id"]
    return after, {"next_id": cursor, "dispatch_next_id": dispatched, "complete": cursor > id_to and not still}
