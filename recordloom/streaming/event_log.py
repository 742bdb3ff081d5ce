"""Event log as a stream: the latest revision per logical event, kept incrementally."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import files
from ..operators.checks import Violation
from ..operators.events import CLASH, latest_revisions, merged_or_fail, not_retracted, payload_digest

EVENT = "event_id string, case_id string, activity string, logical_id string, revision bigint, operation string, source_index bigint"
UPDATE = "logical_id string, event_id string, case_id string, revision bigint, operation string, active boolean"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark: SparkSession) -> None:
    """Queries that this session starts from now on keep their state in RocksDB, which state of several kinds needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def _digest(row) -> str:
    """Digest of a delivery's whole payload, null told apart from text."""
    parts = (row.event_id, row.case_id, row.activity, row.operation, row.source_index)
    return hashlib.sha256("\x1f".join("\x00" if v is None or v != v else f"={v}" for v in parts).encode()).hexdigest()[:32]


class _Latest(StatefulProcessor):
    """The newest (revision, event_id) of a logical event, and a digest for each of its revisions."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "revision bigint, event_id string, case_id string, operation string")
        self.known = handle.getMapState("known", "revision bigint", "digest string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.best.get()) if self.best.exists() else None
        best = held
        for part in rows:
            for r in part.itertuples(index=False):
                at, digest = (int(r.revision),), _digest(r)
                if not self.known.containsKey(at):
                    self.known.updateValue(at, (digest,))
                elif self.known.getValue(at)[0] != digest:
                    raise Violation(f"{CLASH} {key[0]}:{at[0]}")
                row = (at[0], r.event_id, r.case_id, r.operation)
                if best is None or row[:2] > best[:2]:
                    best = row
        if best != held:
            self.best.update(best)
            yield pd.DataFrame([(key[0], best[1], best[2], best[0], best[3], best[3] != "retract")], columns=[c.split()[0] for c in UPDATE.split(", ")])

    def close(self) -> None:
        pass


def latest_stream(events: DataFrame) -> DataFrame:
    """Stream of changes of each logical event's latest revision (update mode).

    Any revision, old or new, that comes again with another payload aborts. A batch reads and
    writes only the revisions that it brings: they are entries of a map state.
    """
    keyed_state(events.sparkSession)
    return events.groupBy("logical_id").transformWithStateInPandas(_Latest(), UPDATE, "Update", "None")


def read_stream(spark: SparkSession, folder: str, schema: str = EVENT, files_per_batch: int = 100) -> DataFrame:
    """Shards of JSON lines as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


# --- log of hash buckets -----------------------------------------------------

BUCKETS, COMPACT_AFTER = 64, 8
_BUCKET, _DIGEST = "_bucket", "_digest"


def _version_folder(target: str, number: int) -> str:
    return f"{target}/v{number:012d}"


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the batches that have been merged."""
    at = f"{target}/versions"
    return sorted(int(n.removesuffix(".json")) for n, _ in files.listed(spark, at)) if files.exists(spark, at) else []


def _layout(spark: SparkSession, target: str, before: int | None = None) -> dict:
    """Which versions hold files of each bucket, as of the last merge, or of the last before a batch."""
    done = [v for v in versions(spark, target) if before is None or v < before]
    if not done:
        return {"version": None, "n_buckets": None, "buckets": {}}
    return json.loads(files.read(spark, f"{target}/versions/{done[-1]:012d}.json"))


def _read(spark: SparkSession, target: str, layout: dict, buckets: list[int] | None = None) -> DataFrame | None:
    paths = [f"{_version_folder(target, v)}/{_BUCKET}={b}" for b, vs in layout["buckets"].items() if buckets is None or int(b) in buckets for v in vs]
    return spark.read.parquet(*paths) if paths else None


def upsert_batches(target: str, n_buckets: int = BUCKETS, compact_after: int = COMPACT_AFTER) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: merge a batch of events into a log of logical revisions.

    The log is a base and delta files for each hash bucket of logical ids. A batch reads keys
    and digests of the buckets that it touches, and writes the revisions that are new there;
    a bucket with ``compact_after`` deltas is written anew as a base. One small document, renamed
    into place, then names the files of every bucket: until then nothing has happened, and files
    of other buckets are never touched. A revision that comes with another payload than before,
    in whatever batch, aborts before that. A batch that was merged already is passed over.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        layout = _layout(spark, target, before=number)
        wide = layout["n_buckets"] or n_buckets
        if number in versions(spark, target):
            return
        folder = _version_folder(target, number)
        files.delete(spark, folder)
        bucket = F.pmod(F.xxhash64("logical_id"), F.lit(wide)).cast("int")
        rows = batch.withColumns({_DIGEST: payload_digest(batch), _BUCKET: bucket}).persist()
        try:
            touched = {r[0] for r in rows.select(_BUCKET).distinct().collect()}
            held = layout["buckets"]
            full = [b for b in touched if len(held.get(str(b), [])) > compact_after]
            old = _read(spark, target, layout, list(touched))
            fresh = merged_or_fail(rows, F.col(_DIGEST), old)
            if full:
                whole = _read(spark, target, layout, full)
                fresh = fresh.unionByName(whole.withColumn(_BUCKET, bucket))
            try:
                fresh.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(folder)
            except Exception as error:
                if CLASH in str(error):
                    raise Violation(str(error)[str(error).index(CLASH) :].split("\n")[0].split("'")[0].strip()) from error
                raise
        finally:
            rows.unpersist()
        made = {int(n.rpartition("=")[2]) for n in files.folders(spark, folder)}
        buckets = {int(b): v for b, v in held.items()}
        buckets |= {b: [number] if b in full else [*buckets.get(b, []), number] for b in made}
        document = {"version": number, "n_buckets": wide, "buckets": {str(b): buckets[b] for b in sorted(buckets)}}
        files.write(spark, f"{target}/versions/{number:012d}.json", json.dumps(document, sort_keys=True).encode())

    return merge


def revisions(spark: SparkSession, target: str) -> DataFrame | None:
    """All logical revisions, as of the last merge."""
    found = _read(spark, target, _layout(spark, target))
    return None if found is None else found.drop(_DIGEST)


def current(spark: SparkSession, target: str) -> DataFrame | None:
    """Latest revision per logical event."""
    found = revisions(spark, target)
    return None if found is None else latest_revisions(found)


def active(spark: SparkSession, target: str) -> DataFrame:
    return not_retracted(current(spark, target))


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete bucket files that none of the last ``keep`` versions names; returns how many folders went."""
    done, gone = versions(spark, target), 0
    if not done:
        return 0
    named = set()
    for number in done[-keep:]:
        layout = _layout(spark, target, before=number + 1)
        named |= {(v, int(b)) for b, vs in layout["buckets"].items() for v in vs}
    for number in done[:-keep]:
        folder = _version_folder(target, number)
        for name in files.folders(spark, folder):
            if (number, int(name.rpartition("=")[2])) not in named:
                files.delete(spark, f"{folder}/{name}")
                gone += 1
        files.delete(spark, f"{target}/versions/{number:012d}.json")
    return gone


def windowed_activity(events: DataFrame, ts: str = "ts", size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events per activity and time window, late rows dropped after the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size), "activity").agg(F.count("*").alias("n"))
