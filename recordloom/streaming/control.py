"""Incremental controllers with exactly-once commit order.

In each, what the state refers to is durable before the state names it. Leases on
ranges are in ``leases``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame

from .. import files
from ..functions.canonical import content_digest
from ..operators import ranges
from ..operators.checks import Violation
from ..operators.replay import Pacing, wait_seconds
from ..sinks.documents import append_bytes, write_bytes, write_json, write_table

# --- high-water sync ---------------------------------------------------------


def load_state(path: str) -> dict:
    """A state document; empty where there is none yet."""
    at = Path(path)
    return json.loads(at.read_text(encoding="utf-8")) if at.exists() else {}


def sync_batches(folder: str, verify: Callable[[str], bool]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: write the batch, have it verified where it was published, then advance the state.

    An empty batch changes nothing; a batch that fails verification aborts with the
    state as it was; a batch that the state already names is skipped.
    """

    def run(batch: DataFrame, number: int) -> None:
        state = load_state(f"{folder}/state.json")
        if number <= state.get("batch", -1) or batch.isEmpty():
            return
        path = f"{folder}/batch-{number:012d}"
        write_table(batch, path)
        if not verify(path):
            raise Violation(f"batch {number} could not be verified")
        write_json(f"{folder}/state.json", {"batch": number, "path": path})

    return run


# --- backfill controller -----------------------------------------------------

BATCH = "label string, id_from bigint, id_to bigint, status string, record_count bigint, worker_run_id string"


def controller_batches(folder: str, id_from: int, id_to: int, span: int, limit: int) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` over receipts (label, record_count, worker_run_id): one controller transition a batch.

    The batches' new table is written first, then one document names it together with the
    cursor, so that append, merge and advance happen together or not at all. A batch that the
    state already names is passed over; the first call, also without receipts, plans the first batches.
    """

    def run(receipts: DataFrame, number: int) -> None:
        spark = receipts.sparkSession
        at = f"{folder}/state.json"
        state = json.loads(files.read(spark, at)) if files.exists(spark, at) else {"batch": -1}
        if number <= state["batch"]:
            return
        held = spark.read.schema(BATCH).parquet(state["table"]) if "table" in state else spark.createDataFrame([], BATCH)
        after, moved = ranges.controller_step(held, receipts.select("label", "record_count", "worker_run_id").dropDuplicates(["label"]), id_from, id_to, span, limit)
        table = f"{folder}/batches-{number:012d}"
        write_table(after.select(*[c.split()[0] for c in BATCH.split(", ")]), table)
        files.write(spark, at, json.dumps({"batch": number, "table": table} | moved, sort_keys=True).encode())

    return run


# --- hash-chained journal and replay -----------------------------------------


def last_entry(journal: str) -> dict | None:
    """Last whole line of a journal, read from its end; a torn line after it is ignored."""
    at = Path(journal)
    if not at.exists():
        return None
    size, step = at.stat().st_size, 1 << 12
    with at.open("rb") as f:
        while True:
            f.seek(max(0, size - step))
            tail = f.read(min(step, size))
            whole = tail[: tail.rfind(b"\n") + 1].splitlines()
            if len(whole) > 1 or step >= size:
                return json.loads(whole[-1]) if whole else None
            step *= 2


def append_entry(journal: str, entry: dict) -> dict:
    """Append an entry with its sequence, link and own digest. Only the journal's end is read and written."""
    if {"sequence", "previous_entry_sha256", "entry_sha256"} & set(entry):
        raise Violation("chain fields are not the caller's")
    last = last_entry(journal)
    made = {**entry, "sequence": last["sequence"] + 1 if last else 0, "previous_entry_sha256": last["entry_sha256"] if last else None}
    made["entry_sha256"] = content_digest(made)
    append_bytes(journal, json.dumps(made, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode() + b"\n")
    return made


def replay(folder: str, members: list[str], observe: Callable[[str], tuple[str, bytes | None, str | None]], policy: dict, clock: Callable[[], datetime], jitter: Callable[[], float] = lambda: 0.0) -> dict[str, str]:
    """One pass over members that are not settled: object, then journal, then checkpoint.

    ``observe`` returns the disposition (complete, retryable, terminal), the body and
    the wished wait. The pass stops when the circuit opens, and does not begin while it is
    open: the checkpoint holds until when. A crash between the steps
    leaves at most an object or an entry that the next pass repeats.
    """
    checkpoint = Path(folder) / "checkpoint.json"
    held = load_state(str(checkpoint))
    states = {m: held.get("states", {}).get(m, "pending") for m in members}
    p = held.get("pacing", {})
    until = p.get("open_until")
    pacing = Pacing(p.get("delay", policy["floor_seconds"]), p.get("failures", 0), tuple(p.get("recent", ())), datetime.fromisoformat(until) if until else None)
    for m in members:
        if states[m] in ("complete", "terminal"):
            continue
        now = clock()
        if pacing.open_until is not None and now < pacing.open_until:
            break
        disposition, body, wait = observe(m)
        digest = None
        if disposition == "complete":
            digest = hashlib.sha256(body).hexdigest()
            write_bytes(Path(folder) / "objects" / digest[:2] / digest, body)
        append_entry(f"{folder}/journal.jsonl", {"member": m, "disposition": disposition, "object_sha256": digest, "at": now.isoformat()})
        pacing = pacing.after(disposition, policy, now, jitter(), wait_seconds(wait, now, policy["ceiling_seconds"]))
        states[m] = disposition
        opened = pacing.open_until.isoformat() if pacing.open_until else None
        write_json(checkpoint, {"states": states, "pacing": {"delay": pacing.delay, "failures": pacing.failures, "recent": list(pacing.recent), "open_until": opened}})
    return states
