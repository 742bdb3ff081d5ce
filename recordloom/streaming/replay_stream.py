"""Replaying archived pages as keyed state: hosts in parallel, each with its own pacing and circuit.

A host's state is its queue, its members' states, its pacing and its journal's end. An attempt
is due when the delay has passed and the circuit is closed; a timer wakes the host for
it. Each attempt writes the object first, then gives a journal entry; the state is
committed with the micro-batch. A batch that is lost begins again from the state before
it: objects are named by their digest, and ``journal_batches`` writes a batch's entries to a
folder of its own, so that nothing is there twice and no state names what is not there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import files
from ..functions.canonical import content_digest
from ..operators.checks import Violation
from ..operators.replay import Pacing, wait_seconds
from .event_log import keyed_state

ENTRY = "host string, sequence bigint, member string, attempt bigint, disposition string, object_sha256 string, at timestamp, delay double, failures int, open_until timestamp, previous_entry_sha256 string, entry_sha256 string"
_COLUMNS = [c.split()[0] for c in ENTRY.split(", ")]
DISPOSITIONS = ("complete", "retryable", "terminal")

#: What an attempt gives: disposition, body, and the wait that the server asks for.
Observe = Callable[[str, str], tuple[str, bytes | None, str | None]]


def entry_digest(entry: Mapping[str, object]) -> str:
    """Digest of a journal entry over all of its fields but this one, times as microseconds."""
    plain = {k: v for k, v in entry.items() if k != "entry_sha256"}
    return content_digest({k: round(v.replace(tzinfo=UTC).timestamp() * 1e6) if isinstance(v, datetime) else v for k, v in plain.items()})


def put_object(folder: str, body: bytes) -> str:
    """Store a body under its digest, whole or not at all; returns the digest."""
    digest = hashlib.sha256(body).hexdigest()
    part = files.Part(f"{folder}/objects/{digest[:2]}/{digest}")
    part.write(body)
    part.publish()
    return digest


class Replay(StatefulProcessor):
    """State of one host."""

    def __init__(self, folder: str, observe: Observe, policy: Mapping[str, float], burst: int = 100):
        self.folder, self.observe, self.policy, self.burst = folder, observe, dict(policy), burst

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getListState("queue", "member string")
        self.members = handle.getMapState("members", "member string", "state string, attempts bigint")
        self.pacing = handle.getValueState("pacing", "delay double, failures int, recent array<boolean>, open_until timestamp, due timestamp")
        self.tail = handle.getValueState("tail", "sequence bigint, entry_sha256 string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = dict.fromkeys(m for part in rows for m in part["member"].tolist() if m is not None)
        for m in new:
            if not self.members.containsKey((m,)):
                self.members.updateValue((m,), ("pending", 0))
                self.queue.appendValue((m,))
        yield from self._attempts(key[0], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._attempts(key[0], timerValues)

    def _attempts(self, host: str, timer_values) -> Iterator[pd.DataFrame]:
        now = datetime.fromtimestamp(timer_values.getCurrentProcessingTimeInMs() / 1000, UTC).replace(tzinfo=None)
        held = self.pacing.get() if self.pacing.exists() else (float(self.policy["floor_seconds"]), 0, [], None, None)
        pacing, due = Pacing(held[0], held[1], tuple(held[2]), held[3]), held[4]
        sequence, previous = self.tail.get() if self.tail.exists() else (-1, None)
        waiting, made = [m for (m,) in self.queue.get()] if self.queue.exists() else [], []
        later = []
        while waiting and len(made) < self.burst and (due is None or due <= now) and (pacing.open_until is None or pacing.open_until <= now):
            m = waiting.pop(0)
            disposition, body, wait = self.observe(host, m)
            if disposition not in DISPOSITIONS:
                raise Violation(f"unregistered disposition {disposition}")
            digest = put_object(self.folder, body) if disposition == "complete" else None
            attempt = self.members.getValue((m,))[1] + 1
            pacing = pacing.after(disposition, self.policy, now, 0.0, wait_seconds(wait, now.replace(tzinfo=UTC), self.policy["ceiling_seconds"]))
            self.members.updateValue((m,), (disposition, attempt))
            if disposition == "retryable":
                later.append(m)
            sequence += 1
            entry = dict(zip(_COLUMNS, (host, sequence, m, attempt, disposition, digest, now, pacing.delay, pacing.failures, pacing.open_until, previous, None), strict=True))
            previous = entry["entry_sha256"] = entry_digest(entry)
            made.append(entry)
            due = now + timedelta(seconds=pacing.delay) if pacing.delay else None
        waiting += later
        self.queue.put([(m,) for m in waiting]) if waiting else self.queue.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if waiting:
            wake = max([t for t in (due, pacing.open_until) if t is not None and t > now], default=now + timedelta(milliseconds=1))
            self.handle.registerTimer(int(wake.replace(tzinfo=UTC).timestamp() * 1000))
        if made:
            self.pacing.update((pacing.delay, pacing.failures, list(pacing.recent), pacing.open_until, due))
            self.tail.update((sequence, previous))
            yield pd.DataFrame(made, columns=_COLUMNS)

    def close(self) -> None:
        pass


def replay_stream(selection: DataFrame, folder: str, observe: Observe, policy: Mapping[str, float], burst: int = 100) -> DataFrame:
    """Journal entries of attempts on the selection's members (host, member), a stream.

    Hosts are keys: they progress in parallel, and an open circuit holds up its own host alone.
    """
    keyed_state(selection.sparkSession)
    return selection.select("host", "member").groupBy("host").transformWithStateInPandas(Replay(folder, observe, policy, burst), ENTRY, "Update", "ProcessingTime")


def journal_batches(folder: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: a batch's entries in a folder of its own, written again if the batch is."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/journal/batch={number:012d}")

    return write


def journal(spark: SparkSession, folder: str) -> DataFrame | None:
    """All entries of a replay's journal."""
    names = [n for n in files.folders(spark, f"{folder}/journal") if n.startswith("batch=")]
    return spark.read.schema(ENTRY).parquet(*[f"{folder}/journal/{n}" for n in names]) if names else None
