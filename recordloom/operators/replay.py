"""Replaying archived pages: outcomes, pacing, state counts."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outcomes of an attempt.
RETRYABLE_STATUS = [429, 500, 502, 503, 504]
TERMINAL_STATUS = [404, 410]
RETRYABLE_TRANSPORT = ["timeout", "connection"]
HTTP_DATE = "%a, %d %b %Y %H:%M:%S GMT"
TERMINAL_CODES = ["redirect_escape", "payload_too_large", "scope_violation", "integrity_mismatch", "unsupported_content_type", "malformed_content"]


def outcome(kind: Column, status: Column, transport: Column, terminal: Column, intact: Column) -> Column:
    """Struct(code, disposition) of an observation; what is not registered aborts."""
    made = lambda code, what: F.struct(code.cast("string").alias("code"), F.lit(what).alias("disposition"))
    http = F.concat(F.lit("http_"), status.cast("string"))
    return (
        F.when((kind == "success") & ~intact, made(F.lit("integrity_mismatch"), "terminal"))
        .when(kind == "success", made(F.lit("success"), "complete"))
        .when((kind == "http") & status.isin(RETRYABLE_STATUS), made(http, "retryable"))
        .when((kind == "http") & status.isin(TERMINAL_STATUS), made(http, "terminal"))
        .when((kind == "transport") & transport.isin(RETRYABLE_TRANSPORT), made(transport, "retryable"))
        .when((kind == "terminal") & terminal.isin(TERMINAL_CODES), made(terminal, "terminal"))
        .otherwise(F.raise_error(F.lit("unregistered observation outcome")).cast("struct<code:string,disposition:string>"))
    )


def retry_after(header: Column, now: Column, ceiling: float) -> Column:
    """Seconds that a Retry-After header asks for, a number or a date, from 0 to ``ceiling``; null if it is neither."""
    stamp = F.regexp_extract(header, r"([0-9]{2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}) GMT", 1)
    date = F.try_to_timestamp(F.concat(F.nullif(stamp, F.lit("")), F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss Z"))
    number = F.when(F.trim(header).rlike("^[0-9]+$"), F.trim(header)).try_cast("double")
    asked = F.coalesce(number, (F.unix_micros(date) - F.unix_micros(now)) / F.lit(1e6))
    return F.when(asked.isNotNull(), F.least(F.greatest(asked, F.lit(0.0)), F.lit(float(ceiling))))


def wait_seconds(header: str | None, now: datetime, ceiling: float) -> float | None:
    """The same for one header on the driver."""
    asked = (header or "").strip()
    if re.fullmatch("[0-9]+", asked):
        wait = float(asked)
    else:
        try:
            wait = (datetime.strptime(asked, HTTP_DATE) - now.astimezone(UTC).replace(tzinfo=None)).total_seconds()
        except ValueError:
            return None
    return min(max(wait, 0.0), ceiling)


@dataclass(frozen=True)
class Pacing:
    """Delay, failures in a row, recent failures, and until when the circuit is open."""

    delay: float = 0.0
    failures: int = 0
    recent: tuple[bool, ...] = ()
    open_until: datetime | None = None

    def after(self, disposition: str, policy: Mapping[str, float], now: datetime, jitter: float = 0.0, wait: float | None = None) -> Pacing:
        """Pacing after one more attempt. ``jitter`` is in [0, 1); ``wait`` is the server's wish."""
        floor, ceiling = policy["floor_seconds"], policy["ceiling_seconds"]
        failed = disposition == "retryable"
        recent = (self.recent + (failed,))[-int(policy["window_size"]) :]
        if not failed:
            factor = policy["decay_factor"] if disposition == "complete" else 1.0
            return Pacing(max(floor, self.delay * factor), 0, recent)
        base = max(floor, self.delay * policy["backoff_multiplier"], wait or 0.0)
        delay = min(ceiling, base + jitter * policy["jitter_fraction"] * min(base, ceiling))
        failures = self.failures + 1
        often = len(recent) >= policy["minimum_window"] and sum(recent) >= policy["failure_ratio"] * len(recent)
        opens = often or failures >= policy["circuit_consecutive_failures"]
        return Pacing(delay, failures, recent, now + timedelta(seconds=policy["circuit_seconds"]) if opens else None)


def state_counts(states: DataFrame, state: str) -> DataFrame:
    return states.groupBy(state).agg(F.count("*").alias("n"))


def distinct_candidates(candidates: DataFrame) -> DataFrame:
    """Replacement candidates once per own digest."""
    return candidates.dropDuplicates(["candidate_sha256"])
