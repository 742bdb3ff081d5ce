"""Properties that hold for any input."""

import json
from datetime import UTC, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recordloom.functions import canonical, text
from recordloom.operators import checks, replay
from recordloom.streaming import leases

values = st.recursive(st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=8)
documents = st.dictionaries(st.text(max_size=6), values, max_size=5)


@given(documents)
def test_digest_ignores_key_order(doc):
    turned = dict(reversed(list(doc.items())))
    for flavour in canonical.FLAVOURS:
        assert canonical.content_digest(doc, flavour) == canonical.content_digest(turned, flavour)
    assert canonical.strict_json(canonical.canonical_bytes(doc).decode()) == doc


@given(documents)
def test_state_survives_its_wrapper(doc):
    assert canonical.decode_state(json.dumps(canonical.encode_state(doc))) == doc


@given(st.text(max_size=200))
def test_any_markup_gives_fields(markup):
    fields = text.page_fields(markup)
    assert len(fields) == len(text.PAGE_FIELDS) and all(f is None or isinstance(f, str) for f in fields)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps=st.lists(st.tuples(st.sampled_from(["reserve", "complete", "abandon"]), st.integers(0, 30), st.integers(1, 8)), max_size=6))
def test_leases_never_overlap(spark, steps):
    held, spans = None, leases.empty(spark)
    for what, start, size in steps:
        try:
            if what == "reserve":
                spans = leases.reserve(spans, 30, start, size, 1)
                held = (start, size)
            elif held:
                spans = leases.complete(spans, 1, *held) if what == "complete" else leases.abandon(spans, 1, *held, "failure", "u", "d")
                held = None
        except checks.Violation:
            continue
        spans = spark.createDataFrame(spans.collect(), leases.SPANS)
    covered = [i for r in spans.where("role = 'done'").collect() for i in range(r.start_offset, r.end_offset)]
    first = leases.next_offset(spans)
    assert len(covered) == len(set(covered)) and first not in covered and set(range(first)) <= set(covered)


@given(st.lists(st.tuples(st.sampled_from(["retryable", "complete", "terminal"]), st.floats(0, 0.999)), max_size=30))
def test_pacing_stays_in_its_bounds(steps):
    policy = {"floor_seconds": 2, "ceiling_seconds": 60, "backoff_multiplier": 2, "jitter_fraction": 0.5, "decay_factor": 0.5, "window_size": 5, "minimum_window": 3, "failure_ratio": 0.5, "circuit_consecutive_failures": 4, "circuit_seconds": 30}
    p, now = replay.Pacing(delay=2.0), datetime(2024, 1, 1, tzinfo=UTC)
    for disposition, jitter in steps:
        p = p.after(disposition, policy, now, jitter)
        assert 2 <= p.delay <= 60 and len(p.recent) <= 5 and (disposition == "retryable" or (p.failures == 0 and p.open_until is None))
