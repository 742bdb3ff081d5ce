import pytest

from recordloom.operators import checks, events

DDL = "event_id string, case_id string, activity string, logical_id string, revision bigint, operation string, source_index bigint"


def log(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_idempotent_and_conflicting_merge(spark):
    a = ("e1", "c1", "sent", "l1", 1, "upsert", 1)
    assert events.merge_shards(log(spark, a, a)).count() == 1
    with pytest.raises(checks.Violation, match="l1:1"):
        events.merge_shards(log(spark, a, ("e1", "c1", "received", "l1", 1, "upsert", 1)))


def test_takedown_runs_before_latest_revision(spark):
    rows = log(spark, ("e1", "c1", "a", "l1", 1, "upsert", 1), ("e2", "c1", "b", "l1", 2, "upsert", 2))
    gone = spark.createDataFrame([("e2",)], "id string")
    assert [r.event_id for r in events.active_events(rows, gone).collect()] == ["e1"]


def test_retraction_hides_and_missing_operation_survives(spark):
    rows = log(spark, ("e1", "c1", "a", "l1", 1, "upsert", 1), ("e2", "c1", "a", "l1", 2, "retract", 2), ("e3", "c2", "a", "l2", 1, None, 1))
    assert [r.event_id for r in events.active_events(rows).collect()] == ["e3"]


def test_revision_tie_goes_to_larger_event_id(spark):
    rows = log(spark, ("e10", "c", "a", "l", 1, None, 1), ("e9", "c", "a", "l", 1, None, 2))
    assert events.latest_revisions(rows).first().event_id == "e9"


def test_null_case_is_not_taken_down(spark):
    rows = log(spark, ("e1", None, "a", "l", 1, None, 1))
    ids = spark.createDataFrame([(None,), ("x",)], "id string")
    assert events.without_takedowns(rows, ids).count() == 1


def test_takedown_row_yields_first_id(spark):
    rows = spark.createDataFrame([("c", "e", "i"), ("", "e", "i"), (None, None, "i"), (None, None, None)], "case_id string, event_id string, id string")
    assert sorted(r.id for r in events.takedown_ids(rows).collect()) == ["c", "e", "i"]


def test_case_with_two_requests_aborts(spark):
    rows = spark.createDataFrame([("c1", 7), ("c1", 8)], "case_id string, request_id bigint")
    with pytest.raises(checks.Violation):
        events.source_records(rows, spark.createDataFrame([(7, "t")], "request_id bigint, title string"))


def test_case_without_request_is_dropped(spark):
    rows = spark.createDataFrame([("c1", 7), ("c2", 9), ("c3", None)], "case_id string, request_id bigint")
    got = events.source_records(rows, spark.createDataFrame([(7, "t")], "request_id bigint, title string"))
    assert [r.case_id for r in got.collect()] == ["c1"]


def test_coverage(spark):
    rows = log(spark, ("e1", "c1", "a", "l1", 1, "upsert", 1), ("e2", "c1", "a", "l1", 2, "retract", 2), ("e3", "c2", "a", "l2", 1, "upsert", 1))
    row = events.coverage(rows, rows, events.active_events(rows), None).first()
    assert (row.merged_event_count, row.event_count, row.excluded_event_count, row.retracted_event_count, row.request_count_reconciles) == (3, 1, 2, 1, True)


def test_rules_abort_in_declared_order(spark):
    rows = spark.createDataFrame([("", "c", "a", "2.0.0")], "event_id string, case_id string, activity string, contract_version string")
    assert checks.messages(rows, checks.event_rules()) == ["event without event_id", "unsupported contract version"]
    with pytest.raises(checks.Violation, match="event_id"):
        checks.require(rows, checks.event_rules())


def test_empty_log(spark):
    assert events.cases(events.active_events(log(spark))).count() == 0
