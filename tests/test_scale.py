"""Steps whose cost must follow the rows, not the number of groups, objects or expressions."""

import json

import pandas as pd
from pyspark.sql import functions as F

from recordloom import session
from recordloom.functions import replay_json
from recordloom.operators import reverify
from recordloom.plans import catalog, stateful


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def journal(owner, n, broken=()):
    before, rows = None, []
    for i in range(n):
        entry = {"previous_entry_sha256": before, "sequence": i}
        entry["entry_sha256"] = before = reverify.own_digest(entry)
        if i in broken:
            entry["note"] = "changed"
        rows.append((owner, i, json.dumps(entry)))
    return rows


def test_journals_are_checked_without_a_call_for_each_group(spark, sf_dir):
    for name in ("journal_segments", "journal_findings"):
        plan = plan_of(getattr(stateful, name)(spark, sf_dir))
        assert "InPandas" not in plan, plan
        assert plan.count("ArrowEvalPython") == 1, plan


def test_journal_of_no_owner_is_one_journal(spark):
    # joins by ends once lost null keys: "has no entry before" at 4 and 8
    rows = journal(None, 10) + journal("a", 9, broken={5}) + [r for r in journal("b", 9) if r[1] not in (3, 4)]
    lines = spark.createDataFrame(rows, "owner string, place bigint, entry string").repartition(3)
    found = reverify.chain_findings(reverify.journal_segments(lines, ["owner"], size=4), ["owner"])
    assert sorted((r.owner, r.place, r.problem) for r in found.collect()) == [
        ("a", 5, "does not have its own digest"), ("b", 5, "has no entry before"),
    ]


def test_entries_that_state_no_digest(spark):
    rows = [(0, "{}"), (1, "[1]"), (2, json.dumps({"sequence": 2, "previous_entry_sha256": 7, "entry_sha256": 8})), (3, None)]
    one = reverify.journal_segments(spark.createDataFrame(rows, "place bigint, entry string"), size=10).collect()
    assert [(r.segment, r.first, r.last, r.head, r.tail, r.problem, r.problem_at) for r in one] == [(0, 0, 3, None, None, "has another place", 0)]


def test_documents_are_parsed_once(spark):
    texts = ['{"title":"a","public_body":{"name":"b","tags":["x",["y",1],3,[],null]},"created_at":0}', '{"authority":7,"id":{"k":1}}', "[1]", "no", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    made = df.select("i", replay_json.replay_fields(F.col("t")).alias("r"), replay_json.record_count(F.col("t")).alias("n"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 2, plan
    rows = [r.r for r in made.orderBy("i").collect()]
    assert (rows[0].title, rows[0].authority, rows[0].authority_tags, rows[0].first_seen) == ("a", "b", ["x", "y", "[]"], None)
    assert (rows[1].authority, rows[1].authority_slug, rows[1].authority_tags, rows[1].request_id) == ("7", "", [], '{"k":1}')
    assert rows[2:] == [None, None, None]


def test_objects_are_listed_by_tasks(spark, sf_dir):
    found = stateful.stored_objects(spark, sf_dir)
    plan = plan_of(found)
    assert "binaryFile" not in plan and "FileScan" not in plan, plan
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null").select("text").distinct().count()


def test_pages_reach_python_in_batches_of_bounded_bytes(spark, sf_dir):
    @F.pandas_udf("int")
    def rows_of_batch(x: pd.Series) -> pd.Series:
        return pd.Series([len(x)] * len(x))

    spark.conf.unset(session.BYTES_SETTING)
    for query in (catalog.html_visible_text, catalog.html_core_fields):
        query(spark, sf_dir)
        assert int(spark.conf.get(session.BYTES_SETTING)) == session.BATCH_BYTES
        spark.conf.unset(session.BYTES_SETTING)
    session.bounded_batches(spark)
    text = F.concat(F.repeat(F.lit("x"), 100_000), F.col("id").cast("string"))
    assert spark.range(0, 400, 1, 1).select(rows_of_batch(text).alias("n")).agg(F.max("n")).first()[0] < 100
