import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boardlake.operators.upsert import upsert
from conftest import rows

SCHEMA = "id string, v string, n long"
PLANS = pytest.mark.parametrize("plan", ["shuffle", "stream_target"])


@PLANS
def test_merge_semantics(spark, plan):
    target = spark.createDataFrame([("a", "old", 1), ("b", "keep", 2), (None, "nullkey", 3)], SCHEMA)
    source = spark.createDataFrame([("a", None, 10), ("c", "new", 30), (None, "nullsrc", 40)], SCHEMA)
    got = rows(upsert(target, source, ["id"], plan=plan))
    assert got == sorted([
        ("a", None, 10),          # matched: every column from the source, null included
        ("b", "keep", 2),         # target only: kept
        ("c", "new", 30),         # source only: inserted
        (None, "nullkey", 3),     # null keys never match: kept ...
        (None, "nullsrc", 40),    # ... and inserted
    ], key=repr)


@PLANS
def test_schema_evolution(spark, plan):
    target = spark.createDataFrame([("a", "t", 1), ("b", "t", 2)], "id string, v string, old long")
    source = spark.createDataFrame([("a", "s", True), ("c", "s", False)], "id string, v string, new boolean")
    out = upsert(target, source, ["id"], plan=plan)
    assert out.columns == ["id", "v", "old", "new"]
    assert rows(out) == sorted([("a", "s", 1, True), ("b", "t", 2, None), ("c", "s", None, False)], key=repr)


@PLANS
def test_duplicate_source_key_fails_without_order(spark, plan):
    target = spark.createDataFrame([("a", "t", 1)], SCHEMA)
    source = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], SCHEMA)
    with pytest.raises(Exception, match="source repeats key"):
        upsert(target, source, ["id"], plan=plan).collect()


@PLANS
def test_duplicate_null_keys_are_allowed(spark, plan):
    target = spark.createDataFrame([("a", "t", 1)], SCHEMA)
    source = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], SCHEMA)
    assert upsert(target, source, ["id"], plan=plan).count() == 3


@PLANS
def test_duplicate_source_key_newest_wins(spark, plan):
    target = spark.createDataFrame([("a", "t", 1)], SCHEMA)
    source = spark.createDataFrame([("a", "x", 5), ("a", "y", 7), ("b", "z", 1)], SCHEMA)
    got = rows(upsert(target, source, ["id"], order_by=[F.col("n").desc()], plan=plan))
    assert got == [("a", "y", 7), ("b", "z", 1)]


@PLANS
def test_keep_newer(spark, plan):
    s = "id string, v string, ts timestamp"
    target = spark.createDataFrame([("a", "stored", dt.datetime(2023, 1, 9)),
                                    ("b", "stored", dt.datetime(2023, 1, 1))], s)
    source = spark.createDataFrame([("a", "late", dt.datetime(2023, 1, 5)),
                                    ("b", "fresh", dt.datetime(2023, 1, 6))], s)
    got = rows(upsert(target, source, ["id"], keep_newer="ts", plan=plan), "id", "v")
    assert got == [("a", "stored"), ("b", "fresh")]


def test_plans(spark):
    target = spark.range(100).selectExpr("cast(id as string) id", "'t' v", "id n")
    source = spark.range(50, 150).selectExpr("cast(id as string) id", "'s' v", "id n")
    small = upsert(target, source, ["id"], plan="stream_target", keys_not_null=True)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BroadcastHashJoin" in plan and "FullOuter" not in plan   # target streamed, not shuffled
    large = upsert(target, source, ["id"], keys_not_null=True)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    assert rows(small) == rows(large)


keys = st.lists(st.tuples(st.integers(0, 20), st.integers(0, 5)), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t=keys, s=keys)
def test_properties(spark, t, s):
    dedup = lambda xs: list({k: v for k, v in xs}.items())
    target = spark.createDataFrame([(str(k), str(v), v) for k, v in dedup(t)], SCHEMA)
    source = spark.createDataFrame([(str(k), str(v), v) for k, v in dedup(s)], SCHEMA)
    once = upsert(target, source, ["id"])
    assert rows(once) == rows(upsert(target, source, ["id"], plan="stream_target"))
    twice = upsert(once, source, ["id"])
    assert rows(once) == rows(twice)                          # idempotent
    ids = [r[0] for r in once.select("id").collect()]
    assert len(ids) == len(set(ids))                          # key stays unique
    expected = dict((str(k), v) for k, v in dedup(t))
    expected.update((str(k), v) for k, v in dedup(s))
    assert sorted(ids) == sorted(expected)


@PLANS
def test_null_key_rows_pass_by_the_join(spark, plan):
    target = spark.createDataFrame([("a", "t", 1)] + [(None, "tn", i) for i in range(50)], SCHEMA)
    source = spark.createDataFrame([("a", "x", 5), ("a", "y", 7)] + [(None, "sn", i) for i in range(50)]
                                   + [(None, "sn", 0)], SCHEMA)
    out = upsert(target, source, ["id"], order_by=[F.col("n").desc()], plan=plan)
    assert out.where("id = 'a'").collect()[0]["v"] == "y"
    # Every null-key row is kept, the repeated one too, and none is dealt out by key.
    assert out.where("id is null").count() == 101
    text = out._jdf.queryExecution().executedPlan().toString()
    if plan == "shuffle":
        assert "WindowGroupLimit" in text and text.count("hashpartitioning") == 2


@PLANS
def test_null_key_rows_that_differ_by_a_microsecond_stay(spark, plan):
    s = "id string, v string, ts timestamp"
    target = spark.createDataFrame([("a", "t", dt.datetime(2023, 1, 1))], s)
    source = spark.createDataFrame([(None, "x", dt.datetime(2023, 1, 1, 0, 0, 0, us)) for us in (1, 2, 2)], s)
    out = upsert(target, source, ["id"], order_by=[F.col("ts").desc()], plan=plan)
    assert out.where("id is null").count() == 3


@PLANS
def test_a_null_in_a_key_declared_non_null_fails(spark, plan):
    target = spark.createDataFrame([("a", "t", 1)], SCHEMA)
    source = spark.createDataFrame([("b", "x", 1), (None, "y", 2)], SCHEMA)
    for t, s in ((target, source), (source, target)):
        with pytest.raises(Exception, match="declared non-null"):
            upsert(t, s, ["id"], plan=plan, keys_not_null=True).collect()


@PLANS
def test_undated_source_never_overwrites_a_dated_row(spark, plan):
    s = "id string, v string, ts timestamp"
    target = spark.createDataFrame([("a", "stored", dt.datetime(2023, 1, 9)), ("b", "stored", None)], s)
    source = spark.createDataFrame([("a", "undated", None), ("b", "undated", None), ("c", "undated", None)], s)
    got = rows(upsert(target, source, ["id"], keep_newer="ts", plan=plan), "id", "v")
    assert got == [("a", "stored"), ("b", "undated"), ("c", "undated")]


@PLANS
def test_matched_with_null_target_timestamp_takes_source(spark, plan):
    s = "id string, v string, ts timestamp"
    target = spark.createDataFrame([("a", "stored", None)], s)
    source = spark.createDataFrame([("a", "new", dt.datetime(2023, 1, 5))], s)
    assert rows(upsert(target, source, ["id"], keep_newer="ts", plan=plan), "v") == [("new",)]


def test_a_large_source_gets_the_shuffle_plan(spark, monkeypatch):
    import boardlake.operators.upsert as U
    target = spark.range(100).selectExpr("cast(id as string) id", "'t' v", "id n")
    source = spark.range(50, 150).selectExpr("cast(id as string) id", "'s' v", "id n")
    monkeypatch.setattr(U, "MAX_SOURCE_FILE_BYTES", 10)
    out = upsert(target, source, ["id"], plan="stream_target")
    assert "FullOuter" in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == rows(upsert(target, source, ["id"]))
    with pytest.raises(ValueError):
        upsert(target, source, ["id"], plan="broadcast")
