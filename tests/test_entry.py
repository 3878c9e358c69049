import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["id", "name", "card_members", "LastUpdated", "board_name"]
    assert 0 < df.count() < 1500


def test_every_query_has_an_oracle():
    import __spark_entry__ as e
    from boardlake.plans.catalog import QUERIES
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_variants_differ(spark):
    """Bounds, matches and date styles give different rows, so that a mix-up shows."""
    from boardlake.plans.catalog import QUERIES
    sf = SF.replace("0.001", "0.01")
    groups = [["activity_contains", "activity_open_ts", "activity_closed_date", "activity_like", "activity_optional",
               "activity_dayfirst", "medallion_e2e"], ["range_closed_ts", "range_open_ts", "range_closed_date", "range_tz"]]
    for names in groups:
        found = {n: tuple(sorted(r[0] for r in QUERIES[n](spark, sf).select("id").collect())) for n in names}
        assert len(set(found.values())) == len(names)
    swapped = QUERIES["activity_dayfirst"].__globals__
    assert swapped["DAYFIRST_START"][:2] != swapped["DAYFIRST_START"][3:5]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_building_a_query_runs_no_job_and_no_guard(spark):
    """Only schema reads (and the stored batch of ``stream_target``) may run before the result is asked for."""
    from boardlake.plans.catalog import QUERIES
    tracker = spark.sparkContext.statusTracker()
    for name, query in QUERIES.items():
        if name in ("upsert_small_batch", "activity_member_table"):   # the latter stores its members' probes
            continue
        for table in ("orders", "lineitem", "supplier", "events"):   # schema reads are known now
            spark.read.parquet(f"{SF}/{table}.parquet").schema
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setJobGroup("default", "default")
        stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
        # A schema read is one task over file footers.
        assert all(tracker.getStageInfo(s) is None or tracker.getStageInfo(s).numTasks <= 1 for s in stages), name
        assert "GlobalLimit" not in plan and "CollectLimit" not in plan, name
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_silver_upsert_exchanges(spark):
    from boardlake.plans.catalog import QUERIES
    df = QUERIES["silver_upsert"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    import re
    assert len(re.findall(r"(?<!\], )Exchange hashpartitioning", plan)) <= 6      # a ReusedExchange is none


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_queries_match_oracle(spark):
    from boardlake.plans.catalog import QUERIES
    from oracle_check import compare
    res = compare(spark, SF, list(QUERIES))
    bad = {k: v for k, v in res.items() if not (v.get("values_match") and v.get("cols_match"))}
    assert not bad
