"""Task failures are retried without changing results.

Runs in a fresh JVM (``local[4,4]``: up to four attempts per task) and makes
the first attempt of every even-numbered task fail inside the upsert's
source and inside the cards feeding the member-name join and the
newest-per-name dedupe.  The results must equal an
un-faulted run.  (The UDF is only the fault injector.)
"""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(r"""
    import sys, tempfile
    sys.path.insert(0, REPO)
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from boardlake.session import build_session, checkpoint_root
    spark = build_session("retries", master="local[4,4]", conf={
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    checkpoint_root(spark, default=tempfile.mkdtemp(prefix="retries-ckpt-"))
    from boardlake.operators.upsert import upsert

    @F.udf("long")
    def flaky(x):
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return x

    def tables(fault):
        t = spark.range(0, 3000, numPartitions=4).selectExpr(
            "case when id % 97 = 0 then null else cast(id as string) end as id", "'t' as v", "id as n")
        s = spark.range(2000, 5000, numPartitions=4).selectExpr(
            "case when id % 89 = 0 then null else cast(id % 4000 as string) end as id", "'s' as v", "id as n")
        if fault:
            s = s.withColumn("n", flaky("n"))
        return t, s

    def result(fault, plan):
        t, s = tables(fault)
        out = upsert(t, s, ["id"], order_by=[F.col("n").desc()], plan=plan)
        return sorted((r.id or "", r.v, r.n) for r in out.collect())

    for plan in ("shuffle", "stream_target"):
        assert result(True, plan) == result(False, plan), plan
    assert result(False, "shuffle") == result(False, "stream_target")

    from boardlake.operators.members import member_names
    from boardlake.operators.refine import unique_cards
    cards = spark.range(0, 4000, numPartitions=4).selectExpr(
        "cast(id as string) as id", "cast(id % 300 as string) as name",
        "timestamp_seconds(id * 3600) as dateLastActivity",
        "array(cast(id % 50 as string), cast(id % 7 as string), 'zz') as idMembers")
    members = spark.range(0, 50).selectExpr("cast(id as string) as id", "concat('M', id) as fullName")

    def silver(fault, size):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", size)
        c = cards.where(flaky(F.col("id").cast("long")) >= 0) if fault else cards
        named = member_names(c, members)
        return (sorted(tuple(r) for r in named.select("id", "card_members").collect()),
                sorted(r[0] for r in unique_cards(named).select("id").collect()))

    for size in ("-1", "64MB"):    # shuffle join, then AQE's broadcast join
        assert silver(True, size) == silver(False, size), size
    print("RETRIES-OK")
""").replace("REPO", repr(REPO))


def test_injected_task_failures_do_not_change_results(tmp_path):
    proc = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600,
                          cwd=str(tmp_path))
    assert "RETRIES-OK" in proc.stdout, proc.stderr[-3000:]
