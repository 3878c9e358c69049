"""Time the pipeline jobs on JSON landings built from the driver tables.

    python tools/pipeline_bench.py [sf_dir] [scratch_dir]

Builds the landing in a new scratch folder, then runs every job twice: the
first pass loads empty tables, the second merges the same landing into the
existing tables (the daily shape).  Prints one JSON line of seconds per job.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main(argv) -> int:
    from boardlake.operators.activity import MemberSpec
    from boardlake.plans import pipeline as P
    from boardlake.session import build_session
    from standin_landing import write_landing
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="boardlake-pipeline-")
    spark = build_session("pipeline-bench", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    lr, root = f"{scratch}/landing", f"{scratch}/tables"
    write_landing(spark, sf_dir, lr)
    specs = [MemberSpec(f"r{i}", f"Supplier#00000000{i}", "1996-01-01", "1999-12-31") for i in range(10)]
    jobs = [
        ("boards", lambda: P.ingest_listing(spark, f"{lr}/boards", root, "boards")),
        ("lists", lambda: P.ingest_listing(spark, f"{lr}/lists", root, "lists")),
        ("bronze_members", lambda: P.ingest_bronze(spark, f"{lr}/members", root, "members")),
        ("bronze_cards", lambda: P.ingest_bronze(spark, f"{lr}/cards", root, "cards")),
        ("silver_all_boards", lambda: P.refine_silver(spark, root, all_boards=True)),
        ("silver_unique", lambda: P.build_unique(spark, root)),
        ("gold_idle", lambda: P.gold_idle(spark, root, 30, dt.datetime(1998, 1, 1), board="1-URGENT")),
        ("gold_reports", lambda: P.gold_member_reports(spark, root, specs)),
    ]
    out = {}
    for run in ("load", "rerun"):
        for name, job in jobs:
            t0 = time.perf_counter()
            job()
            out[f"{run}:{name}"] = round(time.perf_counter() - t0, 3)
    cards = P.read_table(spark, root, P.BRONZE_CARDS).count()
    print(json.dumps({"sf_dir": sf_dir, "cards": cards, "seconds": out,
                      "total_load": round(sum(v for k, v in out.items() if k.startswith("load")), 3),
                      "total_rerun": round(sum(v for k, v in out.items() if k.startswith("rerun")), 3)}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
