"""Command line for the pipeline jobs.

    python -m boardlake ingest  --landing L --root R --kind cards|members|boards|lists
    python -m boardlake refine  --root R [--board ID | --all-boards] [--board-pick latest|last_listed]
                                [--keep-unmatched]
    python -m boardlake unique  --root R [--full]
    python -m boardlake idle    --root R --days N [--as-of YYYY-MM-DD] [--list doing] [--list-pick name|first]
                                [--board ID] [--board-pick latest|last_listed]
    python -m boardlake member  --root R --report NAME --member TEXT [--start_date D --end_date D]
                                [--date-format %Y-%m-%d] [--match contains|like]
                                [--bounds closed_ts|open_ts|closed_date] [--columns A|B|C]
    python -m boardlake reports --root R --specs specs.json
    python -m boardlake stream  --landing L --root R [--kind cards|members] [--checkpoint C]
    python -m boardlake prune   --root R [--keep 3] [--table NAME]
    python -m boardlake run-all --landing-root L --root R [--days N] [--as-of T] [--specs specs.json]
                                [--board-pick P] [--list doing] [--list-pick P] [--keep-unmatched]

Each command builds its session with :func:`boardlake.session.build_session`
and leaves master, memory and checkpoint settings to ``spark-submit``.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from boardlake.operators.activity import MemberSpec
from boardlake.schemas import GOLD_A, GOLD_B, GOLD_C

COLUMN_ORDERS = {"A": GOLD_A, "B": GOLD_B, "C": GOLD_C}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="boardlake", description="task-board medallion pipeline")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("ingest", help="landing JSON -> bronze (cards, members) or listing (boards, lists)")
    s.add_argument("--landing", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--kind", required=True, choices=["cards", "members", "boards", "lists"])
    s.add_argument("--multi-line", action="store_true", help="one JSON object per file")
    s.add_argument("--new-files", action="store_true", help="take in only files that no earlier run took in (cards, members)")
    _bucket_option(s)

    s = sub.add_parser("refine", help="bronze -> silver for one board")
    s.add_argument("--root", required=True)
    s.add_argument("--board", default=None, help="board id; default: the current sprint board")
    s.add_argument("--board-pick", default="latest", choices=["latest", "last_listed"])
    s.add_argument("--keep-unmatched", action="store_true")
    s.add_argument("--all-boards", action="store_true", help="refine every board in one pass")
    s.add_argument("--changes", action="store_true", help="refine the cards of all boards that changes since the last such run touch")
    _bucket_option(s)

    s = sub.add_parser("unique", help="silver -> newest card per name")
    s.add_argument("--root", required=True)
    s.add_argument("--full", action="store_true", help="rebuild instead of updating the changed names")

    s = sub.add_parser("idle", help="gold: cards idle for more than N days in a list")
    s.add_argument("--root", required=True)
    s.add_argument("--days", required=True, type=int)
    _idle_options(s)
    s.add_argument("--board", default=None)

    s = sub.add_parser("member", help="gold: one member's cards in a date range")
    s.add_argument("--root", required=True)
    s.add_argument("--report", required=True)
    s.add_argument("--member", required=True)
    s.add_argument("--start_date", default=None)
    s.add_argument("--end_date", default=None)
    s.add_argument("--date-format", default="%Y-%m-%d")
    s.add_argument("--match", default="contains", choices=["contains", "like"])
    s.add_argument("--bounds", default="closed_ts", choices=["closed_ts", "open_ts", "closed_date"])
    s.add_argument("--columns", default="A", choices=sorted(COLUMN_ORDERS))
    s.add_argument("--tz", default=None, help="zone the activity times are shifted to before they are compared")

    s = sub.add_parser("reports", help="gold: every member report in one scan")
    s.add_argument("--root", required=True)
    s.add_argument("--specs", default=None, help="JSON file: a list of MemberSpec fields")
    s.add_argument("--members", default=None, help="folder of Parquet files: a table with a row for each report")

    s = sub.add_parser("stream", help="incremental bronze ingest (logs what has landed, then merges it)")
    s.add_argument("--landing", required=True)
    s.add_argument("--kind", default="cards", choices=["cards", "members"])
    s.add_argument("--root", required=True)
    s.add_argument("--checkpoint", default=None)

    s = sub.add_parser("prune", help="delete all but the newest versions of snapshot tables")
    s.add_argument("--root", required=True)
    s.add_argument("--keep", type=int, default=3)
    s.add_argument("--table", default=None, help="one table; default: every table under the root")

    s = sub.add_parser("optimize", help="write a table's newest version again in Z-order")
    s.add_argument("--root", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--by", required=True, help="columns, separated by commas")

    s = sub.add_parser("run-all", help="every layer once")
    s.add_argument("--landing-root", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--days", type=int, default=7)
    _idle_options(s)
    s.add_argument("--specs", default=None, help="JSON file: a list of MemberSpec fields")
    s.add_argument("--keep-unmatched", action="store_true")
    return p


def _bucket_option(s: argparse.ArgumentParser) -> None:
    s.add_argument("--buckets", type=int, default=None, help="cut the card tables into so many buckets by board; 0: keep them whole")


def _idle_options(s: argparse.ArgumentParser) -> None:
    s.add_argument("--as-of", default=None, help="YYYY-MM-DD[THH:MM:SS[+HH:MM]], UTC without a zone; default: now")
    s.add_argument("--list", dest="list_name", default="doing")
    s.add_argument("--list-pick", default="name", choices=["name", "first"])
    s.add_argument("--board-pick", default="latest", choices=["latest", "last_listed"])


def load_specs(path: str) -> list[MemberSpec]:
    """Specs of a JSON file; ``columns`` may be a list of names or A, B or C."""
    with open(path) as f:
        items = json.load(f)
    for item in items:
        if "columns" in item:
            item["columns"] = tuple(COLUMN_ORDERS.get(item["columns"], item["columns"])
                                    if isinstance(item["columns"], str) else item["columns"])
    return [MemberSpec(**item) for item in items]


def _as_of(args) -> _dt.datetime | None:
    return _dt.datetime.fromisoformat(args.as_of) if args.as_of else None


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    from boardlake.plans import pipeline as P
    from boardlake.session import build_session
    spark = spark or build_session(f"boardlake-{args.cmd}")

    if args.cmd == "ingest":
        if args.kind in ("cards", "members") and args.new_files:
            v = P.ingest_new(spark, args.landing, args.root, args.kind, args.multi_line, buckets=args.buckets)
        elif args.kind in ("cards", "members"):
            v = P.ingest_bronze(spark, args.landing, args.root, args.kind, args.multi_line, buckets=args.buckets)
        else:
            v = P.ingest_listing(spark, args.landing, args.root, args.kind, args.multi_line)
    elif args.cmd == "refine" and args.changes:
        from boardlake.plans.incremental import refine_changes
        v = refine_changes(spark, args.root, args.keep_unmatched, args.buckets)
    elif args.cmd == "refine":
        v = P.refine_silver(spark, args.root, args.board, args.board_pick, args.keep_unmatched,
                            args.all_boards, args.buckets)
    elif args.cmd == "unique":
        v = P.build_unique(spark, args.root, incremental=not args.full)
    elif args.cmd == "idle":
        v = P.gold_idle(spark, args.root, args.days, _as_of(args), args.list_name, args.list_pick, args.board,
                        args.board_pick)
    elif args.cmd == "member":
        spec = MemberSpec(args.report, args.member, args.start_date, args.end_date, args.match,
                          args.bounds, args.date_format, args.tz, tuple(COLUMN_ORDERS[args.columns]))
        v = P.gold_member(spark, args.root, spec)
    elif args.cmd == "reports":
        if not (args.specs or args.members):
            raise SystemExit("reports: give --specs or --members")
        if args.members:
            v = P.gold_member_table(spark, args.root, spark.read.parquet(args.members))
        else:
            v = P.gold_member_reports(spark, args.root, load_specs(args.specs))
    elif args.cmd == "stream":
        from boardlake.streaming.ingest import compact_changes, stream_cards, stream_members
        start = stream_cards if args.kind == "cards" else stream_members
        start(spark, args.landing, args.root, args.checkpoint).awaitTermination()
        v = compact_changes(spark, args.root, args.kind)
    elif args.cmd == "optimize":
        from boardlake.sources.zorder import optimize
        v = optimize(spark, args.root, args.table, args.by.split(","))
    elif args.cmd == "prune":
        from boardlake.sources.tables import list_tables, prune_versions
        names = [args.table] if args.table else list_tables(spark, args.root)
        v = {n: prune_versions(spark, args.root, n, args.keep) for n in names}
    else:
        P.run_all(spark, args.landing_root, args.root, args.days, _as_of(args),
                  load_specs(args.specs) if args.specs else (), args.board_pick, args.list_name, args.list_pick,
                  args.keep_unmatched)
        v = None
    print(json.dumps({"command": args.cmd, "version": v}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
