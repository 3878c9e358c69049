import datetime as dt
import json
import os

from boardlake.operators.activity import MemberSpec
from boardlake.plans import pipeline as P
from boardlake.sources.tables import committed_versions, read_table, write_snapshot
from conftest import rows


def _write(path, objs):
    os.makedirs(path, exist_ok=True)
    n = len(os.listdir(path))
    with open(os.path.join(path, f"part-{n:04d}.json"), "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")


BOARDS = [{"id": "b1", "name": "Sprint (14-Sept-2022)", "pos": 1},
          {"id": "b2", "name": "Sprint (4-JAN-2023)", "pos": 2},
          {"id": "b3", "name": "Sprint (archive)", "pos": 3}]
LISTS = [{"id": "l1", "idBoard": "b2", "name": "backlog", "pos": 1},
         {"id": "l2", "idBoard": "b2", "name": "Doing", "pos": 2},
         {"id": "l3", "idBoard": "b2", "name": "done", "pos": 3}]
MEMBERS = [{"id": "m1", "fullName": "Ann Lee", "username": "ann", "idOrganizations": ["o1"]},
           {"id": "m2", "fullName": "Bo Li", "username": "bo"},
           {"id": None, "fullName": "no id"}]


def card(i, name, when, lst="l2", members=("m1",), board="b2", extra=None):
    c = {"id": i, "closed": False, "dateLastActivity": when, "due": None, "idBoard": board,
         "idList": lst, "desc": "", "idMembers": list(members), "name": name,
         "shortLink": i, "shortUrl": "u/" + i, "url": "https://x/" + i, "unknownKey": 1}
    if extra:
        c.update(extra)
    return c


CARDS = [card("c1", "fix login", "2023-01-02T10:00:00.000Z"),
         card("c2", "fix login", "2023-01-08T09:00:00.000Z", members=("m1", "m2")),
         card("c3", "write docs", "2022-12-20T00:00:00.000Z", members=("m2",)),
         card("c4", "lonely", "2023-01-03T00:00:00.000Z", members=()),
         card("c5", "old board", "2023-01-03T00:00:00.000Z", board="b1"),
         card("c6", "bad time", "garbage", members=("m2",))]


def _landing(tmp_path):
    lr = str(tmp_path / "landing")
    _write(f"{lr}/boards", BOARDS)
    _write(f"{lr}/lists", LISTS)
    _write(f"{lr}/members", MEMBERS)
    _write(f"{lr}/cards", CARDS)
    return lr


def _snapshot(spark, root):
    return {name: rows(read_table(spark, root, name))
            for name in [P.BRONZE_CARDS, P.BRONZE_MEMBERS, P.SILVER_CARDS, P.SILVER_UNIQUE, P.GOLD_IDLE]}


def test_end_to_end_twice(spark, tmp_path):
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    specs = [MemberSpec("ann", "Ann Lee", "2023-01-01", "2023-01-08", "contains", "closed_ts"),
             MemberSpec("bo", "Bo Li", "2023-01-01", "2023-01-08", "contains", "closed_date")]
    as_of = dt.datetime(2023, 1, 9)
    P.run_all(spark, lr, root, idle_days=5, as_of=as_of, specs=specs)
    first = _snapshot(spark, root)
    P.run_all(spark, lr, root, idle_days=5, as_of=as_of, specs=specs)
    assert _snapshot(spark, root) == first                       # rerun changes nothing
    assert committed_versions(spark, root, P.BRONZE_CARDS) == [1, 2]

    bronze = read_table(spark, root, P.BRONZE_CARDS)
    assert bronze.columns[:3] == ["id", "closed", "dateLastActivity"]
    assert bronze.where("id = 'c6'").select("dateLastActivity").first()[0] is None   # bad text -> null
    assert P.read_rejects(spark, root, "members").count() == 2    # one for each run

    silver = read_table(spark, root, P.SILVER_CARDS)
    got = rows(silver, "id", "card_members", "LastUpdated", "board_name")
    # Current board b2 only; c4 has no member and drops; c6 keeps a null date.
    assert got == [("c1", "Ann Lee", "02-01-2023", "Sprint (4-JAN-2023)"),
                   ("c2", "Ann Lee, Bo Li", "08-01-2023", "Sprint (4-JAN-2023)"),
                   ("c3", "Bo Li", "20-12-2022", "Sprint (4-JAN-2023)"),
                   ("c6", "Bo Li", None, "Sprint (4-JAN-2023)")]
    unique = rows(read_table(spark, root, P.SILVER_UNIQUE), "id")
    assert unique == [("c2",), ("c3",), ("c6",)]
    idle = rows(read_table(spark, root, P.GOLD_IDLE), "id")
    assert idle == [("c1",), ("c3",)]                            # before 01-04, in 'Doing'
    reports = rows(read_table(spark, root, P.GOLD_REPORTS), "report", "id")
    # closed_ts ends at 01-08 00:00, so c2 (09:00 that day) is only in the closed_date report.
    assert reports == [("bo", "c2")]


def test_incremental_update(spark, tmp_path):
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    P.run_all(spark, lr, root, idle_days=5, as_of=dt.datetime(2023, 1, 9))
    _write(f"{lr}/cards", [card("c1", "fix login", "2023-01-09T00:00:00.000Z", members=("m2",),
                                extra={"desc": None})])
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    P.refine_silver(spark, root)
    silver = dict(rows(read_table(spark, root, P.SILVER_CARDS), "id", "card_members"))
    assert silver["c1"] == "Bo Li"
    assert read_table(spark, root, P.BRONZE_CARDS).where("id='c1'").select("desc").first()[0] is None


def test_snapshot_widening(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.createDataFrame([(1, "a")], "id int, old string"), root, "x")
    write_snapshot(spark.createDataFrame([(2, True)], "id int, new boolean"), root, "x")
    t = read_table(spark, root, "x")
    assert t.columns == ["id", "old", "new"]
    assert rows(t) == [(2, None, True)]
    assert rows(read_table(spark, root, "x", version=1)) == [(1, "a")]


def test_prune_versions(spark, tmp_path):
    from boardlake.sources.tables import prune_versions
    root = str(tmp_path / "t")
    for i in range(5):
        write_snapshot(spark.createDataFrame([(i,)], "id int"), root, "x")
    assert prune_versions(spark, root, "x", keep=2) == [1, 2, 3]
    assert committed_versions(spark, root, "x") == [4, 5]
    assert rows(read_table(spark, root, "x")) == [(4,)]


def test_multi_line_landing(spark, tmp_path):
    from boardlake.sources.landing import read_cards
    d = tmp_path / "one-object-per-file"
    d.mkdir()
    for c in CARDS[:2]:
        (d / f"{c['id']}.json").write_text(json.dumps(c, indent=2))
    got = rows(read_cards(spark, str(d), multi_line=True), "id", "name")
    assert got == [("c1", "fix login"), ("c2", "fix login")]


def test_gold_member_column_orders(spark, tmp_path):
    from boardlake.schemas import GOLD_B, GOLD_C
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    P.run_all(spark, lr, root, idle_days=5, as_of=dt.datetime(2023, 1, 9))
    spec = MemberSpec("bo", "Bo Li", "2022-12-01", "2023-01-31", "like", "open_ts")
    P.gold_member(spark, root, spec, GOLD_B)
    assert read_table(spark, root, "gold_bo").columns == GOLD_B
    P.gold_member(spark, root, spec, GOLD_C)
    t = read_table(spark, root, "gold_bo")
    # mergeSchema overwrite: card_members stays as a column, null in the new rows.
    assert t.columns == GOLD_B and t.where("card_members is not null").count() == 0
    assert rows(t, "id") == [("c2",), ("c3",)]


def test_cli(spark, tmp_path, capsys):
    from boardlake.plans.cli import main
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    for kind in ("boards", "lists", "members", "cards"):
        main(["ingest", "--landing", f"{lr}/{kind}", "--root", root, "--kind", kind], spark=spark)
    main(["refine", "--root", root], spark=spark)
    main(["unique", "--root", root], spark=spark)
    main(["idle", "--root", root, "--days", "5", "--as-of", "2023-01-09"], spark=spark)
    main(["member", "--root", root, "--report", "ann", "--member", "Ann Lee", "--start_date",
          "01-01-2023", "--end_date", "08-01-2023", "--date-format", "%d-%m-%Y",
          "--bounds", "closed_date", "--columns", "C"], spark=spark)
    specs = tmp_path / "specs.json"
    specs.write_text(json.dumps([{"report": "bo", "member": "Bo Li"}]))
    main(["reports", "--root", root, "--specs", str(specs)], spark=spark)
    assert rows(read_table(spark, root, P.GOLD_IDLE), "id") == [("c1",), ("c3",)]
    assert rows(read_table(spark, root, "gold_ann"), "id") == [("c2",)]
    assert rows(read_table(spark, root, P.GOLD_REPORTS), "report", "id") == [("bo", "c2"), ("bo", "c3"),
                                                                              ("bo", "c6")]
    assert '"command": "reports"' in capsys.readouterr().out
    main(["ingest", "--landing", f"{lr}/cards", "--root", root, "--kind", "cards"], spark=spark)
    main(["prune", "--root", root, "--keep", "1"], spark=spark)
    for name in (P.BRONZE_CARDS, P.SILVER_CARDS, P.GOLD_IDLE):
        assert len(committed_versions(spark, root, name)) == 1
    assert rows(read_table(spark, root, P.GOLD_IDLE), "id") == [("c1",), ("c3",)]


def test_idle_resolves_the_board_as_refine_does(spark, tmp_path):
    from boardlake.plans.cli import main
    lr, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    _write(f"{lr}/boards", [{"id": "b2", "name": "Sprint (4-JAN-2023)", "pos": 1.5},
                            {"id": "b1", "name": "Sprint (14-Sept-2022)", "pos": 2}])
    _write(f"{lr}/lists", LISTS + [{"id": "l9", "idBoard": "b1", "name": "doing", "pos": 1}])
    _write(f"{lr}/members", MEMBERS)
    _write(f"{lr}/cards", CARDS + [card("c9", "on b1", "2022-12-01T00:00:00.000Z", lst="l9", board="b1")])
    specs = tmp_path / "specs.json"
    specs.write_text(json.dumps([{"report": "ann", "member": "Ann Lee", "columns": "C"}]))
    main(["run-all", "--landing-root", lr, "--root", root, "--days", "5", "--as-of", "2023-01-09T05:30:00+05:30",
          "--board-pick", "last_listed", "--specs", str(specs)], spark=spark)
    assert rows(read_table(spark, root, P.GOLD_IDLE), "id") == [("c9",)]
    assert rows(read_table(spark, root, P.GOLD_REPORTS), "report", "id") == [("ann", "c5"), ("ann", "c9")]
    main(["idle", "--root", root, "--days", "5", "--as-of", "2023-01-09", "--board-pick", "last_listed"], spark=spark)
    assert rows(read_table(spark, root, P.GOLD_IDLE), "id") == [("c9",)]


def test_member_spec_columns_and_zone(spark, tmp_path):
    from boardlake.plans.cli import load_specs
    from boardlake.schemas import GOLD_C
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    P.run_all(spark, lr, root, idle_days=5, as_of=dt.datetime(2023, 1, 9))
    specs = tmp_path / "specs.json"
    specs.write_text(json.dumps([{"report": "bo", "member": "Bo Li", "start": "2023-01-07", "end": "2023-01-07",
                                  "bounds": "closed_date", "tz": "-10:00", "columns": "C"}]))
    (spec,) = load_specs(str(specs))
    P.gold_member(spark, root, spec)
    assert read_table(spark, root, "gold_bo").columns == GOLD_C
    assert rows(read_table(spark, root, "gold_bo"), "id") == [("c2",)]     # 09:00 UTC is the day before there
    P.gold_member_reports(spark, root, [spec])
    assert rows(read_table(spark, root, P.GOLD_REPORTS), "id") == [("c2",)]


def test_refine_all_boards(spark, tmp_path):
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    for kind in ("boards", "lists"):
        P.ingest_listing(spark, f"{lr}/{kind}", root, kind)
    P.ingest_bronze(spark, f"{lr}/members", root, "members")
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    P.refine_silver(spark, root, all_boards=True)
    got = rows(read_table(spark, root, P.SILVER_CARDS), "id", "board_name")
    assert got == [("c1", "Sprint (4-JAN-2023)"), ("c2", "Sprint (4-JAN-2023)"),
                   ("c3", "Sprint (4-JAN-2023)"), ("c5", "Sprint (14-Sept-2022)"),
                   ("c6", "Sprint (4-JAN-2023)")]


def test_malformed_landing_rows_are_kept(spark, tmp_path):
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    with open(f"{lr}/cards/part-9999.json", "w") as f:
        f.write('{"id": "c9", "name": "broken", \n')
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    assert read_table(spark, root, P.BRONZE_CARDS).count() == len(CARDS)
    assert "_corrupt_record" not in read_table(spark, root, P.BRONZE_CARDS).columns
    rejected = P.read_rejects(spark, root, "cards").collect()
    assert len(rejected) == 1 and rejected[0]["_corrupt_record"].startswith('{"id": "c9"')
    os.remove(f"{lr}/cards/part-9999.json")
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    assert P.read_rejects(spark, root, "cards").count() == 1      # a later run keeps them
    with open(f"{lr}/lists/part-9999.json", "w") as f:
        f.write('{"id": "l9", oops\n')
    P.ingest_listing(spark, f"{lr}/lists", root, "lists")
    assert read_table(spark, root, P.LISTS).count() == len(LISTS)
    assert P.read_rejects(spark, root, "lists").first()["_corrupt_record"] == '{"id": "l9", oops'


def test_the_last_landed_record_of_an_id_wins(spark, tmp_path):
    from boardlake.streaming.ingest import compact_changes, stream_members
    landing, root = str(tmp_path / "members"), str(tmp_path / "tables")
    # Named so that the later file comes first by name.
    for age, (name, suffix) in enumerate([("z.json", "old"), ("a.json", "new")]):
        os.makedirs(landing, exist_ok=True)
        with open(f"{landing}/{name}", "w") as f:
            for k in range(20):
                f.write(json.dumps({"id": f"m{k}", "fullName": f"{k} older {suffix}"}) + "\n")
                f.write(json.dumps({"id": f"m{k}", "fullName": f"{k} {suffix}"}) + "\n")
        os.utime(f"{landing}/{name}", (1_700_000_000 + age, 1_700_000_000 + age))
    P.ingest_bronze(spark, landing, root, "members")
    want = sorted((f"m{k}", f"{k} new") for k in range(20))
    assert rows(read_table(spark, root, P.BRONZE_MEMBERS), "id", "fullName") == want
    stream_members(spark, landing, str(tmp_path / "s"), checkpoint=str(tmp_path / "c")).awaitTermination()
    compact_changes(spark, str(tmp_path / "s"), "members")
    assert rows(read_table(spark, str(tmp_path / "s"), P.BRONZE_MEMBERS), "id", "fullName") == want


def test_cards_of_one_date_go_by_landing(spark, tmp_path):
    landing, root = str(tmp_path / "cards"), str(tmp_path / "tables")
    _write(landing, [card("c1", "first", "2023-01-02T00:00:00.000Z"), card("c1", "second", "2023-01-02T00:00:00.000Z"),
                     card("c1", "undated", None)])
    P.ingest_bronze(spark, landing, root, "cards")
    assert rows(read_table(spark, root, P.BRONZE_CARDS), "name") == [("second",)]


def test_json_is_parsed_once(spark, tmp_path, monkeypatch):
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    seen = []
    real = P.write_part
    monkeypatch.setattr(P, "write_part", lambda df, *a: (seen.append(df._jdf.queryExecution().executedPlan().toString()),
                                                         real(df, *a)))
    real_merge = P.merge_into
    monkeypatch.setattr(P, "merge_into", lambda s, r, n, source, *a, **k: (
        seen.append(source._jdf.queryExecution().executedPlan().toString()), real_merge(s, r, n, source, *a, **k))[1])
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    assert [plan.count("Scan json") + plan.count("FileScan json") > 0 for plan in seen] == [True, False, False, False]  # rejects, failures, upsert


def test_clustered_snapshot_files_are_sorted(spark, tmp_path):
    import glob
    import pyarrow.parquet as pq
    root = str(tmp_path / "t")
    df = spark.range(0, 5000, numPartitions=4).selectExpr("id", "(id * 7919) % 1000 as k")
    write_snapshot(df.repartition(3), root, "x", cluster_by=["k"])
    files = glob.glob(f"{root}/x/version=*/*.parquet")
    assert files
    for f in files:
        ks = pq.read_table(f).column("k").to_pylist()
        assert ks == sorted(ks)
    assert read_table(spark, root, "x").count() == 5000


def test_upsert_plans_give_the_same_tables(spark, tmp_path):
    lr = _landing(tmp_path)
    tables = {}
    for plan in ("shuffle", "stream_target"):
        root = str(tmp_path / plan)
        for _ in range(2):
            P.ingest_bronze(spark, f"{lr}/cards", root, "cards", plan=plan)
        tables[plan] = rows(read_table(spark, root, P.BRONZE_CARDS))
    assert tables["shuffle"] == tables["stream_target"]


def test_incremental_unique_equals_full_rebuild(spark, tmp_path):
    from boardlake.operators.refine import unique_cards
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    P.run_all(spark, lr, root, idle_days=5, as_of=dt.datetime(2023, 1, 9))
    # Rename c3 into the "fix login" group, move c2 back in time, add a card
    # without a name and one with a new name.
    _write(f"{lr}/cards", [
        card("c3", "fix login", "2023-01-09T00:00:00.000Z", members=("m2",)),
        card("c2", "fix login", "2022-12-01T00:00:00.000Z", members=("m1",)),
        card("c7", None, "2023-01-04T00:00:00.000Z", members=("m1",)),
        card("c8", "brand new", "2023-01-05T00:00:00.000Z", members=("m2",))])
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    P.refine_silver(spark, root)
    _write(f"{lr}/cards", [card("c8", "renamed again", "2023-01-06T00:00:00.000Z", members=("m2",))])
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    P.refine_silver(spark, root)                       # two refines, one build
    built_from = read_table(spark, root, P.SILVER_UNIQUE_STATE).first()[0]
    latest = max(committed_versions(spark, root, P.SILVER_CARDS))
    changed = P._changed_names(spark, root, built_from, latest)
    assert changed is not None                         # the incremental path is taken
    # A refine re-refines the whole current board, so every name on it counts
    # as touched, plus the names its cards had before (c3 was "write docs").
    assert sorted(r[0] or "" for r in changed.collect()) == \
        ["", "bad time", "brand new", "fix login", "renamed again", "write docs"]
    P.build_unique(spark, root)
    full = rows(unique_cards(read_table(spark, root, P.SILVER_CARDS)))
    assert rows(read_table(spark, root, P.SILVER_UNIQUE)) == full
    ids = [r[0] for r in rows(read_table(spark, root, P.SILVER_UNIQUE), "id")]
    assert ids == ["c3", "c6", "c7", "c8"]
    assert read_table(spark, root, P.SILVER_CHANGES).count() == 0      # log trimmed after the build
    v = P.build_unique(spark, root)                    # nothing new: no new version
    assert v == max(committed_versions(spark, root, P.SILVER_UNIQUE))


def test_unique_rebuilds_when_silver_has_no_change_log(spark, tmp_path):
    from boardlake.operators.refine import unique_cards
    lr, root = _landing(tmp_path), str(tmp_path / "tables")
    P.run_all(spark, lr, root, idle_days=5, as_of=dt.datetime(2023, 1, 9))
    silver = read_table(spark, root, P.SILVER_CARDS)
    write_snapshot(silver.where("id != 'c2'"), root, P.SILVER_CARDS)   # written by another job
    built_from = read_table(spark, root, P.SILVER_UNIQUE_STATE).first()[0]
    latest = max(committed_versions(spark, root, P.SILVER_CARDS))
    assert P._changed_names(spark, root, built_from, latest) is None   # falls back to a rebuild
    P.build_unique(spark, root)
    assert rows(read_table(spark, root, P.SILVER_UNIQUE)) == \
        rows(unique_cards(read_table(spark, root, P.SILVER_CARDS)))


def test_cli_stream_and_run_all(spark, tmp_path):
    from boardlake.plans.cli import main
    lr = _landing(tmp_path)
    streamed, batched = str(tmp_path / "streamed"), str(tmp_path / "batched")
    main(["stream", "--landing", f"{lr}/cards", "--root", streamed, "--kind", "cards",
          "--checkpoint", str(tmp_path / "ckpt")], spark=spark)
    main(["run-all", "--landing-root", lr, "--root", batched, "--days", "5"], spark=spark)
    assert rows(read_table(spark, streamed, P.BRONZE_CARDS)) == rows(read_table(spark, batched, P.BRONZE_CARDS))
    assert read_table(spark, batched, P.SILVER_UNIQUE).count() == 3
