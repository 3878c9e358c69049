"""Incremental refine against refining everything, and what it reads."""

import random

import pytest
from pyspark.sql import functions as F

from boardlake.plans import incremental as I
from boardlake.plans import pipeline as P
from boardlake.sources.tables import bucket_paths, latest_version, prune_versions, read_table
from conftest import rows
from test_buckets import spoil
from test_pipeline import LISTS, _write, card


def _day(rng, cards, members, boards):
    """Changes of one day: cards renamed, moved, with other members or none, new ones; members and boards renamed."""
    for i in rng.sample(sorted(cards), 4):
        cards[i] = {**cards[i], **rng.choice([{"name": f"n{rng.randrange(4)}"}, {"idBoard": f"b{rng.randrange(5)}"}, {"idMembers": []},
                                              {"idMembers": [f"m{rng.randrange(9)}", "m1"]}, {"desc": None}, {"dateLastActivity": "2023-03-01T00:00:00.000Z"}])}
    new = f"c{len(cards)}"
    cards[new] = card(new, "new", "2023-01-05T00:00:00.000Z", members=(f"m{rng.randrange(9)}",), board=f"b{rng.randrange(5)}")
    if rng.random() < 0.7:
        m = f"m{rng.randrange(9)}"
        members[m] = {"id": m, "fullName": rng.choice([None, f"Name {rng.randrange(100)}"]), "username": str(rng.random())}
    if rng.random() < 0.5:
        b = f"b{rng.randrange(5)}"
        boards[b] = {"id": b, "name": f"Board {rng.randrange(100)}", "pos": 1}


@pytest.mark.parametrize("seed,buckets,keep", [(1, 8, False), (3, None, True)])
def test_incremental_refine_equals_a_full_one(spark, tmp_path, seed, buckets, keep):
    rng, step, full = random.Random(seed), str(tmp_path / "step"), str(tmp_path / "full")
    cards = {f"c{k}": card(f"c{k}", f"n{k % 4}", "2023-01-01T00:00:00.000Z", members=tuple({f"m{k % 6}", "m1"}), board=f"b{k % 5}") for k in range(25)}
    members = {f"m{k}": {"id": f"m{k}", "fullName": f"Name {k}", "username": "u"} for k in range(6)}
    boards = {f"b{k}": {"id": f"b{k}", "name": f"Sprint ({k + 1}-Jan-2023)", "pos": k} for k in range(4)}
    for day in range(3):
        land = str(tmp_path / f"day{day}")
        for kind, data in (("cards", cards), ("members", members), ("boards", boards)):
            _write(f"{land}/{kind}", list(data.values()))
        for root in (step, full):
            P.ingest_listing(spark, f"{land}/boards", root, "boards")
            P.ingest_bronze(spark, f"{land}/members", root, "members")
            P.ingest_bronze(spark, f"{land}/cards", root, "cards", buckets=buckets)
        I.refine_changes(spark, step, keep_unmatched=keep, buckets=buckets)
        P.refine_silver(spark, full, all_boards=True, keep_unmatched=keep, buckets=buckets)
        P.build_unique(spark, step)
        P.build_unique(spark, full, incremental=False)
        for name in (P.SILVER_CARDS, P.SILVER_UNIQUE):
            assert rows(read_table(spark, step, name)) == rows(read_table(spark, full, name)), (day, name)
        _day(rng, cards, members, boards)
    # nothing new: no new version; a change of what is kept refines all
    before = latest_version(spark, step, P.SILVER_CARDS)
    assert I.refine_changes(spark, step, keep_unmatched=keep, buckets=buckets) == before
    prune_versions(spark, step, P.BOARDS, keep=1)


def test_only_changed_cards_are_refined(spark, tmp_path):
    root, land = str(tmp_path / "t"), str(tmp_path / "l")
    _write(f"{land}/boards", [{"id": f"b{k}", "name": f"Sprint ({k + 1}-Jan-2023)", "pos": k} for k in range(20)])
    _write(f"{land}/members", [{"id": f"m{k}", "fullName": f"Name {k}"} for k in range(40)])
    _write(f"{land}/cards", [card(f"c{k}", f"n{k}", "2023-01-01T00:00:00.000Z", members=(f"m{k % 40}",), board=f"b{k % 20}") for k in range(200)])
    P.ingest_listing(spark, f"{land}/boards", root, "boards")
    P.ingest_bronze(spark, f"{land}/members", root, "members")
    P.ingest_bronze(spark, f"{land}/cards", root, "cards", buckets=32)
    first = I.refine_changes(spark, root, buckets=32)
    paths = bucket_paths(spark, root, P.SILVER_CARDS, first)

    # one member's new name: exactly their cards, and so exactly their boards' buckets
    later = str(tmp_path / "later")
    _write(later, [{"id": "m7", "fullName": "Renamed"}, {"id": "m8", "fullName": "Name 8", "email": "new@x"}])
    P.ingest_bronze(spark, later, root, "members")
    second = I.refine_changes(spark, root)
    assert rows(read_table(spark, root, P.SILVER_CARDS).where("card_members = 'Renamed'"), "id") == sorted((f"c{k}",) for k in range(7, 200, 40))
    moved = {b for b, p in bucket_paths(spark, root, P.SILVER_CARDS, second).items() if paths[b] != p}
    assert len(moved) == 1  # 7, 47, 87, ... are all on board 7
    names = {r[0] for r in read_table(spark, root, P.SILVER_CHANGES).where(F.col("silver_version") == second).select("name").collect()}
    assert names == {f"n{k}" for k in range(7, 200, 40)}

    # one changed card: the change feed opens the rewritten buckets of bronze alone
    one = str(tmp_path / "one")
    _write(one, [card("c3", "changed", "2023-02-01T00:00:00.000Z", members=("m3",), board="b3")])
    since = latest_version(spark, root, P.BRONZE_CARDS)
    until = P.ingest_bronze(spark, one, root, "cards")
    assert rows(I.changed_keys(spark, root, P.BRONZE_CARDS, since, until)) == [("c3",)]
    old, new = (bucket_paths(spark, root, P.BRONZE_CARDS, v) for v in (since, until))
    kept = [p for b, p in new.items() if old.get(b) == p and p != next(iter(old.values()))]  # whose footer names the columns
    assert kept
    for p in kept:
        spoil(p)
    assert rows(I.changed_keys(spark, root, P.BRONZE_CARDS, since, until)) == [("c3",)]
