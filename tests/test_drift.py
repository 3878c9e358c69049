"""Unknown keys of landing records: kept, reported, promoted."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.plans import incremental as I
from boardlake.plans import pipeline as P
from boardlake.schemas import CARDS_JSON
from boardlake.sources.drift import EXTRAS, drift_report, promote
from boardlake.sources.landing import read_cards, read_json
from boardlake.sources.tables import read_table
from conftest import rows
from test_pipeline import CARDS, MEMBERS, _write, card


def plain(c, **extra):
    out = {**c, **extra}
    out.pop("unknownKey", None)
    return out


LANDED = [plain(CARDS[0], priority=3, cover={"color": "red", "size": 2}), plain(CARDS[1], priority="high", labels=["a", "b"]),
          plain(CARDS[2], priority=None), plain(CARDS[3]), plain(CARDS[4], priority=2.5)]


def test_typed_columns_are_those_of_the_plain_reader(spark, tmp_path):
    land = str(tmp_path / "l")
    _write(land, [*LANDED, CARDS[5]])
    with open(os.path.join(land, "part-9999.json"), "w") as f:
        f.write('{"id": "c9", oops\n\n[1]\n"text"\n')
    for kwargs in ({}, {"keep_corrupt": True, "landed": False}, {"keep_corrupt": True, "landed": True, "failures": True}):
        with_extras = read_cards(spark, land, extras=True, **kwargs)
        without = read_cards(spark, land, **kwargs)
        compared = [c for c in without.columns if not c.startswith("__landed_") and c != "_corrupt_record"]
        assert rows(with_extras.where("id IS NOT NULL"), *compared) == rows(without.where("id IS NOT NULL"), *compared)
    found = read_cards(spark, land, extras=True, keep_corrupt=True)
    assert '{"id": "c9", oops' in {r[0] for r in found.select("_corrupt_record").collect()}
    keys = {r["id"]: r["k"] for r in found.select("id", F.array_sort(F.map_keys(EXTRAS)).alias("k")).collect() if r["id"]}
    assert keys == {"c1": ["cover", "priority"], "c2": ["labels", "priority"], "c3": ["priority"], "c4": None, "c5": ["priority"], "c6": ["unknownKey"]}


def test_a_new_key_is_promoted_without_the_landing(spark, tmp_path):
    land, root = str(tmp_path / "l"), str(tmp_path / "t")
    _write(f"{land}/1", [plain(c) for c in CARDS])
    P.ingest_bronze(spark, f"{land}/1", root, buckets=4)                  # before anyone knew of extras
    assert EXTRAS not in read_table(spark, root, P.BRONZE_CARDS).columns
    _write(f"{land}/2", LANDED)
    P.ingest_bronze(spark, f"{land}/2", root, extras=True)
    bronze = read_table(spark, root, P.BRONZE_CARDS)
    report = {r["key"]: (r["n"], r["type"]) for r in drift_report(bronze).collect()}
    assert report["cover"] == (1, "OBJECT<color: STRING, size: BIGINT>") and report["priority"][0] == 4 and report["labels"] == (1, "ARRAY<STRING>")

    # what reading the landing again under a longer schema would give
    longer = T.StructType([*CARDS_JSON.fields, *T._parse_datatype_string("priority string, cover struct<color:string,size:int>").fields])
    again = read_json(spark, f"{land}/2", longer)
    want = rows(again.select("id", "priority", "cover.size"))
    got = promote(promote(bronze, "priority", "string"), "cover", "int", "$.size", "size").where("id <> 'c6'")
    assert rows(got, "id", "priority", "size") == want
    assert rows(promote(bronze, "priority", "int").where("id = 'c2'"), "priority") == [(None,)]
    assert rows(promote(bronze, "absent", "int"), "absent") == [(None,)] * 6
    for f in os.listdir(f"{land}/2"):
        os.remove(os.path.join(land, "2", f))
    assert rows(got, "id", "priority", "size") == want

    # a later batch replaces a card's extras; one without them leaves none behind
    _write(f"{land}/3", [plain(CARDS[0], priority=9)])
    P.ingest_bronze(spark, f"{land}/3", root, extras=True)
    assert rows(promote(read_table(spark, root, P.BRONZE_CARDS), "priority", "int").where("id = 'c1'"), "priority") == [(9,)]


def test_one_object_a_file_and_members(spark, tmp_path):
    land, root = str(tmp_path / "l"), str(tmp_path / "t")
    os.makedirs(f"{land}/cards")
    for k, c in enumerate(LANDED):
        with open(f"{land}/cards/{k}.json", "w") as f:
            json.dump(c, f, indent=2)
    P.ingest_bronze(spark, f"{land}/cards", root, multi_line=True, extras=True)
    assert rows(read_table(spark, root, P.BRONZE_CARDS), "id") == [("c1",), ("c2",), ("c3",), ("c4",), ("c5",)]
    _write(f"{land}/members", [{**MEMBERS[0], "avatar": {"hash": "x"}}, MEMBERS[1]])
    P.ingest_bronze(spark, f"{land}/members", root, "members", extras=True)
    members = promote(read_table(spark, root, P.BRONZE_MEMBERS), "avatar", "string", "$.hash", "hash")
    assert rows(members, "id", "hash") == [("m1", "x"), ("m2", None)]


def test_the_change_feed_sees_changed_extras(spark, tmp_path):
    land, root = str(tmp_path / "l"), str(tmp_path / "t")
    for day, c in enumerate((LANDED[:2], [LANDED[0], {**LANDED[1], "priority": "low"}])):
        _write(f"{land}/{day}", c)
        P.ingest_bronze(spark, f"{land}/{day}", root, extras=True)
    assert rows(I.changed_keys(spark, root, P.BRONZE_CARDS, 1, 2)) == [("c2",)]
    assert card("x", "y", None)["unknownKey"] == 1
