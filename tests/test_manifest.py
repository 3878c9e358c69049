"""Incremental batch ingest of a folder that grows."""

import os

from boardlake.plans import pipeline as P
from boardlake.sources.tables import read_parts, read_table
from conftest import rows
from test_pipeline import CARDS, _write, card


def stamp(path, seconds):
    os.utime(path, (1_700_000_000 + seconds, 1_700_000_000 + seconds))


def test_a_second_run_reads_new_files_alone(spark, tmp_path):
    land, root, whole = str(tmp_path / "l"), str(tmp_path / "t"), str(tmp_path / "w")
    _write(land, CARDS[:3])
    stamp(f"{land}/part-0000.json", 0)
    metrics = {}
    assert P.ingest_new(spark, land, root, metrics=metrics) == 1 and metrics["rows"] == 3
    assert P.ingest_new(spark, land, root) == 1  # nothing new, no version

    _write(land, [card("c1", "later", "2023-02-01T00:00:00.000Z"), *CARDS[3:]])
    stamp(f"{land}/part-0001.json", 10)
    assert P.ingest_new(spark, land, root, metrics=metrics) == 2 and metrics["rows"] == 4  # the old file's three rows are not parsed again
    P.ingest_bronze(spark, land, whole)
    assert rows(read_table(spark, root, P.BRONZE_CARDS)) == rows(read_table(spark, whole, P.BRONZE_CARDS))

    # delivered again unchanged: counts once; changed: it is new
    with open(f"{land}/part-0000.json") as f:
        text = f.read()
    with open(f"{land}/part-0000.json", "w") as f:
        f.write(text)
    stamp(f"{land}/part-0000.json", 0)
    assert P.ingest_new(spark, land, root) == 2
    with open(f"{land}/part-0000.json", "w") as f:
        f.write(text.replace("write docs", "write more"))
    stamp(f"{land}/part-0000.json", 20)
    assert P.ingest_new(spark, land, root, metrics=metrics) == 3 and metrics["rows"] == 3
    assert ("write more",) in rows(read_table(spark, root, P.BRONZE_CARDS), "name")
    assert read_parts(spark, root, "consumed_cards").count() == 3


def test_a_run_that_dies_before_its_manifest_takes_the_files_again(spark, tmp_path, monkeypatch):
    land, root = str(tmp_path / "l"), str(tmp_path / "t")
    _write(land, CARDS)
    real = P.consumed
    monkeypatch.setattr(P, "consumed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        P.ingest_new(spark, land, root)
    except RuntimeError:
        pass
    before = rows(read_table(spark, root, P.BRONZE_CARDS))
    monkeypatch.setattr(P, "consumed", real)
    assert P.ingest_new(spark, land, root) == 2 and rows(read_table(spark, root, P.BRONZE_CARDS)) == before
    assert P.ingest_new(spark, land, root) == 2


def test_members_have_a_manifest_of_their_own(spark, tmp_path):
    land, root = str(tmp_path / "m"), str(tmp_path / "t")
    _write(land, [{"id": "m1", "fullName": "Ann"}])
    assert P.ingest_new(spark, land, root, "members") == 1
    assert P.ingest_new(spark, land, root, "members") == 1 and P.ingest_new(spark, land, root, "cards") is not None
