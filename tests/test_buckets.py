"""Bucketed tables: what a batch reads and writes, failures, and equality with the whole-table upsert."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from boardlake.operators.upsert import upsert
from boardlake.plans import pipeline as P
from boardlake.sources import tables as tb
from boardlake.sources.tables import (bucket_count, bucket_of, bucket_paths, committed_versions, latest_version, merge_into,
                                      prune_versions, read_table, version_path, write_buckets, write_snapshot)
from conftest import rows
from test_pipeline import BOARDS, LISTS, MEMBERS, _write, card

SCHEMA = "id string, board string, v int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def spoil(path):
    """Make the files of a folder unreadable, so that reading one fails."""
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    assert found
    for f in found:
        with open(f, "wb") as out:
            out.write(b"spoilt")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


@pytest.mark.parametrize("by", [["id"], ["board"]])
def test_batches_give_the_rows_of_upsert(spark, tmp_path, by):
    rng, root = random.Random(3), str(tmp_path)
    want = frame(spark, [])
    for step in range(5):
        ids = rng.sample(range(60), 12 if step else 40)
        batch = frame(spark, [(f"i{k}", rng.choice([None, "a", "b", "c", "d"]), rng.randrange(100)) for k in ids])
        want = spark.createDataFrame(upsert(want, batch, ["id"], keys_not_null=True).collect(), SCHEMA)
        merge_into(spark, root, "t", batch, ["id"], buckets=(by, 7))
        got = read_table(spark, root, "t")
        assert got.columns == want.columns and rows(got) == rows(want)
        held = read_table(spark, root, "t", keep_bucket=True)
        assert held.where(F.col(tb.BUCKET) != bucket_of(by, 7)).count() == 0
    assert bucket_count(spark, root, "t") == 7
    # every older version still shows its own rows, and pruning keeps what the newest ones need
    before = {v: rows(read_table(spark, root, "t", v)) for v in committed_versions(spark, root, "t")}
    prune_versions(spark, root, "t", keep=2)
    for v in committed_versions(spark, root, "t")[-2:]:
        assert rows(read_table(spark, root, "t", v)) == before[v]


def test_a_bucket_left_empty_stays_empty(spark, tmp_path):
    root = str(tmp_path)
    merge_into(spark, root, "t", frame(spark, [("1", "a", 1), ("2", "b", 2)]), ["id"], buckets=(["board"], 50))
    a, b = (spark.range(1).select(bucket_of([F.lit(x)], 50)).first()[0] for x in "ab")
    assert a != b
    merge_into(spark, root, "t", frame(spark, [("1", "b", 3)]), ["id"], buckets=(["board"], 50))
    assert rows(read_table(spark, root, "t")) == [("1", "b", 3), ("2", "b", 2)]
    assert a not in bucket_paths(spark, root, "t", 2)
    merge_into(spark, root, "t", frame(spark, [("1", "a", 4)]), ["id"], buckets=(["board"], 50))
    assert rows(read_table(spark, root, "t")) == [("1", "a", 4), ("2", "b", 2)]


def test_a_small_batch_reads_and_writes_its_buckets_alone(spark, tmp_path):
    """A batch of 0.1 % rewrites at most as many buckets as it has rows; the others' files are never opened."""
    root, n = str(tmp_path), 64
    base = spark.range(10_000).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("board"), F.lit(0).alias("v"))
    merge_into(spark, root, "t", base, ["id"], buckets=(["id"], n))
    batch = base.where("id % 1000 = 7").withColumn("v", F.lit(1))
    want = rows(upsert(base, batch, ["id"], keys_not_null=True))
    touched = {r[0] for r in batch.select(bucket_of(["id"], n)).collect()}
    assert 1 < len(touched) <= 10
    version = merge_into(spark, root, "t", batch, ["id"], buckets=(["id"], n))
    assert {int(p.split("=")[-1]) for p in glob.glob(f"{version_path(root, 't', version)}/__bucket*")} == touched
    assert rows(read_table(spark, root, "t")) == want
    for b, path in bucket_paths(spark, root, "t", version).items():
        if b not in touched:
            spoil(path)
    assert merge_into(spark, root, "t", batch.withColumn("v", F.lit(2)), ["id"], buckets=(["id"], n)) == version + 1
    with pytest.raises(Exception):
        read_table(spark, root, "t").collect()


def test_a_failure_half_way_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    merge_into(spark, root, "t", frame(spark, [(str(k), "a", k) for k in range(40)]), ["id"], buckets=(["id"], 8))
    before = rows(read_table(spark, root, "t"))
    broken = frame(spark, [(str(k), "a", 99) for k in range(40)]).withColumn(
        "v", F.when(F.col("id") == "23", F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        write_buckets(broken, root, "t", ["id"], 8, touched=list(range(8)))
    assert latest_version(spark, root, "t") == 1 and rows(read_table(spark, root, "t")) == before

    # all files written but the version not committed yet: as if nothing had happened
    real, tb._touch = tb._touch, lambda spark, path: (_ for _ in ()).throw(RuntimeError("driver lost"))
    try:
        with pytest.raises(RuntimeError):
            merge_into(spark, root, "t", frame(spark, [("1", "b", -1)]), ["id"], buckets=(["id"], 8))
    finally:
        tb._touch = real
    assert rows(read_table(spark, root, "t")) == before
    merge_into(spark, root, "t", frame(spark, [("1", "b", -2)]), ["id"], buckets=(["id"], 8))
    assert rows(read_table(spark, root, "t")) == sorted([("1", "b", -2), *[r for r in before if r[0] != "1"]], key=repr)


def test_new_columns_other_counts_and_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    merge_into(spark, root, "t", frame(spark, []), ["id"], buckets=(["id"], 4))
    assert read_table(spark, root, "t").count() == 0 and read_table(spark, root, "t").columns == ["id", "board", "v"]
    merge_into(spark, root, "t", frame(spark, [("1", "a", 1), ("2", "a", 2), ("3", "a", 3)]), ["id"], buckets=(["id"], 4))
    assert merge_into(spark, root, "t", frame(spark, []), ["id"], buckets=(["id"], 4)) == 2  # nothing to do
    wide = frame(spark, [("2", "b", 5)]).withColumn("extra", F.lit("e"))
    merge_into(spark, root, "t", wide, ["id"], buckets=(["id"], 4))
    want = [("1", "a", 1, None), ("2", "b", 5, "e"), ("3", "a", 3, None)]
    assert rows(read_table(spark, root, "t")) == want
    merge_into(spark, root, "t", wide, ["id"], buckets=(["id"], 9))  # cut anew
    assert bucket_count(spark, root, "t") == 9 and rows(read_table(spark, root, "t")) == want
    merge_into(spark, root, "t", wide, ["id"])  # whole again
    assert bucket_count(spark, root, "t") is None and rows(read_table(spark, root, "t")) == want
    with pytest.raises(Exception, match="repeats key"):
        merge_into(spark, root, "t", wide.union(wide), ["id"], buckets=(["id"], 9))
    write_snapshot(frame(spark, [("7", "z", 7)]), root, "t")
    assert rows(read_table(spark, root, "t")) == [("7", "z", 7, None)]


def _lake(tmp_path, name):
    lr = str(tmp_path / name)
    _write(f"{lr}/boards", BOARDS + [{"id": f"x{k}", "name": f"Board {k}", "pos": 9 + k} for k in range(12)])
    _write(f"{lr}/lists", LISTS)
    _write(f"{lr}/members", MEMBERS)
    _write(f"{lr}/cards", [card(f"c{k}", f"name {k % 5}", f"2023-01-0{1 + k % 9}T10:00:00.000Z", members=("m1", "m2")[: 1 + k % 2],
                                board="b2" if k % 3 == 0 else f"x{k % 12}") for k in range(60)])
    return lr


def test_refine_reads_the_boards_bucket_alone(spark, tmp_path):
    lr, root, plain = _lake(tmp_path, "l"), str(tmp_path / "t"), str(tmp_path / "p")
    P.run_all(spark, lr, root, buckets=16)
    P.run_all(spark, lr, plain)
    assert bucket_count(spark, root, P.BRONZE_CARDS) == bucket_count(spark, root, P.SILVER_CARDS) == 16
    for name in (P.BRONZE_CARDS, P.SILVER_CARDS, P.SILVER_UNIQUE, P.GOLD_IDLE):
        assert rows(read_table(spark, root, name)) == rows(read_table(spark, plain, name))
    assert read_table(spark, root, P.SILVER_CARDS).count() == 20
    # every other board's files are unreadable, and the run does not notice
    mine = spark.range(1).select(bucket_of([F.lit("b2")], 16)).first()[0]
    # (the first file's footer names the columns)
    others = [p for b, p in list(bucket_paths(spark, root, P.BRONZE_CARDS, 1).items())[1:] if b != mine]
    assert len(others) > 3
    for p in others:
        spoil(p)
    P.refine_silver(spark, root)
    P.refine_silver(spark, root, board="b2")
    assert rows(read_table(spark, root, P.SILVER_CARDS)) == rows(read_table(spark, plain, P.SILVER_CARDS))
    with pytest.raises(Exception):
        P.refine_silver(spark, root, all_boards=True)


def test_a_card_that_changes_its_board(spark, tmp_path):
    lr, root, plain = _lake(tmp_path, "l"), str(tmp_path / "t"), str(tmp_path / "p")
    later = str(tmp_path / "later")
    _write(later, [card("c0", "moved", "2023-02-01T10:00:00.000Z", board="x1"), card("c1", "joined", "2023-02-01T10:00:00.000Z", board="b2"),
                   card("new", "new", "2023-02-01T10:00:00.000Z", board="x5")])
    for where, n in ((root, 16), (plain, None)):
        P.run_all(spark, lr, where, buckets=n)
        P.refine_silver(spark, where, all_boards=True)
        P.ingest_bronze(spark, later, where, "cards")
        P.refine_silver(spark, where, board="x1")
        P.refine_silver(spark, where)
        P.build_unique(spark, where)
    for name in (P.BRONZE_CARDS, P.SILVER_CARDS, P.SILVER_UNIQUE):
        assert rows(read_table(spark, root, name)) == rows(read_table(spark, plain, name))


def test_listings_of_several_days_keep_the_last_record(spark, tmp_path):
    lr, root = _lake(tmp_path, "l"), str(tmp_path / "t")
    for kind, row in (("boards", {"id": "b2", "name": "Sprint (5-JAN-2023)", "pos": 2}), ("lists", {"id": "l2", "idBoard": "b2", "name": "Waiting", "pos": 2})):
        _write(f"{lr}/{kind}", [row, {"id": "l9", "idBoard": "b2", "name": "doing", "pos": 9}] if kind == "lists" else [row])
        newest = sorted(glob.glob(f"{lr}/{kind}/*.json"))[-1]
        os.utime(newest, (2_000_000_000, 2_000_000_000))
    P.run_all(spark, lr, root)
    assert rows(read_table(spark, root, P.BOARDS).where("id = 'b2'"), "id", "name") == [("b2", "Sprint (5-JAN-2023)")]
    assert rows(read_table(spark, root, P.LISTS).where("idBoard = 'b2'"), "id", "name") == [
        ("l1", "backlog"), ("l2", "Waiting"), ("l3", "done"), ("l9", "doing")]
    P.refine_silver(spark, root, all_boards=True)
    P.refine_silver(spark, root, board="b2")
    assert {r[0] for r in read_table(spark, root, P.SILVER_CARDS).where("idBoard = 'b2'").select("board_name").collect()} == {"Sprint (5-JAN-2023)"}
