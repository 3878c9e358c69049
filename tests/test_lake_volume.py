"""What the lake's steps deal out and write: each row no more often than its result needs, with the same rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boardlake.operators.dedupe import latest_per_key
from boardlake.operators.members import member_names
from boardlake.operators import members as members_module
from boardlake.plans import pipeline as P
from boardlake.plans.incremental import affected_cards
from boardlake.sources import scratch, tables
from boardlake.sources.tables import merge_into, read_table
from conftest import rows


def batch(spark, n=400, every=50):
    """``n`` keys on five boards, one in ``every`` twice, the later row newer."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("b"), F.pmod("id", F.lit(5))).alias("idBoard"),
        F.explode(F.when(F.col("id") % every == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("at"),
        F.expr("idBoard || '-' || at").alias("text"))


@pytest.mark.parametrize("limit", [scratch.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("buckets", [None, (["idBoard"], 4)])
def test_first_version_of_a_stored_batch(spark, tmp_path, monkeypatch, limit, buckets):
    monkeypatch.setattr(tables, "broadcast_if_small", lambda df, texts: scratch.broadcast_if_small(df, texts, limit))
    source = scratch.stored(batch(spark), "test-batch")
    want = rows(latest_per_key(source, ["id"], [F.col("at").desc()]).drop("at"), "id", "idBoard", "text")
    for n, is_stored in enumerate((True, False)):
        root = str(tmp_path / f"t{n}")
        merge_into(spark, root, "t", source, ["id"], order_by=[F.col("at").desc()], drop=("at",), buckets=buckets, is_stored=is_stored)
        assert rows(read_table(spark, root, "t"), "id", "idBoard", "text") == want and len(want) == 400
        merge_into(spark, root, "t", source.limit(0), ["id"], order_by=[F.col("at").desc()], drop=("at",), buckets=buckets, is_stored=is_stored)
        assert rows(read_table(spark, root, "t"), "id", "idBoard", "text") == want


def test_a_null_key_fails_the_first_version_too(spark, tmp_path):
    source = scratch.stored(batch(spark, 5).withColumn("id", F.when(F.col("id") != "3", F.col("id"))), "test-batch")
    with pytest.raises(Exception, match="null in a key"):
        merge_into(spark, str(tmp_path / "t"), "t", source, ["id"], order_by=["at"], is_stored=True)


def test_a_first_version_deals_out_repeated_keys_alone(spark, tmp_path, monkeypatch):
    plans = []
    write = tables.write_buckets

    def seen(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, *args, **options)

    monkeypatch.setattr(tables, "write_buckets", seen)
    root, source = str(tmp_path / "t"), scratch.stored(batch(spark), "test-batch")
    merge_into(spark, root, "t", source, ["id"], order_by=[F.col("at").desc()], drop=("at",), buckets=(["idBoard"], 4), is_stored=True)
    # rows of a key that is there once pass by the window: an anti join with the few repeated keys
    assert "LeftAnti" in plans[0] and "Join FullOuter" not in plans[0]


def test_members_are_measured_and_broadcast_before_the_pairs_are_shuffled(spark):
    cards = spark.createDataFrame([("c1", ["m1", "m2", "m1"]), ("c2", ["m3"]), ("c3", None)], "id string, idMembers array<string>")
    members = spark.createDataFrame([("m1", "Ann"), ("m2", "Bo")], "id string, fullName string")
    got = member_names(cards, members)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "id", "card_members") == [("c1", "Ann, Bo")]
    marked = cards.withColumns({"idBoard": F.lit("b"), "name": F.lit("n")})
    ids = affected_cards(marked, marked.select("id").where("false"), members.select("id"), marked.select("id").where("false"))
    assert "BroadcastHashJoin" in ids._jdf.queryExecution().executedPlan().toString() and rows(ids) == [("c1",)]


def test_members_above_the_limit_are_joined_the_same(spark, monkeypatch):
    cards = spark.createDataFrame([("c1", ["m1", "m2", "m1"]), ("c2", ["m3"])], "id string, idMembers array<string>")
    members = spark.createDataFrame([("m1", "Ann"), ("m2", None), (None, "x")], "id string, fullName string")
    small = rows(member_names(cards, members), "id", "card_members")
    monkeypatch.setattr(members_module, "broadcast_if_small", lambda df, texts: scratch.broadcast_if_small(df, texts, 0))
    large = member_names(cards, members)
    assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    assert rows(large, "id", "card_members") == small == [("c1", "Ann")]


def test_refine_writes_no_uncompressed_checkpoint(spark, tmp_path):
    import glob
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    root, when = str(tmp_path / "t"), dt.datetime(2023, 1, 1)
    before = glob.glob(f"{folder}/**/rdd-*", recursive=True)
    tables.write_snapshot(spark.createDataFrame([("b", "Sprint (1-Jan-2023)", 1.0)], "id string, name string, pos double"), root, P.BOARDS)
    tables.write_snapshot(spark.createDataFrame([("m", "Ann")], "id string, fullName string"), root, P.BRONZE_MEMBERS)
    for name in ("old", "new"):
        tables.write_snapshot(spark.createDataFrame([("c", name, "b", "l", when, ["m"])], "id string, name string, idBoard string, idList string, "
                              "dateLastActivity timestamp, idMembers array<string>"), root, P.BRONZE_CARDS)
        P.refine_silver(spark, root, all_boards=True, buckets=4)
        names = rows(read_table(spark, root, P.SILVER_CHANGES), "name", "silver_version")
    assert names == [("new", 2), ("old", 1), ("old", 2)]
    assert rows(read_table(spark, root, P.SILVER_CARDS), "id", "name", "card_members") == [("c", "new", "Ann")]
    assert glob.glob(f"{folder}/**/rdd-*", recursive=True) == before
