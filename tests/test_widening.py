"""Type widening of overwritten tables, and the quarantine of unreadable dates."""

import decimal
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.plans import pipeline as P
from boardlake.sources.tables import read_table, write_snapshot
from boardlake.sources.widening import WideningError, common_type
from boardlake.streaming.ingest import compact_changes, stream_cards
from conftest import rows
from test_pipeline import _write, card


def kind(ddl):
    return T._parse_datatype_string(ddl)


@pytest.mark.parametrize("old, new, want", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"),
    ("float", "double", "double"), ("smallint", "float", "double"), ("int", "decimal(5,2)", "decimal(12,2)"),
    ("bigint", "decimal(3,1)", "decimal(21,1)"), ("decimal(10,0)", "decimal(8,4)", "decimal(14,4)"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("void", "string", "string"), ("string", "void", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
    ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:string>", "struct<c:date,a:bigint>", "struct<a:bigint,b:string,c:date>"),
    ("array<struct<a:int>>", "array<struct<a:decimal(12,3),z:int>>", "array<struct<a:decimal(13,3),z:int>>")])
def test_common_types(spark, old, new, want):
    assert common_type(kind(old), kind(new)).simpleString() == kind(want).simpleString()


@pytest.mark.parametrize("old, new", [
    ("int", "string"), ("string", "int"), ("bigint", "double"), ("double", "bigint"), ("decimal(38,0)", "decimal(5,2)"), ("timestamp", "date"),
    ("boolean", "int"), ("double", "decimal(10,2)"), ("struct<a:int>", "int"), ("struct<a:struct<b:int>>", "struct<a:struct<b:string>>")])
def test_types_without_a_common_one_are_an_error(spark, old, new):
    with pytest.raises(WideningError):
        common_type(kind(old), kind(new), "c")


PLAIN = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(9,2)", "decimal(20,5)", "date", "timestamp_ntz", "string", "boolean"]


@settings(max_examples=80, deadline=None)
@given(st.sampled_from(PLAIN), st.sampled_from(PLAIN))
def test_the_common_type_does_not_depend_on_the_order(a, b):
    def found(x, y):
        try:
            return common_type(kind(x), kind(y)).simpleString()
        except WideningError:
            return None

    assert found(a, b) == found(b, a) and found(a, a) == a
    if found(a, b):
        assert found(found(a, b), a) == found(a, b)


def test_overwrites_widen_or_fail(spark, tmp_path):
    root = str(tmp_path)
    old = spark.createDataFrame([(1, 2, ("x", 3), [("k", 1)])], "id int, n long, s struct<a:string,b:int>, l array<struct<a:string,b:int>>")
    write_snapshot(old, root, "t")
    new = spark.createDataFrame([(2 ** 40, 7, (2 ** 41, None), [(5, True)]), (None, None, None, None)],
                                "id long, n int, s struct<b:long,c:date>, l array<struct<b:long,c:boolean>>")
    write_snapshot(new, root, "t")
    got = read_table(spark, root, "t")
    assert got.schema.simpleString() == ("struct<id:bigint,n:bigint,s:struct<a:string,b:bigint,c:date>,"
                                         "l:array<struct<a:string,b:bigint,c:boolean>>>")
    assert rows(got) == sorted([(2 ** 40, 7, (None, 2 ** 41, None), [(None, 5, True)]), (None, None, None, None)], key=repr)
    with pytest.raises(WideningError, match="s.a: string in the table and int in the new data"):
        write_snapshot(spark.createDataFrame([((1,),)], "s struct<a:int>"), root, "t")
    assert rows(read_table(spark, root, "t")) == rows(got)  # nothing was written
    write_snapshot(spark.createDataFrame([(decimal.Decimal("1.5"),)], "n decimal(4,1)"), root, "t")
    assert read_table(spark, root, "t").schema["n"].dataType == T.DecimalType(21, 1)


def test_unreadable_dates_are_kept_with_their_text(spark, tmp_path):
    land, root, streamed = str(tmp_path / "l"), str(tmp_path / "t"), str(tmp_path / "s")
    cards = [card("c1", "a", "2023-01-02T10:00:00.000Z", extra={"due": "soon"}), card("c2", "b", "yesterday", extra={"due": ""}),
             card("c3", "c", None), card("c4", "d", "2023-01-02T10:00:00.000Z", extra={"due": "2023-01-09T00:00:00.000Z"}),
             {**card("x", "no id", "never"), "id": None}]
    _write(land, cards)
    with open(os.path.join(land, "part-9999.json"), "w") as f:
        f.write('{"id": "c9", oops\n')
    metrics = {}
    P.ingest_bronze(spark, land, root, "cards", metrics=metrics)
    want = sorted([("c1", "due", "soon"), ("c2", "dateLastActivity", "yesterday"), ("c2", "due", "")])
    assert rows(P.read_cast_failures(spark, root)) == want
    assert metrics == {"rows": 6, "rejected": 2, "cast_failures": 4}  # that of the rejected row too
    table = read_table(spark, root, P.BRONZE_CARDS)
    assert len(table.columns) == 12 and rows(table, "id") == [("c1",), ("c2",), ("c3",), ("c4",)]
    assert rows(P.read_rejects(spark, root, "cards"), "_corrupt_record", "name") == sorted([('{"id": "c9", oops', None), (None, "no id")], key=repr)

    # a second run adds its own part, and the stream keeps the same
    later = str(tmp_path / "later")
    _write(later, [card("c1", "a", "2023-01-03T10:00:00.000Z", extra={"due": "later"})])
    P.ingest_bronze(spark, later, root, "cards")
    assert rows(P.read_cast_failures(spark, root)) == sorted([*want, ("c1", "due", "later")])
    stream_cards(spark, land, streamed, checkpoint=str(tmp_path / "c")).awaitTermination()
    compact_changes(spark, streamed)
    assert rows(P.read_cast_failures(spark, streamed)) == want
    assert rows(read_table(spark, streamed, P.BRONZE_CARDS)) == rows(table)


def test_members_have_no_dates_to_fail(spark, tmp_path):
    metrics = {}
    _write(str(tmp_path / "m"), [{"id": "m1", "fullName": "Ann"}])
    P.ingest_bronze(spark, str(tmp_path / "m"), str(tmp_path / "t"), "members", metrics=metrics)
    assert metrics == {"rows": 1, "rejected": 0, "cast_failures": 0} and P.read_cast_failures(spark, str(tmp_path / "t"), "members") is None
    assert read_table(spark, str(tmp_path / "t"), P.BRONZE_MEMBERS).where(F.col("id") == "m1").count() == 1
