import datetime as dt

from pyspark.sql import functions as F

from boardlake.operators.boards import current_board, list_lookup
from boardlake.operators.dedupe import latest_per_key, latest_per_key_agg
from boardlake.operators.refine import unique_cards
from conftest import rows


def _cards(spark):
    d = dt.datetime
    return spark.createDataFrame([
        ("1", "A", d(2023, 1, 1)), ("2", "A", d(2023, 1, 5)),      # newest wins
        ("3", "B", d(2023, 1, 5)), ("4", "B", d(2023, 1, 5)),      # tie: higher id
        ("5", "C", None), ("6", "C", d(2022, 1, 1)),               # null date last
        ("7", None, d(2023, 1, 1)), ("8", None, d(2023, 2, 1)),    # null names: one group
    ], "id string, name string, dateLastActivity timestamp")


def test_unique_cards(spark):
    got = [r[0] for r in rows(unique_cards(_cards(spark)), "id")]
    assert got == ["2", "4", "6", "8"]


def test_agg_form_agrees(spark):
    df = _cards(spark)
    a = latest_per_key(df, ["name"], [F.col("dateLastActivity").desc(), F.col("id").desc()])
    b = latest_per_key_agg(df, ["name"], ["dateLastActivity", "id"])
    assert rows(a) == rows(b)


def test_window_group_limit_in_plan(spark):
    plan = unique_cards(_cards(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_current_board(spark):
    boards = spark.createDataFrame([
        ("b1", "Sprint (14-Sept-2022)", 1), ("b2", "Sprint (4-JAN-2023)", 2),
        ("b3", "Sprint (archive)", 3), ("b4", "Sprint (2-Jan-2023)", 4),
        ("b5", "Sprint (4-Jan-2023)", 5)], "id string, name string, pos int")
    assert [r[0] for r in current_board(boards, "latest").collect()] == ["b5"]     # tie -> later listed
    assert [r[0] for r in current_board(boards, "last_listed").collect()] == ["b5"]
    boards2 = boards.where("id != 'b5'")
    assert [r[0] for r in current_board(boards2, "latest").collect()] == ["b2"]
    assert [r[0] for r in current_board(boards2, "last_listed").collect()] == ["b4"]
    none = boards.where("id = 'b3'")
    assert current_board(none).count() == 0


def test_list_lookup(spark):
    lists = spark.createDataFrame([
        ("l1", "B", "backlog", 1), ("l2", "B", "Doing", 2), ("l3", "B", "done", 3),
        ("l4", "C", "todo", 1)], "id string, idBoard string, name string, pos int")
    assert rows(list_lookup(lists, "doing", "name")) == [("B", "l2")]
    assert rows(list_lookup(lists, pick="first")) == [("B", "l1"), ("C", "l4")]


def test_idle_cards_list_id_or_lookup(spark):
    from boardlake.operators.activity import idle_cards
    d = dt.datetime
    cards = spark.createDataFrame([
        ("1", "a", "l2", d(2023, 1, 1), "x", "01-01-2023", "B"),
        ("2", "b", "l2", d(2023, 1, 20), "x", "20-01-2023", "B"),
        ("3", "c", "l1", d(2023, 1, 1), "x", "01-01-2023", "B"),
        ("4", "d", "l2", None, "x", None, "B"),
    ], "id string, name string, idList string, dateLastActivity timestamp, card_members string, "
       "LastUpdated string, board_name string")
    lists = spark.createDataFrame([("l1", "B", "backlog", 1), ("l2", "B", "Doing", 2)],
                                  "id string, idBoard string, name string, pos int")
    by_id = rows(idle_cards(cards, "l2", 7, as_of=d(2023, 1, 15)), "id")
    by_lookup = rows(idle_cards(cards, list_lookup(lists, "doing"), 7, as_of=d(2023, 1, 15)), "id")
    assert by_id == by_lookup == [("1",)]
    assert idle_cards(cards, "l2", 7, as_of=d(2023, 1, 15)).columns == \
        ["id", "name", "card_members", "LastUpdated", "board_name"]


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_rows = st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]),
                           st.one_of(st.none(), st.integers(0, 5))), max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=_rows)
def test_unique_cards_brute_force(spark, data):
    """Newest card per name (null dates last, ties to the greater id) against plain Python."""
    base = dt.datetime(2023, 1, 1)
    cards = [(f"{i:03d}", name, None if day is None else base + dt.timedelta(days=day))
             for i, (name, day) in enumerate(data)]
    best = {}
    for cid, name, ts in cards:
        key = (ts is not None, ts or base, cid)
        if name not in best or key > best[name][0]:
            best[name] = (key, cid)
    expected = sorted(v[1] for v in best.values())
    df = spark.createDataFrame(cards, "id string, name string, dateLastActivity timestamp")
    assert sorted(r[0] for r in unique_cards(df).select("id").collect()) == expected
    agg = latest_per_key_agg(df, ["name"], ["dateLastActivity", "id"])
    assert sorted(r[0] for r in agg.select("id").collect()) == expected


_dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31))
_spellings = [
    lambda d: f"Sprint ({d.day}-{d.strftime('%B')}-{d.year})",            # full month name
    lambda d: f"SPRINT ({d.day}-{d.strftime('%b').upper()}-{d.year})",     # upper-case abbreviation
    lambda d: f"Sprint ({d.day:02d}-{d.strftime('%b')}{d.year})",          # no dash before the year
    lambda d: f"Sprint ({d.day:02d}-{d.strftime('%b')}-{d.year}) (old)",   # first parentheses only
    lambda d: f"S ({d.day}-{d.strftime('%B').lower()}-{d.year})",          # lower-case full name
]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(_dates, min_size=1, max_size=20), which=st.integers(0, len(_spellings) - 1))
def test_board_date_round_trip(spark, days, which):
    from boardlake.functions.dates import board_date
    names = [(_spellings[(which + i) % len(_spellings)](d), d) for i, d in enumerate(days)]
    df = spark.createDataFrame(names, "name string, want date")
    got = df.select("want", board_date("name").alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got)


def test_board_name_join(spark):
    from boardlake.operators.boards import with_board_name
    cards = spark.createDataFrame([("c1", "b1"), ("c2", "b2"), ("c3", None), ("c4", "zz")],
                                  "id string, idBoard string")
    boards = spark.createDataFrame([("b1", "One"), ("b2", "Two")], "id string, name string")
    assert rows(with_board_name(cards, boards=boards)) == [
        ("c1", "b1", "One"), ("c2", "b2", "Two"), ("c3", None, None), ("c4", "zz", None)]


def test_positions_may_be_fractional_large_equal_or_missing(spark, tmp_path):
    from boardlake.operators.boards import current_board, list_lookup
    from boardlake.sources.landing import read_boards, read_lists
    (tmp_path / "lists.json").write_text("\n".join([
        '{"id": "l1", "idBoard": "b", "name": "backlog", "pos": 49152.5}',
        '{"id": "l2", "idBoard": "b", "name": "doing", "pos": 65536}',
        '{"id": "l3", "idBoard": "b", "name": "done", "pos": 140737488355328}',
        '{"id": "l0", "idBoard": "b", "name": "unplaced"}']))
    lists = read_lists(spark, str(tmp_path / "lists.json"))
    assert rows(list_lookup(lists, pick="first")) == [("b", "l1")]
    (tmp_path / "boards.json").write_text("\n".join([
        '{"id": "b1", "name": "S (1-Jan-2023)", "pos": 7.5}', '{"id": "b3", "name": "S (1-Jan-2023)", "pos": 7.5}',
        '{"id": "b2", "name": "S (1-Jan-2023)", "pos": 7.5}', '{"id": "b9", "name": "S (1-Jan-2023)"}']))
    boards = read_boards(spark, str(tmp_path / "boards.json"))
    for pick in ("latest", "last_listed"):
        assert current_board(boards, pick).first()["id"] == "b3"
