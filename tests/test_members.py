
from boardlake.operators.members import member_names
from conftest import rows

CARDS = "id string, name string, idMembers array<string>"
MEMBERS = "id string, fullName string"


def _data(spark):
    cards = spark.createDataFrame([
        ("c1", "two known", ["m2", "m1"]),
        ("c2", "empty", []),
        ("c3", "null", None),
        ("c4", "unknown only", ["zz"]),
        ("c5", "same id twice", ["m1", "m1"]),
        ("c6", "null-name member", ["m3"]),
        ("c7", "known and unknown", ["m2", "zz"]),
    ], CARDS)
    members = spark.createDataFrame([("m1", "Bo Li"), ("m2", "Ann Lee"), ("m3", None)], MEMBERS)
    return cards, members


def test_reference_semantics(spark):
    cards, members = _data(spark)
    got = rows(member_names(cards, members), "id", "card_members")
    assert got == [("c1", "Ann Lee, Bo Li"), ("c5", "Bo Li"), ("c6", ""), ("c7", "Ann Lee")]


def test_keep_unmatched(spark):
    cards, members = _data(spark)
    got = dict(rows(member_names(cards, members, keep_unmatched=True), "id", "card_members"))
    assert got == {"c1": "Ann Lee, Bo Li", "c2": "", "c3": "", "c4": "", "c5": "Bo Li", "c6": "",
                   "c7": "Ann Lee"}


def expected_names(cards, members):
    """Names by card in plain Python: known ids of the array, each once, by name."""
    known = dict(members)
    out = []
    for card, _, ids in cards:
        found = [known[m] for m in set(ids or []) if m in known]
        if found:
            out.append((card, ", ".join(sorted(n for n in found if n is not None))))
    return sorted(out)


def test_plan_has_no_nested_loop(spark):
    cards, members = _data(spark)
    plan = member_names(cards, members)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_ids = st.sampled_from(["m0", "m1", "m2", "m3", "zz"])
_cards = st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.lists(_ids, max_size=5))),
                  max_size=12, unique_by=lambda c: c[0])
_names = st.lists(st.one_of(st.none(), st.sampled_from(["Ann", "Bo", "Ann", "Cy"])), min_size=4, max_size=4)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cards=_cards, names=_names)
def test_property_equals_membership_by_sets(spark, cards, names):
    card_rows = [(f"c{i}", f"n{i}", ids) for i, ids in cards]
    member_rows = [(f"m{i}", n) for i, n in enumerate(names)]
    got = member_names(spark.createDataFrame(card_rows, CARDS), spark.createDataFrame(member_rows, MEMBERS))
    assert rows(got, "id", "card_members") == expected_names(card_rows, member_rows)
