"""The idle-card stream against ``idle_cards`` over the same files."""

import datetime as dt
import os
import random

import pytest

from boardlake.operators.activity import idle_cards
from boardlake.operators.dedupe import latest_per_key
from boardlake.plans.pipeline import newest_first
from boardlake.sources.landing import read_cards
from boardlake.sources.tables import parts, read_parts, write_part
from boardlake.streaming.idle import LOG, RECORD, advance, held_before, idle_now, log_batch, stream_idle
from conftest import rows
from test_pipeline import card

COLUMNS = ["id", "name", "idBoard", "idList", "dateLastActivity"]
DAYS = 7


def land(folder, number, objs, day):
    import json
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"part-{number:04d}.json")
    with open(path, "w") as f:
        f.writelines(json.dumps(o) + "\n" for o in objs)
    at = dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day)
    os.utime(path, (at.timestamp(), at.timestamp()))
    return at.replace(tzinfo=None)


def batch_idle(spark, folder, as_of, lists):
    newest = latest_per_key(read_cards(spark, folder, landed=True).where("id IS NOT NULL"), ["id"], newest_first("cards"))
    out = [idle_cards(newest, x, DAYS, as_of, COLUMNS) for x in lists]
    return rows(out[0].union(out[1]))


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_the_batch_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, root, ckpt = str(tmp_path / "cards"), str(tmp_path / "t"), str(tmp_path / "c")
    day = 0
    for step in range(3):
        for number in range(step * 2, step * 2 + 2):
            day += rng.randrange(1, 6)
            objs = []
            for place in range(12):
                k, back = rng.randrange(10), rng.choice([0, 1, 6, 7, 8, 400])
                when = dt.datetime(2023, 1, 1) + dt.timedelta(days=day - back, hours=rng.choice([0, 0, 5]), milliseconds=place)
                objs.append(card(f"c{k}", f"n{rng.randrange(9)}", None if rng.random() < 0.1 else when.isoformat(timespec="milliseconds") + "Z", lst=rng.choice(["l1", "l2", "l3"])))
            as_of = land(folder, number, objs + [{**card("x", "no id", None), "id": None}], day)
        stream_idle(spark, folder, root, DAYS, checkpoint=ckpt, max_files_per_trigger=1).awaitTermination()
        for lists in (["l1", "l2"], ["l3", "none"]):
            assert rows(idle_now(spark, root, lists), *COLUMNS) == batch_idle(spark, folder, as_of, lists), (step, lists)
    # a batch that is run again replaces its own part
    key = parts(spark, root, LOG)[-1]
    again = spark.createDataFrame(read_parts(spark, root, LOG, [key]).collect(), read_parts(spark, root, LOG).schema)
    before = rows(idle_now(spark, root))
    write_part(again, root, LOG, key)
    assert rows(idle_now(spark, root)) == before
    # and nothing new lands nothing new
    stream_idle(spark, folder, root, DAYS, checkpoint=ckpt).awaitTermination()
    assert rows(idle_now(spark, root)) == before


def record_batch(spark, *records):
    at = dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc)
    data = [(i, name, "b", "l1", None if active is None else at + dt.timedelta(days=active), at + dt.timedelta(days=landed), "f")
            for i, name, active, landed in records]
    return spark.createDataFrame(data, RECORD)


def test_changes_of_cards_by_batches_and_a_batch_that_runs_again(spark, tmp_path):
    root = str(tmp_path / "t")
    batches = [record_batch(spark, ("a", "old", 0, 1), ("b", "undated", None, 1), ("a", "older", -1, 1)),
               record_batch(spark, ("c", "new", 9, 9)),                         # the clock passes a's time
               record_batch(spark, ("a", "again", 8, 8)),                       # landed before the clock
               record_batch(spark, ("a", "late", 8.5, 20), ("c", "new", 9, 9)),  # woke before c's time passes, too late itself
               record_batch(spark, ("a", "older", -1, 1))]                      # changes nothing

    def logged():
        return rows(read_parts(spark, root, LOG), "id", "changes", "idle", "name")

    want = [("a", 1, True, "old"), ("a", 2, False, "again"), ("a", 3, True, "late"), ("c", 1, True, "new")]
    for n, batch in enumerate(batches):
        for _ in range(2):
            log_batch(spark, batch, root, DAYS, n)
    assert logged() == want
    log_batch(spark, batches[2], root, DAYS, 2)   # from an older checkpoint
    log_batch(spark, batches[3], root, DAYS, 3)
    assert logged() == want
    assert rows(idle_now(spark, root), "id", "name") == [("a", "late"), ("c", "new")]


def test_a_record_that_landed_before_the_clock_counts(spark, tmp_path):
    folder, root, ckpt = str(tmp_path / "cards"), str(tmp_path / "t"), str(tmp_path / "c")
    for number, (name, active, day) in enumerate([("k1", 1, 30), ("k2", 2, 25)]):  # k2's file shows up with an earlier time
        land(folder, number, [card(name, name, f"2023-01-{active:02d}T00:00:00.000Z")], day)
        stream_idle(spark, folder, root, DAYS, checkpoint=ckpt).awaitTermination()
    assert rows(idle_now(spark, root), "id") == [("k1",), ("k2",)]
    assert "Python" not in "".join(advance(held_before(spark, root, "z"), record_batch(spark), DAYS, 1)._jdf.queryExecution().executedPlan().toString())
