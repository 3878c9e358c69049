"""Incremental refine (R3): silver brought up to date from what changed in bronze alone.

Between the bronze and listing versions of the last run and the newest ones a
change feed gives the keys of rows that differ, by fingerprints; in a bucketed
table only the buckets that were rewritten are compared.  A card is refined
again if it changed, if one of its members did (found by inverting the cards'
id arrays for the changed members alone), or if its board's name did.  All
other cards would be refined to the rows that silver has, so the result is
that of refining everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from boardlake.operators.members import card_member_pairs
from boardlake.operators.refine import refine_cards
from boardlake.plans import pipeline as P
from boardlake.sources.scratch import broadcast_if_small, stored
from boardlake.sources.tables import (BUCKET, bucket_count, bucket_paths, committed_versions, latest_version, read_table,
                                      write_snapshot)

STATE = "silver_refine_state"
INPUTS = (P.BRONZE_CARDS, P.BRONZE_MEMBERS, P.BOARDS)


def _rows(spark: SparkSession, root: str, name: str, version: int, buckets: list[int] | None) -> DataFrame:
    rows = read_table(spark, root, name, version, keep_bucket=buckets is not None)
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets)).drop(BUCKET)


def changed_keys(spark: SparkSession, root: str, name: str, since: int, until: int, key: str = "id",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Keys of the rows that differ between two versions of a table with unique keys, came or went.

    ``columns`` are those compared (all of both versions, if not given; one
    that a version lacks counts as null there).
    """
    buckets, n = None, bucket_count(spark, root, name, until)
    if n and n == bucket_count(spark, root, name, since):
        before, after = (bucket_paths(spark, root, name, v) for v in (since, until))
        buckets = sorted(b for b in before.keys() | after.keys() if before.get(b) != after.get(b))
    sides = [_rows(spark, root, name, v, buckets) for v in (since, until)]
    compared = list(columns or dict.fromkeys(c for s in sides for c in s.columns if c != key))
    if since == until:
        return sides[1].select(key).where("false")

    def prints(side: DataFrame, label: str) -> DataFrame:
        # A null hashes to the seed whatever its type, so its place is hashed too.
        # Maps (of extra keys) have no hash; their text has.
        given = [F.lit(None) if c not in side.columns else F.to_json(F.col(f"`{c}`")) if isinstance(side.schema[c].dataType, MapType)
                 else F.col(f"`{c}`") for c in compared]
        nulls = F.concat_ws("", *[F.when(c.isNull(), "0").otherwise("1") for c in given])
        print_ = F.struct(F.xxhash64(*given, nulls), F.xxhash64(nulls, *given, F.lit(1)))
        return side.select(F.col(f"`{key}`").alias(f"{label}_key"), print_.alias(f"{label}_print"))

    old, new = prints(sides[0], "old"), prints(sides[1], "new")
    both = old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")
    return both.where(~F.col("old_print").eqNullSafe(F.col("new_print"))).select(F.coalesce("new_key", "old_key").alias(key))


def affected_cards(cards: DataFrame, changed: DataFrame, members: DataFrame, boards: DataFrame) -> DataFrame:
    """Distinct ids of ``cards`` that changed, hold one of ``members(id)``, or are on one of ``boards(id)``."""
    pairs = card_member_pairs(cards)
    members, boards = (broadcast_if_small(x.select("id"), ["id"]) for x in (members, boards))
    by_member = pairs.join(members.select(F.col("id").alias("__m")), F.col("__member_id") == F.col("__m"), "left_semi")
    by_board = cards.join(boards.select(F.col("id").alias("__b")), F.col("idBoard") == F.col("__b"), "left_semi")
    return changed.select("id").union(by_member.select(F.col("__card_id").alias("id"))).union(by_board.select("id")).distinct()


def _state(spark: SparkSession, root: str, keep_unmatched: bool) -> dict[str, int] | None:
    """Input versions of the last run, if all are still there and it kept the same cards."""
    table = read_table(spark, root, STATE)
    if table is None or read_table(spark, root, P.SILVER_CARDS) is None:
        return None
    row = table.first()
    if row["keep_unmatched"] != keep_unmatched:
        return None
    held = {name: row[name] for name in INPUTS}
    return held if all(v in committed_versions(spark, root, name) for name, v in held.items()) else None


def refine_changes(spark: SparkSession, root: str, keep_unmatched: bool = False, buckets: int | None = None) -> int:
    """Bring silver to what ``refine_silver(all_boards=True)`` would make of it now; returns its version.

    The first run, and one whose predecessor's inputs are pruned, refines all cards.
    """
    since = _state(spark, root, keep_unmatched)
    now = {name: latest_version(spark, root, name) for name in INPUTS}
    if since is None:
        version = P.refine_silver(spark, root, keep_unmatched=keep_unmatched, all_boards=True, buckets=buckets)
    else:
        cards, members, boards = (read_table(spark, root, name, v) for name, v in now.items())
        changed, renamed, relisted = (
            stored(changed_keys(spark, root, name, since[name], now[name], columns=columns), f"changed-{name}")
            for name, columns in zip(INPUTS, (None, ["fullName"], ["name"])))
        ids = stored(affected_cards(cards, changed, renamed, relisted), "affected-cards")
        if ids.isEmpty():
            version = latest_version(spark, root, P.SILVER_CARDS)
        else:
            again = cards.join(ids, "id", "left_semi")
            refined = refine_cards(again, members, boards=boards.select("id", "name"), keep_unmatched=keep_unmatched)
            version = P.merge_refined(spark, root, refined, buckets)
    if since != now:
        write_snapshot(spark.createDataFrame([(*now.values(), keep_unmatched)],
                                             ", ".join(f"{n} int" for n in INPUTS) + ", keep_unmatched boolean"),
                       root, STATE, merge_schema=False)
    return version
