"""Gold queries: idle cards in a list (G0) and member activity."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.functions.dates import BOUNDS, idle_filter, range_condition, range_filter
from boardlake.functions.text import member_match
from boardlake.schemas import GOLD_A


def idle_cards(cards: DataFrame, lists: str | DataFrame, days: int,
               as_of: _dt.datetime | None = None, columns: Sequence[str] = GOLD_A,
               list_col: str = "idList", date_col: str = "dateLastActivity") -> DataFrame:
    """Cards in the given list whose last activity is strictly older than
    ``as_of - days`` (null activity drops).

    ``lists`` is a list id or a DataFrame with a ``list_id`` column (one row
    per board, from :func:`list_lookup`), applied as a semi join.
    """
    if isinstance(lists, DataFrame):
        ids = lists.select(F.col("list_id").alias("__list_id"))
        cards = cards.join(ids, cards[list_col] == ids["__list_id"], "left_semi")
    else:
        cards = cards.where(F.col(list_col) == F.lit(lists))
    return idle_filter(cards, date_col, days, as_of).select(*columns)


def member_activity(cards: DataFrame, member: str, start=None, end=None,
                    match: str = "contains", bounds: str = "closed_ts",
                    columns: Sequence[str] = GOLD_A, date_format: str = "%Y-%m-%d",
                    tz: str | None = None, members_col: str = "card_members",
                    date_col: str = "dateLastActivity") -> DataFrame:
    """Cards a member worked on, optionally within a date range.

    The member test is a case-sensitive substring match on the joined
    names (``contains`` literal, ``like`` with wildcards).  The range is
    applied only when both ``start`` and ``end`` are given; see
    :func:`range_filter` for the three bound variants.
    """
    out = cards.where(member_match(members_col, member, match))
    out = range_filter(out, date_col, start, end, bounds, date_format, tz)
    return out.select(*columns)


@dataclass(frozen=True)
class MemberSpec:
    """One member report: who, how to match, which range and bounds."""
    report: str
    member: str
    start: object = None
    end: object = None
    match: str = "contains"
    bounds: str = "closed_ts"
    date_format: str = "%Y-%m-%d"
    tz: str | None = None
    #: Column order of the report as a table of its own.
    columns: tuple[str, ...] = tuple(GOLD_A)


def _spec_condition(cards: DataFrame, spec: MemberSpec, members_col: str, date_col: str):
    cond = member_match(members_col, spec.member, spec.match)
    rng = range_condition(cards, date_col, spec.start, spec.end, spec.bounds, spec.date_format, spec.tz)
    return cond if rng is None else cond & rng


def member_activity_many(cards: DataFrame, specs: Sequence[MemberSpec],
                         columns: Sequence[str] = GOLD_A, members_col: str = "card_members",
                         date_col: str = "dateLastActivity") -> DataFrame:
    """All member reports in one scan.

    Each spec is a predicate over the card row; the row is emitted once
    per spec it satisfies, tagged with the spec's ``report`` and ``member``.
    The specs are job parameters (one per configured report), not data,
    so no join or broadcast is involved and the card table is read once
    instead of once per report.
    """
    if not specs:
        raise ValueError("no member specs given")
    for s in specs:
        if s.bounds not in BOUNDS:
            raise ValueError(f"bad bounds {s.bounds!r} in spec {s.report!r}")
    tags = F.array(*[
        F.when(_spec_condition(cards, s, members_col, date_col),
               F.struct(F.lit(s.report).alias("report"), F.lit(s.member).alias("member")))
        for s in specs])
    # explode emits nothing for an empty array, so rows matching no report
    # drop out without a filter that would evaluate every predicate again.
    matched = F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("__t")
    return cards.select(matched, *[F.col(c) for c in columns]).select("__t.report", "__t.member", *columns)
