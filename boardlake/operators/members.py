"""Member names per card.

The reference joins cards to members with ``array_contains(idMembers, id)``,
a theta join Spark can only run as a nested loop or cartesian product.
Here the id array is exploded (after ``array_distinct``, so a repeated id
matches once, as under ``array_contains``) and joined on equality, which
runs as a hash or sort-merge join.  Names are collected per card in a
deterministic order (by name, then member id) and joined with ``", "``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.schemas import MEMBER_NAME_SEPARATOR
from boardlake.sources.scratch import broadcast_if_small

_CID = "__card_id"
_MID = "__member_id"
_MNAME = "__member_name"


def card_member_pairs(cards: DataFrame, id_col: str = "id",
                      members_col: str = "idMembers") -> DataFrame:
    """``(card id, member id)`` pairs from the cards' id arrays, one per distinct id."""
    return cards.select(F.col(id_col).alias(_CID),
                        F.explode(F.array_distinct(F.col(members_col))).alias(_MID))


def names_per_card(pairs: DataFrame, members: DataFrame, member_id: str = "id",
                   member_name: str = "fullName", pair_card: str = _CID,
                   pair_member: str = _MID) -> DataFrame:
    """``(card id, card_members)`` for every card with at least one known member.

    ``pairs`` may repeat a (card, member) pair; it counts once.  Members
    whose name is null are matched but contribute no name.  The members
    are measured first and broadcast when they are small: AQE would learn that
    only after the pairs, many times as many, are shuffled too.  Otherwise the
    join shuffles on member id, and AQE splits a skewed (very popular) member.  ``collect_set`` deduplicates map-side, so a card's group is
    bounded by its number of distinct members.
    """
    m = members.select(F.col(member_id).alias(_MID), F.col(member_name).alias(_MNAME))
    # A null card id can never attach to a card; dropping it here also keeps
    # all such pairs from forming one hot group.
    p = (pairs.select(F.col(pair_card).alias(_CID), F.col(pair_member).alias(_MID))
         .where(F.col(_CID).isNotNull()))
    matched = p.join(broadcast_if_small(m, [_MID, _MNAME]), on=_MID, how="inner")
    entries = F.array_sort(F.collect_set(F.struct(F.col(_MNAME).alias("n"), F.col(_MID).alias("m"))))
    names = F.array_join(F.transform(entries, lambda e: e["n"]), MEMBER_NAME_SEPARATOR)
    return matched.groupBy(_CID).agg(names.alias("card_members"))


def attach_member_names(cards: DataFrame, names: DataFrame, id_col: str = "id",
                        keep_unmatched: bool = False) -> DataFrame:
    """Join ``card_members`` onto the card rows.

    ``keep_unmatched=False`` is the reference behaviour: its ``LEFT OUTER``
    join has no ON clause and a WHERE on the member side, so it acts as an
    inner join and cards without a known member are dropped.  ``True``
    keeps them with ``card_members = ''``.
    """
    joined = cards.join(names, cards[id_col] == names[_CID], "left" if keep_unmatched else "inner")
    joined = joined.drop(_CID)
    if keep_unmatched:
        joined = joined.withColumn("card_members", F.coalesce(F.col("card_members"), F.lit("")))
    return joined


def member_names(cards: DataFrame, members: DataFrame, keep_unmatched: bool = False,
                 id_col: str = "id", members_col: str = "idMembers",
                 member_id: str = "id", member_name: str = "fullName") -> DataFrame:
    """Cards with a ``card_members`` column resolved from their ``idMembers`` array."""
    pairs = card_member_pairs(cards, id_col, members_col)
    names = names_per_card(pairs, members, member_id, member_name)
    return attach_member_names(cards, names, id_col, keep_unmatched)


def member_names_from_pairs(cards: DataFrame, pairs: DataFrame, members: DataFrame,
                            pair_card: str, pair_member: str, keep_unmatched: bool = False,
                            id_col: str = "id", member_id: str = "id",
                            member_name: str = "fullName") -> DataFrame:
    """As :func:`member_names` when membership is a separate (card, member) table."""
    names = names_per_card(pairs, members, member_id, member_name, pair_card, pair_member)
    return attach_member_names(cards, names, id_col, keep_unmatched)
