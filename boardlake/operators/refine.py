"""Bronze -> silver refinement (F1, J1/A1, X1, X2) and the unique-card table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.functions.dates import last_updated
from boardlake.operators.boards import with_board_name
from boardlake.operators.dedupe import latest_per_key
from boardlake.operators.members import member_names, member_names_from_pairs


def board_filter(cards: DataFrame, board: str | DataFrame, board_col: str = "idBoard") -> DataFrame:
    """Cards of a board.  ``board`` is an id, or a DataFrame of board ids in
    an ``id`` column (e.g. the one-row :func:`current_board`), applied as a
    semi join so no value travels through the driver."""
    if isinstance(board, DataFrame):
        b = board.select(F.col("id").alias("__board_id"))
        return cards.join(b, cards[board_col] == b["__board_id"], "left_semi")
    return cards.where(F.col(board_col) == F.lit(board))


def refine_cards(cards: DataFrame, members: DataFrame, board: str | DataFrame | None = None,
                 board_name: str | None = None, boards: DataFrame | None = None,
                 keep_unmatched: bool = False, pairs: DataFrame | None = None,
                 pair_card: str = "card_id", pair_member: str = "member_id") -> DataFrame:
    """Silver rows: the card columns, then ``card_members``, ``LastUpdated``, ``board_name``.

    ``board`` restricts to one board; ``board_name`` is a constant name, or
    ``boards`` supplies names by id (for refining many boards at once).
    Membership comes from the cards' ``idMembers`` arrays, or from a
    separate ``pairs`` table of (card id, member id).
    """
    named_here = isinstance(board, DataFrame) and board_name is None and boards is None
    if named_here:
        # One join both keeps the board's cards and names them (the board
        # DataFrame, e.g. the one-row current board, is computed once).
        b = board.select(F.col("id").alias("__board_id"), F.col("name").alias("board_name"))
        cards = cards.join(b, cards["idBoard"] == b["__board_id"], "inner").drop("__board_id")
    elif board is not None:
        cards = board_filter(cards, board)
    if pairs is None:
        out = member_names(cards, members, keep_unmatched=keep_unmatched)
    else:
        out = member_names_from_pairs(cards, pairs, members, pair_card, pair_member,
                                      keep_unmatched=keep_unmatched)
    out = out.withColumn("LastUpdated", last_updated("dateLastActivity"))
    if named_here:
        return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "board_name"], "board_name")
    return with_board_name(out, boards=boards, board_name=board_name)


def unique_cards(silver: DataFrame, key: str = "name", date_col: str = "dateLastActivity",
                 tie_col: str = "id") -> DataFrame:
    """Newest card per name (nulls last); ties broken by the greater ``id``."""
    return latest_per_key(silver, [key], [F.col(date_col).desc_nulls_last(),
                                          F.col(tie_col).desc_nulls_last()])
