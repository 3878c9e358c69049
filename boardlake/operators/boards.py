"""Board and list resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.functions.dates import board_date

PICK_BOARD = ("latest", "last_listed")
PICK_LIST = ("name", "first")


def dated_boards(boards: DataFrame, name_col: str = "name") -> DataFrame:
    """Boards whose name carries a sprint date, with that date as ``board_date``.

    A filter on the parsed date would be pushed below the projection with
    the parse inlined, so every name would be parsed twice; generating from
    ``array_compact(array(date))`` parses once and emits no row for null.
    """
    parsed = F.explode(F.array_compact(F.array(board_date(name_col))))
    return boards.select(*[F.col(f"`{c}`") for c in boards.columns], parsed.alias("board_date"))


def current_board(boards: DataFrame, pick: str = "latest", id_col: str = "id",
                  name_col: str = "name", pos_col: str = "pos") -> DataFrame:
    """The current sprint board as a one-row DataFrame ``(id, name, board_date)``.

    ``latest``: the dated board with the greatest date; on a date tie the
    later listed one (greater ``pos``, a missing one first) wins, then the
    greater id.  ``last_listed``: the dated board listed last, whatever its
    date, with the same rule for missing and equal ``pos``.  A global aggregate, so the result
    is one row however many boards there are (none when no board is dated).
    """
    if pick not in PICK_BOARD:
        raise ValueError(f"pick must be one of {PICK_BOARD}")
    # max_by skips rows whose ordering value is null, so undated boards drop
    # out without a separate filter (which would parse every name twice).
    dated = boards.withColumn("board_date", board_date(name_col))
    # A null in a struct sorts before every value, so max_by takes it last.
    key = (F.struct(F.col("board_date"), F.col(pos_col), F.col(id_col)) if pick == "latest"
           else F.struct(F.col(pos_col), F.col(id_col)))
    rank = F.when(F.col("board_date").isNotNull(), key)
    row = F.struct(F.col(id_col).alias("id"), F.col(name_col).alias("name"),
                   F.col("board_date").alias("board_date"))
    best = dated.agg(F.max_by(row, rank).alias("b"))
    return best.where(F.col("b").isNotNull()).select("b.id", "b.name", "b.board_date")


def list_lookup(lists: DataFrame, list_name: str | None = None, pick: str = "name",
                board_col: str = "idBoard", id_col: str = "id", name_col: str = "name",
                pos_col: str = "pos") -> DataFrame:
    """One list per board: ``(idBoard, list_id)``.

    ``name``: the list whose name equals ``list_name`` ignoring case (the
    first in ``pos`` order if several).  ``first``: the first list of the
    board in ``pos`` order, whatever its name.  Lists without ``pos`` come
    last; ties go to the smaller id.
    """
    if pick not in PICK_LIST:
        raise ValueError(f"pick must be one of {PICK_LIST}")
    chosen = lists
    if pick == "name":
        if list_name is None:
            raise ValueError("list_name is required with pick='name'")
        chosen = lists.where(F.lower(F.col(name_col)) == F.lit(list_name.lower()))
    return (chosen.groupBy(F.col(board_col).alias("idBoard"))
            .agg(F.min_by(F.col(id_col), F.struct(F.col(pos_col).isNull(), F.col(pos_col), F.col(id_col))).alias("list_id")))


def with_board_name(cards: DataFrame, boards: DataFrame | None = None,
                    board_name: str | None = None, board_col: str = "idBoard",
                    id_col: str = "id", name_col: str = "name") -> DataFrame:
    """Add ``board_name``: a constant when ``board_name`` is given, otherwise a
    left join to ``boards`` on the board id (AQE broadcasts a measured small
    side and splits a hot board otherwise)."""
    if board_name is not None:
        return cards.withColumn("board_name", F.lit(board_name))
    if boards is None:
        raise ValueError("give boards or board_name")
    b = boards.select(F.col(id_col).alias("__board_id"), F.col(name_col).alias("board_name"))
    return (cards.join(b, cards[board_col] == b["__board_id"], "left").drop("__board_id"))
