"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``row_number() = 1`` over ``partitionBy(keys).orderBy(order)``; Spark
    plans it with a partial ``WindowGroupLimit`` before the shuffle, so a
    hot key leaves each map task as a single row.  Null keys form one
    group.  Put a unique column last in ``order`` for deterministic ties.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_columns(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_per_key_agg(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       descending: bool = True) -> DataFrame:
    """Same rows as :func:`latest_per_key` with an aggregate plan.

    ``max_by(struct(row), struct(order))`` per key with partial aggregation
    before the shuffle.  ``order`` names columns; ``descending=True`` picks
    the greatest, ``False`` the smallest.  A null in an order column is
    smaller than any value: it loses under ``True`` (``NULLS LAST``) and wins
    under ``False`` (``NULLS FIRST``).
    """
    cols = [c for c in df.columns]
    row = F.struct(*[F.col(c) for c in cols])
    rank = F.struct(*[F.col(c) for c in order])
    agg = F.max_by(row, rank) if descending else F.min_by(row, rank)
    return df.groupBy(*keys).agg(agg.alias("_r")).select(*[F.col("_r")[c].alias(c) for c in cols])
