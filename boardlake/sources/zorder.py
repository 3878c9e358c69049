"""Global Z-order of a table, so that filters on any of several columns skip whole files.

Sorting inside each task, as snapshots do, leaves every file spanning all
values.  Here each column is cut into 2^BITS ranges of its distinct values,
a row's range numbers are interleaved bit by bit into its place on a Z curve,
and rows are dealt out by ranges of the curve: a file then holds a small box
of the columns' ranges, and its statistics rule it out for other boxes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from boardlake.sources.tables import bucket_count, read_table, write_snapshot

#: Bits of a column's range number.
BITS = 6


def _ordered(df: DataFrame, name: str) -> Column:
    """What a column is cut into ranges by: times by their day, of which there are few."""
    column = F.col(f"`{name}`")
    return F.to_date(column) if isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType)) else column


def range_starts(values: DataFrame, bits: int = BITS) -> list:
    """First values, ascending, of all but the first of at most ``2^bits`` ranges of the one column of ``values``.

    Spark's range partitioning of the distinct values finds them; the driver
    gets one value a range.
    """
    distinct = values.toDF("v").where("v IS NOT NULL").distinct()
    cut = distinct.repartitionByRange(1 << bits, "v").groupBy(F.spark_partition_id()).agg(F.min("v").alias("v"))
    return sorted(r["v"] for r in cut.select("v").collect())[1:]


def range_number(column: Column, starts: Sequence) -> Column:
    """Number of the range that a value lies in, by a tree of comparisons; a null is in the first."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(starts[middle]), tree(middle + 1, high)).otherwise(tree(low, middle))

    return tree(0, len(starts))


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Z curve: bit ``i`` of every number side by side, highest first."""
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for k, number in enumerate(numbers):
            one = F.shiftright(number.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(numbers) + k))
    return place


def zordered(df: DataFrame, by: Sequence[str], bits: int = BITS) -> DataFrame:
    """``df`` dealt out and sorted by its place on the Z curve of the columns ``by``.

    Partitions are the session's, coalesced by AQE to its advisory size; a
    place that very many rows share is split no further, as its rows agree in all ranges.
    """
    keys = [_ordered(df, c) for c in by]
    starts = [range_starts(df.select(k), bits) for k in keys]
    # Fewer ranges than numbers are spread over all of them, so that the highest bit halves them.
    numbers = [F.floor(range_number(k, s) * F.lit(1 << bits) / F.lit(len(s) + 1)) for k, s in zip(keys, starts)]
    curve = interleaved(numbers, bits)
    rows = df.withColumn("__curve", curve)
    return rows.repartitionByRange("__curve", *by).sortWithinPartitions("__curve", *by).drop("__curve")


def optimize(spark: SparkSession, root: str, name: str, by: Sequence[str]) -> int:
    """Write the newest version of a table again, in Z-order; returns the new version.

    For tables that are read more often than written.  A table in buckets is
    split by its board already and is refused.
    """
    table = read_table(spark, root, name)
    if table is None:
        raise FileNotFoundError(f"table {name!r} has no committed version under {root}")
    if bucket_count(spark, root, name):
        raise ValueError(f"table {name!r} is cut into buckets")
    return write_snapshot(zordered(table, by), root, name)
