"""The pipeline's tables expressed over the driver's TPC-H-like tables.

The driver tables hold no task-board data, so each layer is built from an
analogous table and every operator runs on data whose size grows with the
scale factor:

  card        = orders   (id = o_orderkey, name = o_custkey as text,
                          dateLastActivity = o_orderdate at one of four times of
                          day (00:00, 06:00, 12:00, 18:00) by o_orderkey, board = o_orderpriority,
                          list = priority/status, closed = status 'F')
  member      = supplier (id = s_suppkey, fullName = s_name)
  membership  = lineitem (l_orderkey, l_suppkey)
  board       = one per priority, named "Board <priority>"; for sprint-date
                parsing one board per order, named from its order date
  list        = one per (priority, status): Done (F), Doing (O), Review (P)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.operators.refine import refine_cards, unique_cards


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def activity():
    """A card's last activity: order dates are all at midnight, so the key gives the time of day."""
    return F.col("o_orderdate") + F.make_interval(hours=(F.col("o_orderkey") % 4 * 6).cast("int"))


def cards(spark: SparkSession, sf_dir: str, with_price: bool = False) -> DataFrame:
    """Bronze cards (without the id array; membership is a separate table).
    ``with_price`` adds ``o_totalprice`` as an extra ``price`` column."""
    o = table(spark, sf_dir, "orders")
    cols = [
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").alias("closed"),
        activity().alias("dateLastActivity"),
        F.col("o_orderpriority").alias("idBoard"),
        F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus")).alias("idList"),
        F.col("o_custkey").cast("string").alias("name"),
    ]
    if with_price:
        cols.append(F.col("o_totalprice").alias("price"))
    return o.select(*cols)


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("card_id"), F.col("l_suppkey").alias("member_id"))


def cards_with_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with their id array, from every line item: ids repeat as suppliers
    do within an order, and each array ends with an id that no member has."""
    ids = memberships(spark, sf_dir).groupBy("card_id").agg(F.collect_list("member_id").alias("idMembers"))
    unknown = F.array(F.lit(-1).cast(ids.schema["idMembers"].dataType.elementType))
    return cards(spark, sf_dir).join(ids, F.col("id") == F.col("card_id"), "left").drop("card_id").withColumn(
        "idMembers", F.concat("idMembers", "idMembers", unknown))


def cards_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed card records: JSON text of every card, id array included."""
    c = cards_with_members(spark, sf_dir)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    return c.select(F.to_json(F.struct(
        F.col("id").cast("string").alias("id"), "closed",
        F.date_format("dateLastActivity", iso).alias("dateLastActivity"), "idBoard", "idList",
        F.transform("idMembers", lambda m: m.cast("string")).alias("idMembers"), "name")).alias("value"))


def members_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed member records."""
    return members(spark, sf_dir).select(F.to_json(F.struct(
        F.col("id").cast("string").alias("id"), "fullName")).alias("value"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("fullName"))


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One board per priority, derived from the whole orders table."""
    return (table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("id")).distinct()
            .withColumn("name", F.concat(F.lit("Board "), F.col("id"))))


def sprint_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One board per order, its name carrying the order date in one of five
    spellings chosen by priority (one of them has no date at all)."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    p = F.col("o_orderpriority")
    name = (F.when(p == "1-URGENT", F.concat(F.lit("Sprint ("), F.date_format(d, "d-MMMM-yyyy"), F.lit(")")))
            .when(p == "2-HIGH", F.concat(F.lit("SPRINT ("), F.upper(F.date_format(d, "d-MMM-yyyy")), F.lit(")")))
            .when(p == "3-MEDIUM", F.concat(F.lit("Sprint ("), F.date_format(d, "dd-MMMyyyy"), F.lit(")")))
            .when(p == "4-NOT SPECIFIED", F.lit("Sprint (archive)"))
            .otherwise(F.concat(F.lit("Sprint ("), F.date_format(d, "dd-MMM-yyyy"), F.lit(") (old)"))))
    return o.select(F.col("o_orderkey").alias("id"), name.alias("name"),
                    F.col("o_orderkey").alias("pos"))


def dated_priority_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One board per priority, named after the priority's latest order date
    (``Sprint (1-Aug-2001)``), listed in priority order."""
    o = table(spark, sf_dir, "orders")
    latest = o.groupBy(F.col("o_orderpriority").alias("id")).agg(F.max("o_orderdate").alias("d"))
    return latest.select(
        "id",
        F.concat(F.lit("Sprint ("), F.date_format("d", "d-MMM-yyyy"), F.lit(")")).alias("name"),
        F.substring("id", 1, 1).cast("int").alias("pos"))


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list per (board, status), derived from the whole orders table."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus").distinct()
    s = F.col("o_orderstatus")
    return o.select(
        F.concat(F.col("o_orderpriority"), F.lit("/"), s).alias("id"),
        F.col("o_orderpriority").alias("idBoard"),
        F.when(s == "F", "Done").when(s == "O", "Doing").when(s == "P", "Review").alias("name"),
        F.when(s == "F", 1).when(s == "O", 2).when(s == "P", 3).alias("pos"),
    )


def silver(spark: SparkSession, sf_dir: str, board: str | None = None,
           keep_unmatched: bool = False) -> DataFrame:
    """Silver cards: member names, LastUpdated and board name on every card."""
    return refine_cards(cards(spark, sf_dir), members(spark, sf_dir), board=board,
                        boards=boards(spark, sf_dir), keep_unmatched=keep_unmatched,
                        pairs=memberships(spark, sf_dir))


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_cards(silver(spark, sf_dir))
