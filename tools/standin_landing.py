"""JSON landing directories built from the driver tables (test and bench data).

cards   <- orders, with ``idMembers`` the distinct suppliers of the order's lines
members <- supplier;  boards <- one per order priority;  lists <- one per (priority, status)

Building the id arrays groups lineitem by order; this is data preparation for
tests and benchmarks, not part of the pipeline.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def write_landing(spark: SparkSession, sf_dir: str, out: str) -> None:
    t = lambda n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet")
    o, li, s = t("orders"), t("lineitem"), t("supplier")
    ids = li.groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey").cast("string")).alias("idMembers"))
    cards = o.join(ids, o.o_orderkey == ids.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_orderstatus") == "F").alias("closed"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("dateLastActivity"),
        F.col("o_orderpriority").alias("idBoard"),
        F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("idList"),
        "idMembers",
        F.col("o_custkey").cast("string").alias("name"))
    cards.write.json(f"{out}/cards")
    s.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("fullName")) \
        .write.json(f"{out}/members")
    o.select(F.col("o_orderpriority").alias("id")).distinct() \
        .select("id", F.concat(F.lit("Board "), "id").alias("name"), F.lit(1).alias("pos")) \
        .write.json(f"{out}/boards")
    o.select("o_orderpriority", "o_orderstatus").distinct().select(
        F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("id"),
        F.col("o_orderpriority").alias("idBoard"), F.col("o_orderstatus").alias("name"),
        F.lit(1).alias("pos")).write.json(f"{out}/lists")
