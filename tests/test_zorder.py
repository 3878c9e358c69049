"""Z-ordered tables: the same rows, and files that filters rule out by their statistics."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from boardlake.plans import pipeline as P
from boardlake.sources.tables import merge_into, read_table, version_path, write_snapshot
from boardlake.sources.zorder import interleaved, optimize, range_number, range_starts
from conftest import rows

DAY = dt.datetime(2023, 1, 1)


def cards(spark, n=6000):
    k = F.col("id")
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    return spark.range(n, numPartitions=4).select(
        k.cast("string").alias("id"), F.concat(F.lit("n"), k % 50).alias("name"),
        F.format_string("l%03d", F.when(h < 300, 7).otherwise(h % 40)).alias("idList"),  # one list holds a third
        F.when(k % 97 != 0, F.lit(DAY) + F.make_interval(days=F.pmod(F.xxhash64("id", F.lit(2)), F.lit(400)).cast("int"))).alias("dateLastActivity"),
        F.lit("Ann").alias("card_members"), F.lit("d").alias("LastUpdated"), F.lit("b").alias("board_name"))


def touched(root, name, version, lists=None, low=None, high=None):
    """Files whose statistics can't rule the filter out, and all files."""
    hit, files = 0, glob.glob(f"{version_path(root, name, version)}/*.parquet")
    for f in files:
        meta, keep = pq.ParquetFile(f).metadata, True
        for group in (meta.row_group(k) for k in range(meta.num_row_groups)):
            stats = {group.column(k).path_in_schema: group.column(k).statistics for k in range(group.num_columns)}
            a, d = stats["idList"], stats["dateLastActivity"]
            keep = (lists is None or a.min <= lists <= a.max) and (not d.has_min_max or (
                (low is None or d.max.replace(tzinfo=None) >= low) and (high is None or d.min.replace(tzinfo=None) < high)))
            hit += keep
    return hit, len(files)


def test_filters_skip_files(spark, tmp_path):
    root = str(tmp_path)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        write_snapshot(cards(spark).repartition(32), root, P.SILVER_CARDS, cluster_by=P.CLUSTER[P.SILVER_CARDS])
        assert optimize(spark, root, P.SILVER_CARDS, ["idList", "dateLastActivity"]) == 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert rows(read_table(spark, root, P.SILVER_CARDS, 2)) == rows(read_table(spark, root, P.SILVER_CARDS, 1))
    # the idle cards of a list, and a member's date range over all lists
    idle, span = {"lists": "l021", "high": DAY + dt.timedelta(days=100)}, {"low": DAY + dt.timedelta(days=350), "high": DAY + dt.timedelta(days=380)}
    for filters, share in ((idle, 0.33), (span, 0.5), ({"lists": "l021"}, 0.5)):
        hit, files = touched(root, P.SILVER_CARDS, 2, **filters)
        assert files >= 24 and 0 < hit <= share * files, (filters, hit, files)
        assert touched(root, P.SILVER_CARDS, 1, **filters)[0] == 32


def test_ranges_and_the_curve(spark):
    values = spark.createDataFrame([(v,) for v in [None, *"qwertyuiopasdfghjklzxcvbnm"] * 2], "v string")
    starts = range_starts(values, 3)
    assert starts == sorted(starts) and len(starts) <= 7
    for r in values.distinct().select("v", range_number(F.col("v"), starts).alias("n")).collect():
        assert r.n == (0 if r.v is None else sum(s <= r.v for s in starts))
    assert range_starts(values.where("false")) == [] and range_starts(values.where("v = 'a'")) == []
    grid = spark.range(64).select((F.col("id") % 8).alias("x"), (F.col("id") / 8).cast("int").alias("y"))
    for r in grid.select("x", "y", interleaved([F.col("x"), F.col("y")], 3).alias("z")).collect():
        assert r.z == sum((r.x >> k & 1) << 2 * k | (r.y >> k & 1) << 2 * k + 1 for k in range(3))


def test_empty_and_bucketed_tables(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(cards(spark, 0), root, "empty")
    optimize(spark, root, "empty", ["idList", "dateLastActivity"])
    assert read_table(spark, root, "empty").count() == 0
    merge_into(spark, root, "cut", cards(spark, 10), ["id"], buckets=(["idList"], 4))
    with pytest.raises(ValueError, match="buckets"):
        optimize(spark, root, "cut", ["idList"])
    with pytest.raises(FileNotFoundError):
        optimize(spark, root, "absent", ["idList"])
