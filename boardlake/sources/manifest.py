"""Which landing files a table has taken in: incremental batch ingest.

A folder that grows is listed without reading its files, and those in the
manifest with the same path, modification time and length are left out.  The
manifest is a log with a part for each run, written when the batch is
committed: a run that dies before takes the same files again, to the same
rows.  A file delivered again unchanged counts once; one that changed is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.sources.tables import read_parts, write_part

KEY = ["path", "modified", "length"]


def listed(spark: SparkSession, landing: str, pattern: str = "*.json*") -> DataFrame:
    """(path, modified, length) of the landing's files; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(landing)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def unconsumed(spark: SparkSession, landing: str, root: str, kind: str, pattern: str = "*.json*") -> DataFrame:
    """The listed files that the manifest of ``kind`` does not have."""
    found, seen = listed(spark, landing, pattern), read_parts(spark, root, f"consumed_{kind}")
    return found if seen is None else found.join(seen.select(*KEY), KEY, "left_anti")


def consumed(files: DataFrame, root: str, kind: str, run: str) -> None:
    """Note ``files`` as taken in by ``run``; written again, it replaces its own part."""
    write_part(files.select(*KEY), root, f"consumed_{kind}", run)
