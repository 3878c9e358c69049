"""Helpers shared by the corpus operators: scratch tables, a worker cache,
null-tolerant column picks and connected components."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.session import checkpoint_root


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    A single-process session (``local[...]``) without that setting gets a
    temporary folder, removed when the process ends; a cluster without it is
    an error.
    """
    context, key = spark.sparkContext, "spark.checkpoint.dir"
    named = spark.conf.get(key, None) or context.getConf().get(key, None)
    local = context.master == "local" or context.master.startswith("local[")
    if named or not (local or context.getCheckpointDir()):
        return checkpoint_root(spark)
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    own = tempfile.mkdtemp(prefix="boardlake-llm-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return checkpoint_root(spark, default=own)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/boardlake-llm/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch path through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this package from the shared folder.

    For the end of a job: results that were not written elsewhere read from them.
    """
    delete_path(spark, f"{scratch_root(spark)}/boardlake-llm")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared folder and read it.

    The files survive lost executors, so later stages never recompute ``df``.
    """
    path = scratch_path(df.sparkSession, name)
    with released_shuffles(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


@contextlib.contextmanager
def released_shuffles(spark: SparkSession):
    """Actions inside give their shuffle files back when they end.

    For an action whose exchanged data nothing reads again; otherwise the files
    stay until the driver happens to collect its plan.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` once nothing reads it any more."""
    delete_path(df.sparkSession, df._scratch_path)


def worker_cache(key: tuple, make: Callable):
    """``make()`` once per Python worker process.

    Functions shipped by value get fresh module globals in every task, so the
    cache lives in a module of its own that outlasts them.
    """
    holder = sys.modules.setdefault("_boardlake_worker_cache", types.ModuleType("_boardlake_worker_cache"))
    store = holder.__dict__.setdefault("items", {})
    if key not in store:
        store[key] = make()
    return store[key]


def sql_name(name: str) -> str:
    """Backquoted column name, safe for dots and quotes."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(df: DataFrame, new: str, without: tuple[str, ...] = ()) -> T.StructType:
    """Schema of ``df`` less some columns, with the fields of the DDL string ``new``."""
    return T.StructType([f for f in df.schema.fields if f.name not in without] + T.StructType.fromDDL(new).fields)


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under fixed names, whatever else ``df`` holds."""
    return df.select(*[F.col(sql_name(source)).alias(name) for name, source in names.items()])


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: link each node's neighbours to the smallest of them."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        rest = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = rest.union(least.select("u", F.col("m").alias("v")))
    return out.distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(u, v)``: rows (node, component).

    ``component`` is the smallest node that can be reached; nodes without an
    edge do not appear.  Alternating large-star and small-star steps (both
    joins and aggregates, no node's neighbours are gathered in one place)
    until the edge set, which only ever points to smaller nodes, stands still.
    """
    a, b = F.greatest("u", "v"), F.least("u", "v")
    current = stored(edges.where("u != v").select(a.alias("u"), b.alias("v")).distinct(), name)

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = state(current)
    while before[0]:
        grown = stored(_stars(current, large=True), name)
        after = stored(_stars(grown, large=False), name)
        discard(grown)
        discard(current)
        current, now = after, state(after)
        if now == before:
            break
        before = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
