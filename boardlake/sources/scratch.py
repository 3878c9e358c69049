"""Intermediate tables under the cluster's shared folder (``spark.checkpoint.dir``).

For operators that read an intermediate result more than once: it is written
as Parquet there, so a lost executor never sets a job back beyond it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.session import checkpoint_root


#: Codec of all tables written: a third smaller than the default.
CODEC = "zstd"
#: Bytes up to which a table is broadcast, as measured from its rows.
BROADCAST_BYTES = 64 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder.

    A single-process session without ``spark.checkpoint.dir`` gets a
    temporary folder of its own; a cluster without it is an error.
    """
    context, key = spark.sparkContext, "spark.checkpoint.dir"
    root = spark.conf.get(key, None) or context.getConf().get(key, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            checkpoint_root(spark)  # raises: not set
        root = tempfile.mkdtemp(prefix="boardlake-scratch-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        checkpoint_root(spark, default=root)
    return f"{root.rstrip('/')}/boardlake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, texts: Sequence[str], limit: int = BROADCAST_BYTES, row_bytes: int = 110) -> DataFrame:
    """``df``, to be broadcast if its measured rows, at ``row_bytes`` each, and the bytes of ``texts`` stay under ``limit``."""
    size = F.lit(row_bytes)
    for c in texts:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= limit else df
