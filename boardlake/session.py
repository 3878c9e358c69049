"""Session construction and cluster-provided settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the pipeline's semantics depend on: dates are formatted and
# day-truncated in UTC, and casts of bad text must fail loudly (ANSI),
# which is why bronze parses timestamps once with try_to_timestamp.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Execution settings: AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed ones.  Broadcasts come only
# from sizes that are measured (AQE, after a shuffle stage has run) or
# proven by file sizes (operators.upsert); the static planner's guess from
# compressed file sizes is switched off.
EXECUTION_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Member names are gathered by collect_set with a group for each card; the
    # default of 128 groups would leave hash aggregation for a sort in every task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    # Checkpoints written by upserts are removed once no plan refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "boardlake", master: str | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Return a session with the pipeline's settings.

    ``master`` is only set when given (tests and bench pass ``local[N]``);
    on a cluster the submitter decides.  Cluster-wide settings such as
    ``spark.checkpoint.dir`` are never overridden here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**EXECUTION_CONF, **SEMANTIC_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Streaming checkpoints and lineage cuts go under it.  ``default`` is
    used only when the setting is absent (local tests); it is then also
    registered on the context so ``DataFrame.checkpoint`` works.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not value:
        if default is None:
            raise ValueError("spark.checkpoint.dir is not set and no default was given")
        value = default
        spark.sparkContext.setCheckpointDir(value)
    return value.rstrip("/")
