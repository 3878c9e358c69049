"""Incremental bronze ingest (ST1).

New JSON files in the landing directory are picked up by a file stream.  A
micro-batch is parsed once and written whole as a part of the kind's change
log, named by its batch id, and its unusable records as a part of the rejects;
the bronze table is not touched.  Writing a batch again, after a failure or
from an older checkpoint, replaces the same parts, so nothing doubles.
``compact_changes`` then merges all parts into bronze as one new version, on
whatever schedule suits: a trigger costs only its own rows.

Late data does not overwrite a stored card whose last activity is newer, and
an undated card no dated one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from boardlake.plans.pipeline import CLUSTER, KINDS, _bad, _buckets, keep_rejects, newest_first
from boardlake.schemas import CARDS_JSON, MEMBER_COLUMNS, MEMBERS_JSON
from boardlake.session import checkpoint_root
from boardlake.sources.landing import CORRUPT, FAILURES, LANDED, _typed_cards
from boardlake.sources.tables import delete_parts, latest_version, merge_into, parts, read_parts, write_part


def batch_key(batch_id: int) -> str:
    return f"stream-{batch_id:010d}"


def log_batch(batch: DataFrame, root: str, kind: str, batch_id: int) -> None:
    """Write a micro-batch to the change log and its rejects beside it."""
    key, name = batch_key(batch_id), f"changes_{kind}"
    write_part(batch.withColumn("__bad", _bad(batch)), root, name, key)
    keep_rejects(read_parts(batch.sparkSession, root, name, [key]), root, kind, key)


def compact_changes(spark: SparkSession, root: str, kind: str = "cards", plan: str = "shuffle") -> int | None:
    """Merge the logged micro-batches into bronze; the new version, or None without any.

    Of several records of an id the newest wins (see ``newest_first``).  If
    the job dies between the merge and the deletion of the parts, merging
    them again gives the same table.
    """
    name, (_, table, _) = f"changes_{kind}", KINDS[kind]
    keys = parts(spark, root, name)
    if not keys:
        return latest_version(spark, root, table)
    good = read_parts(spark, root, name, keys).where("NOT __bad").drop("__bad", CORRUPT, FAILURES)
    version = merge_into(spark, root, table, good, ["id"], order_by=newest_first(kind),
                         keep_newer="dateLastActivity" if kind == "cards" else None,
                         cluster_by=CLUSTER.get(table), plan=plan, drop=tuple(LANDED),
                         buckets=_buckets(spark, root, table, None))
    delete_parts(spark, root, name, keys)
    return version


def _stream(spark: SparkSession, landing: str, root: str, kind: str, checkpoint: str | None,
            max_files_per_trigger: int | None, available_now: bool):
    ckpt = checkpoint or f"{checkpoint_root(spark)}/boardlake/stream_{KINDS[kind][1]}"
    schema = CARDS_JSON if kind == "cards" else MEMBERS_JSON
    reader = (spark.readStream.schema(StructType(schema.fields + [StructField(CORRUPT, StringType())]))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    meta = F.col("_metadata")
    rows = reader.json(landing).select("*", meta["file_modification_time"].alias(LANDED[0]),
                                       meta["file_path"].alias(LANDED[1]), meta["file_block_start"].alias(LANDED[2]))
    rows = _typed_cards(rows, failures=True) if kind == "cards" else rows.select(*MEMBER_COLUMNS, CORRUPT, *LANDED[:3])

    def log(batch: DataFrame, batch_id: int) -> None:
        # The place in the split is numbered here: a stream's plan may not number rows.
        log_batch(batch.withColumn(LANDED[3], F.monotonically_increasing_id()), root, kind, batch_id)

    writer = rows.writeStream.foreachBatch(log).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_cards(spark: SparkSession, landing: str, root: str, checkpoint: str | None = None,
                 max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the card stream; with ``available_now`` it logs what has landed
    and stops (the daily-cron shape), to be followed by
    :func:`compact_changes`.  Returns the query handle.

    ``checkpoint`` defaults to a folder under the cluster's
    ``spark.checkpoint.dir``.
    """
    return _stream(spark, landing, root, "cards", checkpoint, max_files_per_trigger, available_now)


def stream_members(spark: SparkSession, landing: str, root: str, checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None, available_now: bool = True):
    """As :func:`stream_cards` for member JSON (members carry no timestamp, so
    the last landed record wins)."""
    return _stream(spark, landing, root, "members", checkpoint, max_files_per_trigger, available_now)
