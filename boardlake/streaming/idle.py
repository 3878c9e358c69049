"""Idle cards as a stream (G0 with state): a card comes out when it becomes idle.

Event time is the time a record landed, so the newest landing seen, the clock,
is the stream's ``as_of``, and a card whose last activity is years old is no
late record.  The state of a card is its newest record (by activity, then by
landing, as in bronze) and whether it is idle.  When the clock passes ``days``
after its activity, the card is logged as idle; a newer record of a card that
is idle logs it as active again.  Records may arrive in any order and again,
also ones that landed before the clock: an older or equal one changes nothing.
A stream's rows have no place in their file, so of a card's records of one file
and one activity the greatest (name, board, list) counts.

A batch joins its newest records to the state, for all cards at once, instead
of calling code for each card.  The state is a log too: a batch appends the
cards that it changed, and the state before a batch is the last row of each
card in the parts of earlier batches.  So a batch writes its changes alone,
and reads the state once.  All logs are written in parts named by batch id, and
a batch that is run again replaces its own.  ``idle_now`` folds the log of
changes to the cards that are idle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.schemas import CARDS_JSON
from boardlake.session import checkpoint_root
from boardlake.sources.landing import _typed_cards
from boardlake.sources.tables import delete_parts, parts, read_parts, write_part

LOG, STATE, CLOCK, BATCH = "idle_log", "idle_state", "idle_clock", "idle_batch"
RECORD = "id string, name string, idBoard string, idList string, activity timestamp, landed timestamp, file string"
#: A card's record, in the order in which records are newer; nulls are oldest.
CARD = ["activity", "landed", "file", "name", "idBoard", "idList"]
HELD = ("id string, card struct<activity: timestamp, landed: timestamp, file: string, name: string, idBoard: string, idList: string>, "
        "idle boolean, changes long")
DAY_US = 86_400_000_000


def advance(held: DataFrame, records: DataFrame, days: int, clock: int | None) -> DataFrame:
    """HELD rows of the cards that ``records`` or the ``clock`` (microseconds) change, and how: ``woke``, ``fell`` or neither.

    A card that was idle and whose newer record is past its time too does both.
    """
    newest = records.groupBy("id").agg(F.max(F.struct(*CARD)).alias("new"))
    before = held.select(F.col("id").alias("held_id"), F.col("card").alias("old"), F.coalesce("idle", F.lit(False)).alias("was_idle"), "changes")
    both = newest.join(before, F.col("id").eqNullSafe(F.col("held_id")), "full_outer").withColumns({
        "taken": F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new") > F.col("old"))),
        "was_idle": F.coalesce("was_idle", F.lit(False)), "card": F.greatest("new", "old")})
    due = F.unix_micros("card.activity") + F.lit(days * DAY_US)
    both = both.withColumn("idle", F.coalesce(due < F.lit(clock).cast("long"), F.lit(False)))
    both = both.withColumns({"woke": F.col("was_idle") & F.col("taken"), "fell": F.col("idle") & (F.col("taken") | ~F.col("was_idle"))})
    changes = F.coalesce("changes", F.lit(0)) + F.col("woke").cast("long") + F.col("fell").cast("long")
    return both.where("taken OR fell").select(F.coalesce("id", "held_id").alias("id"), "card", "idle", changes.alias("changes"), "woke", "fell")


def changes_logged(changed: DataFrame) -> DataFrame:
    """Log rows of ``advance``: each time a card becomes idle, or active again."""
    times = F.array_compact(F.array(
        F.when(F.col("woke"), F.struct(F.lit(False).alias("idle"), (F.col("changes") - F.col("fell").cast("long")).alias("changes"))),
        F.when(F.col("fell"), F.struct(F.lit(True).alias("idle"), F.col("changes").alias("changes")))))
    return changed.where("woke OR fell").select("id", "card", F.explode(times).alias("t")).select(
        "id", "card.name", "card.idBoard", "card.idList", F.col("card.activity").alias("dateLastActivity"), "t.idle", "t.changes")


def held_before(spark: SparkSession, root: str, key: str) -> DataFrame:
    """The state (HELD) that the batches before part ``key`` left."""
    log = read_parts(spark, root, STATE, [k for k in parts(spark, root, STATE) if k < key])
    if log is None:
        return spark.createDataFrame([], HELD)
    return log.groupBy("id").agg(F.max_by(F.struct("card", "idle", "changes"), "batch").alias("s")).select("id", "s.*")


def log_batch(spark: SparkSession, batch: DataFrame, root: str, days: int, batch_id: int) -> None:
    """Take a micro-batch of RECORD rows into the state, and log the cards that became idle or active again."""
    key = f"stream-{batch_id:010d}"
    write_part(batch, root, BATCH, key)   # the landing is parsed once; what follows runs outside the stream's session
    records = read_parts(spark, root, BATCH, [key])
    write_part(records.agg(F.max(F.unix_micros("landed")).alias("clock")), root, CLOCK, key)
    clock = read_parts(spark, root, CLOCK, [k for k in parts(spark, root, CLOCK) if k <= key]).agg(F.max("clock")).first()[0]
    changed = advance(held_before(spark, root, key), records, days, clock)
    write_part(changed.withColumn("batch", F.lit(batch_id).cast("long")), root, STATE, key)
    write_part(changes_logged(read_parts(spark, root, STATE, [key])), root, LOG, key)
    delete_parts(spark, root, BATCH, [key])


def log_idle(records: DataFrame, root: str, days: int, checkpoint: str | None = None, available_now: bool = True):
    """Start logging the changes of a stream of RECORD rows.  Returns the query handle."""
    spark = records.sparkSession

    def log(batch: DataFrame, batch_id: int) -> None:
        log_batch(spark, batch, root, days, batch_id)

    writer = records.writeStream.foreachBatch(log).option(
        "checkpointLocation", checkpoint or f"{checkpoint_root(spark)}/boardlake/stream_idle")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_idle(spark: SparkSession, landing: str, root: str, days: int, checkpoint: str | None = None,
                max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stream over a folder of card JSON; it logs to ``idle_log``.  Returns the query handle."""
    reader = spark.readStream.schema(CARDS_JSON)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    meta = F.col("_metadata")
    rows = reader.json(landing).select("*", meta["file_modification_time"].alias("__landed_at"), meta["file_path"].alias("__landed_file"))
    cards = _typed_cards(rows).where("id IS NOT NULL").select(
        "id", "name", "idBoard", "idList", F.col("dateLastActivity").alias("activity"),
        F.col("__landed_at").alias("landed"), F.col("__landed_file").alias("file"))
    return log_idle(cards, root, days, checkpoint, available_now)


def idle_now(spark: SparkSession, root: str, lists: str | Sequence[str] | None = None) -> DataFrame | None:
    """Cards that are idle after the last logged batch, in ``lists`` (any, if not given); None before any batch."""
    log = read_parts(spark, root, LOG)
    if log is None:
        return None
    last = log.groupBy("id").agg(F.max_by(F.struct(*[c for c in log.columns if c != "id"]), "changes").alias("s")).select("id", "s.*")
    out = last.where("idle").drop("idle", "changes")
    if lists is None:
        return out
    return out.where(F.col("idList").isin([lists] if isinstance(lists, str) else list(lists)))
