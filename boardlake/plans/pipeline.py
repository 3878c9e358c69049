"""The pipeline's jobs (R1-R6): landing JSON -> bronze -> silver -> gold.

Each job reads the latest committed snapshots, builds one Spark plan and
writes one new snapshot (see :mod:`boardlake.sources.tables`).  No data
rows reach the driver: the current board and the chosen list are one-row
DataFrames joined into the plan; only version numbers are read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from boardlake.operators.activity import MemberSpec, idle_cards, member_activity, member_activity_many
from boardlake.operators.boards import current_board, list_lookup
from boardlake.operators.dedupe import latest_per_key
from boardlake.operators.member_table import member_activity_table
from boardlake.operators.refine import refine_cards, unique_cards
from boardlake.schemas import GOLD_A
from boardlake.sources.landing import (CORRUPT, FAILURES, LANDED, cast_failures, newest_landed, read_boards, read_cards,
                                       read_lists, read_members)
from boardlake.sources.manifest import consumed, unconsumed
from boardlake.sources.scratch import stored
from boardlake.sources.tables import (BUCKET, bucket_count, bucket_of, delete_parts, latest_version, merge_into,
                                      read_parts, read_table, write_part, write_snapshot)

# Table names under the pipeline root.
BRONZE_CARDS = "bronze_cards"
BRONZE_MEMBERS = "bronze_members"
BOARDS = "boards"
LISTS = "lists"
SILVER_CARDS = "silver_cards"
SILVER_UNIQUE = "silver_unique_cards"
SILVER_CHANGES = "silver_changes"
SILVER_UNIQUE_STATE = "silver_unique_state"
GOLD_IDLE = "gold_noactive_cards"
GOLD_REPORTS = "gold_member_reports"

# Row order inside each written file, chosen for the filters that read the
# table next: refine filters bronze by board, the idle job filters silver by
# list and last activity, member reports filter unique cards by date range.
CLUSTER = {
    BRONZE_CARDS: ["idBoard", "dateLastActivity"],
    SILVER_CARDS: ["idList", "dateLastActivity"],
    SILVER_UNIQUE: ["dateLastActivity"],
}

# Columns whose hash cuts a table into buckets, where buckets are asked for.  Both tables
# are refined a board at a time: a run reads and writes that board's buckets alone.
BUCKETS_BY = {BRONZE_CARDS: ["idBoard"], BRONZE_MEMBERS: ["id"], SILVER_CARDS: ["idBoard"]}


def _buckets(spark: SparkSession, root: str, table: str, asked: int | None) -> tuple[list[str], int] | None:
    """Columns and count of the table's buckets: as asked, else as it is cut already (0: not cut)."""
    n = bucket_count(spark, root, table) if asked is None else asked
    return (BUCKETS_BY[table], n) if n else None


def _require(spark: SparkSession, root: str, name: str, keep_bucket: bool = False) -> DataFrame:
    t = read_table(spark, root, name, keep_bucket=keep_bucket)
    if t is None:
        raise FileNotFoundError(f"table {name!r} has no committed version under {root}")
    return t


#: Job kinds of the landing: reader, table, and what comes before the landing order of a repeated id.
KINDS = {
    "cards": (read_cards, BRONZE_CARDS, ["dateLastActivity"]),
    "members": (read_members, BRONZE_MEMBERS, []),
}
LISTINGS = {"boards": (read_boards, BOARDS), "lists": (read_lists, LISTS)}


def _bad(df: DataFrame):
    """Rows without an id (a null key would be inserted again on every run) or malformed.

    The predicate names the corrupt column: a filter on parsed fields alone is
    pushed into the JSON reader, which then skips malformed records.
    """
    return F.col("id").isNull() | F.col(CORRUPT).isNotNull()


def newest_first(kind: str) -> list:
    """Order of the records of one id: cards by last activity, then, as all kinds, by landing."""
    return [F.col(c).desc_nulls_last() for c in KINDS[kind][2]] + newest_landed()


def _run_key(spark: SparkSession, root: str, table: str) -> str:
    """Name of a batch run: the version of ``table`` it is about to write."""
    return f"batch-{(latest_version(spark, root, table) or 0) + 1:08d}"


def _staged(raw: DataFrame, root: str, kind: str, run: str, metrics: dict | None = None) -> DataFrame:
    """``raw`` with a ``__bad`` flag, written once, so that its JSON is parsed once.

    A run that is started again writes the same part again.  ``metrics`` gets
    the counts of rows, rejects and unreadable fields, observed while writing.
    """
    spark, flagged = raw.sparkSession, raw.withColumn("__bad", _bad(raw))
    failures = F.sum(F.size(FAILURES) if FAILURES in raw.columns else F.lit(0))
    counts = Observation(f"{kind}-{run}")
    observed = flagged.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if("__bad").alias("rejected"),
                               F.coalesce(failures, F.lit(0)).cast("long").alias("cast_failures"))
    write_part(observed if metrics is not None else flagged, root, f"staged_{kind}", run)
    if metrics is not None:
        metrics.update(counts.get)
    return read_parts(spark, root, f"staged_{kind}", [run])


def keep_rejects(staged: DataFrame, root: str, kind: str, run: str) -> None:
    """Write the run's unusable records as a part of ``rejected_<kind>``; other runs' parts stay."""
    rejects = staged.where("__bad").drop("__bad", FAILURES, *LANDED)
    write_part(rejects, root, f"rejected_{kind}", run)
    if FAILURES in staged.columns:
        write_part(cast_failures(staged.where("NOT __bad")), root, f"cast_failures_{kind}", run)


def read_cast_failures(spark: SparkSession, root: str, kind: str = "cards") -> DataFrame | None:
    """(id, field, raw): text of kept rows that could not be read and is null in its column, of all runs."""
    return read_parts(spark, root, f"cast_failures_{kind}")


def read_rejects(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """Rejected records of all runs."""
    return read_parts(spark, root, f"rejected_{kind}")


def ingest_bronze(spark: SparkSession, landing: str | list[str], root: str, kind: str = "cards",
                  multi_line: bool = False, plan: str = "shuffle", buckets: int | None = None,
                  metrics: dict | None = None, extras: bool = False) -> int:
    """Upsert a landing directory of card or member JSON into bronze.

    The whole batch is one upsert (the reference ran one MERGE per object).
    Rows without an id and malformed records go to ``rejected_<kind>``.  A
    key repeated in the batch keeps its newest row: cards by last activity,
    then, as members, by the landing time of the file, its path, and the
    record's place in it, so the last landed one wins.  ``plan`` names the
    plan of the upsert.  ``buckets`` cuts the table into so many buckets (cards
    by board, members by id), of which a batch rewrites only its own; a table
    that is cut stays so, and 0 makes it whole again.

    A row with an unreadable date stays, with a null; the text goes to
    ``cast_failures_<kind>`` with the row's id and the field's name.
    ``metrics``, a dict, gets the counts of rows, rejects and such fields.
    ``extras`` keeps the keys that the schema lacks (see ``sources.drift``).
    """
    if kind not in KINDS:
        raise ValueError("kind must be 'cards' or 'members'")
    reader, table, _ = KINDS[kind]
    run = _run_key(spark, root, table)
    extra = {"failures": True} if kind == "cards" else {}
    extra |= {"extras": True} if extras else {}
    raw = reader(spark, landing, multi_line, keep_corrupt=True, landed=True, **extra)
    staged = _staged(raw, root, kind, run, metrics)
    keep_rejects(staged, root, kind, run)
    good = staged.where("NOT __bad").drop("__bad", CORRUPT, FAILURES)
    version = merge_into(spark, root, table, good, ["id"], order_by=newest_first(kind),
                         cluster_by=CLUSTER.get(table), plan=plan, drop=tuple(LANDED),
                         buckets=_buckets(spark, root, table, buckets), is_stored=True)
    delete_parts(spark, root, f"staged_{kind}", [run])
    return version


def ingest_new(spark: SparkSession, landing: str, root: str, kind: str = "cards", multi_line: bool = False,
               pattern: str = "*.json*", **options) -> int | None:
    """R1/R2 over a folder that grows: :func:`ingest_bronze` of the files that no earlier run took in.

    Returns the table's version, which stays as it is when there is no new
    file (None before the first).  The driver reads the new files' paths, as
    Spark's own listing does.
    """
    _, table, _ = KINDS[kind]
    files = stored(unconsumed(spark, landing, root, kind, pattern), f"landing-{kind}")
    paths = sorted(r["path"] for r in files.select("path").collect())
    if not paths:
        return latest_version(spark, root, table)
    run = _run_key(spark, root, table)
    version = ingest_bronze(spark, paths, root, kind, multi_line, **options)
    consumed(files, root, kind, run)
    return version


def ingest_listing(spark: SparkSession, landing: str, root: str, kind: str = "boards",
                   multi_line: bool = False) -> int:
    """Board or list listing (S7/S8): replaced as a whole on every run; rejects as in bronze.

    A folder may hold the listings of several days: of the records of one id
    the last landed one stays, so a renamed board or list has its new name alone.
    """
    if kind not in LISTINGS:
        raise ValueError("kind must be 'boards' or 'lists'")
    reader, table = LISTINGS[kind]
    run = _run_key(spark, root, table)
    staged = _staged(reader(spark, landing, multi_line, keep_corrupt=True, landed=True), root, kind, run)
    keep_rejects(staged, root, kind, run)
    good = latest_per_key(staged.where("NOT __bad").drop("__bad", CORRUPT), ["id"], newest_landed()).drop(*LANDED)
    version = write_snapshot(good, root, table, merge_schema=False)
    delete_parts(spark, root, f"staged_{kind}", [run])
    return version


def _board(spark: SparkSession, root: str, board: str | None, pick: str) -> DataFrame:
    boards = _require(spark, root, BOARDS)
    if board is None:
        return current_board(boards, pick)
    return boards.where(F.col("id") == F.lit(board)).select("id", "name")


def cards_of_board(cards: DataFrame, board: DataFrame, buckets: int) -> DataFrame:
    """Cards of the one-row ``board``, read from its bucket alone.

    The board is one row by construction (a global aggregate, or a look-up in
    a listing of one row an id), so it may be broadcast; its bucket then prunes
    the scan's folders while the query runs, and no value goes through the driver.
    """
    one = F.broadcast(board.select(F.col("id").alias("__of"), bucket_of(["id"], buckets).alias("__in")).where("__in >= 0"))
    return cards.join(one, (cards[BUCKET] == one["__in"]) & (cards["idBoard"] == one["__of"]), "left_semi").drop(BUCKET)


def refine_silver(spark: SparkSession, root: str, board: str | None = None,
                  board_pick: str = "latest", keep_unmatched: bool = False,
                  all_boards: bool = False, buckets: int | None = None) -> int:
    """Refine bronze cards and upsert them into silver.

    By default one board is refined: ``board``, or the current sprint board
    (``board_pick``).  ``all_boards=True`` refines every board in one pass,
    with names joined from the boards table.  ``buckets`` is as in
    :func:`ingest_bronze`; one board is read from its bucket of bronze alone.

    The names whose newest-card group this batch can change -- the batch's
    names and the previous names of its cards -- are logged in
    ``silver_changes`` with the new silver version, for the incremental
    :func:`build_unique`.
    """
    cut = bucket_count(spark, root, BRONZE_CARDS)
    cards = _require(spark, root, BRONZE_CARDS, keep_bucket=bool(cut) and not all_boards)
    members = _require(spark, root, BRONZE_MEMBERS)
    if all_boards:
        boards = _require(spark, root, BOARDS).select("id", "name")
        refined = refine_cards(cards, members, boards=boards, keep_unmatched=keep_unmatched)
    else:
        the_board = _board(spark, root, board, board_pick)
        if cut:
            cards = cards_of_board(cards, the_board, cut)
        refined = refine_cards(cards, members, board=the_board, keep_unmatched=keep_unmatched)
    return merge_refined(spark, root, refined, buckets)


def merge_refined(spark: SparkSession, root: str, refined: DataFrame, buckets: int | None = None) -> int:
    """Upsert refined cards into silver and log the names whose newest card they can change.

    A first version is merged as it is refined, still dealt out by id, and its
    names are those of the version; later batches are stored and read again.
    """
    previous, cut = read_table(spark, root, SILVER_CARDS), _buckets(spark, root, SILVER_CARDS, buckets)
    if previous is not None:
        refined = stored(refined, "refined")
    version = merge_into(spark, root, SILVER_CARDS, refined, ["id"], cluster_by=CLUSTER[SILVER_CARDS], buckets=cut,
                         is_stored=previous is not None)
    if previous is None:
        touched = read_table(spark, root, SILVER_CARDS).select("name")
    else:
        touched = refined.select("name").unionByName(previous.join(refined.select("id"), "id", "left_semi").select("name"))
    log = touched.distinct().withColumn("silver_version", F.lit(version).cast("long"))
    earlier = read_table(spark, root, SILVER_CHANGES)
    if earlier is not None:
        log = earlier.unionByName(log)
    write_snapshot(log, root, SILVER_CHANGES, merge_schema=False)
    return version


def _changed_names(spark: SparkSession, root: str, built_from: int, silver_version: int):
    """Names changed in silver versions ``(built_from, silver_version]``, or None
    when some version in that range has no change log (written by another job)."""
    changes = read_table(spark, root, SILVER_CHANGES)
    if changes is None:
        return None
    window = changes.where((F.col("silver_version") > built_from) &
                           (F.col("silver_version") <= silver_version))
    # One row: the log has every version in the range exactly if it has as many.
    if window.agg(F.count_distinct("silver_version")).first()[0] != silver_version - built_from:
        return None
    return window.select("name").distinct()


def build_unique(spark: SparkSession, root: str, incremental: bool = True) -> int:
    """Newest silver card per name.

    Incremental when possible: only the name groups logged by
    :func:`refine_silver` since the last build are recomputed, from silver
    rows found by a (null-safe) semi join, and the other rows of the
    previous table are kept by the matching anti join; AQE broadcasts the
    names when they measure small.  Otherwise (first build, or a silver version
    without a change log) the whole table is rebuilt with one shuffle by
    name.  Either way the result equals a full rebuild.
    """
    silver = _require(spark, root, SILVER_CARDS)
    silver_version = latest_version(spark, root, SILVER_CARDS)
    state = read_table(spark, root, SILVER_UNIQUE_STATE)
    previous = read_table(spark, root, SILVER_UNIQUE)
    changed = None
    if incremental and state is not None and previous is not None:
        built_from = state.first()["silver_version"]
        if built_from == silver_version:
            return latest_version(spark, root, SILVER_UNIQUE)
        if built_from < silver_version:
            changed = _changed_names(spark, root, built_from, silver_version)
    if changed is None:
        out = unique_cards(silver)
    else:
        names = changed.select(F.col("name").alias("__name"))
        same = F.col("name").eqNullSafe(F.col("__name"))
        recomputed = unique_cards(silver.join(names, same, "left_semi"))
        kept = previous.join(names, same, "left_anti")
        out = kept.unionByName(recomputed, allowMissingColumns=True)
    version = write_snapshot(out, root, SILVER_UNIQUE, cluster_by=CLUSTER[SILVER_UNIQUE])
    write_snapshot(spark.createDataFrame([(silver_version,)], "silver_version long"), root,
                   SILVER_UNIQUE_STATE, merge_schema=False)
    log = read_table(spark, root, SILVER_CHANGES)
    if log is not None:   # keep only entries the next build may still need
        write_snapshot(log.where(F.col("silver_version") > silver_version), root, SILVER_CHANGES,
                       merge_schema=False)
    return version


def gold_idle(spark: SparkSession, root: str, days: int, as_of: _dt.datetime | None = None,
              list_name: str = "doing", list_pick: str = "name", board: str | None = None,
              board_pick: str = "latest") -> int:
    """Cards in the board's chosen list idle for more than ``days`` days."""
    silver = _require(spark, root, SILVER_CARDS)
    lists = _require(spark, root, LISTS)
    the_board = _board(spark, root, board, board_pick).select(F.col("id").alias("idBoard"))
    chosen = list_lookup(lists, list_name, list_pick).join(the_board, "idBoard", "left_semi")
    return write_snapshot(idle_cards(silver, chosen, days, as_of), root, GOLD_IDLE)


def gold_member(spark: SparkSession, root: str, spec: MemberSpec,
                columns: Sequence[str] | None = None) -> int:
    """One member's cards in a date range, to ``gold_<report>``.

    ``columns`` defaults to the spec's own.
    """
    unique = _require(spark, root, SILVER_UNIQUE)
    out = member_activity(unique, spec.member, spec.start, spec.end, spec.match, spec.bounds,
                          columns or spec.columns, spec.date_format, spec.tz)
    return write_snapshot(out, root, f"gold_{spec.report}")


def gold_member_reports(spark: SparkSession, root: str, specs: Sequence[MemberSpec],
                        columns: Sequence[str] = GOLD_A) -> int:
    """Every member report from one scan, partitioned by report."""
    unique = _require(spark, root, SILVER_UNIQUE)
    out = member_activity_many(unique, specs, columns)
    return write_snapshot(out, root, GOLD_REPORTS, merge_schema=False, partition_by=["report"])


def gold_member_table(spark: SparkSession, root: str, members: DataFrame,
                      columns: Sequence[str] = GOLD_A) -> int:
    """G14 for members given as a table: every report, sorted by report over all files.

    A reader of one report skips the other files by their statistics.
    """
    unique = _require(spark, root, SILVER_UNIQUE)
    out = member_activity_table(unique, members, columns)
    return write_snapshot(out.repartitionByRange("report", columns[0]), root, GOLD_REPORTS, merge_schema=False,
                          cluster_by=["report", columns[0]])


def run_all(spark: SparkSession, landing_root: str, root: str, idle_days: int = 7,
            as_of: _dt.datetime | None = None, specs: Sequence[MemberSpec] = (),
            board_pick: str = "latest", list_name: str = "doing", list_pick: str = "name",
            keep_unmatched: bool = False, buckets: int | None = None) -> None:
    """Every layer once, in order.  ``landing_root`` holds ``cards/``,
    ``members/``, ``boards/`` and ``lists/`` subdirectories.  ``board_pick``
    holds for refining and for the idle cards alike, ``buckets`` for the card
    tables."""
    lr = landing_root.rstrip("/")
    ingest_listing(spark, f"{lr}/boards", root, "boards")
    ingest_listing(spark, f"{lr}/lists", root, "lists")
    ingest_bronze(spark, f"{lr}/members", root, "members")
    ingest_bronze(spark, f"{lr}/cards", root, "cards", buckets=buckets)
    refine_silver(spark, root, board_pick=board_pick, keep_unmatched=keep_unmatched, buckets=buckets)
    build_unique(spark, root)
    gold_idle(spark, root, idle_days, as_of, list_name, list_pick, board_pick=board_pick)
    if specs:
        gold_member_reports(spark, root, specs)
