"""The jobs themselves as queries: landing files in the shared folder, snapshots written, read back.

Each query lands the stand-in records as JSON files of two days, runs the
jobs that lead to its table, and returns that table.  On the second day the
closed cards come again, renamed, a day later or (every other one) earlier, and
some on another board; members in debt change their names; and the listings
name boards and lists that had other names the day before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.operators.activity import MemberSpec, idle_cards
from boardlake.operators.boards import list_lookup
from boardlake.operators.member_table import specs_table
from boardlake.plans import catalog as c
from boardlake.plans import pipeline as P
from boardlake.plans import standins as si
from boardlake.plans.incremental import refine_changes
from boardlake.sources.drift import drift_report, promote
from boardlake.sources.scratch import scratch_path, stored
from boardlake.sources.tables import prune_versions, read_table, write_snapshot
from boardlake.sources.zorder import optimize
from boardlake.streaming.idle import RECORD, idle_now, log_idle
from boardlake.streaming.ingest import compact_changes, stream_cards

#: Buckets of the card tables.
BUCKETS = 16
MOVED_TO = "2-HIGH"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
CARD = ["id", "closed", "dateLastActivity", "idBoard", "idList", "name"]


def second_day(cards: DataFrame) -> DataFrame:
    """The closed cards as they land on the second day."""
    k = F.col("id").cast("long")
    days = F.make_interval(days=F.when(k % 2 == 0, 1).otherwise(-1))
    return cards.where("closed").withColumns({
        "name": F.concat("name", F.lit(" (closed)")), "dateLastActivity": F.col("dateLastActivity") + days,
        "idBoard": F.when(k % 7 == 0, MOVED_TO).otherwise(F.col("idBoard"))})


def _json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").option("compression", "gzip").text(path)


def land_cards(cards: DataFrame, path: str) -> None:
    _json(cards.select(*[F.date_format("dateLastActivity", ISO).alias(x) if x == "dateLastActivity" else F.col(x) for x in cards.columns]), path)


def cards_of_days(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Cards with text ids and members, as landed on the first day and on the second."""
    first = stored(si.cards_with_members(spark, d).select(
        F.col("id").cast("string").alias("id"), "closed", "dateLastActivity", "idBoard", "idList", "name",
        F.transform("idMembers", lambda m: m.cast("string")).alias("idMembers")), "cards-of-days")
    return first, second_day(first)


def members_of_day(spark: SparkSession, d: str, day: int) -> DataFrame:
    s = si.table(spark, d, "supplier")
    name = F.col("s_name") if day == 1 else F.when(F.col("s_acctbal") < 0, F.concat("s_name", F.lit(" jr"))).otherwise(F.col("s_name"))
    return s.select(F.col("s_suppkey").cast("string").alias("id"), name.alias("fullName"))


def land_listings(spark: SparkSession, d: str, root: str) -> None:
    """Boards and lists of two days in one folder; on the first day they had other names."""
    boards, lists = si.dated_priority_boards(spark, d), si.lists(spark, d)
    _json(boards.withColumn("name", F.lit("Sprint (1-Jan-2099)")), f"{root}/land/boards")
    _json(lists.withColumn("name", F.lit("doing")), f"{root}/land/lists")
    _json(boards, f"{root}/land/boards")
    _json(lists, f"{root}/land/lists")
    P.ingest_listing(spark, f"{root}/land/boards", root, "boards")
    P.ingest_listing(spark, f"{root}/land/lists", root, "lists")


def land_members(spark: SparkSession, d: str, root: str, day: int) -> None:
    _json(members_of_day(spark, d, day), f"{root}/land/members-{day}")
    P.ingest_bronze(spark, f"{root}/land/members-{day}", root, "members")


def ingest_cards(spark: SparkSession, cards: DataFrame, root: str, day: int) -> None:
    land_cards(cards, f"{root}/land/cards-{day}")
    P.ingest_bronze(spark, f"{root}/land/cards-{day}", root, "cards", buckets=BUCKETS)


def silver_lake(spark: SparkSession, d: str) -> str:
    """Root of a lake whose silver holds all boards of the first day, and the current one of the second."""
    root = scratch_path(spark, "lake")
    first, second = cards_of_days(spark, d)
    land_listings(spark, d, root)
    land_members(spark, d, root, 1)
    ingest_cards(spark, first, root, 1)
    P.refine_silver(spark, root, all_boards=True, buckets=BUCKETS)
    P.build_unique(spark, root)
    land_members(spark, d, root, 2)
    ingest_cards(spark, second, root, 2)
    P.refine_silver(spark, root)
    return root


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(x).cast("timestamp_ntz").alias(x) if x == "dateLastActivity" else F.col(x) for x in columns])


def q_job_bronze_cards(spark, d):
    """Two days of card files upserted into bucketed bronze."""
    root = scratch_path(spark, "lake")
    first, second = (x.drop("idMembers") for x in cards_of_days(spark, d))
    ingest_cards(spark, first, root, 1)
    ingest_cards(spark, second, root, 2)
    return _plain(read_table(spark, root, P.BRONZE_CARDS), *CARD)


def q_job_ingest_new(spark, d):
    """One folder that grows, taken in twice; the second run reads the second day's files alone."""
    root = scratch_path(spark, "lake")
    for cards in cards_of_days(spark, d):
        land_cards(cards.drop("idMembers"), f"{root}/land/cards")
        P.ingest_new(spark, f"{root}/land/cards", root, "cards", pattern="part-*", buckets=BUCKETS)
    P.ingest_new(spark, f"{root}/land/cards", root, "cards", pattern="part-*")
    return _plain(read_table(spark, root, P.BRONZE_CARDS), *CARD)


def _drifted(spark, d) -> str:
    """Root of a lake whose card files hold keys that no schema declares, of two types on the two days."""
    root, price = scratch_path(spark, "lake"), F.col("o_totalprice")
    cards = si.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("name"),
        F.when(F.col("o_orderkey") % 3 == 0, F.floor(price)).alias("price"),
        F.when(F.col("o_orderstatus") == "O", F.struct(F.col("o_orderpriority").alias("rank"), F.col("o_custkey").alias("who"))).alias("cover"))
    _json(cards, f"{root}/land/cards-1")
    _json(cards.where("id % 6 = 0").withColumn("price", F.col("price").cast("string")), f"{root}/land/cards-2")
    for day in (1, 2):
        P.ingest_bronze(spark, f"{root}/land/cards-{day}", root, "cards", buckets=BUCKETS, extras=True)
    return root


def q_job_extras(spark, d):
    """Keys new upstream, promoted to columns from bronze; numbers that came as text are cast."""
    bronze = read_table(spark, _drifted(spark, d), P.BRONZE_CARDS)
    rows = promote(promote(bronze, "price", "long"), "cover", "string", "$.rank", "rank")
    return promote(rows, "cover", "int", "$.who", "who").select("id", "name", "price", "rank", "who")


def q_job_drift_report(spark, d):
    """S3: the unknown keys of all card records, how many have them and of which type."""
    return drift_report(read_table(spark, _drifted(spark, d), P.BRONZE_CARDS))


def q_job_bronze_members(spark, d):
    """Two days of member files."""
    root = scratch_path(spark, "lake")
    land_members(spark, d, root, 1)
    land_members(spark, d, root, 2)
    return read_table(spark, root, P.BRONZE_MEMBERS).select("id", "fullName")


def q_job_boards(spark, d):
    """The listings of two days in one folder; each board has its last name."""
    root = scratch_path(spark, "lake")
    land_listings(spark, d, root)
    return read_table(spark, root, P.BOARDS)


def q_job_lists(spark, d):
    """As S7 for lists; an old name of a list matches no more."""
    root = scratch_path(spark, "lake")
    land_listings(spark, d, root)
    return read_table(spark, root, P.LISTS)


def q_job_silver(spark, d):
    """All boards refined, then the current board alone after a second day of cards and members."""
    return _plain(read_table(spark, silver_lake(spark, d), P.SILVER_CARDS), *CARD, "card_members", "LastUpdated", "board_name")


def q_job_refine_changes(spark, d):
    """R3, incrementally: all boards of two days, the second by its changed cards, members and boards alone."""
    root = scratch_path(spark, "lake")
    first, second = cards_of_days(spark, d)
    land_listings(spark, d, root)
    land_members(spark, d, root, 1)
    ingest_cards(spark, first, root, 1)
    refine_changes(spark, root, buckets=BUCKETS)
    land_members(spark, d, root, 2)
    ingest_cards(spark, second, root, 2)
    refine_changes(spark, root)
    return _plain(read_table(spark, root, P.SILVER_CARDS), *CARD, "card_members", "LastUpdated", "board_name")


def q_job_unique(spark, d):
    """Newest card per name, recomputed for the names that the second day touched."""
    root = silver_lake(spark, d)
    P.build_unique(spark, root)
    return _plain(read_table(spark, root, P.SILVER_UNIQUE), *CARD, "card_members", "LastUpdated", "board_name")


def q_job_gold_idle(spark, d):
    """Idle cards in the current board's doing list."""
    root = silver_lake(spark, d)
    P.gold_idle(spark, root, c.IDLE_DAYS, c.IDLE_AS_OF)
    return read_table(spark, root, P.GOLD_IDLE)


def q_job_gold_member(spark, d):
    """One member's gold table."""
    root = silver_lake(spark, d)
    P.build_unique(spark, root)
    P.gold_member(spark, root, MemberSpec("one", c.MEMBER, c.ACT_START, c.ACT_END, "contains", "closed_date"))
    return read_table(spark, root, "gold_one")


def q_job_member_reports(spark, d):
    """The thirteen reports from a members table, sorted by report."""
    root = silver_lake(spark, d)
    P.build_unique(spark, root)
    P.gold_member_table(spark, root, specs_table(spark, c.REPORT_SPECS))
    return read_table(spark, root, P.GOLD_REPORTS)


def q_job_overwrite(spark, d):
    """A snapshot overwritten by one with another column and without one of its own, then pruned."""
    root = scratch_path(spark, "lake")
    write_snapshot(si.cards(spark, d), root, "t")
    write_snapshot(si.cards(spark, d, with_price=True).where("NOT closed").drop("closed"), root, "t")
    prune_versions(spark, root, "t", keep=1)
    return read_table(spark, root, "t")


def q_job_zorder(spark, d):
    """Silver in Z-order of list and date, and the idle cards of every doing list read from it."""
    root = scratch_path(spark, "lake")
    write_snapshot(si.silver(spark, d), root, P.SILVER_CARDS, cluster_by=P.CLUSTER[P.SILVER_CARDS])
    optimize(spark, root, P.SILVER_CARDS, ["idList", "dateLastActivity"])
    return idle_cards(read_table(spark, root, P.SILVER_CARDS), list_lookup(si.lists(spark, d), "doing"), c.IDLE_DAYS, c.IDLE_AS_OF)


def q_job_stream(spark, d):
    """ST1: two days of card files through the stream's change log; an older card does not replace a newer one."""
    root = scratch_path(spark, "lake")
    first, second = (x.drop("idMembers") for x in cards_of_days(spark, d))
    for cards in (first, second):
        land_cards(cards, f"{root}/land/cards")
        stream_cards(spark, f"{root}/land/cards", root, checkpoint=f"{root}/checkpoint", available_now=True).awaitTermination()
        compact_changes(spark, root)
    return _plain(read_table(spark, root, P.BRONZE_CARDS), *CARD)


def q_job_idle_stream(spark, d):
    """ST1, G0 with state: cards idle when the last record landed; a record lands up to 20 days after its activity."""
    root, (first, second) = scratch_path(spark, "lake"), cards_of_days(spark, d)
    for n, cards in enumerate((first, second)):
        days = F.make_interval(days=F.pmod(F.col("id").cast("long"), F.lit(20)).cast("int") + n)
        cards.select("id", "name", "idBoard", "idList", F.col("dateLastActivity").cast("timestamp").alias("activity"),
                     (F.col("dateLastActivity") + days).cast("timestamp").alias("landed"), F.lit(f"file-{n}").alias("file")
                     ).write.parquet(f"{root}/land/records/day={n}")
    records = spark.readStream.schema(RECORD).parquet(f"{root}/land/records/day=*")
    log_idle(records, root, c.IDLE_DAYS, checkpoint=f"{root}/checkpoint").awaitTermination()
    return _plain(idle_now(spark, root), "id", "name", "idBoard", "idList", "dateLastActivity")


QUERIES = {f"job_{name}": globals()[f"q_job_{name}"] for name in (
    "bronze_cards", "ingest_new", "extras", "drift_report", "bronze_members", "boards", "lists", "silver", "refine_changes", "unique", "gold_idle", "gold_member", "member_reports",
    "overwrite", "zorder", "stream", "idle_stream")}
