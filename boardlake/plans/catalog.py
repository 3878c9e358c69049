"""Registered queries over the driver tables and their DuckDB oracles.

Each query runs one operator (or the whole pipeline) of the package on the
stand-in tables of :mod:`boardlake.plans.standins`, over whole tables.  The
oracle for the same key states the expected answer in plain SQL, written
from the semantics rather than from our plan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.dates import last_updated, range_filter
from boardlake.operators.activity import MemberSpec, idle_cards, member_activity, member_activity_many
from boardlake.operators.boards import current_board, dated_boards, list_lookup, with_board_name
from boardlake.operators.dedupe import latest_per_key, latest_per_key_agg
from boardlake.operators.member_table import member_activity_table
from boardlake.operators.members import attach_member_names, member_names, names_per_card
from boardlake.operators.refine import board_filter, refine_cards, unique_cards
from boardlake.operators.upsert import upsert
from boardlake.plans import standins as si
from boardlake.schemas import GOLD_A, GOLD_B, GOLD_C, MEMBERS_JSON
from boardlake.sources.landing import (cast_failures, parse_boards_column, parse_cards_column, parse_json_field, parse_lists_column,
                                       parse_members_column)
from boardlake.sources.scratch import stored
from boardlake.sources.tables import widen

# Parameters of the stand-in queries.
BOARD = "1-URGENT"
MEMBER = "Supplier#0000000"             # a substring that very many cards carry
LIKE_MEMBER = "Supplier#0000000_3"     # '_' is a wildcard under like
# Both days have cards at 00:00 and later, so the three bound variants differ.
ACT_START, ACT_END = "1999-11-14", "2001-05-15"
# Day-first text whose swapped form is a date too (5 September, 4 May).
DAYFIRST_START, DAYFIRST_END = "05-09-1999", "04-05-2001"
IDLE_AS_OF, IDLE_DAYS = _dt.datetime(1998, 1, 1), 30
# The whole pipeline: from before the stored cards end to the batch's last ones.
E2E_START, E2E_END = "1997-06-01", "2000-12-31"
UPSERT_TARGET_BEFORE = "1998-01-01"
UPSERT_SOURCE_FROM = "1997-01-01"

# The thirteen member reports of the reference, one spec each (matching,
# bounds and date-argument style as in the reference; members are stand-ins).
REPORT_SPECS = [
    MemberSpec("r01", "Supplier#000000001", "01-01-1996", "31-12-1999", "like", "closed_ts", "%d-%m-%Y"),
    MemberSpec("r02", "Supplier#000000002", ACT_START, ACT_END, "like", "closed_date"),
    MemberSpec("r03", "Supplier#000000003", ACT_START, ACT_END, "contains", "closed_ts"),
    MemberSpec("r04", "Supplier#000000004", ACT_START, ACT_END, "contains", "closed_ts"),
    MemberSpec("r05", "Supplier#000000005", ACT_START, ACT_END, "contains", "closed_ts"),
    MemberSpec("r06", "Supplier#000000006", ACT_START, ACT_END, "like", "closed_ts"),
    MemberSpec("r07", "Supplier#000000007", ACT_START, ACT_END, "contains", "closed_date"),
    MemberSpec("r08", "Supplier#000000008", ACT_START, ACT_END, "contains", "closed_ts"),
    MemberSpec("r09", "Supplier#000000009", ACT_START, ACT_END, "contains", "closed_ts"),
    MemberSpec("r10", "Supplier#00000000_", ACT_START, ACT_END, "like", "closed_date"),
    MemberSpec("r11", "Supplier#000000001", ACT_START, ACT_END, "contains", "closed_ts"),
    MemberSpec("r12", "Supplier#000000002", None, None, "contains", "closed_ts"),
    MemberSpec("r13", "Supplier#000000003", ACT_START, ACT_END, "like", "open_ts"),
]


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------- queries

def _card_texts(spark: SparkSession, d: str) -> DataFrame:
    o = si.table(spark, d, "orders")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    status = F.col("o_orderstatus")
    payload = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        (status == "F").alias("closed"),
        F.date_format("o_orderdate", iso).alias("dateLastActivity"),
        F.when(status == "P", F.lit("garbage"))
         .otherwise(F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), iso)).alias("due"),
        F.col("o_orderpriority").alias("idBoard"),
        F.concat(F.col("o_orderpriority"), F.lit("/"), status).alias("idList"),
        F.col("o_custkey").cast("string").alias("name"),
        F.concat(F.lit("order \"\n"), "o_orderkey").alias("desc"),
        F.array(F.col("o_custkey").cast("string"), F.lit("x")).alias("idMembers"),
        F.hex("o_orderkey").alias("shortLink"),
        F.concat(F.lit("https://b.example/"), F.hex("o_orderkey")).alias("shortUrl"),
        F.when(status != "F", F.concat(F.lit("https://b.example/c/"), F.hex("o_orderkey"))).alias("url"),
    ))
    return o.select(payload.alias("value"))


def q_bronze_cast_failures(spark, d):
    """Every text that could not be read, with its row's id and its field."""
    return cast_failures(parse_cards_column(_card_texts(spark, d), "value", failures=True))


def q_bronze_cards_json(spark: SparkSession, d: str) -> DataFrame:
    """Card JSON text -> typed bronze rows; bad timestamp text -> null."""
    cards = parse_cards_column(_card_texts(spark, d), "value")
    return cards.select("id", "closed",
                        F.col("dateLastActivity").cast("timestamp_ntz").alias("dateLastActivity"),
                        F.col("due").cast("timestamp_ntz").alias("due"),
                        "idBoard", "idList", "name", "desc", F.array_join("idMembers", ",").alias("idMembers"),
                        "shortLink", "shortUrl", "url")


def q_bronze_members_json(spark, d):
    """Member JSON text -> the nine bronze member columns."""
    s = si.table(spark, d, "supplier")
    user = F.lower(F.regexp_replace("s_name", "#", "_"))
    payload = F.to_json(F.struct(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("fullName"),
        F.concat(F.lit("S"), F.right("s_name", F.lit(3))).alias("initials"),
        F.when(F.col("s_acctbal") < 0, "virtual").otherwise("normal").alias("memberType"),
        F.concat(F.lit("https://board.example/"), user).alias("url"),
        user.alias("username"),
        F.lit("active").alias("status"),
        F.when(F.col("s_acctbal") > 5000, F.concat(user, F.lit("@example.org"))).alias("email"),
        F.array(F.col("s_nationkey").cast("string")).alias("idOrganizations"),
        F.lit(1).alias("ignoredKey"),
    ))
    m = parse_members_column(s.select(payload.alias("value")), "value")
    return m.select(*[c for c in m.columns if c != "idOrganizations"],
                    F.element_at("idOrganizations", 1).alias("idOrganization"))


def q_json_parse(spark, d):
    """S3: parse a JSON text column with a declared schema."""
    e = si.table(spark, d, "events")
    return e.select("event_id", parse_json_field("props", "k bigint")["k"].alias("k"))


def q_project_cards(spark, d):
    """The card projection."""
    return si.cards(spark, d)


def q_board_filter(spark, d):
    """cards of one board."""
    return board_filter(si.cards(spark, d), BOARD)


def _names(spark, d):
    return names_per_card(si.memberships(spark, d), si.members(spark, d),
                          pair_card="card_id", pair_member="member_id")


def q_member_names(spark, d):
    """J1 + A1: sorted member names per card; cards without a known member drop."""
    return attach_member_names(si.cards(spark, d), _names(spark, d)).select("id", "card_members")


def q_member_names_keep(spark, d):
    """As member_names, keeping unmatched cards with ''."""
    return (attach_member_names(si.cards(spark, d), _names(spark, d), keep_unmatched=True)
            .select("id", "card_members"))


def q_last_updated(spark, d):
    """Dd-MM-yyyy display date."""
    return si.table(spark, d, "events").select("event_id", last_updated("ts").alias("LastUpdated"))


def q_with_board_name(spark, d):
    """Board name by id."""
    return with_board_name(si.cards(spark, d), boards=si.boards(spark, d)).select("id", "board_name")


def q_silver_cards(spark, d):
    """One board refined to silver."""
    return si.silver(spark, d, board=BOARD)


def q_silver_cards_keep(spark, d):
    """J2 in silver: unmatched cards kept with empty card_members."""
    return si.silver(spark, d, board=BOARD, keep_unmatched=True)


def q_silver_upsert(spark, d):
    """R3's MERGE: today's refined board upserted into yesterday's silver."""
    # The stored table is a stand-in too: all boards, as far as they were known yesterday.
    yesterday = si.silver(spark, d).where(F.col("dateLastActivity") < _ntz(UPSERT_TARGET_BEFORE))
    today = refine_cards(si.cards(spark, d), si.members(spark, d), board=BOARD, board_name=f"Board {BOARD}",
                         keep_unmatched=True, pairs=si.memberships(spark, d))
    return upsert(yesterday, today, ["id"], keys_not_null=True)


def q_silver_current_board(spark, d):
    """R3 as the reference runs it: the current sprint board is resolved from
    dated board names, then only its cards are refined, named after it."""
    board = current_board(si.dated_priority_boards(spark, d), "latest")
    return refine_cards(si.cards(spark, d), si.members(spark, d), board=board,
                        pairs=si.memberships(spark, d))


def q_unique_cards(spark, d):
    """Newest silver card per name."""
    return si.unique(spark, d)


def q_dedupe_latest(spark, d):
    """W1 on a base table: newest order per customer, ties on the greater key."""
    o = si.table(spark, d, "orders")
    return latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


def q_dedupe_latest_agg(spark, d):
    """The same rows with an aggregate (max_by) plan."""
    o = si.table(spark, d, "orders")
    return latest_per_key_agg(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def _upsert_source(c: DataFrame) -> DataFrame:
    return (c.where(F.col("dateLastActivity") >= _ntz(UPSERT_SOURCE_FROM))
            .select("id", (~F.col("closed")).alias("closed"), "dateLastActivity",
                    F.when(F.col("idList").endswith("/O"), F.lit(None).cast("string"))
                     .otherwise(F.col("idBoard")).alias("idBoard"),
                    F.concat(F.col("idBoard"), F.lit("/moved")).alias("idList"), "name"))


def q_upsert(spark, d):
    """Matched rows take the source (nulls too), new keys insert, others stay."""
    c = si.cards(spark, d)
    target = c.where(F.col("dateLastActivity") < _ntz(UPSERT_TARGET_BEFORE))
    return upsert(target, _upsert_source(c), ["id"], keys_not_null=True)


def q_upsert_small_batch(spark, d):
    """U1 with the ``stream_target`` plan (a batch merged into a large table):
    where the session has a checkpoint folder, the batch is stored there and
    the target is streamed, not shuffled.  Same rows as ``upsert``."""
    c = si.cards(spark, d)
    target = c.where(F.col("dateLastActivity") < _ntz(UPSERT_TARGET_BEFORE))
    return upsert(target, _upsert_source(c), ["id"], plan="stream_target", keys_not_null=True)


def q_upsert_evolve(spark, d):
    """A target-only column (price) and a source-only column (due)."""
    c = si.cards(spark, d, with_price=True)
    target = c.where(F.col("dateLastActivity") < _ntz(UPSERT_TARGET_BEFORE))
    source = _upsert_source(c).withColumn("due", F.col("dateLastActivity") + F.expr("INTERVAL 30 DAYS"))
    return upsert(target, source, ["id"], keys_not_null=True)


def q_upsert_latest(spark, d):
    """A source repeating keys; the newest row per key is merged."""
    li = si.table(spark, d, "lineitem")
    source = li.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("dateLastActivity"),
                       F.concat(F.lit("L/"), F.col("l_linestatus")).alias("idList"),
                       F.col("l_linenumber").alias("lastLine"))
    # Line numbers repeat within an order in the driver data, so the order
    # ends with idList: rows still tied then agree in every output column.
    return upsert(si.cards(spark, d), source, ["id"],
                  order_by=[F.col("dateLastActivity").desc(), F.col("lastLine").desc(),
                            F.col("idList").desc()], keys_not_null=True)


def q_overwrite_widen(spark, d):
    """Overwrite with mergeSchema keeps a column the new data lacks."""
    old = si.cards(spark, d)
    new = si.cards(spark, d, with_price=True).drop("closed")
    return widen(new, old.schema)


def q_overwrite_widen_types(spark, d):
    """An int column becomes long, a decimal gets more digits, and a struct a field and a wider one."""
    o = si.table(spark, d, "orders")
    old = o.select(F.col("o_orderkey").cast("int").alias("id"), F.col("o_totalprice").cast("decimal(12,1)").alias("price"),
                   F.struct(F.col("o_custkey").cast("int").alias("customer"), F.col("o_orderstatus").alias("status")).alias("badge"))
    new = o.select(F.col("o_orderkey").cast("long").alias("id"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
                   F.when(F.col("o_orderkey") % 3 != 0, F.struct(
                       (F.col("o_custkey").cast("long") + (1 << 40)).alias("customer"), F.col("o_orderpriority").alias("priority"))).alias("badge"))
    # What the table would hold: the rows before, read under the new schema, and the new ones.
    schema = widen(new, old.schema).schema
    rows = widen(new, old.schema).unionByName(widen(old, schema))
    return rows.select("id", F.col("price").cast("double").alias("price"), F.col("badge.customer").alias("customer"),
                       F.col("badge.status").alias("status"), F.col("badge.priority").alias("priority"), F.col("badge").isNull().alias("unmarked"))


def q_board_date(spark, d):
    """Sprint date parsed from board names in five spellings."""
    return dated_boards(si.sprint_boards(spark, d)).select("id", "board_date")


def q_current_board(spark, d):
    """The board with the latest sprint date."""
    return current_board(si.sprint_boards(spark, d), "latest").select("id", "board_date")


def q_current_board_last_listed(spark, d):
    """B7 (reference behaviour): the dated board listed last."""
    return current_board(si.sprint_boards(spark, d), "last_listed").select("id", "board_date")


def q_list_lookup(spark, d):
    """The 'doing' list of every board, by name."""
    return list_lookup(si.lists(spark, d), "doing", "name")


def q_list_lookup_first(spark, d):
    """J4 (reference behaviour): the first list of every board."""
    return list_lookup(si.lists(spark, d), pick="first")


def q_idle_cards(spark, d):
    """Cards in the board's doing list idle for more than N days."""
    doing = list_lookup(si.lists(spark, d), "doing", "name").where(F.col("idBoard") == BOARD)
    return idle_cards(si.silver(spark, d), doing, IDLE_DAYS, as_of=IDLE_AS_OF)


def q_idle_cards_first_list(spark, d):
    """G0 with the reference's list pick (the board's first list)."""
    first = list_lookup(si.lists(spark, d), pick="first").where(F.col("idBoard") == BOARD)
    return idle_cards(si.silver(spark, d), first, IDLE_DAYS, as_of=IDLE_AS_OF)


def q_activity_contains(spark, d):
    """G3-type: contains, closed timestamp bounds, column order A."""
    return member_activity(si.unique(spark, d), MEMBER, ACT_START, ACT_END, "contains", "closed_ts", GOLD_A)


def q_activity_like(spark, d):
    """G2-type: like (wildcards), closed date bounds, column order B."""
    return member_activity(si.unique(spark, d), LIKE_MEMBER, ACT_START, ACT_END, "like", "closed_date", GOLD_B)


def q_activity_open_ts(spark, d):
    """G13-type: open timestamp bounds, column order B."""
    return member_activity(si.unique(spark, d), MEMBER, ACT_START, ACT_END, "like", "open_ts", GOLD_B)


def q_activity_closed_date(spark, d):
    """G7-type: contains, closed date bounds, column order C."""
    return member_activity(si.unique(spark, d), MEMBER, ACT_START, ACT_END, "contains", "closed_date", GOLD_C)


def q_activity_optional(spark, d):
    """G12-type: range applied only when both bounds are given (here one is)."""
    return member_activity(si.unique(spark, d), MEMBER, ACT_START, None, "contains", "closed_ts", GOLD_A)


def q_activity_dayfirst(spark, d):
    """G1-type: day-first date arguments."""
    return member_activity(si.unique(spark, d), MEMBER, DAYFIRST_START, DAYFIRST_END, "like", "closed_ts",
                           GOLD_A, date_format="%d-%m-%Y")


def _card_range(spark, d, bounds):
    c = si.cards(spark, d).select("id", "dateLastActivity")
    return range_filter(c, "dateLastActivity", ACT_START, ACT_END, bounds)


def q_range_closed_ts(spark, d):
    """F7 on time-of-day data: activity during the end day is outside."""
    return _card_range(spark, d, "closed_ts")


def q_range_open_ts(spark, d):
    """F8."""
    return _card_range(spark, d, "open_ts")


def q_range_closed_date(spark, d):
    """the whole end day is inside."""
    return _card_range(spark, d, "closed_date")


def q_activity_all_members(spark, d):
    """The thirteen member reports in one scan."""
    return member_activity_many(si.unique(spark, d), REPORT_SPECS, GOLD_A)


def member_rows(spark, d):
    """A report for every supplier and every customer: full names, parts of them, wildcards, texts of
    one to three characters and ones that no card holds, over ranges of all kinds."""
    s = si.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("full"))
    c = si.table(spark, d, "customer").select((-F.col("c_custkey")).alias("k"), F.concat(F.lit("Supplier#"), F.right("c_name", F.lit(9))).alias("full"))
    kind = F.pmod(F.col("k"), F.lit(10))
    member = (F.when(kind == 1, F.concat(F.lit("lier#%"), F.right("full", F.lit(4)))).when(kind == 2, F.concat(F.lit("#00000_"), F.right("full", F.lit(3))))
              .when(kind == 3, F.concat(F.right("full", F.lit(2)), F.lit(", "))).when((kind == 4) & (F.col("k") % 50 == 4), F.right("full", F.lit(2)))
              .when((kind == 5) & (F.col("k") % 250 == 5), F.right("full", F.lit(1))).when((F.col("k") == 7), F.lit("_%")).otherwise(F.col("full")))
    day = F.date_add(F.lit("1993-01-01").cast("date"), F.pmod(F.col("k") * 13, F.lit(1500)).cast("int"))
    return s.unionByName(c).select(
        F.concat(F.lit("r"), F.col("k")).alias("report"), member.alias("member"),
        F.when(kind.isin(1, 2, 7), "like").otherwise("contains").alias("match"),
        F.element_at(F.array(*[F.lit(b) for b in ("closed_ts", "open_ts", "closed_date")]), F.pmod("k", F.lit(3)).cast("int") + 1).alias("bounds"),
        day.alias("start"), F.when(F.pmod("k", F.lit(11)) != 0, F.date_add(day, 1200)).alias("end"))


def q_activity_member_table(spark, d):
    """The reports of a members table, joined to the cards by their rarest characters."""
    cards = stored(si.unique(spark, d), "unique-cards")
    return member_activity_table(cards, member_rows(spark, d), GOLD_A)


def q_range_tz(spark, d):
    """Activity shifted from UTC to a zone before the dates are compared."""
    c = si.cards(spark, d).select("id", "dateLastActivity")
    return range_filter(c, "dateLastActivity", ACT_START, ACT_END, "closed_date", tz="+07:00")


def q_member_names_array(spark, d):
    """J1 on real id arrays: repeated ids count once, unknown ones not at all."""
    return member_names(si.cards_with_members(spark, d), si.members(spark, d)).select("id", "card_members")


def q_bronze_members_latest(spark, d):
    """Of the records landed for one member id the last one wins."""
    li = si.table(spark, d, "lineitem")
    payload = F.to_json(F.struct(
        F.col("l_suppkey").cast("string").alias("id"),
        F.concat_ws("-", F.lit("Member"), "l_orderkey", "l_linenumber").alias("fullName")))
    landed = ["l_shipdate", "l_orderkey", "l_linenumber"]
    parsed = li.select(payload.alias("value"), *landed).select(
        F.struct(F.from_json("value", MEMBERS_JSON).alias("m"), *landed).alias("r"))
    rows = parsed.select("r.m.*", *[f"r.{c}" for c in landed])
    return latest_per_key(rows, ["id"], [F.col(c).desc() for c in landed]).select("id", "fullName")


def q_list_lookup_json(spark, d):
    """List JSON with fractional and missing positions; the first list of every board."""
    li = si.lists(spark, d)
    pos = F.when(F.col("name") != "Done", F.lit(1 << 47) + F.lit(4.5) - F.col("pos"))
    text = li.select(F.to_json(F.struct("id", "idBoard", "name", pos.alias("pos"))).alias("value"))
    return list_lookup(parse_lists_column(text, "value"), pick="first")


def q_current_board_json(spark, d):
    """Board JSON with large, fractional and missing positions; the dated board listed last."""
    b = si.sprint_boards(spark, d)
    pos = F.when(F.col("pos") % 3 != 0, F.lit(1 << 40) + F.col("pos") / 4)
    text = b.select(F.to_json(F.struct(F.col("id").cast("string").alias("id"), "name", pos.alias("pos"))).alias("value"))
    return current_board(parse_boards_column(text, "value"), "last_listed").select("id", "board_date")


def q_medallion_e2e(spark, d):
    """All layers: card and member JSON text -> typed bronze -> bronze upsert of
    a later batch -> silver of all boards, then of one board upserted into it
    -> newest card per name -> one member's gold table."""
    # Typed bronze is read three times, members twice: both are parsed once.
    landed = stored(parse_cards_column(si.cards_json(spark, d), "value"), "landed-cards")
    members = stored(parse_members_column(si.members_json(spark, d), "value"), "landed-members")
    boards = si.boards(spark, d)
    held = landed.where(F.col("dateLastActivity") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp"))
    batch = landed.where(F.col("dateLastActivity") >= F.lit(UPSERT_SOURCE_FROM).cast("timestamp")).withColumn(
        "name", F.when(F.col("closed"), F.concat("name", F.lit(" (closed)"))).otherwise(F.col("name")))
    bronze = upsert(held, batch, ["id"], keys_not_null=True)
    yesterday = refine_cards(held, members, boards=boards)
    today = refine_cards(bronze, members, board=BOARD, boards=boards)
    silver = upsert(yesterday, today, ["id"], keys_not_null=True)
    return member_activity(unique_cards(silver), MEMBER, E2E_START, E2E_END, "contains", "closed_ts", GOLD_A)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "medallion_e2e": q_medallion_e2e,
    "bronze_cards_json": q_bronze_cards_json,
    "bronze_cast_failures": q_bronze_cast_failures,
    "bronze_members_json": q_bronze_members_json,
    "json_parse": q_json_parse,
    "project_cards": q_project_cards,
    "board_filter": q_board_filter,
    "member_names": q_member_names,
    "member_names_keep": q_member_names_keep,
    "last_updated": q_last_updated,
    "with_board_name": q_with_board_name,
    "silver_cards": q_silver_cards,
    "silver_cards_keep": q_silver_cards_keep,
    "silver_upsert": q_silver_upsert,
    "silver_current_board": q_silver_current_board,
    "unique_cards": q_unique_cards,
    "dedupe_latest": q_dedupe_latest,
    "dedupe_latest_agg": q_dedupe_latest_agg,
    "upsert": q_upsert,
    "upsert_small_batch": q_upsert_small_batch,
    "upsert_evolve": q_upsert_evolve,
    "upsert_latest": q_upsert_latest,
    "overwrite_widen": q_overwrite_widen,
    "overwrite_widen_types": q_overwrite_widen_types,
    "board_date": q_board_date,
    "current_board": q_current_board,
    "current_board_last_listed": q_current_board_last_listed,
    "list_lookup": q_list_lookup,
    "list_lookup_first": q_list_lookup_first,
    "idle_cards": q_idle_cards,
    "idle_cards_first_list": q_idle_cards_first_list,
    "activity_contains": q_activity_contains,
    "activity_like": q_activity_like,
    "activity_open_ts": q_activity_open_ts,
    "activity_closed_date": q_activity_closed_date,
    "activity_optional": q_activity_optional,
    "activity_dayfirst": q_activity_dayfirst,
    "range_closed_ts": q_range_closed_ts,
    "range_open_ts": q_range_open_ts,
    "range_closed_date": q_range_closed_date,
    "range_tz": q_range_tz,
    "activity_all_members": q_activity_all_members,
    "activity_member_table": q_activity_member_table,
    "member_names_array": q_member_names_array,
    "bronze_members_latest": q_bronze_members_latest,
    "list_lookup_json": q_list_lookup_json,
    "current_board_json": q_current_board_json,
}
