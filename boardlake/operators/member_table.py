"""Member reports driven by a table of members (G14), by a join on rare q-grams.

The members are data: any number of them, none in the plan.  A member's text
matches a card if it is a substring of the joined names (``contains``) or its
literal runs are (``like``), so every piece of a run must be in the card too.
Of those the one in the fewest cards is the text's probe; the cards are cut
into their distinct pieces of the sizes in use and joined to the probes on
equality, and the pairs that meet are verified by the match itself.  A member
with a piece that no card holds drops out at once.

A run is cut into pieces of the greatest of SIZES that it is long enough for:
three characters of a number are in a share of all cards, so that pairs would
grow with cards times members, while sixteen are in few cards beside those that
match.  Runs shorter than Q count only if the text has no longer one, down to
the empty piece, which every card holds: a text of wildcards alone matches
nearly all cards, and its pairs are the result itself.

A text is met and verified once, however many members have it, and then joined
to their rows and date ranges.  Each text has one probe and each card holds a
piece once, so a pair meets once.  A popular piece is one key of many cards:
each side is broadcast if its measured rows and characters stay under
PROBE_BYTES, and otherwise AQE splits the skewed partition of the cards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType

from boardlake.functions.dates import BOUNDS, _as_timestamp, parse_bound
from boardlake.functions.text import MATCHES
from boardlake.operators.activity import MemberSpec
from boardlake.schemas import GOLD_A
from boardlake.sources.scratch import broadcast_if_small, stored

#: Characters of a piece; those that a run needs beside longer ones; bytes (ROW_BYTES a row and those of the texts) up to which probes are broadcast.
SIZES, Q, PROBE_BYTES, ROW_BYTES = (0, 1, 2, 3, 4, 8, 16), 3, 64 << 20, 300

MEMBER_TABLE = ("report string, member string, match string, bounds string, "
                "start timestamp, end timestamp, tz string")


def specs_table(spark: SparkSession, specs: Sequence[MemberSpec]) -> DataFrame:
    """The member table of ``specs``; text dates are read by each spec's format."""
    # Bounds travel as text: a Python time would be read in the driver's zone.
    rows = [(s.report, s.member, s.match, s.bounds, *[None if b is None else b.isoformat(sep=" ") for b in (
        parse_bound(s.start, s.date_format), parse_bound(s.end, s.date_format))], s.tz) for s in specs]
    text = spark.createDataFrame(rows, "report string, member string, match string, bounds string, start string, end string, tz string")
    return text.withColumns({c: F.col(c).cast("timestamp") for c in ("start", "end")})


def _one_of(column: Column, allowed: Sequence[str], what: str) -> Column:
    failure = F.raise_error(F.concat(F.lit(f"{what} must be one of {', '.join(allowed)}, got "), column))
    return F.when(column.isin(*allowed), column).otherwise(failure.cast("string"))


def _member_rows(members: DataFrame, ntz: bool) -> DataFrame:
    """(report, member, match, bounds, lo, hi, tz); a missing bound leaves both null."""
    have = set(members.columns)

    def given(name: str, default: str | None) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in have else F.lit(default).cast("string")

    def bound(name: str) -> Column:
        if name not in have:
            return F.lit(None).cast("timestamp")
        if isinstance(members.schema[name].dataType, StringType):
            return F.call_function("to_timestamp", F.col(name), F.col("date_format") if "date_format" in have else F.lit("yyyy-MM-dd"))
        return F.col(name).cast("timestamp")

    kind = "timestamp_ntz" if ntz else "timestamp"
    bounds = _one_of(given("bounds", "closed_ts"), BOUNDS, "bounds")
    whole_days = bounds == "closed_date"
    start, end = bound("start"), bound("end")
    both = start.isNotNull() & end.isNotNull()
    lo = F.when(whole_days, F.date_trunc("day", start)).otherwise(start)
    hi = F.when(whole_days, F.date_trunc("day", end) + F.make_interval(days=F.lit(1))).otherwise(end)
    return members.where(F.col("member").isNotNull()).select(
        F.col("report"), F.col("member"), _one_of(given("match", "contains"), MATCHES, "match").alias("match"), bounds.alias("bounds"),
        F.when(both, lo).cast(kind).alias("lo"), F.when(both, hi).cast(kind).alias("hi"), given("tz", None).alias("tz"))


def _pieces(text: Column, size: Column) -> Column:
    """All substrings of ``size`` characters; none of a shorter text."""
    return F.when(F.length(text) < size, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size)))


def _size_of(run: Column) -> Column:
    """The greatest of SIZES up to the length of ``run``."""
    size = F.lit(SIZES[0])
    for n in SIZES[1:]:
        size = F.when(F.length(run) >= n, F.lit(n)).otherwise(size)
    return size


def member_pieces(rows: DataFrame) -> DataFrame:
    """(member, match, piece) of each distinct member text: pieces that a matching card must hold."""
    # A backslash is LIKE's escape; cutting there too leaves runs that are surely literal.
    runs = F.when(F.col("match") == "like", F.split("member", r"[_%\\]")).otherwise(F.array("member"))
    found = rows.select("member", "match").distinct().withColumn("runs", runs)
    longest = F.array_max(F.transform("runs", F.length))
    used = F.filter("runs", lambda r: F.length(r) >= F.least(F.lit(Q), longest))
    pieces = F.array_distinct(F.flatten(F.transform(used, lambda r: _pieces(r, _size_of(r)))))
    return found.select("member", "match", F.explode(pieces).alias("piece"))


def card_pieces(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct pieces of the given sizes; null for a null text."""
    return F.array_distinct(F.concat(*[_pieces(text, F.lit(n)) if n else F.array(F.lit("")) for n in sizes]))


def rarest_pieces(pieces: DataFrame, cards: DataFrame, members_col: str, sizes: Sequence[int]) -> DataFrame:
    """(member, match, piece): each member's piece in the fewest cards; none if a piece is in no card."""
    held = cards.where(F.col(members_col).isNotNull()).select(F.explode(card_pieces(F.col(members_col), sizes)).alias("piece"))
    counts = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    each = pieces.join(counts, "piece", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = each.groupBy("member", "match").agg(F.min(F.struct("n", "piece")).alias("b"))
    return best.where("b.n > 0").select("member", "match", F.col("b.piece").alias("piece"))


def met_cards(cards: DataFrame, texts: DataFrame, wanted: Sequence[str], members_col: str, sizes: Sequence[int]) -> DataFrame:
    """The ``wanted`` columns of each card beside each text whose piece it holds."""
    cut = cards.where(F.col(members_col).isNotNull()).select(
        *wanted, F.explode(card_pieces(F.col(members_col), sizes)).alias("__card_piece"))
    return cut.join(texts, F.col("__card_piece") == F.col("__piece")).drop("__card_piece", "__piece")


def member_activity_table(cards: DataFrame, members: DataFrame, columns: Sequence[str] = GOLD_A,
                          members_col: str = "card_members", date_col: str = "dateLastActivity",
                          probe_bytes: int = PROBE_BYTES) -> DataFrame:
    """The reports of all rows of ``members``: (report, member, *columns).

    ``members`` has ``report`` and ``member`` and may have ``match``
    (contains), ``bounds`` (closed_ts), ``start`` and ``end`` (dates,
    timestamps, or text read by ``date_format``, yyyy-MM-dd if absent) and
    ``tz``, with the meaning they have in :func:`member_activity`.  A row
    without a member matches nothing; repeated rows give repeated reports;
    an unknown ``match`` or ``bounds`` fails the job.  Cards whose names are
    null match nothing.

    ``cards`` is read twice (to count pieces and to join), so give a table.
    """
    dtype = cards.schema[date_col].dataType
    rows = _member_rows(members, isinstance(dtype, TimestampNTZType))
    pieces = stored(member_pieces(rows), "member-pieces")
    sizes = sorted(r[0] for r in pieces.select(F.length("piece")).distinct().collect())  # a few of SIZES
    chosen = stored(rarest_pieces(pieces, cards, members_col, sizes or [0]), "member-probes")
    texts = chosen.select(*[F.col(c).alias(f"__{c}") for c in ("member", "match", "piece")])
    probes = rows.join(chosen.select("member", "match"), ["member", "match"])

    wanted = list(dict.fromkeys([*columns, members_col, date_col]))
    met = met_cards(cards, broadcast_if_small(texts, ["__member"], probe_bytes, ROW_BYTES), wanted, members_col, sizes or [0])
    text, member = F.col(members_col), F.col("__member")
    matches = F.when(F.col("__match") == "contains", F.contains(text, member)).otherwise(
        F.like(text, F.concat(F.lit("%"), member, F.lit("%"))))
    # Named anew, so that the join below compares the members' columns to the cards'.
    reports = broadcast_if_small(probes.select(*[F.col(c).alias(f"__{c}_of" if c in ("member", "match") else f"__{c}") for c in rows.columns]),
                                 ["__member_of", "__report"], probe_bytes, ROW_BYTES)
    met = met.where(matches).join(reports, (member == F.col("__member_of")) & (F.col("__match") == F.col("__match_of")))
    ts = _as_timestamp(dtype, date_col)
    moved = F.from_utc_timestamp(ts, F.col("__tz"))
    ts = F.when(F.col("__tz").isNull(), ts).otherwise(moved.cast("timestamp_ntz") if isinstance(dtype, TimestampNTZType) else moved)
    lo, hi, bounds = F.col("__lo"), F.col("__hi"), F.col("__bounds")
    inside = ((ts > lo) | ((bounds != "open_ts") & (ts == lo))) & ((ts < hi) | ((bounds == "closed_ts") & (ts == hi)))
    return met.where(lo.isNull() | inside).select(
        F.col("__report").alias("report"), member.alias("member"), *[F.col(c) for c in columns])
