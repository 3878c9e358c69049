"""boardlake: a Spark-native medallion pipeline for task-board data.

Raw card, member, board and list records land as JSON; they are upserted
into keyed bronze tables, refined into silver tables (member names
resolved from id arrays, formatted dates, board names, newest card per
name) and summarised into gold tables (idle cards in a list, cards a
member worked on in a date range).

Every operator is a ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions, so Catalyst sees the whole plan.
"""

from boardlake.operators.activity import MemberSpec, idle_cards, member_activity, member_activity_many
from boardlake.operators.boards import current_board, dated_boards, list_lookup, with_board_name
from boardlake.operators.dedupe import latest_per_key, latest_per_key_agg
from boardlake.operators.member_table import member_activity_table, specs_table
from boardlake.operators.members import member_names, member_names_from_pairs
from boardlake.operators.refine import board_filter, refine_cards, unique_cards
from boardlake.operators.upsert import upsert
from boardlake.session import build_session, checkpoint_root
from boardlake.sources.drift import drift_report, promote
from boardlake.sources.landing import read_boards, read_cards, read_lists, read_members
from boardlake.sources.tables import merge_into, prune_versions, read_table, widen, write_buckets, write_snapshot
from boardlake.sources.zorder import optimize, zordered

__all__ = [
    "MemberSpec", "board_filter", "build_session", "checkpoint_root", "current_board", "dated_boards",
    "drift_report", "idle_cards", "latest_per_key", "latest_per_key_agg", "list_lookup", "member_activity",
    "member_activity_many", "member_activity_table", "member_names", "member_names_from_pairs", "merge_into", "optimize",
    "promote", "prune_versions",
    "read_boards", "read_cards", "read_lists", "read_members", "read_table", "refine_cards",
    "specs_table", "unique_cards", "upsert", "widen", "with_board_name", "write_buckets", "write_snapshot", "zordered",
]
