"""DuckDB SQL stating the expected answer of every registered query.

Written from the pipeline's semantics over the driver tables, independent
of the Spark plans.  Column names match the Spark results.
"""

from __future__ import annotations

import datetime as dt

from boardlake.plans import catalog as c

CARDS = """cards AS (
  SELECT o_orderkey AS id, o_orderstatus = 'F' AS closed,
         o_orderdate + to_hours(CAST(o_orderkey % 4 * 6 AS INTEGER)) AS dateLastActivity,
         o_orderpriority AS idBoard, o_orderpriority || '/' || o_orderstatus AS idList,
         CAST(o_custkey AS VARCHAR) AS name
  FROM orders)"""

NAMES = """names AS (
  SELECT p.l_orderkey AS id,
         string_agg(s.s_name, ', ' ORDER BY s.s_name, s.s_suppkey) AS card_members
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) p
  JOIN supplier s ON p.l_suppkey = s.s_suppkey
  GROUP BY p.l_orderkey)"""

SILVER = """silver AS (
  SELECT c.*, n.card_members, strftime(c.dateLastActivity, '%d-%m-%Y') AS LastUpdated,
         'Board ' || c.idBoard AS board_name
  FROM cards c JOIN names n ON c.id = n.id)"""

UNIQ = """uniq AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY dateLastActivity DESC NULLS LAST, id DESC) = 1)"""

SILVER_CHAIN = f"WITH {CARDS},\n{NAMES},\n{SILVER},\n{UNIQ}\n"

SILVER_KEEP = """silver_keep AS (
  SELECT c.*, coalesce(n.card_members, '') AS card_members,
         strftime(c.dateLastActivity, '%d-%m-%Y') AS LastUpdated, 'Board ' || c.idBoard AS board_name
  FROM cards c LEFT JOIN names n ON c.id = n.id)"""

UPSERT_SRC = f"""s AS (
  SELECT id, NOT closed AS closed, dateLastActivity,
         CASE WHEN idList LIKE '%/O' THEN NULL ELSE idBoard END AS idBoard,
         idBoard || '/moved' AS idList, name
  FROM cards WHERE dateLastActivity >= TIMESTAMP '{c.UPSERT_SOURCE_FROM}')"""

SPRINT_DATED = """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS board_date
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'"""


def _match(value: str, how: str) -> str:
    v = value.replace("'", "''")
    if how == "contains":
        return f"contains(card_members, '{v}')"
    return f"card_members LIKE '%{v}%'"


def _range(start, end, bounds: str, fmt: str = "%Y-%m-%d", col: str = "dateLastActivity") -> str:
    if start is None or end is None:
        return "TRUE"
    s = dt.datetime.strptime(start, fmt).date().isoformat()
    e = dt.datetime.strptime(end, fmt).date().isoformat()
    if bounds == "closed_ts":
        return f"{col} >= TIMESTAMP '{s}' AND {col} <= TIMESTAMP '{e}'"
    if bounds == "open_ts":
        return f"{col} > TIMESTAMP '{s}' AND {col} < TIMESTAMP '{e}'"
    return f"CAST({col} AS DATE) BETWEEN DATE '{s}' AND DATE '{e}'"


def _activity(member, start, end, how, bounds, cols, fmt="%Y-%m-%d") -> str:
    return (SILVER_CHAIN + f"SELECT {', '.join(cols)} FROM uniq WHERE {_match(member, how)} "
            f"AND {_range(start, end, bounds, fmt)}")


def _all_members() -> str:
    parts = []
    for s in c.REPORT_SPECS:
        parts.append(f"SELECT '{s.report}' AS report, '{s.member}' AS member, {', '.join(c.GOLD_A)} "
                     f"FROM uniq WHERE {_match(s.member, s.match)} "
                     f"AND {_range(s.start, s.end, s.bounds, s.date_format)}")
    return SILVER_CHAIN + "\nUNION ALL\n".join(parts)


def _card_range(bounds: str) -> str:
    return f"WITH {CARDS} SELECT id, dateLastActivity FROM cards WHERE {_range(c.ACT_START, c.ACT_END, bounds)}"


# Bronze ids are text: the newest card of a name is decided by text on equal dates.
E2E = f"""WITH {CARDS},
{NAMES},
stored AS (SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM cards
           WHERE dateLastActivity < TIMESTAMP '{c.UPSERT_TARGET_BEFORE}'),
batch AS (SELECT * REPLACE (CAST(id AS VARCHAR) AS id, CASE WHEN closed THEN name || ' (closed)' ELSE name END AS name)
          FROM cards WHERE dateLastActivity >= TIMESTAMP '{c.UPSERT_SOURCE_FROM}'),
bronze AS (SELECT * FROM batch UNION ALL SELECT * FROM stored WHERE id NOT IN (SELECT id FROM batch)),
today AS (SELECT * FROM bronze WHERE idBoard = '{c.BOARD}'),
silver AS (SELECT * FROM today UNION ALL SELECT * FROM stored WHERE id NOT IN (SELECT id FROM today)),
named AS (SELECT s.id, s.name, n.card_members, strftime(s.dateLastActivity, '%d-%m-%Y') AS LastUpdated,
                 'Board ' || s.idBoard AS board_name, s.dateLastActivity
          FROM silver s JOIN names n ON s.id = CAST(n.id AS VARCHAR)),
uniq AS (SELECT * FROM named
         QUALIFY row_number() OVER (PARTITION BY name ORDER BY dateLastActivity DESC, id DESC) = 1)
SELECT {', '.join(c.GOLD_A)} FROM uniq
WHERE {_match(c.MEMBER, 'contains')} AND {_range(c.E2E_START, c.E2E_END, 'closed_ts')}"""


UPSERT_SQL = f"""WITH {CARDS},
t AS (SELECT * FROM cards WHERE dateLastActivity < TIMESTAMP '{c.UPSERT_TARGET_BEFORE}'),
{UPSERT_SRC}
SELECT * FROM s
UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)"""


ORACLE: dict[str, str] = {
    "medallion_e2e": E2E,
    "bronze_cards_json": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus = 'F' AS closed, o_orderdate AS dateLastActivity,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS due,
       o_orderpriority AS idBoard, o_orderpriority || '/' || o_orderstatus AS idList,
       CAST(o_custkey AS VARCHAR) AS name, 'order "' || chr(10) || o_orderkey AS desc,
       o_custkey || ',x' AS idMembers, hex(o_orderkey) AS shortLink,
       'https://b.example/' || hex(o_orderkey) AS shortUrl,
       CASE WHEN o_orderstatus <> 'F' THEN 'https://b.example/c/' || hex(o_orderkey) END AS url
FROM orders""",
    "bronze_members_json": """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS fullName, 'S' || right(s_name, 3) AS initials,
       CASE WHEN s_acctbal < 0 THEN 'virtual' ELSE 'normal' END AS memberType,
       'https://board.example/' || lower(replace(s_name, '#', '_')) AS url,
       lower(replace(s_name, '#', '_')) AS username, 'active' AS status,
       CASE WHEN s_acctbal > 5000 THEN lower(replace(s_name, '#', '_')) || '@example.org' END AS email,
       CAST(s_nationkey AS VARCHAR) AS idOrganization
FROM supplier""",
    "json_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "project_cards": f"WITH {CARDS} SELECT * FROM cards",
    "board_filter": f"WITH {CARDS} SELECT * FROM cards WHERE idBoard = '{c.BOARD}'",
    "member_names": f"WITH {CARDS},\n{NAMES}\nSELECT c.id, n.card_members FROM cards c JOIN names n ON c.id = n.id",
    "member_names_keep": f"WITH {CARDS},\n{NAMES}\nSELECT c.id, coalesce(n.card_members, '') AS card_members "
                         "FROM cards c LEFT JOIN names n ON c.id = n.id",
    "last_updated": "SELECT event_id, strftime(ts, '%d-%m-%Y') AS LastUpdated FROM events",
    "with_board_name": f"WITH {CARDS} SELECT id, 'Board ' || idBoard AS board_name FROM cards",
    "silver_cards": f"WITH {CARDS},\n{NAMES},\n{SILVER}\nSELECT * FROM silver WHERE idBoard = '{c.BOARD}'",
    "silver_cards_keep": f"WITH {CARDS},\n{NAMES},\n{SILVER_KEEP}\n"
                         f"SELECT * FROM silver_keep WHERE idBoard = '{c.BOARD}'",
    "silver_upsert": f"""WITH {CARDS},
{NAMES},
{SILVER},
{SILVER_KEEP},
t AS (SELECT * FROM silver WHERE dateLastActivity < TIMESTAMP '{c.UPSERT_TARGET_BEFORE}'),
s AS (SELECT * FROM silver_keep WHERE idBoard = '{c.BOARD}')
SELECT * FROM s
UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)""",
    "silver_current_board": f"""WITH {CARDS},
{NAMES},
bd AS (SELECT o_orderpriority AS id, max(o_orderdate) AS d,
              CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pos
       FROM orders GROUP BY o_orderpriority),
cur AS (SELECT id, 'Sprint (' || strftime(d, '%-d-%b-%Y') || ')' AS name
        FROM bd ORDER BY CAST(d AS DATE) DESC, pos DESC LIMIT 1)
SELECT c.*, n.card_members, strftime(c.dateLastActivity, '%d-%m-%Y') AS LastUpdated,
       cur.name AS board_name
FROM cards c JOIN names n ON c.id = n.id JOIN cur ON c.idBoard = cur.id""",
    "unique_cards": SILVER_CHAIN + "SELECT * FROM uniq",
    "dedupe_latest": """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "dedupe_latest_agg": """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "upsert": UPSERT_SQL,
    "upsert_small_batch": UPSERT_SQL,
    "upsert_evolve": f"""WITH {CARDS},
priced AS (SELECT cards.*, o.o_totalprice AS price FROM cards JOIN orders o ON cards.id = o.o_orderkey),
t AS (SELECT * FROM priced WHERE dateLastActivity < TIMESTAMP '{c.UPSERT_TARGET_BEFORE}'),
s AS (
  SELECT id, NOT closed AS closed, dateLastActivity,
         CASE WHEN idList LIKE '%/O' THEN NULL ELSE idBoard END AS idBoard,
         idBoard || '/moved' AS idList, name, dateLastActivity + INTERVAL 30 DAY AS due
  FROM priced WHERE dateLastActivity >= TIMESTAMP '{c.UPSERT_SOURCE_FROM}')
SELECT coalesce(s.id, t.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.closed ELSE t.closed END AS closed,
       CASE WHEN s.id IS NOT NULL THEN s.dateLastActivity ELSE t.dateLastActivity END AS dateLastActivity,
       CASE WHEN s.id IS NOT NULL THEN s.idBoard ELSE t.idBoard END AS idBoard,
       CASE WHEN s.id IS NOT NULL THEN s.idList ELSE t.idList END AS idList,
       CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       t.price AS price, s.due AS due
FROM t FULL OUTER JOIN s ON t.id = s.id""",
    "upsert_latest": f"""WITH {CARDS},
s AS (
  SELECT l_orderkey AS id, l_shipdate AS dateLastActivity, 'L/' || l_linestatus AS idList,
         l_linenumber AS lastLine
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey
                             ORDER BY l_shipdate DESC, l_linenumber DESC, 'L/' || l_linestatus DESC) = 1)
SELECT coalesce(s.id, t.id) AS id, t.closed AS closed,
       CASE WHEN s.id IS NOT NULL THEN s.dateLastActivity ELSE t.dateLastActivity END AS dateLastActivity,
       t.idBoard AS idBoard,
       CASE WHEN s.id IS NOT NULL THEN s.idList ELSE t.idList END AS idList,
       t.name AS name, s.lastLine AS lastLine
FROM cards t FULL OUTER JOIN s ON t.id = s.id""",
    "overwrite_widen": f"""WITH {CARDS}
SELECT c.id, CAST(NULL AS BOOLEAN) AS closed, c.dateLastActivity, c.idBoard, c.idList, c.name,
       o.o_totalprice AS price
FROM cards c JOIN orders o ON c.id = o.o_orderkey""",
    "board_date": SPRINT_DATED,
    "current_board": SPRINT_DATED + " ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
    "current_board_last_listed": SPRINT_DATED + " ORDER BY o_orderkey DESC LIMIT 1",
    "list_lookup": "SELECT DISTINCT o_orderpriority AS idBoard, o_orderpriority || '/O' AS list_id "
                   "FROM orders WHERE o_orderstatus = 'O'",
    "list_lookup_first": "SELECT DISTINCT o_orderpriority AS idBoard, o_orderpriority || '/F' AS list_id "
                         "FROM orders WHERE o_orderstatus = 'F'",
    "idle_cards": f"""WITH {CARDS},
{NAMES},
{SILVER}
SELECT {', '.join(c.GOLD_A)} FROM silver
WHERE idList = '{c.BOARD}/O'
  AND dateLastActivity < TIMESTAMP '{(c.IDLE_AS_OF - dt.timedelta(days=c.IDLE_DAYS)).isoformat(' ')}'""",
    "idle_cards_first_list": f"""WITH {CARDS},
{NAMES},
{SILVER}
SELECT {', '.join(c.GOLD_A)} FROM silver
WHERE idList = '{c.BOARD}/F'
  AND dateLastActivity < TIMESTAMP '{(c.IDLE_AS_OF - dt.timedelta(days=c.IDLE_DAYS)).isoformat(' ')}'""",
    "activity_contains": _activity(c.MEMBER, c.ACT_START, c.ACT_END, "contains", "closed_ts", c.GOLD_A),
    "activity_like": _activity(c.LIKE_MEMBER, c.ACT_START, c.ACT_END, "like", "closed_date", c.GOLD_B),
    "activity_open_ts": _activity(c.MEMBER, c.ACT_START, c.ACT_END, "like", "open_ts", c.GOLD_B),
    "activity_closed_date": _activity(c.MEMBER, c.ACT_START, c.ACT_END, "contains", "closed_date", c.GOLD_C),
    "activity_optional": _activity(c.MEMBER, None, None, "contains", "closed_ts", c.GOLD_A),
    "activity_dayfirst": _activity(c.MEMBER, c.DAYFIRST_START, c.DAYFIRST_END, "like", "closed_ts", c.GOLD_A,
                                   "%d-%m-%Y"),
    "range_closed_ts": _card_range("closed_ts"),
    "range_open_ts": _card_range("open_ts"),
    "range_closed_date": _card_range("closed_date"),
    "range_tz": f"WITH {CARDS} SELECT id, dateLastActivity FROM cards WHERE "
                + _range(c.ACT_START, c.ACT_END, "closed_date", col="(dateLastActivity + INTERVAL 7 HOUR)"),
    "activity_all_members": _all_members(),
    "bronze_cast_failures": "SELECT CAST(o_orderkey AS VARCHAR) AS id, 'due' AS field, 'garbage' AS raw FROM orders WHERE o_orderstatus = 'P'",
    "overwrite_widen_types": """SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS DOUBLE) AS price,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS BIGINT) + 1099511627776 END AS customer, NULL::VARCHAR AS status,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority, o_orderkey % 3 = 0 AS unmarked FROM orders
UNION ALL SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12, 1)) AS DOUBLE), o_custkey, o_orderstatus, NULL, FALSE FROM orders""",
    "activity_member_table": SILVER_CHAIN + """, people AS (
  SELECT s_suppkey AS k, s_name AS full_name FROM supplier
  UNION ALL SELECT -c_custkey, 'Supplier#' || right(c_name, 9) FROM customer
), kinds AS (SELECT *, ((k % 10) + 10) % 10 AS kind, DATE '1993-01-01' + CAST((((k * 13) % 1500) + 1500) % 1500 AS INTEGER) AS d FROM people
), specs AS (
  SELECT 'r' || k AS report,
         CASE WHEN kind = 1 THEN 'lier#%' || right(full_name, 4) WHEN kind = 2 THEN '#00000_' || right(full_name, 3)
              WHEN kind = 3 THEN right(full_name, 2) || ', ' WHEN kind = 4 AND k % 50 = 4 THEN right(full_name, 2)
              WHEN kind = 5 AND k % 250 = 5 THEN right(full_name, 1) WHEN k = 7 THEN '_%' ELSE full_name END AS member,
         kind IN (1, 2, 7) AS is_like, ((k % 3) + 3) % 3 AS bound, d AS lo, CASE WHEN ((k % 11) + 11) % 11 <> 0 THEN d + 1200 END AS hi
  FROM kinds)
SELECT report, member, u.id, u.name, u.card_members, u.LastUpdated, u.board_name
FROM uniq u JOIN specs s
  ON CASE WHEN is_like THEN u.card_members LIKE '%' || member || '%' ELSE contains(u.card_members, member) END
 AND (hi IS NULL OR CASE bound WHEN 0 THEN dateLastActivity >= lo AND dateLastActivity <= hi
                               WHEN 1 THEN dateLastActivity > lo AND dateLastActivity < hi
                               ELSE CAST(dateLastActivity AS DATE) BETWEEN lo AND hi END)""",
    "member_names_array": f"WITH {CARDS},\n{NAMES}\nSELECT c.id, n.card_members FROM cards c JOIN names n ON c.id = n.id",
    "bronze_members_latest": """SELECT CAST(l_suppkey AS VARCHAR) AS id, 'Member-' || l_orderkey || '-' || l_linenumber AS fullName
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""",
    "list_lookup_json": """WITH l AS (
  SELECT DISTINCT o_orderpriority AS idBoard, o_orderpriority || '/' || o_orderstatus AS id,
         CASE o_orderstatus WHEN 'O' THEN -2 WHEN 'P' THEN -3 END AS pos
  FROM orders)
SELECT idBoard, id AS list_id FROM l
QUALIFY row_number() OVER (PARTITION BY idBoard ORDER BY pos ASC NULLS LAST, id) = 1""",
    "current_board_json": SPRINT_DATED.replace("o_orderkey AS id", "CAST(o_orderkey AS VARCHAR) AS id")
                          + " ORDER BY CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END DESC NULLS LAST, id DESC LIMIT 1",
}

