"""DuckDB SQL of the job queries: what two days of landing files must lead to."""

from __future__ import annotations

from boardlake.plans import catalog as c
from boardlake.plans.jobs import MOVED_TO
from boardlake.plans.oracle import CARDS, NAMES, SILVER_CHAIN, _match, _range

FIRST = f"""WITH {CARDS},
day1 AS (SELECT CAST(id AS VARCHAR) AS id, closed, dateLastActivity, idBoard, idList, name FROM cards)"""

SECOND = f"""day2 AS (
  SELECT id, closed, dateLastActivity + to_days(CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END) AS dateLastActivity,
         CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN '{MOVED_TO}' ELSE idBoard END AS idBoard, idList, name || ' (closed)' AS name
  FROM day1 WHERE closed)"""

BOARDS = """boards AS (
  SELECT o_orderpriority AS id, 'Sprint (' || strftime(max(o_orderdate), '%-d-%b-%Y') || ')' AS name,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS pos, CAST(max(o_orderdate) AS DATE) AS d
  FROM orders GROUP BY o_orderpriority),
cur AS (SELECT * FROM boards ORDER BY d DESC, pos DESC, id DESC LIMIT 1)"""

SILVER = f"""{FIRST},
{SECOND},
{BOARDS},
{NAMES},
renamed AS (
  SELECT p.l_orderkey AS id, string_agg(s.n, ', ' ORDER BY s.n, CAST(s.s_suppkey AS VARCHAR)) AS card_members
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) p
  JOIN (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN s_name || ' jr' ELSE s_name END AS n FROM supplier) s ON p.l_suppkey = s.s_suppkey
  GROUP BY p.l_orderkey),
bronze AS (SELECT * FROM day2 UNION ALL SELECT * FROM day1 WHERE NOT closed),
old AS (SELECT x.*, n.card_members FROM day1 x JOIN names n ON x.id = CAST(n.id AS VARCHAR)),
fresh AS (SELECT x.*, n.card_members FROM bronze x JOIN renamed n ON x.id = CAST(n.id AS VARCHAR) WHERE x.idBoard = (SELECT id FROM cur)),
silver AS (
  SELECT x.*, strftime(x.dateLastActivity, '%d-%m-%Y') AS LastUpdated, b.name AS board_name
  FROM (SELECT * FROM fresh UNION ALL SELECT * FROM old WHERE id NOT IN (SELECT id FROM fresh)) x LEFT JOIN boards b ON x.idBoard = b.id),
uniq AS (
  SELECT * FROM silver QUALIFY row_number() OVER (PARTITION BY name ORDER BY dateLastActivity DESC NULLS LAST, id DESC) = 1)
"""

GOLD = "id, name, card_members, LastUpdated, board_name"


def _reports() -> str:
    return SILVER + "\nUNION ALL\n".join(
        f"SELECT '{s.report}' AS report, '{s.member}' AS member, {GOLD} FROM uniq "
        f"WHERE {_match(s.member, s.match)} AND {_range(s.start, s.end, s.bounds, s.date_format)}" for s in c.REPORT_SPECS)


BRONZE = f"{FIRST},\n{SECOND}\nSELECT * FROM day2 UNION ALL SELECT * FROM day1 WHERE NOT closed"

ORACLE = {
    "job_bronze_cards": BRONZE,
    "job_ingest_new": BRONZE,
    "job_extras": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS name,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS price,
  CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS rank, CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS INTEGER) END AS who
FROM orders""",
    "job_drift_report": """SELECT 'price' AS key, count(*) AS n, 'VARIANT' AS type FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT 'cover', count(*), 'OBJECT<rank: STRING, who: BIGINT>' FROM orders WHERE o_orderstatus = 'O'""",
    "job_bronze_members": """SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_acctbal < 0 THEN s_name || ' jr' ELSE s_name END AS fullName
FROM supplier""",
    "job_boards": f"WITH {BOARDS}\nSELECT id, name, pos FROM boards",
    "job_lists": """SELECT DISTINCT o_orderpriority || '/' || o_orderstatus AS id, o_orderpriority AS idBoard,
  CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'Doing' WHEN 'P' THEN 'Review' END AS name,
  CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 2.0 WHEN 'P' THEN 3.0 END AS pos FROM orders""",
    "job_silver": SILVER + "SELECT * FROM silver",
    "job_refine_changes": SILVER + """SELECT x.*, n.card_members, strftime(x.dateLastActivity, '%d-%m-%Y') AS LastUpdated, b.name AS board_name
FROM bronze x JOIN renamed n ON x.id = CAST(n.id AS VARCHAR) LEFT JOIN boards b ON x.idBoard = b.id""",
    "job_unique": SILVER + "SELECT * FROM uniq",
    "job_gold_idle": SILVER + f"""SELECT {GOLD} FROM silver
WHERE idList = (SELECT id FROM cur) || '/O' AND dateLastActivity < TIMESTAMP '{c.IDLE_AS_OF}' - INTERVAL {c.IDLE_DAYS} DAY""",
    "job_gold_member": SILVER + f"SELECT {GOLD} FROM uniq WHERE {_match(c.MEMBER, 'contains')} AND {_range(c.ACT_START, c.ACT_END, 'closed_date')}",
    "job_member_reports": _reports(),
    "job_overwrite": f"WITH {CARDS}\nSELECT id, NULL::BOOLEAN AS closed, dateLastActivity, idBoard, idList, name, o_totalprice AS price\n"
                     "FROM cards JOIN orders ON id = o_orderkey WHERE NOT closed",
    "job_zorder": SILVER_CHAIN + f"""SELECT {GOLD} FROM silver
WHERE idList LIKE '%/O' AND dateLastActivity < TIMESTAMP '{c.IDLE_AS_OF}' - INTERVAL {c.IDLE_DAYS} DAY""",
    "job_idle_stream": f"""{FIRST},
{SECOND},
latest AS (SELECT * FROM day2 WHERE CAST(id AS BIGINT) % 2 = 0 UNION ALL SELECT * FROM day1 WHERE NOT closed OR CAST(id AS BIGINT) % 2 <> 0),
clock AS (SELECT max(dateLastActivity + to_days(CAST(CAST(id AS BIGINT) % 20 AS INTEGER) + n)) AS t
       FROM (SELECT id, dateLastActivity, 0 AS n FROM day1 UNION ALL SELECT id, dateLastActivity, 1 FROM day2))
SELECT id, name, idBoard, idList, dateLastActivity FROM latest, clock WHERE dateLastActivity < t - INTERVAL {c.IDLE_DAYS} DAY""",
    "job_stream": f"{FIRST},\n{SECOND}\nSELECT * FROM day2 WHERE CAST(id AS BIGINT) % 2 = 0 UNION ALL "
                  "SELECT * FROM day1 WHERE NOT closed OR CAST(id AS BIGINT) % 2 <> 0",
}
