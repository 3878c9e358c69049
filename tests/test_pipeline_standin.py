"""The pipeline jobs on JSON landings built from the driver tables (sf0.01),
checked against DuckDB: 15,000 cards with id arrays, 100 members."""

import os

import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from standin_landing import write_landing  # noqa: E402

from boardlake.plans import pipeline as P
from boardlake.sources.tables import read_table

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _landing(spark, lr):
    write_landing(spark, SF, lr)


ORACLE = """
WITH names AS (
  SELECT p.l_orderkey AS k, string_agg(s.s_name, ', ' ORDER BY s.s_name) AS card_members
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) p JOIN supplier s ON p.l_suppkey = s.s_suppkey
  GROUP BY p.l_orderkey),
silver AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id, CAST(o.o_custkey AS VARCHAR) AS name, o.o_orderdate AS ts,
         n.card_members, strftime(o.o_orderdate, '%d-%m-%Y') AS LastUpdated,
         'Board ' || o.o_orderpriority AS board_name
  FROM orders o JOIN names n ON o.o_orderkey = n.k)
"""


def test_pipeline_on_driver_tables_matches_duckdb(spark, tmp_path):
    import duckdb
    lr, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    _landing(spark, lr)
    P.ingest_listing(spark, f"{lr}/boards", root, "boards")
    P.ingest_listing(spark, f"{lr}/lists", root, "lists")
    P.ingest_bronze(spark, f"{lr}/members", root, "members")
    P.ingest_bronze(spark, f"{lr}/cards", root, "cards")
    P.refine_silver(spark, root, all_boards=True)
    P.build_unique(spark, root)

    con = duckdb.connect()
    for n in ("orders", "lineitem", "supplier"):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF}/{n}.parquet')")
    want = sorted(con.sql(ORACLE + "SELECT id, card_members, LastUpdated, board_name FROM silver").fetchall())
    got = sorted(tuple(r) for r in read_table(spark, root, P.SILVER_CARDS)
                 .select("id", "card_members", "LastUpdated", "board_name").collect())
    assert len(got) == 14743 and got == want
    want_u = sorted(r[0] for r in con.sql(ORACLE + """
        SELECT id FROM silver
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY ts DESC, id DESC) = 1""").fetchall())
    got_u = sorted(r[0] for r in read_table(spark, root, P.SILVER_UNIQUE).select("id").collect())
    assert got_u == want_u
