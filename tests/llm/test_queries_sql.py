"""The queries that SQL can express, against it."""

import duckdb
import pytest

from loomlake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for n in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    d = QUERIES[name](spark, SF)
    columns = sorted(d.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    plain = lambda rows: sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)
    assert plain(d.select(*columns).collect()) == plain(want)
