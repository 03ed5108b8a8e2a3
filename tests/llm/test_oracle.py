import duckdb
import pytest

from wellmart.llm.queries import ORACLE, QUERIES
from conftest import SF


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
