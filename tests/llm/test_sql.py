import duckdb
import pytest
from littoral.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str([v for _, v in sorted(zip(names, r, strict=True))]) for r in found.fetchall())
    got = sorted(str([v for _, v in sorted(r.asDict().items())]) for r in df.collect())
    assert got == want
