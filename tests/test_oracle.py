"""Every query with SQL against DuckDB on the same tables."""

import math
import os
from datetime import date, datetime

import duckdb
import pytest
from littoral.plans import catalog

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        path = f"{SF}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_equal_to_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = [tuple(plain(v) for _, v in sorted(r.asDict().items())) for r in df.collect()]
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(plain(v) for _, v in sorted(zip(names, row, strict=True))) for row in found.fetchall()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("copies", [20, 60])
def test_rising_flow_adds_in_the_order_of_time(spark, tmp_path, copies):
    """Copies a little later make equal means that only the order of their sums tells apart, and means that end in a 5; one thread of the SQL adds in time order."""
    con = duckdb.connect(config={"threads": 1})
    con.execute("SET TimeZone = 'UTC'")
    rows = f"SELECT event_id + k * 1000 AS event_id, ts + k * INTERVAL 977 SECONDS AS ts, user_id, event_type, value, props FROM range({copies}) r(k), '/root/testdata/sf0.001/events.parquet'"
    con.execute(f"COPY ({rows} ORDER BY hash(event_id * 7 + k)) TO '{tmp_path}/events.parquet'")
    con.execute(f"CREATE VIEW events AS FROM '{tmp_path}/events.parquet'")
    got = {(r.site, r.day): (r.mean_72h, r.mean_6h, r.rising) for r in catalog.QUERIES["a07_rising_flow"](spark, str(tmp_path)).collect()}
    want = {(site, day): rest for site, day, *rest in con.execute(f"SELECT site, day, mean_72h, mean_6h, rising FROM ({catalog.ORACLE_SQL['a07_rising_flow']})").fetchall()}
    assert got.keys() == want.keys() and len(got) > 100
    assert [k for k in got if got[k] != tuple(want[k])] == []
