"""Every query that has SQL gives the rows of its SQL on the smallest tables."""

import duckdb
import pytest

from parcel_jobs.plans import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_of_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert len(got) == len(want)
    assert [repr(x).replace(" ", "") for x in got] == [repr(x).replace(" ", "") for x in want] or got == want


def test_union_of_hazards_is_at_most_their_sum(spark):
    rows = QUERIES["p2_overlap_union"](spark, DATA).collect()
    assert rows and all(0 <= r["overlap_pct"] <= 100 for r in rows)
