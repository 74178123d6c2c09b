"""What queries move or parse: no more than they need."""

import re

from parcel_jobs.operators import profile, snapshots
from parcel_jobs.plans import QUERIES
from parcel_jobs.plans.catalogue import Tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_travel_as_numbers(spark):
    df = spark.sql("select cast(id % 7 as string) as a, cast(id % 3 as string) as b from range(40)")
    out = profile.probe_keys(df, [["a"], ["a", "b"]])
    assert re.search(r"candidate, 1, key|1 AS candidate", plan(out)) and {r["candidate"]: r["distinct_keys"] for r in out.collect()} == {"a": 7, "a+b": 21}


def test_keys_that_are_there_are_not_counted(spark):
    want, seen = spark.sql("select cast(id as string) as k from range(40)"), spark.sql("select cast(id % 30 as string) as k from range(90)")
    out = snapshots.missing_by_shard(want, seen, ["k"], 4)
    assert plan(out).count("Aggregate") == 1 and sum(r["n"] for r in out.collect()) == 10


def test_screening_stores_what_it_reads(spark, monkeypatch):
    held = []
    monkeypatch.setattr(Tables, "stored", lambda self, tag, df: held.append(df.columns) or df)
    QUERIES["c15_screen_report"](spark, "/root/testdata/sf0.001")
    assert len(held) == 1 and not {"grantor", "grantee", "trns_cd", "trns_dscr"} & set(held[0])
