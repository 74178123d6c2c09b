"""Differences of versions by trees of fingerprints against a full comparison."""

import random

import pytest
from pyspark.sql import functions as F

from parcel_jobs.operators import snapshots

SCHEMA = "k string, line int, name string, pct string"


def versions(n, changes):
    rng = random.Random(4)
    old = {(f"{i:018d}", line): [rng.choice(["a", "b", None, ""]), str(line)] for i in range(n) for line in range(i % 3 + 1)}
    new = {k: list(v) for k, v in old.items()}
    for i in rng.sample(range(n), changes):
        kind, key = rng.randrange(5), f"{i:018d}"
        if kind == 0:
            new[key, 0][0] = "z"
        elif kind == 1:
            new[key, 0] = ["z", "z"]
        elif kind == 2:
            new[key, 9] = ["x", "9"]
        elif kind == 3:
            new = {k: v for k, v in new.items() if k[0] != key}
        else:
            new["n" + key, 0] = ["x", None]
    return old, new


def slow(old, new):
    out = {}
    for key in {k for k, _ in [*old, *new]}:
        a, b = ({line: v for (k, line), v in x.items() if k == key} for x in (old, new))
        fields = [sum(p != q for p, q in zip(a[i], b[i], strict=True)) for i in a.keys() & b.keys()]
        counts = len(b.keys() - a.keys()), len(a.keys() - b.keys()), sum(f > 0 for f in fields), sum(fields)
        out[key] = ("added" if not a else "missing" if not b else "changed" if any(counts) else "unchanged", *counts)
    return out


@pytest.mark.parametrize("ranges", [1, 512, snapshots.RANGES])
def test_equals_a_full_comparison(spark, ranges):
    old, new = versions(400, 60)
    a, b = (spark.createDataFrame([(*k, *v) for k, v in x.items()], SCHEMA) for x in (old, new))
    got = snapshots.diff_snapshots(a, b, "k", "line", ["name", "pct"], ranges=ranges).collect()
    assert len(got) == len(slow(old, new)) and {r[0]: tuple(r)[1:] for r in got} == slow(old, new)


def test_rows_joined_are_in_proportion_to_the_changes(spark):
    old, new = versions(3000, 20)
    a, b = (spark.createDataFrame([(*k, *v) for k, v in x.items()], SCHEMA) for x in (old, new))
    trees = [snapshots.fingerprint_tree(x, "k", ["line", "name", "pct"]) for x in (a, b)]
    differ = snapshots.differing_ranges(*trees)
    assert 0 < differ.count() <= 20
    joined = b.withColumn("node", F.pmod(F.xxhash64("k"), F.lit(snapshots.RANGES)).cast("int")).join(differ, "node", "left_semi").count()
    assert joined <= 20 * 6
    again = snapshots.diff_snapshots(a, b, "k", "line", ["name", "pct"], trees=tuple(trees))
    assert {r[0]: tuple(r)[1:] for r in again.collect()} == slow(old, new)


def test_nulls_are_no_blanks_and_empty_versions(spark):
    a = spark.createDataFrame([("k", 1, None, "x"), ("m", 1, "-", "=")], SCHEMA)
    b = spark.createDataFrame([("k", 1, "", "x"), ("m", 1, "-", "=")], SCHEMA)
    got = {r.k: (r.state, r.changed_fields) for r in snapshots.diff_snapshots(a, b, "k", "line", ["name", "pct"]).collect()}
    assert got == {"k": ("changed", 1), "m": ("unchanged", 0)}
    none = a.limit(0)
    assert {r.state for r in snapshots.diff_snapshots(a, none, "k", "line", ["name", "pct"]).collect()} == {"missing"} and snapshots.diff_snapshots(none, none, "k", "line", ["name", "pct"]).count() == 0
    assert {r.state for r in snapshots.diff_snapshots(a, a.repartition(3), "k", "line", ["name", "pct"]).collect()} == {"unchanged"}
