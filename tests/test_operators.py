import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcel_jobs.functions import kernels
from parcel_jobs.operators import gates, profile, qualification, records, snapshots

BOX = lambda x0, y0, x1, y1: np.array([[x0, y0], [x0, y1], [x1, y1], [x1, y0], [x0, y0]], float)


def test_gates_close(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, error string")
    with pytest.raises(gates.GateClosed):
        gates.require_no_errors(df)
    with pytest.raises(gates.GateClosed):
        gates.require_unique(df, ["k"])
    assert gates.require_unique(df, ["k", "error"]) is df


def test_target_gate_gathers_no_keys(spark):
    from parcel_jobs.plans import QUERIES

    plan = QUERIES["g4_target_gate"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    now, old, key = "2024-01-31 00:00:00", "2024-01-29 00:00:00", lambda i: f"{i:018d}"
    rows = [("a", now, 0, key(1)), ("a", now, 0, key(2)), ("b", now, 0, key(1)), ("b", now, 0, key(1)), ("c", now, 0, None), ("d", now, 0, key(1)), ("d", old, 0, key(2)), ("e", now, 1, key(1)), ("f", now, None, key(1))]
    df = spark.createDataFrame(rows, "project_ref string, captured_at string, registry_drift int, parcel_key string").withColumn("captured_at", F.col("captured_at").cast("timestamp"))
    for project in "abcdef":
        got = {r["project_ref"]: tuple(r)[1:] for r in gates.target_gate_rows(df, project, now).collect()}
        assert {p: x[:3] for p, x in got.items()} == {"a": (2, 0, 0), "b": (2, 0, 1), "c": (1, 1, 0), "d": (2, 0, 0), "e": (1, 0, 0), "f": (1, 0, 0)}
        assert {p for p, x in got.items() if x[3]} == ({"a"} if project == "a" else set())


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    a = profile.table_fingerprint(df, "k").first()
    assert a == profile.table_fingerprint(df.repartition(5).orderBy(F.desc("k")), "k").first()
    assert a != profile.table_fingerprint(df.withColumn("v", F.col("v") + 1), "k").first()


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, s string, n int")
    once = snapshots.upsert(old, new, ["k"], keep_if_null=["s"])
    assert sorted(once.collect()) == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    assert sorted(snapshots.upsert(once, new, ["k"], keep_if_null=["s"]).collect()) == sorted(once.collect())


@pytest.mark.parametrize(
    ("feature", "wet", "road", "paved", "flags", "status", "missing"),
    [
        (("X", "F", "AREA OF MINIMAL FLOOD HAZARD"), "NOT_FOUND", "FOUND", 1, True, "QUALIFIED_FOR_CONTACT_ENRICHMENT", []),
        (("AE", "F", ""), "FOUND", "FOUND", 1, True, "REJECTED_FLOOD_ZONE", []),
        (("X", "T", ""), "NOT_FOUND", "FOUND", 1, True, "REJECTED_FLOOD_ZONE", []),
        (("X", "F", "OTHER"), "FOUND", "FOUND", 1, True, "REJECTED_MAPPED_WETLANDS", []),
        (("X", "F", None), "STALE", None, None, None, "HOLD", ["FLOOD", "WETLANDS", "PAVED_ROAD", "RECORDED_FRONTAGE_AND_ACCESS_REVIEW", "SELLER_DISTRESS", "SIZE_ZONING_ROUGH_COMPS"]),
        (("X", "F", "AREA OF MINIMAL FLOOD HAZARD"), "NOT_FOUND", "FOUND", 0, True, "HOLD", ["PAVED_ROAD"]),
    ],
)
def test_gate(spark, feature, wet, road, paved, flags, status, missing):
    row = spark.createDataFrame([(feature, wet, road, paved, flags)], "f struct<fld_zone:string,sfha_tf:string,zone_subty:string>, wet string, road string, paved int, ok boolean")
    gate = qualification.evaluate_gate(F.lit("FOUND"), F.array("f"), F.col("wet"), F.lit(0), F.col("road"), F.col("paved"), *[F.col("ok")] * 3)
    assert row.select(gate.alias("g")).select("g.*").first() == (status, missing)


def test_legal_lines_reassemble(spark):
    head = '"000000000000000001","1","12","34","56","1","1","RUN 12" E'
    rows = [("f", 0, "stray"), ("f", 1, head), ("f", 2, "goes on"), ("f", 200_001, "and on"), ("f", 200_002, head)]
    got = records.reassemble_legal(spark.createDataFrame(rows, "file string, line_no long, value string")).orderBy("record").collect()
    assert [(r["record"], r["n_lines"]) for r in got] == [(0, 1), (1, 3), (2, 1)] and got[1]["value"].endswith("goes on and on")


def test_areas_with_holes_and_overlaps():
    hole = [BOX(0, 0, 10, 10), BOX(4, 4, 6, 6)]
    assert kernels.overlap_areas(hole, [[BOX(0, 0, 5, 10)], [BOX(3, 0, 5, 20)]]) == pytest.approx((96, 48))
    concave = [np.array([[0, 0], [0, 4], [4, 4], [4, 3], [1, 3], [1, 0]], float)]
    assert kernels.overlap_areas(concave, [[BOX(-1, -1, 5, 5)]]) == pytest.approx((7, 7))
    assert kernels.overlap_areas([np.zeros((0, 2))], [[BOX(0, 0, 1, 1)]]) == (0, 0)


def test_areas_agree_with_points():
    rng = np.random.default_rng(5)
    shape = lambda: [np.c_[a := rng.uniform(2, 8, 2), a][:0].reshape(-1, 2)] and [(np.c_[np.cos(t := np.sort(rng.uniform(0, 2 * math.pi, 9))), np.sin(t)] * rng.uniform(1, 4, (9, 1)) + rng.uniform(3, 7, 2))]
    parcel, hazards = shape(), [shape() for _ in range(4)]
    area, covered = kernels.overlap_areas(parcel, hazards)
    p = rng.uniform(-2, 12, (20_000, 2))
    inside = np.array([kernels.contains(parcel, *q) for q in p])
    hit = np.array([i and any(kernels.contains(h, *q) for h in hazards) for i, q in zip(inside, p, strict=True)])
    assert area == pytest.approx(inside.mean() * 196, abs=2.0) and covered == pytest.approx(hit.mean() * 196, abs=2.0)


def test_lengths_and_distances():
    box, line = BOX(0, 0, 10, 10), np.array([[0, -3, 10, -3]], float)
    assert kernels.distance([box], line) == 3
    assert kernels.distance([box], np.array([[2, 2, 3, 3]], float)) == 0
    assert kernels.distance([box], np.array([[-5, 5, 20, 5]], float)) == 0
    assert kernels.length_near(kernels.edges([box]), np.array([[0, 0, 10, 0], [5, 0, 10, 0]], float), 0.2) == pytest.approx(10.4)
