"""Nearest sales against all pairs: in dense, sparse and empty places, with ties, copies and own parcels."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcel_jobs.functions.geodesy import geodesic_m
from parcel_jobs.operators import geo
from parcel_jobs.operators.nearest import LEVELS, fewest, nearest, quadtree, tally, within_areas

METRES = 5 * 1609.344
POINT = "lon double, lat double, sale_parcel string, instrument string, price double"


def slow(subjects, points, metres, most):
    s = subjects.select("subject_id", F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
    d = geodesic_m(F.col("s_lon"), F.col("s_lat"), F.col("lon"), F.col("lat"))
    pairs = s.crossJoin(points).withColumn("d", d).where((F.col("d") <= metres) & (F.col("sale_parcel") != F.col("subject_id")))
    n = F.row_number().over(Window.partitionBy("subject_id").orderBy(F.round("d", 6), "sale_parcel", "instrument"))
    return sorted((r.subject_id, r.n, r.sale_parcel, r.instrument) for r in pairs.withColumn("n", n).where(F.col("n") <= most).collect())


def fast(df):
    return sorted((r.subject_id, r.n, r.sale_parcel, r.instrument) for r in df.collect())


def places(rng, lat):
    town = [(-82 + rng.gauss(0, 0.004), lat + rng.gauss(0, 0.004)) for _ in range(1500)]
    village = [(-81.9 + rng.gauss(0, 0.02), lat + 0.08 + rng.gauss(0, 0.02)) for _ in range(100)]
    country = [(-82.3 + rng.random() * 0.6, lat - 0.3 + rng.random() * 0.6) for _ in range(60)]
    return town + village + country + [(-82.001, lat + 0.001)] * 200 + [(-81.7, lat + 0.2)] * 3


@pytest.mark.parametrize("lat", [26.5, -0.01, 59.0])
def test_equals_all_pairs(spark, lat):
    rng = random.Random(lat)
    rows = [(x, y, f"p{i % 900}", f"{i % 7}", 1.0) for i, (x, y) in enumerate(places(rng, lat))] + [(None, lat, "p1", "n", 1.0), (-82.0, None, "p1", "n", 1.0)]
    points = spark.createDataFrame(rows, POINT)
    spots = [*rng.sample(places(rng, lat), 25), (-82.001, lat + 0.001), (-83.5, lat), (-82.08, lat), (-82.0, lat + 0.07)]
    subjects = spark.createDataFrame([(f"p{i * 3}", x, y) for i, (x, y) in enumerate(spots)] + [("none", None, lat)], "subject_id string, lon double, lat double")
    got = nearest(subjects, points, "sale_parcel", ("instrument",), METRES, 30, leaf=16)
    assert fast(got) == slow(subjects, points, METRES, 30)
    assert {"s_lon", "s_lat", "price", "distance_m"} <= set(got.columns)
    few = nearest(subjects, points, "sale_parcel", ("instrument",), METRES, 2, leaf=500)
    assert fast(few) == slow(subjects, points, METRES, 2)


def test_no_leaf_is_over_its_bound_and_each_point_has_one(spark):
    rng = random.Random(1)
    points = spark.createDataFrame([(x, y) for x, y in places(rng, 26.5)], "lon double, lat double")
    cells, leaves = quadtree(points, METRES, 50)
    assert cells.where(f"is_leaf and n > 50 and level < {LEVELS - 1}").count() == 0
    fine = cells.where(f"level = {LEVELS - 1}")
    assert leaves.count() == fine.count() and leaves.where("level < 2").count() > 0 and leaves.where("level > 2").count() > 0


def test_sparse_subject_beside_a_town_meets_its_outskirts_alone(spark):
    """The pairs that are measured, not those that are kept: a few leaves a subject."""
    rng = random.Random(2)
    town = [(-82 + rng.random() * 0.02, 26.5 + rng.random() * 0.02, f"p{i}", "", 1.0) for i in range(20_000)]
    points = spark.createDataFrame(town, POINT)
    subjects = spark.createDataFrame([("s", -82.05, 26.51)], "subject_id string, lon double, lat double")
    out = nearest(subjects, points, "sale_parcel", ("instrument",), METRES, 30)
    assert out.count() == 30
    plan = out._jdf.queryExecution().executedPlan()
    rows = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif name.endswith("QueryStage"):
            walk(node.plan())
        if "Join" in name:
            metric = node.metrics().get("numOutputRows")
            rows.append(metric.get().value() if metric.isDefined() else 0)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    fast(out)
    walk(plan)
    assert rows[0] == 30 and rows[1] <= 4_000  # of joins from the result down: those kept, then pairs measured


@pytest.mark.parametrize("lat", [26.5, -0.01, 88.95])
def test_points_of_areas_that_no_subject_reaches_are_left_out(spark, lat):
    rng = random.Random(lat)
    points = spark.createDataFrame([(i, rng.uniform(-180, 180), lat + rng.uniform(-3, 0.04)) for i in range(4000)] + [(4000 + i, -82 + rng.gauss(0, 0.1), lat + rng.gauss(0, 0.02)) for i in range(300)], "id int, lon double, lat double")
    subjects = spark.createDataFrame([(-82.0, lat), (-81.99, lat - 0.01), (179.9, lat)], "lon double, lat double")
    kept = {r.id for r in within_areas(points, subjects, METRES).collect()}
    d = geodesic_m(F.col("s_lon"), F.col("s_lat"), F.col("lon"), F.col("lat"))
    near = subjects.select(F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat")).crossJoin(points).where(d <= METRES).collect()
    assert near and {r.id for r in near} <= kept and len(kept) < 3000


def test_counts_are_those_of_the_points_that_are_kept(spark):
    rng = random.Random(3)
    points = spark.createDataFrame([(rng.randrange(5) * 1.0, 1.0, f"p{rng.randrange(4) ** 2}", str(i)) for i in range(600)], "lon double, lat double, sale_parcel string, instrument string")
    for most in (2, 40, 1000):
        places, own = tally(points, "sale_parcel", most)
        kept = fewest(points, "sale_parcel", ("instrument",), most)
        assert {r.lon: r.n for r in places.collect()} == {r.lon: r["count"] for r in kept.groupBy("lon").count().collect()}
        counts = {r.sale_parcel: r["count"] for r in kept.groupBy("sale_parcel").count().collect()}
        assert all(counts.get(r.subject_id, 0) <= r.own for r in own.collect())


def test_comparables_of_the_rules(spark):
    good = ("b", -82.0, 26.5, "R1", 1.0, "V", "01", "02", 101.0, "2026-01-01", "i")
    names = ["sale_parcel", "lon", "lat", "sale_zoning", "sale_acres", "vacant", "code", "second_code", "price", "sale_date", "instrument"]
    bad = {"sale_parcel": "a", "lon": -82.03, "sale_zoning": "R2", "sale_acres": 2.01, "vacant": "I", "code": "03", "second_code": "11", "price": 100.0, "sale_date": "2023-12-31", "instrument": ""}
    rows = [good]
    for name, value in [*bad.items(), ("sale_acres", 0.49), ("sale_date", "2026-09-30"), *((n, None) for n in names[1:])]:
        rows.append(tuple(value if n == name else v for n, v in zip(names, good, strict=True)))
    sales = spark.createDataFrame(rows, "sale_parcel string, lon double, lat double, sale_zoning string, sale_acres double, vacant string, code string, second_code string, price double, sale_date string, instrument string").withColumn("sale_date", F.to_date("sale_date"))
    subjects = spark.createDataFrame([("a", -82.001, 26.5, "R1", 1.0)], "subject_id string, lon double, lat double, zoning string, acres double")
    assert [r.sale_parcel for r in geo.comps_within_radius(subjects, sales, "2026-09-22").collect()] == ["b"]


def test_comparables_are_counted_before_they_meet_subjects(spark):
    rng = random.Random(5)
    places = [(f"p{k}", -82 + rng.random() * 0.08, 26.5 + rng.random() * 0.08, rng.choice(["R1", "R2"])) for k in range(60)]
    rows = [(*rng.choice(places), rng.choice([0.4, 0.5, 1.0, 2.0, 2.1, None]), rng.choice("aab")) for _ in range(3000)] + [("far", 10.0, 50.0, "R1", 1.0, "a")]
    sales = spark.createDataFrame(rows, "sale_parcel string, lon double, lat double, sale_zoning string, sale_acres double, instrument string")
    sales = sales.selectExpr("*", "'V' as vacant", "'01' as code", "'01' as second_code", "101.0 as price", "date '2026-01-01' as sale_date")
    subjects = spark.createDataFrame([(k, x, y, z, rng.choice([1.0, 4.0])) for k, x, y, z in places[:40]], "subject_id string, lon double, lat double, zoning string, acres double")
    got = geo.comps_by_instrument(subjects, sales, "2026-09-22")
    pairs = geo.comps_within_radius(subjects, sales, "2026-09-22").groupBy("subject_id", "sale_parcel", "instrument").agg(F.count("*").alias("n"), F.max("distance_m").alias("distance_m"))
    want = sorted(tuple(r) for r in pairs.collect())
    assert want and sorted(tuple(r) for r in got.select(*pairs.columns).collect()) == want
    text = got._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in text[: text.index("SortMergeJoin")]  # nothing groups pairs
