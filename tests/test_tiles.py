"""Areas and lengths added up by tiles against the kernels on whole shapes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcel_jobs.functions import kernels
from parcel_jobs.operators import geo

SHAPE = "array<array<array<double>>>"


def star(rng, x, y, size, n=9):
    turn = sorted(rng.random() * 2 * math.pi for _ in range(n))
    ring = [[x + size * rng.uniform(0.3, 1) * math.cos(t), y + size * rng.uniform(0.3, 1) * math.sin(t)] for t in turn]
    return [[*ring, ring[0]]]


def box(x0, y0, x1, y1):
    return [[[float(x), float(y)] for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


def arrays(shape):
    return [np.array(r, float) for r in shape]


@pytest.mark.parametrize("seed", range(6))
def test_boxes_side_by_side_add_up(seed):
    rng = random.Random(seed)
    parcel = arrays(star(rng, 50, 50, 60))
    hazards = [arrays(star(rng, rng.uniform(0, 100), rng.uniform(0, 100), 30)) for _ in range(8)] + [arrays(box(20, 20, 40, 40) + box(25, 25, 30, 30))]
    whole = kernels.overlap_areas(parcel, hazards)
    xs, ys = np.linspace(-20, 120, 6), np.linspace(-20, 120, 5)
    parts = [kernels.overlap_areas(parcel, hazards, (a, c, b, d)) for a, b in zip(xs, xs[1:], strict=False) for c, d in zip(ys, ys[1:], strict=False)]
    assert np.allclose(np.sum(parts, axis=0), whole)
    lines = np.array([[rng.uniform(-10, 110) for _ in range(4)] for _ in range(5)])
    own = kernels.edges(parcel)
    for reach in (0.2, 9.0):
        lengths = [kernels.length_near(own, lines, reach, (a, c, b, d)) for a, b in zip(xs, xs[1:], strict=False) for c, d in zip(ys, ys[1:], strict=False)]
        assert sum(lengths) == pytest.approx(kernels.length_near(own, lines, reach))


def test_sides_on_the_borders_of_boxes_count_once():
    own = kernels.edges(arrays(box(0, 0, 10, 10)))
    lines = np.array([[0.0, 0.0, 10.0, 0.0], [10.0, 0.0, 10.0, 10.0], [0.0, 10.0, 10.0, 10.0]])
    parts = [kernels.length_near(own, lines, 0.1, (x, y, x + 5, y + 5)) for x in (-5, 0, 5, 10) for y in (-5, 0, 5, 10)]
    assert sum(parts) == pytest.approx(30.2)


@pytest.mark.parametrize("most", [3, 64])
def test_overlap_and_frontage_of_many_small_shapes(spark, most):
    """One parcel under hundreds of hazards, one across many cells, one with none near, one without area."""
    rng = random.Random(1)
    parcels = {"a": star(rng, 250, 250, 200, 12), "b": star(rng, 900, 600, 700, 15), "c": box(9000, 9000, 9010, 9010), "d": [[[0.0, 0.0], [5.0, 5.0], [0.0, 0.0]]], "e": box(500, 500, 1000, 1000)}
    hazards = [star(rng, rng.uniform(100, 400), rng.uniform(100, 400), 15) for _ in range(150)] + [star(rng, rng.uniform(0, 1600), rng.uniform(0, 1300), 90) for _ in range(60)] + [box(480, 480, 520, 1020)]
    a = spark.createDataFrame(list(parcels.items()), f"parcel_id string, shape {SHAPE}")
    b = spark.createDataFrame(list(enumerate(hazards)), f"other_id long, other_shape {SHAPE}")
    got = {r.parcel_id: r for r in geo.overlap_pct(a, b, most=most).collect()}
    for k, shape in parcels.items():
        area, covered = kernels.overlap_areas(arrays(shape), [arrays(h) for h in hazards])
        if k == "d":
            assert (got[k].overlap_pct, got[k].error) == (None, "invalid_parcel")
        else:
            assert got[k].overlap_pct == pytest.approx(100 * covered / area, abs=1e-4) and got[k].error is None
    bounds = lambda s: (min(p[0] for r in s for p in r), min(p[1] for r in s for p in r), max(p[0] for r in s for p in r), max(p[1] for r in s for p in r))
    for k, shape in parcels.items():
        p = bounds(shape)
        assert got[k].hazards == sum(p[0] <= h[2] and h[0] <= p[2] and p[1] <= h[3] and h[1] <= p[3] for h in map(bounds, hazards))
    lines = [[[[rng.uniform(0, 1600), rng.uniform(0, 1300)], [rng.uniform(0, 1600), rng.uniform(0, 1300)]]] for _ in range(40)] + [[[[500.0, 500.0], [1000.0, 500.0]]]]
    c = spark.createDataFrame(list(enumerate(lines)), f"other_id long, other_shape {SHAPE}")
    every = np.concatenate([np.array([[*q[0][0], *q[0][1]]]) for q in lines])
    for r in geo.frontage_metrics(a, c, reach=2.0, search=30.0, most=most).collect():
        shape = arrays(parcels[r.parcel_id])
        if r.status == "no_mapped_line_review":
            assert r.frontage_m is None and kernels.distance(shape, every) > 30
        else:
            assert r.frontage_m == pytest.approx(kernels.length_near(kernels.edges(shape), every, 2.0), abs=1e-3)
            assert r.nearest_m == pytest.approx(kernels.distance(shape, every), abs=1e-3)


def test_one_parcel_is_many_tiles(spark):
    rows = [(k, box(k % 100 * 5, k // 100 * 5, k % 100 * 5 + 4, k // 100 * 5 + 4)) for k in range(10_000)]
    hazards = spark.createDataFrame(rows, f"other_id long, other_shape {SHAPE}")
    parcel = spark.createDataFrame([("p", box(0, 0, 499, 499))], f"parcel_id string, shape {SHAPE}")
    sizes = geo.tiles(parcel, hazards).groupBy("level", "i", "j").agg(F.count("*").alias("n"), F.count_if("met").alias("met"))
    most, tiles, met = sizes.select(F.max("n"), F.count("*"), F.sum("met")).first()
    assert most <= geo.TILE_MOST and tiles > 200 and met == 10_000


def stacked(n, seed, side=600):
    """Boxes of whole metres, many over each place."""
    rng = random.Random(seed)
    corners = [(rng.randrange(-100, side), rng.randrange(-100, side), rng.randrange(5, 160), rng.randrange(5, 160)) for _ in range(n)]
    return [(x, y, x + w, y + h) for x, y, w, h in corners]


def test_crowded_tiles_under_one_hazard_stay_one(spark):
    """Thousands of hazards over each place: a tile that one of them covers isn't split. The union is held against a raster of metres."""
    hazards = stacked(3000, 3)
    raster = np.zeros((900, 900), bool)
    for x0, y0, x1, y1 in hazards:
        raster[max(x0, 0) : max(x1, 0), max(y0, 0) : max(y1, 0)] = True
    parcels = {f"{x}-{y}": (x, y, x + 40, y + 40) for x in (10, 480, 640, 700) for y in (20, 490, 650)}
    a = spark.createDataFrame([(k, box(*b)) for k, b in parcels.items()], f"parcel_id string, shape {SHAPE}")
    b = spark.createDataFrame([(k, box(*h)) for k, h in enumerate(hazards)], f"other_id long, other_shape {SHAPE}")
    got = {r.parcel_id: r for r in geo.overlap_pct(a, b).collect()}
    for k, (x0, y0, x1, y1) in parcels.items():
        assert got[k].overlap_pct == pytest.approx(100 * raster[x0:x1, y0:y1].mean(), abs=1e-4)
        assert got[k].hazards == sum(x0 <= h[2] and h[0] <= x1 and y0 <= h[3] and h[1] <= y1 for h in hazards)
    one = spark.createDataFrame([("p", box(10, 20, 50, 60))], f"parcel_id string, shape {SHAPE}")
    rows = geo.tiles(one, b, settle=True)
    assert rows.agg(F.count_if("used"), F.max("level"), F.count_if("met")).first() == (1, 0, got["10-20"].hazards) and got["10-20"].hazards > geo.TILE_MOST


def test_points_under_stacked_polygons_meet_few(spark):
    rng = random.Random(4)
    polygons = [(k, k * 7 % 5, box(*h)) for k, h in enumerate(stacked(2000, 5))] + [(2000 + k, k % 5, star(rng, rng.uniform(0, 600), rng.uniform(0, 600), 80)) for k in range(300)]
    points = [(k, *p) for k, p in enumerate([(float(rng.randrange(0, 700)), float(rng.randrange(0, 700))) for _ in range(200)] + [(rng.uniform(0, 700), rng.uniform(0, 700)) for _ in range(200)])]
    a = spark.createDataFrame(points, "point_id long, x double, y double")
    b = spark.createDataFrame(polygons, f"other_id long, layer int, other_shape {SHAPE}")
    got = {r.point_id: (r.layer, r.other_id) for r in geo.point_in_polygon(a, b).collect()}
    shapes = [(layer, k, arrays(s)) for k, layer, s in polygons]
    for k, x, y in points:
        assert got[k] == min(((layer, i) for layer, i, s in shapes if kernels.contains(s, x, y)), default=(None, None))
    sizes = geo._first_tiles(b, 500.0, geo.TILE_MOST).groupBy("level", "i", "j").count()
    assert sizes.agg(F.max("count")).first()[0] <= geo.TILE_MOST


def test_lines_beyond_a_side_are_apart():
    """A line in the prolongation of a side doesn't meet it."""
    shape = arrays(box(0, 0, 80, 80))
    for line, apart in (([100, 0, 400, 0], 20), ([-30, 80, -10, 80], 10), ([80, 95, 80, 200], 15), ([60, 0, 400, 0], 0), ([80, 80, 90, 80], 0)):
        assert kernels.distance(shape, np.array([line], float)) == pytest.approx(apart)


def test_rows_of_a_batch_are_measured_together():
    """Each as if alone, whatever their sizes."""
    rng = random.Random(7)
    rows = [(kernels.edges(arrays(star(rng, 50, 50, 40, rng.randrange(3, 7)))), np.array([[rng.uniform(0, 100) for _ in range(4)] for _ in range(rng.randrange(0, 4))]).reshape(-1, 4)) for _ in range(60)]
    assert kernels.distances(rows).tolist() == [kernels.distances([r])[0] for r in rows]
    boxes = [np.array([x, 20.0, x + 50, 70.0]) for x in range(60)]
    full = [(*r, b) for r, b in zip(rows, boxes, strict=True)]
    assert kernels.lengths_near(full, 3.0) == pytest.approx([kernels.length_near(*r[:2], 3.0, tuple(r[2])) for r in full])


def test_shapes_to_measure_are_dealt_by_number(spark):
    a = spark.createDataFrame([(str(k), box(k * 100, 0, k * 100 + 80, 80)) for k in range(40)], f"parcel_id string, shape {SHAPE}")
    b = spark.createDataFrame([(k, [[[k * 100.0, 0.0], [k * 100.0 + 80, 0.0]]]) for k in range(0, 40, 2)], f"other_id long, other_shape {SHAPE}")
    out = geo.frontage_metrics(a, b, search=5.0)
    assert out._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2
    assert {r.parcel_id: (r.frontage_m, r.nearest_m) for r in out.collect()} == {str(k): (80.4, 0.0) if k % 2 == 0 else (None, None) for k in range(40)}
