"""The nearest points of each subject: a quadtree by density, descended level by level with bounds on the distance.

Cells are split in sixteen until they hold no more than a leaf may. A subject begins with the cells of the coarsest level
within reach. At each level its cells are bounded below and above by distance: as soon as the nearest upper
bounds cover as many points as it wants, cells that begin farther away are dropped, and the rest are replaced by their
parts. Only points of the leaves that are left are met, so a subject beside a town meets its outskirts alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geodesy import geodesic_m

#: Levels of cells; each divides both sides of the one before by 2 ** BITS.
LEVELS, BITS = 7, 2
#: Metres of a degree: of latitude at least and at most, of longitude at the equator at most; and what bounds are widened by.
LAT_LEAST, LAT_MOST, LON_MOST, SLACK = 110_570.0, 111_700.0, 111_330.0, 1.002
#: Degrees of an area. There are 720 by 360 of them at most, so a set of areas is small enough to be sent to all tasks.
AREA = 0.5


def _width(metres: float) -> float:
    """Degrees of a cell of the coarsest level."""
    return metres / LAT_LEAST


def _finest(metres: float) -> float:
    return _width(metres) / (1 << BITS * (LEVELS - 1))


def _parents() -> dict[str, Column]:
    """x and y, at a row's level, of the finest cell fx, fy."""
    return {c: F.expr(f"shiftright(f{c}, {BITS} * ({LEVELS - 1} - level))") for c in "xy"}


def quadtree(points: DataFrame, metres: float, leaf: int, held: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes: level, x, y, n, is_leaf, of every cell that isn't within a leaf; leaves: fx, fy, level of each finest cell) of points (lon, lat), or of places that hold so many each.

    A leaf holds at most `leaf` points, but for cells of the finest level, of some metres.
    """
    fine = points.groupBy(*_fine(metres)).agg((F.sum(held) if held else F.count("*")).alias("n"))
    up = fine.select("fx", "fy", "n", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    up = up.withColumns(_parents())
    cells = up.groupBy("level", "x", "y").agg(F.sum("n").alias("n")).withColumn("is_leaf", (F.col("n") <= leaf) | (F.col("level") == LEVELS - 1))
    leaves = up.drop("n").join(cells.where("is_leaf"), ["level", "x", "y"]).groupBy("fx", "fy").agg(F.min("level").alias("level"))
    return cells, leaves


def _fine(metres: float) -> tuple[Column, Column]:
    size = _finest(metres)
    return F.floor(F.col("lon") / size).alias("fx"), F.floor(F.col("lat") / size).alias("fy")


def _limits(size: Column) -> tuple[Column, Column]:
    """Lower and upper bound of the metres from (s_lon, s_lat) to the cell x, y of so many degrees."""
    west, south = F.col("x") * size, F.col("y") * size
    east, north = west + size, south + size
    gap = lambda at, a, b: F.greatest(a - at, at - b, F.lit(0.0))
    far = lambda at, a, b: F.greatest(F.abs(at - a), F.abs(b - at))
    high = F.least(F.greatest(F.abs(south), F.abs(north), F.abs("s_lat")), F.lit(90.0))
    low = F.when((south <= 0) & (north >= 0), 0.0).otherwise(F.least(F.abs(south), F.abs(north), F.abs("s_lat")))
    norm = lambda a, b: F.sqrt(a * a + b * b)
    near = norm(gap(F.col("s_lon"), west, east) * LAT_LEAST * F.cos(F.radians(high)), gap(F.col("s_lat"), south, north) * LAT_LEAST)
    most = norm(far(F.col("s_lon"), west, east) * LON_MOST * F.cos(F.radians(low)), far(F.col("s_lat"), south, north) * LAT_MOST)
    return near / SLACK, most * SLACK


def _pruned(cells: DataFrame, metres: float) -> DataFrame:
    """Cells of each subject without those that begin beyond reach, or beyond where nearer cells surely hold all that it wants."""
    size = F.lit(_finest(metres)) * F.pow(F.lit(2.0), F.lit(BITS) * (LEVELS - 1 - F.col("level")))
    near, far = _limits(size)
    of_subject = Window.partitionBy("subject_id")
    held = F.sum("n").over(of_subject.orderBy("far").rowsBetween(Window.unboundedPreceding, 0))
    out = cells.withColumns({"near": near, "far": far}).where(F.col("near") <= metres)
    out = out.withColumn("enough", F.when(held >= F.col("wanted"), F.col("far")))
    return out.withColumn("reach", F.min("enough").over(of_subject)).where(F.col("reach").isNull() | (F.col("near") <= F.col("reach"))).drop("near", "far", "enough", "reach")


def fewest(points: DataFrame, key: str, order: tuple[str, ...], most: int) -> DataFrame:
    """Points of one place are equally far from everyone, so of each (place, key) the first `most` and of a place the first 2 * most can be among a subject's, whichever key it leaves out."""
    n = F.row_number().over(Window.partitionBy("lon", "lat", key).orderBy(*order))
    kept = points.withColumn("turn", n).where(F.col("turn") <= most)
    n = F.row_number().over(Window.partitionBy("lon", "lat").orderBy(key, *order))
    return kept.withColumn("turn", n).where(F.col("turn") <= 2 * most).drop("turn")


def tally(points: DataFrame, key: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(places: lon, lat, n; own: subject_id, own): how many points `fewest` leaves of each place, and at most of each key, from counts alone."""
    each = points.groupBy("lon", "lat", key).agg(F.least(F.count("*"), F.lit(most)).alias("n"))
    places = each.groupBy("lon", "lat").agg(F.least(F.sum("n"), F.lit(2 * most)).alias("n"))
    return places, each.groupBy(F.col(key).alias("subject_id")).agg(F.sum("n").alias("own"))


def _reach(metres: float, lat: Column) -> tuple[Column, Column]:
    """Degrees of longitude and latitude within which a subject's points lie."""
    side = F.lit(metres * SLACK / LAT_LEAST)
    return side / F.cos(F.radians(F.least(F.abs(lat) + metres / LAT_LEAST, F.lit(89.9)))), side


def _span(at: Column, reach: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor((at - reach) / width), F.floor((at + reach) / width)))


def within_areas(points: DataFrame, subjects: DataFrame, metres: float) -> DataFrame:
    """The points of the areas that any subject reaches into; the others are too far from all."""
    area = lambda i, j: F.pmod(i, F.lit(720)) * 360 + F.pmod(j, F.lit(360))
    side, height = _reach(metres, F.col("lat"))
    met = subjects.select(_span(F.col("lon"), side, AREA).alias("i"), "lat").select("i", _span(F.col("lat"), height, AREA).alias("j"))
    met = met.select(area(F.col("i"), F.col("j")).alias("area")).distinct()
    own = area(F.floor(F.col("lon") / AREA), F.floor(F.col("lat") / AREA))
    return points.withColumn("area", own).join(F.broadcast(met), "area", "left_semi").drop("area")


def nearest(subjects: DataFrame, points: DataFrame, key: str, order: tuple[str, ...], metres: float, most: int, leaf: int = 64) -> DataFrame:
    """Each subject (subject_id unique, lon, lat) with its at most `most` nearest points (lon, lat, key, ...) within so many metres whose key isn't its id.

    Equally near ones, to a micrometre, come by key and order. Adds distance_m and n, the place from 1. Coordinates that are null
    or beyond 89 degrees of latitude meet nothing. Only points of areas that subjects reach into are moved. Counts of cells are added
    in partial sums; a task of the last step holds leaves and, of each subject, a heap of `most` points a task.
    """
    placed = lambda df: df.where(F.col("lat").between(-89, 89) & F.col("lon").isNotNull())
    points = within_areas(placed(points), placed(subjects), metres)
    places, own = tally(points, key, most)
    cells, leaves = quadtree(places, metres, leaf, "n")
    lat, lon = F.col("s_lat"), F.col("s_lon")
    who = placed(subjects).select("subject_id", F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat"))
    tasks = int(subjects.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # subjects are few bytes and much work, so they are dealt by number
    who = who.repartition(tasks, "subject_id").join(own, "subject_id", "left").withColumn("wanted", F.coalesce("own", F.lit(0)) + most).drop("own")
    side, height = _reach(metres, lat)
    at = who.withColumn("x", _span(lon, side, _width(metres))).withColumn("y", _span(lat, height, _width(metres)))
    found = _pruned(at.join(cells.where("level = 0"), ["x", "y"]), metres)
    for level in range(1, LEVELS):
        part = cells.where(F.col("level") == level).select(
            F.expr(f"shiftright(x, {BITS})").alias("px"), F.expr(f"shiftright(y, {BITS})").alias("py"), *[F.col(c).alias(f"p_{c}") for c in ("level", "x", "y", "n", "is_leaf")]
        )
        on = (F.col("x") == F.col("px")) & (F.col("y") == F.col("py")) & ~F.col("is_leaf")
        parts = found.join(part, on, "left")
        fresh = {c: F.coalesce(F.col(f"p_{c}"), F.col(c)) for c in ("level", "x", "y", "n", "is_leaf")}
        found = _pruned(parts.select("subject_id", "s_lon", "s_lat", "wanted", *[v.alias(c) for c, v in fresh.items()]), metres)
    held = fewest(points, key, order, most).withColumns(dict(zip(("fx", "fy"), _fine(metres), strict=True))).join(leaves, ["fx", "fy"])
    held = held.withColumns(_parents()).drop("fx", "fy")
    pairs = found.select("subject_id", "s_lon", "s_lat", "level", "x", "y").join(held, ["level", "x", "y"]).drop("level", "x", "y")
    pairs = pairs.withColumn("distance_m", geodesic_m(lon, lat, F.col("lon"), F.col("lat")))
    pairs = pairs.where((F.col("distance_m") <= metres) & (F.col(key) != F.col("subject_id")))
    place = F.row_number().over(Window.partitionBy("subject_id").orderBy(F.round("distance_m", 6), key, *order))
    first = pairs.withColumn("n", place).where(F.col("n") <= most).drop("s_lon", "s_lat")
    return subjects.withColumnsRenamed({"lon": "s_lon", "lat": "s_lat"}).join(first, "subject_id")
