"""Queries on geometry, on boxes of degrees or metres, whose measures have closed forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import geodesic_m, geodesic_sql, to_utm17
from ..operators import geo
from .bindings import END
from .catalogue import Tables, query

#: Parcels as boxes of metres, and hazards as boxes of suppliers that overlap each other.
_BOX = "select parcel_id, round((x0 + 82.0) * 100000) as ax0, round((y0 - 26.5) * 100000) as ay0, round((x0 + 82.0) * 100000) + 80 as ax1, round((y0 - 26.5) * 100000) + 80 as ay1 from {boxes}"
_HAZARD = "select s_suppkey as other_id, cast(s_suppkey * 37 % 4000 as double) as bx0, cast(s_suppkey * 91 % 900 as double) as by0, cast(s_suppkey * 37 % 4000 + 150 + s_suppkey % 7 * 20 as double) as bx1, cast(s_suppkey * 91 % 900 + 120 as double) as by1 from {supplier}"
_PLANE = ", pb as (" + _BOX.format(boxes="boxes") + "), hz as (" + _HAZARD.format(supplier="supplier") + ")"


def _ring(a: str) -> F.Column:
    x0, y0, x1, y1 = (F.col(f"{a}{c}").cast("double") for c in ("x0", "y0", "x1", "y1"))
    return F.array(F.array(F.array(x0, y0), F.array(x0, y1), F.array(x1, y1), F.array(x1, y0), F.array(x0, y0)))


def parcels(t: Tables) -> DataFrame:
    return t.sql(_BOX, boxes=t("boxes")).select("parcel_id", _ring("a").alias("shape"))


def hazards(t: Tables, n: int | None = None) -> DataFrame:
    h = t.sql(_HAZARD, supplier=t("supplier")).select("other_id", _ring("b").alias("other_shape"))
    return h.where(F.col("other_id") % n == 0) if n else h


#: Hazards that do not meet, so that covered areas add up.
_APART = "select s_suppkey as other_id, cast(s_suppkey % 20 * 220 as double) as bx0, cast(floor(s_suppkey / 20) * 140 as double) as by0, cast(s_suppkey % 20 * 220 + 150 as double) as bx1, cast(floor(s_suppkey / 20) * 140 + 120 as double) as by1 from {supplier}"


@query("p2_overlap_pct", _PLANE + ", ap as (" + _APART.format(supplier="supplier") + "), m as (select parcel_id, count(*) as n, sum(greatest(0, least(ax1, bx1) - greatest(ax0, bx0)) * greatest(0, least(ay1, by1) - greatest(ay0, by0))) as area from pb join ap on ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1 group by parcel_id) select pb.parcel_id, coalesce(n, 0) as hazards, round(coalesce(area, 0) / 64.0, 4) as overlap_pct, cast(null as varchar) as error from pb left join m using (parcel_id)")
def _(t: Tables) -> DataFrame:
    h = t.sql(_APART, supplier=t("supplier")).select("other_id", _ring("b").alias("other_shape"))
    return geo.overlap_pct(parcels(t), h)


#: The cuts of hazards within a parcel make a grid; a cell of it counts once if any hazard covers its middle.
_UNION = """
, met as (select parcel_id, ax0, ay0, ax1, ay1, bx0, by0, bx1, by1 from pb join hz on ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1)
, xs as (select distinct parcel_id, least(greatest(unnest([ax0, ax1, bx0, bx1]), ax0), ax1) as x from met), xc as (select parcel_id, x as x0, lead(x) over (partition by parcel_id order by x) as x1 from xs)
, ys as (select distinct parcel_id, least(greatest(unnest([ay0, ay1, by0, by1]), ay0), ay1) as y from met), yc as (select parcel_id, y as y0, lead(y) over (partition by parcel_id order by y) as y1 from ys)
, hit as (select distinct parcel_id, x0, x1, y0, y1 from xc join yc using (parcel_id) join met using (parcel_id) where x1 is not null and y1 is not null and bx0 <= x0 and x1 <= bx1 and by0 <= y0 and y1 <= by1)
, ar as (select parcel_id, sum((x1 - x0) * (y1 - y0)) as area from hit group by parcel_id), ct as (select parcel_id, count(*) as n from met group by parcel_id)
select pb.parcel_id, coalesce(n, 0) as hazards, round(coalesce(area, 0) / 64.0, 4) as overlap_pct, cast(null as varchar) as error from pb left join ct using (parcel_id) left join ar using (parcel_id)"""


@query("p2_overlap_union", _PLANE + _UNION)
def _(t: Tables) -> DataFrame:
    """All hazards, which overlap each other: their union counts once."""
    return geo.overlap_pct(parcels(t), hazards(t))


_LINE = "select s_suppkey as other_id, cast(s_suppkey * 53 % 5000 as double) as lx, cast(s_suppkey * 29 % 4000 as double) as ly from {supplier}"


def lines(t: Tables) -> DataFrame:
    point = lambda x: F.array(F.col("lx") + x, F.col("ly"))
    return t.sql(_LINE, supplier=t("supplier")).select("other_id", F.array(F.array(point(0.0), point(300.0))).alias("other_shape"))


@query("p3_lines_within", ", pb as (" + _BOX.format(boxes="boxes") + "), ln as (" + _LINE.format(supplier="supplier") + "), d as (select parcel_id, other_id, sqrt(pow(greatest(0, lx - ax1, ax0 - (lx + 300)), 2) + pow(greatest(0, ly - ay1, ay0 - ly), 2)) as distance_m from pb join ln on ax0 - 30 <= lx + 300 and lx <= ax1 + 30 and ay0 - 30 <= ly and ly <= ay1 + 30) select * from d where distance_m <= 30")
def _(t: Tables) -> DataFrame:
    return geo.lines_within(parcels(t), lines(t), 30.0)


@query("p4_frontage", ", pb as (" + _BOX.format(boxes="boxes") + "), e as (select parcel_id, 0.8 * 100 as side from pb where cast(parcel_id as bigint) % 2 = 0) select pb.parcel_id, case when side is not null then 80.4::double end as frontage_m, case when side is not null then round(80.4::double / 0.3048, 4) end as frontage_ft, case when side is not null then 0.0::double end as nearest_m, case when side is null then 'no_mapped_line_review' else 'measured_review' end as status, false as verified from pb left join e using (parcel_id)")
def _(t: Tables) -> DataFrame:
    """Lines along the lower sides of every second box: the side, and 0.2 m of each neighbouring side, lie within reach."""
    b = t.sql(_BOX, boxes=t("boxes")).where("cast(parcel_id as bigint) % 2 = 0")
    point = lambda x: F.array(F.col(x).cast("double"), F.col("ay0").cast("double"))
    own = b.select(F.col("parcel_id").cast("bigint").alias("other_id"), F.array(F.array(point("ax0"), point("ax1"))).alias("other_shape"))
    return geo.frontage_metrics(parcels(t), own, search=5.0)


_POINT = "select c_custkey as point_id, cast(c_custkey * 17 % 4100 as double) + 0.5 as x, cast(c_custkey * 23 % 1000 as double) + 0.5 as y from {customer}"


@query("p5_point_in_polygon", _PLANE + ", pt as (" + _POINT.format(customer="customer") + "), h as (select point_id, min(struct_pack(layer := cast(other_id % 6 as int), other_id := other_id)) as f from pt join hz on x > bx0 and x < bx1 and y > by0 and y < by1 group by point_id) select point_id, f.layer as layer, f.other_id as other_id from pt left join h using (point_id)")
def _(t: Tables) -> DataFrame:
    polygons = hazards(t).withColumn("layer", (F.col("other_id") % 6).cast("int"))
    return geo.point_in_polygon(t.sql(_POINT, customer=t("customer")), polygons)


@query("p6_ring_centroid", ", pb as (" + _BOX.format(boxes="boxes") + ") select parcel_id, case when cast(parcel_id as bigint) % 3 = 0 then 1.5 else round((ax0 * 3 + ax1 * 2) / 5, 6) end as x, round((ay0 * 3 + ay1 * 2) / 5, 6) as y from pb")
def _(t: Tables) -> DataFrame:
    given = F.when(F.col("parcel_id").cast("bigint") % 3 == 0, 1.5)
    c = parcels(t).select("parcel_id", geo.ring_centroid(F.col("shape"), given, F.lit(None).cast("double")).alias("c"))
    return c.select("parcel_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


@query("p7_geodesic", f"select parcel_id, round({geodesic_sql('x0', 'y0', 'x1', 'y1')}, 3) as metres from boxes")
def _(t: Tables) -> DataFrame:
    return t("boxes").select("parcel_id", F.round(geodesic_m(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]), 3).alias("metres"))


def _utm17_sql(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing in SQL by another series than the operator's: the meridian's arc and powers of the distance from it (Snyder 1987), good to a millimetre in mid zone."""
    e2 = (2 - 1 / 298.257222101) / 298.257222101
    p = e2 / (1 - e2)
    phi, d = f"radians({lat})", f"radians({lon} + 81.0)"
    n, t, c, a = f"(6378137.0 / sqrt(1 - {e2!r} * pow(sin({phi}), 2)))", f"pow(tan({phi}), 2)", f"({p!r} * pow(cos({phi}), 2))", f"(cos({phi}) * {d})"
    arc = f"(6378137.0 * ({1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256!r} * {phi} - {3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024!r} * sin(2 * {phi}) + {15 * e2**2 / 256 + 45 * e2**3 / 1024!r} * sin(4 * {phi}) - {35 * e2**3 / 3072!r} * sin(6 * {phi})))"
    east = f"500000 + 0.9996 * {n} * ({a} + (1 - {t} + {c}) * pow({a}, 3) / 6 + (5 - 18 * {t} + pow({t}, 2) + 72 * {c} - 58 * {p!r}) * pow({a}, 5) / 120)"
    north = f"0.9996 * ({arc} + {n} * tan({phi}) * (pow({a}, 2) / 2 + (5 - {t} + 9 * {c} + 4 * pow({c}, 2)) * pow({a}, 4) / 24 + (61 - 58 * {t} + pow({t}, 2) + 600 * {c} - 330 * {p!r}) * pow({a}, 6) / 720))"
    return east, north


# The two series agree to a millimetre, so a coordinate seldom lies between their roundings to ten metres; tests compare them to the millimetre.
@query("p1_to_utm17", f", u as (select parcel_id, {_utm17_sql('x0', 'y0')[0]} as e, {_utm17_sql('x0', 'y0')[1]} as n from boxes) select parcel_id, cast(floor(e / 10 + 0.5) as bigint) as easting_10m, cast(floor(n / 10 + 0.5) as bigint) as northing_10m from u")
def _(t: Tables) -> DataFrame:
    east, north = to_utm17(F.col("x0").cast("double"), F.col("y0").cast("double"))
    return t("boxes").select("parcel_id", F.floor(east / 10 + 0.5).alias("easting_10m"), F.floor(north / 10 + 0.5).alias("northing_10m"))


_SUBJECT = "select lpad(cast(s_suppkey + 1 as string), 18, '0') as subject_id, -82.0 + (s_suppkey % 50) * 0.001 as lon, 26.5 + floor(s_suppkey / 50) * 0.001 as lat, case when s_suppkey % 3 = 0 then 'R1' else 'R2' end as zoning, 1.0 + s_suppkey % 4 as acres, case when s_suppkey % 2 = 0 then 'land' else 'home' end as property_type from {supplier}"
_SOLD = "select lpad(cast(l_partkey + 1 as string), 18, '0') as sale_parcel, -82.0 + (l_partkey % 50) * 0.001 as lon, 26.5 + floor(l_partkey / 50) * 0.001 as lat, case when l_partkey % 3 = 0 then 'R1' else 'R2' end as sale_zoning, 0.5 + l_linenumber as sale_acres, case when l_linenumber <= 2 then '01' when l_linenumber <= 4 then '02' else '05' end as code, l_extendedprice as price, cast(l_shipdate as date) as sale_date, case when l_orderkey % 40 = 0 then '' else cast(l_orderkey as string) end as instrument, case when l_orderkey % 9 = 0 then 'I' when l_orderkey % 31 > 0 then 'V' end as vacant, case when l_linenumber % 7 = 5 then '11' else '01' end as second_code from {lineitem}"
_PAIRS = ", sb as (" + _SUBJECT.format(supplier="supplier") + "), sl as (" + _SOLD.format(lineitem="lineitem") + f"), nr as (select sb.subject_id, sb.zoning, sb.acres, sl.*, {geodesic_sql('sb.lon', 'sb.lat', 'sl.lon', 'sl.lat')} as d from sb join sl on sl.sale_parcel <> sb.subject_id and abs(sb.lat - sl.lat) < 0.02 and abs(sb.lon - sl.lon) < 0.021), cp as (select * from nr where d <= 2000 and zoning = sale_zoning and sale_acres between acres * 0.5 and acres * 2 and vacant = 'V' and code in ('01', '02') and second_code in ('01', '02') and length(instrument) > 0 and price > 100 and sale_date between date '1998-12-31' and date '{END}')"


def subjects(t: Tables) -> DataFrame:
    return t.sql(_SUBJECT, supplier=t("supplier")).withColumns({c: F.col(c).cast("double") for c in ("lon", "lat", "acres")})


def sold(t: Tables) -> DataFrame:
    return t.sql(_SOLD, lineitem=t("lineitem")).withColumns({c: F.col(c).cast("double") for c in ("lon", "lat", "sale_acres")})


def comps(t: Tables) -> DataFrame:
    return geo.comps_within_radius(subjects(t), sold(t), END)


@query("j11_comps_within_radius", _PAIRS + " select subject_id, sale_parcel, instrument, count(*) as n, round(max(d), 2) as distance_m from cp group by all")
def _(t: Tables) -> DataFrame:
    return geo.comps_by_instrument(subjects(t), sold(t), END).withColumn("distance_m", F.round("distance_m", 2))


@query("w2_one_sale_per_instrument", _PAIRS + " select subject_id, instrument, min(sale_parcel) as sale_parcel from cp group by all")
def _(t: Tables) -> DataFrame:
    return geo.one_sale_per_instrument(comps(t)).select("subject_id", "instrument", "sale_parcel")


@query("c23_comp_median", _PAIRS + ", md as (select subject_id, count(*) as comps, median(price / sale_acres) as pa, median(price) as m from cp group by subject_id) select subject_id, coalesce(comps, 0) as comps, round(case when property_type = 'land' then pa * acres else m end, 4) as median_reference, false as promoted from sb left join md using (subject_id)")
def _(t: Tables) -> DataFrame:
    return geo.comp_median(subjects(t), comps(t))


@query("j12_radius_sales", ", sb as (" + _SUBJECT.format(supplier="supplier") + "), sl as (" + _SOLD.format(lineitem="lineitem") + f"), nr as (select subject_id, sale_parcel, instrument, {geodesic_sql('sb.lon', 'sb.lat', 'sl.lon', 'sl.lat')} as d from sb join sl on sale_parcel <> subject_id and price > 0), rk as (select *, row_number() over (partition by subject_id order by round(d, 6), sale_parcel, instrument) as n from nr where d <= {5 * 1609.344!r}) select subject_id, count(*) as n, round(max(d), 2) as farthest_m from rk where n <= 30 group by subject_id")
def _(t: Tables) -> DataFrame:
    near = geo.radius_sales(subjects(t), sold(t))
    return near.groupBy("subject_id").agg(F.count("*").alias("n"), F.round(F.max("distance_m"), 2).alias("farthest_m"))


@query("j10_legacy_road_join", ", r as (select s_suppkey as id, case when s_suppkey % 4 = 0 then '' else 'A' || cast(s_suppkey as varchar) end as k1, case when s_suppkey % 3 = 0 then ' ' else 'B' || cast(s_suppkey as varchar) end as k2 from supplier) select id, nullif(trim(k1), '') as k1, nullif(trim(k2), '') as k2, 'PAVED' as surface from r where not (trim(k1) = '' and trim(k2) = '') and id % 2 = 0")
def _(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    keys = {"k1": F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("A"), k.cast("string"))), "k2": F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("B"), k.cast("string")))}
    roads = t("supplier").select(k.alias("id"), *[c.alias(n) for n, c in keys.items()])
    return geo.legacy_road_join(roads, roads.where("id % 2 = 0").select("k1", "k2", F.lit("PAVED").alias("surface")), ("k1", "k2"))


@query("r11_overlap_flags", "select s_suppkey as id, 'legal_access_unverified' || case when s_suppkey % 3 > 0 then ',flood_revision_area' else '' end || case when s_suppkey % 20 >= 10 then ',wetland_sources_differ' else '' end || case when s_suppkey % 5 > 0 then ',pavement_unconfirmed' else '' end as flags from supplier")
def _(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    rows = t("supplier").select(k.alias("id"), (k % 3).cast("double").alias("revision_pct"), (k % 20 + 5).cast("double").alias("wetland_a_pct"), F.lit(5.0).alias("wetland_b_pct"), F.when(k % 5 == 0, True).alias("paved"))
    return geo.overlap_flags(rows).select("id", F.array_join("flags", ",").alias("flags"))
