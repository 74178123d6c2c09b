"""Rules that close or hold: bad keys, repeated keys, odd lines, other counties, sparse places; and coordinates against another series."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcel_jobs.functions.geodesy import geodesic_m, to_utm17
from parcel_jobs.functions.scalars import county_config, money
from parcel_jobs.operators import geo, profile, qualification, records, screening, snapshots
from parcel_jobs.operators.gates import GateClosed
from parcel_jobs.sources import feeds

KEY = lambda i: f"{i:018d}"
PROPERTY, REGISTRY = "id long, parcel_id string", "property_id long, parcel_key string, refreshed_at timestamp"


def test_registry_refuses_bad_and_repeated_keys(spark):
    registry = spark.createDataFrame([(1, KEY(1), None)], REGISTRY)
    table = lambda *rows: spark.createDataFrame(rows, PROPERTY)
    fine = table((1, KEY(1)), (2, "00-00-00-000000-000002"), (3, " "), (4, None))
    assert sorted(r["property_id"] for r in snapshots.refresh_registry(fine, registry, "2024-01-01").collect()) == [1, 2]
    for bad in (table((1, KEY(1)), (2, "12")), table((2, "00-00-00-000000-000002"), (3, KEY(2)))):
        with pytest.raises(GateClosed):
            snapshots.refresh_registry(bad, registry, "2024-01-01")


SALE = "parcel_id string, sale_id string, ln_num string, saledt string, price string, book string, page string, saletype string, instrtyp string, instrtyp_dscr string, foreclosure string"


def sale(parcel=KEY(1), line="1", **other):
    row = dict(parcel_id=parcel, sale_id="7", ln_num=line, saledt="01/02/1999", price="500", book="1", page="2", saletype="I", instrtyp="01", instrtyp_dscr="Q-Per examination of deed", foreclosure="N") | other
    return tuple(row.values())


def test_screening_wants_unique_inputs(spark):
    parcel = spark.createDataFrame([(KEY(1), "0100", "RES", "Single Family"), (KEY(2), "9910", "RES", "Single Family")], "parcel_id string, dorus_code string, dordesc string, dordesc1 string")
    sales = spark.createDataFrame([sale(), sale(KEY(2), page="3", price="100.00", saletype=" X "), sale(KEY(3), page="", sale_id="", instrtyp="05", foreclosure=""), sale(line="2", saledt="", page="9")], SALE)
    got = {r["parcel_id"]: r for r in screening.screen_sales(sales, parcel, parcel.limit(1), "1998-01-01", "2000-12-31").collect()}
    assert got[KEY(1)]["reasons"] == [] and got[KEY(1)]["status"] == "candidate_for_comparability_review" and got[KEY(1)]["is_target"]
    assert got[KEY(2)]["reasons"] == ["county_classification_mismatch", "county_inaccessible_tract", "nominal_price_screen_at_most_100", "sale_type_unrecognized"]
    assert got[KEY(1)]["observations"] == ["sale_id_not_globally_unique", "sale_id_reference_repeated"]
    assert got[KEY(3)]["reasons"] == ["current_parcel_missing", "foreclosure_flag_or_unknown", "qualification_code_outside_candidate_contract", "recording_reference_missing_or_unrecognized", "sale_id_missing_or_unrecognized"]
    for a, b in ((sales, parcel.unionAll(parcel.limit(1))), (sales.unionAll(sales.limit(1)), parcel)):
        with pytest.raises(GateClosed):
            screening.screen_sales(a, b, parcel, "1998-01-01", "2000-12-31")


def test_gaps_may_be_wide(spark):
    rows = [("a", 1), ("a", 2147483647), ("b", 1), ("b", 3), ("b", 5), ("b", 11), ("c", 1), ("c", 2), ("d", 4), ("d", 4), ("d", 7), ("e", 9)]
    got = {r["k"]: (r["n"], r["kind"], r["first_missing"]) for r in profile.line_gaps(spark.createDataFrame(rows, "k string, ln int"), "k", F.col("ln")).collect()}
    assert got == {"a": (2, "gapped", "2,3,4,5,6"), "b": (4, "gapped", "2,4,6,7,8"), "c": (2, "contiguous", ""), "d": (3, "duplicate", "5,6")}


def test_legal_records_are_strict(spark):
    head = '"000000000000000001","1","12","34","56","1","1",'
    lines = [head + '"RUN 12" E"', head + '"no end', head.replace('"12"', '"S1"') + '"x"', head + '"nul \0"', head + '"two\nlines"', "", None]
    got = records.parse_legal_strict(spark.createDataFrame(list(enumerate(lines)), "n int, value string")).orderBy("n").collect()
    assert [r["error"] for r in got] == [None, "unbalanced_or_unknown", "unbalanced_or_unknown", "nul_byte", None, "unbalanced_or_unknown", "unbalanced_or_unknown"]
    assert got[0]["dscr"] == 'RUN 12" E' and got[0]["section"] == "12" and got[2]["dscr"] is None


def test_a_file_without_records_is_many_rows(spark):
    rows = [("f", i, f"line {i}") for i in range(300)]
    got = records.reassemble_legal(spark.createDataFrame(rows, "file string, line_no long, value string")).collect()
    assert len(got) == 300 and all(r["record"] == 0 and r["n_lines"] == 1 and r["value"] == f"line {r['first_line']}" for r in got)


def test_parties_are_in_order_of_pages(spark):
    rows = [(2, 0, "late", "f", "01/02/2024", "p2", ""), (1, 0, "first", "f", "01/01/2024", "", "LOT"), (1, 1, "next", "f", "01/03/2024", "p1", "")]
    p = spark.createDataFrame(rows, "page_id int, ordinal int, name string, file_no string, date string, parcel_id string, legal string")
    assert records.document_rollup(p).first() == ("f", "first", "01/01/2024", "p1", "LOT", 3)
    same = records.party_dedupe(p.withColumn("name", F.lit("n"))).collect()
    assert len(same) == 1 and (same[0]["page_id"], same[0]["ordinal"], same[0]["date"]) == (2, 0, "01/02/2024")


def test_repeated_certificates_with_nulls(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", "x"), (4, None, None)], "k int, p string, c string")
    assert {r["k"]: r["quarantined"] for r in records.duplicate_certificates(rows, ["p", "c"]).collect()} == {1: True, 2: True, 3: False, 4: False}


def test_auction_pages(spark):
    body = "x Case Number 2024-1 Case Type: A Case of\n wine Parcel ID 123456789012345678 and Assessed Value: $1,200.5 Auction Starts: 01/02/2024 9:05 am et Name On Title:  Jo Legal Description: LOT: 1"
    r = records.parse_auction_details(spark.createDataFrame([(1, body), (2, ""), (3, None)], "auction_id int, body string")).orderBy("auction_id").collect()
    assert (r[0]["case_number"], r[0]["case_type"], r[0]["parcel_id"], r[0]["auction_time"]) == ("2024-1", "A Case of wine Parcel ID 123456789012345678 and", "12-34-56-789012-345678", "9:05 am et")
    assert float(r[0]["assessed_value"]) == 1200.5 and r[0]["name_on_title"] == "Jo" and r[0]["legal_description"] == "LOT: 1" and r[0]["final_judgment"] is None
    assert r[1]["case_number"] is None and r[2]["auction_date"] is None


def test_money(spark):
    df = spark.createDataFrame([("$1,200.5",), ("a 7 b",), ("12.345",), ("none",), (None,)], "c string")
    assert [None if r[0] is None else float(r[0]) for r in df.select(money(F.col("c"))).collect()] == [1200.5, 7, 12.34, None, None]


def test_counties_hold_their_own_reviews(spark):
    results = spark.createDataFrame([("p1", "Polk", 1, qualification.FLOODED), ("p2", "Lee", 2, qualification.HOLD), ("p3", "Polk", 3, qualification.WET), ("p4", "Lee", 4, qualification.HOLD), ("p5", "Lee", 5, qualification.HOLD)], "parcel_id string, county string, property_id long, status string")
    evidence = spark.createDataFrame([("p1", "POLK_PARCEL_GEOMETRY", True), ("p2", "POLK_PARCEL_GEOMETRY", True), ("p3", "POLK_PARCEL_GEOMETRY", True), ("p4", "LEE_PARCEL_GEOMETRY", False), ("p5", "LEE_PARCEL_GEOMETRY", None)], "parcel_id string, source string, identity_verified boolean")
    reviews = spark.createDataFrame([(3, "approved", "a", "b", "c", ["z"]), (9, qualification.HELD, "a", "b", "c", [])], "property_id long, status string, flood_status string, wetlands_status string, access_status string, fatal_flags array<string>")
    got = {r["property_id"]: tuple(r)[1:] for r in qualification.sync_dd_holds(results, evidence, reviews).collect()}
    assert got == {1: (qualification.HELD, "failed", "review_required", "review_required", [qualification.FLOODED]), 3: ("approved", "a", "b", "c", ["z"]), 9: (qualification.HELD, "a", "b", "c", [])}


def test_county_dimension(spark):
    rows = {r["county"]: r for r in county_config(spark).collect()}
    assert len(rows) == 7 and rows["lee"]["identity_field"] == "STRAP" and "SURFACE" in rows["lee"]["road_fields"] and rows["osceola"]["road_field"] is None
    assert all(r["identity_field"] in r["parcel_fields"] for r in rows.values())


def test_nearest_sales_in_dense_and_sparse_places(spark):
    rng = random.Random(4)
    near = [(f"s{i}", -82 + rng.uniform(-0.002, 0.002), 26.5 + rng.uniform(-0.002, 0.002), 5.0, str(i % 3)) for i in range(80)]
    far = [(f"t{i}", -80 + rng.uniform(-0.06, 0.06), 26.5 + rng.uniform(-0.06, 0.06), float(i % 4), str(i)) for i in range(60)]
    sales = spark.createDataFrame(near + far, "sale_parcel string, lon double, lat double, price double, instrument string")
    subjects = spark.createDataFrame([("s1", -82.0, 26.5), ("b", -80.0, 26.5), ("none", -75.0, 26.5)], "subject_id string, lon double, lat double")
    got = geo.radius_sales(subjects, sales, miles=5.0, most=30).collect()
    for name, lon, lat in [("s1", -82.0, 26.5), ("b", -80.0, 26.5), ("none", -75.0, 26.5)]:
        distance = {r["sale_parcel"]: r["d"] for r in sales.where("price > 0").select("sale_parcel", geodesic_m(F.lit(lon), F.lit(lat), F.col("lon"), F.col("lat")).alias("d")).collect()}
        want = sorted((d, p) for p, d in distance.items() if d <= 5 * 1609.344 and p != name)[:30]
        assert sorted((r["distance_m"], r["sale_parcel"]) for r in got if r["subject_id"] == name) == pytest.approx(want) if not want else [p for _, p in sorted((r["distance_m"], r["sale_parcel"]) for r in got if r["subject_id"] == name)] == [p for _, p in want]


def slow_utm17(lon, lat):
    """By the arc of the meridian and powers of the distance from it."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    p, phi, d = e2 / (1 - e2), math.radians(lat), math.radians(lon + 81)
    n, t, c, x = a / math.sqrt(1 - e2 * math.sin(phi) ** 2), math.tan(phi) ** 2, p * math.cos(phi) ** 2, d * math.cos(phi)
    arc = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi) - 35 * e2**3 / 3072 * math.sin(6 * phi))
    east = 500000 + 0.9996 * n * (x + (1 - t + c) * x**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * p) * x**5 / 120)
    return east, 0.9996 * (arc + n * math.tan(phi) * (x * x / 2 + (5 - t + 9 * c + 4 * c * c) * x**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * p) * x**6 / 720))


def test_coordinates_agree_with_another_series(spark):
    points = [(-81.0, 26.0), (-82.0, 26.5), (-80.1, 27.9), (-82.9, 24.6), (-79.2, 30.9)]
    df = spark.createDataFrame(points, "lon double, lat double")
    east, north = to_utm17(F.col("lon"), F.col("lat"))
    for r in df.select("lon", "lat", east.alias("e"), north.alias("n")).collect():
        assert (r["e"], r["n"]) == pytest.approx(slow_utm17(r["lon"], r["lat"]), abs=0.002)
    assert slow_utm17(-81.0, 0.0) == pytest.approx((500000, 0))


def test_coordinates_round_like_their_sql(spark):
    """To a tenth of a micrometre, at latitudes of larger tables too: up to half a millimetre apart, some of a million coordinates were rounded otherwise."""
    df = spark.range(0, 60_000, 977).select((-82 + F.col("id") % 50 * 0.001).alias("lon"), (26.5 + F.col("id") * 0.0004).alias("lat"))
    east, north = to_utm17(F.col("lon"), F.col("lat"))
    for r in df.select("lon", "lat", east.alias("e"), north.alias("n")).collect():
        assert (r["e"], r["n"]) == pytest.approx(slow_utm17(r["lon"], r["lat"]), rel=0, abs=1e-7)


def test_digest_gate(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text(name)
    found = feeds.source_digests(spark, str(tmp_path / "*.txt")).withColumn("k", F.regexp_extract("path", r"(.)\.txt$", 1))
    accepted = found.select("k", "sha256")
    assert feeds.require_digests(found, accepted, "k").count() == 2
    for wrong in (accepted.where("k = 'a'"), accepted.unionAll(accepted.limit(1).withColumn("k", F.lit("c"))), accepted.withColumn("sha256", F.lit("0"))):
        with pytest.raises(GateClosed):
            feeds.require_digests(found, wrong, "k")


def test_block_digest_sees_every_row(spark):
    df = spark.createDataFrame([(KEY(i % 50), str(i), f"d{i}") for i in range(500)], "parcel_id string, ln_num string, digest string")
    one = snapshots.block_digest(df, "parcel_id", "ln_num").first()
    assert one["rows"] == 500 and one == snapshots.block_digest(df.repartition(7).orderBy(F.desc("digest")), "parcel_id", "ln_num").first()
    assert one["block_digest"] != snapshots.block_digest(df.withColumn("digest", F.when(F.col("ln_num") == "77", "x").otherwise(F.col("digest"))), "parcel_id", "ln_num").first()["block_digest"]
    assert snapshots.block_digest(df.limit(0), "parcel_id", "ln_num").first()["rows"] == 0
