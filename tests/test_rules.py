"""Rules by literal rows: one sound row, and each way in which it may fail."""

import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from parcel_jobs.functions import scalars
from parcel_jobs.operators import gates, qualification, records, screening, snapshots

NOW = "2026-10-14 08:00:00"
HASH = "a" * 64


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def each_wrong(spark, schema, good, wrong):
    """Row 0 as it is; then rows with one field wrong each."""
    names = [part.split()[0] for part in schema.split(",")]
    rows = [(0, *good)]
    for k, (name, value) in enumerate(wrong, 1):
        rows.append((k, *[value if n == name else v for n, v in zip(names, good, strict=True)]))
    return spark.createDataFrame(rows, f"case int, {schema}")


APN = "334426L3030160020"


@pytest.mark.parametrize(
    ("reply", "parcel", "county", "state", "records_found"),
    [
        ({"property": [{"identifier": {"apn": "OTHER", "fips": "12071"}, "foreclosure": {"documentNumber": "123"}}]}, APN, "Lee", "error", 0),
        ({"property": [{"identifier": {"apn": APN, "fips": "12071"}, "foreclosure": {"documentNumber": "123", "recordingDate": "2025-01-01", "distressType": "NOD"}}]}, APN, "Lee", "REVIEW_REQUIRED", 1),
        ({"property": [{"identifier": {"apn": "33-44-26-L3-03016.0020", "fips": 12071}, "foreclosure": {"recordingDate": "2025-01-01"}}]}, APN, "LEE", "REVIEW_REQUIRED", 1),
        ({"property": [{"identifier": {"apn": "P", "fips": "12071"}}]}, "P", "Lee", "NO_ADVERSE_RECORD_RETURNED", 0),
        ({"property": [{"identifier": {"apn": "P", "fips": "12071"}, "foreclosure": {"documentNumber": None, "recordingDate": None, "distressType": None}}]}, "P", "Lee", "NO_ADVERSE_RECORD_RETURNED", 0),
        ({"property": [{"identifier": {"apn": "P", "fips": "12071"}, "foreclosure": ["a"]}]}, "P", "Lee", "NO_ADVERSE_RECORD_RETURNED", 0),
        ({"property": [{"identifier": {"apn": "P", "fips": "12015"}}]}, "P", "Lee", "error", 0),
        ({"property": [{"identifier": {"apn": "P", "fips": "12071"}}]}, "P", "Dade", "error", 0),
        ({"status": {"code": 400, "msg": "SuccessWithoutResult"}, "property": []}, "P", "Lee", "NO_PROPERTY_MATCH", 0),
        ({"status": {"code": 1, "msg": "SuccessWithoutResult"}}, "P", "Lee", "NO_PROPERTY_MATCH", 0),
        ({"status": {"code": 0, "msg": "SuccessWithoutResult"}, "property": []}, "P", "Lee", "error", 0),
        ({"status": {"code": 401, "msg": "InvalidApiKey"}, "property": []}, "P", "Lee", "error", 0),
        ({"status": {"code": 1, "msg": "x"}, "property": [{"identifier": {"apn": "P", "fips": "12071"}, "foreclosure": {"documentNumber": 0}}]}, "P", "Lee", "REVIEW_REQUIRED", 1),
        ({}, "P", "Lee", "error", 0),
    ],
)
def test_provider_replies(spark, reply, parcel, county, state, records_found):
    row = records.normalize_provider(frame(spark, "parcel_id string, county string, reply string", (parcel, county, json.dumps(reply)))).first()
    assert (row.verification_status, len(row.foreclosure_records)) == (state, records_found)
    assert row.qualifying_distress is False and row.release_search_complete is False


def test_replies_that_are_no_json(spark):
    rows = frame(spark, "parcel_id string, county string, reply string", ("P", "Lee", '{"property":['), ("P", "Lee", None), ("P", None, "[]"))
    assert {r.verification_status for r in records.normalize_provider(rows).collect()} == {"error"}


DOCUMENT = "parcel_id string, status string, document_url string, document_sha256 string, instrument_reference string, evidence_candidates string, exact_frontage_verified boolean, legal_access_verified boolean"


def test_recorded_documents(spark):
    good = (APN, "REVIEW_REQUIRED", "https://example.org/test.pdf", HASH, "TEST ONLY", "[]", False, False)
    wrong = [("legal_access_verified", True), ("legal_access_verified", None), ("exact_frontage_verified", True), ("exact_frontage_verified", None), ("status", "VERIFIED"), ("status", None), ("document_url", "http://example.org"), ("document_url", None)]
    wrong += [("document_sha256", "A" * 64), ("document_sha256", HASH + "\n"), ("document_sha256", None), ("instrument_reference", "  "), ("instrument_reference", None), ("evidence_candidates", "{}"), ("evidence_candidates", "x"), ("evidence_candidates", None)]
    docs = each_wrong(spark, DOCUMENT, good, wrong)
    assert [r.case for r in qualification.stage_documents(docs).where("accepted").collect()] == [0]
    reviews = frame(spark, "parcel_id string, research string", (APN, '{"a":{"b":1},"recorded_document":"old"}'), ("other", None))
    merged = {r.parcel_id: json.loads(r.research) for r in qualification.merge_documents(reviews, docs, NOW, "case").collect()}
    assert merged["other"] == {} and merged[APN]["a"] == {"b": 1} and merged[APN]["document_staged_at"] == NOW
    assert merged[APN]["recorded_document"]["instrument_reference"] == "TEST ONLY" and merged[APN]["recorded_document"]["legal_access_verified"] is False


def raw(**change):
    return json.dumps({"current_pa_parcel_id": "P", "current_pa_owner": "OWNER", "source_document_sha256": HASH, "subsequent_release_found": False, "absentee": True, "vacant": True, "held_years": 10} | change)


SIGNAL = "property_id int, parcel_id string, signal_type string, signal_status string, verified_at string, source_record_id string, source_url string, amount double, raw_data string"


@pytest.mark.parametrize(
    ("kind", "wrong"),
    [
        ("lis_pendens_recorded", [("raw_data", raw(subsequent_release_found=x)) for x in (None, True, "false")]),
        ("tax_delinquent", [("amount", 0.0), ("amount", None)]),
        ("absentee_longheld_vacant", [("raw_data", raw(**{k: v})) for k, v in (("absentee", "true"), ("vacant", None), ("held_years", 9), ("held_years", "12"))]),
        ("rumour", None),
    ],
)
def test_older_rule_of_distress(spark, kind, wrong):
    good = (1, "P", kind, "verified", "2026-10-10 00:00:00", "r", "https://x", 5.0, raw())
    common = [("signal_status", "observed"), ("signal_status", None), ("verified_at", "2026-10-07 07:59:59"), ("verified_at", "2026-10-14 08:00:01"), ("verified_at", None), ("source_record_id", ""), ("source_url", "http://x"), ("source_url", None), ("parcel_id", "Q")]
    common += [("raw_data", raw(**{k: v})) for k, v in (("current_pa_parcel_id", "Q"), ("current_pa_owner", "NEW OWNER"), ("source_document_sha256", "b"))] + [("raw_data", None), ("raw_data", "x")]
    rows = each_wrong(spark, SIGNAL, good, [*common, *(wrong or [])])
    signals = rows.withColumns({"verified_at": F.col("verified_at").cast("timestamp"), "property_id": F.col("case")})
    own = rows.select(F.col("case").alias("id"), F.lit("P").alias("parcel_id"), F.lit("OWNER").alias("owner_name")).union(frame(spark, "id int, parcel_id string, owner_name string", (99, "P", "OWNER")))
    got = {r.id: r.distress_verified for r in qualification.older_distress_rule(own, signals, NOW).collect()}
    assert len(got) == rows.count() + 1 and [k for k, v in got.items() if v] == ([] if wrong is None else [0])


def test_comparables_gate(spark):
    found = "subject_id string, county string, acres double, found_county string, zoning_verified boolean, source_verified boolean, checked_at string"
    good = ("s", "lee", 0.25, "Lee", True, True, "2026-10-14 08:00:00")
    wrong = [("zoning_verified", None), ("zoning_verified", False), ("source_verified", None), ("found_county", "polk"), ("found_county", None), ("acres", 0.0), ("acres", None), ("checked_at", None), ("checked_at", "2026-10-07 07:59:59"), ("checked_at", "2026-10-14 08:00:01")]
    findings = each_wrong(spark, found, good, wrong).withColumns({"subject_id": F.concat("subject_id", F.col("case").cast("string")), "checked_at": F.col("checked_at").cast("timestamp")})
    sample = "parcel_id string, county string, asset_type string, verified boolean, price double, acreage double, sale_date string"
    sales = frame(spark, sample, *[(f"comp{i}", "LEE", "land", True, 20000.0 + i, 0.25, "2026-10-14") for i in (1, 2, 3)]).withColumn("sale_date", F.col("sale_date").cast("date"))
    every = findings.select("subject_id").crossJoin(sales)
    got = qualification.verified_comp_gate(findings, every, NOW).where("passes").collect()
    assert [(r.subject_id, r.comps) for r in got] == [("s0", 3)]
    for name, value in (("parcel_id", "comp2"), ("parcel_id", ""), ("parcel_id", "s0"), ("county", "polk"), ("asset_type", "improved"), ("verified", None), ("price", 0.0), ("price", None), ("acreage", 0.51), ("acreage", 0.12), ("sale_date", "2024-10-13"), ("sale_date", "2026-10-15"), ("sale_date", None)):
        kind = dict(x.split() for x in sample.split(", "))[name].replace("string", "date" if name == "sale_date" else "string")
        one = every.withColumn(name, F.when(F.col("parcel_id") == "comp3", F.lit(value).cast(kind)).otherwise(F.col(name)))
        assert qualification.verified_comp_gate(findings, one, NOW).where("passes").count() == 0, name


def test_staged_distress(spark):
    schema = "parcel_id string, source_name string, source_url string, record_sha256 string, verification_status string, qualifying_distress boolean"
    good = (APN, "ATTOM", "https://api.gateway.attomdata.com/", "b" * 64, "VERIFIED", True)
    rows = each_wrong(spark, schema, good, [("source_name", "official_records"), ("source_name", None), ("source_url", "http://x"), ("source_url", None), ("record_sha256", None), ("record_sha256", "B" * 64)])
    staged = qualification.stage_distress(rows)
    assert [r.case for r in staged.where("accepted").collect()] == [0]
    assert {(r.verification_status, r.qualifying_distress) for r in staged.collect()} == {("REVIEW_REQUIRED", False)}
    old = frame(spark, "parcel_id string, source_name string, evidence string, checked_at timestamp", (APN, "ATTOM", '{"verification_status":"VERIFIED"}', datetime.datetime(2020, 1, 1)), ("q", "official_clerk", "{}", None))
    after = {r.parcel_id: r for r in qualification.upsert_distress(old, rows, NOW, "case").collect()}
    assert json.loads(after[APN].evidence)["verification_status"] == "REVIEW_REQUIRED" and after[APN].checked_at.year == 2026 and after["q"].evidence == "{}"


EVIDENCE = {
    "parcel_id": "P", "county": "Lee", "owner_name": "OWNER", "ev_parcel_id": "P", "ev_county": "Lee", "ev_current_owner": "OWNER", "ev_signal_type": "lis_pendens", "ev_verification_status": "VERIFIED", "ev_active": "true", "ev_released": "false",
    "ev_release_search_complete": "true", "ev_checked_at": NOW, "ev_release_checked_at": NOW, "ev_event_date": "2026-09-14", "ev_source_url": "https://www.leeclerk.org/", "ev_source_record_id": "INSTRUMENT", "ev_record_sha256": HASH, "ev_amount_due": None, "ev_delinquent_since": None,
}


def test_distress_evidence(spark):
    tax = {"ev_signal_type": "tax_certificate_delinquency", "ev_amount_due": "1000", "ev_delinquent_since": "2025-09-14"}
    cases = [({}, True), (tax, True), ({"ev_release_search_complete": "false"}, False), ({"ev_released": "true"}, False), ({"owner_name": "NEW OWNER"}, False), ({"ev_checked_at": "2026-10-06 08:00:00"}, False), ({"ev_verification_status": "REVIEW_REQUIRED"}, False)]
    cases += [(tax | {"ev_delinquent_since": "2025-10-14"}, False), (tax | {"ev_amount_due": "0"}, False), (dict.fromkeys([k for k in EVIDENCE if k.startswith("ev_")]), False)]
    rows = [tuple((EVIDENCE | change).values()) for change, _ in cases]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{c} string" for c in EVIDENCE))
    got = {r.i: r.q for r in df.select("i", qualification.distress_qualifies(NOW).alias("q")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_access_review_needs_an_instrument(spark):
    schema = "status string, source_url string, record_sha256 string, instrument string, frontage_ft double, reviewer string, frontage_confirmed boolean, access_confirmed boolean, instrument_confirmed boolean, plat_confirmed boolean, reviewed_at string, expires_at string"
    good = ("VERIFIED", "https://x", HASH, "OR 1", 80.0, "r", True, True, True, True, "2026-01-01", "2026-06-01")
    rows = each_wrong(spark, schema, good, [("instrument", "  "), ("instrument", None), ("frontage_ft", 0.0), ("plat_confirmed", None), ("expires_at", "2026-01-01"), ("expires_at", None), ("reviewed_at", None), ("reviewer", None)])
    got = rows.withColumn("ok", scalars.access_review_valid())
    assert [r.case for r in got.where("ok").collect()] == [0]


def test_document_reviews(spark):
    docs = frame(spark, "doc_id int, text string, parcel string, reference string", (1, "Plat PB 15 PG 100\n80 feet frontage\fAccess easement recorded", "parcel", "pb 15 PG 100"), (2, "", "parcel", "record"), (3, None, None, None), (4, "Right-of-way\r\nno\rVACATED", "x", "x"))
    hits = sorted((r.doc_id, r.page, r.excerpt) for r in records.review_excerpts(docs).collect())
    assert hits == [(1, 1, "80 feet frontage"), (1, 1, "Plat PB 15 PG 100"), (1, 2, "Access easement recorded"), (4, 1, "Right-of-way"), (4, 1, "VACATED")]
    said = {r.doc_id: r for r in records.review_documents(docs).collect()}
    assert {k: (r.extraction_status, r.parcel_id_found_in_text, r.reference_found_in_text) for k, r in said.items()} == {1: ("TEXT_EXTRACTED", False, True), 2: ("NO_TEXT", False, False), 3: ("NO_TEXT", False, False), 4: ("TEXT_EXTRACTED", False, False)}
    assert not any(r.exact_frontage_verified or r.legal_access_verified or r.status != "REVIEW_REQUIRED" for r in said.values())


SALE = {"parcel_id": "1" * 18, "sale_id": "9", "ln_num": "1", "saledt": "01/02/2026", "price": "101.00", "book": "1", "page": "2", "saletype": "V", "trns_cd": "", "trns_dscr": "", "instrtyp": "01", "instrtyp_dscr": "Q-Per examination of deed", "grantor": "", "grantee": "", "foreclosure": "N"}


def test_screened_sales(spark):
    cases = [({}, None), *(({"instrtyp": c, "instrtyp_dscr": d}, "qualification_code") for c, d in (("05", "Q-Multiple parcels"), ("03", "Q-Physical characteristics changed after sale"), ("01", "Q-Multiple parcels"), ("99", "Q-Per examination of deed")))]
    cases += [({"price": ""}, "price_missing"), ({"price": "100.00"}, "nominal_price_screen_at_most_100"), ({"price": "0"}, "nominal_price_screen_at_most_100"), ({"foreclosure": ""}, "foreclosure_flag_or_unknown"), ({"foreclosure": "C"}, "foreclosure_flag_or_unknown"), ({"saletype": "X"}, "sale_type_unrecognized"), ({"book": "A"}, "recording_reference_missing_or_unrecognized"), ({"parcel_id": "2" * 18}, "county_inaccessible_tract"), ({"parcel_id": "3" * 18}, "current_parcel_missing")]
    rows = [tuple((SALE | {"ln_num": str(i), "sale_id": str(100 + i), "page": str(200 + i)} | change).values()) for i, (change, _) in enumerate(cases)]
    reused = [tuple((SALE | {"ln_num": str(900 + i), "sale_id": "77", "page": str(900 + i), "parcel_id": p}).values()) for i, p in enumerate(("1" * 18, "4" * 18))]
    sales = spark.createDataFrame(rows + reused, ", ".join(f"{c} string" for c in SALE))
    parcel = frame(spark, "parcel_id string, dorus_code string, dordesc string, dordesc1 string", ("1" * 18, "0100", "RES", "Single Family"), ("2" * 18, "9910", "RES", "Inaccessible tracts"), ("4" * 18, "0100", "RES", "Single Family"))
    got = {int(r.ln_num): r for r in screening.screen_sales(sales, parcel, parcel.select("parcel_id").limit(0), "2025-01-01", "2026-09-22").collect()}
    for i, (_, reason) in enumerate(cases):
        held = any(reason and r.startswith(reason) for r in got[i].reasons)
        assert (got[i].status, held) == (("held_for_review", True) if reason else ("candidate_for_comparability_review", False)), (i, got[i])
    assert all(r.review_required and not r.qualified_comp and not r.eligible_for_automated_acquisition and len(r.remaining_review) == 4 for r in got.values())
    flagged = got[len(cases) - 2]
    assert [(f.reason, f.feed, f.source_code, f.legal_conclusion_verified) for f in flagged.source_review_flags] == [("county_inaccessible_tract", "parcel", "9910", False)] and flagged.current_parcel.dordesc1 == "Inaccessible tracts"
    assert got[len(cases) - 1].current_parcel is None and got[len(cases) - 1].source_review_flags == []
    assert got[900].status == "candidate_for_comparability_review" and got[900].observations == ["sale_id_not_globally_unique", "sale_id_reference_repeated"]


def certificate(year="2024", status="Issued"):
    return [year, "01-44-26-L1-01003.0020", "-- None --", status, "2513857", "TEST ADDRESS LEHIGH ACRES", "TEST OWNER", *[""] * 9, "Unpaid", "00", "351.29", "432.15"]


def test_tax_certificates(spark):
    of = lambda rows, today="2026-10-14": records.tax_certificate_candidates(spark.createDataFrame([(r,) for r in rows], "c array<string>"), today).collect()
    (one,) = of([certificate()])
    assert (one.reason, one.delinquent_since, one.parcel_id) == (None, datetime.date(2025, 4, 1), "014426L1010030020")
    assert one.record_sha256 == hashlib.sha256(json.dumps(certificate(), separators=(",", ":")).encode()).hexdigest()
    odd = certificate()
    odd[6] = 'Ñandú "é" 😀\x7f\n\x01'
    assert of([odd])[0].record_sha256 == hashlib.sha256(json.dumps(odd, separators=(",", ":")).encode()).hexdigest()
    assert of([certificate(status="Redeemed")])[0].reason == "CERTIFICATE_NOT_ISSUED"
    assert of([certificate(year="2025")])[0].reason == "DELINQUENCY_NOT_OVER_12_MONTHS" and of([certificate()], "2026-04-01")[0].reason == "DELINQUENCY_NOT_OVER_12_MONTHS"
    assert [r.reason for r in of([certificate()] * 2)] == ["DUPLICATE_CERTIFICATE_REVIEW"] * 2


def test_tax_reports(spark):
    schema = "source_url string, checked_at string, complete boolean, reported_total int, rows array<array<string>>"
    good = ("https://county-taxes.net/fl-lee/reports", "2026-10-14T08:00:00+00:00", True, 1, [certificate()])
    wrong = [("source_url", "https://county-taxes.net/fl-other/reports"), ("source_url", "https://a@county-taxes.net/fl-lee/r"), ("source_url", "http://county-taxes.net/fl-lee/r"), ("source_url", "https://county-taxes.net.x.org/fl-lee/r"), ("source_url", None)]
    wrong += [("checked_at", "2026-10-14T08:00:00"), ("checked_at", None), ("complete", False), ("complete", None), ("reported_total", 2), ("reported_total", None), ("rows", None), ("rows", [certificate()[:19]]), ("rows", [certificate(year="x")])]
    names = ["source_url", "checked_at", "complete", "reported_total", "rows"]
    rows = [(0, *good)] + [(k, *[v2 if n == name else v for n, v, v2 in zip(names, good, [value] * 5, strict=True)]) for k, (name, value) in enumerate(wrong, 1)]
    reports = spark.createDataFrame(rows, f"case int, {schema}")
    errors = {r.case: r.error for r in records.check_tax_report(reports).collect()}
    assert [k for k, e in errors.items() if e is None] == [0]
    assert [errors[k] for k in (1, 6, 8, 10, 12, 13, 14)] == ["source", "checked_at", "incomplete", "incomplete", "incomplete", "layout", "value"]
    with pytest.raises(gates.GateClosed):
        records.tax_report_rows(reports)
    assert records.tax_report_rows(reports.where("case = 0")).first().c == certificate()


def test_quarantine(spark):
    schema = "id int, status string, dd_score int, comps_status string, underwriting_status string, findings string"
    rows = [(1, "review_required", 90, "a", "b", '{"underwriting":{"preliminary_mao":82000},"n":[1,"x"]}'), (2, "approved", 91, "a", "b", '{"underwriting":{"preliminary_mao":82001}}'), (3, "review_required", 0, "a", "b", '{"underwriting":{"eligible_for_automated_acquisition":false}}'), (4, "review_required", 5, "a", "b", None), (5, None, 6, "a", "b", None)]
    reviews = frame(spark, schema, *rows)
    backup, after = snapshots.quarantine_reviews(reviews, NOW)
    assert sorted(map(tuple, backup.collect())) == [rows[0], rows[3]]
    now = {r.id: r for r in after.collect()}
    assert [tuple(now[i]) for i in (2, 3, 5)] == [rows[1], rows[2], rows[4]]
    for i in (1, 4):
        block = json.loads(now[i].findings)
        assert (now[i].dd_score, now[i].comps_status, now[i].underwriting_status) == (0, "review_required", "review_required")
        assert block["underwriting"]["preliminary_mao"] is None and block["underwriting"]["eligible_for_automated_acquisition"] is False
    assert json.loads(now[1].findings)["n"] == [1, "x"]
    many = spark.range(101).selectExpr("cast(id as int) id", "'review_required' status", "90 dd_score", "'a' comps_status", "'b' underwriting_status", "'{}' findings")
    with pytest.raises(gates.GateClosed):
        snapshots.quarantine_reviews(many, NOW)
    assert snapshots.quarantine_reviews(many.limit(100), NOW)[0].count() == 100


def test_digests_of_a_snapshot(spark):
    rows = [("000000000000000001", "02", 'A "B"\tÑ\x01', "50.00"), ("000000000000000001", "1", "x", ".5"), ("000000000000000002", "10", "y", "")]
    fields = [["000000000000000001", "2", 'A "B"\tÑ\x01', "50"], ["000000000000000001", "1", "x", "0.5"], ["000000000000000002", "10", "y", ""]]
    want = [hashlib.md5(json.dumps(f, ensure_ascii=False).encode()).hexdigest() for f in fields]
    df = snapshots.row_digest(frame(spark, "parcel_id string, ln_num string, name string, pctown string", *rows), ["parcel_id", "ln_num", "name", "pctown"], line="ln_num", percent="pctown")
    assert [r.digest for r in df.orderBy("parcel_id", F.desc("ln_num")).collect()] == [want[1], want[0], want[2]]
    df = df.withColumn("line", F.col("ln_num").cast("int"))
    assert snapshots.feed_digest(df, "parcel_id", "line").first() == (3, hashlib.md5((want[1] + want[0] + want[2]).encode()).hexdigest())
    assert snapshots.feed_digest(df.limit(0), "parcel_id", "line").first() == (0, hashlib.md5(b"").hexdigest())
    with pytest.raises(gates.GateClosed):
        snapshots.feed_digest(df, "parcel_id", "line", max_rows=2)


def test_json_merge_keeps_types(spark):
    old = frame(spark, "k int, j string", (1, '{"a":1,"b":{"c":[true,null]},"d":"1"}'), (2, None), (3, "[1]"))
    new = frame(spark, "k int, j string", (1, '{"d":2,"e":false}'), (2, '{"x":"y"}'), (4, '{"z":0.5}'))
    got = {r.k: json.loads(r.j) for r in snapshots.upsert_json(old, new, ["k"], "j").collect()}
    assert got == {1: {"a": 1, "b": {"c": [True, None]}, "d": 2, "e": False}, 2: {"x": "y"}, 3: {}, 4: {"z": 0.5}}


def test_queues_exits_and_matches(spark):
    contacts = frame(spark, "id int, crm_status string, priority_score int, entity_type string", (1, "ready_for_crm", 5, "seller"), (2, "needs_enrichment", 9, "buyer"), (3, "new", 99, "seller"), (4, "ready_for_crm", None, "title"), (5, None, 1, "seller"))
    assert [r.id for r in qualification.crm_queue(contacts).collect()] == [4, 2, 1] and [r.id for r in qualification.crm_queue(contacts, "seller").collect()] == [1] and [r.id for r in qualification.crm_queue(contacts, "title").collect()] == [4, 2, 1]
    matches = frame(spark, "property_id int, buyer_id int, match_score double", *[(1, i, float(i)) for i in range(30)], (3, 1, None))
    got = {r.property_id: tuple(r)[1:] for r in qualification.buyer_exit(frame(spark, "property_id int", (1,), (2,), (3,)), matches).collect()}
    assert got == {1: (20, 29.0, "buyer_path_verified"), 2: (0, 0.0, "review_required"), 3: (1, 0.0, "buyer_path_verified")}
    events = frame(spark, "event_id int, parcel_id string, property_id int, match_method string, match_confidence double", (1, "P", 7, "direct_parcel_id", 1.0), (2, "P", 7, "address", 1.0), (3, "P", 7, "direct_parcel_id", 0.5), (4, "P", None, None, None), (5, None, None, None, None), (6, "Q", None, None, None))
    got = records.match_by_parcel(events, frame(spark, "id int, parcel_id string", (7, "P")))
    assert sorted(map(tuple, got.collect())) == [(i, "P", 7, "direct_parcel_id", 1.0) for i in (2, 3, 4)]


def test_feed_digest_of_more_than_a_million_rows(spark):
    """Rows from many tasks, in the order of the key; an older version held them all in one array and closed here."""
    n = 1_000_050
    df = spark.range(n, numPartitions=7).select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("k")).select("k", F.md5(F.col("k").cast("string")).alias("digest"))
    want = hashlib.md5()
    for k in range(n):
        want.update(hashlib.md5(str(k).encode()).hexdigest().encode())
    assert snapshots.feed_digest(df, "k").first() == (n, want.hexdigest())


def test_feed_digest_query_takes_every_owner_row(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    rows = entry.queries()["c17_row_digest"](spark, sf).count()
    assert entry.queries()["c17_feed_digest"](spark, sf).first()["rows"] == rows
