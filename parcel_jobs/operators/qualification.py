"""Evidence, qualification and lead gates. Missing, stale or ambiguous evidence never counts as clear."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import json_text, road_surface_class

PENDING, QUALIFIED, HOLD = "PENDING_FLOOD_WETLAND_ROAD_DISTRESS", "QUALIFIED_FOR_CONTACT_ENRICHMENT", "HOLD"
FLOODED, WET = "REJECTED_FLOOD_ZONE", "REJECTED_MAPPED_WETLANDS"
#: Fixed value: the status of a review that screening holds.
HELD = "qualification_hold"
#: What a new lead says.
LEAD = {"status": "qualified_for_contact_enrichment", "priority": "normal", "outreach_status": "held", "notes": "County qualification gates verified. Contact enrichment pending; no outreach sent."}
LEHIGH_ACRES, OTHER_ACRES = 0.25, 10000.0 / 43560.0


def _no(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def latest_evidence(evidence: DataFrame, as_of: str, sources: Column | None = None) -> DataFrame:
    """The newest row of each parcel and source, ties by id; older than seven days or in the future is STALE."""
    rows = evidence if sources is None else evidence.where(sources)
    n = F.row_number().over(Window.partitionBy("parcel_id", "source").orderBy(F.desc("checked_at"), F.desc("id")))
    now = F.lit(as_of).cast("timestamp")
    fresh = _no(F.col("checked_at").between(now - F.expr("interval 7 days"), now))
    return rows.withColumn("n", n).where("n = 1").drop("n").withColumn("result", F.when(fresh, F.col("result")).otherwise("STALE"))


def work_queue(screening: DataFrame, evidence: DataFrame, as_of: str, limit: int = 2, force: bool = False, county: str | None = None) -> DataFrame:
    """Parcels due for a check: never checked first, then the longest ago, then parcel. At most five."""
    last = evidence.groupBy("parcel_id").agg(F.max("checked_at").alias("last_check"))
    rows = screening.where(F.lower("county") == county.lower()) if county else screening
    due = rows.select("parcel_id").join(last, "parcel_id", "left")
    if not force:
        due = due.where(F.col("last_check").isNull() | (F.col("last_check") <= F.lit(as_of).cast("timestamp") - F.expr("interval 20 hours")))
    return due.orderBy(F.asc_nulls_first("last_check"), "parcel_id").limit(max(1, min(limit, 5)))


def join_screening_inputs(screening: DataFrame, access: DataFrame, properties: DataFrame) -> DataFrame:
    """Screening rows with their access review and property, the county compared without case."""
    p = properties.select(F.col("id").alias("property_id"), "parcel_id", F.lower("county").alias("low_county"))
    a = access.select("parcel_id", F.col("status").alias("access_status"), F.col("expires_at").alias("access_expires"))
    return screening.withColumn("low_county", F.lower("county")).join(a, "parcel_id", "left").join(p, ["parcel_id", "low_county"], "left").drop("low_county")


def evaluate_gate(flood_result: Column, features: Column, wet_result: Column, wet_count: Column, road_result: Column, paved: Column, legal: Column, distress: Column, initial: Column) -> Column:
    """(status, missing): flood hazard rejects, then wetlands; then anything that is missing holds; else qualified.

    features is an array of (fld_zone, sfha_tf, zone_subty). paved is null unless its source is a number.
    """
    found = _no((flood_result == "FOUND") & (F.size(features) > 0))
    hazard = found & _no(F.exists(features, lambda f: _no(f["sfha_tf"] == "T") | _no(F.substring(f["fld_zone"], 1, 1).isin("A", "V"))))
    low = found & _no(F.forall(features, lambda f: _no((f["fld_zone"] == "X") & (f["sfha_tf"] == "F") & (f["zone_subty"] == "AREA OF MINIMAL FLOOD HAZARD"))))
    wanted = (
        (low, "FLOOD"), (_no((wet_result == "NOT_FOUND") & (wet_count == 0)), "WETLANDS"), (_no((road_result == "FOUND") & (paved > 0)), "PAVED_ROAD"),
        (_no(legal), "RECORDED_FRONTAGE_AND_ACCESS_REVIEW"), (_no(distress), "SELLER_DISTRESS"), (_no(initial), "SIZE_ZONING_ROUGH_COMPS"),
    )
    missing = F.array_compact(F.array(*[F.when(~ok, name) for ok, name in wanted]))
    status = F.when(hazard, FLOODED).when(_no(wet_result == "FOUND"), WET).when(F.size(missing) > 0, HOLD).otherwise(QUALIFIED)
    return F.struct(status.alias("status"), F.when(status == HOLD, missing).otherwise(F.array().cast("array<string>")).alias("missing"))


def refresh_qualification(screening: DataFrame, access: DataFrame, properties: DataFrame, evidence: DataFrame, distress: DataFrame, findings: DataFrame, as_of: str) -> DataFrame:
    """Each open parcel with its gate status, missing checks and next screening fields.

    distress (parcel_id) holds parcels with qualifying distress; findings (parcel_id, comps_pass) the comparables gate.
    """
    rows = join_screening_inputs(screening.where(F.col("screening_status").isin(PENDING, QUALIFIED)), access, properties)
    kind = F.when(F.col("source") == "FEMA_FLOOD", "flood").when(F.col("source") == "USFWS_WETLANDS", "wet").otherwise("road")
    newest = latest_evidence(evidence, as_of, F.col("source").isin("FEMA_FLOOD", "USFWS_WETLANDS", "LEE_ROAD", "CHARLOTTE_ROAD", "POLK_ROAD")).join(rows.select("parcel_id", "county"), "parcel_id")
    newest = newest.where(F.col("source").isin("FEMA_FLOOD", "USFWS_WETLANDS") | (F.col("source") == F.concat(F.upper("county"), F.lit("_ROAD"))))
    feature = F.array(F.struct("fld_zone", "sfha_tf", "zone_subty"))
    pick = lambda k, c: F.max(F.when(kind == k, c))
    checks = newest.groupBy("parcel_id").agg(
        pick("flood", F.col("result")).alias("flood_result"), pick("flood", feature).alias("features"), pick("wet", F.col("result")).alias("wet_result"),
        pick("wet", F.when(F.col("result") == "NOT_FOUND", 0).otherwise(1)).alias("wet_count"), pick("road", F.col("result")).alias("road_result"), pick("road", F.col("paved_candidate_count")).alias("paved"),
    )
    rows = rows.join(checks, "parcel_id", "left").join(distress.select("parcel_id", F.lit(True).alias("distress")).distinct(), "parcel_id", "left").join(findings, "parcel_id", "left")
    least = F.when(F.lower("city") == "lehigh acres", LEHIGH_ACRES).otherwise(OTHER_ACRES)
    initial = (F.col("building_count") == 0) & (F.col("gis_acres") >= least) & F.col("comps_pass")
    legal = (F.col("access_status") == "VERIFIED") & (F.col("access_expires") > F.lit(as_of).cast("timestamp"))
    gate = evaluate_gate(*[F.col(c) for c in ("flood_result", "features", "wet_result", "wet_count", "road_result", "paved")], legal, F.col("distress"), initial)
    rows = rows.withColumn("gate", gate)
    status = F.col("gate.status")
    was = lambda c: F.col(c) if c in screening.columns else F.lit(None).cast("string")  # noqa: E731 - a status that the gate says nothing of stays
    mark = lambda c, bad: F.when(status == bad, "FAIL").when(status == QUALIFIED, "PASS").when(status == HOLD, "REVIEW").otherwise(was(c))
    return rows.select(
        "parcel_id", "county", "property_id", status.alias("status"), F.array_join("gate.missing", ", ").alias("missing"), F.when(status == HOLD, PENDING).otherwise(status).alias("screening_status"),
        mark("flood_status", FLOODED).alias("flood_status"), mark("wetlands_status", WET).alias("wetlands_status"), mark("paved_road_status", "").alias("paved_road_status"),
        F.when(status == QUALIFIED, "VERIFIED").otherwise(was("seller_distress_status")).alias("seller_distress_status"), (status == QUALIFIED).alias("eligible_for_contact"), F.lit(as_of).cast("timestamp").alias("evaluated_at"),
    )


def materialize_leads(screening: DataFrame, results: DataFrame, properties: DataFrame, access: DataFrame, leads: DataFrame, as_of: str) -> DataFrame:
    """New leads: qualified and eligible for contact, evaluated within the hour, access verified and unexpired, a property, and no lead yet. Their outreach is held.

    eligible_for_contact of results is a boolean; null is no.
    """
    now = F.lit(as_of).cast("timestamp")
    ok = results.where((F.col("status") == QUALIFIED) & F.col("eligible_for_contact") & F.col("evaluated_at").between(now - F.expr("interval 1 hour"), now)).select("parcel_id")
    valid = access.where((F.col("status") == "VERIFIED") & (F.col("expires_at") > now)).select("parcel_id")
    rows = screening.where(F.col("screening_status") == QUALIFIED).select("parcel_id", F.lower("county").alias("c")).join(ok, "parcel_id", "left_semi").join(valid, "parcel_id", "left_semi")
    out = rows.join(properties.select(F.col("id").alias("property_id"), "parcel_id", F.lower("county").alias("c")), ["parcel_id", "c"])
    return out.join(leads, "property_id", "left_anti").select("property_id", *[F.lit(v).alias(c) for c, v in LEAD.items()])


def resolve_parcel_identity(features: DataFrame) -> DataFrame:
    """Replies (parcel_id, feature_id, polygon_ok) by parcel: the feature if it is the only one, its id is the parcel's, and its polygon is valid."""
    one = features.groupBy("parcel_id").agg(F.count("*").alias("n"), F.max("feature_id").alias("feature_id"), F.bool_and("polygon_ok").alias("ok"))
    good = _no((F.col("n") == 1) & (F.col("feature_id") == F.col("parcel_id")) & F.col("ok"))
    return one.select("parcel_id", F.when(good, F.col("feature_id")).alias("feature_id"), good.alias("resolved"))


def cas_update(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates (id, read_status, read_at, new_status) by outcome: applied only where base is still as it was read, else conflict."""
    both = updates.join(base.select("id", F.col("status").alias("now_status"), F.col("updated_at").alias("now_at")), "id", "left")
    same = F.col("now_status").eqNullSafe(F.col("read_status")) & F.col("now_at").eqNullSafe(F.col("read_at"))
    return both.select("id", F.when(same, F.col("new_status")).otherwise(F.col("now_status")).alias("status"), F.when(same, "applied").otherwise("conflict").alias("outcome"))


def verified_comp_gate(findings: DataFrame, samples: DataFrame, as_of: str) -> DataFrame:
    """Subjects with whether verified zoning and sources, fresh, and three distinct verified land sales stand beside them.

    findings: subject_id, county and acres of the subject, found_county, zoning_verified, source_verified, checked_at. A null of them is no.
    samples: subject_id, parcel_id, county, asset_type, verified, price and acreage (numbers, null for what was none), sale_date; a sale counts if it isn't
    the subject's, is of its county, priced, half to twice its size and at most two years old. Fresh is at most seven days old.
    """
    day, now = F.lit(as_of).cast("date"), F.lit(as_of).cast("timestamp")
    s = samples.join(findings.select("subject_id", F.lower("county").alias("own_county"), "acres"), "subject_id")
    ok = (F.col("parcel_id") != F.col("subject_id")) & (F.length("parcel_id") > 0) & (F.lower("county") == F.col("own_county")) & (F.col("asset_type") == "land") & F.col("verified")
    ok = ok & (F.col("price") > 0) & F.col("acreage").between(F.col("acres") * 0.5, F.col("acres") * 2) & F.col("sale_date").between(F.add_months(day, -24), day)
    counts = s.where(ok).groupBy("subject_id").agg(F.count_distinct("parcel_id").alias("comps"))
    out = findings.join(counts, "subject_id", "left").withColumn("comps", F.coalesce("comps", F.lit(0).cast("long")))
    sound = (F.lower("found_county") == F.lower("county")) & F.col("zoning_verified") & F.col("source_verified") & F.col("checked_at").between(now - F.expr("interval 7 days"), now) & (F.col("acres") > 0)
    return out.select("subject_id", "comps", _no(sound & (F.col("comps") >= 3)).alias("passes"))


def distress_qualifies(as_of: str) -> Column:
    """Whether a row of evidence (ev_*: its fields as text) shows distress of its parcel, county and owner. Any bad value is no."""
    now, day = F.lit(as_of).cast("timestamp"), F.lit(as_of).cast("date")
    recent = lambda c: F.col(c).try_cast("timestamp").between(now - F.expr("interval 7 days"), now)
    ok = (F.col("ev_parcel_id") == F.col("parcel_id")) & (F.lower("ev_county") == F.lower("county")) & (F.trim("owner_name") != "") & (F.col("ev_current_owner") == F.col("owner_name"))
    ok = ok & (F.col("ev_verification_status") == "VERIFIED") & (F.col("ev_active") == "true") & (F.col("ev_released") == "false") & (F.col("ev_release_search_complete") == "true")
    ok = ok & recent("ev_checked_at") & recent("ev_release_checked_at") & (F.col("ev_event_date").try_cast("date") <= day) & (F.trim("ev_source_record_id") != "")
    ok = ok & F.startswith("ev_source_url", F.lit("https://")) & F.col("ev_record_sha256").rlike(r"^[a-f0-9]{64}\z")
    tax = (F.col("ev_amount_due").try_cast("decimal(38,10)") > 0) & (F.col("ev_delinquent_since").try_cast("date") < F.add_months(day, -12))
    kind = F.col("ev_signal_type")
    return _no(ok) & F.when(kind.isin("lis_pendens", "notice_of_default"), True).when(kind == "tax_certificate_delinquency", _no(tax)).otherwise(False)


def county_distress_verified(evidence: DataFrame, as_of: str) -> DataFrame:
    """Parcels that have some qualifying evidence."""
    return evidence.groupBy("parcel_id").agg(F.bool_or(distress_qualifies(as_of)).alias("distress_verified"))


def _json_type(json: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))


def _json_is(json: Column, path: str, value: bool) -> Column:
    """Whether JSON holds this boolean itself, no text of it."""
    return (_json_type(json, path) == "BOOLEAN") & (F.try_variant_get(F.try_parse_json(json), path, "boolean") == F.lit(value))


def older_distress_rule(properties: DataFrame, signals: DataFrame, as_of: str) -> DataFrame:
    """Properties (id, parcel_id, owner_name) with whether a signal of theirs verifies distress, by the older rule.

    signals: property_id, parcel_id, signal_type, signal_status, verified_at, source_record_id, source_url, amount, raw_data (JSON). One must be
    verified within seven days, name its record and an https source, and hold the present parcel and owner and a document's hash. A lis pendens counts if its
    release was sought and not found, which is an explicit false; a delinquent tax above zero; an owner absent from vacant land for ten years.
    """
    now, raw = F.lit(as_of).cast("timestamp"), F.col("raw_data")
    at = lambda name: F.get_json_object(raw, f"$.{name}")
    years = F.when(_json_type(raw, "$.held_years").rlike(r"^(BIGINT|DOUBLE|DECIMAL\(.*\))$"), at("held_years").try_cast("decimal(38,10)"))
    kind = F.col("signal_type")
    ok = (F.col("signal_status") == "verified") & F.col("verified_at").between(now - F.expr("interval 7 days"), now) & (F.length("source_record_id") > 0) & F.startswith("source_url", F.lit("https://"))
    ok &= (at("current_pa_parcel_id") == F.col("parcel_id")) & (at("current_pa_owner") == F.col("owner_name")) & at("source_document_sha256").rlike(r"^[a-f0-9]{64}\z")
    ok &= (
        ((kind == "lis_pendens_recorded") & _no(_json_is(raw, "$.subsequent_release_found", False))) | ((kind == "tax_delinquent") & _no(F.col("amount") > 0))
        | ((kind == "absentee_longheld_vacant") & _no(_json_is(raw, "$.absentee", True)) & _no(_json_is(raw, "$.vacant", True)) & _no(years >= 10))
    )
    own = signals.withColumnRenamed("property_id", "id").join(properties.select("id", "parcel_id", "owner_name"), ["id", "parcel_id"])
    found = own.groupBy("id").agg(F.bool_or(_no(ok)).alias("found"))
    return properties.select("id", "parcel_id").join(found, "id", "left").select("id", "parcel_id", _no(F.col("found")).alias("distress_verified"))


#: Sources that may stage a candidate of distress.
DISTRESS_SOURCES = ("ATTOM", "official_clerk", "official_tax_collector")


def stage_distress(candidates: DataFrame) -> DataFrame:
    """Candidates (source_name, source_url, record_sha256, ...) with accepted; whatever state was submitted becomes REVIEW_REQUIRED."""
    ok = F.col("source_name").isin(*DISTRESS_SOURCES) & F.startswith("source_url", F.lit("https://")) & F.col("record_sha256").rlike(r"^[a-f0-9]{64}\z")
    return candidates.withColumns({"accepted": _no(ok), "verification_status": F.lit("REVIEW_REQUIRED"), "qualifying_distress": F.lit(False)})


def upsert_distress(evidence: DataFrame, candidates: DataFrame, as_of: str, order: str) -> DataFrame:
    """evidence (parcel_id, source_name, evidence JSON, checked_at) after the accepted of candidates are staged, the last by order of each parcel and source."""
    from .snapshots import upsert

    staged = stage_distress(candidates).where("accepted").withColumn("checked_at", F.lit(as_of).cast("timestamp"))
    text = F.to_json(F.struct(*[c for c in staged.columns if c not in ("accepted", order)]))
    last = staged.groupBy("parcel_id", "source_name").agg(F.max_by(text, F.col(order)).alias("evidence"), F.max("checked_at").alias("checked_at"))
    return upsert(evidence.select("parcel_id", "source_name", "evidence", "checked_at"), last, ["parcel_id", "source_name"])


def stage_documents(docs: DataFrame) -> DataFrame:
    """Recorded documents with accepted: up for review, hashed, from https, with an instrument, a JSON array of candidates and both flags false. A null is no false.

    docs: parcel_id, status, document_url, document_sha256, instrument_reference, evidence_candidates (JSON), exact_frontage_verified, legal_access_verified.
    """
    ok = (F.col("status") == "REVIEW_REQUIRED") & F.startswith("document_url", F.lit("https://")) & F.col("document_sha256").rlike(r"^[a-f0-9]{64}\z") & (F.trim("instrument_reference") != "")
    ok &= F.startswith(F.schema_of_variant(F.try_parse_json("evidence_candidates")), F.lit("ARRAY")) & (F.col("exact_frontage_verified") == F.lit(False)) & (F.col("legal_access_verified") == F.lit(False))
    return docs.withColumn("accepted", _no(ok))


def merge_documents(reviews: DataFrame, docs: DataFrame, as_of: str, order: str) -> DataFrame:
    """reviews (parcel_id, research JSON) after the accepted of docs are staged, the last by order of each parcel: recorded_document and document_staged_at in their research replace what was there."""
    from .snapshots import upsert_json

    staged = stage_documents(docs).where("accepted")
    text = F.to_json(F.struct(*[c for c in docs.columns if c != order]))
    last = staged.groupBy("parcel_id").agg(F.max_by(text, F.col(order)).alias("document"))
    entry = F.concat(F.lit('{"recorded_document":'), F.col("document"), F.lit(',"document_staged_at":'), json_text(F.lit(as_of)), F.lit("}"))
    return upsert_json(reviews.select("parcel_id", "research"), last.select("parcel_id", entry.alias("research")), ["parcel_id"], "research")


def gis_response_complete(reply: Column) -> Column:
    """An object without error, not cut off, whose features are an array."""
    v = F.try_parse_json(reply)
    kind = F.schema_of_variant(F.try_variant_get(v, "$.features", "variant"))
    bad = F.try_variant_get(v, "$.error", "variant").isNotNull() | _no(F.try_variant_get(v, "$.exceededTransferLimit", "boolean"))
    return _no(F.startswith(kind, F.lit("ARRAY")) & ~bad)


def polygon_valid(polygon: Column) -> Column:
    """JSON rings: not empty, each of four points or more, closed, of numbers (no numeric strings), longitudes and latitudes in range."""
    v = F.try_variant_get(F.try_parse_json(polygon), "$.rings", "variant")
    numeric = F.schema_of_variant(v).rlike(r"^ARRAY<ARRAY<ARRAY<(BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))>>>$")
    rings = F.try_variant_get(v, "$", "array<array<array<double>>>")
    point = lambda p: (F.size(p) >= 2) & p[0].between(-180, 180) & p[1].between(-90, 90)
    ring = lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)) & F.forall(r, point)
    return _no(numeric & (F.size(rings) > 0) & F.forall(rings, ring))


def evidence_outcome(source: Column, complete: Column, features: Column, county: Column, road: Column) -> Column:
    """outcome, feature_count and paved_candidate_count of a reply: ERROR for a failed one, FOUND with features, else NOT_FOUND, but for flood UNVERIFIED.

    features is an array of attributes as maps; counts of a failed reply are null, and paved ones are counted for roads alone, by the county's own field.
    """
    held = F.when(_no(complete), features)
    paved = F.filter(held, lambda f: F.exists(F.map_entries(f), lambda e: road_surface_class(county, e["key"], e["value"]) == "PAVED"))
    count = lambda c: F.when(c.isNotNull(), F.size(c))
    outcome = F.when(held.isNull(), "ERROR").when(F.size(held) > 0, "FOUND").when(source == "FEMA_FLOOD", "UNVERIFIED").otherwise("NOT_FOUND")
    return F.struct(outcome.alias("outcome"), count(held).alias("feature_count"), F.when(_no(road), count(paved)).alias("paved_candidate_count"))


#: Counties whose parcels the view shows.
VIEW_COUNTIES = ("lee", "charlotte")


def qualification_view(results: DataFrame, screening: DataFrame) -> DataFrame:
    """Results (parcel_id, status, reason, missing as text, eligible_for_contact, evaluated_at) of screened parcels of two counties, as a reviewer sees them.

    buildability_status is the reason, else what is missing, which may be empty, else UNVERIFIED. Distress is shown for review only where contact is eligible,
    the status is QUALIFIED and the seller's distress verified. Nothing is ever released.
    """
    shown = screening.where(F.lower("county").isin(*VIEW_COUNTIES)).select("parcel_id", "county", "owner_name", "site_address", "seller_distress_status")
    rows = results.select("parcel_id", "status", "reason", "missing", "eligible_for_contact", "evaluated_at").join(shown, "parcel_id")
    seen = _no(F.col("eligible_for_contact") & (F.col("status") == "QUALIFIED") & (F.col("seller_distress_status") == "VERIFIED"))
    return rows.select(
        F.col("parcel_id").alias("strap"), "county", "owner_name", F.col("site_address").alias("property_address"), F.col("status").alias("qualification_status"), F.coalesce("reason", "missing", F.lit("UNVERIFIED")).alias("buildability_status"),
        F.when(seen, "DISTRESS_REVIEW_REQUIRED").otherwise("UNVERIFIED_DISTRESS").alias("financial_distress_reason"), F.when(seen, "REVIEW_PROPERTY_WITH_OWNER").alias("conversation_hook"), F.lit(False).alias("seller_card_release_authorized"), "evaluated_at",
    )


#: What must be verified for a card, and the most of wetlands and floodway that it may have, the latter excluded.
CARD_FLAGS = ("distress_verified", "paved_frontage_verified", "legal_access_verified", "nwi_coverage_verified", "flood_coverage_verified", "zoning_verified", "regulatory_wetlands_verified", "title_verified")
MOST_WETLANDS, BELOW_FLOODWAY = 30, 100


def seller_cards(results: DataFrame) -> DataFrame:
    """Cards of screening results of which all flags are true, distress has a source and a time, and percentages are within limits; null never passes. Percentages have four decimals."""
    wet, way = (F.col(c).cast("decimal(7,4)") for c in ("wetlands_pct", "floodway_pct"))
    ok = F.col("distress_source").isNotNull() & F.col("distress_checked_at").isNotNull() & (wet <= MOST_WETLANDS) & (way < BELOW_FLOODWAY)
    for f in CARD_FLAGS:
        ok &= F.col(f)
    summary = F.concat(F.lit("Paved frontage verified; "), wet.cast("string"), F.lit("% mapped wetlands; Flood Zone "), F.coalesce("flood_zone", F.lit("unknown")))
    shown = ("owner_name", "contact_info", "property_address", "distress_detail")
    return results.where(_no(ok)).select("county", "strap", *shown, summary.alias("buildability_summary"), "conversation_hook", "screening_checked_at")


def derive_dd_fields(reviews: DataFrame) -> DataFrame:
    """Review statuses from what the sources said: a field's source that failed leaves only that field in review; failed required sources reset all.

    reviews: id, owner_now, owner_stored, amount_due, flood_hit, wet_hit, zoning_hit, street_hit, water_hit, sewer_hit, comps_status, exit_status, required_ok.
    Whatever was found, underwriting is pending: no estimate, no offer, no confidence, no score.
    """
    from ..functions.scalars import owner_match

    due = F.nullif(F.trim("amount_due"), F.lit("")).try_cast("decimal(38,10)")
    review = F.lit("review_required")
    fields = {
        "title_status": F.when(owner_match(F.col("owner_now"), F.col("owner_stored")), "owner_name_match_current_pa"),
        "tax_status": F.when(due == 0, "current_pa_zero_due").when(due.isNotNull(), "current_pa_balance_due"),
        "flood_status": F.when(F.col("flood_hit"), "point_screen_only"),
        "wetlands_status": F.when(F.col("wet_hit"), "point_screen_only"),
        "zoning_status": F.when(F.col("zoning_hit"), "verified_gis"),
        "access_status": F.when(F.col("street_hit"), "verified_near_mapped_street"),
        "utilities_status": F.when(F.col("water_hit").isNotNull() & F.col("sewer_hit").isNotNull() & (F.col("water_hit") | F.col("sewer_hit")), "service_area_verified"),
    }
    good = _no(F.col("required_ok"))
    out = [F.when(good, F.coalesce(c, review)).otherwise(review).alias(name) for name, c in fields.items()]
    out += [F.when(good, F.coalesce(F.col(c), review)).otherwise(review).alias(c) for c in ("comps_status", "exit_status")]
    none = [F.lit(None).cast("double").alias(c) for c in ("estimated_value", "preliminary_mao", "confidence_score")]
    pending = [review.alias("underwriting_status"), review.alias("status"), F.lit(0).alias("dd_score"), *none, F.lit(False).alias("eligible_for_automated_acquisition")]
    return reviews.select("id", *out, *pending, F.when(~good, "source_or_write_failure").alias("source_error"))


#: Attributes that name a land use, in order.
LAND_USE = ("FLUNAME", "FLU_NAME", "DESCRIPTION", "FLU")


def finalize_dd(reviews: DataFrame) -> DataFrame:
    """The last statuses of reviews (id, land_use: attributes of the feature at the point as a map, null without one; road_hit; assessed_value as text).

    A land use or a mapped road is a screen, no proof of zoning or access; the assessed value is a reference only. Nothing is approved, valued or scored here.
    """
    name = F.coalesce(*[F.try_element_at("land_use", F.lit(c)) for c in LAND_USE])
    plain = F.nullif(F.trim("assessed_value"), F.lit("")).try_cast("double")
    review = F.lit("review_required")
    return reviews.select(
        "id", name.alias("classification"), F.when(F.col("land_use").isNotNull(), "future_land_use_verified").otherwise(review).alias("zoning_status"),
        F.when(_no(F.col("road_hit")), "mapped_road_proximity_verified").otherwise(review).alias("access_status"), review.alias("comps_status"), review.alias("underwriting_status"),
        review.alias("status"), F.lit(0).alias("dd_score"), plain.alias("assessed_reference_value"), F.lit(False).alias("eligible_for_automated_acquisition"),
        F.lit(None).cast("double").alias("estimated_value"), F.nullif(name, F.lit("")).alias("future_land_use"), F.when(_no(F.col("road_hit")), True).alias("road_access_signal"),
    )


def title_access_stamp(reviews: DataFrame) -> DataFrame:
    """Findings with explicit false flags; a road signal that is no boolean is null."""
    near = F.when(F.lower("road_signal") == "true", True).when(F.lower("road_signal") == "false", False)
    return reviews.select("id", near.alias("near_road"), F.lit(False).alias("legal_access_verified"), F.lit(False).alias("title_verified"))


#: Contacts that the queue shows.
CRM_OPEN, CRM_KINDS = ("ready_for_crm", "needs_enrichment"), ("seller", "buyer")


def crm_queue(contacts: DataFrame, entity: str = "all", n: int = 200) -> DataFrame:
    """Open contacts (id, crm_status, priority_score, entity_type), the highest score first, nulls before all as the source's order has them, ties by id. Another entity than seller or buyer means all."""
    rows = contacts.where(F.col("crm_status").isin(*CRM_OPEN))
    return (rows.where(F.col("entity_type") == entity) if entity in CRM_KINDS else rows).orderBy(F.desc_nulls_first("priority_score"), "id").limit(n)


def buyer_exit(properties: DataFrame, matches: DataFrame, n: int = 20) -> DataFrame:
    """Each property (property_id) with the number of its best n matches (property_id, buyer_id, match_score), the best score, and exit_status. Without matches it is 0 and up for review."""
    k = F.row_number().over(Window.partitionBy("property_id").orderBy(F.desc_nulls_first("match_score"), "buyer_id"))
    best = matches.withColumn("k", k).where(F.col("k") <= n).groupBy("property_id").agg(F.count("*").alias("buyer_matches"), F.max(F.coalesce("match_score", F.lit(0.0))).alias("max_match_score"))
    out = properties.select("property_id").join(best, "property_id", "left").withColumns({"buyer_matches": F.coalesce("buyer_matches", F.lit(0).cast("long")), "max_match_score": F.coalesce("max_match_score", F.lit(0.0))})
    return out.withColumn("exit_status", F.when(F.col("buyer_matches") > 0, "buyer_path_verified").otherwise("review_required"))


def inventory_counts(properties: DataFrame, leads: DataFrame) -> DataFrame:
    """Five counts; a table that can't be read fails, it never counts as zero."""
    a = properties.agg(F.count("*").alias("properties"), F.count_if(F.coalesce(F.col("parcel_id"), F.lit("")) != "").alias("with_parcel"), F.count_if(F.col("property_type") == "land").alias("land"))
    return a.crossJoin(leads.agg(F.count("*").alias("leads"), F.count_if(F.col("status") == "held").alias("held")))  # one row each


def ledger_upsert(status: DataFrame, run: DataFrame) -> DataFrame:
    """The ledger with the run's rows in place of those of their feeds."""
    return run.unionByName(status.join(run.select("feed"), "feed", "left_anti"))


def ledger_drift(status: DataFrame, counts: DataFrame) -> DataFrame:
    """Feeds whose stored count differs from their table's."""
    return status.join(counts.select("feed", F.col("n").alias("table_rows")), "feed", "left").where(~F.col("rows").eqNullSafe(F.col("table_rows"))).select("feed", "rows", "table_rows")


def sequence_verified(status: DataFrame, feeds: tuple[str, ...]) -> DataFrame:
    """Whether every one of the named feeds is verified; a feed without a row is not."""
    fixed = status.sparkSession.sql("select * from values " + ", ".join(f"('{f}')" for f in feeds) + " as t(feed)")
    return fixed.join(status, "feed", "left").agg(F.bool_and(_no(F.col("state") == "verified")).alias("verified"), F.count_if(~_no(F.col("state") == "verified")).alias("open_feeds"))


def sync_dd_holds(results: DataFrame, evidence: DataFrame, reviews: DataFrame) -> DataFrame:
    """The next reviews (property_id, status, flood_status, wetlands_status, access_status, fatal_flags): results whose identity was verified become held ones.

    Evidence (parcel_id, source, identity_verified) must be of the geometry of the row's own county. A rejection fails
    its field and is a fatal flag; all else is up for review. Of reviews that exist only held ones change.
    """
    source = F.concat(F.upper(F.trim("county")), F.lit("_PARCEL_GEOMETRY"))
    proof = evidence.where(_no(F.col("identity_verified"))).select("parcel_id", "source").distinct()
    held = results.where("property_id is not null").withColumn("source", source).join(proof, ["parcel_id", "source"], "left_semi").select("property_id", F.col("status").alias("gate"))
    both = reviews.alias("r").join(held, "property_id", "full_outer")
    change = F.col("gate").isNotNull() & F.coalesce(F.col("status") == HELD, F.lit(True))
    failed = lambda gate: F.when(F.col("gate") == gate, "failed").otherwise("review_required")
    flags = F.when(F.col("gate").isin(FLOODED, WET), F.array("gate")).otherwise(F.array().cast("array<string>"))
    new = {"status": F.lit(HELD), "flood_status": failed(FLOODED), "wetlands_status": failed(WET), "access_status": F.lit("review_required"), "fatal_flags": flags}
    return both.select("property_id", *[F.when(change, c).otherwise(F.col(f"r.{n}")).alias(n) for n, c in new.items()])
