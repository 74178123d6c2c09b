"""Queries on screening, records, evidence and qualification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import SALES
from ..operators import qualification as Q
from ..operators import records as R
from ..operators import screening
from .bindings import AS_OF, END, START
from .catalogue import Tables, query
from .feeds import _ALIAS, _DATE, _TARGETS, ACCESS, targets

_NOW = f"timestamp '{AS_OF}'"

_SCREEN = (
    _TARGETS
    + rf"""
, sa as (select *, nullif({_ALIAS.format('book')}, '') as ba, nullif({_ALIAS.format('page')}, '') as pa, nullif({_ALIAS.format('sale_id')}, '') as ia from sales_raw)
, rec as (select ba, pa, min(parcel_id) <> max(parcel_id) as apart from sa where ba is not null and pa is not null group by ba, pa having count(*) > 1)
, sid as (select ia, min(parcel_id) <> max(parcel_id) as apart from sa where ia is not null group by ia having count(*) > 1)
, fl as (select parcel_id, case dorus_code when '9910' then 'county_inaccessible_tract' when '9350' then 'county_mineral_rights' when '0989' then 'county_split_combine' end as by_code,
    case lower(dordesc1) when 'inaccessible tracts' then 'county_inaccessible_tract' when 'mineral rights (not phos.)' then 'county_mineral_rights' when 'split and/or combine in progress' then 'county_split_combine' end as by_text from parcel_raw)
, w as (select sa.*, rec.ba is not null as again, rec.apart as rapart, sid.ia is not null as sagain, sid.apart as sapart, p.parcel_id as pp, p.dorus_code, p.dordesc, p.dordesc1, p.parcel_id || '|' || p.dorus_code || '|' || p.dordesc || '|' || p.dordesc1 as current_parcel, coalesce(fl.by_code, fl.by_text) as cls, coalesce(fl.by_code, fl.by_text) is not null and fl.by_code is distinct from fl.by_text as mism, t.parcel_id is not null as is_target
   from sa left join rec on rec.ba = sa.ba and rec.pa = sa.pa left join sid on sid.ia = sa.ia left join parcel_raw p on p.parcel_id = sa.parcel_id left join fl on fl.parcel_id = sa.parcel_id left join targets t on t.parcel_id = sa.parcel_id
   where {_DATE} between date '{START}' and date '{END}')
, sc as (select parcel_id, ln_num, is_target, current_parcel, case when cls is null then '' else cls || ':' || dorus_code || ':' || dordesc1 || case when mism then ',county_classification_mismatch:' || dorus_code || ':' || dordesc1 else '' end end as source_review_flags, list_sort(list_filter([
   case when instrtyp not in ('01', '02') then 'qualification_code_outside_candidate_contract' end,
   case when (instrtyp = '01' and instrtyp_dscr <> 'Q-Per examination of deed') or (instrtyp = '02' and instrtyp_dscr <> 'Q-Credible, verified & documented') then 'qualification_code_description_drift' end,
   case when price = '' then 'price_missing' when cast(price as decimal(38,10)) <= 100 then 'nominal_price_screen_at_most_100' end,
   case when saletype not in ('I', 'V') then 'sale_type_unrecognized' end, case when foreclosure <> 'N' then 'foreclosure_flag_or_unknown' end,
   case when ba is null or pa is null then 'recording_reference_missing_or_unrecognized' end, case when ia is null then 'sale_id_missing_or_unrecognized' end,
   case when again then 'recording_reference_repeated' end, case when rapart then 'recording_spans_multiple_parcels' end,
   case when pp is null then 'current_parcel_missing' when dorus_code = '' or dordesc = '' or dordesc1 = '' then 'current_classification_incomplete' end,
   cls, case when mism then 'county_classification_mismatch' end], lambda x: x is not null)) as reasons,
   list_filter([case when sapart then 'sale_id_not_globally_unique' end, case when sagain then 'sale_id_reference_repeated' end], lambda x: x is not null) as seen from w)
"""
)


def screened(t: Tables) -> DataFrame:
    """The feed is a window over a whole table, and screening reads it more than once: the columns that it reads are written first."""
    return screening.screen_sales(t.stored("sales-rows", t("sales_raw").select(*[c for c in SALES if c not in ("trns_cd", "trns_dscr", "grantor", "grantee")])), t("parcel_raw"), targets(t), START, END)


@query("r1_screen_sales", _SCREEN + " select parcel_id, ln_num, array_to_string(reasons, ',') as reasons, array_to_string(list_sort(seen), ',') as observations, case when len(reasons) > 0 then 'held_for_review' else 'candidate_for_comparability_review' end as status, is_target, 'historical_export_semantics_unverified,transaction_identity_unverified,sale_date_property_attributes_unverified,subject_comparability_unverified' as remaining_review, current_parcel, source_review_flags, true as review_required, false as qualified_comp, false as eligible_for_automated_acquisition from sc")
def _(t: Tables) -> DataFrame:
    text = {c: F.array_join(c, ",") for c in ("reasons", "observations", "remaining_review")} | {"current_parcel": F.concat_ws("|", "current_parcel.parcel_id", "current_parcel.dorus_code", "current_parcel.dordesc", "current_parcel.dordesc1")}
    text["current_parcel"] = F.when(F.col("current_parcel").isNotNull(), text["current_parcel"])
    text["source_review_flags"] = F.array_join(F.transform("source_review_flags", lambda f: F.concat_ws(":", f["reason"], f["source_code"], f["source_description"])), ",")
    return screened(t).withColumns(text)


_NAMES = ", ".join([f"('reason', '{r}')" for r in screening.REASONS] + [f"('observation', '{o}')" for o in screening.OBSERVATIONS] + ["('status', 'held_for_review')", "('status', 'candidate_for_comparability_review')", "('target', 'true')", "('target', 'false')"])


@query("c15_screen_report", _SCREEN + f", x as (select 'status' as kind, case when len(reasons) > 0 then 'held_for_review' else 'candidate_for_comparability_review' end as name from sc union all select 'target', cast(is_target as varchar) from sc union all select 'reason', unnest(reasons) from sc union all select 'observation', unnest(seen) from sc), nm(kind, name) as (values {_NAMES}) select nm.kind, nm.name, count(x.name) as n from nm left join x on x.kind = nm.kind and x.name = nm.name group by all")
def _(t: Tables) -> DataFrame:
    return screening.screen_report(screened(t))


_LEGAL = "^" + ",".join(['"([0-9]+)"'] * 7) + ',"(.*)"$'


@query("a4_parse_legal_strict", f"select line_no, nullif(regexp_extract(value, '{_LEGAL}', 1, 's'), '') as parcel_id, case when regexp_full_match(value, '{_LEGAL}', 's') then regexp_extract(value, '{_LEGAL}', 8, 's') end as dscr, case when not regexp_full_match(value, '{_LEGAL}', 's') then 'unbalanced_or_unknown' end as error from legal_lines")
def _(t: Tables) -> DataFrame:
    return R.parse_legal_strict(t("legal_lines")).select("line_no", "parcel_id", "dscr", "error")


_FILES = "case when line_no % 18 = 8 then 'orphans' else 'f' || cast(line_no % 3 as string) end"


@query("a5_reassemble_legal", rf""", l as (select {_FILES} as file, * from legal_lines), s as (select *, sum(case when regexp_matches(value, '^"[0-9]{{18}}","') then 1 else 0 end) over (partition by file order by line_no) as record from l) select file, cast(record as bigint) as record, count(*) as n_lines, min(line_no) as first_line, string_agg(value, ' ' order by line_no) as value from s group by file, record, case when record = 0 then line_no end""")
def _(t: Tables) -> DataFrame:
    return R.reassemble_legal(t("legal_lines").withColumn("file", F.expr(_FILES)))


@query("a6_read_fixed_width", "select line_no, trim(substr(value, 2, 18)) as parcel, trim(substr(value, 20, 5)) as num, trim(substr(value, 31, 20)) as rest from legal_lines")
def _(t: Tables) -> DataFrame:
    return R.read_fixed_width(t("legal_lines"), [("parcel", 1, 19), ("num", 19, 24), ("rest", 30, 50)]).drop("value")


@query("a7_pad_to_width", "select line_no, array_to_string(list_resize(string_split(value, ','), 9, ''), '|') as fields from legal_lines where trim(value) <> ''")
def _(t: Tables) -> DataFrame:
    return R.pad_to_width(t("legal_lines"), ",", 9).select("line_no", F.array_join("fields", "|").alias("fields"))


_PARTY = """select o_custkey as page_id, o_orderkey as k, case when o_orderkey % 3 = 0 then '*' else '' end || 'PARTY ' || cast(o_orderkey as string) as name, lpad(cast(month(o_orderdate) as string), 2, '0') || '/' || lpad(cast(day(o_orderdate) as string), 2, '0') || '/' || cast(year(o_orderdate) as string) as date,
  case when o_orderkey % 4 = 0 then 'L PEN' else 'LP' end as type, cast(o_orderkey % 900 + 1 as string) as book, cast(o_orderkey + 1 as string) as page, case when o_orderkey % 2 = 0 then '12-34-56-000001-' || lpad(cast(o_orderkey as string), 6, '0') else 'LOT ' || cast(o_orderkey as string) end as legal,
  lpad(cast(o_orderkey - o_orderkey % 2 as string), 10, '0') as file_no, case when o_orderkey % 5 = 0 then 'A' else 'B' end as status, case when o_orderkey % 6 = 0 then 'F' else '' end as flag from {orders}"""
_PARTIES = ", party as (" + _PARTY.format(orders="orders") + "), q as (select *, row_number() over (partition by page_id order by k) - 1 as ordinal from party)"


def party_rows(t: Tables) -> DataFrame:
    """One result page for each customer's orders, parsed back."""
    rows = t.sql(_PARTY, orders=t("orders"))
    line = F.concat_ws(" ", "name", "date", "type", "book", "page", "legal", "file_no", "status", F.nullif(F.col("flag"), F.lit("")), F.lit("View\n"))
    listed = F.array_sort(F.collect_list(F.struct("k", line.alias("x"))))
    pages = rows.groupBy("page_id").agg(F.concat(F.lit("Results \n Name Date Type Book Page Legal File# Status Flag View  "), F.array_join(F.transform(listed, lambda r: r["x"]), ""), F.lit(" Retrieved records 1 of 1 View more")).alias("body"))
    return R.parse_party_rows(pages)


@query("x1_parse_party_rows", _PARTIES + " select page_id, cast(ordinal as int) as ordinal, ltrim(name, '*') as name, starts_with(name, '*') as from_party, date, type, book, page, legal, file_no, status, flag, case when k % 2 = 0 then legal end as parcel_id from q")
def _(t: Tables) -> DataFrame:
    return party_rows(t)


@query("w4_document_rollup", _PARTIES + " select file_no, first(ltrim(name, '*') order by page_id, k) as first_name, first(date order by page_id, k) as date, first(legal order by page_id, k) filter (k % 2 = 0) as parcel_id, first(legal order by page_id, k) as legal, count(*) as parties from q group by file_no")
def _(t: Tables) -> DataFrame:
    return R.document_rollup(party_rows(t))


@query("w6_party_dedupe", _PARTIES + " select 'P' || cast(k % 3 as string) as name, file_no, k from q qualify row_number() over (partition by k % 3, file_no order by page_id desc, k desc) = 1")
def _(t: Tables) -> DataFrame:
    k = F.col("page").cast("bigint") - 1
    return R.party_dedupe(party_rows(t).withColumn("name", F.concat(F.lit("P"), (k % 3).cast("string")))).select("name", "file_no", k.alias("k"))


@query("j8_match_by_parcel", "select p_partkey as event_id, p.parcel_id, p.id as property_id, 'direct_parcel_id' as match_method, 1.0::double as match_confidence from part join properties p on p.id = p_partkey where p_partkey % 12 <> 0 and p.parcel_id <> ''")
def _(t: Tables) -> DataFrame:
    """Events of which a third have their property, and of these a fourth have it by the same method and confidence."""
    p, k = t("properties").where("parcel_id <> ''"), F.col("id")
    old = {"property_id": F.when(k % 3 == 0, k), "match_method": F.when(k % 2 == 0, "direct_parcel_id").otherwise("address"), "match_confidence": F.when(k % 4 < 2, 1.0)}
    return R.match_by_parcel(p.select(k.alias("event_id"), "parcel_id", *[c.alias(n) for n, c in old.items()]), p)


def matched_documents(t: Tables) -> DataFrame:
    """Documents of the records run; those of even orders match."""
    return R.document_rollup(party_rows(t)).withColumn("property_id", F.when(F.col("file_no").cast("bigint") % 4 == 0, F.col("file_no").cast("bigint")))


@query("m8_upsert_signals", f""", d as (select distinct lpad(cast(o_orderkey - o_orderkey % 2 as string), 10, '0') as f from orders), n as (select f, cast(f as bigint) as id from d where cast(f as bigint) % 4 = 0 and cast(f as bigint) % 3 > 0),
o as (select 'old' as f union all select f from d where cast(f as bigint) % 5 = 0)
select 'lis_pendens' as signal_type, 'official_records' as source_name, coalesce(n.f, o.f) as source_record_id, coalesce(id, -1) as property_id, case when n.f is not null then 'p' || n.f else 'was' end as parcel_id, case when n.f is not null then 'observed' else 'closed' end as signal_status, case when o.f is not null then 'https://was' else 'https://is' end as source_url,
  case when n.f is not null then date '2024-01-02' else date '2020-01-01' end as event_date, case when n.f is not null then 1.0 else 0.5 end::double as confidence, case when n.f is not null then '{{"document":"{{}}","resolution_method":"direct_parcel_id"}}' else 'was' end as raw_data, cast(floor(epoch(case when n.f is not null then {_NOW} else timestamp '2020-01-01' end)) as bigint) as verified_at
from n full join o on n.f = o.f""")
def _(t: Tables) -> DataFrame:
    """Documents of even orders match, some of them by another method; some signals are there before."""
    number = F.col("file_no").cast("bigint")
    docs = matched_documents(t).select("file_no", F.concat(F.lit("p"), "file_no").alias("parcel_id"), "property_id", F.when(number % 3 == 0, "address").otherwise("direct_parcel_id").alias("match_method"), F.lit(1.0).alias("match_confidence"), F.lit("https://is").alias("source_url"), F.lit("2024-01-02").cast("date").alias("recording_date"), F.lit("{}").alias("raw_data"))
    was = "-1L as property_id, 'was' as parcel_id, 'lis_pendens' as signal_type, 'closed' as signal_status, 'official_records' as source_name, 'https://was' as source_url, f as source_record_id, date '2020-01-01' as event_date, 0.5D as confidence, 'was' as raw_data, timestamp '2020-01-01' as verified_at, timestamp '2020-01-01' as last_seen_at"
    some = docs.where(number % 5 == 0).select(F.col("file_no").alias("f"))
    old = some.unionByName(t("region").where("r_regionkey = 0").select(F.lit("old").alias("f"))).selectExpr(*was.split(", "))
    return R.upsert_signals(old, docs, AS_OF).withColumn("verified_at", F.unix_timestamp("verified_at")).drop("last_seen_at")


@query("c25_run_audit", ", d as (select distinct o_orderkey - o_orderkey % 2 as f from orders) select (select count(*) from orders) as parties, count(*) as documents, count(*) filter (f % 4 = 0) as exact_matches, 'success' as state from d")
def _(t: Tables) -> DataFrame:
    return R.run_audit(party_rows(t), matched_documents(t))


_AUCTION = "select o_orderkey as auction_id, o_orderkey % 50 as c, o_orderdate as d, o_totalprice as price from {orders}"


def auctions(t: Tables) -> DataFrame:
    a = t.sql(_AUCTION, orders=t("orders"))
    parts = [
        F.lit("Auction Details Case Number"), F.when(F.col("c") == 9, " ").otherwise(" : "), F.lit("2024CA"), F.col("c").cast("string"), F.lit("\nCase Type: FORECLOSURE\n Final Judgment Amount: $"), F.format_number("price", 2), F.when(F.col("c") == 8, "  Parcel ID ").otherwise("  Parcel ID: "), F.lpad(F.col("auction_id").cast("string"), 18, "0"),
        F.lit(" Property Address: "), F.col("auction_id").cast("string"), F.lit(" MAIN ST\n Assessed Value: "), F.when(F.col("c") == 7, "unknown").when(F.col("c") == 6, "$1,000.5").otherwise("$1,000.50"), F.lit(" Auction Starts: "), F.date_format("d", "MM/dd/yyyy"), F.lit(" 10:00 AM ET Name On Title: X"), F.lit(" Certificate Number: C-"), F.col("c").cast("string"), F.lit(" Legal Description: LOT 1 Case of wine"),
    ]
    return R.parse_auction_details(a.select("auction_id", F.concat(*parts).alias("body")))


@query("x2_parse_auction_details", ", a as (" + _AUCTION.format(orders="orders") + "), k as (select *, lpad(cast(auction_id as string), 18, '0') as p from a) select auction_id, '2024CA' || cast(c as string) as case_number, substr(p, 1, 2) || '-' || substr(p, 3, 2) || '-' || substr(p, 5, 2) || '-' || substr(p, 7, 6) || '-' || substr(p, 13, 6) as parcel_id, cast(d as date) as auction_date, '10:00 AM ET' as auction_time, cast(cast(price as decimal(18,2)) as decimal(38,10)) as final_judgment, case when c <> 7 then cast(1000.50 as decimal(38,10)) end as assessed_value, cast(auction_id as string) || ' MAIN ST' as property_address, 'FORECLOSURE' as case_type, p as parcel_id_raw, 'C-' || cast(c as string) as certificate_number, 'LOT 1 Case of wine' as legal_description, 'X' as name_on_title from k")
def _(t: Tables) -> DataFrame:
    return auctions(t)


@query("c26_auction_calendar", ", a as (" + _AUCTION.format(orders="orders") + ") select cast(d as date) as auction_date, count(distinct c) as cases, cast(date_trunc('month', d) as date) as month from a group by d")
def _(t: Tables) -> DataFrame:
    return R.auction_calendar(auctions(t))


_MARKED = "case n % 9 when 0 then 'Right-of-Way ' when 2 then 'O.R. BOOK ' when 4 then 'this Plat' when 5 then 'Vacated ' else '' end"


@query("x3_review_excerpts", rf""", l as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as n, unnest(string_split(text, chr(10))) as y from documents where text is not null)
, m as (select doc_id, n, {_MARKED} || y as x from l)
, h as (select doc_id, cast(n // 3 + 1 as int) as page, cast(n % 3 as int) as line, substr(trim(regexp_replace(x, '^\s+|\s+$', '', 'g')), 1, 500) as excerpt from m where regexp_matches(x, '(?i)frontage|right.of.way|easement|dedicat|access|restrict|vacat|plat|book|page'))
select * from h qualify row_number() over (partition by doc_id order by page, line) <= 500""")
def _(t: Tables) -> DataFrame:
    """Documents with words of plats before some of their lines, three lines a page."""
    lines = F.transform(F.split("text", "\n"), lambda y, n: F.concat(F.when(n % 9 == 0, "Right-of-Way ").when(n % 9 == 2, "O.R. BOOK ").when(n % 9 == 4, "this Plat").when(n % 9 == 5, "Vacated ").otherwise(""), y))
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 3).cast("int")), lambda i: F.array_join(F.slice(lines, i * 3 + 1, 3), "\n"))
    return R.review_excerpts(t("documents").where("text is not null").select("doc_id", F.array_join(pages, "\f").alias("text")))


@query("x3_review_documents", r"select doc_id, 'REVIEW_REQUIRED' as status, case when regexp_matches(coalesce(text, ''), '\S') then 'TEXT_EXTRACTED' else 'NO_TEXT' end as extraction_status, coalesce(contains(lower(text), lower(substr(text, 11, 5))), false) as parcel_id_found_in_text, coalesce(contains(lower(text), lower('EN' || source)), false) as reference_found_in_text, false as exact_frontage_verified, false as legal_access_verified, false as current_restrictions_checked from documents")
def _(t: Tables) -> DataFrame:
    return R.review_documents(t("documents").select("doc_id", "text", F.upper(F.substring("text", 11, 5)).alias("parcel"), F.concat(F.lit("EN"), "source").alias("reference")))


_CERT = """select o_orderkey as k, case when o_orderkey % 31 = 0 then 'bad' else lpad(cast(o_orderkey % 900 as string), 6, '0') || '-AB123456789' end as p, cast(case when o_orderkey % 5 = 0 then 2023 else 2019 + o_orderkey % 3 end as string) as y,
  case when o_orderkey % 7 = 0 then 'Redeemed' else 'Issued' end as s, case when o_orderkey % 11 = 0 then 'Applied' else '-- None --' end as deed, case when o_orderkey % 13 = 0 then 'Paid' else 'Unpaid' end as u, case when o_orderkey % 17 = 0 then '0' else '1,200.50' end as due, case when o_orderkey % 19 = 0 then '' else cast(o_orderkey % 4000 as string) end as c from {orders}"""


def certificates(t: Tables) -> DataFrame:
    a = t.sql(_CERT, orders=t("orders"))
    blank = [F.lit("")] * 5 + [F.lit('José "Ñ" 😀')] + [F.lit("")] * 14
    for i, c in ((0, "y"), (1, "p"), (2, "deed"), (3, "s"), (4, "c"), (16, "u"), (19, "due")):
        blank[i] = F.col(c)
    return a.select("k", F.array(*blank).alias("c"))


@query("x4_tax_certificates", ", a as (" + _CERT.format(orders="orders") + """), z as (select *, upper(regexp_replace(p, '[^A-Za-z0-9]', '', 'g')) as parcel_id, make_date(cast(y as int) + 1, 4, 1) as since, count(*) over (partition by p, y, c) as n from a)
select parcel_id, c as certificate, case when n > 1 then 'DUPLICATE_CERTIFICATE_REVIEW' when not regexp_full_match(parcel_id, '[0-9]{6}[A-Z0-9]{11}') then 'INVALID_PARCEL' when s <> 'Issued' then 'CERTIFICATE_NOT_ISSUED' when deed <> '-- None --' then 'DEED_STATUS_REVIEW' when u <> 'Unpaid' or due = '0' then 'NO_UNPAID_BALANCE' when since >= date '2023-01-31' then 'DELINQUENCY_NOT_OVER_12_MONTHS' when not regexp_full_match(c, '0*[1-9][0-9]*') then 'MISSING_CERTIFICATE' end as reason,
  since as delinquent_since, cast(replace(due, ',', '') as decimal(38,10)) as amount_due,
  sha256('["' || y || '","' || p || '","' || deed || '","' || s || '","' || c || '","Jos\\u00e9 \\"\\u00d1\\" \\ud83d\\ude00","","","","","","","","","","","' || u || '","","","' || due || '"]') as record_sha256 from z""")
def _(t: Tables) -> DataFrame:
    return R.tax_certificate_candidates(certificates(t), AS_OF[:10])


@query("w5_duplicate_certificates", ", a as (" + _CERT.format(orders="orders") + ") select k, count(*) over (partition by p, y, c) > 1 as quarantined from a")
def _(t: Tables) -> DataFrame:
    rows = certificates(t).select("k", F.col("c")[0].alias("y"), F.col("c")[1].alias("p"), F.col("c")[4].alias("c"))
    return R.duplicate_certificates(rows, ["p", "y", "c"]).select("k", "quarantined")


_REPLY = """select c_custkey as k, 'p-' || cast(c_custkey as string) as parcel_id, case when c_custkey % 17 = 0 then 'dade' else 'Lee' end as county, case c_custkey % 8
  when 0 then '{{"status":{{"code":400,"msg":"SuccessWithoutResult"}},"property":[]}}' when 1 then '{{"status":{{"code":401,"msg":"InvalidApiKey"}},"property":[]}}' when 2 then '{{"status":{{"code":0,"msg":"SuccessWithoutResult"}}}}' when 3 then 'junk'
  else '{{"status":{{"code":0,"msg":"ok"}},"property":[{{"identifier":{{"apn":"P' || cast(case when c_custkey % 24 = 5 then c_custkey + 1 else c_custkey end as string) || '","fips":"12071"}},"foreclosure":' ||
    case c_custkey % 8 when 4 then '{{"documentNumber":"123"}}' when 5 then '{{"recordingDate":"2025-01-01","distressType":null}}' when 6 then '{{"documentNumber":null,"recordingDate":"","distressType":null}}' else '["a"]' end || '}}]}}' end as reply from {customer}"""


@query("x5_normalize_provider", ", q as (" + _REPLY.format(customer="customer").replace("{{", "{").replace("}}", "}") + """), v as (select k, parcel_id, county, case when json_valid(reply) then reply::json end as j from q),
p as (select *, coalesce(json_array_length(j, '$.property'), 0) as n, upper(regexp_replace(coalesce(j->>'$.property[0].identifier.apn', ''), '[^A-Za-z0-9]', '', 'g')) as apn, j->'$.property[0].foreclosure' as f from v)
select parcel_id, county, case when n = 0 then case when j->>'$.status.msg' = 'SuccessWithoutResult' and j->>'$.status.code' in ('400', '1') then 'NO_PROPERTY_MATCH' else 'error' end
  when apn <> upper(regexp_replace(parcel_id, '[^A-Za-z0-9]', '', 'g')) or lower(county) <> 'lee' or j->>'$.property[0].identifier.fips' <> '12071' then 'error'
  when json_type(f) = 'OBJECT' and coalesce(nullif(f->>'documentNumber', ''), nullif(f->>'recordingDate', ''), nullif(f->>'distressType', '')) is not null then 'REVIEW_REQUIRED' else 'NO_ADVERSE_RECORD_RETURNED' end as verification_status, false as qualifying_distress, false as release_search_complete from p""")
def _(t: Tables) -> DataFrame:
    return R.normalize_provider(t.sql(_REPLY, customer=t("customer"))).drop("foreclosure_records")


_LATEST = f", w1 as (select id, parcel_id, source, case when checked_at between {_NOW} - interval 7 days and {_NOW} then result else 'STALE' end as result, fld_zone, sfha_tf, zone_subty, paved_candidate_count, checked_at from evidence qualify row_number() over (partition by parcel_id, source order by checked_at desc, id desc) = 1)"


@query("w1_latest_evidence", _LATEST + " select id, parcel_id, source, result from w1")
def _(t: Tables) -> DataFrame:
    return Q.latest_evidence(t("evidence"), AS_OF).select("id", "parcel_id", "source", "result")


@query("w3_work_queue", f", l as (select parcel_id, max(checked_at) as last_check from evidence group by parcel_id) select s.parcel_id, cast(floor(epoch(last_check)) as bigint) as last_check from screening s left join l using (parcel_id) where last_check is null or last_check <= {_NOW} - interval 20 hours order by l.last_check nulls first, s.parcel_id limit 5")
def _(t: Tables) -> DataFrame:
    due = Q.work_queue(t("screening"), t("evidence"), AS_OF, limit=9)
    return due.withColumn("last_check", F.unix_timestamp(F.col("last_check").cast("timestamp")))


def access(t: Tables) -> DataFrame:
    return t.sql(ACCESS, customer=t("customer"))


_DASHLESS = "select id, lpad(cast(id + 1 as string), 18, '0') as parcel_id, case when id % 2 = 0 then 'lee' else 'LEE' end as county, property_type from {properties}"


def plain_properties(t: Tables) -> DataFrame:
    return t.sql(_DASHLESS, properties=t("properties"))


_INPUTS = ", acc as (" + ACCESS.format(customer="customer") + "), pp as (" + _DASHLESS.format(properties="properties") + "), j7 as (select s.*, a.status as access_status, a.expires_at as access_expires, p.id as property_id from screening s left join acc a on a.parcel_id = s.parcel_id left join pp p on p.parcel_id = s.parcel_id and lower(p.county) = lower(s.county))"


@query("j7_screening_inputs", _INPUTS + " select parcel_id, access_status, property_id from j7")
def _(t: Tables) -> DataFrame:
    return Q.join_screening_inputs(t("screening"), access(t), plain_properties(t)).select("parcel_id", "access_status", "property_id")


_LOW = "fld_zone = 'X' and sfha_tf = 'F' and zone_subty = 'AREA OF MINIMAL FLOOD HAZARD'"


def _gate(legal: str, distress: str, initial: str) -> str:
    return f"""case when fr = 'FOUND' and (sfha_tf = 'T' or substr(fld_zone, 1, 1) in ('A', 'V')) then 'REJECTED_FLOOD_ZONE' when wr = 'FOUND' then 'REJECTED_MAPPED_WETLANDS'
  when coalesce(fr = 'FOUND' and {_LOW}, false) and coalesce(wr = 'NOT_FOUND', false) and coalesce(rr = 'FOUND' and paved > 0, false) and coalesce({legal}, false) and coalesce({distress}, false) and coalesce({initial}, false) then 'QUALIFIED_FOR_CONTACT_ENRICHMENT' else 'HOLD' end as status,
  array_to_string(list_filter([case when not coalesce(fr = 'FOUND' and {_LOW}, false) then 'FLOOD' end, case when not coalesce(wr = 'NOT_FOUND', false) then 'WETLANDS' end, case when not coalesce(rr = 'FOUND' and paved > 0, false) then 'PAVED_ROAD' end,
    case when not coalesce({legal}, false) then 'RECORDED_FRONTAGE_AND_ACCESS_REVIEW' end, case when not coalesce({distress}, false) then 'SELLER_DISTRESS' end, case when not coalesce({initial}, false) then 'SIZE_ZONING_ROUGH_COMPS' end], lambda x: x is not null), ', ') as missing"""


_EVENTS = "select *, case when id % 4 = 0 then 'STALE' else 'FOUND' end as fr, case when id % 6 = 1 then 'FOUND' when id % 6 = 2 then 'STALE' else 'NOT_FOUND' end as wr, 'FOUND' as rr, paved_candidate_count as paved from {evidence}"


@query("r2_evaluate_gate", ", e as (" + _EVENTS.format(evidence="evidence") + "), g as (select id, " + _gate("id % 5 > 1", "id % 3 > 0", "id % 2 = 1") + " from e) select id, status, case when status = 'HOLD' then missing else '' end as missing from g")
def _(t: Tables) -> DataFrame:
    e = t.sql(_EVENTS, evidence=t("evidence"))
    feature = F.array(F.struct("fld_zone", "sfha_tf", "zone_subty"))
    gate = Q.evaluate_gate(F.col("fr"), feature, F.col("wr"), F.when(F.col("wr") == "NOT_FOUND", 0).otherwise(1), F.col("rr"), F.col("paved"), F.col("id") % 5 > 1, F.col("id") % 3 > 0, F.col("id") % 2 == 1)
    return e.select("id", gate.alias("g")).select("id", "g.status", F.array_join("g.missing", ", ").alias("missing"))


_R3 = (
    _LATEST.replace("from evidence qualify", "from evidence where source in ('FEMA_FLOOD', 'USFWS_WETLANDS', 'LEE_ROAD') qualify")
    + _INPUTS
    + ", k as (select parcel_id, max(case when source = 'FEMA_FLOOD' then result end) as fr, max(case when source = 'FEMA_FLOOD' then fld_zone end) as fld_zone, max(case when source = 'FEMA_FLOOD' then sfha_tf end) as sfha_tf, max(case when source = 'FEMA_FLOOD' then zone_subty end) as zone_subty, max(case when source = 'USFWS_WETLANDS' then result end) as wr, max(case when source = 'LEE_ROAD' then result end) as rr, max(case when source = 'LEE_ROAD' then paved_candidate_count end) as paved from w1 group by parcel_id)"
    + ", r3 as (select j7.parcel_id, j7.property_id, "
    + _gate(f"access_status = 'VERIFIED' and access_expires > {_NOW}", "cast(j7.parcel_id as bigint) % 2 = 0", "building_count = 0 and gis_acres >= (case when lower(city) = 'lehigh acres' then 0.25 else 10000.0 / 43560.0 end) and cast(j7.parcel_id as bigint) % 3 > 0")
    + " from j7 left join k on k.parcel_id = j7.parcel_id where screening_status in ('PENDING_FLOOD_WETLAND_ROAD_DISTRESS', 'QUALIFIED_FOR_CONTACT_ENRICHMENT'))"
)


def refreshed(t: Tables) -> DataFrame:
    number = F.col("parcel_id").cast("bigint")
    fields = ("flood_status", "wetlands_status", "paved_road_status", "seller_distress_status")
    s = t("screening").withColumns({c: F.concat(F.lit(f"{c[:3]}-"), (number % 4).cast("string")) for c in fields})
    return Q.refresh_qualification(s, access(t), plain_properties(t), t("evidence"), s.where(number % 2 == 0), s.select("parcel_id", (number % 3 > 0).alias("comps_pass")), AS_OF)


@query("r3_refresh_qualification", _R3 + ", o as (select *, cast(cast(parcel_id as bigint) % 4 as varchar) as m, case when status like 'QUAL%' then 'PASS' when status = 'HOLD' then 'REVIEW' end as mark from r3) select parcel_id, property_id, status, case when status = 'HOLD' then missing else '' end as missing, case when status = 'HOLD' then 'PENDING_FLOOD_WETLAND_ROAD_DISTRESS' else status end as screening_status, case when status = 'REJECTED_FLOOD_ZONE' then 'FAIL' else coalesce(mark, 'flo-' || m) end as flood_status, case when status = 'REJECTED_MAPPED_WETLANDS' then 'FAIL' else coalesce(mark, 'wet-' || m) end as wetlands_status, coalesce(mark, 'pav-' || m) as paved_road_status, case when status like 'QUAL%' then 'VERIFIED' else 'sel-' || m end as seller_distress_status from o")
def _(t: Tables) -> DataFrame:
    return refreshed(t).select("parcel_id", "property_id", "status", "missing", "screening_status", "flood_status", "wetlands_status", "paved_road_status", "seller_distress_status")


@query("m7_sync_dd_holds", _R3 + ", h as (select property_id, status as gate from r3 where property_id is not null and parcel_id in (select parcel_id from evidence where source = 'LEE_PARCEL_GEOMETRY' and id % 4 > 0)), rv as (select c_custkey as property_id, case when c_custkey % 3 = 0 then 'qualification_hold' else 'approved' end as status from customer where c_custkey % 2 = 0), b as (select coalesce(h.property_id, rv.property_id) as property_id, gate, status, gate is not null and coalesce(status = 'qualification_hold', true) as change from h full join rv on rv.property_id = h.property_id) select property_id, case when change then 'qualification_hold' else status end as status, case when not change then 'old' when gate = 'REJECTED_FLOOD_ZONE' then 'failed' else 'review_required' end as flood_status, case when not change then 'old' when gate = 'REJECTED_MAPPED_WETLANDS' then 'failed' else 'review_required' end as wetlands_status, case when change then 'review_required' else 'old' end as access_status, case when change and gate like 'REJECTED%' then gate else '' end as fatal_flags from b")
def _(t: Tables) -> DataFrame:
    old = F.lit("old")
    reviews = t("customer").where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("property_id"), F.when(F.col("c_custkey") % 3 == 0, Q.HELD).otherwise("approved").alias("status"),
        old.alias("flood_status"), old.alias("wetlands_status"), old.alias("access_status"), F.array().cast("array<string>").alias("fatal_flags"),
    )
    evidence = t("evidence").select("parcel_id", "source", (F.col("id") % 4 > 0).alias("identity_verified"))
    return Q.sync_dd_holds(refreshed(t), evidence, reviews).withColumn("fatal_flags", F.array_join("fatal_flags", ","))


@query("j9_materialize_leads", _INPUTS + f", ok as (select * from j7 where cast(parcel_id as bigint) % 4 > 0 and cast(parcel_id as bigint) % 5 > 1 and access_status = 'VERIFIED' and access_expires > {_NOW} and property_id is not null and property_id % 7 <> 1) select property_id, 'qualified_for_contact_enrichment' as status, 'normal' as priority, 'held' as outreach_status, 'County qualification gates verified. Contact enrichment pending; no outreach sent.' as notes from ok")
def _(t: Tables) -> DataFrame:
    s, k = t("screening").withColumn("screening_status", F.lit(Q.QUALIFIED)), F.col("parcel_id").cast("bigint")
    results = s.select("parcel_id", F.when(k % 4 > 0, Q.QUALIFIED).otherwise(Q.HOLD).alias("status"), F.when(k % 5 > 0, k % 5 > 1).alias("eligible_for_contact"), F.lit(AS_OF).cast("timestamp").alias("evaluated_at"))
    leads = t("properties").where("id % 7 = 1").select(F.col("id").alias("property_id"))
    return Q.materialize_leads(s, results, plain_properties(t), access(t), leads, AS_OF)


@query("j13_resolve_identity", ", f as (select lpad(cast(c_custkey + 1 as string), 18, '0') as parcel_id, lpad(cast(c_custkey + 1 as string), 18, '0') as feature_id, c_nationkey % 4 > 0 as ok from customer union all select lpad(cast(c_custkey + 1 as string), 18, '0'), 'other', true from customer where c_mktsegment = 'BUILDING') select parcel_id, case when count(*) = 1 and bool_and(ok) then max(feature_id) end as feature_id, count(*) = 1 and bool_and(ok) as resolved from f group by parcel_id")
def _(t: Tables) -> DataFrame:
    """Each customer's parcel has a feature, those of one segment a second one."""
    key = F.lpad((F.col("c_custkey") + 1).cast("string"), 18, "0")
    one = t("customer").select(key.alias("parcel_id"), key.alias("feature_id"), (F.col("c_nationkey") % 4 > 0).alias("polygon_ok"))
    return Q.resolve_parcel_identity(one.unionAll(t("customer").where("c_mktsegment = 'BUILDING'").select(key, F.lit("other"), F.lit(True))))


@query("j14_cas_update", "select c_custkey as id, case when c_custkey % 3 = 0 then 'open' else 'done' end as status, case when c_custkey % 3 = 0 then 'conflict' else 'applied' end as outcome from customer where c_custkey % 2 = 0")
def _(t: Tables) -> DataFrame:
    base = t("customer").select(F.col("c_custkey").alias("id"), F.lit("open").alias("status"), F.lit(AS_OF).cast("timestamp").alias("updated_at"))
    read = F.when(F.col("id") % 3 == 0, F.lit("2024-01-30").cast("timestamp")).otherwise(F.col("updated_at"))
    return Q.cas_update(base, base.where("id % 2 = 0").select("id", F.col("status").alias("read_status"), read.alias("read_at"), F.lit("done").alias("new_status")))


_COMPS = "select lpad(cast(l_suppkey + 1 as string), 18, '0') as subject_id, lpad(cast(l_partkey % 300 + 1 as string), 18, '0') as parcel_id, case when l_orderkey % 5 = 0 then 'Polk' else 'LEE' end as county, case when l_linenumber = 7 then 'improved' else 'land' end as asset_type, l_quantity / 10 as acreage, case when l_orderkey % 9 = 0 then 0.0 else l_extendedprice end as price, cast(l_shipdate as date) as sale_date, l_returnflag <> 'R' as verified from {lineitem}"


_FOUND = "select lpad(cast(s_suppkey + 1 as string), 18, '0') as subject_id, 'Lee' as county, cast(s_suppkey % 4 as double) as acres, case when s_suppkey % 13 = 0 then 'polk' else 'LEE' end as found_county, case when s_suppkey % 5 > 0 then true end as zoning_verified, s_suppkey % 7 > 0 as source_verified, timestamp '2000-12-30 00:00:00' - make_interval(0, 0, 0, s_suppkey % 11 - 1, 0, 0, 0) as checked_at from {supplier}"


@query("c22_verified_comp_gate", ", s as (" + _COMPS.format(lineitem="lineitem") + "), k as (select s_suppkey as x, lpad(cast(s_suppkey + 1 as string), 18, '0') as subject_id, cast(s_suppkey % 4 as double) as acres from supplier), c as (select s.subject_id, count(distinct parcel_id) as comps from s join k using (subject_id) where parcel_id <> s.subject_id and length(parcel_id) > 0 and lower(county) = 'lee' and asset_type = 'land' and verified and price > 0 and acreage between acres * 0.5 and acres * 2 and sale_date between date '1998-12-31' and date '2000-12-31' group by s.subject_id) select subject_id, coalesce(comps, 0) as comps, x % 13 > 0 and x % 5 > 0 and x % 7 > 0 and x % 11 < 8 and acres > 0 and coalesce(comps, 0) >= 3 as passes from k left join c using (subject_id)")
def _(t: Tables) -> DataFrame:
    return Q.verified_comp_gate(t.sql(_FOUND, supplier=t("supplier")), t.sql(_COMPS, lineitem=t("lineitem")), END)


_DISTRESS = """select event_id, lpad(cast(user_id + 1 as string), 18, '0') as parcel_id, 'Lee' as county, 'Owner' as owner_name, lpad(cast(user_id + 1 as string), 18, '0') as ev_parcel_id, 'LEE' as ev_county, case when event_id % 11 = 0 then 'Other' else 'Owner' end as ev_current_owner,
 case when event_id % 7 = 0 then 'REVIEW_REQUIRED' else 'VERIFIED' end as ev_verification_status, 'true' as ev_active, 'false' as ev_released, 'true' as ev_release_search_complete, cast(ts as string) as ev_checked_at, case when event_id % 13 = 0 then 'soon' else '2024-01-30 00:00:00' end as ev_release_checked_at,
 '2023-05-01' as ev_event_date, 'r1' as ev_source_record_id, 'https://x' as ev_source_url, repeat('a', 64) as ev_record_sha256, case event_type when 'click' then 'lis_pendens' when 'view' then 'tax_certificate_delinquency' when 'error' then 'notice_of_default' else 'rumour' end as ev_signal_type, case when event_id % 2 = 0 then '10.5' else 'n/a' end as ev_amount_due,
 case when event_id % 3 = 0 then '2023-02-01' else '2022-12-31' end as ev_delinquent_since from {events}"""
_QUALIFIES = f"event_id % 11 <> 0 and event_id % 7 <> 0 and event_id % 13 <> 0 and cast(ev_checked_at as timestamp) between {_NOW} - interval 7 days and {_NOW} and (ev_signal_type in ('lis_pendens', 'notice_of_default') or (ev_signal_type = 'tax_certificate_delinquency' and event_id % 2 = 0 and event_id % 3 <> 0))"


@query("r4_distress_qualifies", ", e as (" + _DISTRESS.format(events="events") + f") select event_id, {_QUALIFIES} as qualifies from e")
def _(t: Tables) -> DataFrame:
    return t.sql(_DISTRESS, events=t("events")).select("event_id", Q.distress_qualifies(AS_OF).alias("qualifies"))


@query("r5_county_distress", ", e as (" + _DISTRESS.format(events="events") + f") select parcel_id, bool_or({_QUALIFIES}) as distress_verified from e group by parcel_id")
def _(t: Tables) -> DataFrame:
    return Q.county_distress_verified(t.sql(_DISTRESS, events=t("events")), AS_OF)


_SIGNALS = """select event_id as k, user_id + 1 as property_id, lpad(cast(user_id + 1 as string), 18, '0') as parcel_id, case event_type when 'click' then 'lis_pendens_recorded' when 'view' then 'tax_delinquent' else 'absentee_longheld_vacant' end as signal_type,
  case when event_id % 7 = 0 then 'observed' else 'verified' end as signal_status, cast(ts as timestamp) as verified_at, case when event_id % 11 > 0 then 'r' else '' end as source_record_id, case when event_id % 13 > 0 then 'https://x' else 'http://x' end as source_url, value - 50 as amount,
  '{{"current_pa_parcel_id":"' || lpad(cast(user_id + 1 as string), 18, '0') || '","current_pa_owner":"' || case when event_id % 17 > 0 then 'Owner' else 'Other' end || '","source_document_sha256":"' || repeat('a', 64) || '","subsequent_release_found":' || case event_id % 4 when 0 then 'null' when 1 then '"false"' when 2 then 'true' else 'false' end
  || ',"absentee":' || case when event_id % 5 > 0 then 'true' else '"true"' end || ',"vacant":true,"held_years":' || case when event_id % 6 = 0 then '"30"' else cast(event_id % 20 as string) end || '}}' as raw_data from {events}"""


@query("r5_older_distress_rule", ", g as (" + _SIGNALS.format(events="events").replace("{{", "{").replace("}}", "}") + f"), o as (select distinct user_id + 1 as id from events), h as (select property_id as id, bool_or(signal_status = 'verified' and verified_at between {_NOW} - interval 7 days and {_NOW} and length(source_record_id) > 0 and source_url like 'https://%' and k % 17 > 0 and ((signal_type = 'lis_pendens_recorded' and k % 4 = 3) or (signal_type = 'tax_delinquent' and amount > 0) or (signal_type = 'absentee_longheld_vacant' and k % 5 > 0 and k % 6 > 0 and k % 20 >= 10))) as hit from g group by 1) select id, lpad(cast(id as varchar), 18, '0') as parcel_id, coalesce(hit, false) as distress_verified from o left join h using (id)")
def _(t: Tables) -> DataFrame:
    owners = t("events").select((F.col("user_id") + 1).alias("id")).distinct().select("id", F.lpad(F.col("id").cast("string"), 18, "0").alias("parcel_id"), F.lit("Owner").alias("owner_name"))
    return Q.older_distress_rule(owners, t.sql(_SIGNALS, events=t("events")), AS_OF)


_STAGED = """select event_id as id, cast(user_id as string) as parcel_id, case event_id % 4 when 0 then 'official_records' when 1 then 'ATTOM' when 2 then 'official_clerk' else 'official_tax_collector' end as source_name, case when event_id % 5 = 0 then 'http://x' else 'https://x' end as source_url,
  case when event_id % 7 = 0 then 'zz' else repeat('a', 64) end as record_sha256, 'VERIFIED' as verification_status from {events}"""
_TAKEN = "event_id % 4 > 0 and event_id % 5 > 0 and event_id % 7 > 0"


@query("r6_stage_distress", f"select event_id as id, {_TAKEN} as accepted, 'REVIEW_REQUIRED' as verification_status, false as qualifying_distress from events")
def _(t: Tables) -> DataFrame:
    return Q.stage_distress(t.sql(_STAGED, events=t("events"))).select("id", "accepted", "verification_status", "qualifying_distress")


@query("r6_upsert_distress", f", n as (select cast(user_id as string) as parcel_id, case event_id % 4 when 1 then 'ATTOM' when 2 then 'official_clerk' else 'official_tax_collector' end as source_name from events where {_TAKEN} group by 1, 2), o as (select distinct cast(user_id as string) as parcel_id, 'ATTOM' as source_name from events where user_id % 3 = 0) select coalesce(n.parcel_id, o.parcel_id) as parcel_id, coalesce(n.source_name, o.source_name) as source_name, case when n.parcel_id is not null then 'REVIEW_REQUIRED' else 'old' end as verification_status, cast(floor(epoch(case when n.parcel_id is not null then {_NOW} else timestamp '2024-01-01' end)) as bigint) as checked_at from n full join o on n.parcel_id = o.parcel_id and n.source_name = o.source_name")
def _(t: Tables) -> DataFrame:
    """What is staged replaces what was held of its parcel and source."""
    old = t("events").where("user_id % 3 = 0").select(F.col("user_id").cast("string").alias("parcel_id"), F.lit("ATTOM").alias("source_name")).distinct()
    old = old.withColumns({"evidence": F.lit('{"verification_status":"old"}'), "checked_at": F.lit("2024-01-01").cast("timestamp")})
    out = Q.upsert_distress(old, t.sql(_STAGED, events=t("events")), AS_OF, "id")
    return out.select("parcel_id", "source_name", F.get_json_object("evidence", "$.verification_status").alias("verification_status"), F.unix_timestamp("checked_at").alias("checked_at"))


_DOCS = """select event_id as id, cast(user_id as string) as parcel_id, case when event_id % 3 = 0 then 'VERIFIED' when event_id % 31 > 0 then 'REVIEW_REQUIRED' end as status, case when event_id % 5 = 0 then 'http://x' else 'https://x' end as document_url, case when event_id % 7 = 0 then 'zz' else repeat('a', 64) end as document_sha256,
  case when event_id % 11 = 0 then ' ' else 'PB 1' end as instrument_reference, case when event_id % 13 = 0 then '{{}}' else '[]' end as evidence_candidates, case event_id % 17 when 0 then true when 1 then null else false end as exact_frontage_verified, event_id % 19 = 0 as legal_access_verified from {events}"""
_SOUND = "event_id % 3 > 0 and event_id % 31 > 0 and event_id % 5 > 0 and event_id % 7 > 0 and event_id % 11 > 0 and event_id % 13 > 0 and event_id % 17 > 1 and event_id % 19 > 0"


@query("r7_stage_documents", f"select event_id as id, {_SOUND} as accepted from events")
def _(t: Tables) -> DataFrame:
    return Q.stage_documents(t.sql(_DOCS, events=t("events"))).select("id", "accepted")


@query("r7_merge_documents", f", n as (select cast(user_id as string) as parcel_id, max(event_id) as last from events where {_SOUND} group by 1), o as (select distinct cast(user_id as string) as parcel_id from events where user_id % 2 = 0) select coalesce(n.parcel_id, o.parcel_id) as parcel_id, case when o.parcel_id is not null then 'kept' end as note, case when last is not null then 'https://x' end as url, case when last is not null then '{AS_OF}' end as staged_at from n full join o on o.parcel_id = n.parcel_id")
def _(t: Tables) -> DataFrame:
    """Research of parcels, some of it there before, with the last document that was accepted."""
    old = t("events").where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("parcel_id")).distinct().withColumn("research", F.lit('{"note":"kept"}'))
    out = Q.merge_documents(old, t.sql(_DOCS, events=t("events")), AS_OF, "id")
    return out.select("parcel_id", F.get_json_object("research", "$.note").alias("note"), F.get_json_object("research", "$.recorded_document.document_url").alias("url"), F.get_json_object("research", "$.document_staged_at").alias("staged_at"))


_DD = "select c_custkey as id, c_name as owner_now, case when c_custkey % 3 = 0 then lower(c_name) else 'else' end as owner_stored, case when c_custkey % 4 = 0 then '0' when c_custkey % 4 = 1 then '12.5' when c_custkey % 4 = 2 then '' end as amount_due, c_custkey % 2 = 0 as flood_hit, c_custkey % 5 = 0 as wet_hit, c_custkey % 7 = 0 as zoning_hit, case when c_custkey % 8 = 0 then true end as street_hit, c_custkey % 2 = 1 as water_hit, case when c_custkey % 9 <> 0 then false end as sewer_hit, case when c_custkey % 6 = 0 then 'recorded_sales_found' end as comps_status, case when c_custkey % 12 = 1 then 'buyer_path_verified' end as exit_status, c_custkey % 10 <> 0 as required_ok from {customer}"


@query("r8_derive_dd_fields", ", d as (" + _DD.format(customer="customer") + ") select id, case when required_ok and id % 3 = 0 then 'owner_name_match_current_pa' else 'review_required' end as title_status, case when required_ok and amount_due = '0' then 'current_pa_zero_due' when required_ok and amount_due = '12.5' then 'current_pa_balance_due' else 'review_required' end as tax_status, case when required_ok and flood_hit then 'point_screen_only' else 'review_required' end as flood_status, case when required_ok and wet_hit then 'point_screen_only' else 'review_required' end as wetlands_status, case when required_ok and zoning_hit then 'verified_gis' else 'review_required' end as zoning_status, case when required_ok and street_hit then 'verified_near_mapped_street' else 'review_required' end as access_status, case when required_ok and water_hit and sewer_hit is not null then 'service_area_verified' else 'review_required' end as utilities_status, case when required_ok then coalesce(comps_status, 'review_required') else 'review_required' end as comps_status, case when required_ok then coalesce(exit_status, 'review_required') else 'review_required' end as exit_status, 'review_required' as underwriting_status, 'review_required' as status, 0 as dd_score, cast(null as double) as estimated_value, cast(null as double) as preliminary_mao, cast(null as double) as confidence_score, false as eligible_for_automated_acquisition, case when not required_ok then 'source_or_write_failure' end as source_error from d")
def _(t: Tables) -> DataFrame:
    return Q.derive_dd_fields(t.sql(_DD, customer=t("customer")))


_FIN = "select c_custkey as id, case c_custkey % 4 when 0 then map('FLU', 'RL-1', 'DESCRIPTION', c_mktsegment) when 1 then map('FLUNAME', '') when 2 then map('OTHER', 'x') end as land_use, c_custkey % 3 = 0 as road_hit, case c_custkey % 5 when 0 then '' when 1 then 'n/a' else cast(c_acctbal as string) end as assessed_value, case when c_custkey % 3 = 0 then 'true' when c_custkey % 3 = 1 then 'FALSE' else '1' end as road_signal from {customer}"


@query("r9_finalize_dd", "select c_custkey as id, case c_custkey % 4 when 0 then c_mktsegment when 1 then '' end as classification, case when c_custkey % 4 < 3 then 'future_land_use_verified' else 'review_required' end as zoning_status, case when c_custkey % 3 = 0 then 'mapped_road_proximity_verified' else 'review_required' end as access_status, 'review_required' as comps_status, 'review_required' as underwriting_status, 'review_required' as status, 0 as dd_score, case when c_custkey % 5 > 1 then cast(c_acctbal as double) end as assessed_reference_value, false as eligible_for_automated_acquisition, cast(null as double) as estimated_value, case when c_custkey % 4 = 0 then c_mktsegment end as future_land_use, case when c_custkey % 3 = 0 then true end as road_access_signal from customer")
def _(t: Tables) -> DataFrame:
    return Q.finalize_dd(t.sql(_FIN, customer=t("customer")))


@query("r10_title_access_stamp", "select c_custkey as id, case c_custkey % 3 when 0 then true when 1 then false end as near_road, false as legal_access_verified, false as title_verified from customer")
def _(t: Tables) -> DataFrame:
    return Q.title_access_stamp(t.sql(_FIN, customer=t("customer")))


_REPLIES = """select event_id as id, case event_id % 7 when 0 then '{{"features":[{{"a":1}}]}}' when 1 then '{{"features":[]}}' when 2 then '{{"error":{{"code":1}},"features":[]}}' when 3 then '{{"features":[],"exceededTransferLimit":true}}' when 4 then 'not json' when 5 then '{{"features":{{"a":1}}}}' else props end as reply from {events}"""


@query("x6_gis_response_complete", "select event_id as id, event_id % 7 <= 1 as complete from events")
def _(t: Tables) -> DataFrame:
    return t.sql(_REPLIES, events=t("events")).select("id", Q.gis_response_complete(F.col("reply")).alias("complete"))


_POLY = """select event_id as id, case event_id % 8 when 0 then '{{"rings":[[[-82,26],[-82,27],[-81,27],[-82,26]]]}}' when 1 then '{{"rings":[[[-82.5,26.5],[-82,27],[-81,27.25],[-82.5,26.5]]]}}' when 2 then '{{"rings":[[["-82",26],[-82,27],[-81,27],["-82",26]]]}}' when 3 then '{{"rings":[[[-82,26],[-82,27],[-81,27]]]}}'
  when 4 then '{{"rings":[[[-82,26],[-82,27],[-81,27],[-80,26]]]}}' when 5 then '{{"rings":[]}}' when 6 then '{{"rings":[[[-182,26],[-82,27],[-81,27],[-182,26]]]}}' else 'x' end as polygon from {events}"""


@query("x7_polygon_valid", "select event_id as id, event_id % 8 <= 1 as valid from events")
def _(t: Tables) -> DataFrame:
    return t.sql(_POLY, events=t("events")).select("id", Q.polygon_valid(F.col("polygon")).alias("valid"))


_SCREENS = """select event_id as id, case event_type when 'error' then 'FEMA_FLOOD' when 'click' then 'LEE_ROAD' else 'USFWS_WETLANDS' end as source, case when user_id % 3 = 0 then 'charlotte' else 'Lee' end as county, case event_id % 7
  when 0 then '{{"features":[{{"attributes":{{"SURFACE":"PAVED"}}}},{{"attributes":{{"SURFACE":"DIRT","PAVED":"YES"}}}},{{"attributes":{{"OTHER":"PAVED","SURFACE":" paved "}}}}]}}' when 1 then '{{"features":[]}}' when 2 then '{{"error":{{"code":1}},"features":[]}}' when 3 then '{{"features":[],"exceededTransferLimit":true}}' when 4 then 'not json' when 5 then '{{"features":{{"a":1}}}}'
  else '{{"features":[{{"attributes":{{"PAVED":"No"}}}}]}}' end as reply from {events}"""


@query("x8_evidence_outcome", ", s as (" + _SCREENS.format(events="events").replace("{{", "{").replace("}}", "}") + ") select id, case when id % 7 between 2 and 5 then 'ERROR' when id % 7 in (0, 6) then 'FOUND' when source = 'FEMA_FLOOD' then 'UNVERIFIED' else 'NOT_FOUND' end as outcome, case id % 7 when 0 then 3 when 1 then 0 when 6 then 1 end as feature_count, case when source = 'LEE_ROAD' then case id % 7 when 0 then case when county = 'Lee' then 2 else 1 end when 1 then 0 when 6 then 0 end end as paved_candidate_count from s")
def _(t: Tables) -> DataFrame:
    rows = t.sql(_SCREENS, events=t("events"))
    features = F.transform(F.from_json("reply", "struct<features:array<struct<attributes:map<string,string>>>>")["features"], lambda f: f["attributes"])
    out = Q.evidence_outcome(F.col("source"), Q.gis_response_complete(F.col("reply")), features, F.col("county"), F.col("source") == "LEE_ROAD")
    return rows.select("id", out.alias("x")).select("id", "x.*")


_VIEWED = "select parcel_id, case cast(parcel_id as bigint) % 5 when 0 then 'Polk' when 1 then 'CHARLOTTE' else county end as county, owner_name, city as site_address, case cast(parcel_id as bigint) % 3 when 0 then 'VERIFIED' when 1 then 'old' end as seller_distress_status from {screening}"


@query("x9_qualification_view", _R3 + ", v as (" + _VIEWED.format(screening="screening") + "), j as (select v.*, cast(v.parcel_id as bigint) as k, case when r3.status = 'HOLD' then r3.missing else '' end as missing, case when r3.status like 'QUAL%' or cast(v.parcel_id as bigint) % 7 = 0 then 'QUALIFIED' else r3.status end as status from r3 join v using (parcel_id) where lower(v.county) in ('lee', 'charlotte')), w as (select *, k % 4 > 0 and status = 'QUALIFIED' and coalesce(seller_distress_status = 'VERIFIED', false) as seen from j) select parcel_id as strap, county, owner_name, site_address as property_address, status as qualification_status, case when k % 6 = 0 then 'full_polygon_flood_hazard' when k % 11 = 0 then 'UNVERIFIED' else missing end as buildability_status, case when seen then 'DISTRESS_REVIEW_REQUIRED' else 'UNVERIFIED_DISTRESS' end as financial_distress_reason, case when seen then 'REVIEW_PROPERTY_WITH_OWNER' end as conversation_hook, false as seller_card_release_authorized from w")
def _(t: Tables) -> DataFrame:
    k = F.col("parcel_id").cast("bigint")
    results = refreshed(t).withColumns({"reason": F.when(k % 6 == 0, "full_polygon_flood_hazard"), "missing": F.when(k % 11 > 0, F.col("missing")), "eligible_for_contact": F.when(k % 4 > 0, True)})
    results = results.withColumn("status", F.when((F.col("status") == Q.QUALIFIED) | (k % 7 == 0), "QUALIFIED").otherwise(F.col("status")))
    return Q.qualification_view(results, t.sql(_VIEWED, screening=t("screening"))).drop("evaluated_at")


_CARDS = "select s_suppkey as k, 'lee' as county, 'S' || cast(s_suppkey as string) as strap, s_name as owner_name, cast(s_nationkey as string) as contact_info, 'x' as property_address, 'd' as distress_detail, 'h' as conversation_hook, timestamp '2024-01-01' as screening_checked_at, s_suppkey % 13 > 0 as distress_verified, s_suppkey % 17 > 0 as paved_frontage_verified, case when s_suppkey % 11 > 0 then true end as legal_access_verified, true as nwi_coverage_verified, s_suppkey % 19 > 0 as flood_coverage_verified, true as zoning_verified, true as regulatory_wetlands_verified, s_suppkey % 7 > 0 as title_verified, case when s_suppkey % 23 > 0 then 's' end as distress_source, timestamp '2024-01-01' as distress_checked_at, case when s_suppkey % 9 > 0 then s_suppkey % 5 * 7.5 end as wetlands_pct, 98 + s_suppkey % 3 as floodway_pct, case when s_suppkey % 2 = 0 then 'X' end as flood_zone from {supplier}"


@query("x10_seller_cards", "select 'S' || cast(s_suppkey as varchar) as strap, s_name as owner_name, cast(s_nationkey as varchar) as contact_info, 'Paved frontage verified; ' || printf('%.4f', s_suppkey % 5 * 7.5) || '% mapped wetlands; Flood Zone ' || case when s_suppkey % 2 = 0 then 'X' else 'unknown' end as buildability_summary from supplier where s_suppkey % 13 > 0 and s_suppkey % 17 > 0 and s_suppkey % 11 > 0 and s_suppkey % 19 > 0 and s_suppkey % 7 > 0 and s_suppkey % 23 > 0 and s_suppkey % 9 > 0 and s_suppkey % 3 < 2")
def _(t: Tables) -> DataFrame:
    return Q.seller_cards(t.sql(_CARDS, supplier=t("supplier"))).select("strap", "owner_name", "contact_info", "buildability_summary")


_CONTACTS = "select c_custkey as id, c_nationkey as priority_score, case c_custkey % 3 when 0 then 'closed' when 1 then 'ready_for_crm' else 'needs_enrichment' end as crm_status, case c_custkey % 4 when 0 then 'buyer' when 1 then 'title' else 'seller' end as entity_type from {customer}"


@query("t1_crm_queue", ", c as (" + _CONTACTS.format(customer="customer") + ") select id, priority_score from c where crm_status in ('ready_for_crm', 'needs_enrichment') and entity_type = 'seller' order by priority_score desc, id limit 200")
def _(t: Tables) -> DataFrame:
    return Q.crm_queue(t.sql(_CONTACTS, customer=t("customer")), "seller").select("id", "priority_score")


@query("t2_buyer_exit", ", m as (select o_custkey as property_id, o_totalprice as s, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders), b as (select property_id, count(*) as n, max(s) as s from m where k <= 20 group by property_id) select c_custkey as property_id, coalesce(n, 0) as buyer_matches, coalesce(s, 0) as max_match_score, case when n > 0 then 'buyer_path_verified' else 'review_required' end as exit_status from customer left join b on property_id = c_custkey")
def _(t: Tables) -> DataFrame:
    matches = t("orders").select(F.col("o_custkey").alias("property_id"), F.col("o_totalprice").alias("match_score"), F.col("o_orderkey").alias("buyer_id"))
    return Q.buyer_exit(t("customer").select(F.col("c_custkey").alias("property_id")), matches)


@query("c24_inventory_counts", "select count(*) as properties, count(*) filter (parcel_id <> '') as with_parcel, count(*) filter (property_type = 'land') as land, (select count(*) from customer) as leads, (select count(*) from customer where c_custkey % 3 = 0) as held from properties")
def _(t: Tables) -> DataFrame:
    return Q.inventory_counts(t("properties"), t("customer").select(F.when(F.col("c_custkey") % 3 == 0, "held").otherwise("new").alias("status")))


_LEDGER = "select r_name as feed, cast(r_regionkey * 10 as bigint) as rows, case when r_regionkey % 2 = 0 then 'verified' else 'loaded' end as state from {region}"


@query("m6_ledger_upsert", ", l as (" + _LEDGER.format(region="region") + ") select feed, case when feed = 'ASIA' then 99 else rows end as rows, case when feed = 'ASIA' then 'verified' else state end as state from l")
def _(t: Tables) -> DataFrame:
    ledger = t.sql(_LEDGER, region=t("region"))
    return Q.ledger_upsert(ledger, ledger.where("feed = 'ASIA'").select("feed", F.lit(99).cast("long").alias("rows"), F.lit("verified").alias("state")))


@query("m6_ledger_drift", "select r_name as feed, cast(r_regionkey * 10 as bigint) as rows, cast(case when r_regionkey <> 3 then r_regionkey * r_regionkey * 10 end as bigint) as table_rows from region where r_regionkey not in (0, 1)")
def _(t: Tables) -> DataFrame:
    ledger = t.sql(_LEDGER, region=t("region"))
    k = F.col("rows") / 10
    return Q.ledger_drift(ledger, ledger.where("rows <> 30").select("feed", (k * k * 10).cast("long").alias("n")))


@query("m6_sequence_verified", "select bool_and(r_regionkey % 2 = 0) as verified, count(*) filter (r_regionkey % 2 = 1) as open_feeds from region")
def _(t: Tables) -> DataFrame:
    return Q.sequence_verified(t.sql(_LEDGER, region=t("region")), ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
