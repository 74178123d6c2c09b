"""Queries on feeds: scalar contracts, gates, profiles, snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import gates, profile, snapshots
from .bindings import AS_OF, END, START
from .catalogue import Tables, query

_KEY18 = r"regexp_full_match(parcel_id, '[0-9]{18}')"
_INT32 = "(regexp_full_match({0}, '[0-9]+') and try_cast({0} as hugeint) <= 2147483647)"
_DATE = "try_strptime(saledt, '%m/%d/%Y')"
_KEY = "case when regexp_full_match(regexp_replace(upper(parcel_id), '[^A-Z0-9]', '', 'g'), '[0-9]{18}') then regexp_replace(upper(parcel_id), '[^A-Z0-9]', '', 'g') end"
_ALIAS = "case when regexp_full_match({0}, '[0-9]+') then ltrim({0}, '0') else '' end"
_NORMAL = rf"""
, s1 as (select *, case when not {_KEY18} then 'parcel_id' when not {_INT32.format('ln_num')} then 'ln_num'
    when saledt <> '' and {_DATE} is null then 'saledt' when price <> '' and not regexp_full_match(price, '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)') then 'price'
    when price <> '' and cast(price as decimal(38,10)) < 0 then 'negative_price' end as error from sales_dirty)
"""


@query("s1_normalize_sales", _NORMAL + "select parcel_id, sale_id, ln_num, saledt, price, error from s1")
def _(t: Tables) -> DataFrame:
    return S.normalize_sales(t("sales_dirty")).select("parcel_id", "sale_id", "ln_num", "saledt", "price", "error")


@query("s2_type_sales", f"select parcel_id, nullif(sale_id, '') as sale_id, cast(ln_num as int) as ln_num, cast({_DATE} as date) as saledt, cast(nullif(price, '') as decimal(38,10)) as price, nullif(foreclosure, '') as foreclosure from sales_raw")
def _(t: Tables) -> DataFrame:
    return S.type_sales(t("sales_raw")).select("parcel_id", "sale_id", "ln_num", "saledt", "price", "foreclosure")


@query("s3_parcel_key", f"select id, {_KEY} as parcel_key from properties")
def _(t: Tables) -> DataFrame:
    return t("properties").select("id", S.parcel_key(F.col("parcel_id")).alias("parcel_key"))


@query("s4_format_parcel", "select parcel_id, substr(parcel_id, 1, 2) || '-' || substr(parcel_id, 3, 2) || '-' || substr(parcel_id, 5, 2) || '-' || substr(parcel_id, 7, 6) || '-' || substr(parcel_id, 13, 6) as dashed from parcel_raw")
def _(t: Tables) -> DataFrame:
    return t("parcel_raw").select("parcel_id", S.format_parcel(F.col("parcel_id")).alias("dashed"))


@query("s5_validate_tax", f"select parcel_id, lnnum, {_KEY} as parcel_key, case when ({_KEY}) is null then 'parcel_id' when not {_INT32.format('lnnum')} then 'lnnum' when trim(taxdist) = '' then 'taxdist' end as error from tax_raw")
def _(t: Tables) -> DataFrame:
    return S.validate_tax(t("tax_raw")).select("parcel_id", "lnnum", "parcel_key", "error")


@query("s6_validate_property", rf"select parcel_id, cast(ln_num as int) as line, case when not {_KEY18} then 'parcel_id' when pctown <> '' and not coalesce(cast(pctown as decimal(38,10)) <= 100, false) then 'pctown' end as error from owner_raw")
def _(t: Tables) -> DataFrame:
    return S.validate_property(t("owner_raw"), "owner").select("parcel_id", "line", "error")


@query("s7_reference_alias", f"select page, {_ALIAS.format('book')} as book_alias, {_ALIAS.format('sale_id')} as sale_alias from sales_raw")
def _(t: Tables) -> DataFrame:
    return t("sales_raw").select("page", S.reference_alias(F.col("book")).alias("book_alias"), S.reference_alias(F.col("sale_id")).alias("sale_alias"))


@query("s8_amounts", "select parcel_id, ln_num, cast(nullif(price, '') as decimal(38,10)) as amount, cast(nullif(price, '') as decimal(38,10)) as money, coalesce(try_cast(nullif(price, '') as double), 0.0) as num from sales_raw")
def _(t: Tables) -> DataFrame:
    sales = t("sales_raw").withColumn("shown", F.when(F.col("price") != "", F.concat(F.lit("Judgment: $"), F.format_number(F.col("price").cast("decimal(18,2)"), 2))).otherwise("none"))
    return sales.select("parcel_id", "ln_num", S.amount(F.col("price")).alias("amount"), S.money(F.col("shown")).alias("money"), S.to_num(F.concat(F.lit(" $"), "price")).alias("num"))


@query("s9_sha_shard", "select parcel_id, cast(cast('0x' || substr(sha256(parcel_id), 1, 16) as ubigint) % 32 as int) as shard from parcel_raw")
def _(t: Tables) -> DataFrame:
    return t("parcel_raw").select("parcel_id", S.sha_shard(F.col("parcel_id"), 32).alias("shard"))


@query("s10_md5_shard", "select parcel_id, cast((cast(cast('0x' || substr(md5(parcel_id), 1, 16) as ubigint) % 96 as hugeint) * 64 + cast('0x' || substr(md5(parcel_id), 17, 16) as ubigint) % 96) % 96 as int) as shard from parcel_raw")
def _(t: Tables) -> DataFrame:
    return t("parcel_raw").select("parcel_id", S.md5_shard(F.col("parcel_id"), 96).alias("shard"))


@query("s11_parse_year", "select parcel_id, ln_num, try_cast(nullif(right(saledt, 4), '') as int) as year, try_cast(nullif(right(saledt, 4), '') as int) as year_dashed, try_cast(nullif(right(saledt, 4), '') as int) as year_token from sales_raw")
def _(t: Tables) -> DataFrame:
    year, text = S.parse_year, F.col("saledt")
    return t("sales_raw").select("parcel_id", "ln_num", year(text).alias("year"), year(F.translate(text, "/", "-")).alias("year_dashed"), year(F.when(text != "", F.concat(F.lit("sold/"), F.substring(text, 7, 4), F.lit("/x"))).otherwise("")).alias("year_token"))


@query("s12_window_class", f"select parcel_id, ln_num, case when {_DATE} is null then 'undated' when {_DATE} > date '{END}' then 'after_as_of' when {_DATE} < date '{START}' then 'before_window' else 'in_window' end as window_class from sales_raw")
def _(t: Tables) -> DataFrame:
    return t("sales_raw").select("parcel_id", "ln_num", S.window_class(S.sale_date(F.col("saledt")), START, END).alias("window_class"))


_ROADS = "select s_suppkey as id, case when s_suppkey % 3 = 0 then 'Lee' when s_suppkey % 3 = 1 then ' charlotte' else 'polk' end as county, case when s_suppkey % 3 = 0 then 'SURFACE' when s_suppkey % 3 = 1 then 'PAVED' else 'OTHER' end as field, case when s_suppkey % 5 = 0 then 'DIRT' when s_suppkey % 5 = 1 then 'yes' when s_suppkey % 5 = 2 then 'NO' when s_suppkey % 5 = 3 then 'PAVED' end as value from {supplier}"


@query("s13_road_surface_class", ", roads as (" + _ROADS.format(supplier="supplier") + ") select id, case when county = 'Lee' and value = 'PAVED' then 'PAVED' when county = 'Lee' and value = 'DIRT' then 'UNPAVED' when county = ' charlotte' and value = 'yes' then 'PAVED' when county = ' charlotte' and value = 'NO' then 'UNPAVED' else 'REVIEW' end as surface from roads")
def _(t: Tables) -> DataFrame:
    return t.sql(_ROADS, supplier=t("supplier")).select("id", S.road_surface_class(F.col("county"), F.col("field"), F.col("value")).alias("surface"))


@query("s14_county_config", "select id, lower(trim(county)) as county, case lower(trim(county)) when 'lee' then 'SURFACE' when 'charlotte' then 'PAVED' when 'polk' then 'SURFTYPE' end as road_field, case lower(trim(county)) when 'lee' then 'STRAP' when 'charlotte' then 'ACCOUNT' when 'polk' then 'PARCELID' end as identity_field, case lower(trim(county)) when 'charlotte' then 6 when 'lee' then 5 else 3 end as parcel_fields, 5 as road_fields from properties")
def _(t: Tables) -> DataFrame:
    return t("properties").select("id", F.lower(F.trim("county")).alias("county")).join(F.broadcast(S.county_config(t.spark)), "county", "left").withColumns({"parcel_fields": F.size("parcel_fields"), "road_fields": F.size("road_fields")})


_FLAGS = """
, f1 as (select parcel_id, case dorus_code when '9910' then 'county_inaccessible_tract' when '9350' then 'county_mineral_rights' when '0989' then 'county_split_combine' end as by_code,
    case lower(dordesc1) when 'inaccessible tracts' then 'county_inaccessible_tract' when 'mineral rights (not phos.)' then 'county_mineral_rights' when 'split and/or combine in progress' then 'county_split_combine' end as by_text from parcel_raw),
flags as (select parcel_id, coalesce(by_code, by_text) as reason, by_code is distinct from by_text and coalesce(by_code, by_text) is not null as mismatch from f1)
"""


@query("s15_source_review_flags", _FLAGS + "select parcel_id, coalesce(reason, '') || case when mismatch then ',county_classification_mismatch' else '' end as flags from flags")
def _(t: Tables) -> DataFrame:
    return t("parcel_raw").select("parcel_id", F.array_join(S.source_review_flags(F.col("dorus_code"), F.col("dordesc1")), ",").alias("flags"))


@query("s16_residential_split", "select parcel_id, starts_with(lower(dordesc1), 'vac') as vacant from parcel_raw where dordesc = 'RES'")
def _(t: Tables) -> DataFrame:
    return S.residential_split(t("parcel_raw")).select("parcel_id", "vacant")


@query("s17_owner_match", "select id, owner_name <> '' as same, id % 2 = 0 as other from properties")
def _(t: Tables) -> DataFrame:
    p = t("properties").withColumn("seen", F.lower(F.replace("owner_name", F.lit("#"), F.lit(" # "))))
    return p.select("id", S.owner_match(F.col("owner_name"), F.col("seen")).alias("same"), S.owner_match(F.col("owner_name"), F.when(F.col("id") % 2 == 0, F.col("seen")).otherwise("x")).alias("other"))


#: Access reviews of customers, some short of one piece of evidence.
ACCESS = """select c_custkey as id, lpad(cast(c_custkey + 1 as string), 18, '0') as parcel_id, case when c_custkey % 7 = 6 then 'PENDING' else 'VERIFIED' end as status,
  case when c_custkey % 11 = 0 then 'http://a' else 'https://a' end as source_url, case when c_custkey % 13 = 0 then 'ab' else repeat('a', 64) end as record_sha256,
  case when c_custkey % 5 = 4 then null when c_custkey % 29 = 3 then '  ' else 'OR 1' end as instrument, cast(c_custkey % 17 as double) as frontage_ft, 'rev' as reviewer, true as frontage_confirmed, true as access_confirmed, true as instrument_confirmed,
  c_custkey % 19 <> 1 as plat_confirmed, timestamp '2024-01-01 00:00:00' as reviewed_at, case when c_custkey % 23 = 2 then timestamp '2023-12-01 00:00:00' else timestamp '2024-06-01 00:00:00' end as expires_at from {customer}"""


@query("s18_access_review_valid", ", a as (" + ACCESS.format(customer="customer") + ") select id, status <> 'VERIFIED' or (id % 11 <> 0 and id % 13 <> 0 and coalesce(length(trim(instrument)), 0) > 0 and id % 17 > 0 and id % 19 <> 1 and id % 23 <> 2) as valid from a")
def _(t: Tables) -> DataFrame:
    return t.sql(ACCESS, customer=t("customer")).select("id", S.access_review_valid().alias("valid"))


@query("g1_error_counts", _NORMAL + "select error, count(*) as n from s1 group by error")
def _(t: Tables) -> DataFrame:
    return gates.error_counts(S.normalize_sales(t("sales_dirty")))


@query("g2_duplicate_keys", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def _(t: Tables) -> DataFrame:
    return gates.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


_EXPORTS = "select 'project' || cast(p_partkey % 3 as string) as project_ref, timestamp '2024-01-30 12:00:00' as captured_at, 0 as registry_drift, lpad(cast(case when p_partkey % 3 = 2 then p_partkey % 5 else p_partkey end as string), case when p_partkey = 4 then 17 else 18 end, '0') as k from {part}"


@query("g4_target_gate", ", e as (" + _EXPORTS.format(part="part") + ") select project_ref, count(*) as n_keys, count(*) filter (length(k) <> 18) as invalid_keys, count(*) - count(distinct k) as repeated_keys, project_ref = 'project0' as usable from e group by project_ref")
def _(t: Tables) -> DataFrame:
    return gates.target_gate_rows(t.sql(_EXPORTS, part=t("part")).withColumnRenamed("k", "parcel_key"), "project0", AS_OF)


@query("g5_coverage_gate", "select cast(o_orderdate as date) as day, count(*) as parsed, count(*) >= count(*) + cast(day(o_orderdate) % 3 as bigint) - 1 as covered, count(*) < 8 as sized from orders group by o_orderdate")
def _(t: Tables) -> DataFrame:
    days = t("orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.count("*").alias("parsed"))
    return days.select(F.col("day").cast("date").alias("day"), "parsed", gates.coverage_gate(F.col("parsed"), F.col("parsed") + F.day("day") % 3, slack=1).alias("covered"), gates.size_gate(F.col("parsed"), 8).alias("sized"))


_PROBE = """select '{name}' as candidate, cast(sum(case when b then n else 0 end) as bigint) as blank_rows, cast(sum(case when b then 0 else n - 1 end) as bigint) as duplicate_rows, count(*) filter (not b) as distinct_keys,
  sum(case when b then n else 0 end) = 0 and sum(case when b then 0 else n - 1 end) = 0 as complete_unique from (select {cols}, {blank} as b, count(*) as n from sales_raw group by {cols})"""


def _probe(*keys: tuple[str, ...]) -> str:
    return " union all ".join(_PROBE.format(name="+".join(k), cols=", ".join(k), blank=" or ".join(f"trim({c}) = ''" for c in k)) for k in keys)


@query("c1_probe_keys", _probe(("parcel_id", "ln_num"), ("sale_id",), ("book", "page"), ("parcel_id",)))
def _(t: Tables) -> DataFrame:
    return profile.probe_keys(t("sales_raw"), [["parcel_id", "ln_num"], ["sale_id"], ["book", "page"], ["parcel_id"]])


@query("c2_probe_key_pairs", _probe(("parcel_id", "ln_num"), ("parcel_id", "page"), ("parcel_id", "saledt"), ("parcel_id", "ln_num", "page"), ("parcel_id", "ln_num", "saledt"), ("parcel_id", "page", "saledt")))
def _(t: Tables) -> DataFrame:
    return profile.probe_key_pairs(t("sales_raw"), "parcel_id", ["ln_num", "page", "saledt"])


_COLS = ("sale_id", "saledt", "price", "book", "foreclosure", "grantor")


@query("c3_profile_columns", " union all ".join(f"select '{c}' as column_name, count(*) filter (trim({c}) = '') as blank_rows, count(*) filter (trim({c}) <> {c}) as outer_space_rows, max(length({c})) as max_length from sales_raw" for c in _COLS))
def _(t: Tables) -> DataFrame:
    return profile.profile_columns(t("sales_raw").select(*_COLS))


@query("c4_width_distribution", "select cast(len(string_split(value, ',')) as int) as fields, count(*) as n, len(string_split(value, ',')) <> 8 as bad from legal_lines group by all")
def _(t: Tables) -> DataFrame:
    return profile.width_distribution(t("legal_lines"), ",", 8)


@query("c5_physical_lines", ", s as (select cast(1 + length(text) - length(replace(text, chr(10), '')) as bigint) as span from documents where text is not null) select span, count(*) as n, (span - 1) * count(*) as extra_lines from s group by span")
def _(t: Tables) -> DataFrame:
    return profile.reconcile_physical_lines(t("documents").where("text is not null"), ["text"])


@query("c6_id_semantics", "select count(*) as n, count(*) filter (sale_id = book) as equal_rows, count(*) filter (sale_id <> book) as differ_rows, count(distinct sale_id) as distinct_a, count(distinct book) as distinct_b, min(sale_id) as min_a, max(sale_id) as max_a from sales_raw")
def _(t: Tables) -> DataFrame:
    return profile.id_semantics(t("sales_raw"), "sale_id", "book")


@query("c6_top_values", "select sale_id as value, count(*) as n from sales_raw group by sale_id order by n desc, value limit 10")
def _(t: Tables) -> DataFrame:
    return profile.top_values(t("sales_raw"), "sale_id")


@query("c7_id_fanout", "select others, count(*) as keys from (select sale_id, count(distinct parcel_id) as others from sales_raw where sale_id <> '' group by sale_id) group by others")
def _(t: Tables) -> DataFrame:
    return profile.id_fanout(t("sales_raw"), "sale_id", "parcel_id")


@query("c8_line_gaps", """
, g as (select l_orderkey as k, count(*) as n, min(l_linenumber) as lo, max(l_linenumber) as hi, list_sort(list(distinct l_linenumber)) as seen from lineitem group by l_orderkey having count(*) > 1)
select k as l_orderkey, n, case when n > len(seen) then 'duplicate' when hi - lo + 1 > len(seen) then 'gapped' else 'contiguous' end as kind,
  array_to_string(list_filter(range(lo, hi + 1), lambda x: not list_contains(seen, x))[1:5], ',') as first_missing from g""")
def _(t: Tables) -> DataFrame:
    return profile.line_gaps(t("lineitem"), "l_orderkey", F.col("l_linenumber"))


@query("c9_shard_balance", " union all ".join(f"select {n} as shards, min(c) as min_rows, max(c) as max_rows, round(sum(c) / {n}, 6) as avg_rows, round(max(c) * {n} / sum(c), 6) as max_over_avg from (select cast('0x' || substr(sha256(parcel_id), 1, 16) as ubigint) % {n} as s, count(*) as c from sales_raw group by s)" for n in (32, 64, 96, 128)))
def _(t: Tables) -> DataFrame:
    return profile.shard_balance(t("sales_raw"), "parcel_id")


_BYTES = "(" + " + ".join(f"strlen({c})" for c in S.SALES) + f" + {len(S.SALES) - 1})"


@query("c10_row_payload_stats", f", b as (select {_BYTES} as b, row_number() over (order by {_BYTES}) as k, count(*) over () as n from sales_raw) select max(n) as rows, round(avg(b), 6) as mean_bytes, max(b) filter (k = greatest(cast(floor(n * 0.95) as bigint), 1)) as p95, max(b) filter (k = greatest(cast(floor(n * 0.99) as bigint), 1)) as p99, max(b) as max_bytes, cast(sum(b) as bigint) as total_bytes from b")
def _(t: Tables) -> DataFrame:
    return profile.row_payload_stats(t("sales_raw"))


@query("c11_tax_capacity", ", p as (select parcel_id, count(*) as n, count(distinct lnnum) as lines, count(*) filter (cast(taxesdue as decimal(18,2)) > 0) as due_rows, sum(cast(taxesdue as decimal(18,2))) as due from tax_raw group by parcel_id) select count(*) as parcels, cast(sum(n) as bigint) as rows, round(avg(n), 6) as avg_rows, min(n) as min_rows, max(n) as max_rows, count(*) filter (n > lines) as repeated_line_parcels, cast(sum(due_rows) as bigint) as due_rows, count(*) filter (due > 0) as due_parcels, cast(sum(due) as decimal(28,2)) as total_due from p")
def _(t: Tables) -> DataFrame:
    return profile.tax_capacity(t("tax_raw"))


_SCOPE = f", s as (select r.parcel_id, try_cast(nullif(right(saledt, 4), '') as int) as year, starts_with(lower(dordesc1), 'vac') as vacant, {_BYTES.replace('strlen(parcel_id)', 'strlen(r.parcel_id)')} as b from sales_raw r join parcel_raw p on p.parcel_id = r.parcel_id where dordesc = 'RES') "


@query("c12_sales_scope_by_year", _SCOPE + "select year, count(*) as rows, count(distinct parcel_id) as parcels, count(*) filter (not vacant) as improved_rows, count(*) filter (vacant) as vacant_rows, cast(sum(b) as bigint) as bytes from s group by year")
def _(t: Tables) -> DataFrame:
    return profile.sales_scope_by_year(t("sales_raw"), t("parcel_raw"))


@query("c13_sales_scope_since", _SCOPE + "select start_year, count(*) as rows, count(distinct parcel_id) as parcels, cast(sum(b) as bigint) as bytes from s join (values (1996), (1998), (2000)) v(start_year) on year >= start_year group by start_year")
def _(t: Tables) -> DataFrame:
    return profile.sales_scope_since(t("sales_raw"), t("parcel_raw"), [1996, 1998, 2000])


@query("c14_recording_groups", f"select {_ALIAS.format('book')} as book, {_ALIAS.format('page')} as page, count(*) as n, min(parcel_id) as min_parcel, max(parcel_id) as max_parcel from sales_raw where {_ALIAS.format('book')} <> '' and {_ALIAS.format('page')} <> '' group by 1, 2 having count(*) > 1")
def _(t: Tables) -> DataFrame:
    return profile.repeated_aliases(t("sales_raw"), "book", "page")


@query("c14_sale_id_groups", f"select {_ALIAS.format('sale_id')} as sale_id, count(*) as n, min(parcel_id) as min_parcel, max(parcel_id) as max_parcel from sales_raw where {_ALIAS.format('sale_id')} <> '' group by 1 having count(*) > 1")
def _(t: Tables) -> DataFrame:
    return profile.repeated_aliases(t("sales_raw"), "sale_id")


@query("c16_table_fingerprint", f"select count(*) as rows, count(*) filter (parcel_id = '') as blank_keys, min(parcel_id) as min_key, max(parcel_id) as max_key, cast(sum(cast(cast('0x' || substr(md5(concat_ws(chr(31), {', '.join(S.SALES)})), 1, 15) as ubigint) as hugeint)) as decimal(38,0)) as fingerprint from sales_raw")
def _(t: Tables) -> DataFrame:
    return profile.table_fingerprint(t("sales_raw"), "parcel_id")


@query("c18_prefix_counts", "select substr(parcel_id, 1, 3) as prefix, count(*) as n from sales_raw group by 1")
def _(t: Tables) -> DataFrame:
    return profile.prefix_counts(t("sales_raw"), "parcel_id")


_NORM_OWNER = "md5('[\"' || parcel_id || '\", \"' || cast(cast(ln_num as int) as varchar) || '\", \"' || name || '\", \"' || case when pctown = '.5' then '0.5' when pctown = '50.00' then '50' else pctown end || '\"]')"


@query("c17_row_digest", f"select parcel_id, ln_num, {_NORM_OWNER} as digest from owner_raw")
def _(t: Tables) -> DataFrame:
    return snapshots.row_digest(t("owner_raw"), ["parcel_id", "ln_num", "name", "pctown"], line="ln_num", percent="pctown").select("parcel_id", "ln_num", "digest")


@query("c17_block_digest", f", g as (select parcel_id, count(*) as n, md5(string_agg({_NORM_OWNER}, '' order by ln_num)) as digest from owner_raw group by parcel_id), b as (select substr(md5(parcel_id), 1, 4) as block, sum(n) as n, md5(string_agg(digest, '' order by parcel_id)) as digest from g group by 1) select cast(sum(n) as bigint) as rows, md5(string_agg(digest, '' order by block)) as block_digest from b")
def _(t: Tables) -> DataFrame:
    return snapshots.block_digest(snapshots.row_digest(t("owner_raw"), ["parcel_id", "ln_num", "name", "pctown"], line="ln_num", percent="pctown"), "parcel_id", "ln_num")


_TARGETS = f", targets as (select distinct {_KEY} as parcel_id from properties where ({_KEY}) is not null)"


def targets(t: Tables) -> DataFrame:
    return t("properties").select(S.parcel_key(F.col("parcel_id")).alias("parcel_id")).where("parcel_id is not null").distinct()


@query("c17_feed_digest", f", d as (select parcel_id, cast(ln_num as int) as n, {_NORM_OWNER} as digest from owner_raw) select count(*) as rows, md5(coalesce(string_agg(digest, '' order by parcel_id, n), '')) as feed_digest from d")
def _(t: Tables) -> DataFrame:
    rows = t("owner_raw").withColumn("line", F.col("ln_num").cast("int"))
    return snapshots.feed_digest(snapshots.row_digest(rows, ["parcel_id", "ln_num", "name", "pctown"], line="ln_num", percent="pctown"), "parcel_id", "line")


@query("j1_select_targets", _TARGETS + " select parcel_id, lnnum, taxesdue from tax_raw semi join targets using (parcel_id)")
def _(t: Tables) -> DataFrame:
    return snapshots.select_targets(t("tax_raw"), targets(t)).select("parcel_id", "lnnum", "taxesdue")


@query("j2_target_coverage", _TARGETS + " select (select count(*) from owner_raw) as source_rows, (select count(*) from owner_raw semi join targets using (parcel_id)) as selected_rows, (select count(*) from targets semi join owner_raw using (parcel_id)) as matched, (select count(*) from targets anti join owner_raw using (parcel_id)) as missing, round((select count(*) from owner_raw semi join targets using (parcel_id)) / (select count(*) from owner_raw), 6) as kept_fraction")
def _(t: Tables) -> DataFrame:
    return snapshots.target_coverage(t("owner_raw"), targets(t))


@query("j3_cross_feed_integrity", "select count(distinct parcel_id) filter (parcel_id in (select parcel_id from parcel_raw)) as matched_keys, count(distinct parcel_id) filter (parcel_id not in (select parcel_id from parcel_raw)) as orphan_keys from sales_raw")
def _(t: Tables) -> DataFrame:
    return snapshots.cross_feed_integrity(t("sales_raw"), t("parcel_raw"))


_LOADED = "select parcel_id, ln_num, case when cast(page as bigint) % 101 = 0 then '1.00' else price end as price, saledt from {sales_raw} where cast(page as bigint) % 97 <> 0 union all select parcel_id, ln_num, price, saledt from {sales_raw} where cast(page as bigint) % 103 = 0 union all select 'new' || parcel_id, ln_num, price, saledt from {sales_raw} where cast(page as bigint) % 107 = 0"


@query("j4_reconcile", ", loaded as (" + _LOADED.format(sales_raw="sales_raw") + """), l as (select parcel_id, ln_num, count(*) as copies, min(price) as price, min(saledt) as saledt from loaded group by all)
, z as (select s.parcel_id is not null as src, copies, s.price is not distinct from l.price and s.saledt is not distinct from l.saledt as same from sales_raw s full join l on s.parcel_id = l.parcel_id and s.ln_num = l.ln_num)
select count(*) filter (not src) as outside, count(*) filter (src and copies is not null and not same) as different, count(*) filter (copies > 1) as duplicate, count(*) filter (src and copies is null) as missing, false as passes from z""")
def _(t: Tables) -> DataFrame:
    sales = t("sales_raw")
    return snapshots.reconcile(sales.select("parcel_id", "ln_num", "price", "saledt"), t.sql(_LOADED, sales_raw=sales), ["parcel_id", "ln_num"], ["price", "saledt"])


@query("j5_missing_by_shard", "select cast(cast('0x' || substr(sha256(parcel_id), 1, 16) as ubigint) % 32 as int) as shard, count(*) as n from sales_raw where cast(page as bigint) % 97 = 0 group by 1")
def _(t: Tables) -> DataFrame:
    sales = t("sales_raw")
    return snapshots.missing_by_shard(sales, sales.where("cast(page as bigint) % 97 <> 0"), ["parcel_id", "ln_num"], 32)


_BOTH = f", p as (select id as property_id, {_KEY} as parcel_key from properties where ({_KEY}) is not null), b as (select coalesce(p.property_id, r.property_id) as property_id, p.parcel_key as new_key, r.parcel_key as old_key from p full join registry_old r on p.property_id = r.property_id) "


@query("j6_registry_drift", _BOTH + "select property_id, case when old_key is null then 'missing' when new_key is null then 'stale' else 'changed' end as state from b where old_key is distinct from new_key")
def _(t: Tables) -> DataFrame:
    return snapshots.registry_drift(t("properties"), t("registry_old"))


@query("m1_refresh_registry", _BOTH + f"select property_id, new_key as parcel_key, case when old_key = new_key then timestamp '2024-01-01 00:00:00' else timestamp '{AS_OF}' end as refreshed_at from b where new_key is not null")
def _(t: Tables) -> DataFrame:
    return snapshots.refresh_registry(t("properties"), t("registry_old").withColumn("refreshed_at", F.lit("2024-01-01 00:00:00").cast("timestamp")), AS_OF)


_NEW = "select parcel_id, ln_num, case when cast(ln_num as int) % 3 = 0 then null else price end as price, 'new' as grantor from {sales_raw} where cast(page as bigint) % 5 = 0 union all select 'x' || parcel_id, ln_num, price, 'new' from {sales_raw} where cast(page as bigint) % 50 = 0"


@query("m2_upsert", ", n as (" + _NEW.format(sales_raw="sales_raw") + ") select coalesce(n.parcel_id, s.parcel_id) as parcel_id, coalesce(n.ln_num, s.ln_num) as ln_num, coalesce(n.price, s.price) as price, coalesce(n.grantor, s.grantor) as grantor from sales_raw s full join n on n.parcel_id = s.parcel_id and n.ln_num = s.ln_num")
def _(t: Tables) -> DataFrame:
    sales = t("sales_raw")
    return snapshots.upsert(sales.select("parcel_id", "ln_num", "price", "grantor"), t.sql(_NEW, sales_raw=sales), ["parcel_id", "ln_num"], keep_if_null=["price"])


_JSON = "select c_custkey as id, '{{\"a\":\"' || cast(c_nationkey as string) || '\",\"b\":\"1\"}}' as findings from {customer}"


@query("m3_upsert_json", """select c_custkey as id, case when c_custkey % 2 = 0 then '{"a":"new","b":"1","c":"x"}' else '{"a":"' || cast(c_nationkey as string) || '","b":"1"}' end as findings from customer""")
def _(t: Tables) -> DataFrame:
    old = t.sql(_JSON, customer=t("customer"))
    new = old.where("id % 2 = 0").select("id", F.lit('{"c":"x","a":"new"}').alias("findings"))
    return snapshots.upsert_json(old, new, ["id"], "findings")


@query("m4_incomplete_profiles", _TARGETS + ", l as (select parcel_id, 'parcel' as feed from targets anti join parcel_raw using (parcel_id) union all select parcel_id, 'owner' from targets anti join owner_raw using (parcel_id)) select parcel_id, string_agg(feed, ',' order by feed) as missing_feeds from l group by parcel_id")
def _(t: Tables) -> DataFrame:
    return snapshots.incomplete_profiles(targets(t), {"parcel": t("parcel_raw"), "owner": t("owner_raw")})


_OLD_OWNERS = "select parcel_id, ln_num, case when parcel_id like '%7' then 'Former' else name end as name, case when parcel_id like '%3' then '1' else pctown end as pctown from {owner_raw} where parcel_id not like '%9' and not (parcel_id like '%5' and ln_num = '01') union all select 'old' || parcel_id, ln_num, name, pctown from {owner_raw} where parcel_id like '%00'"


@query("c19_diff_snapshots", ", o as (" + _OLD_OWNERS.format(owner_raw="owner_raw") + """), b as (select coalesce(o.parcel_id, n.parcel_id) as parcel_id, o.parcel_id is not null as was, n.parcel_id is not null as is_new, case when o.parcel_id is not null and n.parcel_id is not null then (case when o.name is distinct from n.name then 1 else 0 end) + (case when o.pctown is distinct from n.pctown then 1 else 0 end) else 0 end as fields from o full join owner_raw n on o.parcel_id = n.parcel_id and o.ln_num = n.ln_num),
k as (select parcel_id, count(*) filter (not was) as added_rows, count(*) filter (not is_new) as removed_rows, count(*) filter (fields > 0) as changed_rows, cast(sum(fields) as bigint) as changed_fields, count(*) filter (was) as o, count(*) filter (is_new) as n from b group by parcel_id)
select parcel_id, case when o = 0 then 'added' when n = 0 then 'missing' when added_rows + removed_rows + changed_rows > 0 then 'changed' else 'unchanged' end as state, added_rows, removed_rows, changed_rows, changed_fields from k""")
def _(t: Tables) -> DataFrame:
    """Both versions are stored tables, as snapshots are."""
    new = t.stored("owner_raw", t("owner_raw"))
    old = t.stored("old-owners", t.sql(_OLD_OWNERS, owner_raw=new))
    return snapshots.diff_snapshots(old, new, "parcel_id", "ln_num", ["name", "pctown"])


@query("c20_owner_set_changes", ", o as (" + _OLD_OWNERS.format(owner_raw="owner_raw") + "), a as (select parcel_id, string_agg(distinct name, '|' order by name) as old_names from o group by parcel_id), b as (select parcel_id, string_agg(distinct name, '|' order by name) as new_names from owner_raw group by parcel_id) select parcel_id, old_names, new_names from a join b using (parcel_id) where old_names <> new_names")
def _(t: Tables) -> DataFrame:
    new = t("owner_raw")
    return snapshots.owner_set_changes(t.sql(_OLD_OWNERS, owner_raw=new), new)


@query("c21_review_class_counts", _FLAGS + "select reason, count(distinct parcel_id) as profiles from (select parcel_id, reason from flags where reason is not null union all select parcel_id, 'county_classification_mismatch' from flags where mismatch union all select parcel_id, 'any' from flags where reason is not null) group by reason")
def _(t: Tables) -> DataFrame:
    return snapshots.review_class_counts(t("parcel_raw"))


@query("x11_profile_documents", _TARGETS + _FLAGS + ", o as (select parcel_id, count(*) as owners, string_agg(name, '|' order by cast(ln_num as int)) as names from owner_raw group by parcel_id) select t.parcel_id, coalesce(o.owners, -1) as owners, coalesce(o.names, '') as names, case when p.parcel_id is null and o.parcel_id is null then 'parcel,owner' when p.parcel_id is null then 'parcel' when o.parcel_id is null then 'owner' else '' end as missing_feeds, p.parcel_id is null or o.parcel_id is null or f.reason is not null as review_required from targets t left join parcel_raw p on p.parcel_id = t.parcel_id left join o on o.parcel_id = t.parcel_id left join flags f on f.parcel_id = t.parcel_id")
def _(t: Tables) -> DataFrame:
    out = snapshots.profile_documents(targets(t), t("parcel_raw"), t("owner_raw"))
    return out.select("parcel_id", F.coalesce(F.when(F.col("owner_rows").isNotNull(), F.size("owner_rows")), F.lit(-1)).cast("long").alias("owners"), F.coalesce(F.array_join("owner_rows.name", "|"), F.lit("")).alias("names"), F.array_join("missing_feeds", ",").alias("missing_feeds"), "review_required")


_REVIEWS = """select c_custkey as id, case when c_custkey % 4 = 0 then 'approved' when c_custkey % 4 = 1 then 'qualification_hold' else 'review_required' end as status, cast(c_nationkey as int) as dd_score, 'complete' as comps_status, 'complete' as underwriting_status,
  case when c_custkey % 6 = 2 then null when c_custkey % 6 = 3 then '{{"a":1}}' else '{{"a":1,"underwriting":{{"eligible_for_automated_acquisition":' || case when c_custkey % 5 = 0 and c_custkey % 1000 < 97 then 'true' else 'false' end || ',"estimated_value":5}}}}' end as findings, c_mktsegment as segment from {customer}"""
_HIT = "status = 'review_required' and (id % 6 in (2, 3) or (id % 5 = 0 and id % 1000 < 97))"


@query("m5_quarantine_reviews", ", rv as (" + _REVIEWS.format(customer="customer").replace("{{", "{").replace("}}", "}") + f"), g as (select segment, count(*) filter ({_HIT}) > 100 as closed from rv group by segment) select rv.segment, id, status, case when not closed and {_HIT} then 0 else dd_score end as dd_score, case when not closed and {_HIT} then 'review_required' else 'complete' end as comps_status, case when not closed and {_HIT} then 'review_required' else 'complete' end as underwriting_status, case when not closed and {_HIT} then 'false' when id % 6 in (2, 3) then null when id % 5 = 0 and id % 1000 < 97 then 'true' else 'false' end as eligible, case when id % 6 <> 2 then '1' end as a, case when not (not closed and {_HIT}) and id % 6 not in (2, 3) then '5' end as estimated_value, closed from rv join g using (segment)")
def _(t: Tables) -> DataFrame:
    """A quarantine for each segment, with the cap as it is: it closes for one that has more affected reviews than a hundred, and leaves that one alone."""
    reviews, out = t.sql(_REVIEWS, customer=t("customer")), []
    for segment in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"):
        some = reviews.where(F.col("segment") == segment)
        try:
            out.append(snapshots.quarantine_reviews(some, AS_OF)[1].withColumn("closed", F.lit(False)))
        except gates.GateClosed:
            out.append(some.withColumn("closed", F.lit(True)))
    at = lambda path: F.get_json_object("findings", f"$.{path}")
    fields = {"eligible": at("underwriting.eligible_for_automated_acquisition"), "a": at("a"), "estimated_value": at("underwriting.estimated_value")}
    return reduce(DataFrame.unionAll, out).withColumns(fields).drop("findings")
