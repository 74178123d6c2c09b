"""Domain tables derived from the given tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents".split()
#: The window of sales, and now for evidence.
START, END, AS_OF = "1998-01-01", "2000-12-31", "2024-01-31 00:00:00"

BINDINGS: dict[str, str] = {}

#: lineitem -> 15-column feed; a line number is generated because (l_orderkey, l_linenumber) repeats.
BINDINGS["sales_raw"] = """
select lpad(cast(l_partkey + 1 as string), 18, '0') as parcel_id,
  case when l_orderkey % 97 = 0 then '' else lpad(cast(l_orderkey % 900 as string), 6, '0') end as sale_id,
  cast(row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey) as string) as ln_num,
  case when l_orderkey % 41 = 0 then '' else lpad(cast(month(l_shipdate) as string), 2, '0') || '/' || lpad(cast(day(l_shipdate) as string), 2, '0') || '/' || cast(year(l_shipdate) as string) end as saledt,
  case when l_orderkey % 53 = 0 then '' when l_orderkey % 47 = 0 then '100.00' else cast(cast(l_extendedprice as decimal(12,2)) as string) end as price,
  case when l_suppkey % 31 = 0 then 'A' || cast(l_suppkey as string) else lpad(cast(l_suppkey + 1 as string), 5, '0') end as book,
  cast(l_orderkey + 1 as string) as page,
  case when l_linestatus = 'O' then 'I' when l_linenumber = 7 then 'X' else 'V' end as saletype,
  'WD' as trns_cd, 'Warranty Deed' as trns_dscr,
  case when l_linenumber <= 4 then '01' when l_linenumber <= 6 then '02' else '05' end as instrtyp,
  case when l_orderkey % 29 = 0 or l_linenumber = 7 then 'Q-Multiple parcels' when l_linenumber <= 4 then 'Q-Per examination of deed' else 'Q-Credible, verified & documented' end as instrtyp_dscr,
  'Supplier ' || cast(l_suppkey as string) as grantor, 'Order ' || cast(l_orderkey as string) as grantee,
  case when l_returnflag = 'R' and l_orderkey % 7 = 0 then 'C' when l_returnflag = 'A' and l_orderkey % 11 = 0 then '' else 'N' end as foreclosure
from lineitem
"""

#: sales_raw with rule violations for S1 / G1 (apply to the rows of sales_raw).
BINDINGS["sales_dirty"] = """
select case when cast(page as bigint) % 1009 = 0 then 'BAD-' || parcel_id else parcel_id end as parcel_id, sale_id,
  case when cast(page as bigint) % 1013 = 0 then '-1' else ln_num end as ln_num,
  case when cast(page as bigint) % 1019 = 0 then '02/29/2023' else saledt end as saledt,
  case when cast(page as bigint) % 1021 = 0 then '1e6' when cast(page as bigint) % 1031 = 0 then '-5' else price end as price,
  book, page, saletype, trns_cd, trns_dscr, instrtyp, instrtyp_dscr, grantor, grantee, foreclosure
from sales_raw
"""

#: part -> current parcel dimension (some parcels missing on purpose).
BINDINGS["parcel_raw"] = """
select lpad(cast(p_partkey + 1 as string), 18, '0') as parcel_id,
  case when p_size in (1, 4) then '9910' when p_size = 2 then '9350' when p_size = 3 then '0989' when p_size = 6 then '' else '0100' end as dorus_code,
  case when p_type in ('STANDARD', 'SMALL', 'MEDIUM') then 'RES' else 'COM' end as dordesc,
  case when p_size = 1 then 'Inaccessible tracts' when p_size = 2 then 'Mineral Rights (Not Phos.)' when p_size = 3 then 'Split and/or Combine in Progress'
       when p_size = 5 then 'INACCESSIBLE TRACTS' when p_size % 2 = 0 then 'Vacant Residential' else 'Single Family' end as dordesc1,
  cast(cast(p_retailprice as decimal(12,2)) as string) as amtdue, cast(p_size as string) as tot_acreage
from part where p_partkey % 101 <> 0
"""

#: target universe (dashed keys, some blank).
BINDINGS["properties"] = """
select p_partkey as id,
  case when p_partkey % 211 = 0 then '' else substr(k, 1, 2) || '-' || substr(k, 3, 2) || '-' || substr(k, 5, 2) || '-' || substr(k, 7, 6) || '-' || substr(k, 13, 6) end as parcel_id,
  case when p_partkey % 3 = 0 then 'Lee' when p_partkey % 3 = 1 then 'Charlotte' else 'Polk' end as county,
  case when p_type in ('LARGE', 'ECONOMY') then 'land' else 'residential' end as property_type, p_brand as owner_name
from (select *, lpad(cast(p_partkey + 1 as string), 18, '0') as k from part) t where p_size <= 10
"""

#: an earlier registry with stale, missing and changed rows.
BINDINGS["registry_old"] = """
select p_partkey as property_id, lpad(cast(case when p_partkey % 17 = 0 then p_partkey + 2 else p_partkey + 1 end as string), 18, '0') as parcel_key
from part where p_size <= 11 and p_partkey % 13 <> 0
"""

#: distinct part/supplier pairs as owners (a fourth of the parcels has none).
BINDINGS["owner_raw"] = """
select lpad(cast(l_partkey + 1 as string), 18, '0') as parcel_id,
  lpad(cast(row_number() over (partition by l_partkey order by l_suppkey) as string), 2, '0') as ln_num,
  'Supplier ' || cast(l_suppkey as string) as name, case when l_suppkey % 2 = 0 then '50.00' else '.5' end as pctown
from (select distinct l_partkey, l_suppkey from lineitem where l_partkey % 4 <> 0) t
"""

#: parts and line numbers of lineitem as parcels and lines of tax districts.
BINDINGS["tax_raw"] = """
select lpad(cast(l_partkey + 1 as string), 18, '0') as parcel_id, cast(l_linenumber as string) as lnnum, 'DISTRICT ' || cast(l_linenumber as string) as taxdist,
  cast(cast(max(l_extendedprice) as decimal(12,2)) as string) as asdval, '0' as exmptval, cast(cast(max(l_extendedprice) as decimal(12,2)) as string) as taxval,
  '.22' as asdtaxes, '0' as exmpttaxes, case when l_linenumber % 2 = 0 then '.00' else cast(cast(max(l_quantity) as decimal(12,2)) as string) end as taxesdue
from lineitem group by l_partkey, l_linenumber
"""

#: events -> append-only evidence log.
BINDINGS["evidence"] = """
select event_id as id, lpad(cast(user_id + 1 as string), 18, '0') as parcel_id,
  case event_type when 'error' then 'FEMA_FLOOD' when 'click' then 'USFWS_WETLANDS' when 'purchase' then 'LEE_ROAD' when 'view' then 'LEE_PARCEL_GEOMETRY' else 'FRONTAGE_ACCESS' end as source,
  case when event_id % 19 = 0 then 'ERROR' when event_type = 'click' and event_id % 3 <> 0 then 'NOT_FOUND' else 'FOUND' end as result,
  case when event_id % 5 = 0 then 'AE' else 'X' end as fld_zone, case when event_id % 5 = 0 then 'T' else 'F' end as sfha_tf,
  case when event_id % 7 = 0 then 'OTHER' else 'AREA OF MINIMAL FLOOD HAZARD' end as zone_subty,
  cast(event_id % 4 as int) as paved_candidate_count, ts as checked_at
from events
"""

#: one row per customer.
BINDINGS["screening"] = """
select lpad(cast(c_custkey + 1 as string), 18, '0') as parcel_id, case when c_custkey % 2 = 0 then 'Lee' else 'LEE' end as county,
  case when c_custkey % 3 = 0 then 'Lehigh Acres' else 'Fort Myers' end as city, c_name as owner_name,
  cast(c_acctbal as decimal(12,2)) / 10000 as gis_acres, cast(c_nationkey % 2 as int) as building_count,
  case when c_custkey % 10 = 9 then 'REJECTED_FLOOD_ZONE' else 'PENDING_FLOOD_WETLAND_ROAD_DISTRESS' end as screening_status
from customer
"""

#: axis-aligned parcel rectangles in degrees; hazards from suppliers. Box overlap has a closed form for the oracle.
BINDINGS["boxes"] = """
select lpad(cast(p_partkey + 1 as string), 18, '0') as parcel_id, -82.0 + (p_partkey % 50) * 0.001 as x0, 26.5 + floor(p_partkey / 50) * 0.001 as y0,
  -82.0 + (p_partkey % 50) * 0.001 + 0.0008 as x1, 26.5 + floor(p_partkey / 50) * 0.001 + 0.0008 as y1
from part
"""

#: documents, whole -> physical lines of the legal dialect; every 9th is a continuation, every 50th unbalanced, every 40th has letters where digits belong.
BINDINGS["legal_lines"] = """
select doc_id as line_no, case when doc_id % 9 = 8 then 'CONT ' || translate(coalesce(text, ''), chr(10), ' ')
  else '"' || lpad(cast(doc_id + 1 as string), 18, '0') || '","' || cast(doc_id % 5 as string) || '","' || case when doc_id % 40 = 3 then 'S1' else '12' end || '","34","56","000001","000001","RUN 12" E, ' || translate(coalesce(text, ''), chr(10), ' ') || case when doc_id % 50 = 7 then '' else '"' end end as value
from documents
"""


def ctes() -> str:
    return ", ".join(f"{name} as ({sql})" for name, sql in BINDINGS.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a binding."""
    given = ", ".join(f"{t} as (select * from parquet.`{sf_dir}/{t}.parquet`)" for t in TABLES)
    return spark.sql(f"with {given}, {ctes()} select * from {name}")
