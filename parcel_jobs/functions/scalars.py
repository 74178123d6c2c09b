"""Scalar contracts as column expressions. Unknown stays null, and nothing here raises on bad input."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column names of the sales feed, in order.
SALES = "parcel_id sale_id ln_num saledt price book page saletype trns_cd trns_dscr instrtyp instrtyp_dscr grantor grantee foreclosure".split()
#: Land-use classes that need review, with their county descriptions.
REVIEW_CLASSES = (
    ("9910", "Inaccessible tracts", "county_inaccessible_tract"),
    ("9350", "Mineral Rights (Not Phos.)", "county_mineral_rights"),
    ("0989", "Split and/or Combine in Progress", "county_split_combine"),
)
#: County, coded road attribute, its value, and the surface it stands for.
ROAD_CODES = (
    ("lee", "SURFACE", "PAVED", "PAVED"), ("lee", "SURFACE", "DIRT", "UNPAVED"), ("lee", "SURFACE", "GRAVEL", "UNPAVED"),
    ("charlotte", "PAVED", "YES", "PAVED"), ("charlotte", "PAVED", "NO", "UNPAVED"),
    ("polk", "SURFTYPE", "PAV", "PAVED"), ("polk", "SURFTYPE", "UNPAV", "UNPAVED"),
    ("highlands", "MAINT_CAT", "1", "PAVED"), ("highlands", "MAINT_CAT", "41", "PAVED"), ("highlands", "MAINT_CAT", "2", "UNPAVED"), ("highlands", "MAINT_CAT", "42", "UNPAVED"),
    ("marion", "Paved", "1", "PAVED"),
    ("sarasota", "SurfaceType", "ASPHALTIC CONCRETE", "PAVED"), ("sarasota", "SurfaceType", "DIRT", "UNPAVED"),
)
#: Counties whose sources are configured, the field that identifies a parcel in each, and the fields of parcels and roads.
COUNTIES = (
    ("lee", "STRAP", "OBJECTID,STRAP,FOLIOID,LEGAL,FRONTAGE", "OBJECTID,STREET,SURFACE,MAINTAINBY,ROW_WIDTH"),
    ("charlotte", "ACCOUNT", "OBJECTID,ACCOUNT,shortlegal,roads,zoningcode,landuse", "OBJECTID,STREET,PAVED,MAINT_BY,MB_DESCRIPTION"),
    ("marion", "PARCEL", "OBJECTID,PARCEL,ALT_Key", "OBJECTID,Street,Paved,SurfaceType,Jurisdiction"),
    ("highlands", "STRAP", "OBJECTID,STRAP,PARCELNO", "OBJECTID_1,FULLNAME,MAINT_CAT,MAINT_DESC"),
    ("polk", "PARCELID", "OBJECTID,PARCELID,PR_STRAP", "OBJECTID,SURFTYPE,UNITDESC,OWN,SERVSTAT"),
    ("osceola", "PARCELID", "OBJECTID,PARCELID,strap,dsp_strap", "OBJECTID,STREET"),
    ("sarasota", "ID", "OBJECTID,ID,ACCOUNT", "OBJECTID,STREET_NAME,Maintenance,SurfaceType,PavementClass"),
)


def strip(c: Column) -> Column:
    """Without ASCII white space of any kind at either end."""
    return F.trim(c, F.lit(" \t\n\x0b\f\r"))


def int32_text(c: Column) -> Column:
    """ASCII digits that fit a nonnegative 32-bit integer."""
    return F.coalesce(c.rlike(r"^[0-9]+\z") & (F.length(F.ltrim(c, F.lit("0"))) <= 10) & (c.try_cast("decimal(38,0)") <= 2147483647), F.lit(False))


def parcel_key(c: Column) -> Column:
    """18 digits left of an id after upper-casing and dropping all but letters and digits, else null."""
    k = F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    return F.when(k.rlike(r"^[0-9]{18}\z"), k)


def format_parcel(c: Column) -> Column:
    """18 digits as dd-dd-dd-dddddd-dddddd, else null."""
    k = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(k) == 18, F.regexp_replace(k, r"^(..)(..)(..)(.{6})(.{6})$", "$1-$2-$3-$4-$5"))


def reference_alias(c: Column) -> Column:
    """A positive ASCII integer without spaces and leading zeros, else ''."""
    s = strip(F.coalesce(c, F.lit("")))
    return F.when(s.rlike(r"^[0-9]+\z"), F.ltrim(s, F.lit("0"))).otherwise("")


def sale_date(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"), F.try_to_date(c, "MM/dd/yyyy"))


def normalize_sales(df: DataFrame) -> DataFrame:
    """All rows, trimmed, LN_NUM canonical, with error: the first rule that a row breaks, or null."""
    for name in ("parcel_id", "ln_num", "saledt", "price"):
        df = df.withColumn(name, strip(F.coalesce(name, F.lit(""))))
    price_ok = F.col("price").rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\z")
    nul = F.lit(False)
    for name in SALES:
        nul = nul | F.contains(F.coalesce(name, F.lit("")), F.lit("\0"))
    error = (
        F.when(nul, "nul_byte").when(~F.col("parcel_id").rlike(r"^[0-9]{18}\z"), "parcel_id").when(~int32_text(F.col("ln_num")), "ln_num")
        .when((F.col("saledt") != "") & sale_date(F.col("saledt")).isNull(), "saledt").when((F.col("price") != "") & ~price_ok, "price")
        .when((F.col("price") != "") & (F.col("price").try_cast("decimal(38,10)") < 0), "negative_price")
    )
    df = df.withColumn("error", error)
    return df.withColumn("ln_num", F.when(int32_text(F.col("ln_num")), F.col("ln_num").try_cast("int").cast("string")).otherwise(F.col("ln_num")))


def type_sales(df: DataFrame) -> DataFrame:
    """Blank text as null; line, date and price as types."""
    text = [F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns if c not in ("ln_num", "saledt", "price")]
    return df.select(*text, F.col("ln_num").try_cast("int").alias("ln_num"), sale_date(F.col("saledt")).alias("saledt"), F.nullif(F.col("price"), F.lit("")).try_cast("decimal(38,10)").alias("price"))


def validate_tax(df: DataFrame) -> DataFrame:
    """All rows of the parcel-tax feed with their key and error."""
    amounts = ("asdval", "exmptval", "taxval", "asdtaxes", "exmpttaxes", "taxesdue")
    bad = F.lit(False)
    for a in amounts:
        bad = bad | ~F.coalesce(F.col(a).rlike(r"^([0-9]+(\.[0-9]{1,2})?|\.[0-9]{1,2})\z"), F.lit(False))
    key = parcel_key(F.col("parcel_id"))
    error = F.when(key.isNull(), "parcel_id").when(~int32_text(F.col("lnnum")), "lnnum").when(F.coalesce(strip(F.col("taxdist")), F.lit("")) == "", "taxdist").when(bad, "amount")
    return df.withColumns({"parcel_key": key, "error": error})


def validate_property(df: DataFrame, feed: str) -> DataFrame:
    """All rows of the parcel, owner or legal feed with line (0 for parcel) and error."""
    line = {"parcel": None, "owner": "ln_num", "legal": "num"}[feed]
    error = F.when(~F.coalesce(F.col("parcel_id").rlike(r"^[0-9]{18}\z"), F.lit(False)), "parcel_id")
    if line:
        error = error.when(~int32_text(F.col(line)), "line")
    if feed == "owner":
        share = F.coalesce("pctown", F.lit(""))
        fits = share.rlike(r"^([0-9]+(\.[0-9]*)?|\.[0-9]+)\z") & (share.try_cast("decimal(38,10)") <= 100)
        error = error.when((share != "") & ~F.coalesce(fits, F.lit(False)), "pctown")
    return df.withColumns({"line": F.when(int32_text(F.col(line)), F.col(line).try_cast("int")) if line else F.lit(0), "error": error})


def amount(c: Column) -> Column:
    """A number, null where there is none: unknown is not zero."""
    return F.nullif(strip(c), F.lit("")).try_cast("decimal(38,10)")


def money(c: Column) -> Column:
    """The first figure in a text, commas dropped, with one or two digits of cents."""
    return F.nullif(F.replace(F.regexp_extract(c, r"\$?\s*([0-9][0-9,]*(\.[0-9]{1,2})?)", 1), F.lit(","), F.lit("")), F.lit("")).try_cast("decimal(38,10)")


def to_num(c: Column) -> Column:
    """A number after dropping commas and $; blank or bad is 0."""
    return F.coalesce(F.nullif(strip(F.translate(c, ",$", "")), F.lit("")).try_cast("double"), F.lit(0.0))


def sha_shard_bits(c: Column) -> Column:
    """The first 64 bits of SHA-256, unsigned."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def sha_shard(c: Column, n: int) -> Column:
    """The first 64 bits of SHA-256, unsigned, mod n."""
    return F.pmod(sha_shard_bits(c), F.lit(n)).cast("int")


def md5_shard(c: Column, n: int) -> Column:
    """All 128 bits of MD5 mod n, from its two halves."""
    half = lambda at: F.conv(F.substring(F.md5(c), at, 16), 16, 10).cast("decimal(20,0)") % n
    return ((half(1) * (2**64 % n) + half(17)) % n).cast("int")


def parse_year(c: Column) -> Column:
    """The year of one of four date formats, else the first number of four digits from 1900 to 2100."""
    # A date that fails is dear: plain digits are cast, and a format is tried where its separator stands.
    at = lambda i, n: F.substring(c, i, n)
    forms = (("MM/dd/yyyy", 3, "/", 7, 1, 4), ("yyyy-MM-dd", -3, "-", 1, 6, 9), ("MM-dd-yyyy", 3, "-", 7, 1, 4), ("yyyy/MM/dd", -3, "/", 1, 6, 9))
    dates = []
    for form, place, sep, y, m, d in forms:
        plain = c.rlike(f"^{re.sub('[Mdy]', '[0-9]', form)}\\z")
        fast = F.concat(at(y, 4), F.lit("-"), at(m, 2), F.lit("-"), at(d, 2)).try_cast("date")
        dates.append(F.when(at(place, 1) == sep, F.year(F.when(plain, fast).otherwise(F.try_to_date(c, form)))))
    token = F.regexp_extract(F.translate(c, "-", "/"), r"(?:^|/)(19[0-9]{2}|20[0-9]{2}|2100)(?=/|\z)", 1)
    return F.coalesce(*dates, F.nullif(token, F.lit("")).try_cast("int"))


def window_class(date: Column, start: str, as_of: str) -> Column:
    """undated, after_as_of, before_window or in_window; both ends are inside."""
    lo, hi = F.lit(start).cast("date"), F.lit(as_of).cast("date")
    return F.when(date.isNull(), "undated").when(date > hi, "after_as_of").when(date < lo, "before_window").otherwise("in_window")


def road_surface_class(county: Column, field: Column, value: Column) -> Column:
    """PAVED, UNPAVED or, for anything unknown, REVIEW."""
    out = F.when(F.lit(False), "REVIEW")
    for c, f, v, kind in ROAD_CODES:
        out = out.when((F.lower(F.trim(county)) == c) & (field == f) & (F.upper(F.trim(value)) == v), kind)
    return out.otherwise("REVIEW")


def county_config(spark: SparkSession) -> DataFrame:
    """Configured counties: county, identity_field, parcel_fields, road_fields, road_field (null where roads have no coded surface). Endpoints belong to the transfer, which isn't built."""
    fields = {c: f for c, f, _, _ in ROAD_CODES}
    rows = ", ".join(f"('{c}', '{i}', '{p}', '{r}', {repr(fields[c]) if c in fields else 'null'})" for c, i, p, r in COUNTIES)
    return spark.sql(f"select county, identity_field, split(parcel_fields, ',') as parcel_fields, split(road_fields, ',') as road_fields, cast(road_field as string) as road_field from values {rows} as t(county, identity_field, parcel_fields, road_fields, road_field)")


def source_review_flags(code: Column, description: Column) -> Column:
    """Reasons, in order: the class by code or by description, then a mismatch if the two disagree."""
    code, text = strip(F.coalesce(code, F.lit(""))), F.lower(strip(F.coalesce(description, F.lit(""))))
    by_code, by_text, agrees = F.when(F.lit(False), ""), F.when(F.lit(False), ""), F.lit(False)
    for c, d, reason in REVIEW_CLASSES:
        by_code, by_text = by_code.when(code == c, reason), by_text.when(text == d.lower(), reason)
        agrees = agrees | ((code == c) & (text == d.lower()))
    reason = F.coalesce(by_code, by_text)
    return F.array_compact(F.array(reason, F.when(reason.isNotNull() & ~agrees, "county_classification_mismatch")))


def residential_split(df: DataFrame) -> DataFrame:
    """Residential parcels, with vacant."""
    return df.where(F.col("dordesc") == "RES").withColumn("vacant", F.startswith(F.lower("dordesc1"), F.lit("vac")))


def owner_match(a: Column, b: Column) -> Column:
    """Equal after upper-casing and dropping all but letters and digits, and not blank."""
    plain = lambda c: F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")
    return (plain(a) == plain(b)) & (plain(a) != "")


def access_review_valid() -> Column:
    """A VERIFIED access review must hold all its evidence; a null never passes."""
    confirmed: Sequence[str] = ("frontage_confirmed", "access_confirmed", "instrument_confirmed", "plat_confirmed")
    held = F.coalesce(F.col("source_url").rlike(r"^https://"), F.lit(False)) & F.coalesce(F.col("record_sha256").rlike(r"^[a-f0-9]{64}\z"), F.lit(False))
    held = held & F.coalesce(F.trim("instrument") != "", F.lit(False)) & F.coalesce(F.col("frontage_ft") > 0, F.lit(False)) & F.coalesce(F.col("reviewer") != "", F.lit(False))
    for c in confirmed:
        held = held & F.coalesce(F.col(c), F.lit(False))
    return F.when(F.col("status") == "VERIFIED", held & F.coalesce(F.col("expires_at") > F.col("reviewed_at"), F.lit(False))).otherwise(True)


def json_text(c: Column, ascii_only: bool = False) -> Column:
    """A JSON string: quotes, backslashes and control characters are escaped; with ascii_only all beyond ASCII too, as UTF-16 units."""
    short = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    rest = {chr(i): f"\\u{i:04x}" for i in range(0x20) if chr(i) not in short}
    plain = c
    for raw, shown in (short | rest).items():
        plain = F.replace(plain, F.lit(raw), F.lit(shown))
    out = F.when(c.rlike("[\\x00-\\x1f\"\\\\]"), plain).otherwise(c)
    if ascii_only:
        units = lambda x: F.regexp_replace(F.lower(F.hex(F.encode(x, "UTF-16BE"))), "(.{4})", r"\\u$1")
        far, near = "[^\\x00-\\x7e]", "[\\x00-\\x7e]"  # 0x7f is escaped as well
        parts = F.transform(F.split(out, f"(?<={near})(?={far})|(?<={far})(?={near})"), lambda x: F.when(x.rlike(far), units(x)).otherwise(x))
        out = F.when(out.rlike(far), F.array_join(parts, "")).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))
