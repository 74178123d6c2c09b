"""Clerk records, auctions, tax certificates, provider replies: text and JSON to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import format_parcel, json_text, money, strip
from .gates import require_no_errors

LEGAL = "parcel_id num section township range sub parcel dscr".split()
_LEGAL_ROW = "(?s)^" + ",".join([r'"([0-9]+)"'] * 7) + r',"(.*)"\z'
_LEGAL_START = r'^"[0-9]{18}","'
#: Labels of auction pages, and words that a reviewer looks for.
LABELS = ("Case Number", "Case Type", "Final Judgment Amount", "Parcel ID", "Certificate Number", "Property Address", "Assessed Value", "Legal Description", "Auction Starts", "Name On Title")
#: Fixed value: how a document that names its parcel is matched.
DIRECT = "direct_parcel_id"
#: County codes of provider replies.
FIPS = {"lee": "12071", "charlotte": "12015", "osceola": "12097"}
KEYWORDS = ("frontage", "right.of.way", "easement", "dedicat", "access", "restrict", "vacat", "plat", "book", "page")


def parse_legal_strict(lines: DataFrame) -> DataFrame:
    """One record for each physical line: seven fields of digits, then free text in quotes; the raw line, and error: nul_byte, or unbalanced_or_unknown."""
    nul = F.contains("value", F.lit("\0"))
    good = F.coalesce(F.col("value").rlike(_LEGAL_ROW) & ~nul, F.lit(False))
    error = F.when(nul, "nul_byte").when(~good, "unbalanced_or_unknown")
    return lines.select("*", *[F.when(good, F.regexp_extract("value", _LEGAL_ROW, i + 1)).alias(c) for i, c in enumerate(LEGAL)], F.col("value").alias("raw_record"), error.alias("error"))


def reassemble_legal(lines: DataFrame, file: str = "file", line_no: str = "line_no") -> DataFrame:
    """Records of the lenient dialect: a line that begins none goes on with the description before it.

    Lines before any record are quarantined: each is a row of record 0, so a file without a record is no one value. Two
    levels, so that a file need not fit one task: starts are counted by blocks of lines, blocks are summed up in order
    (one row for each), and lines are then numbered within their block. first_line is a record's first line.
    """
    block = F.floor(F.col(line_no) / 100_000).cast("long")
    rows = lines.withColumns({"block": block, "starts": F.coalesce(F.col("value").rlike(_LEGAL_START), F.lit(False)).cast("long")})
    before = Window.partitionBy(file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(file, "block").agg(F.sum("starts").alias("n")).select(file, "block", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    inside = Window.partitionBy(file, "block").orderBy(line_no)
    numbered = rows.join(blocks, [file, "block"]).withColumn("record", F.col("base") + F.sum("starts").over(inside))
    parts = F.array_sort(F.collect_list(F.struct(F.col(line_no).alias("line_no"), "value")))
    alone = F.when(F.col("record") == 0, F.col(line_no))
    out = numbered.groupBy(file, "record", alone.alias("alone")).agg(F.count("*").alias("n_lines"), F.min(line_no).alias("first_line"), F.array_join(F.transform(parts, lambda p: p["value"]), " ").alias("value"))
    return out.drop("alone")


def read_fixed_width(lines: DataFrame, spec: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Columns by (name, start, end) from 0, the end outside, trimmed."""
    return lines.select("*", *[strip(F.substring("value", a + 1, b - a)).alias(name) for name, a, b in spec])


def pad_to_width(lines: DataFrame, separator: str, width: int) -> DataFrame:
    """Rows that aren't blank, padded with '' or cut to the width."""
    fields = F.split("value", separator, -1)
    padded = F.slice(F.concat(fields, F.array_repeat(F.lit(""), width)), 1, width)
    return lines.where(strip(F.col("value")) != "").withColumn("fields", padded)


def clean(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def parse_party_rows(pages: DataFrame) -> DataFrame:
    """Rows of a clerk's result page (page_id, body): name, from_party, date, type, book, page, legal, file_no, status, flag, parcel_id.

    The text is cut at the header and the footer and then split at the View mark of each row, so that no pattern has to
    search the whole page for the end of a row.
    """
    text = clean(F.col("body"))
    text = F.when(F.contains(text, F.lit("Flag View ")), F.substring_index(text, "Flag View ", -1)).otherwise(text)
    text = F.regexp_replace(text, r"(?i)\s+Retrieved records\b.*$", "")
    row = r"(?i)^(.+?) (\d{2}/\d{2}/\d{4}) (LP|L PEN) (\d+) (\d+) (.+?) (\d{10}) ([A-Z])(?: ([A-Z]))?$"
    rows = pages.select("page_id", F.posexplode(F.split(F.concat(text, F.lit(" ")), " View ")).alias("ordinal", "x")).where(F.col("x").rlike(row))
    part = lambda i: F.regexp_extract("x", row, i)
    return rows.select(
        "page_id", "ordinal", strip(F.ltrim(part(1), F.lit("*"))).alias("name"), F.startswith(part(1), F.lit("*")).alias("from_party"), part(2).alias("date"), F.upper(part(3)).alias("type"), part(4).alias("book"), part(5).alias("page"),
        part(6).alias("legal"), part(7).alias("file_no"), F.upper(part(8)).alias("status"), F.upper(part(9)).alias("flag"), F.when(part(6).rlike(r"^\d{2}-\d{2}-\d{2}-\d{6}-\d{6}\z"), part(6)).alias("parcel_id"),
    )


def parse_auction_details(pages: DataFrame) -> DataFrame:
    """Fields of auction pages (auction_id, body): the text after each label and its colon up to the next one.

    The page is cut once, before each label that has a colon, and a field is the first piece of its label. A case
    number or parcel whose label has no colon is still found by its form.
    """
    text = clean(F.col("body"))
    cut = F.regexp_replace(text, r"(?i)(?:^|\s)(" + "|".join(LABELS) + r")\s*:", "\x1e$1\x1f")
    rows = pages.select("auction_id", text.alias("text"), F.slice(F.split(cut, "\x1e"), 2, 1_000_000).alias("pieces"))

    def value(label: str) -> Column:
        own = F.get(F.filter("pieces", lambda p: F.lower(F.substring_index(p, "\x1f", 1)) == label.lower()), F.lit(0))
        return F.nullif(strip(F.substring_index(own, "\x1f", -1)), F.lit(""))

    by_form = lambda label, form: F.nullif(F.regexp_extract("text", rf"(?i){label}\s*:?\s*({form})", 1), F.lit(""))
    starts, parcel = value("Auction Starts"), F.coalesce(value("Parcel ID"), by_form("Parcel ID", "[0-9]{18}"))
    clock = F.regexp_extract(starts, r"(?i)\b([01]?[0-9]:[0-5][0-9] ?[AP]M( ?ET)?)", 1)
    return rows.select(
        "auction_id", F.coalesce(value("Case Number"), by_form("Case Number", "[A-Za-z0-9-]+")).alias("case_number"), value("Case Type").alias("case_type"), parcel.alias("parcel_id_raw"), format_parcel(parcel).alias("parcel_id"),
        F.try_to_date(F.regexp_extract(starts, "[0-9]{2}/[0-9]{2}/[0-9]{4}", 0), "MM/dd/yyyy").alias("auction_date"), F.nullif(clock, F.lit("")).alias("auction_time"),
        money(value("Final Judgment Amount")).alias("final_judgment"), money(value("Assessed Value")).alias("assessed_value"), value("Property Address").alias("property_address"),
        value("Certificate Number").alias("certificate_number"), value("Legal Description").alias("legal_description"), value("Name On Title").alias("name_on_title"),
    )


#: Line ends within a page.
_LINES = "\r\n|[\n\r\x0b\x1c-\x1e\x85\u2028\u2029]"


def review_excerpts(docs: DataFrame, most: int = 500, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    """Lines of recorded documents (doc_id, text; form feeds between pages) that hold a keyword: page, place and 500 characters, the first `most` of a document."""
    pages = docs.select("doc_id", F.posexplode(F.split("text", "\f")).alias("page", "body"))
    lines = pages.select("doc_id", F.col("page") + 1, F.posexplode(F.split("body", _LINES)).alias("line", "x")).toDF("doc_id", "page", "line", "x")
    hits = lines.where(F.col("x").rlike("(?i)" + "|".join(keywords)))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "line"))
    return hits.withColumn("n", rank).where(F.col("n") <= most).select("doc_id", "page", "line", F.substring(strip(F.col("x")), 1, 500).alias("excerpt"))


def review_documents(docs: DataFrame) -> DataFrame:
    """What is said of recorded documents (doc_id, text, parcel, reference) besides excerpts: whether there is text, and whether it holds the parcel and the reference, whatever their case.

    Always up for review: no excerpt certifies frontage, access or restrictions. A null parcel or reference is never found.
    """
    text = F.coalesce("text", F.lit(""))
    within = lambda c: F.coalesce(F.contains(F.lower(text), F.lower(c)), F.lit(False))
    return docs.select(
        "doc_id", F.lit("REVIEW_REQUIRED").alias("status"), F.when(strip(text) != "", "TEXT_EXTRACTED").otherwise("NO_TEXT").alias("extraction_status"), within("parcel").alias("parcel_id_found_in_text"), within("reference").alias("reference_found_in_text"),
        *[F.lit(False).alias(c) for c in ("exact_frontage_verified", "legal_access_verified", "current_restrictions_checked")],
    )


#: Where reports of tax certificates come from.
REPORT_HOST, REPORT_PATH = "county-taxes.net", "/fl-lee/"


def check_tax_report(reports: DataFrame) -> DataFrame:
    """Reports (source_url, checked_at as text, complete, reported_total, rows: array of arrays of text) with error: what forbids to use their rows.

    source: not https from the official host without credentials, or another county's path; checked_at: no time with its zone; incomplete: not
    marked complete, or another number of rows than reported; layout: a row without 20 fields; value: a year or balance that can't be read.
    """
    url, rows = F.col("source_url"), F.coalesce("rows", F.array().cast("array<array<string>>"))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    zoned = F.col("checked_at").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:.]+(Z|[+-][0-9]{2}:?[0-9]{2})\z") & F.col("checked_at").try_cast("timestamp").isNotNull()
    sound = lambda r: r[0].try_cast("int").isNotNull() & F.replace(r[19], F.lit(","), F.lit("")).try_cast("decimal(38,10)").isNotNull()
    error = (
        F.when(no(url.rlike(rf"^https://{REPORT_HOST.replace('.', '[.]')}(:[0-9]+)?{REPORT_PATH}")), "source").when(no(zoned), "checked_at")
        .when(no(F.col("complete") & (F.size(rows) == F.col("reported_total"))), "incomplete").when(no(F.forall(rows, lambda r: F.size(r) == 20)), "layout").when(no(F.forall(rows, sound)), "value")
    )
    return reports.withColumn("error", error)


def tax_report_rows(reports: DataFrame) -> DataFrame:
    """c of each row of the reports, for tax_certificate_candidates; GateClosed if one of them has an error."""
    checked = check_tax_report(reports)
    require_no_errors(checked)
    return checked.select("source_url", "checked_at", F.explode("rows").alias("c"))


def tax_certificate_candidates(rows: DataFrame, today: str) -> DataFrame:
    """Report rows (c: array of 20 strings) with parcel, reason (null: a candidate), delinquent_since, amount_due and record_sha256, of the row as ASCII JSON.

    The first rule that holds names the reason, but a repeated certificate overrides them all. A row whose year or
    balance can't be read has reason INVALID_REPORT: its report must not be used.
    """
    c = lambda i: F.get("c", F.lit(i))
    year, due = c(0).try_cast("int"), F.replace(c(19), F.lit(","), F.lit("")).try_cast("decimal(38,10)")
    rows = rows.withColumns({"parcel": F.regexp_replace(F.upper(c(1)), "[^A-Z0-9]", ""), "since": F.make_date(year + 1, F.lit(4), F.lit(1)), "due": due})
    rows = rows.withColumns({"id_year": c(0), "id_number": c(4)})
    copied = rows.groupBy("parcel", "id_year", "id_number").agg(F.count("*").alias("copies")).where("copies > 1")  # in partial sums: no identity is hot
    rows = _marked(rows, copied, ["parcel", "id_year", "id_number"], "copied")
    reason = (
        F.when(year.isNull() | due.isNull() | (F.size("c") != 20), "INVALID_REPORT").when(F.col("copied"), "DUPLICATE_CERTIFICATE_REVIEW").when(~F.col("parcel").rlike(r"^\d{6}[A-Z0-9]{11}\z"), "INVALID_PARCEL")
        .when(c(3) != "Issued", "CERTIFICATE_NOT_ISSUED").when(c(2) != "-- None --", "DEED_STATUS_REVIEW").when((c(16) != "Unpaid") | (F.col("due") <= 0), "NO_UNPAID_BALANCE")
        .when(F.col("since") >= F.add_months(F.lit(today).cast("date"), -12), "DELINQUENCY_NOT_OVER_12_MONTHS").when(~c(4).rlike(r"^0*[1-9][0-9]*\z"), "MISSING_CERTIFICATE")
    )
    text = F.concat(F.lit("["), F.array_join(F.transform("c", lambda x: F.coalesce(json_text(x, ascii_only=True), F.lit("null"))), ","), F.lit("]"))
    return rows.select(F.col("parcel").alias("parcel_id"), c(4).alias("certificate"), reason.alias("reason"), F.col("since").alias("delinquent_since"), F.col("due").alias("amount_due"), F.sha2(text, 256).alias("record_sha256"))


def normalize_provider(replies: DataFrame) -> DataFrame:
    """Outcome of provider replies (parcel_id, county, reply JSON): all properties must be of the parcel and county asked for.

    REVIEW_REQUIRED where a property has a foreclosure record, an object with a document number, a date or a type;
    NO_ADVERSE_RECORD_RETURNED where none has; NO_PROPERTY_MATCH where there is no property, and the status says so by message and code;
    error for all else, so a reply cut short is never clear. A field that is a number counts as given, even zero. None of them is a
    certificate of absence: qualifying_distress and release_search_complete are always false.
    """
    shape = "struct<status:struct<code:int,msg:string>,property:array<struct<identifier:struct<apn:string,fips:string>,foreclosure:string>>>"
    plain = lambda c: F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")
    fips = F.lit(None).cast("string")
    for name, code in FIPS.items():
        fips = F.when(F.lower("county") == name, code).otherwise(fips)

    def record(found: Column) -> Column:
        field = lambda name: ~F.coalesce(F.get_json_object(found, f"$.{name}"), F.lit("")).isin("", "false", "[]", "{}")
        return F.coalesce(F.startswith(F.ltrim(found), F.lit("{")), F.lit(False)) & (field("documentNumber") | field("recordingDate") | field("distressType"))

    r = F.from_json("reply", shape)
    found = F.coalesce(r["property"], F.array().cast("array<struct<identifier:struct<apn:string,fips:string>,foreclosure:string>>"))
    right = F.forall(found, lambda p: F.coalesce((plain(p["identifier"]["apn"]) == plain(F.col("parcel_id"))) & (p["identifier"]["fips"] == fips), F.lit(False)))
    records = F.transform(F.filter(found, lambda p: record(p["foreclosure"])), lambda p: p["foreclosure"])
    none = F.coalesce((r["status"]["msg"] == "SuccessWithoutResult") & r["status"]["code"].isin(400, 1), F.lit(False))
    state = (
        F.when(F.size(found) == 0, F.when(none, "NO_PROPERTY_MATCH").otherwise("error")).when(~right, "error")
        .when(F.size(records) > 0, "REVIEW_REQUIRED").otherwise("NO_ADVERSE_RECORD_RETURNED")
    )
    kept = F.when(state == "REVIEW_REQUIRED", records).otherwise(F.array().cast("array<string>"))
    return replies.select("parcel_id", "county", state.alias("verification_status"), kept.alias("foreclosure_records"), F.lit(False).alias("qualifying_distress"), F.lit(False).alias("release_search_complete"))


def _marked(rows: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """rows with name: whether their key, nulls being equal, is among keys."""
    right = keys.select(*[F.col(k).alias(f"_{k}") for k in on], F.lit(True).alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in on]
    return rows.join(right, same, "left").drop(*[f"_{k}" for k in on]).withColumn(name, F.coalesce(name, F.lit(False)))


def document_rollup(parties: DataFrame, order: Sequence[str] = ("page_id", "ordinal")) -> DataFrame:
    """One row for each file_no: the first row's fields, parcel and legal text from the first row that has them, and the parties. Rows are in order of page, then place in it."""
    at = F.struct(*order)
    first = lambda c: F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", at))
    return parties.groupBy("file_no").agg(F.min_by("name", at).alias("first_name"), F.min_by("date", at).alias("date"), first("parcel_id").alias("parcel_id"), first("legal").alias("legal"), F.count("*").alias("parties"))


def duplicate_certificates(rows: DataFrame, identity: Sequence[str]) -> DataFrame:
    """All rows, with quarantined: whether their identity occurs again anywhere. Counts are partial sums and the few repeated ones are joined back, so no identity is hot."""
    repeated = rows.groupBy(*identity).agg(F.count("*").alias("copies")).where("copies > 1")
    return _marked(rows, repeated, identity, "quarantined")


def party_dedupe(parties: DataFrame, order: Sequence[str] = ("page_id", "ordinal")) -> DataFrame:
    """The last row seen of each name and file_no, in order of page, then place in it."""
    last = parties.groupBy("name", "file_no").agg(F.max_by(F.struct(*parties.columns), F.struct(*order)).alias("row"))
    return last.select("row.*")


def match_by_parcel(events: DataFrame, properties: DataFrame) -> DataFrame:
    """Events (parcel_id, property_id, match_method, match_confidence, ...) whose exact parcel match changes what they hold, with what they hold then."""
    new = {"property_id": F.col("match_id"), "match_method": F.lit(DIRECT), "match_confidence": F.lit(1.0)}
    known = properties.select(F.col("id").alias("match_id"), "parcel_id")
    same = F.lit(True)
    for c, value in new.items():
        same &= F.col(c).eqNullSafe(value)
    return events.join(known, "parcel_id").where(~same).select(*[new[c].alias(c) if c in new else F.col(c) for c in events.columns])


def run_audit(parties: DataFrame, documents: DataFrame, errors: int = 0) -> DataFrame:
    """Totals of a records run and its state."""
    a = parties.agg(F.count("*").alias("parties"))
    b = documents.agg(F.count("*").alias("documents"), F.count_if(F.col("property_id").isNotNull()).alias("exact_matches"))
    return a.crossJoin(b).withColumn("state", F.lit("partial" if errors else "success"))  # one row each


def auction_calendar(auctions: DataFrame) -> DataFrame:
    """Distinct cases by day, and the day's month."""
    return auctions.where("auction_date is not null").groupBy("auction_date").agg(F.count_distinct("case_number").alias("cases")).withColumn("month", F.trunc("auction_date", "month"))


def upsert_signals(signals: DataFrame, documents: DataFrame, as_of: str, source_name: str = "official_records") -> DataFrame:
    """The next signals: one lis pendens, observed, for each document that was matched by its own parcel with full confidence. A signal of the same type, source and record keeps its source_url and takes all else.

    documents: file_no, parcel_id, property_id, match_method, match_confidence, source_url, recording_date, raw_data (JSON).
    """
    now = F.lit(as_of).cast("timestamp")
    sound = documents.where(F.col("property_id").isNotNull() & (F.col("match_method") == DIRECT) & (F.col("match_confidence") == 1.0)).dropDuplicates(["file_no"])
    raw = F.to_json(F.struct(F.col("raw_data").alias("document"), F.col("match_method").alias("resolution_method")))
    new = {
        "property_id": F.col("property_id"), "parcel_id": F.col("parcel_id"), "signal_type": F.lit("lis_pendens"), "signal_status": F.lit("observed"), "source_name": F.lit(source_name), "source_url": F.col("source_url"),
        "source_record_id": F.col("file_no"), "event_date": F.col("recording_date"), "confidence": F.lit(1.0), "raw_data": raw, "verified_at": now, "last_seen_at": now,
    }
    key = ["signal_type", "source_name", "source_record_id"]
    both = signals.withColumn("was", F.lit(True)).alias("l").join(sound.select(*[c.alias(n) for n, c in new.items()]).withColumn("is", F.lit(True)).alias("r"), key, "full_outer")
    value = lambda c: F.when(F.col("was") & F.lit(c == "source_url") | F.col("is").isNull(), F.col(f"l.{c}")).otherwise(F.col(f"r.{c}"))
    return both.select(*[F.col(c) if c in key else value(c).alias(c) for c in new])


