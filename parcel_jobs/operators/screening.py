"""Screening of sales for comparability review: every row stays review-required."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import reference_alias, sale_date, source_review_flags, strip, window_class
from .gates import require_unique
from .profile import repeated_aliases

#: Accepted instrument codes and their descriptions.
QUALIFIED = {"01": "Q-Per examination of deed", "02": "Q-Credible, verified & documented"}
#: All reasons and observations that a report names.
REASONS = (
    "qualification_code_outside_candidate_contract", "qualification_code_description_drift", "price_missing", "nominal_price_screen_at_most_100", "sale_type_unrecognized",
    "foreclosure_flag_or_unknown", "recording_reference_missing_or_unrecognized", "sale_id_missing_or_unrecognized", "recording_reference_repeated", "recording_spans_multiple_parcels",
    "current_parcel_missing", "current_classification_incomplete", "county_inaccessible_tract", "county_mineral_rights", "county_split_combine", "county_classification_mismatch",
)
#: What every sale still needs, and the two statuses.
REMAINING_REVIEW = ("historical_export_semantics_unverified", "transaction_identity_unverified", "sale_date_property_attributes_unverified", "subject_comparability_unverified")
HELD, CANDIDATE = "held_for_review", "candidate_for_comparability_review"
OBSERVATIONS = ("sale_id_reference_repeated", "sale_id_not_globally_unique")


def screen_sales(sales: DataFrame, parcel: DataFrame, targets: DataFrame, start: str, as_of: str) -> DataFrame:
    """Sales of the window with sorted reasons, observations, status, what remains to be reviewed, their present parcel and its flags, and whether it is a target.

    GateClosed if a parcel or a sale's key (parcel_id, ln_num) repeats: a second parcel row would multiply sales.
    Groups of repeated references come from the whole history; they are few, so the joins back are small, and blank
    aliases are null, which joins nothing. Rules set bits of one number, whose names are written out last.
    """
    require_unique(parcel, ["parcel_id"])
    require_unique(sales, ["parcel_id", "ln_num"])
    by_recording = repeated_aliases(sales, "book", "page").select(F.col("book").alias("book_alias"), F.col("page").alias("page_alias"), F.lit(True).alias("recorded_again"), (F.col("min_parcel") != F.col("max_parcel")).alias("recorded_apart"))
    by_sale = repeated_aliases(sales, "sale_id").select(F.col("sale_id").alias("sale_alias"), F.lit(True).alias("sold_again"), (F.col("min_parcel") != F.col("max_parcel")).alias("sold_apart"))
    kind = [strip(F.coalesce(c, F.lit(""))) for c in ("dorus_code", "dordesc", "dordesc1")]
    flags = source_review_flags(F.col("dorus_code"), F.col("dordesc1"))
    flagged = F.transform(flags, lambda r: F.struct(r.alias("reason"), F.lit("parcel").alias("feed"), kind[0].alias("source_code"), kind[2].alias("source_description"), F.lit(False).alias("legal_conclusion_verified")))
    current = parcel.select("parcel_id", flags.alias("flags"), F.struct("parcel_id", "dorus_code", "dordesc", "dordesc1").alias("current_parcel"), flagged.alias("source_review_flags"), ((kind[0] == "") | (kind[1] == "") | (kind[2] == "")).alias("incomplete"))
    wanted = targets.select("parcel_id").distinct().withColumn("is_target", F.lit(True))
    alias = lambda c: F.nullif(reference_alias(F.col(c)), F.lit(""))
    code, text, price = strip(F.col("instrtyp")), strip(F.col("instrtyp_dscr")), strip(F.col("price"))
    expected = F.when(code == "01", QUALIFIED["01"]).when(code == "02", QUALIFIED["02"])
    own = {  # rules that a sale breaks by itself
        REASONS[0]: expected.isNull(), REASONS[1]: text != expected, REASONS[2]: price == "", REASONS[3]: price.try_cast("decimal(38,10)") <= 100,
        REASONS[4]: ~strip(F.col("saletype")).isin("I", "V"), REASONS[5]: strip(F.col("foreclosure")) != "N",
    }
    rows = sales.where(window_class(sale_date(F.col("saledt")), start, as_of) == "in_window").select(
        "parcel_id", "ln_num", alias("book").alias("book_alias"), alias("page").alias("page_alias"), alias("sale_id").alias("sale_alias"), _bits(own).alias("own")
    )
    rows = rows.join(by_recording, ["book_alias", "page_alias"], "left").join(by_sale, "sale_alias", "left").join(current, "parcel_id", "left").join(wanted, "parcel_id", "left")
    joined = {
        REASONS[6]: F.col("book_alias").isNull() | F.col("page_alias").isNull(), REASONS[7]: F.col("sale_alias").isNull(), REASONS[8]: F.col("recorded_again"), REASONS[9]: F.col("recorded_apart"),
        REASONS[10]: F.col("flags").isNull(), REASONS[11]: F.col("incomplete"), **{r: F.array_contains("flags", r) for r in REASONS[12:]},
    }
    seen = _bits({OBSERVATIONS[0]: F.col("sold_again"), OBSERVATIONS[1]: F.col("sold_apart")})
    rows = rows.select("parcel_id", "ln_num", F.col("own").bitwiseOR(_bits(joined)).alias("mask"), seen.alias("seen"), "is_target", "current_parcel", "source_review_flags")
    status = F.when(F.col("mask") != 0, HELD).otherwise(CANDIDATE)
    return rows.select(
        "parcel_id", "ln_num", _names(F.col("mask"), REASONS).alias("reasons"), _names(F.col("seen"), OBSERVATIONS).alias("observations"), status.alias("status"),
        F.array(*map(F.lit, REMAINING_REVIEW)).alias("remaining_review"), "current_parcel", F.coalesce("source_review_flags", F.array().cast("array<struct<reason:string,feed:string,source_code:string,source_description:string,legal_conclusion_verified:boolean>>")).alias("source_review_flags"),
        F.coalesce("is_target", F.lit(False)).alias("is_target"), F.lit(True).alias("review_required"), F.lit(False).alias("qualified_comp"), F.lit(False).alias("eligible_for_automated_acquisition"),
    )


def _bits(rules: dict[str, Column]) -> Column:
    """A number with the bit of each name whose condition holds; a name's bit is its place among REASONS or OBSERVATIONS."""
    return sum((F.when(c, 1 << (REASONS if r in REASONS else OBSERVATIONS).index(r)).otherwise(0) for r, c in rules.items()), F.lit(0))


def _names(mask: Column, names: tuple[str, ...]) -> Column:
    """The names of the bits that are set, sorted."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(F.lit(1 << k)) != 0, names[k]) for k in order]))


def screen_report(screened: DataFrame) -> DataFrame:
    """Counts by kind and name: statuses, targets, reasons and observations, those of zero too.

    Rows are counted by their combination of all four first, which are few, and only the combinations are taken apart.
    """
    spark = screened.sparkSession
    names = [("status", s) for s in (HELD, CANDIDATE)] + [("target", s) for s in ("true", "false")] + [("reason", r) for r in REASONS] + [("observation", o) for o in OBSERVATIONS]
    fixed = spark.sql("select * from values " + ", ".join(f"('{k}', '{n}')" for k, n in names) + " as t(kind, name)")
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("name"))
    alike = screened.groupBy("status", "is_target", "reasons", "observations").agg(F.count("*").alias("rows"))
    every = F.concat(F.array(pair("status", F.col("status")), pair("target", F.col("is_target").cast("string"))), F.transform("reasons", lambda r: pair("reason", r)), F.transform("observations", lambda o: pair("observation", o)))
    counts = alike.select("rows", F.explode(every).alias("x")).groupBy("x.kind", "x.name").agg(F.sum("rows").alias("n"))
    return fixed.join(counts, ["kind", "name"], "left").select("kind", "name", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
