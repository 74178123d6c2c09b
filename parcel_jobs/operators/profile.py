"""Profiles of feeds: keys, columns, shards, gaps, payloads, fingerprints. All are aggregates with partial sums."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_year, reference_alias, residential_split, sha_shard_bits, strip

SEPARATOR = "\x1f"


def probe_keys(df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """For each candidate key: blank rows (any part blank), rows beyond the first of a key, distinct keys, and whether complete and unique.

    The candidates, by their places, are exploded from one scan and counted by (candidate, key) at once.
    """
    parts = lambda key: [strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in key]
    one = lambda key: F.struct(F.lit(candidates.index(key)).alias("candidate"), F.concat_ws(SEPARATOR, *parts(key)).alias("key"), reduce(lambda a, b: a | b, [p == "" for p in parts(key)]).alias("blank"))
    long = df.select(F.explode(F.array(*map(one, candidates))).alias("x")).select("x.*")
    by_key = long.groupBy("candidate", "key").agg(F.count("*").alias("n"), F.max(F.col("blank").cast("int")).alias("blank"))
    out = by_key.groupBy("candidate").agg(F.sum(F.col("n") * F.col("blank")).alias("blank_rows"), F.sum((F.col("n") - 1) * (1 - F.col("blank"))).alias("duplicate_rows"), F.sum((1 - F.col("blank")).cast("long")).alias("distinct_keys"))
    out = out.withColumn("candidate", F.array(*[F.lit("+".join(key)) for key in candidates])[F.col("candidate")])
    return out.withColumn("complete_unique", (F.col("blank_rows") == 0) & (F.col("duplicate_rows") == 0))


def probe_key_pairs(df: DataFrame, base: str, columns: Sequence[str]) -> DataFrame:
    """probe_keys over the base with each column and with each pair of them."""
    return probe_keys(df, [[base, c] for c in columns] + [[base, *p] for p in combinations(columns, 2)])


def profile_columns(df: DataFrame) -> DataFrame:
    """Blank rows, rows with white space outside, and the greatest length of each column."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns}
    measures = [m for c, t in text.items() for m in (F.count_if(strip(t) == "").alias(f"b_{c}"), F.count_if(strip(t) != t).alias(f"o_{c}"), F.max(F.length(t)).cast("long").alias(f"l_{c}"))]
    wide = df.agg(*measures)
    row = lambda c: F.struct(F.lit(c).alias("column_name"), F.col(f"b_{c}").alias("blank_rows"), F.col(f"o_{c}").alias("outer_space_rows"), F.col(f"l_{c}").alias("max_length"))
    return wide.select(F.explode(F.array(*[row(c) for c in df.columns])).alias("x")).select("x.*")


def width_distribution(lines: DataFrame, separator: str, expected: int) -> DataFrame:
    """Lines by number of fields, and whether that is the expected number."""
    n = F.size(F.split("value", separator, -1))
    return lines.groupBy(n.alias("fields")).agg(F.count("*").alias("n")).withColumn("bad", F.col("fields") != expected)


def reconcile_physical_lines(rows: DataFrame, columns: Sequence[str], physical_lines: int | None = None) -> DataFrame:
    """Rows by the physical lines that they span, and the lines beyond the first in all; with a physical count, whether it adds up."""
    span = 1 + sum((F.regexp_count(F.coalesce(F.col(c), F.lit("")), F.lit("\n")) for c in columns), F.lit(0))
    out = rows.groupBy(span.cast("long").alias("span")).agg(F.count("*").alias("n"))
    out = out.withColumn("extra_lines", (F.col("span") - 1) * F.col("n"))
    if physical_lines is None:
        return out
    total = out.agg(F.sum(F.col("span") * F.col("n")).alias("total"))
    return out.crossJoin(F.broadcast(total)).withColumn("reconciled", F.col("total") == physical_lines).drop("total")  # one row


def id_semantics(df: DataFrame, a: str, b: str) -> DataFrame:
    """How two ids of a row compare: equal, differing, their distinct counts, least and greatest."""
    x, y = strip(F.col(a)), strip(F.col(b))
    return df.agg(
        F.count("*").alias("n"), F.count_if(x == y).alias("equal_rows"), F.count_if(x != y).alias("differ_rows"),
        F.count_distinct(x).alias("distinct_a"), F.count_distinct(y).alias("distinct_b"), F.min(x).alias("min_a"), F.max(x).alias("max_a"),
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values, ties by value."""
    return df.groupBy(strip(F.col(column)).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def id_fanout(df: DataFrame, key: str, other: str) -> DataFrame:
    """Keys by how many distinct others they have; blank keys are none."""
    per = df.where(strip(F.col(key)) != "").groupBy(key).agg(F.count_distinct(other).alias("others"))
    return per.groupBy("others").agg(F.count("*").alias("keys"))


def line_gaps(df: DataFrame, key: str, line: Column, first_missing: int = 5) -> DataFrame:
    """Keys with several rows: contiguous, gapped or duplicated line numbers, and the first missing ones.

    Each line is compared with the next of its key; of a gap, however wide, at most first_missing numbers are written out,
    and only the first gaps of a key are kept.
    """
    lines = df.select(key, line.cast("long").alias("ln")).groupBy(key, "ln").agg(F.count("*").alias("n"))
    order = Window.partitionBy(key).orderBy("ln")
    after = F.lead("ln").over(order)
    lines = lines.withColumn("gap", F.coalesce(after - F.col("ln") - 1, F.lit(0))).withColumn("before", F.coalesce(F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    kept = F.when((F.col("gap") > 0) & (F.col("before") < first_missing), F.struct("ln", F.least(F.col("gap"), F.lit(first_missing)).alias("wide")))
    per = lines.groupBy(key).agg(F.sum("n").alias("n"), F.count("*").alias("lines"), F.sum("gap").alias("missing"), F.array_sort(F.collect_list(kept)).alias("gaps")).where("n > 1")
    kind = F.when(F.col("n") > F.col("lines"), "duplicate").when(F.col("missing") > 0, "gapped").otherwise("contiguous")
    numbers = F.flatten(F.transform("gaps", lambda g: F.transform(F.sequence(F.lit(1).cast("long"), g["wide"]), lambda i: g["ln"] + i)))
    return per.select(key, "n", kind.alias("kind"), F.array_join(F.slice(numbers, 1, first_missing), ",").alias("first_missing"))


def shard_balance(df: DataFrame, key: str, counts: Sequence[int] = (32, 64, 96, 128)) -> DataFrame:
    """Least, greatest and mean rows of a shard for each number of shards, and greatest over mean."""
    by_key = df.groupBy(key).agg(F.count("*").alias("n")).select("n", sha_shard_bits(F.col(key)).alias("h"))  # one hash for each key
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("shards"), F.pmod(F.col("h"), F.lit(n)).cast("int").alias("shard")) for n in counts]))
    per = by_key.select("n", every.alias("x")).groupBy("x.shards", "x.shard").agg(F.sum("n").alias("n"))
    out = per.groupBy("shards").agg(F.min("n").alias("min_rows"), F.max("n").alias("max_rows"), F.sum("n").alias("rows"))
    return out.select("shards", "min_rows", "max_rows", F.round(F.col("rows") / F.col("shards"), 6).alias("avg_rows"), F.round(F.col("max_rows") * F.col("shards") / F.col("rows"), 6).alias("max_over_avg"))


def payload_bytes(columns: Sequence[str]) -> Column:
    """UTF-8 bytes of a row's fields and the separators between them."""
    return sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns), F.lit(len(columns) - 1)).cast("long")


def row_payload_stats(df: DataFrame) -> DataFrame:
    """Mean, 95th and 99th percentile (the element at int(n p) - 1 in order), greatest and total bytes of a row."""
    by_size = df.select(payload_bytes(df.columns).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    counts = by_size.agg(F.array_sort(F.collect_list(F.struct("b", "n"))).alias("sizes"), F.sum("n").alias("rows"), F.max("b").alias("max_bytes"), F.sum(F.col("b") * F.col("n")).alias("total_bytes"))  # one entry for each size

    def at(p: float) -> Column:
        place = F.greatest(F.floor(F.col("rows") * p).cast("long"), F.lit(1))
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("b"))
        step = lambda s, x: F.struct((s["seen"] + x["n"]).alias("seen"), F.when((s["seen"] < place) & (s["seen"] + x["n"] >= place), x["b"]).otherwise(s["b"]).alias("b"))
        return F.aggregate("sizes", start, step)["b"]

    return counts.select("rows", F.round(F.col("total_bytes") / F.col("rows"), 6).alias("mean_bytes"), at(0.95).alias("p95"), at(0.99).alias("p99"), "max_bytes", "total_bytes")


def tax_capacity(tax: DataFrame) -> DataFrame:
    """Rows of a parcel, parcels with repeated lines, rows with tax due, and its sum."""
    due = F.coalesce(F.col("taxesdue").try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    per = tax.groupBy("parcel_id").agg(F.count("*").alias("n"), F.count_distinct("lnnum").alias("lines"), F.count_if(due > 0).alias("due_rows"), F.sum(due).alias("due"))
    return per.agg(
        F.count("*").alias("parcels"), F.sum("n").alias("rows"), F.round(F.avg("n"), 6).alias("avg_rows"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
        F.count_if(F.col("n") > F.col("lines")).alias("repeated_line_parcels"), F.sum("due_rows").alias("due_rows"), F.count_if(F.col("due") > 0).alias("due_parcels"), F.sum("due").cast("decimal(28,2)").alias("total_due"),
    )


def _scope(sales: DataFrame, parcel: DataFrame) -> DataFrame:
    homes = residential_split(parcel).select("parcel_id", "vacant")
    return sales.withColumns({"year": parse_year(F.col("saledt")), "bytes": payload_bytes(sales.columns)}).join(homes, "parcel_id")


def sales_scope_by_year(sales: DataFrame, parcel: DataFrame) -> DataFrame:
    """Residential sales by year (null: no date): rows, parcels, improved and vacant rows, bytes."""
    return _scope(sales, parcel).groupBy("year").agg(F.count("*").alias("rows"), F.count_distinct("parcel_id").alias("parcels"), F.count_if(~F.col("vacant")).alias("improved_rows"), F.count_if("vacant").alias("vacant_rows"), F.sum("bytes").alias("bytes"))


def sales_scope_since(sales: DataFrame, parcel: DataFrame, starts: Sequence[int]) -> DataFrame:
    """Residential sales from each start year on."""
    since = F.explode(F.filter(F.array(*map(F.lit, starts)), lambda s: F.col("year") >= s)).alias("start_year")
    return _scope(sales, parcel).select("parcel_id", "bytes", since).groupBy("start_year").agg(F.count("*").alias("rows"), F.count_distinct("parcel_id").alias("parcels"), F.sum("bytes").alias("bytes"))


def table_fingerprint(df: DataFrame, key: str) -> DataFrame:
    """Rows, blank keys, least and greatest key, and a sum of row hashes that no order or partitioning changes."""
    text = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    return df.agg(
        F.count("*").alias("rows"), F.count_if(F.coalesce(F.col(key), F.lit("")) == "").alias("blank_keys"), F.min(key).alias("min_key"), F.max(key).alias("max_key"),
        F.sum(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias("fingerprint"),
    )


def prefix_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.substring(key, 1, 3).alias("prefix")).agg(F.count("*").alias("n"))


def repeated_aliases(sales: DataFrame, *columns: str) -> DataFrame:
    """Aliases of the columns that several rows of the whole history share: count, least and greatest parcel. Blank aliases are none."""
    named = sales.select("parcel_id", *[reference_alias(F.col(c)).alias(c) for c in columns])
    for c in columns:
        named = named.where(F.col(c) != "")
    return named.groupBy(*columns).agg(F.count("*").alias("n"), F.min("parcel_id").alias("min_parcel"), F.max("parcel_id").alias("max_parcel")).where("n > 1")
