"""Checks that close on any doubt: invalid, missing, stale or ambiguous never passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateClosed(ValueError):
    """A gate found what it must not pass."""


def _close_on(df: DataFrame, what: str) -> None:
    if rows := df.limit(20).collect():
        raise GateClosed(f"{what}: {[r.asDict() for r in rows]}")


def error_counts(df: DataFrame) -> DataFrame:
    """Rows by error, null for valid ones."""
    return df.groupBy("error").agg(F.count("*").alias("n"))


def require_no_errors(df: DataFrame) -> DataFrame:
    """df, or GateClosed if any row, target or not, has an error."""
    _close_on(error_counts(df.where("error is not null")), "invalid rows")
    return df


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """df, or GateClosed if a canonical key repeats."""
    _close_on(duplicate_keys(df, key), "repeated keys")
    return df


def target_gate(export: DataFrame, project: str, as_of: str) -> DataFrame:
    """One row for each export (project_ref, captured_at, registry_drift, parcel_keys): keys, invalid and repeated keys, and whether it may be used."""
    keys = F.coalesce("parcel_keys", F.array().cast("array<string>"))
    bad = F.size(F.filter(keys, lambda k: ~F.coalesce(k.rlike(r"^[0-9]{18}\z"), F.lit(False))))
    repeated = F.size(keys) - F.size(F.array_distinct(keys))
    age = F.lit(as_of).cast("timestamp") - F.col("captured_at")
    fresh = (age >= F.expr("interval 0 hours")) & (age <= F.expr("interval 24 hours"))
    usable = (F.col("project_ref") == project) & fresh & (F.col("registry_drift") == 0) & (bad == 0) & (repeated == 0) & (F.size(keys) > 0)
    return export.select("project_ref", F.size(keys).cast("long").alias("n_keys"), bad.cast("long").alias("invalid_keys"), repeated.cast("long").alias("repeated_keys"), F.coalesce(usable, F.lit(False)).alias("usable"))


def target_gate_rows(export: DataFrame, project: str, as_of: str) -> DataFrame:
    """The same of exports with a row for each key (project_ref, captured_at, registry_drift, parcel_key), in partial sums: no export need fit one task.

    Rows of an export that disagree close the gate: all must be fresh and without drift.
    """
    valid = F.coalesce(F.col("parcel_key").rlike(r"^[0-9]{18}\z"), F.lit(False))
    age = F.lit(as_of).cast("timestamp") - F.col("captured_at")
    sound = F.coalesce((age >= F.expr("interval 0 hours")) & (age <= F.expr("interval 24 hours")) & (F.col("registry_drift") == 0), F.lit(False))
    per_key = export.select("project_ref", "parcel_key", valid.alias("valid"), sound.alias("sound")).groupBy("project_ref", "parcel_key").agg(
        F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("bad"), F.count_if(~F.col("sound")).alias("unsound")
    )
    out = per_key.groupBy("project_ref").agg(F.sum("n").alias("n_keys"), F.sum("bad").alias("invalid_keys"), F.sum(F.col("n") - 1).alias("repeated_keys"), F.sum("unsound").alias("unsound"))
    usable = (F.col("project_ref") == project) & (F.col("unsound") == 0) & (F.col("invalid_keys") == 0) & (F.col("repeated_keys") == 0)
    return out.select("project_ref", "n_keys", "invalid_keys", "repeated_keys", F.coalesce(usable, F.lit(False)).alias("usable"))


def coverage_gate(parsed: Column, reported: Column, slack: int = 0) -> Column:
    """Whether the rows that were parsed reach the total that was reported, less the slack."""
    return F.coalesce(parsed >= reported - slack, F.lit(False))


def size_gate(n: Column, cap: int = 40_000) -> Column:
    """Whether an upstream result is neither empty nor at its cap, where it may be cut off."""
    return F.coalesce((n > 0) & (n < cap), F.lit(False))
