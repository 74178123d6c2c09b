"""Exact dedup by distributed MSD radix partitioning: equality of bytes, no digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import forget, written

#: Deleted before texts are compared.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def _least(neg_chars: str, doc_id: str, row: Column) -> Column:
    """The order in which rows of a group are preferred: most code points, then smallest doc_id, nulls last, then any."""
    return F.struct(F.col(neg_chars).alias("a"), F.col(doc_id).isNull().alias("b"), F.col(doc_id).alias("c"), row.alias("d"))


def exact_groups(docs: DataFrame, carry: tuple[str, ...] = (), text: str = "text", first_digit: int = 64, growth: int = 16) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, and the carried columns.

    Texts are split by successive digits of bytes, the most significant first: rows of one group that share the next
    digit form a group of the next round. A group ends when it holds one row or when its texts have ended. Digits grow
    by `growth` each round, so a text of n bytes takes about log(n) rounds and moves each byte a bounded number of
    times; rows that are alone leave after the first digit. Groups are counted with partial sums, and their numbers
    are joined back by sort-merge joins, whose large partitions Spark may split: no task holds a group, and as nothing
    bounds the number of groups, none is broadcast, at any size.

    Null text is empty and equals texts of white space alone. Rows that repeat a doc_id are rows like others: one row
    of a group has kept = true. An empty table gives no rows; other columns are ignored. text_sha256 is a report only.
    With carried columns, `text` names the text among them (a field of a carried struct, say), so it is held once.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    held = F.col(text) if carry else F.col("held")
    norm = lambda t: F.translate(F.coalesce(t, F.lit("")), WHITE_SPACE, "").cast("binary")
    digit = lambda at, width: F.expr("substring(norm, %d, %d)" % (at + 1, width))
    named = lambda df, t: df.withColumn("norm", norm(t))
    own = [] if carry else ["held"]

    rows = docs.select(*carry, "doc_id", (-F.length(whole)).cast("long").alias("neg_chars"), *([] if carry else [F.col(text).alias("held")]))
    rows = named(rows, held).withColumn("digit", digit(0, first_digit)).drop("norm")
    groups = written(rows.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit", F.monotonically_increasing_id().alias("gid")), "radix-groups")
    state = rows.join(groups.hint("merge"), "digit", "left").select(
        *carry, "doc_id", "neg_chars", "gid", F.sha2(norm(held), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"),
        *[F.when(F.col("gid").isNotNull(), F.col(x)).alias(x) for x in own],
        F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.col("gid").isNull().alias("kept"),
    )
    state = written(state, "radix")
    forget(groups)
    done, at, width = [state.where("gid is null")], first_digit, first_digit
    while not (going := state.where("gid is not null")).isEmpty():
        width *= growth
        rows = named(going.drop("keep_id", "group_size", "kept"), held)
        rows = rows.withColumns({"digit": digit(at, width), "ended": F.octet_length("norm") < at + width}).drop("norm")
        groups = rows.groupBy("gid", "digit", "ended").agg(F.count("*").alias("n"), F.min(_least("neg_chars", "doc_id", F.col("row"))).alias("best"))
        groups = written(groups.where("n > 1").withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        alone = F.col("n").isNull()
        on = ~alone & ~F.col("ended")
        state = rows.join(groups.hint("merge"), ["gid", "digit", "ended"], "left").select(
            *carry, "doc_id", "neg_chars", F.when(on, F.col("next")).alias("gid"), "text_sha256", "row",
            *[F.when(on, F.col(x)).alias(x) for x in own],
            F.when(alone, F.col("doc_id")).otherwise(F.col("best.c")).alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            (alone | (F.col("best.d") == F.col("row"))).alias("kept"),
        )
        state = written(state, "radix")
        forget(groups)
        at += width
        done.append(state.where("gid is null"))
    return reduce(DataFrame.unionAll, done).select(*carry, "doc_id", "keep_id", "group_size", "kept", "text_sha256")
