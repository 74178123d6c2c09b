"""Targets, coverage, reconciliation, digests, differences and merges of snapshot versions."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import json_text, parcel_key, sha_shard, source_review_flags
from .gates import GateClosed, require_no_errors, require_unique


def _same(columns: Sequence[str], left: str = "l", right: str = "r") -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(True))


def select_targets(feed: DataFrame, targets: DataFrame, key: str = "parcel_id") -> DataFrame:
    """Rows of the feed, all validated before, whose key is a target. Spark broadcasts the targets if their size allows."""
    return feed.join(targets.select(key).distinct(), key, "left_semi")


def target_coverage(feed: DataFrame, targets: DataFrame, key: str = "parcel_id") -> DataFrame:
    """Source and selected rows, matched and missing targets, and the fraction kept."""
    seen = targets.select(key).distinct().join(feed.select(key).distinct().withColumn("hit", F.lit(True)), key, "left")
    found = seen.agg(F.count_if(F.col("hit")).alias("matched"), F.count_if(F.col("hit").isNull()).alias("missing"))
    rows = feed.join(targets.select(key).distinct().withColumn("target", F.lit(True)), key, "left").agg(F.count("*").alias("source_rows"), F.count_if(F.col("target")).alias("selected_rows"))
    return rows.crossJoin(found).withColumn("kept_fraction", F.round(F.col("selected_rows") / F.col("source_rows"), 6))  # one row each


def cross_feed_integrity(feed: DataFrame, parcel: DataFrame, key: str = "parcel_id") -> DataFrame:
    """Distinct keys of the feed: those the parcel feed has, and orphans."""
    keys = feed.select(key).distinct().join(parcel.select(key).distinct().withColumn("hit", F.lit(True)), key, "left")
    return keys.agg(F.count_if(F.col("hit")).alias("matched_keys"), F.count_if(F.col("hit").isNull()).alias("orphan_keys"))


def reconcile(source: DataFrame, incoming: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Counts that must all be zero: keys outside the source, rows that differ, keys seen twice, keys of the source not seen."""
    seen = incoming.groupBy(*key).agg(F.count("*").alias("copies"), *[F.min(c).alias(c) for c in columns])
    both = source.withColumn("in_source", F.lit(True)).alias("l").join(seen.alias("r"), list(key), "full_outer")
    both = both.select(F.coalesce("in_source", F.lit(False)).alias("in_source"), F.col("copies"), _same(columns).alias("same"))
    out = both.agg(
        F.count_if(~F.col("in_source")).alias("outside"), F.count_if(F.col("in_source") & F.col("copies").isNotNull() & ~F.col("same")).alias("different"),
        F.count_if(F.col("copies") > 1).alias("duplicate"), F.count_if(F.col("in_source") & F.col("copies").isNull()).alias("missing"),
    )
    return out.withColumn("passes", F.col("outside") + F.col("different") + F.col("duplicate") + F.col("missing") == 0)


def missing_by_shard(expected: DataFrame, seen: DataFrame, key: Sequence[str], shards: int) -> DataFrame:
    """Rows that are still to be loaded, by shard of the first key column, so that a rerun resumes."""
    left = expected.select(*key).join(seen.select(*key), list(key), "left_anti")
    return left.groupBy(sha_shard(F.col(key[0]), shards).alias("shard")).agg(F.count("*").alias("n"))


def keyed_properties(properties: DataFrame) -> DataFrame:
    return properties.select(F.col("id").alias("property_id"), parcel_key(F.col("parcel_id")).alias("parcel_key")).where("parcel_key is not null")


def registry_drift(properties: DataFrame, registry: DataFrame) -> DataFrame:
    """Property ids of either side by state: missing from the registry, stale in it, or with another key."""
    both = keyed_properties(properties).alias("l").join(registry.alias("r"), "property_id", "full_outer")
    state = F.when(F.col("r.parcel_key").isNull(), "missing").when(F.col("l.parcel_key").isNull(), "stale").when(F.col("l.parcel_key") != F.col("r.parcel_key"), "changed")
    return both.select("property_id", state.alias("state")).where("state is not null")


def refresh_registry(properties: DataFrame, registry: DataFrame, as_of: str) -> DataFrame:
    """The next registry: stale rows gone, new ones in, changed ones rewritten; unchanged rows keep refreshed_at.

    GateClosed if a property's parcel_id, blank ones apart, has no valid key, or two properties have the same one.
    """
    named = properties.where(F.trim(F.coalesce("parcel_id", F.lit(""))) != "").select(F.col("id").alias("property_id"), "parcel_id", parcel_key(F.col("parcel_id")).alias("parcel_key"))
    require_no_errors(named.withColumn("error", F.when(F.col("parcel_key").isNull(), "parcel_id")))
    require_unique(named, ["parcel_key"])
    both = named.alias("l").join(registry.alias("r"), "property_id", "left")
    same = F.col("l.parcel_key").eqNullSafe(F.col("r.parcel_key"))
    return both.select("property_id", F.col("l.parcel_key"), F.when(same, F.col("r.refreshed_at")).otherwise(F.lit(as_of).cast("timestamp")).alias("refreshed_at"))


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], keep_if_null: Sequence[str] = ()) -> DataFrame:
    """The next version of target: rows of source replace those of their key; columns of keep_if_null keep the old value for a null."""
    both = target.withColumn("old", F.lit(True)).alias("l").join(source.withColumn("new", F.lit(True)).alias("r"), list(key), "full_outer")
    value = lambda c: F.coalesce(f"r.{c}", f"l.{c}") if c in keep_if_null else F.when(F.col("new"), F.col(f"r.{c}")).otherwise(F.col(f"l.{c}"))
    return both.select(*key, *[value(c).alias(c) for c in target.columns if c not in key])


def upsert_json(target: DataFrame, source: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Upsert of one JSON object column: fields of both, those of source winning, each with its type; what is no object counts as empty. Fields come in order of name."""
    fields = lambda c: F.coalesce(F.from_json(c, "map<string,variant>"), F.expr("cast(map() as map<string,variant>)"))
    both = target.select(*key, F.col(column).alias("old")).join(source.select(*key, F.col(column).alias("new")), list(key), "full_outer")
    old, new = fields("old"), fields("new")
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)
    named = F.map_from_arrays(F.array_sort(F.map_keys(merged)), F.transform(F.array_sort(F.map_keys(merged)), lambda k: F.element_at(merged, k)))
    return both.select(*key, F.to_json(named).alias(column))


def incomplete_profiles(targets: DataFrame, feeds: dict[str, DataFrame], key: str = "parcel_id") -> DataFrame:
    """Targets that lack rows of a feed, with the feeds they lack."""
    base = targets.select(key).distinct()
    lacks = [base.join(f.select(key), key, "left_anti").withColumn("feed", F.lit(name)) for name, f in feeds.items()]
    return reduce(DataFrame.unionAll, lacks).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("feed")), ",").alias("missing_feeds"))


def row_digest(df: DataFrame, columns: Sequence[str], line: str | None = None, percent: str | None = None) -> DataFrame:
    """df with digest: MD5 of the JSON array of its comparison fields, line numbers as integers, percents without trailing zeros."""
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in columns}
    if line:
        text[line] = F.col(line).try_cast("bigint").cast("string")
    if percent:
        plain = F.col(percent).try_cast("decimal(38,10)").cast("string")
        plain = F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+\z", "$1"), r"\.\z", "")
        text[percent] = F.when(text[percent] == "", "").otherwise(plain)
    return df.withColumn("digest", F.md5(F.concat(F.lit("["), F.concat_ws(", ", *[json_text(t) for t in text.values()]), F.lit("]"))))


#: Bytes of digests in one row of a stream, so that a batch of rows stays small.
_PIECE = 4096


def feed_digest(df: DataFrame, *order: str, max_rows: int | None = None) -> DataFrame:
    """rows and feed_digest of a snapshot: MD5 of all row digests in the order of the key, each after the other, as a published snapshot states it.

    Rows are sorted and joined to pieces side by side. An MD5 is a chain, so one task takes the pieces in turn, 32 bytes a row, and
    holds no more than a batch of them. GateClosed beyond max_rows, if that is given. block_digest and table_fingerprint have no such chain.
    """
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise GateClosed(f"more than {max_rows} rows for one digest")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = "".join(d for d in batch.column(0).to_pylist() if d).encode()
            pieces = [text[i : i + _PIECE] for i in range(0, max(len(text), 1), _PIECE)]
            rows = [batch.num_rows] + [0] * (len(pieces) - 1)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(pieces), pa.int32()), pa.array(range(at, at + len(pieces)), pa.int64()), pa.array(rows, pa.int64()), pa.array(pieces, pa.binary())], names=["part", "at", "rows", "piece"])
            at += len(pieces)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = hashlib.md5(), 0
        for batch in batches:
            rows += pc.sum(batch.column(0)).as_py() or 0
            for piece in batch.column(1):
                seen.update(piece.as_buffer())
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64()), "feed_digest": pa.array([seen.hexdigest()])})

    pieces = df.orderBy(*order, "digest").select("digest").mapInArrow(joined, "part int, at long, rows long, piece binary")
    chain = pieces.repartition(1).sortWithinPartitions("part", "at").select("rows", "piece").mapInArrow(chained, "rows long, feed_digest string")
    return chain.agg(F.coalesce(F.max("rows"), F.lit(0).cast("long")).alias("rows"), F.coalesce(F.max("feed_digest"), F.md5(F.lit(""))).alias("feed_digest"))


def block_digest(df: DataFrame, *order: str) -> DataFrame:
    """rows and block_digest: a digest of all row digests in two levels, so that no task holds them all. It isn't the MD5 that a published snapshot states.

    A group is the rows of one first key column; its digest is the MD5 of its row digests in order. Groups are gathered
    by the first four hex digits of the MD5 of their key, 65536 blocks at most, and the digest is the MD5 of the
    blocks' digests in order. A block's list grows with the number of keys over 65536, a group's with its own rows.
    """
    joined = lambda parts: F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(parts)), lambda r: r["digest"]), ""))
    groups = df.groupBy(order[0]).agg(F.count("*").alias("rows"), joined(F.struct(*order, "digest")).alias("digest"))
    blocks = groups.groupBy(F.substring(F.md5(order[0]), 1, 4).alias("block")).agg(F.sum("rows").alias("rows"), joined(F.struct(order[0], "digest")).alias("digest"))
    return blocks.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("rows"), joined(F.struct("block", "digest")).alias("block_digest"))


#: Ranges of hashes of the key in a tree of fingerprints, and how many of them one node above holds.
RANGES, FANOUT = 65_536, 256


def _range(key: str, ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def fingerprint_tree(df: DataFrame, key: str, columns: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """(level, node, rows, one, two): for each range of hashes of the key (level 1), and each FANOUT of them (level 0), sums of two 64-bit hashes of their rows.

    Sums don't depend on order, so they are added in partial sums; a tree has at most ranges * (1 + 1 / FANOUT) rows. One that was kept with a version stands for it.
    """
    number = lambda seed: F.xxhash64(F.lit(seed), *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (key, *columns)]).cast("decimal(20,0)")
    leaves = df.groupBy(_range(key, ranges).alias("node")).agg(F.count("*").alias("rows"), F.sum(number(1)).alias("one"), F.sum(number(2)).alias("two"))
    up = leaves.groupBy((F.col("node") / FANOUT).cast("int").alias("node")).agg(*[F.sum(c).alias(c) for c in ("rows", "one", "two")])
    same = ["rows", F.col("one").cast("decimal(38,0)").alias("one"), F.col("two").cast("decimal(38,0)").alias("two")]
    return leaves.select(F.lit(1).alias("level"), "node", *same).unionAll(up.select(F.lit(0).alias("level"), "node", *same))


def differing_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """node of the ranges in which two trees differ: those below a node of level 0 that does."""
    both = old.alias("l").join(new.alias("r"), ["level", "node"], "full_outer").where(~_same(["rows", "one", "two"]))
    above = both.where("level = 0").select(F.col("node").alias("above"))
    return both.where("level = 1").select("node").join(F.broadcast(above), (F.col("node") / FANOUT).cast("int") == F.col("above"), "left_semi")  # at most RANGES / FANOUT rows


def diff_snapshots(old: DataFrame, new: DataFrame, key: str, line: str, columns: Sequence[str], ranges: int = RANGES, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Keys with their state and how many rows were added, removed or changed, and how many fields changed.

    Only rows of ranges whose fingerprints differ are joined; keys of all others are unchanged, by two sums of 64 bits each. trees are those of both
    versions, if they were kept; else they are made, which reads each version once more but shuffles none of its rows.
    """
    a, b = trees or (fingerprint_tree(old, key, [line, *columns], ranges), fingerprint_tree(new, key, [line, *columns], ranges))
    differ = F.broadcast(differing_ranges(a, b).distinct())  # at most `ranges` numbers
    part = lambda df, how: df.withColumn("node", _range(key, ranges)).join(differ, "node", how).drop("node")
    both = part(old, "left_semi").withColumn("was", F.lit(True)).alias("l").join(part(new, "left_semi").withColumn("is", F.lit(True)).alias("r"), [key, line], "full_outer")
    fields = sum(((~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).cast("int") for c in columns), F.lit(0))
    kept = F.col("was") & F.col("is")
    per = both.select(key, "was", "is", F.when(kept, fields).otherwise(0).alias("fields")).groupBy(key).agg(
        F.count_if(F.col("was").isNull()).alias("added_rows"), F.count_if(F.col("is").isNull()).alias("removed_rows"), F.count_if(F.col("fields") > 0).alias("changed_rows"),
        F.sum("fields").cast("long").alias("changed_fields"), F.count_if(F.col("was")).alias("old_rows"), F.count_if(F.col("is")).alias("new_rows"),
    )
    state = F.when(F.col("old_rows") == 0, "added").when(F.col("new_rows") == 0, "missing").when(F.col("added_rows") + F.col("removed_rows") + F.col("changed_rows") > 0, "changed").otherwise("unchanged")
    counts = ["added_rows", "removed_rows", "changed_rows", "changed_fields"]
    rest = part(new, "left_anti").select(key).distinct()
    return per.select(key, state.alias("state"), *counts).unionByName(rest.select(key, F.lit("unchanged").alias("state"), *[F.lit(0).cast("long").alias(c) for c in counts]))


def owner_set_changes(old: DataFrame, new: DataFrame, key: str = "parcel_id", name: str = "name") -> DataFrame:
    """Keys of both versions whose sets of owner names differ."""
    names = lambda df, out: df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(name)), "|").alias(out))
    return names(old, "old_names").join(names(new, "new_names"), key).where("old_names <> new_names")


def review_class_counts(parcel: DataFrame) -> DataFrame:
    """Profiles of each flagged class, and all that need review once, as 'any'."""
    flagged = parcel.select("parcel_id", source_review_flags(F.col("dorus_code"), F.col("dordesc1")).alias("reasons")).where(F.size("reasons") > 0)
    return flagged.select("parcel_id", F.explode(F.array_append("reasons", F.lit("any"))).alias("reason")).groupBy("reason").agg(F.count_distinct("parcel_id").alias("profiles"))


def profile_documents(targets: DataFrame, parcel: DataFrame, owner: DataFrame, legal: DataFrame | None = None) -> DataFrame:
    """One row for each target: the feeds' rows in order of line, missing feeds, flags, and whether review is required."""
    listed = lambda df, line, out: df.groupBy("parcel_id").agg(F.array_sort(F.collect_list(F.struct(line.alias("line"), *[c for c in df.columns if c != "parcel_id"]))).alias(out))
    out = targets.select("parcel_id").distinct().join(listed(parcel, F.lit(0), "parcel_rows"), "parcel_id", "left").join(listed(owner, F.col("ln_num").try_cast("int"), "owner_rows"), "parcel_id", "left")
    feeds = {"parcel": "parcel_rows", "owner": "owner_rows"}
    if legal is not None:
        out, feeds = out.join(listed(legal, F.col("num").try_cast("int"), "legal_rows"), "parcel_id", "left"), feeds | {"legal": "legal_rows"}
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(n)) for n, c in feeds.items()]))
    flags = F.coalesce(F.flatten(F.transform("parcel_rows", lambda r: source_review_flags(r["dorus_code"], r["dordesc1"]))), F.array().cast("array<string>"))
    return out.withColumns({"missing_feeds": missing, "flags": flags}).withColumn("review_required", (F.size("missing_feeds") > 0) | (F.size("flags") > 0))


#: Fixed value: what a quarantined review says of its estimates.
QUARANTINE_NOTE = "Legacy machine estimates quarantined pending verified comps and due diligence; original review retained privately."


def quarantine_reviews(reviews: DataFrame, as_of: str, max_rows: int = 100) -> tuple[DataFrame, DataFrame]:
    """(backup of affected rows, next version) of reviews (status, dd_score, comps_status, underwriting_status, findings JSON, ...).

    Affected is what is up for review and not marked as ineligible for automated acquisition; approved and safe reviews stay as they are. Those
    lose their score, and a block without estimates replaces their underwriting. GateClosed above max_rows: nothing is done.
    """
    hit = F.coalesce((F.col("status") == "review_required") & ~F.get_json_object("findings", "$.underwriting.eligible_for_automated_acquisition").eqNullSafe(F.lit("false")), F.lit(False))
    backup = reviews.where(hit)
    if backup.limit(max_rows + 1).count() > max_rows:
        raise GateClosed(f"more than {max_rows} reviews are affected")
    block = {"checked_at": as_of, "estimated_value": None, "preliminary_mao": None, "confidence_score": None, "eligible_for_automated_acquisition": False, "note": QUARANTINE_NOTE}
    held = F.coalesce(F.from_json("findings", "map<string,variant>"), F.expr("cast(map() as map<string,variant>)"))
    findings = F.to_json(F.map_concat(F.map_filter(held, lambda k, v: k != "underwriting"), F.create_map(F.lit("underwriting"), F.parse_json(F.lit(json.dumps(block))))))
    new = {"dd_score": F.lit(0), "comps_status": F.lit("review_required"), "underwriting_status": F.lit("review_required"), "findings": findings}
    return backup, reviews.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()})
