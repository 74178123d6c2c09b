"""Near duplicates by shingle sets: buckets of banded minima, bit-sliced fingerprints, and whole sets compared at the end."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import roots_of
from .shared import chunks, forget, text_column, written
from .simhash import SEED, TILE, named_rows, near_matrix

SHINGLE, LEAST = 5, 0.8
#: Minima a band, and bands. Sets that share four fifths agree in one band at least in 99.8 % of cases.
ROWS, BANDS = 5, 16
#: Differing bits of the fingerprints of two sets. At four fifths they are 9.7 in the mean, with a deviation of 2.9.
RADIUS = 21
#: Rounds in which every text is compared with one other of its buckets, before all that is left is compared.
STARS = 3
#: Bits of the parities of a set.
PARITIES = 1024


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, np.uint64) | np.uint64(1)


_FACTORS, _WEIGHTS, _OFFSETS = _odd(ROWS * BANDS, SEED), _odd(ROWS, SEED + 1), _odd(BANDS, SEED + 2)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the different shingles of a text, words as in fingerprint(); a text of fewer words has one."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    return np.unique(np.array([xxh64_intdigest(b" ".join(words[i : i + size]), SEED) for i in range(max(1, len(words) - size + 1))], np.uint64)).view(np.int64)


def sketch(members: np.ndarray) -> tuple[int, np.ndarray]:
    """Fingerprint of a set of hashes, each counted once, and the keys of its bands: hashes of their minima under multiplication by odd factors."""
    counts, least = np.zeros(64, np.int64), np.full(len(_FACTORS), ~np.uint64(0))
    for i in range(0, len(members), 4096):
        part = members[i : i + 4096].view(np.uint64)
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        least = np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(axis=1))
    keys = (least.reshape(BANDS, ROWS) * _WEIGHTS).sum(axis=1, dtype=np.uint64) + _OFFSETS
    return int.from_bytes(np.packbits(counts * 2 > len(members), bitorder="little").tobytes(), "little"), keys


def parities(members: np.ndarray) -> bytes:
    """Whether an odd number of the set's hashes end in each value. Of two sets, no more bits differ than hashes are in one of them alone."""
    return np.packbits((np.bincount((members.view(np.uint64) % PARITIES).astype(np.int64), minlength=PARITIES) & 1).astype(np.uint8)).tobytes()


def _sketches(docs: DataFrame, carry: tuple[str, ...], text: str, size: int) -> DataFrame:
    """The carried columns, doc_id, fp and keys of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sketch(shingles(t, size)) for _, texts in chunks(text_column(batch, text)) for t in texts]
            kept = [i for i, name in enumerate(batch.schema.names) if name in (*carry, "doc_id")]
            flat = np.concatenate([np.zeros(0, np.uint64), *[keys for _, keys in made]]).view(np.int64)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            columns = [*[batch.column(i) for i in kept], pa.array(np.array([fp for fp, _ in made], np.uint64).view(np.int64)), keys]
            yield pa.RecordBatch.from_arrays(columns, names=[*[batch.schema.names[i] for i in kept], "fp", "keys"])

    docs = docs.select(*carry, "doc_id")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds}, fp long, keys array<long>")


def _stars(buckets: DataFrame, turn: int, radius: int) -> DataFrame:
    """Pairs (a, b): each text b with one leader a of its buckets, of another component. A turn has leaders of its own, the same in all bands.

    The first leaders are the texts with the most company in their buckets: of a text and its near copies, those with the fewest changes.
    """
    order = F.struct((F.xxhash64("fp", F.lit(turn)) if turn else -F.col("company")).alias("draw"), "fp", "root")
    leaders = buckets.groupBy("key").agg(F.min(order).alias("leader"))
    met = buckets.join(leaders.hint("merge"), "key").where((F.col("root") != F.col("leader.root")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("leader.fp"))) <= radius))
    return met.groupBy("fp").agg(F.min("leader").alias("leader")).select(F.col("leader.fp").alias("a"), F.col("fp").alias("b"))


def _rarest(texts: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(key, fp, root, size, rest, bits): each text under the rarest of its shingles, where it meets texts of other components.

    Shingles are in one order, by the number of these texts that have them. Two sets of which one has `size` members share least * size
    of them, if they are alike; so the first of those lies among the first size - ceil(least * size) + 1 of either. rest counts a text's
    shingles from this one on. Shingles that no other text has meet nothing.
    """
    each = sets.join(texts.hint("merge"), "fp").select("fp", "root", F.size("members").alias("size"), F.explode("members").alias("key"))
    common = each.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    own = each.join(common.hint("merge"), "key").groupBy("fp", "root", "size").agg(F.array_sort(F.collect_list(F.struct("held", "key"))).alias("order"))  # no longer than the text
    alone = F.col("size") - F.size("order")
    first = F.col("size") - F.ceil(F.col("size") * least - 1e-6).cast("int") + 1
    placed = own.select("fp", "root", "size", alone.alias("alone"), F.posexplode(F.slice("order", 1, F.greatest(first - alone, F.lit(0)))).alias("at", "x"))
    rarest = _mixed(placed.select("x.key", "fp", "root", "size", (F.col("size") - F.col("alone") - F.col("at")).alias("rest")))
    return rarest.join(sets.select("fp", "bits").hint("merge"), "fp").select("key", "fp", "root", "size", "rest", "bits")


def _mixed(buckets: DataFrame) -> DataFrame:
    """Buckets whose texts aren't of one component."""
    keys = buckets.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return buckets.join(keys.hint("merge"), "key")


class Texts(NamedTuple):
    """Columns of texts in buckets: fingerprints, components, sizes of sets, how much of them is left, and words of parities."""

    fps: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray
    rests: np.ndarray
    bits: np.ndarray

    def may_be_alike(self, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
        """Which pairs, of different components, the bounds on what two sets share leave in. None that is alike is left out."""
        sizes = self.sizes[i] + self.sizes[j]
        part = least / (1 + least)
        keep = (self.roots[i] != self.roots[j]) & (np.minimum(self.rests[i], self.rests[j]) >= part * sizes - 1e-6)
        at = np.flatnonzero(keep)
        for some in np.array_split(at, max(1, len(at) // 20_000)):
            apart = np.bitwise_count(self.bits[i[some]] ^ self.bits[j[some]]).sum(axis=1, dtype=np.int64)
            keep[some] = apart <= (1 - 2 * part) * sizes[some] + 1e-6
        return keep


def pairs_of_runs(texts: Texts, starts: np.ndarray, ends: np.ndarray, radius: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a run within the radius that may be alike."""
    n, fps = ends - starts, texts.fps
    small, left, right = n <= 64, [], []
    at = np.concatenate([np.zeros(0, np.int64), *[np.arange(i, j) for i, j in zip(starts[small], ends[small], strict=True)]])
    run = np.repeat(np.arange(small.sum()), n[small])
    for step in range(1, int(n[small].max(initial=0))):
        i, j = at[:-step], at[step:]
        met = (run[:-step] == run[step:]) & (np.bitwise_count(fps[i] ^ fps[j]) <= radius)
        left.append(i[met])
        right.append(j[met])
    for lo, hi in zip(starts[~small], ends[~small], strict=True):
        i, j = np.nonzero(np.triu(near_matrix(fps[lo:hi], radius), 1))
        keep = texts.may_be_alike(lo + i, lo + j, least)
        left.append(lo + i[keep])
        right.append(lo + j[keep])
    none = np.zeros(0, np.int64)
    left, right = np.concatenate([none, *left]), np.concatenate([none, *right])
    keep = texts.may_be_alike(left, right, least)
    return fps[left[keep]], fps[right[keep]]


def _pairs(buckets: DataFrame, radius: int, tile: int, least: float = LEAST) -> DataFrame:
    """All pairs (a, b) of a bucket's texts of different components that pairs_of_runs leaves in; without the columns of their sets, all within the radius. Each bucket must have several components.

    The largest component of a bucket isn't compared with itself: its tiles meet the tiles of all others, and those meet each other.
    """
    if "bits" not in buckets.columns:
        buckets = buckets.withColumns({"size": F.lit(1), "rest": F.lit(1), "bits": F.lit(b"\0" * 8)})
    sizes = buckets.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("all"))
    sizes = sizes.select("key", F.col("main.root").alias("main"), F.ceil(F.col("main.n") / tile).alias("mains"), F.ceil((F.col("all") - F.col("main.n")) / tile).alias("others"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    code = lambda i, j: i * (1 << 24) + j
    hashed = F.xxhash64("fp")
    of_main = F.transform(upto("others"), lambda j: code(F.pmod(hashed, "mains"), j))
    own = F.pmod(hashed, "others")
    of_other = F.transform(upto("mains"), lambda i: code(i, own))
    among = F.when(F.col("others") > 1, F.transform(upto("others"), lambda j: code(F.least(own, j), F.greatest(own, j)) + (1 << 48))).otherwise(F.array().cast("array<long>"))
    places = F.when(F.col("root") == F.col("main"), of_main).otherwise(F.concat(of_other, among))
    dealt = buckets.join(sizes.hint("merge"), "key").select("key", F.explode(places).alias("place"), "fp", "root", "size", "rest", "bits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(last: bool) -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            key, place = columns[:2]
            new = np.flatnonzero((key[1:] != key[:-1]) | (place[1:] != place[:-1])) + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(key)]])
            upto = len(starts) if last else len(starts) - 1  # the last run may go on in the next batch
            held[:] = [] if last else [tuple(x[starts[-1] :] for x in columns)]
            a, b = pairs_of_runs(Texts(columns[2].view(np.uint64), *columns[3:]), starts[:upto], ends[:upto], radius, least)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            held.append((*[c.to_numpy() for c in batch.columns[:-1]], bits))
            if sum(len(x[0]) for x in held) >= 100_000:
                yield flush(last=False)
        if held:
            yield flush(last=True)

    found = dealt.repartition("key", "place").sortWithinPartitions("key", "place", "fp").mapInArrow(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _sets(by_doc: DataFrame, rows: DataFrame, text: str, size: int) -> DataFrame:
    """(fp, members, bits): the whole shingle sets of the rows named, and their parities."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for _, texts in chunks(batch.column(1)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64())), pa.array([parities(x) for x in sets], pa.binary())], names=["fp", "members", "bits"])

    return by_doc.join(rows.hint("merge"), "row", "left_semi").select("fp", F.col(text).alias("text")).mapInArrow(cut, "fp long, members array<long>, bits binary")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose sets share at least that part of their union."""
    shared = F.size(F.array_intersect("of_a", "of_b"))
    sets = sets.select("fp", "members")
    both = pairs.join(sets.toDF("a", "of_a").hint("merge"), "a").join(sets.toDF("b", "of_b").hint("merge"), "b")
    return both.where(shared >= least * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")


def similar_groups(
    docs: DataFrame, carry: tuple[str, ...] = (), text: str = "text", shingle: int = SHINGLE, least: float = LEAST, radius: int = RADIUS, tile: int = TILE, stars: int = STARS
) -> DataFrame:
    """near_groups whose links are texts that share `least` of their different shingles (Jaccard).

    Texts meet in a bucket if all minima of a band agree; in a bucket, pairs whose fingerprints differ in more than
    radius bits are left out by the bit-sliced comparison, and the rest are links if their shingle sets, all of them,
    are alike enough. Texts with one fingerprint are alike without a look. Some rounds compare each text with one
    leader of its buckets, so that a large group of near copies becomes one component for about one comparison a
    member; then the texts of buckets that aren't joined yet meet under the rarest of their shingles, where all that are
    alike do, whatever their number. Pairs there are compared by bounds on what their sets can share, and those that are
    left by their sets. So no pair that meets is lost, and none is linked unverified. Nothing depends on the number of rows.
    Null texts are empty, and empty texts are alike; null doc_ids never name a component unless it has no other;
    repeated rows are kept; an empty table gives no rows; other columns are ignored.
    """
    if not carry:
        held = docs.select("doc_id", F.struct(F.col(text).alias("text")).alias("held"))
        return similar_groups(held, ("held",), "held.text", shingle, least, radius, tile, stars).drop("held")
    sketched = written(_sketches(docs, carry, text, shingle).withColumn("row", F.monotonically_increasing_id()), "sketches")
    by_doc = sketched.drop("keys")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("row").alias("c"), "keys")
    by_fp = written(sketched.groupBy("fp").agg(F.min(order).alias("least")), "distinct-sketches")
    spread = by_fp.select("fp", F.explode("least.keys").alias("key"))
    met = spread.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = spread.join(met.hint("merge"), "key")
    company = shared.groupBy("fp").agg(F.sum("members").alias("company"))
    buckets = written(shared.join(company.hint("merge"), "fp").select("key", "fp", F.col("fp").alias("root"), "company"), "buckets")
    in_buckets = buckets.select("fp").distinct()
    sets = written(_sets(by_doc, by_fp.join(in_buckets.hint("merge"), "fp").select(F.col("least.c").alias("row")), text, shingle), "sets")
    links = [buckets.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)]
    for turn in range(stars + 1):
        if buckets.isEmpty():
            break
        if turn < stars:
            pairs = written(_stars(buckets, turn, radius), "candidates")
        else:
            rarest = written(_rarest(buckets.select("fp", "root").distinct(), sets, least), "rarest")
            pairs = written(_pairs(rarest, radius, tile, least), "candidates")
            forget(rarest)
        found = written(_alike(pairs, sets, least), "verified")
        forget(pairs)
        links.append(found)
        if turn < stars:
            roots = written(roots_of(_union(links)), "roots")
            moved = buckets.drop("root").join(roots.toDF("fp", "root").hint("merge"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"), "company")
            left = written(_mixed(moved), "buckets")
            forget(buckets, roots)
            buckets = left
    forget(sets)
    return named_rows(by_doc, by_fp, _union(links), carry)


def _union(links: list[DataFrame]) -> DataFrame:
    out = links[-1]
    for more in links[1:-1]:
        out = out.unionAll(more)
    return out
