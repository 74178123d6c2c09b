"""SimHash near-dedup: bit-sliced comparison of fingerprints in buckets of shared blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import roots_of
from .shared import chunks, forget, text_column, written

WORDS_A_SHINGLE, SEED, RADIUS = 3, 42, 3
#: Widths of the blocks of a fingerprint. Three bits lie in three blocks at most, so two of the five are equal.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints of a bucket that are compared in one task; larger buckets are dealt out as pairs of tiles.
TILE = 1024


def fingerprint(text: str, shingle: int = WORDS_A_SHINGLE) -> int:
    """A bit is 1 if set in over half of the XXH64 of the shingles, repeats included. Fewer words than a shingle has: all; none: 0."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # on bytes, this folds A-Z only and splits at white space of ASCII only
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    if n <= shingle:
        return xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=False)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = (), text: str = "text", shingle: int = WORDS_A_SHINGLE) -> DataFrame:
    """The carried columns, doc_id and fp (the 64 bits as a signed long) of each row of docs; null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for _, texts in chunks(text_column(batch, text)) for t in texts]
            kept = [i for i, name in enumerate(batch.schema.names) if name in (*carry, "doc_id")]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(np.array(fps, np.uint64).view(np.int64))], names=[*[batch.schema.names[i] for i in kept], "fp"])

    docs = docs.select(*carry, "doc_id", *([] if carry else [text]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in (*carry, "doc_id"))
    return docs.mapInArrow(run, f"{kinds}, fp long")


# Bit-sliced comparison. 64 fingerprints lie across one word: plane b holds bit b of each of them.


def _within(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Words [queries, W] with a bit for each member within the radius of the query.

    planes: [64, W] words. queries: [Q, 64] or, if each word has a query of its own, [Q, 64, W]; entries are 0 or all
    ones. Distances of all members grow at once in counters of three to five bits, held as carry-save words; a counter that
    overflows, or the radius + 1 at a check, stays out. Words in which all members are out are dropped on the way.
    """
    q, width = queries.shape[0], planes.shape[1]
    own = queries.ndim == 3
    out = np.zeros((q, width), np.uint64)
    at = np.arange(width)
    one = two = four = eight = sixteen = over = np.zeros((q, width), np.uint64)
    for b in range(64):
        differ = planes[b, at] ^ (queries[:, b, at] if own else queries[:, b, None])
        carry = one & differ
        one = one ^ differ
        carry, two = two & carry, two ^ carry
        carry, four = four & carry, four ^ carry
        if radius > 7:
            carry, eight = eight & carry, eight ^ carry
        if radius > 15:
            carry, sixteen = sixteen & carry, sixteen ^ carry
        over = over | carry
        if b % 16 == 15 and b < 63:
            keep = np.flatnonzero((_beyond((sixteen, eight, four, two, one), over, radius) != ~np.uint64(0)).any(axis=0))
            if len(keep) < len(at) // 2:
                at, over = at[keep], over[:, keep]
                one, two, four, eight, sixteen = (plane[:, keep] for plane in (one, two, four, eight, sixteen))
                if not len(at):
                    return out
    out[:, at] = ~_beyond((sixteen, eight, four, two, one), over, radius)
    return out


def _beyond(planes: tuple[np.ndarray, ...], over: np.ndarray, radius: int) -> np.ndarray:
    """Members whose counter exceeds a radius of 0 to 31: the counter's planes, highest first, are compared with it bit by bit."""
    greater, equal = over, ~over
    for bit, plane in zip((16, 8, 4, 2, 1), planes, strict=True):
        if radius & bit:
            equal = equal & plane
        else:
            greater, equal = greater | (equal & plane), equal & ~plane
    return greater


def _bits(fps: np.ndarray) -> np.ndarray:
    """[n, 64] of 0 and 1, bit b in column b."""
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _planes(fps: np.ndarray, lanes: int) -> np.ndarray:
    """[64, lanes / 64] planes of the fingerprints; the unused lanes hold zeros."""
    bits = np.zeros((lanes, 64), np.uint8)
    bits[: len(fps)] = _bits(fps)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _all_ones(bits: np.ndarray) -> np.ndarray:
    return np.where(bits != 0, ~np.uint64(0), np.uint64(0))


def near_matrix(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """[n, n] of whether two members of one run are within the radius."""
    n = len(fps)
    planes = _planes(fps, -(-n // 64) * 64)
    near = np.zeros((n, n), bool)
    for i in range(0, n, 64):
        found = _within(planes, _all_ones(_bits(fps[i : i + 64])), radius)
        near[i : i + 64] = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(len(found), -1), axis=1, bitorder="little")[:, :n]
    return near


def spanning_links(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the parts of one run of distinct fingerprints: as many as members at most, never all pairs."""
    n, near = len(fps), near_matrix(fps, radius)
    seen, a, b = np.zeros(n, bool), [], []
    for root in range(n):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(near[i] & ~seen)
            seen[new] = True
            a += [i] * len(new)
            b += new.tolist()
            stack += new.tolist()
    return fps[a], fps[b]


def links_of_runs(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of many runs. Runs of up to 64 members take a word each, so that one step serves all of them."""
    sizes, left, right = ends - starts, [], []
    for least, most in ((2, 2), (3, 4), (5, 8), (9, 16), (17, 32), (33, 64)):
        which = np.flatnonzero((sizes >= least) & (sizes <= most))
        for part in np.array_split(which, max(1, len(which) * most // 200_000)):
            if not len(part):
                continue
            member = starts[part][:, None] + np.minimum(np.arange(most), sizes[part][:, None] - 1)
            held = fps[member]  # [runs, most]; the last member is repeated
            bits = _bits(held.ravel()).reshape(len(part), most, 64)
            lanes = np.zeros((len(part), 64, 64), np.uint8)
            lanes[:, :most] = bits
            planes = np.ascontiguousarray(np.packbits(lanes.transpose(2, 0, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]
            for k in range(most - 1):
                found = _within(planes, _all_ones(bits[:, k].T)[None], radius)[0]
                hit = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :most].astype(bool)
                hit &= (np.arange(most) > k) & (np.arange(most) < sizes[part][:, None])
                run, j = np.nonzero(hit)
                left.append(held[run, k])
                right.append(held[run, j])
    for i in np.flatnonzero(sizes > 64):
        a, b = spanning_links(fps[starts[i] : ends[i]], radius)
        left.append(a)
        right.append(b)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def near_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (fp) which chains of steps within the radius connect.

    Fingerprints within three bits are equal in two of five blocks, so each of the ten pairs of blocks is a bucket's
    key of 25 or 26 bits. A bucket over `tile` members is dealt out as pairs of its tiles, which meet in tasks of their
    own; every pair of members meets once at least. Within a bucket only spanning links are returned. ValueError for
    a radius at which two blocks need not be equal.
    """
    if not 0 <= radius <= len(BLOCKS) - 2:
        raise ValueError(f"{len(BLOCKS)} blocks find all links up to a radius of {len(BLOCKS) - 2}, not of {radius}")
    low = np.cumsum((0, *BLOCKS))
    block = [F.shiftrightunsigned("fp", int(at)).bitwiseAND(F.lit((1 << w) - 1)) for at, w in zip(low, BLOCKS, strict=False)]
    keys = [F.shiftleft(block[i], 17).bitwiseOR(block[j]).bitwiseOR(F.lit(n << 32)) for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    return _bucket_links(fps, keys, radius, tile)


def _bucket_links(fps: DataFrame, keys: list, radius: int, tile: int) -> DataFrame:
    """Spanning links within the radius of all buckets, a bucket being the fingerprints (fp) that have one of the keys in common."""
    spread = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = written(spread.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > tile), "large-buckets")
    tiles = F.ceil(F.col("members") / tile)
    own = F.pmod(F.xxhash64("fp"), tiles)
    pair = F.transform(F.sequence(F.lit(0).cast("long"), tiles - 1), lambda other: F.least(own, other) * (1 << 24) + F.greatest(own, other))
    dealt = spread.join(large, "key", "left").select("fp", "key", F.explode(F.when(F.col("members").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pair)).alias("pair"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(last: bool) -> pa.RecordBatch:
            key, pair, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            new = np.flatnonzero((key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(key)]])
            upto = len(starts) if last else len(starts) - 1  # the last run may go on in the next batch
            held[:] = [] if last else [(key[starts[-1] :], pair[starts[-1] :], fp[starts[-1] :])]
            a, b = links_of_runs(fp, starts[:upto], ends[:upto], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in (0, 1)) + (batch.column(2).to_numpy().view(np.uint64),))
            if sum(len(x[0]) for x in held) >= 200_000:
                yield flush(last=False)
        if held:
            yield flush(last=True)

    return dealt.select("key", "pair", "fp").repartition("key", "pair").sortWithinPartitions("key", "pair", "fp").mapInArrow(link, "a long, b long")


def near_groups(docs: DataFrame, carry: tuple[str, ...] = (), text: str = "text", shingle: int = WORDS_A_SHINGLE) -> DataFrame:
    """The carried columns, doc_id, fingerprint (16 hex digits), component_id and first of each row of docs (doc_id, text).

    component_id is the least doc_id that links reach, links being fingerprints at three or fewer differing bits; copies
    share a fingerprint and meet as one member. What a bucket of m members over TILE costs grows with m * m / TILE. first is true for one row of a component, one with that doc_id. Texts
    without words have the fingerprint zero, which links like others. Null text is empty. Null doc_ids are rows of their
    component and never name it, unless it has no other. Repeated rows are kept. An empty table gives no rows; other
    columns are ignored. With carried columns, `text` names the text among them.
    """
    by_doc = written(fingerprints(docs, carry, text, shingle).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    by_fp = _distinct(by_doc)
    return named_rows(by_doc, by_fp, near_links(by_fp.select("fp")), carry)


def _distinct(by_doc: DataFrame) -> DataFrame:
    """Each fingerprint once, with the first of its rows: the least doc_id, nulls last."""
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("row").alias("c"))
    return written(by_doc.groupBy("fp").agg(F.min(order).alias("least")), "distinct-fingerprints")


def named_rows(by_doc: DataFrame, by_fp: DataFrame, links: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Rows with the name of their component, whose fingerprints the links join."""
    roots = written(roots_of(links), "roots")
    rooted = by_fp.join(roots.toDF("fp", "root").hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = written(rooted.groupBy("root").agg(F.min("least").alias("least")), "components")
    named = written(rooted.select("fp", "root").join(names.hint("merge"), "root").select("fp", F.col("least.b").alias("component_id"), F.col("least.c").alias("first")), "fingerprint-components")
    forget(by_fp, roots, names)
    out = by_doc.join(named.hint("merge"), "fp")
    return out.select(*carry, "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", (F.col("row") == F.col("first")).alias("first"))
