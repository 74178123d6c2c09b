"""Exact and near groups against brute force, with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcel_jobs.llm import similar, simhash
from parcel_jobs.llm.components import roots_of
from parcel_jobs.llm.exact_dedup import exact_groups

SCHEMA = "doc_id long, text string, gid long, row string, n int"


def table(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", None) for i, t in texts], SCHEMA)


def bodies():
    rng, long = random.Random(3), "word " * 9000
    base = [None, "", " \t\n", "a b", "ab", "a\tb ", "b", long, long + "x", long.replace(" ", "\n"), "é", "é", "x" * 64, "x" * 64, "x" * 65, "x" * 1088, "x" * 1089, "x" * 1088]
    base += [" ".join(rng.choice("pqrs") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    return [*enumerate(base), (3, "a b"), (None, "b"), (None, "nobody")]


def test_exact_groups(spark):
    texts = bodies()
    got = exact_groups(table(spark, texts)).collect()
    assert len(got) == len(texts)
    groups = {}
    for i, t in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    want = [(i, min(g := groups[n])[3], len(g), hashlib.sha256(n.encode()).hexdigest()) for i, t in texts for n in [re.sub(r"[\x20\x09-\x0D]", "", t or "")]]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=key) == sorted(want, key=key)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_groups_carry_and_empty(spark):
    docs = table(spark, bodies()).select(F.struct("*").alias("doc"), "doc_id")
    out = exact_groups(docs, carry=("doc",), text="doc.text").where("kept").select("doc.*")
    assert out.columns == ["doc_id", "text", "gid", "row", "n"] and out.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in bodies()})
    assert exact_groups(table(spark, [])).collect() == []


def slow_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [sum(xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def near_bodies():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(4)]
    out = [None, "", " \n", "ONE", "one two", "One TWO three", "Éa b c", "long " * 20_000]
    for b in base:
        for _ in range(12):
            w = b.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    return [*enumerate(out), (9, out[9]), (None, out[10]), (None, "alone here now")]


def test_near_groups(spark):
    texts = near_bodies()
    got = simhash.near_groups(table(spark, texts)).collect()
    fps = {i: slow_fingerprint(t) for i, t in enumerate(t for _, t in texts)}
    ids = [i for i, _ in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(texts)):
        least.setdefault(find(i), []).append(ids[i])
    least = {r: min((x for x in v if x is not None), default=None) for r, v in least.items()}
    want = sorted((ids[i] is None, ids[i] or 0, f"{fps[i]:016x}", least[find(i)] is None, least[find(i)] or 0) for i in range(len(texts)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"] is None, r["component_id"] or 0) for r in got) == want
    assert sum(r["first"] for r in got) == len(least)


def test_large_buckets_are_dealt_in_tiles(spark):
    rng = random.Random(1)
    fps = sorted({0x1234567800000000 ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)) for _ in range(400)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    tiled, whole = (sorted(map(tuple, roots_of(simhash.near_links(df, tile=t)).collect())) for t in (16, 1 << 20))
    assert tiled == whole and tiled


@pytest.mark.parametrize("n", [2, 3, 40, 64, 65, 300])
def test_bit_sliced_links(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 62, 3, dtype=np.uint64)
    fps = set()
    while len(fps) < n:
        x = int(base[rng.integers(3)])
        for _ in range(rng.integers(0, 6)):
            x ^= 1 << int(rng.integers(64))
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)

    def parts(links):
        label = {int(x): int(x) for x in fps}
        for _ in range(n):
            for a, b in links:
                label[int(a)] = label[int(b)] = min(label[int(a)], label[int(b)])
        return label

    brute = [(fps[i], fps[j]) for i in range(n) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 3]
    one, many = list(zip(*simhash.spanning_links(fps), strict=True)), list(zip(*simhash.links_of_runs(fps, np.array([0]), np.array([n])), strict=True))
    assert parts(brute) == parts(one) == parts(many) and len(one) < n
    assert all(bin(int(a ^ b)).count("1") <= 3 for a, b in one + many)


def test_roots_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    got = dict(map(tuple, roots_of(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 200}
    assert roots_of(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_radius_that_blocks_do_not_cover_is_an_error(spark):
    df = spark.createDataFrame([(0,), (0b1000000000000100000000000010000000000001,)], "fp long")
    with pytest.raises(ValueError):
        simhash.near_links(df, radius=4)


@pytest.mark.parametrize("radius", [0, 3, 7, 8, 15, 16, 21, 31])
def test_distances_up_to_thirty_one(radius):
    rng = np.random.default_rng(radius)
    fps = np.unique(np.concatenate([[np.uint64(0xABCDEF)], np.array([0xABCDEF ^ int(np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64))) for k in rng.integers(1, 40, 90)], np.uint64)]))
    planes = simhash._planes(fps, -(-len(fps) // 64) * 64)
    found = simhash._within(planes, simhash._all_ones(simhash._bits(fps)), radius)
    near = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")[:, : len(fps)]
    assert near.tolist() == [[int(bin(int(a ^ b)).count("1") <= radius) for b in fps] for a in fps]


def groups_of(n, alike):
    """Sets of indices that chains of alike pairs reach."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in alike:
        parent[find(i)] = find(j)
    out = {}
    for i in range(n):
        out.setdefault(find(i), set()).add(i)
    return sorted(map(sorted, out.values()))


def alike_pairs(texts, least=0.8):
    sets = [set(similar.shingles(t or "").tolist()) for t in texts]
    return [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]


def found_groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r["component_id"], []).append(r["doc_id"])
    return sorted(map(sorted, out.values()))


def test_similar_groups_equal_brute_force(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for base in range(12):  # copies with two of 300 words changed share nine tenths of their shingles, those with 30 changed a third
        b = [rng.choice(words) for _ in range(300)]
        for changed in (0, 0, 2, 2, 30):
            w = b.copy()
            for k in rng.sample(range(300), changed):
                w[k] = "other"
            texts.append(" ".join(w))
    texts += [None, "", "one two", "one two", "x " * 9000, "x " * 40, " ".join(f"v{i % 25_000}" for i in range(60_000)), " ".join(f"v{i % 25_000}" for i in range(70_000))]
    rows = [*enumerate(texts), (None, texts[0])]
    got = similar.similar_groups(table(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r["first"] for r in got) == len({r["component_id"] for r in got})
    assert found_groups(r for r in got if r["doc_id"] is not None) == groups_of(len(texts), alike_pairs(texts))
    assert next(r["component_id"] for r in got if r["doc_id"] is None) == min(i for i, t in enumerate(texts) if t == texts[0])
    assert similar.similar_groups(table(spark, [])).collect() == []


@pytest.mark.parametrize("least", [0.8, 0.85, 0.9])
def test_pairs_at_the_threshold_are_found(spark, least):
    rng = random.Random(int(least * 100))
    texts, n = [], 0
    while n < 150:  # pairs that differ in a run of words at the end and in single words, at or just over the threshold
        b = [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(60, 400))]
        w = b.copy()
        while True:
            nearer = w.copy()
            w[rng.randrange(len(w))] = "other"
            if not alike_pairs([" ".join(b), " ".join(w)], least):
                break
        if nearer != b and alike_pairs([" ".join(b), " ".join(nearer)], least):
            texts += [" ".join(b), " ".join(nearer)]
            n += 1
    got = {r["doc_id"]: r["component_id"] for r in similar.similar_groups(table(spark, enumerate(texts)), least=least).collect()}
    found = sum(got[2 * i] == got[2 * i + 1] for i in range(150))
    assert found >= 147, found
    assert all(got[2 * i] >= 2 * i for i in range(150))


@pytest.mark.parametrize("n", [65, 200, 2000])
def test_large_buckets_of_texts_that_only_chains_join(spark, n):
    """Windows that move on by a fixed step: only those close to each other are alike, and no leader is alike to all."""
    rng = random.Random(n)
    shared = " ".join(f"s{i}" for i in range(40))
    words = [f"w{rng.randrange(10**6)}" for _ in range(n * 3 + 100)]
    texts = [shared + " " + " ".join(words[3 * i : 3 * i + 60]) for i in range(n) if i % 37 != 5 and i % 37 != 6 and i % 37 != 7]
    got = similar.similar_groups(table(spark, enumerate(texts)), tile=64).collect()
    sets = [set(similar.shingles(t).tolist()) for t in texts]
    alike = [(i, j) for i in range(len(texts)) for j in range(max(0, i - 40), i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = groups_of(len(texts), alike)
    assert len(want) > 1 and max(map(len, want)) > 20
    found = found_groups(got)
    at = {i: k for k, g in enumerate(want) for i in g}
    assert all(len({at[i] for i in g}) == 1 for g in found)  # none is linked to what no chain reaches
    assert sum(len(g) - 1 for g in found) >= 0.98 * sum(len(g) - 1 for g in want)


def test_pairs_of_one_bucket_are_all_compared(spark):
    """Without stars: all pairs within the radius of different components, in tiles or not, by brute force."""
    rng = random.Random(4)
    fps = sorted({0x1234567812345678 ^ sum(1 << k for k in rng.sample(range(63), rng.randint(0, 9))) for _ in range(300)})
    roots = [0 if i % 3 else rng.randrange(1, 5) for i in range(len(fps))]
    df = spark.createDataFrame([(7, x, r) for x, r in zip(fps, roots, strict=True)], "key long, fp long, root long")
    want = sorted((a, b) for i, a in enumerate(fps) for j, b in enumerate(fps) if a < b and roots[i] != roots[j] and bin(a ^ b).count("1") <= 10)
    for tile in (16, 64, 4096):
        assert sorted(map(tuple, similar._pairs(df, 10, tile).collect())) == want


def test_sketch_counts_each_shingle_once():
    one, many = similar.sketch(similar.shingles("a b c d e f g " * 2)), similar.sketch(similar.shingles("a b c d e f g " * 50))
    assert one[0] == many[0] and (one[1] == many[1]).all() and len(set(one[1].tolist())) == similar.BANDS


def test_near_copies_that_are_not_alike_are_no_candidates(spark):
    """Texts of one model with changes of their own meet in buckets, within the radius, but bounds on what they share leave out all but those that are nearly alike."""
    rng = random.Random(8)
    model = [f"m{i}" for i in range(140)]
    texts = []
    for i in range(120):
        w = model.copy()
        for k in rng.sample(range(140), rng.choice((3, 4, 6))):
            w[k] = f"n{rng.randrange(200)}"
        texts.append(" ".join(w))
    sets = {x: similar.shingles(t) for t in texts for x in [int(np.uint64(similar.sketch(similar.shingles(t))[0]).view(np.int64))]}
    both = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    alike = {(a, b) for a in sets for b in sets if a < b and both(a, b) >= 0.8 * (len(sets[a]) + len(sets[b]) - both(a, b))}
    rows = [(fp, x.tolist(), similar.parities(x)) for fp, x in sets.items()]
    held = spark.createDataFrame(rows, "fp long, members array<long>, bits binary")
    met = similar._rarest(held.selectExpr("fp", "fp as root"), held, 0.8)
    for tile in (16, 1024):
        got = set(map(tuple, similar._pairs(met, 30, tile, 0.8).collect()))
        assert alike <= got and len(got) <= 2 * len(alike) + 20, (len(alike), len(got))
    a, b = rows[0], rows[1]
    apart = np.bitwise_count(np.frombuffer(a[2], np.uint64) ^ np.frombuffer(b[2], np.uint64)).sum()
    assert apart <= len(np.setxor1d(sets[a[0]], sets[b[0]]))
