"""Alignment against whole texts, all pairs of byte ranges, and counts kept in one dictionary."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcel_jobs.llm.token_alignment import TwoTokenizers, align_tokens, run_of

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = list("abeth'sS ,.!?\n\t\r\x0b\x0c\x00\x01\x1c\x1f\x85\xa0   　​́éß中日😀▁<>|1290") + ["{\r", ";\r\n", "<|endoftext|>", " the", "  ", "<s>", "'re", "<0x41>"]
TEXTS = st.lists(st.sampled_from(ODD), max_size=25).map("".join)


@pytest.fixture(scope="module")
def two():
    return TwoTokenizers(A, B)


def spans(sizes):
    out, at = [], 0
    for n in sizes:
        out.append((at, at + n))
        at += n
    return out


def slow(two, text):
    """(ids of A, ids of B, groups, links) of a whole text, by the definition."""
    if not text:
        return None
    a = two.a.encode(" " + text, add_special_tokens=False).ids
    b = two.b.encode(text)
    bytes_a, bytes_b = [two.bytes_a[i] for i in a], [two.bytes_b[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    at_a, at_b = spans(map(len, bytes_a)), spans(map(len, bytes_b))
    ends = sorted({y for _, y in at_a} & {y for _, y in at_b})
    groups = []
    for lo, hi in zip([0, *ends], ends, strict=False):
        groups.append(tuple(",".join(str(i) for i, (x, _) in zip(ids, at, strict=True) if lo <= x < hi) for ids, at in ((a, at_a), (b, at_b))))
    links = [(i, j) for i, (p, q) in zip(a, at_a, strict=True) for j, (r, s) in zip(b, at_b, strict=True) if max(p, r) < min(q, s)]
    return a, b, ";".join("|".join(g) for g in groups), links


def slow_corpus(two, texts):
    found = [slow(two, t) for t in texts]
    count = Counter(pair for f in found if f for pair in f[3])
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    for f in found:
        if f is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            a, b, groups, links = f
            yield len(a), len(b), groups.count(";") + 1, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(groups.encode()).hexdigest()


def test_tokenizers_are_encoded_by_units(two):
    assert two.by_unit


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_units_give_the_tokens_of_whole_texts(two, text):
    import pyarrow as pa

    got = run_of(two, pa.array([text]))
    (want,) = slow_corpus(two, [text])
    assert (*(int(got[c][0]) for c in ("n_a", "n_b", "n_groups", "n_links")), got["sha"][0]) == (*want[:4], want[6])


@pytest.mark.parametrize("run_bytes", [1, 300, 2_000_000])
def test_corpus_against_brute_force(spark, two, run_bytes):
    rng = __import__("random").Random(7)
    texts = ["".join(rng.choices(ODD, k=rng.randrange(60))) for _ in range(150)]
    texts += ["the cat sat on the unbelievable mat", "the cat sat on the unbelievable mat", "", "▁", "x" * 500 + " antidisestablishmentarianism " * 9, " ", "\n"]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "the mat", 1), (5, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int").repartition(3)
    got = sorted((tuple(r) for r in align_tokens(docs, A, B, run_bytes=run_bytes).collect()), key=repr)
    want = sorted(((d, *x) for (d, _, _), x in zip(rows, slow_corpus(two, [t or "" for _, t, _ in rows]), strict=True)), key=repr)
    assert got == want


def test_tokenizer_files_that_join_units_are_encoded_whole(two):
    import pyarrow as pa

    other = TwoTokenizers(A, B)
    other.by_unit = False
    texts = ["some text,\n  of words", "", "<|endoftext|> ▁", "déjà vu"]
    assert [run_of(other, pa.array(texts))[c] if c == "sha" else run_of(other, pa.array(texts))[c].tolist() for c in ("n_a", "n_links", "sha")] == [
        run_of(two, pa.array(texts))[c] if c == "sha" else run_of(two, pa.array(texts))[c].tolist() for c in ("n_a", "n_links", "sha")
    ]


def test_empty_table(spark):
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
