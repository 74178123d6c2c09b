"""Token files, packing and merge-dropout: exact against the libraries, and round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcel_jobs.llm import merge_dropout, packing
from parcel_jobs.llm.token_files import read_token_files, write_token_files
from parcel_jobs.llm.wordcache import WordBpe

BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "Hello, world. It's 5,000!", "<|endoftext|> x", "Ça va? İ, Σσς.", "日本語 text", "a\n\nb\tc  d", "long words here " * 3000, "x" * 3000, "...", "tie", "tie"]
SCHEMA = "doc_id long, text string, part string, start string"
odd = st.text(st.one_of(st.sampled_from("aBs ,.!'&$\n\t\x0b\x85\xa05éİΣ<|▁́ßµ²"), st.characters(exclude_categories=["Cs"])), max_size=60)


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def by_word():
    return WordBpe(BPE, cache_words=100)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(odd, max_size=4))
def test_words_give_the_ids_of_whole_texts(whole, by_word, texts):
    ids, at = by_word.encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def rows():
    ids = list(range(len(TEXTS)))
    random.Random(2).shuffle(ids)
    return [(i, TEXTS[i], "p", "s") for i in ids] + [(3, TEXTS[3], "p", "s"), (None, "no id", "p", "s")]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, whole):
    docs = spark.createDataFrame(rows(), SCHEMA)
    folder, index = write_token_files(docs.repartition(3), BPE, 2)
    got = sorted(read_token_files(folder, index, with_ids=True).collect(), key=lambda r: r["start"])
    want, at = [], 0
    for i, t, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), crc(ids), ids))
        at += len(ids)
    assert [tuple(r) for r in got] == want
    assert read_token_files(*write_token_files(spark.createDataFrame([], SCHEMA), BPE, 2)).collect() == []


def test_packing(spark, whole):
    got = packing.pack_documents(spark.createDataFrame(rows(), SCHEMA).repartition(2), BPE, 1, with_ids=True).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        assert crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    for i, t, *_ in rows():
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        copies = 2 if i == 3 else 1
        assert sorted(x for _, piece, _ in by_doc[i] for x in piece) == sorted(ids * copies) and {n for *_, n in by_doc[i]} == {len(ids)}
        if copies == 1:
            assert [x for _, piece, _ in sorted(by_doc[i]) for x in piece] == ids
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), BPE, 1).collect() == []


@settings(max_examples=60, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), max_size=60))
def test_windows(sizes):
    windows = packing.windows_of(sizes, 128)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes))) and all(sum(sizes[i] for i in w) <= 128 for w in windows)


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(1).integers(1, 512, 400).tolist()
    sums = [sum(sizes[i] for i in w) for w in packing.difference(sizes, 50)]
    assert max(sums) - min(sums) < 60


@pytest.fixture(scope="module")
def coders():
    return merge_dropout.MergeDropout(PIECES, 0.0, 1), merge_dropout.MergeDropout(PIECES, 0.4, 7), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def coded(coder, texts, draws):
    ids, at = coder.encode(pa.array(texts, pa.string()), draws)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def slow_cut(sp, shown, key, rate):
    """Merge the best pair of neighbours whose own draw does not skip it, again and again; in plain integers and strings."""
    golden, parts = 0x9E3779B97F4A7C15, [(i, i + 1) for i in range(len(shown))]
    text = shown.replace(" ", "▁")
    known = lambda a, b: sp.piece_to_id(text[a:b]) != sp.unk_id() and not sp.is_control(sp.piece_to_id(text[a:b])) and not sp.is_byte(sp.piece_to_id(text[a:b])) and "▁" not in shown[a:b]
    while True:
        best = None
        for (a, m), (_, b) in zip(parts, parts[1:], strict=False):
            if known(a, m) and known(m, b) and known(a, b):
                place = ((a << 42) ^ (m << 21) ^ b) * golden % 2**64
                if mixed(key ^ place) >= int(rate * 2**64):
                    best = min(filter(None, (best, (-sp.get_score(sp.piece_to_id(text[a:b])), a, m, b))))
        if not best:
            break
        _, a, m, b = best
        parts = [p for p in parts if p[0] not in (a, m)] + [(a, b)]
        parts.sort()
    return [i for a, b in parts for i in ([sp.piece_to_id(text[a:b])] if known(a, b) else [sp.piece_to_id(f"<0x{x:02X}>") for x in shown[a:b].encode()])]


def slow_dropout(sp, text, draw, seed, rate):
    own = mixed(draw % 2**64 ^ (seed * 0x9E3779B97F4A7C15) % 2**64)
    words = merge_dropout.MergeDropout.split(text) if text else []
    return [i for n, w in enumerate(words) for i in slow_cut(sp, w if w[:1] == "\n" else f" {w}", mixed((own + (n + 1) * 0x9E3779B97F4A7C15) % 2**64), rate)]


@settings(max_examples=150, deadline=None)
@given(text=odd)
def test_dropout(coders, text):
    plain, dropped, sp = coders
    if "▁" not in text and "\0" not in text:
        assert coded(plain, [text], [0])[0] == sp.encode(text)
    for draw in (0, 3):
        ids, at = dropped.encode(pa.array([text, "x", text]), [draw, 5, draw])
        assert dropped.decode(ids, at) == [text.encode(), b"x", text.encode()]
        assert ids[: at[1]].tolist() == ids[at[2] :].tolist() == slow_dropout(sp, text, draw, 7, 0.4)


def test_dropout_varies_and_skips(coders):
    plain, dropped, sp = coders
    words = [f"segmentation{w}" for w in ("s", "al", "ing", "wise", "free")]
    cuts = {tuple(coded(dropped, [" ".join(words)], [v])[0]) for v in range(4)}
    assert len(cuts) == 4 and all(len(c) >= len(coded(plain, [" ".join(words)], [0])[0]) for c in cuts)


def test_dropout_draws_each_occurrence(coders):
    dropped = coders[1]
    word = "segmentations"
    text = " ".join([word] * 400)
    cuts, own = set(), []
    for i in coded(dropped, [text], [5])[0]:
        own.append(i)
        if b"".join(dropped.bytes_of[x] for x in own) == f" {word}".encode():
            cuts.add(tuple(own))
            own = []
    assert not own and len(cuts) > 20
    assert len({tuple(coded(dropped, [word], [d])[0]) for d in range(400)}) > 20


@settings(max_examples=60, deadline=None)
@given(words=st.lists(st.sampled_from(["the", "tie", "houses", "a,", "▁x", "\t", "é日", "\nin", "x" * 30, "y" * 400, "segmentation", "", "walking" * 30]), min_size=1, max_size=40))
def test_words_in_a_run_are_cut_as_each_alone(coders, words):
    plain, dropped, sp = coders
    text = " ".join(words)
    got = coded(dropped, [text, None, text], [3, 9, 4])
    assert got[0] == slow_dropout(sp, text, 3, 7, 0.4) and got[1] == [] and got[2] == slow_dropout(sp, text, 4, 7, 0.4)
    if "▁" not in text:
        assert coded(plain, [text], [1])[0] == sp.encode(text)


def test_dropout_query(spark):
    docs = spark.createDataFrame([(*r, 0) for r in rows()], SCHEMA + ", ids int")
    got = merge_dropout.encode_with_dropout(docs, PIECES).collect()
    assert len(got) == len(rows()) and all(r["lossless"] for r in got) and all(crc(r["ids"]) == r["ids_crc32"] for r in got)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (0, 1)] == [0, 0]
    assert merge_dropout.encode_with_dropout(spark.createDataFrame([], SCHEMA), PIECES, with_ids=False).collect() == []


def test_token_files_of_text_ids_and_a_hot_id(spark, whole):
    texts = [(None if i % 2 else f"d{i % 3}", f"word {i % 7} and more") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder, index = write_token_files(docs.repartition(3), BPE, 2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.count() > 2  # half of the rows share the null id, and still no file holds half of the rows
    assert max(r["n_docs"] for r in index.collect()) < 200
    got = sorted(read_token_files(folder, index, with_ids=True, id_type="string").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in texts), key=lambda i: i or "")
    want = sorted(((i or "", whole.encode(t, add_special_tokens=False).ids + [2]) for i, t in texts))
    assert sorted((r["doc_id"] or "", r["ids"]) for r in got) == want


def test_padding_is_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack_documents(docs.coalesce(1), BPE, 1).groupBy("sequence_id").sum("length").collect()
    filled = [r["sum(length)"] for r in got]
    assert sum(filled) > 0.97 * 2048 * len(filled) and max(filled) <= 2048


def test_another_tokenizer_is_encoded_by_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, other = WordBpe(path), Tokenizer.from_file(path)
    ids, at = bpe.encode(pa.array(["It's  a Test", None, "ça va\n"]))
    assert not bpe.by_word and [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [other.encode(t).ids for t in ("It's  a Test", "", "ça va\n")]
