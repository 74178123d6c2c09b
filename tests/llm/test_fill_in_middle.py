"""Fill-in-middle against a loop over units, and exact round trips."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcel_jobs.llm.fill_in_middle import PLAIN, PSM, SPM, Rates, fill_in_middle, restore, transform, unit_ends

LOOP = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ALL = Rates(fim=100)
TEXTS = st.text(alphabet=list(" \t\n\x0bab<>PSM é 😀"), max_size=60)


def slow(doc_id, text, fim=50, spm=80):
    units = LOOP.findall(text)
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= fim:
        return len(units), "plain", None, None, text
    i, j = sorted([h1 % (len(units) + 1), h2 % (len(units) + 1)])
    p, m, s = ("".join(x) for x in (units[:i], units[i:j], units[j:]))
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(-5, 10**12))
def test_equals_a_loop_over_units_and_comes_back(text, doc_id):
    c = transform(doc_id, text, ALL)
    assert (c.n, c.form, c.prefix_chars, c.middle_chars, c.output) == slow(doc_id, text, 100)
    assert restore(c.output, c.form) == text


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_stretches_give_the_same_ends(text, span):
    assert unit_ends(text, span).tolist() == [m.end() for m in LOOP.finditer(text)]


@pytest.mark.parametrize("form", [PSM, SPM])
def test_parts_that_look_like_pieces_of_marks(form):
    text = "<P <S M> < P> <M"
    rates = Rates(fim=100, spm=100 if form == SPM else 0)
    for doc_id in range(200):
        c = transform(doc_id, text, rates)
        assert c.form == form and restore(c.output, c.form) == text


def test_one_very_long_text():
    text = "ab \n" * 3_000_000
    ends = unit_ends(text)
    assert len(ends) == 3_000_001 and ends[0] == 2 and ends[-1] == len(text)
    assert unit_ends("x" * 3_000_000).tolist() == [3_000_000] and unit_ends(" " * 3_000_000).tolist() == [3_000_000]


def test_odd_rows(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, " \n ", "u"), (None, "a b c", "u"), (4, "<S> b", "u"), (5, "a b c d", "u"), (5, "a b c d", "u"), (6, "word " * 50_000, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = sorted(fill_in_middle(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want = [("" if d is None else d, t or "") for d, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))]
    assert [tuple(r)[1:] for r in got] == [slow(d, t) for d, t in want]
    digests = {r.doc_id: r for r in fill_in_middle(docs, digests=True).collect()}
    assert digests[6].restored_sha256 == hashlib.sha256(("word " * 50_000).encode()).hexdigest()
    assert fill_in_middle(docs.limit(0)).count() == 0
