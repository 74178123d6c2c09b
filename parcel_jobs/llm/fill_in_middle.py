"""Fill-in-middle: a text is cut between units into prefix, middle and suffix, which a form puts in another order.

One fullmatch of (unit)* by the regex library keeps every repetition of the group, so `ends(1)` gives the number of units
and both cuts at once. Draws come from a keyed hash of the document's id, so a task that runs again cuts alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: White space, the marks of the three parts, the forms.
SPACE = r"\x20\x09-\x0D"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: A group that is atomic can be cut in one way alone, so matching is linear.
_UNITS = regex.compile(rf"((?>[{SPACE}]*[^{SPACE}]+|[{SPACE}]+))*")
#: Between what isn't white space and what is, a unit always ends.
_BREAK = regex.compile(rf"(?<=[^{SPACE}])[{SPACE}]")
_MARKS = regex.compile("<[PSM]>")


def unit_ends(text: str, span: int = 1_000_000) -> np.ndarray:
    """Where each unit of text ends.

    The library holds some millions of repetitions at most, so a text of more than `span` code points is matched in
    stretches that begin and end where units do: the ends are the same, and memory is bounded by the stretch.
    """
    if len(text) <= span:
        return np.array(_UNITS.fullmatch(text).ends(1), np.int64)
    parts, at = [], 0
    while at < len(text):
        cut = _BREAK.search(text, at + span) if at + span < len(text) else None
        stop = cut.start() if cut else len(text)
        parts.append(np.array(_UNITS.fullmatch(text, at, stop).ends(1), np.int64))
        at = stop
    return np.concatenate(parts)


@dataclass(frozen=True)
class Rates:
    """Of a hundred documents, those that are transformed, and of these, those in suffix-first form; and the hash's key."""

    fim: int = 50
    spm: int = 80
    key: str = "42"


@dataclass(frozen=True)
class Cut:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def transform(doc_id: object, text: str, rates: Rates = Rates(), span: int = 1_000_000) -> Cut:
    """text in its form. A text that is empty or holds a mark stays plain, so every output can be read back."""
    digest = hashlib.sha256(f"{rates.key}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    ends = unit_ends(text, span)
    n = len(ends)
    if not text or h3 % 100 >= rates.fim or _MARKS.search(text):
        return Cut(n, PLAIN, None, None, text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (i, j))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < rates.spm:
        return Cut(n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Cut(n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


def restore(output: str, form: str) -> str:
    """The text that was transformed. Marks share no beginning with an end, so none can arise where parts meet."""
    if form == PLAIN:
        return output
    first, second = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    head, _, middle = output.removeprefix(first).partition(MIDDLE)
    one, _, two = head.partition(second)
    prefix, suffix = (two, one) if form == SPM else (one, two)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, rates: Rates = Rates(), digests: bool = False, text: str = "text") -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n, form, prefix_chars, middle_chars, output.

    With digests, output_sha256 and restored_sha256 (of the text read back from output and form) stand in its place. Null
    and empty texts have no units and stay plain; a null doc_id is hashed as no digits. Repeated rows are transformed
    alike; an empty table gives no rows; other columns are ignored. No row meets another, so there is no shuffle, and a
    task holds the units of one stretch of a text at a time.
    """
    last = ("output_sha256", "restored_sha256") if digests else ("output",)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                cuts, ends = [], []
                for d, t in zip(part.column(0), part.column(1), strict=True):
                    c = transform(d.as_py(), t.as_py() or "", rates)
                    ends.append((sha(c.output), sha(restore(c.output, c.form))) if digests else (c.output,))
                    cuts.append((c.n, c.form, c.prefix_chars, c.middle_chars))
                n, form, prefix, middle = zip(*cuts, strict=True)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                columns += [pa.array(x, pa.string()) for x in zip(*ends, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *last])

    docs = docs.selectExpr("doc_id", f"{text} as text")
    kept = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, "
    return docs.mapInArrow(run, kept + ", ".join(f"{x} string" for x in last))


#: The cuts, both forms and the digests in SQL.
ORACLE = r"""
with d as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u from documents),
k as (
  select doc_id, text, u, len(u) as n, ('0x' || substr(h, 1, 8))::bigint % (len(u) + 1) as k1, ('0x' || substr(h, 9, 8))::bigint % (len(u) + 1) as k2,
    case when text = '' or regexp_matches(text, '<[PSM]>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 50 then 'plain'
         when ('0x' || substr(h, 25, 8))::bigint % 100 < 80 then 'spm' else 'psm' end as form from d),
p as (
  select *, array_to_string(u[1:least(k1, k2)], '') as prefix, array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') as middle,
    array_to_string(u[greatest(k1, k2) + 1:], '') as suffix from k)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from p
"""
