"""Cross-tokenizer alignment: the tokens of a text by a byte-level BPE (A) and by a SentencePiece BPE (B), in groups.

Cumulative ends of A's and of B's tokens go into two dictionaries, end to index. The ends that both key sets hold, in
order, cut the two id lists into groups, and the links of a group are its pairs of tokens whose bytes overlap.

Neither tokenizer joins characters across the start of a run of white space, or a letter and a mark after it
(`TwoTokenizers.by_unit` checks that of the files given), so a text is a row of units, cut there, whose tokens don't depend on their neighbours. The
distinct units of a run of texts are aligned once. Their links are counted for the run, added up over the corpus by
pair, and joined back to the run, so no document's links are ever shuffled one by one and no pair is ever broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .wordcache import TwoGenerations, runs_of

#: Unicode white space, as the byte-level tokenizer's pattern has it; that pattern; marks; B's sign for a space.
WHITE = r"\x{09}-\x{0D} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARKS = r"!-/:-@\[-`{-~"
SIGN = "\u2581"
LETTERS = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"
#: Stands between units while Arrow splits a text; a text that holds it is split by _CUT.
_BETWEEN = "\x01"
_BRACED = regex.compile(r"\\x\{(\w+)\}")
_WHITE, _LETTERS = (_BRACED.sub(lambda m: regex.escape(chr(int(m[1], 16))), x) for x in (WHITE, LETTERS))
_CUT = regex.compile(rf"(?<=[{_LETTERS}])(?=[{MARKS}])|(?<![{_WHITE}])(?=[{_WHITE}])", regex.V1)
#: Texts whose characters all libraries class alike.
_LATIN = regex.compile(r"[\x00-\u024F]*").fullmatch
#: Units of more characters are aligned each time they come.
LONG = 200
#: Before units that are encoded together or alone, so that none of them begins the text.
_LEAD = " a"


def byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes of Latin-1 stand for themselves, the others for what follows U+00FF."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: Of a unit: n_a, n_b, n_groups and its links as a << 32 | b, all in 64 bits, and its groups as text. Both are empty if it has no tokens.
Aligned = tuple[bytes, bytes]
NONE: Aligned = (b"", b"")


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Rows (index of A's token, index of B's token, end) of the ends that both hold, in order; indices count from 1."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return np.array([[index_a[e] for e in common], [index_b[e] for e in common], common], np.int64).T


class TwoTokenizers:
    """align(texts): what TwoTokenizers.units gives for the distinct units of a run, and where each text has which."""

    def __init__(self, byte_path: str, piece_path: str, cache_units: int = 60_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        alphabet = byte_of()
        shown = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(alphabet[c] for c in t) if set(t) <= alphabet.keys() else t.encode() for t in shown]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SIGN, " ").encode() for i, p in enumerate(pieces)]
        self.fast_a = self._fast_a(json.loads(self.a.to_str())["model"], set(alphabet))
        self.size_a, self.size_b = (np.array([len(x) for x in of], np.int64) for of in (self.bytes_a, self.bytes_b))
        every = [f"{i}{mark}" for n, marks in ((len(shown), ",|"), (len(pieces), ",;")) for i in range(n) for mark in marks]
        self.shown = pa.array(every, pa.large_string())
        self.by_unit = self._by_unit()
        #: White space that pieces hold behind other characters (a carriage return after a brace, say): no unit begins with it.
        self.inner = "".join(sorted({c for p in pieces for c in regex.findall(r"(?<=.)\s", p, regex.DOTALL)}))
        self.known = TwoGenerations(cache_units)

    def _fast_a(self, model: dict, alphabet: set[str]) -> Callable[[str], list[int]] | None:
        """A by the tiktoken library, whose ranks are A's ids if these follow the order of A's merges; for Latin texts."""
        import tiktoken

        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = {t: i for t, i in vocab.items() if set(t) <= alphabet}
        if sorted(plain.values()) != list(range(256 + len(merges))) or any(vocab.get(x + y) != i for i, (x, y) in enumerate(merges, 256)):
            return None
        ranks = {self.bytes_a[i]: i for i in plain.values()}
        return tiktoken.Encoding("A", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _by_unit(self) -> bool:
        """Whether units can be encoded apart: what makes it so is checked, and else whole texts are units."""
        from sentencepiece import sentencepiece_model_pb2 as pb2

        shown = lambda part: json.loads(part.__getstate__()) if part is not None else None
        pre = shown(self.a.pre_tokenizer) or {}
        model = pb2.ModelProto.FromString(self.b.serialized_model_proto())
        spec = model.normalizer_spec
        within = regex.compile(rf" |[^{SIGN}]{SIGN}|[{_LETTERS}][{MARKS}]").search
        return (
            self.a.normalizer is None and self.a.post_processor is None and type(self.a.model).__name__ == "BPE" and not self.a.model.dropout
            and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and all(t.special for t in self.a.get_added_tokens_decoder().values())
            and model.trainer_spec.model_type == model.trainer_spec.BPE and not model.trainer_spec.treat_whitespace_as_suffix
            and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
            and not any(p.type in (p.USER_DEFINED, p.UNUSED) or (p.type == p.NORMAL and within(p.piece)) for p in model.pieces)
        )

    def whole(self, text: str, lead: str = "") -> Aligned:
        """Of a text that begins with a space, encoded as a whole; of what follows lead, if the text begins with that."""
        return self._parts(text, [len(text[len(lead) :].encode())], len(lead.encode()), None)[0]

    def _parts(self, text: str, sizes: np.ndarray | list[int], skip: int, split: list[str] | None) -> list[Aligned]:
        """Of parts of a text, given their sizes in bytes. If tokens don't give back the text or end where parts end, each part for itself."""
        if self.fast_a and self.by_unit and _LATIN(text):
            a = np.array(self.fast_a(text), np.int64)
        else:
            a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text[1:], num_threads=1), np.int64)
        data = text.encode()
        right = b"".join(map(self.bytes_a.__getitem__, a.tolist())) == data == b"".join(map(self.bytes_b.__getitem__, b.tolist()))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        groups = common_ends(ends_a, ends_b)
        stops = skip + np.cumsum([0, *sizes])  # of the lead, then of parts
        at = np.searchsorted(groups[:, 2], stops)
        if not right or not np.array_equal(groups[np.minimum(at, len(groups) - 1), 2][not skip :], stops[not skip :]):
            return [NONE] if split is None else [self.whole(_LEAD + u, _LEAD) for u in split]
        of_parts = np.zeros((len(stops), 3), np.int64)  # tokens of A and B and groups before each stop
        of_parts[not skip :] = np.column_stack([groups[:, :2], np.arange(1, len(groups) + 1)])[at[not skip :]]
        # links: between two ends of either that follow one another, one token of each covers the bytes
        ends = np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]
        link_at = np.searchsorted(ends, stops, side="right")
        counts = np.diff(of_parts, axis=0)
        numbers = np.insert(links[link_at[0] :], np.repeat(link_at[:-1] - link_at[0], 3), counts.ravel()).tobytes()
        number_at = ((link_at - link_at[0] + 3 * np.arange(len(stops))) * 8).tolist()
        # text: a group's tokens of A come before its tokens of B, and each is shown with the mark that follows it
        where_a = np.arange(len(a)) + np.concatenate([[0], groups[:, 1]])[np.searchsorted(groups[:, 0], np.arange(1, len(a) + 1))]
        where_b = np.arange(len(b)) + groups[:, 0][np.searchsorted(groups[:, 1], np.arange(1, len(b) + 1))]
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[groups[:, 0] - 1], last_b[groups[:, 1] - 1] = True, True
        shown = np.empty(len(a) + len(b), np.int64)
        shown[where_a], shown[where_b] = 2 * a + last_a, 2 * (len(self.size_a) + b) + last_b
        text_of = self.shown.take(pa.array(shown))
        _, offsets, chars = text_of.buffers()
        text_at = np.frombuffer(offsets, np.int64)[: len(shown) + 1][of_parts[:, 0] + of_parts[:, 1]].tolist()
        chars = chars.to_pybytes()
        return [(numbers[i:j], chars[k:m]) for i, j, k, m in zip(number_at, number_at[1:], text_at, text_at[1:], strict=False)]

    def units(self, units: list[str]) -> list[Aligned]:
        """Of units, or of whole texts if units can't be encoded apart."""
        if not self.by_unit:
            return [self.whole(u) if u else NONE for u in units]
        out = [NONE] * len(units)
        held = pa.array(units, pa.string())
        alone, marked, latin = (
            pc.match_substring_regex(held, x).to_numpy(zero_copy_only=False) for x in (rf"\A[^{WHITE}{MARKS}]|\s\z|[{WHITE}]\z", f"\\A[{MARKS}]", r"\A[\x00-\x{24F}]*\z")
        )
        size = pc.utf8_length(held).to_numpy()
        alone = (alone | (size > LONG)) & (size > 0)
        for i in np.flatnonzero(alone).tolist():
            out[i] = self.whole(_LEAD + units[i], _LEAD)
        for of_kind in (latin, ~latin):
            for behind in (marked, ~marked):
                every = np.flatnonzero(of_kind & behind & ~alone & (size > 0)).tolist()
                for start in range(0, len(every), 2000):
                    some = every[start : start + 2000]
                    split = [units[i] for i in some]
                    if behind is marked:  # a mark stands behind a letter
                        split = [x for u in split for x in (_LEAD, u)]
                    parts = self._parts(_LEAD + "".join(split), pc.binary_length(pa.array(split)).to_numpy(), len(_LEAD), split)
                    for i, x in zip(some, parts[1::2] if behind is marked else parts, strict=True):
                        out[i] = x
        return out

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(n + 1 offsets, units) of texts without nulls, each with a space before it."""
        led = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
        if not self.by_unit:
            return np.arange(len(texts) + 1), led
        if pc.any(pc.match_substring(texts, _BETWEEN)).as_py():
            lists = [self._split(t) for t in led.to_pylist()]
            return np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.array([u for x in lists for u in x], pa.string())
        cut = pc.replace_substring_regex(led, f"([{WHITE}]+)", _BETWEEN + r"\1")
        for c in self.inner:
            cut = pc.replace_substring(cut, _BETWEEN + c, c)
        cut = pc.replace_substring_regex(cut, f"([{LETTERS}])([{MARKS}])", rf"\1{_BETWEEN}\2")
        lists = pc.split_pattern(cut, _BETWEEN)
        at = lists.offsets.to_numpy()
        return at - at[0], lists.flatten()  # the first unit of each text is empty and counts for nothing

    def _split(self, text: str) -> list[str]:
        out: list[str] = []
        for u in _CUT.split(text):
            if u and u[0] in self.inner:
                out[-1] += u
            else:
                out.append(u)
        return out

    def align(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[Aligned], np.ndarray]:
        """(n + 1 offsets, index of each unit, Aligned of each distinct unit, whether it has no tokens though it should)."""
        at, units = self.split(texts)
        coded = units.dictionary_encode()
        distinct, sizes = coded.dictionary.to_pylist(), pc.utf8_length(coded.dictionary).to_numpy()
        is_long = np.flatnonzero(sizes > LONG).tolist()
        known = self.known.hold(set(distinct) - {distinct[i] for i in is_long}, self.units)
        long = dict(zip(is_long, self.units([distinct[i] for i in is_long]), strict=True))  # those aren't kept
        aligned = [long.get(i) or known[u] for i, u in enumerate(distinct)] if long else list(map(known.__getitem__, distinct))
        return at, coded.indices.to_numpy(), aligned, (sizes > 0) & np.array([not x[1] for x in aligned], bool)


_OPEN: dict[tuple, TwoTokenizers] = {}


def two_tokenizers(byte_path: str, piece_path: str) -> TwoTokenizers:
    """One for each Python worker and pair of files; it stays warm from task to task."""
    key = (byte_path, piece_path)
    if key not in _OPEN:
        _OPEN[key] = TwoTokenizers(*key)
    return _OPEN[key]


def sums(values: np.ndarray, index: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[index] between successive offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(values[index], dtype=np.int64)])[at])


def packed(values: np.ndarray) -> bytes:
    """32-bit numbers as their count and a Zstandard frame of their bytes, those of the lowest order first."""
    planes = values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


#: A run of documents: what is known of each, and the units of those with tokens in a row; of each unit, its links by the index of their
#: pair; of each pair, ids and number of links in the run.
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_RUN = "run string, doc_id array<{}>, " + ", ".join(f"{c} array<long>" for c in _COUNTS) + ", sha array<string>, unit_at binary, units binary, link_at binary, links binary, a array<int>, b array<int>, n array<long>"


def run_of(two: TwoTokenizers, texts: pa.Array) -> dict[str, np.ndarray | list]:
    """The columns of one run of texts, but for its name and doc_ids."""
    texts = pc.fill_null(texts, "")
    at, index, distinct, bad = two.align(texts)
    good = (pc.binary_length(texts).to_numpy() > 0) & (sums(bad, index, at) == 0)
    held = np.repeat(good, np.diff(at))
    index = index[held]
    at = np.concatenate([[0], np.cumsum(np.diff(at) * good)])
    used, index = np.unique(index, return_inverse=True)
    distinct = [distinct[i] for i in used.tolist()]
    out: dict[str, np.ndarray | list] = {}
    numbers = np.frombuffer(b"".join([x for x, _ in distinct]), np.int64)
    size = np.array([len(x) for x, _ in distinct], np.int64) // 8
    heads = (np.cumsum(size) - size)[size > 0][:, None] + np.arange(3)  # an empty unit has no numbers
    of_unit = np.zeros((len(distinct), 3), np.int64)
    of_unit[size > 0] = numbers[heads]
    n_links = np.maximum(size - 3, 0)
    for name, values in zip(_COUNTS, [*of_unit.T, n_links], strict=True):
        out[name] = sums(values, index, at)
    shown = pa.array([x for _, x in distinct], pa.large_binary()).take(pa.array(index))  # the groups of all documents, one after the other
    _, ends, data = shown.buffers()
    ends = np.frombuffer(ends, np.int64)[shown.offset : shown.offset + len(shown) + 1][at] if len(shown) else np.zeros(len(at), np.int64)
    view = memoryview(data) if data is not None else memoryview(b"")
    out["sha"] = [hashlib.sha256(view[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends.tolist(), ends.tolist()[1:], strict=False)]
    is_link = np.ones(len(numbers), bool)
    is_link[heads] = False
    pairs, links = np.unique(numbers[is_link], return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, links, np.repeat(np.bincount(index, minlength=len(used)), n_links))
    out |= {"unit_at": at, "units": index, "link_at": np.concatenate([[0], np.cumsum(n_links)]), "links": links, "a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "n": n}
    return out


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", run_bytes: int = 2_000_000) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Tokens are those of a space and the text, of whole texts, without special tokens. A text that is null or empty, or that one of
    the tokenizers doesn't give back byte by byte (B turns its sign for a space into a space), has none: its numbers are zero, its digest is
    empty, and it adds to no count. A pair's count is the number of links of the corpus that hold it; n_best are the links whose
    count is the highest of their B id, ties included; count_sum adds up the counts of all links. Repeated rows count each; a
    null doc_id is one like others; an empty table gives no rows; other columns are ignored.

    Runs of about run_bytes of text are written first, with the distinct pairs of each. Their counts are added in partial
    sums, and come back to the runs by joins whose large partitions Spark may split: a row moved is one distinct pair of a run. One
    text that is longer is a run alone, so memory grows with the longest text.
    """
    docs = docs.selectExpr("doc_id", f"{text} as text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    inner = ("unit_at", "units", "link_at", "links")
    as_list = {**dict.fromkeys(_COUNTS, pa.list_(pa.int64())), "n": pa.list_(pa.int64()), "sha": pa.list_(pa.string())}

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        two, part, seen = two_tokenizers(byte_path, piece_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, texts in runs_of(batch.column(1), run_bytes):
                out = run_of(two, texts)
                ids = batch.column(0).slice(start, len(texts))
                columns = {"run": pa.array([f"{part}-{seen}"]), "doc_id": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids]))}
                columns |= {k: pa.array([packed(v)], pa.binary()) if k in inner else pa.array([v], as_list.get(k, pa.list_(pa.int32()))) for k, v in out.items()}
                yield pa.RecordBatch.from_pydict(columns)
                seen += 1

    table = written(docs.mapInArrow(runs, _RUN.format(id_type)), "aligned-runs")
    pairs = table.select("run", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "pair")).select("run", "at", "pair.a", "pair.b", "pair.n")
    counts = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    judged = counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))
    of_run = pairs.join(judged.hint("merge"), ["a", "b"]).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("judged"))
    both = table.drop("a", "b", "n").join(of_run.hint("merge"), "run", "left")
    both = both.select("doc_id", *_COUNTS, "sha", *inner, F.col("judged.count").alias("count"), F.col("judged.best").alias("best"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: column[i].as_py() if name in inner else column[i].values for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                ids = row["doc_id"]
                at, units, link_at, link = (unpacked(row[c]) for c in inner)
                count, best = (np.zeros(0, np.int64) if row[c] is None else row[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("count", "best"))
                whole = [sums(sums(values, link, link_at), units, at) for values in (best, count)]
                columns = [ids, *(row[c] for c in _COUNTS), *(pa.array(x, pa.int64()) for x in whole), row["sha"]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    kept = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
    return both.mapInArrow(documents, kept)
