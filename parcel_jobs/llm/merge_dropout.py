"""SentencePiece encoding and decoding with seeded merge-dropout.

BPE merges the best-scored pair of neighbours, the leftmost of equals, until none is in the vocabulary. With dropout, a
candidate that comes up on the agenda is skipped if a keyed hash of it falls below the rate: the key is the seed, the
document, the word's position in it and the candidate's place in the word, so each occurrence of a word is drawn for
itself, a run can be repeated and another seed cuts words otherwise. All cuts of a text decode to the text.

For each distinct word of a run of texts the agenda without dropout is known, with the candidates that come up on it. An
occurrence that skips none of them is cut alike; every other occurrence is merged for itself, by its own draws. Words are
merged side by side in numpy, long ones by a priority queue.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .wordcache import TwoGenerations, runs_of

SPACE = "▁"
NO_PAIR = np.int32(2**31 - 1)
#: Longer words take the agenda one by one; shorter ones are merged side by side.
LONG = 192
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: each bit of the result depends on all of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] numbers, then those of starts[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class PairTable:
    """Pairs of ids that merge: an open hash table, looked up for many pairs at once."""

    def __init__(self, pairs: dict[tuple[int, int], int], rank_of: dict[int, int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks, self.merged = np.full(1 << self.bits, NO_PAIR, np.int32), np.zeros(1 << self.bits, np.int32)
        for (a, b), m in pairs.items():
            key = (a << 32) | b
            at = int(self._slot(np.array([key], np.int64))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ranks[at], self.merged[at] = key, rank_of[m], m

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * GOLDEN) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; one with rank NO_PAIR if it is not in the table. Negative ids are in no pair."""
        key = (left.astype(np.int64) << 32) | right
        at = self._slot(key)
        held = self.keys[at]
        going = np.flatnonzero((held != key) & (held >= 0))
        while len(going):
            at[going] = (at[going] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[going]]
            going = going[(held != key[going]) & (held >= 0)]
        return at


class MergeDropout:
    """Encoder and decoder of one SentencePiece BPE model; rate 0 gives the model's own ids."""

    def __init__(self, model_file: str, rate: float, seed: int, cache_words: int = 200_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        if n > 1 << 16:
            raise ValueError("vocabularies over 65536 pieces are not supported")
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = [b""] * n
        for p, i in self.ids.items():
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_id):
            self.bytes_of[i] = bytes([b])
        self.pieces = pa.array(self.bytes_of, pa.large_binary())
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("pieces that span words are not supported")
        ranked = sorted(normal, key=lambda i: -sp.get_score(i))
        rank, last = {}, None
        for i in ranked:  # equal scores have equal ranks
            rank[i] = rank[last] if last is not None and sp.get_score(i) == sp.get_score(last) else len(rank)
            last = i
        self.table = PairTable({(self.ids[p[:k]], self.ids[p[k:]]): i for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}, rank)
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1 and p != SPACE:  # a mark that is text itself goes by its bytes, so that it decodes
                self.char[ord(p)] = i
        self.char[ord(" ")] = self.ids[SPACE]
        self.below, self.seed, self.size = np.uint64(min(int(rate * 2**64), 2**64 - 1)), seed, n
        self.plain = TwoGenerations(cache_words)  # word: its ids without dropout, hashed places of the candidates that come up

    @staticmethod
    def _place(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ((start.astype(np.uint64) << np.uint64(42)) ^ (middle.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)) * GOLDEN

    def agenda(self, symbols: list[int], key: int | None) -> list[tuple[int, int, int]]:
        """(id, start, end) of one word's pieces by a priority queue of candidates; without a key none is skipped."""
        n = len(symbols)
        ids, ends, before, after, heap = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1], []
        one = lambda x: np.array([x], np.int64)

        def push(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j < 0 or ids[i] < 0 or ids[j] < 0:
                return
            slot = int(self.table.find(one(ids[i]), one(ids[j]))[0])
            rank = int(self.table.ranks[slot])
            if rank != NO_PAIR and not (key is not None and _mixed(np.array([key], np.uint64) ^ self._place(one(i), one(j), one(ends[j])))[0] < self.below):
                heapq.heappush(heap, (rank, i, j, ends[i], ends[j], int(self.table.merged[slot])))

        for i in range(n):
            push(i)
        while heap:
            _, i, j, e, f, merged = heapq.heappop(heap)
            if ends[i] != e or ends[j] != f or after[i] != j:
                continue
            ids[i], ends[i], after[i], ends[j] = merged, f, after[j], -1
            if after[j] >= 0:
                before[after[j]] = i
            push(before[i])
            push(i)
        return [(ids[i], i, ends[i]) for i in range(n) if ends[i] > i]

    def _side_by_side(self, symbols: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """The same for many words, a row each: ids at the first character of each piece, and where those are.

        Symbols are linked lists in flat arrays, so a round touches the best pair of each row and its two neighbours.
        Without keys nothing is skipped, and (row, hashed place) of all candidates that came up are returned as well.
        """
        w, width = symbols.shape
        none = w * width  # the place that stands for no neighbour
        ids = np.append(symbols.ravel(), np.int32(-1))
        place = np.arange(none, dtype=np.int32)
        row_of = np.repeat(np.arange(w, dtype=np.int32), width)
        column = np.append(place - row_of * np.int32(width), np.int32(0))
        size = lengths.astype(np.int32)
        inside = column[:none] < size[row_of]
        more = column[:none] + 1 < size[row_of]
        after = np.append(np.where(more, place + 1, none), none).astype(np.int32)
        before = np.append(np.where(column[:none] > 0, place - 1, none), none).astype(np.int32)
        ranks, merged = np.full(none + 1, NO_PAIR, np.int32), np.zeros(none + 1, np.int32)
        seen_rows, seen_places = [], []

        def consider(p: np.ndarray, r: np.ndarray) -> None:
            q = after[p]
            slot = self.table.find(ids[p], ids[q])
            rank = self.table.ranks[slot]
            rank[(ids[p] < 0) | (ids[q] < 0)] = NO_PAIR
            some = np.flatnonzero(rank != NO_PAIR)
            ps, qs, rs = p[some], q[some], r[some]
            end = after[qs]
            here = self._place(column[ps], column[qs], np.where(end == none, size[rs], column[end]))
            if keys is None:
                seen_rows.append(rs)
                seen_places.append(here)
            else:
                rank[some[_mixed(keys[rs] ^ here) < self.below]] = NO_PAIR
            ranks[p], merged[p] = rank, self.table.merged[slot]

        consider(place[inside], row_of[inside])
        rows, table = np.arange(w, dtype=np.int32), ranks[:none].reshape(w, width)
        while len(rows):
            held = table[rows]
            best = held.argmin(axis=1).astype(np.int32)
            going = held[np.arange(len(rows)), best] != NO_PAIR
            rows = rows[going]
            if not len(rows):
                break
            p = rows * np.int32(width) + best[going]
            q = after[p]
            ids[p], ranks[q], inside[q] = merged[p], NO_PAIR, False
            after[p] = after[q]
            before[after[p]] = p
            b = before[p]
            left = b != none
            consider(np.concatenate([p, b[left]]), np.concatenate([rows, rows[left]]))
        found = (np.concatenate(seen_rows), np.concatenate(seen_places)) if keys is None else (rows, np.zeros(0, np.uint64))
        return ids[:none].reshape(w, width), inside.reshape(w, width), found

    def _cut(self, shown: list[str], symbols: np.ndarray, starts: np.ndarray, which: np.ndarray, keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cuts of the words numbered which, in that order: ids of all, sizes; and without keys the places of candidates, sizes.

        shown are the distinct words, symbols those of all of them, starts where each one's begin, and the end.
        """
        n = np.diff(starts)[which]
        order = np.argsort(n, kind="stable")
        cuts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (rows, sizes, ids)
        places: list[tuple[np.ndarray, np.ndarray]] = []
        short = order[: np.searchsorted(n[order], LONG, side="right")]
        for part in np.array_split(short, max(1, int(n[short].sum()) // 60_000)):
            if not len(part):
                continue
            size, width = n[part], int(n[part].max())
            at = np.minimum(starts[which[part]][:, None] + np.arange(max(width, 1)), len(symbols) - 1)
            table = np.where(np.arange(max(width, 1)) < size[:, None], symbols[at], np.int32(-1)).astype(np.int32)
            ids, alive, (r, found) = self._side_by_side(table, size, None if keys is None else keys[part])
            odd = (alive & (ids < 0)).any(axis=1)
            for k in np.flatnonzero(odd).tolist():
                at = [*np.flatnonzero(alive[k]).tolist(), int(size[k])]
                cut = self._with_bytes(shown[which[part[k]]], [(int(ids[k, a]), a, b) for a, b in zip(at, at[1:], strict=False)])
                cuts.append((part[k : k + 1], np.array([len(cut)]), cut))
            even = np.flatnonzero(~odd)
            cuts.append((part[even], alive[even].sum(axis=1), ids[even][alive[even]].astype("<u2")))
            places.append((part[r], found))
        for i in order[len(short) :].tolist():
            w = which[i]
            cut = self._with_bytes(shown[w], self.agenda(symbols[starts[w] : starts[w + 1]].tolist(), None if keys is None else int(keys[i])))
            cuts.append((np.array([i]), np.array([len(cut)]), cut))
        sizes = np.zeros(len(which), np.int64)
        held = np.concatenate([np.zeros(0, "<u2"), *[x for *_, x in cuts]])
        at, begin = 0, np.zeros(len(which), np.int64)
        for rows, counts, ids in cuts:
            sizes[rows], begin[rows] = counts, at + np.cumsum(counts) - counts
            at += len(ids)
        rows, found = (np.concatenate([np.zeros(0, t), *x]) for x, t in zip(zip(*places, strict=True), (np.int64, np.uint64), strict=True)) if places else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        by_row = np.argsort(rows, kind="stable")
        return held[_ragged(begin, sizes)], sizes, found[by_row], np.bincount(rows, minlength=len(which))

    def _with_bytes(self, shown: str, pieces: list[tuple[int, int, int]]) -> np.ndarray:
        ids: list[int] = []
        for i, start, end in pieces:
            ids += [i] if i >= 0 else [self.byte_id[b] for b in shown[start:end].encode()]
        return np.array(ids, "<u2")

    @staticmethod
    def split(text: str) -> list[str]:
        """Words that no piece spans, in order; each but those that begin with a line break has a space before it."""
        if "  " not in text and text[:1] != " ":
            return text.replace("\n", " \n").split(" ")
        words = []
        for k, line in enumerate(text.split("\n")):
            if k:
                first = re.match("[^ ]*", line)[0]
                words.append("\n" + first)
                line = line[len(first) :]
            else:
                line = " " + line
            words += [w[1:] for w in re.findall(" +[^ ]*", line)]
        return words

    def _split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(words of all texts, number of words of each)."""
        spaced = pc.match_substring_regex(texts, "^ |  ").to_numpy(zero_copy_only=False)
        if not spaced.any():
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
            words, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
        else:
            lists = [self.split(t) for t in texts.to_pylist()]
            words, sizes = pa.array([w for x in lists for w in x], pa.string()), np.array([len(x) for x in lists])
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        if empty.any():  # an empty text is no word
            words = words.filter(pa.array(~np.repeat(empty, sizes)))
            sizes = np.where(empty, 0, sizes)
        return words, sizes.astype(np.int64)

    def _hold(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, hashed places of candidates) of each word without dropout, as bytes."""
        shown, symbols, starts = self._symbols(words)
        ids, sizes, places, counts = self._cut(shown, symbols, starts, np.arange(len(words)), None)
        ids, places = ids.tobytes(), places.tobytes()
        a, b = (2 * np.cumsum(sizes)).tolist(), (8 * np.cumsum(counts)).tolist()
        return [(ids[i:j], places[k:m]) for i, j, k, m in zip([0, *a], a, [0, *b], b, strict=False)]

    def _symbols(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        shown = [w if w[:1] == "\n" else f" {w}" for w in words]
        symbols = self.char[np.frombuffer("".join(shown).encode("utf-32-le"), "<u4")]
        return shown, symbols, np.concatenate([[0], np.cumsum([len(x) for x in shown], dtype=np.int64)])

    def encode(self, texts: pa.Array, draws: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n + 1 offsets). draws: a number for each text, which keys all draws of its words."""
        texts = pc.fill_null(texts, "")
        words, sizes = self._split(texts)
        if not len(words):
            return np.zeros(0, "<u2"), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        known = self.plain.hold(set(distinct), self._hold)
        held = [known[w] for w in distinct]
        own = _mixed(np.array([d % 2**64 for d in draws], np.uint64) ^ np.uint64(self.seed * int(GOLDEN) % 2**64))
        ends = np.cumsum(sizes)
        position = np.arange(len(which)) - np.repeat(ends - sizes, sizes)
        keys = _mixed(np.repeat(own, sizes) + (position + 1).astype(np.uint64) * GOLDEN)

        places, counts = np.frombuffer(b"".join([x[1] for x in held]), np.uint64), np.array([len(x[1]) // 8 for x in held], np.int64)
        first = np.cumsum(counts) - counts
        skips = np.zeros(len(which), bool)  # whether the occurrence skips a candidate of the agenda without dropout
        for a in range(0, len(which), 50_000):
            w = which[a : a + 50_000]
            m = counts[w]
            hit = _mixed(np.repeat(keys[a : a + 50_000], m) ^ places[_ragged(first[w], m)]) < self.below
            hits = np.concatenate([[0], np.cumsum(hit)])
            upto = np.cumsum(m)
            skips[a : a + 50_000] = hits[upto] > hits[upto - m]
        shown, symbols, starts = self._symbols(distinct)
        if self.below:
            skips |= (np.diff(starts) > LONG)[which]  # the candidates of long words are not listed
        alone = np.flatnonzero(skips)
        ids, n, *_ = self._cut(shown, symbols, starts, which[alone], keys[alone])

        cuts = b"".join([x[0] for x in held])
        length = np.concatenate([[len(x[0]) for x in held], 2 * n]).astype(np.int64)
        data = pa.py_buffer(cuts + ids.tobytes())
        pool = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(length)]).astype(np.int64).tobytes()), data])
        take = which.astype(np.int64)
        take[alone] = len(held) + np.arange(len(alone))
        out = np.frombuffer(pool.take(pa.array(take)).buffers()[2] or b"", "<u2")
        upto = np.concatenate([[0], np.cumsum(length[take] // 2)])
        return out[: upto[-1]], upto[np.concatenate([[0], ends])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; the space before the first word goes."""
        if not len(ids):
            return [b""] * (len(offsets) - 1)
        held = self.pieces.take(pa.array(ids.astype(np.int32)))
        _, ends, data = held.buffers()
        at = np.frombuffer(ends, np.int64)[offsets].tolist()
        data = memoryview(data)
        return [bytes(data[a + (data[a : a + 1] == b" ") : b]) for a, b in zip(at, at[1:], strict=False)]


_OPEN: dict[tuple, MergeDropout] = {}


def encoder(*args) -> MergeDropout:
    if args not in _OPEN:
        _OPEN[args] = MergeDropout(*args)
    return _OPEN[args]


def encode_with_dropout(docs: DataFrame, model_file: str, rate: float = 0.1, seed: int = 1, with_ids: bool = True) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_tokens, ids_crc32, decoded_sha256, lossless, and ids if asked for.

    The draw for a word depends on the seed, doc_id and the word's position: each occurrence is drawn for itself, within a
    document and from document to document. ids_crc32 is of the ids as little-endian unsigned 32-bit; decoded_sha256 is
    of the text that the ids decode to, lossless whether it is the text. Null text is empty: no ids. Null doc_ids share
    their draws. Repeated rows are encoded each, alike; an empty table gives no rows; other columns are ignored, also
    such as have a name of the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        coder = encoder(model_file, rate, seed)
        for batch in batches:
            for first, texts in runs_of(batch.column(1)):
                doc_ids = batch.column(0).slice(first, len(texts))
                ids, at = coder.encode(texts, [xxh64_intdigest(str(i).encode(), seed) for i in doc_ids.to_pylist()])
                decoded, wide, bounds = coder.decode(ids, at), ids.astype("<u4"), at.tolist()
                out = {
                    "doc_id": doc_ids,
                    "n_tokens": pa.array(np.diff(at)),
                    "ids_crc32": pa.array([zlib.crc32(wide[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], pa.int64()),
                    "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
                    "lossless": [d == (t or "").encode() for d, t in zip(decoded, texts.to_pylist(), strict=True)],
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(wide.view(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_crc32 long, decoded_sha256 string, lossless boolean" + ", ids array<int>" * with_ids)
