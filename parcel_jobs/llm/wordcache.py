"""Token ids of whole texts by a word BPE of the tokenizers library, over the distinct words of a run of texts.

The tokenizer of word_bpe_49k.json never joins characters across white space, so the ids of a text are those of its
words in order. A run of texts is split into words by Arrow, each distinct word is looked up in a bounded cache or
encoded, and the ids of all words are gathered into one array. Results equal Tokenizer.encode on the whole text. A
tokenizer with another normaliser or other pre-tokens, and texts with special tokens, are encoded as whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class TwoGenerations:
    """A bounded map: when the young half is full it becomes the old half, and what is used again moves back."""

    def __init__(self, limit: int = 200_000):
        self.limit, self.young, self.old = limit, {}, {}

    def hold(self, keys: set, compute: Callable[[list], Iterable]) -> dict:
        """A map that has all keys; those unknown are computed in one call."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old, missing = self.young, self.old, []
        for k in keys - young.keys():
            if (v := old.get(k)) is None:
                missing.append(k)
            else:
                young[k] = v
        if missing:
            young.update(zip(missing, compute(missing), strict=True))
        return young


#: What a tokenizer file must hold for its texts to be encoded word by word.
WORD_BY_WORD = {
    "normalizer": ["NFC", r"\s+", "Lowercase"],
    "pre_tokens": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "suffix": "</w>",
}
#: Marks that stand together are set apart as words of their own, unless an apostrophe is beside another of them.
_MARKS, _BESIDE = r"([^\s\x{0B}\x{85}\x{A0}\pL\pN']+)", r"'[^\s\pL\pN]|[^\s\pL\pN]'"
#: Such texts are cut into pre-tokens by the tokenizer's own pattern; those that aren't of Latin-1 at white space alone.
_NOT_LATIN, _SPACES = r"[^\x{0}-\x{FF}]", r"[\x{0B}\x{85}\x{A0}]"
_TOKENS = "(" + WORD_BY_WORD["pre_tokens"].replace(r"[\p{L}]", r"\pL").replace(r"[\p{N}]", r"\pN").replace(r"\p{L}\p{N}", r"\pL\pN") + ")"
#: A word that is surely one pre-token: letters in lower case, ASCII marks, or a digit.
_SINGLE = re.compile(r"[a-zß-öø-ÿ]+|[!-/:-@\[-`{-~]+|[0-9]").fullmatch


class WordBpe:
    """encode(texts): ids of all texts, of self.dtype, and where each text's begin."""

    def __init__(self, path: str, cache_words: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [t.content for t in added]
        self.by_word = self._is_by_word(self.tokenizer, added)
        if self.by_word:
            # for words that are one pre-token each: white space alone parts them, and their bytes are shown as the byte level does
            self.singles = Tokenizer(self.tokenizer.model)
            self.singles.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes_shown = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xA1, 0x100)}
            self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith(WORD_BY_WORD["suffix"]) for i in range(size)], bool)
        self.words = TwoGenerations(cache_words)

    @staticmethod
    def _is_by_word(tokenizer, added) -> bool:
        shown = lambda part: json.loads(part.__getstate__()) if part is not None else {}
        normal = [x["type"] if x["type"] != "Replace" else x["pattern"].get("Regex") if x["content"] == " " else None for x in shown(tokenizer.normalizer).get("normalizers") or []]
        pre = shown(tokenizer.pre_tokenizer).get("pretokenizers") or []
        split = [x["pattern"].get("Regex") for x in pre if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]]
        byte = [x for x in pre if x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"]]
        marked = any(t.single_word or t.lstrip or t.rstrip or " " in t.content for t in added)
        model = tokenizer.model
        return (
            normal == WORD_BY_WORD["normalizer"] and split == [WORD_BY_WORD["pre_tokens"]] and len(byte) == 1 and len(pre) == 2 and not marked
            and type(model).__name__ == "BPE" and model.end_of_word_suffix == WORD_BY_WORD["suffix"] and not model.dropout and tokenizer.post_processor is None
        )

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n + 1 offsets) of texts; a null text is empty."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if self.by_word:
            special = np.zeros(n, bool)
            for t in self.specials:
                special |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        else:
            special = np.ones(n, bool)
        if not special.any():
            return self._by_words(texts)
        turns = np.flatnonzero(special[1:] != special[:-1]) + 1
        parts = [(self._whole if special[a] else self._by_words)(texts.slice(a, b - a)) for a, b in zip([0, *turns], [*turns, n], strict=True)]
        sizes = np.concatenate([np.diff(offsets) for _, offsets in parts])
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([[0], np.cumsum(sizes)])

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        coded = [np.array(e.ids, self.dtype) for t in texts.to_pylist() for e in self.tokenizer.encode_batch_fast([t], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, self.dtype), *coded]), np.concatenate([[0], np.cumsum([len(x) for x in coded], dtype=np.int64)])

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        latin, beside = pc.invert(pc.match_substring_regex(texts, _NOT_LATIN)), pc.match_substring_regex(texts, _BESIDE)
        lower = texts if pc.all(latin).as_py() else pc.if_else(latin, texts, "")
        lower = pc.utf8_lower(lower)  # a text of Latin-1 has no marks that compose, so its case can be folded before it is normalised
        ready = pc.replace_substring_regex(lower, _MARKS, r" \1 ")
        if pc.any(beside).as_py():
            tokens = pc.replace_substring_regex(pc.replace_substring_regex(lower.filter(beside), _SPACES, " "), _TOKENS, r"\1 ")
            ready = pc.replace_with_mask(ready, beside, tokens)
        if not pc.all(latin).as_py():
            ready = pc.if_else(latin, ready, texts)
        split = pc.ascii_split_whitespace(ready)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.words.hold(set(distinct), self._encode)
        held = pa.array([known[w] for w in distinct], pa.large_binary()).take(coded.indices)  # the ids of all words, one after the other
        _, ends, data = held.buffers()
        ends = np.frombuffer(ends, np.int64)[held.offset : held.offset + len(held) + 1] if len(held) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, self.dtype)[ends[0] // self.dtype.itemsize : ends[-1] // self.dtype.itemsize] if data is not None else np.zeros(0, self.dtype)
        bounds = split.offsets.to_numpy()
        return ids, (ends[bounds - bounds[0]] - ends[0]) // self.dtype.itemsize

    def _encode(self, words: list[str]) -> list[bytes]:
        """Words that are one pre-token are encoded as one text, whose ids are cut where one ends a word; others are texts of their own."""
        out: list[bytes] = [b""] * len(words)
        single = [i for i, w in enumerate(words) if _SINGLE(w)]
        other = [i for i, w in enumerate(words) if not _SINGLE(w)] if len(single) < len(words) else []
        single.sort(key=lambda i: words[i].isascii())  # so that few lines need their bytes shown
        for k in range(0, len(single), 4000):
            some = single[k : k + 4000]
            line = " ".join([words[i] for i in some])
            ids = np.array(self.singles.encode_batch_fast([line if line.isascii() else line.translate(self.bytes_shown)], add_special_tokens=False)[0].ids, self.dtype)
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(some):
                other += some
                continue
            joined, size, a = ids.tobytes(), self.dtype.itemsize, 0
            for i, b in zip(some, (stops * size).tolist(), strict=True):
                out[i] = joined[a:b]
                a = b
        for i, e in zip(other, self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, self.dtype).tobytes()
        return out


def runs_of(texts: pa.Array, most_bytes: int = 2_000_000) -> Iterable[tuple[int, pa.Array]]:
    """(first row, texts) of runs of rows with a bounded number of bytes; one longer text is a run alone. What Arrow holds for the runs is given back after each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield start, texts.slice(start, stop - start)
        pa.default_memory_pool().release_unused()
        start, done = stop, int(ends[stop - 1])


_OPEN: dict[tuple, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """One encoder for each Python worker; it stays warm from task to task."""
    if path not in _OPEN:
        _OPEN[path] = WordBpe(path)
    return _OPEN[path]
