"""Token ids of whole texts by the tokenizers library, with a cache of the ids of single words.

The vocabulary file is read by every worker itself, from a path that is a parameter. Where the
file's own rules split a text into words first, and a text has nothing but Latin-1 characters and no special
string, its ids are the ids of its words in a row; the library then encodes each new word once,
and many new words in one call. Every other text goes to the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable

import numpy as np

#: Fixed values of word_bpe_49k.json: how it normalizes and splits a text.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
WORD_END = "</w>"

#: The same split for lower-cased Latin-1 text.
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffA-Z\xc0-\xd6\xd8-\xde"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = "\t-\r \x85\xa0"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+")
BEYOND_LATIN_1 = re.compile("[^\x00-\xff]")

END_ID = 1
#: Bytes of words and their ids that a worker keeps; later words are encoded each time that they come up.
CACHED_BYTES = 56 << 20
#: What a kept word takes besides its letters and ids.
ENTRY_BYTES = 160


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as bytes of little-endian unsigned integers of `width` bytes, without special tokens added."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.by_word = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == SPLITTER and rules["model"].get("end_of_word_suffix") == WORD_END and not rules["model"].get("dropout")
        self.special = [token["content"] for token in rules["added_tokens"]]
        self.cache: dict[str, bytes] = {}
        self.cached = 0
        if self.by_word:
            # The words come normalized and split, so their ids follow from the merges alone.
            self.merges = Tokenizer(self.library.model)
            self.merges.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ends_word = np.zeros(self.size, bool)
            self.ends_word[[number for token, number in rules["model"]["vocab"].items() if token.endswith(WORD_END)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        simple = [self.by_word and not BEYOND_LATIN_1.search(text) and not any(s in text for s in self.special) for text in texts]
        whole = iter(self.library.encode_batch_fast([t for t, s in zip(texts, simple) if not s], add_special_tokens=False))
        words = [WORD.findall(text.lower()) if s else None for text, s in zip(texts, simple)]
        known = self.cache
        found = [list(map(known.get, row)) if row is not None else [] for row in words]
        holes = [(ids, i, row[i]) for row, ids in zip(words, found) if None in ids for i, one in enumerate(ids) if one is None]
        new = list({word for _, _, word in holes})
        if new:
            known.update(zip(new, self._encode_words(new)))
            for ids, i, word in holes:
                ids[i] = known[word]
        out = [b"".join(ids) if row is not None else np.array(next(whole).ids, self.dtype).tobytes() for row, ids in zip(words, found)]
        for word in new:
            size = ENTRY_BYTES + len(word) + len(known[word])
            if self.cached + size > CACHED_BYTES:  # what is beyond the bound leaves again
                del known[word]
            else:
                self.cached += size
        return out

    def _encode_words(self, words: list[str]) -> Iterable[bytes]:
        ids = np.array(self.merges.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.dtype)
        ends = (np.flatnonzero(self.ends_word[ids]) + 1) * self.dtype.itemsize
        if len(ends) != len(words):
            raise ValueError("the vocabulary splits words in another way than expected")
        raw, at = ids.tobytes(), 0
        for end in ends.tolist():
            yield raw[at:end]
            at = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a path; it stays for later tasks."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Characters of text that are encoded in one call.
CHARACTERS_AT_ONCE = 1 << 18


def encoded(texts: list[str | None], path: str) -> Iterable[np.ndarray]:
    """Ids of each text with the end id appended; null counts as empty."""
    tool = encoder(path)
    end = np.array([END_ID], tool.dtype)
    at = 0
    while at < len(texts):
        size, until = 0, at
        while until < len(texts) and (until == at or size < CHARACTERS_AT_ONCE):
            size += len(texts[until] or "")
            until += 1
        for raw in tool.encode([t or "" for t in texts[at:until]]):
            yield np.concatenate([np.frombuffer(raw, tool.dtype), end])
        at = until


def crc32(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
