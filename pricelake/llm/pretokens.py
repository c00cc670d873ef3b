"""Ids of whole texts, as the vocabulary's own library gives them without adding special tokens.

``ByteLevelBpe`` merges by the ranks of a byte-level vocabulary, which gives the library's
ids several times faster. ``WordBpe`` looks whole words up: a column of texts is split at
white space, each different word is merged once and its ids are put in all its places.

Both do so for texts whose characters have classes known here (Latin letters and common
punctuation); any other text goes to the library whole, and so does one that holds the
string of a special token, unless such strings are to be ``plain`` text.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

# Characters U+0001 to U+017F and some punctuation. U+0130 is left out, as its lower case
# is two characters, U+001C to U+001F, as not all libraries take them for white space, and NUL,
# which marks a word's end below.
_KNOWN = r"\x01-\x1b\x20-\x7f¡-įı-ſ‐-‧€"
_ALL_KNOWN = re.compile(f"[{_KNOWN}]*")
_UNKNOWN = f"[^{_KNOWN}]"
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ"
_NUMBER = "0-9²³¹¼½¾"
_RUNS = r"|\s+(?!\S)|\s+"  # how a byte-level pattern ends: runs of white space but for their last
_OTHER_SPACE = "\t\x0b\x0c\r"
_SPACES = ("  ", " \n", "\n ", "\n\n")
_WORD_LEVEL = (
    rf"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t-\r\x20{_LETTER}{_NUMBER}]+)"
)
_WORD_END = r"([\pL0-9])([.,;:!?]+\s)"


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class _Own:
    """A vocabulary and its own library, which is loaded when a text first needs it."""

    def __init__(self, vocabulary: str, plain: bool) -> None:
        self.vocabulary, self.plain = vocabulary, plain
        self.spec = json.loads(vocabulary)
        self.special = tuple(t["content"] for t in self.spec["added_tokens"])

    @cached_property
    def library(self) -> Tokenizer:
        library = Tokenizer.from_str(self.vocabulary)
        library.encode_special_tokens = self.plain
        return library

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


class ByteLevelBpe:
    """Ids of a text by a byte-level vocabulary whose ids are in the order of its merges."""

    def __init__(self, vocabulary: str, pattern: str, plain: bool = False) -> None:
        self.own = _Own(vocabulary, plain)
        spec, special = self.own.spec, self.own.special
        self.special = () if plain else special
        self.pattern = pattern
        alphabet = str.maketrans({c: chr(b) for c, b in byte_alphabet().items()})
        self.tokens = {
            token.translate(alphabet).encode("latin-1"): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self.size = max(spec["model"]["vocab"].values()) + 1

    def _by(self, pattern: str) -> tiktoken.Encoding:
        # without any special token ``encode_to_numpy`` stops at every character; NUL is not known
        return tiktoken.Encoding(
            "vocabulary", pat_str=pattern, mergeable_ranks=self.tokens, special_tokens={"\0": self.size}
        )

    @cached_property
    def merges(self) -> tiktoken.Encoding:
        return self._by(self.pattern)

    @cached_property
    def quick(self) -> tiktoken.Encoding:
        """Texts without runs of white space need no look-ahead, which a regex is slow at."""
        if not self.pattern.endswith(_RUNS):
            return self.merges
        return self._by(self.pattern.removesuffix(_RUNS) + r"|\s")

    def _merging(self, text: str) -> tiktoken.Encoding | None:
        """What merges the text here, None if the library is to encode it."""
        if not _ALL_KNOWN.fullmatch(text) or any(s in text for s in self.special):
            return None
        runs = any(s in text for s in _OTHER_SPACE) or any(s in text for s in _SPACES)
        return self.merges if runs else self.quick

    def ids(self, text: str) -> list[int]:
        merging = self._merging(text)
        return merging.encode_ordinary(text) if merging else self.own.ids(text)

    def __call__(self, text: str) -> np.ndarray:
        merging = self._merging(text)
        if merging:  # without a Python number for each id
            return merging.encode_to_numpy(text, disallowed_special=())
        return np.asarray(self.own.ids(text), np.uint32)


def gathered(
    flat: np.ndarray, begin: np.ndarray, length: np.ndarray, parts: pa.Array, offsets: pa.Array
) -> list[np.ndarray]:
    """The ids of each text: those of its parts, one after the other."""
    part = parts.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = length[part]
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[part] - (ends - lengths), lengths)
    ids = flat[place]
    first = offsets.to_numpy()
    cuts = np.concatenate([[0], ends])[first - first[0]]
    return [ids[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


class WordBpe:
    """Ids of texts by a lower-case vocabulary that drops white space and marks word ends.

    Words are merged by ranks too: NUL stands for the mark of a word's end, and the first
    merge of every word is that of its last byte with the mark.
    """

    def __init__(self, vocabulary: str, plain: bool = False) -> None:
        self.own = _Own(vocabulary, plain)
        spec, special = self.own.spec, self.own.special
        self.special = () if plain else special
        alphabet, mark = byte_alphabet(), spec["model"]["end_of_word_suffix"]
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token not in special:
                plain = token.removesuffix(mark)
                ranks[bytes(alphabet[c] for c in plain) + b"\0" * (plain != token)] = rank
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"[^\s\x00]+\x00|\n", mergeable_ranks=ranks, special_tokens={}
        )
        self.newline = ranks[b"\n"]

    def __call__(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text of a column without NULLs."""
        other = pc.match_substring_regex(texts, _UNKNOWN)
        for string in self.special:
            other = pc.or_(other, pc.match_substring(texts, string))
        known = pc.invert(other)
        lower = pc.utf8_lower(pc.if_else(known, texts, ""))
        # a boundary anyway: with the punctuation apart more words are met again
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _WORD_END, r"\1 \2"))
        coded = split.flatten().dictionary_encode()
        marked = pc.replace_substring_regex(coded.dictionary, _WORD_LEVEL, "\\1\0")
        lines = "\n".join([*marked.to_pylist(), ""])
        ids = np.asarray(self.merges.encode_ordinary(lines), np.uint32)
        # the ids of one word after the other, each followed by that of the line's end
        stop = np.flatnonzero(ids == self.newline)
        begin = np.concatenate([[0], stop + 1])[: len(stop)]
        out = gathered(ids, begin, stop - begin, coded.indices, split.offsets)
        for i in np.flatnonzero(~known.to_numpy(zero_copy_only=False)):
            out[i] = np.asarray(self.own.ids(texts[i].as_py()), np.uint32)
        return out
