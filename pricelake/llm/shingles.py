"""Word shingles of whole texts as 64-bit hashes, computed with numpy inside tasks.

Words are runs of bytes other than space and \\x09-\\x0D, with A-Z lower-cased. A word's
hash is a polynomial of random numbers that stand for its bytes, read off prefix sums
over many texts at once, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

import pricelake.llm.common  # noqa: F401  (ships these functions to tasks)

SHINGLE_WORDS = 5
AT_ONCE = 1 << 20  # bytes hashed at a time
_MASK = 2**64 - 1
_BASE = 0x9E3779B97F4A7C15  # 5 modulo 8: powers of it repeat as late as they can
_random = np.random.default_rng(5)
_FACTORS = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Shingle sets of texts; holds the powers that hashing needs."""

    def __init__(self, width: int = SHINGLE_WORDS, at_once: int = AT_ONCE) -> None:
        self.width, self.at_once = width, at_once
        inverse = pow(_BASE, -1, 2**64)
        self.up = self._powers(_BASE)
        self.down = self._powers(inverse)

    def _powers(self, base: int) -> np.ndarray:
        powers = np.full(self.at_once + 1, base, np.uint64)
        powers[0] = 1
        return np.cumprod(powers)

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and unfinished hash of each word of at most ``at_once`` bytes."""
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_SPACE[data]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[: len(data)], out=sums[1:])
        return starts, ends, (sums[ends] - sums[starts]) * self.down[starts]

    def word_hashes(self, text: bytes) -> np.ndarray:
        """Hash of each word of a text, which is read in parts if it is long."""
        data = np.frombuffer(text.lower(), np.uint8)
        out, lengths = [], []
        carried, length = 0, 0  # of a word that the part before did not end
        for at in range(0, max(1, len(data)), self.at_once):
            part = data[at : at + self.at_once]
            starts, ends, hashes = self._words(part)
            sizes = ends - starts
            if length:
                if len(starts) and starts[0] == 0:
                    shift = pow(_BASE, length, 2**64)
                    hashes[0] = (int(hashes[0]) * shift + carried) & _MASK
                    sizes[0] += length
                else:
                    out.append(np.array([carried], np.uint64))
                    lengths.append(np.array([length]))
            carried, length = 0, 0
            if len(ends) and ends[-1] == len(part) and at + self.at_once < len(data):
                carried, length = int(hashes[-1]), int(sizes[-1])
                hashes, sizes = hashes[:-1], sizes[:-1]
            out.append(hashes)
            lengths.append(sizes)
        return mix(np.concatenate(out) + np.concatenate(lengths).astype(np.uint64))

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of each text, in order.

        Texts of fewer than ``width`` words have the whole sequence as one shingle,
        texts without words none.
        """
        begin, size = 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text) + 1 > self.at_once:
                yield from self._sets(texts[begin:i])
                begin, size = i, 0
            size += len(text) + 1
        if begin < len(texts):
            yield from self._sets(texts[begin:])

    def _sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if len(texts) == 1:
            hashes = self.word_hashes(texts[0])
            counts = [len(hashes)]
        else:
            joined = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
            starts, ends, hashes = self._words(joined)
            hashes = mix(hashes + (ends - starts).astype(np.uint64))
            limits = np.cumsum([len(t) + 1 for t in texts])
            counts = np.diff(np.searchsorted(starts, limits), prepend=0).tolist()
        rolled = np.zeros(max(0, len(hashes) - self.width + 1), np.uint64)
        for k in range(self.width):
            rolled += hashes[k : k + len(rolled)] * _FACTORS[k]
        rolled = mix(rolled)
        at = 0
        for n in counts:
            if n >= self.width:
                ordered = np.sort(rolled[at : at + n - self.width + 1])
                new = np.empty(len(ordered), bool)
                new[0] = True
                np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
                yield ordered[new]
            elif n:
                yield mix((hashes[at : at + n] * _FACTORS[:n]).sum(keepdims=True) + _FACTORS[n + self.width])
            else:
                yield rolled[:0]
            at += n


def binary(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, NULL as empty."""
    wide = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(wide).to_pylist()]
