"""Word shingles of many texts at once, as 64-bit hashes.

Words are maximal runs of bytes outside space and 0x09-0x0D; A-Z count as a-z.
A text with fewer words than a shingle, but at least one, has one shingle: all
of its words. All steps are array operations over the bytes of a slice of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x + np.uint64((salt + 1) * int(_BASE) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Sets:
    """Distinct ascending hashes of every text: those of text i are ``hashes[ends[i] - sizes[i]:ends[i]]``."""

    hashes: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.sizes)

    def signature(self) -> np.ndarray:
        """A 64-bit hash of each set as a whole."""
        total = np.zeros(len(self.sizes), np.uint64)
        np.add.at(total, self.owner, mixed(self.hashes, 7))
        return mixed(total + mixed(self.sizes.astype(np.uint64), 3), 5)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` together."""
    sizes = np.array(pc.fill_null(pc.binary_length(texts), 0))
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def shingle_sets(texts: pa.Array, words: int) -> Sets:
    """The shingle sets of a slice of texts; null counts as empty."""
    texts = pa.array(texts.fill_null("").to_pylist(), pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[:n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    raw = raw + np.uint8(32) * ((raw >= 65) & (raw <= 90)).astype(np.uint8)
    visible = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = visible.copy()
    first[1:] &= ~visible[:-1]
    opens = offsets[:-1][offsets[:-1] < len(raw)]
    first[opens] |= visible[opens]
    places = np.flatnonzero(visible)
    starts = np.flatnonzero(first)
    if not len(starts):
        return Sets(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n, np.int64))
    begins = np.flatnonzero(first[places])
    lengths = np.diff(np.append(begins, len(places)))
    inside = np.arange(len(places)) - np.repeat(begins, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, 0x2545F4914F6CDD1D, np.uint64))
    word = mixed(np.add.reduceat((raw[places].astype(np.uint64) + np.uint64(1)) * powers[inside], begins)
                 + lengths.astype(np.uint64))
    owner = np.searchsorted(offsets, starts, "right") - 1
    held = np.bincount(owner, minlength=n)

    parts, owners = [], []
    if len(word) >= words:
        joined = sum(word[i:len(word) - words + 1 + i] * _STEPS[i] for i in range(words))
        whole = owner[:len(word) - words + 1] == owner[words - 1:]
        parts.append(mixed(joined[whole], words))
        owners.append(owner[:len(word) - words + 1][whole])
    short = np.flatnonzero((held > 0) & (held < words))
    if len(short):
        at = np.searchsorted(owner, short)
        joined = np.zeros(len(short), np.uint64)
        for i in range(words - 1):
            has = held[short] > i
            joined[has] += word[at[has] + i] * _STEPS[i]
        parts.append(mixed(joined + held[short].astype(np.uint64), 1 << 20))
        owners.append(short)
    hashes, owners = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return Sets(hashes, owners, np.bincount(owners, minlength=n))
