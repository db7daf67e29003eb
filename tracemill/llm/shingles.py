"""Words, word shingles and bottom-k sketches of their hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

SHINGLE_WORDS = 5
# Word hashes a task remembers before it starts anew.
REMEMBERED = 500_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
EMPTY = np.zeros(0, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_known = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, with A-Z lower-cased.

    Words are what lies between ASCII white space; other white space belongs to them.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    known = _known
    return np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))


def finish_hash(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range, one to one."""
    mixed = values ^ (values >> np.uint64(30))
    mixed = mixed * _MIX[0]
    mixed ^= mixed >> np.uint64(27)
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(31)
    return mixed


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words.

    With fewer words the whole sequence is the one shingle; without any word there
    is none.
    """
    hashes = word_hashes(text) if text else EMPTY
    if not len(hashes):
        return EMPTY
    size = min(size, len(hashes))
    runs = len(hashes) - size + 1
    mixed = np.zeros(runs, dtype=np.uint64)
    for step in range(size):
        mixed = mixed * _FACTOR + hashes[step : step + runs]
    return np.unique(finish_hash(mixed))


def set_digest(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def jaccard_parts(one: np.ndarray, other: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = np.concatenate((one, other))
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common, len(both) - common


def union_sketch(one: np.ndarray, other: np.ndarray, size: int) -> tuple[int, int]:
    """Of the ``size`` smallest values of a union: how many both have, and how many there are.

    Both sketches are sorted and hold the ``size`` smallest values of their set, or
    all. The shared part estimates the resemblance of the sets.
    """
    both = np.concatenate((one, other))
    both.sort(kind="stable")
    same = both[1:] == both[:-1]
    first = np.concatenate(([True], ~same)) if len(both) else np.zeros(0, bool)
    starts = np.flatnonzero(first)[:size]
    if not len(starts):
        return 0, 0
    twice = np.append(same, False)[starts]
    return int(twice.sum()), len(starts)
