"""Word shingles of whole texts as sorted arrays of 64-bit hashes, with numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from chatloom.llm.common import WORD_PATTERN

SHINGLE_WORDS = 5

_WORD = re.compile(WORD_PATTERN)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles; a text of fewer words is one shingle, a text of none has none."""
    words = _WORD.findall(text or "")
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(word.encode("utf-8", "surrogatepass")) for word in words), np.uint64, len(words)
    )
    width = min(width, len(words))
    mixed = np.full(len(words) - width + 1, len(words) if len(words) < SHINGLE_WORDS else 0, np.uint64)
    for place in range(width):
        mixed = (mixed ^ hashes[place : len(hashes) - width + 1 + place]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def jaccard(left: np.ndarray, right: np.ndarray) -> float:
    """Of two sets that are not both empty."""
    common = len(np.intersect1d(left, right, assume_unique=True))
    return common / (len(left) + len(right) - common)
