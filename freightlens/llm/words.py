"""Words of a text as bytes, their hashes, and hashes of runs of words."""

from __future__ import annotations

import zlib

import numpy as np

from freightlens.llm.common import GOLD, mix

#: Lower-cases A-Z and turns every byte outside digits, letters and non-ASCII characters into a space.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters."""
    return text.translate(ALNUM).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k consecutive words; a text of fewer has none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.array([], np.uint64)
    x = hashes[:n].copy()
    for j in range(1, k):
        x = (x ^ (x >> np.uint64(29))) * GOLD + hashes[j : j + n]
    return mix(x + np.uint64(k))
