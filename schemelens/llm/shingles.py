"""Word shingles of whole texts as sets of 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], np.uint64)
_FINAL = np.uint64(0xFF51AFD7ED558CCD)
_HALF = np.uint64(32)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
HELD = 100_000


class WordNumbers(dict):
    """64-bit hash of each word, remembered for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_numbers = WordNumbers()


def words(text: str) -> list[bytes]:
    """Words of the A-Z lower-cased text; only the six ASCII white-space characters part words."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_set(w: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words (at most five); fewer words are one shingle, none is
    the empty set."""
    n = len(w)
    if not 0 < width <= len(_MULTIPLIERS):
        raise ValueError(f"shingles of {width} words")
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=n)] if n else [], np.uint64)
    h = np.fromiter(map(_numbers.__getitem__, w), np.uint64, n)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out += (h[i:n - width + 1 + i] ^ (h[i:n - width + 1 + i] >> _HALF)) * _MULTIPLIERS[i]
    out ^= out >> _HALF
    out *= _FINAL
    return np.unique(out ^ (out >> _HALF))
