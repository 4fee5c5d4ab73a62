"""Word shingles of many texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from talentlake.llm.frames import remembered

WORDS = 5
REMEMBERED_WORDS = 200_000
_STEP = 0x9E3779B97F4A7C15


class Hashes(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(remembered(Hashes).__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingles of a text's lower-case words. A shorter text has one shingle, all
    its words; a text without words has none."""
    w = word_hashes(text.lower().split())
    if not len(w):
        return w
    width = min(words, len(w))
    total = np.zeros(len(w) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = total * np.uint64(_STEP) + w[i : len(w) - width + 1 + i]
    return np.unique(mixed(total + np.uint64(width)))
