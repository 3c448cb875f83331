"""Words and word shingles as 64-bit numbers, for numpy."""

from __future__ import annotations

import hashlib

import numpy as np

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed values: the splitmix64 finaliser
STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: its increment, odd
KNOWN = 1 << 20


def split_words(text: str | None) -> list[bytes]:
    """Runs of anything but blank, tab, line feed, vertical tab, form feed and return; A-Z lower-cased, no other letter."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MIX[0]
    values = (values ^ (values >> np.uint64(27))) * MIX[1]
    return values ^ (values >> np.uint64(31))


class WordNumbers(dict):
    """Word to 64-bit number, kept for as many words as KNOWN; the number depends on the word alone."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        number = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = number
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_set(words: list[bytes], numbers: WordNumbers, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than size make one shingle of all of them, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    each = numbers.of(words)
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * STEP + each[i:i + len(out)]
    return np.unique(mixed(out))
