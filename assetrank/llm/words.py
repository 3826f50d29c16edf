"""Words of texts as 64-bit hashes, for numpy."""

from __future__ import annotations

import string

import numpy as np
import xxhash

_TO_BLANK = bytes.maketrans((string.punctuation + "\x1c\x1d\x1e\x1f\x00").encode(), b" " * (len(string.punctuation) + 5))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype="uint64")


class WordHashes(dict):
    """Word -> 64-bit hash; ``most`` bounds the memory (a full table keeps what it has)."""

    def __init__(self, most: int = 200_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.most:
            self[word] = value
        return value


_HASHES = WordHashes()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype="uint64", count=len(words))


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased: what bytes.lower and bytes.split do."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def plain_words(text: str) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_BLANK).split()


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread sums of products over all bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def grams(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; n is 5 at most. Fewer words give none."""
    count = len(hashed) - n + 1
    if count <= 0:
        return np.empty(0, dtype="uint64")
    total = np.zeros(count, dtype="uint64")
    for k in range(n):
        total += (hashed[k : k + count] + np.uint64(k)) * _FACTORS[k]
    return mixed(total)


def run_hash(hashed: np.ndarray) -> int:
    """Hash of a whole sequence of words."""
    return xxhash.xxh64_intdigest(hashed.tobytes(), seed=len(hashed))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view("int64")
