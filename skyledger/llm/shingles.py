"""Hashes of words and of word shingles, vectorised over one text at a time."""

import numpy as np
import xxhash

_KEEP = 1 << 18


class WordHashes(dict):
    """64-bit hashes of words, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEEP:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the words of a text: A-Z in lower case, split at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; fewer words are one shorter run; none, no hash."""
    if not len(words):
        return words
    length = min(size, len(words))
    found = np.full(len(words) - length + 1, length, dtype=np.uint64)
    for i in range(length):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(found)])
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))]
