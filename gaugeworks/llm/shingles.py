"""Word shingles of a text as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

U64 = np.uint64


class WordHashes(dict):
    """xxhash64 of words (UTF-8 bytes) as eight bytes, kept for the words seen last."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh64_digest(word)
        return found


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's `size`-word shingles. A text with fewer words
    has one shingle, all its words; a text without words has none."""
    words = words_of(text)
    if not words:
        return np.empty(0, U64)
    h = np.frombuffer(b"".join(map(hashes.__getitem__, words)), ">u8").astype(U64)
    width = min(size, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        total = np.full(n, U64(width), U64)
        for k in range(width):
            total = mix(total + h[k : k + n])
    # for so few numbers faster than np.unique
    total.sort()
    return total[np.r_[True, total[1:] != total[:-1]]]
