"""Where lines within a few edits meet, for all lines of a batch at once.

The lines of a batch are one array of letters. Sums of powers give the hash of any stretch
of it in one step, so segments, substrings and words are hashed by array operations.

Regions come with a sketch of 64 parities, by hash: of pairs of adjacent letters for the
regions of segments, of words for those of runs. An edit changes few of them, so parities
bound from below how many edits lie between two lines (``Letters`` and ``Words``).
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa

from gaugeworks.llm.shingles import U64, mix


#: One edit per so many letters, up to MOST_EDITS.
LETTERS_PER_EDIT = 20
MOST_EDITS = 2


def letter_edits(length: int) -> int:
    """Edits allowed to a line of ``length`` letters, the shorter of two."""
    return min(length // LETTERS_PER_EDIT, MOST_EDITS)


#: One word may differ from LEAST_WORDS words on, and one more per WORDS_PER_EDIT.
LEAST_WORDS = 12
WORDS_PER_EDIT = 24
#: Scales of lines by words: (from, words of an n-gram, n-grams of a run). A line of
#: ``from`` words or more whose words are cut by the edits has a run of both sizes less one.
SCALES = ((LEAST_WORDS, 4, 3), (WORDS_PER_EDIT, 5, 4), (2 * WORDS_PER_EDIT, 6, 7))
#: Words from which on a line meets others by runs of words only. A changed letter touches
#: three words at most, and may change their number by EDIT_WORDS / MOST_EDITS. So of LONG
#: words and EDIT_WORDS less, which SIZE_RATIO allows, 40 or more stay untouched in either
#: line, a run of fourteen among them.
LONG = 50
EDIT_WORDS = 2 * MOST_EDITS
#: The least ratio of sizes, in letters or in words, that the edits allow.
SIZE_RATIO = 0.92
#: What stands between spaces, but each letter of scripts written without them.
_NO_SPACES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORDS = re.compile(f"[{_NO_SPACES}]|[^{_NO_SPACES}\x20\x09-\x0d]+")

#: Parities that a changed letter may turn: of pairs of letters two go and two come, and of
#: words three become one.
PARITIES = 4
#: A size in words is kept in two bytes; from so many on the bound is beyond any distance.
MOST_SIZE = (1 << 16) - 1


def word_edits(n_words: int) -> int:
    """Changed, missing or further words allowed to a line of ``n_words``, the shorter."""
    return 1 + n_words // WORDS_PER_EDIT if n_words >= LEAST_WORDS else 0


def scales_of(n_words: int) -> set[int]:
    """The scales a line takes part in: its own and that of the shortest line in reach."""
    ends = [n_words, n_words - word_edits(n_words)]
    if n_words >= LONG:
        ends.append(n_words - EDIT_WORDS)
    return {sum(n >= least for least, _, _ in SCALES) - 1 for n in ends if n >= LEAST_WORDS}


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its number, and whether it is of a word (0), white space (1) or a word (2)."""
    codes = np.arange(0x110000, dtype=np.uint64)
    kinds = np.zeros(len(codes), np.uint8)
    kinds[[0x20, *range(0x09, 0x0E)]] = 1
    for k in range(0, len(_NO_SPACES), 3):
        kinds[ord(_NO_SPACES[k]) : ord(_NO_SPACES[k + 2]) + 1] = 2
    return mix(codes + U64(0x5851F42D4C957F2D)), kinds


#: An odd number and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """2 ** bits powers of the base and of its inverse."""
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


class Lines:
    """Lines as code points in a row, line k from ``starts[k]`` to ``starts[k + 1]``."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        self.starts, self.sizes = starts, np.diff(starts)
        numbers, kinds = _letters()
        self.letters = numbers[codes]
        power, self.inverse = _powers(max(len(codes), 1 << 16).bit_length())
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.letters * power[: len(codes)], out=self.sums[1:])
        kind = kinds[codes]
        # a word begins and ends where its line does or another kind stands beside it
        edge = np.zeros(len(codes) + 1, bool)
        edge[starts] = True
        plain = kind == 0
        begins, ends = kind == 2, kind == 2
        begins[1:] |= plain[1:] & ~plain[:-1]
        ends[:-1] |= plain[:-1] & ~plain[1:]
        begins |= plain & edge[:-1]
        ends |= plain & edge[1:]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.words = self.hashes(first, last)
        self.word_starts = np.searchsorted(first, starts)
        self.n_words = np.diff(self.word_starts)

    @classmethod
    def of(cls, lines: pa.Array) -> Lines:
        """Of an Arrow array of strings without nulls."""
        at = np.frombuffer(lines.buffers()[1], np.int64 if lines.type == pa.large_string() else np.int32)
        at = at[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
        raw = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        at -= at[0]
        new = (raw & 0xC0) != 0x80
        if new.all():
            return cls(raw, at)
        text = raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass")
        return cls(np.frombuffer(text, np.uint32), np.r_[0, np.cumsum(new)][at])

    @classmethod
    def of_texts(cls, lines: list[str]) -> Lines:
        text = "".join(lines).encode("utf-32-le", "surrogatepass")
        return cls(np.frombuffer(text, np.uint32), np.cumsum([0, *map(len, lines)]))

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the letters from each of ``first`` up to ``last``."""
        with np.errstate(over="ignore"):
            return mix((self.sums[last] - self.sums[first]) * self.inverse[first])

    def word_sketches(self) -> np.ndarray:
        return _parities(self.words, self.word_starts[:-1], self.word_starts[1:])

    def letter_sketches(self, part: np.ndarray, made=None) -> np.ndarray:
        """Of the lines numbered by ``part``, in rising order."""
        made = made or _parities
        sizes = self.sizes[part]
        ends = np.cumsum(sizes)
        chosen = np.arange(int(sizes.sum())) + np.repeat(self.starts[part] - (ends - sizes), sizes)
        letters = self.letters[chosen]
        with np.errstate(over="ignore"):
            pairs = (letters[:-1] * U64(_BASE) + letters[1:]) * U64(0xD6E8FEB86659FD93)
        return made(pairs, ends - sizes, np.maximum(ends - 1, ends - sizes))

    def wide_sketches(self) -> np.ndarray:
        """Per line WIDE times 64 parities of words, then as many of pairs of letters."""
        words = _wide_parities(self.words, self.word_starts[:-1], self.word_starts[1:])
        return np.hstack([words, self.letter_sketches(np.arange(len(self.sizes)), _wide_parities)])


#: Numbers of 64 parities in each half of a wide sketch, a power of two.
WIDE = 8


def _wide_parities(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """As ``_parities``, WIDE numbers to a stretch."""
    which = (hashes << U64(6)) >> U64(65 - WIDE.bit_length())
    found = [_parities(hashes, first, last, which == k) for k in range(WIDE)]
    return np.stack(found, 1)


def _parities(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, part=True) -> np.ndarray:
    """64 parities of the hashes in each stretch, or a part of them, by their first six bits."""
    ahead = np.zeros(len(hashes) + 1, np.uint64)
    np.bitwise_xor.accumulate(np.where(part, U64(1) << (hashes >> U64(58)), U64(0)), out=ahead[1:])
    return ahead[last] ^ ahead[first]


def segments(length, edits: int) -> list[tuple]:
    """(start, length) of the even cut of a line, or of lines, into ``edits + 1`` segments."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    out, at = [], length * 0
    for k in range(parts):
        size = short + (k >= parts - longer)
        out.append((at, size))
        at = at + size
    return out


def letter_regions(lines: Lines, part: np.ndarray, edits: int | None = None) -> tuple:
    """(region, line, edits, whether it is one of the line's own segments) of the lines
    numbered by ``part``: of each its segments, and, for each shorter length in reach, those
    of its substrings at the places an alignment allows. Edits are ``letter_edits`` of that
    length, or as given. For segment k (from 0), the substring may start within k edits to
    its left and, counted from the right end, within the segments that remain."""
    regions, owners, allowed, own = [], [], [], []
    levels = range(1, MOST_EDITS + 1) if edits is None else [edits]
    for e in levels:
        for gap in range(e + 1):
            length = lines.sizes[part] - gap
            if edits is None:
                chosen = np.minimum(length // LETTERS_PER_EDIT, MOST_EDITS) == e
            else:
                chosen = length > e
            of, length = part[chosen], length[chosen]
            for k, (at, size) in enumerate(segments(length, e)):
                tag = mix((length << 16 | k).astype(np.uint64))
                for move in range(max(-k, gap - (e - k)), min(k, gap + (e - k)) + 1):
                    start = at + move
                    good = (start >= 0) & (start + size <= length + gap)
                    first = (lines.starts[of] + start)[good]
                    regions.append(mix(lines.hashes(first, first + size[good]) ^ tag[good]))
                    owners.append(of[good])
                    allowed.append(np.full(len(first), e, np.uint8))
                    own.append(np.full(len(first), gap == 0 and move == 0))
    return tuple(np.concatenate(x) for x in (regions, owners, allowed, own))


#: Per scale, whether a line of so many words takes part; longer ones are as the last.
_TAKES_PART = [np.array([k in scales_of(n) for n in range(12 * WORDS_PER_EDIT)]) for k in range(len(SCALES))]


def run_regions(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(region, index of the line) of lines as word hashes in a row: per scale the least
    n-gram hashes of all runs."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    regions, owners = [], []
    for scale, (_, gram, run) in enumerate(SCALES):
        part = _TAKES_PART[scale][np.minimum(sizes, len(_TAKES_PART[scale]) - 1)]
        chosen = part[owner] if len(owner) else np.zeros(0, bool)
        words, of = hashes[chosen], owner[chosen]
        if len(words) < gram + run - 1:
            continue
        grams = np.full(len(words) - gram + 1, scale + 1, np.uint64)
        for k in range(gram):
            grams = (grams ^ words[k : k + len(grams)]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
        least = grams[: len(grams) - run + 1].copy()
        for k in range(1, run):
            np.minimum(least, grams[k : k + len(least)], out=least)
        # runs that lie in one line, each least n-gram once where it is the same in a row
        first, last = of[: len(least)], of[gram + run - 2 :]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (first[1:] != first[:-1]) | (first[:-1] != last[:-1])
        good = (first == last) & new
        regions.append(least[good])
        owners.append(first[good])
    if not regions:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(regions), np.concatenate(owners)


class Letters:
    """Regions of segments. A note holds the edits allowed, and in its last bit whether the
    line's own segment meets there: the shorter of two lines in reach, and of two of one
    length either, has one in common with a substring of the other."""

    SAME_NOTES = False

    @staticmethod
    def rows(lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(region, line, sketch, note) of lines under LONG words."""
        part = np.flatnonzero((lines.n_words < LONG) & (lines.sizes >= LETTERS_PER_EDIT))
        if not len(part):
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.uint64, np.uint16))
        sketches = np.zeros(len(lines.sizes), np.uint64)
        sketches[part] = lines.letter_sketches(part)
        regions, owners, edits, own = letter_regions(lines, part)
        return regions, owners, sketches[owners], (edits.astype(np.uint16) << 1) | own

    @staticmethod
    def may_link(note, other, apart: np.ndarray) -> np.ndarray:
        """Whether lines of one region with these notes and so many parities apart can be in reach."""
        return ((note | other) & 1).astype(bool) & (apart <= PARITIES * (other >> 1))

    @staticmethod
    def may_link_wide(note, other, words: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """As ``may_link``, by the parities apart of either half of wide sketches."""
        return Letters.may_link(note, other, np.maximum(words, letters))


class Words:
    """Regions of runs of words. A note is the number of words."""

    SAME_NOTES = True

    @staticmethod
    def rows(lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(region, line, sketch, note)."""
        regions, owners = run_regions(lines.words, lines.n_words)
        notes = np.minimum(lines.n_words, MOST_SIZE).astype(np.uint16)
        return regions, owners, lines.word_sketches()[owners], notes[owners]

    @staticmethod
    def may_link(note, other, apart: np.ndarray) -> np.ndarray:
        return Words.may_link_wide(note, other, apart, np.uint8(0))

    @staticmethod
    def may_link_wide(note, other, words: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """A changed word turns two parities, and changes the size by one at most. Lines that
        have no segments may differ in letters instead."""
        low, high = np.minimum(note, other).astype(np.int32), np.maximum(note, other).astype(np.int32)
        edits, gap = np.where(low >= LEAST_WORDS, 1 + low // WORDS_PER_EDIT, 0), high - low
        by_words = (words <= 2 * edits) & (gap <= edits)
        most = PARITIES * MOST_EDITS
        return by_words | (high >= LONG) & (words <= most) & (letters <= most) & (gap <= EDIT_WORDS)
