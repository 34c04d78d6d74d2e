"""Byte-pair encoding with a rank array per word, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import regex
from pyspark.sql import DataFrame

from gaugeworks.llm.common import documents_of, rows_like

#: Words up to this many parts keep their ranks in an array; a scan of it is short.
SHORT = 64
NO_RANK = 1 << 60


@cache
def byte_letters() -> list[str]:
    """The printable letter of each byte, by the rule of byte-level vocabularies: printable
    Latin-1 stands for itself, the rest follow from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in own}
    rest = (b for b in range(256) if b not in letters)
    letters |= {b: chr(256 + k) for k, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Merges, ids and rules of a tokenizer file whose words end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {k: t for t, k in (self.ids | self.special).items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(map(re.escape, longest_first))})")

    def parts(self, word: str) -> list[str]:
        letters = byte_letters()
        parts = [letters[b] for b in word.encode("utf-8")]
        parts[-1] += self.end
        return merged(parts, self.ranks) if len(parts) <= SHORT else merged_long(parts, self.ranks)


def merged(parts: list[str], ranks: dict) -> list[str]:
    """Merge the adjacent pair of lowest rank, leftmost first, until none has a rank.
    ``near[i]`` is the rank of the boundary between parts i and i + 1."""
    rank = ranks.get
    near = [rank(pair, NO_RANK) for pair in zip(parts, parts[1:])]
    while near and (least := min(near)) != NO_RANK:
        at = near.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del near[at]
        if at:
            near[at - 1] = rank((parts[at - 1], parts[at]), NO_RANK)
        if at < len(near):
            near[at] = rank((parts[at], parts[at + 1]), NO_RANK)
    return parts


def merged_long(parts: list[str], ranks: dict) -> list[str]:
    """The same merges for a long word, from a heap over a linked list."""
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := ranks.get(p)) is not None]
    heapq.heapify(heap)
    text: list[str | None] = list(parts)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if text[i] is None or j >= len(text) or ranks.get((text[i], text[j])) != rank:
            continue
        text[i] += text[j]
        text[j] = None
        after[i] = after[j]
        if after[j] < len(text):
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(text):
                found = ranks.get((text[a], text[b]))
                if found is not None:
                    heapq.heappush(heap, (found, a))
    return [x for x in text if x is not None]


class Encoder(dict):
    """(number, ids, tokens) of a text between white space, the latter two as text."""

    def __init__(self, path: str, most: int = 300_000):
        super().__init__()
        self.vocabulary, self.most = Vocabulary(path), most

    def __missing__(self, chunk: str) -> tuple[int, str, str]:
        if len(self) >= self.most:
            self.clear()
        v = self.vocabulary
        tokens = [t for w in v.words.findall(chunk) for t in v.parts(w)]
        ids = [v.ids[t] for t in tokens]
        found = len(tokens), " ".join(map(str, ids)), decode(ids, v)
        if len(chunk) <= 1000:
            self[chunk] = found
        return found

    def encode(self, text: str) -> list[tuple[int, str, str]]:
        """Entries of the text in order. Special strings are their tokens; the rest is
        composed (NFC), lower-cased letter by letter and split at white space."""
        v, out = self.vocabulary, []
        pieces = v.specials.split(text) if "<" in text else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append((1, str(v.special[piece]), decode([v.special[piece]], v)))
                continue
            # a capital sigma has one small letter here, also at the end of a word
            plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            if not plain.isascii() and _NEWER_LETTERS.search(plain):
                plain = plain.translate(_NEWER)
            # str.split also parts at U+001C to U+001F, which are no white space here
            chunks = plain.split() if not _SEPARATORS.search(plain) else _CHUNKS.findall(plain)
            out += filter(_has_tokens, map(self.__getitem__, chunks))
        return out


# Capital and small letters that are newer than Python's tables (fixed values).
_NEWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_NEWER |= {k: k + 0x20 for k in range(0x10D50, 0x10D66)}
_NEWER_LETTERS = re.compile(f"[{''.join(map(chr, _NEWER))}]")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_CHUNKS = regex.compile(r"\P{White_Space}+")


def _has_tokens(entry: tuple[int, str, str]) -> bool:
    return entry[0] > 0


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The tokens of ids with spaces between, special ones included: these vocabularies
    have no decoder that would join them."""
    return " ".join([vocabulary.names[k] for k in ids])


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def bpe_texts(docs: DataFrame, vocabulary_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal, a space between) and decoded text of every row.
    Null and empty texts have no tokens and empty strings. Rows stay as they are, repeated
    ones too; other columns are ignored."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        encoder = Encoder(vocabulary_path)
        for p in pieces:
            found = [encoder.encode(t) for t in p["text"]]
            yield (
                p["doc_id"],
                [sum(e[0] for e in f) for f in found],
                [" ".join([e[1] for e in f]) for f in found],
                [" ".join([e[2] for e in f]) for f in found],
            )

    fields = "doc_id long,n_tokens long,ids string,decoded string"
    return documents_of(docs, id_col, text_col).mapInArrow(rows_like(fields, rows, 32), fields)


def bpe_digests(docs: DataFrame, vocabulary_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """``bpe_texts`` with SHA-256 digests in place of the texts, made where they arise."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        encoder = Encoder(vocabulary_path)
        for p in pieces:
            found = [encoder.encode(t) for t in p["text"]]
            yield (
                p["doc_id"],
                [sum(e[0] for e in f) for f in found],
                [_sha256(" ".join([e[1] for e in f])) for f in found],
                [_sha256(" ".join([e[2] for e in f])) for f in found],
            )

    fields = "doc_id long,n_tokens long,ids_sha256 string,decoded_sha256 string"
    return documents_of(docs, id_col, text_col).mapInArrow(rows_like(fields, rows, 32), fields)
