"""Token counts of whole texts, huge ones by overlapping chunks that are spliced.

A text is encoded as its pieces say. Huge texts are cut into overlapping chunks, which
tasks encode apart with offsets. Neighbours are spliced where both have a token boundary
that is proven stable: no piece of the vocabulary has the two letters around it next to
each other, so no merge can cross it, whatever the context. Where an overlap has no such
boundary, it is widened, in the end to the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import documents_of, rows_like
from gaugeworks.session import written

#: The letter that stands for a space in pieces.
SPACE = "▁"
#: The segment of one space at the end of a text.
SPACE_AT_END = " "
_SEGMENTS = re.compile(" *[^ ]+| +")


@cache
def model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def inner_pairs(path: str) -> frozenset[str]:
    """Pairs of letters that stand next to each other inside some piece."""
    sp = model(path)
    names = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_byte(i))
    return frozenset(name[k : k + 2] for name in names for k in range(len(name) - 1))


class Counts(dict):
    """Tokens of a text between stable boundaries. The boundary before a run of spaces is
    stable if no piece has a space after another letter, which is checked here."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        self.sp, self.most = model(path), most
        if any(p[1] == SPACE and p[0] != SPACE for p in inner_pairs(path)):
            raise ValueError("a piece of this vocabulary holds a space inside")

    def __missing__(self, segment: str) -> int:
        if len(self) >= self.most:
            self.clear()
        if segment == SPACE_AT_END:
            # alone it would be an empty text to the library
            found = len(self.sp.encode("a ")) - len(self.sp.encode("a"))
        else:
            # the library puts one space in front itself
            found = len(self.sp.encode(segment[1:]))
        if len(segment) <= 1000:
            self[segment] = found
        return found

    def of(self, text: str) -> int:
        if not text:
            return 0
        plain = " " + text.replace(SPACE, " ")
        if "  " in plain or plain[-1] == " ":
            return sum(map(self.__getitem__, _SEGMENTS.findall(plain)))
        return sum([self[f" {word}"] for word in plain[1:].split(" ")])


def _whole(path: str):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        counts = Counts(path)
        for p in pieces:
            yield p["doc_id"], p["n_bytes"], [counts.of(t) for t in p["text"]]

    return rows


def stable_boundaries(text: str, pairs: frozenset[str]) -> list[int]:
    """Offsets between two letters that no piece has next to each other."""
    plain = text.replace(" ", SPACE)
    return [k for k in range(1, len(plain)) if plain[k - 1 : k + 1] not in pairs]


def _chunk_rows(path: str):
    """Per chunk: the tokens up to the first stable boundary of its head overlap, up to that
    of its tail overlap and in all. -1 where an overlap has none. Both neighbours see the
    same letters there, so they choose the same boundary; it must be one in their tokens."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        sp, pairs = model(path), inner_pairs(path)

        def cut(text: str, begin: int, end: int, ends: dict[int, int]) -> tuple[int, int]:
            # a letter before and behind the overlap may differ in a neighbour
            for at in stable_boundaries(text[begin:end], pairs):
                if begin + at in ends:
                    return begin + at, ends[begin + at]
            return -1, -1

        for p in pieces:
            out: list[tuple] = []
            for doc, start, head, tail, text in zip(
                p["doc_id"], p["start"], p["head"], p["tail"], p["text"], strict=True
            ):
                # offsets in letters, not in bytes
                tokens = sp.encode(text, return_type="offset_mapping")["offsets"]
                ends = {end: k for k, (_, end) in enumerate(tokens, 1)}
                left = cut(text, 0, head, ends) if head else (0, 0)
                right = cut(text, len(text) - tail, len(text), ends) if tail else (len(text), len(tokens))
                at_left = start + left[0] if left[0] >= 0 else -1
                at_right = start + right[0] if right[0] >= 0 else -1
                out.append((doc, start, at_left, left[1], at_right, right[1]))
            yield tuple(zip(*out, strict=True))

    return rows


_CHUNK_FIELDS = "doc_id long,start long,at_left long,n_left long,at_right long,n_right long"


def spliced_counts(huge: DataFrame, path: str, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """(row_id, n_tokens) of huge texts with a unique ``row_id``. A document of which some
    overlap has no common stable boundary goes round again with chunks and overlaps eight
    times as long; one chunk in the end is the whole text."""
    done = None
    length = F.char_length("text")
    while True:
        # positions 0, chunk, 2 chunk, ...; a chunk reaches overlap letters into the next
        last = F.greatest(F.lit(0), F.ceil((length - overlap_chars) / chunk_chars) - 1).cast("int")
        starts = huge.select(
            F.col("row_id").alias("doc_id"), "text", length.alias("chars"),
            F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda k: k * chunk_chars)).alias("k", "start"),
        )
        size = F.least(F.col("chars") - F.col("start"), F.lit(chunk_chars + overlap_chars))
        is_last = F.col("start") + chunk_chars + overlap_chars >= F.col("chars")
        chunks = starts.select(
            "doc_id",
            F.col("start").cast("long").alias("start"),
            F.when(F.col("k") > 0, overlap_chars).otherwise(0).alias("head"),
            F.when(is_last, 0).otherwise(overlap_chars).alias("tail"),
            F.substring("text", F.col("start") + 1, size).alias("text"),
        ).repartition("doc_id", "start")
        cuts = written(chunks.mapInArrow(rows_like(_CHUNK_FIELDS, _chunk_rows(path), 8), _CHUNK_FIELDS), "cuts")
        # where a chunk ends, the next begins: the sums of both ends meet
        whole = cuts.groupBy("doc_id").agg(
            F.min(F.least("at_left", "at_right")).alias("worst"),
            (F.sum("at_right") - F.sum("at_left")).alias("covered"),
            (F.sum("n_right") - F.sum("n_left")).alias("n_tokens"),
        )
        known = huge.select(F.col("row_id").alias("doc_id"), length.alias("chars")).join(whole, "doc_id")
        fine = (F.col("worst") >= 0) & (F.col("covered") == F.col("chars"))
        known = written(known.select("doc_id", "n_tokens", fine.alias("fine")), "splices")
        good = known.filter("fine").select(F.col("doc_id").alias("row_id"), "n_tokens")
        done = good if done is None else done.unionByName(good)
        bad = known.filter("NOT fine").select(F.col("doc_id").alias("row_id"))
        if bad.isEmpty():
            return done
        huge = written(huge.join(bad, "row_id", "left_semi"), "unaligned")
        chunk_chars, overlap_chars = chunk_chars * 8, overlap_chars * 8


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    huge_chars: int = 32768,
    overlap_chars: int = 512,
    limit: int = 4096,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row; null counts as empty, with no tokens.
    Texts over ``huge_chars`` are chunked. Repeated rows are counted each; an empty table
    gives no rows; other columns are ignored."""
    own = documents_of(docs, id_col, text_col)
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    long = F.char_length("text") > huge_chars
    small = own.filter(~long).select("doc_id", "text", n_bytes)
    fields = "doc_id long,n_bytes long,n_tokens long"
    counted = small.mapInArrow(rows_like(fields, _whole(model_path)), fields)
    # a row number that stays: the rows are written before they are used twice
    huge = written(own.filter(long).withColumn("row_id", F.monotonically_increasing_id()), "huge")
    pieces = spliced_counts(huge.select("row_id", "text"), model_path, huge_chars, overlap_chars)
    rest = huge.select("row_id", "doc_id", n_bytes).join(pieces, "row_id").drop("row_id")
    both = counted.unionByName(rest)
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
