"""Repeated lines by digest, near-duplicate lines by a segment-partition edit join.

Equal lines of any length are one by their digest. Of two lines the shorter says how many
edits may lie between them (``letter_edits``). It is cut into one segment more than that;
a line within reach holds one of them unchanged, shifted by at most as many places. So
lines meet in regions keyed by (length, segment number, segment): a line enters its own,
and, for each shorter length in reach, those of its substrings at the places an alignment
allows. A banded bit-parallel edit distance verifies what meets.

Longer lines may also differ in words, the more the longer they are (``word_edits``). What
the edits leave untouched holds a run of words whose least length is known; both lines have
the least hash of the word n-grams of that run, and meet in its region, wherever it stands.
From LONG words on that holds for letter edits too, and lines need no segments.

Regions are made and met as arrays (``line_regions``, ``region_pairs``); sketches there tell
most pairs of a region out of reach before texts are fetched for the rest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach_once, rows_like
from gaugeworks.llm.line_regions import (
    _WORDS,
    LONG,  # noqa: F401
    MOST_EDITS,
    SIZE_RATIO,  # noqa: F401  of the rules, with the others
    Letters,
    Lines,
    Words,
    letter_edits,
    letter_regions,
    run_regions,
    word_edits,
)
from gaugeworks.llm.region_pairs import close_classes
from gaugeworks.session import scratch, scratch_path, written


def _as_list(regions: np.ndarray) -> list[int]:
    return regions.view(np.int64).tolist()


def word_regions(lines: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(region, index of the line) of lines as words: per scale the least n-gram hashes of
    all runs."""
    words = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for words in lines for w in words]
    sizes = np.array([len(words) for words in lines], np.int64)
    regions, owners = run_regions(np.array(words, np.uint64), sizes)
    return regions.view(np.int64), owners


def substring_keys(line: str, edits: int) -> list[int]:
    """Regions of a line where lines of all lengths have ``edits`` edits."""
    return _as_list(np.unique(letter_regions(Lines.of_texts([line]), np.zeros(1, int), edits)[0]))


def scaled_keys(line: str) -> list[int]:
    """Regions of a line where each length has its own ``letter_edits``."""
    return _as_list(np.unique(letter_regions(Lines.of_texts([line]), np.zeros(1, int))[0]))


def _same(a: Sequence[str], b: Sequence[str]) -> int:
    """How many items both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        at = (low + high + 1) // 2
        if a[low:at] == b[low:at]:
            low = at
        else:
            high = at - 1
    return low


def within_edits(a: Sequence[str], b: Sequence[str], edits: int) -> bool:
    """Whether the edit distance is at most ``edits``. Bit j of a level is the diagonal
    j - edits of the band; a level's bits are the cells reachable with that many edits."""
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    # what both begin and end with needs no edit
    at = _same(a, b)
    end = _same(a[at:][::-1], b[at:][::-1])
    a, b = a[at : len(a) - end], b[at : len(b) - end]
    if max(len(a), len(b)) <= edits:
        return True
    places: dict[str, int] = {}
    for k, letter in enumerate(b):
        places[letter] = places.get(letter, 0) | 1 << (k + edits)
    band = (1 << (2 * edits + 1)) - 1
    levels = [1 << edits]
    for _ in range(edits):
        levels.append(levels[-1] | levels[-1] << 1 & band)
    for row, letter in enumerate(a):
        # bit j: letter `row` of a equals the letter of b on diagonal j - edits
        equal = places.get(letter, 0) >> row & band
        before, levels[0] = levels[0], levels[0] & equal
        for e in range(1, edits + 1):
            kept = levels[e] & equal
            old = levels[e]
            levels[e] = (kept | before | before >> 1 | levels[e - 1] << 1) & band
            before = old
        if not levels[edits]:
            return False
    end = len(b) - len(a) + edits
    return any(level >> end & 1 for level in levels)


def near(a: str, b: str) -> bool:
    """Whether two lines are within the edits of the shorter, in letters or in words."""
    edits = letter_edits(min(len(a), len(b)))
    at = _same(a, b)
    end = _same(a[at:][::-1], b[at:][::-1])
    if max(len(a), len(b)) - at - end <= edits:
        return True
    # whole words that both begin and end with need no edit either
    at = a.rfind(" ", 0, at) + 1
    cut = a.find(" ", len(a) - end)
    end = len(a) - cut if cut >= 0 else 0
    n_same = len(_WORDS.findall(a, 0, at)) + len(_WORDS.findall(a, len(a) - end))
    a, b = a[at : len(a) - end], b[at : len(b) - end]
    x, y = _WORDS.findall(a), _WORDS.findall(b)
    known, others = set(x), set(y)
    # an edit changes one word, or as a letter three words at most
    changed = max(len(known - others), len(others - known))
    if changed <= 3 * edits and within_edits(a, b, edits):
        return True
    edits = word_edits(n_same + min(len(x), len(y)))
    if not 0 < edits >= changed:
        return False
    if edits > MOST_EDITS:
        # words may repeat, and many edits take long to count
        more = Counter(x)
        more.subtract(y)
        if max(sum(v for v in more.values() if v > 0), -sum(v for v in more.values() if v < 0)) > edits:
            return False
    return within_edits(x, y, edits)


def _region_rows(pieces: Iterator[dict]) -> Iterator[tuple]:
    for p in pieces:
        lines = Lines.of_texts(p["line"])
        regions, ids, notes = [], [], []
        for kind in (Letters, Words):
            found, owners, _, own = kind.rows(lines)
            regions += _as_list(found)
            ids += [p["id"][k] for k in owners.tolist()]
            notes += own.tolist()
        yield regions, ids, notes


def _pair_rows(pieces: Iterator[dict]) -> Iterator[tuple]:
    for p in pieces:
        good = [
            (a, b)
            for a, b, x, y in zip(p["a"], p["b"], p["x"], p["y"], strict=True)
            if near(x, y)
        ]
        yield [a for a, _ in good], [b for _, b in good]


def _plain(line: Column) -> Column:
    # most lines have nothing to replace, which takes less to see than to do
    odd = F.contains(line, F.lit("  "))
    for blank in "\t\n\x0b\x0c\r":
        odd = odd | F.contains(line, F.lit(blank))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    own = F.coalesce(docs[id_col].cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat_ws(":", own, F.coalesce(docs[text_col], F.lit("")))))


def line_classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_key, at, id, keep): every line that is not blank and has others in its class, by
    the number of one line of the class, and whether it is the first of its class."""
    last = F.lit((1 << 63) - 1)
    # keys of rows are made before lines are: Spark would make them again for each line
    whole = docs.select(
        F.coalesce(docs[id_col].cast("long"), last).alias("doc"),
        _row_key(docs, id_col, text_col).alias("row_key"),
        F.split(F.coalesce(docs[text_col], F.lit("")), "\n").alias("lines"),
    )
    spots = F.transform("lines", lambda x, k: F.struct(k.alias("at"), _plain(x).alias("line")))
    lines = whole.select("doc", "row_key", F.explode(spots).alias("spot"))
    lines = lines.select("doc", "row_key", "spot.at", "spot.line").filter(F.col("line") != "")
    lines = lines.withColumn("id", F.unhex(F.md5("line")))
    distinct = lines.groupBy("id").agg(
        F.any_value("line").alias("line"), F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n_rows")
    )
    # regions and pairs, many to a line, hold its number, which takes less than its digest
    distinct = written(distinct.withColumn("number", F.monotonically_increasing_id()), "lines")

    def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
        left = lines.select(F.col("number").alias("a"), F.col("line").alias("x"))
        right = lines.select(F.col("number").alias("b"), F.col("line").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return both.mapInArrow(rows_like("a long,b long", _pair_rows, 1024), "a long,b long")

    items = distinct.select("number", "line")
    roots = close_classes(items, distinct.count(), Lines.of, [Letters, Words], verified)
    roots = roots.withColumnRenamed("node", "number").hint("shuffle_hash")
    named = distinct.select("id", "number", "first", "n_rows").join(roots, "number", "left")
    named = named.withColumn("class", F.coalesce("root", "number")).drop("root", "number")
    named = written(named, "line-classes")
    # classes of one line that occurs once have nothing to drop
    firsts = named.groupBy("class").agg(
        F.min("first").alias("class_first"), F.sum("n_rows").alias("n_rows")
    )
    firsts = firsts.filter("n_rows > 1").withColumnRenamed("n_rows", "class_rows")
    repeated = named.join(firsts, "class").select("id", "class", "class_first", "n_rows")
    spots = lines.select("id", "row_key", "doc", "at")
    placed = attach_once(spots, written(repeated, "repeated"), "id")
    keep = (F.col("doc") == F.col("class_first.doc")) & (F.col("at") == F.col("class_first.at"))
    return placed.select("row_key", "at", F.col("class").alias("id"), keep.alias("keep"))


#: Names that no input column may have; they are gone from the output.
_KEY, _DROPPED = "__line_dedup_row_key", "__line_dedup_dropped_at"


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str = "n_lines",
    dropped_col: str = "n_dropped",
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and the numbers of lines and of
    dropped lines added under the given names (input columns of these names are replaced,
    all others are passed on).

    Lines are compared with white-space runs as one space. Lines that are equal or within
    the ``letter_edits`` or the ``word_edits`` of the shorter one form classes (single
    link); of a class the line of the smallest doc_id, then of the first place, stays. Blank
    lines always stay. A null text stays null and has no lines; an empty one has one. Null
    ids sort last. Rows that repeat both id and text are one document and get equal
    answers. An empty table gives no rows."""
    spark = docs.sparkSession
    with scratch(spark):
        drops = line_classes(docs, id_col, text_col).filter("NOT keep")
        # at most as many numbers as the document has lines
        drops = drops.groupBy(F.col("row_key").alias(_KEY)).agg(F.collect_set("at").alias(_DROPPED))
        drops = written(drops, "dropped-lines", scratch_path(spark, "dropped-lines"))
    others = [c for c in docs.columns if c not in (lines_col, dropped_col)]
    own = docs.select(*[docs[c] for c in others], _row_key(docs, id_col, text_col).alias(_KEY))
    whole = own.join(drops, _KEY, "left")
    lines = F.split(F.col(text_col), "\n")
    kept = F.filter(
        F.transform(lines, lambda x, k: F.struct(x.alias("line"), k.alias("at"))),
        lambda s: ~F.array_contains(_DROPPED, s["at"]),
    )
    text = F.when(F.col(_DROPPED).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda s: s["line"]), "\n")
    )

    def number(found: Column) -> Column:
        return F.greatest(F.coalesce(F.size(found), F.lit(0)), F.lit(0)).cast("long")

    return whole.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in others],
        number(lines).alias(lines_col),
        number(F.col(_DROPPED)).alias(dropped_col),
    )
