"""Jaccard metric-space join of word-shingle sets.

Jaccard distance is a metric on sets. Pivots that are documents tell nothing here: texts
that are no copies are all at distance 1 from them, so every window would take in every
text. The pivots are therefore the sets of one shingle each: a document lies at distance
1 - 1/n from a pivot whose shingle it has and at 1 from all others. Its Voronoi cell is
that of its nearest pivot, ties going to the rarer shingle. By the triangle inequality a
partner within distance r lacks at most r * n of its shingles, so replicating a document
to its next floor(r * n) cells makes all partners meet. Within a cell, a document of it
serves as next pivot, and so on (``linking.link_classes``), until the rest joins exactly.

Sets are compared only for pairs that may reach the ratio: counts of shingles per bin of
hashes, a few per bin, bound an intersection from above at a twentieth of the sets' size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach, documents_of, rows_like
from gaugeworks.llm.linking import link_classes
from gaugeworks.llm.shingles import U64, WordHashes, mix, shingle_set
from gaugeworks.session import scratch, scratch_path, written

#: Bits of a cell number of the frequency sketch that orders the pivots (1 MB in all).
SKETCH_BITS = 17


#: A pair is looked at if it shares this many cells; documents go to as many more.
SHARES = 3


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def bin_counts(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each bin of the hashes' first bits, some three to a bin.
    Nothing, which bounds nothing, if a count is beyond a byte."""
    bits = max(len(shingles) // 3, 1).bit_length()
    counts = np.bincount((shingles >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def may_link(n: int, m: int, bins: bytes, others: bytes, num: int, den: int) -> bool:
    """Whether sets of ``n`` and ``m`` shingles with these ``bin_counts`` can be in reach: of
    a bin they share at most the smaller count."""
    both = min(n, m)
    if bins and others:
        x, y = sorted((np.frombuffer(bins, np.uint8), np.frombuffer(others, np.uint8)), key=len)
        if len(x) < len(y):
            y = y.reshape(len(x), -1).sum(1, dtype=np.int64)
        both = int(np.minimum(x, y).sum(dtype=np.int64))
    return den * both >= num * (n + m - both)


def _note_rows(size: int):
    """Per row its id, set size, digest and bins; last, per task, the counts of the sketch."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        counts, hashes = np.zeros(1 << SKETCH_BITS, np.int64), WordHashes()
        for p in pieces:
            sets = [shingle_set(t, size, hashes) for t in p["text"]]
            for s in sets:
                np.add.at(counts, _cells(s), 1)
            nothing = [None] * len(sets)
            bins = [bin_counts(s) for s in sets]
            yield p["doc_id"], [len(s) for s in sets], [_digest(s) for s in sets], bins, nothing, nothing
        used = np.flatnonzero(counts)
        for at in range(0, len(used), 65536):
            part = used[at : at + 65536]
            nothing = [None] * len(part)
            yield nothing, nothing, nothing, nothing, part.tolist(), counts[part].tolist()

    return rows


def _set_rows(size: int):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        hashes = WordHashes()
        for p in pieces:
            sets = [shingle_set(t, size, hashes) for t in p["text"]]
            yield [_digest(s) for s in sets], [s.tobytes() for s in sets]

    return rows


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> U64(64 - SKETCH_BITS)).astype(np.int64)


def _region_rows(size: int, order, num: int, den: int):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        counts, hashes = order.value, WordHashes()
        for p in pieces:
            regions, ids, sizes = [], [], []
            for text in p["text"]:
                s = shingle_set(text, size, hashes)
                reach = min(len(s), len(s) - -(-num * len(s) // den) + SHARES)
                nearest = np.lexsort((s, counts[_cells(s)]))[:reach]
                regions += s[nearest].view(np.int64).tolist()
                ids += [_digest(s)] * reach
                sizes += [len(s)] * reach
            yield regions, ids, sizes

    return rows


def _able_rows(num: int, den: int):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            of = zip(p["a"], p["b"], p["n"], p["m"], p["bins"], p["others"], strict=True)
            good = [(a, b) for a, b, *known in of if may_link(*known, num, den)]
            yield [a for a, _ in good], [b for _, b in good]

    return rows


def _pair_rows(num: int, den: int):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            a, b = [], []
            for x, y, s, t in zip(p["a"], p["b"], p["sa"], p["sb"], strict=True):
                s, t = np.frombuffer(s, U64), np.frombuffer(t, U64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if den * both >= num * (len(s) + len(t) - both):
                    a.append(x)
                    b.append(y)
            yield a, b

    return rows


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    num: int = 90,
    den: int = 100,
) -> DataFrame:
    """doc_id, n_shingles, component_id per row: two documents link if den * intersection
    >= num * union of their shingle sets; component_id is the smallest doc_id reachable.

    Null and empty texts have no shingles and link with nothing; component_id is their own
    id. Equal sets form one class first, so copies are compared once. Repeated rows get
    equal answers; null ids sort last (their component is null only if it has no other id).
    No rows give no rows; other columns are ignored. Shingles are 64-bit hashes."""
    spark = docs.sparkSession
    own = documents_of(docs, id_col, text_col)
    fields = "doc_id long,n_shingles long,digest binary,bins binary,cell long,n long"
    noted = written(own.mapInArrow(rows_like(fields, _note_rows(words), 64), fields), "shingle-notes")
    made = noted.filter("cell IS NULL").select("doc_id", "n_shingles", "digest", "bins")
    full = made.filter("n_shingles > 0")
    with scratch(spark):
        members = full.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"),
            F.count("*").alias("n_rows"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("bins").alias("bins"),
        )
        members = written(members, "set-classes")
        groups = members.select("digest", "first_id")
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        # at most one number per cell, whatever the size of the data
        table = noted.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        counts[table["cell"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
        order = spark.sparkContext.broadcast(counts)
        fields = "region long,id binary,size long"
        regions = own.mapInArrow(rows_like(fields, _region_rows(words, order, num, den), 64), fields)

        def verified(pairs: DataFrame) -> DataFrame:
            right = members.select(F.col("digest").alias("b"), F.col("n_shingles").alias("m"), F.col("bins").alias("others"))
            left = members.select(F.col("digest").alias("a"), F.col("n_shingles").alias("n"), "bins")
            able = pairs.join(right, "b").join(left, "a").select("a", "b", "n", "m", "bins", "others")
            fields = "a binary,b binary"
            able = written(able.mapInArrow(rows_like(fields, _able_rows(num, den), 1024), fields), "able")
            # sets are made again for those documents only that have a possible partner
            ids = able.select(F.col("a").alias("id")).unionByName(able.select(F.col("b").alias("id")))
            ids = written(ids.distinct(), "wanted")
            first = groups.join(ids.withColumnRenamed("id", "digest"), "digest").select(
                F.col("first_id").alias("wanted")
            )
            texts = own.join(first.distinct(), own["doc_id"].eqNullSafe(F.col("wanted")), "left_semi")
            sets = texts.mapInArrow(
                rows_like("id binary,shingles binary", _set_rows(words), 64), "id binary,shingles binary"
            )
            # rows that repeat a doc_id may hold the same set again
            sets = written(sets.join(ids, "id", "left_semi").dropDuplicates(["id"]), "sets")
            left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
            right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
            both = able.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")
            return both.mapInArrow(rows_like(fields, _pair_rows(num, den), 64), fields)

        classes = link_classes(regions, lambda _: verified, num / den - 1e-9, shares=SHARES, costly=True)
        named = groups.join(classes.withColumnRenamed("id", "digest"), "digest", "left")
        named = named.select("digest", "first_id", F.coalesce("root", "digest").alias("class"))
        named = written(named, "named")
        smallest = named.groupBy("class").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n_rows"))
        by_set = attach(named.select("digest", "class"), written(smallest, "smallest"), "class")
        by_set = by_set.select("digest", "component_id").join(members.select("digest", "n_rows"), "digest")
        by_set = written(by_set, "by-set", scratch_path(spark, "by-set"))
    answered = attach(full.select("digest", "doc_id", "n_shingles"), by_set, "digest")
    empty = made.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return answered.select("doc_id", "n_shingles", "component_id").unionByName(empty)
