"""Benchmark decontamination by latent semantic retrieval.

Texts become passages, overlapping windows of words, weighted by TF-IDF over the words of
the benchmark. A distributed randomised SVD finds the latent space: tasks multiply their
passages by a thin matrix, Spark adds up the products per word. Passages near a benchmark
passage by cosine are candidates, and so is every place that shares GRAM words in a row
with one, whatever the cosine; the longest common subsequence of words and a check of the
closing words, where answers stand, decide. A long verbatim run of an item decides alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import rows_like
from gaugeworks.session import written

_WORDS = re.compile(r"[^\W_]+")
#: Passages of documents: WINDOW words, the next one STRIDE words on.
STRIDE = 16
WINDOW = 4 * STRIDE
#: Words in a row that make a place a candidate.
GRAM = 5
#: Bits of the sketch that bounds how many of a passage's words a place can hold.
SKETCH = 512


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


@dataclass(frozen=True)
class Passage:
    item_id: int | None
    words: np.ndarray
    answer: np.ndarray
    part: int = 0


@dataclass(frozen=True)
class Rules:
    """What counts as found: a common subsequence of ``whole`` of a passage's words, or of
    ``part`` of them if ``answer`` of the closing words are there too, or ``verbatim`` words
    of an item in a row."""

    cosine: float = 0.3
    whole: float = 0.75
    part: float = 0.55
    answer: float = 0.8
    closing: int = 8
    verbatim: int = 13


def gram_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per ``size`` words in a row; 0 where one of them is -1."""
    n = max(len(words) - size + 1, 0)
    keys, known = np.full(n, size, np.uint64), np.ones(n, bool)
    wide = words.astype(np.uint64)
    for k in range(size):
        keys = (keys ^ wide[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
        known &= words[k : k + n] >= 0
    return np.where(known, keys | np.uint64(1), np.uint64(0))


class Places:
    """Where n-grams stand in the queries: for each key the (query, offset) it has."""

    def __init__(self, size: int, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """``rows``: words, and for each n-gram of them its query and its offset there."""
        self.size = size
        keys = np.concatenate([gram_keys(w, size) for w, _, _ in rows])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.query = np.concatenate([q for _, q, _ in rows])[order]
        self.offset = np.concatenate([o for _, _, o in rows])[order]

    def of(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(query, place of its first word, place of the n-gram) for each shared n-gram."""
        keys = gram_keys(words, self.size)
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for at in np.flatnonzero((high > low) & (keys > 0)).tolist():
            for k in range(low[at], high[at]):
                yield int(self.query[k]), at - int(self.offset[k]), at


def gram_places(queries: list[Passage]) -> Places:
    """The n-grams of GRAM words of each passage."""
    rows = []
    for k, q in enumerate(queries):
        n = max(len(q.words) - GRAM + 1, 0)
        rows.append((q.words, np.full(n, k), np.arange(n)))
    return Places(GRAM, rows)


def verbatim_places(queries: list[Passage], size: int) -> Places:
    """The runs of ``size`` words of whole items, each at the passage of its middle word."""
    rows, k = [], 0
    while k < len(queries):
        end = k + 1
        while end < len(queries) and queries[end].part > 0:
            end += 1
        words = np.concatenate([q.words for q in queries[k:end]])
        starts = np.cumsum([0] + [len(q.words) for q in queries[k:end]])
        begin = np.arange(max(len(words) - size + 1, 0))
        at = np.searchsorted(starts, begin + size // 2, "right") - 1
        rows.append((words, k + at, begin - starts[at]))
        k = end
    return Places(size, rows)


def passages(items: list[tuple], vocabulary: dict[str, int], closing: int) -> list[Passage]:
    """Items cut into passages of at most WINDOW words, all of about the same length."""
    out = []
    for item_id, text in items:
        ids = np.array([vocabulary[w] for w in words_of(text or "")], np.int32)
        cuts = -(-len(ids) // WINDOW)
        for k, part in enumerate(np.array_split(ids, cuts) if cuts else []):
            out.append(Passage(item_id, part, part[-closing:], k))
    return out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence; the bits of one number are a column."""
    places: dict[int, int] = {}
    for k, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(a)) - 1
    column = full
    for w in b.tolist():
        hit = places.get(w)
        if hit:
            both = column & hit
            column = (column + both | column - both) & full
    return len(a) - column.bit_count()


def _encoded_rows(vocabulary: dict[str, int]):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        get = vocabulary.get
        for p in pieces:
            ids = [
                np.fromiter((get(w, -1) for w in words_of(t)), np.int32) for t in p["text"]
            ]
            yield p["doc_id"], p["text_key"], [x.tobytes() for x in ids]

    return rows


def _frequency_rows(size: int):
    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        counts = np.zeros(size + 1, np.int64)
        for p in pieces:
            for raw in p["words"]:
                counts[np.unique(np.frombuffer(raw, np.int32))] += 1
        used = np.flatnonzero(counts[:size])
        yield used.tolist(), counts[used].tolist()

    return rows


def _blocks(words: np.ndarray, table: np.ndarray, at_once: int = 4096) -> np.ndarray:
    """Sums of table rows per STRIDE words; the last row of the table stands for -1."""
    n = max(-(-len(words) // STRIDE), 1)
    padded = np.full(n * STRIDE, -1, np.int32)
    padded[: len(words)] = words
    grid = padded.reshape(n, STRIDE)
    return np.concatenate([table[grid[k : k + at_once]].sum(1) for k in range(0, n, at_once)])


def _windows(blocks: np.ndarray, width: int) -> np.ndarray:
    if len(blocks) <= width:
        return blocks.sum(0, keepdims=True)
    total = np.concatenate([np.zeros_like(blocks[:1]), np.cumsum(blocks, 0)])
    return total[width:] - total[:-width]


def window_sums(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """One row per passage: passage k starts at word k * STRIDE."""
    return _windows(_blocks(words, table), WINDOW // STRIDE)


def _product_rows(idf: np.ndarray, thin: np.ndarray):
    """Per task: the rows of A' (A thin) for the words it saw."""
    table = np.vstack([idf[:, None] * thin, np.zeros((1, thin.shape[1]))])

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        total = np.zeros_like(table)
        width = WINDOW // STRIDE
        for p in pieces:
            products, at, of, base = [], [], [], 0
            for raw in p["words"]:
                words = np.frombuffer(raw, np.int32)
                known = np.flatnonzero(words >= 0)
                if not len(known):
                    continue
                sums = window_sums(words, table)
                # a word counts in each passage that holds its block
                n = max(-(-len(words) // STRIDE), 1)
                run = np.concatenate([np.zeros_like(sums[:1]), np.cumsum(sums, 0)])
                block = np.arange(n)
                high = np.minimum(block, len(sums) - 1) + 1
                low = np.clip(block - width + 1, 0, len(sums))
                if n <= width:
                    high, low = np.ones(n, int), np.zeros(n, int)
                products.append(run[high] - run[low])
                of.append(words[known])
                at.append(base + known // STRIDE)
                base += n
            if products:
                # the rows of each word, side by side
                per_block, word, block = map(np.concatenate, (products, of, at))
                order = np.argsort(word, kind="stable")
                word = word[order]
                starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                total[word[starts]] += np.add.reduceat(per_block[block[order]], starts)
        total = total[:-1] * idf[:, None]
        used = np.flatnonzero(np.abs(total).sum(1))
        yield used.tolist(), [v.tolist() for v in total[used]]

    return rows


def latent_space(
    fitted: DataFrame, queries: list[Passage], idf: np.ndarray, rank: int, rounds: int
) -> np.ndarray:
    """Words by ``rank``: an orthonormal basis of the leading right singular space of the
    passages of all rows of ``fitted`` and the queries, by randomised subspace iteration."""
    rank = min(rank, len(idf))
    thin = np.linalg.qr(np.random.default_rng(11).standard_normal((len(idf), rank)))[0]
    fields = "word long,row array<double>"
    for _ in range(rounds):
        rows = fitted.select("words").mapInArrow(rows_like(fields, _product_rows(idf, thin)), fields)
        summed = rows.groupBy("word").agg(
            F.array(*[F.sum(F.col("row")[k]) for k in range(rank)]).alias("row")
        )
        # as many rows as the block of queries has words
        product = np.zeros_like(thin)
        for word, row in summed.collect():
            product[word] = row
        for q in queries:
            weights = np.bincount(q.words, minlength=len(idf)) * idf
            product += np.outer(weights, weights @ thin)
        thin = np.linalg.qr(product)[0]
    return thin


class Sketches:
    """An upper bound of the common subsequence of a passage and a place, for many pairs at
    once: how many words of the passage fall on bits that words of the place have set."""

    def __init__(self, queries: list[Passage], n_words: int):
        self.bit = (np.arange(n_words) * 0x9E3779B1 % (1 << 32)) * SKETCH >> 32
        self.counts = np.zeros((len(queries), SKETCH), np.int16)
        for k, q in enumerate(queries):
            np.add.at(self.counts[k], self.bit[q.words], 1)
        # whole numbers of a passage's length at most, so exact
        self.weights = self.counts.T.astype(np.float32)

    def places(self, words: np.ndarray, width: int) -> np.ndarray:
        """Per passage of ``width`` blocks: the bits of its words and of a block at each side."""
        n = max(-(-len(words) // STRIDE), 1)
        own = np.zeros((n + width + 1, SKETCH), np.int16)
        at = np.flatnonzero(words >= 0)
        own[at // STRIDE + 1, self.bit[words[at]]] = 1
        held = np.zeros((max(n - width, 0) + 1, SKETCH), np.int16)
        for k in range(width + 2):
            part = own[k : k + len(held)]
            held[: len(part)] |= part
        return held

    def all_bounds(self, held: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """``bounds`` of each of ``held`` with each of ``chosen``, as one product."""
        return held.astype(np.float32) @ self.weights[:, chosen]

    def bounds(self, held: np.ndarray, chosen: np.ndarray, at_once: int = 4096) -> np.ndarray:
        """``held`` are rows of places, ``chosen`` the passages they are paired with."""
        parts = [
            np.einsum("ij,ij->i", held[k : k + at_once], self.counts[chosen[k : k + at_once]])
            for k in range(0, len(chosen), at_once)
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.int16)


def _match_rows(queries: list[Passage], idf: np.ndarray, thin: np.ndarray, rules: Rules):
    table = np.vstack([idf[:, None] * thin, np.zeros((1, thin.shape[1]))]).astype(np.float64)
    wanted = np.array([table[q.words].sum(0) for q in queries])
    wanted /= np.linalg.norm(wanted, axis=1, keepdims=True) + 1e-12

    # queries are looked for in passages of about their length, or the rest would drown them
    fits = np.array([min(-(-(len(q.words) + STRIDE // 2) // STRIDE), WINDOW // STRIDE) for q in queries])
    scales = [(int(width), np.flatnonzero(fits == width)) for width in np.unique(fits)]
    shared, runs = gram_places(queries), verbatim_places(queries, rules.verbatim)
    sketches = Sketches(queries, len(idf))
    least = np.array([rules.part * len(q.words) for q in queries])

    def candidates(words: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
        blocks = _blocks(words, table)
        for width, chosen in scales:
            if not len(chosen):
                continue
            sums = _windows(blocks, width)
            sums = sums / (np.linalg.norm(sums, axis=1, keepdims=True) + 1e-12)
            held = None
            for begin in range(0, len(sums), 4096):
                near = sums[begin : begin + 4096] @ wanted[chosen].T
                close = near >= rules.cosine
                if not close.any():
                    continue
                held = sketches.places(words, width) if held is None else held
                # only pairs that can reach the least share of words in common
                able = sketches.all_bounds(held[begin : begin + len(near)], chosen) >= least[chosen] - 1e-9
                for k, j in zip(*(x.tolist() for x in np.nonzero(able & close)), strict=True):
                    yield (begin + k) * STRIDE, int(chosen[j]), float(near[k, j]), width * STRIDE

    def exact(words: np.ndarray) -> Iterator[tuple[int, int, float | None, int, bool]]:
        """As ``candidates``, by words in a row, and whether a verbatim run stands there."""
        seen = set()
        for places, is_run in ((runs, True), (shared, False)):
            for q, at, _ in places.of(words):
                if (q, at) not in seen:
                    seen.add((q, at))
                    yield at, q, None, len(queries[q].words), is_run

    def of(words: np.ndarray) -> dict:
        found: dict = {}
        near = ((*c, False) for c in candidates(words))
        for at, q, cosine, size, is_run in chain(near, exact(words)):
            query = queries[q]
            region = words[max(at - STRIDE, 0) : max(at + size + STRIDE, 0)]
            region = region[region >= 0]
            share = common_subsequence(query.words, region) / len(query.words)
            if share < rules.part and not is_run:
                continue
            closing = common_subsequence(query.answer, region) / len(query.answer)
            if share >= rules.whole or closing >= rules.answer or is_run:
                if cosine is None:
                    own = table[words[max(at, 0) : max(at + size, 0)]].sum(0)
                    cosine = float(own @ wanted[q] / (np.linalg.norm(own) + 1e-12))
                best = (share, cosine, closing >= rules.answer)
                found[query.item_id] = max(found.get(query.item_id, best), best)
        return found

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            out = [
                (doc, key, item, *best)
                for doc, key, raw in zip(p["doc_id"], p["text_key"], p["words"], strict=True)
                for item, best in of(np.frombuffer(raw, np.int32)).items()
            ]
            yield tuple(map(list, zip(*out, strict=True))) if out else ([],) * 6

    return rows


_MATCH = "doc_id long,text_key binary,item_id long,lcs_share double,cosine double,answer_found boolean"


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rules: Rules = Rules(),
    rank: int = 64,
    rounds: int = 2,
    block_items: int = 5000,
) -> DataFrame:
    """(doc_id, text_key, item_id, lcs_share, cosine, answer_found): the benchmark items
    that documents hold, each pair once per row of ``docs``, by its best passage.

    All passages of all rows are searched, by cosine and by words in a row; word statistics
    cover all rows, and the latent space is fitted on all rows and all items. The benchmark is a query set, taken in blocks of about ``block_items``. Null and empty
    texts and items match nothing; repeated items match alike; empty tables give no rows;
    other columns are ignored."""
    spark = docs.sparkSession
    items = benchmark.select(
        benchmark[item_col].cast("long").alias("item_id"), benchmark[item_text_col].alias("text")
    ).filter("text IS NOT NULL")
    own = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        _key(docs[text_col]).alias("text_key"),
        docs[text_col].alias("text"),
    ).filter("text <> ''")
    blocks = max(1, -(-items.count() // block_items))
    every = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct()
        texts = sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        names = sorted({w for _, text in texts for w in words_of(text)})
        vocabulary = {w: k for k, w in enumerate(names)}
        queries = passages(texts, vocabulary, rules.closing)
        if not queries:
            continue
        fields = "doc_id long,text_key binary,words binary"
        encoded = written(own.mapInArrow(rows_like(fields, _encoded_rows(vocabulary), 64), fields), "words")
        n_docs = encoded.count()
        fields = "word long,n long"
        found = encoded.select("words").mapInArrow(rows_like(fields, _frequency_rows(len(names))), fields)
        seen = np.zeros(len(names))
        for word, n in found.groupBy("word").agg(F.sum("n")).collect():
            seen[word] = n
        idf = np.log((1 + n_docs) / (1 + seen)) + 1e-3
        thin = latent_space(encoded, queries, idf, rank, rounds)
        matches = encoded.mapInArrow(rows_like(_MATCH, _match_rows(queries, idf, thin, rules), 64), _MATCH)
        matches = written(matches, "matches")
        every = matches if every is None else every.unionByName(matches)
    return spark.createDataFrame([], _MATCH) if every is None else every


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    matches = contaminated(docs, benchmark, text_col=text_col, **options)
    found = matches.select("text_key").distinct()
    return docs.join(found, _key(docs[text_col]) == found["text_key"], "left_anti")
