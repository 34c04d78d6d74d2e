"""Document quality by Bradley-Terry ranking of preference pairs."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import documents_of, rows_like
from gaugeworks.operators.ordinal import counted_ordinal
from gaugeworks.session import written

_RUN = re.compile(r"([!?.*#=~_-])\1+")


def features(text: str) -> list[float]:
    """Numbers that describe how a whole text is written, none of them its topic."""
    n = max(len(text), 1)
    words = text.split()
    m = max(len(words), 1)
    upper = sum(map(str.isupper, words)) / m
    letters = len(re.findall(r"[^\W\d_]", text)) / n
    digits = len(re.findall(r"[0-9]", text)) / n
    lines = [x for x in text.split("\n") if x.strip()]
    kinds = Counter(words)
    sizes = Counter(lines)
    marks = [text.count(c) / m for c in "!?|.,:;<{@"]
    return [
        np.log1p(m),
        upper,
        letters,
        digits,
        len(text.replace(" ", "")) / n,
        *(min(x, 4.0) for x in marks),
        len(_RUN.findall(text)) / m,
        len(kinds) / m,
        max(kinds.values(), default=0) / m,
        sum(c for c in sizes.values() if c > 1) / max(len(lines), 1),
        np.log1p(m / max(len(lines), 1)),
        sum(map(len, words)) / m / 10,
        sum(1 for w in words if not any(map(str.isalnum, w))) / m,
    ]


@dataclass(frozen=True)
class Ranking:
    """Weights of standardised features, and where and how steeply scores pass 0.3."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        return _wide((rows - self.mean) / self.scale) @ self.weights

    def scores(self, rows: np.ndarray, at_cut: float) -> np.ndarray:
        z = (self.strengths(rows) - self.cut) * self.slope + np.log(at_cut / (1 - at_cut))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _wide(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.hstack([z, np.abs(z)])


#: Rows of the larger side in a bucket, and the least rows of the other side beside them.
BUCKET, BESIDE = 512, 16
#: Sums are taken in whole numbers of this fraction, so their order changes nothing.
FRACTION = 1 << 32
#: Cells that strengths are counted in to place the cut.
CELLS = 1 << 14


def _matrices(pieces: Iterator[dict], ranking: Ranking) -> Iterator[tuple]:
    """Per bucket its rows' standardised features, which are good, which stand here first."""
    width = len(ranking.mean)
    for p in pieces:
        for x, good, first in zip(p["x"], p["good"], p["first"], strict=True):
            rows = np.array(x, np.float64).reshape(-1, width)
            z = _wide((rows - ranking.mean) / ranking.scale)
            yield z, np.array(good, bool), np.array(first, bool)


def _slope_rows(ranking: Ranking):
    """The mean over the pairs of a bucket of the loss, its gradient and its curvature, summed
    over buckets; each good row is paired with each bad one."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        total = None
        for z, good, _ in _matrices(pieces, ranking):
            upper, lower = z[good], z[~good]
            ahead = np.clip((upper @ ranking.weights)[:, None] - (lower @ ranking.weights)[None], -500, 500)
            lost = 1 / (1 + np.exp(ahead))
            bend = lost * (1 - lost)
            slope = upper.T @ lost.sum(1) - lower.T @ lost.sum(0)
            cross = upper.T @ bend @ lower
            curve = (upper.T * bend.sum(1)) @ upper + (lower.T * bend.sum(0)) @ lower - cross - cross.T
            sums = np.concatenate([[np.logaddexp(0, -ahead).sum()], slope, curve.ravel()]) / lost.size
            whole = np.rint(sums * FRACTION).astype(np.int64)
            total = whole if total is None else total + whole
        if total is not None:
            yield list(range(len(total))), total.tolist()

    return rows


def _strength_rows(ranking: Ranking, low: float = 0.0, step: float = 0.0):
    """Rows per side and cell of the strengths; without a step their extremes."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for z, good, first in _matrices(pieces, ranking):
            strength = (z @ ranking.weights)[first]
            if not step:
                yield [0], [False], [float(strength.min())], [float(strength.max())], [0]
                continue
            cells = np.clip(((strength - low) / step).astype(np.int64), 0, CELLS - 1)
            both, n = np.unique(cells * 2 + good[first], return_counts=True)
            nothing = [0.0] * len(n)
            yield (both // 2).tolist(), (both % 2 > 0).tolist(), nothing, nothing, n.tolist()

    return rows


def _buckets(labelled: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """All labelled rows dealt to buckets by their number. The smaller side's stand in as many
    buckets as it takes to have some in each; in the first of them ``first`` is set."""
    n_buckets = -(-max(n_good, n_bad) // BUCKET)
    sides = []
    for good, n in ((True, n_good), (False, n_bad)):
        copies = 1 if n == max(n_good, n_bad) else min(n_buckets, max(1, -(-BESIDE * n_buckets // n)))
        own = counted_ordinal(labelled.filter(F.col("good") == good), "doc_id", name="n")
        own = own.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        sides.append(own.withColumn("bucket", ((F.col("n") - 1) * copies + F.col("copy")) % n_buckets))
    rows = sides[0].unionByName(sides[1])
    held = rows.groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "good", (F.col("copy") == 0).alias("first"), "x"))).alias("r")
    )
    return held.select(F.flatten("r.x").alias("x"), F.col("r.good").alias("good"), F.col("r.first").alias("first"))


def fit(labelled: DataFrame, steps: int = 30) -> Ranking:
    """From (doc_id, good, x), each doc_id once: the weights that minimise the logistic loss of
    good rows ahead of bad ones, by Newton's method on sums that Spark adds up, and the cut of
    the strengths that parts the labels best. Every row takes part in both."""
    width = len(features(""))
    sums = [F.sum(F.col("x")[k].cast("decimal(20,10)")).cast("double").alias(f"s{k}") for k in range(width)]
    squares = [
        F.sum((F.col("x")[k].cast("double") * F.col("x")[k]).cast("decimal(28,10)")).cast("double").alias(f"q{k}")
        for k in range(width)
    ]
    row = labelled.agg(F.count("*").alias("n"), F.count_if("good").alias("good"), *sums, *squares).first()
    if not row.n:
        return Ranking(np.zeros(width), np.ones(width), np.zeros(2 * width), -1.0, 1.0)
    mean = np.array([row[f"s{k}"] for k in range(width)]) / row.n
    spread = np.array([row[f"q{k}"] for k in range(width)]) / row.n - mean**2
    weights = np.zeros(2 * width)
    ranking = Ranking(mean, np.sqrt(np.maximum(spread, 0)) + 1e-6, weights, 0.0, 1.0)
    n_bad = row.n - row.good
    if not (row.good and n_bad):
        return replace(ranking, cut=-1.0 if row.good else 1.0)
    buckets = written(_buckets(labelled, row.good, n_bad), "label-buckets")
    n_buckets = buckets.count()

    def added(made, fields: str, *keys: str, **sums) -> list:
        found = buckets.mapInArrow(rows_like(fields, made, 16), fields)
        return found.groupBy(*keys).agg(*[v.alias(k) for k, v in sums.items()]).collect()

    best, step = np.inf, np.zeros_like(weights)
    for _ in range(steps):
        found = added(_slope_rows(replace(ranking, weights=weights + step)), "k long,v long", "k", v=F.sum("v"))
        total = np.array([r.v for r in sorted(found, key=lambda r: r.k)], np.float64) / FRACTION / n_buckets
        at = weights + step
        loss = total[0] + 5e-4 * at @ at
        if loss > best:
            step = step / 2
            if np.abs(step).max() < 1e-6:
                break
            continue
        slope = total[1 : len(at) + 1] - 1e-3 * at
        curve = total[len(at) + 1 :].reshape(len(at), -1) + 1e-3 * np.eye(len(at))
        best, weights, step = loss, at, np.linalg.solve(curve, slope)
        if np.abs(slope).max() < 1e-6:
            break
    ranking = replace(ranking, weights=weights)
    fields = "cell long,good boolean,low double,high double,n long"
    ends = added(_strength_rows(ranking), fields, low=F.min("low"), high=F.max("high"))[0]
    low = np.floor(ends.low * 1e6) / 1e6
    step = max((np.ceil(ends.high * 1e6) / 1e6 - low) / CELLS, 1e-9)
    counts = np.zeros((2, CELLS))
    for r in added(_strength_rows(ranking, low, step), fields, "cell", "good", n=F.sum("n")):
        counts[int(r.good), r.cell] = r.n
    below = np.cumsum(counts, 1)
    hits = below[0] / n_bad - below[1] / row.good
    # the middle of the cells that part the labels equally well
    top = int(np.argmax(hits))
    after = np.flatnonzero(hits[top:] != hits[top])
    end = top + (after[0] if len(after) else CELLS - top)
    return replace(ranking, cut=float(low + step * (top + 1 + end) / 2))


def _feature_rows(pieces: Iterator[dict]) -> Iterator[tuple]:
    for p in pieces:
        yield p["doc_id"], [features(t) for t in p["text"]]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and features of every row, which both learning and scoring can start from."""
    fields = "doc_id long,x array<float>"
    return documents_of(docs, id_col, text_col).mapInArrow(rows_like(fields, _feature_rows), fields)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", made: DataFrame | None = None,
) -> Ranking:
    """Fit on all labelled documents. Rows without a label or an id do not count. Of
    contradicting labels of an id the greatest counts, of several texts of an id the one with
    the least features.

    Features are made where the texts lie and then meet the labels, so no text is shuffled.
    ``made`` is the ``feature_table`` of the documents, if there is one already."""
    marks = labels.select(
        labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("quality")
    )
    marks = marks.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality IS NOT NULL")
    made = feature_table(docs, id_col, text_col) if made is None else made
    found = made.join(marks, "doc_id").groupBy("doc_id", "quality").agg(F.min("x").alias("x"))
    found = found.select("doc_id", (F.col("quality") > 0).alias("good"), "x")
    return fit(written(found, "labelled"))


def quality_scores(
    docs: DataFrame, ranking: Ranking, id_col="doc_id", text_col="text", threshold: float = 0.3,
    made: DataFrame | None = None,
) -> DataFrame:
    """doc_id, score, predicted per row. Null texts count as empty, which have features of
    their own; repeated rows get equal scores; an empty table gives no rows. A ranking
    without labels of both kinds gives every row the same score. ``made`` is as in ``learn``."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            score = ranking.scores(np.array(p["x"], np.float32).astype(np.float64), threshold)
            yield p["doc_id"], score.tolist(), (score >= threshold).astype(int).tolist()

    fields = "doc_id long,score double,predicted int"
    made = feature_table(docs, id_col, text_col) if made is None else made
    return made.mapInArrow(rows_like(fields, rows), fields)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from: a fifth by the hash of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def good_documents(
    docs: DataFrame, ranking: Ranking, text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """The rows of ``docs`` that the ranking does not reject, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x = [features(t or "") for t in part.column(at).to_pylist()]
                score = ranking.scores(np.array(x, np.float32).astype(np.float64), threshold)
                yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
