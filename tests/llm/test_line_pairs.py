"""Candidate pairs of lines: none in reach is missed, unlike ones make no rows, and dense
regions make no square of pairs."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from gaugeworks.llm import line_dedup, region_pairs
from gaugeworks.llm.line_regions import Letters, Lines, Words


def _changed(pick, line, edits):
    for _ in range(edits):
        at = pick.randrange(1, len(line) - 1)
        line = line[:at] + pick.choice(["", " ", "x", "漢"]) + line[at + pick.randint(0, 1) :]
    return " ".join(line.split())


def _some_lines(pick, n):
    out = set()
    while len(out) < n:
        size = pick.choice([3, 6, 8, 12, 13, 23, 25, 45, 49, 50, 52, 75])
        words = ["".join(pick.choices("abcdeéfgh漢", k=pick.randint(1, 7))) for _ in range(size)]
        line = " ".join(words)
        out.add(line)
        for _ in range(3):
            other = _changed(pick, line, pick.randint(0, 3)).split()
            other[pick.randrange(len(other))] = pick.choice(["new", "other", ""])
            out |= {_changed(pick, line, pick.randint(1, 3)), " ".join(" ".join(other).split())}
    return sorted(x for x in out if x)


def _members(lines, kind):
    regions, of, sketches, notes = kind.rows(Lines.of_texts(lines))
    order = np.argsort(regions, kind="stable")
    regions, of = regions[order], of[order].astype(np.int64)
    return region_pairs.Members(regions, of, sketches[order], notes[order], of)


def _pairs(lines):
    found = set()
    for kind in (Letters, Words):
        for a, b, _ in region_pairs.region_pairs(_members(lines, kind), kind, 0, last=True):
            found |= set(zip(a.tolist(), b.tolist(), strict=True))
    return found


def _roots(n, pairs):
    root = list(range(n))

    def of(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        root[max(of(a), of(b))] = min(of(a), of(b))
    return [of(k) for k in range(n)]


def test_words_of_a_batch_are_those_of_its_lines():
    lines = _some_lines(random.Random(1), 80) + ["漢字 ab", "a", "字"]
    made = Lines.of_texts(lines)
    assert made.n_words.tolist() == [len(line_dedup._WORDS.findall(x)) for x in lines]
    words = [w for x in lines for w in line_dedup._WORDS.findall(x)]
    assert len(set(made.words.tolist())) == len(set(words)) == len(set(zip(words, made.words.tolist(), strict=True)))


def test_every_pair_in_reach_is_a_candidate():
    lines = _some_lines(random.Random(2), 260)
    near = {(a, b) for a in range(len(lines)) for b in range(a) if line_dedup.near(lines[a], lines[b])}
    assert len(near) > 100 and near <= _pairs(lines)


def test_unlike_lines_that_share_a_segment_are_no_candidates():
    pick = random.Random(3)
    lines = ["one common beginning " + "".join(pick.choices("abcdefgh ", k=42)) for _ in range(300)]
    regions = _members(lines, Letters).regions
    assert len(np.unique(regions, return_counts=True)[1].nonzero()[0]) < len(regions)
    assert len(_pairs(lines)) < 20


def test_a_dense_region_gives_a_pair_per_member_first():
    pick = random.Random(4)
    words = [f"word{k}" for k in range(30)]
    lines = [" ".join(words[:12] + [f"own{k}"] + words[13:]) for k in range(400)]
    m = _members(lines, Words)
    rows = [len(a) for a, _, _ in region_pairs.region_pairs(m, Words, 0)]
    assert sum(rows) <= len(m.ids) and sum(rows) < 400 * 399 // 2
    assert pick


def test_classes_are_those_of_all_pairs(spark):
    pick = random.Random(5)
    lines = _some_lines(pick, 120)
    words = [f"word{k}" for k in range(30)]
    # a dense region whose members are not all in one class
    for k in range(200):
        other = list(words)
        for at in pick.sample(range(12, 30), k % 5):
            other[at] = f"own{k % 7}{at}"
        lines.append(" ".join(other))
    lines = list(dict.fromkeys(lines))
    near = [(a, b) for a in range(len(lines)) for b in range(a) if line_dedup.near(lines[a], lines[b])]
    roots = _roots(len(lines), near)
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id long, text string")
    out = line_dedup.line_dedup(docs).select("doc_id", F.col("n_dropped")).collect()
    assert {r.doc_id for r in out if not r.n_dropped} == set(roots)
