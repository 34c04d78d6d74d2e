"""SimHash classes against all pairs, and their edge cases."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gaugeworks.llm import queries, simhash

SCHEMA = "doc_id long, text string, fp string, part int, bucket string, n_rows long"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + width]), 42) for k in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, distance=3):
    """{row: smallest id of its class} by comparing all pairs."""
    fps = [plain_fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        least.setdefault(find(k), []).append(doc)
    named = {r: min((d for d in docs if d is not None), default=None) for r, docs in least.items()}
    return sorted(
        ((doc, f"{fps[k]:016x}", named[find(k)]) for k, (doc, _) in enumerate(rows)), key=str
    )


def near_texts(seed, groups, copies):
    """Groups of texts of which some words differ, so that fingerprints differ by few bits."""
    pick = random.Random(seed)
    texts = []
    for g in range(groups):
        words = [f"W{pick.randrange(60)}" for _ in range(pick.choice([2, 30, 90, 200]))]
        for _ in range(copies):
            changed = list(words)
            for _ in range(pick.randrange(3)):
                changed[pick.randrange(len(words))] = f"x{pick.randrange(999)}"
            texts.append(pick.choice([" ", "\n", "\t "]).join(changed))
    pick.shuffle(texts)
    return texts


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in rows], SCHEMA).repartition(3)


def got(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_fingerprint_of_long_texts_is_made_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    for text in near_texts(3, 6, 2):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("dense", [4096, 3])
def test_classes_equal_all_pairs(spark, dense):
    rows = list(enumerate(near_texts(1, 12, 8)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One"), (903, "One"), (None, "one"), (None, "lone wolf here")]
    out = simhash.near_classes(frame(spark, rows), dense=dense)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert got(out) == plain_classes(rows)


def test_dense_buckets_are_cut_without_loss(spark):
    """Fingerprints that share nearly all bits: every bucket stays dense to the last cut."""
    pick = random.Random(5)
    fps = {pick.getrandbits(64) for _ in range(5)}
    for _ in range(150):
        fps.add(pick.choice(sorted(fps)) ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)))
    fps = [simhash._signed(f) for f in sorted(fps)]
    near = spark.createDataFrame([(f,) for f in fps], "fp long")
    for dense in (2, 10):
        links = {tuple(r) for r in simhash.near_links(near, 3, dense=dense).collect()}
        assert _parts(fps, links) == _parts(
            fps, [(a, b) for a in fps for b in fps if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
        )


def _parts(nodes, links):
    root = {n: n for n in nodes}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_thresholds_leave_out_a_partition_that_separates_nothing():
    import numpy as np

    flat, single = np.full(256, 4.0), np.zeros(256)
    single[0] = 1024.0
    chosen = simhash.thresholds([single, flat, flat, flat], 3)
    assert chosen[0] == -1 and sum(t + 1 for t in chosen) == 4
    assert simhash.thresholds([flat] * 4, 3) == [0, 0, 0, 0]


def test_correlated_bits_share_a_group(spark):
    pick = random.Random(2)
    rows = []
    for _ in range(500):
        f = pick.getrandbits(64)
        for b in (7, 23, 41):
            f = f & ~(1 << b) | (f >> 2 & 1) << b
        rows.append((simhash._signed(f),))
    groups = simhash.bit_groups(spark.createDataFrame(rows, "fp long"))
    assert any({2, 7, 23, 41} <= set(g) for g in groups)
    assert sorted(b for g in groups for b in g) == list(range(64))


def test_empty_table(spark):
    assert simhash.near_classes(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_query_equals_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = queries.op11_simhash(spark, sf_dir)
    assert got(out) == plain_classes([tuple(r) for r in docs])
    assert out.filter(F.col("component_id") != F.col("doc_id")).count() > 0
