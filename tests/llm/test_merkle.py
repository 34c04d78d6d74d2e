"""Merkle proofs against a plain tree, and their edge cases."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, digest string, tree string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    found = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
        found.append(nodes)
    return found


def path(tree, place):
    steps = []
    for nodes in tree[:-1]:
        run = nodes[place // 2 * 2 : place // 2 * 2 + 2]
        steps.append((place % 2, run[: place % 2] + run[place % 2 + 1 :]))
        place //= 2
    return steps


def plain(rows):
    """Rows are (doc_id, text, lang, source, n_chars); one proof per row."""

    def leaf(r, extra=0):
        n = r[4] if r[4] is None else r[4] + extra
        return H(field(r[0]), field(r[3]), field(r[2]), field(n), field(r[1]))

    groups = {}
    for r in rows:
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        groups.setdefault(r[2], []).append((r[0], leaf(r), leaf(r, int(bad))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[g] = levels([x[1] for x in groups[g]])
    crown = levels([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for place, (doc, own, shown) in enumerate(groups[g]):
            steps = path(trees[g], place) + path(crown, at)
            now = shown
            for left, others in steps:
                now = H(*others[:left], now, *others[left:])
            siblings = H(*[d for _, others in steps for d in others])
            out.append((doc, own, trees[g][-1][0], crown[-1][0], siblings, now, now == crown[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, levels=8):
    frame = spark.createDataFrame([(*r, 5, "x", "y") for r in rows], SCHEMA).repartition(3)
    changed = merkle.one_more_where(frame["n_chars"], frame["doc_id"])
    out = merkle.manifest(frame, tampered={"n_chars": changed}, levels=levels)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def some_rows():
    rows = [(k, f"text {k}", "en", "web", k % 9) for k in range(41)]
    rows += [(k, None, None, None, None) for k in range(100, 103)]
    rows += [(7, "text 7", "en", "web", 7), (7, "other", "en", "web", None), (None, "", "en", "", 0), (None, "", "de", "é", 1)]
    rows += [(500 + k, "é" * k, "żź", "s:1", k) for k in range(16)]
    return [*rows, (900, "alone", "", "w", 2**63 - 1), (901, "long " * 30_000, "zz", "w", 1)]


@pytest.mark.parametrize("levels", [2, 8])
def test_proofs_equal_a_plain_tree(spark, levels):
    rows = some_rows()
    assert run(spark, rows, levels) == plain(rows)


def test_equal_segments_are_stored_once(spark):
    rows = [(3, "copy", "en", "s", 4)] * 64 + [(9, "own", "en", "s", 3)]
    assert run(spark, rows, 2) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    rows = [(k, "t", "en", "s", 1) for k in range(n)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([(1, "t", "en", "s", 1, 5, "x", "y")], SCHEMA).limit(0)
    assert merkle.manifest(frame).count() == 0


def test_untampered_rows_all_verify(spark):
    frame = spark.createDataFrame([(*r, 5, "x", "y") for r in some_rows()], SCHEMA)
    assert merkle.manifest(frame).filter(~F.col("verified")).count() == 0


def test_query_equals_a_plain_tree(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
    out = queries.op12_merkle(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in out), key=str) == plain([tuple(r) for r in rows])
