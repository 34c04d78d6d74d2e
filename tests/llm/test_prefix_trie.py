"""The prefix trie against sets of prefixes, and its edge cases."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from gaugeworks.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, n long, key string, depth int"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def symbol(role, text):
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, symbol(role, text), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c in own:
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        found, waiting = [], [node]
        while waiting:
            now = waiting.pop()
            found.append(now)
            waiting += children.get(now, [])
        return found

    out = []
    for node, convs in members.items():
        under = below(node)
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in under if v)
        joined = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(children.get(node, [])), sum(v not in children for v in under), saved,
            sha256(joined.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA).repartition(3)
    convs = prefix_trie.conversations(frame)
    out = prefix_trie.trie_nodes(prefix_trie.rebuilt(convs))
    assert sorted(out.columns) == sorted(COLUMNS)
    return sorted((tuple(r) for r in out.select(*COLUMNS).collect()), key=str)


def some_rows(seed, n):
    """Conversations that share beginnings, some of them copies of one another."""
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        turns = pick.choice([0, 1, 2, 3, 5, 12]) if c % 4 else 3
        kind = pick.choice([0, 0, 0, 1, c])
        for t in range(turns):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", f"é{kind} {t} {pick.choice([0, 0, 0, 1])}"))
    rows += [(-3, 1, "user", "x"), (-5, 0, "user", "y"), (-5, 1, "user", "y"), (-5, 1, "bot", "y"), (-5, 1, "bot", "y")]
    rows += [(None, 0, "user", "lost"), (700, None, None, None), (700, 0, "user", ""), (701, 0, None, "a")]
    rows += [(800, t, "user", f"long {t}" * 50) for t in range(300)] + [(804, t, "user", f"long {t}" * 50) for t in range(290)]
    pick.shuffle(rows)
    return rows


def test_closing_parentheses():
    pick = random.Random(4)
    for block in (64, 4, 2):
        prefix_trie.BLOCK = block
        for n in (1, 2, 40, 900):
            depth = [0]
            for _ in range(n - 1):
                depth.append(pick.randint(1, min(depth[-1] + 1, pick.choice([3, 300]))))
            depth = np.array(depth)
            opens = 2 * np.arange(n) - depth
            steps = np.full(2 * n, -1)
            steps[opens] = 1
            excess = np.cumsum(steps)
            found = prefix_trie.next_at_most(excess, opens, excess[opens] - 1)
            for p, q in zip(opens.tolist(), found.tolist(), strict=True):
                assert q == next(k for k in range(p + 1, 2 * n) if excess[k] < excess[p])
    prefix_trie.BLOCK = 64


@pytest.mark.parametrize("strings", [1 << 16, 8])
def test_nodes_equal_sets_of_prefixes(spark, monkeypatch, strings):
    monkeypatch.setattr(prefix_trie, "SHARD_STRINGS", strings)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 4)
    rows = some_rows(strings, 150)
    assert run(spark, rows) == plain(rows)


def test_few_conversations(spark):
    for rows in ([(3, 0, "user", "a")], [(0, 0, "user", "a"), (0, 1, "bot", "b")], [(4, None, None, None)]):
        assert run(spark, rows) == plain(rows)


def test_copies_of_one_conversation(spark):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(120) for t in range(9)]
    assert run(spark, rows) == plain(rows)


def test_no_conversations(spark):
    assert run(spark, [(None, 0, "user", "a")]) == []


def test_query_equals_sets_of_prefixes(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    out = queries.op13_prefix_trie(spark, sf_dir).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in out), key=str) == plain(rows)
