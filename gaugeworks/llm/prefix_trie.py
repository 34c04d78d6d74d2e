"""Prefix trie of conversations in balanced parentheses, built by shards.

A conversation is the string of its turns' digests. Equal conversations are one string with
a count, so a group of copies is one row from there on. The sorted strings are dealt into
shards of neighbouring strings, and a shard codes its part of the trie as balanced
parentheses: a node opens before its subtree and closes after it. A tree of least excesses
over blocks finds the closing parenthesis of each node, which delimits its subtree; the
leaf pairs ``()`` before both ends are its leaves, and the difference of a running sum of
savings is what its subtree saves.

Nodes that another shard may have too lie on a shard's first or last string, its spines.
They stay open: their counts so far go into a next round, sorted and dealt again, where
equal spines merge. A round hands on at most two strings per shard, so the rounds end in one
shard after a few.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach, rows_like
from gaugeworks.session import written

#: Bytes of a turn's digest in a conversation's string.
SYMBOL = 16
#: Strings per shard.
SHARD_STRINGS = 1 << 16
#: Ids per piece of the list of conversations that end at a node.
PIECE_IDS = 256
#: Excesses per block, and blocks per block above.
BLOCK = 64
#: Node rows per batch.
ROWS_OUT = 1 << 16
NO_ENDS = sha256(b"").hexdigest()
NOBODY = int(np.iinfo(np.int64).max)


# --- conversations ------------------------------------------------------------------


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns): the turns of a conversation as (symbol, bytes of the text), by turn,
    null first; equal turns by role, then by digest. Texts are not gathered, only digests,
    so a conversation is some 50 bytes a turn. Null role or text is empty; rows without
    ``conv_id`` belong to no conversation. Repeated rows are turns of their own."""
    role, text = (F.coalesce(turns[c], F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string")
    symbol = F.substring(F.sha2(F.concat(size, F.lit(":"), role, text), 256), 1, 2 * SYMBOL)
    turn = F.struct(
        turns["turn"].cast("long").alias("turn"),
        role.alias("role"),
        symbol.alias("symbol"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    own = turns.select(turns[id_col].cast("long").alias("conv_id"), turn.alias("t"))
    listed = own.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["symbol"], t["bytes"])).alias("turns"))


def rebuilt(convs: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """Conversations whose beginning is that of the first of their family: the first ``h``
    turns of conversation ``c - c % family``, then their own behind the first ``h``, where
    ``h`` is the CRC-32 of the decimal id modulo ``most + 1``. ``convs`` is read twice."""
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = convs.filter(F.col("conv_id") % family == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = convs.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    none = F.slice("turns", 1, 0)
    begin = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(begin, rest).alias("turns"))


def strings_of(convs: DataFrame) -> DataFrame:
    """Distinct conversations: key (their symbols), lens (bytes of the texts), n, conv (the
    smallest id) and ends (digest of all ids, ascending, comma-joined).

    Ids are listed in pieces of a range of ids each, so copies of one conversation are
    spread; their digest is then fed piece by piece."""
    digits = F.concat_ws("", "turns.symbol")
    own = convs.select(
        "conv_id",
        F.sha2(digits.cast("binary"), 256).alias("pid"),
        F.unhex(digits).alias("key"),
        F.col("turns.bytes").alias("lens"),
        F.expr(f"conv_id div {PIECE_IDS}").alias("piece"),
    )
    ids = F.sort_array(F.collect_list("conv_id")).cast("array<string>")
    pieces = own.groupBy("pid", "piece").agg(
        F.first("key").alias("key"),
        F.first("lens").alias("lens"),
        F.count("*").alias("n"),
        F.min("conv_id").alias("conv"),
        F.array_join(ids, ",").alias("ids"),
    )

    def joined(batches: Iterator[dict]) -> Iterator[tuple]:
        now = None
        for p in batches:
            out: list[tuple] = []
            for pid, key, lens, n, conv, ids in zip(
                p["pid"], p["key"], p["lens"], p["n"], p["conv"], p["ids"], strict=True
            ):
                if now is not None and now[0] == pid:
                    now[4] += n
                    now[5] = min(now[5], conv)
                    now[1].update(f",{ids}".encode())
                    continue
                if now is not None:
                    out.append((*now[2:], now[1].hexdigest()))
                now = [pid, sha256(ids.encode()), key, lens, n, conv]
            yield tuple(zip(*out, strict=True)) if out else ([],) * 5
        if now is not None:
            yield tuple([v] for v in (*now[2:], now[1].hexdigest()))

    fields = "key binary,lens array<long>,n long,conv long,ends string"
    dealt = pieces.repartition("pid").sortWithinPartitions("pid", "piece")
    return dealt.mapInArrow(rows_like(fields, joined, 1024), fields)


# --- a shard's trie in balanced parentheses -----------------------------------------


def next_at_most(values: np.ndarray, start: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per start the first later position with a value of at most its target, which exists:
    by its own block, else by the least values of blocks, and down again."""
    padded = np.full(-(-len(values) // BLOCK) * BLOCK, np.iinfo(np.int64).max)
    padded[: len(values)] = values
    found, rest, beyond = np.full(len(start), -1), np.arange(len(start)), []
    for step in range(1, BLOCK):
        at = start[rest] + step
        inside = at // BLOCK == start[rest] // BLOCK
        beyond.append(rest[~inside])
        rest, at = rest[inside], at[inside]
        hit = padded[at] <= target[rest]
        found[rest[hit]] = at[hit]
        rest = rest[~hit]
    far = np.concatenate([*beyond, rest])
    if len(far):
        least = padded.reshape(-1, BLOCK).min(axis=1)
        block = next_at_most(least, start[far] // BLOCK, target[far])
        for step in range(BLOCK):
            at = block * BLOCK + step
            hit = padded[at] <= target[far]
            found[far[hit]] = at[hit]
            far, block = far[~hit], block[~hit]
    return found


def common_symbols(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b)) // SYMBOL
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[: half * SYMBOL] == b[: half * SYMBOL] else (low, half - 1)
    return low


def prefix_ids(key: bytes) -> list[str]:
    """A name for each prefix of a string, from the empty one on."""
    running, ids = sha256(), [sha256().hexdigest()]
    for at in range(0, len(key), SYMBOL):
        running.update(key[at : at + SYMBOL])
        ids.append(running.copy().hexdigest())
    return ids


#: Sums that a string carries per depth, from the root on.
CARRIED = ("n", "leaves", "saved", "kids")


class ShardTrie:
    """The trie of sorted strings. Entries have key, lens, and per depth n, conv, leaves,
    saved, kids and ends; what entries say about one node adds up."""

    def __init__(self, entries: dict[str, list]):
        self.keys = entries["key"]
        depth: list[int] = []
        parent: list[int] = []
        texts: list[int] = []
        stack: list[int] = []
        along: list[int] = []
        self.ends: dict[int, str] = {}
        before = None
        for key, lens, ends in zip(self.keys, entries["lens"], entries["ends"], strict=True):
            shared = -1 if before is None else common_symbols(before, key)
            del stack[shared + 1 :]
            for d in range(shared + 1, len(lens) + 1):
                parent.append(stack[-1] if stack else -1)
                stack.append(len(depth))
                depth.append(d)
                texts.append(lens[d - 1] if d else 0)
            along += stack
            self.ends.update((stack[d], e) for d, e in enumerate(ends) if e)
            if before is None:
                self.first = list(stack)
            before = key
        self.last = list(stack)
        self.depth, self.parent = np.array(depth), np.array(parent)
        self.texts = np.array(texts)
        m, at = len(depth), np.array(along)
        self.sums = {c: np.zeros(m, np.int64) for c in CARRIED}
        for c in CARRIED:
            np.add.at(self.sums[c], at, np.concatenate([np.array(v, np.int64) for v in entries[c]]))
        self.conv = np.full(m, NOBODY)
        np.minimum.at(self.conv, at, np.concatenate([np.array(v, np.int64) for v in entries["conv"]]))

    def totals(self, edge: np.ndarray) -> None:
        """Children, leaves and savings of every node, not counting ``edge`` nodes below it."""
        m = len(self.depth)
        opens = 2 * np.arange(m) - self.depth
        bits = np.zeros(2 * m, np.int64)
        bits[opens] = 1
        excess = np.cumsum(2 * bits - 1)
        closes = next_at_most(excess, opens, excess[opens] - 1)

        final = ~edge
        held = final & (self.parent >= 0)
        sums = self.sums
        pairs = bits.copy()
        pairs[:-1] &= 1 - bits[1:]
        pairs[opens[edge | (sums["kids"] > 0)]] = 0
        rank = np.concatenate([[0], np.cumsum(pairs)])
        sums["leaves"] += rank[closes + 1] - rank[opens]
        sums["kids"] += np.bincount(self.parent[held], minlength=m)
        # a subtree is as many nodes in a row as it has pairs of parentheses
        size = (closes - opens + 1) // 2
        gains = np.where(final, (sums["n"] - 1) * self.texts, 0)
        running = np.concatenate([[0], np.cumsum(gains)])
        sums["saved"] += running[np.arange(m) + size] - running[:-1]


NODE_FIELDS = (
    "conv_id long,depth long,parent_conv_id long,n_convs long,n_children long,n_leaves long,"
    "saved_tokens long,ends_sha256 string,node_id string,parent_id string"
)
ENTRY_FIELDS = (
    "key binary,lens array<long>,n array<long>,conv array<long>,leaves array<long>,"
    "saved array<long>,kids array<long>,ends array<string>"
)


def _names(fields: str) -> list[str]:
    return [field.split()[0] for field in fields.split(",")]


_N_NODE, _N_ENTRY = len(_names(NODE_FIELDS)), len(_names(ENTRY_FIELDS))


def _shard(named: bool, last: bool):
    """Rows of a shard's closed nodes, then its spines as strings of the next round. Nodes
    are ``named`` where they were spines, and so other nodes' parents, in a round before."""

    def rows(batches: Iterator[dict]) -> Iterator[tuple]:
        entries: dict[str, list] = {}
        for p in batches:
            for name, column in p.items():
                entries.setdefault(name, []).extend(column)
        if not entries or not entries["key"]:
            return
        trie = ShardTrie(entries)
        edge = np.zeros(len(trie.depth), bool)
        if not last:
            edge[trie.first] = edge[trie.last] = True
        trie.totals(edge)
        ids: dict[int, str] = dict(zip(trie.first, prefix_ids(trie.keys[0]), strict=True))
        ids.update(zip(trie.last, prefix_ids(trie.keys[-1]), strict=True))
        if named:
            ids = _all_ids(trie, entries)
        yield from _node_rows(trie, edge, ids, named)
        if not last:
            yield _spines(trie, entries)

    return rows


def _all_ids(trie: ShardTrie, entries: dict[str, list]) -> dict[int, str]:
    ids: dict[int, str] = {}
    stack: list[int] = []
    node = 0
    before = b""
    for place, key in enumerate(trie.keys):
        shared = common_symbols(before, key) if place else -1
        del stack[shared + 1 :]
        names = prefix_ids(key)
        for d in range(shared + 1, len(names)):
            ids[node] = names[d]
            stack.append(node)
            node += 1
        before = key
    return ids


def _node_rows(trie: ShardTrie, edge: np.ndarray, ids: dict[int, str], named: bool) -> Iterator[tuple]:
    closed = np.flatnonzero(~edge)
    for begin in range(0, len(closed), ROWS_OUT):
        at = closed[begin : begin + ROWS_OUT]
        up, nodes = trie.parent[at].tolist(), at.tolist()
        conv = trie.conv.item
        yield (
            trie.conv[at].tolist(),
            trie.depth[at].tolist(),
            [None if u < 0 or edge[u] else conv(u) for u in up],
            *[trie.sums[c][at].tolist() for c in ("n", "kids", "leaves", "saved")],
            [trie.ends.get(k, NO_ENDS) for k in nodes],
            [ids[k] if named else None for k in nodes],
            [ids[u] if u >= 0 and edge[u] else None for u in up],
            *[[None] * len(nodes)] * _N_ENTRY,
        )


def _spines(trie: ShardTrie, entries: dict[str, list]) -> tuple:
    """The first and the last string with what is known of their nodes; nodes on both are
    told once."""
    told: set[int] = set()
    out: list[tuple] = []
    for place, path in ((0, trie.first), (-1, trie.last)):
        if place and len(trie.keys) == 1:
            break
        new = [k not in told for k in path]
        told.update(path)

        def once(values, nothing, path=path, new=new):
            return [values(k) if n else nothing for k, n in zip(path, new, strict=True)]

        out.append((
            trie.keys[place],
            entries["lens"][place],
            once(trie.sums["n"].item, 0),
            once(trie.conv.item, NOBODY),
            *[once(trie.sums[c].item, 0) for c in ("leaves", "saved", "kids")],
            once(trie.ends.get, None),
        ))
    return (*[[None] * len(out)] * _N_NODE, *zip(*out, strict=True))


# --- rounds -------------------------------------------------------------------------


def _entries(strings: DataFrame) -> DataFrame:
    """Distinct conversations as entries: counted at each node of their path."""
    depths = F.size("lens") + 1

    def repeated(value: Column) -> Column:
        return F.array_repeat(value, depths)

    zeros = repeated(F.lit(0).cast("long"))
    ends = F.concat(F.array_repeat(F.lit(None).cast("string"), F.size("lens")), F.array("ends"))
    return strings.select(
        "key", "lens", repeated(F.col("n")).alias("n"), repeated(F.col("conv")).alias("conv"),
        zeros.alias("leaves"), zeros.alias("saved"), zeros.alias("kids"), ends.alias("ends"),
    )


def trie_nodes(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, turns as of ``conversations``).

    Per node: conv_id (its smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens (bytes that storing its subtree once saves)
    and ends_sha256. Conversations without turns are members of the root. Without
    conversations there is no node."""
    strings = written(strings_of(convs), "strings")
    count = strings.count()
    spark = convs.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, -(-count // SHARD_STRINGS))
    entries, turn, closed = _entries(strings), 0, None
    fields = f"{NODE_FIELDS},{ENTRY_FIELDS}"
    last = False
    while True:
        # the last round's few spines meet in one task: two per shard of the round before
        dealt = entries.repartition(1) if last else entries.repartitionByRange(shards, "key")
        made = dealt.sortWithinPartitions("key").mapInArrow(rows_like(fields, _shard(turn > 0, last)), fields)
        made = written(made, f"trie-{turn}")
        nodes = made.filter("depth IS NOT NULL").select(*_names(NODE_FIELDS))
        closed = nodes if closed is None else closed.unionByName(nodes)
        entries = made.filter("key IS NOT NULL").select(*_names(ENTRY_FIELDS))
        spines = 0 if last else entries.count()
        if not spines:
            break
        shards, turn = -(-spines // SHARD_STRINGS), turn + 1
        last = shards == 1
    parents = closed.filter("node_id IS NOT NULL").select(
        F.col("node_id").alias("parent_id"), F.col("conv_id").alias("found"), F.col("n_children").alias("n_rows")
    )
    below = closed.filter("parent_id IS NOT NULL").drop("parent_conv_id")
    below = attach(below, parents, "parent_id").withColumnRenamed("found", "parent_conv_id").drop("n_rows")
    both = closed.filter("parent_id IS NULL").unionByName(below)
    return both.drop("node_id", "parent_id")
