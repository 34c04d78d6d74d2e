"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descending it.

Rows become leaves, leaves of one group a tree, the groups' roots a tree above them. A tree
is built in segments of ``levels`` levels: the ``RUN ** levels`` digests or fewer at a
segment's bottom, next to each other by rank, give the digest at its top, and the record top -> bottom digests
is stored under the top's digest. The levels between follow from the record.

Proofs are requested for all leaves at once and descend from the root. A request stands for
all leaves below one node; at a record it splits by the next digit of their ranks, each part
taking along the children that it did not select. So a level of the descent has as many
requests as it has segments, never one per leaf, and all join keys are unique. At the bottom
the requests meet their leaves, whose path is the collected segments in reverse order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach, rows_like
from gaugeworks.operators.ordinal import global_ordinal
from gaugeworks.session import written

#: Consecutive nodes that become one, and levels of a segment.
RUN = 2
LEVELS = 8
#: The tree above the groups' trees, and the name of the group without a value.
TOP = ""
NULL_GROUP = "0"


def field_text(value: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf_digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def digest(parts: list[str]) -> str:
    """The digest of nodes that become one."""
    return sha256("".join(parts).encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels until one of ``n`` nodes remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a segment by level, from its bottom to the one at its top."""
    found = [nodes]
    for _ in range(levels):
        nodes = [digest(nodes[k : k + RUN]) for k in range(0, len(nodes), RUN)]
        found.append(nodes)
    return found


def unselected(segment: list[list[str]], place: int) -> list[tuple[int, list[str]]]:
    """Per level from the bottom: which of its run the node above ``place`` is, and the rest."""
    path = []
    for nodes in segment[:-1]:
        at = place % RUN
        run = nodes[place - at : place - at + RUN]
        path.append((at, run[:at] + run[at + 1 :]))
        place //= RUN
    return path


def packed(path: list[tuple[int, list[str]]]) -> str:
    return ",".join(f"{at}{''.join(others)}" for at, others in path)


def unpacked(text: str) -> list[tuple[int, list[str]]]:
    steps = [(int(step[0]), step[1:]) for step in text.split(",") if step]
    return [(at, [rest[k : k + 64] for k in range(0, len(rest), 64)]) for at, rest in steps]


def folded(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and the siblings of its path give."""
    for at, others in path:
        leaf = digest([*others[:at], leaf, *others[at:]])
    return leaf


# --- building -----------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """``records`` (height, digest, levels, children) by content, ``tops`` (tree, digest,
    height) and the greatest height, counted in segments of ``levels`` levels."""

    records: DataFrame
    tops: DataFrame
    height: int
    levels: int

    @property
    def fan(self) -> int:
        return RUN**self.levels


def _climbed(rows: DataFrame, full: int) -> DataFrame:
    """tree, seg, children, n_segs -> the same with the digest at the top and the levels."""

    def of(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            levels = [
                full if n > 1 else levels_of(len(c))
                for c, n in zip(p["children"], p["n_segs"], strict=True)
            ]
            tops = [climb(c, k)[-1][0] for c, k in zip(p["children"], levels, strict=True)]
            yield p["tree"], p["seg"], tops, levels, p["children"], p["n_segs"]

    fields = "tree string,seg long,digest string,levels int,children array<string>,n_segs long"
    wanted = rows.select("tree", "seg", "children", "n_segs")
    return wanted.mapInArrow(rows_like(fields, of, 64), fields)


def build(leaves: DataFrame, levels: int = LEVELS) -> Forest:
    """The trees over ``leaves`` (tree, rank from 0, digest, n_nodes of its tree)."""
    records = tops = None
    fan = RUN**levels
    nodes, height = leaves, 0
    while True:
        seg = F.expr(f"rank div {fan}").alias("seg")
        n_segs = F.expr(f"(n_nodes + {fan - 1}) div {fan}").alias("n_segs")
        grouped = nodes.groupBy("tree", seg, n_segs).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes")
        )
        grouped = grouped.withColumn("children", F.col("nodes.digest"))
        made = written(_climbed(grouped, levels), "segments").withColumn("height", F.lit(height))
        stored = made.select("height", "digest", "levels", "children")
        done = made.filter("n_segs = 1").select("tree", "digest", "height")
        records = stored if records is None else records.unionByName(stored)
        tops = done if tops is None else tops.unionByName(done)
        nodes = made.filter("n_segs > 1").select(
            "tree", F.col("seg").alias("rank"), "digest", F.col("n_segs").alias("n_nodes")
        )
        if nodes.isEmpty():
            return Forest(records, tops, height, levels)
        height += 1


# --- descending ---------------------------------------------------------------------


def _joined(lower: str, upper: str) -> str:
    """A path: the segment nearer to the leaf comes first."""
    return ",".join(filter(None, (lower, upper)))


def _split(fan: int):
    """Requests with their record, by the next digit of the ranks they stand for."""
    names = ("tree", "at", "levels", "path", "children")

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            out: list[tuple] = []
            for tree, at, levels, path, children in zip(*[p[n] for n in names], strict=True):
                segment = climb(children, levels)
                for place, child in enumerate(children):
                    taken = packed(unselected(segment, place))
                    out.append((tree, at * fan + place, child, _joined(taken, path)))
            yield tuple(zip(*out, strict=True)) if out else ([], [], [], [])

    return rows


def _met(forest: Forest, requests: DataFrame, height: int) -> DataFrame:
    """Requests of a height with the record of their digest. Many may ask for the same
    content - segments of repeated rows, stored once - and meet it by broadcast then."""
    store = forest.records.filter(F.col("height") == height).drop("height").dropDuplicates(["digest"])
    here = requests.filter(F.col("height") == height).drop("height")
    asked = here.groupBy("digest").agg(F.count("*").alias("n_rows"))
    return attach(here, written(asked.join(store, "digest"), "asked"), "digest").drop("n_rows")


def descend(forest: Forest, roots: DataFrame) -> DataFrame:
    """Requests of ``roots`` (tree, digest, path from there up) taken down to the bottom
    segments: tree, at (the segment's number), digest, path, levels, children."""
    waiting = roots.join(forest.tops.select("tree", "height"), "tree")
    waiting = waiting.select("tree", F.lit(0).cast("long").alias("at"), "digest", "path", "height")
    waiting = written(waiting, "requests")
    fields = "tree string,at long,digest string,path string"
    for height in range(forest.height, 0, -1):
        below = _met(forest, waiting, height).mapInArrow(rows_like(fields, _split(forest.fan), 16), fields)
        below = below.withColumn("height", F.lit(height - 1))
        rest = waiting.filter(F.col("height") < height)
        waiting = written(rest.unionByName(below), "requests")
    return _met(forest, waiting, 0)


def leaf_paths(forest: Forest, roots: DataFrame) -> DataFrame:
    """(tree, rank, digest, path) of every leaf."""
    fields = "tree string,rank long,digest string,path string"
    return descend(forest, roots).mapInArrow(rows_like(fields, _split(forest.fan), 16), fields)


def _proved(fan: int):
    """Per leaf of a bottom segment: its path's siblings as one digest, and its folded root."""
    names = ("leaves", "path", "levels", "children", "subroot")

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            out: list[tuple] = []
            for leaves, path, levels, children, subroot in zip(*[p[n] for n in names], strict=True):
                segment, upper = climb(children, levels), unpacked(path)
                for leaf in leaves:
                    steps = unselected(segment, leaf["rank"] % fan) + upper
                    proof = digest([d for _, others in steps for d in others])
                    out.append((leaf["doc_id"], leaf["digest"], subroot, proof, folded(leaf["shown"], steps)))
            yield tuple(zip(*out, strict=True)) if out else ([], [], [], [], [])

    return rows


# --- the manifest -------------------------------------------------------------------


def group_key(group: Column) -> Column:
    """A group's name, sorted null first and then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit(NULL_GROUP))


def ranked(leaves: DataFrame, group: str, *order: str) -> DataFrame:
    """``rank`` of each row in its group, from 0, and the group's ``n_nodes``. The rows are
    range-partitioned by group and order, so a group that holds most rows is spread."""
    numbered = global_ordinal(leaves, F.col(group).asc(), *[F.col(c).asc_nulls_first() for c in order], name="ordinal")
    firsts = numbered.groupBy(group).agg(F.min("ordinal").alias("first"), F.count("*").alias("n_nodes"))
    placed = attach(numbered, written(firsts, "groups"), group, "n_nodes")
    return placed.withColumn("rank", F.col("ordinal") - F.col("first")).drop("ordinal", "first")


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per document with its Merkle proof: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    A leaf is the digest of ``columns``; leaves of a group ascend by id (null first, then by
    leaf, so repeated rows are leaves of their own, next to each other). ``tampered`` has
    expressions for columns whose changed values the check uses in place of the stored
    ones: ``folded_root`` is what the changed leaf and the original siblings give, and
    ``verified`` whether that is the root. Any column may be null, and no text is too long,
    as only its digest is moved. An empty table gives no rows. Other columns are ignored."""
    tampered = tampered or {}
    leaves = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        group_key(docs[group_col]).alias("tree"),
        leaf_digest(*[field_text(docs[c]) for c in columns]).alias("digest"),
        leaf_digest(*[field_text(tampered.get(c, docs[c])) for c in columns]).alias("shown"),
    )
    placed = written(ranked(leaves, "tree", "doc_id", "digest", "shown"), "leaves")
    forest = build(placed.select("tree", "rank", "digest", "n_nodes"), levels)

    # the groups' roots are the leaves of the tree above
    subroots = forest.tops.select(F.lit(TOP).alias("all"), F.col("tree").alias("group"), "digest")
    above = written(ranked(subroots, "all", "group"), "above")
    crown = build(above.select(F.col("all").alias("tree"), "rank", "digest", "n_nodes"), levels)
    top = crown.tops.first()
    paths = leaf_paths(crown, crown.tops.select("tree", "digest", F.lit("").alias("path")))
    roots = above.drop("digest").join(paths.drop("tree"), "rank")
    roots = written(roots.select(F.col("group").alias("tree"), "digest", "path"), "roots")

    leaf = F.struct("rank", "doc_id", "digest", "shown")
    lists = placed.groupBy("tree", F.expr(f"rank div {forest.fan}").alias("at")).agg(F.collect_list(leaf).alias("leaves"))
    asked = descend(forest, roots).drop("digest").join(lists, ["tree", "at"])
    asked = asked.join(roots.select("tree", F.col("digest").alias("subroot")), "tree")
    fields = "doc_id long,leaf string,subroot string,proof_sha256 string,folded_root string"
    proofs = asked.mapInArrow(rows_like(fields, _proved(forest.fan), 16), fields)
    root = F.lit(top["digest"] if top else None).cast("string")
    return proofs.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def one_more_where(column: Column, id_column: Column, divisor: int = 7) -> Column:
    """A count that is one too high where ``divisor`` divides the id's CRC-32; nulls stay."""
    chosen = F.crc32(id_column.cast("string")) % divisor == 0
    # a decimal, so that the greatest long has a successor too
    wide = column.cast("decimal(20,0)")
    return F.when(chosen, wide + 1).otherwise(wide)
