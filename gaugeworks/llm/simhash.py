"""SimHash near copies: all pairs of fingerprints within a few bits, by a general pigeonhole.

The 64 bits are grouped into partitions, bits that go together in the same one. Partition
``i`` gets its own threshold ``t_i`` (-1: not looked at). If the ``t_i + 1`` add up to one
more than the allowed distance, two fingerprints within that distance differ by at most
``t_i`` bits in some partition ``i``. A dynamic program picks the thresholds with the
fewest estimated candidates; the estimate counts the values of each partition over all
fingerprints.

Every fingerprint owns the bucket of its value in a partition and visits those within
``t_i`` bits. Buckets with many members are cut again by the same rule over the bits not
yet used. What is dense even then is compared in pairs of slices. A bucket returns the
links of a spanning forest, never its pairs, and equal fingerprints take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach, documents_of, rows_like
from gaugeworks.llm.linking import components
from gaugeworks.session import written

BITS = 64
SEED = 42
PARTS = 4
#: Fingerprints of a bucket that one task compares; larger buckets are cut.
DENSE = 4096
#: How often a bucket is cut by further bits before it is cut into slices.
CUTS = 2
#: Shingles hashed at a time, so that a long text needs no more memory than this.
AT_ONCE = 1 << 16


# --- fingerprints ---------------------------------------------------------------


def fingerprint(text: bytes, words: int = 3) -> int:
    """The fingerprint of UTF-8 bytes, unsigned: a bit is set if more than half of the
    shingles' hashes have it. A text with fewer words is one shingle; without words it is 0."""
    found = text.lower().split()
    if not found:
        return 0
    width = min(words, len(found))
    last = len(found) - width + 1
    ones, hashed = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for begin in range(0, last, AT_ONCE):
        end = min(begin + AT_ONCE, last)
        shingles = zip(*[found[begin + k : end + k] for k in range(width)], strict=True)
        h = np.fromiter((hashed(b" ".join(s), SEED) for s in shingles), "<u8", end - begin)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > last).tolist()))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp) per row, the 64 bits as a signed long."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            yield p["doc_id"], [_signed(fingerprint(t, words)) for t in p["text"]]

    own = documents_of(docs, id_col, text_col)
    own = own.select("doc_id", F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(rows_like("doc_id long,fp long", rows), "doc_id long,fp long")


# --- partitions and thresholds ----------------------------------------------------


def _bits_of(values: list[int]) -> np.ndarray:
    packed = np.array(values, np.int64).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(packed, axis=1, bitorder="little")


def bit_groups(fps: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """Bits grouped by how strongly they go together over all fingerprints. The tasks
    return sums of 64 x 64 numbers; of these the driver gets one table."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        both, n = np.zeros((BITS, BITS)), 0
        for p in pieces:
            bits = _bits_of(p["fp"]).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        yield list(range(BITS * BITS + 1)), [*both.astype(np.int64).ravel().tolist(), n]

    fields = "cell long,n long"
    sums = fps.select("fp").mapInArrow(rows_like(fields, rows, 4096), fields)
    table = dict(sums.groupBy("cell").agg(F.sum("n")).collect())
    n = max(table.get(BITS * BITS, 0), 1)
    both = np.array([table.get(k, 0) for k in range(BITS * BITS)], float).reshape(BITS, BITS) / n
    share = both.diagonal()
    spread = np.sqrt(share * (1 - share))
    tie = np.abs(both - np.outer(share, share)) / np.maximum(np.outer(spread, spread), 1e-9)
    left, groups = set(range(BITS)), []
    for part in range(parts):
        size = -(-len(left) // (parts - part))
        # the two bits most alike first, then whatever is most like the group
        a, b = max(combinations(sorted(left), 2), key=lambda ab: tie[ab]) if size > 1 else (min(left),) * 2
        group = sorted({a, b})
        left -= set(group)
        while len(group) < size:
            nearest = max(sorted(left), key=lambda k: tie[k, group].sum())
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def _value(column: str, bits: list[int]):
    """The given bits of a fingerprint as a small number."""
    out = F.lit(0).cast("long")
    for place, bit in enumerate(bits):
        one = F.shiftrightunsigned(column, bit).bitwiseAND(F.lit(1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(one, place))
    return out


def _probes(part: int, bits: list[int], limit: int):
    """The buckets of a partition that a fingerprint owns or visits."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(len(bits), limit)])

    def probe(mask):
        value = _value("fp", bits).bitwiseXOR(mask)
        return F.struct(F.lit(part).alias("part"), value.alias("value"), (mask == 0).alias("owns"))

    return F.transform(masks, probe)


def _masks(n_bits: int, distance: int) -> list[int]:
    """All numbers of up to ``n_bits`` with at most ``distance`` ones."""
    found = []
    for ones in range(distance + 1):
        found += [sum(1 << k for k in c) for c in combinations(range(n_bits), ones)]
    return found


def thresholds(counts: list[np.ndarray], distance: int) -> list[int]:
    """Per partition a threshold from -1 on, so that the ``t + 1`` add up to ``distance + 1``
    and the estimated candidates are fewest. ``counts`` has the fingerprints per value."""
    cost = []
    for held in counts:
        width = len(held).bit_length() - 1
        per, met, own = [0.0], np.zeros(len(held)), np.arange(len(held))
        for t in range(distance + 1):
            for mask in (m for m in _masks(width, t) if m.bit_count() == t):
                met = met + held[own ^ mask]
            # a probe costs something even where it meets nobody
            probes = held.sum() * len(_masks(width, t))
            per.append(float(held @ met) + probes)
        cost.append(per)
    best = {0: (0.0, [])}
    for per in cost:
        found: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for extra in range(min(distance + 1 - used, len(per) - 1) + 1):
                option = (total + per[extra], [*chosen, extra - 1])
                if used + extra not in found or option < found[used + extra]:
                    found[used + extra] = option
        best = found
    return best[distance + 1][1]


# --- probing and verifying --------------------------------------------------------


def _forest(fps: list[int], owns: list[bool], distance: int) -> list[tuple[int, int]]:
    """Links between fingerprints at most ``distance`` bits apart, enough to connect all that
    such links connect. Only pairs with an owner need a look: two visitors meet elsewhere."""
    root = list(range(len(fps)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    links, array = [], np.array(fps, np.int64).view(np.uint64)
    for k in range(len(fps)):
        if not owns[k]:
            continue
        if len(fps) < 16:
            near = [j for j in range(len(fps)) if ((fps[k] ^ fps[j]) & ((1 << BITS) - 1)).bit_count() <= distance]
        else:
            near = np.flatnonzero(np.bitwise_count(array ^ array[k]) <= distance).tolist()
        for j in near:
            a, b = find(k), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((fps[k], fps[j]))
    return links


def _verified(buckets: DataFrame, distance: int) -> DataFrame:
    """(a, b): links of buckets (bucket, members)."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            links = []
            for members in p["members"]:
                owners = {m["fp"]: False for m in members}
                for m in members:
                    owners[m["fp"]] |= m["owns"]
                links += _forest(list(owners), list(owners.values()), distance)
            yield [a for a, _ in links], [b for _, b in links]

    fields = "a long,b long"
    return buckets.select("members").mapInArrow(rows_like(fields, rows, 64), fields)


def _grouped(rows: DataFrame, distance: int) -> DataFrame:
    groups = rows.groupBy("bucket").agg(F.collect_list(F.struct("fp", "owns")).alias("members"))
    return _verified(groups.filter(F.size("members") > 1), distance)


def _cut_by_bits(rows: DataFrame, rest: dict[int, list[int]], cuts: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """Members of dense buckets by the bits ``rest`` that their part has not used: ``cuts``
    groups of bits, one of which two near fingerprints must share. Also what is left then."""
    cells, left = [], {}
    for part, bits in rest.items():
        cell = []
        for k in range(cuts):
            group, finer = bits[k::cuts], part * cuts + k
            left[finer] = [b for b in bits if b not in group]
            cell.append(F.struct(F.lit(finer).alias("part"), _value("fp", group).alias("value")))
        cells.append(F.when(F.col("part") == part, F.array(*cell)))
    exploded = rows.select("bucket", "fp", "owns", F.explode(F.coalesce(*cells)).alias("cell"))
    finer = F.xxhash64("bucket", "cell.part", "cell.value").alias("bucket")
    return exploded.select("cell.part", finer, "fp", "owns"), left


def near_links(fps: DataFrame, distance: int = 3, parts: int = PARTS, dense: int = DENSE, cuts: int = CUTS) -> DataFrame:
    """(a, b): pairs of distinct ``fp`` at most ``distance`` bits apart that connect all which
    such pairs connect. ``fps`` has distinct values and is read several times."""
    groups = bit_groups(fps, parts)
    # a partition has 2 ** 16 values: counts of them fit on the driver whatever the input
    cells = [F.struct(F.lit(i).alias("part"), _value("fp", bits).alias("value")) for i, bits in enumerate(groups)]
    counted = fps.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.part", "c.value").count()
    held = [np.zeros(1 << len(bits)) for bits in groups]
    for part, value, n in counted.collect():
        held[part][value] = n
    limits = thresholds(held, distance)

    members = [_probes(p, *x) for p, x in enumerate(zip(groups, limits, strict=True)) if x[1] >= 0]
    probes = fps.select("fp", F.explode(F.concat(*members)).alias("m"))
    probes = probes.select("m.part", F.xxhash64("m.part", "m.value").alias("bucket"), "fp", "m.owns")
    rows = written(probes, "probes")
    rest = {i: [b for b in range(BITS) if b not in bits] for i, bits in enumerate(groups)}
    links = None
    for level in range(cuts + 1):
        # a bucket without an owner, or with one member, links nothing
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n_rows"), F.count_if("owns").alias("owners"))
        sizes = written(sizes.filter("owners > 0 AND n_rows > 1"), "sizes")
        sized = attach(rows, sizes, "bucket")
        found = written(_grouped(sized.filter(F.col("n_rows") <= dense), distance), "links")
        links = found if links is None else links.unionByName(found)
        crowded = sized.filter(F.col("n_rows") > dense)
        if sizes.filter(F.col("n_rows") > dense).isEmpty():
            return links
        if level < cuts:
            finer, rest = _cut_by_bits(crowded, rest, distance + 1)
            rows = written(finer, "cut")
    # pairs of slices: each member goes to every pair that has its own slice
    slices = F.ceil(F.col("n_rows") / F.lit(dense)).cast("int")
    sliced = crowded.withColumn("slice", F.pmod(F.xxhash64("fp", F.lit(1)), slices)).withColumn("slices", slices)
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    sliced = sliced.select("bucket", "fp", "owns", "slice", other)
    pair = F.xxhash64("bucket", F.least("slice", "other"), F.greatest("slice", "other"))
    return links.unionByName(_grouped(sliced.select(pair.alias("bucket"), "fp", "owns"), distance))


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 3,
    dense: int = DENSE,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id per row: the smallest doc_id that
    links of at most ``distance`` differing bits reach, itself included.

    Null counts as empty text; a text without words has fingerprint 0 and links like any
    other. Rows with null ids link too; their class is named by its smallest id that is not
    null, null where there is none. Repeated rows come out as often as they are in. An empty
    table gives no rows. Other columns are ignored."""
    own = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    held = written(own.groupBy("fp").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("least")), "distinct")
    links = near_links(held.select("fp"), distance, dense=dense)
    roots = components(links).select(F.col("node").alias("fp"), "root")
    rooted = written(held.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_fps"))
    named = attach(rooted.select("fp", "root", "n_rows"), written(classes, "classes"), "root", "n_fps")
    out = attach(own, written(named.select("fp", "n_rows", "component_id"), "named"), "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), "component_id")
