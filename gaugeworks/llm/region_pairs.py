"""Pairs of items that share a region and whose sketches lie close, by arrays.

Regions of items come in blobs: a task deals what it has made to buckets by the first bits
of the regions and hands on, per bucket, the rest of each region, the item's number, its
sketch of 64 parities and a note, all as arrays. A bucket's blobs are sorted by region as
one array, and members of a region are compared by their sketches there, so what is no
candidate never becomes a row. A bound, ``may_link``, tells from two notes and the parities
apart whether a pair can link.

A region with many close pairs gives a pair per member first, with a leader; what that
leaves open is handed on as rows, to be settled when classes are known.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.linking import components
from gaugeworks.llm.shingles import U64, mix
from gaugeworks.session import written

#: Rows that a task gathers before it hands blobs on, and letters it looks at together.
HELD = 1 << 20
LETTERS_AT_ONCE = 1 << 20
#: Rows of a partition and of a bucket, at some REGIONS rows to an item.
REGIONS, PART_ROWS, BUCKET_ROWS = 20, 1 << 21, 1 << 19
#: Bits of a region that make its bucket, at most, and that are kept below it.
BUCKET_BITS, REGION_BITS = 16, 48
#: Regions of up to SMALL members are compared together, larger ones each by itself. One
#: with more than CLOSE pairs to a member is dense.
SMALL, CLOSE = 128, 8
#: Members that are compared with all others of a large region at once.
AT_ONCE = 256
#: Pairs whose wide sketches are compared at once.
WIDE_AT_ONCE = 1 << 12
#: How many of the regions that a member of dense regions is in its pairs are held against.
FIRST = 16
#: Turns with leaders before the close pairs that a dense region has left are all verified.
TURNS = 2

#: Spark numbers the rows of a partition from its number shifted by so many bits.
ROW_BITS = 33

_BLOBS = pa.schema([("bucket", pa.int32()), ("base", pa.int64()), ("kind", pa.int32())] + [(n, pa.binary()) for n in ("regions", "numbers", "sketches", "notes")])
_BLOB_FIELDS = "bucket int,base long,kind int,regions binary,numbers binary,sketches binary,notes binary"
_FOUND_FIELDS = "a long,b long,region long,sketch long,note int,kind int"


def _blobs(base: int, kind: int, held: list[tuple], bits: int) -> pa.RecordBatch:
    """One row per bucket that has any."""
    regions, numbers, sketches, notes = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(regions)
    regions = regions[order]
    buckets = regions >> U64(64 - bits)
    ends = np.flatnonzero(np.r_[buckets[1:] != buckets[:-1], True]) + 1
    low = np.ascontiguousarray(regions >> U64(64 - bits - REGION_BITS)).view(np.uint8).reshape(-1, 8)
    columns = [(low[:, : REGION_BITS // 8], REGION_BITS // 8), (numbers[order], 4), (sketches[order], 8), (notes[order], 2)]
    edges = np.r_[0, ends].astype(np.int32)

    def column(values: np.ndarray, width: int) -> pa.Array:
        at = pa.py_buffer((edges * width).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, at, pa.py_buffer(np.ascontiguousarray(values))])

    fixed = [buckets[ends - 1].astype(np.int32), np.full(len(ends), base, np.int64), np.full(len(ends), kind, np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, fixed), *(column(*c) for c in columns)], schema=_BLOBS)


def _blob_rows(lines_of: Callable, kinds: list, bits: int):
    """Blobs of (number, line): ``kinds`` make the rows of what ``lines_of`` makes of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, now = [[] for _ in kinds], [0] * len(kinds), None

        def out(k: int) -> Iterator[pa.RecordBatch]:
            if counts[k]:
                yield _blobs(now << ROW_BITS, k, held[k], bits)
            held[k], counts[k] = [], 0

        for batch in batches:
            numbers, lines = batch.column(0).to_numpy(), batch.column(1)
            if not len(numbers):
                continue
            size = np.cumsum(np.asarray(pc.binary_length(lines), np.int64)) // LETTERS_AT_ONCE
            high = numbers >> ROW_BITS
            cuts = np.flatnonzero((size[1:] != size[:-1]) | (high[1:] != high[:-1])) + 1
            for at, end in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                if high[at] != now:
                    for k in range(len(kinds)):
                        yield from out(k)
                    now = int(high[at])
                part = lines_of(lines.slice(at, end - at))
                rows = (numbers[at:end] & ((1 << ROW_BITS) - 1)).astype(np.uint32)
                for k, kind in enumerate(kinds):
                    regions, of, sketches, notes = kind.rows(part)
                    held[k].append((regions, rows[of], sketches, notes))
                    counts[k] += len(regions)
                    if counts[k] >= HELD:
                        yield from out(k)
        for k in range(len(kinds)):
            yield from out(k)

    return run


class Members:
    """Members of regions, sorted by region: ids, sketches, notes, labels (an id each), and,
    or nothing, wide sketches and the first of the regions that each is in."""

    def __init__(self, regions, ids, sketches, notes, labels, wide=None, others=None):
        self.regions, self.ids, self.sketches, self.notes, self.labels = regions, ids, sketches, notes, labels
        self.wide, self.others = wide, others

    def of(self, chosen) -> Members:
        parts = (self.regions, self.ids, self.sketches, self.notes, self.labels, self.wide, self.others)
        return Members(*(None if x is None else x[chosen] for x in parts))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) of each region."""
        starts = np.flatnonzero(np.r_[True, self.regions[1:] != self.regions[:-1]]) if len(self.regions) else np.zeros(0, int)
        return starts, np.diff(np.r_[starts, len(self.regions)])

    def close(self, i, j, kind) -> np.ndarray:
        """Whether i and j, that are shaped alike, can link by their sketches."""
        apart = np.bitwise_count(self.sketches[i] ^ self.sketches[j])
        return kind.may_link(self.notes[i], self.notes[j], apart) & (self.ids[i] != self.ids[j])

    def closer(self, i: np.ndarray, j: np.ndarray, kind) -> np.ndarray:
        """Whether those that can link by their sketches can by the wide ones."""
        good = np.ones(len(i), bool)
        if self.wide is not None:
            half = self.wide.shape[1] // 2
            for at in range(0, len(i), WIDE_AT_ONCE):
                x, y = i[at : at + WIDE_AT_ONCE], j[at : at + WIDE_AT_ONCE]
                apart = np.bitwise_count(self.wide[x] ^ self.wide[y])
                words, letters = apart[:, :half].sum(1, dtype=np.int32), apart[:, half:].sum(1, dtype=np.int32)
                good[at : at + len(x)] = kind.may_link_wide(self.notes[x], self.notes[y], words, letters)
        return good

    def first_met(self, i: np.ndarray, j: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
        """Those of one region that meet in no region before it, as far as these are known.
        Others are a pair there too, if notes are the same in all regions."""
        good = np.ones(len(i), bool)
        if self.others is not None and kind.SAME_NOTES:
            for at in range(0, len(i), WIDE_AT_ONCE):
                x, y = i[at : at + WIDE_AT_ONCE], j[at : at + WIDE_AT_ONCE]
                own = self.others[x]
                before = own < self.regions[x].view(np.int64)[:, None]
                both = (own[:, :, None] == self.others[y][:, None, :]).any(2)
                good[at : at + len(x)] = ~(before & both).any(1)
        return i[good], j[good]

    def pairs(self, i, j) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ids[i], self.ids[j]
        return np.maximum(a, b), np.minimum(a, b)


def _small(m: Members, kind) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs (i, j) of all regions, of few members each, in different classes."""
    i, found, by = np.flatnonzero(m.regions[1:] == m.regions[:-1]), [], 1
    while len(i):
        near = i[(m.labels[i] != m.labels[i + by]) & m.close(i, i + by, kind)]
        near = near[m.closer(near, near + by, kind)]
        found.append((near, near + by))
        by += 1
        i = i[i + by < len(m.regions)]
        i = i[m.regions[i + by] == m.regions[i]]
    nothing = np.zeros(0, np.int64)
    return tuple(np.concatenate([nothing, *x]) for x in zip(*found, strict=True)) if found else (nothing, nothing)


def _large(m: Members, kind, most: float) -> Iterator[tuple] | None:
    """Close pairs of one region in different classes; nothing if they are more than ``most``."""
    n, found, count = len(m.ids), [], 0
    for at in range(0, n, AT_ONCE):
        i, j = np.arange(at, min(n, at + AT_ONCE))[:, None], np.arange(at, n)[None, :]
        x, y = np.nonzero((i < j) & (m.labels[i] != m.labels[j]) & m.close(i, j, kind))
        x, y = x + at, y + at
        good = m.closer(x, y, kind)
        count += int(good.sum())
        if count > most:
            return None
        found.append((x[good], y[good]))
    return found


def _led(m: Members, kind, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Per leader of one dense region its close members in other classes; each member not yet
    close to one is the next leader."""
    by = m.ids if turn == 0 else mix(m.ids.view(np.uint64) + U64(turn))
    alive, found = np.lexsort((by, (m.notes & 1) == 0)), []
    while len(alive) > 1:
        leader, rest = alive[0], alive[1:]
        good = m.close(leader, rest, kind)
        near = rest[good]
        good[good] = closer = m.closer(np.full(len(near), leader), near, kind)
        near = near[closer]
        near = near[m.labels[near] != m.labels[leader]]
        found.append((np.full(len(near), leader), near))
        alive = rest[~good]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def region_pairs(m: Members, kind, turn: int, last: bool = False) -> Iterator[tuple]:
    """Per part (pairs a, pairs b, dense members): the close pairs of the regions of ``m``
    that are in different classes. Of a dense region, pairs with leaders and all members,
    unless it is the ``last`` turn; then a pair that meets in a region before is left to that."""
    starts, sizes = m.runs()
    small = np.repeat(sizes <= SMALL, sizes)
    few = m.of(small)
    i, j = _small(few, kind)
    run_starts, run_sizes = few.runs()
    run = np.repeat(np.arange(len(run_sizes)), run_sizes)
    dense = np.bincount(run[i], minlength=len(run_sizes)) > CLOSE * run_sizes
    if last:
        dense[:] = False
    i, j = (x[~dense[run[i]]] for x in (i, j))
    if last:
        i, j = few.first_met(i, j, kind)
    yield *few.pairs(i, j), None
    one = [few.of(slice(run_starts[k], run_starts[k] + run_sizes[k])) for k in np.flatnonzero(dense)]
    for k in np.flatnonzero(sizes > SMALL):
        own = m.of(slice(starts[k], starts[k] + sizes[k]))
        if (own.labels == own.labels[0]).all():
            continue
        found = _large(own, kind, np.inf if last else CLOSE * sizes[k])
        if found is None:
            one.append(own)
        else:
            for i, j in found:
                yield *own.pairs(*(own.first_met(i, j, kind) if last else (i, j))), None
    for own in one:
        yield *own.pairs(*_led(own, kind, turn)), own


def _found(kind: int, parts: Iterator[tuple], members: bool) -> Iterator[pa.RecordBatch]:
    """Pairs with nulls for a region; with null b, the ``members`` of regions that stay open
    or else one row for each of these."""

    def batch(columns: list) -> pa.RecordBatch:
        types = [pa.int64()] * 4 + [pa.int32()] * 2
        n = len(columns[0])
        arrays = [pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "region", "sketch", "note", "kind"])

    for a, b, dense in parts:
        if len(a):
            # one region after the other may have the same pair
            pair = np.unique(np.stack([a, b], 1), axis=0)
            yield batch([pair[:, 0], pair[:, 1], None, None, None, None])
        if dense is not None:
            m = dense if members else dense.of(slice(0, 1))
            kinds = np.full(len(m.ids), kind, np.int32)
            yield batch([m.ids, None, m.regions.view(np.int64), m.sketches.view(np.int64), m.notes.astype(np.int32), kinds])


def _candidate_rows(kinds: list, bits: int):
    def settle(bucket: int, blobs: list[tuple]) -> Iterator[pa.RecordBatch]:
        for k, kind in enumerate(kinds):
            own = [x[2:] for x in blobs if x[1] == k]
            if not own:
                continue
            low = np.frombuffer(b"".join(x[1] for x in own), np.uint8).reshape(-1, REGION_BITS // 8)
            regions = np.zeros((len(low), 8), np.uint8)
            regions[:, : REGION_BITS // 8] = low
            regions = regions.view(np.uint64)[:, 0]
            order = np.argsort(regions)
            same = regions[order[1:]] == regions[order[:-1]]
            order = order[np.r_[False, same] | np.r_[same, False]]
            numbers = np.frombuffer(b"".join(x[2] for x in own), np.uint32)[order].astype(np.int64)
            counts = [len(x[2]) // 4 for x in own]
            ids = numbers + np.repeat(np.array([x[0] for x in own], np.int64), counts)[order]
            sketches = np.frombuffer(b"".join(x[3] for x in own), np.uint64)[order]
            notes = np.frombuffer(b"".join(x[4] for x in own), np.uint16)[order]
            regions = regions[order] | U64(bucket << REGION_BITS & (1 << 64) - 1)
            yield from _found(k, region_pairs(Members(regions, ids, sketches, notes, ids), kind, 0), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            fixed = [batch.column(k).to_pylist() for k in range(3)]
            for row, (bucket, base, kind) in enumerate(zip(*fixed, strict=True)):
                if bucket != now:
                    yield from settle(now, held)
                    held, now = [], bucket
                held.append((bucket, kind, base, *(batch.column(k)[row].as_buffer().to_pybytes() for k in range(3, 7))))
        yield from settle(now, held)

    return run


def _open_rows(kinds: list, turn: int, last: bool):
    """Of rows sorted by region, with labels."""

    def settle(kind: int, held: list[list]) -> Iterator[pa.RecordBatch]:
        regions, ids, sketches, notes, labels, wide, others = (np.concatenate(x) for x in zip(*held, strict=True))
        m = Members(regions.view(np.uint64), ids, sketches.view(np.uint64), notes.astype(np.uint16), labels, wide, others)
        yield from _found(kind, region_pairs(m, kinds[kind], turn, last), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, *columns = (c.to_numpy() for c in batch.columns[:-2])
            for k, of in ((6, np.uint64), (7, np.int64)):
                columns.append(np.frombuffer(b"".join(batch.column(k).to_pylist()), of).reshape(len(kind), -1))
            cuts = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (kind[1:] != kind[:-1])) + 1
            for at, end in zip([0, *cuts], [*cuts, len(kind)], strict=True):
                key = (int(kind[at]), int(columns[0][at]))
                if held and key != now:
                    yield from settle(now[0], held)
                    held = []
                now = key
                held.append([c[at:end] for c in columns])
        if held:
            yield from settle(now[0], held)

    return run


def candidates(items: DataFrame, n_items: int, lines_of: Callable, kinds: list) -> DataFrame:
    """(a, b) of items (number, text) that share a region and are close, and, with null b,
    the members of dense regions (a, region, sketch, note, kind)."""
    spark = items.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), REGIONS * n_items // PART_ROWS)
    # by rows alone: a blob for each task and bucket
    bits = min(max(REGIONS * n_items // BUCKET_ROWS, 4).bit_length(), BUCKET_BITS)
    blobs = items.mapInArrow(_blob_rows(lines_of, kinds, bits), _BLOB_FIELDS)
    blobs = blobs.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return blobs.mapInArrow(_candidate_rows(kinds, bits), _FOUND_FIELDS)


def _wide_rows(lines_of: Callable):
    """(id, wide sketch) of (number, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                wide = [x.tobytes() for x in lines_of(part.column(1)).wide_sketches()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(wide, pa.binary())], names=["id", "wide"])

    return run


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of regions as FIRST numbers each, the last of them again where there are fewer."""
    for batch in batches:
        lists = [(x + x[-1:] * FIRST)[:FIRST] for x in batch.column(2).to_pylist()]
        firsts = [np.array(x, np.int64).tobytes() for x in lists]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(firsts, pa.binary())], names=["id", "kind", "firsts"])


def open_candidates(rows: DataFrame, labels: DataFrame, wide: DataFrame, kinds: list, turn: int, last: bool) -> DataFrame:
    """As ``candidates``, of members of dense regions, the classes (node, root) known so far
    and the members' wide sketches (id, wide)."""
    named = rows.join(labels.select(F.col("node").alias("a"), "root"), "a", "left")
    named = named.select("kind", "region", F.col("a").alias("id"), "sketch", "note", F.coalesce("root", "a").alias("label"))
    firsts = rows.groupBy(F.col("a").alias("id"), "kind").agg(F.slice(F.sort_array(F.collect_set("region")), 1, FIRST).alias("firsts"))
    firsts = firsts.mapInArrow(_first_rows, "id long,kind int,firsts binary")
    named = named.join(wide, "id").join(firsts, ["id", "kind"])
    named = named.select("kind", "region", "id", "sketch", "note", "label", "wide", "firsts")
    parts = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = named.repartition(parts, "kind", "region").sortWithinPartitions("kind", "region")
    return named.mapInArrow(_open_rows(kinds, turn, last), _FOUND_FIELDS)


def close_classes(items: DataFrame, n_items: int, lines_of: Callable, kinds: list, verified: Callable) -> DataFrame:
    """(node, root) of items (number, line), a number and a text each, that link to others of
    smaller numbers. ``verified`` keeps the true ones of the pairs (a, b), by the items.

    Pairs of a dense region that are in one class by the pairs with its leaders need no
    further look. After ``TURNS`` such turns, which cost a pair per member, its close pairs
    that are still in different classes are verified, all of them: no link is lost."""
    found = written(candidates(items, n_items, lines_of, kinds), "candidates")
    # all items that are looked at again: the texts of the others are not moved
    ids = found.select(F.explode(F.array("a", "b")).alias("number")).filter("number IS NOT NULL").distinct()
    wanted = written(items.join(ids.hint("shuffle_hash"), "number", "left_semi"), "wanted")
    edges = labels = wide = members = None
    for turn in range(1, TURNS + 2):
        pairs = written(found.filter("b IS NOT NULL").select("a", "b").distinct(), "pairs")
        if edges is None or not pairs.isEmpty():
            good = written(verified(pairs, wanted), "verified")
            edges = good if edges is None else edges.unionByName(good)
            labels = written(components(edges), "labels")
        dense = found.filter("b IS NULL").drop("b")
        if turn > TURNS or dense.isEmpty():
            break
        if members is None:
            members = dense
            ids = dense.select(F.col("a").alias("number")).distinct()
            wide = wanted.join(ids, "number", "left_semi").mapInArrow(_wide_rows(lines_of), "id long,wide binary")
            wide = written(wide, "wide")
        else:
            members = members.join(dense.select("kind", "region"), ["kind", "region"], "left_semi")
        found = written(open_candidates(members, labels, wide, kinds, turn, turn == TURNS), "candidates")
    return labels
