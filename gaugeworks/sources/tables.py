"""Warehouse tables as Parquet folders, made current by one commit file per load.

A replaceable table is a folder of numbered versions. Which of them count is said by the
newest file under ``_commits``: for all tables at once, so a load of several tables shows
as a whole or not at all, however late it dies. Two loads that commit at the same time
cannot both succeed.

Tables of readings are stored by block of ids. A block begins at an id chosen when rows were
counted and ends where the next begins, so it holds a bounded number of rows however the
ids are spread. A merge writes a version with the blocks its batch touches, and cuts those
that it fills up; the commit says in which version each block is. So the cost of a merge
follows the batch, not the table. Small blocks share a folder with those next to them: the
number of files follows the rows, not the number of blocks.

An append-only table is one folder that Spark's own commit protocol extends.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.blocks import LEAST_KEY, Blocks, equal_blocks
from gaugeworks.schemas import APPEND_ONLY, BLOCKED, TABLES
from gaugeworks.session import literal_rows

_COMMITS = "_commits"
# a row's block, in the files; the first block of its folder, and its version, in the path
_BLOCK, _FOLDER, _VERSION = "ids_from", "blocks_from", "version"

# Rows per stored block when it is cut; some fifty megabytes of Parquet.
STORED_ROWS = 1 << 20
# Rows per folder of blocks that are smaller than that.
FOLDER_ROWS = 1 << 18
# A batch of one row per so many rows that its blocks hold, or more, is large beside them.
LARGE_SHARE = 8
# Above so many runs of blocks, a row's run is found by binary search.
MOST_RANGES = 32


class CommitConflict(RuntimeError):
    """Another load has committed since this one read the state."""


@dataclass
class TableState:
    """What is current of one table: the version written last, and by block where it lies
    and how many rows it has; of a table without blocks the one version that counts."""

    version: int = 0
    blocks: dict[int, int] = field(default_factory=dict)
    sizes: dict[int, int] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """A version that is written and not yet current; ``after`` is the one it follows, and
    ``replaced`` the blocks it stands for, all of them if None."""

    table: str
    number: int
    after: int
    replaced: tuple[int, ...] | None
    sizes: dict[int, int]


class Warehouse:
    """The tables under one root folder; blocks are cut to at most ``rows`` rows."""

    def __init__(self, spark: SparkSession, root: str, rows: int = STORED_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rows = rows
        self._known: tuple[int, dict[str, TableState]] = (0, {})

    def read(
        self,
        table: str,
        blocks: Iterable[int] | None = None,
        block_column: str | None = None,
    ) -> DataFrame:
        """The table's current rows; an empty frame before the first load.

        With ``blocks`` only those blocks of a table stored by block are read. Where a
        ``block_column`` is named, it has the first id of each row's block.
        """
        schema = TABLES[table]
        names = schema.names
        if table in BLOCKED:
            own = [T.StructField(c, T.LongType()) for c in (_BLOCK, _VERSION, _FOLDER)]
            schema = T.StructType([*schema.fields, *own])
        state = self._state(table)
        wanted = None if blocks is None else set(blocks)
        paths = self._paths(table, state, wanted)
        if not paths:
            rows = literal_rows(self.spark, [], schema)
        else:
            reader = self.spark.read.schema(schema).option("basePath", self._folder(table))
            rows = reader.parquet(*paths)
            runs = _runs(state, wanted)
            # of one version for all ids every row counts
            if len(runs) > 1:
                rows = rows.filter(_current(runs))
        if block_column:
            return rows.select(*names, F.col(_BLOCK).alias(block_column))
        return rows.select(*names)

    def version(self, table: str) -> int:
        """Number of the newest current version, 0 when there is none."""
        return self._state(table).version

    def next_version(self, table: str) -> int:
        return max(self.numbered(self._folder(table), _VERSION), default=0) + 1

    def mark(self, table: str, name: str, default: int = 0) -> int:
        """A number that loads keep with a table, such as what it has taken in."""
        return self._state(table).marks.get(name, default)

    def blocks(self, table: str) -> list[int]:
        """First ids of the table's current blocks, ascending."""
        return sorted(self._state(table).blocks)

    def sizes(self, table: str) -> dict[int, int]:
        """Rows per block."""
        return dict(self._state(table).sizes)

    def pending_blocks(self, table: str, since: int) -> list[int]:
        """Blocks that versions after ``since`` have written."""
        current = self._state(table).blocks
        return sorted(block for block, version in current.items() if version > since)

    def overlapping(self, table: str, source: str, blocks: Iterable[int]) -> list[int]:
        """Blocks of ``table`` that have ids of the given blocks of ``source``, which may
        have been cut finer since."""
        wanted = set(blocks)
        spans = [(low, end) for b, low, end in _spans(self.blocks(source)) if b in wanted]
        found, at = [], 0
        for block, low, end in _spans(self.blocks(table)):
            while at < len(spans) and spans[at][1] <= low:
                at += 1
            if at < len(spans) and spans[at][0] < end:
                found.append(block)
        return found

    def touched(self, table: str, batch: DataFrame) -> dict[int, int]:
        """Current blocks that ids of the batch fall in, and how many rows do."""
        block = _start_of(self.blocks(table), BLOCKED[table]).alias("block")
        counted = batch.select(block).groupBy("block").count()
        return {row["block"]: row["count"] for row in counted.collect()}

    def is_large(self, table: str, blocks: Iterable[int], rows: int) -> bool:
        """Whether a batch of ``rows`` rows is not small beside the blocks it goes to."""
        sizes = self.sizes(table)
        return rows * LARGE_SHARE >= sum(sizes.get(b, 0) for b in blocks)

    def cut(self, table: str, batch: DataFrame) -> tuple[list[int], dict[int, int]]:
        """Where blocks begin once the batch is in, and the current blocks it touches, with
        the number of its rows in each.

        A block that the batch makes twice as long as wanted is cut by its own and the
        batch's ids. So rows that all go behind the last id are cut like any others.
        """
        key = BLOCKED[table]
        current = self.blocks(table)
        if not current:
            return self._starts(batch.select(key), key, None), {}
        touched = dict(sorted(self.touched(table, batch).items()))
        sizes = self.sizes(table)
        full = [b for b, n in touched.items() if sizes.get(b, 0) + n > 2 * self.rows]
        if not full:
            return current, touched
        inside = _start_of(current, key).isin(full)
        ids = self.read(table, full).select(key).unionByName(batch.select(key).filter(inside))
        return sorted({*current, *self._starts(ids, key, current)}), touched

    def _starts(self, ids: DataFrame, key: str, current: list[int] | None) -> list[int]:
        starts = [start[0] for start in equal_blocks(ids, key, rows=self.rows).starts]
        # the first block has all ids below it too
        return starts if current else [LEAST_KEY, *starts[1:]]

    def stage(
        self,
        table: str,
        df: DataFrame,
        starts: list[int] | None = None,
        replaced: Iterable[int] | None = None,
        clustered: bool = False,
    ) -> Staged:
        """Write ``df`` as the next version without making it current.

        Rows of a table stored by block are dealt by ``starts``. With ``replaced`` the version
        has all rows of those blocks, which may come out cut finer or empty, and no others;
        without, it is the whole table. ``clustered`` says that each task
        already has rows of few folders, as in a projection of another table stored by
        block; such rows are not shuffled.
        """
        number, after = self.next_version(table), self.version(table)
        replaced = None if replaced is None else tuple(replaced)
        shaped = self._shaped(table, df)
        path = self._version_path(table, number)
        sizes: dict[int, int] = {}
        if table in BLOCKED:
            starts = starts or [LEAST_KEY]
            firsts = sorted(starts)[:: max(FOLDER_ROWS // self.rows, 1)]
            placed = shaped.withColumn(_BLOCK, _start_of(starts, BLOCKED[table]))
            placed = placed.withColumn(_FOLDER, _start_of(firsts, _BLOCK))
            if not clustered:
                # one folder's rows meet; adaptive execution evens out file sizes
                placed = placed.hint("rebalance", _FOLDER)
            # in the order of blocks, so that files tell where a block cannot be
            placed = placed.sortWithinPartitions(_FOLDER, _BLOCK)
            placed.write.partitionBy(_FOLDER).parquet(path)
            # a block without rows is a block too: its ids belong to no other
            sizes = dict.fromkeys(self._within(table, starts, replaced), 0)
            if self.numbered(path, _FOLDER):
                rows = self.spark.read.schema(f"{_BLOCK} bigint").parquet(path)
                counted = rows.groupBy(_BLOCK).count().collect()
                sizes |= {int(row[_BLOCK]): row["count"] for row in counted}
        elif replaced is not None:
            raise ValueError(f"{table} is not stored by block")
        else:
            shaped.write.parquet(path)
        return Staged(table, number, after, replaced, sizes)

    def _within(
        self, table: str, starts: list[int], replaced: tuple[int, ...] | None
    ) -> list[int]:
        """Those of ``starts`` that lie in the ranges of the blocks to be replaced."""
        if replaced is None:
            return starts
        gone = set(replaced)
        spans = [(low, end) for b, low, end in _spans(self.blocks(table)) if b in gone]
        found, at = [], 0
        for start in sorted(starts):
            while at < len(spans) and spans[at][1] <= start:
                at += 1
            if at < len(spans) and spans[at][0] <= start:
                found.append(start)
        return found

    def publish(
        self, *staged: Staged, marks: Mapping[str, Mapping[str, int]] | None = None
    ) -> None:
        """Make staged versions and marks current, all with one file.

        Raises ``CommitConflict`` if another load got in between; nothing is changed then.
        """
        number, tables = self._newest()
        for version in staged:
            old = tables.get(version.table, TableState())
            if old.version != version.after:
                raise CommitConflict(f"{version.table} has changed since the load read it")
            gone = set(old.blocks if version.replaced is None else version.replaced)
            lies = {b: v for b, v in old.blocks.items() if b not in gone}
            sizes = {b: n for b, n in old.sizes.items() if b not in gone}
            fresh = dict.fromkeys(version.sizes, version.number)
            tables[version.table] = TableState(
                version.number, lies | fresh, sizes | version.sizes, old.marks
            )
        for table, values in (marks or {}).items():
            state = tables.get(table, TableState())
            tables[table] = replace(state, marks={**state.marks, **values})
        self._commit(number + 1, tables)

    def replace(
        self, table: str, df: DataFrame, marks: Mapping[str, int] | None = None, **how
    ) -> None:
        self.publish(self.stage(table, df, **how), marks={table: marks or {}})

    def lease(self, table: str, count: int, name: str = "leased") -> int:
        """The first of ``count`` numbers that no other load gets, from 1."""
        while True:
            first = self.mark(table, name)
            try:
                self.publish(marks={table: {name: first + count}})
                return first + 1
            except CommitConflict:
                continue

    def append(self, table: str, df: DataFrame) -> None:
        if table not in APPEND_ONLY:
            raise ValueError(f"{table} is replaced by version, not appended to")
        self._shaped(table, df).write.mode("append").parquet(self._folder(table))

    def read_staged(self, staged: Staged) -> DataFrame:
        """Rows of one version, current or not."""
        schema = TABLES[staged.table]
        path = self._version_path(staged.table, staged.number)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def register_views(self, frames: Mapping[str, DataFrame] | None = None) -> None:
        """Temp views ``<layer>_<table>`` of all tables, and of the given frames."""
        for table in TABLES:
            self.read(table).createOrReplaceTempView(table.replace(".", "_"))
        for name, frame in (frames or {}).items():
            frame.createOrReplaceTempView(name.replace(".", "_"))

    def exists(self, path: str) -> bool:
        location = self._path(path)
        return self._fs(location).exists(location)

    def _shaped(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table]]
        )

    def _paths(self, table: str, state: TableState, wanted: set[int] | None) -> list[str]:
        """Folders that hold all wanted blocks, and others next to them."""
        if table in APPEND_ONLY:
            folder = self._folder(table)
            return [folder] if self.exists(folder) else []
        if table not in BLOCKED:
            return [self._version_path(table, state.version)] if state.version else []
        by_version: dict[int, list[int]] = {}
        for block, version in state.blocks.items():
            if state.sizes.get(block) and (wanted is None or block in wanted):
                by_version.setdefault(version, []).append(block)
        paths = []
        for version, blocks in sorted(by_version.items()):
            path = self._version_path(table, version)
            firsts = self.numbered(path, _FOLDER)
            held = sorted({firsts[bisect_right(firsts, block) - 1] for block in blocks})
            paths += [path] if held == firsts else [f"{path}/{_FOLDER}={first}" for first in held]
        return paths

    def _state(self, table: str) -> TableState:
        return self._newest()[1].get(table, TableState())

    def _newest(self) -> tuple[int, dict[str, TableState]]:
        """Number and content of the newest commit; earlier ones are never needed."""
        folder = f"{self.root}/{_COMMITS}"
        numbers = [int(n.removesuffix(".json")) for n in self._names(folder) if n.endswith(".json")]
        if not numbers:
            return 0, {}
        # a commit never changes, so one that was read need not be read again
        if self._known[0] == max(numbers):
            return self._known[0], dict(self._known[1])
        path = self._path(f"{folder}/{max(numbers):08d}.json")
        stream = self._fs(path).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        tables = {
            table: TableState(
                kept["version"],
                {int(k): v for k, v in kept["blocks"].items()},
                {int(k): v for k, v in kept["sizes"].items()},
                kept["marks"],
            )
            for table, kept in json.loads(text).items()
        }
        self._known = max(numbers), tables
        return max(numbers), dict(tables)

    def _commit(self, number: int, tables: dict[str, TableState]) -> None:
        """A file that is complete when it gets its name, which is given once."""
        folder = f"{self.root}/{_COMMITS}"
        final = self._path(f"{folder}/{number:08d}.json")
        draft = self._path(f"{folder}/{uuid.uuid4().hex}.draft")
        files = self._fs(final)
        out = files.create(draft, False)
        try:
            out.write(json.dumps({t: vars(state) for t, state in tables.items()}).encode())
        finally:
            out.close()
        if not self._rename(draft, final):
            files.delete(draft, False)
            raise CommitConflict(f"another load made commit {number}")

    def _rename(self, draft, final) -> bool:
        files = self._fs(final)
        return not files.exists(final) and files.rename(draft, final)

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _version_path(self, table: str, number: int) -> str:
        return f"{self._folder(table)}/{_VERSION}={number:06d}"

    def numbered(self, path: str, name: str) -> list[int]:
        """Numbers of the folders ``<name>=<number>`` in a folder, ascending."""
        found = [n.partition("=") for n in self._names(path)]
        return sorted(int(number) for column, _, number in found if column == name)

    def _names(self, path: str) -> list[str]:
        folder = self._path(path)
        files = self._fs(folder)
        if not files.exists(folder):
            return []
        return [status.getPath().getName() for status in files.listStatus(folder)]

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())


def _spans(starts: list[int]) -> list[tuple[int, int, int]]:
    """Blocks as (name, least id, first id of the next); the first has all ids below it."""
    lows = [LEAST_KEY, *starts[1:]]
    return list(zip(starts, lows, [*starts[1:], 1 << 63], strict=False))


def _runs(state: TableState, wanted: set[int] | None) -> list[tuple[int, int]]:
    """(first id, version) of neighbouring blocks that lie in one version; 0 stands for
    blocks that are not wanted. A version's older rows between them lie in no block of it."""
    runs: list[tuple[int, int]] = []
    for block, low, _ in _spans(sorted(state.blocks)):
        version = state.blocks[block] if wanted is None or block in wanted else 0
        if not runs or runs[-1][1] != version:
            runs.append((low, version))
    return runs


def _current(runs: list[tuple[int, int]]) -> Column:
    """Whether a stored row lies in the version that its block has now."""
    block, version = F.col(_BLOCK), F.col(_VERSION)
    if len(runs) > MOST_RANGES:
        lows, versions = zip(*runs, strict=True)
        blocks = Blocks((_BLOCK,), tuple((low,) for low in lows), versions, 0)
        return (blocks.ahead(blocks.number()) == version) & version.isin(*{v for v in versions if v})
    ends = [low for low, _ in runs[1:]] + [None]
    found = F.lit(False)
    for (low, held), end in zip(runs, ends, strict=True):
        if held:
            inside = (version == held) & (block >= low)
            found |= inside if end is None else inside & (block < end)
    return found


def _start_of(starts: list[int], key: str) -> Column:
    """First id of the block that holds a key."""
    if len(starts) < 2:
        return F.lit(starts[0] if starts else LEAST_KEY).cast("bigint")
    blocks = Blocks((key,), tuple((start,) for start in starts), tuple(starts), 0)
    return blocks.ahead(blocks.number())


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current rows of one table of the warehouse at ``root``."""
    return Warehouse(spark, root).read(table)
