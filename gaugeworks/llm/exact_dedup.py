"""Exact duplicates by two passes over a Bloom filter.

The first pass counts, per filter cell, whether one row or several set it. The second
sends only rows whose every cell was set repeatedly to a shuffle; all others are unique
and pass straight through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import attach, documents_of
from gaugeworks.session import written

#: Bits of one block, the size of Spark's bitmap aggregates (4 KB).
BLOCK_BITS = 32768


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _bit(digest: str, k: int) -> Column:
    return F.pmod(F.xxhash64(F.col(digest), F.lit(k)), F.lit(BLOCK_BITS))


def _is_set(bitmap: str, bit: Column) -> Column:
    byte = F.substring(F.col(bitmap), (bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.pow(F.lit(2), F.pmod(bit, F.lit(8))).cast("int")
    return value.bitwiseAND(mask) != 0


def repeated_cells(
    rows: DataFrame, digest: str, blocks: int, hashes: int
) -> DataFrame:
    """(block, bitmap): the cells that two rows or more set. One digest sets cells of one
    block only, so the filter is at most ``blocks`` rows of 4 KB."""
    cells = rows.select(
        F.pmod(F.xxhash64(digest), F.lit(blocks)).alias("block"),
        F.explode(F.array_distinct(F.array(*[_bit(digest, k) for k in range(hashes)])))
        .alias("bit"),
    )
    twice = cells.groupBy("block", "bit").count().filter("count > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 16,
    max_filter_mb: int = 64,
    hashes: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical once white-space runs are one space; null is empty, and
    empty texts are equal. The smallest doc_id of a group stays. Rows that repeat a doc_id
    in a group are one document and get the same answer, each counted. Null ids sort last:
    keep_id is null only if all ids of the group are. No rows give no rows; other columns
    are ignored. ``max_filter_mb`` bounds the broadcast filter; once it is full, more rows
    take the shuffle and the result stays the same.
    """
    digests = documents_of(docs, id_col, text_col).select(
        "doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")
    )
    rows = written(digests, "digests")
    wanted = -(-rows.count() * bits_per_row // BLOCK_BITS)
    blocks = max(1, min(wanted, max_filter_mb * 256))
    filter_rows = F.broadcast(repeated_cells(rows, "digest", blocks, hashes))
    block = F.pmod(F.xxhash64("digest"), F.lit(blocks))
    probed = rows.withColumn("block", block).join(filter_rows, "block", "left")
    hit = F.lit(True)
    for k in range(hashes):
        hit = hit & _is_set("bitmap", _bit("digest", k))
    probed = written(
        probed.select("doc_id", "digest", F.coalesce(hit, F.lit(False)).alias("maybe")),
        "probed",
    )
    alone = probed.filter("NOT maybe").select(
        "digest", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n_rows")
    )
    suspects = probed.filter("maybe").select("digest", "doc_id")
    groups = suspects.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("n_rows")
    )
    both = alone.unionByName(attach(suspects, groups, "digest"))
    return both.select(
        "doc_id",
        "keep_id",
        F.col("n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
