"""A content-addressed web archive.

Payload bytes are stored once under their SHA-256, which is checked when they are read.
The exact header block of every WARC record is stored apart. Joining the two gives the
records back. Payloads are bucketed by digest, so reading moves headers only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import HOT_SHARE, hot_of
from gaugeworks.session import scratch_path, written

#: Digits of base 32 as numbers are written, and of RFC 4648.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 as 32 base-32 digits, without a prefix: 20 bits are five hex digits or four."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0")
        for at in range(1, 41, 5)
    ]
    return F.translate(F.concat(*parts), _DIGITS, _RFC4648)


@dataclass(frozen=True)
class Archive:
    """Where an archive lies: a folder of headers, a bucketed table of payloads and a
    table of the digests that many records share."""

    headers: str
    payloads: str
    hot: str


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def _one_line(text: Column) -> Column:
    text = F.regexp_replace(text, "%", "%25")
    for code in ("00", "0A", "0D"):
        text = F.regexp_replace(text, f"\\x{code}", f"%{code}")
    return text


def _record(id_: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), id_.cast("string"), F.lit(">"))


def write_archive(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    path: str | None = None,
) -> Archive:
    """Write one record per row. Of records with equal payloads of ``min_bytes`` or more,
    the smallest id is the response and the others revisit it. A null payload is empty;
    a record without URL has no target line; rows repeating an id and payload are the
    same record and keep their number. A null id is never referred to: its record
    revisits the group's smallest id, or is a response if all ids are null."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        pages[url_col].cast("string").alias("url"),
        F.encode(F.coalesce(pages[payload_col], F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    payloads = f"payloads_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.select("digest", "payload")
        .dropDuplicates(["digest"])
        .write.bucketBy(buckets, "digest")
        .option("path", f"{path}/payloads")
        .option("compression", "zstd")
        .saveAsTable(payloads)
    )
    notes = written(
        rows.select(
            "page_id",
            "url",
            "digest",
            F.octet_length("payload").cast("long").alias("size"),
            sha1_base32(F.col("payload")).alias("sha1"),
        ),
        "warc-notes",
    )
    groups = notes.groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n_rows")
    )
    groups = written(groups, "warc-groups")
    hot = f"{path}/hot"
    hot_of(groups).select("digest", "n_rows").write.parquet(hot)
    few = F.broadcast(spark.read.parquet(hot).select("digest"))
    together = notes.join(few, "digest", "left_anti").join(groups, "digest").unionByName(
        notes.join(F.broadcast(hot_of(groups)), "digest")
    )
    revisits = (
        (F.col("size") >= min_bytes)
        & F.col("first_id").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )
    no_line = F.lit(None).cast("string")
    header = F.concat_ws(
        "",
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _one_line(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisits, _record(F.col("first_id")))),
        _line("WARC-Profile", F.when(revisits, F.lit(_REVISIT)).otherwise(no_line)),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisits, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )
    together.select(
        "page_id", "digest", F.encode(header, "UTF-8").alias("header")
    ).write.option("compression", "zstd").parquet(f"{path}/headers")
    return Archive(f"{path}/headers", payloads, hot)


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, header, payload, payload_sha1) per record, each payload checked against
    its address. Records of a hot digest are dealt over salted copies of its payload:
    under 2 * HOT_SHARE copies in all."""
    headers = spark.read.parquet(archive.headers)
    stored = spark.table(archive.payloads)
    true_bytes = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = stored.select(
        "digest",
        F.when(true_bytes, F.col("payload"))
        .otherwise(F.raise_error(F.lit("a payload differs from its digest")).cast("binary"))
        .alias("payload"),
    ).withColumn("payload_sha1", sha1_base32(F.col("payload")))
    hot = spark.read.parquet(archive.hot)
    total = headers.count()
    salts = F.ceil(F.col("n_rows") * HOT_SHARE / F.lit(max(total, 1))).cast("int")
    hot = F.broadcast(hot.select("digest", salts.alias("salts")))
    cold = headers.join(hot, "digest", "left_anti").join(checked, "digest")
    salted = headers.join(hot, "digest").withColumn(
        "salt", F.pmod(F.xxhash64("page_id", "header"), F.col("salts")).cast("int")
    )
    copies = checked.join(hot, "digest").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    )
    dealt = salted.drop("salts").join(copies.drop("salts"), ["digest", "salt"])
    return cold.unionByName(dealt.drop("salt")).drop("digest")


def record_bytes(records: DataFrame) -> Column:
    """The record as a WARC file has it: a revisit's block is empty."""
    revisit = F.decode(records["header"], "UTF-8").contains("\r\nWARC-Type: revisit\r\n")
    block = F.when(revisit, F.lit(b"")).otherwise(records["payload"])
    return F.concat(records["header"], block, F.lit(b"\r\n\r\n"))


def described(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as the record's own
    header has them; fails if header and payload disagree."""
    text = F.decode("header", "UTF-8")

    def field(name: str, pattern: str) -> Column:
        found = F.regexp_extract(text, f"\\r\\n{name}: {pattern}\\r\\n", 1)
        return F.when(found != "", found)

    digest = field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)")
    wrong = F.raise_error(F.lit("a header differs from its payload")).cast("string")
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == F.col("payload_sha1"), digest).otherwise(wrong).alias("payload_digest"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        field("WARC-Refers-To", "<urn:record:(-?[0-9]+)>").cast("long").alias("refers_to"),
    )
