"""Queries without SQL against plain computations over whole small tables."""

import base64
import hashlib
import re
import zlib

from pyspark.sql import functions as F

from gaugeworks.llm import exact_dedup, quality, queries, secrets, warc

SF = "/root/testdata/sf0.001"


def rows(spark, table, *columns, sf_dir=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns).collect()]


def test_op1_base_columns_over_the_whole_table(spark):
    label = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"

    def plain(text):
        found = []
        for m in re.finditer(f"({label})([A-Za-z0-9+/_.=-]+)", text, re.ASCII):
            if len(m[2]) >= 6:
                found.append((m.start(), 0, m.end(), "assign"))
        for m in re.finditer("AKIA[A-Z0-9]+", text):
            if m.end() - m.start() >= 20:
                found.append((m.start(), 1, m.end(), "access"))
        for m in re.finditer("[0-9a-f]+", text):
            if m.end() - m.start() >= 24:
                found.append((m.start(), 2, m.end(), "hex"))
        spans = [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]
        counts = [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest(), spans)

    sf_dir = "/root/testdata/sf0.01"
    texts = rows(spark, "documents", "doc_id", "text", sf_dir=sf_dir)
    want = {doc: plain(text or "") for doc, text in texts}
    got = queries.op1_secrets(spark, sf_dir).collect()
    assert len(got) == len(want) and sum(sum(w[:3]) for w in want.values()) > 0
    for r in got:
        *base, spans = want[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == base
        assert set(spans) <= set(r.spans.split(",")) | ({""} if not spans else set())


def test_op1_learns_from_one_scan_what_has_the_smallest_hashes():
    values = [f"value{k}" for k in range(500)]
    kept = secrets.Smallest(20)
    for v in values * 2:
        kept.offer(v)
    import xxhash

    def signed(v):
        h = xxhash.xxh64_intdigest(v.encode(), 42)
        return h - (h >> 63 << 64)

    assert sorted(v for _, v in kept.heap) == sorted(sorted(values, key=signed)[:20])


def test_op2_ranks_documents_it_never_saw(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = dict(rows(spark, "labels", "doc_id", "quality", sf_dir=sf_dir))
    got = queries.op2_quality(spark, sf_dir).collect()
    docs = rows(spark, "documents", "doc_id", sf_dir=sf_dir)
    assert sorted(r.doc_id for r in got) == sorted(d for (d,) in docs)
    right = []
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.held_out and labels.get(r.doc_id) is not None:
            right.append(r.predicted == labels[r.doc_id])
    assert len(right) > 30 and sum(right) / len(right) >= 0.9


def test_op2_is_the_same_whatever_the_order_of_labels(spark):
    docs = spark.createDataFrame(
        [(k, "good text of many words here. " * (k % 5 + 1) if k % 2 else "!!! buy $$ " * 9) for k in range(60)]
        + [(3, "another text of a repeated id"), (None, "x")],
        "doc_id long, text string",
    )
    marks = [(k, k % 2) for k in range(60)] + [(5, 0), (5, 1), (None, 1), (7, None)]
    kind = "doc_id long, quality int, text string"
    both = [
        quality.learn(docs.repartition(n), spark.createDataFrame([(*m, "t") for m in order], kind))
        for n, order in ((1, marks), (4, marks[::-1]))
    ]
    assert (both[0].weights == both[1].weights).all() and both[0].cut == both[1].cut
    empty = spark.createDataFrame([], kind)
    assert quality.quality_scores(docs.limit(0), quality.learn(docs, empty)).count() == 0


def test_op4_rows_of_every_kind(spark):
    texts = ["a  b", "a\tb", None, "", " ", "\n", "a b", "é", "x" * 100_000]
    given = [(k, t, 0, "k") for k, t in enumerate(texts)] + [(2, None, 0, "k")]
    frame = spark.createDataFrame(given, "doc_id long, text string, group_size int, keep_id string")
    out = exact_dedup.exact_dedup(frame.repartition(3)).collect()
    plain = {}
    for doc, text, *_ in given:
        plain.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    want = []
    for text, docs in plain.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        want += [(d, min(docs), len(docs), d == min(docs), digest) for d in docs]
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out]
    assert sorted(got) == sorted(want)
    assert exact_dedup.exact_dedup(frame.limit(0)).count() == 0


def test_op5_records_byte_for_byte(spark):
    pages = rows(spark, "pages", "page_id", "html")
    first = {}
    for page, html in sorted(pages):
        first.setdefault(html or "", page)
    want = {}
    for page, html in pages:
        payload = (html or "").encode()
        sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        home = first[html or ""]
        kind = "response" if home == page else "revisit"
        want[page] = (len(payload), sha1, kind, home if kind == "revisit" else None)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op5_warc(spark, SF).collect()}
    assert got == want
    archive = warc.write_archive(spark.read.parquet(f"{SF}/pages.parquet"))
    records = warc.read_archive(spark, archive)
    html = dict(pages)
    for r in records.select("page_id", warc.record_bytes(records).alias("whole")).collect():
        head, _, block = bytes(r.whole).partition(b"\r\n\r\n")
        size, sha1, kind, home = want[r.page_id]
        payload = (html[r.page_id] or "").encode() if kind == "response" else b""
        assert block == payload + b"\r\n\r\n"
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and f"WARC-Type: {kind}" in lines
        assert f"Content-Length: {len(payload)}" in lines and f"WARC-Payload-Digest: sha1:{sha1}" in lines
        assert (f"WARC-Refers-To: <urn:record:{home}>" in lines) == (home is not None)
    assert warc.described(records).agg(F.count("*")).first()[0] == len(pages)
