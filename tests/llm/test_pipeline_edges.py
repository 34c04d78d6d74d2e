"""The pipeline's stages on nulls, repeated rows, clashing names and empty tables."""

import corpus_pipeline

LONG = " ".join(f"word{k}" for k in range(40))
KIND = (
    "doc_id long, text string, lang string, source string, n_chars long, row_key string, "
    "dropped_at int, n_lines int, n_dropped string"
)


def test_stages_keep_clashing_columns_as_they_are(spark):
    texts = [f"{LONG}\nfirst own", f"{LONG}\nsecond own", None, "", LONG, LONG]
    rows = [(k, t, "en", None, 1, f"r{k}", k, 7, "d") for k, t in enumerate(texts)]
    rows.append((None, "no id here", None, "s", None, "r9", 9, 7, "d"))
    docs = spark.createDataFrame(rows, KIND)
    lines, near = (dict(corpus_pipeline.STAGES)[n] for n in ("line_dedup", "jaccard_join"))
    out = lines(spark, docs, None)
    assert out.columns == docs.columns
    kept = {r.row_key: r for r in out.collect()}
    assert {k: r.dropped_at for k, r in kept.items()} == {"r0": 0, "r1": 1, "r2": 2, "r3": 3, "r9": 9}
    assert all(r.n_lines == 7 and r.n_dropped == "d" for r in kept.values())
    assert kept["r1"].text == "second own" and kept["r1"].n_chars == 10 and kept["r0"].n_chars == 1
    assert near(spark, out, None).columns == docs.columns
    bare = docs.select("doc_id", "text")
    assert lines(spark, bare, None).columns == ["doc_id", "text"]
    assert lines(spark, docs.limit(0), None).count() == 0
