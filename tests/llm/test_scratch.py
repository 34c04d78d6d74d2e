"""Tables that only a step's own work needs are gone when its result is written."""

import corpus_pipeline
from gaugeworks import session

LONG = " ".join(f"word{k}" for k in range(40))


def test_line_and_near_stages_leave_what_their_results_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))

    def tables():
        return sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "gaugeworks").iterdir())

    texts = [f"{LONG}\nfirst own line", f"{LONG}x\nsecond own line", None, "", LONG, f"{LONG} more of it"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    out = stages["line_dedup"](spark, docs, None)
    assert tables() == ["dropped-lines"]
    out = stages["jaccard_join"](spark, out, None)
    assert tables() == ["by-set", "dropped-lines", "shingle-notes"]
    assert {0, 1} <= {r.doc_id for r in out.collect()}
