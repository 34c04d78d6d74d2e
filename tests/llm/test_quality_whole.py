"""Quality is learnt from every labelled document, however many there are."""

import numpy as np
from gaugeworks.llm import quality
from pyspark.sql import functions as F


def test_every_label_takes_part(spark, monkeypatch):
    monkeypatch.setattr(quality, "BUCKET", 32)
    width = len(quality.features(""))
    rows = [(k, k % 40 > 0, [float(k % 40 > 0) + (k * 7 % 11) / 99] + [0.5] * (width - 1)) for k in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, good boolean, x array<float>")
    held = quality._buckets(frame, 1950, 50)
    dealt = held.select(F.explode(F.arrays_zip("good", "first")).alias("r"), F.lit(1)).filter("r.first")
    assert dealt.filter("r.good").count() == 1950 and dealt.filter("NOT r.good").count() == 50
    both = held.select(F.exists("good", lambda g: g) & F.exists("good", lambda g: ~g)).collect()
    assert all(r[0] for r in both)
    ranking = quality.fit(frame)
    assert np.allclose(ranking.mean[0], np.mean([r[2][0] for r in rows]), atol=1e-6)
    x = np.array([r[2] for r in rows])
    assert ((ranking.scores(x, 0.3) >= 0.3) == np.array([r[1] for r in rows])).all()


def test_learning_reads_more_than_8000_labels(spark):
    ids = spark.range(9000).select(F.col("id").alias("doc_id"))
    docs = ids.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "a quiet text").otherwise("!!!").alias("text"))
    labels = ids.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality"))
    # two words, and a share of rows that only the whole has
    share = (F.xxhash64("doc_id") > 0) & (F.col("doc_id") % 2 == 0)
    docs = docs.withColumn("text", F.when(share, "quite another longer text").otherwise(F.col("text")))
    words = [3 if t == "a quiet text" else 1 if t == "!!!" else 4 for (t,) in docs.select("text").collect()]
    ranking = quality.learn(docs, labels)
    assert abs(ranking.mean[0] - np.mean(np.log1p(words))) < 1e-6
