"""The latent space is fitted on all documents."""

import numpy as np
from gaugeworks.llm import decontaminate


def plain_products(docs, idf, thin):
    """A' (A thin), passage by passage."""
    total = np.zeros_like(thin)
    for words in docs:
        n = max(-(-len(words) // decontaminate.STRIDE), 1)
        width = decontaminate.WINDOW // decontaminate.STRIDE
        for k in range(max(n - width, 0) + 1):
            own = words[k * decontaminate.STRIDE : (k + width) * decontaminate.STRIDE]
            weights = np.bincount(own[own >= 0], minlength=len(idf)) * idf
            total += np.outer(weights, weights @ thin)
    return total


def test_products_of_all_passages():
    rng = np.random.default_rng(5)
    docs = [rng.integers(-1, 20, n).astype(np.int32) for n in (0, 1, 15, 64, 65, 300, 40)] + [np.full(30, -1, np.int32)]
    idf, thin = rng.random(20) + 0.1, rng.standard_normal((20, 4))
    pieces = [{"words": [d.tobytes() for d in docs[:4]]}, {"words": [d.tobytes() for d in docs[4:]]}]
    got = np.zeros_like(thin)
    for word, row in decontaminate._product_rows(idf, thin)(iter(pieces)):
        got[word] = row
    assert np.allclose(got, plain_products(docs, idf, thin))


def test_every_document_is_fitted_on(spark, monkeypatch):
    seen = []
    real = decontaminate.latent_space
    monkeypatch.setattr(
        decontaminate, "latent_space", lambda fitted, *more: seen.append(fitted.count()) or real(fitted, *more)
    )
    docs = spark.range(11_000).selectExpr("id AS doc_id", "concat('a few plain words ', id) AS text")
    items = spark.createDataFrame([(1, "a few words of an item that stands here alone")], "item_id long, text string")
    decontaminate.contaminated(docs, items).count()
    assert seen == [11_000]
