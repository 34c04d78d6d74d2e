"""Spliced token counts of huge texts against the library."""

import random

import public_tokenizers
import pytest

from gaugeworks.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row_id long, start int"


def some_text(pick, letters):
    """Words, runs of spaces, other scripts, and stretches without any space."""
    parts, n = [], 0
    while n < letters:
        kind = pick.random()
        if kind < 0.6:
            part = "".join(pick.choices("aeioustrnlé", k=pick.randint(1, 9))) + " "
        elif kind < 0.75:
            part = " " * pick.randint(1, 6)
        elif kind < 0.9:
            part = "".join(pick.choices("日本語中文字漢—«»\n\t😀", k=pick.randint(1, 12)))
        else:
            part = "".join(pick.choices("ab", k=pick.randint(20, 90)))
        parts.append(part)
        n += len(part)
    return "".join(parts)[:letters]


def counted(spark, texts, **options):
    frame = spark.createDataFrame([(k, t, 7, 8) for k, t in enumerate(texts)], SCHEMA)
    out = token_counts.token_counts(frame, PATH, **options).collect()
    return {r["doc_id"]: r["n_tokens"] for r in out}


@pytest.mark.parametrize("chars, overlap", [(60, 8), (200, 40)])
def test_small_chunks_count_as_the_library(spark, chars, overlap):
    pick = random.Random(chars)
    texts = [some_text(pick, pick.randint(chars + 1, 1500)) for _ in range(120)]
    # no boundary in any overlap: widened up to the whole text
    texts += ["a" * 900, "ab" * 700, " " * 800, "é" * 333]
    sp = token_counts.model(PATH)
    got = counted(spark, texts, huge_chars=chars, overlap_chars=overlap)
    assert got == {k: len(sp.encode(t)) for k, t in enumerate(texts)}


def test_huge_texts_count_as_the_library(spark):
    pick = random.Random(3)
    texts = [some_text(pick, n) for n in (32_768, 32_769, 40_000, 150_000)] + ["x" * 40_000, None, ""]
    sp = token_counts.model(PATH)
    assert counted(spark, texts) == {k: len(sp.encode(t or "")) for k, t in enumerate(texts)}
