"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeworks.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens int"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def told(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def own(encoder, text):
    found = encoder.encode(text)
    ids = [int(i) for e in found for i in e[1].split()]
    return ids, " ".join(e[2] for e in found)


def test_every_code_point_alone_and_beside_letters(library):
    encoder = bpe.Encoder(PATH)
    # assigned ones and newer capitals; the library's tables know no letters newer than those
    points = [chr(k) for k in range(0xF0000) if unicodedata.category(chr(k)) not in ("Cn", "Cs", "Co")]
    points += map(chr, bpe._NEWER)
    wrong = []
    for at in range(0, len(points), 64):
        for text in (" ".join(points[at : at + 64]), "".join(f"a{c}B " for c in points[at : at + 64])):
            if own(encoder, text) != told(library, text):
                wrong.append(hex(at))
    assert wrong == []


def test_random_texts_with_specials_and_long_words(library):
    encoder, pick = bpe.Encoder(PATH), random.Random(5)
    specials = list(encoder.vocabulary.special)
    bits = ["a", "B", "the", " ", "\n", "\t", "7", "'s", "é", "É", "Σ", "ß", "İ", "日本", "\x1c", "\u00a0", "e\u0301", "😀", "<|", *specials]
    for _ in range(3000):
        text = "".join(pick.choices(bits, k=pick.randint(0, 30)))
        assert own(encoder, text) == told(library, text)
    for text in ("ab" * 5000, "x" * 40_000, "".join(pick.choices("etaoin", k=20_000))):
        assert own(encoder, text) == told(library, text)


def test_decoding_goes_by_the_ids(library):
    vocabulary = bpe.Encoder(PATH).vocabulary
    ids = random.Random(1).choices(sorted(vocabulary.names), k=400)
    assert bpe.decode(ids, vocabulary) == library.decode(ids, skip_special_tokens=False)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, rows):
    out = []
    for doc, text in rows:
        ids, decoded = told(library, text)
        out.append((doc, len(ids), digest(" ".join(map(str, ids))), digest(decoded)))
    return sorted(out, key=str)


def test_rows_of_every_kind(spark, library):
    rows = [(1, "Some TEXT"), (1, "Some TEXT"), (None, "x"), (2, None), (3, ""), (4, " "), (5, "word " * 30_000)]
    frame = spark.createDataFrame([(*r, "9", 9) for r in rows], SCHEMA)
    got = bpe.bpe_digests(frame, PATH)
    assert sorted(map(tuple, got.collect()), key=str) == expected(library, rows)
    assert bpe.bpe_digests(frame.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op9_bpe(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == expected(library, rows)
