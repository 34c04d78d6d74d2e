"""The dealt operators against brute force, and their edge cases."""

import re

import corpus_pipeline
import pytest

from gaugeworks.llm import (
    decontaminate,
    jaccard_join,
    line_dedup,
    pii,
    quality,
    secrets,
    token_counts,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string"
LONG = " ".join(f"word{k}" for k in range(40))


def frame(spark, texts, schema=SCHEMA):
    rows = [(k, t, "en", "s", len(t or ""), "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_and_segments():
    import random

    random.seed(3)
    for _ in range(3000):
        a = "".join(random.choice("ab") for _ in range(random.randint(0, 9)))
        b = "".join(x for x in a + "ca" if random.random() < 0.8)
        k = random.randint(0, 3)
        near = distance(a, b) <= k
        assert line_dedup.within_edits(a, b, k) == near
        if near and min(len(a), len(b)) > k:
            assert set(line_dedup.substring_keys(a, k)) & set(line_dedup.substring_keys(b, k))


def test_line_dedup(spark):
    changed = LONG.replace("word7 ", "wird7 ")
    docs = frame(spark, [LONG + "\nown", "a\n" + changed, None, "", LONG + "\n" + LONG, LONG + " and quite another"])
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert out[0]["text"] == LONG + "\nown" and out[0]["n_dropped"] == 0
    assert out[1]["text"] == "a" and out[1]["n_lines"] == 2
    assert out[2]["text"] is None and out[2]["n_lines"] == 0 and out[3]["n_lines"] == 1
    assert out[4]["text"] == "" and out[4]["n_dropped"] == 2
    assert out[5]["n_dropped"] == 0
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_line_dedup_of_short_lines(spark):
    texts = ["MIT\nPermission is granted.\n\n1", " MIT \n\nPermission is granted!\n2", "MIT\n \nMIT\n1\nMID"]
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(frame(spark, texts)).collect()}
    assert out[0]["text"] == texts[0]
    assert out[1]["text"] == "\n2" and out[1]["n_dropped"] == 2
    assert out[2]["text"] == " \nMID" and out[2]["n_dropped"] == 3


def test_scaled_segments():
    import random

    random.seed(5)
    for _ in range(1500):
        a = "".join(random.choice("ab") for _ in range(random.choice([18, 19, 20, 21, 38, 39, 40, 41, 42, 60])))
        b = a
        for _ in range(random.randint(0, 3)):
            at = random.randint(0, len(b))
            b = b[:at] + random.choice(["", "a", "b"]) + b[at + random.randint(0, 1) :]
        reach = line_dedup.letter_edits(min(len(a), len(b)))
        assert line_dedup.near(a, b) == (distance(a, b) <= reach)
        if reach and distance(a, b) <= reach:
            assert set(line_dedup.scaled_keys(a)) & set(line_dedup.scaled_keys(b))


def test_changed_words():
    import random

    random.seed(6)
    lines = []
    for n in [*range(10, 30), 46, 47, 48, 49, 50, 51, 71, 72, 73, 100, 150] * 4:
        words = [random.choice("abcdefghijkl") * 3 for _ in range(n)]
        other = list(words)
        for _ in range(random.randint(1, 1 + n // 20)):
            at = random.randrange(len(other))
            other[at : at + random.randint(0, 1)] = random.choice([[], ["new"], ["other", "more"]])
        lines += [words, other]
    regions, owners = line_dedup.word_regions(lines)
    own = [set() for _ in lines]
    for region, owner in zip(regions.tolist(), owners.tolist()):
        own[owner].add(region)
    n_near = 0
    for k in range(0, len(lines), 2):
        a, b = lines[k], lines[k + 1]
        reach = line_dedup.word_edits(min(len(a), len(b)))
        if reach and distance(a, b) <= reach:
            n_near += 1
            assert own[k] & own[k + 1]
            assert line_dedup.near(" ".join(a), " ".join(b))
    assert n_near > 60
    low = line_dedup.SIZE_RATIO
    for n in range(12, 500):
        assert n >= low * (n + line_dedup.word_edits(n))
    for n in range(20, 500):
        assert n >= low * (n + line_dedup.letter_edits(n))


def test_line_dedup_of_changed_words(spark):
    replaced = LONG.replace("word7 ", "something ")
    docs = frame(spark, [LONG, "own\n" + replaced, LONG.replace("word2", "else")])
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert out[1]["text"] == "own" and out[0]["n_dropped"] == 0
    # twelve of its words differ
    assert out[2]["n_dropped"] == 0


def test_jaccard_join(spark):
    close = LONG.replace("word39", "end")
    docs = frame(spark, [None, close + " x", LONG, "", LONG, "Two words", "two  WORDS", close])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(docs).collect()}
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").lower())
        width = min(3, len(words)) or 1
        sets[r["doc_id"]] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    root = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == {d: (len(sets[d]), root[d]) for d in sets}
    assert jaccard_join.jaccard_classes(docs.limit(0)).count() == 0


def test_pii(spark):
    texts = [f"ssn: {m}-000{m}" for m in range(100, 104)]
    seeds = [f"call: +1 (555) 010-{m}" for m in range(1000, 1004)]
    texts += seeds + ["call: 0555-123456 now", "price: 1234567", None, "", "1 " * 9000, "a" * 50000]
    texts += ["x@y.co.uk, 1.2.3.400 10.0.0.1, 4111-1111 1111 1111 "]
    out = {r["doc_id"]: r for r in pii.personal_data(frame(spark, texts)).collect()}
    assert out[8]["spans"] == "context:6:17"
    assert out[0]["spans"] == out[9]["spans"] == out[10]["spans"] == out[12]["spans"] == ""
    last = out[len(texts) - 1]
    assert (last["n_email"], last["n_ip"], last["n_card"]) == (1, 1, 1)
    assert last["spans"] == "email:0:9,ip:21:29,card:31:50"
    assert pii.personal_data(frame(spark, texts).limit(0)).count() == 0


def test_secrets(spark):
    keys = ["AKIA" + "".join(chr(65 + (k * 7 + j * 5) % 26) for j in range(16)) for k in range(30)]
    texts = [f"password: {k}" for k in keys] + [None, "", "Token='abc123' " + "a1" * 14, "plain words only here"]
    docs = frame(spark, texts)
    out = {r["doc_id"]: r for r in secrets.secret_spans(docs, secrets.infer(docs)).collect()}
    assert out[0]["spans"] == "assign:0:30,access:10:30"
    assert out[30]["spans"] == out[31]["spans"] == out[33]["spans"] == ""
    assert (out[32]["n_assign"], out[32]["n_hex"]) == (1, 1)
    empty = docs.limit(0)
    assert secrets.secret_spans(empty, secrets.infer(empty)).count() == 0


def test_automaton_merges_states():
    strings = ["k" + "1" * n for n in range(1, 30)]
    grammar = secrets.Automaton(strings)
    assert len(grammar.states) < 10
    assert grammar.bits("k1111") > grammar.bits("1111k")


def test_quality(spark):
    good = [f"Some quiet text number {k} that goes on. It has sentences." for k in range(40)]
    bad = [f"BUY!! NOW!! CHEAP!! {k}!! DEAL!!" for k in range(40)]
    docs = frame(spark, good + bad + [None, ""])
    labels = spark.createDataFrame([(k, int(k < 40)) for k in range(80)], "doc_id long, quality int")
    ranking = quality.learn(docs, labels.filter("doc_id % 4 <> 0"))
    out = {r["doc_id"]: r["predicted"] for r in quality.quality_scores(docs, ranking).collect()}
    assert sum(out[k] == int(k < 40) for k in range(0, 80, 4)) >= 19
    assert len(out) == 82
    assert quality.good_documents(docs.limit(0), ranking).count() == 0
    unlabelled = quality.learn(docs, labels.limit(0))
    assert {r["predicted"] for r in quality.quality_scores(docs, unlabelled).collect()} == {1}


@pytest.mark.parametrize("size", [17, 60])
def test_decontaminate(spark, size):
    item = " ".join(f"item{k}" for k in range(size))
    other = " ".join(f"plain{k % 90}" for k in range(400))
    changed = item.replace("item5 ", "thing ")
    docs = frame(spark, [other, f"{other} {item} {other}", changed, None, "", other + " item1 item2"])
    items = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    out = decontaminate.contaminated(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in out) == [(1, 7), (2, 7)]
    kept = decontaminate.decontaminated(docs, items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 5]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_decontaminate_finds_what_the_cosine_misses(spark):
    item = " ".join(f"item{k}" for k in range(60))
    long = " ".join(f"long{k}" for k in range(150))
    plain = " ".join(f"plain{k}" for k in range(200))
    half, across = " ".join(item.split()[20:50]), " ".join(long.split()[44:58])
    texts = [f"{plain} {item} {plain}", f"{plain} {half} {plain}", f"{plain} {across}", f"{plain} {' '.join(half.split()[:12])}"]
    items = spark.createDataFrame([(7, item), (9, long)], "item_id long, text string")
    blind = decontaminate.Rules(cosine=2.0)
    out = decontaminate.contaminated(frame(spark, texts), items, rules=blind).collect()
    got = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in out}
    assert set(got) == {(0, 7), (1, 7), (2, 9)}
    assert got[0, 7] == 1.0 and got[1, 7] == 0.5


def test_common_subsequence():
    import numpy as np

    a, b = np.array([1, 2, 3, 4, 2]), np.array([2, 9, 3, 2, 1])
    assert decontaminate.common_subsequence(a, b) == 3


def test_token_counts_are_the_library_s(spark):
    import random

    import public_tokenizers

    random.seed(7)
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["hello ", "hello", "hello  ", " ", "  ", "   ", "", " a", "  a b", "a  b ", "\u2581", "a\u2581", "a \u2581b", "\n ", " \n"]
    texts += ["".join(random.choices(["a", "the", " ", "\u2581", "\n", "\xe9", "!"], k=random.randint(1, 12))) for _ in range(400)]
    sp = token_counts.model(path)
    rows = token_counts.token_counts(frame(spark, [*texts, None]), path).collect()
    got = {r["doc_id"]: r["n_tokens"] for r in rows}
    assert got == {k: len(sp.encode(t)) for k, t in enumerate([*texts, ""])}
    edge = token_counts.token_counts(frame(spark, ["hello "]), path, limit=2).first()
    assert edge["over_limit"]


def test_pipeline_leaves_one_of_each_exact_copy(spark):
    groups = [f"{LONG} {k * k}\nTitle {k}\n\n" + "\n".join(f"Own {k} {j}." for j in range(k + 1)) for k in range(4)]
    texts = [*groups, "Quite alone.", *groups, groups[0].replace("\n", " \n"), *groups[2:]]
    docs = frame(spark, texts)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, None)
    assert sorted(r["doc_id"] for r in docs.collect()) == [0, 1, 2, 3, 4]
