"""Long lines meet by runs of words alone, and cheap bounds change no answer."""

from __future__ import annotations

import random

from gaugeworks.llm import line_dedup

LETTERS = "abcdefgh  漢字かな"


def _changed(pick, line, edits):
    for _ in range(edits):
        at = pick.randrange(1, len(line) - 1)
        line = line[:at] + pick.choice(["", " ", "x", "漢", "yz"[:1]]) + line[at + pick.randint(0, 1) :]
    return " ".join(line.split())


def test_long_lines_in_reach_share_a_run_of_words():
    pick, n_long = random.Random(3), 0
    for k in range(1500):
        n = pick.choice([12, 20, 23, 24, 30, 45, 48, 50, 51, 54, 55, 70, 100])
        words = ["".join(pick.choices(LETTERS if k % 2 else "abcdefgh", k=pick.randint(1, 6))) for _ in range(n)]
        a = " ".join(" ".join(words).split())
        b = _changed(pick, a, pick.randint(0, 2))
        if pick.random() < 0.5:
            cut = b.split()
            cut[pick.randrange(len(cut))] = "other"
            b = " ".join(cut)
        if not line_dedup.near(a, b):
            continue
        x, y = line_dedup._WORDS.findall(a), line_dedup._WORDS.findall(b)
        if max(len(x), len(y)) >= line_dedup.LONG:
            n_long += 1
            found, owners = (v.tolist() for v in line_dedup.word_regions([x, y]))
            sets = [{r for r, o in zip(found, owners) if o == k} for k in (0, 1)]
            assert sets[0] & sets[1]
            assert min(len(x), len(y)) >= line_dedup.SIZE_RATIO * max(len(x), len(y))
    assert n_long > 200


def test_a_word_or_letter_bound_changes_no_answer():
    pick = random.Random(4)
    for _ in range(400):
        a = " ".join("".join(pick.choices("ab漢", k=pick.randint(1, 4))) for _ in range(pick.randint(5, 30)))
        b = _changed(pick, a, pick.randint(0, 4))
        x, y = line_dedup._WORDS.findall(a), line_dedup._WORDS.findall(b)
        edits = line_dedup.word_edits(min(len(x), len(y)))
        plain = line_dedup.within_edits(a, b, line_dedup.letter_edits(min(len(a), len(b))))
        assert line_dedup.near(a, b) == (plain or edits > 0 and line_dedup.within_edits(x, y, edits))


def test_long_lines_have_no_letter_regions():
    words = [f"word{k}" for k in range(60)]
    regions, ids, _ = next(line_dedup._region_rows(iter([{"id": [1], "line": [" ".join(words)]}])))
    assert set(ids) == {1} and not set(regions) & set(line_dedup.scaled_keys(" ".join(words)))


def test_unlike_lines_cost_no_edit_distance(monkeypatch):
    calls = []
    real = line_dedup.within_edits
    monkeypatch.setattr(line_dedup, "within_edits", lambda *a: calls.append(a) or real(*a))
    common = " ".join(f"common{k}" for k in range(20))
    assert not line_dedup.near(f"{common} one two three four five six seven", f"{common} 1 2 3 4 5 6 7")
    assert not calls
    assert line_dedup.near(f"{common} one", f"{common} two") and calls
