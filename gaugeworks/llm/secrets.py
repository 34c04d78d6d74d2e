"""Secret scan by grammar inference.

Fixed patterns find labelled credentials. From a bounded sample of them, prefix trees over
letter classes are built per kind, and states whose futures agree statistically (Hoeffding
bounds) are merged into probabilistic automata. Every other candidate of the corpus is then
scored by how much likelier an automaton makes it than one learnt from ordinary words.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import documents_of, rows_like
from gaugeworks.session import written

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_WORD = re.compile(r"[A-Za-z]{6,}")
KINDS = ("assign", "access", "hex", "grammar")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the fixed patterns, in code points, the end exclusive."""
    found = [
        (m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6
    ]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def symbol(letter: str) -> str:
    """Letter classes: digits, small letters of hexadecimal digits, other small and capital
    letters; signs stand for themselves."""
    if "0" <= letter <= "9":
        return "0"
    if "a" <= letter <= "f":
        return "a"
    if "g" <= letter <= "z":
        return "z"
    return "A" if "A" <= letter <= "Z" else letter


@dataclass
class State:
    seen: int = 0
    ends: int = 0
    steps: dict[str, list] = field(default_factory=dict)


class Automaton:
    """A probabilistic automaton, merged from the prefix tree of a sample of strings."""

    def __init__(self, strings: Iterable[str], alpha: float = 0.05):
        self.states = [State()]
        for s in strings:
            at = self.states[0]
            at.seen += 1
            for letter in s:
                step = at.steps.setdefault(symbol(letter), [len(self.states), 0])
                if step[1] == 0:
                    self.states.append(State())
                step[1] += 1
                at = self.states[step[0]]
                at.seen += 1
            at.ends += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()

    def _differ(self, part1: int, all1: int, part2: int, all2: int) -> bool:
        if not all1 or not all2:
            return False
        gap = abs(part1 / all1 - part2 / all2)
        return gap > self._bound * (1 / math.sqrt(all1) + 1 / math.sqrt(all2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = (self.states[k] for k in todo.pop())
            if self._differ(x.ends, x.seen, y.ends, y.seen):
                return False
            for s in x.steps.keys() | y.steps.keys():
                p, q = x.steps.get(s), y.steps.get(s)
                if self._differ(p[1] if p else 0, x.seen, q[1] if q else 0, y.seen):
                    return False
                if p and q and p[0] != q[0]:
                    todo.append((p[0], q[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            x, y = self.states[a], self.states[b]
            x.seen += y.seen
            x.ends += y.ends
            for s, (to, n) in y.steps.items():
                if s in x.steps:
                    x.steps[s][1] += n
                    todo.append((x.steps[s][0], to))
                else:
                    x.steps[s] = [to, n]

    def _merge_all(self) -> None:
        red = [0]
        while True:
            blue = [
                (r, s, to)
                for r in red
                for s, (to, _) in sorted(self.states[r].steps.items())
                if to not in red
            ]
            if not blue:
                break
            parent, s, to = max(blue, key=lambda e: self.states[e[2]].seen)
            for r in red:
                if self._compatible(r, to):
                    self.states[parent].steps[s][0] = r
                    self._fold(r, to)
                    break
            else:
                red.append(to)
        self.states = self._kept(red)

    def _kept(self, red: list[int]) -> list[State]:
        names = {r: k for k, r in enumerate(red)}
        for r in red:
            for step in self.states[r].steps.values():
                step[0] = names[step[0]]
        return [self.states[r] for r in red]

    def bits(self, text: str, unseen: float = 1e-3) -> float:
        """log2 of the likelihood of a string. A letter that the state has never seen
        costs ``unseen`` and leaves the state as it is."""
        at, total = self.states[0], 0.0
        for letter in text:
            step = at.steps.get(symbol(letter))
            if step is None:
                total += math.log2(unseen)
                continue
            total += math.log2(step[1] / at.seen)
            at = self.states[step[0]]
        return total + math.log2(max(at.ends / at.seen, unseen) if at.seen else unseen)


@dataclass
class Grammar:
    kinds: dict[str, Automaton]
    ordinary: Automaton
    bits_needed: float

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates apart from base spans that some kind makes likelier by the bits."""
        found, k = [], 0
        taken = sorted((s, e) for s, e, _ in base)
        for m in _CANDIDATE.finditer(text):
            start, end = m.span()
            value = m[0].rstrip(".=-")
            while k < len(taken) and taken[k][1] <= start:
                k += 1
            if any(s < end and e > start for s, e in taken[k : k + 4]) or len(value) < 12:
                continue
            # credentials mix letters and digits; addresses, dates and plain words do not
            if not any(map(str.isdigit, value)) or not any(map(str.isalpha, value)):
                continue
            if self.margin(value) >= self.bits_needed:
                found.append((start, start + len(value), "grammar"))
        return found

    def margin(self, value: str) -> float:
        plain = self.ordinary.bits(value)
        return max((a.bits(value) - plain for a in self.kinds.values()), default=-math.inf)


class Smallest:
    """The ``most`` distinct values of smallest hash among all that are offered."""

    def __init__(self, most: int):
        self.most, self.heap, self.held = most, [], set()
        self.least = 1 << 63

    def offer(self, value: str) -> None:
        h = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42)
        h -= (h >> 63) << 64
        if h >= self.least or value in self.held:
            return
        self.held.add(value)
        heapq.heappush(self.heap, (-h, value))
        if len(self.heap) > self.most:
            self.held.remove(heapq.heappop(self.heap)[1])
            self.least = -self.heap[0][0]


def _labelled_rows(most: int, longest: int):
    """Of each kind, the values of smallest hash of a whole task, at its end."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        kept = {kind: Smallest(most) for kind in (*KINDS[:3], "ordinary")}
        for p in pieces:
            for text in p["text"]:
                for m in _ASSIGN.finditer(text):
                    if 6 <= len(m[2]) <= longest:
                        kept["assign"].offer(m[2])
                for start, end, kind in base_spans(text):
                    if kind != "assign" and end - start <= longest:
                        kept[kind].offer(text[start:end])
                for word in set(_WORD.findall(text)):
                    if len(word) <= longest:
                        kept["ordinary"].offer(word)
        found = [(kind, -h, v) for kind, s in kept.items() for h, v in s.heap]
        yield tuple(zip(*found, strict=True)) if found else ([], [], [])

    return rows


def infer(
    docs: DataFrame, id_col="doc_id", text_col="text", most: int = 1500, longest: int = 128,
    bits_needed: float = 24.0,
) -> Grammar:
    """Automata of each kind, learnt from the distinct credentials of up to ``longest``
    letters, of each kind the ``most`` of smallest hash. All rows are searched for them."""
    fields = "kind string,h long,value string"
    found = documents_of(docs, id_col, text_col).select("text").mapInArrow(
        rows_like(fields, _labelled_rows(most, longest), 64), fields
    )
    # one scan: a bounded part by hash of each kind is all that leaves a task
    found = written(found, "labelled")
    names, parts = [*KINDS[:3], "ordinary"], None
    smallest = found.groupBy("kind", "h").agg(F.min("value").alias("value"))
    for kind in names:
        part = smallest.filter(F.col("kind") == kind).orderBy("h").limit(most)
        parts = part if parts is None else parts.unionByName(part)
    by_kind: dict[str, list[str]] = {}
    for kind, value in sorted((r["kind"], r["value"]) for r in parts.select("kind", "value").collect()):
        by_kind.setdefault(kind, []).append(value)
    ordinary = Automaton(by_kind.pop("ordinary", []) or ["ordinary"])
    return Grammar({k: Automaton(v) for k, v in by_kind.items()}, ordinary, bits_needed)


def _joined(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for start, end, kind in spans])


def secret_spans(
    docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256, spans per row.

    Null counts as empty; a text without secrets has zeros, the digest of nothing and empty
    spans. Repeated rows are answered each; an empty table gives no rows; other columns are
    ignored. Base spans never depend on the grammar."""

    def rows(pieces: Iterator[dict]) -> Iterator[tuple]:
        for p in pieces:
            base = [base_spans(t) for t in p["text"]]
            more = [grammar.spans(t, b) for t, b in zip(p["text"], base, strict=True)]
            count = [[sum(s[2] == k for s in b) for b in base] for k in KINDS[:3]]
            every = [
                sorted(b + m, key=lambda s: (s[0], KINDS.index(s[2])))
                for b, m in zip(base, more, strict=True)
            ]
            digests = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield p["doc_id"], *count, [len(m) for m in more], digests, [_joined(e) for e in every]

    fields = (
        "doc_id long,n_assign long,n_access long,n_hex long,n_grammar long,"
        "base_sha256 string,spans string"
    )
    return documents_of(docs, id_col, text_col).mapInArrow(rows_like(fields, rows, 64), fields)
