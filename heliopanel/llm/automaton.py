"""Deterministic automata for many rules at once.

A rule's pattern is parsed, turned into an epsilon-free position automaton, and all rules
together are determinised by subset construction and minimised by partition refinement.
The result is one array ``next[state, byte]`` plus, per state, the set of rules whose match
ends there; a text is scanned for all rules in a single pass over its bytes.

Match semantics, per rule: leftmost, longest, non-overlapping.  A subset is an ordered list
of position sets, oldest start first; a position held by an older start is dropped from
younger ones, and a match in progress drops every younger start.  Compilation checks the
two facts the scan relies on: when a rule matches no older start is alive, and a match that
goes on matches at every byte (so it ends exactly where the automaton leaves it).

Pattern syntax: literals, ``\\xHH`` and escaped characters, ``[...]`` classes with ranges,
groups, ``|``, ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class Rule:
    """``head`` + ``body``; a match counts if it has ``min_length`` bytes and its body ``min_body``."""

    kind: str
    body: str
    head: str = ""
    min_length: int = 1
    min_body: int = 1
    ignore_case: bool = False


class _Parser:
    def __init__(self, pattern: str, ignore_case: bool):
        self.text, self.at, self.fold = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        c = self.peek()
        self.at += 1
        return c

    def parse(self):
        node = self.alternation()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.peek()!r} in {self.text!r}")
        return node

    def alternation(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeat())
        return ("seq", parts)

    def repeat(self):
        node = self.atom()
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                stop = self.text.index("}", self.at)
                low, comma, high = self.text[self.at:stop].partition(",")
                self.at = stop + 1
                lo, hi = int(low), (int(high) if high else None) if comma else int(low)
            else:
                lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, lo, hi)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alternation()
            if self.take() != ")":
                raise ValueError(f"unbalanced group in {self.text!r}")
            return node
        if c == "[":
            return ("set", self.members())
        return ("set", self.folded({self.escape() if c == "\\" else ord(c)}))

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def members(self) -> frozenset:
        out: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escape() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else ord(c)
            out.update(range(low, high + 1))
        self.take()
        return self.folded(out)

    def folded(self, chars: set[int]) -> frozenset:
        if self.fold:
            for c in list(chars):
                if chr(c).isascii() and chr(c).isalpha():
                    chars |= {ord(chr(c).lower()), ord(chr(c).upper())}
        return frozenset(chars)


@dataclass
class Positions:
    """Position automaton: ``chars[p]`` is read on entering p, ``follow[p]`` what may come next."""

    chars: list[frozenset] = field(default_factory=list)
    follow: list[set[int]] = field(default_factory=list)
    first: frozenset = frozenset()
    last: frozenset = frozenset()
    empty: bool = False

    @classmethod
    def of(cls, node) -> Positions:
        out = cls()
        out.empty, first, last = out._build(node)
        out.first, out.last = frozenset(first), frozenset(last)
        return out

    def _build(self, node) -> tuple[bool, set, set]:
        kind = node[0]
        if kind == "set":
            self.chars.append(node[1])
            self.follow.append(set())
            return False, {len(self.chars) - 1}, {len(self.chars) - 1}
        if kind == "alt":
            parts = [self._build(x) for x in node[1]]
            return any(p[0] for p in parts), set().union(*(p[1] for p in parts)), set().union(*(p[2] for p in parts))
        if kind == "rep":
            _, sub, lo, hi = node
            copies = [sub] * (lo if hi is None else hi)
            if hi is None and lo == 0:
                copies = [sub]
            empty, first, last = True, set(), set()
            for i, x in enumerate(copies):
                e, f, t = self._build(x)
                e = e or i >= lo
                if hi is None and i == len(copies) - 1:
                    for p in t:
                        self.follow[p] |= f
                empty, first, last = self._chain((empty, first, last), (e, f, t))
            return empty, first, last
        out = (True, set(), set())
        for x in node[1]:
            out = self._chain(out, self._build(x))
        return out

    def _chain(self, a, b):
        for p in a[2]:
            self.follow[p] |= b[1]
        return a[0] and b[0], a[1] | b[1] if a[0] else a[1], b[2] | a[2] if b[0] else b[2]


def parse(rule: Rule):
    return ("seq", [_Parser(p, rule.ignore_case).parse() for p in (rule.head, rule.body) if p])


def reverse(node):
    if node[0] == "set":
        return node
    if node[0] == "rep":
        return ("rep", reverse(node[1]), node[2], node[3])
    children = [reverse(x) for x in node[1]]
    return (node[0], children[::-1] if node[0] == "seq" else children)


def byte_classes(automata: list[Positions]) -> tuple[np.ndarray, list[int]]:
    """Bytes that no rule tells apart share a class; one representative byte per class."""
    signature: dict[tuple, int] = {}
    of, first = np.zeros(256, np.int64), []
    for b in range(256):
        key = tuple(b in c for a in automata for c in a.chars)
        if key not in signature:
            signature[key] = len(first)
            first.append(b)
        of[b] = signature[key]
    return of, first


def minimise(step: np.ndarray, output: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states of equal behaviour (partition refinement); state 0 stays the start."""
    _, part = np.unique(output, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)
        if finer.max() == part.max():
            break
        part = finer
    order = {}
    for p in part:
        order.setdefault(int(p), len(order))
    label = np.array([order[int(p)] for p in part])
    pick = np.array([int(np.flatnonzero(label == i)[0]) for i in range(len(order))])
    return label[step[pick]], output[pick]


class Anchored:
    """One pattern from a fixed place: ``longest(bytes)`` gives the longest matching prefix."""

    def __init__(self, node):
        a = Positions.of(node)
        of, reps = byte_classes([a])
        states, work = {frozenset({-1}): 0}, [frozenset({-1})]
        rows, accept = [], []
        for s in work:
            accept.append(int(bool(s & a.last) or (-1 in s and a.empty)))
            row = []
            for b in reps:
                reach = set().union(*(a.first if p < 0 else a.follow[p] for p in s)) if s else set()
                t = frozenset(p for p in reach if b in a.chars[p])
                if t not in states:
                    states[t] = len(work)
                    work.append(t)
                row.append(states[t])
            rows.append(row)
        step, out = minimise(np.array(rows), np.array(accept))
        self.step, self.accept = step[:, of], out
        dead = [i for i in range(len(out)) if not out[i] and (self.step[i] == i).all()]
        self.dead = dead[0] if dead else -1
        self.rows = [list(map(int, r)) for r in self.step]

    def longest(self, data) -> int:
        """Length of the longest prefix of the byte sequence that matches, or -1."""
        s, best, n = 0, 0 if self.accept[0] else -1, 0
        for b in data:
            s = self.rows[s][b]
            n += 1
            if s == self.dead:
                break
            if self.accept[s]:
                best = n
        return best


class Combined:
    """All rules in one automaton: transition array ``step`` and per-state rule bits ``output``."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        parsed = [parse(r) for r in rules]
        autos = [Positions.of(p) for p in parsed]
        if any(a.empty or a.first & a.last for a in autos):
            raise ValueError("a rule must match at least two bytes")
        self.back = [Anchored(reverse(p)) for p in parsed]
        self.heads = [Anchored(_Parser(r.head, r.ignore_case).parse()) if r.head else None for r in rules]
        of, reps = byte_classes(autos)
        alone = [self._subsets(a, reps) for a in autos]
        start = (0,) * len(rules)
        states, work = {start: 0}, [start]
        rows, output = [], []
        for state in work:
            output.append(sum(1 << i for i, q in enumerate(state) if alone[i][1][q]))
            row = []
            for t in zip(*(alone[i][0][q] for i, q in enumerate(state))):
                if t not in states:
                    states[t] = len(work)
                    work.append(t)
                row.append(states[t])
            rows.append(row)
        self.states_before = len(work)
        step, self.output = minimise(np.array(rows), np.array(output))
        self.step = step[:, of].astype(np.int32)
        # the same array with references for state numbers: one index per byte when scanning
        self._rows = [[None] * 256 + [int(o)] for o in self.output]
        for row, targets in zip(self._rows, self.step.tolist()):
            for b, t in enumerate(targets):
                row[b] = self._rows[t]

    def _subsets(self, a: Positions, reps: list[int]) -> tuple[list[list[int]], list[bool]]:
        """Subset construction of one rule: next state by byte class, and where a match is in progress."""
        states, work, rows = {((), False): 0}, [((), False)], []
        for state in work:
            row = []
            for b in reps:
                t = self._next(a, state, b)
                if t not in states:
                    states[t] = len(work)
                    work.append(t)
                row.append(states[t])
            rows.append(row)
        return rows, [going for _, going in work]

    @staticmethod
    def _next(a: Positions, state, b: int):
        groups, going = state
        seen: set[int] = set()
        out = []
        for g in groups:
            t = frozenset(p for p in set().union(*(a.follow[q] for q in g)) if b in a.chars[p]) - seen
            if t:
                out.append(t)
                seen |= t
        if going and out:
            if not out[0] & a.last:
                raise ValueError("a match may not go on through bytes at which it does not match")
            return (out[0],), True
        fresh = frozenset(p for p in a.first if b in a.chars[p]) - seen
        if fresh:
            out.append(fresh)
        for i, g in enumerate(out):
            if g & a.last:
                if i:
                    raise ValueError("a match may not end while an older start is alive")
                return (g,), True
        return tuple(out), False

    def ends(self, data: bytes) -> list[list[int]]:
        """For each rule the end offsets of its matches: one pass over the bytes."""
        found: list[list[int]] = [[] for _ in self.rules]
        row, n = self._rows[0], len(data)
        bytes_left = iter(data)
        for b in bytes_left:
            row = row[b]
            if row[256]:
                at = n - bytes_left.__length_hint__()
                bits, i = row[256], 0
                while bits:
                    if bits & 1:
                        own = found[i]
                        if own and own[-1] == at - 1:
                            own[-1] = at
                        else:
                            own.append(at)
                    bits >>= 1
                    i += 1
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule index, end) in bytes of every match that meets its rule's lengths."""
        out = []
        for i, ends in enumerate(self.ends(data)):
            rule, floor = self.rules[i], 0
            for end in ends:
                start = end - self.back[i].longest(reversed(data[floor:end]))
                floor = end
                body = end - start
                if self.heads[i] is not None:
                    body -= self.heads[i].longest(data[start:end])
                if end - start >= rule.min_length and body >= rule.min_body:
                    out.append((start, i, end))
        out.sort()
        return out
