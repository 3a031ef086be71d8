"""Rules as one deterministic automaton over bytes: regular expressions, subset construction, minimisation, transition arrays.

A rule's automaton finds its leftmost, longest, non-overlapping matches in one pass: its states are ordered lists of positions in the
expression (earlier starts first); once a match is accepted, later starts are left out; when the accepted
match can't go on, the search starts anew at the byte at hand. The rules' automata run side by side as one product
automaton, which is minimised. A boundary byte (0xFF, in no UTF-8 text) resets it, so that many texts are scanned as one buffer.

Expressions: literals, escapes \\xHH, \\. and the like, classes [..], groups (..), |, ?, *, +, {m} and {m,n}. They must be closed: from an
accepted match each further step is accepted too, and no earlier start may be waiting meanwhile. Others are refused.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BOUNDARY = 0xFF


class Unsupported(ValueError):
    """The expression is outside what the construction handles."""


# --- expressions ------------------------------------------------------------------------------------------------
# Trees: ("set", frozenset of bytes), ("cat", parts), ("or", parts), ("rep", part, least, most or None)


class Parser:
    def __init__(self, text: str, any_case: bool = False):
        self.text, self.at, self.any_case = text, 0, any_case

    def parse(self):
        tree = self.either()
        if self.at != len(self.text):
            raise Unsupported(f"unbalanced: {self.text}")
        return tree

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def either(self):
        parts = [self.chain()]
        while self.peek() == "|":
            self.take()
            parts.append(self.chain())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def chain(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return parts[0] if len(parts) == 1 else ("cat", parts)

    def repeated(self):
        tree = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                end = self.text.index("}", self.at)
                least, _, most = self.text[self.at : end].partition(",")
                bounds = (int(least), int(most) if most else (None if "," in self.text[self.at : end] else int(least)))
                self.at = end + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            tree = ("rep", tree, *bounds)
        return tree

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        if c.isalnum():
            raise Unsupported(f"\\{c}")
        return ord(c)

    def cased(self, chars: set[int]) -> frozenset[int]:
        if self.any_case:
            chars = chars | {c ^ 32 for c in chars if chr(c).isascii() and chr(c).isalpha()}
        return frozenset(chars)

    def atom(self):
        c = self.take()
        if c == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            tree = self.either()
            if self.take() != ")":
                raise Unsupported("missing )")
            return tree
        if c == "[":
            negated = self.peek() == "^"
            self.at += negated
            chars: set[int] = set()
            while (x := self.take()) != "]":
                low = self.escaped() if x == "\\" else ord(x)
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    y = self.take()
                    chars |= set(range(low, (self.escaped() if y == "\\" else ord(y)) + 1))
                else:
                    chars.add(low)
            return ("set", frozenset(range(255)) - self.cased(chars) if negated else self.cased(chars))
        if c == "\\":
            return ("set", self.cased({self.escaped()}))
        return ("set", self.cased({ord(c)}))


def reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [reverse(x) for x in reversed(tree[1])])
    if kind == "or":
        return ("or", [reverse(x) for x in tree[1]])
    if kind == "rep":
        return ("rep", reverse(tree[1]), *tree[2:])
    return tree


# --- positions with ordered choices -----------------------------------------------------------------------------


@dataclass
class Program:
    """Nodes: ("set", bytes, next), ("split", [next..]) by preference, ("end",)."""

    nodes: list = field(default_factory=list)

    def add(self, node) -> int:
        self.nodes.append(node)
        return len(self.nodes) - 1

    def build(self, tree, after: int) -> int:
        kind = tree[0]
        if kind == "set":
            return self.add(("set", tree[1], after))
        if kind == "cat":
            for part in reversed(tree[1]):
                after = self.build(part, after)
            return after
        if kind == "or":
            return self.add(("split", [self.build(x, after) for x in tree[1]]))
        _, part, least, most = tree
        if most is None:
            loop = self.add(None)
            self.nodes[loop] = ("split", [self.build(part, loop), after])
            after = loop
        else:
            for _ in range(most - least):
                after = self.add(("split", [self.build(part, after), after]))
        for _ in range(least):
            after = self.build(part, after)
        return after

    def closure(self, starts: list[int]) -> tuple[int, ...]:
        """Positions that read a byte, and the end, in order of preference."""
        out, seen, stack = [], set(), list(reversed(starts))
        while stack:
            n = stack.pop()
            if n in seen:
                continue
            seen.add(n)
            node = self.nodes[n]
            if node[0] == "split":
                stack.extend(reversed(node[1]))
            else:
                out.append(n)
        return tuple(out)


@dataclass
class Machine:
    """next[state, byte class]; accepting[state]; fresh[state]: the byte that led here began a new search after a match."""

    classes: np.ndarray  # 256 -> class
    next: np.ndarray
    accepting: np.ndarray
    fresh: np.ndarray


def byte_classes(sets: list[frozenset[int]]) -> tuple[np.ndarray, list[int]]:
    kinds: dict[tuple, int] = {}
    out, example = np.zeros(256, np.uint8), []
    for b in range(256):
        key = (b == BOUNDARY, *[b in s for s in sets])
        if key not in kinds:
            kinds[key] = len(kinds)
            example.append(b)
        out[b] = kinds[key]
    return out, example


def searching(tree) -> Machine:
    """The automaton of one rule that finds its matches anywhere."""
    program = Program()
    end = program.add(("end",))
    start = program.build(tree, end)
    first = program.closure([start])
    if end in first:
        raise Unsupported("the rule matches the empty text")
    classes, example = byte_classes([n[1] for n in program.nodes if n[0] == "set"])

    def step(state: tuple[int, ...], b: int) -> tuple[int, ...]:
        return program.closure([program.nodes[n][2] for n in state if program.nodes[n][0] == "set" and b in program.nodes[n][1]])

    def settle(threads: tuple[int, ...]) -> tuple[tuple[int, ...], bool]:
        """Leave out starts later than an accepted match; else the search may also start at the next byte."""
        if end in threads:
            # threads of the accepted start come before the end in the order; earlier starts would come first of all
            return threads[: threads.index(end) + 1], True
        return threads + tuple(n for n in first if n not in threads), False

    # a state: its threads, whether they are an accepted match, whether the last byte began a new search
    begin = (settle(())[0], False, False)
    states, rows, todo = {begin: 0}, [], [begin]
    while todo:
        threads, accepted, _ = todo.pop(0)
        row = []
        for b in example:
            again = False
            if b == BOUNDARY:
                new = (begin[0], False, accepted)
            else:
                moved = step(threads, b)
                if accepted and not moved:
                    moved, again = step(begin[0], b), True
                got, ok = settle(moved)
                if accepted and not again and not ok:
                    raise Unsupported("an accepted match goes on without being accepted")
                new = (got, ok, again)
            if new not in states:
                states[new] = len(states)
                todo.append(new)
            row.append(states[new])
        rows.append(row)
    keys = list(states)
    return Machine(classes, np.array(rows, np.int32), np.array([k[1] for k in keys]), np.array([k[2] for k in keys]))


def anchored(tree) -> Machine:
    """The automaton that tells after each byte whether the text so far is a match; state 0 is dead, state 1 the start."""
    program = Program()
    end = program.add(("end",))
    begin = program.closure([program.build(tree, end)])
    classes, example = byte_classes([n[1] for n in program.nodes if n[0] == "set"])
    states, todo, rows = {(): 0, begin: 1}, [(), begin], []
    while todo:
        now = todo.pop(0)
        row = []
        for b in example:
            new = program.closure([program.nodes[n][2] for n in now if program.nodes[n][0] == "set" and b in program.nodes[n][1] and b != BOUNDARY])
            new = tuple(sorted(new))
            if new not in states:
                states[new] = len(states)
                todo.append(new)
            row.append(states[new])
        rows.append(row)
    accepting = np.array([end in k for k in states])
    return Machine(classes, np.array(rows, np.int32), accepting, np.zeros(len(states), bool))


@dataclass
class Combined:
    """All rules' automata as one, minimised. accepting and fresh: [state, rule]."""

    classes: np.ndarray
    next: np.ndarray  # [state, class]
    accepting: np.ndarray
    fresh: np.ndarray

    @property
    def flat(self) -> np.ndarray:
        return np.ascontiguousarray(self.next.astype(np.int32) * self.next.shape[1]).ravel()


def combine(machines: list[Machine]) -> Combined:
    kinds: dict[tuple, int] = {}
    classes, example = np.zeros(256, np.uint8), []
    for b in range(256):
        key = tuple(int(m.classes[b]) for m in machines)
        if key not in kinds:
            kinds[key] = len(kinds)
            example.append(b)
        classes[b] = kinds[key]
    begin = (0,) * len(machines)
    states, todo, rows = {begin: 0}, [begin], []
    while todo:
        now = todo.pop(0)
        row = []
        for b in example:
            new = tuple(int(m.next[s, m.classes[b]]) for m, s in zip(machines, now, strict=True))
            if new not in states:
                states[new] = len(states)
                todo.append(new)
            row.append(states[new])
        rows.append(row)
    keys = list(states)
    accepting = np.array([[m.accepting[s] for m, s in zip(machines, k, strict=True)] for k in keys])
    fresh = np.array([[m.fresh[s] for m, s in zip(machines, k, strict=True)] for k in keys])
    return minimised(Combined(classes, np.array(rows, np.int32), accepting, fresh))


def minimised(c: Combined) -> Combined:
    """Merge states that no text tells apart: refine the partition by outputs until successors agree."""
    _, block = np.unique(np.hstack([c.accepting, c.fresh]), axis=0, return_inverse=True)
    block = block.ravel()
    while True:
        _, refined = np.unique(np.hstack([block[:, None], block[c.next]]), axis=0, return_inverse=True)
        refined = refined.ravel()
        if refined.max() == block.max():
            break
        block = refined
    # number blocks so that the start keeps 0
    order = {block[0]: 0}
    for b in block:
        order.setdefault(b, len(order))
    number = np.array([order[b] for b in block])
    pick = np.array([int(np.argmax(number == k)) for k in range(len(order))])
    return Combined(c.classes, number[c.next[pick]].astype(np.int16 if len(order) < 1 << 15 else np.int32), c.accepting[pick], c.fresh[pick])


# --- scanning ---------------------------------------------------------------------------------------------------

LANE = 2048  # bytes of a lane; all lanes of a buffer step together
WARM = 48  # bytes before a lane from which its first state is guessed; wrong guesses are found and mended


def states_after(c: Combined, data: bytes) -> np.ndarray:
    """The state after each byte of data."""
    n = len(data)
    width = c.next.shape[1]
    flat = c.flat
    cls = c.classes[np.frombuffer(data, np.uint8)].astype(np.int32)
    lanes = -(-n // LANE)
    padded = np.full(lanes * LANE, c.classes[BOUNDARY], np.int32)
    padded[:n] = cls
    grid = padded.reshape(lanes, LANE)
    state = np.zeros(lanes, np.int32)
    if lanes > 1:
        for k in range(LANE - WARM, LANE):
            state[1:] = flat.take(state[1:] + grid[:-1, k])
    begin, columns = state, np.ascontiguousarray(grid.T)
    out = np.empty((LANE, lanes), np.int32)
    todo = np.arange(lanes)
    while len(todo):
        s, whole = begin[todo], len(todo) == lanes
        for k in range(LANE):
            s = flat.take(s + (columns[k] if whole else columns[k, todo]))
            if whole:
                out[k] = s
            else:
                out[k, todo] = s
        # a lane whose first state isn't its predecessor's last is run again
        right = np.concatenate([[0], out[LANE - 1, :-1]]).astype(np.int32)
        todo = np.flatnonzero(right != begin)
        begin = right
    return (out.T.ravel()[:n] // width).astype(np.int32)


def matches(c: Combined, data: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each rule: (place of the byte that made it a match, place just after it, place just after the match before or 0).

    data must end with a boundary byte."""
    states = states_after(c, data)
    out = []
    for r in range(c.accepting.shape[1]):
        on = c.accepting[:, r][states]
        fresh = c.fresh[:, r][states]
        begins, over = on.copy(), on.copy()
        begins[1:] &= ~on[:-1] | fresh[1:]
        over[:-1] &= ~on[1:] | fresh[1:]
        first, ends = np.flatnonzero(begins), np.flatnonzero(over) + 1
        out.append((first, ends, np.concatenate([[0], ends[:-1]])))
    return out


def match_start(backward: Machine, data: bytes, end: int, least: int) -> int:
    """The leftmost place at or after least from which the rule matches up to end, by the reversed rule's automaton."""
    state, best, nxt, classes, accepting = 1, -1, backward.next, backward.classes, backward.accepting
    for k in range(end - 1, least - 1, -1):
        state = nxt[state, classes[data[k]]]
        if not state:
            break
        if accepting[state]:
            best = k
    return best
