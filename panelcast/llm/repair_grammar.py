"""Cheapest repairs of role/fault sequences by dynamic programming over a Re-Pair grammar.

A row of a conversation is one symbol: its role's initial (s, u, a or another) and its first fault (none,
blank, duplicate, truncated).  Its effect on a repair is a min-plus matrix over the states of the wanted
form ``(s?(ua)+)?``: entry (p, q) holds the least cost of going from state p to q over that row, inserted
turns before it included, and the audit of edit initials that costs it.  Equal costs keep the audit that
is ASCII-least; audits of one entry never begin one another (all name the same rows, and a longer one
pays for its extra insertions), so matrices can be multiplied in any bracketing.

The grammar names frequent pairs of symbols.  Every rule has one matrix, the product of its two sides,
made once, bottom-up; a sequence is the product of the matrices of its few remaining symbols.  Audits
are ropes: a node points at two shorter ropes, so rules share theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
ACCEPTED = (START, AFTER_A)
#: state -> initial -> next state of the wanted form
STEP = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
ROLE = {"u": "user", "a": "assistant"}

INITIALS = "suao"
FAULTS = ("", "blank", "duplicate", "truncated")
#: the symbols: "A" + 4 * initial + fault
FIRST = ord("A")
#: rules are named by the private characters from here on
RULE = 0xE000
RULES_MAX = 0xF8FF - RULE + 1

DELETE, INSERT, REROLE, UNFINISHED = 3, 2, 2, 1

Entry = tuple[int, object]
Matrix = tuple[tuple[Entry | None, ...], ...]


def symbol(initial: str, fault: str) -> str:
    return chr(FIRST + 4 * INITIALS.index(initial) + FAULTS.index(fault))


def meaning(sym: str) -> tuple[str, str]:
    k = ord(sym) - FIRST
    return INITIALS[k // 4], FAULTS[k % 4]


# --- ropes ---------------------------------------------------------------------
def chain(left, right):
    """The rope of ``left`` and then ``right``; a rope is a string or a pair of ropes."""
    return right if left == "" else left if right == "" else (left, right)


def letters(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack += (top[1], top[0])
        else:
            yield from top


def flat(rope) -> str:
    return rope if isinstance(rope, str) else "".join(letters(rope))


def before(x, y) -> bool:
    """x is ASCII-less than y.  Shared parts are stepped over without being read."""
    left, right = [x], [y]
    while left and right:
        if left[-1] is right[-1]:
            left.pop(), right.pop()
            continue
        a, b = left.pop(), right.pop()
        if isinstance(a, tuple):
            left += (a[1], a[0])
            right.append(b)
        elif isinstance(b, tuple):
            right += (b[1], b[0])
            left.append(a)
        else:
            n = min(len(a), len(b))
            if a[:n] != b[:n]:
                return a[:n] < b[:n]
            if a[n:]:
                left.append(a[n:])
            if b[n:]:
                right.append(b[n:])
    return bool(right) and not left


def better(x: Entry | None, y: Entry | None) -> Entry | None:
    if x is None or y is None:
        return y if x is None else x
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return y if before(y[1], x[1]) else x


# --- matrices ------------------------------------------------------------------
def product(m: Matrix, n: Matrix) -> Matrix:
    rows = []
    for p in range(STATES):
        row: list[Entry | None] = [None] * STATES
        for mid, a in enumerate(m[p]):
            if a is not None:
                for q, b in enumerate(n[mid]):
                    if b is not None:
                        cost, old = a[0] + b[0], row[q]
                        if old is None or cost <= old[0]:
                            row[q] = better(old, (cost, chain(a[1], b[1])))
        rows.append(tuple(row))
    return tuple(rows)


def _table(edges: list[tuple[int, int, int, str]]) -> Matrix:
    cells: list[list[Entry | None]] = [[None] * STATES for _ in range(STATES)]
    for p, q, cost, audit in edges:
        cells[p][q] = better(cells[p][q], (cost, audit))
    return tuple(map(tuple, cells))


@lru_cache(maxsize=None)
def insertions() -> Matrix:
    """Any number of inserted turns; none is ever worth more than two in a row."""
    none = _table([(p, p, 0, "") for p in range(STATES)])
    one = _table([(p, STEP[p][i], INSERT, "I") for p in range(STATES) for i in "ua" if i in STEP[p]])
    upto = tuple(tuple(better(a, b) for a, b in zip(x, y)) for x, y in zip(none, one))
    return product(upto, upto)


@lru_cache(maxsize=None)
def terminal(sym: str) -> Matrix:
    """Insertions and then one edit of the row."""
    initial, fault = meaning(sym)
    edges = [(p, p, DELETE, "D") for p in range(STATES)]
    if fault not in ("blank", "duplicate"):
        extra = UNFINISHED if fault == "truncated" else 0
        for p in range(STATES):
            if initial in STEP[p]:
                edges.append((p, STEP[p][initial], extra, "K"))
            edges += [(p, STEP[p][i], REROLE + extra, "R") for i in "ua" if i in STEP[p]]
    return product(insertions(), _table(edges))


class Grammar:
    """Rules (pairs of symbols, in the order they were made) with one matrix each."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.rank = {pair: i for i, pair in enumerate(rules)}
        self.made: dict[str, Matrix] = {}
        for i, pair in enumerate(rules):                              # bottom-up: sides come before their rule
            self.made[chr(RULE + i)] = product(self.matrix(pair[0]), self.matrix(pair[1]))

    def matrix(self, sym: str) -> Matrix:
        return self.made[sym] if sym in self.made else terminal(sym)

    def packed(self, text: str) -> str:
        """``text`` with every rule applied, first rules first."""
        while len(text) > 1:
            ranks = [r for r in (self.rank.get(text[i:i + 2]) for i in range(len(text) - 1)) if r is not None]
            if not ranks:
                return text
            r = min(ranks)
            text = text.replace(self.rules[r], chr(RULE + r))
        return text

    def repair(self, pieces: list[str]) -> tuple[int, str]:
        """Cost and audit of the cheapest repair of a sequence, given in pieces."""
        todo = [self.matrix(s) for piece in pieces for s in self.packed(piece)]
        while len(todo) > 1:                                          # balanced, so ropes stay shallow
            todo = [product(todo[i], todo[i + 1]) if i + 1 < len(todo) else todo[i] for i in range(0, len(todo), 2)]
        whole = product(todo[0], insertions()) if todo else insertions()
        end: Entry | None = None
        for q in ACCEPTED:
            end = better(end, whole[START][q])
        return end[0], flat(end[1])


def pair_counts(text: str, weight: int, into: dict[str, int]) -> None:
    """Adds the pairs of neighbours of ``text``; of overlapping equal pairs every second one counts."""
    last, at = "", -2
    for i in range(len(text) - 1):
        pair = text[i:i + 2]
        if pair == last and at == i - 1 and pair[0] == pair[1]:
            last = ""
            continue
        into[pair] = into.get(pair, 0) + weight
        last, at = pair, i


def batch_of(counted: list[tuple[str, int]]) -> list[str]:
    """The frequent pairs that can become rules at once: taken in order of count, as long as no symbol is
    the left side of one and the right side of another."""
    chosen, left, right = [], set(), set()
    for pair, _ in sorted(counted, key=lambda c: (-c[1], c[0])):
        a, b = pair
        if a in right or b in left or (a == b and (a in left or b in right)):
            continue
        chosen.append(pair)
        left.add(a)
        right.add(b)
    return chosen


def walk(audit: str) -> Iterator[tuple[str, str]]:
    """(edit, initial that a changed or inserted turn gets) for every letter; a kept row's initial is not known
    here, so ``send`` it: ``u``, ``a`` or ``s``."""
    state = START
    for edit in audit:
        wanted = "a" if state == AFTER_U else "u"
        initial = yield edit, wanted
        if edit != "D":
            state = STEP[state][initial if edit == "K" else wanted]
