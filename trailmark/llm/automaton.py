"""Rule expressions to one minimal deterministic automaton over bytes.

``compile_rules`` turns a list of byte expressions into one automaton that, fed any text byte by byte, tells after every
byte which rules have a match ending there.  The expressions know classes, literals, groups, alternation
and the repeats ``? * + {n} {n,}``; that is all the rules need.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ANY = frozenset(range(256))


@dataclass(frozen=True)
class Automaton:
    """``step[state, class_of[byte]]``; ``accepts[state]`` has bit r set where rule r ends; ``start`` is the state outside any match."""

    step: np.ndarray
    class_of: np.ndarray
    accepts: np.ndarray
    start: int


class _Nfa:
    """Thompson construction: edges by byte set and by nothing."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def build(self, node: tuple, begin: int) -> int:
        """Add ``node`` from ``begin``; returns the state after it."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[begin].append((node[1], end))
            return end
        if kind == "seq":
            for part in node[1]:
                begin = self.build(part, begin)
            return begin
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                first = self.state()
                self.free[begin].append(first)
                self.free[self.build(part, first)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            begin = self.build(part, begin)
        if most is None:
            loop = self.state()
            self.free[begin].append(loop)
            self.free[self.build(part, loop)].append(loop)
            return loop
        end = self.state()
        self.free[begin].append(end)
        for _ in range(most - least):
            begin = self.build(part, begin)
            self.free[begin].append(end)
        return end


def _parse(rule: str, fold: bool) -> tuple:
    """Recursive descent over one expression."""
    at = 0

    def both(b: int) -> set[int]:
        c = chr(b)
        return {b, ord(c.lower()), ord(c.upper())} if fold and b < 128 and c.isalpha() else {b}

    def escaped() -> int:
        nonlocal at
        c = rule[at]
        at += 1
        if c == "x":
            at += 2
            return int(rule[at - 2:at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def one() -> int:
        nonlocal at
        c = rule[at]
        at += 1
        return escaped() if c == "\\" else ord(c)

    def bracket() -> tuple:
        nonlocal at
        negated = rule[at] == "^"
        at += negated
        found: set[int] = set()
        while rule[at] != "]":
            low = one()
            if rule[at] == "-" and rule[at + 1] != "]":
                at += 1
                for b in range(low, one() + 1):
                    found |= both(b)
            else:
                found |= both(low)
        at += 1
        return "set", ANY - found if negated else frozenset(found)

    def alternatives() -> tuple:
        nonlocal at
        options = [sequence()]
        while at < len(rule) and rule[at] == "|":
            at += 1
            options.append(sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence() -> tuple:
        nonlocal at
        parts = []
        while at < len(rule) and rule[at] not in "|)":
            if rule[at] == "(":
                at += 1
                part = alternatives()
                at += 1
            elif rule[at] == "[":
                at += 1
                part = bracket()
            else:
                part = ("set", frozenset(both(one())))
            if at < len(rule) and rule[at] in "?*+":
                part = ("rep", part, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[rule[at]])
                at += 1
            elif at < len(rule) and rule[at] == "{":
                close = rule.index("}", at)
                low, _, high = rule[at + 1:close].partition(",")
                most = int(high) if high else (None if "," in rule[at:close] else int(low))
                part = ("rep", part, int(low), most)
                at = close + 1
            parts.append(part)
        return "seq", parts

    return alternatives()


def compile_rules(rules: list[tuple[str, bool]]) -> Automaton:
    """``rules``: (expression, whether ASCII letters match in either case)."""
    nfa = _Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for r, (rule, fold) in enumerate(rules):
        first = nfa.state()
        nfa.free[root].append(first)
        ends[nfa.build(_parse(rule, fold), first)] = 1 << r
    # Bytes that no rule tells apart share a class.
    sets = list({s for moves in nfa.moves for s, _ in moves})
    signature = [tuple(b in s for s in sets) for b in range(256)]
    classes = {sig: c for c, sig in enumerate(dict.fromkeys(signature))}
    class_of = np.array([classes[sig] for sig in signature])
    byte_of = [signature.index(sig) for sig in classes]

    closures: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closures:
            seen, todo = {state}, [state]
            while todo:
                for nxt in nfa.free[todo.pop()]:
                    if nxt not in seen:
                        seen.add(nxt)
                        todo.append(nxt)
            closures[state] = frozenset(seen)
        return closures[state]

    # Subset construction; the root stays in every subset, so a match may begin at any byte.
    begin = closure(root)
    number, queue, table = {begin: 0}, [begin], []
    moves = [[(frozenset(int(class_of[b]) for b in s), t) for s, t in m] for m in nfa.moves]
    for subset in queue:
        reach: list[set[int]] = [set() for _ in byte_of]
        for state in subset:
            for by, target in moves[state]:
                for c in by:
                    reach[c] |= closure(target)
        row = []
        for found in reach:
            nxt = begin | found
            if nxt not in number:
                number[nxt] = len(queue)
                queue.append(nxt)
            row.append(number[nxt])
        table.append(row)
    step = np.array(table)
    accepts = np.array([sum({ends[s] for s in subset if s in ends}) for subset in queue])

    # Minimisation by refinement: split groups until members agree on the groups of all successors.
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        rows = np.column_stack([group, group[step]])
        finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    keep = np.unique(group, return_index=True)[1]
    small = group[step[keep]]
    kind = np.uint16 if len(keep) < 1 << 16 else np.uint32
    return Automaton(np.ascontiguousarray(small.astype(kind)), class_of.astype(np.uint8), accepts[keep].astype(np.uint32), int(group[0]))


def run(machine: Automaton, raw: np.ndarray, lane: int = 1024) -> np.ndarray:
    """The state after every byte of ``raw``.

    The bytes are cut into lanes that advance together.  Each lane first assumes that it begins in the start state; a
    lane whose predecessor ended otherwise is run again from that state, until all lanes fit together.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, machine.step.dtype)
    lanes = -(-n // lane)
    # Column-wise, so that each step reads one contiguous row.
    padded = np.zeros(lanes * lane, np.uint8)
    padded[:n] = machine.class_of[raw]
    columns = np.ascontiguousarray(padded.reshape(lanes, lane).T)
    flat, classes = machine.step.ravel(), machine.step.shape[1]
    states = np.empty((lane, lanes), machine.step.dtype)
    entry = np.full(lanes, machine.start, np.int64)
    todo = np.arange(lanes)
    while len(todo):
        now = entry[todo]
        whole = len(todo) == lanes
        for i in range(lane):
            now = flat[now * classes + (columns[i] if whole else columns[i, todo])].astype(np.int64)
            if whole:
                states[i] = now
            else:
                same = states[i, todo] == now
                states[i, todo] = now
                if same.all():  # from here on nothing changes
                    break
        real = np.concatenate(([machine.start], states[-1, :-1].astype(np.int64)))
        todo = np.flatnonzero(real != entry)
        entry = real
    return np.ascontiguousarray(states.T).ravel()[:n]
