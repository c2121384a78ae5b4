"""One deterministic automaton for many regular expressions, run over bytes.

The expressions are compiled together: parse tree, nondeterministic automaton,
subset construction, minimisation. Byte values that no expression tells apart
share a class, so the result is one array of next states per state and class and
one bit mask of matching expressions per state.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

import numpy as np

#: Byte that occurs in no UTF-8 text; it parts texts that are scanned together.
SEPARATOR = 0xFF
_NO_STATES = 60_000


class _Nfa:
    """Epsilon and byte-set moves, made from a parsed expression."""

    def __init__(self) -> None:
        self.empty: dict[int, list[int]] = defaultdict(list)
        self.moves: dict[int, list[tuple[int, int]]] = defaultdict(list)  # state -> (byte set as bits, next)
        self.n = 0

    def state(self) -> int:
        self.n += 1
        return self.n - 1

    def build(self, tree: Iterable, start: int, backward: bool, fold: bool) -> int:
        """Add a sequence of parsed items after a state; the state behind it."""
        items = list(tree)
        for kind, value in reversed(items) if backward else items:
            start = self._item(str(kind), value, start, backward, fold)
        return start

    def _item(self, kind: str, value, start: int, backward: bool, fold: bool) -> int:
        if kind in ("LITERAL", "IN", "NOT_LITERAL", "ANY"):
            end = self.state()
            self.moves[start].append((_bytes(kind, value, fold), end))
            return end
        if kind == "SUBPATTERN":
            _, on, off, tree = value
            return self.build(tree, start, backward, bool((fold or on & re.I) and not off & re.I))
        if kind == "BRANCH":
            end = self.state()
            for tree in value[1]:
                self.empty[self.build(tree, start, backward, fold)].append(end)
            return end
        if kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, tree = value
            for _ in range(low):
                start = self.build(tree, start, backward, fold)
            if str(high) == "MAXREPEAT":
                loop = self.state()
                self.empty[start].append(loop)
                self.empty[self.build(tree, loop, backward, fold)].append(loop)
                return loop
            ends = [start]
            for _ in range(high - low):
                start = self.build(tree, start, backward, fold)
                ends.append(start)
            end = self.state()
            for s in ends:
                self.empty[s].append(end)
            return end
        raise ValueError(f"{kind} cannot be compiled into the automaton")

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _bytes(kind: str, value, fold: bool) -> int:
    """A set of bytes as bits; only ASCII characters can be named."""
    if kind == "ANY":
        return ((1 << 256) - 1) & ~(1 << 10)
    if kind in ("LITERAL", "NOT_LITERAL"):
        bits, negated = 1 << _ascii(value), kind == "NOT_LITERAL"
    else:
        bits, negated = 0, False
        for part, what in value:
            if str(part) == "NEGATE":
                negated = True
            elif str(part) == "LITERAL":
                bits |= 1 << _ascii(what)
            elif str(part) == "RANGE":
                for c in range(_ascii(what[0]), _ascii(what[1]) + 1):
                    bits |= 1 << c
            else:
                raise ValueError(f"{part} cannot be compiled into the automaton")
    if fold:
        lower, upper = bits >> 97 & (1 << 26) - 1, bits >> 65 & (1 << 26) - 1
        bits |= (lower | upper) << 65 | (lower | upper) << 97
    return ((1 << 255) - 1) & ~bits if negated else bits


def _ascii(code: int) -> int:
    if code > 127:
        raise ValueError("rules are written in ASCII")
    return code


class Automaton:
    """Transition arrays of all rules together.

    ``search`` automata look for the rules anywhere (the start state is always
    entered again); others read from their first byte on. ``backward`` automata
    read the rules from their last byte to the first.
    """

    def __init__(self, rules: list[str], search: bool, backward: bool = False):
        if len(rules) > 32:
            raise ValueError("a mask holds 32 rules")
        nfa = _Nfa()
        starts, ends = [], {}
        for i, rule in enumerate(rules):
            start = nfa.state()
            starts.append(start)
            parsed = re._parser.parse(rule, re.ASCII)
            ends[nfa.build(parsed, start, backward, bool(parsed.state.flags & re.I))] = 1 << i
        self._classes(nfa)
        first = nfa.closure(starts)
        names = {first: 0}
        rows: list[list[int]] = []
        order = [first]
        for subset in order:
            row = []
            for bit in self._representatives:
                goal = {to for s in subset for bits, to in nfa.moves.get(s, ()) if bits & bit}
                after = nfa.closure(goal) | (first if search else frozenset())
                if after not in names:
                    if len(names) >= _NO_STATES:
                        raise ValueError("the rules together need too many states")
                    names[after] = len(names)
                    order.append(after)
                row.append(names[after])
            rows.append(row)
        masks = [0] * len(order)
        for i, subset in enumerate(order):
            for s in subset:
                masks[i] |= ends.get(s, 0)
        self._minimise(np.array(rows), np.array(masks, np.uint32))

    def _classes(self, nfa: _Nfa) -> None:
        sets = sorted({bits for moves in nfa.moves.values() for bits, _ in moves})
        kinds: dict[tuple[bool, ...], int] = {}
        self.classes = np.zeros(256, np.uint8)
        self._representatives: list[int] = []
        for byte in range(256):
            kind = tuple(bool(bits >> byte & 1) for bits in sets)
            if kind not in kinds:
                kinds[kind] = len(kinds)
                self._representatives.append(1 << byte)
            self.classes[byte] = kinds[kind]

    def _minimise(self, rows: np.ndarray, masks: np.ndarray) -> None:
        """Split states by mask, then by the groups of their next states until nothing splits."""
        group = np.unique(masks, return_inverse=True)[1]
        while True:
            seen, new = np.unique(np.column_stack([group, group[rows]]), axis=0, return_inverse=True)
            if len(seen) == group.max() + 1:
                break
            group = new
        group = np.asarray(group).ravel()
        # the start state is number 0
        order = np.full(group.max() + 1, -1)
        order[group[0]] = 0
        others = [g for g in range(group.max() + 1) if g != group[0]]
        order[others] = np.arange(1, len(others) + 1)
        one = np.empty(len(order), np.int64)
        one[order[group]] = np.arange(len(group))
        self.next = order[group[rows[one]]].astype(np.uint16)
        self.masks = masks[one]
        self.n_classes = self.next.shape[1]
        self.flat = self.next.astype(np.uint32).ravel()
        stuck = np.nonzero((self.next == np.arange(len(one))[:, None]).all(axis=1) & (self.masks == 0))[0]
        dead = int(stuck[0]) if len(stuck) else -1
        #: the arrays as lists, for steps of one byte: next states, classes, class of each byte, masks, dead state
        self.lists = (self.flat.tolist(), self.n_classes, self.classes.tolist(), self.masks.tolist(), dead)

    def states(self, data: np.ndarray, lanes: int = 4096) -> np.ndarray:
        """State after each byte, in one pass.

        The bytes are cut into equal lanes that advance side by side from the
        start state. A lane whose predecessor ended elsewhere is run again from
        there until it meets the states it had.
        """
        n = len(data)
        lanes = max(1, min(lanes, n // 256))
        width = -(-n // lanes) if n else 0
        codes = np.zeros(lanes * width, np.uint8)
        codes[:n] = self.classes[data]
        codes = np.ascontiguousarray(codes.reshape(lanes, width).T)
        out = np.empty((width, lanes), np.uint16)
        state = np.zeros(lanes, np.uint32)
        k = np.uint32(self.n_classes)
        for t in range(width):
            np.multiply(state, k, out=state)
            state += codes[t]
            state = self.flat[state]
            out[t] = state
        flat, next_ = self.flat, self.n_classes
        for lane in range(1, lanes):
            s = int(out[-1, lane - 1])
            if not s:
                continue
            own, had = codes[:, lane], out[:, lane]
            for t in range(width):
                s = int(flat[s * next_ + int(own[t])])
                if s == had[t]:
                    break
                had[t] = s
        return out.T.reshape(-1)[:n]
