"""Secret scans: all rules as one minimised automaton, one pass over the bytes.

The automaton marks, for every byte, the rules of which a match ends there. The
last byte of a run of such marks is the end of a match; an automaton of the
reversed rule, run back from there to the end of the rule's match before it,
gives the leftmost start. That is the leftmost non-overlapping greedy match of
rules whose last part is a repeated set of characters that no match can leave
and enter again, which all rules here are. The body of a private key, of which the
automaton finds the first line, is read on from there.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paddock.llm.automaton import SEPARATOR, Automaton
from paddock.llm.common import arrow_extend, arrow_map, join_spans, numbered, pick, sha256


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression and what a match must be to count.

    A match that does not count is dropped; what it covered is not read again.
    """

    kind: str
    pattern: str
    least: int = 0  # characters of the match
    least_tail: int = 0  # characters of the value behind the sign of assignment
    behind: str = ""  # what belongs to a match if it follows it

    def counts(self, match: str) -> bool:
        if len(match) < self.least:
            return False
        return not self.least_tail or self._value(match) >= self.least_tail

    def _value(self, match: str) -> int:
        """Length of the value behind the first sign of assignment."""
        at = min(i for i in (match.find(":"), match.find("=")) if i >= 0) + 1
        rest = match[at:].lstrip(" ")
        return len(rest) - (rest[:1] in "\"'")


# The rules of the contract, in the order of their kinds.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least_tail=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
# What follows the first line of a private key: headers, base64 lines up to a short last one, and the end line. Lines
# may be indented, or parted by the escapes of a quoted string.
_GAP = r"(?:[\x20\t\r\n]|\\[nrt])*+"
KEY_BODY = (
    rf"(?:{_GAP}(?:Proc-Type|DEK-Info|Comment):\x20[^\r\n\\]*+)*+"
    rf"(?:{_GAP}(?:[A-Za-z0-9+/]{{16,}}+={{0,2}}|[A-Za-z0-9+/]++={{1,2}}|[A-Za-z0-9+/]++(?={_GAP}-----END)))*+"
    rf"(?:{_GAP}-----END [A-Z\x20]{{0,60}}PRIVATE KEY-----)?"
)
# Published token formats of common services.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]+", least=24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]+", least=26),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", behind=KEY_BODY),
)
RULES = BASE + MORE
#: Bytes of text that are scanned in one go; a longer text is scanned alone.
TOGETHER = 4 << 20

Span = tuple[str, int, int]


class Scanner:
    """The automata of a list of rules."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.forward = Automaton([r.pattern for r in rules], search=True)
        self.behind = [re.compile(r.behind.encode()) if r.behind else None for r in rules]
        self.backward = [Automaton([r.pattern], search=False, backward=True) for r in rules]

    def scan(self, texts: list[bytes]) -> list[list[Span]]:
        """Spans in code points of each text, by rule and start."""
        gap = bytes([SEPARATOR])
        data = np.frombuffer(gap.join(texts) + gap, np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        states = self.forward.states(data)
        marks = self.forward.masks[states]
        at = np.nonzero(marks)[0]
        marks = marks[at]
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for r in range(len(self.rules)):
            places = at[(marks >> np.uint32(r) & 1).astype(bool)]
            if not len(places):
                continue
            ends = places[np.append(np.diff(places) > 1, True)] + 1
            owners = np.searchsorted(starts, ends, "left") - 1
            done, owner_before = 0, -1
            for end, owner in zip(ends.tolist(), owners.tolist()):
                if owner != owner_before:
                    done, owner_before = int(starts[owner]), owner
                start = self._start(r, data, done, end)
                if start is None:
                    continue
                done = end
                out[owner].append((r, start - int(starts[owner]), end - int(starts[owner])))
        return [self._counting(text, found) for text, found in zip(texts, out)]

    def _start(self, r: int, data: np.ndarray, low: int, end: int) -> int | None:
        """Leftmost start of a match of a rule that ends here and starts at low or later."""
        own = self.backward[r]
        flat, k, classes, masks, dead = own.lists
        state, found = 0, None
        for step in range(low, end, 4096):  # pieces, so that a short match copies little
            stop = end - (step - low)
            for i, byte in enumerate(reversed(data[max(low, stop - 4096) : stop].tobytes())):
                state = flat[state * k + classes[byte]]
                if state == dead:
                    return found
                if masks[state]:
                    found = stop - 1 - i
        return found

    def _counting(self, text: bytes, found: list[tuple[int, int, int]]) -> list[Span]:
        """Matches that count, in code points."""
        if not found:
            return []
        spans = []
        plain = text.isascii()
        before = None if plain else np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        for r, start, end in found:
            rule = self.rules[r]
            if rule.counts(text[start:end].decode()):
                if self.behind[r] is not None:
                    end = self.behind[r].match(text, end).end()
                if not plain:  # matches are ASCII
                    start, end = int(before[start]) - 1, int(before[end - 1])
                spans.append((rule.kind, start, end))
        return spans


@functools.lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """One scanner for each worker process and list of rules."""
    return Scanner(rules)


def _scanned(tuples: Iterable[tuple], rules: tuple[Rule, ...]) -> Iterator[tuple[tuple, list[Span]]]:
    """Each tuple, which ends with a text, and the spans in it."""
    kept: list[tuple] = []
    texts: list[bytes] = []
    weight = 0
    for row in tuples:
        kept.append(row)
        texts.append((row[-1] or "").encode())
        weight += len(texts[-1])
        if weight >= TOGETHER:
            yield from zip(kept, scanner(rules).scan(texts))
            kept, texts, weight = [], [], 0
    if kept:
        yield from zip(kept, scanner(rules).scan(texts))


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, base counts, digest of the base spans and all spans of each row.

    Null and empty texts have no spans; repeated rows stay; an empty table gives
    an empty one; other columns are not read. Texts are scanned whole, several
    short ones together, without a shuffle.
    """
    order = {r.kind: i for i, r in enumerate(rules)}
    base = [r.kind for r in BASE]

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for (doc_id, _), spans in _scanned(tuples, rules):
            own = [s for s in spans if s[0] in base]
            counts = [sum(s[0] == kind for s in own) for kind in base]
            yield doc_id, *counts, sha256(join_spans(own, order)), join_spans(spans, order)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return arrow_map(pick(docs, "doc_id", "text"), schema, rows)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The table with every span of its texts replaced by a mark and n_chars counted anew where a text changed.

    Overlapping spans are replaced as one. Texts without a span, nulls included,
    and all other columns stay as they are.
    """
    names = docs.columns
    text = f"_{names.index('text')}"

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for (whole,), spans in _scanned(tuples, rules):
            new = _replaced(whole, spans, mark) if spans else None
            yield new, None if new is None else len(new)

    plain = arrow_extend(numbered(docs), [text], "new string, size long", rows)
    changed = {text: F.coalesce("new", text)}
    if "n_chars" in names:
        own = f"_{names.index('n_chars')}"
        changed[own] = F.coalesce(F.col("size").cast(plain.schema[own].dataType), own)
    return plain.withColumns(changed).drop("new", "size").toDF(*names)


def _replaced(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
