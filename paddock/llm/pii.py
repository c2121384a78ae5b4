"""Personal data by bootstrapped contextual extraction.

Four base expressions find the seeds. Every place that looks like an identifier
(a run of digits or a part of a long one, a spelled-out IP address, or a token
with a sign of a mail address) is an instance with lexical patterns, each for a
kind of identifier: the words before it and the word behind it, a label right
before it, and its own shape between the characters around it. Patterns and
instances form a graph. Spark scores it in rounds until no new pattern is
accepted: a pattern by the share of its instances that are believed and by how
much evidence there is for that share; an instance of an accepted pattern is
believed. So a shape that nearly always stands behind accepted labels is found
elsewhere in the next round. Patterns that end with high confidence mark the instances the base
expressions missed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import arrow_map, join_spans, pick, sha256

KINDS = ("email", "ip", "card", "phone")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

Span = tuple[str, int, int]

# The base expressions, in the forms that take linear time.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_LOCALS = frozenset(_LOCAL)
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

#: What a pattern needs: the share of believed ones among its distinct instances, and the lower bound of that share
#: (Wilson's, at two standard errors): 0.7 asks for 10 instances that are all believed, or 22 of which two are not.
CONFIDENCE = 0.9
EVIDENCE = 0.7


def emails(text: str) -> Iterator[Span]:
    """Matches of ``[local]+@[label]+(\\.[label]+)+``: a sign, the domain behind it, all local characters before it."""
    done = 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > done and text[start - 1] in _LOCALS:
            start -= 1
        if start < match.start():
            yield "email", start, match.end()
            done = match.end()


def ips(text: str) -> Iterator[Span]:
    """Numbers joined by dots, four at a time, none above 255."""
    for match in _DOTTED.finditer(text):
        parts, at = match[0].split("."), match.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield "ip", at, at + size
            at += size + 1


def cards(text: str) -> Iterator[Span]:
    for match in _CARD.finditer(text):
        if match.end() - match.start() < 14:
            continue
        digits = _NOT_DIGIT.sub("", match[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", *match.span()


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def phones(text: str) -> Iterator[Span]:
    for match in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
            yield "phone", *match.span()


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if "@" in text:
        found += emails(text)
    found += ips(text)
    found += cards(text)
    if "+" in text:
        found += phones(text)
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


# Candidate instances by shape; what the base expressions found is a seed.
_RUN = re.compile(r"\+?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+")
_GROUP = re.compile(r"[0-9]++")
_DATE = re.compile(
    r"(?<![^\x20])(?:(?:19|20)[0-9]{2}([-./])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|"
    r"(?:0?[1-9]|[12][0-9]|3[01])([-./])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})(?![^\x20])"
)
_SIGNS = re.compile(r"@|\(at\)|\[at\]|\x20at\x20")
_AFTER = re.compile(
    r"\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}+)+"
)
_LOOSE_IP = re.compile(
    r"(?<![0-9])[0-9]{1,3}+(?:\x20?(?:\.|\[\.\]|\(\.\)|\(dot\)|\[dot\])\x20?[0-9]{1,3}+|\x20dot\x20[0-9]{1,3}+){3}(?![0-9])"
)
_IPV6 = re.compile(r"(?<![\w:])[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){2,7}+(?![\w:])")
_WORDS = re.compile(r"[^\W\d_]+")
_NEAR = 48  # characters on either side in which the words of a pattern stand


def instances(text: str, seeds: list[Span]) -> Iterator[tuple[str, int, int, str, str, bool]]:
    """kind, start, end, pattern, instance and whether it is a seed, of every identifier-like place."""
    for kind, start, end in seeds:
        for pattern in _patterns_at(kind, text, start, end):
            yield kind, start, end, pattern, _plain(text[start:end]), True
    reach, taken = 0, []  # starts of the seeds and the furthest end up to each
    for _, start, end in seeds:
        reach = max(reach, end)
        taken.append((start, reach))
    for start, end, kinds in _candidates(text):
        at = bisect_left(taken, (end, 0))
        if at and taken[at - 1][1] > start:
            continue
        for kind in kinds:
            for pattern in _patterns_at(kind, text, start, end):
                yield kind, start, end, pattern, _plain(text[start:end]), False


def _candidates(text: str) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    for match in _RUN.finditer(text):
        yield from _numbers(match[0], match.start())
    for match in _LOOSE_IP.finditer(text):
        if all(int(p) <= 255 for p in _GROUP.findall(match[0])):
            yield *match.span(), ("ip",)
    if ":" in text:
        for match in _IPV6.finditer(text):
            groups = match[0].count(":")
            if len(match[0]) > groups and (groups == 7 or "::" in match[0]):
                yield *match.span(), ("ip",)
    done = floor = 0  # end of the last address; no local part reaches over the sign before it
    for sign in _SIGNS.finditer(text):
        if sign.start() < done:
            continue
        end = sign.start() - (sign[0] != " at " and text[sign.start() - 1 : sign.start()] == " ")
        before = text[max(done, floor) : max(done, floor, end)]
        floor = sign.end()
        local = len(before) - len(before.rstrip(_LOCAL))
        # the space behind " at " is part of it
        match = _AFTER.match(text, sign.end()) if local else None
        if match and not (sign[0] == " at " and match[0][0] == " "):
            yield end - local, match.end(), ("email",)
            done = match.end()


def _kinds(digits: int) -> tuple[str, ...]:
    return ("phone",) * (7 <= digits <= 15) + ("card",) * (13 <= digits <= 19)


def _numbers(run: str, at: int) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """A run of digits as one number; of long runs, and runs with dates, the numbers they can be cut into too."""
    digits = len(_NOT_DIGIT.sub("", run))
    dates = list(_DATE.finditer(run)) if digits > 8 else []
    if digits <= 19 and not dates or digits < 15:
        yield at, at + len(run), _kinds(digits)
    elif digits <= 19:
        yield at, at + len(run), ("card",)
    if digits <= 15 and not dates:
        return
    start = 0
    for stop, behind in [*(d.span() for d in dates), (len(run), len(run))]:
        for a, b, size in _cut(run[start:stop]):
            plus = start + a - (start + a == 1 and run[0] == "+")
            if (plus, start + b) != (0, len(run)):
                yield at + plus, at + start + b, _kinds(size)
        start = behind


def _cut(run: str) -> list[tuple[int, int, int]]:
    """Start, end and digits of the numbers in a run.

    Equal parts where its groups repeat, else the cut of least cost: digits left
    over, and sizes that phones and cards rarely have. Numbers never overlap, so
    other cuts of the same run are not offered.
    """
    spans = [m.span() for m in _GROUP.finditer(run)]
    sizes = [b - a for a, b in spans]
    n = len(sizes)
    equal = []
    if sum(sizes) > 15:
        for k in range(1, min(19, n) + 1):
            size = sum(sizes[:k])
            if n % k == 0 and 7 <= size <= 19 and sizes[k:] == sizes[:-k] and (k < n or _odd(size, k) == 0):
                equal.append((_odd(size, k), k))
    if equal:
        k = min(equal)[1]
        return [(spans[i][0], spans[i + k - 1][1], sum(sizes[i : i + k])) for i in range(0, n, k)]
    # least cost from each group to the end, and the group behind its number
    best: list[tuple[int, int]] = [(0, 0)] * (n + 1)
    for i in range(n - 1, -1, -1):
        best[i] = (best[i + 1][0] + 4 * sizes[i], 0)
        inside = i and " " not in run[spans[i - 1][1] : spans[i][0]]
        size = 0
        for j in range(i, min(n, i + 19)):
            size += sizes[j]
            if size > 19:
                break
            if size >= 7:
                whole = 5 * (" " not in run[spans[i][0] : spans[j][1]])
                cost = best[j + 1][0] + _odd(size, j - i + 1) + 3 * bool(inside) - whole
                if cost < best[i][0]:
                    best[i] = (cost, j + 1)
    found, i = [], 0
    while i < n:
        j = best[i][1]
        if j:
            found.append((spans[i][0], spans[j - 1][1], sum(sizes[i:j])))
        i = j or i + 1
    return found


def _odd(size: int, groups: int) -> int:
    """How far a number of digits is from the usual ones of phones and cards."""
    if size > 13:
        return abs(size - 16) + 8 * (groups not in (1, 4))
    return abs(size - 10)


def _plain(text: str) -> str:
    return re.sub(r"[^0-9a-z@]", "", text.lower())


_LABEL = re.compile(r"([^\W\d_]+)[.]?\x20?[:=#]\x20?[\"'(]?\Z")


def _shape(kind: str, text: str) -> str:
    """Digits as 9; in addresses, whose parts have any length, runs of letters and digits as one."""
    if kind == "email":
        return re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", text))
    return re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", text))


def _beside(character: str) -> str:
    """A character next to a place: its kind, or itself."""
    return " " if not character or character.isspace() else "a" if character.isalnum() else character


def _patterns_at(kind: str, text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place, each with the kind.

    Words before (at most two) and behind (at most one), in lower case; the word
    of a label such as ``tel:``; the shape of the place and the characters beside
    it, but for cards, whose check digit says more than any shape.
    """
    found = _words_at(kind, text, start, end)
    label = _LABEL.search(text[max(0, start - _NEAR) : start])
    if label:
        found.append(f"{kind} {label[1].lower()}: _")
    if kind != "card" and end - start <= _NEAR:
        beside = _beside(text[start - 1 : start]), _beside(text[end : end + 1])
        found.append(f"{kind} {beside[0]}{_shape(kind, text[start:end])}{beside[1]}")
    return found


def _words_at(kind: str, text: str, start: int, end: int) -> list[str]:
    before = [w.lower() for w in _WORDS.findall(text[max(0, start - _NEAR) : start])[-2:]]
    after = [w.lower() for w in _WORDS.findall(text[end : end + _NEAR])[:1]]
    both = [(before, after), (before, [])] + [(before[-1:], after)] * (len(before) > 1)
    return list(dict.fromkeys(" ".join([kind, *b, "_", *a]) for b, a in both if b or a))


_BASE = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "more array<struct<kind:string,start:int,end:int,pattern:string,instance:string,seed:boolean>>"
)


def find(docs: DataFrame, evidence: float = EVIDENCE, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id, base counts, digest of the base spans, all spans, and n_more: how many the patterns added.

    One row per input row. Null and empty texts have no spans; repeated rows
    stay, and count once in the graph, as an edge is a distinct pattern and
    instance; an empty table gives an empty one; other columns are not read.
    Added spans never overlap base ones. Texts are read once; what is shuffled
    is the identifier-like places alone.
    """

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for row, doc_id, text in tuples:
            text = text or ""
            found = base_spans(text)
            counts = [sum(s[0] == kind for s in found) for kind in KINDS]
            joined = join_spans(found, _ORDER)
            more = list(instances(text, found))
            yield row, doc_id, *counts, sha256(joined), joined, more

    texts = pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    # written once to the shared folder: the graph and the result read it
    scanned = arrow_map(texts.select("row", "doc_id", "text"), _BASE, rows).checkpoint()
    places = scanned.select("row", F.inline("more"))
    believed = _patterns(places, evidence, confidence)
    added = (
        places.where("NOT seed")
        .join(believed, "pattern")
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "end", "kind")).alias("added"))
    )
    spans = F.when(F.col("spans") == "", F.array().cast("array<string>")).otherwise(F.split("spans", ","))
    as_struct = F.transform(
        spans,
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"),
            F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("end"),
            F.split_part(s, F.lit(":"), F.lit(1)).alias("kind"),
        ),
    )
    rank = F.create_map(*[F.lit(x) for kind in KINDS for x in (kind, _ORDER[kind])])
    every = F.array_sort(
        F.transform(
            F.concat(as_struct, "added"),
            lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    text = F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return (
        scanned.drop("more")
        .join(added, "row", "left")
        .withColumn("spans", F.when(F.col("added").isNull(), F.col("spans")).otherwise(text))
        .withColumn("n_more", F.coalesce(F.size("added"), F.lit(0)).cast("long"))
        .select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_more")
    )


def _lower_bound(believed: str, n: str) -> Column:
    """Lower end of Wilson's interval for a share, at two standard errors."""
    share, count = F.col(believed) / F.col(n), F.col(n)
    spread = 2 * F.sqrt(share * (1 - share) / count + 1 / (count * count))
    return (share + 2 / count - spread) / (1 + 4 / count)


def _patterns(places: DataFrame, evidence: float, confidence: float) -> DataFrame:
    """Patterns of high confidence: a column ``pattern``.

    Edges are distinct, so copies of a document weigh as one. Each round sums
    the belief of a pattern's instances (both sides pre-aggregated) and passes
    acceptance of patterns back to their instances, which are then believed like
    seeds. Belief only grows, so patterns are only added, and the rounds end when
    one adds none.
    """
    edges = (
        places.withColumn("kind_instance", F.concat_ws(":", "kind", "instance"))
        .groupBy("pattern", "kind_instance")
        .agg(F.max(F.col("seed").cast("double")).alias("belief"))
        .checkpoint()
    )
    seeds = edges.groupBy("kind_instance").agg(F.max("belief").alias("belief"))
    belief = seeds
    accepted = 0
    while True:
        scores = (
            edges.select("pattern", "kind_instance")
            .join(belief, "kind_instance")
            .groupBy("pattern")
            .agg(F.sum("belief").alias("believed"), F.count("*").alias("n"))
            .where((_lower_bound("believed", "n") >= evidence) & (F.col("believed") >= confidence * F.col("n")))
            .select("pattern", F.lit(1.0).alias("passed"))
            .checkpoint()
        )
        before, accepted = accepted, scores.count()
        if accepted == before:
            return scores.select("pattern")
        passed = (
            edges.select("pattern", "kind_instance").join(scores, "pattern")
            .groupBy("kind_instance").agg(F.max("passed").alias("passed"))
        )
        belief = seeds.join(passed, "kind_instance", "left").select(
            "kind_instance", F.greatest("belief", F.coalesce("passed", F.lit(0.0))).alias("belief")
        )
