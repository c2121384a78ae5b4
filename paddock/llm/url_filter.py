"""URL filtering with a memory-mapped, sorted array of 64-bit digests.

A list of strings (rule keys ``host/path``, blocked hosts and families of hosts) becomes one file:
xxhash64 digests in ascending order, offsets, and the strings themselves. The
file goes to every executor once and is memory-mapped there, so the pages of it
that are asked for are all that a worker keeps. A batch of probes is hashed and
looked up by one vectorised binary search; every hit is confirmed against the
stored string, and equal digests are all tried, so a collision cannot decide.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterable, Iterator
from hashlib import md5

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from paddock.llm.common import arrow_map, pick
from paddock.session import shared_dir

_HEAD = struct.Struct("<8sQ")
_MAGIC = b"DIGESTS1"

#: Host and path rules with their verdicts.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Hosts that are blocked, with their subdomains, where no rule fits: the four that the oracle names, an example and
#: no cover of any table. Other endings of the same names are not blocked; give ``families`` for that.
BLOCKED_HOSTS = (
    "ads-track.example.org",
    "cheap-pills.example.com",
    "free-bets.example.com",
    "spam-farm.example.org",
)
#: Urls whose probes are looked up together.
_TOGETHER = 2048


def build(strings: Iterable[str]) -> bytes:
    """The file of a list of distinct strings."""
    items = [s.encode() for s in dict.fromkeys(strings)]
    digests = np.fromiter((xxhash.xxh64_intdigest(s) for s in items), np.uint64, len(items))
    order = np.argsort(digests, kind="stable")
    sizes = np.fromiter((len(items[i]) for i in order), np.int64, len(items))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    text = b"".join(items[i] for i in order)
    return _HEAD.pack(_MAGIC, len(items)) + digests[order].tobytes() + offsets.tobytes() + text


class Digests:
    """The memory-mapped file."""

    def __init__(self, path: str):
        self.data = np.memmap(path, np.uint8, "r")
        magic, self.n = _HEAD.unpack(self.data[: _HEAD.size].tobytes())
        if magic != _MAGIC:
            raise ValueError("not a file of sorted digests")
        at = _HEAD.size
        self.keys = self.data[at : at + 8 * self.n].view(np.uint64)
        at += 8 * self.n
        self.offsets = self.data[at : at + 8 * (self.n + 1)].view(np.int64)
        self.text = self.data[at + 8 * (self.n + 1) :]

    def found(self, probes: list[str]) -> list[bool]:
        """Whether each probe is one of the strings."""
        raw = [p.encode() for p in probes]
        wanted = np.fromiter((xxhash.xxh64_intdigest(p) for p in raw), np.uint64, len(raw))
        first = np.searchsorted(self.keys, wanted, "left")
        after = np.searchsorted(self.keys, wanted, "right")
        hit = np.zeros(len(raw), bool)
        for i in np.nonzero(first < after)[0].tolist():
            hit[i] = any(self._string(j) == raw[i] for j in range(first[i], after[i]))
        return hit.tolist()

    def _string(self, j: int) -> bytes:
        return self.text[self.offsets[j] : self.offsets[j + 1]].tobytes()


@functools.lru_cache(maxsize=8)
def _opened(name: str) -> Digests:
    return Digests(SparkFiles.get(name))


def distribute(spark: SparkSession, data: bytes) -> str:
    """Put a file into the shared folder and send it to all executors; its name there.

    The name is a digest of the content, so a list that was sent before is not
    sent again. The file gets its name when it is whole.
    """
    name = f"digests-{md5(data).hexdigest()}"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(path):
        part = context._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        out = store.create(part, True)
        out.write(bytearray(data))
        out.close()
        if not store.rename(part, path) and not store.exists(path):
            raise OSError(f"cannot write {path}")
    context.addFile(path.toString())
    return name


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    stop = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:stop]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


_LOWER = {c: c + 32 for c in range(65, 91)}


def suffixes(host: str) -> list[str]:
    """The host and the domains above it."""
    out = [host] if host else []
    at = host.find(".")
    while at >= 0:
        if at + 1 < len(host):
            out.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return out


def runs(host: str, sizes: list[int]) -> list[str]:
    """Runs of that many neighbouring labels of a host, each with an ending behind it."""
    labels = host.split(".")
    return list(dict.fromkeys(".".join(labels[i : i + n]) for n in sizes for i in range(len(labels) - n)))


def judge(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    blocked_hosts: Iterable[str] = BLOCKED_HOSTS,
    families: Iterable[str] = (),
) -> DataFrame:
    """page_id, host, path, rule and verdict of each url.

    A rule (host, path prefix, verdict) fits its host and all subdomains where
    the path starts with its prefix; the longest ``host + path`` wins, of equal
    ones that with the longer host. Of rules with equal host and path the first
    counts. Without a rule, a host at or below a blocked host is blocked, and
    so is one with the labels of a family (``ads-track`` or ``ads-track.example``)
    before any ending; any other url is allowed. Null urls and urls without ``://`` have empty host and
    path and are allowed. Rows are judged where they are, one by one: repeated
    rows stay, an empty table gives an empty one, other columns are not read.

    Rules, hosts and families are lists in the driver's memory, so their size is bounded
    by what the caller holds; the verdicts of the rules are kept in the key.
    """
    verdicts: dict[str, tuple[int, str]] = {}
    for host, path, verdict in rules:
        verdicts.setdefault(host + path, (len(host), verdict))
    lengths = sorted({len(key) - n for key, (n, _) in verdicts.items()})
    keys = [f"{verdict[0]}{n}:{key}" for key, (n, verdict) in verdicts.items()]
    named = [f.translate(_LOWER) for f in families]
    sizes = sorted({f.count(".") + 1 for f in named})
    hosts = [*(f"h:{h}" for h in blocked_hosts), *(f"f:{f}" for f in named)]
    name = distribute(pages.sparkSession, build([*keys, *hosts]))

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        kept: list[tuple] = []
        for row in tuples:
            kept.append(row)
            if len(kept) >= _TOGETHER:
                yield from _judged(_opened(name), kept, lengths, sizes)
                kept = []
        yield from _judged(_opened(name), kept, lengths, sizes)

    schema = "page_id long, host string, path string, rule string, verdict string"
    return arrow_map(pick(pages, "page_id", "url"), schema, rows)


def _judged(digests: Digests, rows: list[tuple], lengths: list[int], sizes: list[int]) -> Iterator[tuple]:
    split = [parts(url) for _, url in rows]
    asked: dict[str, None] = {}
    wanted = []
    for host, path in split:
        above = suffixes(host)
        own = [
            (len(h) + n, len(h), verdict, h + path[:n])
            for h in above for n in lengths if n <= len(path) for verdict in ("block", "allow")
        ]
        listed = [*(f"h:{h}" for h in above), *(f"f:{r}" for r in runs(host, sizes))]
        wanted.append((own, listed))
        asked.update(dict.fromkeys(_key(*c) for c in own))
        asked.update(dict.fromkeys(listed))
    probes = list(asked)
    hit = dict(zip(probes, digests.found(probes)))
    for (page_id, _), (host, path), (own, listed) in zip(rows, split, wanted):
        fitting = [c for c in own if hit[_key(*c)]]
        if fitting:
            _, _, verdict, rule = max(fitting)
            yield page_id, host, path, rule, verdict
        else:
            yield page_id, host, path, None, "block" if any(hit[k] for k in listed) else "allow"


def _key(_: int, host_length: int, verdict: str, rule: str) -> str:
    return f"{verdict[0]}{host_length}:{rule}"


#: Oracle over ``pages``, with the rules and hosts written out.
SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN url LIKE '%://%'
    THEN regexp_replace(substr(url, instr(url, '://') + 3), '[?#][\\s\\S]*$', '') ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(split_part(rest, '/', 1)) + 1) AS path
  FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM split
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host,
    '(^|\\.)(ads-track\\.example\\.org|cheap-pills\\.example\\.com|free-bets\\.example\\.com|spam-farm\\.example\\.org)$')
    THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""
