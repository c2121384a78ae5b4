"""URL rules against a plain loop; collisions; odd urls."""

import random

import pytest
from paddock.llm import url_filter as uf

PAGES = "page_id long, url string, HOST string, verdict string"


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for stop in "?#":
            rest = rest.split(stop, 1)[0]
        host, slash, more = rest.partition("/")
        path = slash + more
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in uf.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fitting:
        return host, path, max(fitting)[2], max(fitting)[3]
    bad = any(host == h or host.endswith("." + h) for h in uf.BLOCKED_HOSTS)
    return host, path, None, "block" if bad else "allow"


def test_random_urls(spark):
    chance = random.Random(4)
    parts = ["http", "://", "/", "?", "#", "a.", "example.net", "EXAMPLE.com", "org", "net", "/en/", "/de/", "/fr/", "x", ".", "Ä", "spam-farm.example.org"]
    urls = [None, "", "://", "http://net/", "http://NET", "http://a..net/x"]
    urls += ["http://" + "".join(chance.choice(parts) for _ in range(chance.randint(0, 9))) for _ in range(600)]
    urls += ["http://example.net/en/" + "y" * 200_000]
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, "http://a.net/", "", ""), (1, "", "", "")]
    got = uf.judge(spark.createDataFrame(rows, PAGES)).collect()
    want = [(i, *plain(u)) for i, u, _, _ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty(spark):
    assert uf.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_longest_rule_wins(spark):
    rules = (("example.net", "/", "block"), ("a.example.net", "/", "allow"), ("example.net", "/deep/er/", "allow"))
    frame = spark.createDataFrame([(1, "http://b.a.example.net/deep/er/x"), (2, "http://example.net/deep")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in uf.judge(frame, rules, ()).collect()}
    assert got == {1: ("example.net/deep/er/", "allow"), 2: ("example.net/", "block")}


def test_a_family_is_blocked_under_any_ending(spark):
    hosts = ["ads-track.example.com", "m.Ads-Track.example.org", "ads-track.co.uk", "my-ads-track.example.com", "example.ads-track", "ads-track",
             "www.spam-farm.example.com", "spam-farm.other.com", "spam-farm.example", "", "."]
    frame = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in uf.judge(frame, (), (), ("ads-track", "SPAM-farm.example")).collect()}
    assert [i for i in sorted(got) if got[i] == "block"] == [0, 1, 2, 6]
    ruled = uf.judge(frame, (("example.com", "/", "allow"),), (), ("ads-track",)).collect()
    assert {r.page_id: r.verdict for r in ruled}[0] == "allow"


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(uf.xxhash, "xxh64_intdigest", lambda s: len(s) % 3)
    path = tmp_path / "digests"
    path.write_bytes(uf.build(["aa", "bb", "c", "dddd", "aa"]))
    assert uf.Digests(str(path)).found(["aa", "bb", "cc", "c", "dddd", "eeee", ""]) == [True, True, False, True, True, False, False]
    path.write_bytes(b"x" * 64)
    with pytest.raises(ValueError):
        uf.Digests(str(path))


def test_a_million_strings(spark, tmp_path):
    """The file of a long list, families included: every string is found and no other one is."""
    strings = [f"h:host{i}.example{i % 97}.com" for i in range(700_000)] + [f"f:family-{i}.brand{i % 31}" for i in range(300_000)]
    path = tmp_path / "digests"
    path.write_bytes(uf.build(strings))
    digests = uf.Digests(str(path))
    assert digests.n == 1_000_000
    asked = strings[::997] + [f"{s}x" for s in strings[::991]] + [s[2:] for s in strings[::1009]]
    assert digests.found(asked) == [True] * len(strings[::997]) + [False] * (len(asked) - len(strings[::997]))


def test_long_lists_judge_pages(spark):
    urls = [(i, f"https://sub.host{i}.example{i % 97}.com/a") for i in range(0, 5000, 7)]
    urls += [(10_000 + i, f"http://x.family-{i}.brand{i % 31}.org/") for i in range(0, 3000, 11)] + [(99_999, "https://host1.example2.com/")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    hosts = [f"host{i}.example{i % 97}.com" for i in range(100_000)]
    families = [f"family-{i}.brand{i % 31}" for i in range(50_000)]
    got = {r.page_id: r.verdict for r in uf.judge(pages, (), hosts, families).collect()}
    assert got.pop(99_999) == "allow" and set(got.values()) == {"block"} and len(got) == len(urls) - 1


def test_a_file_that_is_not_whole_has_no_name(spark, monkeypatch):
    from pathlib import Path

    from paddock.session import shared_dir

    data = uf.build(["h:only.example.com"])
    name = uf.distribute(spark, data)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    assert (folder / name).read_bytes() == data
    assert not [p for p in folder.glob(f"{name}.*")]
    assert uf.distribute(spark, data) == name
