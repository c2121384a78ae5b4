"""The automaton against plain expressions."""

import hashlib
import random
import re

import numpy as np
import pytest
from paddock.llm import secrets
from paddock.llm.automaton import Automaton

BASE = [r.kind for r in secrets.BASE]


def plain(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


PARTS = [
    "password", "secret", "toKen", "api_key", "apikey", "PASSWD", " ", ":", "=", '"', "'", "a", "0", "é", "\n", "AKIA",
    "AK", "ABCDEFGH12345678", "0123456789abcdef", "z", "_", ".", "=:", "ſecret", "deadbeef", "token=", "-",
]


def test_random_texts():
    chance = random.Random(3)
    scan = secrets.scanner(secrets.RULES).scan
    for _ in range(60):
        texts = ["".join(chance.choice(PARTS) for _ in range(chance.randint(0, 60))) for _ in range(100)]
        for text, spans in zip(texts, scan([t.encode() for t in texts])):
            own = sorted((s for s in spans if s[0] in BASE), key=lambda s: (s[1], BASE.index(s[0])))
            assert own == plain(text), text


@pytest.mark.parametrize("lanes", [1, 3, 64])
def test_lanes_agree_with_one_pass(lanes):
    automaton = Automaton([r"ab+c", r"[0-9]{3,}", r"x(?:yz)*"], search=True)
    data = np.frombuffer(bytes(random.Random(6).choice(b"abcxyz019 ") for _ in range(40_000)), np.uint8)
    state, want = 0, []
    for byte in data.tolist():
        state = int(automaton.next[state, automaton.classes[byte]])
        want.append(state)
    assert automaton.states(data, lanes).tolist() == want


def test_automaton_is_minimal_and_right():
    automaton = Automaton([r"(?:a|b)*abb"], search=False)
    assert len(automaton.masks) == 5  # the four states of the textbook and the dead one
    for word in ("abb", "aabb", "babb", "ab", "abba", ""):
        state = 0
        for byte in word.encode():
            state = int(automaton.next[state, automaton.classes[byte]])
        assert bool(automaton.masks[state]) == bool(re.fullmatch(r"(?:a|b)*abb", word))


def test_other_rules():
    text = "é ghp_" + "A1" * 18 + " -----BEGIN RSA PRIVATE KEY----- xoxb-123456789012-abcdefghij AIza" + "b" * 35
    spans = secrets.scanner(secrets.RULES).scan([text.encode()])[0]
    assert {(k, text[a:b][:4]) for k, a, b in spans} >= {("github", "ghp_"), ("private_key", "----"), ("slack", "xoxb"), ("google", "AIza")}


def test_a_private_key_is_found_whole():
    lines = ["MIIEpAIBAAKCAQEA" + "b+/9" * 12, "Q" * 64, "short"]
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    sealed = [head, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", "", *lines, end]
    keys = ["\n".join([head, *lines, end]), "\r\n".join(sealed), "\n    ".join([head, *lines, end]), "\\n".join([head, *lines, end]), "\n".join([head, *lines[:2], "ab=="]), head]
    for key in keys:
        for before, after in (("", ""), ("é key: ", "\nThen the text goes on."), ("x", " is a line.")):
            spans = secrets.scanner(secrets.RULES).scan([(before + key + after).encode()])[0]
            assert [s for s in spans if s[0] == "private_key"] == [("private_key", len(before), len(before + key))]
    secrets.scanner(secrets.RULES).scan([(head + part * 100_000).encode() for part in ("\n", "\\n", "a", "a ", "a\n", "Ab: c\n", "QQ==\n")])


def test_a_redacted_key_leaves_nothing(spark, docs):
    key = "-----BEGIN PRIVATE KEY-----\n" + "Ab+/" * 16 + "\nxyz\n-----END PRIVATE KEY-----"
    assert secrets.redact(docs([(1, f"a\n{key}\nb")])).first()["text"] == "a\n[SECRET]\nb"


def test_columns(spark, docs, odd_texts):
    texts = [*odd_texts, "token = abcdefghijkl", "é" * 70_000 + " AKIA" + "B" * 20, "f" * 100_000]
    pairs = [(i, t) for i, t in enumerate(texts)] + [(None, "0" * 16), (1, "0" * 16), (1, "0" * 16)]
    got = secrets.find(docs(pairs, clash=True)).collect()
    want = []
    for i, t in pairs:
        spans = plain(t)
        counts = [sum(s[0] == k for s in spans) for k in BASE]
        want.append((i, *counts, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert secrets.find(docs([])).count() == 0


def test_redact(spark, docs):
    pairs = [(1, "é token=abcdefghijklmn, ok"), (2, None), (3, "clean"), (None, "x 0123456789abcdef 0123456789abcdef")]
    got = sorted(map(tuple, secrets.redact(docs(pairs)).select("doc_id", "text", "n_chars").collect()), key=repr)
    want = [(1, "é [SECRET], ok", 14), (2, None, None), (3, "clean", 5), (None, "x [SECRET] [SECRET]", 19)]
    assert got == sorted(want, key=repr)
    clashing = secrets.redact(docs(pairs, clash=True))
    assert clashing.columns == ["doc_id", "text", "TEXT", "spans", "score"] and clashing.count() == 4
    assert secrets.redact(docs([])).count() == 0
