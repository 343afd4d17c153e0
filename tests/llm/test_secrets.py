import hashlib
import random
import re

import pytest

from citeloom.llm import secrets
from tests.llm.conftest import ODD_ROWS, frame

RULES = secrets.BASE_RULES + secrets.MORE_RULES
PARTS = [
    "password", "PassWd", "secret", "token", "api_key", "APIKEY", ":", "=", " ", '"', "'", "abc", "deadbeef01",
    "AKIA", "ABCDEFGH", "0123456789abcdef", "é", "日", "\n", "x", "/+.", "😀", "ghp_" + "a1B2" * 9, "K",
    "xoxb-1234567890ab", "https://me:pass@host", "-----BEGIN RSA PRIVATE KEY-----", "sk_live_" + "0aZ9" * 5,
]


def brute(text, rules=RULES):
    found = []
    for number, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def test_trigram_queries():
    ways = lambda p: [[sorted(w) for w in part] for part in secrets.trigram_query(p)]
    assert ways("AKIA[A-Z]+") == [[["aki", "kia"]]]
    assert ways("[0-9a-f]+") == [] and ways("ab|cde") == [] and ways("(abc)?") == []
    assert ways("abcd|xyz") == [[["abc", "bcd"], ["xyz"]]]
    assert ways("ab?cd") == [[["abc", "bcd"], ["acd"]]]
    assert ways("(abc)+x*def") == [[["abc"]], [["def"]]]
    assert ways("a[bc]d") == [[["abd"], ["acd"]]]
    assert len(ways(RULES[0].pattern)[0]) == 6


@pytest.mark.parametrize("seed", range(3))
def test_queries_lose_no_match(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 14)))
        for rule in RULES:
            if re.search(rule.pattern, text):
                low = text.lower()
                assert all(any(all(t in low for t in w) for w in p) for p in secrets.trigram_query(rule.pattern))


def test_spans(spark, scratch):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(300)]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(frame(spark, rows), scratch).collect()}
    for i, text in rows:
        assert got[i] == brute(text), repr(text)


def test_spans_of_very_many_matches(spark, scratch):
    """Also one match fewer and more than whole runs of them hold."""
    rng = random.Random(6)
    texts = [
        "é" + " ".join("".join(rng.choices("0123456789abcdef", k=rng.choice([5, 31, 32, 40]))) for _ in range(n))
        for n in (secrets.RUN - 1, secrets.RUN, secrets.RUN + 1, 2 * secrets.RUN, 20_000)
    ]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(frame(spark, list(enumerate(texts))), scratch).collect()}
    for i, text in enumerate(texts):
        assert [tuple(s) for s in got[i]] == brute(text)


def test_report_of_odd_documents(odd, none, scratch):
    rows = secrets.report(odd, scratch).collect()
    want = []
    for row in ODD_ROWS:
        found = brute(row[1] or "")
        base = [f for f in found if f[1] < 3]
        show = lambda spans: ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in spans)
        counts = [sum(k == i for _, k, _ in base) for i in range(3)]
        want.append((row[0], *counts, hashlib.sha256(show(base).encode()).hexdigest(), show(found)))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert secrets.report(none, scratch).collect() == []
