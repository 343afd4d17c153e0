import itertools
import random
import re

import numpy as np
import pytest
from tests.llm.conftest import ODD_ROWS, frame, prose

from citeloom.llm import filter_audit
from citeloom.llm.filter_audit import Counter, survival_word


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        c
        for c, fails in {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
        }.items()
        if fails
    }


def brute_force(rows, labels):
    """One document after another through every order of the filters."""
    least, good, toxic = {}, set(), set()
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, quality, poison, *_ in labels:
        good |= {doc_id} if quality == 1 else set()
        toxic |= {doc_id} if poison == 1 else set()
    report, shapley = {}, {}
    for doc_id, text, *rest in rows:
        part = (rest[0] if rest else "en") or ""
        own = failed(text or "")
        if doc_id is not None and doc_id > least[text or ""]:
            own.add("E")
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                row = report.setdefault((part, order, step, letter), [0] * 6)
                fails = letter in own
                removed = fails and not gone
                row[0] += not gone and not fails
                row[1] += removed
                row[2] += fails and gone
                row[3] += own == {letter}
                row[4] += removed and doc_id is not None and doc_id in good
                row[5] += removed and doc_id is not None and doc_id in toxic
                shapley[part, letter] = shapley.get((part, letter), 0) + removed
                gone = gone or fails
    return {key: (*row, shapley[key[0], key[3]]) for key, row in report.items()}


def audited(spark, rows, labels, scratch, docs=None):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string, n long")
    got = filter_audit.audit(docs if docs is not None else frame(spark, rows), table, scratch).collect()
    return {tuple(r)[:4]: tuple(r)[4:] for r in got}


def test_equals_brute_force(spark, scratch):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        text = prose(rng.randrange(30), rng.choice([5, 150, 220, 400]))
        text = text.upper() if rng.random() < 0.2 else text
        text = " ".join(text.split()[:10] * 30) if rng.random() < 0.2 else text
        text += rng.choice(["", "", " 5%", " #"])
        rows.append((i, text, rng.choice(["en", "de", None, ""]), "s"))
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1), "x", 1) for i in range(0, 120, 2)]
    assert audited(spark, rows, labels, scratch) == brute_force(rows, labels)


def test_odd_documents_and_labels(spark, scratch, odd):
    labels = [(4, 1, 0, "x", 1), (4, None, 1, "x", 1), (None, 1, 1, "x", 1), (99, 1, 1, "x", 1), (7, None, None, "x", 1)]
    assert audited(spark, ODD_ROWS, labels, scratch, odd) == brute_force(ODD_ROWS, [(4, 1, 1)])


def test_a_text_that_fills_the_table(spark, scratch):
    rows = [(i // 2, "same words", "en" if i % 3 else "fr", "s") for i in range(90)]
    assert audited(spark, rows, [], scratch) == brute_force(rows, [])


def test_no_documents(spark, scratch, none):
    assert audited(spark, [], [], scratch, none) == {}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1_000])
def test_carry_save_counts(n):
    rng = np.random.default_rng(n)
    words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    times = rng.integers(0, 1_000_000, n)
    counter = Counter()
    for i in range(0, n, 7):
        counter.add(words[i : i + 7], times[i : i + 7])
    want = [int(sum(times[(words >> np.uint32(s)) & np.uint32(1) == 1])) for s in range(32)]
    assert counter.sums() == want
    assert all(len(plane) <= 2 for plane in counter.planes)


def test_survival_word():
    assert survival_word(0) == (1 << 32) - 1
    assert survival_word(31) == 1
    assert [s for s in range(32) if survival_word(0b00101) >> s & 1] == [0, 2, 8, 10, 16, 18, 24, 26]
