import random
import re

import numpy as np
import pytest

from citeloom.llm import templates
from tests.llm.conftest import CLASHES, ODD_ROWS, frame, prose

QUESTION = (
    "If Maria walks 12 km on Monday and then Maria walks another 7 km with Peter before noon, "
    "how many km did Maria walk in total that week?"
)
AGAIN = (
    "If Sonja walks 31 miles on Monday and then Sonja walks another 9 miles with Igor before noon, "
    "how many miles did Sonja walk in total that week?"
)
MIXED = (
    "If Sonja walks 31 miles on Monday and then Helga walks another 9 miles with Igor before noon, "
    "how many miles did Bruno walk in total that week?"
)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def hits(docs, items, **kw):
    found = templates.contaminated(docs, items, **kw)
    return sorted((r["doc_id"], r["item_id"], r["verbatim"]) for r in found.collect())


def brute_verbatim(rows, items):
    """Documents that hold an item word for word."""
    norm = lambda t: " " + " ".join(t.split()) + " "
    return sorted(
        (d, i, True) for d, t in rows for i, q in items if len(q.split()) >= 5 and norm(q) in norm(t or "")
    )


def test_asked_again_with_other_values(spark):
    items = benchmark(spark, [(1, QUESTION)])
    around = lambda q: f"{prose(1, 40)} {q} {prose(2, 40)}"
    rows = [(1, around(QUESTION)), (2, around(AGAIN)), (3, around(MIXED)), (4, prose(3, 100)), (5, QUESTION)]
    assert hits(frame(spark, rows), items) == [(1, 1, True), (2, 1, False), (5, 1, True)]


def test_longer_names_and_units_apart(spark):
    items = benchmark(spark, [(1, QUESTION), (2, QUESTION.replace("12 km", "12km"))])
    rows = [(1, QUESTION.replace("Maria", "Anna Lee")), (2, QUESTION.replace(" km on", "km on"))]
    assert {(d, i) for d, i, _ in hits(frame(spark, rows), items)} == {(d, i) for d in (1, 2) for i in (1, 2)}


def test_values_that_meet_and_values_that_part(spark):
    passage = prose(21, 20) + " and Maria " + prose(22, 20).lower() + " near Maria " + prose(23, 14).lower()
    items = benchmark(spark, [(1, QUESTION), (2, passage)])
    met = QUESTION.replace("12 km", "9 km").replace("7 km", "9 km")
    rows = [(1, met), (2, passage.replace("near Maria", "near Sonja"))]
    assert {(d, i) for d, i, _ in hits(frame(spark, rows), items)} == {(1, 1), (2, 2)}


def test_copies_of_any_words(spark):
    items = ["Who Was The First King Of Old Norway Then", "3 17 42 9 118 6 77 21 5", "Maria sees seven dogs here"]
    rows = [(d, f"{prose(30 + d, 30)} so {q} {prose(40 + d, 20)}") for d, q in enumerate(items)]
    found = hits(frame(spark, rows), benchmark(spark, list(enumerate(items))))
    assert found == [(d, d, True) for d in range(3)]


def test_placeholders_alone_match_nothing(spark):
    items = benchmark(spark, [(1, "1 2 3 4 5 6 7 8 9 10"), (2, "rows 1 2 3 4 5 6 7 8 9")])
    rows = [(1, "9 8 7 6 5 4 3 2 1 0 11 12"), (2, " ".join(map(str, range(300))))]
    assert hits(frame(spark, rows), items) == []


def test_verbatim_items_equal_a_search(spark):
    rng = random.Random(4)
    items = [(i, prose(900 + i, rng.randint(3, 40))) for i in range(30)]
    rows = []
    for d in range(80):
        text = prose(d, rng.randint(20, 80)) + "."
        if d % 3 == 0:
            text += "\n" + items[d % 30][1] + "\n" + prose(d + 500, 20)
        rows.append((d, text))
    got = hits(frame(spark, rows), benchmark(spark, items))
    assert set(brute_verbatim(rows, items)) <= set(got)
    assert {d for d, _, _ in got} == {d for d, _, _ in brute_verbatim(rows, items)}


def test_a_part_below_the_share_is_no_hit(spark):
    item = prose(5, 40).lower()
    words = item.split()
    rows = [(1, prose(6, 30) + " " + " ".join(words[:12])), (2, prose(7, 30) + " " + " ".join(words[:30]))]
    assert [d for d, _, _ in hits(frame(spark, rows), benchmark(spark, [(1, item)]))] == [2]


def test_many_copies_and_repeats(spark):
    items = benchmark(spark, [(1, QUESTION), (1, QUESTION), (2, QUESTION)])
    rows = [(i, QUESTION + " " + QUESTION) for i in range(50)]
    assert hits(frame(spark, rows), items) == sorted((i, q, True) for i in range(50) for q in (1, 2))


def test_odd_documents(odd, none, spark):
    items = benchmark(spark, [(1, prose(4, 80)), (2, None), (3, ""), (None, prose(9, 20_000)), (4, "too short")])
    found = templates.contaminated(odd, items).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(4, 1), (4, 1), (5, 1), (9, None)], key=repr)
    kept = templates.decontaminate(odd, items)
    assert kept.columns == odd.columns and CLASHES[1] in kept.columns
    assert kept.count() == len(ODD_ROWS) - 4
    assert templates.contaminated(none, items).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    assert templates.contaminated(odd, empty).collect() == []
    assert templates.decontaminate(odd, empty).count() == len(ODD_ROWS)


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("he paid 5 dollars to Anna. Then", "0013020"),
        ("the 3,500.5 kg load", "0130"),
        ("it weighs 3kg", "001"),
        ("percent of it", "000"),
    ],
)
def test_types(text, kinds):
    made = templates.Templates()
    words = made.words_of(text)
    found = made.canonical(words)[1]
    assert len(found) == len(re.findall(r"\S+", text))
    assert "".join(map(str, found)) == kinds.ljust(len(found), "0")[: len(found)]


def test_many_contaminated_texts_are_joined_by_key(spark, scratch, monkeypatch):
    words = [prose(i, 30) for i in range(6)]
    docs = frame(spark, [(i, words[i % 6] + " and more") for i in range(60)] + [(99, None), (100, prose(99, 40))])
    docs = docs.withColumnRenamed("key", "_template_key")
    benchmark = spark.createDataFrame([(i, w) for i, w in enumerate(words[:3])], "item_id long, text string")
    few = templates.decontaminate(docs, benchmark, scratch)
    monkeypatch.setattr(templates, "BROADCAST_KEYS", 0)
    many = templates.decontaminate(docs, benchmark)
    want = sorted([i for i in range(60) if i % 6 > 2] + [99, 100])
    assert sorted(r["doc_id"] for r in few.collect()) == sorted(r["doc_id"] for r in many.collect()) == want
    assert few.columns == many.columns == docs.columns


def test_eight_words_cost_three_steps_and_hash_as_one_sum():
    class Counting(np.ndarray):
        def __mul__(self, other):
            steps.append(1)
            return super().__mul__(other)

    steps, words = [], np.arange(3, 40, dtype=np.uint64) * np.uint64(0x1234567890ABCDF)
    maker, factor = templates.Templates(), templates._MULTIPLIER
    for size in (1, 4, 5, 7, 8):
        del steps[:]
        got = maker.sums(words.view(Counting), size)
        want = [sum(int(w) * factor ** (size - 1 - i) for i, w in enumerate(words[a : a + size])) % 2**64 for a in range(len(words) - size + 1)]
        assert got.tolist() == want
        assert len(steps) == {1: 0, 4: 2, 5: 3, 7: 4, 8: 3}[size]


def test_words_with_a_mark_are_read_as_the_words_they_hold():
    alone, flags = templates._word("Miles"), {",": 0, ";": 0, ".": templates._STOP, "!": templates._STOP, "?": templates._STOP, ":": templates._STOP}
    assert alone & 31 == templates._CAPITAL | templates._UNIT_WORD
    for mark, more in flags.items():
        assert templates._word("Miles" + mark) == alone | more
    assert templates._word("...") & 31 == templates._STOP and templates._word("7.") & 31 == templates._STOP | templates.NUMBER
