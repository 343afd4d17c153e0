import hashlib
import random

import pytest

from citeloom.operators import hashing
from citeloom.operators.hashing import hash_files, hash_identifiers, hash_values


def _hash(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "id string").repartition(3)
    return hash_identifiers(df, **options).first()["hash"]


def test_exact_hash_is_that_of_the_sorted_list(spark):
    ids = ["pmid:77", "doi:10.5/q", "pmcid:PMC8"]
    want = hashlib.sha256("\n".join(sorted(ids)).encode()).hexdigest()[:16]
    assert _hash(spark, [" pmid:77", "  ", "doi:10.5/q ", "pmcid:PMC8"], mode="exact") == want
    assert hash_values(ids) == hash_values(ids[::-1] + [" "]) == want
    with pytest.raises(ValueError, match="sum or exact"):
        _hash(spark, ids, mode="other")


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="at least one identifier"):
        _hash(spark, ["  "])
    with pytest.raises(ValueError, match="at least one identifier"):
        hash_values(["\t"])


def test_exact_hash_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(hashing, "EXACT_LIMIT", 3)
    assert len(_hash(spark, "abc", mode="exact")) == 16
    with pytest.raises(ValueError, match="3 identifiers at most"):
        _hash(spark, "abcd", mode="exact")


def test_hash_is_order_free_and_counts_repeats(spark):
    values = [str(i) for i in range(3_000)] + ["7"] * 500
    shuffled = values[:]
    random.Random(1).shuffle(shuffled)
    whole = _hash(spark, values)
    assert whole == _hash(spark, shuffled) and len(whole) == 16
    assert whole != _hash(spark, values[:-1])
    assert whole != _hash(spark, values[1:] + ["x"])


def test_the_rule_does_not_depend_on_size(spark):
    """Sums of the digests' limbs and the number of values, hashed once more."""
    for values in (["a"], ["b", "a", "b"], list(map(str, range(400)))):
        digests = [hashlib.sha256(v.encode()).hexdigest() for v in values]
        sums = [sum(int(d[i : i + 5], 16) for d in digests) for i in range(0, 64, 5)]
        text = "\n".join(map(str, [*sums, len(values)]))
        assert _hash(spark, values) == hashlib.sha256(text.encode()).hexdigest()[:16]


def test_tree_hash_is_that_of_the_distinct_values_and_their_counts(spark):
    from hashlib import sha256

    values = [str(i) for i in range(3_000)] + ["7"] * 500
    entries, branches = {}, {}
    for value in set(values):
        sha = sha256(value.encode()).hexdigest()
        entries.setdefault(int(sha[:5], 16), []).append(f"{sha}:{values.count(value)}")
    for leaf, found in entries.items():
        digest = sha256("\n".join(sorted(found)).encode()).hexdigest()
        branches.setdefault(leaf // 1024, []).append(f"{leaf:07d}:{digest}")
    top = [f"{k:07d}:" + sha256("\n".join(sorted(v)).encode()).hexdigest() for k, v in branches.items()]
    want = sha256("\n".join(sorted(top)).encode()).hexdigest()[:16]
    assert _hash(spark, values, mode="tree") == _hash(spark, values[::-1], mode="tree") == want
    assert want != _hash(spark, values[:-1], mode="tree")


def test_file_hash_keeps_order(spark, tmp_path, monkeypatch):
    def write(name, text):
        (tmp_path / name).write_bytes(text.encode())
        return str(tmp_path / name)

    lines = [f"line {i}" for i in range(50)]
    whole = "\n".join(lines) + "\n"
    a = hash_files(spark, [write("a", whole)])
    assert a == hash_files(spark, [write("b", whole)]) and len(a) == 16  # names do not count
    swapped = "\n".join([lines[1], lines[0], *lines[2:]]) + "\n"
    assert a != hash_files(spark, [write("c", swapped)])
    assert a != hash_files(spark, [write("d", whole.rstrip())])
    two = [write("e", "one\n"), write("f", "two\n")]
    assert hash_files(spark, two) == hash_files(spark, two[::-1] + [str(tmp_path / "missing")])
    assert hash_files(spark, two) != hash_files(spark, [write("g", "two\n"), write("h", "one\n")])
    assert hash_files(spark, two) != hash_files(spark, [write("i", "one\ntwo\n")])
    assert hash_files(spark, [str(tmp_path / "missing")]) == hashlib.sha256().hexdigest()[:16]
    # More ranges than one, and more levels than one in use.
    monkeypatch.setattr(hashing, "_FANOUT", 4)
    assert hash_files(spark, [write("a", whole)], 7) != hash_files(spark, [write("c", swapped)], 7)
    assert hash_files(spark, [write("a", whole)], 7) == hash_files(spark, [write("j", whole)], 7)


@pytest.mark.parametrize(
    "one, other",
    [(b"x\ry\n", b"x\ny\n"), (b"x\ny\r\n", b"x\r\ny\n"), (b"x\n", b"x"), (b"", b"\0"), (b"\xff\xfe", b"\xff\xfd"),
     (b"a" * 5_000, b"a" * 4_999 + b"b")],
)
def test_files_that_differ_in_a_byte_hash_apart(spark, tmp_path, one, other):
    (tmp_path / "one").write_bytes(one)
    (tmp_path / "other").write_bytes(other)
    (tmp_path / "again").write_bytes(one)
    names = [str(tmp_path / n) for n in ("one", "other", "again")]
    first, second, third = (hash_files(spark, [n], 1024) for n in names)
    assert first == third != second


def test_ranges_are_the_same_however_they_are_read(spark, tmp_path, monkeypatch):
    (tmp_path / "f").write_bytes(bytes(range(256)) * 9)
    (tmp_path / "empty").write_bytes(b"")
    files = spark.read.format("binaryFile").load(str(tmp_path))

    def read():
        rows = hashing.range_digests(files, 100).collect()
        return sorted((r["path"].split("/")[-1], r["place"], r["digest"]) for r in rows)

    by_range = read()
    monkeypatch.setattr(hashing, "_ARROW_STORES", ("none:",))
    assert read() == by_range and len(by_range) == 24
    data = (tmp_path / "f").read_bytes()
    assert [d for n, _, d in by_range if n == "f"] == [
        hashlib.sha256(data[i : i + 100]).hexdigest() for i in range(0, len(data), 100)
    ]
